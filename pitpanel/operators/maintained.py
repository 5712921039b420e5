"""Ranks kept up to date: only the cohorts that a change touches are read, ranked anew and written."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitpanel.sources.commits import Log

from . import ranks


class MaintainedRanks:
    """(key, cohort, value, percentile) of members, by cohort in ``buckets`` of the cohort's hash, copy on write.

    A change names a member, the cohort it was in (null for a new one), the one it is in now (null for one that leaves) and its value. The buckets of
    both cohorts are read and written, no others; in them the changed cohorts are ranked anew and the rest is copied. The result is that of a
    full run. A commit names all buckets' folders, so a reader sees all of a change or nothing.
    """

    COLUMNS = ("key", "cohort", "value", "percentile")

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path, self.buckets, self.log = spark, path, buckets, Log(spark, path)

    def _bucket(self, cohort: str):
        return F.pmod(F.xxhash64(cohort), F.lit(self.buckets)).cast("int")

    def _ranked(self, rows: DataFrame) -> DataFrame:
        counts = ranks.value_counts(rows, ["value"], ["cohort"])
        placed = ranks.count_ranks(counts, ["cohort"]).select("cohort", F.col("_v").alias("value"), ranks.percent_rank(F.col("rank"), F.col("n")).alias("percentile"))
        return ranks.null_safe_join(rows.select("key", "cohort", "value"), placed, ["cohort", "value"], "left").select(*self.COLUMNS)

    def _write(self, rows: DataFrame, number: int, body: dict, touched: list[int]) -> int:
        folder = f"{self.path}/data/{uuid.uuid4().hex}"
        rows.withColumn("_bucket", self._bucket("cohort")).repartition("_bucket").write.partitionBy("_bucket").parquet(folder)
        there = {r[0] for r in self.spark.read.parquet(folder).select("_bucket").distinct().collect()} if touched else set()  # at most one row a bucket
        held = {b: f for b, f in body.get("buckets", {}).items() if int(b) not in touched}
        self.log.commit(number + 1, {"buckets": held | {str(b): f"{folder}/_bucket={b}" for b in there}})
        return number + 1

    def full(self, rows: DataFrame) -> int:
        """Ranks all of (key, cohort, value)."""
        number = self.log.last()
        return self._write(self._ranked(rows.select("key", "cohort", F.col("value").cast("double").alias("value"))), number, {}, list(range(self.buckets)))

    def apply(self, changes: DataFrame) -> list[str]:
        """Applies (key, before, cohort, value) and returns the folders that were read."""
        number = self.log.last()
        body = self.log.read(number)
        cohorts = changes.select(F.explode(F.array("before", "cohort")).alias("cohort")).where("cohort IS NOT NULL").distinct()
        touched = [r[0] for r in cohorts.select(self._bucket("cohort").alias("b")).distinct().collect()]  # at most one row a bucket
        read = [f for b, f in body["buckets"].items() if int(b) in touched]
        schema = "key long, cohort string, value double, percentile double"
        old = self.spark.read.schema(schema).parquet(*read) if read else self.spark.createDataFrame([], schema)
        gone = changes.select("key").distinct()
        new = changes.where("cohort IS NOT NULL").select("key", "cohort", F.col("value").cast("double").alias("value"))
        stale = old.join(cohorts, "cohort", "left_semi").join(gone, "key", "left_anti").select("key", "cohort", "value").unionByName(new)
        kept = old.join(cohorts, "cohort", "left_anti")
        self._write(kept.select(*self.COLUMNS).unionByName(self._ranked(stale)), number, body, touched)
        return read

    def rows(self) -> DataFrame:
        return self.spark.read.parquet(*self.log.read()["buckets"].values()).select(*self.COLUMNS)
