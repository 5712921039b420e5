"""Landed snapshots: verified reading, idempotent appends, and latest versions."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitpanel.operators.audit import fingerprint

from .commits import Log

ENVELOPE = T.StructType([T.StructField(n, T.StringType()) for n in ("source", "dataset", "request", "fetched_at", "payload", "digest")])


def read_envelopes(spark: SparkSession, path: str) -> DataFrame:
    """JSON envelopes, a line each, with whether the stated digest is that of the payload; bad lines are all null and unverified."""
    rows = spark.read.schema(ENVELOPE).json(path)
    return rows.withColumn("verified", F.coalesce(F.sha2(F.col("payload").cast("binary"), 256) == F.col("digest"), F.lit(False)))


def split_verified(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(verified, quarantined)."""
    return rows.where("verified"), rows.where(~F.col("verified"))


def payload_hash(*volatile_free: str) -> Column:
    """The hash of the columns that carry meaning (no fetch times)."""
    return F.sha2(F.to_json(F.struct(*(F.col(c) for c in sorted(volatile_free))), {"ignoreNullFields": "false"}), 256)


def new_rows(batch: DataFrame, stored: DataFrame, key: list[str]) -> DataFrame:
    """The batch's rows, each key once, whose key is not stored yet."""
    return batch.dropDuplicates(key).join(stored.select(*key).distinct(), key, "left_anti")


def changed_rows(batch: DataFrame, stored: DataFrame, key: list[str], hash_col: str, at: str) -> DataFrame:
    """Rows whose hash differs from that of their key's latest stored row, or whose key is new."""
    last = stored.groupBy(*key).agg(F.max_by(hash_col, F.struct(at, hash_col)).alias("_last"))
    return batch.join(last, key, "left").where(~F.col(hash_col).eqNullSafe(F.col("_last"))).drop("_last")


def winners(rows: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """All revisions of a key with their place in winner order."""
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(*key).orderBy(*order)).cast("long"))


def required(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Renames source columns to stable ones; a missing one is an error before anything runs."""
    absent = sorted(set(names) - set(df.columns))
    if absent:
        raise ValueError(f"missing columns: {', '.join(absent)}")
    return df.withColumnsRenamed(names)


def sanitized(df: DataFrame, text: list[str], numbers: list[str], dates: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(clean, quarantined): numbers that aren't finite become null, dates and instants ISO text; rows with a challenge page in a text cell are set apart."""
    kinds, out = dict(df.dtypes), df
    for d in dates:
        out = out.withColumn(d, F.date_format(d, "yyyy-MM-dd" if kinds[d] == "date" else "yyyy-MM-dd'T'HH:mm:ss"))
    for n in numbers:
        d = F.col(n).cast("double")
        out = out.withColumn(n, F.when(~F.isnan(d) & (F.abs(d) != F.lit(float("inf"))), d))
    bad = F.lit(False)
    for t in text:
        bad = bad | F.coalesce(F.col(t).rlike(r"(?i)<html|captcha|access denied"), F.lit(False))
    return out.where(~bad), out.where(bad)


def write_partitioned(df: DataFrame, path: str, by: list[str], mode: str = "append") -> None:
    """A dataset laid out by its partition columns, one shuffle so that each partition has few files."""
    df.repartition(*by).write.mode(mode).partitionBy(*by).parquet(path)


def not_empty(df: DataFrame, name: str) -> DataFrame:
    """``df``, or an error if the source has no row."""
    if df.isEmpty():
        raise ValueError(f"the source {name} is empty")
    return df


def period_rows(rows: DataFrame, key: list[str], report: str, period: str, notice: str) -> DataFrame:
    """For each key: rows of the target period in either spelling, whether there are any, rows that lack only a date's plain form, and the target rows' notice dates."""
    target = F.col(report).isin(period, f"{period} 00:00:00")
    dates = F.array_sort(F.collect_set(F.when(target, F.col(notice))))
    midnight = F.col(report).rlike(r"^\d{4}-\d{2}-\d{2} 00:00:00$")
    return rows.groupBy(*key).agg(F.count_if(target).alias("target_rows"), F.bool_or(target).alias("present"), F.count_if(midnight).alias("repairable"), dates.alias("notice_dates"))


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None where nothing was written yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return spark.read.parquet(path) if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder) else None


def append_new(batch: DataFrame, path: str, key: list[str], by: list[str]) -> None:
    """Appends the batch's rows, each key once, whose key is not at ``path`` yet; a second run of the same batch adds nothing."""
    before = stored(batch.sparkSession, path)
    write_partitioned(batch.dropDuplicates(key) if before is None else new_rows(batch, before, key), path, by)


def put_view(rows: DataFrame, path: str, columns: list[str]) -> str:
    """Replaces the view at ``path`` by ``rows`` unless it holds the same rows; written or unchanged.

    A view stands in a folder of its own, and a numbered commit names the one that counts, so a reader sees a whole view, the old or
    the new one, also where a writer dies half-way.
    """
    mark, log = fingerprint(rows, columns).first()[0], Log(rows.sparkSession, path)
    number = log.last()
    if log.read(number).get("fingerprint") == mark:
        return "unchanged"
    folder = f"{path}/{mark}-{uuid.uuid4().hex}"
    rows.write.parquet(folder)
    log.commit(number + 1, {"fingerprint": mark, "folder": folder})
    return "written"


def view(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the view at ``path``."""
    return spark.read.parquet(Log(spark, path).read()["folder"])


def put_features(long: DataFrame, path: str, key: list[str], input_hash: str) -> None:
    """Writes a header row for each (key, input_hash) and its values as child rows, both only for headers that are not there yet.

    Both are made from one staged table and counted by one commit, which comes last: a run that dies before it added nothing, and
    its rerun adds everything once.
    """
    spark, head = long.sparkSession, [*key, input_hash]
    log = Log(spark, path)
    number = log.last()
    parts = log.read(number).get("parts", [])
    fresh = long.join(spark.read.parquet(*(f"{p}/headers" for p in parts)).select(*head), head, "left_anti") if parts else long
    part = f"{path}/{uuid.uuid4().hex}"
    fresh.write.parquet(f"{part}/values")
    values = spark.read.schema(long.schema).parquet(f"{part}/values")
    values.groupBy(*head).agg(F.count(F.lit(1)).alias("n_values"), F.count_if(F.col("status") == "derived").alias("n_derived")).write.parquet(f"{part}/headers")
    log.commit(number + 1, {"parts": [*parts, part]})


def feature_tables(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(headers, values) as of the newest commit."""
    parts = Log(spark, path).read()["parts"]
    return tuple(spark.read.parquet(*(f"{p}/{name}" for p in parts)) for name in ("headers", "values"))


def write_ordered(df: DataFrame, path: str, order: list[Column | str]) -> DataFrame:
    """Files that follow one another in ``order``, read back with each row's ``position`` from 0; positions come from the files' row counts."""
    spark = df.sparkSession
    df.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order).write.parquet(path)
    rows = spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_n")).select("_file", before.alias("_before"))  # a row a file
    return rows.join(F.broadcast(files), "_file").withColumn("position", F.col("_before") + F.col("_row")).drop("_file", "_row", "_before")
