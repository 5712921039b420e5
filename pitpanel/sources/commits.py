"""Numbered commits beside a dataset: what a reader trusts, and what two writers can't both take.

Data goes to folders of their own first; the commit file that names them comes last, by a rename that fails where the number is
taken. A writer that dies before it leaves folders that nobody reads; one that runs again takes up from the last commit.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Conflict(RuntimeError):
    """Another writer has taken the next number."""


class Log:
    """Commits 0, 1, 2, ... of a folder, each a small JSON object."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, f"{path}/commits"
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        conf = spark._jsc.hadoopConfiguration()
        self._fs = self._path(self.path).getFileSystem(conf)
        self._context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path(self.path).toUri(), conf)
        self._options = spark.sparkContext._gateway.new_array(getattr(jvm, "org.apache.hadoop.fs.Options$Rename"), 0)

    def last(self) -> int:
        """The newest number, -1 before the first commit."""
        folder = self._path(self.path)
        if not self._fs.exists(folder):
            return -1
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return max((int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith(".")), default=-1)

    def read(self, number: int | None = None) -> dict:
        """A commit, by default the newest; {} where there is none."""
        number = self.last() if number is None else number
        if number < 0:
            return {}
        stream = self._fs.open(self._path(f"{self.path}/{number:020d}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def commit(self, number: int, body: dict) -> None:
        """Takes the number for ``body``; Conflict if somebody else has it."""
        temporary = self._path(f"{self.path}/.{uuid.uuid4().hex}.tmp")
        out = self._fs.create(temporary, False)
        out.write(bytearray(json.dumps(body, sort_keys=True).encode()))
        out.close()
        try:
            self._context.rename(temporary, self._path(f"{self.path}/{number:020d}.json"), self._options)
        except Exception as e:
            self._fs.delete(temporary, False)
            if "FileAlreadyExists" in str(e):
                raise Conflict(f"commit {number} of {self.path} is taken") from e
            raise


class Items:
    """Rows by (run, key), changed only while their run is provisional.

    Rows stand in ``buckets`` by the hash of run and key. A batch rewrites the buckets it touches, copy on write, and one commit
    names all buckets' folders and the states of all runs; so a batch counts whole or not at all, and a run that is made final between
    a batch's check and its commit takes the number away from it.
    """

    def __init__(self, spark: SparkSession, path: str, run: str, key: str, schema: str, buckets: int = 16):
        self.spark, self.path, self.run, self.key, self.schema, self.buckets = spark, path, run, key, schema, buckets
        self.log = Log(spark, path)

    def _change(self, make: Callable[[dict], dict]) -> int:
        number = self.log.last()
        body = self.log.read(number) or {"runs": {}, "buckets": {}}
        self.log.commit(number + 1, make(body))
        return number + 1

    def set_run(self, run: str, state: str) -> int:
        """Begins a run (provisional), or ends it (final, invalidated); a run that has ended stays as it is."""

        def make(body: dict) -> dict:
            now = body["runs"].get(run)
            if (now is None) != (state == "provisional") or now not in (None, "provisional"):
                raise ValueError(f"run {run} can't go from {now} to {state}")
            return body | {"runs": body["runs"] | {run: state}}

        return self._change(make)

    def upsert(self, batch: DataFrame) -> int:
        """Puts the batch's rows in place of those with the same run and key; the whole batch is refused if one of its runs isn't provisional or a key stands twice."""
        number = self.log.last()
        body = self.log.read(number) or {"runs": {}, "buckets": {}}
        rows = batch.withColumn("_bucket", F.pmod(F.xxhash64(self.run, self.key), F.lit(self.buckets)).cast("int"))
        touched, runs = set(), set()
        for r in rows.select(self.run, "_bucket").distinct().limit(self.buckets * (len(body["runs"]) + 1) + 1).collect():  # at most runs x buckets rows, one more if a run is unknown
            runs.add(r[0])
            touched.add(r[1])
        if closed := sorted(str(r) for r in runs if body["runs"].get(r) != "provisional"):
            raise ValueError(f"not provisional: {', '.join(closed)}")
        if not rows.groupBy(self.run, self.key).count().where("count > 1").isEmpty():
            raise ValueError("a key stands twice in a batch")
        folder = f"{self.path}/data/{uuid.uuid4().hex}"
        before = self._read({b: f for b, f in body["buckets"].items() if int(b) in touched})
        kept = before.join(batch.select(self.run, self.key), [self.run, self.key], "left_anti")
        merged = kept.select(*batch.columns).unionByName(batch).withColumn("_bucket", F.pmod(F.xxhash64(self.run, self.key), F.lit(self.buckets)).cast("int"))
        merged.repartition("_bucket").write.partitionBy("_bucket").parquet(folder)
        self.log.commit(number + 1, body | {"buckets": body["buckets"] | {str(b): f"{folder}/_bucket={b}" for b in touched}})
        return number + 1

    def _read(self, folders: dict[str, str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders.values())

    def rows(self, number: int | None = None) -> DataFrame:
        """All rows as of a commit, by default the newest."""
        return self._read(self.log.read(number).get("buckets", {}))
