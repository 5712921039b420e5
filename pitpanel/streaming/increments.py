"""Incremental runs with Structured Streaming; every run processes what is new and ends (availableNow)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from pitpanel.functions.shared import dealt, settings
from pitpanel.sources.commits import Log


def stream(spark: SparkSession, path: str, like: str | None = None, files: int = 1) -> DataFrame:
    """A stream over Parquet files that land in ``path``, with the schema of ``like`` (or of path itself)."""
    return spark.readStream.schema(spark.read.parquet(like or path).schema).option("maxFilesPerTrigger", files).parquet(path)


def run(df: DataFrame, checkpoint: str, batch: Callable[[DataFrame, int], None], mode: str = "append") -> StreamingQuery:
    """Hands each micro-batch to ``batch`` until nothing new is left; a task reads one landed file (or a part of it), however many a batch takes."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(batch).trigger(availableNow=True)
    with settings(df.sparkSession, spark__sql__files__openCostInBytes=df.sparkSession.conf.get("spark.sql.files.maxPartitionBytes")):
        query = writer.start()
    query.awaitTermination()
    return query


def unique_append(df: DataFrame, sink: str, checkpoint: str, key: list[str], at: str | None = None, delay: str = "1 day") -> StreamingQuery:
    """Rows whose key was not seen before; repeated content and repeated runs add nothing.

    What was seen is kept in the engine's state store, so a batch reads no earlier one. With the event time ``at``, state older
    than ``delay`` behind the newest row is dropped. A batch goes to a folder of its own that a rerun of the
    same batch overwrites, so a lost driver leaves no half batch behind.
    """
    seen = df.dropDuplicates(key) if at is None else df.withWatermark(at, delay).dropDuplicatesWithinWatermark(key)
    return run(seen, checkpoint, lambda rows, number: rows.write.mode("overwrite").parquet(f"{sink}/batch={number}"))


def cutoff_split(df: DataFrame, sink: str, checkpoint: str, at: str, cutoff: str) -> StreamingQuery:
    """Rows up to the cutoff to <sink>/frozen, later ones to <sink>/observed, in one pass over each batch."""

    def batch(rows: DataFrame, number: int) -> None:
        view = F.when(F.col(at) <= F.to_timestamp(F.lit(cutoff)), "frozen").otherwise("observed")
        rows.withColumn("view", view).withColumn("batch", F.lit(number)).write.mode("overwrite").partitionBy("view").parquet(f"{sink}/run={number}")

    return run(df, checkpoint, batch)


def latest_upsert(df: DataFrame, sink: str, checkpoint: str, key: list[str], at: str, tie: str) -> StreamingQuery:
    """Keeps the newest row of each key in the state store; a batch writes the keys that it changed, and ``current`` reads the last of each."""
    whole = F.struct(*(F.col(c) for c in df.columns))
    newest = df.groupBy(*(F.col(k).alias(f"_{k}") for k in key)).agg(F.max_by(whole, F.struct(at, tie)).alias("_r")).select("_r.*")
    return run(newest, checkpoint, lambda rows, number: rows.write.mode("overwrite").parquet(f"{sink}/batch={number}"), "update")


def compact(spark: SparkSession, sink: str, key: list[str]) -> int:
    """Folds all batches of a sink so far into one base with each key's last row; how many batches the next read still has to look at.

    A base is counted by a commit, so a reader sees the old batches or the base. Batches that come later are read beside it.
    """
    log = Log(spark, sink)
    number, body = log.last(), log.read()
    upto = newest_batch(spark, sink)
    if upto > body.get("upto", -1):
        folder = f"{sink}-base/upto={upto}"
        current(spark, sink, key, upto).write.mode("overwrite").parquet(folder)
        log.commit(number + 1, {"upto": upto, "folder": folder})
    return max(0, newest_batch(spark, sink) - upto)


def newest_batch(spark: SparkSession, sink: str) -> int:
    return int(last_folder(spark, sink, "batch").rsplit("=", 1)[1])


def batches(spark: SparkSession, sink: str, upto: int | None = None) -> DataFrame:
    """What a sink holds, with each row's ``batch`` (up to ``upto``): the base, as batch -1, and the batches after it."""
    body = Log(spark, sink).read()
    last = newest_batch(spark, sink) if upto is None else upto
    first = body.get("upto", -1) + 1
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    there = lambda p: (x := jvm.org.apache.hadoop.fs.Path(p)).getFileSystem(conf).exists(x)
    later = [p for k in range(first, last + 1) if there(p := f"{sink}/batch={k}")]
    rows = spark.read.option("basePath", sink).parquet(*later) if later else None
    if body:
        base = spark.read.parquet(body["folder"])
        base = base.withColumn("batch", F.lit(-1))
        rows = base if rows is None else rows.unionByName(base)
    return rows


def current(spark: SparkSession, sink: str, key: list[str], upto: int | None = None) -> DataFrame:
    """Each key's row as its last batch (of those up to ``upto``) wrote it."""
    rows = dealt(batches(spark, sink, upto), *key)
    whole = F.struct(*(F.col(c) for c in rows.columns if c != "batch"))
    return rows.groupBy(*(F.col(k).alias(f"_{k}") for k in key)).agg(F.max_by(whole, "batch").alias("_r")).select("_r.*")


def running_counts(df: DataFrame, checkpoint: str, sink: str, by: list[str], total: str) -> StreamingQuery:
    """Counters by state, kept by the engine's own aggregation and rewritten whole after each batch."""
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.max(total).alias("latest"))
    return run(counts, checkpoint, lambda rows, number: rows.write.mode("overwrite").parquet(f"{sink}/state={number}"), "complete")


def page_counts(df: DataFrame, checkpoint: str, sink: str, request: str, generation: str, due: str) -> StreamingQuery:
    """Pages that have come of each request and generation; a batch writes what it changed.

    Requests are never forgotten, so their state lies on disk, with a bound on what an executor holds of it.
    """
    pages = df.groupBy(request, generation).agg(F.count(F.lit(1)).alias("pages"), F.max(due).alias("due"))
    store = {"spark__sql__streaming__stateStore__providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider", "spark__sql__streaming__stateStore__rocksdb__boundedMemoryUsage": "true"}
    with settings(df.sparkSession, **store):
        return run(pages, checkpoint, lambda rows, number: rows.write.mode("overwrite").parquet(f"{sink}/batch={number}"), "update")


def newest_generations(spark: SparkSession, sink: str, request: str, generation: str) -> DataFrame:
    """Of each request the newest generation of pages, as its last batch wrote it, and whether it is complete."""
    rows = dealt(batches(spark, sink), request)
    whole = F.struct(*(F.col(c) for c in rows.columns if c != "batch"))
    newest = rows.groupBy(F.col(request).alias("_k")).agg(F.max_by(whole, F.struct(generation, "batch")).alias("r")).select("r.*")
    return newest.withColumn("complete", F.col("pages") == F.col("due"))


def last_folder(spark: SparkSession, sink: str, name: str) -> str:
    """The newest numbered folder of a sink, found through Spark's own file system layer."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(sink)
    numbers = [int(s.getPath().getName().split("=")[1]) for s in path.getFileSystem(conf).listStatus(path) if s.getPath().getName().startswith(f"{name}=")]
    return f"{sink}/{name}={max(numbers)}"
