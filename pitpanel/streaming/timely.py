"""Streams in which time decides: facts held until they take effect, and a frozen view that late revisions don't erase."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from pitpanel.operators import versions
from pitpanel.sources.commits import Conflict, Log

from .increments import run


class Held(StatefulProcessor):
    """Keeps a group's rows until the watermark passes the instant from which they count; what comes later than that goes out at once."""

    def __init__(self, names: list[str], effective: str, schema: str):
        self.names, self.effective, self.schema = names, effective, schema

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", self.schema)

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803  the names are the engine's
        import pandas as pd

        now = pd.Timestamp(timerValues.getCurrentWatermarkInMs(), unit="ms")
        for part in rows:
            part = part[self.names]
            due = part[self.effective] <= now
            if due.any():
                yield part[due]
            waiting = part[~due]
            if len(waiting):
                self.rows.appendList([tuple(r) for r in waiting.astype(object).where(waiting.notna(), None).itertuples(index=False)])
                self.handle.registerTimer(int(waiting[self.effective].iloc[0].value // 1_000_000))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):  # noqa: N802, N803
        import pandas as pd

        yield pd.DataFrame([tuple(r) for r in self.rows.get()], columns=self.names)
        self.rows.clear()

    def close(self) -> None:
        pass


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """The state store that list state and timers need, for what is started inside."""
    setting, wanted = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    before = spark.conf.get(setting)
    spark.conf.set(setting, wanted)
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def usable_facts(df: DataFrame, sink: str, checkpoint: str, key: list[str], arrived: str, effective: str, delay: str = "0 seconds", buckets: int = 8) -> StreamingQuery:
    """Writes each fact once it may be used: when the clock, the watermark over ``arrived``, has passed its ``effective`` instant.

    State is kept for each instant in ``buckets`` by the hash of ``key``, each with one timer; ``key`` should name a fact, so that no bucket is
    larger than others. A fact that was published long ago but arrives now is not late: the clock goes by arrival. Rows
    without an effective instant never become usable. A restart from the checkpoint goes on with what is held.
    """
    rows = df.where(F.col(effective).isNotNull()).withWatermark(arrived, delay).withColumn("_bucket", F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    with keyed_state(df.sparkSession):
        out = rows.groupBy("_bucket", effective).transformWithStateInPandas(statefulProcessor=Held(df.columns, effective, schema), outputStructType=schema, outputMode="append", timeMode="EventTime")
        return run(out, checkpoint, lambda batch, number: batch.write.mode("overwrite").parquet(f"{sink}/batch={number}"))


def frozen_view(df: DataFrame, sink: str, checkpoint: str, key: list[str], at: str, tie: str, cutoff: str) -> StreamingQuery:
    """A view of a latest-only source as of the cutoff, a version for each batch.

    Of each batch a key's newest row counts. Where it lies at or before the cutoff it replaces what the view held; where the source has gone on to
    one after the cutoff, the row that the view held before is carried forward. Version ``number`` is made from version ``number`` - 1 and
    from nothing later, so a batch that runs again makes the same one, and one that was committed is left as it is.
    """
    spark = df.sparkSession

    def batch(rows: DataFrame, number: int) -> None:
        log = Log(spark, sink)
        if log.last() >= number:
            return
        seen = versions.newest(rows, key, [F.col(at).desc(), F.col(tie).desc()])
        at_cutoff = seen.where(F.col(at) <= F.to_timestamp(F.lit(cutoff)))
        before = log.read(number - 1).get("folder")
        if before:
            held = spark.read.parquet(before)
            merged = versions.carried_forward(at_cutoff, seen, held.drop("carried"), key)
            untouched = held.join(seen.select(*key), key, "left_anti")
            merged = merged.unionByName(untouched)
        else:
            merged = at_cutoff.withColumn("carried", F.lit(False))
        folder = f"{sink}/view={number}"
        merged.write.mode("overwrite").parquet(folder)
        try:
            log.commit(number, {"folder": folder})
        except Conflict:
            pass  # an attempt that was thought lost has written the same version

    return run(df, checkpoint, batch)


def frozen(spark: SparkSession, sink: str) -> DataFrame:
    """The newest version of a frozen view."""
    return spark.read.parquet(Log(spark, sink).read()["folder"])
