"""The folder that driver and executors share, lineage cut there, rows dealt to tasks, and settings for a while."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Rows that one task sorts or groups at once.
ROWS = 500_000


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a temporary folder only where it is unset and all runs on one machine (tests)."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="pitpanel-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, what: str) -> str:
    """A path in the shared folder that nobody has used."""
    return f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """``df`` checkpointed to the shared folder, for small tables inside loops."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def dealt(df: DataFrame, *key: str, rows: int | None = None) -> DataFrame:
    """``df`` by ``key`` in parts of about ROWS rows, so that what a task sorts or groups stays the same at any size.

    ``rows`` is how many there are, counted if not given: cheap for a table that is read, a pass for anything else. Parts by
    bytes, as Spark merges them, hold ever more rows until they reach its size, and numbers shrink well.
    """
    n = df.count() if rows is None else rows
    return df.repartition(max(-(-n // ROWS), df.sparkSession.sparkContext.defaultParallelism), *key)


@contextmanager
def settings(spark: SparkSession, **wanted: str) -> Iterator[None]:
    """These settings of the session (``__`` stands for a dot) for what is started inside."""
    names = {k.replace("__", "."): v for k, v in wanted.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
