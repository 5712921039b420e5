"""What the corpus operators share: tables, the shared folder, cut lineage, row numbering, Arrow maps."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitpanel.functions.shared import cut, new_path, shared_dir  # noqa: F401  used by the operators


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables, by Spark's own reader (any file system)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, what: str = "table", folder: str | None = None) -> DataFrame:
    """``df`` as a Parquet table in the shared folder (or in ``folder`` there): computed once, lineage cut, columns prunable."""
    spark = df.sparkSession
    path = f"{folder}/{what}" if folder else new_path(spark, what)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, folder: str) -> None:
    """Deletes a folder of intermediate tables that nothing reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def numbered(df: DataFrame, order: list[Column | str], name: str, weight: str | None = None) -> DataFrame:
    """``df`` with ``name``: the sum of ``weight`` (1 where none is given) over all rows before it in ``order``.

    The rows are range partitioned and sorted, and written; the driver sees one total for each
    partition, and each task adds up its own rows. ``order`` must be total for the result to be
    fixed. No window over the whole table is needed.
    """
    spark = df.sparkSession
    ranged = df.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    ranged = cut(ranged.withColumn("_part", F.spark_partition_id()))
    unit = F.lit(1) if weight is None else F.col(weight)
    totals = {r._part: int(r.n) for r in ranged.groupBy("_part").agg(F.sum(unit.cast("long")).alias("n")).collect()}
    base, sums = 0, {}
    for part in sorted(totals):
        sums[part] = base
        base += totals[part]

    columns = list(df.columns)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        for batch in batches:
            part = batch.column("_part").to_numpy(zero_copy_only=False)
            w = np.ones(batch.num_rows, np.int64) if weight is None else batch.column(weight).to_numpy(zero_copy_only=False).astype(np.int64)
            before = np.zeros(batch.num_rows, np.int64)
            for p in np.unique(part):
                own = part == p
                at = sums[int(p)] + seen.get(int(p), 0)
                run = np.cumsum(w[own])
                before[own] = at + run - w[own]
                seen[int(p)] = seen.get(int(p), 0) + int(run[-1])
            kept = [batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(before)], names=[*columns, name])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return ranged.mapInArrow(add, f"{fields}, `{name}` long")


def best(rows: DataFrame, by: str, order: list[Column], k: int, name: str = "rank", salts: int = 64) -> DataFrame:
    """The first ``k`` rows in ``order`` for each ``by``, ranked from 1; a group's rows meet in ``salts`` parts first, each of which keeps k."""
    dealt = rows.withColumn("_salt", F.spark_partition_id() % salts)
    part = dealt.withColumn("_place", F.row_number().over(Window.partitionBy(by, "_salt").orderBy(*order))).where(F.col("_place") <= k).drop("_place", "_salt")
    return part.withColumn(name, F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col(name) <= k)


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts' UTF-8 bytes, one text behind the other, and where each ends; a null text is empty."""
    import pyarrow.compute as pc

    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(0, np.int64)
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8)
    return whole, ends[1:] - ends[0]


def coded_words(data: np.ndarray, ends: np.ndarray, inner: np.ndarray) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All texts' words (runs of ``inner`` bytes within a text) as codes of their different ones, and each text's number of words."""
    begins = inner & np.append(True, ~inner[:-1])[: len(inner)]
    first = np.append(0, ends[:-1])[: len(ends)]
    first = first[first < ends]
    begins[first] = inner[first]
    starts = np.flatnonzero(begins)
    letters = data[inner]
    bounds = np.append(np.cumsum(inner)[starts] - 1, len(letters)).astype(np.int64)
    coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(letters)]).dictionary_encode()
    return coded, np.diff(np.searchsorted(starts, ends), prepend=0)


def word_hashes(data: np.ndarray, ends: np.ndarray, inner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of each word (run of ``inner`` bytes within a text), and each text's number of words; only different words are hashed."""
    import xxhash

    coded, held = coded_words(data, ends, inner)
    names = np.array([xxhash.xxh64_intdigest(w, 42) for w in coded.dictionary.to_numpy(zero_copy_only=False).tolist()], np.uint64)
    return names[coded.indices.to_numpy()] if len(names) else names, held


def joined(run: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a run of words that goes on with another word."""
    x = (run ^ word) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def give_back() -> None:
    """Returns what a worker's C library holds free to the system, for workers that wait beside others; nothing where it can't."""
    gc.collect()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)
    pa.default_memory_pool().release_unused()


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Arrow batches of at most ``rows`` rows for what is run inside; the session's own setting comes back after.

    Spark's bound of 64 MB a batch is too much beside the memory of an encoder. A smaller setting of the user's stays.
    """
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    if 0 < int(before) <= rows:
        yield
        return
    spark.conf.set(setting, str(rows))
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def map_text(df: DataFrame, text: str, keep: list[str], fields: str, each: Callable[[list], dict], lists: bool = True, most: int = 1 << 20) -> DataFrame:
    """``keep`` and the columns of ``each(texts)``, whole texts in slices of about ``most`` bytes.

    ``each`` gets a list of str or None (without ``lists`` an Arrow array) and returns equally long columns by
    name; ``fields`` is their DDL. Spark bounds a batch by its bytes as well as by its rows.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    ddl = ", ".join([*(f"`{c}` {kinds[c].simpleString()}" for c in keep), fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(text), most):
                part = batch.slice(lo, hi - lo)
                made = each(part.column(text).to_pylist() if lists else part.column(text))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *(v if isinstance(v, pa.Array) else pa.array(v) for v in made.values())], names=[*keep, *made])
        give_back()

    return df.select(*dict.fromkeys([*keep, text])).mapInArrow(run, ddl)


def slices(texts: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes of text."""
    import pyarrow.compute as pc

    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    lo, total = 0, 0
    for i, n in enumerate(size):
        if i > lo and total + n > most:
            yield lo, i
            lo, total = i, 0
        total += int(n)
    if len(size) > lo:
        yield lo, len(size)

