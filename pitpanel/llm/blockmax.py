"""Exact top-k search by block-at-a-time pruning.

Vectors of integers are documents, their components the terms' impacts. Each task cuts its range of documents into blocks and keeps,
of each block, every component's largest and smallest value and the rows themselves (the forward index). A query's bound in
a block is the sum over its components of query times the maximum, or the minimum where the query is negative. Each query
takes its blocks in the order of their bounds and scores their rows whole until the next bound falls below its k-th score.

Queries are a stated set, handed to the tasks in blocks of bounded size; a task's k best of each query meet in two steps.
Documents are ordered by the signs of their components, so that those of one block are alike and its bounds are near.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import best, numbered, partitions, written

#: Rows of a block; components that a task holds at a time; components of a block of queries.
ROWS, HELD, QUERIES = 128, 1 << 22, 1 << 21
#: Sums of products below this are exact in double precision.
EXACT = float(1 << 53)


def integers(df: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(vec_id, code, ints) of each row that takes part: floor(scale * x) of every component, saturating at 64 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("v")
            ok = pc.is_valid(lists).to_numpy(zero_copy_only=False).copy()
            flat, parent = lists.flatten(), pc.list_parent_indices(lists).to_numpy()
            x = pc.fill_null(flat, np.nan).to_numpy(zero_copy_only=False)
            ok[parent[~np.isfinite(x)]] = False
            keep = ok[parent]
            with np.errstate(over="ignore", invalid="ignore"):
                y = np.floor(scale * x[keep])
            y = np.where(y >= 2.0**63, 2**63 - 1, np.where(y <= -(2.0**63), -(2**63), np.where(np.abs(y) < 2.0**63, y, 0).astype(np.int64)))
            some = np.flatnonzero(ok)
            n = np.bincount(parent[keep], minlength=batch.num_rows)[some] if len(parent) else np.zeros(len(some), np.int64)
            ends = np.append(0, np.cumsum(n))
            code = [np.packbits(y[a:b] > 0).tobytes() for a, b in zip(ends, ends[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(pa.array(some)), pa.array(code, pa.binary()), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(y, pa.int64()))], names=["vec_id", "code", "ints"])

    return df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")).mapInArrow(run, "vec_id long, code binary, ints array<long>")


def matrix(lists: pa.ListArray, width: int | None = None) -> np.ndarray:
    """Rows of equal width; components that a vector lacks are 0."""
    n = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(n), max(width or 0, int(n.max(initial=0)))), np.int64)
    starts = np.cumsum(n) - n
    flat = lists.flatten().to_numpy()
    row = np.repeat(np.arange(len(n)), n)
    out[row, np.arange(len(flat)) - starts[row]] = flat
    return out


def size(a: np.ndarray) -> float:
    """The largest magnitude."""
    return float(max(a.max(initial=0), -float(a.min(initial=0))))


class Found:
    """The k best of each query: scores, ids (null as the largest), and the rows that they came from."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.score, self.key = [np.zeros(0, object)] * queries, [np.zeros(0, object)] * queries
        self.least = np.full(queries, -np.inf)

    def add(self, q: int, scores: np.ndarray, keys: np.ndarray) -> None:
        score, key = np.concatenate([self.score[q], scores]), np.concatenate([self.key[q], keys])
        order = sorted(range(len(score)), key=lambda i: (-score[i], key[i]))[: self.k]
        self.score[q], self.key[q] = score[order], key[order]
        if len(order) == self.k:
            self.least[q] = float(self.score[q][-1])


def search(rows: np.ndarray, keys: np.ndarray, own: np.ndarray, queries: np.ndarray, asked: np.ndarray, found: Found, block_rows: int = ROWS) -> int:
    """Brings a range of documents into ``found``; the number of (query, block) pairs that were scored.

    ``own`` numbers the rows and ``asked`` the queries' own rows, which don't count. Where products could leave what double precision
    holds exactly, sums are Python integers.
    """
    width = max(rows.shape[1], queries.shape[1])
    rows, queries = (np.pad(a, ((0, 0), (0, width - a.shape[1]))) for a in (rows, queries))
    kind = np.float64 if size(rows) * size(queries) * max(width, 1) < EXACT else object
    rows, queries = rows.astype(kind), queries.astype(kind)
    heads = np.arange(0, len(rows), block_rows)
    if width:
        bounds = np.maximum(queries, 0) @ np.maximum.reduceat(rows, heads).T + np.minimum(queries, 0) @ np.minimum.reduceat(rows, heads).T
    else:
        bounds = np.zeros((len(queries), len(heads)), kind)
    order = np.argsort(-bounds.astype(np.float64), axis=1, kind="stable")
    active, scored = np.arange(len(queries)), 0
    for turn in range(len(heads)):
        block = order[active, turn]
        # A bound's double may have been rounded, by less than one part in 2**50.
        bound = bounds[active, block].astype(np.float64)
        going = bound + np.abs(bound) * 2.0**-50 >= found.least[active]
        active, block = active[going], block[going]
        if not len(active):
            break
        scored += len(active)
        for b in np.unique(block):
            who = active[block == b]
            part = slice(int(heads[b]), int(heads[b]) + block_rows)
            scores = queries[who] @ rows[part].T if width else np.zeros((len(who), len(rows[part])), kind)
            mine = own[part][None, :] == asked[who][:, None]
            good = (scores.astype(np.float64) >= (found.least[who] - np.abs(np.nan_to_num(found.least[who], neginf=0)) * 2.0**-50)[:, None]) & ~mine
            for i, q in enumerate(who):
                at = np.flatnonzero(good[i])
                if len(at) > 4 * found.k and kind is np.float64:
                    cut = np.partition(scores[i, at], len(at) - found.k)[len(at) - found.k]
                    at = at[scores[i, at] >= cut]
                if len(at):
                    found.add(int(q), np.array([int(s) for s in scores[i, at]], object), keys[part][at])
    return scored


def top(df: DataFrame, every: int = 50, k: int = 5, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of largest integer inner product for each row whose id is divisible by ``every``.

    A row never meets itself, but another row with its id or its components does. Null vectors and those with null or non-finite
    components take no part. Vectors of different lengths meet as if the shorter one went on with zeros; an empty one scores 0. Ties go
    to the smaller id, a null id last. A score beyond 64 bits is returned as the nearest such number. An empty table
    has no result; columns beside those named aren't read.
    """
    spark = df.sparkSession
    rows = integers(df, id_col, vector_col, scale).withColumn("row", F.monotonically_increasing_id())
    rows = written(rows.repartitionByRange(partitions(spark), "code", "row").sortWithinPartitions("code", "row").select("vec_id", "row", "ints"), "vectors")
    asked = rows.where(F.col("vec_id") % every == 0).withColumn("size", F.size("ints") + 1)
    asked = written(numbered(asked, ["row"], "at", weight="size"), "queries")
    made = []
    for b in [r[0] for r in asked.select(F.expr(f"at div {QUERIES}").alias("b")).distinct().sort("b").toLocalIterator()]:
        block = asked.where(F.expr(f"at div {QUERIES}") == b).select("row", "ints").sort("row").toArrow()
        made.append(written(searched(rows, block["row"].to_numpy(), matrix(block["ints"].combine_chunks()), k), "found"))
    if not made:
        return asked.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0).cast("long").alias("score")).limit(0)
    every_part = made[0]
    for more in made[1:]:
        every_part = every_part.unionByName(more)
    ranked = best(every_part, "asked", [F.col("exact").desc(), F.col("vec_id").asc_nulls_last()], k)
    named = asked.select(F.col("row").alias("asked"), F.col("vec_id").alias("query_id"))
    most, least = F.lit(2**63 - 1).cast("decimal(38,0)"), F.lit(-(2**63)).cast("decimal(38,0)")
    return ranked.join(named, "asked").select("query_id", "rank", "vec_id", F.least(F.greatest("exact", least), most).cast("long").alias("score"))


def searched(rows: DataFrame, asked: np.ndarray, queries: np.ndarray, k: int) -> DataFrame:
    """(asked, vec_id, exact): the k best of each task for each query of a block."""
    from decimal import Decimal

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Found(len(asked), k)
        parts: list[pa.RecordBatch] = []

        def close() -> None:
            t = pa.Table.from_batches(parts)
            parts.clear()
            keys = np.array([float("inf") if v is None else v for v in t["vec_id"].to_pylist()], object)
            search(matrix(t["ints"].combine_chunks()), keys, t["row"].to_numpy(), queries, asked, found, ROWS)

        held = 0
        for batch in batches:
            n = np.cumsum(1 + pc.list_value_length(batch.column("ints")).to_numpy(zero_copy_only=False).astype(np.int64))
            lo = 0
            while lo < batch.num_rows:
                gone = int(n[lo - 1]) if lo else 0
                hi = min(1 + int(np.searchsorted(n, gone + HELD - held)), batch.num_rows)
                parts.append(batch.slice(lo, hi - lo))
                held, lo = held + int(n[hi - 1]) - gone, hi
                if held >= HELD:
                    close()
                    held = 0
        if parts:
            close()
        made = [(int(asked[q]), None if key == float("inf") else int(key), Decimal(int(score))) for q in range(len(asked)) for score, key in zip(found.score[q], found.key[q], strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array([m[0] for m in made], pa.int64()), pa.array([m[1] for m in made], pa.int64()), pa.array([m[2] for m in made], pa.decimal128(38, 0))], names=["asked", "vec_id", "exact"])

    return rows.mapInArrow(run, "asked long, vec_id long, exact decimal(38,0)")


ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS c FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, d.vec_id, CAST(list_sum(list_transform(list_zip(q.c, d.c), lambda z: z[1] * z[2])) AS BIGINT) AS score FROM v q JOIN v d ON q.vec_id <> d.vec_id WHERE q.vec_id % 50 = 0),
o AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM o WHERE rank <= 5
"""
