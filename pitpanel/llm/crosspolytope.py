"""Embedding near-duplicates by cross-polytope hashing after fast Hadamard rotations.

Each hash turns a unit vector by three rounds of random signs and a fast Hadamard transform; its
code is the nearest of the 2d signed axes. A table's bucket is made of k codes. A vector owns its
first bucket and probes those of the ``probes`` nearest axes of each code, so a pair meets where
one owns what the other probes. k grows with the rows of a label so that buckets stay small, and
the number of tables with it: how often a pair at the threshold meets is tried out for the width and k at
hand, so that it is missed with probability below 0.001 in any width and at any size.

Equal vectors of one label are one class. Pairs that meet are verified by their cosine in double
precision. A bucket of many vectors is cut into blocks, compared two by two in tasks of their own;
a task returns sums and a star of edges for each of its groups, never the pairs. A pair that
meets more than once counts in the first table, in the bucket of its smaller id if that is shared. The
few pairs that meet only where a third vector owns the bucket are listed, and counted once each.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .graph import connected_components, stars

BLOCK = 1024
#: How often a pair at the threshold may be missed.
MISSED = 0.001


def hadamard(x: np.ndarray) -> np.ndarray:
    """The normalised fast Walsh-Hadamard transform of each row; the width is a power of two."""
    n, h = x.shape[1], 1
    while h < n:
        y = x.reshape(len(x), -1, 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(len(x), n)
        h *= 2
    return x / np.sqrt(n)


def codes(unit: np.ndarray, seed: int, probes: int) -> np.ndarray:
    """For each row the ``probes`` nearest signed axes after the rotation of this seed, nearest first."""
    width = 1 << max(0, int(unit.shape[1] - 1).bit_length())
    x = np.pad(unit, ((0, 0), (0, width - unit.shape[1])))
    signs = np.random.default_rng(seed)
    for _ in range(3):
        x = hadamard(x * signs.choice([-1.0, 1.0], width))
    near = np.argsort(-np.abs(x), axis=1, kind="stable")[:, : min(probes, width)]
    return near * 2 + (np.take_along_axis(x, near, 1) < 0)


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows at unit length, in double precision and without overflow."""
    scaled = x.astype(np.float64)
    scaled /= np.abs(scaled).max(1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def meeting(dims: int, k: int, least: float, probes: int, pairs: int = 1500, trials: int = 6) -> float:
    """How often a pair at cosine ``least`` meets in a table with k codes, tried out on random pairs, less three standard errors."""
    draw = np.random.default_rng(dims)
    x, y = draw.normal(size=(2, pairs, max(2, dims)))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y -= (y * x).sum(1, keepdims=True) * x
    y = least * x + np.sqrt(1 - least**2) * y / np.linalg.norm(y, axis=1, keepdims=True)
    met = 0
    for t in range(trials):
        own, other = np.ones(pairs, bool), np.ones(pairs, bool)
        for c in range(k):
            a, b = codes(x, 1000 * (10_000 + t) + c, probes), codes(y, 1000 * (10_000 + t) + c, probes)
            own &= (b == a[:, :1]).any(1)
            other &= (a == b[:, :1]).any(1)
        met += int((own | other).sum())
    share = met / (pairs * trials)
    return max(0.01, share - 3 * np.sqrt(share * (1 - share) / (pairs * trials)))


def settings(largest_label: int, dims: tuple[int, ...], least: float, probes: int, bucket: int = 256) -> tuple[int, int]:
    """(codes of a bucket, tables) for so many vectors of one label, so that a pair at ``least`` is missed with probability MISSED at most, whatever the size."""
    k = 1
    while largest_label / (2 * max(2, min(dims))) ** k > bucket and k < 6:
        k += 1
    worst = min(meeting(d, k, least, probes) for d in dims)
    return k, max(1, int(np.ceil(np.log(MISSED) / np.log(1 - min(worst, 0.999)))))


def near_pairs(x: np.ndarray, y: np.ndarray, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs with cosine of at least ``least``, in strips of rows."""
    for lo in range(0, len(x), 128):
        i, j = np.nonzero(x[lo : lo + 128] @ y.T >= least)
        if len(i):
            yield i + lo, j


def near_duplicates(vectors: DataFrame, least: float = 0.93, probes: int = 3, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row.

    Vectors that are null, empty, zero or hold null or non-finite components, and rows with a null
    label, link with nothing; vectors of different length never link. n_links counts the other rows
    linked directly, component_id is the smallest id reachable, kept marks the row with that id.
    Repeated rows count as others do. A null id keeps its links' count but names no component. Only the three
    columns named are read, so others can't clash. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    values = F.col(vector_col).cast("array<double>")
    narrow = dict(vectors.dtypes)[vector_col] == "array<float>"  # then 32 bits lose nothing on the way
    kind = "<f4" if narrow else "<f8"
    sound = F.col(label_col).isNotNull() & F.col(vector_col).isNotNull() & (F.size(values) > 0)
    finite = F.forall(values, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    zero = F.forall(values, lambda v: v == 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.when(sound & finite & ~zero, F.col(vector_col) if narrow else values).alias("v"))
    rows = rows.withColumn("h", F.xxhash64("label", "v")).withColumn("g", F.xxhash64("v", "label", F.lit(1)))
    rows_light = written(rows.select("vec_id", F.when(F.col("v").isNotNull(), F.col("h")).alias("h"), "g"), "rows")
    classes = rows_light.where("h is not null").groupBy("h", "g").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    classes = written(classes, "classes")
    reps = rows.where("v is not null").join(classes, ["h", "g"]).where("vec_id = rep").dropDuplicates(["h", "g"]).select("rep", "copies", "label", F.col("v"))
    reps = written(reps, "representatives")
    most = reps.groupBy("label", F.size("v").alias("dims")).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("n"), F.min("dims").alias("low"), F.max("dims").alias("high")).first()
    if most.n is None:
        return rows_light.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    k, tables = settings(most.n, (most.low, most.high), least, probes)
    small = np.int32 if k == 1 else np.int64

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("v")
            sizes = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            starts = np.concatenate([[0], np.cumsum(sizes)])
            for dims in np.unique(sizes):
                own = np.flatnonzero(sizes == dims)
                x = flat[starts[own][:, None] + np.arange(dims)].astype(kind)
                unit = unit_rows(x)
                every = np.stack([np.stack([codes(unit, 1000 * t + c, probes) for c in range(k)], 1) for t in range(tables)], 1)
                wide = 2 * (1 << max(0, int(dims - 1).bit_length()))
                picks = list(product(range(every.shape[3]), repeat=k))
                base = wide ** np.arange(k)
                buckets = np.stack([(every[:, :, range(k), p] * base).sum(2) for p in picks], 2)  # rows, tables, probes
                taken = batch.take(pa.array(own))
                yield pa.RecordBatch.from_arrays([taken.column("rep"), taken.column("copies"), taken.column("label"), pa.array(np.full(len(own), dims, np.int32)), pa.array([r.tobytes() for r in x], pa.binary()), pa.array([r.tobytes() for r in buckets.astype(small)], pa.binary())], names=["rep", "copies", "label", "dims", "x", "buckets"])

    # Codes are computed once and kept beside the vectors.
    coded = written(reps.repartition(2 * max(8, spark.sparkContext.defaultParallelism), "rep").mapInArrow(encode, "rep long, copies long, label string, dims int, x binary, buckets binary"), "coded")

    def listed(keep: list[str]):
        """A row for each table and probe, with the columns in ``keep``."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                held = [np.frombuffer(b, small).reshape(tables, -1) for b in batch.column("buckets").to_pylist()]
                for dims in {len(h[0]) for h in held}:
                    own = [i for i, h in enumerate(held) if len(h[0]) == dims]
                    every = np.stack([held[i] for i in own])
                    taken = batch.take(pa.array(own))
                    for t in range(tables):
                        for p in range(dims):
                            yield pa.RecordBatch.from_arrays([*(taken.column(c) for c in keep), pa.array(np.full(len(own), t, np.int32)), pa.array(every[:, t, p].astype(np.int64)), pa.array(np.full(len(own), p == 0))], names=[*keep, "t", "bucket", "own"])

        return run

    spot = ["label", "dims", "t", "bucket"]
    # Sizes are counted without the vectors; a bucket that nobody owns or that holds one row has no pair.
    light = ["label", "dims"]
    counted = coded.select(*light, "buckets").mapInArrow(listed(light), "label string, dims int, t int, bucket long, own boolean")
    sizes = counted.groupBy(*spot).agg(F.count(F.lit(1)).alias("n"), F.max("own").alias("owned")).where("n > 1 and owned")
    every = ["rep", "copies", "label", "dims", "x", "buckets"]
    dealt = coded.mapInArrow(listed(every), "rep long, copies long, label string, dims int, x binary, buckets binary, t int, bucket long, own boolean")
    parts = dealt.join(sizes, spot).withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int")).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    facing = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least(o, F.col("block")).alias("a"), F.greatest(o, F.col("block")).alias("b")))
    parts = parts.withColumn("pair", F.explode(facing)).select(*spot, F.col("pair.a").alias("a"), F.col("pair.b").alias("b"), "block", "rep", "copies", "own", "x", "buckets")

    def compare(table: pa.Table) -> pa.Table:
        if table.num_rows < 2:
            return pa.table({"rep": pa.array([], pa.int64()), "n": pa.array([], pa.int64()), "low": pa.array([], pa.int64()), "other": pa.array([], pa.int64())})
        t, a, b = table.column("t")[0].as_py(), table.column("a")[0].as_py(), table.column("b")[0].as_py()
        rep, copies, own = (table.column(c).to_numpy() for c in ("rep", "copies", "own"))
        block = table.column("block").to_numpy()
        unit = unit_rows(np.frombuffer(b"".join(table.column("x").to_pylist()), kind).reshape(len(rep), -1))
        seen = np.frombuffer(b"".join(table.column("buckets").to_pylist()), small).reshape(len(rep), tables, -1)
        left, right = np.flatnonzero(block == a), np.flatnonzero(block == b)
        counts, edges, lone = np.zeros(len(rep), np.int64), [], []
        for i, j in near_pairs(unit[left], unit[right], least):
            i, j = left[i], right[j]
            keep = (rep[i] < rep[j]) if a == b else (rep[i] != rep[j])
            i, j = i[keep], j[keep]
            i, j = np.where(rep[i] < rep[j], i, j), np.where(rep[i] < rep[j], j, i)
            edges.append((i, j)) if len(i) else None
            probed = (seen[j, t] == seen[i, t, :1]).any(1)  # the larger id probes the smaller one's bucket
            first = np.where(probed, own[i], own[j])
            for u in range(t):
                first &= ~((seen[j, u] == seen[i, u, :1]).any(1) | (seen[i, u] == seen[j, u, :1]).any(1))
            np.add.at(counts, i[first], copies[j[first]])
            np.add.at(counts, j[first], copies[i[first]])
            third = ~own[i] & ~own[j]  # counted elsewhere if either owns what the other probes in any table
            x, y = i[third], j[third]
            if len(x):
                apart = ~((seen[y] == seen[x, :, :1]).any((1, 2)) | (seen[x] == seen[y, :, :1]).any((1, 2)))
                lone += [(x[apart], y[apart]), (y[apart], x[apart])]
        who, low = stars(len(rep), edges, rep)
        some = counts > 0
        x, y = (np.concatenate([p[k] for p in lone]) if lone else np.zeros(0, np.int64) for k in (0, 1))
        other = pa.concat_arrays([pa.nulls(int(some.sum()) + len(who), pa.int64()), pa.array(rep[y])])
        return pa.table({"rep": np.concatenate([rep[some], who, rep[x]]), "n": np.concatenate([counts[some], np.zeros(len(who), np.int64), copies[y]]), "low": pa.array(np.concatenate([rep[some], low, rep[x]]), pa.int64()), "other": other})

    found = written(parts.groupBy(*spot, "a", "b").applyInArrow(compare, "rep long, n long, low long, other long"), "links")
    lonely = found.where("other is not null").select("rep", "n", "other").distinct()
    linked = found.where("other is null").select("rep", "n").unionByName(lonely.select("rep", "n")).groupBy("rep").agg(F.sum("n").alias("n"))
    joined = connected_components(found.select(F.col("rep").alias("a"), F.col("low").alias("b")))
    named = classes.join(linked, "rep", "left").join(joined, F.col("rep") == F.col("node"), "left").select("h", "g", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("component", "rep").alias("component"))
    out = rows_light.join(named, ["h", "g"], "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
