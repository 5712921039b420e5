"""SimHash near-duplicates at a given Jaccard similarity of shingle sets, verified exactly.

Every different set has a SimHash of 128 bits and a bitmap of at least two bits an element. The pivot table of ``simhash`` deals out the pairs whose first 64 bits
differ in at most two, and these, being nearest, are verified first. The fingerprints' distance orders the work but decides nothing. The bitmaps discard pairs: each bit in which two of them differ stands for an element
that one set has and the other hasn't, and sets of similarity t differ in at most (1 - t) / (1 + t) of their sizes' sum. All
pairs that are left are verified by the sets themselves.

Neither the distance nor the pivot coordinates of ``simhash`` can say of all pairs which to look at here: at 0.8
some 20 of 128 bits differ, in one pair of a million more than 48, while distances of unrelated
fingerprints to any reference differ by about 8. So the rest is dealt out exactly, by a prefix-filter join on
rare shingles. All sets are put in one order, rare shingles first. Two sets of similarity t
share at least t / (1 + t) of their sizes' sum, so the first shingle both hold lies among the first
n - ceil(t n) + 1 of each set of n. Sets therefore meet in cells, one for each shingle of these
prefixes, and no pair at the threshold is missed at any size of the input. Any order gives the same
result; frequencies are counted over all shingles of all texts, in counters that some shingles share, and only the
sizes of the cells depend on them. Sets are of hashes, of 64 bits where candidates are found and of 32 where they are verified: that is the only approximation.

Rows of a cell of more than ``few``, as groups of near copies make, are compared with a few leaders
of the cell only, which are mostly the same in all cells of a group. Only components are asked for,
so a pair that verified links have joined is decided. First each set's nearest partner and the one
with the smallest hash are verified, then the listed pairs that these links leave open. What the crowded
cells still hold is decided without listing pairs: where the bitmaps of rows of different groups
allow it, a task returns a star that joins them, and the stars' components, clusters of texts that are much
alike, are compared by their sets, each cluster once, in blocks that face one another in tasks of their own. Rows
outside a cell's or cluster's largest group meet all others, rows of that group don't meet each
other. Nothing is linked or left apart by an estimate.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bytes_of, give_back, joined, map_text, new_path, partitions, remove, slices, small_batches, word_hashes, written
from .graph import connected_components, stars
from .simhash import links
from .tokenstore import mix

BLOCK = 512
#: Rows of a crowded cell with which all its rows are compared first.
LEADERS = 2
#: Rows that a task compares at once, and pairs that it hands out at once.
ROWS, PAIRS = 200_000, 500_000
#: Counters of shingles: sixteen for each row, within these powers of two (0.25 to 16 MB), and those that travel as one row.
LEAST_COUNTERS, MOST_COUNTERS, COUNTERS = 16, 22, 1 << 16
#: Words of the smallest bitmaps, and those that are looked at first.
WORDS, FIRST = 32, 8
#: Pairs whose fingerprints differ in at most so many of 128 bits go to their sets at once, others by their bitmaps first; a choice of way, not of result.
LIKELY = 48


def shingle_hashes(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all texts' shingles, one text behind the other, repeats included, and each text's number of them.

    Words and shingles are those of ``simhash``. numpy parts all texts at once and Arrow makes the words
    distinct; a shingle's hash is made of its words' hashes.
    """
    data, ends = bytes_of(texts)
    data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    inner = ~((data == 32) | ((data >= 9) & (data <= 13)))
    word, held = word_hashes(data, ends, inner)
    at = np.cumsum(held) - held
    full = np.maximum(held - size + 1, 0)
    number = np.where(held < size, np.minimum(held, 1), full)
    place = np.repeat(at, full) + np.arange(full.sum()) - np.repeat(np.cumsum(full) - full, full)
    run = np.zeros(len(place), np.uint64)
    for k in range(size):
        run = joined(run, word[place + k])
    out = np.zeros(int(number.sum()), np.uint64)
    whole = np.repeat(held >= size, number)
    out[whole] = run
    few = np.flatnonzero((held > 0) & (held < size))
    some = np.zeros(len(few), np.uint64)
    for k in range(size - 1):
        own = held[few] > k
        some[own] = joined(some[own], word[at[few[own]] + k])
    out[~whole] = some
    return out, number


def sets_of(texts: pa.Array, size: int) -> list[np.ndarray]:
    """The different shingles' hashes of each text, sorted."""
    hashes, number = shingle_hashes(texts, size)
    return [np.unique(h) for h in np.split(hashes, np.cumsum(number)[:-1])] if len(number) else []


def wide_fingerprint(h: np.ndarray) -> tuple[int, int]:
    """128 bits, each set if it is set in over half of the hashes (64 bits of each and 64 derived from it); 0 for none."""
    if not len(h):
        return 0, 0
    total = np.zeros(128, np.int64)
    for k in range(0, len(h), 65536):
        part = h[k : k + 65536]
        both = np.stack([part, mix(part.view(np.int64), 5)], 1)
        total += np.unpackbits(both.view(np.uint8).reshape(-1, 16), axis=1, bitorder="little").sum(0, dtype=np.int64)
    first, second = np.packbits(2 * total > len(h), bitorder="little").view("<i8")
    return int(first), int(second)


def prefix(h: np.ndarray, counts: np.ndarray, similarity: float) -> np.ndarray:
    """The first of the hashes in order of (their counters, hash): one is shared with every set of this similarity."""
    often = counts[(h & np.uint64(len(counts) - 1)).astype(np.int64)]
    return h[np.lexsort((h, often))[: len(h) - math.ceil(similarity * len(h) - 1e-9) + 1]]


def gram_counts(docs: DataFrame, shingle: int, text_col: str) -> np.ndarray:
    """Counters of the shingles of all texts, each of those whose hashes end in its number; beyond 65,535 they are alike.

    Every text is read, whole, and repeats count. A task adds up all its texts first, so each core hands out one table of
    counters, however many texts there are.
    """
    spark = docs.sparkSession
    width = 1 << min(MOST_COUNTERS, max(LEAST_COUNTERS, (16 * docs.count()).bit_length()))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, np.uint32)
        for batch in batches:
            for lo, hi in slices(batch.column("text"), 1 << 20):
                h, _ = shingle_hashes(batch.column("text").slice(lo, hi - lo), shingle)
                np.add.at(total, (h & np.uint64(width - 1)).astype(np.int64), np.uint32(1))
        for k in range(0, width, COUNTERS):
            yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([total[k : k + COUNTERS].tobytes()], pa.binary())], names=["first", "counters"])
        give_back()

    def add(rows: pa.Table) -> pa.Table:
        total = np.zeros(COUNTERS, np.int64)
        for c in rows.column("counters").to_pylist():
            total += np.frombuffer(c, np.uint32)
        return pa.table({"first": rows.column("first")[:1], "counters": pa.array([np.minimum(total, 65_535).astype(np.uint16).tobytes()], pa.binary())})

    texts = docs.select(F.col(text_col).alias("text")).coalesce(spark.sparkContext.defaultParallelism)
    added = texts.mapInArrow(count, "first long, counters binary").groupBy("first").applyInArrow(add, "first long, counters binary")
    out = np.zeros(width, np.uint16)
    with small_batches(spark, 2000):
        for r in added.collect():
            out[r.first : r.first + COUNTERS] = np.frombuffer(r.counters, np.uint16)
    return out


def pivot_pairs(codes: DataFrame, folder: str | None = None) -> DataFrame:
    """Pairs (a, b), a < b, of ``codes`` (cid, f1) that join all whose f1 differ in at most two bits, dealt by the pivot table.

    Equal ones are joined to the smallest cid of theirs, which stands for them in the table.
    """
    fps = written(codes.groupBy("f1").agg(F.min("cid").alias("rep")), "pivots", folder).withColumnRenamed("f1", "fp")
    copies = codes.join(fps, F.col("f1") == F.col("fp")).where("cid <> rep").select(F.col("cid").alias("a"), F.col("rep").alias("b"))
    return links(fps, folder=folder).unionByName(copies).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose sets (rep, grams) have at least this Jaccard similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                x, y = np.frombuffer(x, "<u4"), np.frombuffer(y, "<u4")
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both >= similarity * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
        give_back()

    left = sets.select(F.col("rep").alias("a"), F.col("grams").alias("x"))
    right = sets.select(F.col("rep").alias("b"), F.col("grams").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def whole_cells(ordered: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    """Columns of about ROWS rows that come sorted by cell; no cell is cut."""
    held: list[pa.RecordBatch] = []
    rows = 0

    def columns() -> dict[str, np.ndarray]:
        table = pa.Table.from_batches(held)
        return {c: table.column(c).to_numpy() for c in table.column_names}

    least = ROWS
    for batch in ordered:
        held.append(batch)
        rows += batch.num_rows
        if rows < least:
            continue
        found = columns()
        end = int(np.searchsorted(found["cell"], found["cell"][-1]))  # the last cell may go on in the next batch
        if end:
            yield {c: v[:end] for c, v in found.items()}
        held = [pa.RecordBatch.from_arrays([pa.array(v[end:]) for v in found.values()], names=list(found))]
        rows -= end
        least = max(ROWS, 2 * rows)
    if rows:
        yield columns()


def fits(x: np.ndarray, y: np.ndarray, similarity: float) -> np.ndarray:
    """Whether sets may be as similar, by their sizes and how much of each is left from the shared shingle on."""
    shared = similarity / (1 + similarity) * ((x >> 32) + (y >> 32)) - 1e-6
    return np.minimum(x & 0xFFFFFFFF, y & 0xFFFFFFFF) >= shared


def pairs_within(rows: dict[str, np.ndarray], similarity: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Different pairs (smaller, larger) of each cell that may be similar."""
    cell, rep, at = rows["cell"], rows["rep"], rows["at"]
    i = np.arange(len(cell))
    j = i + 1
    found, n = [], 0
    while len(i):
        more = j < len(cell)
        i, j = i[more], j[more]
        more = cell[i] == cell[j]
        i, j = i[more], j[more]
        keep = fits(at[i], at[j], similarity) & (rep[i] != rep[j])
        found.append((rep[i[keep]], rep[j[keep]]))
        n += int(keep.sum())
        if n > PAIRS:
            yield different(found)
            found, n = [], 0
        j = j + 1
    if n:
        yield different(found)


def leaders(rows: dict[str, np.ndarray], similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Different pairs of each cell's rows and the LEADERS of them whose names have the smallest hashes."""
    order = np.lexsort((mix(rows["rep"], 1), rows["cell"]))
    cell, rep, at = (rows[c][order] for c in ("cell", "rep", "at"))
    first = np.searchsorted(cell, cell)
    found = []
    for k in range(LEADERS):
        own = first + k
        keep = fits(at[own], at, similarity) & (rep[own] != rep)
        found.append((rep[own[keep]], rep[keep]))
    return different(found)


def different(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The different ones of the pairs, smaller name first."""
    x, y = (np.concatenate(c) for c in zip(*found, strict=True))
    both = np.stack([np.minimum(x, y), np.maximum(x, y)], 1)
    both = both[np.lexsort((both[:, 1], both[:, 0]))]
    first = np.append(True, (both[1:] != both[:-1]).any(1))[: len(both)]
    return both[first, 0], both[first, 1]


def met(ordered: Iterator[pa.RecordBatch], similarity: float, few: int) -> Iterator[pa.RecordBatch]:
    """From rows (cell, rep, at) sorted by cell: (null, a, b, null) for pairs of small cells and with leaders, (cell, rep, null, at) for rows of crowded cells."""
    names = ["cell", "a", "b", "at"]

    def paired(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        none = pa.nulls(len(a), pa.int64())
        return pa.RecordBatch.from_arrays([none, pa.array(a), pa.array(b), none], names=names)

    for rows in whole_cells(ordered):
        _, of, size = np.unique(rows["cell"], return_inverse=True, return_counts=True)
        size = size[of]
        some = (size > 1) & (size <= few)
        for a, b in pairs_within({c: v[some] for c, v in rows.items()}, similarity):
            yield paired(a, b)
        many = size > few
        if many.any():
            rows = {c: v[many] for c, v in rows.items()}
            yield paired(*leaders(rows, similarity))
            cell, rep, at = (pa.array(rows[c]) for c in ("cell", "rep", "at"))
            yield pa.RecordBatch.from_arrays([cell, rep, pa.nulls(len(rep), pa.int64()), at], names=names)
    give_back()


def bitmap(h: np.ndarray) -> bytes:
    """One bit for each element of a set, by its lowest bits; at least two bits an element, and a power of two of them."""
    bits = max(64 * WORDS, 1 << max(0, 2 * len(h) - 1).bit_length())
    out = np.zeros(bits, np.uint8)
    out[(h & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(out).tobytes()


def folded(bits: bytes, size: int) -> np.ndarray:
    """The bitmap of fewer bits, ``size`` bytes of them, of the same set."""
    return np.bitwise_or.reduce(np.frombuffer(bits, np.uint64).reshape(-1, size // 8), axis=0)


def differing(maps: list[bytes], i: np.ndarray, j: np.ndarray, most: int = 1 << 22) -> np.ndarray:
    """In how many bits the bitmaps of each pair differ, the larger one folded to the size of the other."""
    size = np.array([len(m) for m in maps], np.int64)
    least = np.minimum(size[i], size[j])
    out = np.zeros(len(i), np.int64)
    for n in np.unique(least).tolist():
        own = np.flatnonzero(least == n)
        rows, at = np.unique(np.concatenate([i[own], j[own]]), return_inverse=True)
        table = np.stack([folded(maps[r], n) for r in rows.tolist()])
        step = max(1, most // table.shape[1])
        for lo in range(0, len(own), step):
            p, q = at[lo : min(lo + step, len(own))], at[len(own) + lo : len(own) + min(lo + step, len(own))]
            out[own[lo : lo + step]] = np.bitwise_count(table[p] ^ table[q]).sum(1, dtype=np.int64)
    return out


def allowed(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """The pairs (a, b, apart, size_a, size_b, x, y) whose bitmaps don't rule out the similarity, without their bitmaps."""
    share = (1 - similarity) / (1 + similarity)
    for batch in batches:
        k = np.arange(batch.num_rows)
        bits = differing([*batch.column("x").to_pylist(), *batch.column("y").to_pylist()], k, batch.num_rows + k)
        limit = share * (batch.column("size_a").to_numpy().astype(np.int64) + batch.column("size_b").to_numpy()) + 1e-6
        yield batch.select(["a", "b", "apart"]).filter(pa.array(bits <= limit))
    give_back()


def may_be_similar(x: list[bytes], y: list[bytes], nx: np.ndarray, ny: np.ndarray, wanted: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` pairs (i, j) whose bitmaps x[i] and y[j] of sets of nx[i] and ny[j] elements don't rule out the similarity.

    The first words of the smallest bitmaps rule out most, whole ones decide on the rest.
    """
    share = (1 - similarity) / (1 + similarity)
    limit = share * (nx[:, None] + ny) + 1e-6
    small_x, small_y = (np.stack([folded(m, 8 * WORDS) for m in part]) for part in (x, y))
    count = np.zeros(limit.shape, np.int32)
    for k in range(FIRST):
        count += np.bitwise_count(small_x[:, k][:, None] ^ small_y[:, k])
    i, j = np.nonzero(wanted & (count <= limit))
    keep = differing([*x, *y], i, len(x) + j) <= limit[i, j] if len(i) else np.zeros(0, bool)
    return i[keep], j[keep]


def faced(ordered: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """Stars (a, b) that join rows of different groups that may be similar, from rows (cell, rep, at, group, side, bitmap) sorted by cell.

    In a cell, side 0 faces side 1; rows of side 2 face one another.
    """
    for rows in whole_cells(ordered):
        cuts = np.append(np.flatnonzero(np.diff(rows["cell"], prepend=rows["cell"][0] - 1 if len(rows["cell"]) else 0)), len(rows["cell"]))
        names, lows = [], []
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            rep, at, group, side = (rows[c][lo:hi] for c in ("rep", "at", "group", "side"))
            left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
            if not len(left) or not len(right):
                continue
            maps = rows["bitmap"][lo:hi]
            wanted = (group[left][:, None] != group[right]) & fits(at[left][:, None], at[right], similarity)
            i, j = may_be_similar(list(maps[left]), list(maps[right]), at[left] >> 32, at[right] >> 32, wanted, similarity)
            if len(i):
                who, low = stars(len(rep), [(left[i], right[j])], rep)
                names.append(who)
                lows.append(low)
        if names:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(names)), pa.array(np.concatenate(lows))], names=["a", "b"])
    give_back()


def similar(x: list[np.ndarray], y: list[np.ndarray], similarity: float, width: int = 2048) -> np.ndarray:
    """Whether each set of ``x`` and each of ``y`` are similar, by products of membership matrices, ``width`` elements at a time."""
    sizes = [np.array([len(s) for s in part], np.int64) for part in (x, y)]
    owner = np.concatenate([np.repeat(np.arange(len(part)), n) for part, n in zip((x, y), sizes, strict=True)])
    first = np.arange(len(owner)) < sizes[0].sum()
    _, element, times = np.unique(np.concatenate([*x, *y]), return_inverse=True, return_counts=True)
    shared = np.flatnonzero(times[element] > 1)  # an element of one set alone is in no intersection
    shared = shared[np.argsort(element[shared], kind="stable")]
    _, column = np.unique(element[shared], return_inverse=True)
    both = np.zeros((len(x), len(y)), np.float32)
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        lo, hi = np.searchsorted(column, [start, start + width])
        tables = []
        for mine, n in ((first[shared[lo:hi]], len(x)), (~first[shared[lo:hi]], len(y))):
            m = np.zeros((n, width), np.float32)
            m[owner[shared[lo:hi][mine]], column[lo:hi][mine] - start] = 1
            tables.append(m)
        both += tables[0] @ tables[1].T
    return both >= similarity * (sizes[0][:, None] + sizes[1] - both) - 1e-6


def grouped(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, few: int = 4, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Tables (id, cid, text_hash) of all rows and (cid, group) of all different sets.

    cid names a row's shingle set, whatever its id; group is one of the cids that links of at least
    ``similarity`` join. Repeated and null ids therefore never mix up different texts.
    """
    spark = docs.sparkSession
    counts = gram_counts(docs, shingle, text_col)
    scratch = new_path(spark, "scratch")
    held = lambda df, what: written(df, what, scratch)

    def each(texts: pa.Array) -> dict:
        found = sets_of(texts, shingle)
        maps = [bitmap(h) for h in found]
        codes = [wide_fingerprint(h) for h in found]
        made = {"grams": [np.unique(h.astype("<u4")).tobytes() for h in found], "prefix": [prefix(h, counts, similarity).tobytes() for h in found], "bitmap": maps, "half": [folded(m, len(m) // 2).tobytes() for m in maps]}
        cid = np.array([xxhash.xxh3_64_intdigest(h.tobytes()) for h in found], np.uint64).view(np.int64)
        return {"cid": cid} | {c: pa.array(v, pa.binary()) for c, v in made.items()} | {"size": pa.array([len(h) for h in found], pa.int32()), "f1": pa.array([c[0] for c in codes], pa.int64()), "f2": pa.array([c[1] for c in codes], pa.int64())}

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_hash"))
    made = map_text(rows, "text", ["id", "text_hash"], "cid long, grams binary, prefix binary, bitmap binary, half binary, size int, f1 long, f2 long", each, lists=False)
    with small_batches(spark, 2000):
        fps = held(made, "shingles")
    codes = held(fps.groupBy("cid").agg(*(F.any_value(c).alias(c) for c in ("f1", "f2", "size", "half"))), "classes")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column("prefix"), 1 << 20):
                part = batch.slice(lo, hi - lo)
                first = part.column("prefix").to_pylist()
                n = np.array([len(p) // 8 for p in first], np.int64)
                place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                size = np.repeat(part.column("size").to_numpy().astype(np.int64), n)
                rep = np.repeat(part.column("cid").to_numpy(), n)
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(b"".join(first), "<i8")), pa.array(rep), pa.array(size << 32 | size - place)], names=["cell", "rep", "at"])

    classes = fps.groupBy("cid").agg(F.any_value("size").alias("size"), F.any_value("prefix").alias("prefix"))
    dealt = classes.mapInArrow(deal, "cell long, rep long, at long")
    shards = dealt.repartition(partitions(spark), "cell").sortWithinPartitions("cell")
    found = held(shards.mapInArrow(lambda batches: met(batches, similarity, few), "cell long, a long, b long, at long"), "met")

    def near(pairs: DataFrame, what: str) -> DataFrame:
        """The different pairs that their bitmaps leave, with the distance of their fingerprints."""
        left = codes.select(F.col("cid").alias("a"), F.col("f1").alias("x1"), F.col("f2").alias("x2"))
        right = codes.select(F.col("cid").alias("b"), F.col("f1").alias("y1"), F.col("f2").alias("y2"))
        apart = F.bit_count(F.col("x1").bitwiseXOR(F.col("y1"))) + F.bit_count(F.col("x2").bitwiseXOR(F.col("y2")))
        every = held(pairs.distinct().join(left, "a").join(right, "b").select("a", "b", apart.alias("apart")), f"{what}-every")
        left = codes.select(F.col("cid").alias("a"), F.col("size").alias("size_a"), F.col("half").alias("x"))
        right = codes.select(F.col("cid").alias("b"), F.col("size").alias("size_b"), F.col("half").alias("y"))
        unlikely = every.where(F.col("apart") > LIKELY).join(left, "a").join(right, "b").select("a", "b", "apart", "size_a", "size_b", "x", "y")
        rest = unlikely.mapInArrow(lambda batches: allowed(batches, similarity), "a long, b long, apart int")
        return held(every.where(F.col("apart") <= LIKELY).unionByName(rest), what)

    def linked(pairs: DataFrame, what: str) -> DataFrame:
        """The pairs that their sets leave."""
        nodes = held(pairs.select(F.col("a").alias("cid")).unionByName(pairs.select(F.col("b").alias("cid"))).distinct(), f"{what}-nodes")
        sets = fps.select("cid", "grams").join(nodes, "cid", "left_semi").dropDuplicates(["cid"]).withColumnRenamed("cid", "rep")
        return held(verified(pairs.select("a", "b"), held(sets, f"{what}-sets"), similarity), f"{what}-edges")

    def apart_yet(pairs: DataFrame, reached: DataFrame) -> DataFrame:
        """The pairs that no links join."""
        x, y = reached.select(F.col("node").alias("a"), F.col("component").alias("x")), reached.select(F.col("node").alias("b"), F.col("component").alias("y"))
        return pairs.join(x, "a", "left").join(y, "b", "left").where(F.coalesce("x", "a") != F.coalesce("y", "b")).select("a", "b")

    pairs = near(found.where("cell is null").select("a", "b").unionByName(pivot_pairs(codes.select("cid", "f1"), scratch)), "near")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "apart"))
    picks = both.groupBy("a").agg(F.min(F.struct("apart", "b")).alias("nearest"), F.min(F.struct(F.xxhash64("b").alias("h"), "b")).alias("first"))
    picks = picks.select("a", F.explode(F.array("nearest.b", "first.b")).alias("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges = linked(held(picks, "picks"), "first")
    reached = connected_components(edges)
    rest = held(apart_yet(pairs.select("a", "b"), reached), "open")
    if not rest.isEmpty():
        edges = edges.unionByName(linked(rest, "second"))
        reached = connected_components(edges)

    def facing(rows: DataFrame, key: str) -> DataFrame:
        """Rows (key, rep, group) of what holds several groups, in blocks: a row for each pair of blocks (pair, side) that it is in."""
        sizes = rows.groupBy(key, "group").agg(F.count(F.lit(1)).alias("n")).groupBy(key).agg(F.max(F.struct("n", "group")).alias("most"), F.sum("n").alias("n"))
        block = lambda n: F.ceil(n / BLOCK).cast("int")
        sizes = held(sizes.where("n > most.n").select(key, F.col("most.group").alias("largest"), block(F.col("n") - F.col("most.n")).alias("outer"), block(F.col("most.n")).alias("inner")), f"{key}-sizes")
        inside = F.col("group") == F.col("largest")
        own = F.when(inside, F.col("outer") + F.pmod(F.xxhash64("rep"), F.col("inner"))).otherwise(F.pmod(F.xxhash64("rep"), F.col("outer"))).cast("int")
        last = F.when(inside, F.col("outer") - 1).otherwise(F.col("outer") + F.col("inner") - 1)
        pair = F.transform(F.sequence(F.lit(0), last), lambda o: F.struct(F.least(o, own).alias("x"), F.greatest(o, own).alias("y"), F.when(o == own, 2).otherwise((o < own).cast("int")).alias("side")))
        dealt = rows.join(sizes, key).withColumn("p", F.explode(pair))
        return dealt.select(*rows.columns, F.xxhash64(key, "p.x", "p.y").alias("pair"), F.col("p.side").cast("long").alias("side"))

    def in_groups(rows: DataFrame) -> DataFrame:
        return rows.join(reached, F.col("rep") == F.col("node"), "left").select(*rows.columns, F.coalesce("component", "rep").alias("group"))

    crowded = held(in_groups(found.where("cell is not null").select("cell", F.col("a").alias("rep"), "at")), "crowded")
    blocks = facing(crowded, "cell").drop("cell").withColumnRenamed("pair", "cell")
    maps = fps.select(F.col("cid").alias("rep"), "bitmap").join(blocks.select("rep").distinct(), "rep", "left_semi").dropDuplicates(["rep"])
    blocks = blocks.join(maps, "rep").select("cell", "rep", "at", "group", "side", "bitmap")
    stars_of = blocks.repartition(partitions(spark), "cell").sortWithinPartitions("cell").mapInArrow(lambda batches: faced(batches, similarity), "a long, b long")
    clusters = held(stars_of.distinct(), "stars")
    if not clusters.isEmpty():
        members = held(in_groups(connected_components(clusters).select(F.col("node").alias("rep"), F.col("component").alias("cluster"))), "members")
        sets = fps.select(F.col("cid").alias("rep"), "grams").join(members.select("rep"), "rep", "left_semi").dropDuplicates(["rep"])
        whole = facing(members, "cluster").join(held(sets, "cluster-sets"), "rep").select("pair", "rep", "group", "side", "grams")

        def compare(rows: pa.Table) -> pa.Table:
            rep, group, side = (rows.column(c).to_numpy() for c in ("rep", "group", "side"))
            left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
            grams = [np.frombuffer(g, "<u4") for g in rows.column("grams").to_pylist()]
            i, j = np.nonzero(similar([grams[k] for k in left], [grams[k] for k in right], similarity) & (group[left][:, None] != group[right]))
            who, low = stars(len(rep), [(left[i], right[j])], rep)
            return pa.table({"a": who, "b": low})

        more = held(whole.groupBy("pair").applyInArrow(compare, "a long, b long"), "third-edges")
        if not more.isEmpty():
            edges = edges.unionByName(more)
            reached = connected_components(edges)
    named = codes.select("cid").join(reached, F.col("cid") == F.col("node"), "left").select("cid", F.coalesce("component", "cid").alias("group"))
    out = written(fps.select("id", "cid", "text_hash"), "rows"), written(named, "groups")
    remove(spark, scratch)
    return out


def near_duplicates(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, few: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, component_id) for each row; component_id is the smallest id reachable over links of at least ``similarity``.

    Equal sets are one class from the start; null, empty and blank texts, which have no words, are one
    class too. A text of fewer words than a shingle is one shingle. Repeated rows come back as often as
    they came in, and two texts under one id are two texts. A null id is carried through and names no
    component. Texts of any length are taken whole. Only the two columns named are read, so others can't
    clash. An empty table gives an empty result.
    """
    rows, named = grouped(docs, shingle, similarity, few, id_col, text_col)
    low = rows.groupBy("cid").agg(F.min("id").alias("low")).join(named, "cid").groupBy("group").agg(F.min("low").alias("component_id"))
    return rows.join(named.join(low, "group").select("cid", "component_id"), "cid").select(F.col("id").alias("doc_id"), "component_id")
