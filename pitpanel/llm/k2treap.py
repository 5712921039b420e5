"""Ranked lexical search: K2-treaps over the grid of terms and documents.

A treap's cell covers a square of the grid (rows are terms, columns documents); a cell that holds a posting is kept with
the largest impact in it, the others are not, and its four quarters follow at the next level. A search goes down the rows of all an
item's terms at once: a state is a range of documents with, for each term that still occurs there, the cell of its
row; its bound is the sum of weight times the cells' maxima. States are taken best first; a range of one document has its
exact score. A state below the k-th best score found so far is given up with all that is left.

Documents go through in one pass over the texts that leaves the postings of the items' terms (term numbers and counts, a row
for each document) and each task's counts. Each task then builds treaps over ranges of documents of bounded size and keeps
the k best of each item; those meet in two steps. No posting is shuffled. Items are taken in blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heappop, heappush, heapreplace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import best, bytes_of, coded_words, give_back, numbered, slices, small_batches, written

INNER = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
#: One of these ends a treap's range of documents, and a block of items.
DOCUMENTS, POSTINGS, ITEM_BYTES = 1 << 13, 1 << 20, 4 << 20
#: States of an item that are taken at a time.
WIDTH = 8
ONES = np.array([bin(b).count("1") for b in range(16)], np.int64)


def words(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All texts' terms as codes of the different ones, and how many each text has."""
    data, ends = bytes_of(texts)
    data = LOWER[data]
    return coded_words(data, ends, INNER[data])


class Treap:
    """The cells of all levels one behind the other: which quarters each has, where the first of them stands, its largest impact."""

    def __init__(self, rows: np.ndarray, cols: np.ndarray, impacts: np.ndarray):
        self.bits = max(1, int(max(rows.max(), cols.max())).bit_length())
        code = np.zeros(len(rows), np.int64)
        for k in range(self.bits):
            code |= ((rows >> k & 1) << (2 * k + 1)) | ((cols >> k & 1) << (2 * k))
        order = np.argsort(code)
        code, top = code[order], impacts[order]
        levels = [(np.zeros(len(code), np.int64), top)]
        for _ in range(self.bits):
            above = code >> 2
            heads = np.flatnonzero(np.append(True, above[1:] != above[:-1]))
            top = np.maximum.reduceat(top, heads)
            levels.append((np.bitwise_or.reduceat(np.int64(1) << (code & 3), heads), top))
            code = above[heads]
        levels.reverse()
        self.quarters, self.top = (np.concatenate(x) for x in zip(*levels, strict=True))
        held = ONES[self.quarters]
        self.first = 1 + np.cumsum(held) - held

    def down(self, cells: np.ndarray, quarter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which cells have the quarter, and where it stands."""
        own = self.quarters[cells]
        return (own >> quarter & 1) == 1, self.first[cells] + ONES[own & ((1 << quarter) - 1)]


class Best:
    """The k best (score, id) of an item, equal scores by ascending id, null last."""

    def __init__(self, k: int):
        self.k, self.heap = k, []

    @property
    def least(self) -> int:
        """A score below this can't come in any more."""
        return self.heap[0][0] if len(self.heap) == self.k else 1

    def add(self, score: int, key: int | None) -> None:
        x = (score, key is not None, -(key or 0))
        if len(self.heap) < self.k:
            heappush(self.heap, x)
        elif x > self.heap[0]:
            heapreplace(self.heap, x)


def search(treap: Treap, ids: list, item_of: np.ndarray, rows: np.ndarray, weights: np.ndarray, found: list[Best], width: int = WIDTH) -> int:
    """Brings the documents of a treap into ``found``; the number of states that were gone down from.

    Term k of ``rows`` and ``weights`` belongs to item ``item_of[k]`` (ascending). Sums are 64-bit integers.
    """
    ends = np.searchsorted(item_of, np.arange(len(found)), "right")
    begins = np.searchsorted(item_of, np.arange(len(found)), "left")
    waiting = [[(-int(weights[a:b].sum() * treap.top[0]), 0, 0, np.stack([np.zeros(b - a, np.int64), np.arange(a, b)]))] if b > a else [] for a, b in zip(begins, ends, strict=True)]
    busy = [k for k, w in enumerate(waiting) if w]
    gone = 0
    while busy:
        taken, owner, still = [], [], []
        for k in busy:
            queue, least = waiting[k], found[k].least
            n = 0
            while queue and n < width and -queue[0][0] >= least:
                taken.append(heappop(queue))
                owner.append(k)
                n += 1
            if n:
                still.append(k)
        busy = still
        if not taken:
            break
        gone += len(taken)
        pairs = np.concatenate([t[3] for t in taken], axis=1)
        state = np.repeat(np.arange(len(taken)), [t[3].shape[1] for t in taken])
        depth = np.array([t[2] for t in taken])
        row = rows[pairs[1]] >> (treap.bits - 1 - depth)[state] & 1
        for half in (0, 1):
            held, child = treap.down(pairs[0], 2 * row + half)
            child, term, own = child[held], pairs[1][held], state[held]
            sums = np.append(0, np.cumsum(weights[term] * treap.top[child]))
            at = np.append(0, np.cumsum(np.bincount(own, minlength=len(taken))))
            bounds = sums[at[1:]] - sums[at[:-1]]
            for s in np.flatnonzero(bounds).tolist():
                k, bound = owner[s], int(bounds[s])
                if bound < found[k].least:
                    continue
                level, col = taken[s][2] + 1, 2 * taken[s][1] + half
                if level == treap.bits:
                    found[k].add(bound, ids[col])
                else:
                    # The column is compared as the first document of its range, so that equal bounds have one order.
                    heappush(waiting[k], (-bound, col, level, np.stack([child[at[s] : at[s + 1]], term[at[s] : at[s + 1]]])))
    return gone


def postings(docs: DataFrame, terms: list[bytes], id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n, terms, counts) of each document with one of ``terms``, and for each task a row with
    ``documents`` (those with any term at all), n (their terms with repeats), and each term's documents as counts."""
    size = len(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.array(terms, pa.large_binary())
        df, documents, total = np.zeros(size, np.int64), 0, 0
        for batch in batches:
            for lo, hi in slices(batch.column("text"), 1 << 20):
                part = batch.slice(lo, hi - lo)
                coded, held = words(part.column("text"))
                documents, total = documents + int((held > 0).sum()), total + int(held.sum())
                number = pc.fill_null(pc.index_in(coded.dictionary, value_set=names), -1).to_numpy(zero_copy_only=False).astype(np.int64)
                term = number[coded.indices.to_numpy()] if len(number) else number
                text = np.repeat(np.arange(len(held)), held)[term >= 0]
                pair, tf = np.unique(text * size + term[term >= 0], return_counts=True)
                df += np.bincount(pair % size, minlength=size)
                many = np.bincount(pair // size, minlength=len(held))
                some = np.flatnonzero(many)
                if len(some):
                    offsets = pa.array(np.append(0, np.cumsum(many[some])).astype(np.int32))
                    yield pa.RecordBatch.from_arrays(
                        [part.column("doc_id").take(pa.array(some)), pa.array(held[some].astype(np.int64)), pa.ListArray.from_arrays(offsets, pa.array((pair % size).astype(np.int32))), pa.ListArray.from_arrays(offsets, pa.array(tf.astype(np.int64))), pa.nulls(len(some), pa.int64())],
                        names=["doc_id", "n", "terms", "counts", "documents"],
                    )
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({"doc_id": pa.array([None], pa.int64()), "n": [total], "terms": pa.array([seen.tolist()], pa.list_(pa.int32())), "counts": pa.array([df[seen].tolist()], pa.list_(pa.int64())), "documents": [documents]})
        give_back()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, n long, terms array<int>, counts array<long>, documents long")


def impact(tf: np.ndarray, n: np.ndarray, documents: int, total: int) -> np.ndarray:
    """1000000000 tf div (1000 tf + 8 m), where m = 10 + (90 n documents) div total."""
    return 1_000_000_000 * tf // (1000 * tf + 8 * (10 + 90 * n * documents // total))


def weight(df: np.ndarray, documents: int) -> np.ndarray:
    return np.floor(1000 * np.log((2 * documents + 2) / (2 * df + 1))).astype(np.int64)


def searched(held: DataFrame, keys: list[int], item_of: np.ndarray, term: np.ndarray, size: int, k: int) -> DataFrame:
    """(at, doc_id, score): the k best of each task for each item of a block."""
    counts = held.where("documents IS NOT NULL")
    documents, total = counts.agg(F.sum("documents"), F.sum("n")).first()
    df = np.zeros(size, np.int64)
    for r in counts.select(F.explode(F.arrays_zip("terms", "counts")).alias("x")).groupBy("x.terms").agg(F.sum("x.counts").alias("n")).toLocalIterator():
        df[r[0]] = r[1]
    weights = weight(df, documents or 0)[term]
    # Rows follow the terms' documents, so that cells of rare terms stand apart from those of frequent ones.
    place = np.empty(size, np.int64)
    place[np.argsort(df, kind="stable")] = np.arange(size)
    rows = place[term]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [Best(k) for _ in keys]
        parts: list[pa.RecordBatch] = []

        def close() -> None:
            t = pa.Table.from_batches(parts).sort_by([("doc_id", "ascending")]).combine_chunks()
            parts.clear()
            lists, tf = t["terms"].combine_chunks(), t["counts"].combine_chunks()
            col = pc.list_parent_indices(lists).to_numpy().astype(np.int64)
            tf, n = tf.flatten().to_numpy(), t["n"].to_numpy()
            treap = Treap(place[lists.flatten().to_numpy()], col, impact(tf, n[col], documents, total))
            search(treap, t["doc_id"].to_pylist(), item_of, rows, weights, found, WIDTH)

        docs = postings_held = 0
        for batch in batches:
            many = np.cumsum(pc.list_value_length(batch.column("terms")).to_numpy(zero_copy_only=False).astype(np.int64))
            lo = 0
            while lo < batch.num_rows:
                gone = int(many[lo - 1]) if lo else 0
                hi = min(lo + DOCUMENTS - docs, 1 + int(np.searchsorted(many, gone + POSTINGS - postings_held)), batch.num_rows)
                parts.append(batch.slice(lo, hi - lo))
                docs, postings_held, lo = docs + hi - lo, postings_held + int(many[hi - 1]) - gone, hi
                if docs >= DOCUMENTS or postings_held >= POSTINGS:
                    close()
                    docs = postings_held = 0
        if parts:
            close()
        made = [(at, -key if known else None, score) for at, b in zip(keys, found, strict=True) for score, known, key in b.heap]
        yield pa.RecordBatch.from_arrays([pa.array([m[i] for m in made], pa.int64()) for i in range(3)], names=["at", "doc_id", "score"])
        give_back()

    return held.where("documents IS NULL").select("doc_id", "n", "terms", "counts").mapInArrow(run, "at long, doc_id long, score long")


def ranked(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``k`` highest scores above 0, equal ones by ascending doc_id (null last).

    A row is a document, whatever its id, and each row of ``items`` an item of its own, also where ids repeat or are
    null. Null and empty texts, and those without a term, match nothing and don't count. Texts go through whole. With empty tables
    the result is empty. Columns beside those named aren't read.
    """
    spark = docs.sparkSession
    asked = items.select(F.col(item_col).alias("item_id"), F.col(item_text).alias("text")).withColumn("size", F.coalesce(F.octet_length("text"), F.lit(0)) + 1)
    asked = written(numbered(asked, [F.col("item_id").asc_nulls_first(), F.col("text").asc_nulls_first()], "at", weight="size"), "items")
    made = []
    # One block holds ITEM_BYTES of text and the last item; more items are searched block by block.
    for b in [r[0] for r in asked.select(F.expr(f"at div {ITEM_BYTES}")).distinct().sort(F.expr(f"at div {ITEM_BYTES}")).toLocalIterator()]:
        block = asked.where(F.expr(f"at div {ITEM_BYTES}") == b).select("at", "text").sort("at").toArrow()
        coded, held = words(block["text"].combine_chunks())
        size = len(coded.dictionary)
        if not size:
            continue
        pair = np.unique(np.repeat(np.arange(len(held)), held) * size + coded.indices.to_numpy())
        with small_batches(spark, 2000):
            found = written(postings(docs, coded.dictionary.to_pylist(), id_col, text_col), "postings")
            made.append(written(searched(found, block["at"].to_pylist(), pair // size, pair % size, size, k), "found"))
    if not made:
        return asked.select("item_id", F.lit(1).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).limit(0)
    rows = made[0]
    for more in made[1:]:
        rows = rows.unionByName(more)
    rows = best(rows, "at", [F.col("score").desc(), F.col("doc_id").asc_nulls_last()], k)
    return rows.join(asked.select("at", "item_id"), "at").select("item_id", "rank", "doc_id", "score")


ORACLE = r"""
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
p AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY 1, 2),
s AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM p GROUP BY 1),
c AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM s),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM p, c GROUP BY term, docs),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
r AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // total)))) AS BIGINT) AS score FROM q JOIN p USING (term) JOIN s USING (doc_id) JOIN w USING (term), c GROUP BY 1, 2),
o AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM r WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM o WHERE rank <= 10
"""
