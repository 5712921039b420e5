"""Benchmark decontamination: rare n-gram seeds join passages to test items, Smith-Waterman alignment scores them.

One pass over the texts, whatever the benchmark's size: words become hashes, and a text is kept, as its
words' hashes, if any of its n-grams passes a bitmap of the items' n-grams. An item's seeds are those of its n-grams that few
other items hold, so what a text's n-grams bring together grows with the texts alone. Which texts meet which items
is decided by groupings and joins of seeds: by how rare the shared ones are, or by how many of the item's are shared.
Only then are the texts fetched, once each with all items that they meet, and aligned around the seeds.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bytes_of, give_back, joined, slices, small_batches, word_hashes, written
from .tokens import byte_kinds

WORD = re.compile(r"\w+")
MATCH, MISMATCH, GAP = 2, -1, -1
#: Bits of the items' bitmap: 256 for each n-gram, within these powers of two (2 to 32 MB). Beyond, more texts pass it in vain.
LEAST_BITS, MOST_BITS = 24, 28


def words(text: str | None) -> list[str]:
    """A text's words; the plain form of ``hashed_words``."""
    return WORD.findall(text.lower()) if text else []


@cache
def word_characters() -> np.ndarray:
    """1 for each character that words are made of."""
    held = np.zeros(0x110000, np.uint8)
    held[[n for n in range(0x110000) if WORD.match(chr(n))]] = 1
    return held


def hashed_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """32-bit hashes of all texts' lower-cased words, one text behind the other, and each text's number of words."""
    data, ends = bytes_of(pc.utf8_lower(texts))
    hashes, held = word_hashes(data, ends, byte_kinds(data, word_characters()) == 1)
    return hashes.astype("<u4"), held


def grams(ids: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash for each run of n words."""
    run = np.zeros(max(0, len(ids) - n + 1), np.uint64)
    for k in range(n):
        run = joined(run, ids[k : k + len(run)].astype(np.uint64))
    return run


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """The best local alignment's score and its first and last place in ``text`` (inclusive).

    A row of the table at a time; gaps along the text by a running maximum.
    """
    n = len(text)
    step = np.arange(n + 1, dtype=np.int64) * -GAP
    row, start = np.zeros(n + 1, np.int64), np.arange(n + 1)
    best, first, last = 0, 0, -1
    for w in item:
        diagonal = row[:-1] + np.where(text == w, MATCH, MISMATCH)
        up = row[1:] + GAP
        now = np.concatenate([[0], np.maximum(np.maximum(diagonal, up), 0)])
        begin = np.concatenate([[0], np.where(now[1:] == 0, np.arange(1, n + 1), np.where(diagonal >= up, start[:-1], start[1:]))])
        run = now + step
        reach = np.maximum.accumulate(run)
        source = np.maximum.accumulate(np.where(run == reach, np.arange(n + 1), 0))
        row = reach - step
        start = begin[source]
        k = int(row.argmax())
        if row[k] > best:
            best, first, last = int(row[k]), int(start[k]), k - 1
    return best, first, last


def best_passage(item: np.ndarray, text: np.ndarray, spots: np.ndarray, least: float) -> tuple[int, int, int]:
    """The best alignment within twice the item's length around the spots; stretches that overlap are aligned as one."""
    reach = 2 * len(item)
    cuts = np.flatnonzero(np.diff(spots) > 2 * reach)
    best = (0, 0, -1)
    for lo, hi in zip(spots[np.append(0, cuts + 1)].tolist(), spots[np.append(cuts, len(spots) - 1)].tolist(), strict=True):
        lo, hi = max(0, lo - reach), min(len(text), hi + reach)
        if MATCH * np.isin(item, text[lo:hi]).sum() < max(least, best[0]):
            continue  # too few of its words are here
        got = align(item, text[lo:hi])
        if got[0] > best[0]:
            best = (got[0], lo + got[1], lo + got[2])
    return best


def numbered_items(benchmark: DataFrame, n: int, item_col: str, item_text: str) -> DataFrame:
    """(item_id, words, grams array) of the different items of n words or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, held = hashed_words(batch.column("text"))
            parts = np.split(ids, np.cumsum(held)[:-1]) if len(held) else []
            own = [list(dict.fromkeys(grams(p, n).view("<i8").tolist())) for p in parts]
            rows = pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array([p.tobytes() for p in parts], pa.binary()), pa.array(own, pa.list_(pa.int64()))], names=["item_id", "words", "grams"])
            yield rows.filter(pa.array(held >= n))

    rows = benchmark.where(F.col(item_text).isNotNull()).select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text).alias("text")).distinct()
    return rows.mapInArrow(run, "item_id long, words binary, grams array<long>")


def bitmap(found: DataFrame, n: int) -> tuple[np.ndarray, int]:
    """(bits, shift): a hash h may be among ``gram`` of ``found``, n rows, if bit h >> shift is set."""
    width = min(MOST_BITS, max(LEAST_BITS, (256 * max(1, n) - 1).bit_length()))
    at = F.shiftrightunsigned("gram", 64 - width)
    words64 = found.groupBy(F.shiftright(at, 6).alias("at")).agg(F.bit_or(F.expr(f"shiftleft(1L, CAST(shiftrightunsigned(gram, {64 - width}) & 63 AS INT))")).alias("bits")).toArrow()
    bits = np.zeros(1 << (width - 6), np.int64)
    bits[words64.column("at").to_numpy()] = words64.column("bits").to_numpy()
    return bits.view(np.uint64), 64 - width


def near_texts(docs: DataFrame, bits: np.ndarray, shift: int, n: int, id_col: str, text_col: str) -> DataFrame:
    """(row, doc_id, words, hits) of the texts that hold an n-gram of the bitmap; hits are the different ones, row a number of the row's own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for lo, hi in slices(batch.column("text"), 1 << 20):
                part = batch.slice(lo, hi - lo)
                ids, held = hashed_words(part.column("text"))
                h = grams(ids, n)
                at = (h >> np.uint64(shift)).astype(np.int64)
                own = np.flatnonzero(bits[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1))
                ends = np.cumsum(held)
                of = np.searchsorted(ends, own, side="right")
                inside = own + n <= ends[of] if len(own) else np.zeros(0, bool)
                own, of = own[inside], of[inside]
                texts, first = np.unique(of, return_index=True)
                hits = [np.unique(x).view("<i8") for x in np.split(h[own], first[1:])] if len(texts) else []
                begin = ends - held
                kept = part.take(pa.array(texts))
                row += len(texts)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(row - len(texts), row)), kept.column("doc_id"), pa.array([ids[begin[t] : ends[t]].tobytes() for t in texts.tolist()], pa.binary()), pa.array(hits, pa.list_(pa.int64()))], names=["row", "doc_id", "words", "hits"])
        give_back()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "row long, doc_id long, words binary, hits array<long>")


def seeds_of(items: DataFrame, each: int) -> DataFrame:
    """(item, gram, total): of each item the n-grams that at most ``each`` different items hold, and how many they are.

    An item without any (all its n-grams are common among items) has all of them, with a total below 0.
    """
    own = items.select("item", F.explode("grams").alias("gram"))
    spread = own.groupBy("gram").agg(F.count(F.lit(1)).alias("items"))
    rows = own.join(spread, "gram").select("item", "gram", (F.col("items") <= each).alias("own"))
    size = rows.groupBy("item").agg(F.count_if("own").alias("some"), F.count(F.lit(1)).alias("every"))
    return rows.join(size, "item").where(F.col("own") | (F.col("some") == 0)).select("item", "gram", F.when(F.col("some") > 0, F.col("some")).otherwise(-F.col("every")).alias("total"))


def met(near: DataFrame, seeds: DataFrame, documents: int, bits: float, share: float, most: float, prior: int) -> DataFrame:
    """(row, item) of the texts and items that are to be aligned; see ``contaminated``."""
    hits = near.select("row", F.explode("hits").alias("gram"))
    held = hits.join(seeds.select("gram").distinct(), "gram").groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    weighed = seeds.join(held, "gram").select("item", "gram", "total", F.log2((F.lit(float(documents)) + prior) / F.col("n")).alias("bits"))
    found = hits.join(weighed, "gram").groupBy("row", "item").agg(F.sum("bits").alias("bits"), F.count(F.lit(1)).alias("n"), F.any_value("total").alias("total"))
    some = (F.col("bits") >= bits) | (F.col("n") >= F.greatest(F.ceil(share * F.col("total")), F.least(F.lit(2), F.col("total"))))
    return found.where(F.when(F.col("total") > 0, some).otherwise(F.col("n") >= -most * F.col("total"))).select("row", "item")


def contaminated(docs: DataFrame, benchmark: DataFrame, n: int = 3, each: int = 4, bits: float = 20.0, share: float = 0.25, most: float = 0.8, prior: int = 1 << 20, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, score, first_word, last_word) for each document and test item it holds a copy of.

    score is the best local alignment (match 2, other word -1, gap -1) over that of the whole item, at
    least ``threshold``. The span counts the document's words (runs of letters, digits and _, any case).

    An item's seeds are its n-grams that at most ``each`` different item texts hold: words that many items share, as a
    question's frame is, say of no one item that it was copied. A shared seed is worth log2((documents + ``prior``) / documents with
    it) bits; ``prior`` stands for texts not seen, so that few documents don't make an n-gram frequent. Document and item
    are aligned if the seeds they share are worth ``bits`` (one that a millionth of all documents hold, or several less rare ones), or are
    ``share`` of the item's seeds and two at least (one, if it has no more): that finds an item which very many documents hold. Items
    whose n-grams are all common among items are met by ``most`` of them. Copies that break nearly every n-gram are beyond the seeds'
    reach; a test holds the rest against all pairs.

    Items of fewer than ``n`` words and null texts match nothing; repeated items count once, repeated
    documents match as often as they come; rows with a null doc_id are reported with it. Texts of any length are taken
    whole, and extra columns aren't read. An empty benchmark or table gives an empty result. Words
    are compared by 32-bit hashes.
    """
    spark = docs.sparkSession
    schema = "doc_id long, item_id long, score double, first_word long, last_word long"
    named = written(numbered_items(benchmark, n, item_col, item_text), "items")
    # Items of the same words are one item until their ids are reported.
    items = named.groupBy(F.xxhash64("words").alias("item")).agg(F.any_value("words").alias("words"), F.any_value("grams").alias("grams"))
    seeds = written(seeds_of(items, each), "seeds")
    different = seeds.select("gram").distinct()
    count = different.count()
    if not count:
        return spark.createDataFrame([], schema)
    passed = near_texts(docs, *bitmap(different, count), n, id_col, text_col)
    with small_batches(spark, 2000):
        near = written(passed, "near")
    pairs = written(met(near, seeds, docs.count(), bits, share, most, prior), "met")
    held = seeds.groupBy("item").agg(F.collect_list("gram").alias("seeds"))
    ids = named.groupBy(F.xxhash64("words").alias("item")).agg(F.any_value("words").alias("words"), F.collect_set("item_id").alias("ids"), F.max(F.col("item_id").isNull()).alias("unnamed"))
    whole = ids.join(held, "item").select("item", F.struct("words", "seeds", F.when(F.col("unnamed"), F.concat("ids", F.array(F.lit(None).cast("long")))).otherwise(F.col("ids")).alias("ids")).alias("whole"))
    asked = pairs.join(whole, "item").groupBy("row").agg(F.collect_list("whole").alias("asked"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for k in range(batch.num_rows):
                doc, text, asked = (batch.column(c)[k].as_py() for c in ("doc_id", "words", "asked"))
                text = np.frombuffer(text, "<u4")
                own = grams(text, n).view(np.int64)
                for one in asked:
                    item = np.frombuffer(one["words"], "<u4")
                    spots = np.flatnonzero(np.isin(own, np.array(one["seeds"], np.int64)))
                    score, first, last = best_passage(item, text, spots, threshold * MATCH * len(item)) if len(spots) else (0, 0, -1)
                    if score >= threshold * MATCH * len(item):
                        for key in one["ids"]:
                            for column, v in zip(out, (doc, key, score / (MATCH * len(item)), first, last), strict=True):
                                column.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64()), pa.array(out[3], pa.int64()), pa.array(out[4], pa.int64())], names=["doc_id", "item_id", "score", "first_word", "last_word"])

    # What is asked grows with the texts and shrinks well on its way, so Spark would broadcast far more than its bound: it is merged, with the texts that meet an item.
    wanted = near.select("row", "doc_id", "words").join(pairs.select("row").distinct(), "row", "left_semi")
    together = wanted.join(asked.hint("merge"), "row")
    return together.select("doc_id", "words", "asked").mapInArrow(run, schema)
