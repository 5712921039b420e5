"""Sharding by a k-d tree over document metadata, split at distributed weighted medians.

Rows of equal text form one class, with one point: text bytes, smallest id, source, language. Every
level cuts each node along the dimension in which it is widest (relative to the whole table), where
half of its bytes lie on either side. The cut is found by narrowing an interval of integer keys (31
bits of the dimension, then 32 bits of the text's hash): each pass is one aggregation that returns
at most nodes x 2048 sums. Only a class that the cut runs through and that is heavier than ``slack``
of a leaf is divided, by id; a lighter one goes to the nearer side whole.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, numbered, written

STEP = 11
DIMS = ("bytes", "first_id", "source", "lang")


def classes_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang") -> tuple[DataFrame, DataFrame]:
    """The rows (doc_id, size, text_crc32, text_hash) and one row for each different text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    number = lambda c: F.xxhash64(F.col(c).cast("string")).alias(c)
    rows = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("text_hash"), F.coalesce(F.col(id_col), F.lit(0)).cast("long").alias("_id"), number(source_col).alias("_source"), number(lang_col).alias("_lang"))
    rows = written(rows, "rows")
    same = ["text_hash", "text_crc32", "size"]
    classes = rows.groupBy(*same).agg(F.count(F.lit(1)).alias("copies"), F.min("_id").alias("first_id"), F.min("_source").alias("source"), F.min("_lang").alias("lang"))
    return rows, classes


def keyed(classes: DataFrame) -> DataFrame:
    """Dimensions as integers of at most 31 bits, scaled over the whole table."""
    raw = {"bytes": F.col("size"), "first_id": F.col("first_id"), "source": F.shiftrightunsigned("source", 33), "lang": F.shiftrightunsigned("lang", 33)}
    ends = classes.agg(*(f(c).alias(f"{n}_{k}") for n, f in (("lo", F.min), ("hi", F.max)) for k, c in raw.items())).first()
    dims = []
    for k, c in raw.items():
        lo, hi = ends[f"lo_{k}"] or 0, ends[f"hi_{k}"] or 0
        dims.append(F.floor((c - F.lit(lo)).cast("double") * F.lit((2**31 - 1) / max(1, hi - lo)) if hi - lo >= 2**31 else (c - F.lit(lo)) * F.lit(max(1, (2**31 - 1) // max(1, hi - lo)))).cast("long").alias(k))
    return classes.select("text_hash", "text_crc32", "size", F.lit(0).cast("long").alias("from_copy"), F.col("copies").alias("to_copy"), F.lit(0).alias("node"), *dims)


def choose(node: Column, table: dict[int, object], other: object) -> Column:
    """table[node] as an expression over at most as many branches as there are nodes."""
    return reduce(lambda e, kv: F.when(node == kv[0], F.lit(kv[1])).otherwise(e), table.items(), F.lit(other))


def split(parts: DataFrame, depth: int, leaves: int, slack: float) -> DataFrame:
    """One level: every node becomes 2 node and 2 node + 1, of near equal bytes."""
    weight = (F.col("to_copy") - F.col("from_copy")) * F.col("size")
    stats = parts.groupBy("node").agg(F.sum(weight).alias("w"), *(f(d).alias(f"{n}_{d}") for n, f in (("lo", F.min), ("hi", F.max)) for d in DIMS)).collect()
    widest = {r.node: max(DIMS, key=lambda d, r=r: r[f"hi_{d}"] - r[f"lo_{d}"]) for r in stats}
    node = F.col("node")
    value = reduce(lambda e, d: F.when(node.isin([n for n, x in widest.items() if x == d] or [-1]), F.col(d)).otherwise(e), DIMS[1:], F.col(DIMS[0]))
    key = F.shiftleft(value, 32) + F.shiftrightunsigned("text_hash", 32)
    rows = cut(parts.withColumn("key", key))
    half = {r.node: r.w / 2 for r in stats}
    below, start, bits = dict.fromkeys(half, 0), dict.fromkeys(half, 0), 63
    while bits > 0:
        step = min(STEP, bits)
        bits -= step
        offset = F.col("key") - choose(node, start, 0)
        bucket = F.shiftright(offset, bits)
        sums = rows.where((offset >= 0) & (bucket < (1 << step))).groupBy("node", bucket.alias("b")).agg(F.sum(weight).alias("w")).collect()
        for n in half:
            own = sorted((r.b, r.w) for r in sums if r.node == n)
            for b, w in own:
                if below[n] + w >= half[n] or (b, w) == own[-1]:
                    start[n] += b << bits
                    break
                below[n] += w
    at = rows.where(F.col("key") == choose(node, start, -1)).groupBy("node").agg(F.sum(weight).alias("w"), F.count(F.lit(1)).alias("n"), F.first("size").alias("size")).collect()
    total = sum(r.w for r in stats)
    copies: dict[int, int] = {}
    for r in at:
        want = half[r.node] - below[r.node]
        if r.w > slack * total / leaves and r.n == 1:
            copies[r.node] = int(want / r.size + 0.5)
        else:
            copies[r.node] = 1 << 62 if 2 * want >= r.w else 0
    pivot = choose(node, start, -1)
    left = F.when(F.col("key") < pivot, F.col("to_copy")).when(F.col("key") > pivot, F.col("from_copy")).otherwise(F.least("to_copy", F.col("from_copy") + choose(node, copies, 0).cast("long")))
    halves = F.filter(F.array(F.struct((node * 2).alias("node"), F.col("from_copy").alias("a"), left.alias("b")), F.struct((node * 2 + 1).alias("node"), left.alias("a"), F.col("to_copy").alias("b"))), lambda x: x["a"] < x["b"])
    return rows.select("text_hash", "text_crc32", "size", *DIMS, F.explode(halves).alias("h")).select("text_hash", "text_crc32", "size", F.col("h.a").alias("from_copy"), F.col("h.b").alias("to_copy"), F.col("h.node").alias("node"), *DIMS)


def shards(docs: DataFrame, depth: int = 4, slack: float = 0.01, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) with 2 ** ``depth`` shards of near equal bytes.

    size is the text's UTF-8 bytes plus 1 (a null text has none). law is always ``bytes``, so
    grown_shard is null. slot counts a shard's rows from 0 in order of doc_id, then text. Copies of
    a text share a shard unless they are too many for it. Rows come back as often as they came in;
    null ids, sources and languages are values like others. Texts of any length are taken whole; one longer than a shard
    fills its own. Only the four columns named are read, so others can't clash. An empty table gives an empty result.
    """
    rows, classes = classes_of(docs, id_col, text_col, source_col, lang_col)
    parts = cut(keyed(written(classes, "classes")))
    if not parts.isEmpty():
        for level in range(depth):
            parts = split(parts, level, 2**depth, slack)
    parts = cut(parts)
    same = ["text_hash", "text_crc32", "size"]
    whole = Window.partitionBy(*same)  # the parts of a class: at most one for each shard
    marked = cut(parts.select(*same, "from_copy", "to_copy", "node", F.count(F.lit(1)).over(whole).alias("n")))
    # Classes that were divided (each heavier than slack of a leaf: at most leaves / slack of them) and those that hold
    # over a thousandth of all rows (fewer than 1000) are broadcast; their rows, however many, stay where they are.
    hot = F.broadcast(marked.where((F.col("n") > 1) | (F.col("to_copy") * 1000 > rows.count())))
    several, single = hot.where("n > 1"), hot.where("n = 1").select(*same, F.col("node").alias("shard"))
    cold = rows.join(F.broadcast(hot.select(*same).distinct()), same, "left_anti").join(marked.where("n = 1").select(*same, F.col("node").alias("shard")), same)
    one = cold.unionByName(rows.join(F.broadcast(single), same)).select("doc_id", *same, "shard")
    cutting = rows.join(F.broadcast(several.select(*same).distinct()), same)
    placed = numbered(cutting.select(*same, "doc_id"), [*same, "doc_id"], "_at")
    first = placed.groupBy(*same).agg(F.min("_at").alias("_first"))
    ranked = placed.join(F.broadcast(first), same).withColumn("copy", F.col("_at") - F.col("_first"))
    parted = F.broadcast(several.select(*(F.col(c).alias(f"_{c}") for c in same), "from_copy", "to_copy", F.col("node").alias("shard")))
    divided = ranked.join(parted, (F.col("text_hash") == F.col("_text_hash")) & (F.col("text_crc32") == F.col("_text_crc32")) & (F.col("size") == F.col("_size")) & (F.col("copy") >= F.col("from_copy")) & (F.col("copy") < F.col("to_copy")))
    every = one.unionByName(divided.select("doc_id", *same, "shard"))
    ordered = numbered(every, ["shard", "doc_id", "text_hash"], "_at")
    counts = {r.shard: r.n for r in ordered.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    base, before = {}, 0
    for s in sorted(counts):
        base[s] = before
        before += counts[s]
    return ordered.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), (F.col("_at") - choose(F.col("shard"), base, 0).cast("long")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
