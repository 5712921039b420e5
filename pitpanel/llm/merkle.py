"""Merkle manifest of a table by time-forward processing.

Rows are leaves. In each group, in order, every ``FAN`` consecutive nodes have one parent until one node, the
subroot, is left; the groups' subroots, in order, likewise lead to the root. A node's label is (number of the
group's nodes up to its last one, level), so children come before parents. One sweep in the order of labels sends
each digest to its parent through a priority queue; the reversed sweep starts with the root and sends every node what its
proof still lacks: the siblings of all nodes above it.

The queue is external: a task sweeps blocks of FAN**levels consecutive nodes with a queue of some FAN messages
a level; what goes to a label beyond the block is written, and the next round of tasks, sorted by label, takes it up. Four levels
go by in a round, so 10**11 rows take four rounds, and no task, group or driver holds more than a block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import numbered, written

#: Children of a node, and levels that go by in a round.
FAN, LEVELS = 8, 4
Label = tuple[int, int]


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_digest(values: list[Column]) -> Column:
    """SHA-256 of all values one behind the other: ``-`` for a null, else the UTF-8 byte count, a colon and the value."""
    texts = [c.cast("string") for c in values]
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts)), 256)


def height(n: int) -> int:
    """Levels above ``n`` nodes until one is left."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


def upward(n: int, first: int, digests: list[str], levels: int = LEVELS) -> tuple[dict[Label, list[str]], str]:
    """A block's sweep: the children of each inner node by its label, and the digest of the block's top.

    ``first`` is the number of the block's first node among the group's ``n``. A message waits in the queue until
    the sweep has come to its receiver's label.
    """
    top, runs, queue, last = min(levels, height(n)), {}, [], ""

    def send(level: int, number: int, value: str) -> None:
        above = number // FAN
        heappush(queue, ((min((above + 1) * FAN ** (level + 1), n), level + 1), number, value))

    for k, value in enumerate(digests):
        last = value
        if top:
            send(0, first + k, value)
        while queue and queue[0][0][0] <= first + k + 1:
            label, run = queue[0][0], []
            while queue and queue[0][0] == label:
                run.append(heappop(queue)[2])
            runs[label], last = run, digest("".join(run))
            if label[1] < top:
                send(label[1], (label[0] - 1) // FAN ** label[1], last)
    return runs, last


def downward(n: int, first: int, count: int, runs: dict[Label, list[str]], rest: str) -> list[str]:
    """The reversed sweep: each node's proof, the digests of its siblings level by level and then ``rest``, what the block's top got."""
    if not runs:
        return [rest] * count
    out = [""] * count
    queue = [(-end, -level, rest) for end, level in [max(runs)]]
    while queue:
        end, level, proof = heappop(queue)
        run = runs[-end, -level]
        begin = (-end - 1) // FAN**-level * FAN
        for place in range(len(run)):
            own = "".join(run[:place] + run[place + 1 :]) + proof
            if level == -1:
                out[begin + place - first] = own
            else:
                heappush(queue, (-min((begin + place + 1) * FAN ** (-level - 1), n), level + 1, own))
    return out


def places(number: int, n: int) -> list[tuple[int, int]]:
    """(place in the run, size of the run) of a node and its ancestors."""
    out = []
    while n > 1:
        above = number // FAN
        out.append((number % FAN, min(FAN, n - above * FAN)))
        number, n = above, -(-n // FAN)
    return out


def fold(value: str, proof: str, path: list[tuple[int, int]]) -> str:
    """The root that a leaf's digest and its proof lead to; a proof of another length fits no root."""
    at = 0
    for place, size in path:
        others = proof[at : at + 64 * (size - 1)]
        at += 64 * (size - 1)
        value = digest(others[: 64 * place] + value + others[64 * place :])
    return value if at == len(proof) else ""


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The runs of rows with one (g, block), of which a partition has each whole and in order."""
    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        g, b = batch.column("g").to_numpy(), batch.column("block").to_numpy()
        edges = [0, *(((g[1:] != g[:-1]) | (b[1:] != b[:-1])).nonzero()[0] + 1).tolist(), batch.num_rows]
        for lo, hi in zip(edges, edges[1:], strict=False):
            if held and key != (g[lo], b[lo]):
                yield pa.Table.from_batches(held)
                held = []
            key = (g[lo], b[lo])
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held)


def climb(nodes: DataFrame, levels: int = LEVELS) -> list[DataFrame]:
    """Tables (g, n, j, digest) of every ``levels``-th level from ``nodes`` on; the last has one row a group, its top."""

    size = FAN**levels

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in blocks(batches):
            n, first = rows["n"][0].as_py(), rows["j"][0].as_py()
            top = upward(n, first, rows["digest"].to_pylist(), levels)[1]
            yield pa.RecordBatch.from_pydict({"g": [rows["g"][0].as_py()], "n": [-(-n // size)], "j": [rows["block"][0].as_py()], "digest": [top]})

    tables = [nodes]
    while len(tables) == 1 or (tables[-1].agg(F.max("n")).first()[0] or 0) > 1:
        rows = tables[-1].select("g", "n", "j", "digest", F.expr(f"j div {size}").alias("block"))
        tables.append(written(rows.repartition("g", "block").sortWithinPartitions("g", "j").mapInArrow(run, "g long, n long, j long, digest string"), "merkle"))
    return tables


def descend(tables: list[DataFrame], tops: DataFrame, fields: str, each: Callable[[pa.Table, dict, list[str]], dict], extra: tuple[str, ...] = (), levels: int = LEVELS) -> DataFrame:
    """The reversed sweeps over ``climb``'s tables, from (g, rest, subroot, root) of each group's top to the nodes of the first table.

    ``each(rows, message, proofs)`` makes the columns of ``fields`` of a block of first nodes; ``extra`` are columns
    of the first table that it needs.
    """

    def sweep(nodes: DataFrame, got: DataFrame, ddl: str, made: Callable, names: tuple[str, ...]) -> DataFrame:
        rows = nodes.select("g", "n", "j", "digest", F.expr(f"j div {FAN**levels}").alias("block"), *names)
        both = rows.unionByName(got.select("g", F.lit(-1).cast("long").alias("j"), F.col("j").alias("block"), "rest", "subroot", "root"), allowMissingColumns=True)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for block in blocks(batches):
                message, own = block.slice(0, 1).to_pylist()[0], block.slice(1)
                if message["j"] != -1 or not own.num_rows:
                    raise ValueError("a block of the manifest and its message from above don't meet")
                n, first = own["n"][0].as_py(), own["j"][0].as_py()
                proofs = downward(n, first, own.num_rows, upward(n, first, own["digest"].to_pylist(), levels)[0], message["rest"])
                yield pa.RecordBatch.from_pydict(made(own, message, proofs))

        return both.repartition("g", "block").sortWithinPartitions("g", "block", "j").mapInArrow(run, ddl)

    def passed(own: pa.Table, message: dict, proofs: list[str]) -> dict:
        n = own.num_rows
        return {"g": own["g"].combine_chunks(), "j": own["j"].combine_chunks(), "rest": proofs, "subroot": [message["subroot"]] * n, "root": [message["root"]] * n}

    got = tops.withColumn("j", F.lit(0).cast("long"))
    for nodes in reversed(tables[1:-1]):
        got = written(sweep(nodes, got, "g long, j long, rest string, subroot string, root string", passed, ()), "merkle")
    return sweep(tables[0], got, fields, each, extra)


@dataclass
class Manifest:
    """``leaves``: climb's tables of the groups, the first also with doc_id and claim; ``tops``: what each group's top needs; ``groups``: how many."""

    leaves: list[DataFrame]
    tops: DataFrame
    groups: int
    levels: int


def build(docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang", columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), claim: Column | None = None, levels: int = LEVELS) -> Manifest:
    """The manifest of ``docs``: leaves over ``columns``, by group (null first, then bytewise) and id (null first).

    ``claim`` is an expression for a digest to be checked in the leaf's place where it isn't null. Rows that share an id are ordered by
    their digests, so only equal rows are interchangeable. Texts of any length go through whole, in one pass that leaves
    digests alone; an empty table has no root. Other columns, whatever their names, aren't read.
    """
    held = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(group_col).cast("string").alias("grp"), leaf_digest([F.col(c) for c in columns]).alias("digest"), (F.lit(None).cast("string") if claim is None else claim).alias("claim"))
    # Equal rows have no order of their own; their place in the table written here deals them out.
    held = written(held, "merkle").withColumn("row", F.monotonically_increasing_id())
    rows = numbered(held, [F.col("grp").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), "digest", "row"], "at")
    groups = rows.groupBy("grp").agg(F.min("at").alias("base"), F.count(F.lit(1)).alias("n"))
    groups = written(numbered(groups, [F.col("grp").asc_nulls_first()], "g"), "merkle")
    joined = rows.alias("r").join(groups.alias("q"), F.col("r.grp").eqNullSafe(F.col("q.grp")))
    leaves = climb(written(joined.select("g", "n", (F.col("at") - F.col("base")).alias("j"), "digest", "doc_id", "claim"), "merkle"), levels)

    count = groups.count()
    subroots = leaves[-1].select(F.lit(0).cast("long").alias("g"), F.lit(count).cast("long").alias("n"), F.col("g").alias("j"), "digest")
    upper = climb(subroots, levels)
    whole = upper[-1].select("g", F.lit("").alias("rest"), F.col("digest").alias("subroot"), F.col("digest").alias("root"))

    def passed(own: pa.Table, message: dict, proofs: list[str]) -> dict:
        return {"g": own["j"].combine_chunks(), "rest": proofs, "subroot": own["digest"].combine_chunks(), "root": [message["root"]] * own.num_rows}

    return Manifest(leaves, written(descend(upper, whole, "g long, rest string, subroot string, root string", passed, levels=levels), "merkle"), count, levels)


def paths(own: pa.Table, groups: int) -> Iterator[list[tuple[int, int]]]:
    upper = places(own["g"][0].as_py(), groups)
    n = own["n"][0].as_py()
    return (places(j, n) + upper for j in own["j"].to_pylist())


def proofs(manifest: Manifest) -> DataFrame:
    """(doc_id, leaf, subroot, root, path, proof): what ``fold`` needs to check a leaf; ``proof`` is hex text, ``path`` places and sizes."""

    groups = manifest.groups

    def each(own: pa.Table, message: dict, found: list[str]) -> dict:
        path = [[x for step in steps for x in step] for steps in paths(own, groups)]
        n = own.num_rows
        return {"doc_id": own["doc_id"].combine_chunks(), "leaf": own["digest"].combine_chunks(), "subroot": [message["subroot"]] * n, "root": [message["root"]] * n, "path": pa.array(path, pa.list_(pa.int32())), "proof": found}

    return descend(manifest.leaves, manifest.tops, "doc_id long, leaf string, subroot string, root string, path array<int>, proof string", each, ("doc_id",), manifest.levels)


def audited(manifest: Manifest) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified): each leaf, or its claim, folded with its proof."""

    groups = manifest.groups

    def each(own: pa.Table, message: dict, found: list[str]) -> dict:
        leaves, claims = own["digest"].to_pylist(), own["claim"].to_pylist()
        folded = [fold(claim or leaf, proof, path) for leaf, claim, proof, path in zip(leaves, claims, found, paths(own, groups), strict=True)]
        n = own.num_rows
        return {"doc_id": own["doc_id"].combine_chunks(), "leaf": leaves, "subroot": [message["subroot"]] * n, "root": [message["root"]] * n, "proof_sha256": [digest(p) for p in found], "folded_root": folded, "verified": [f == message["root"] for f in folded]}

    return descend(manifest.leaves, manifest.tops, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean", each, ("doc_id", "claim"), manifest.levels)


CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def tampered(columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The leaf with lower-cased text, for rows whose id's CRC-32 is divisible by 3; null for others (and for a null id)."""
    values = [F.translate(c, CAPITALS, SMALL) if c == text_col else F.col(c) for c in columns]
    return F.when(F.crc32(F.col(id_col).cast("string")) % 3 == 0, leaf_digest(values))


ORACLE = """
WITH RECURSIVE
k AS (SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(CAST(b AS BIGINT), CAST(range(8) AS BIGINT[])), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t),
d AS (SELECT *, CAST(doc_id AS VARCHAR) AS s, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM documents),
l AS (SELECT doc_id, lang, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(s) + 1), lambda i: CAST(ascii(substr(s, i, 1)) AS BIGINT))), lambda c, b: xor(c // 256, t[1 + xor(c % 256, b)])), 4294967295) % 3 = 0 AS bad,
  coalesce(strlen(s) || ':' || s, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
  coalesce(strlen(text) || ':' || text, '-') AS body, coalesce(strlen(low) || ':' || low, '-') AS changed FROM d, k),
v AS (SELECT doc_id, lang, sha256(head || body) AS leaf, sha256(head || CASE WHEN bad THEN changed ELSE body END) AS claim,
  row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, sha256(head || body)) - 1 AS i, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g FROM l),
t AS (SELECT 0 AS level, g, i, leaf AS h FROM v
  UNION ALL SELECT any_value(level) + 1, g, i // 8, sha256(string_agg(h, '' ORDER BY i)) FROM (SELECT *, count(*) OVER (PARTITION BY g) AS n FROM t) WHERE n > 1 GROUP BY g, i // 8),
subs AS (SELECT g, arg_max(h, level) AS h FROM t GROUP BY g),
u AS (SELECT 0 AS level, g AS i, h FROM subs
  UNION ALL SELECT any_value(level) + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)) FROM (SELECT *, count(*) OVER () AS n FROM u) WHERE n > 1 GROUP BY i // 8),
top AS (SELECT arg_max(h, level) AS root FROM u),
tr AS (SELECT level, g, i // 8 AS run, list(h ORDER BY i) AS hs FROM (SELECT *, count(*) OVER (PARTITION BY level, g) AS n FROM t) WHERE n > 1 GROUP BY ALL),
ur AS (SELECT level, i // 8 AS run, list(h ORDER BY i) AS hs FROM (SELECT *, count(*) OVER (PARTITION BY level) AS n FROM u) WHERE n > 1 GROUP BY ALL),
f AS (SELECT 0 AS level, doc_id, leaf, g, i, claim AS h, '' AS proof FROM v
  UNION ALL SELECT f.level + 1, doc_id, leaf, f.g, i // 8, sha256(array_to_string(hs[:i % 8], '') || f.h || array_to_string(hs[i % 8 + 2:], '')), proof || array_to_string(hs[:i % 8], '') || array_to_string(hs[i % 8 + 2:], '') FROM f JOIN tr ON tr.level = f.level AND tr.g = f.g AND tr.run = i // 8),
e AS (SELECT doc_id, leaf, g, arg_max(h, level) AS h, arg_max(proof, level) AS proof FROM f GROUP BY doc_id, leaf, g),
w AS (SELECT 0 AS level, doc_id, leaf, g, g AS i, h, proof FROM e
  UNION ALL SELECT w.level + 1, doc_id, leaf, g, i // 8, sha256(array_to_string(hs[:i % 8], '') || h || array_to_string(hs[i % 8 + 2:], '')), proof || array_to_string(hs[:i % 8], '') || array_to_string(hs[i % 8 + 2:], '') FROM w JOIN ur ON ur.level = w.level AND ur.run = i // 8),
x AS (SELECT doc_id, leaf, g, arg_max(h, level) AS h, arg_max(proof, level) AS proof FROM w GROUP BY doc_id, leaf, g)
SELECT doc_id, leaf, subs.h AS subroot, root, sha256(proof) AS proof_sha256, x.h AS folded_root, x.h = root AS verified FROM x JOIN subs USING (g), top
"""
