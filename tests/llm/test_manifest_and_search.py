"""The Merkle manifest, ranked lexical search and exact top-k search against brute force and their edge cases."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitpanel.llm import blockmax, k2treap, merkle

DOCS = "doc_id long, source string, lang string, n_chars long, text string, g long, digest string, at long"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row, text):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row.doc_id, row.source, row.lang, row.n_chars, text)))


def plain_tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][k : k + 8]) for k in range(0, len(levels[-1]), 8)])
    return levels


def siblings(levels, i):
    out = []
    for level in levels[:-1]:
        run = level[i // 8 * 8 : i // 8 * 8 + 8]
        out.append((run[: i % 8], run[i % 8 + 1 :]))
        i //= 8
    return out


def plain_audit(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r.lang, []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        groups[g].sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, plain_leaf(r, r.text)))
    trees = {g: plain_tree([plain_leaf(r, r.text) for r in groups[g]]) for g in order}
    upper = plain_tree([trees[g][-1][0] for g in order])
    out = []
    for k, g in enumerate(order):
        for i, r in enumerate(groups[g]):
            lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in r.text) if r.text is not None else None
            bad = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 0
            value, path = plain_leaf(r, lower if bad else r.text), siblings(trees[g], i) + siblings(upper, k)
            for before, behind in path:
                value = H(*before, value, *behind)
            root = upper[-1][0]
            out.append((r.doc_id, trees[g][0][i], trees[g][-1][0], root, H(*(x for before, behind in path for x in before + behind)), value, value == root))
    return sorted(out, key=repr)


@pytest.mark.parametrize("levels", [4, 1, 2])
def test_manifest_against_plain_trees(spark, levels):
    """Nulls in every column, repeated rows and ids, one hot group, groups of 1, 8, 9 and 64 rows, clashing extra columns; few levels a round take many rounds."""
    sizes = {None: 3, "": 1, "de": 8, "en": 700, "es": 9, "fr": 64, "é": 65, "Z": 513}
    rows = [(k * 7 % 1000 - 5, "s", g, k, f"Text {k} É") for g, n in sizes.items() for k in range(n)]
    rows += [(None, "s", "en", 1, "X")] * 3 + [(5, None, "en", None, None), (6, "", "en", 0, ""), (7, "s", "en", 1, "Y"), (7, "s", "en", 1, "Y"), (8, "s", "fr", 1, "Ab " * 60000)]
    docs = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], DOCS).repartition(5)
    got = merkle.audited(merkle.build(docs, claim=merkle.tampered(), levels=levels))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_audit(docs.collect())


def test_manifest_of_few_and_no_rows(spark):
    one = spark.createDataFrame([(1, "s", None, 1, "a", 1, "x", 2)], DOCS)
    assert [tuple(r) for r in merkle.audited(merkle.build(one, claim=merkle.tampered())).collect()] == plain_audit(one.collect())
    assert merkle.audited(merkle.build(one.limit(0))).count() == 0


def test_proofs_fold_to_the_root_and_nothing_else_does(spark):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.when(F.col("id") % 3 > 0, "en").alias("lang"), F.lit(1).alias("n_chars"), F.concat(F.lit("t"), "id").alias("text"))
    rows = merkle.proofs(merkle.build(docs)).collect()
    assert len(rows) == 5000 and len({r.root for r in rows}) == 1
    for r in rows[::97]:
        path = list(zip(r.path[::2], r.path[1::2], strict=True))
        assert merkle.fold(r.leaf, r.proof, path) == r.root
        assert merkle.fold(H("other"), r.proof, path) != r.root
        assert merkle.fold(r.leaf, r.proof + "0" * 64, path) != r.root
        assert merkle.fold(r.leaf, r.proof[64:], path) != r.root


WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_ranks(docs, items, k=10):
    held = [(d, plain_words(t)) for d, t in docs]
    held = [(d, w) for d, w in held if w]
    n_docs, total = len(held), sum(len(w) for _, w in held)
    df = {}
    for _, w in held:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text in items:
        terms = set(plain_words(text)) & df.keys()
        weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in terms}
        scored = []
        for d, w in held:
            m = 10 + 90 * len(w) * n_docs // total
            s = sum(weight[t] * (10**9 * w.count(t) // (1000 * w.count(t) + 8 * m)) for t in terms)
            if s > 0:
                scored.append((-s, d is None, d or 0))
        out += [(item, r + 1, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def some_texts(seed, n, words=300):
    r = random.Random(seed)
    names = [f"w{int(r.paretovariate(0.6)) % words}" for _ in range(words)]
    return [" ".join(r.choice(names) for _ in range(r.randint(1, 60))) for _ in range(n)]


@pytest.mark.parametrize(("documents", "postings", "width"), [(1 << 13, 1 << 20, 8), (16, 1 << 20, 1), (1 << 13, 50, 3)])
def test_ranked_search_against_brute_force(spark, documents, postings, width, monkeypatch):
    """Ties by repeated texts, nulls, upper case, other alphabets, NUL, a very long text, items without a term or with ids in common."""
    monkeypatch.setattr(k2treap, "DOCUMENTS", documents)
    monkeypatch.setattr(k2treap, "POSTINGS", postings)
    monkeypatch.setattr(k2treap, "WIDTH", width)
    texts = some_texts(1, 300)
    docs = [(k, t) for k, t in enumerate(texts)] + [(1000 + k, texts[0]) for k in range(30)] + [(None, texts[1]), (None, texts[1]), (3, texts[3]), (2000, None), (2001, ""), (2002, " .,\x7f\x00 "), (2003, "W1 É é ПРИВЕТ привет 数 a\x00b w1_w2"), (2004, "w1 w2 " * 30000)]
    items = [(k, t) for k, t in enumerate(some_texts(2, 25))] + [(1, texts[0]), (1, texts[0]), (None, "É ПРИВЕТ w1"), (50, None), (51, "unheard of"), (52, "the " + texts[5])]
    left = spark.createDataFrame([(*d, "x", 1.0) for d in docs], "doc_id long, text string, rank string, score double").repartition(3)
    right = spark.createDataFrame([(*i, 3) for i in items], "item_id long, text string, doc_id int")
    got = k2treap.ranked(left, right)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_ranks(docs, items)


def test_ranked_search_in_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(k2treap, "ITEM_BYTES", 100)
    docs, items = list(enumerate(some_texts(3, 60))), list(enumerate(some_texts(4, 6)))
    got = k2treap.ranked(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), 3)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_ranks(docs, items, 3)


def test_ranked_search_of_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, item_id long, text string")
    some = spark.createDataFrame([(1, 1, "a b")], none.schema)
    for docs, items in ((none, some), (some, none), (none, none)):
        assert k2treap.ranked(docs, items).collect() == []


def test_treap_gives_up_what_can_not_come_in():
    """A few documents with rare terms among very many: far fewer states are taken than there are documents."""
    r = np.random.default_rng(1)
    n = 4096
    rows, cols = np.concatenate([np.zeros(n, np.int64), r.integers(1, 50, 3 * n), np.full(20, 50)]), np.concatenate([np.arange(n), r.integers(0, n, 3 * n), r.choice(n, 20, replace=False)])
    pair = np.unique(rows * n + cols)
    treap = k2treap.Treap(pair // n, pair % n, 1 + r.integers(0, 100, len(pair)))
    found = [k2treap.Best(10)]
    gone = k2treap.search(treap, list(range(n)), np.zeros(2, np.int64), np.array([0, 50]), np.array([1, 1000]), found)
    assert gone < n // 4
    value = dict(zip(pair.tolist(), treap_values(treap, pair, n), strict=True))
    want = sorted(((-(value.get(d, 0) + 1000 * value.get(50 * n + d, 0)), d) for d in range(n)))[:10]
    assert sorted((-s, -k) for s, _, k in found[0].heap) == want


def treap_values(treap, pair, n):
    """Each posting's impact, read by its path from the root."""
    out = []
    for p in pair.tolist():
        cell = np.zeros(1, np.int64)
        for k in reversed(range(treap.bits)):
            held, cell = treap.down(cell, np.array([2 * (p // n >> k & 1) + (p % n >> k & 1)]))
            assert held.all()
        out.append(int(treap.top[cell[0]]))
    return out


def plain_top(rows, k=5):
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (q, x) in enumerate(good):
        if q is not None and q % 50 == 0:
            scored = sorted((-sum(s * t for s, t in zip(x, y, strict=False)), d is None, d or 0) for b, (d, y) in enumerate(good) if a != b)[:k]
            out += [(q, r + 1, None if none else d, max(-(2**63), min(2**63 - 1, -s))) for r, (s, none, d) in enumerate(scored)]
    return sorted(out, key=repr)


@pytest.mark.parametrize(("rows", "held", "queries"), [(128, 1 << 22, 1 << 21), (3, 100, 40)])
def test_top_k_against_brute_force(spark, rows, held, queries, monkeypatch):
    """Ties, repeated rows, null and non-finite components, other lengths, huge values, null ids, an extra column."""
    for name, v in (("ROWS", rows), ("HELD", held), ("QUERIES", queries)):
        monkeypatch.setattr(blockmax, name, v)
    r = random.Random(5)
    data = [(k, [r.gauss(0, 0.3) for _ in range(8)]) for k in range(300)]
    data += [(400 + k, list(data[50][1])) for k in range(12)] + [(50, list(data[50][1])), (None, list(data[100][1])), (None, list(data[100][1]))]
    data += [(450, None), (500, [1.0, None]), (550, [float("nan")] * 8), (600, [float("inf")] + [0.0] * 7), (650, []), (700, [0.5] * 3), (750, [-0.25] * 12), (-50, [0.0] * 8)]
    df = spark.createDataFrame([(*d, 1) for d in data], "vec_id long, embedding array<double>, rank int").repartition(3)
    assert sorted((tuple(x) for x in blockmax.top(df).collect()), key=repr) == plain_top(data)
    huge = data[:60] + [(800, [1e17] * 8), (801, [-1e17] * 8), (802, [1e17] + [0.0] * 7)]
    df = spark.createDataFrame(huge, "vec_id long, embedding array<double>")
    got = sorted((tuple(x) for x in blockmax.top(df).collect()), key=repr)
    ints = [(i, [x if abs(x) < 1e16 else math.copysign(2**63 / 256, x) for x in v]) for i, v in huge]
    want = plain_top(ints)
    assert [(x[0], x[1], x[2]) for x in got] == [(x[0], x[1], x[2]) for x in want]


def test_top_k_of_empty_tables_and_lone_rows(spark):
    kind = "vec_id long, embedding array<float>"
    assert blockmax.top(spark.createDataFrame([], kind)).collect() == []
    assert blockmax.top(spark.createDataFrame([(50, [1.0])], kind)).collect() == []
    assert [tuple(r) for r in blockmax.top(spark.createDataFrame([(50, [1.0]), (51, [2.0])], kind)).collect()] == [(50, 1, 51, 256 * 512)]


def test_blocks_below_the_bound_are_not_scored():
    """Rows in clusters, each block of one cluster: most blocks of a query stay unread."""
    r = np.random.default_rng(2)
    centres = r.integers(-200, 200, (40, 16))
    rows = np.repeat(centres, blockmax.ROWS, axis=0) + r.integers(-5, 6, (40 * blockmax.ROWS, 16))
    keys, own = np.array(range(len(rows)), object), np.arange(len(rows))
    asked = np.arange(0, len(rows), 50)
    found = blockmax.Found(len(asked), 5)
    scored = blockmax.search(rows, keys, own, rows[asked], asked, found)
    assert scored < 4 * len(asked)
    exact = rows[asked] @ rows.T
    for i, q in enumerate(asked):
        order = sorted((j for j in range(len(rows)) if j != q), key=lambda j: (-exact[i, j], j))[:5]
        assert found.key[i].tolist() == order
