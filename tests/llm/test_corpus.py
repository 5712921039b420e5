"""The corpus operators against brute force, round trips and their defined edge cases."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pitpanel.llm import crosspolytope, decontam, ecoc_langid, gbt_quality, kdshard, packing, simhash, tokens, tokenstore, urlrules, warc
from pitpanel.llm import simhash_jaccard as jaccard
from pitpanel.llm.graph import connected_components

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, score double, _part int"
SCHEMA = "doc_id long, text string"


def prose(seed, n=120):
    r = random.Random(seed)
    return " ".join("".join(r.choice(["an", "re", "th", "ou", "ble", "st"]) for _ in range(r.randint(1, 4))) for _ in range(n))


def awkward(spark):
    """Null ids and texts, empty and very long texts, repeated rows, clashing extra columns."""
    rows = [(k, prose(k), "en", "s", 1, "x", 0.5, 3) for k in range(40)]
    rows += [(100, None, None, None, None, None, None, None), (101, "", "en", "s", 0, "", 0.0, 0), (None, prose(7), None, "s", 1, "k", 1.0, 1), (102, "   \n\t ", "en", "s", 1, "", 0.0, 0)]
    rows += [(103, prose(5), "en", "t", 1, "", 0.0, 0), (103, prose(5), "en", "t", 1, "", 0.0, 0), (104, prose(9, 60000), "en", "t", 1, "", 0.0, 0), (105, "a  b \n c  <|endoftext|> é\0x", "fr", "t", 1, "", 0.0, 0)]
    return spark.createDataFrame(rows, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def components(names, pairs):
    low = {n: n for n in names}

    def find(x):
        while low[x] != x:
            x = low[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        low[max(a, b)] = min(a, b)
    return {n: find(n) for n in names}


def test_components_against_union_find(spark):
    r = random.Random(1)
    edges = [(r.randint(0, 300), r.randint(0, 300)) for _ in range(250)] + [(k, k + 1) for k in range(400, 460)] + [(500, k) for k in range(501, 700)] + [(7, 7)]
    got = {x.node: x.component for x in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = components({n for a, b in edges for n in (a, b)}, edges)
    assert got == {n: want[n] for n in got}
    assert {n for a, b in edges if a != b for n in (a, b)} == set(got)


def brute_fingerprint(text):
    import xxhash

    words = simhash.words(text)
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("cell", [64, 1])
def test_simhash_links_against_all_pairs(spark, cell):
    """With cells of one row, every pair goes by the path for full cells; both give the same."""
    r = random.Random(2)
    base = [r.getrandbits(64) for _ in range(30)]
    fps = {b ^ (1 << r.randrange(64)) * r.randint(0, 1) ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)) * r.randint(0, 1) for b in base for _ in range(12)}
    rows = [(int(np.uint64(f).view(np.int64)), k) for k, f in enumerate(sorted(fps))]
    for bits in (2, 1):
        edges = simhash.links(spark.createDataFrame(rows, "fp long, rep long"), bits, cell)
        got = {x.node: x.component for x in connected_components(edges).collect()}
        values = sorted(fps)
        near = [(i, j) for i in range(len(values)) for j in range(i) if bin(values[i] ^ values[j]).count("1") <= bits]
        want = components(range(len(values)), near)
        assert {k: got.get(k, k) for k in want} == want


def test_pivot_coordinates_discard_pairs(spark):
    """Of the pairs that meet in cells, the coordinates discard most and none that links."""
    r = random.Random(6)
    fps = {r.getrandbits(64) for _ in range(1500)}
    fps |= {f ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)) for f in list(fps)[:200]}
    rows = [(int(np.uint64(f).view(np.int64)), k) for k, f in enumerate(sorted(fps))]
    dealt = simhash.cells(spark.createDataFrame(rows, "fp long, rep long"), 3, 2).cache()
    x, y = dealt.alias("x"), dealt.alias("y")
    met = x.join(y, (F.col("x.cell") == F.col("y.cell")) & (F.col("x.fp") < F.col("y.fp"))).select((simhash.largest_difference(F.col("x.coordinates"), F.col("y.coordinates")) <= 2).alias("kept"), (F.bit_count(F.expr("x.fp ^ y.fp")) <= 2).alias("links"))
    count = {(v.kept, v.links): v["count"] for v in met.groupBy("kept", "links").count().collect()}
    dealt.unpersist()
    assert (False, True) not in count and count[True, True] >= 200
    assert count[False, False] > count.get((True, False), 0)


def test_simhash_rows(spark):
    docs = awkward(spark)
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == docs.count()
    text = {x.doc_id: x.text for x in docs.collect()}
    for x in got:
        assert x.fingerprint == f"{brute_fingerprint(text[x.doc_id] or ''):016x}"
    by = {x.doc_id: x.component_id for x in got}
    assert by[100] == by[101] == by[102] == 100 and by[103] == 5 and by[None] == 7
    assert simhash.near_duplicates(empty(spark)).count() == 0


def test_wide_simhash_finds_edited_copies(spark):
    rows, r = [], random.Random(3)
    for k in range(60):
        words = prose(k, 300).split()
        rows.append((10 * k, " ".join(words)))
        copy = list(words)
        for i in r.sample(range(300), 2):
            copy[i] = "edited"
        rows.append((10 * k + 1, " ".join(copy)))
    got = {x.doc_id: x.component_id for x in jaccard.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert sum(got[10 * k + 1] == 10 * k for k in range(60)) >= 59
    assert all(got[10 * k] == 10 * k for k in range(60))
    out = jaccard.near_duplicates(awkward(spark)).collect()
    assert len(out) == awkward(spark).count()
    assert jaccard.near_duplicates(empty(spark)).count() == 0


def test_wide_simhash_against_all_pairs(spark):
    """No link below the similarity, and next to none above it is missed."""
    rows, r = [], random.Random(13)
    for k in range(80):
        words = prose(k, 260).split()
        for c in range(3):
            copy = list(words)
            for i in r.sample(range(260), r.randint(1, 12) if c else 0):
                copy[i] = f"w{r.random()}"
            rows.append((10 * k + c, " ".join(copy)))
    sets = {k: set(simhash.shingles(simhash.words(t), 5)) for k, t in rows}
    near = [(a, b) for a in sets for b in sets if a < b and a // 10 == b // 10 and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    want = components(sets, near)
    got = {x.doc_id: x.component_id for x in jaccard.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(want[x] == want[got[x]] for x in got)
    assert sum(got[a] == got[b] for a, b in near) >= 0.97 * len(near) > 60


def test_wide_simhash_cuts_up_large_cells(spark, monkeypatch):
    rows = [(k, prose(1, 300) + f" tail{k}") for k in range(60)]
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    got = jaccard.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {x.component_id for x in got} == {0}


def shared_passages(groups, copies, seed, n=260):
    """(rows, near pairs): ``copies`` edited copies of each of ``groups`` texts, at similarities on both sides of 0.8."""
    rows, r = [], random.Random(seed)
    for k in range(groups):
        text = prose(1000 + k, n).split()
        for c in range(copies):
            copy = list(text)
            for i in r.sample(range(n), r.randint(4, 9) if c else 0):
                copy[i] = f"w{r.random()}"
            rows.append((copies * k + c, " ".join(copy)))
    sets = {k: set(simhash.shingles(simhash.words(t), 5)) for k, t in rows}
    near = [(a, b) for a in sets for b in range(a + 1, (a // copies + 1) * copies) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    return rows, near


def test_wide_simhash_misses_no_pair(spark):
    """Exact at every size: components are those of all pairs at 0.8, though most lie near it."""
    rows, near = shared_passages(100, 3, 17)
    want = components([k for k, _ in rows], near)
    got = {x.doc_id: x.component_id for x in jaccard.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == want
    assert 50 < len(near) < 290


@pytest.mark.parametrize("block", [1024, 16])
def test_wide_simhash_decides_crowded_cells_exactly(spark, block, monkeypatch):
    """Groups of more rows than ``few``: every pair counts by its sets, none by an estimate, in blocks too."""
    rows, near = shared_passages(4, 60, 23)
    want = components([k for k, _ in rows], near)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    got = {x.doc_id: x.component_id for x in jaccard.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == want
    assert len(set(want.values())) > 4  # some copies are linked to nothing


def test_set_products_equal_plain_similarities():
    r = np.random.default_rng(8)
    make = lambda n: [np.unique(r.integers(0, 60, r.integers(0, 50))).astype("<u4") for _ in range(n)]
    for x, y in ((make(20), make(30)), (make(1), make(1)), ([np.zeros(0, "<u4")], make(3))):
        for width in (7, 2048):
            got = jaccard.similar(x, y, 0.5, width)
            assert got.tolist() == [[len(set(a.tolist()) & set(b.tolist())) >= 0.5 * len(set(a.tolist()) | set(b.tolist())) for b in y] for a in x]


def test_hub_of_copies_is_one_group(spark, monkeypatch):
    """Copies that are linked by their common source alone, in a crowded cell where the source is no leader."""
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    r = random.Random(31)
    base = prose(4000, 200).split()
    rows = [(0, " ".join(base))]
    for k in range(1, 90):
        copy = list(base)
        for i in r.sample(range(200), r.randint(3, 6)):
            copy[i] = f"w{k}x{i}"
        rows.append((k, " ".join(copy)))
    sets = {k: set(simhash.shingles(simhash.words(t), 5)) for k, t in rows}
    near = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    got = {x.doc_id: x.component_id for x in jaccard.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    want = components(sets, near)
    assert got == want and 1 < len(set(want.values())) < 90


@pytest.mark.parametrize("size", [(4, 4), (4, 5), (5, 6), (9, 10), (20, 25), (60, 50)])
def test_fingerprints_of_similar_sets_are_near(size):
    """Nested sets at 0.8 or more differ in few bits, also where they are small, so the distance is a good order of work."""
    r = np.random.default_rng(sum(size))
    apart = []
    for _ in range(200):
        h = r.integers(0, 2**63, max(size), dtype=np.int64).view(np.uint64) * np.uint64(2) + np.uint64(1)
        (a, b), (c, d) = (jaccard.wide_fingerprint(np.sort(h[:n])) for n in size)
        apart.append(bin((a ^ c) & (2**64 - 1)).count("1") + bin((b ^ d) & (2**64 - 1)).count("1"))
    assert np.mean(apart) <= 25


def test_bitmaps_rule_out_no_similar_pair():
    """Sets of all sizes, half of them edited copies just at the threshold or beside it: every similar pair stays, most others go."""
    r = np.random.default_rng(3)
    sets = []
    for n in (1, 4, 5, 9, 40, 300, 700, 2500, 20_000):
        for _ in range(6):
            h = np.unique(r.integers(0, 2**63, n, dtype=np.int64).view(np.uint64))
            sets.append(h)
            for share in (0.05, 0.1, 0.12, 0.2, 0.25):
                cut = int(share * n)
                sets.append(np.unique(np.append(h[cut:], r.integers(0, 2**63, cut // 2, dtype=np.int64).view(np.uint64))))
    maps = [jaccard.bitmap(h) for h in sets]
    size = np.array([len(h) for h in sets])
    true = jaccard.similar(sets, sets, 0.8)
    i, j = jaccard.may_be_similar(maps, maps, size, size, np.ones(true.shape, bool), 0.8)
    kept = np.zeros(true.shape, bool)
    kept[i, j] = True
    assert not (true & ~kept).any() and true.sum() > 2 * len(sets)
    i, j = np.nonzero(true)
    half = [jaccard.folded(m, len(m) // 2).tobytes() for m in maps]
    assert (jaccard.differing(half, i, j, 1000) <= (size[i] + size[j]) / 9 + 1e-6).all() and (jaccard.differing(maps, i, j, 1000) == jaccard.differing(maps, i, j)).all()
    assert (kept & ~true & (size[:, None] > 2000) & (size > 2000)).sum() < 0.1 * (~true & (size[:, None] > 2000) & (size > 2000)).sum()
    small = (size[:, None] < 1000) & (size < 1000)
    assert (kept & small & ~true).sum() < 0.05 * (small & ~true).sum()


def test_warc_round_trip(spark):
    same, other = "<p>" + "x" * 2000, "short"
    rows = [(1, "http://a/", same), (2, "http://b/ \r\n", same), (3, None, None), (4, "u", other), (5, "u", other), (5, "u", same), (5, "u", same), (None, "u", same), (6, "u", "é" * 600), (7, "u", "ab\r\n\r\nWARC/1.1\r\n" * 80)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    folder = warc.new_folder(pages)
    manifest = warc.write(pages, folder, roll_mb=0.0005)
    assert manifest.count() > 1
    got = sorted((tuple(x) for x in warc.read(manifest).collect()), key=str)
    want = []
    for key, _, html in rows:
        data = (html or "").encode()
        want.append((key, len(data), hashlib.sha1(data).hexdigest()))
    assert sorted((g[:3] for g in got), key=str) == sorted(want, key=str)
    of = [g for g in got if g[2] == hashlib.sha1(same.encode()).hexdigest()]
    assert sorted((str(g[0]), g[3], g[4]) for g in of) == sorted([("1", "revisit", 5), ("2", "revisit", 5), ("5", "response", None), ("5", "revisit", 5), ("None", "revisit", 5)])
    assert all(g[3] == "response" for g in got if g[1] < 1000)
    again = warc.write(pages.repartition(3), warc.new_folder(pages), roll_mb=0.0005)
    content = lambda m: [hashlib.sha1(open(p.path.removeprefix("file://"), "rb").read()).hexdigest() for p in m.orderBy("file").collect()]  # noqa: E731, SIM115
    assert content(manifest) == content(again)  # boundaries and bytes follow from the data alone
    assert warc.read(warc.write(pages.limit(0), warc.new_folder(pages))).count() == 0


def vectors(spark):
    r = np.random.default_rng(4)
    base = r.normal(size=(40, 24))
    rows = []
    for k in range(400):
        v = base[k % 40] * r.uniform(0.5, 2) + r.normal(size=24) * r.choice([0.0, 0.1, 0.35])
        rows.append((k, [float(np.float32(x)) for x in v], int(k % 2)))
    rows += [(1000, None, 1), (1001, [0.0] * 24, 1), (1002, [float("nan")] * 24, 1), (1003, [None] * 24, 1), (1004, rows[0][1], None), (1005, rows[0][1], 0), (1006, [1.0], 0), (1007, [], 0), (1005, rows[0][1], 0)]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("rep", F.lit(1))


@pytest.mark.parametrize("block", [1024, 16])
def test_embedding_links_against_all_pairs(spark, block, monkeypatch):
    monkeypatch.setattr(crosspolytope, "BLOCK", block)
    rows, df = vectors(spark)
    sound = [(k, np.array(v, float), lab) for k, v, lab in rows if lab is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    n, pairs = {}, []
    for i, (a, x, la) in enumerate(sound):
        for j, (b, y, lb) in enumerate(sound):
            if i != j and la == lb and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.93:
                n[a] = n.get(a, 0) + (1 if a != 1005 else 0.5)
                pairs.append((a, b))
    want = components({k for k, _, _ in rows}, pairs)
    got = crosspolytope.near_duplicates(df).collect()
    assert len(got) == len(rows)
    found = sum(x.n_links for x in got if x.vec_id != 1005)
    truth = sum(v for k, v in n.items() if k != 1005)
    assert all(x.n_links <= n.get(x.vec_id, 0) for x in got) and found >= 0.97 * truth
    assert np.mean([x.component_id == want[x.vec_id] for x in got]) > 0.95
    assert all(x.kept == (x.vec_id == x.component_id) for x in got)
    assert crosspolytope.near_duplicates(df.limit(0)).count() == 0


def test_embedding_links_count_pairs_that_only_probe(spark, monkeypatch):
    """Whoever is joined to others has links, also by buckets that a third vector owns."""
    monkeypatch.setattr(crosspolytope, "settings", lambda *a: (1, 1))
    r = np.random.default_rng(3)
    base = np.repeat(r.normal(size=(150, 64)), 4, 0)
    near = base + r.normal(size=base.shape) * 0.25
    rows = [(k, x.tolist(), "a") for k, x in enumerate(near)]
    out = crosspolytope.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")).collect()
    unit = near / np.linalg.norm(near, axis=1, keepdims=True)
    true = (unit @ unit.T >= 0.93).sum(1) - 1
    assert sum(x.component_id != x.vec_id for x in out) > 50
    assert all(x.n_links > 0 for x in out if x.component_id != x.vec_id)
    assert all(x.n_links <= true[x.vec_id] for x in out)


@pytest.mark.parametrize(("dims", "k"), [(64, 2), (64, 3), (768, 2)])
def test_embedding_recall_at_the_threshold(spark, monkeypatch, dims, k):
    """Pairs just above the threshold are found in wide vectors and with several codes a bucket, too."""
    tables = int(np.ceil(np.log(crosspolytope.MISSED) / np.log(1 - crosspolytope.meeting(dims, k, 0.93, 3))))
    monkeypatch.setattr(crosspolytope, "settings", lambda *a: (k, tables))
    r = np.random.default_rng(dims + k)
    x = r.normal(size=(300, dims))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = r.normal(size=x.shape)
    y -= (y * x).sum(1, keepdims=True) * x
    y = 0.9301 * x + np.sqrt(1 - 0.9301**2) * y / np.linalg.norm(y, axis=1, keepdims=True)
    rows = [(k, v.tolist(), "a") for k, v in enumerate(np.concatenate([x, y]))]
    got = {v.vec_id: v for v in crosspolytope.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")).collect()}
    assert all(v.n_links <= 1 for v in got.values())
    assert np.mean([got[k].n_links == 1 and got[300 + k].component_id == k for k in range(300)]) >= 0.99


def test_kd_shards(spark):
    docs = awkward(spark)
    more = docs.unionByName(spark.createDataFrame([(2000 + k, prose(3000 + k, 20 + k % 60), "de", f"s{k % 7}", 1, "", 0.0, 0) for k in range(3000)] + [(9000 + k, prose(1), "en", "s", 1, "", 0.0, 0) for k in range(900)], DOCS))
    got = kdshard.shards(more).collect()
    text = {}
    for x in more.collect():
        text.setdefault(x.doc_id, x.text)
    assert len(got) == more.count()
    for x in got:
        data = (text[x.doc_id] or "").encode()
        assert (x.size, x.text_crc32, x.law, x.grown_shard) == (len(data) + 1, zlib.crc32(data), "bytes", None)
    size = [sum(x.size for x in got if x.shard == s) for s in range(16)]
    longest = max(x.size for x in got)  # the very long text is more than a shard's part
    rest = sorted(size)[:-1]
    assert max(size) < np.mean(size) + longest and max(rest) < 1.35 * np.mean(rest)
    for s in range(16):
        assert sorted(x.slot for x in got if x.shard == s) == list(range(sum(x.shard == s for x in got)))
    assert kdshard.shards(empty(spark)).count() == 0


def test_kd_tree_equals_a_plain_one(spark):
    """Every text's copies fall into the shards of a tree cut at weighted medians in plain Python."""
    r = random.Random(15)
    rows = [(k, prose(k % 130, 5 + k % 130 // 2), r.choice(["en", "de"]), r.choice("abc"), 1, "", 0.0, 0) for k in range(700)] + [(1000 + k, prose(999, 30), "en", "a", 1, "", 0.0, 0) for k in range(200)] + [(None, None, None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, DOCS)
    points = kdshard.keyed(kdshard.classes_of(docs)[1]).collect()
    total = sum(p.to_copy * p.size for p in points)

    def split(node, level):
        """node: (point, from, to) triples."""
        if level == 4:
            return [node]
        d = max(kdshard.DIMS, key=lambda d: max(p[d] for p, _, _ in node) - min(p[d] for p, _, _ in node)) if node else "bytes"
        key = lambda p: (p[d] << 32) + ((p.text_hash & (2**64 - 1)) >> 32)
        weight, half, below, pivot = lambda x: (x[2] - x[1]) * x[0].size, sum((b - a) * p.size for p, a, b in node) / 2, 0, None
        left, right = [], []
        for x in sorted(node, key=lambda x: key(x[0])):
            if pivot is None and below + weight(x) >= half:
                pivot = x
                want = half - below
                if weight(x) > 0.01 * total / 16:
                    at = min(x[2], x[1] + int(want / x[0].size + 0.5))
                else:
                    at = x[2] if 2 * want >= weight(x) else x[1]
                left += [(x[0], x[1], at)] if at > x[1] else []
                right += [(x[0], at, x[2])] if at < x[2] else []
            elif pivot is None:
                below += weight(x)
                left.append(x)
            else:
                right.append(x)
        return split(left, level + 1) + split(right, level + 1)

    want = {(p.text_hash, s): b - a for s, leaf in enumerate(split([(p, 0, p.to_copy) for p in points], 0)) for p, a, b in leaf}
    hashes = {v.text_crc32: v.text_hash for v in kdshard.classes_of(docs)[0].collect()}
    got = {}
    for x in kdshard.shards(docs).collect():
        at = (hashes[x.text_crc32], x.shard)
        got[at] = got.get(at, 0) + 1
    assert got == want


def test_url_rules(spark):
    urls = ["https://a.NET/x", "http://example.net/en/7?q#f", "http://w.example.com/de/", "http://wexample.com/de/1", "http://x.org/fr/9", "http://org", "http://net", "nothing", None, "", "http://b.org/login", "ftp://example.net:80/en/", "http://a.net?x=/", "http://shop.org/cart", "http://pixel.site.org/a", "http://example.net/en", "http://e.net/a://b/c"]
    df = spark.createDataFrame([(k, u, "h") for k, u in enumerate([*urls, urls[0]])], "page_id long, url string, host string")
    got = {x.page_id: x for x in urlrules.judge(df).collect()}
    rules = {"net/": ("net", "/", "block"), "example.net/en/": ("example.net", "/en/", "allow"), "example.com/de/": ("example.com", "/de/", "block"), "org/fr/": ("org", "/fr/", "allow")}
    for k, u in enumerate(urls):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        cut = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
        host, path = rest[:cut].lower(), rest[cut:].split("?")[0].split("#")[0]
        fit = [n for n, (h, p, _) in rules.items() if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fit, key=len, default=None)
        assert (got[k].host, got[k].path, got[k].rule) == (host, path, best), u
        assert not best or got[k].verdict == rules[best][2]
    assert got[10].verdict == "block" and got[13].verdict == "block" and got[14].verdict == "block" and got[8].verdict == "allow"
    assert urlrules.judge(df.limit(0)).count() == 0
    plan = urlrules.judge(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def expected_ids(texts):
    plain = tokens.Encoder(tokens.default_path())
    return [np.concatenate([np.frombuffer(b, "<u4"), [2]]).astype("<u4") for b in plain.whole([t or "" for t in texts])]


def test_encoder_equals_the_library():
    r = random.Random(5)
    parts = [" ", "  ", "\n", "\t", " \n", "a", "'s", "é", "x1", "12", "!!", "ñandú", "<|endoftext|>", "\0", "½", "ª", "|", "\u3000", "\x1c", "don't", " the", "'", "'re", "'l", "l", "\u00a0", "漢", "\U0001f600", "ǆ"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 30))) for _ in range(4000)] + [prose(1), "", None]
    e = tokens.Encoder(tokens.default_path(), remembered=500)
    for k in range(0, len(texts), 300):
        part = texts[k : k + 300]
        ids, counts = e.encode(pa.array([*part, "cut off"]).slice(0, len(part)))
        want = e.whole([t or "" for t in part])
        assert ids.tobytes() == b"".join(want) and counts.tolist() == [len(w) // 4 for w in want]
    assert [len(x) for x in e.encode(pa.array([], pa.string()))] == [0, 0]


@pytest.mark.parametrize("kind", ["norm", "dot"])
def test_packing_plan_keeps_every_capacity(kind):
    r = random.Random(6)
    counts = {}
    for _ in range(800):
        n = min(64, int(r.lognormvariate(2.5, 0.9)) + 1)
        counts[n] = counts.get(n, 0) + 1
    runs = packing.plan(counts, (64, 5, 64 * 40), (1.0, 0.2, 0.2), kind) if max(counts) ** 2 <= 64 * 40 else packing.plan(counts, (64, 5, 64 * 64), (1.0, 0.2, 0.2), kind)
    bins, seen = {}, {}
    for length, rank, n, first, offset in runs.tolist():
        for k in range(n):
            bins.setdefault(first + k, []).append((offset, length))
            seen.setdefault(length, []).append(rank + k)
    assert {k: len(v) for k, v in seen.items()} == counts and all(sorted(v) == list(range(len(v))) for v in seen.values())
    for own in bins.values():
        own.sort()
        assert [o for o, _ in own] == [sum(x for _, x in own[:k]) for k in range(len(own))]
        assert sum(x for _, x in own) <= 64 and len(own) <= 5


@pytest.mark.parametrize("kind", ["norm", "dot"])
@pytest.mark.parametrize("capacity", [(64, 5, 64 * 64), (64, 64, 1500), (64, 4, 1800)])
def test_packing_takes_the_best_bin(kind, capacity):
    """Bins are filled as by a packer that scores every open bin for every single piece."""
    r, weights = random.Random(16), (1.0, 0.3, 0.5)
    pieces = sorted((min(38, int(r.lognormvariate(2.2, 0.8)) + 1) for _ in range(400)), reverse=True)
    open_bins = []
    for n in pieces:
        need, scored = (n, 1, n * n), []
        for k, own in enumerate(open_bins):
            load = (sum(own), len(own), sum(x * x for x in own))
            if all(u + d <= c for u, d, c in zip(load, need, capacity)):
                rest = [(c - u - d) / c for u, d, c in zip(load, need, capacity)] if kind == "norm" else [(c - u) / c for u, c in zip(load, capacity)]
                value = sum(w * (x * x) for w, x in zip(weights, rest)) if kind == "norm" else -sum(w * (d / c) * x for w, d, c, x in zip(weights, need, capacity, rest))
                scored.append((value, k))
        if scored:
            open_bins[min(scored)[1]].append(n)
        else:
            open_bins.append([n])
    bins = {}
    for length, _, n, first, _ in packing.plan({n: pieces.count(n) for n in set(pieces)}, capacity, weights, kind).tolist():
        for k in range(n):
            bins.setdefault(first + k, []).append(length)
    load = lambda b: (sum(b), len(b), sum(x * x for x in b))  # noqa: E731  bins of equal load are interchangeable
    assert sorted(map(load, bins.values())) == sorted(map(load, open_bins))
    tokens_only = packing.plan({n: pieces.count(n) for n in set(pieces)}, (64, 64, 64 * 64), weights, kind)
    assert len(bins) > len({first + k for _, _, n, first, _ in tokens_only.tolist() for k in range(n)})  # the others bind


def test_packing_rows(spark):
    docs = awkward(spark)
    rows = docs.collect()
    want = {}
    for x, ids in zip(rows, expected_ids([x.text for x in rows]), strict=True):
        want.setdefault(x.doc_id, []).append(ids)
    got = packing.pack(packing.pieces(docs, tokens.default_path())).collect()
    assert sum(x.length for x in got) == sum(len(i) for v in want.values() for i in v)
    for x in got:
        assert any(zlib.crc32(i[x.start : x.start + x.length].tobytes()) == x.ids_crc32 for i in want[x.doc_id])
        assert x.length == 1024 or x.piece == 0
    by = {}
    for x in got:
        by.setdefault(x.sequence_id, []).append((x.offset, x.length))
    for own in by.values():
        own.sort()
        assert sum(n for _, n in own) <= 1024 and [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))]
    total = sum(x.length for x in got)
    assert len(by) <= total / 1024 * 1.1 + 1
    assert packing.pack(packing.pieces(empty(spark), tokens.default_path())).count() == 0


def test_packing_rows_under_every_capacity(spark):
    """Document and attention capacities bind pack() as tokens do."""
    r = random.Random(5)
    made = spark.createDataFrame([(k, 0, 0, r.randint(1, 40), k) for k in range(300)], "doc_id long, piece int, start long, length long, ids_crc32 long")
    sizes = []
    for capacity in ({"documents": None}, {"documents": 3}, {"documents": None, "attention": 2000}, {"documents": 3, "attention": 2000}):
        bins = {}
        for x in packing.pack(made, 100, **capacity).collect():
            bins.setdefault(x.sequence_id, []).append((x.offset, x.length))
        sizes.append(len(bins))
        assert sum(map(len, bins.values())) == 300
        for held in bins.values():
            held.sort()
            assert all(a + n == b for (a, n), (b, _) in zip(held, held[1:], strict=False)) and sum(n for _, n in held) <= 100
            assert len(held) <= (capacity["documents"] or 100) and sum(n * n for _, n in held) <= capacity.get("attention", 100**2)
    assert sizes[0] < min(sizes[1:])


def test_token_store_round_trip(spark):
    docs = awkward(spark)
    rows = sorted(docs.collect(), key=lambda x: (x.doc_id is not None, x.doc_id or 0, x.text or ""))
    ids = expected_ids([x.text for x in rows])
    manifest = tokenstore.write(docs, tokenstore.new_folder(docs), tokens.default_path(), roll_mb=1)
    got = sorted(tokenstore.read(manifest).collect(), key=lambda x: x.start)
    assert [x.doc_id for x in got] == [x.doc_id for x in rows]
    assert [x.n_tokens for x in got] == [len(i) for i in ids]
    assert [x.start for x in got] == np.cumsum([0, *map(len, ids)])[:-1].tolist()
    assert [x.ids_crc32 for x in got] == [zlib.crc32(i.tobytes()) for i in ids]
    shards = [tokenstore.Shard(x.path) for x in manifest.collect()]
    found = [s.ids(17) for s in shards]
    assert [f.tolist() for f in found if f is not None] == [ids[[x.doc_id for x in rows].index(17)].tolist()]
    assert all(s.ids(123456789) is None for s in shards)
    assert tokenstore.read(tokenstore.write(empty(spark), tokenstore.new_folder(docs), tokens.default_path())).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_perfect_hash_is_minimal(n):
    keys = np.random.default_rng(n).choice(2**62, n, replace=False).astype(np.int64)
    slots = tokenstore.PerfectHash.build(keys).slots(keys)
    assert sorted(slots.tolist()) == list(range(n))


def test_quality_trees_separate_junk(spark):
    r = random.Random(8)
    rows, labels = [], []
    for k in range(600):
        junk = k % 4 == 0
        text = " ".join(["BUY!!"] * r.randint(5, 50) + [prose(k, 30).upper()]) if junk else prose(k, r.randint(30, 200)) + "."
        rows.append((k, text))
        labels.append((k, int(not junk), 0))
    docs = spark.createDataFrame(rows, SCHEMA).unionByName(awkward(spark).select("doc_id", "text").where("doc_id is null or doc_id >= 100").withColumn("doc_id", F.col("doc_id") + 1000))
    marks = spark.createDataFrame([*labels, (None, 1, 0), (3, None, 0), (3, 1, 0)], "doc_id long, quality int, toxic int")
    out = gbt_quality.score(docs, gbt_quality.train(docs, marks)).collect()
    assert len(out) == docs.count() and all(0 <= x.score <= 1 and x.predicted == int(x.score >= 0.3) for x in out)
    held = [x for x in out if x.doc_id is not None and x.doc_id < 600 and x.held_out]
    assert all(x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 5 == 0) for x in out if x.doc_id is not None)
    assert np.mean([x.predicted == int(x.doc_id % 4 != 0) for x in held]) > 0.97
    none = gbt_quality.score(docs, gbt_quality.train(docs, marks.limit(0))).collect()
    assert {x.score for x in none} == {0.5}
    assert gbt_quality.score(docs.limit(0), gbt_quality.train(docs, marks)).count() == 0


def test_forest_walk_equals_plain_walk():
    r = np.random.default_rng(9)
    x = r.normal(size=(500, 5))
    forest = gbt_quality.fit(x, (x[:, 0] + x[:, 1] ** 2 > 0.5).astype(float), trees=20)

    def walk(row):
        total = forest.base
        for f, t, v in zip(forest.feature, forest.threshold, forest.value, strict=True):
            k = 0
            while k < len(f):
                k = 2 * k + 1 + int(row[f[k]] > t[k])
            total += v[k - len(f)]
        return total

    assert np.allclose([walk(row) for row in x], forest.margin(x))


def test_language_codes(spark):
    kinds = {"xx": "abcdef", "yy": "ghijkl", "zz": "mnopqr"}
    r = random.Random(10)
    rows = [(k, " ".join("".join(r.choice(kinds[lang]) for _ in range(r.randint(2, 6))) for _ in range(40)), lang) for k, lang in enumerate(r.choice(list(kinds)) for _ in range(500))]
    extra = [(1000, None, "xx"), (1001, "", "xx"), (1002, "12 !? 34", "yy"), (None, "abc abc", "xx"), (1003, "ghi gli", None), (1003, "ghi gli", None)]
    docs = spark.createDataFrame(rows + extra, "doc_id long, text string, lang string").withColumn("lang_pred", F.lit("clash"))
    out = ecoc_langid.predict(docs, ecoc_langid.train(docs)).collect()
    assert len(out) == 506
    by = {x.doc_id: x for x in out}
    assert all(by[k].lang_pred == "und" and by[k].score == 0 for k in (1000, 1001, 1002))
    assert np.mean([by[k].lang_pred == lang for k, _, lang in rows if by[k].held_out]) > 0.98
    assert all(x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 3 == 1) for x in out if x.doc_id is not None)
    assert {x.lang_pred for x in ecoc_langid.predict(docs, ecoc_langid.train(docs.limit(0))).collect()} == {"und"}


def test_language_decoder_equals_a_plain_one(spark):
    r = np.random.default_rng(3)
    for n in (2, 4, 7):
        bits = max(15, 3 * int(np.ceil(np.log2(n + 1))))
        code = ecoc_langid.codewords(n, bits)
        apart = min(int((code[i] != code[j]).sum()) for i in range(n) for j in range(i))
        assert apart >= bits // 3 and all(0 < (code[:, b] > 0).sum() < n for b in range(bits))
        model = ecoc_langid.Model([f"l{k}" for k in range(n)], code, r.normal(size=(20, bits)), r.normal(size=bits), r.uniform(0.5, 1, bits))
        x = r.normal(size=(50, 20))
        best, score, gap = model.decode(x)
        for i, row in enumerate(x):
            margin = [sum(row[d] * model.weights[d, b] for d in range(20)) + model.bias[b] for b in range(bits)]
            loss = [sum(model.trust[b] * np.log1p(np.exp(-margin[b] * code[k, b])) for b in range(bits)) for k in range(n)]
            share = np.exp(min(loss) - np.array(loss)) / np.exp(min(loss) - np.array(loss)).sum()
            first, second = sorted(share)[-1], sorted(share)[-2]
            assert best[i] == int(np.argmin(loss)) and np.isclose(score[i], first) and np.isclose(gap[i], first - second)
    docs = spark.createDataFrame([(k, ("abcdef " if k % 2 else "ghijkl ") * 9, "x" if k % 2 else "y") for k in range(80)], "doc_id long, text string, lang string")
    model = ecoc_langid.train(docs)
    out = {v.doc_id: v for v in ecoc_langid.predict(spark.createDataFrame([(1, "abcdef " * 9), (2, "abcdef ghijkl " * 9), (3, "abcdef " * 60_000)], "doc_id long, text string"), model, gap=0.6).collect()}
    assert not out[1].ambiguous and out[2].ambiguous and out[3].lang_pred == "x"
    assert ecoc_langid.predict(docs.limit(0), model).count() == 0


def test_every_language_is_learned(spark):
    kinds = [f"{a}{b}" for a in "bcdfgh" for b in "aeiou"]
    docs = spark.createDataFrame([(30 * k + i, f"{w} {w}{w} " * 12, f"l{i:02}") for k in range(12) for i, w in enumerate(kinds)], "doc_id long, text string, lang string")
    model = ecoc_langid.train(docs, max_rows=60)
    assert len(model.languages) == len(kinds)


def test_forest_cuts_equal_an_exhaustive_search():
    """The root of the first tree is the best of all cuts of all columns, found here without histograms."""
    r = np.random.default_rng(2)
    x = np.round(r.normal(size=(300, 4)), 1)
    y = (x[:, 2] > 0.3).astype(float)
    y[r.integers(0, 300, 20)] = 1 - y[r.integers(0, 300, 20)]
    forest = gbt_quality.fit(x, y, trees=1, depth=1, bins=64, l2=1.0, least=2.0)
    p = y.mean()
    g, h = p - y, np.full(300, p * (1 - p))
    best = (0.0, None, None)
    for column in range(4):
        for cut in np.unique(np.quantile(x[:, column], np.linspace(0, 1, 65)[1:-1])):
            left = x[:, column] <= cut
            if h[left].sum() < 2 or h[~left].sum() < 2:
                continue
            gain = g[left].sum() ** 2 / (h[left].sum() + 1) + g[~left].sum() ** 2 / (h[~left].sum() + 1) - g.sum() ** 2 / (h.sum() + 1)
            if gain > best[0] + 1e-9:
                best = (gain, column, cut)
    assert (int(forest.feature[0][0]), float(forest.threshold[0][0])) == (best[1], best[2])
    left = x[:, best[1]] <= best[2]
    assert np.allclose(forest.value[0], [-0.1 * g[s].sum() / (h[s].sum() + 1) for s in (left, ~left)])


def plain_alignment(a, b):
    best, table = 0, np.zeros((len(a) + 1, len(b) + 1), int)
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            table[i, j] = max(0, table[i - 1, j - 1] + (2 if x == y else -1), table[i - 1, j] - 1, table[i, j - 1] - 1)
            best = max(best, table[i, j])
    return best


def test_alignment_against_the_full_table():
    r = np.random.default_rng(11)
    for _ in range(60):
        a, b = r.integers(0, 6, r.integers(1, 25)).astype(np.int32), r.integers(-1, 6, r.integers(1, 60)).astype(np.int32)
        score, first, last = decontam.align(a, b)
        assert score == plain_alignment(a, b)
        assert score == 0 or plain_alignment(a, b[first : last + 1]) == score


def test_decontamination_against_all_pairs(spark):
    r = random.Random(12)
    items = [(k, prose(5000 + k, 30)) for k in range(8)] + [(90, "of the"), (91, None), (92, "")]
    docs = []
    for k in range(80):
        words = prose(k, 200).split()
        if k % 4 == 0:
            leak = items[k // 4 % 8][1].split()
            for i in r.sample(range(30), k // 4 % 5):
                leak[i] = "changed"
            words[50:50] = leak
        docs.append((k, " ".join(words)))
    docs += [(200, None), (201, ""), (None, items[0][1]), (202, items[1][1].upper() + "!"), (202, items[1][1])]
    df = spark.createDataFrame(docs, SCHEMA).withColumn("item_id", F.lit(5))
    got = decontam.contaminated(df, spark.createDataFrame(items, "item_id long, text string")).collect()
    want = []
    for d, text in docs:
        w = decontam.words(text)
        for i, t in items:
            item = decontam.words(t)
            if len(item) >= 3 and w and plain_alignment(item, w) >= 0.5 * 2 * len(item):
                want.append((d, i))
    assert sorted(((x.doc_id, x.item_id) for x in got), key=str) == sorted(want, key=str)
    assert {x.score for x in got if x.doc_id == 202} == {1.0}
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.contaminated(df, none).count() == 0 and decontam.contaminated(df.limit(0), spark.createDataFrame(items, "item_id long, text string")).count() == 0


def test_pipeline_stages_on_awkward_rows(spark, tmp_path):
    import corpus_pipeline

    docs = awkward(spark).unionByName(spark.createDataFrame([(500 + k, prose(600 + k) + ".", "en", "s", 1, "", 0.0, 0) for k in range(60)] + [(700, prose(601) + ".", "en", "s", 1, "", 0.0, 0)], DOCS))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, 1, 0) for k in range(500, 560)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, prose(605))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, rows, str(tmp_path))
        if name != "pack":
            assert after.columns == rows.columns
        rows = spark.createDataFrame(after.collect(), after.schema)
    left = {x.doc_id for x in rows.collect()}
    assert 501 in left and 700 not in left and 505 not in left and 100 not in left
    assert {500 + k for k in range(60) if k != 5} <= left


@pytest.mark.parametrize("stage", range(5))
def test_pipeline_stages_on_empty_tables(spark, tmp_path, stage):
    import corpus_pipeline

    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    name, function = corpus_pipeline.STAGES[stage]
    out = function(spark, empty(spark), str(tmp_path))
    assert out.count() == 0 and (name == "pack" or out.columns == empty(spark).columns)


def test_near_duplicate_stage_tells_rows_apart(spark):
    """Texts that share an id are judged one by one; of repeated rows one stays; nulls come last in their group."""
    import corpus_pipeline

    rows = [(1, prose(1)), (1, prose(2)), (2, prose(3)), (2, prose(3)), (None, prose(3)), (None, prose(4)), (3, None), (4, ""), (None, " "), (5, prose(5, 40_000)), (6, prose(5, 40_000) + " end"), (42, prose(6))]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("_id", F.lit("clash")).withColumn("cid", F.lit(0))
    out = corpus_pipeline.near_duplicates(spark, docs, "")
    got = sorted(((x.doc_id, (x.text or "")[:40]) for x in out.collect()), key=str)
    assert out.columns == docs.columns
    assert got == sorted([(1, prose(1)[:40]), (1, prose(2)[:40]), (2, prose(3)[:40]), (None, prose(4)[:40]), (3, ""), (5, prose(5, 40_000)[:40]), (42, prose(6)[:40])], key=str)


def test_decontamination_stage_drops_only_copies(spark, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([(1, prose(50, 40))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(7, prose(1)), (7, prose(2) + " " + prose(50, 40)), (None, prose(50, 40)), (8, None), (8, ""), (9, prose(3, 60_000)), (10, prose(4, 60_000) + " " + prose(50, 40))]
    out = corpus_pipeline.decontaminate(spark, spark.createDataFrame(rows, SCHEMA), str(tmp_path)).collect()
    assert sorted(((x.doc_id, (x.text or "")[:30]) for x in out), key=str) == sorted(((k, (t or "")[:30]) for k, t in (rows[0], rows[3], rows[4], rows[5])), key=str)


def test_whole_pipeline_against_a_plain_chain(spark, tmp_path):
    """All stages over a small corpus, against plain versions: every tree walked, every pair compared, every alignment filled in."""
    import corpus_pipeline

    r = random.Random(21)
    kinds = {"xx": "abcdefgh", "yy": "ijklmnop"}
    word = lambda lang: "".join(r.choice(kinds[lang]) for _ in range(r.randint(3, 7)))
    items = [(k, " ".join(word("xx") for _ in range(30))) for k in range(3)]
    rows, labels = [], []
    for k in range(160):
        lang = "xx" if k % 2 else "yy"
        text = [word(lang) for _ in range(r.randint(40, 90))]
        if k % 5 == 0:
            text = ["BUY!!!"] * 30 + [w.upper() for w in text[:5]]
        elif k % 9 == 1 and rows:
            text = rows[-1][1].split()
            text[r.randrange(len(text))] = "other"
        elif k % 16 == 3:
            text[10:10] = items[k % 3][1].split()
        rows.append((k, " ".join(text), lang, "s", 1))
        labels.append((k, int(k % 5 != 0), 0))
    rows += [(200, None, "xx", "s", 0), (201, "", "xx", "s", 0), (202, "12 34", "xx", "s", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")

    forest = gbt_quality.train(docs, spark.read.parquet(f"{tmp_path}/labels.parquet"))

    def walked(text):
        x, total = gbt_quality.statistics(text, forest.common), forest.base
        for f, t, v in zip(forest.feature, forest.threshold, forest.value, strict=True):
            k = 0
            while k < len(f):
                k = 2 * k + 1 + int(x[f[k]] > t[k])
            total += v[k - len(f)]
        return 1 / (1 + np.exp(-total))

    left = [x for x in rows if walked(x[1]) >= 0.3]
    assert 20 < len(rows) - len(left) < 50
    model = ecoc_langid.train(spark.createDataFrame(left, docs.schema))

    def language(text):
        if not text or not any(c.isalpha() for c in text):
            return 0.0
        margin = ecoc_langid.features(text) @ model.weights + model.bias
        loss = [(model.trust * np.log1p(np.exp(-margin * c))).sum() for c in model.code]
        return max(np.exp(min(loss) - np.array(loss)) / np.exp(min(loss) - np.array(loss)).sum())

    left = [x for x in left if language(x[1]) >= corpus_pipeline.LEAST_LANGUAGE_SCORE]
    sets = {x[0]: set(simhash.shingles(simhash.words(x[1]), 5)) for x in left}
    near = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    first = components(sets, near)
    left = [x for x in left if first[x[0]] == x[0]]
    assert len(near) > 5
    leaks = {x[0] for x in left for _, t in items if plain_alignment(decontam.words(t), decontam.words(x[1])) >= 0.5 * 2 * 30}
    left = [x for x in left if x[0] not in leaks]
    assert len(leaks) > 3
    want = {(x[0], 0, len(i), zlib.crc32(i.tobytes())) for x, i in zip(left, expected_ids([x[1] for x in left]), strict=True)}
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {(x.doc_id, x.piece, x.length, x.ids_crc32) for x in out} == want and len(out) == len(want)
    held = {}
    for x in out:
        held[x.sequence_id] = held.get(x.sequence_id, 0) + x.length
    assert max(held.values()) <= 1024 and len(held) <= sum(held.values()) / 1024 * 1.1 + 1


def test_very_long_pages_urls_and_documents(spark):
    long = "<p>" + prose(3, 150_000)
    pages = spark.createDataFrame([(1, "http://a.org/" + "x/" * 100_000 + "login", long), (2, "http://a.org/" + "y" * 200_000, long), (3, None, None)], "page_id long, url string, html string").withColumn("host", F.lit("clash")).withColumn("digest", F.lit("clash"))
    got = {x.page_id: x for x in warc.read(warc.write(pages, warc.new_folder(pages), roll_mb=0.1)).collect()}
    assert got[2].record_type == "response" and (got[1].record_type, got[1].refers_to) == ("revisit", 2) and got[1].payload_bytes == len(long) and got[3].payload_bytes == 0
    judged = {x.page_id: x for x in urlrules.judge(pages).collect()}
    assert judged[1].verdict == "block" and judged[2].verdict == "allow" and judged[3].host == ""
    docs = spark.createDataFrame([(1, prose(8, 30_000) + " " + prose(70, 50) + " " + prose(9, 30_000))], SCHEMA).withColumn("words", F.lit("clash")).withColumn("row", F.lit(0))
    found = decontam.contaminated(docs, spark.createDataFrame([(5, prose(70, 50)), (5, prose(70, 50))], "item_id long, text string")).collect()
    assert [(x.doc_id, x.item_id, x.score, x.first_word, x.last_word) for x in found] == [(1, 5, 1.0, 30_000, 30_049)]


def test_warc_headers(spark):
    pages = spark.createDataFrame([(1, "http://a/", "z" * 2000), (2, "http://b/", "z" * 2000)], "page_id long, url string, html string")
    manifest = warc.write(pages, warc.new_folder(pages)).collect()
    with warc.files.opened(manifest[0].path) as f:
        info, revisit, response = list(warc.records(f))
    assert info[0]["WARC-Type"] == "warcinfo" and info[0]["WARC-Filename"].endswith(".warc.gz")
    assert response[0]["WARC-Type"] == "response" and response[1].startswith(b"HTTP/1.1 200 OK\r\n") and response[1].endswith(b"z" * 2000) and response[0]["Content-Type"] == "application/http; msgtype=response"
    assert revisit[0]["WARC-Refers-To"] == response[0]["WARC-Record-ID"] and revisit[0]["WARC-Refers-To-Target-URI"] == "http://b/" and revisit[0]["WARC-Profile"].endswith("identical-payload-digest")
    assert manifest[0].records == 2


def test_warc_rolls_by_written_bytes_and_splits_null_keys(spark):
    rows = [(None, f"http://a/{k}", prose(k, 150)) for k in range(400)] + [(k, f"http://b/{k}", prose(0, 400)) for k in range(600)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    manifest = warc.write(pages, warc.new_folder(pages), roll_mb=0.05).collect()
    sizes = [m.bytes for m in sorted(manifest, key=lambda m: m.file)]
    assert [m.file for m in sorted(manifest, key=lambda m: m.file)] == list(range(len(sizes)))
    assert max(sizes) < 1.15 * 0.05 * (1 << 20) and min(sizes[:-1]) > 0.8 * 0.05 * (1 << 20) and sum(m.records for m in manifest) == 1000


def test_warc_files_in_runs(spark):
    """With fewer runs than files a task writes several files, and all are as they are with a run for each."""
    pages = spark.createDataFrame([(None if k % 5 == 0 else k, f"http://a/{k % 7}", prose(k % 60, 40 + k % 30)) for k in range(400)], "page_id long, url string, html string")
    seen = []
    for runs in (10_000, 3, 1):
        manifest = warc.write(pages, warc.new_folder(pages), roll_mb=0.003, runs=runs)
        files = [(r.file, r.records, r.bytes, r["first"], r["last"]) for r in manifest.orderBy("file").collect()]
        seen.append((files, sorted((tuple(r) for r in warc.read(manifest).collect()), key=repr)))
    assert seen[0] == seen[1] == seen[2] and len(seen[0][0]) > 20


def test_frames_shared_by_items_bring_no_pairs(spark):
    """200 items of one frame and 2,000 documents with the frame: only documents that go on like an item meet it."""
    items = [(k, f"what is the name of item {k}") for k in range(200)]
    docs = [(k, f"{prose(k, 8)} what is the name of my dog {prose(k + 5000, 8)}") for k in range(2000)] + [(9000 + k, f"so what is the name of item {k} then") for k in range(0, 200, 20)]
    left, right = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, "item_id long, text string")
    named = decontam.numbered_items(right, 3, "item_id", "text").withColumn("item", F.xxhash64("words"))
    seeds = decontam.seeds_of(named, 4).cache()
    different = seeds.select("gram").distinct()
    near = decontam.near_texts(left, *decontam.bitmap(different, different.count()), 3, "doc_id", "text").cache()
    assert decontam.met(near, seeds, len(docs), 20.0, 0.25, 0.8, 1 << 20).count() < 200
    got = {(x.doc_id, x.item_id) for x in decontam.contaminated(left, right).collect()}
    assert got >= {(9000 + k, k) for k in range(0, 200, 20)} and len(got) < 50


@pytest.mark.parametrize("words", [12, 40])
def test_decontamination_recall_where_a_third_hold_one_item(spark, words):
    """Copies with every tenth to every third word changed, of one item in a third of all documents and of others in few."""
    r = random.Random(21)
    items = [(k, prose(7000 + k, words)) for k in range(10)]
    docs = []
    for k in range(900):
        text = prose(20_000 + k, 60).split()
        if k % 3 == 0 or k % 10 == 1:
            leak = items[0 if k % 3 == 0 else 1 + k % 9][1].split()
            for i in r.sample(range(words), r.randint(0, words // 4)):
                leak[i] = r.choice(["changed", "other", "words"])
            text[20:20] = leak
        docs.append((k, " ".join(text)))
    got = {(x.doc_id, x.item_id) for x in decontam.contaminated(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, "item_id long, text string")).collect()}
    parted = {i: decontam.words(t) for i, t in items}
    code = {w: k for k, w in enumerate({w for _, t in docs + items for w in decontam.words(t)})}
    hashed = lambda ws: np.array([code[w] for w in ws], np.int64)
    want = {(d, i) for d, t in docs for i, item in parted.items() if decontam.align(hashed(item), hashed(decontam.words(t)))[0] >= 0.5 * 2 * len(item)}
    assert got <= want and len(want) > 300
    assert len(got & want) >= 0.98 * len(want)


def test_items_in_common_and_repeated_items(spark):
    """Items whose n-grams are all held by many items, the same item under several ids and a null one."""
    frame = prose(3, 14).split()
    items = [(k, " ".join(frame[: 5 + k])) for k in range(9)] + [(100 + k, prose(8, 20)) for k in range(7)] + [(None, prose(8, 20))]
    docs = [(1, " ".join(frame)), (2, prose(8, 20)), (3, prose(9, 50))]
    got = {(x.doc_id, x.item_id) for x in decontam.contaminated(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert {(1, k) for k in range(9)} <= got and {(2, 100 + k) for k in range(7)} | {(2, None)} <= got
    assert not [d for d, _ in got if d == 3]


def test_quality_sample_is_bounded_by_rows(spark, monkeypatch):
    """One labelled id on 30,000 rows: at most max_train rows of statistics reach the driver."""
    seen = []
    monkeypatch.setattr(gbt_quality, "fit", lambda x, y, **more: seen.append(len(y)))
    rows = [(2, f"text {k % 20000} of many") for k in range(30_000)] + [(k, prose(k, 9)) for k in range(3, 300)] + [(3, None), (4, "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(300)], "doc_id long, quality int, toxic int")
    for most in (3, 1000):
        gbt_quality.train(docs, labels, max_train=most)
    gbt_quality.train(docs.where("doc_id = 2").withColumn("text", F.lit("same")), labels, max_train=3)
    gbt_quality.train(docs.limit(0), labels)
    gbt_quality.train(docs, labels.limit(0))
    assert 0 < seen[0] <= 3 and 500 < seen[1] <= 1000 and seen[2:] == [1, 0, 0]


def test_numerals_are_no_letters(spark):
    docs = spark.createDataFrame([(k, prose(k), "en") for k in range(30)] + [(k, "ñü " * k, "es") for k in range(30, 60)], "doc_id long, text string, lang string")
    model = ecoc_langid.train(docs)
    asked = spark.createDataFrame([(1, "½ ² 12"), (2, "ⅷ"), (3, "_ 7 \U0001f600"), (4, "ªa"), (5, "漢")], SCHEMA)
    assert [(x.doc_id, x.lang_pred == "und", x.score == 0) for x in ecoc_langid.predict(asked, model).orderBy("doc_id").collect()] == [(1, True, True), (2, True, True), (3, True, True), (4, False, False), (5, False, False)]


def test_more_languages_than_are_learned(spark):
    docs = spark.createDataFrame([(k * 7 + j, prose(k), f"l{k % 6}") for k in range(60) for j in range(1 + k % 6)], "doc_id long, text string, lang string")
    assert ecoc_langid.train(docs, max_languages=4).languages == ["l2", "l3", "l4", "l5"]


def test_token_store_with_many_null_and_repeated_keys(spark):
    """A third of the rows has no key, a third one key: they are dealt to many shards, and every row comes back from its place."""
    r = random.Random(4)
    rows = [(None if k % 3 == 0 else 7 if k % 3 == 1 else k, prose(r.randint(0, 40), r.randint(0, 30))) for k in range(1500)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("start", F.lit(1)).withColumn("h", F.lit("x"))
    manifest = tokenstore.write(docs, tokenstore.new_folder(docs), tokens.default_path())
    assert manifest.where("n > 0").count() >= 3 and manifest.agg(F.max("n")).first()[0] < 800
    got = tokenstore.read(manifest).collect()
    ids = expected_ids([t for _, t in rows])
    assert sorted(((x.doc_id, x.n_tokens, x.ids_crc32) for x in got), key=repr) == sorted(((k, len(i), zlib.crc32(i.tobytes())) for (k, _), i in zip(rows, ids, strict=True)), key=repr)
    at = 0
    for x in sorted(got, key=lambda x: x.start):
        assert x.start == at
        at += x.n_tokens


def test_packing_takes_the_fewest_sequences_of_all_scorings():
    r = random.Random(9)
    counts = {}
    for _ in range(3000):
        n = min(1024, int(r.lognormvariate(5, 1.2)) + 1)
        counts[n] = counts.get(n, 0) + 1
    used = lambda runs: len({b + k for _, _, n, b, _ in runs.tolist() for k in range(n)})
    capacity = (1024, 1024, 1024**2)
    every = [used(packing.plan(counts, capacity, w, kind)) for kind, w in packing.SCORINGS]
    best = used(packing.fewest(counts, capacity))
    assert best == min(every) and best <= 1 + -(-sum(k * n for k, n in counts.items()) // 1024)


def test_pivot_table_deals_the_nearest_pairs_of_the_pipeline(spark):
    """Pairs dealt by pivots join what all pairs within two bits join, equal fingerprints too, also in a crowd."""
    r = random.Random(5)
    seeds = [r.getrandbits(64) for _ in range(150)]
    codes = [s ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 3))) for s in seeds for _ in range(3)]
    codes += [seeds[0] ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(a)]
    wide = [c - (1 << 64) if c >> 63 else c for c in codes]
    made = jaccard.pivot_pairs(spark.createDataFrame(list(enumerate(wide)), "cid long, f1 long")).collect()
    assert all(x.a < x.b for x in made)

    def joined(pairs):
        low = list(range(len(codes)))
        for a, b in pairs:
            x, y = sorted((low[a], low[b]))
            if x != y:
                low = [x if v == y else v for v in low]
        return low

    assert joined((x.a, x.b) for x in made) == joined((a, b) for b in range(len(codes)) for a in range(b) if (codes[a] ^ codes[b]).bit_count() <= 2)


def test_shingle_counts_leave_no_text_out(spark):
    """Counters are those of all shingles of all texts, also where there are many texts and each shingle is rare among them."""
    texts = [f"one{k % 7000} two{k % 7000} three four five six{k}" for k in range(28_000)] + [None, "", "too short", prose(3, 5000)]
    got = jaccard.gram_counts(spark.createDataFrame(list(enumerate(texts)), SCHEMA).repartition(5), 5, "text")
    hashes, _ = jaccard.shingle_hashes(pa.array(texts), 5)
    assert got.sum() == len(hashes) == 2 * 28_000 + 1 + 4996
    assert (got == np.bincount((hashes % len(got)).astype(np.int64), minlength=len(got))).all()
    four = jaccard.shingle_hashes(pa.array(["one1 two1 three four five"]), 5)[0]
    alone = jaccard.shingle_hashes(pa.array(["two1 three four five six1"]), 5)[0]
    assert (jaccard.prefix(np.sort(np.append(four, alone)), got, 0.8)[0] == alone).all()


def test_what_texts_are_asked_is_no_broadcast(spark):
    """The items that texts meet grow with the texts, so they reach them by a shuffle, at any size; only numbers of texts are broadcast."""
    items = spark.createDataFrame([(k, prose(500 + k, 30)) for k in range(4)], "item_id long, text string")
    docs = spark.createDataFrame([(k, prose(k, 40) + " " + prose(500 + k % 4, 30) * (k % 2)) for k in range(80)], SCHEMA)
    found = decontam.contaminated(docs, items)
    assert sorted((x.doc_id, x.item_id) for x in found.collect()) == [(k, k % 4) for k in range(80) if k % 2]
    joins = re.findall(r"(\w+Join) \[row#\d+L\], \[row#\d+L\], (\w+)", found._jdf.queryExecution().executedPlan().toString())
    assert ("SortMergeJoin", "Inner") in joins and ("BroadcastHashJoin", "Inner") not in joins
