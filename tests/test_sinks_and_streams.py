"""Commits, guarded upserts, crash safety, maintained ranks and timed streams."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from pitpanel.operators import formulas, gates, lineage, versions
from pitpanel.operators.maintained import MaintainedRanks
from pitpanel.sources import snapshots
from pitpanel.sources.commits import Conflict, Items, Log
from pitpanel.streaming import increments, timely


def at(spark, tmp_path, name):
    return f"file://{tmp_path}/{name}"


def test_a_commit_number_is_taken_once(spark, tmp_path):
    one, other = (Log(spark, at(spark, tmp_path, "log")) for _ in range(2))
    assert one.last() == -1 and one.read() == {}
    one.commit(0, {"a": 1})
    with pytest.raises(Conflict):
        other.commit(0, {"a": 2})
    other.commit(1, {"a": 3})
    assert (one.last(), one.read(), one.read(0)) == (1, {"a": 3}, {"a": 1})


def items(spark, tmp_path):
    held = Items(spark, at(spark, tmp_path, "items"), "run", "k", "run string, k long, v long", 4)
    held.set_run("a", "provisional")
    held.set_run("b", "provisional")
    return held


def content(held):
    return sorted(tuple(r) for r in held.rows().select("run", "k", "v").collect())


def test_upserts_replace_rows_of_provisional_runs_only(spark, tmp_path):
    held = items(spark, tmp_path)
    batch = lambda *rows: spark.createDataFrame(rows, "run string, k long, v long")
    held.upsert(batch(("a", 1, 1), ("a", 2, 2), ("b", 1, 3)))
    held.upsert(batch(("a", 2, 20), ("b", 9, 9)))
    want = [("a", 1, 1), ("a", 2, 20), ("b", 1, 3), ("b", 9, 9)]
    assert content(held) == want
    held.set_run("b", "final")
    for bad in (batch(("a", 1, 7), ("b", 1, 7)), batch(("c", 1, 7)), batch(("a", 1, 7), ("a", 1, 8))):
        with pytest.raises(ValueError):
            held.upsert(bad)
    assert content(held) == want
    with pytest.raises(ValueError):
        held.set_run("b", "provisional")
    with pytest.raises(ValueError):
        held.set_run("new", "final")
    assert sorted(tuple(r) for r in held.rows(3).select("run", "k", "v").collect()) == want  # older commits stay readable


def test_of_two_writers_one_wins(spark, tmp_path, monkeypatch):
    """Another batch, or the end of the run, comes between a batch's check and its commit: the batch is refused and leaves no trace."""
    held, other = items(spark, tmp_path), Items(spark, at(spark, tmp_path, "items"), "run", "k", "run string, k long, v long", 4)
    rows = spark.createDataFrame([("a", 1, 1)], "run string, k long, v long")
    for meanwhile in (lambda: other.upsert(rows.withColumn("v", F.lit(5).cast("long"))), lambda: other.set_run("a", "final")):
        commit = held.log.commit

        def late(number, body, meanwhile=meanwhile, commit=commit):
            meanwhile()
            commit(number, body)

        monkeypatch.setattr(held.log, "commit", late)
        with pytest.raises(Conflict):
            held.upsert(rows)
        monkeypatch.setattr(held.log, "commit", commit)
        assert content(held) == [("a", 1, 5)]


def test_a_crash_before_the_commit_changes_nothing(spark, tmp_path, monkeypatch):
    view, rows = at(spark, tmp_path, "view"), spark.createDataFrame([(1, "a"), (2, "b")], "k long, d string")
    assert snapshots.put_view(rows, view, ["k", "d"]) == "written"
    path = at(spark, tmp_path, "features")
    long = spark.createDataFrame([(1, "h1", "f", 1.0, "derived"), (1, "h1", "g", None, "missing"), (2, "h2", "f", 2.0, "derived")], "k long, input_hash string, feature string, value double, status string")
    snapshots.put_features(long.where("k = 1"), path, ["k"], "input_hash")
    counts = lambda: tuple(df.count() for df in snapshots.feature_tables(spark, path))

    def broken(self, number, body):
        raise RuntimeError("the driver is lost")

    with monkeypatch.context() as m:
        m.setattr(Log, "commit", broken)
        with pytest.raises(RuntimeError):
            snapshots.put_view(rows.limit(1), view, ["k", "d"])
        with pytest.raises(RuntimeError):
            snapshots.put_features(long, path, ["k"], "input_hash")
    assert snapshots.view(spark, view).count() == 2 and counts() == (1, 2)
    assert snapshots.put_view(rows.limit(1), view, ["k", "d"]) == "written" and snapshots.view(spark, view).count() == 1
    for _ in range(2):
        snapshots.put_features(long, path, ["k"], "input_hash")
        assert counts() == (2, 3)


def ranked(rows):
    out = {}
    for cohort in {c for _, c, _ in rows}:
        own = sorted(v for _, c, v in rows if c == cohort and v is not None)
        for k, c, v in rows:
            if c == cohort:
                place = None if v is None else own.index(v) + 1 + (own.count(v) - 1) / 2
                out[k] = (c, v, None if v is None else 50.0 if len(own) == 1 else (place - 1) / (len(own) - 1) * 100)
    return out


def test_maintained_ranks_equal_a_full_run_and_read_touched_cohorts_only(spark, tmp_path):
    r = random.Random(3)
    rows = {k: (f"c{r.randint(0, 19)}", r.choice([None, 1.0, 2.0, r.random()])) for k in range(400)}
    held = MaintainedRanks(spark, at(spark, tmp_path, "ranks"), 64)
    held.full(spark.createDataFrame([(k, *v) for k, v in rows.items()], "key long, cohort string, value double"))
    read_all = set(held.log.read()["buckets"].values())
    for step in range(4):
        changes = []
        for k in r.sample(sorted(rows), 3) + [1000 + step]:
            before = rows.get(k, (None, None))[0]
            now = r.choice([None, "c3", "new"]) if before else "c5"
            value = r.random()
            changes.append((k, before, now, value))
            rows.pop(k, None)
            if now:
                rows[k] = (now, value)
        read = held.apply(spark.createDataFrame(changes, "key long, before string, cohort string, value double"))
        cohorts = {c for x in changes for c in x[1:3] if c}
        assert len(read) <= len(cohorts) and len(read) < len(read_all)
        got = {x.key: (x.cohort, x.value, x.percentile) for x in held.rows().collect()}
        want = ranked([(k, *v) for k, v in rows.items()])
        assert got.keys() == want.keys()
        for k in want:
            assert got[k][:2] == want[k][:2] and (got[k][2] == want[k][2] or got[k][2] == pytest.approx(want[k][2]))


T = dt.datetime(2024, 1, 1, tzinfo=dt.UTC)


def test_facts_wait_until_they_take_effect(spark, tmp_path):
    """Out of order, published long ago, without an effective instant, and with a restart between two runs."""
    hour = lambda h: T + dt.timedelta(hours=h)
    kind = "id long, arrived timestamp, effective timestamp"
    runs = [[(1, hour(1), hour(5)), (2, hour(2), hour(3)), (3, hour(2), hour(40)), (4, hour(3), None)], [(5, hour(10), hour(1)), (6, hour(9), hour(11)), (7, hour(12), hour(11))], [(8, hour(60), hour(61)), (9, hour(60), hour(59))]]
    landed, sink, mark = (at(spark, tmp_path, n) for n in ("landed", "sink", "mark"))
    seen = []
    for rows in runs:
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(landed)
        timely.usable_facts(increments.stream(spark, landed), sink, mark, ["id"], "arrived", "effective", "0 seconds", 2)
        seen.append(sorted(r.id for r in spark.read.parquet(sink).select("id").collect()))
    assert seen == [[], [1, 2, 5, 6, 7], [1, 2, 3, 5, 6, 7, 9]]


def test_frozen_view_survives_replayed_batches(spark, tmp_path):
    hour = lambda h: T + dt.timedelta(hours=h)
    landed, sink = at(spark, tmp_path, "landed"), at(spark, tmp_path, "sink")
    kind = "k long, v long, at timestamp"
    wants = []
    for rows in ([(1, 1, hour(1)), (2, 1, hour(1)), (3, 1, hour(30))], [(1, 2, hour(5)), (2, 2, hour(30))], [(1, 3, hour(31)), (4, 3, hour(2))]):
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(landed)
        timely.frozen_view(increments.stream(spark, landed), sink, at(spark, tmp_path, "mark"), ["k"], "at", "v", "2024-01-01 12:00:00")
        wants.append(sorted((r.k, r.v, r.carried) for r in timely.frozen(spark, sink).collect()))
    assert wants == [[(1, 1, False), (2, 1, False)], [(1, 2, False), (2, 1, True)], [(1, 2, True), (2, 1, True), (4, 3, False)]]
    timely.frozen_view(increments.stream(spark, landed), sink, at(spark, tmp_path, "lost-mark"), ["k"], "at", "v", "2024-01-01 12:00:00")
    assert sorted((r.k, r.v, r.carried) for r in timely.frozen(spark, sink).collect()) == wants[-1] and Log(spark, sink).last() == 2


def test_upserts_are_compacted(spark, tmp_path):
    landed, sink, mark = (at(spark, tmp_path, n) for n in ("landed", "sink", "mark"))
    last = {}
    for k in range(4):
        rows = [(i % 5, 10 * k + i, T + dt.timedelta(hours=10 * k + i)) for i in range(7)]
        last.update({i % 5: 10 * k + i for i in range(7)})
        spark.createDataFrame(rows, "k long, v long, at timestamp").coalesce(1).write.mode("append").parquet(landed)
        increments.latest_upsert(increments.stream(spark, landed), sink, mark, ["k"], "at", "v")
        if k in (1, 2):
            assert increments.compact(spark, sink, ["k"]) == 0
        assert {r.k: r.v for r in increments.current(spark, sink, ["k"]).collect()} == last
    assert Log(spark, sink).read()["upto"] == 2


@pytest.mark.parametrize(("rows", "state"), [
    ([("2024-01-01", None, "d", 1, "x")], "chosen"), ([("2024-01-01", None, "d", 1, "x"), ("2024-01-02", None, "d", 1, "y")], "chosen"), ([("2024-01-01", None, "d", 1, "x"), ("2024-01-01", None, "d", 1, "y")], "different_content"),
    ([("2024-01-01", None, "d", 1, "x"), ("2024-01-02", None, "t", 1, "y")], "incomparable"), ([("2024-01-01", None, "d", 1, "x"), ("2024-01-02", None, "t", 1, "x")], "chosen"), ([("2024-01-01", "2024-01-05", "d", 1, "x"), ("2024-01-02", "2024-01-04", "d", 1, "y")], "contradictory"),
    ([("2024-01-01", "2024-01-05", "d", 1, "x"), ("2024-01-01", None, "d", 2, "x")], "incomparable"),
])
def test_leading_versions(spark, rows, state):
    df = spark.createDataFrame([(1, *r) for r in rows], "k long, p string, u string, pr string, g long, c string").withColumns({"p": F.to_date("p"), "u": F.to_date("u")})
    assert versions.leading_versions(df, ["k"], "p", "u", "pr", "g", "c").first().state == state


def test_history_and_formula_shapes(spark):
    annual = lambda *ys: F.array(*(F.lit(f"{y}-12-31") for y in ys)) if ys else F.array().cast("array<string>")
    q8 = F.array(*(F.lit(q) for q in ("1998Q3", "1998Q4", "1999Q1", "1999Q2", "1999Q3", "1999Q4", "2000Q1", "2000Q2")))
    day = F.lit("2000-06-30").cast("date")
    cases = [(annual(1996, 1997, 1998, 1999), q8, False), (annual(1996, 1997, 1998, 1999), q8, True), (annual(1995, 1996, 1997, 1998, 1999), q8, True), (annual(1999, 1998), q8, False), (annual(1996, 1997, 1998, 1999, 2000), q8, False), (annual(1996, 1997, 1998, 1999), F.slice(q8, 2, 7), False)]
    got = spark.range(1).select(*(gates.history_blockers(a, q, day, F.lit(c)).alias(f"c{i}") for i, (a, q, c) in enumerate(cases))).first()
    late, short = "pending_evidence/history_not_mature", "history_annual_window_incomplete"
    assert list(got) == [[], [short, late], [], ["history_invalid_input", late], ["history_invalid_input", late], ["history_quarter_window_incomplete", late]]
    tree = {"op": "divide", "args": [("a", "FY1999"), {"op": "add", "args": [("b", "1999Q2"), 1.0, ("a", "FY1999")]}]}
    s = formulas.shape(tree)
    assert (s.leaves, s.operations, s.families, s.denominators) == ([("a", "FY1999"), ("b", "1999Q2")], {"divide", "add"}, {"FY", "quarter"}, {("b", "1999Q2"), ("a", "FY1999")})
    assert formulas.cells(("a", "1999Q4"), True) == [("a", 1999, "FY"), ("a", 1999, "Q3")] and formulas.cells(("a", "1999S1"), True) == []


def test_contexts_and_sources_refuse_what_is_absent(spark):
    one = spark.createDataFrame([(1, 5)], "k long, v long")
    with pytest.raises(ValueError, match="1 candidates have no fact"):
        lineage.built_context(spark.createDataFrame([(1,), (2,)], "k long"), one, ["k"], strict=True)
    with pytest.raises(ValueError, match="no rows: b"):
        lineage.required_union({"a": one, "b": one.limit(0)}, "k")


def test_a_task_sorts_a_bounded_number_of_rows(spark, monkeypatch):
    """Requests are dealt by how many lines there are, and landed files grow in number, not in size, with as many batches as before."""
    from pitpanel.functions import shared
    from pitpanel.plans import quality, streams

    monkeypatch.setattr(shared, "ROWS", 2000)
    monkeypatch.setattr(streams, "ROWS", 2000)
    spread = quality.page_groups(spark, "/root/testdata/sf0.01").groupBy(F.spark_partition_id()).agg(F.sum("pages").alias("n")).collect()
    assert max(r.n for r in spread) < 2 * 2000
    path, files = streams._landed(spark, spark.range(60_000))
    each = [r.n for r in spark.read.parquet(path).groupBy(F.input_file_name()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert files == 10 and len(each) == 30 and max(each) < 2 * 2000 and sum(each) == 60_000


def test_newest_generation_by_its_last_batch(spark, tmp_path):
    """Rows for a generation come in several batches; a request whose generation is unknown is kept, with its key."""
    landed, sink, mark = (at(spark, tmp_path, n) for n in ("landed", "sink", "mark"))
    for rows in ([(1, 1, 2), (1, 1, 2), (2, None, 1)], [(1, 2, 3)], [(1, 2, 3), (1, 1, 2)]):
        spark.createDataFrame(rows, "k long, g int, due long").coalesce(1).write.mode("append").parquet(landed)
        increments.page_counts(increments.stream(spark, landed), mark, sink, "k", "g", "due")
    got = sorted(tuple(r) for r in increments.newest_generations(spark, sink, "k", "g").select("k", "g", "pages", "due", "complete").collect())
    assert got == [(1, 2, 2, 3, False), (2, None, 1, 1, True)]
