"""Operators on small tables with values worked out by hand."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pitpanel.functions import exprs
from pitpanel.functions.redaction import redacted
from pitpanel.operators import audit, calendars, contracts, features, market, periods, policy, ranks, score, selection, versions
from pitpanel.sources import snapshots
from pitpanel.streaming import increments


def one(spark, **columns):
    return spark.range(1).select(*(c.alias(n) for n, c in columns.items())).first().asDict()


def test_percent_ranks_average_ties_and_a_single_value_is_50(spark):
    df = spark.createDataFrame([("a", -10.0), ("b", -10.0), ("c", 20.0), ("d", None)], "k string, v double")
    whole = {r["_v"]: (r["rank"], r.n) for r in ranks.count_ranks(ranks.value_counts(df, ["v"], []), []).collect()}
    assert whole == {-10.0: (1.5, 3), 20.0: (3.0, 3)}
    got = {r.k: (r.v_pct, r.v_scope) for r in ranks.with_fallback(df.withColumn("g", F.lit(1)), ["v"], "g", 20).collect()}
    assert got == {"a": (25.0, "table"), "b": (25.0, "table"), "c": (100.0, "table"), "d": (None, None)}
    single = ranks.with_fallback(df.where("k = 'c'").withColumn("g", F.lit(1)), ["v"], "g", 1).first()
    assert (single.v_pct, single.v_scope) == (50.0, "group")


@pytest.mark.parametrize(("n", "scope"), [(19, "coarse"), (20, "fine")])
def test_peer_cohorts_need_20_eligible_values(spark, n, scope):
    rows = [(k, "a", "x", float(k), True, True) for k in range(n)] + [(100 + k, "a", "y", float(k), True, True) for k in range(5)] + [(200, "a", "x", None, True, True), (201, "a", "x", 1.0, False, True)]
    df = spark.createDataFrame(rows, "k long, c string, f string, v double, ok boolean, up boolean")
    got = {r.k: r for r in ranks.peer_percentiles(df, "v", "ok", ["f"], ["c"], "up").collect()}
    assert got[3].scope == scope and got[3].peers == (n if scope == "fine" else n + 5)
    assert got[200].reason == got[201].reason == "not_eligible"
    if scope == "fine":
        assert got[3].percentile == pytest.approx(100 * 3.5 / 20)


def test_weighted_mean_renormalises_over_what_is_there(spark):
    v, there = ranks.weighted_available([(F.lit(25.0), 0.55), (F.lit(None).cast("double"), 0.45)])
    assert one(spark, v=v, there=there) == {"v": 25.0, "there": 0.55}


def test_pools_equal_the_greedy_scan(spark):
    """Two pools with their own orders and caps, ties, nulls, and three scans at once, against a loop over sorted rows."""
    import random

    r = random.Random(5)
    rows = []
    for per in ("a", "b", "c"):
        for k in range(400):
            pick = lambda *v: r.choice(v)
            rows.append((per, k, f"i{min(r.randint(0, 14), r.randint(0, 14))}", pick("strong", "wait", None), pick(70.0, 75.5, 80.25, r.random()), pick(0.75, 0.8), pick(50.0, None, 60.0), pick(66.0, 70.0, r.random()), pick(1.0, 2.0)))
    df = spark.createDataFrame(rows, "per string, k long, g string, pool string, Sc double, C double, R_safety double, B double, V double").repartition(7)
    got = {(x.per, x.k): (x.state, x.group_count, tuple(x.comparison)) for x in selection.selected(df, "k", "g", per=("per",)).collect()}
    want = {}
    for per in ("a", "b", "c"):
        for pool in (selection.STRONG, selection.WAIT):
            own = [dict(zip(df.columns, x, strict=True)) for x in rows if x[0] == per and x[3] == pool.name]
            place = lambda x: (*((x[n] is None, -(x[n] or 0)) for n in pool.order), x["k"])  # noqa: E731, B023
            counts, total = {}, 0
            for x in sorted(own, key=place):
                g = counts.get(x["g"], 0)
                state = "group_cap" if g >= pool.group_cap else "capacity" if total >= pool.capacity else "selected"
                if state == "selected":
                    counts[x["g"]], total, g = g + 1, total + 1, g + 1
                want[per, x["k"]] = (state, g, (*(x[n] for n in pool.order), x["k"]))
    assert got == want


def test_version_order_ties_and_blocked_keys(spark):
    t = lambda h: dt.datetime(2024, 1, 1, h)
    rows = [("a", 1, t(1), None, t(2), 5.0), ("a", 2, t(1), t(1), t(2), 6.0), ("b", 3, t(1), None, t(2), 5.0), ("b", 4, t(1), None, t(2), 7.0), ("c", 5, t(1), None, None, 5.0), ("c", 6, t(3), None, t(4), 5.0), ("d", 7, t(20), None, t(21), 5.0), ("e", 8, t(1), None, t(2), 5.0), ("e", 9, t(1), None, t(2), 5.0)]
    df = spark.createDataFrame(rows, "k string, id long, a timestamp, u timestamp, f timestamp, v double")
    got = {r.k: (r.state, r.id, r.v) for r in versions.visible_versions(df, ["k"], "a", "u", "f", ["v"], F.lit(t(12)), "id").collect()}
    assert got == {"a": ("chosen", 2, 6.0), "b": ("conflict", None, None), "c": ("unknown_fetch", None, None), "e": ("chosen", 9, 5.0)}


def test_newest_invalid_row_is_not_replaced(spark):
    df = spark.createDataFrame([("a", 1, True), ("a", 2, False)], "k string, at int, ok boolean")
    got = versions.as_of_newest(df, ["k"], "at", F.lit(5), F.col("ok"), "at").first()
    assert (got["at"], got.valid) == (2, False)


def test_carried_forward_rows(spark):
    mk = lambda rows: spark.createDataFrame(rows, "k string, v int")
    out = versions.carried_forward(mk([("a", 1)]), mk([("a", 1), ("b", 9)]), mk([("b", 2), ("c", 3)]), ["k"])
    assert {(r.k, r.v, r.carried) for r in out.collect()} == {("a", 1, False), ("b", 2, True)}


def test_dates_and_sessions(spark):
    got = one(spark, close=exprs.business_instant(F.lit("2024-01-05 15:00:00")), end=exprs.business_instant(F.lit("2024-01-05"), end_of_day=True), bad=exprs.business_instant(F.lit("5 Jan")), kind=exprs.period_kind(F.lit("2024-06-30").cast("date")), rep=exprs.report_date(F.lit("2024-06-30 00:00:00")), no=exprs.report_date(F.lit("2024-06-30 00:00:01")), sat=exprs.session_date(F.lit("2024-01-07 16:00:00").cast("timestamp")))
    assert got["close"] == dt.datetime(2024, 1, 5, 7) and got["end"] == dt.datetime(2024, 1, 5, 15, 59, 59) and got["bad"] is None
    assert (got["kind"], got["rep"], got["no"], got["sat"]) == ("H1", dt.date(2024, 6, 30), None, dt.date(2024, 1, 5))


def test_next_session_is_strictly_after(spark):
    days = spark.createDataFrame([(dt.date(2024, 1, d), d not in (6, 7)) for d in range(1, 10)], "day date, open boolean")
    got = {r.day.day: r.next_session and r.next_session.day for r in calendars.next_session(days, "day", F.col("open")).collect()}
    assert got == {1: 2, 2: 3, 3: 4, 4: 5, 5: 8, 6: 8, 7: 8, 8: 9, 9: None}


def test_ranges_are_cut_greedily_from_the_newest_day(spark):
    days = spark.createDataFrame([("x", dt.date(2024, 1, d)) for d in (1, 2, 5, 9, 10, 11)], "k string, day date")
    got = sorted((r.part, r.start.day, r.end.day) for r in calendars.ranges(days, "k", "day", 3).collect())
    assert got == [(0, 9, 11), (1, 5, 5), (2, 1, 2)]


def test_quarters_and_runs(spark):
    df = spark.createDataFrame([("a", 2024, 1, 10.0), ("a", 2024, 2, 25.0), ("a", 2024, 4, 60.0)], "k string, y int, q int, v double")
    got = {r.q: (r.quarter_value, r.reason) for r in periods.single_quarters(df, ["k"], "y", "q", "v").collect()}
    assert got == {1: (10.0, None), 2: (15.0, None), 4: (None, "previous_missing")}
    years = spark.createDataFrame([("a", y) for y in (2018, 2020, 2021, 2022)] + [("b", 2022)], "k string, y int")
    assert {r.k: r.run_years for r in periods.latest_run(years, ["k"], "y").collect()} == {"a": 3, "b": 1}


def test_statement_formulas(spark):
    x = {k: F.lit(v) for k, v in {"revenue": 100.0, "cost": 60.0, "profit": 20.0, "interest": 2.0, "tax": 40.0, "short_debt": 5.0, "long_debt": 7.0, "equity": 30.0, "cash": 4.0, "operating_cash": 9.0, "investment": 3.0, "receivables": 6.0, "inventory": 8.0, "payables": 5.0, "net_profit": 11.0}.items()}
    got = one(spark, **features.derived(x))
    assert (got["gross_profit"], got["tax_rate"], got["nopat"], got["net_debt"], got["invested_capital"], got["accruals"]) == (40.0, 0.5, 11.0, 8.0, 38.0, 2.0)
    none = one(spark, **features.derived(x | {"tax": F.lit(None).cast("double")}))
    assert none["tax_rate"] is None and none["nopat"] is None and none["gross_profit"] == 40.0


def test_formula_trees(spark):
    facts = {"a": F.lit(1.0), "b": F.lit(5.0), "c": F.lit(3.0), "z": F.lit(0.0), "n": F.lit(None).cast("double")}
    run = lambda node: one(spark, v=features.compiled(node, facts))["v"]
    assert run({"op": "median", "args": ["a", "b", "c"]}) == 3.0 and run({"op": "median", "args": ["a", "b"]}) == 3.0
    assert run({"op": "minimum", "args": ["b", "c"]}) == 3.0 and run({"op": "minimum", "args": ["b", "n"]}) is None
    assert run({"op": "divide", "args": ["a", "z"]}) is None and run({"op": "cagr", "args": ["a", "b"], "years": 1}) == pytest.approx(400.0)
    assert features.leaves({"op": "add", "args": ["a", {"op": "add", "args": ["b", "a", 2]}]}) == ["a", "b"]


@pytest.mark.parametrize(("idle", "veto", "price", "stale"), [(0, "clear", "found", 0), (1, "clear", "found", 1), (19, "clear", "found", 19), (20, "proven", "found", 20), (249, "proven", "found", 249), (250, "proven", "no_value", None)])
def test_activity_windows_at_their_edges(spark, idle, veto, price, stale):
    days = [("k", d, "active" if d == 300 - idle else "inactive", 7.0) for d in range(301)]
    df = spark.createDataFrame(days, "k string, d int, st string, v double")
    got = market.activity(df, ["k"], "d", F.col("st"), "v").where("d = 300").first()
    assert (got.veto, got.price_state, got.stale_days) == (veto, price, stale)


def test_an_unknown_day_blocks_the_value_only_if_it_is_newer(spark):
    def last(states):
        df = spark.createDataFrame([("k", d, s, float(d)) for d, s in enumerate(states)], "k string, d int, st string, v double")
        return market.activity(df, ["k"], "d", F.col("st"), "v", 3, 10).orderBy(F.desc("d")).first()

    newer = last(["active", None, "inactive", "inactive", "inactive"])
    assert (newer.veto, newer.price_state) == ("proven", "incomplete")
    older = last([None, "active", "inactive"])
    assert (older.price_state, older.last_value, older.stale_days) == ("found", 1.0, 1)


def test_quantiles_and_three_valued_rules(spark):
    five = F.array(*(F.lit(float(v)) for v in (50, 10, 40, 20, 30)))
    got = one(spark, near=policy.nearest_rank(five, 0.8), linear=policy.linear_quantile(five, 0.8), basis=policy.profit_basis(F.lit(45.0), five), hole=policy.linear_quantile(F.array(F.lit(1.0), F.lit(None).cast("double")), 0.5))
    assert got == {"near": 40.0, "linear": 42.0, "basis": 30.0, "hole": None}
    unknown = F.array().cast("array<double>")
    rules = one(spark, clears=policy.cyclic([(F.lit(1.0), five), (F.lit(1.0), unknown)]), waits=policy.cyclic([(F.lit(99.0), five), (F.lit(1.0), unknown)]), hits=policy.cyclic([(F.lit(99.0), five)]))
    assert rules == {"clears": "clear", "waits": "pending", "hits": "matched"}


HAND = {"G": 80.0, "V": 70.0, "M": 60.0, "EQ": 50.0, "FS": 40.0, "CA": 90.0, "T": 30.0}


def test_score_arithmetic_by_hand(spark):
    risk = dict(zip(score.RISK_SLOTS, map(F.lit, (70.0, 50.0, 60.0, 80.0)), strict=True))
    got = one(spark, **score.arithmetic({n: F.lit(v) for n, v in HAND.items()}, F.lit(1.0), risk))
    want = {"S0": 64.40, "Sc": 64.40, "Sbase": 68.222222, "B": 68.222222, "M_persistence": 61.428571, "CA_downside": 68.571429, "R_safety": 51.071429, "risk_exposure": 48.928571}
    assert got == pytest.approx(want, abs=1e-6)
    shrunk = one(spark, **score.arithmetic({n: F.lit(v) for n, v in HAND.items()}, F.lit(0.6), risk))
    assert shrunk["Sc"] == pytest.approx(50 + 0.6 * 14.4) and shrunk["R_safety"] == pytest.approx(want["R_safety"], abs=1e-6)
    assert sum(score.WEIGHTS.values()) == pytest.approx(1) and all(sum(w for _, w in own) == pytest.approx(1) for own in score.SLOTS.values())
    assert [len(own) for own in score.SLOTS.values()] == [4, 3, 3, 4, 3, 4, 4]


@pytest.mark.parametrize(("quality", "years", "cap", "want"), [(0.8, 4, None, 0.96), (1.0, 4, None, 0.98), (0.8, 5, None, 0.98), (1.0, 5, None, 1.0), (0.995, 4, 0.90, 0.90), (None, 5, 0.90, None)])
def test_confidence_by_hand(spark, quality, years, cap, want):
    got = one(spark, **score.confidence(F.lit(quality).cast("double"), F.lit(years), F.lit(cap).cast("double")))
    assert got["C"] == (None if want is None else pytest.approx(want)) and got["H"] == pytest.approx(years / 5) and got["D"] == got["K"] == 1


def test_dimensions_quality_and_branches(spark):
    slots = spark.createDataFrame([("k", "G", 0.5, 10.0), ("k", "G", 0.5, 30.0), ("k", "V", 0.5, 10.0), ("k", "V", 0.5, None)], "k string, d string, w double, v double")
    assert {r.d: r.score for r in score.dimension_scores(slots, ["k"], "d", "w", "v").collect()} == {"G": 20.0, "V": None}
    evidence = spark.createDataFrame([("a", "timestamp"), ("a", "date_only"), ("b", "timestamp"), ("c", "about"), ("c", "timestamp")], "k string, p string")
    assert {r.k: r.quality for r in score.temporal_quality(evidence, ["k"], "p").collect()} == {"a": 0.8, "b": 1.0, "c": None}
    bands = one(spark, a=exprs.grade(F.lit(90.0)), b=exprs.grade(F.lit(89.999999)), e=exprs.grade(F.lit(1.0)), n=exprs.grade(F.lit(None).cast("double")))
    assert bands == {"a": "A+", "b": "A", "e": "E", "n": None}
    caps = spark.createDataFrame([("k", "G", 15.0), ("k", "G", 12.0)], "k string, dimension string, cap double")
    rows = spark.createDataFrame([("k", "G", 20.0), ("k", "V", 7.0), ("k", "M", None)], "k string, dimension string, score double")
    assert {r.dimension: r.capped for r in score.capped(rows, caps, ["k"]).collect()} == {"G": 12.0, "V": 7.0, "M": None}
    text = lambda v: F.lit(v).cast("string")
    branch = lambda linked, status, none, n: one(spark, b=score.consensus_branch(F.lit(linked), text(status), F.lit(none), F.lit(n)))["b"]
    assert [branch(False, None, None, None), branch(True, None, None, None), branch(True, "no_valid_coverage", True, 0), branch(True, "covered", False, 2), branch(True, "covered", False, 0), branch(True, "no_valid_coverage", False, 0)] == ["unlinked", "absent", "neutral", "covered", "malformed", "malformed"]


def test_grouped_ranks_of_a_hot_group_equal_plain_ones(spark):
    import random

    r = random.Random(4)
    rows = [(k, None if k % 50 == 0 else "hot" if k % 3 else f"g{k % 7}", None if k % 11 == 0 else float(r.randint(0, 40))) for k in range(600)]
    df = spark.createDataFrame(rows, "k long, g string, v double")
    counts = ranks.value_counts(df, ["v"], ["g"])
    window, dealt = ({(x.g, x["_v"]): (x["rank"], x.n) for x in ranks.count_ranks(counts, ["g"], 8, most).collect()} for most in (1000, 0))
    assert window == dealt
    for g in {x[1] for x in rows}:
        own = sorted(x[2] for x in rows if x[1] == g and x[2] is not None)
        for v in set(own):
            assert window[g, v] == (own.index(v) + 1 + (own.count(v) - 1) / 2, len(own))


def test_identities_facts_and_evidence(spark):
    error = lambda a, b, e: one(spark, x=contracts.identity_error(F.lit(a).cast("string"), F.lit(b).cast("string"), F.lit(e)))["x"]
    assert [error("600000", "600000.SH", "SH600000"), error("600000", None, "SH600000"), error("", "000001.SZ", "SZ000001"), error(None, "", "SH600000"), error("60000", None, "SH600000"), error("600000", "600000.XX", "SH600000"), error("600000", "600001.SH", "SH600000"), error("600001", None, "SH600000")] == [None, None, None, "missing", "invalid", "invalid", "mismatch", "mismatch"]
    good = dict(statement="income", nature="duration", period_kind="H1", period_start=dt.date(2024, 1, 1), period_end=dt.date(2024, 6, 30), value=1.0, unit="CNY", announced_at=dt.datetime(2024, 8, 1), updated_at=None, effective_at=dt.datetime(2024, 8, 1))
    schema = "statement string, nature string, period_kind string, period_start date, period_end date, value double, unit string, announced_at timestamp, updated_at timestamp, effective_at timestamp"
    broken = lambda **change: spark.createDataFrame([tuple({**good, **change}.values())], schema).select(contracts.fact_violations().alias("b")).first().b
    assert broken() == [] and broken(nature="instant") == ["statement", "start"] and broken(statement="balance", nature="instant", period_start=None) == []
    assert broken(period_kind="FY", unit="USD", value=float("inf")) == ["period_kind", "value", "unit"] and broken(updated_at=dt.datetime(2024, 8, 2)) == ["effective"]
    assert broken(period_start=dt.date(2024, 4, 1)) == ["start"] and broken(nature=None) == ["nature", "statement"]
    at = F.lit("2024-01-01 00:00:00").cast("timestamp")
    why = lambda url, precision, binding: one(spark, x=contracts.evidence_reasons(F.lit(url), ["a.org"], F.lit(True), at, at, at, F.lit(precision), F.lit(binding).cast("string")))["x"]
    assert why("https://A.org/x", "timestamp", None) == [] and why("http://b.org", "date_only", None) == ["calendar_binding_missing", "host_not_allowed", "not_https"] and why("https://a.org", "timestamp", "c") == ["calendar_binding_forbidden"]
    status = lambda *x: one(spark, s=contracts.universe_status(F.lit(x[0]), F.lit(x[1]), F.array(*map(F.lit, x[2]))))["s"]
    assert [status(False, False, ["v"]), status(True, False, ["v"]), status(True, True, ["v"]), status(True, True, [])] == ["out_of_scope", "pending_evidence", "pool_vetoed", "formal_scored"]


def test_market_gate_lists_errors_in_order(spark):
    rows = spark.createDataFrame([("a", "d", None), ("a", "d", "market_missing_close"), (None, "e", None), ("x", "d", None)], "k string, day string, error string")
    universe = spark.createDataFrame([("a",), ("b",)], "k string")
    got = contracts.market_gate(rows, universe, "k", "day", "error", "d").first()
    assert (got.records, got.universe, got.covered) == (4, 2, 1)
    assert got.errors == ["market_duplicate_security", "market_outside_universe", "market_incomplete_universe", "market_wrong_date", "market_missing_close"]
    fine = contracts.market_gate(universe.withColumn("day", F.lit("d")).withColumn("error", F.lit(None).cast("string")), universe, "k", "day", "error", "d").first()
    assert fine.errors == [] and fine.covered == 2


REDACTED = [
    ("see https://a.b/c/d and /home/x/y.txt, C:\\Users\\me\\f.txt \\\\srv\\share\\x //srv/s/x", "see https://a.b/c/d and [path], [path] [path] [path]"),
    ("https://u:p@h/x Authorization: Bearer abc.d basic Zm9v=", "[credential] Authorization: Bearer [credential] basic [credential]"),
    ("{\"api_key\": \"s3\", 'token':'x y, z'} password=hunter2; ok a/b 1/2", "{\"api_key\": \"[credential]\", 'token':'[credential]'} password=[credential]; ok a/b 1/2"),
    ('{"password": "two words, and more", "user": "bob"}', '{"password": "[credential]", "user": "bob"}'),
    ("http://x.y/z,/opt/q (/var/z) key:/no", "http://x.y/z,[path] ([path]) key:[path]"),
    ("password : hunter2 next\nMY-SECRET=\nx y", "password : [credential] next\nMY-SECRET=\n[credential] y"),
    ("https://h/x?q=1&access_token=zz done https://h/x?q=1", "https://h/x?[credential] done https://h/x?q=1"),
    ("path=/etc/passwd file:///etc/x ~/notes / // a and/or", "path=[path] [path] [path] / // a and/or"),
    ("authorization=Basic QWxh Cookie: a=b; c", "authorization=Basic [credential] Cookie: [credential]; c"),
    ("my secret is safe, the token, too", "my secret is safe, the token, too"),
    ("  spaced  \n text ", "spaced  \n text"),
    ("\u00e9" * 300, "\u00e9" * 240),
    ("/a " * 200, ("[path] " * 200)[:240]),
    ("", ""),
    (None, None),
]


def test_redaction_by_cases(spark):
    rows = spark.createDataFrame(list(enumerate(t for t, _ in REDACTED)), "k long, t string").select("k", redacted("t").alias("r")).collect()
    assert {x.k: x.r for x in rows} == {k: r for k, (_, r) in enumerate(REDACTED)}


def test_redaction_lets_no_planted_secret_through(spark):
    """Secrets in many dresses between plain words: none survives, and all plain words and public URLs do."""
    import random

    r, rows = random.Random(3), []
    dress = ["password={}", "token: {}", '"apiKey" : "{}"', "Bearer {}", "Authorization: Basic {}", "https://me:{}@host/x", "client-secret={}", "'access_key':'{} tail{}'", "/home/{}/file", "C:\\dir\\{}", "\\\\host\\{}\\z", "https://host/q?token={}", "x=/var/{}"]
    for k in range(300):
        plain = [f"word{k}", "and/or", f"https://public.org/page{k}", "1/2", "n=3"]
        secret = f"zq{k}zq"
        text = " ".join([*plain[: k % 5], r.choice(dress).replace("{}", secret), *plain[k % 5 :]])
        rows.append((text, secret, plain))
    got = spark.createDataFrame([(k, t) for k, (t, _, _) in enumerate(rows)], "k long, t string").select("k", redacted("t", 400).alias("r")).collect()
    for x in got:
        text, secret, plain = rows[x.k]
        assert secret not in x.r and all(p in x.r.split() for p in plain), (text, x.r)


def test_sinks_run_twice(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a", 5), (2, "b", 6), (2, "b", 6)], "k long, d string, v long")
    for _ in range(2):
        snapshots.append_new(rows, f"file://{tmp_path}/log", ["k"], ["d"])
    assert spark.read.parquet(f"file://{tmp_path}/log").count() == 2
    view = f"file://{tmp_path}/view"
    assert [snapshots.put_view(x, view, ["k", "v"]) for x in (rows, rows.orderBy(F.desc("k")), rows.where("k = 1"))] == ["written", "unchanged", "written"]
    assert snapshots.view(spark, view).count() == 1
    ordered = snapshots.write_ordered(spark.range(100).select((F.col("id") * 37 % 100).alias("x")), f"file://{tmp_path}/ordered", [F.desc("x")]).collect()
    assert sorted((r.position, r.x) for r in ordered) == [(k, 99 - k) for k in range(100)]
    with pytest.raises(ValueError, match="empty"):
        snapshots.not_empty(rows.limit(0), "x")


def test_cleaning_expressions(spark):
    got = one(spark, a=exprs.number(F.lit(" 1,234.5% ")), b=exprs.number(F.lit("1e400")), c=exprs.number(F.lit("NaN")), d=exprs.code6(F.lit("sh.600000")), e=exprs.code6(F.lit("1.0")), f=exprs.code6(F.lit("1234567")), g=exprs.share(F.lit(85.0)), h=exprs.share(F.lit(101.0)), i=exprs.decimal_text(F.lit("12.500").cast("decimal(10,3)")), j=exprs.decimal_text(F.lit("100").cast("decimal(10,0)")), k=redacted(F.lit("Bearer abc.def  token=xyz see /home/me/x https://a.org/b")), m=exprs.session_date(F.lit("2024-01-08 09:00:00").cast("timestamp")))
    assert (got["a"], got["b"], got["c"], got["d"], got["e"], got["f"], got["g"], got["h"], got["i"], got["j"]) == (1234.5, None, None, "600000", "000001", None, 0.85, None, "12.5", "100")
    assert got["k"] == "Bearer [credential]  token=[credential] see [path] https://a.org/b" and got["m"] == dt.date(2024, 1, 5)


def test_flags_absent_is_not_false(spark):
    flags = lambda *f: F.array(*(F.struct(F.lit(n).alias("flag_id"), F.lit(v).alias("active")) for n, v in f))
    got = one(spark, a=exprs.flag_state(flags(("x", True)), "x"), b=exprs.flag_state(flags(("x", False)), "x"), c=exprs.flag_state(flags(("y", True)), "x"), d=exprs.flag_state(flags(("x", True), ("x", True)), "x"))
    assert got == {"a": "active", "b": "inactive", "c": "absent", "d": "duplicate"}


def test_closure_ready_and_matches(spark):
    edges = spark.createDataFrame([(2, 1), (3, 2), (4, 3), (6, 5)], "node long, needs long")
    got = {r.node: r.distance for r in audit.blocked_closure(edges, spark.createDataFrame([(1,)], "node long")).collect()}
    assert got == {1: 0, 2: 1, 3: 2, 4: 3}
    nodes = spark.createDataFrame([(k,) for k in range(1, 7)], "node long")
    done = spark.createDataFrame([(1,), (5,)], "node long")
    assert {r.node for r in audit.ready(edges, done, nodes).collect()} == {2, 6}


def test_fingerprint_ignores_order_but_not_repeats(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, "")], "k int, v string")
    mark = lambda d: audit.fingerprint(d, ["k", "v"]).first().fingerprint
    assert mark(df) == mark(df.repartition(5).orderBy(F.desc("k"))) != mark(df.unionByName(df.limit(1)))


def test_envelopes_are_verified(spark, tmp_path):
    good = spark.createDataFrame([("s", "d", "r", "t", "body")], "source string, dataset string, request string, fetched_at string, payload string").withColumn("digest", F.sha2("payload", 256))
    good.unionByName(good.withColumn("digest", F.lit("bad"))).write.json(f"{tmp_path}/e")
    ok, bad = snapshots.split_verified(snapshots.read_envelopes(spark, f"{tmp_path}/e"))
    assert (ok.count(), bad.count()) == (1, 1)
    with pytest.raises(ValueError, match="missing columns: b"):
        snapshots.required(spark.createDataFrame([(1,)], "a int"), {"a": "x", "b": "y"})
    clean, held = snapshots.sanitized(spark.createDataFrame([("x", float("nan")), ("<HTML>", 1.0)], "t string, n double"), ["t"], ["n"])
    assert [tuple(r) for r in clean.collect()] == [("x", None)] and held.count() == 1


def test_a_second_streaming_run_adds_nothing(spark, tmp_path):
    rows = spark.range(50).select((F.col("id") % 20).alias("k"))
    rows.repartition(3).write.parquet(f"{tmp_path}/in")
    counts = []
    for _ in range(2):
        increments.unique_append(increments.stream(spark, f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/mark", ["k"])
        counts.append(spark.read.parquet(f"{tmp_path}/out").count())
    spark.range(15, 25).select(F.col("id").alias("k")).write.mode("append").parquet(f"{tmp_path}/in")
    increments.unique_append(increments.stream(spark, f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/mark", ["k"])
    counts.append(spark.read.parquet(f"{tmp_path}/out").count())
    assert counts == [20, 20, 25]
