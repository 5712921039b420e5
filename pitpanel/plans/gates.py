"""Queries of the quality and final gates, history maturity, period formulas, rebuilt facts and report tables."""

from pyspark.sql import functions as F

from pitpanel.operators import contracts, formulas, gates

from .base import YEARS, query, supplier_years, table
from .contracts import _market_rows

GATE_SQL = """WITH c AS (SELECT c_nationkey % 5 AS part, c_custkey AS k, * FROM customer), u AS (SELECT part, k FROM c WHERE NOT (part = 4 AND k % 9 = 1) UNION ALL SELECT part, k FROM c WHERE part = 4 AND k % 20 = 2),
p0 AS (SELECT part, k, CASE WHEN part = 4 AND k % 2 = 0 THEN NULL ELSE c_acctbal END AS a, c_mktsegment AS b, CASE WHEN part = 2 AND k % 6 = 0 THEN '  ' WHEN part = 3 AND k % 30 = 3 THEN 'soon' WHEN part = 3 AND k % 30 = 8 THEN '2024-07-01' WHEN part = 3 AND k % 30 = 13 THEN '2024-06-30 20:00:01' WHEN k % 3 = 0 THEN '2024-06-30' ELSE '2024-06-30 19:59:59' END AS t FROM c),
p AS (SELECT * FROM p0 UNION ALL SELECT * FROM p0 WHERE part = 1 AND k % 50 = 1),
f AS (SELECT *, try_cast(t AS TIMESTAMP) AS x, regexp_full_match(trim(t), '\\d{4}-\\d{2}-\\d{2}') AS bare FROM p),
r AS (SELECT part, count(*) AS rows, count(DISTINCT k) AS d, count(a) + count(b) AS cells, count(*) FILTER (WHERE trim(t) = '') AS announcement_missing, count(*) FILTER (WHERE trim(t) <> '' AND x IS NULL) AS announcement_unparseable, count(*) FILTER (WHERE CASE WHEN bare THEN CAST(x AS DATE) > DATE '2024-06-30' ELSE x > TIMESTAMP '2024-06-30 20:00:00' END) AS announcement_future FROM f GROUP BY 1),
v AS (SELECT part, count(DISTINCT k) AS eligible, count(*) - count(DISTINCT k) AS universe_duplicates FROM u GROUP BY 1),
o AS (SELECT p.part, count(DISTINCT p.k) FILTER (WHERE u.k IS NULL) AS outside, count(DISTINCT p.k) FILTER (WHERE u.k IS NOT NULL) AS disclosed FROM p LEFT JOIN u ON u.part = p.part AND u.k = p.k GROUP BY 1),
g AS (SELECT part, eligible, universe_duplicates, disclosed, outside, rows - d AS duplicates, rows, announcement_missing, announcement_unparseable, announcement_future, cells / (2.0 * rows) AS completeness, disclosed / eligible AS coverage FROM r JOIN v USING (part) JOIN o USING (part)),
q AS (SELECT *, concat_ws(',', CASE WHEN completeness < 0.95 THEN 'completeness' END, CASE WHEN coverage < 0.95 THEN 'coverage' END, CASE WHEN duplicates > 0 THEN 'duplicates' END, CASE WHEN universe_duplicates > 0 THEN 'universe_duplicates' END, CASE WHEN outside > 0 THEN 'outside' END, CASE WHEN announcement_missing > 0 THEN 'announcement_missing' END, CASE WHEN announcement_unparseable > 0 THEN 'announcement_unparseable' END, CASE WHEN announcement_future > 0 THEN 'announcement_future' END) AS failed FROM g)"""


def _gate(spark, sf_dir, as_of="2024-06-30 20:00:00", cutoff="2024-06-30 18:00:00"):
    """Customers in five parts, one of them clean and each other with faults of its own."""
    c = table(spark, sf_dir, "customer").select((F.col("c_nationkey") % 5).alias("part"), F.col("c_custkey").alias("k"), "c_acctbal", "c_mktsegment")
    k, part = F.col("k"), F.col("part")
    universe = c.where(~((part == 4) & (k % 9 == 1))).unionByName(c.where((part == 4) & (k % 20 == 2))).select("part", "k")
    text = F.when((part == 2) & (k % 6 == 0), "  ").when((part == 3) & (k % 30 == 3), "soon").when((part == 3) & (k % 30 == 8), "2024-07-01").when((part == 3) & (k % 30 == 13), "2024-06-30 20:00:01").when(k % 3 == 0, "2024-06-30").otherwise("2024-06-30 19:59:59")
    rows = c.select("part", "k", F.when(~((part == 4) & (k % 2 == 0)), F.col("c_acctbal")).alias("a"), F.col("c_mktsegment").alias("b"), text.alias("t"))
    rows = rows.unionByName(rows.where((part == 1) & (k % 50 == 1)))
    return gates.quality_gate(universe, rows, "k", ["a", "b"], "t", as_of, cutoff, ["part"])


@query("A2 A1", GATE_SQL + " SELECT part, eligible, CAST(universe_duplicates AS BIGINT) AS universe_duplicates, disclosed, outside, duplicates, rows, announcement_missing, announcement_unparseable, announcement_future, round(completeness, 6) AS completeness, round(coverage, 6) AS coverage, failed, CASE WHEN failed = '' THEN 'data_ready' ELSE 'failed' END AS status FROM q")
def quality_gate(spark, sf_dir):
    """All checks of the disclosure gate, for five parts of the customers."""
    out = _gate(spark, sf_dir).drop("latest")
    return out.withColumns({"failed": F.array_join("failed", ","), "completeness": F.round("completeness", 6), "coverage": F.round("coverage", 6)})


MARKET_SQL = """, mt AS (SELECT event_id, CASE WHEN event_id % 401 = 9 THEN NULL ELSE user_id + CASE WHEN event_id % 503 = 11 THEN 1000000 ELSE 0 END END AS user_id, CASE WHEN event_id % 307 = 2 THEN '2024-01-01' ELSE '2024-01-31' END AS day, CASE WHEN event_id % 13 = 5 THEN '0' WHEN event_id % 701 = 6 THEN '?' ELSE ' TRUE ' END AS st, CASE WHEN event_id % 17 = 8 THEN NULL ELSE value END AS cl, CASE WHEN event_id % 19 = 3 THEN NULL ELSE value + 1 END AS pre FROM events),
mr AS (SELECT *, CASE WHEN st = '?' THEN 'market_invalid_tradestatus' WHEN st = '0' AND pre IS NULL OR st = ' TRUE ' AND cl IS NULL THEN 'market_missing_close' END AS err FROM mt), mu AS (SELECT DISTINCT user_id FROM events), ms AS (SELECT user_id, count(*) AS n FROM mr WHERE user_id IS NOT NULL GROUP BY 1),
me AS (SELECT array_to_string(list_filter([CASE WHEN (SELECT count(*) FROM ms WHERE n > 1) > 0 THEN 'market_duplicate_security' END, CASE WHEN (SELECT count(*) FROM ms WHERE user_id NOT IN (SELECT user_id FROM mu)) + (SELECT count(*) FROM mr WHERE user_id IS NULL) > 0 THEN 'market_outside_universe' END, CASE WHEN (SELECT count(*) FROM mu WHERE user_id NOT IN (SELECT user_id FROM ms)) > 0 THEN 'market_incomplete_universe' END, CASE WHEN (SELECT count(*) FROM mr WHERE day <> '2024-01-31') > 0 THEN 'market_wrong_date' END] || list_sort((SELECT list(DISTINCT err) FILTER (WHERE err IS NOT NULL) FROM mr)), lambda x: x IS NOT NULL), ',') AS errors)"""


@query("A28 A27", GATE_SQL + MARKET_SQL + """, b AS (SELECT part, 'after' AS run, failed, '' AS cut, errors FROM q, me UNION ALL SELECT part, 'before', failed, 'cutoff_not_passed', errors FROM q, me UNION ALL SELECT part, 'no_market', failed, '', '' FROM q)
SELECT part, run, concat_ws(',', nullif(cut, ''), nullif(array_to_string(list_transform(list_filter(string_split(failed, ','), lambda x: x <> ''), lambda x: 'quality_' || x), ','), ''), nullif(errors, '')) AS reasons, cut = '' AND failed = '' AND errors = '' AS final_ready FROM b""")
def final_gate(spark, sf_dir):
    """Cutoff, quality and market reasons together: before and after the cutoff, and with a market snapshot that has no errors."""
    market = contracts.market_gate(_market_rows(spark, sf_dir), table(spark, sf_dir, "events").select("user_id"), "user_id", "day", "error", "2024-01-31")
    clean = market.withColumn("errors", F.array().cast("array<string>"))
    runs = (("after", _gate(spark, sf_dir), market), ("before", _gate(spark, sf_dir, cutoff="2024-06-30 20:00:00"), market), ("no_market", _gate(spark, sf_dir), clean))
    out = [gates.final_gate(q, m).select("part", F.lit(n).alias("run"), F.array_join("reasons", ",").alias("reasons"), "final_ready") for n, q, m in runs]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query("W15", """WITH h AS (SELECT l_suppkey AS s, list_sort(list(DISTINCT CAST(year(l_shipdate) AS VARCHAR) || '-12-31')) AS a, list_sort(list(DISTINCT CAST(year(l_shipdate) AS VARCHAR) || 'Q' || quarter(l_shipdate))) AS q FROM lineitem WHERE NOT (l_suppkey % 11 = 2 AND year(l_shipdate) = 1996) AND NOT (l_suppkey % 13 = 6 AND year(l_shipdate) = 1998 AND quarter(l_shipdate) = 2) GROUP BY 1),
d AS (SELECT *, CASE s % 4 WHEN 0 THEN DATE '1999-12-31' WHEN 1 THEN DATE '2000-06-29' WHEN 2 THEN DATE '2000-06-30' ELSE DATE '2000-01-01' END AS as_of, s % 3 = 0 AS cyc FROM h),
k AS (SELECT s, as_of, cyc, list_filter(a, lambda x: x <= strftime(as_of, '%Y-%m-%d')) AS fa, list_filter(q, lambda x: CAST(left(x, 4) AS INTEGER) * 4 + CAST(right(x, 1) AS INTEGER) - 1 BETWEEN year(as_of) * 4 + (month(as_of + 1) - 1) // 3 - CASE WHEN as_of = DATE '1999-12-31' THEN -4 ELSE 0 END - 8 AND year(as_of) * 4 + (month(as_of + 1) - 1) // 3 - CASE WHEN as_of = DATE '1999-12-31' THEN -4 ELSE 0 END - 1) AS fq FROM d),
b AS (SELECT *, CASE WHEN s % 17 = 5 THEN list_reverse(fa) ELSE fa END AS ia, CASE WHEN s % 19 = 7 THEN list_concat(fq, ['2000Q5']) ELSE fq END AS iq, year(as_of) - CASE WHEN as_of = DATE '1999-12-31' THEN 0 ELSE 1 END AS ly FROM k),
c AS (SELECT *, ia <> list_sort(list_distinct(ia)) OR s % 19 = 7 AS bad, len(list_filter(range(ly - CASE WHEN cyc THEN 4 ELSE 3 END, ly + 1), lambda y: NOT list_contains(ia, CAST(y AS VARCHAR) || '-12-31'))) > 0 AS short_a, len(iq) <> 8 AS short_q FROM b)
SELECT s, CASE WHEN bad THEN 'history_invalid_input,pending_evidence/history_not_mature' ELSE concat_ws(',', CASE WHEN short_a THEN 'history_annual_window_incomplete' END, CASE WHEN short_q THEN 'history_quarter_window_incomplete' END, CASE WHEN short_a OR short_q THEN 'pending_evidence/history_not_mature' END) END AS blockers FROM c""")
def history_maturity(spark, sf_dir):
    """The last eight quarters and four or five fiscal years of each supplier as of different days, with gaps and input that is no history."""
    s, y, q = F.col("l_suppkey"), F.year("l_shipdate"), F.quarter("l_shipdate")
    x = table(spark, sf_dir, "lineitem").where(~((s % 11 == 2) & (y == 1996)) & ~((s % 13 == 6) & (y == 1998) & (q == 2)))
    as_of = F.when(F.col("s") % 4 == 0, "1999-12-31").when(F.col("s") % 4 == 1, "2000-06-29").when(F.col("s") % 4 == 2, "2000-06-30").otherwise("2000-01-01").cast("date")
    seen = x.select(s.alias("s"), y.alias("y"), q.alias("q")).distinct().withColumn("as_of", as_of)
    ended = F.last_day(F.make_date("y", F.col("q") * 3, F.lit(1))) <= F.col("as_of")
    near = F.col("y") * 4 + F.col("q") > F.year(F.date_add("as_of", 1)) * 4 + F.quarter(F.date_add("as_of", 1)) - 9
    have = seen.groupBy("s", "as_of").agg(F.array_sort(F.collect_set(F.when(F.make_date("y", F.lit(12), F.lit(31)) <= F.col("as_of"), F.concat("y", F.lit("-12-31"))))).alias("a"), F.array_sort(F.collect_set(F.when(ended & near, F.concat("y", F.lit("Q"), "q")))).alias("q"))
    k = F.col("s")
    annuals = F.when(k % 17 == 5, F.reverse("a")).otherwise(F.col("a"))
    quarters = F.when(k % 19 == 7, F.array_append("q", F.lit("2000Q5"))).otherwise(F.col("q"))
    return have.select("s", F.array_join(gates.history_blockers(annuals, quarters, F.col("as_of"), k % 3 == 0), ",").alias("blockers"))


FORMULAS = {
    "quarter_growth": ({"op": "divide", "args": [{"op": "subtract", "args": [("quantity", "1998Q2"), ("quantity", "1998Q1")]}, ("quantity", "1998Q1")]}, "ratio"),
    "three_years": ({"op": "cagr", "args": [("quantity", "FY1996"), ("quantity", "FY1999")], "years": 3}, "ratio"),
    "per_line": ({"op": "divide", "args": [("quantity", "FY1998"), ("lines", "FY1998")]}, "pieces"),
    "middle": ({"op": "median", "args": [("quantity", "1998Q1"), ("quantity", "1998Q3"), ("quantity", "1998Q4")]}, "pieces"),
    "stock": ({"op": "add", "args": [("stock", "1998Q3"), 1.0]}, "pieces"),
    "nowhere": ({"op": "minimum", "args": [("quantity", "1998S1"), ("quantity", "FY1998")]}, "pieces"),
}
UNITS = {"quantity": "pieces", "lines": "lines", "stock": "pieces"}


@query("F8 F21 J13", """WITH l AS (SELECT l_suppkey AS s, CAST(year(l_shipdate) AS INTEGER) AS y, quarter(l_shipdate) AS q, CAST(l_quantity AS BIGINT) AS v FROM lineitem), b AS (SELECT s, y, count(*) AS n, sum(v) FILTER (WHERE q = 1) AS a1, sum(v) FILTER (WHERE q <= 2) AS a2, sum(v) FILTER (WHERE q <= 3) AS a3, sum(v) AS a4, max(v) FILTER (WHERE q = 3) AS st FROM l GROUP BY 1, 2),
w AS (SELECT s, max(a1) FILTER (WHERE y = 1998) AS q1, CASE WHEN s % 7 <> 3 THEN max(a2) FILTER (WHERE y = 1998) END AS h1, max(a3) FILTER (WHERE y = 1998) AS q3, max(a4) FILTER (WHERE y = 1998) AS fy, max(a4) FILTER (WHERE y = 1996) AS fy96, max(a4) FILTER (WHERE y = 1999) AS fy99, max(n) FILTER (WHERE y = 1998) AS lines, max(st) FILTER (WHERE y = 1998) AS st FROM b GROUP BY 1),
i AS (SELECT s, CASE WHEN s % 13 = 4 THEN 'formal_fact_issue_lines_bad' END AS il, CASE WHEN s % 17 = 6 THEN 'formal_fact_issue_source' END AS ia FROM w),
e AS (SELECT s, 'quarter_growth' AS slot, ((h1 - q1) - q1) / nullif(CAST(q1 AS DOUBLE), 0) AS v, 'ratio' AS unit, 'ratio' AS want, ia AS x1, NULL AS x2, CASE WHEN h1 IS NOT NULL AND q1 IS NULL THEN 'quarter_missing_prerequisite' END AS x3, CASE WHEN q1 IS NULL THEN 'missing:quantity@1998Q1' WHEN h1 IS NULL THEN 'missing:quantity@1998Q2' END AS miss, 2 AS leaves, (q1 IS NOT NULL)::INT + (h1 - q1 IS NOT NULL)::INT AS found FROM w JOIN i USING (s)
 UNION ALL SELECT s, 'three_years', CASE WHEN fy96 > 0 AND fy99 > 0 THEN 100 * (pow(fy99 / fy96, 1 / 3.0) - 1) END, 'ratio', 'ratio', ia, NULL, NULL, CASE WHEN fy96 IS NULL THEN 'missing:quantity@FY1996' WHEN fy99 IS NULL THEN 'missing:quantity@FY1999' END, 2, (fy96 IS NOT NULL)::INT + (fy99 IS NOT NULL)::INT FROM w JOIN i USING (s)
 UNION ALL SELECT s, 'per_line', fy / CAST(lines AS DOUBLE), 'pieces_per_lines', 'pieces', ia, il, CASE WHEN s % 11 = 5 THEN 'formula_fact_ambiguous' END, NULL, 2, 2 FROM w JOIN i USING (s)
 UNION ALL SELECT s, 'middle', CASE WHEN h1 IS NOT NULL THEN list_sort([q1, q3 - h1, fy - q3])[2] END, 'pieces', 'pieces', ia, CASE WHEN s % 11 = 5 THEN 'formula_fact_ambiguous' END, CASE WHEN h1 IS NULL AND q3 IS NOT NULL THEN 'quarter_missing_prerequisite' END, CASE WHEN h1 IS NULL THEN 'missing:quantity@1998Q3' END, 3, (q1 IS NOT NULL)::INT + (q3 - h1 IS NOT NULL)::INT + (fy - q3 IS NOT NULL)::INT FROM w JOIN i USING (s)
 UNION ALL SELECT s, 'stock', st + 1, 'pieces', 'pieces', ia, NULL, NULL, CASE WHEN st IS NULL THEN 'missing:stock@1998Q3' END, 1, (st IS NOT NULL)::INT FROM w JOIN i USING (s)
 UNION ALL SELECT s, 'nowhere', NULL, 'pieces', 'pieces', ia, CASE WHEN s % 11 = 5 THEN 'formula_fact_ambiguous' END, NULL, 'missing:quantity@1998S1', 2, 1 FROM w JOIN i USING (s)),
f AS (SELECT *, list_sort(list_filter([x1, x2, x3], lambda x: x IS NOT NULL))[1] AS block FROM e)
SELECT s, slot, CASE WHEN block IS NULL AND v IS NOT NULL AND unit = want THEN round(v + 3e-8, 6) END AS value, unit, CASE WHEN block IS NOT NULL THEN 'blocked' WHEN v IS NULL OR unit <> want THEN 'missing' ELSE 'derived' END AS status, CASE WHEN block IS NOT NULL THEN block WHEN v IS NULL THEN coalesce(miss, 'domain') WHEN unit <> want THEN 'formula_unit_mismatch' END AS reason, leaves, found FROM f""")
def period_formulas(spark, sf_dir):
    """Formulas over years and single quarters of cumulated statements, with facts that are absent or stated twice and issues of one metric or of all."""
    x = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("s"), F.year("l_shipdate").alias("year"), F.quarter("l_shipdate").alias("q"), F.col("l_quantity").cast("long").alias("v"))
    upto = lambda k: F.sum(F.when(F.col("q") <= k, F.col("v")))
    b = x.groupBy("s", "year").agg(*(upto(k).alias(f"a{k}") for k in (1, 2, 3, 4)), F.count(F.lit(1)).alias("n"), F.max(F.when(F.col("q") == 3, F.col("v"))).alias("st"))
    fact = lambda m, kind, v: F.struct(F.lit(m).alias("metric"), F.lit(kind).alias("kind"), v.cast("double").alias("value"))
    s = F.col("s")
    half = F.when(~((s % 7 == 3) & (F.col("year") == 1998)), F.col("a2"))
    twice = F.when((s % 11 == 5) & (F.col("year") == 1998), F.col("a4") + 1)
    facts = F.array(fact("quantity", "Q1", F.col("a1")), fact("quantity", "H1", half), fact("quantity", "Q3", F.col("a3")), fact("quantity", "FY", F.col("a4")), fact("quantity", "FY", twice), fact("lines", "FY", F.col("n")), fact("stock", "Q3", F.col("st")))
    long = b.select("s", "year", F.explode(facts).alias("f")).select("s", "year", "f.*").where("value IS NOT NULL")
    told = F.array_compact(F.array(F.when(s % 13 == 4, F.struct(F.lit("lines").alias("metric"), F.lit("lines_bad").alias("code"))), F.when(s % 17 == 6, F.struct(F.lit(None).cast("string").alias("metric"), F.lit("source").alias("code")))))
    issues = b.select("s").distinct().select("s", F.explode(told).alias("i")).select("s", "i.*")
    out = formulas.evaluated(long, issues, FORMULAS, {"quantity", "lines"}, UNITS, ["s"])
    return out.withColumn("value", F.round(F.col("value") + 3e-8, 6))


@query("A30 S11", f"""WITH {YEARS}, d AS (SELECT s, y, unnest(['income', 'income', 'balance', 'cash']) AS statement, unnest(['revenue', 'rebates', 'stock', 'paid']) AS metric, unnest([revenue, CASE WHEN s % 9 = 1 THEN NULL ELSE discounts END, quantity, tax]) AS value, unnest(['CNY', 'CNY', 'pieces', 'CNY']) AS unit, unnest(['duration', 'duration', 'instant', 'duration']) AS nature FROM years),
f AS (SELECT * FROM d WHERE value IS NOT NULL), st AS (SELECT s, y, statement, metric, value + CASE WHEN s % 23 = 4 AND metric = 'stock' THEN 1 ELSE 0 END AS value, CASE WHEN s % 29 = 3 AND metric = 'paid' THEN 'USD' ELSE unit END AS unit, nature FROM f WHERE NOT (s % 31 = 5 AND y = 1998) UNION ALL SELECT * FROM f WHERE s % 37 = 6 AND metric = 'revenue'),
m AS (SELECT s, y, statement, metric, value, unit, nature, sum(n) AS n FROM (SELECT *, 1 AS n FROM st UNION ALL SELECT *, -1 FROM f) GROUP BY ALL HAVING sum(n) <> 0)
SELECT s, y, statement, metric, round(value, 4) AS value, unit, nature, CASE WHEN n > 0 THEN 'stored' ELSE 'derived' END AS side, CAST(abs(n) AS BIGINT) AS times FROM m""")
def rebuilt_fact_set(spark, sf_dir):
    """Facts rebuilt from three wide statements against stored ones of which some are changed, lost, repeated or in another unit."""
    x = supplier_years(spark, sf_dir)
    sources = {"income": x.select("s", "y", "revenue", F.when(F.col("s") % 9 != 1, F.col("discounts")).alias("discounts")), "balance": x.select("s", "y", "quantity", F.lit("note").alias("note")), "cash": x.select("s", "y", "tax")}
    mapping = {"revenue": ("revenue", "CNY", "duration"), "discounts": ("rebates", "CNY", "duration"), "quantity": ("stock", "pieces", "instant"), "tax": ("paid", "CNY", "duration")}
    facts = formulas.rebuilt_facts(sources, mapping, ["s", "y"])
    s, metric = F.col("s"), F.col("metric")
    stored = facts.where(~((s % 31 == 5) & (F.col("y") == 1998))).withColumns({"value": F.col("value") + F.when((s % 23 == 4) & (metric == "stock"), 1).otherwise(0), "unit": F.when((s % 29 == 3) & (metric == "paid"), "USD").otherwise(F.col("unit"))})
    stored = stored.unionByName(facts.where((s % 37 == 6) & (metric == "revenue")))
    return formulas.multiset_differences(stored, facts).withColumn("value", F.round("value", 4))


REPORTS = {"by_status": ("o_orderstatus",), "by_priority": ("o_orderpriority",), "by_year": ("y",), "by_month": ("m",), "by_status_priority": ("o_orderstatus", "o_orderpriority"), "by_status_month": ("o_orderstatus", "m"), "by_priority_year": ("o_orderpriority", "y"), "by_customer": ("o_custkey",)}


def _report_sql():
    names = ("o_orderstatus", "o_orderpriority", "y", "m", "o_custkey")
    parts = [f"SELECT '{r}' AS report, {', '.join(f'CAST({c} AS VARCHAR) AS {c}' if c in cs else f'CAST(NULL AS VARCHAR) AS {c}' for c in names)}, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM o GROUP BY {', '.join(cs)}" for r, cs in REPORTS.items()]
    order = ", ".join(f"{c} NULLS LAST" for c in names)
    return f"""WITH o AS (SELECT *, CAST(year(o_orderdate) AS INTEGER) AS y, strftime(o_orderdate, '%Y-%m') AS m FROM orders), g AS ({' UNION ALL '.join(parts)}),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY report ORDER BY n DESC, {order}) AS INTEGER) AS position, count(*) OVER (PARTITION BY report) AS reviewed FROM g)
SELECT *, count(*) OVER (PARTITION BY report) AS shown, reviewed > 25 AS truncated FROM r WHERE position <= 25"""


@query("S20 W16", _report_sql())
def report_tables(spark, sf_dir):
    """Eight bounded report tables of the orders from one scan, each with what was reviewed and shown and whether it is cut off."""
    o = table(spark, sf_dir, "orders").withColumns({"y": F.year("o_orderdate"), "m": F.date_format("o_orderdate", "yyyy-MM")})
    sums = {"n": F.count(F.lit(1)), "total": F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double")}
    return gates.bounded_reports(o, REPORTS, sums, [F.col("n").desc()])
