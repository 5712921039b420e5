"""Queries of formulas, mapped facts, context kinds, manifests, pool eligibility, annual series, winners and integrity."""

from pyspark.sql import functions as F

from pitpanel.functions import exprs
from pitpanel.operators import contracts, features, periods, versions

from .base import PANEL, YEARS, panel, query, supplier_years, table
from .facts import COLUMNS, DERIVED, DERIVED_SQL, STATEMENT, TALL, tall

FORMULAS = {
    "margin": {"op": "divide", "args": [{"op": "subtract", "args": ["revenue", "discounts"]}, "revenue"]},
    "spread": {"op": "subtract", "args": [{"op": "median", "args": ["discounts", "revenue", "tax"]}, {"op": "minimum", "args": ["discounts", "tax"]}]},
    "per_piece": {"op": "divide", "args": ["revenue", "quantity"]},
    "growth": {"op": "cagr", "args": ["tax", "revenue"], "years": 2},
}


@query("F7", f"""WITH {TALL}, r AS (SELECT s, y, unnest(['margin', 'spread', 'per_piece', 'growth']) AS formula, unnest(['ratio', 'CNY', 'CNY_per_pieces', 'ratio']) AS unit,
 unnest([(revenue - discounts) / nullif(revenue, 0), CASE WHEN discounts IS NOT NULL AND tax IS NOT NULL THEN list_sort([discounts, revenue, tax])[2] - least(discounts, tax) END, revenue / nullif(quantity, 0), CASE WHEN tax > 0 AND revenue > 0 THEN 100 * (pow(revenue / tax, 0.5) - 1) END]) AS v,
 unnest([CASE WHEN discounts IS NULL THEN 'missing:discounts' END, CASE WHEN discounts IS NULL THEN 'missing:discounts' WHEN tax IS NULL THEN 'missing:tax' END, NULL, CASE WHEN tax IS NULL THEN 'missing:tax' END]) AS reason FROM wide)
SELECT s, y, formula, round(v + 3e-8, 6) AS value, unit, CASE WHEN v IS NULL THEN coalesce(reason, 'domain') END AS reason FROM r""")
def formula_results(spark, sf_dir):
    """Formula trees over supplier-years with their units and the first missing fact."""
    w = features.wide(tall(spark, sf_dir), ["s", "y"], "metric", "value", list(COLUMNS), "unit")
    units = {"revenue": "CNY", "discounts": "CNY", "tax": "CNY", "quantity": "pieces"}
    made = []
    for name, tree in FORMULAS.items():
        value, unit, reason = features.evaluated(tree, {k: F.col(k) for k in COLUMNS}, units)
        made.append(F.struct(F.lit(name).alias("formula"), F.round(value + 3e-8, 6).alias("value"), F.lit(unit).alias("unit"), reason.alias("reason")))
    return w.select("s", "y", F.explode(F.array(*made)).alias("f")).select("s", "y", "f.*")


@query("P15", """WITH i AS (SELECT l_orderkey AS doc, CASE l_linenumber % 6 WHEN 0 THEN '' WHEN 1 THEN 'sales' WHEN 2 THEN 'costs' WHEN 3 THEN CASE WHEN l_partkey % 2 = 0 THEN 'sales' ELSE 'stock' END WHEN 4 THEN 'gossip' ELSE 'stock' END AS field, CASE WHEN l_partkey % 11 = 4 THEN 'n/a' ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS text FROM lineitem),
m(field, metric, required) AS (VALUES ('sales', 'revenue', true), ('costs', 'cost', true), ('stock', 'inventory', false)),
g AS (SELECT doc, field, count(*) AS n, min(text) AS text FROM i GROUP BY 1, 2),
f AS (SELECT g.doc, g.field, m.metric, TRY_CAST(text AS DOUBLE) AS v, CASE WHEN g.field = '' THEN 'malformed' WHEN m.metric IS NULL THEN 'unknown_field' WHEN n > 1 THEN 'duplicate_field' WHEN text = 'n/a' THEN 'not_numeric' END AS issue FROM g LEFT JOIN m USING (field))
SELECT doc, field, metric, CASE WHEN issue IS NULL THEN v END AS value, issue FROM f UNION ALL SELECT d.doc, m.field, m.metric, NULL, 'missing_required' FROM (SELECT DISTINCT doc FROM i) d CROSS JOIN m WHERE required AND NOT EXISTS (SELECT 1 FROM g WHERE g.doc = d.doc AND g.field = m.field)""")
def document_facts(spark, sf_dir):
    """Item rows of each order as a document, mapped to facts or to one of five issues."""
    n = F.col("l_linenumber") % 6
    field = F.when(n == 0, "").when(n == 1, "sales").when(n == 2, "costs").when((n == 3) & (F.col("l_partkey") % 2 == 0), "sales").when(n == 4, "gossip").otherwise("stock")
    items = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc"), field.alias("field"), F.when(F.col("l_partkey") % 11 == 4, "n/a").otherwise(F.col("l_quantity").cast("int").cast("string")).alias("text"))
    mapping = spark.createDataFrame([("sales", "revenue", True), ("costs", "cost", True), ("stock", "inventory", False)], "field string, metric string, required boolean")
    return contracts.mapped_facts(items, mapping, ["doc"])


@query("P27", """WITH t AS (SELECT event_id AS k, CASE event_id % 8 WHEN 0 THEN 'trading_calendar' WHEN 1 THEN 'market_close' WHEN 2 THEN 'security_state' WHEN 3 THEN 'industry_snapshot' WHEN 4 THEN 'regulatory_state' WHEN 5 THEN 'event_calendar' WHEN 6 THEN 'consensus_snapshot' ELSE 'weather' END AS kind, CAST(ts AS DATE) AS d, value AS v, user_id AS u FROM events)
SELECT k AS event_id, concat_ws(',', CASE WHEN kind = 'weather' THEN 'kind' END,
 CASE WHEN kind IN ('trading_calendar', 'market_close') AND u % 5 = 0 THEN 'exchange' END, CASE WHEN kind = 'trading_calendar' AND u % 7 IN (0, 1) THEN 'trading_days' END, CASE WHEN kind = 'market_close' AND u % 11 = 0 THEN 'volume' END, CASE WHEN kind = 'market_close' AND u % 13 = 0 THEN 'close' END,
 CASE WHEN kind = 'market_close' AND CASE WHEN u % 2 = 0 THEN NOT (u % 3 = 0 AND d = DATE '2024-01-15') ELSE NOT (u % 3 > 0 AND d < DATE '2024-01-15') END THEN 'freshness' END,
 CASE WHEN kind = 'security_state' AND u % 4 = 1 THEN 'listing_status' END, CASE WHEN kind = 'industry_snapshot' AND u % 6 = 5 THEN 'system' END, CASE WHEN kind = 'industry_snapshot' AND u % 9 = 2 THEN 'industry' END, CASE WHEN kind = 'industry_snapshot' AND d > DATE '2024-01-15' THEN 'effective_date' END,
 CASE WHEN kind = 'regulatory_state' AND u % 7 IN (2, 3) THEN 'flags' END, CASE WHEN kind = 'event_calendar' AND u % 7 IN (2, 3) THEN 'events' END,
 CASE WHEN kind = 'consensus_snapshot' AND NOT CASE WHEN u % 3 = 0 THEN u % 10 <> 4 AND u % 4 > 0 ELSE u % 3 = 1 AND u % 10 = 4 AND u % 4 = 0 END THEN 'coverage' END, CASE WHEN kind NOT IN ('consensus_snapshot', 'weather') AND u % 10 = 4 THEN 'no_coverage' END) AS broken FROM t""")
def context_kinds(spark, sf_dir):
    """Context facts of seven kinds (and an unknown one), each held against its own rules at a freeze date."""
    k, u, day = F.col("event_id") % 8, F.col("user_id"), F.to_date("ts")
    names = ("trading_calendar", "market_close", "security_state", "industry_snapshot", "regulatory_state", "event_calendar", "consensus_snapshot", "weather")
    kind = F.element_at(F.array(*map(F.lit, names)), (k + 1).cast("int"))
    days = F.when(u % 7 == 0, F.array().cast("array<date>")).when(u % 7 == 1, F.array(day, F.date_sub(day, 1))).otherwise(F.array(F.date_sub(day, 1), day))
    ids = F.when(u % 7 == 2, F.array(F.lit("b"), F.lit("a"))).when(u % 7 == 3, F.array(F.lit(" "), F.lit("a"))).otherwise(F.array(F.lit("a"), F.lit("b")))
    rows = table(spark, sf_dir, "events").select(
        "event_id", kind.alias("kind"), F.when(u % 5 == 0, "XX").otherwise("SH").alias("exchange"), days.alias("days"), F.when(u % 11 == 0, -1.0).otherwise(1.0).alias("volume"), F.when(u % 13 == 0, 0.0).otherwise(2.0).alias("close"), day.alias("close_date"), (u % 2 == 0).alias("effective"), (u % 3).alias("stale"),
        F.when(u % 4 == 1, "gone").otherwise("listed").alias("listing_status"), F.when(u % 6 == 5, "old").otherwise("SW2021").alias("system"), F.when(u % 9 == 2, " ").otherwise("banks").alias("industry"), day.alias("valid_from"), ids.alias("ids"),
        F.when(u % 3 == 0, "covered").when(u % 3 == 1, "no_valid_coverage").otherwise("about").alias("coverage"), (u % 10 == 4).alias("no_coverage"), (u % 4).alias("estimates"),
    )
    return rows.select("event_id", F.array_join(contracts.context_violations(F.lit("2024-01-15").cast("date")), ",").alias("broken"))


@query("X5", """WITH sl AS (SELECT c_custkey, c_nationkey, p FROM customer CROSS JOIN (VALUES ('1-URGENT'), ('2-HIGH'), ('3-MEDIUM'), ('4-NOT SPECIFIED'), ('5-LOW')) x(p)),
j AS (SELECT o_custkey, o_orderpriority, count(*) AS n, min(o_orderkey) AS k, count(DISTINCT o_orderstatus) AS kinds, max(o_orderstatus) AS st FROM orders GROUP BY 1, 2)
SELECT c_custkey, p, CASE WHEN c_nationkey = 7 AND p = '5-LOW' THEN 'not_applicable_signed' WHEN c_nationkey = 24 THEN 'blocked_schema' WHEN k % 61 = 1 THEN 'blocked_registry' WHEN k % 59 = 2 THEN 'blocked_identity' WHEN k % 53 = 3 THEN 'blocked_integrity' WHEN k % 47 = 4 THEN 'blocked_temporal' WHEN n > 4 THEN 'blocked_ambiguous' WHEN k % 43 = 5 THEN 'blocked_dependency'
 WHEN st = 'P' AND k % 2 = 0 THEN 'terminal_failed' WHEN st = 'P' THEN 'retryable_failed' WHEN kinds > 1 THEN 'pending' WHEN n IS NULL AND c_nationkey % 3 <> 0 THEN 'missing' WHEN n IS NULL THEN 'verified_no_coverage' WHEN n = 1 THEN 'verified_partial' ELSE 'verified_complete' END AS class FROM sl LEFT JOIN j ON o_custkey = c_custkey AND o_orderpriority = p""")
def coverage_manifest(spark, sf_dir):
    """Every customer's every dataset in one of fifteen classes."""
    kinds = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
    slots = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", F.explode(F.array(*map(F.lit, kinds))).alias("p"))
    jobs = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey"), F.col("o_orderpriority").alias("p")).agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("k"), F.countDistinct("o_orderstatus").alias("kinds"), F.max("o_orderstatus").alias("st"))
    k, n, nation = F.col("k"), F.col("n"), F.col("c_nationkey")
    tests = {
        "not_applicable_signed": (nation == 7) & (F.col("p") == "5-LOW"), "blocked_schema": nation == 24, "blocked_registry": k % 61 == 1, "blocked_identity": k % 59 == 2, "blocked_integrity": k % 53 == 3, "blocked_temporal": k % 47 == 4, "blocked_ambiguous": n > 4, "blocked_dependency": k % 43 == 5,
        "terminal_failed": (F.col("st") == "P") & (k % 2 == 0), "retryable_failed": F.col("st") == "P", "pending": F.col("kinds") > 1, "missing": n.isNull() & (nation % 3 != 0), "verified_no_coverage": n.isNull(), "verified_partial": n == 1,
    }
    return slots.join(jobs, ["c_custkey", "p"], "left").select("c_custkey", "p", contracts.coverage_class(tests).alias("class"))


@query("P22", f"""WITH {PANEL}, v AS (SELECT *, c_acctbal / 100 + 10 AS score, coalesce(orders, 0) * 4 AS weakest, CASE WHEN spend IS NULL THEN 0.7 ELSE 0.95 END AS conf, c_custkey % 11 = 0 AS no_strong, c_custkey % 13 = 0 AS no_wait, c_custkey % 17 = 0 AS neither FROM panel)
SELECT c_custkey, CASE WHEN score >= 75 AND weakest >= 40 AND conf >= 0.8 AND NOT (no_strong OR neither) THEN 'strong' WHEN score >= 60 AND weakest >= 30 AND conf >= 0.7 AND NOT (no_wait OR neither) THEN 'wait' ELSE 'none' END AS pool FROM v""")
def pool_eligibility(spark, sf_dir):
    """Bounds on score, weakest dimension and confidence; vetoes by pool; nobody in two pools."""
    k = F.col("c_custkey")
    vetoes = F.array_compact(F.array(F.when(k % 11 == 0, "strong"), F.when(k % 13 == 0, "wait"), F.when(k % 17 == 0, "both")))
    pool = contracts.pool_of(F.col("c_acctbal") / 100 + 10, F.coalesce("orders", F.lit(0)) * 4, F.when(F.col("spend").isNull(), 0.7).otherwise(0.95), vetoes, (75, 40, 0.8), (60, 30, 0.7))
    return panel(spark, sf_dir).select("c_custkey", pool.alias("pool"))


@query("R4 R5", """WITH t AS (SELECT c_custkey AS k, CASE WHEN c_nationkey = 5 THEN NULL ELSE c_mktsegment <> 'FURNITURE' END AS applies, CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'proven' WHEN 2 THEN 'pending' ELSE CASE WHEN c_custkey % 2 = 0 THEN 'proven' ELSE 'clear' END END AS veto, CASE c_custkey % 3 WHEN 0 THEN 'incomplete' WHEN 1 THEN 'found' ELSE 'no_value' END AS price FROM customer),
s AS (SELECT *, CASE WHEN veto IS NULL OR veto = 'pending' OR price = 'incomplete' THEN 'pending_evidence' WHEN veto = 'proven' THEN 'matched' ELSE 'clear' END AS st FROM t)
SELECT k AS c_custkey, CASE WHEN applies IS NULL THEN 'unresolved' WHEN NOT applies THEN 'not_applicable' ELSE st END AS state, CASE WHEN applies IS NOT TRUE THEN 'none' WHEN veto = 'proven' AND price = 'incomplete' THEN 'pool' WHEN st = 'matched' THEN 'all' ELSE 'none' END AS released FROM s""")
def liquidity_rules(spark, sf_dir):
    """The market rule where it applies, might apply or doesn't, and which of its effects it releases."""
    k = F.col("c_custkey")
    applies = F.when(F.col("c_nationkey") != 5, F.col("c_mktsegment") != "FURNITURE")
    veto = F.when(k % 5 == 0, None).when(k % 5 == 1, "proven").when(k % 5 == 2, "pending").when(k % 2 == 0, "proven").otherwise("clear")
    state, released = contracts.liquidity_state(veto, F.when(k % 3 == 0, "incomplete").when(k % 3 == 1, "found").otherwise("no_value"))
    rows = table(spark, sf_dir, "customer").withColumn("applies", applies)
    return rows.select("c_custkey", F.when(F.col("applies").isNull(), "unresolved").when(~F.col("applies"), "not_applicable").otherwise(state).alias("state"), F.when(F.col("applies"), released).otherwise("none").alias("released"))


@query("R8", f"""WITH {YEARS}, f AS (SELECT s, y, CASE WHEN s % 6 = 1 AND y = 1998 THEN NULL ELSE quantity END AS v, CASE WHEN s % 5 = 2 AND y = 1999 THEN 'b' ELSE 'a' END AS basis FROM years WHERE y BETWEEN 1996 AND 2000),
g AS (SELECT s, count(DISTINCT basis) FILTER (WHERE v IS NOT NULL) AS bases, count(v) AS n, list(v ORDER BY y) AS l FROM f WHERE v IS NOT NULL GROUP BY 1)
SELECT s, CASE WHEN bases > 1 THEN 'domain_conflict' WHEN n < 5 THEN 'pending' ELSE 'ready' END AS state, CASE WHEN bases = 1 AND n = 5 THEN array_to_string(list_transform(l, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ',') END AS series FROM g""")
def annual_series(spark, sf_dir):
    """Five years of each supplier in order, or why not."""
    x = supplier_years(spark, sf_dir).select("s", "y", F.when(~((F.col("s") % 6 == 1) & (F.col("y") == 1998)), F.col("quantity")).alias("v"), F.when((F.col("s") % 5 == 2) & (F.col("y") == 1999), "b").otherwise("a").alias("basis"))
    out = contracts.annual_series(x, ["s"], "y", "v", "basis", 2000)
    return out.select("s", "state", F.array_join(F.transform("values", lambda v: v.cast("long").cast("string")), ",").alias("series"))


@query("W8", """WITH v AS (SELECT user_id, event_type, event_id, date_trunc('day', ts) AS published, CASE WHEN event_id % 3 = 0 THEN date_trunc('hour', ts) END AS updated, date_trunc('day', ts) + INTERVAL 1 DAY AS captured, sha256(CAST(event_id % 97 AS VARCHAR)) AS h, CASE WHEN event_id % 211 = 8 THEN 'p2' ELSE 'p1' END AS parser FROM events WHERE ts < TIMESTAMP '2024-01-20'),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY published DESC, updated DESC NULLS LAST, captured DESC, h) AS n, min(parser) OVER (PARTITION BY user_id, event_type) <> max(parser) OVER (PARTITION BY user_id, event_type) AS mixed FROM v)
SELECT user_id, event_type, published, updated, h AS content, CASE WHEN mixed THEN 'mixed_kind' ELSE 'chosen' END AS state FROM r WHERE n = 1""")
def formal_winners(spark, sf_dir):
    """The version of each key that was visible and wins, down to the content hash."""
    e = table(spark, sf_dir, "events").where("ts < TIMESTAMP '2024-01-20 00:00:00'")
    day = F.date_trunc("day", "ts")
    rows = e.select("user_id", "event_type", day.alias("published"), F.when(F.col("event_id") % 3 == 0, F.date_trunc("hour", "ts")).alias("updated"), (day + F.expr("INTERVAL 1 DAY")).alias("captured"), F.sha2((F.col("event_id") % 97).cast("string"), 256).alias("content"), F.when(F.col("event_id") % 211 == 8, "p2").otherwise("p1").alias("parser"))
    return versions.formal_winner(rows, ["user_id", "event_type"], "published", "updated", "captured", "content", ["parser"]).select("user_id", "event_type", "published", "updated", "content", "state")


@query("U3", """WITH st AS (SELECT l_orderkey AS k, l_linenumber AS n, CAST(l_quantity AS BIGINT) + CASE WHEN l_orderkey % 97 = 5 THEN 1 ELSE 0 END AS v FROM lineitem WHERE l_orderkey % 89 <> 7), d AS (SELECT l_orderkey AS k, l_linenumber AS n, CAST(l_quantity AS BIGINT) AS v FROM lineitem)
SELECT *, 'stored' AS side FROM (SELECT * FROM st EXCEPT ALL SELECT * FROM d) UNION ALL SELECT *, 'derived' FROM (SELECT * FROM d EXCEPT ALL SELECT * FROM st)""")
def fact_set_equality(spark, sf_dir):
    """Stored facts against facts extracted anew, as multisets, in both directions."""
    derived = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), F.col("l_quantity").cast("long").alias("v"))
    stored = derived.where("k % 89 <> 7").withColumn("v", F.col("v") + (F.col("k") % 97 == 5).cast("long"))
    return contracts.set_differences(stored, derived)


@query("J8 J9", """WITH f AS (SELECT o_orderkey AS id, o_custkey AS sec, o_orderstatus AS field, o_orderpriority AS unit, CAST(o_orderdate AS DATE) AS announced, sha256(CAST(o_orderkey AS VARCHAR)) AS h, o_orderkey % 8 AS snap, CAST(floor(o_totalprice) AS BIGINT) AS v FROM orders WHERE o_orderkey % 31 <> 6),
e AS (SELECT o_orderkey AS id, o_custkey + CASE WHEN o_orderkey % 37 = 1 THEN 1 ELSE 0 END AS sec, CASE WHEN o_orderkey % 41 = 2 THEN 'x' ELSE o_orderstatus END AS field, CASE WHEN o_orderkey % 43 = 3 THEN 'x' ELSE o_orderpriority END AS unit, CAST(o_orderdate AS DATE) + CASE WHEN o_orderkey % 47 = 4 THEN 1 ELSE 0 END AS announced, CASE WHEN o_orderkey % 53 = 5 THEN 'x' ELSE sha256(CAST(o_orderkey AS VARCHAR)) END AS h, o_orderkey % 8 + CASE WHEN o_orderkey % 59 = 7 THEN 1 ELSE 0 END AS snap, CAST(floor(o_totalprice) AS BIGINT) * 2 + CASE WHEN o_orderkey % 61 = 8 THEN 1 ELSE 0 END AS twice FROM orders)
SELECT e.id, concat_ws(',', CASE WHEN f.id IS NULL THEN 'absent' END, CASE WHEN e.sec <> f.sec THEN 'security' END, CASE WHEN e.field <> f.field THEN 'field' END, CASE WHEN e.unit <> f.unit THEN 'unit' END, CASE WHEN e.announced <> f.announced THEN 'announced' END, CASE WHEN e.h <> f.h THEN 'hash' END, CASE WHEN e.snap <> f.snap THEN 'snapshot' END, CASE WHEN e.twice <> f.v * 2 THEN 'formula' END) AS broken FROM e LEFT JOIN f USING (id)
WHERE f.id IS NULL OR e.sec <> f.sec OR e.field <> f.field OR e.unit <> f.unit OR e.announced <> f.announced OR e.h <> f.h OR e.snap <> f.snap OR e.twice <> f.v * 2""")
def integrity_errors(spark, sf_dir):
    """Evidence against its fact in six columns, and the formula recomputed from the fact."""
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    hashed, value = F.sha2(k.cast("string"), 256), F.floor("o_totalprice")
    facts = o.where("o_orderkey % 31 <> 6").select(k.alias("id"), F.col("o_custkey").alias("f_security"), F.col("o_orderstatus").alias("f_field"), F.col("o_orderpriority").alias("f_unit"), F.to_date("o_orderdate").alias("f_announced"), hashed.alias("f_hash"), (k % 8).alias("f_snapshot"), (value * 2).alias("f_formula"), F.lit(True).alias("there"))
    off = lambda m, r: (k % m == r).cast("int")
    evidence = o.select(k.alias("id"), (F.col("o_custkey") + off(37, 1)).alias("security"), F.when(k % 41 == 2, "x").otherwise(F.col("o_orderstatus")).alias("field"), F.when(k % 43 == 3, "x").otherwise(F.col("o_orderpriority")).alias("unit"), F.date_add(F.to_date("o_orderdate"), off(47, 4)).alias("announced"), F.when(k % 53 == 5, "x").otherwise(hashed).alias("hash"), (k % 8 + off(59, 7)).alias("snapshot"), (value * 2 + off(61, 8)).alias("formula"))
    rows = evidence.join(facts, "id", "left")
    same = ("security", "field", "unit", "announced", "hash", "snapshot", "formula")
    broken = F.array_compact(F.array(F.when(F.col("there").isNull(), "absent"), *(F.when(F.col("there") & ~F.col(n).eqNullSafe(F.col(f"f_{n}")), n) for n in same)))
    return rows.select("id", F.array_join(broken, ",").alias("broken")).where("broken <> ''")


@query("A6 A25", """WITH o AS (SELECT count(*) AS n, count(*) FILTER (WHERE o_orderstatus = 'P') AS open, max(o_orderdate) AS late FROM orders), l AS (SELECT count(*) AS n, max(l_shipdate) AS late, count(DISTINCT l_orderkey) AS k FROM lineitem), e AS (SELECT count(*) AS n, max(ts) AS late FROM events), c AS (SELECT count(*) AS n, (SELECT count(*) FROM (SELECT c_custkey FROM customer GROUP BY 1 HAVING count(*) > 1)) AS twice FROM customer),
g AS (SELECT unnest(['universe', 'duplicates', 'open_rows', 'backed', 'events', 'cutoff']) AS gate, unnest([c.n > 0, c.twice = 0, o.open = 0, l.k <= o.n, e.n > 0, greatest(o.late, l.late, e.late) <= TIMESTAMP '2024-06-30']) AS ok, unnest([c.n, c.twice, o.open, l.k, e.n, CAST(year(greatest(o.late, l.late, e.late)) AS BIGINT)]) AS seen FROM o, l, e, c)
SELECT gate, CASE WHEN ok THEN 'passed' ELSE 'failed' END AS status, seen AS evidence, (SELECT coalesce(array_to_string(list(gate ORDER BY gate), ','), '') FROM g WHERE NOT ok) AS reasons FROM g""")
def release_gate_rows(spark, sf_dir):
    """Six gates over one row of aggregates of four tables, with the latest update of all, and the reasons that bar a release."""
    o = table(spark, sf_dir, "orders").agg(F.count(F.lit(1)).alias("orders"), F.count_if(F.col("o_orderstatus") == "P").alias("open"), F.max("o_orderdate").alias("late1"))
    li = table(spark, sf_dir, "lineitem").agg(F.countDistinct("l_orderkey").alias("backed"), F.max("l_shipdate").alias("late2"))
    e = table(spark, sf_dir, "events").agg(F.count(F.lit(1)).alias("events"), F.max("ts").alias("late3"))
    c = table(spark, sf_dir, "customer").groupBy("c_custkey").agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("universe"), F.count_if(F.col("n") > 1).alias("twice"))
    one = o.crossJoin(li).crossJoin(e).crossJoin(c).withColumn("late", F.greatest("late1", "late2", "late3"))  # one-row frames
    gates = (("universe", F.col("universe") > 0, "universe"), ("duplicates", F.col("twice") == 0, "twice"), ("open_rows", F.col("open") == 0, "open"), ("backed", F.col("backed") <= F.col("orders"), "backed"), ("events", F.col("events") > 0, "events"), ("cutoff", F.col("late") <= F.to_timestamp(F.lit("2024-06-30 00:00:00")), F.year("late")))
    rows = F.array(*(F.struct(F.lit(n).alias("gate"), F.when(ok, "passed").otherwise("failed").alias("status"), (F.col(seen) if isinstance(seen, str) else seen).cast("long").alias("evidence")) for n, ok, seen in gates))
    why = F.array_join(F.array_sort(exprs.violations(**{n: ok for n, ok, _ in gates})), ",")
    return one.select(why.alias("reasons"), F.explode(rows).alias("g")).select("g.*", "reasons")


@query("S8", """WITH d AS (SELECT o_orderpriority AS p, CAST(o_orderdate AS DATE) AS day, arg_min(o_totalprice, o_orderkey) AS o, max(o_totalprice) AS h, min(o_totalprice) AS l, arg_max(o_totalprice, o_orderkey) AS c, count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS a, bool_or(o_orderstatus = 'P') AS st FROM orders GROUP BY 1, 2),
b AS (SELECT *, lag(c) OVER (PARTITION BY p ORDER BY day) AS pre FROM d)
SELECT CAST(day AS VARCHAR) AS date, 'sh.' || left(p, 1) AS code, CAST(CAST(o AS DECIMAL(18,2)) AS VARCHAR) AS open, CAST(CAST(h AS DECIMAL(18,2)) AS VARCHAR) AS high, CAST(CAST(l AS DECIMAL(18,2)) AS VARCHAR) AS low, CAST(CAST(c AS DECIMAL(18,2)) AS VARCHAR) AS close, CAST(CAST(pre AS DECIMAL(18,2)) AS VARCHAR) AS preclose, CAST(n AS VARCHAR) AS volume, CAST(CAST(a AS DECIMAL(18,2)) AS VARCHAR) AS amount, '3' AS adjustflag, CAST(n * 2 AS VARCHAR) AS turn, CASE WHEN n > 1 THEN '1' ELSE '0' END AS tradestatus,
 CASE WHEN pre IS NULL THEN NULL WHEN c > pre THEN 'up' ELSE 'down' END AS "pctChg", CAST(n % 7 AS VARCHAR) AS "peTTM", CAST(n % 5 AS VARCHAR) AS "pbMRQ", CAST(n % 3 AS VARCHAR) AS "psTTM", CAST(NULL AS VARCHAR) AS "pcfNcfTTM", CASE WHEN st THEN '1' ELSE '0' END AS "isST" FROM b""")
def daily_source(spark, sf_dir):
    """Daily rows of each kind with the eighteen text columns of the source, checked and in its order."""
    from pyspark.sql import Window

    text = lambda c: F.col(c).cast("decimal(18,2)").cast("string")
    d = table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("p"), F.to_date("o_orderdate").alias("day")).agg(F.min_by("o_totalprice", "o_orderkey").alias("o"), F.max("o_totalprice").alias("h"), F.min("o_totalprice").alias("l"), F.max_by("o_totalprice", "o_orderkey").alias("c"), F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("a"), F.bool_or(F.col("o_orderstatus") == "P").alias("st"))
    b = d.withColumn("pre", F.lag("c").over(Window.partitionBy("p").orderBy("day")))
    n = F.col("n")
    return b.select(
        F.col("day").cast("string").alias("date"), F.concat(F.lit("sh."), F.substring("p", 1, 1)).alias("code"), text("o").alias("open"), text("h").alias("high"), text("l").alias("low"), text("c").alias("close"), text("pre").alias("preclose"), n.cast("string").alias("volume"), text("a").alias("amount"), F.lit("3").alias("adjustflag"), (n * 2).cast("string").alias("turn"), F.when(n > 1, "1").otherwise("0").alias("tradestatus"),
        F.when(F.col("pre").isNotNull(), F.when(F.col("c") > F.col("pre"), "up").otherwise("down")).alias("pctChg"), (n % 7).cast("string").alias("peTTM"), (n % 5).cast("string").alias("pbMRQ"), (n % 3).cast("string").alias("psTTM"), F.lit(None).cast("string").alias("pcfNcfTTM"), F.when(F.col("st"), "1").otherwise("0").alias("isST"),
    )


@query("P11", """WITH t AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 4 = 0 THEN 'SH' || lpad(CAST(o_custkey AS VARCHAR), 6, '0') END AS a, CASE WHEN o_orderkey % 4 = 1 THEN 'sz.' || lpad(CAST(o_custkey AS VARCHAR), 6, '0') END AS b, CASE WHEN o_orderkey % 4 < 3 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS c FROM orders),
u AS (SELECT lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS six, CASE WHEN c_nationkey < 12 THEN 'SH' ELSE 'SZ' END || lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS id FROM customer WHERE c_custkey % 3 <> 0)
SELECT o_orderkey, coalesce(a, upper(left(b, 2)) || right(b, 6), u.id) AS id FROM t LEFT JOIN u ON u.six = lpad(c, 6, '0')""")
def market_ids(spark, sf_dir):
    """A market row's id from three spellings, the last by a lookup of its six digits."""
    k, text = F.col("o_orderkey") % 4, F.lpad(F.col("o_custkey").cast("string"), 6, "0")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.when(k == 0, F.concat(F.lit("SH"), text)).alias("a"), F.when(k == 1, F.concat(F.lit("sz."), text)).alias("b"), F.when(k == 3, F.col("o_custkey").cast("string")).alias("c"))
    code = F.lpad(F.col("c_custkey").cast("string"), 6, "0")
    lookup = table(spark, sf_dir, "customer").where("c_custkey % 3 <> 0").select(code.alias("six"), F.concat(F.when(F.col("c_nationkey") < 12, "SH").otherwise("SZ"), code).alias("found"))
    joined = rows.join(lookup, exprs.code6("c") == F.col("six"), "left")
    return joined.select("o_orderkey", F.coalesce(exprs.security_id("a"), exprs.security_id(F.regexp_replace("b", r"\.", "")), F.col("found")).alias("id"))


@query("P30", """SELECT event_id, coalesce(json_extract_string(d, '$.a.b'), json_extract_string(d, '$.a.c'), json_extract_string(d, '$.e')) AS v FROM (SELECT event_id, CASE event_id % 4 WHEN 0 THEN '{"a": {"b": "x", "c": "y"}}' WHEN 1 THEN '{"a": {"b": null, "c": "' || event_type || '"}}' WHEN 2 THEN '{"a": {}, "e": "' || user_id || '"}' ELSE '{}' END AS d FROM events)""")
def nested_paths(spark, sf_dir):
    """The first of several nested paths that holds a value."""
    k = F.col("event_id") % 4
    doc = F.when(k == 0, '{"a": {"b": "x", "c": "y"}}').when(k == 1, F.concat(F.lit('{"a": {"b": null, "c": "'), "event_type", F.lit('"}}'))).when(k == 2, F.concat(F.lit('{"a": {}, "e": "'), F.col("user_id").cast("string"), F.lit('"}'))).otherwise("{}")
    return table(spark, sf_dir, "events").select("event_id", F.coalesce(*(F.get_json_object(doc, p) for p in ("$.a.b", "$.a.c", "$.e"))).alias("v"))


@query("T4", """WITH now AS (SELECT c_custkey, sha256(CAST(c_nationkey AS VARCHAR) || chr(31) || c_mktsegment) AS h, CASE WHEN c_nationkey = 3 THEN 'v2' ELSE 'v1' END AS rule FROM customer), st AS (SELECT c_custkey, CASE WHEN c_custkey % 19 = 2 THEN 'old' ELSE h END AS h, 'v1' AS rule FROM now WHERE c_custkey % 23 <> 4)
SELECT now.c_custkey, CASE WHEN st.h IS NULL THEN 'new' WHEN st.h <> now.h THEN 'inputs' WHEN st.rule <> now.rule THEN 'rule' END AS why FROM now LEFT JOIN st USING (c_custkey) WHERE st.h IS NULL OR st.h <> now.h OR st.rule <> now.rule""")
def recomputed_members(spark, sf_dir):
    """Who must be computed again, and whether for new inputs or a new rule version; all others are left as they are."""
    now = table(spark, sf_dir, "customer").select("c_custkey", exprs.row_hash("c_nationkey", "c_mktsegment").alias("h"), F.when(F.col("c_nationkey") == 3, "v2").otherwise("v1").alias("rule"))
    before = now.where("c_custkey % 23 <> 4").select("c_custkey", F.when(F.col("c_custkey") % 19 == 2, "old").otherwise(F.col("h")).alias("h0"), F.lit("v1").alias("rule0"))
    why = F.when(F.col("h0").isNull(), "new").when(F.col("h0") != F.col("h"), "inputs").when(F.col("rule0") != F.col("rule"), "rule")
    return now.join(before, "c_custkey", "left").select("c_custkey", why.alias("why")).where("why is not null")


YEARS_OF = tuple(range(1995, 2002))
SLOT_NAMES = (*DERIVED, "interest_cover")


@query("F6", f"""WITH {TALL}, {DERIVED_SQL}, cv AS (SELECT s, y, 'interest_cover' AS feature, (revenue + tax) / nullif(tax, 0) AS value FROM wide), every AS (SELECT s, y, feature, value, status = 'not_applicable' AS na FROM f UNION ALL SELECT *, false FROM cv),
sp AS (SELECT s, y, feature FROM (SELECT DISTINCT s FROM years) CROSS JOIN (SELECT unnest([{', '.join(f"'{n}'" for n in (*DERIVED, 'interest_cover'))}]) AS feature) CROSS JOIN (SELECT unnest(generate_series(1995, 2001)) AS y)),
a AS (SELECT sp.s, sp.feature || '.' || sp.y AS slot, value, e.s IS NULL AS gone, coalesce(na, false) AS na FROM sp LEFT JOIN every e ON e.s = sp.s AND e.y = sp.y AND e.feature = sp.feature),
g AS (SELECT b.s, 'growth.' || b.y AS slot, 200 * (n.revenue - o.revenue) / nullif(abs(n.revenue) + abs(o.revenue), 0) AS value, n.s IS NULL OR o.s IS NULL AS gone, false AS na FROM (SELECT s, y FROM (SELECT DISTINCT s FROM years) CROSS JOIN (SELECT unnest(generate_series(1996, 2001)) AS y)) b LEFT JOIN wide n ON n.s = b.s AND n.y = b.y LEFT JOIN wide o ON o.s = b.s AND o.y = b.y - 1)
SELECT s, slot, CASE WHEN NOT na THEN round(value + 3e-8, 6) END AS value, CASE WHEN na THEN 'not_applicable' WHEN value IS NULL THEN 'missing' ELSE 'derived' END AS status, CASE WHEN na THEN 'template' WHEN gone THEN 'period_absent' WHEN value IS NULL THEN 'operand_missing' END AS reason FROM (SELECT * FROM a UNION ALL SELECT * FROM g)""")
def feature_catalogue(spark, sf_dir):
    """Ninety slots of each supplier: twelve metrics in seven years and six growth rates, each derived, missing or not applicable."""
    w = features.wide(tall(spark, sf_dir), ["s", "y"], "metric", "value", list(COLUMNS), "unit")
    made = features.derived({k: F.col(v) for k, v in STATEMENT.items()})
    rows = w.select("s", "y", "revenue", *(made[n].alias(n) for n in DERIVED), F.try_divide(F.col("revenue") + F.col("tax"), F.col("tax")).alias("interest_cover"))
    long = rows.select("s", "y", F.explode(F.array(*(F.struct(F.lit(n).alias("name"), F.col(n).alias("value")) for n in SLOT_NAMES))).alias("f")).select("s", F.concat_ws(".", "f.name", "y").alias("slot"), "f.value", ((F.col("s") % 4 == 0) & (F.col("f.name") == "accruals")).alias("na"))
    grown = periods.with_opening(rows, ["s"], "y", ["revenue"], F.col("y") - 1)
    before = rows.select("s", (F.col("y") + 1).alias("y"))
    grown = grown.join(before, ["s", "y"], "left_semi").select("s", F.concat(F.lit("growth."), F.col("y")).alias("slot"), exprs.symmetric_growth("revenue", "opening_revenue").alias("value"), F.lit(False).alias("na"))
    names = [*(f"{n}.{y}" for n in SLOT_NAMES for y in YEARS_OF), *(f"growth.{y}" for y in YEARS_OF[1:])]
    spine = rows.select("s").distinct().withColumn("slot", F.explode(F.array(*map(F.lit, names))))
    found = spine.join(long.unionByName(grown).withColumn("there", F.lit(True)), ["s", "slot"], "left")
    na, value = F.coalesce("na", F.lit(False)), F.col("value")
    status = F.when(na, "not_applicable").when(value.isNull(), "missing").otherwise("derived")
    reason = F.when(na, "template").when(F.col("there").isNull(), "period_absent").when(value.isNull(), "operand_missing")
    return found.select("s", "slot", F.when(~na, F.round(value + 3e-8, 6)).alias("value"), status.alias("status"), reason.alias("reason"))
