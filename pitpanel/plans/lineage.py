"""Queries of contexts, backing records, slots, bundles, sources, error classes and lifecycles."""

from pyspark.sql import functions as F

from pitpanel.operators import audit, lineage
from pitpanel.sources import snapshots

from .base import query, table
from .facts import DERIVED_SQL, TALL, _features, tall


@query("J7", """WITH m AS (SELECT c_custkey AS k, c_mktsegment AS industry, c_nationkey AS nation, CASE WHEN c_custkey % 6 = 1 THEN NULL ELSE c_name END AS name FROM customer),
x AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 11 = 3 THEN 'other' ELSE c_mktsegment END AS industry, c_nationkey + CASE WHEN c_custkey % 22 = 3 THEN 1 ELSE 0 END AS nation, CASE WHEN c_custkey % 6 = 1 AND c_custkey % 5 <> 0 THEN NULL ELSE c_name END AS name FROM customer WHERE c_custkey % 13 <> 5), y AS (SELECT * FROM x UNION ALL SELECT * FROM x WHERE k % 17 = 2), c AS (SELECT k, count(*) AS n, any_value(industry) AS industry, any_value(nation) AS nation, max(name) AS name FROM y GROUP BY 1)
SELECT m.k AS c_custkey, CASE WHEN n IS NULL THEN 'context_absent' WHEN n > 1 THEN 'context_ambiguous' WHEN m.industry IS DISTINCT FROM c.industry OR m.nation IS DISTINCT FROM c.nation OR m.name IS DISTINCT FROM c.name THEN 'differs:' || concat_ws(',', CASE WHEN m.industry IS DISTINCT FROM c.industry THEN 'industry' END, CASE WHEN m.nation IS DISTINCT FROM c.nation THEN 'nation' END, CASE WHEN m.name IS DISTINCT FROM c.name THEN 'name' END) END AS reason FROM m LEFT JOIN c ON c.k = m.k""")
def signed_contexts(spark, sf_dir):
    """Signed membership against the industry context in all columns, null-safely."""
    k = F.col("c_custkey")
    c = table(spark, sf_dir, "customer")
    signed = c.select("c_custkey", F.col("c_mktsegment").alias("industry"), F.col("c_nationkey").alias("nation"), F.when(k % 6 != 1, F.col("c_name")).alias("name"))
    context = c.where("c_custkey % 13 <> 5").select("c_custkey", F.when(k % 11 == 3, "other").otherwise(F.col("c_mktsegment")).alias("industry"), (F.col("c_nationkey") + (k % 22 == 3).cast("int")).alias("nation"), F.when((k % 6 != 1) | (k % 5 == 0), F.col("c_name")).alias("name"))
    context = context.unionByName(context.where("c_custkey % 17 = 2"))
    return lineage.context_reasons(signed, context, ["c_custkey"], ["industry", "nation", "name"]).select("c_custkey", "reason")


@query("J16", """WITH f AS (SELECT o_custkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderkey % 9 = 0), g AS (SELECT o_custkey, count(*) AS n, any_value(o_totalprice) AS p, any_value(o_orderstatus) AS st FROM f GROUP BY 1)
SELECT c_custkey, CASE WHEN n IS NULL THEN 'missing' WHEN n > 1 THEN 'ambiguous' ELSE 'built' END AS context_state, CASE WHEN n = 1 THEN p END AS price, CASE WHEN n = 1 THEN st END AS status FROM customer LEFT JOIN g ON o_custkey = c_custkey""")
def built_contexts(spark, sf_dir):
    """Candidates with the columns of their only performance row; without one, or with several, they say so."""
    rows = table(spark, sf_dir, "orders").where("o_orderkey % 9 = 0").select(F.col("o_custkey").alias("c_custkey"), F.col("o_totalprice").alias("price"), F.col("o_orderstatus").alias("status"))
    return lineage.built_context(table(spark, sf_dir, "customer").select("c_custkey"), rows, ["c_custkey"])


@query("J11 R5", """WITH r(template, rule_id, industries) AS (VALUES ('AFRICA', 'a', NULL), ('AFRICA', 'b', ['BUILDING', 'MACHINERY']), ('ASIA', 'c', ['FURNITURE']), ('EUROPE', 'd', []::VARCHAR[])), c AS (SELECT c_custkey, r_name AS template, CASE WHEN c_custkey % 7 <> 2 THEN c_mktsegment END AS industry FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey)
SELECT c_custkey, rule_id, CASE WHEN industries IS NULL THEN 'applicable' WHEN industry IS NULL THEN 'unresolved' WHEN list_contains(industries, industry) THEN 'applicable' ELSE 'not_applicable' END AS applicability FROM c JOIN r USING (template)""")
def applicable_rules(spark, sf_dir):
    """Rules of each customer's template with the set of industries to which they apply."""
    rules = spark.createDataFrame([("AFRICA", "a", None), ("AFRICA", "b", ["BUILDING", "MACHINERY"]), ("ASIA", "c", ["FURNITURE"]), ("EUROPE", "d", [])], "template string, rule_id string, industries array<string>")
    where = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("r_regionkey") == F.col("n_regionkey")).select(F.col("n_nationkey").alias("c_nationkey"), "r_name")
    rows = table(spark, sf_dir, "customer").join(where, "c_nationkey").withColumn("industry", F.when(F.col("c_custkey") % 7 != 2, F.col("c_mktsegment")))
    return lineage.applicable_rules(rows, rules, ["c_custkey"], "r_name", "industry")


@query("J9", """WITH r AS (SELECT l_orderkey, l_linenumber, l_suppkey, sha256(CAST(l_partkey AS VARCHAR) || chr(31) || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)) AS h FROM lineitem), st AS (SELECT DISTINCT l_suppkey + CASE WHEN l_orderkey % 5 = 0 THEN 1 ELSE 0 END AS k, h FROM r WHERE l_orderkey % 3 <> 1)
SELECT l_orderkey, l_linenumber, CASE WHEN h IN (SELECT h FROM st) THEN 'other_key' ELSE 'unbacked' END AS reason FROM r WHERE NOT EXISTS (SELECT 1 FROM st WHERE st.k = r.l_suppkey AND st.h = r.h)""")
def unbacked_rows(spark, sf_dir):
    """Lines that no stored record of their supplier backs by hash."""
    from pitpanel.functions.exprs import row_hash

    rows = table(spark, sf_dir, "lineitem").withColumn("_q", F.col("l_quantity").cast("long")).select("l_orderkey", "l_linenumber", "l_suppkey", row_hash("l_partkey", "_q").alias("h"))
    stored = rows.where("l_orderkey % 3 <> 1").select((F.col("l_suppkey") + (F.col("l_orderkey") % 5 == 0).cast("int")).alias("l_suppkey"), "h")
    return lineage.unbacked(rows, stored, "l_suppkey", "h").select("l_orderkey", "l_linenumber", "reason")


DATASETS = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", "9-NEVER")


@query("J10", """WITH sl AS (SELECT c_custkey, dataset FROM customer CROSS JOIN (VALUES ('1-URGENT'), ('2-HIGH'), ('3-MEDIUM'), ('4-NOT SPECIFIED'), ('5-LOW'), ('9-NEVER')) d(dataset)),
j AS (SELECT o_custkey, o_orderpriority, max(o_orderkey) AS job, arg_max(CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'pending' ELSE 'failed' END, o_orderkey) AS status FROM orders GROUP BY 1, 2), s AS (SELECT o_custkey, o_orderpriority, o_orderkey AS job, o_orderkey % 4 <> 1 AS verified FROM orders WHERE o_orderkey % 5 <> 2)
SELECT c_custkey, dataset, CASE WHEN j.job IS NULL THEN 'never_asked' WHEN status <> 'done' THEN status WHEN s.job IS NULL THEN 'done_without_snapshot' WHEN NOT verified THEN 'unverified' ELSE 'verified' END AS gap FROM sl LEFT JOIN j ON j.o_custkey = c_custkey AND j.o_orderpriority = dataset LEFT JOIN s ON s.o_custkey = c_custkey AND s.o_orderpriority = dataset AND s.job = j.job""")
def slot_states(spark, sf_dir):
    """Every member's every dataset through its newest job and that job's snapshot."""
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderpriority").alias("dataset"), F.col("o_orderkey").alias("job"), F.when(F.col("o_orderstatus") == "F", "done").when(F.col("o_orderstatus") == "O", "pending").otherwise("failed").alias("status"))
    snaps = o.where("job % 5 <> 2").withColumn("verified", F.col("job") % 4 != 1)
    return lineage.slot_states(table(spark, sf_dir, "customer"), DATASETS, o, snaps, "c_custkey")


@query("P5", """WITH t AS (SELECT o_orderkey AS k, CASE o_orderkey % 4 WHEN 0 THEN '1,200' WHEN 1 THEN 'n/a' WHEN 2 THEN NULL ELSE ' ' END AS a, CASE WHEN o_orderkey % 3 = 0 THEN 'inf' ELSE CAST(o_orderkey AS VARCHAR) END AS b, CASE WHEN o_orderkey % 5 = 0 THEN 'x' END AS c FROM orders),
p AS (SELECT k, unnest(['revenue', 'revenue', 'cost']) AS metric, unnest(['a', 'b', 'c']) AS alias, unnest([1, 2, 1]) AS place, unnest([a, b, c]) AS x FROM t), v AS (SELECT *, CASE WHEN regexp_full_match(regexp_replace(trim(x), ',|%$', '', 'g'), '[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?') THEN CAST(regexp_replace(trim(x), ',|%$', '', 'g') AS DOUBLE) END AS n FROM p)
SELECT k, metric, arg_min(alias, place) AS alias, arg_min(n, place) AS value, CAST(NULL AS VARCHAR) AS issue FROM v WHERE n IS NOT NULL GROUP BY 1, 2 UNION ALL SELECT k, metric, alias, NULL, 'invalid_financial_value' FROM v WHERE n IS NULL AND trim(coalesce(x, '')) <> ''""")
def resolved_values(spark, sf_dir):
    """The first alias with a finite value, and an issue row for every alias that holds something else."""
    k = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(k.alias("k"), F.when(k % 4 == 0, "1,200").when(k % 4 == 1, "n/a").when(k % 4 == 3, " ").alias("a"), F.when(k % 3 == 0, "inf").otherwise(k.cast("string")).alias("b"), F.when(k % 5 == 0, "x").alias("c"))
    return lineage.resolved_values(rows, ["k"], {"revenue": ("a", "b"), "cost": ("c",)})


@query("S5 S24", """WITH v AS (SELECT user_id, event_type, event_id, date_trunc('day', ts) AS published, date_trunc('hour', ts) + INTERVAL 2 HOUR AS captured, sha256(CAST(event_id % 97 AS VARCHAR)) AS content FROM events WHERE event_id % 7 <> 3 AND event_id % 11 <> 4 AND event_id % 13 <> 5)
SELECT event_id, CAST(row_number() OVER (PARTITION BY user_id, event_type ORDER BY published DESC, captured DESC, content, event_id) AS INTEGER) AS place, content FROM v WHERE published <= TIMESTAMP '2024-01-20 12:00:00' AND captured <= TIMESTAMP '2024-01-20 12:00:00'""")
def exact_revisions(spark, sf_dir):
    """All revisions of each request that were visible and made by one parser, contract and mapping, in winner order."""
    k = F.col("event_id")
    by = lambda n, r, name: F.when(k % n == r, "v1").otherwise("v2").alias(name)
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.date_trunc("day", "ts").alias("published"), (F.date_trunc("hour", "ts") + F.expr("INTERVAL 2 HOURS")).alias("captured"), F.concat(F.sha2((k % 97).cast("string"), 256), F.lit(":"), F.lpad(k.cast("string"), 12, "0")).alias("content"), by(7, 3, "parser"), by(11, 4, "contract"), by(13, 5, "mapping"))
    out = lineage.exact_revisions(rows, ["user_id", "event_type"], ("parser", "contract", "mapping"), ("v2", "v2", "v2"), "published", "captured", "content", F.to_timestamp(F.lit("2024-01-20 12:00:00")))
    return out.select("event_id", "place", F.substring("content", 1, 64).alias("content"))


@query("S21", """WITH b AS (SELECT o_orderkey AS bundle, o_custkey AS k, o_orderpriority AS contract, sha256(CAST(o_orderkey // 2 AS VARCHAR)) AS h, o_orderdate AS at_ FROM orders), w AS (SELECT c_custkey AS k, '1-URGENT' AS contract, sha256(CAST(c_custkey * 3 AS VARCHAR)) AS h FROM customer)
SELECT w.k AS c_custkey, (SELECT arg_max(bundle, (at_, bundle)) FROM b WHERE b.h = w.h) AS by_hash, (SELECT arg_max(bundle, (at_, bundle)) FROM b WHERE b.k = w.k AND b.contract = w.contract) AS latest FROM w""")
def bundle_lookups(spark, sf_dir):
    """A bundle by its input hash, and the newest one of a security and contract."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("bundle"), F.col("o_custkey").alias("c_custkey"), F.col("o_orderpriority").alias("contract"), F.sha2(F.expr("o_orderkey div 2").cast("string"), 256).alias("input_hash"), F.col("o_orderdate").alias("at"))
    wanted = table(spark, sf_dir, "customer").select("c_custkey", F.lit("1-URGENT").alias("contract"), F.sha2((F.col("c_custkey") * 3).cast("string"), 256).alias("input_hash"))
    return lineage.bundle_lookups(wanted, o, "input_hash", ["c_custkey", "contract"], "at").select("c_custkey", "by_hash", "latest")


PLACES = {"gross_profit": "G", "gross_margin": "M", "ebit": "G", "tax_rate": "EQ", "nopat": "G", "free_cash": "EQ", "debt": "FS", "net_debt": "FS", "invested_capital": "CA", "working_capital": "FS", "accruals": "EQ"}


@query("A10", f"WITH {TALL}, {DERIVED_SQL}, p(feature, dimension) AS (VALUES {', '.join(f'({f!r}, {d!r})' for f, d in PLACES.items())}) SELECT s, y, dimension, CASE WHEN bool_and(status IN ('derived', 'not_applicable')) THEN 'ready' WHEN NOT bool_or(status = 'derived') THEN 'blocked' ELSE 'partial' END AS state FROM f JOIN p USING (feature) GROUP BY 1, 2, 3")
def dimension_states(spark, sf_dir):
    """Each dimension's state from the set of its slots' states."""
    place = F.coalesce(*(F.when(F.col("feature") == f, F.lit(d)) for f, d in PLACES.items()))
    return _features(spark, sf_dir).groupBy("s", "y", place.alias("dimension")).agg(audit.dimension_state(["derived", "not_applicable"]).alias("state"))


@query("A29", """WITH c AS (SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'estate' WHEN 'FURNITURE' THEN 'goods' WHEN 'MACHINERY' THEN 'goods' ELSE 'unclassified' END AS template, CASE WHEN n = 0 THEN 'no_orders' WHEN c_acctbal < 0 THEN 'negative_balance' END AS reason, CASE WHEN n = 0 THEN 'blocked' WHEN c_acctbal < 0 THEN 'partial' ELSE 'ready' END AS state FROM (SELECT *, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS n FROM customer))
SELECT 'template' AS kind, template AS name, count(*) AS n FROM c GROUP BY 2 UNION ALL SELECT 'missing_reason', reason, count(*) FROM c WHERE reason IS NOT NULL GROUP BY 2 UNION ALL SELECT 'state', state, count(*) FROM c GROUP BY 2""")
def status_summary(spark, sf_dir):
    """Template, state and missing-reason counts in one pass."""
    n = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"))
    rows = table(spark, sf_dir, "customer").join(n, "c_custkey", "left")
    seg, none, low = F.col("c_mktsegment"), F.col("n").isNull(), F.col("c_acctbal") < 0
    kinds = {"template": F.when(seg == "BUILDING", "estate").when(seg.isin("FURNITURE", "MACHINERY"), "goods").otherwise("unclassified"), "missing_reason": F.when(none, "no_orders").when(low, "negative_balance"), "state": F.when(none, "blocked").when(low, "partial").otherwise("ready")}
    return lineage.named_counts(rows, kinds)


@query("A32", """WITH h AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 10 = 3 THEN 0.5 ELSE least((SELECT count(*) FROM range(1, 5) t(i) WHERE i <= 4 AND (o_orderkey + i) % 6 <> 0), 4) / 4.0 END AS coverage FROM orders),
v AS (SELECT k, 's' || i AS slot, CASE WHEN (k + i) % 6 <> 0 THEN i END AS value FROM (SELECT o_orderkey AS k, unnest([1, 2, 3, 4]) AS i FROM orders) WHERE NOT (k % 17 = 5 AND i = 2) UNION ALL SELECT o_orderkey, 's9', 1 FROM orders WHERE o_orderkey % 19 = 6 UNION ALL SELECT o_orderkey, 's1', 7 FROM orders WHERE o_orderkey % 23 = 7),
g AS (SELECT k, slot, count(*) AS n, count(value) AS c FROM v GROUP BY 1, 2), a AS (SELECT k, count(*) FILTER (WHERE slot <> 's9') AS e, count(*) FILTER (WHERE slot = 's9') AS f, count(*) FILTER (WHERE slot <> 's9' AND n > 1) AS r, count(*) FILTER (WHERE slot <> 's9' AND c > 0) AS c FROM g GROUP BY 1),
x AS (SELECT h.k, concat_ws(',', CASE WHEN e < 4 THEN 'absent:' || (4 - e) END, CASE WHEN f > 0 THEN 'foreign:' || f END, CASE WHEN r > 0 THEN 'repeated:' || r END, CASE WHEN abs(coverage - c / 4.0) > 1e-9 THEN 'coverage' END) AS errors FROM h JOIN a USING (k)) SELECT * FROM x WHERE errors <> ''""")
def bundle_errors(spark, sf_dir):
    """Bundles whose slots aren't exactly the expected ones or whose coverage isn't what their values give."""
    k = F.col("k")
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"))
    there = sum((((k + i) % 6 != 0).cast("int") for i in (1, 2, 3, 4)), F.lit(0))
    headers = o.withColumn("coverage", F.when(k % 10 == 3, 0.5).otherwise(there / 4))
    slot = lambda name, value: F.struct(F.lit(name).alias("slot"), value.cast("int").alias("value"))
    made = [F.when(~((k % 17 == 5) & F.lit(i == 2)), slot(f"s{i}", F.when((k + i) % 6 != 0, i))) for i in (1, 2, 3, 4)] + [F.when(k % 19 == 6, slot("s9", F.lit(1))), F.when(k % 23 == 7, slot("s1", F.lit(7)))]
    values = o.select("k", F.explode(F.array_compact(F.array(*made))).alias("v")).select("k", "v.*")
    return lineage.bundle_errors(headers, values, ["k"], ("s1", "s2", "s3", "s4"), "coverage").select("k", F.array_join("errors", ",").alias("errors"))


@query("R13", f"""WITH {TALL}, m(metric, need) AS (VALUES ('revenue', 'CNY'), ('discounts', 'CNY'), ('tax', 'CNY'), ('margin', 'CNY')), k AS (SELECT DISTINCT s, y FROM tall), e AS (SELECT s, y, metric, list_sort(list(DISTINCT s || '-' || y || '-' || metric || '-' || unit)) AS ids FROM tall GROUP BY 1, 2, 3)
SELECT k.s, k.y, m.metric, CASE WHEN t.unit = need AND k.s % 8 <> 5 THEN round(t.value, 4) END AS value, coalesce(array_to_string(ids, ','), '') AS evidence, t.unit = need AND k.s % 8 <> 5 IS TRUE AS eligible, CASE WHEN t.metric IS NULL THEN 'absent' WHEN t.unit <> need THEN 'unit' WHEN k.s % 8 = 5 THEN 'not_eligible' END AS reason FROM k CROSS JOIN m LEFT JOIN tall t ON t.s = k.s AND t.y = k.y AND t.metric = m.metric LEFT JOIN e ON e.s = k.s AND e.y = k.y AND e.metric = m.metric""".replace("t.unit = need AND k.s % 8 <> 5 IS TRUE AS eligible", "coalesce(t.unit = need AND k.s % 8 <> 5, false) AS eligible"))
def eligible_metrics(spark, sf_dir):
    """Every registered metric of every supplier-year with value, evidence ids, eligibility and the first reason why not."""
    facts = tall(spark, sf_dir).withColumn("id", F.concat_ws("-", "s", "y", "metric", "unit"))
    need = F.array(*(F.struct(F.lit(m).alias("metric"), F.lit("CNY").alias("need")) for m in ("revenue", "discounts", "tax", "margin")))
    slots = facts.select("s", "y").distinct().select("s", "y", F.explode(need).alias("m")).select("s", "y", "m.*")
    own = facts.groupBy("s", "y", "metric").agg(F.max("value").alias("v"), F.max("unit").alias("unit"), F.array_sort(F.collect_set("id")).alias("ids"))
    fits, member = F.coalesce(F.col("unit") == F.col("need"), F.lit(False)), F.col("s") % 8 != 5
    reason = F.when(F.col("unit").isNull(), "absent").when(~fits, "unit").when(~member, "not_eligible")
    return slots.join(own, ["s", "y", "metric"], "left").select("s", "y", "metric", F.when(fits & member, F.round("v", 4)).alias("value"), F.coalesce(F.array_join("ids", ","), F.lit("")).alias("evidence"), (fits & member).alias("eligible"), reason.alias("reason"))


@query("U2", """WITH e AS (SELECT s_suppkey AS id, 'north' AS part FROM supplier WHERE s_suppkey % 3 <> 1 UNION ALL SELECT s_suppkey, 'south' FROM supplier WHERE s_suppkey % 3 = 1 OR s_suppkey % 10 = 2 UNION ALL SELECT s_suppkey + 100000, 'east' FROM supplier UNION ALL SELECT s_suppkey, 'east' FROM supplier WHERE s_suppkey % 20 = 2)
SELECT id, part, count(*) OVER (PARTITION BY id) > 1 AS repeated FROM e""")
def required_sources(spark, sf_dir):
    """Three extracts, all of them required, with ids that stand in several."""
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"))
    parts = {"north": s.where("id % 3 <> 1"), "south": s.where("id % 3 = 1 OR id % 10 = 2"), "east": s.select((F.col("id") + 100000).alias("id")).unionByName(s.where("id % 20 = 2"))}
    return lineage.required_union(parts, "id")


@query("P31", """WITH t AS (SELECT event_id, CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 'running' WHEN 2 THEN 'pending' ELSE 'failed' END AS st, CASE event_id % 9 WHEN 0 THEN 'retryable' WHEN 1 THEN 'blocked' WHEN 2 THEN 'terminal_source' WHEN 3 THEN 'target_period_missing' WHEN 4 THEN 'unverified_snapshot' WHEN 5 THEN 'retryable_source' WHEN 6 THEN 'source_blocked' WHEN 7 THEN 'strange' END AS raw FROM events),
c AS (SELECT CASE WHEN st IS NULL OR st IN ('running', 'pending') THEN 'pending' WHEN raw IN ('retryable', 'retryable_source') THEN 'retryable_network' WHEN raw IN ('blocked', 'source_blocked') THEN 'source_blocked' WHEN raw = 'terminal_source' THEN 'terminal_source_missing' WHEN raw IN ('target_period_missing', 'unverified_snapshot') THEN raw END AS class FROM t) SELECT class, count(*) AS n FROM c GROUP BY 1""")
def error_classes(spark, sf_dir):
    """Jobs by the class of their error."""
    k = F.col("event_id")
    raw = F.coalesce(*(F.when(k % 9 == i, v) for i, v in enumerate(("retryable", "blocked", "terminal_source", "target_period_missing", "unverified_snapshot", "retryable_source", "source_blocked", "strange"))))
    status = F.when(k % 5 == 1, "running").when(k % 5 == 2, "pending").when(k % 5 > 2, "failed")
    return table(spark, sf_dir, "events").groupBy(lineage.error_class(status, raw).alias("class")).agg(F.count(F.lit(1)).alias("n"))


@query("P34 A25", """WITH g AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n, CASE WHEN bool_or(o_orderstatus = 'P') THEN 'pending' ELSE 'passed' END AS reviewed, CASE WHEN bool_or(o_orderkey % 50 = 9) THEN 'failed' ELSE 'passed' END AS proven, CASE WHEN count(DISTINCT o_orderpriority) < 2 THEN 'pending' ELSE 'passed' END AS spread FROM orders GROUP BY 1)
SELECT day, CASE WHEN proven = 'failed' THEN 'draft' WHEN reviewed = 'pending' OR spread = 'pending' THEN 'provisional' ELSE 'final' END AS state, concat_ws(',', CASE WHEN proven <> 'passed' THEN 'proven' END, CASE WHEN reviewed <> 'passed' THEN 'reviewed' END, CASE WHEN spread <> 'passed' THEN 'spread' END) AS open, CASE WHEN proven = 'passed' AND reviewed = 'passed' AND spread = 'passed' THEN n END AS shown FROM g""")
def lifecycles(spark, sf_dir):
    """Days with the state that their gates give them, the gates that are open, and counts that only final days show."""
    g = table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("n"), F.when(F.bool_or(F.col("o_orderstatus") == "P"), "pending").otherwise("passed").alias("reviewed"), F.when(F.bool_or(F.col("o_orderkey") % 50 == 9), "failed").otherwise("passed").alias("proven"), F.when(F.countDistinct("o_orderpriority") < 2, "pending").otherwise("passed").alias("spread"))
    rows = g.select("day", F.explode(F.array(*(F.struct(F.lit(n).alias("gate"), F.col(n).alias("status")) for n in ("reviewed", "proven", "spread")))).alias("g")).select("day", "g.*")
    return lineage.lifecycle(rows, g.select("day", "n"), ["day"]).withColumn("open", F.array_join("open", ","))


@query("K4", """WITH d AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1), c AS (SELECT day, dayofweek(day) NOT IN (0, 6) AND n > 1 AS is_open FROM d WHERE day <= DATE '1998-03-01')
SELECT day, is_open, (SELECT max(day) FROM c WHERE is_open) AS latest FROM c ORDER BY day DESC LIMIT 10""")
def calendar_evidence(spark, sf_dir):
    """The last ten calendar rows up to the allowed day, and the latest trading day among all."""
    days = table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return lineage.evidence_days(days, "day", ~F.dayofweek("day").isin(1, 7) & (F.col("n") > 1), F.lit("1998-03-01").cast("date"))


@query("S12 S13", """WITH t AS (SELECT page_id, CASE WHEN page_id % 23 = 4 THEN 'Access Denied' ELSE url END AS title, DATE '2024-04-01' + CAST(page_id % 30 AS INTEGER) AS due, CASE WHEN page_id % 19 = 2 THEN NULL ELSE CAST(length(html) AS DOUBLE) END AS size FROM pages)
SELECT page_id AS announcement_id, CASE WHEN title <> 'Access Denied' OR true THEN title END AS title, CASE WHEN page_id % 17 = 1 THEN NULL ELSE strftime(due, '%Y-%m-%d') || CASE WHEN page_id % 2 = 0 THEN 'T08:30:15' ELSE 'T00:00:00' END END AS announced, size, regexp_matches(lower(title), '<html|captcha|access denied') AS quarantined FROM t""")
def announcements(spark, sf_dir):
    """Announcement metadata: required columns renamed, instants as ISO text, numbers made finite, challenge pages set apart; an empty source is an error."""
    k = F.col("page_id")
    day = F.date_add(F.lit("2024-04-01").cast("date"), (k % 30).cast("int")).cast("timestamp")
    at = F.when(k % 17 != 1, day + F.when(k % 2 == 0, F.expr("INTERVAL '08:30:15' HOUR TO SECOND")).otherwise(F.expr("INTERVAL '00:00:00' HOUR TO SECOND")))
    raw = snapshots.not_empty(table(spark, sf_dir, "pages"), "pages").select("page_id", F.when(k % 23 == 4, "Access Denied").otherwise(F.col("url")).alias("url"), at.alias("at"), F.when(k % 19 == 2, F.lit(float("nan"))).otherwise(F.length("html").cast("double")).alias("size"))
    clean, bad = snapshots.sanitized(snapshots.required(raw, {"page_id": "announcement_id", "url": "title", "at": "announced", "size": "size"}), ["title"], ["size"], ["announced"])
    return clean.withColumn("quarantined", F.lit(False)).unionByName(bad.withColumn("quarantined", F.lit(True)))


@query("S11", """WITH t AS (SELECT l_suppkey AS k, 'income' AS statement, CASE l_orderkey % 4 WHEN 0 THEN '1997-06-30' WHEN 1 THEN '1997-06-30 00:00:00' ELSE '1997-03-31' END AS rd FROM lineitem UNION ALL SELECT o_custkey, 'balance', CASE o_orderkey % 3 WHEN 0 THEN '1997-06-30' ELSE '1997-03-31 00:00:00' END FROM orders UNION ALL SELECT s_suppkey, 'cash', CASE s_suppkey % 5 WHEN 0 THEN '1997-06-30 00:00:00' ELSE '1996-12-31' END FROM supplier)
SELECT k, statement, count(*) FILTER (WHERE rd LIKE '1997-06-30%') AS target_rows, count(*) FILTER (WHERE rd LIKE '1997-06-30%') > 0 AS present, count(*) FILTER (WHERE rd LIKE '% 00:00:00') AS repairable FROM t GROUP BY 1, 2""")
def statement_sources(spark, sf_dir):
    """The target period's rows in three statement sources, each with its own spellings of the date."""
    k = F.col("l_orderkey")
    income = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("k"), F.when(k % 4 == 0, "1997-06-30").when(k % 4 == 1, "1997-06-30 00:00:00").otherwise("1997-03-31").alias("rd"))
    balance = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), F.when(F.col("o_orderkey") % 3 == 0, "1997-06-30").otherwise("1997-03-31 00:00:00").alias("rd"))
    cash = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), F.when(F.col("s_suppkey") % 5 == 0, "1997-06-30 00:00:00").otherwise("1996-12-31").alias("rd"))
    rows = None
    for name, df in (("income", income), ("balance", balance), ("cash", cash)):
        own = df.withColumns({"statement": F.lit(name), "notice": F.lit(None).cast("string")})
        rows = own if rows is None else rows.unionByName(own)
    return snapshots.period_rows(rows, ["k", "statement"], "rd", "1997-06-30", "notice").drop("notice_dates")
