"""Queries of the contracts: identities, facts, evidence, audits, market rows and lookups over the test tables."""

from pyspark.sql import functions as F

from pitpanel.functions import exprs
from pitpanel.functions.shared import new_path
from pitpanel.operators import contracts, score
from pitpanel.operators.maintained import MaintainedRanks
from pitpanel.sources import snapshots

from .base import query, table


@query("P13", """WITH t AS (SELECT c_custkey, c_nationkey, CASE WHEN c_custkey % 211 = 5 THEN '' WHEN c_custkey % 197 = 7 THEN 'x1' ELSE lpad(CAST(c_custkey AS VARCHAR), 6, '0') END AS code,
 CASE WHEN c_custkey % 211 = 5 OR c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 173 = 11 THEN '000000.SH' ELSE lpad(CAST(c_custkey AS VARCHAR), 6, '0') || CASE WHEN c_custkey % 181 = 13 THEN '.SZ' ELSE '.SH' END END AS full_code, 'SH' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS id FROM customer),
e AS (SELECT *, CASE WHEN code = '' AND full_code IS NULL THEN 'missing' WHEN code <> '' AND NOT regexp_full_match(code, '[0-9]{6}') THEN 'invalid' WHEN full_code IS NOT NULL AND code <> '' AND code <> left(full_code, 6) THEN 'mismatch' WHEN coalesce(right(full_code, 2) || left(full_code, 6), 'SH' || code) <> id THEN 'mismatch' END AS error FROM t)
SELECT c_custkey, error, count(error) OVER (PARTITION BY c_nationkey) = 0 AS batch_ok FROM e""")
def statement_identities(spark, sf_dir):
    """Two code columns against the expected id; one bad row spoils its nation's batch."""
    k = F.col("c_custkey")
    text = F.lpad(k.cast("string"), 6, "0")
    code = F.when(k % 211 == 5, "").when(k % 197 == 7, "x1").otherwise(text)
    full = F.when((k % 211 == 5) | (k % 3 == 0), None).when(k % 173 == 11, "000000.SH").otherwise(F.concat(text, F.when(k % 181 == 13, ".SZ").otherwise(".SH")))
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", contracts.identity_error(code, full, F.concat(F.lit("SH"), text)).alias("error"))
    return contracts.sound_batches(rows, ["c_nationkey"], "error").select("c_custkey", "error", "batch_ok")


@query("P16 P19", """WITH t AS (SELECT o_orderkey AS k, CASE o_orderkey % 4 WHEN 0 THEN 'balance' WHEN 1 THEN 'income' WHEN 2 THEN 'cash_flow' ELSE 'income' END AS statement, CASE WHEN o_orderkey % 4 = 3 THEN 'revenue' WHEN o_orderkey % 8 = 2 THEN 'operating_cash_flow' ELSE 'other' END AS metric,
 CASE WHEN o_orderkey % 31 = 0 THEN 'flow' WHEN o_orderkey % 4 = 0 OR o_orderkey % 29 = 1 THEN 'instant' ELSE 'duration' END AS nature, last_day(CAST(o_orderdate AS DATE)) AS pe, CAST(o_orderdate AS TIMESTAMP) AS ann, o_totalprice AS v FROM orders),
f AS (SELECT *, CASE WHEN nature = 'instant' THEN NULL WHEN k % 23 = 2 THEN pe ELSE date_trunc('year', pe) END AS ps, CASE strftime(pe, '%m-%d') WHEN '12-31' THEN 'FY' WHEN '06-30' THEN 'H1' WHEN '03-31' THEN 'Q1' WHEN '09-30' THEN 'Q3' ELSE 'OTHER' END AS right_kind, CASE WHEN k % 19 = 3 THEN 'USD' ELSE 'CNY' END AS unit, CASE WHEN k % 17 = 4 THEN ann - INTERVAL 1 HOUR ELSE ann END AS eff, CASE WHEN k % 13 = 5 THEN ann + INTERVAL 1 DAY WHEN k % 2 = 0 THEN ann END AS upd FROM t)
SELECT k AS o_orderkey, CASE WHEN metric = 'revenue' THEN 'G' WHEN statement = 'income' THEN 'M' WHEN metric = 'operating_cash_flow' THEN 'EQ' WHEN statement = 'cash_flow' THEN 'CA' ELSE 'FS' END AS dimension,
 concat_ws(',', CASE WHEN nature = 'flow' THEN 'nature' END, CASE WHEN (nature = 'instant') <> (statement = 'balance') THEN 'statement' END, CASE WHEN k % 37 = 6 AND right_kind <> 'FY' THEN 'period_kind' END, CASE WHEN nature <> 'instant' AND ps <> date_trunc('year', pe) THEN 'start' END, CASE WHEN k % 41 = 7 THEN 'value' END, CASE WHEN unit = 'USD' THEN 'unit' END, CASE WHEN eff < ann OR eff < upd THEN 'effective' END) AS broken FROM f""")
def fact_contracts(spark, sf_dir):
    """Which rules each fact breaks, and the dimension it feeds."""
    k, at = F.col("o_orderkey"), F.col("o_orderdate").cast("timestamp")
    end = F.last_day(F.to_date("o_orderdate"))
    nature = F.when(k % 31 == 0, "flow").when((k % 4 == 0) | (k % 29 == 1), "instant").otherwise("duration")
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(k % 4 == 0, "balance").when(k % 4 == 2, "cash_flow").otherwise("income").alias("statement"), F.when(k % 4 == 3, "revenue").when(k % 8 == 2, "operating_cash_flow").otherwise("other").alias("metric"), nature.alias("nature"), end.alias("period_end"),
        F.when(nature == "instant", None).when(k % 23 == 2, end).otherwise(F.trunc(end, "year")).alias("period_start"), F.when(k % 37 == 6, "FY").otherwise(exprs.period_kind(end)).alias("period_kind"), F.when(k % 41 == 7, F.lit(float("nan"))).otherwise(F.col("o_totalprice")).alias("value"), F.when(k % 19 == 3, "USD").otherwise("CNY").alias("unit"),
        at.alias("announced_at"), F.when(k % 17 == 4, at - F.expr("INTERVAL 1 HOUR")).otherwise(at).alias("effective_at"), F.when(k % 13 == 5, at + F.expr("INTERVAL 1 DAY")).when(k % 2 == 0, at).alias("updated_at"),
    )
    return rows.select("o_orderkey", contracts.raw_dimension(F.col("metric"), F.col("statement")).alias("dimension"), F.array_join(contracts.fact_violations(), ",").alias("broken"))


@query("P26", r"""WITH t AS (SELECT page_id AS k, CASE WHEN page_id % 3 = 0 THEN 'https://www.Example.org/a' WHEN page_id % 3 = 1 THEN 'http://example.org/b?q=1' ELSE url END AS u, TIMESTAMP '2024-03-01 00:00:00' + INTERVAL (page_id % 900) HOUR AS cap FROM pages),
f AS (SELECT *, lower(regexp_extract(u, '^([A-Za-z]+)://', 1)) AS scheme, lower(regexp_extract(u, '^[A-Za-z]+://([^/:?#]+)', 1)) AS host, CASE WHEN k % 11 = 0 THEN NULL ELSE cap - INTERVAL (k % 7) HOUR END AS pub, CASE WHEN k % 5 = 0 THEN 'date_only' WHEN k % 53 = 1 THEN 'about' ELSE 'timestamp' END AS prec, CASE WHEN k % 10 = 0 OR k % 59 = 2 THEN 'cal' END AS bind FROM t),
r AS (SELECT k, list_sort(list_filter([CASE WHEN bind IS NULL AND prec = 'date_only' THEN 'calendar_binding_missing' END, CASE WHEN bind IS NOT NULL AND prec = 'timestamp' THEN 'calendar_binding_forbidden' END, CASE WHEN k % 13 = 1 AND pub IS NOT NULL THEN 'effective_before_publication' END, CASE WHEN host NOT IN ('www.example.org', 'example.org') THEN 'host_not_allowed' END, CASE WHEN k % 17 = 3 THEN 'identity_mismatch' END, CASE WHEN prec = 'about' THEN 'invalid_precision' END, CASE WHEN scheme <> 'https' THEN 'not_https' END, CASE WHEN pub IS NULL THEN 'published_missing' END], lambda x: x IS NOT NULL)) AS reasons FROM f)
SELECT k AS page_id, CASE WHEN len(reasons) = 0 THEN 'verified' ELSE 'rejected' END AS status, coalesce(array_to_string(reasons, ','), '') AS reasons FROM r""")
def evidence_acceptance(spark, sf_dir):
    k = F.col("page_id")
    url = F.when(k % 3 == 0, "https://www.Example.org/a").when(k % 3 == 1, "http://example.org/b?q=1").otherwise(F.col("url"))
    captured = F.to_timestamp(F.lit("2024-03-01 00:00:00")) + F.make_dt_interval(hours=(k % 900).cast("int"))
    published = F.when(k % 11 != 0, captured - F.make_dt_interval(hours=(k % 7).cast("int")))
    effective = F.when(k % 13 == 1, published - F.expr("INTERVAL 1 MINUTE")).otherwise(published)
    precision = F.when(k % 5 == 0, "date_only").when(k % 53 == 1, "about").otherwise("timestamp")
    binding = F.when((k % 10 == 0) | (k % 59 == 2), "cal")
    reasons = contracts.evidence_reasons(url, ["www.example.org", "example.org"], k % 17 != 3, published, effective, captured, precision, binding)
    return table(spark, sf_dir, "pages").select("page_id", F.when(F.size(reasons) == 0, "verified").otherwise("rejected").alias("status"), F.array_join(reasons, ",").alias("reasons"))


@query("P25", "SELECT c_custkey, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'out_of_scope' WHEN o_custkey IS NULL THEN 'pending_evidence' WHEN c_acctbal < 0 OR late > 20 THEN 'pool_vetoed' ELSE 'formal_scored' END AS status FROM customer LEFT JOIN (SELECT o_custkey, count(*) FILTER (WHERE o_orderstatus = 'O') AS late FROM orders GROUP BY 1) ON o_custkey = c_custkey")
def universe_statuses(spark, sf_dir):
    seen = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count_if(F.col("o_orderstatus") == "O").alias("late"))
    rows = table(spark, sf_dir, "customer").join(seen, F.col("o_custkey") == F.col("c_custkey"), "left")
    vetoes = F.array_compact(F.array(F.when(F.col("c_acctbal") < 0, "negative"), F.when(F.col("late") > 20, "late")))
    return rows.select("c_custkey", contracts.universe_status(F.col("c_mktsegment") != "MACHINERY", F.col("o_custkey").isNotNull(), vetoes).alias("status"))


@query("A12 S18", """WITH d AS (SELECT n_nationkey AS c_nationkey, CAST(coalesce(n, 0) + CASE WHEN n_nationkey % 8 = 3 THEN 1 ELSE 0 END AS BIGINT) AS row_count FROM nation LEFT JOIN (SELECT c_nationkey AS k, count(*) AS n FROM customer GROUP BY 1) ON k = n_nationkey),
t AS (SELECT c_nationkey, CASE WHEN c_custkey % 97 <> 4 THEN c_mktsegment END AS kind FROM customer), a AS (SELECT c_nationkey AS k, count(*) FILTER (WHERE kind IN ('BUILDING', 'FURNITURE', 'HOUSEHOLD')) AS accepted, count(*) FILTER (WHERE kind IS NULL OR kind NOT IN ('BUILDING', 'FURNITURE', 'HOUSEHOLD')) AS excluded, count(*) FILTER (WHERE kind IS NULL) AS untyped FROM t GROUP BY 1)
SELECT c_nationkey, coalesce(accepted, 0) AS accepted, coalesce(excluded, 0) AS excluded, coalesce(untyped, 0) AS untyped, row_count, coalesce(accepted + excluded = row_count, false) AS reconciled FROM d LEFT JOIN a ON k = c_nationkey""")
def source_audit(spark, sf_dir):
    """Listing rows of each nation by type, against a declared count that is wrong for some."""
    rows = table(spark, sf_dir, "customer").select("c_nationkey", F.when(F.col("c_custkey") % 97 != 4, F.col("c_mktsegment")).alias("kind"))
    counts = rows.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"))
    declared = nations.join(counts, "c_nationkey", "left").select("c_nationkey", (F.coalesce("n", F.lit(0)) + (F.col("c_nationkey") % 8 == 3).cast("int")).cast("long").alias("row_count"))
    return contracts.source_audit(rows, ["c_nationkey"], "kind", ["BUILDING", "FURNITURE", "HOUSEHOLD"], declared)


@query("A13", "SELECT o_custkey, count(*) FILTER (WHERE o_orderkey % 3 <> 0) AS timestamps, count(*) FILTER (WHERE o_orderkey % 3 = 0) AS dates, count(DISTINCT year(o_orderdate)) AS years, count(DISTINCT CASE WHEN o_orderkey % 50 = 7 THEN 'v1' ELSE 'v2' END) = 1 AS one_mapping, count(*) FILTER (WHERE o_orderpriority = '5-LOW') AS reason_low, count(*) FILTER (WHERE o_orderpriority <> '5-LOW') AS reason_other FROM orders GROUP BY 1")
def precision_counts(spark, sf_dir):
    dated, mapping = F.col("o_orderkey") % 3 == 0, F.when(F.col("o_orderkey") % 50 == 7, "v1").otherwise("v2")
    low = F.col("o_orderpriority") == "5-LOW"
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count_if(~dated).alias("timestamps"), F.count_if(dated).alias("dates"), F.countDistinct(F.year("o_orderdate")).alias("years"), (F.countDistinct(mapping) == 1).alias("one_mapping"), F.count_if(low).alias("reason_low"), F.count_if(~low).alias("reason_other"))


@query("A27", """WITH t AS (SELECT event_id, CASE WHEN event_id % 401 = 9 THEN NULL ELSE user_id + CASE WHEN event_id % 503 = 11 THEN 1000000 ELSE 0 END END AS user_id, CASE WHEN event_id % 307 = 2 THEN '2024-01-01' ELSE '2024-01-31' END AS day, CASE WHEN event_id % 13 = 5 THEN '0' WHEN event_id % 701 = 6 THEN '?' ELSE ' TRUE ' END AS st, CASE WHEN event_id % 17 = 8 THEN NULL ELSE value END AS cl, CASE WHEN event_id % 19 = 3 THEN NULL ELSE value + 1 END AS pre FROM events),
r AS (SELECT *, CASE WHEN st = '?' THEN 'market_invalid_tradestatus' WHEN st = '0' AND pre IS NULL OR st = ' TRUE ' AND cl IS NULL THEN 'market_missing_close' END AS err FROM t),
u AS (SELECT DISTINCT user_id FROM events), s AS (SELECT user_id, count(*) AS n FROM r WHERE user_id IS NOT NULL GROUP BY 1),
e AS (SELECT [CASE WHEN (SELECT count(*) FROM s WHERE n > 1) > 0 THEN 'market_duplicate_security' END, CASE WHEN (SELECT count(*) FROM s WHERE user_id NOT IN (SELECT user_id FROM u)) + (SELECT count(*) FROM r WHERE user_id IS NULL) > 0 THEN 'market_outside_universe' END, CASE WHEN (SELECT count(*) FROM u WHERE user_id NOT IN (SELECT user_id FROM s)) > 0 THEN 'market_incomplete_universe' END, CASE WHEN (SELECT count(*) FROM r WHERE day <> '2024-01-31') > 0 THEN 'market_wrong_date' END] || list_sort((SELECT list(DISTINCT err) FILTER (WHERE err IS NOT NULL) FROM r)) AS l)
SELECT (SELECT count(*) FROM r) AS records, (SELECT count(*) FROM u) AS universe, (SELECT count(*) FROM u WHERE user_id IN (SELECT user_id FROM s)) AS covered, array_to_string(list_filter(l, lambda x: x IS NOT NULL), ',') AS errors FROM e""")
def market_gate(spark, sf_dir):
    gate = contracts.market_gate(_market_rows(spark, sf_dir), table(spark, sf_dir, "events").select("user_id"), "user_id", "day", "error", "2024-01-31")
    return gate.withColumn("errors", F.array_join("errors", ","))


def _market_rows(spark, sf_dir):
    k = F.col("event_id")
    rows = table(spark, sf_dir, "events")
    status = F.when(k % 13 == 5, "0").when(k % 701 == 6, "?").otherwise(" TRUE ")
    price, basis, error = contracts.effective_price(status, F.when(k % 17 != 8, F.col("value")), F.when(k % 19 != 3, F.col("value") + 1))
    return rows.select("event_id", F.when(k % 401 != 9, F.col("user_id") + F.when(k % 503 == 11, 1000000).otherwise(0)).alias("user_id"), F.when(k % 307 == 2, "2024-01-01").otherwise("2024-01-31").alias("day"), price.alias("price"), basis.alias("basis"), error.alias("error"))


@query("A27", """SELECT event_id, round(CASE WHEN event_id % 13 = 5 THEN CASE WHEN event_id % 19 <> 3 THEN value + 1 END WHEN event_id % 701 = 6 THEN NULL WHEN event_id % 17 <> 8 THEN value END, 6) AS price,
 CASE WHEN event_id % 13 = 5 THEN CASE WHEN event_id % 19 <> 3 THEN 'suspended_preclose' END WHEN event_id % 701 = 6 THEN NULL WHEN event_id % 17 <> 8 THEN 'close' END AS basis FROM events""")
def market_prices(spark, sf_dir):
    return _market_rows(spark, sf_dir).select("event_id", F.round("price", 6).alias("price"), "basis")


@query("J12", """WITH m AS (SELECT p_partkey AS security, unnest(['earnings', 'cash', 'book']) AS metric, CASE WHEN p_partkey % 43 <> 5 THEN p_brand END AS template, unnest([p_retailprice, CASE WHEN p_partkey % 7 <> 1 THEN p_retailprice / 2 END, p_retailprice / 4]) AS value FROM part),
d AS (SELECT p_partkey AS security, CASE WHEN p_size % 5 = 0 THEN 'pending' WHEN p_size % 2 = 0 THEN 'clear' ELSE 'matched' END AS decision, CASE WHEN p_size % 9 = 1 THEN 0.0 ELSE CAST(p_size AS DOUBLE) END AS cur, CASE WHEN p_size % 13 <> 4 THEN p_size * 0.75 END AS norm FROM part WHERE p_partkey % 29 <> 3),
dep(decision, metric, policy) AS (VALUES ('matched', 'earnings', 'scale'), ('matched', 'cash', 'scale'), ('matched', 'book', 'none'), ('clear', 'earnings', 'scale'), ('clear', 'cash', 'scale'), ('clear', 'book', 'none'), ('pending', 'earnings', 'scale'), ('pending', 'cash', 'scale'), ('pending', 'book', 'none')),
cov AS (SELECT DISTINCT p_brand AS template, metric, CASE WHEN metric = 'book' THEN 'none' WHEN metric = 'cash' AND p_brand LIKE '%3' THEN 'none' ELSE 'scale' END AS covered FROM part CROSS JOIN (VALUES ('earnings'), ('cash'), ('book')) x(metric)),
j AS (SELECT m.security, m.metric, m.template, m.value, d.decision, cur, norm, policy, covered FROM m LEFT JOIN d USING (security) LEFT JOIN dep ON dep.decision = d.decision AND dep.metric = m.metric LEFT JOIN cov ON cov.template = m.template AND cov.metric = m.metric),
s AS (SELECT *, CASE WHEN template IS NULL THEN 'invalid_template' WHEN decision IS NULL THEN 'applicability_unresolved' WHEN policy IS NULL OR policy IS DISTINCT FROM covered THEN 'coverage_differs' WHEN decision = 'pending' THEN 'pending_decision' WHEN value IS NULL THEN 'value_missing' WHEN policy = 'none' OR decision = 'clear' THEN 'original' WHEN norm IS NULL THEN 'basis_missing' WHEN cur = 0 THEN 'zero_current' ELSE 'adjusted' END AS status FROM j)
SELECT security, metric, template, status, round(CASE status WHEN 'original' THEN value WHEN 'adjusted' THEN value * norm / cur END, 6) AS adjusted FROM s""")
def adjusted_metrics(spark, sf_dir):
    """Metric, policy decision, its dependency and the adapter's coverage in one row."""
    p = table(spark, sf_dir, "part")
    values = F.array(*(F.struct(F.lit(m).alias("metric"), v.alias("value")) for m, v in (("earnings", F.col("p_retailprice")), ("cash", F.when(F.col("p_partkey") % 7 != 1, F.col("p_retailprice") / 2)), ("book", F.col("p_retailprice") / 4))))
    metrics = p.select(F.col("p_partkey").alias("security"), F.when(F.col("p_partkey") % 43 != 5, F.col("p_brand")).alias("template"), F.explode(values).alias("v")).select("security", "template", "v.*")
    size = F.col("p_size")
    decisions = p.where("p_partkey % 29 <> 3").select(F.col("p_partkey").alias("security"), F.when(size % 5 == 0, "pending").when(size % 2 == 0, "clear").otherwise("matched").alias("decision"), F.when(size % 9 == 1, 0.0).otherwise(size.cast("double")).alias("current"), F.when(size % 13 != 4, size * 0.75).alias("normal"))
    depends = spark.createDataFrame([(d, m, "none" if m == "book" else "scale") for d in ("matched", "clear", "pending") for m in ("earnings", "cash", "book")], "decision string, metric string, policy string")
    kind = F.when(F.col("metric") == "book", "none").when((F.col("metric") == "cash") & F.col("template").endswith("3"), "none").otherwise("scale")
    coverage = p.select(F.col("p_brand").alias("template"), F.explode(F.array(F.lit("earnings"), F.lit("cash"), F.lit("book"))).alias("metric")).distinct().withColumn("policy", kind)
    return contracts.adjusted_metrics(metrics, decisions, depends, coverage).withColumn("adjusted", F.round("adjusted", 6))


@query("J17 P35", """WITH l(seg, scope) AS (VALUES ('BUILDING', 0), ('FURNITURE', 1), ('MACHINERY', 2), ('HOUSEHOLD', 3)),
f AS (SELECT o_custkey, arg_max(CASE o_orderkey % 5 WHEN 0 THEN 'no_valid_coverage' WHEN 1 THEN 'no_valid_coverage' ELSE 'covered' END, o_orderkey) AS status, arg_max(o_orderkey % 5 = 0, o_orderkey) AS none, arg_max(CASE WHEN o_orderkey % 5 IN (0, 1) THEN 0 ELSE o_orderkey % 4 END, o_orderkey) AS est FROM orders GROUP BY 1)
SELECT c_custkey, scope, CASE WHEN scope IS NULL THEN 'unlinked' WHEN status IS NULL THEN 'absent' WHEN none AND status = 'no_valid_coverage' AND est = 0 THEN 'neutral' WHEN NOT none AND status = 'covered' AND est > 0 THEN 'covered' ELSE 'malformed' END AS branch FROM customer LEFT JOIN l ON seg = c_mktsegment LEFT JOIN f ON o_custkey = c_custkey AND scope IS NOT NULL""")
def consensus_links(spark, sf_dir):
    """Customer to its segment's link to the newest consensus fact, and which branch that takes."""
    links = spark.createDataFrame([("BUILDING", 0), ("FURNITURE", 1), ("MACHINERY", 2), ("HOUSEHOLD", 3)], "c_mktsegment string, scope int")
    k = F.col("o_orderkey")
    fact = F.struct(F.when(k % 5 < 2, "no_valid_coverage").otherwise("covered").alias("status"), (k % 5 == 0).alias("none"), F.when(k % 5 < 2, 0).otherwise(k % 4).alias("estimates"))
    newest = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max_by(fact, "o_orderkey").alias("f"))
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment").join(F.broadcast(links), "c_mktsegment", "left").join(newest, "c_custkey", "left")
    return rows.select("c_custkey", "scope", score.consensus_branch(F.col("scope").isNotNull(), F.col("f.status"), F.col("f.none"), F.col("f.estimates")).alias("branch"))


@query("J21 F15", """WITH m AS (SELECT c_custkey, sha256(CAST(c_custkey AS VARCHAR) || chr(31) || c_mktsegment) AS h, CAST(c_nationkey AS VARCHAR) AS content FROM customer),
st AS (SELECT c_custkey, CASE WHEN c_custkey % 9 = 4 THEN 'old' ELSE sha256(CAST(c_custkey AS VARCHAR) || chr(31) || c_mktsegment) END AS h, CAST(c_nationkey + CASE WHEN c_custkey % 14 = 6 THEN 1 ELSE 0 END AS VARCHAR) AS content FROM customer WHERE c_custkey % 5 <> 2)
SELECT m.c_custkey, CASE WHEN st.h IS NULL THEN 'current_receipt_absent' WHEN st.content = m.content THEN 'current' ELSE 'content_differs' END AS state FROM m LEFT JOIN st ON st.c_custkey = m.c_custkey AND st.h = m.h""")
def current_receipts(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", exprs.row_hash("c_custkey", "c_mktsegment").alias("input_hash"), F.col("c_nationkey").alias("content"))
    members = rows.withColumn("content", F.col("content").cast("string"))
    stored = rows.where("c_custkey % 5 <> 2").select("c_custkey", F.when(F.col("c_custkey") % 9 == 4, "old").otherwise(F.col("input_hash")).alias("input_hash"), (F.col("content") + (F.col("c_custkey") % 14 == 6).cast("int")).cast("string").alias("content"))
    return contracts.current_receipts(members, stored, "c_custkey", "input_hash", "content")


@query("J20", """WITH i AS (SELECT o_orderkey AS issue, o_custkey AS k FROM orders), b AS (SELECT CASE WHEN l_linenumber > 2 OR l_partkey % 3 = 0 THEN -l_orderkey WHEN l_linenumber = 1 AND l_orderkey % 4 <> 0 OR l_orderkey % 16 = 3 AND l_linenumber = 2 THEN l_orderkey END AS issue, o_custkey AS k, l_orderkey * 10 + l_linenumber AS binding FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
e AS (SELECT issue, count(*) AS n, min(binding) AS m FROM b WHERE issue IS NOT NULL GROUP BY 1), l AS (SELECT k, count(*) AS n, min(binding) AS m FROM b WHERE issue IS NULL GROUP BY 1)
SELECT i.issue, CASE WHEN e.n = 1 THEN e.m WHEN e.n IS NULL AND l.n = 1 THEN l.m END AS binding, CASE WHEN e.n = 1 THEN 'exact' WHEN e.n > 1 THEN 'ambiguous' WHEN l.n = 1 THEN 'legacy' WHEN l.n > 1 THEN 'ambiguous' ELSE 'absent' END AS state FROM i LEFT JOIN e ON e.issue = i.issue LEFT JOIN l ON l.k = i.k""")
def provenance(spark, sf_dir):
    """Issues with the line that is bound to them, else the customer's only unbound one."""
    o = table(spark, sf_dir, "orders")
    issues = o.select(F.col("o_orderkey").alias("issue"), F.col("o_custkey").alias("k"))
    lines = table(spark, sf_dir, "lineitem").join(o.select("o_orderkey", "o_custkey"), F.col("o_orderkey") == F.col("l_orderkey"))
    bound = (F.col("l_linenumber") == 1) & (F.col("l_orderkey") % 4 != 0) | (F.col("l_orderkey") % 16 == 3) & (F.col("l_linenumber") == 2)
    strange = (F.col("l_linenumber") > 2) | (F.col("l_partkey") % 3 == 0)  # bound to issues that are not in the log
    return contracts.provenance(issues, lines.select(F.when(strange, -F.col("l_orderkey")).when(bound, F.col("l_orderkey")).alias("issue"), F.col("o_custkey").alias("k"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("binding")), "issue", "k")


NAMES = ("daily_bars", "Performance_report", "cash_flow_sheet", "notes")


@query("P33 U5", """WITH n(p, dataset, stated) AS (SELECT '1-URGENT', 'daily_bars', CAST(NULL AS VARCHAR) UNION ALL SELECT '2-HIGH', 'Performance_report', NULL UNION ALL SELECT '3-MEDIUM', 'cash_flow_sheet', 'by hand' UNION ALL SELECT '5-LOW', 'notes', NULL)
SELECT dataset, o_orderstatus AS status, coalesce(stated, CASE dataset WHEN 'daily_bars' THEN 'exchange' WHEN 'notes' THEN 'unknown' ELSE 'filings' END) AS source, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'P' THEN 1 ELSE 2 END AS priority, count(*) AS n FROM n JOIN orders ON o_orderpriority = p GROUP BY 1, 2, 3, 4""")
def inferred_sources(spark, sf_dir):
    """Literal rows of datasets, their sources by name, and their order rows by urgency of status."""
    names = spark.createDataFrame([("1-URGENT", NAMES[0], None), ("2-HIGH", NAMES[1], None), ("3-MEDIUM", NAMES[2], "by hand"), ("5-LOW", NAMES[3], None)], "o_orderpriority string, dataset string, stated string")
    word = F.when(F.col("o_orderstatus") == "F", "Failed").when(F.col("o_orderstatus") == "P", "still RUNNING").otherwise("done")
    rows = table(spark, sf_dir, "orders").join(F.broadcast(names), "o_orderpriority")
    made = rows.select("dataset", F.col("o_orderstatus").alias("status"), contracts.inferred_source(F.col("dataset"), F.col("stated")).alias("source"), contracts.row_priority(word, F.lit(None)).alias("priority"))
    return made.groupBy("dataset", "status", "source", "priority").agg(F.count(F.lit(1)).alias("n"))


@query("A6", """WITH g AS (SELECT o_orderpriority AS batch, count(*) AS n, count(*) FILTER (WHERE o_orderstatus = 'F') AS final, bool_and(o_orderkey % 400 <> 9) AS proven FROM orders GROUP BY 1)
SELECT batch, CASE WHEN n > 0 AND final = n AND proven THEN 'final' WHEN proven THEN 'provisional' ELSE 'draft' END AS state, CASE WHEN proven THEN n END AS shown FROM g""")
def lifecycle_states(spark, sf_dir):
    """Batches with their state; counts are shown only where the proof holds."""
    g = table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("batch")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("final"), F.bool_and(F.col("o_orderkey") % 400 != 9).alias("proven"))
    return g.select("batch", F.when((F.col("final") == F.col("n")) & F.col("proven"), "final").when(F.col("proven"), "provisional").otherwise("draft").alias("state"), F.when(F.col("proven"), F.col("n")).alias("shown"))


@query("A26", "WITH b AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n, bool_and(o_orderstatus <> 'P') AS reviewed FROM orders GROUP BY 1) SELECT count(*) AS batches, count(*) FILTER (WHERE reviewed) AS reviewed_batches, CAST(coalesce(sum(n) FILTER (WHERE reviewed), 0) AS BIGINT) AS reviewed_rows FROM b")
def reviewed_batches(spark, sf_dir):
    b = table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("n"), F.bool_and(F.col("o_orderstatus") != "P").alias("reviewed"))
    return b.agg(F.count(F.lit(1)).alias("batches"), F.count_if("reviewed").alias("reviewed_batches"), F.coalesce(F.sum(F.when(F.col("reviewed"), F.col("n"))), F.lit(0)).alias("reviewed_rows"))


@query("R7", """WITH t AS (SELECT p_partkey AS k, CASE p_partkey % 6 WHEN 0 THEN 'numeric_redline' WHEN 1 THEN 'boolean_state' WHEN 2 THEN 'cyclic_protection' WHEN 3 THEN 'numeric_redline' WHEN 4 THEN 'market_liquidity' ELSE 'mood' END AS kind, CASE WHEN p_size % 7 = 0 THEN 'about' ELSE 'lte' END AS op, CASE WHEN p_size % 11 <> 0 THEN p_retailprice END AS threshold, CASE p_size % 3 WHEN 0 THEN 'dimension_cap' WHEN 1 THEN 'pool_prohibition' ELSE 'independent_status' END AS effect, p_size * 2.5 AS cap, CASE WHEN p_size % 5 = 2 THEN 'all' ELSE 'both' END AS pool, p_size % 13 <> 1 AS fits FROM part)
SELECT k AS p_partkey, concat_ws(',', CASE WHEN kind = 'mood' THEN 'kind' END, CASE WHEN kind = 'numeric_redline' AND op = 'about' THEN 'operator' END, CASE WHEN kind = 'numeric_redline' AND threshold IS NULL THEN 'threshold' END, CASE WHEN effect = 'dimension_cap' AND cap > 100 THEN 'cap' END, CASE WHEN effect = 'pool_prohibition' AND pool = 'all' THEN 'pool' END, CASE WHEN NOT fits THEN 'applies_to' END) AS broken FROM t""")
def rule_shapes(spark, sf_dir):
    """Rules made of parts, with what is wrong with each one's shape."""
    k, size = F.col("p_partkey") % 6, F.col("p_size")
    rules = table(spark, sf_dir, "part").select(
        "p_partkey", F.when(k % 3 == 0, "numeric_redline").when(k == 1, "boolean_state").when(k == 2, "cyclic_protection").when(k == 4, "market_liquidity").otherwise("mood").alias("kind"), F.when(size % 7 == 0, "about").otherwise("lte").alias("op"), F.when(size % 11 != 0, F.col("p_retailprice")).alias("threshold"),
        F.when(size % 3 == 0, "dimension_cap").when(size % 3 == 1, "pool_prohibition").otherwise("independent_status").alias("effect"), F.lit("G").alias("dimension"), (size * 2.5).alias("cap"), F.when(size % 5 == 2, "all").otherwise("both").alias("pool"), F.when(size % 13 != 1, F.array("p_brand")).otherwise(F.array().cast("array<string>")).alias("applies_to"),
    )
    return rules.select("p_partkey", F.array_join(contracts.rule_violations(), ",").alias("broken"))


@query("X6 T4", """WITH ch AS (SELECT DISTINCT 'spend' AS metric, c_nationkey AS cohort FROM customer WHERE c_acctbal < -900 UNION ALL SELECT DISTINCT 'balance', c_nationkey FROM customer WHERE c_acctbal > 9900),
co AS (SELECT 'spend' AS metric, c_nationkey AS cohort, c_custkey AS member FROM customer UNION ALL SELECT 'balance', c_nationkey, c_custkey FROM customer),
mem AS (SELECT DISTINCT metric, member FROM co JOIN ch USING (metric, cohort)), st AS (SELECT DISTINCT member * 10 + CASE metric WHEN 'spend' THEN 1 ELSE 2 END AS score FROM mem WHERE NOT (metric = 'spend' AND member % 2 = 1))
SELECT 'member' AS step, CAST(member AS VARCHAR) AS id FROM (SELECT DISTINCT member FROM mem) UNION ALL SELECT 'score', CAST(score AS VARCHAR) FROM st UNION ALL SELECT 'pool', p FROM (VALUES ('strong'), ('wait')) x(p) WHERE EXISTS (SELECT 1 FROM st)""")
def invalidated_scores(spark, sf_dir):
    """A changed metric makes its whole cohort stale, then the scores that read it, then both pools."""
    c = table(spark, sf_dir, "customer")
    mark = lambda where, metric: c.where(where).select(F.lit(metric).alias("metric"), F.col("c_nationkey").alias("cohort"))
    changed = mark("c_acctbal < -900", "spend").unionByName(mark("c_acctbal > 9900", "balance"))
    every = c.select(F.explode(F.array(F.lit("spend"), F.lit("balance"))).alias("metric"), F.col("c_nationkey").alias("cohort"), F.col("c_custkey").alias("member"))
    scores = every.where("NOT (metric = 'spend' AND member % 2 = 1)").select("member", "metric", (F.col("member") * 10 + F.when(F.col("metric") == "spend", 1).otherwise(2)).alias("score"))
    return contracts.invalidated(changed, every, scores)


@query("S10", """WITH t AS (SELECT doc_id, CASE WHEN doc_id % 23 = 4 THEN 'Access Denied' WHEN doc_id % 29 = 6 THEN '<HTML>' ELSE source END AS source, CASE WHEN doc_id % 19 = 2 THEN CAST(NULL AS DOUBLE) ELSE CAST(n_chars AS DOUBLE) END AS size FROM documents)
SELECT doc_id AS report_id, size AS report_size, source AS issuer, regexp_matches(lower(source), '<html|captcha|access denied') AS quarantined FROM t""")
def performance_report(spark, sf_dir):
    """Source columns checked and renamed, numbers made finite, rows with a challenge page set apart."""
    k = F.col("doc_id")
    raw = table(spark, sf_dir, "documents").select("doc_id", F.when(k % 23 == 4, "Access Denied").when(k % 29 == 6, "<HTML>").otherwise(F.col("source")).alias("source"), F.when(k % 19 == 2, F.lit(float("inf"))).otherwise(F.col("n_chars").cast("double")).alias("n_chars"))
    clean, bad = snapshots.sanitized(snapshots.required(raw, {"doc_id": "report_id", "n_chars": "report_size", "source": "issuer"}), ["issuer"], ["report_size"])
    return clean.withColumn("quarantined", F.lit(False)).unionByName(bad.withColumn("quarantined", F.lit(True)))


@query("F18 F19", """WITH t AS (SELECT o_custkey AS k, CASE o_orderkey % 4 WHEN 0 THEN '1997-06-30' WHEN 1 THEN '1997-06-30 00:00:00' WHEN 2 THEN '1997-03-31 00:00:00' ELSE '1997-06-30 08:00' END AS rd, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS nd FROM orders)
SELECT k AS o_custkey, count(*) FILTER (WHERE rd IN ('1997-06-30', '1997-06-30 00:00:00')) AS target_rows, count(*) FILTER (WHERE rd IN ('1997-06-30', '1997-06-30 00:00:00')) > 0 AS present, count(*) FILTER (WHERE regexp_full_match(rd, '[0-9]{4}-[0-9]{2}-[0-9]{2} 00:00:00')) AS repairable, coalesce(array_to_string(list_sort(list(DISTINCT nd) FILTER (WHERE rd IN ('1997-06-30', '1997-06-30 00:00:00'))), ','), '') AS notice_dates FROM t GROUP BY 1""")
def statement_rows(spark, sf_dir):
    """Rows of the target period in either spelling, their notice dates, and rows whose only defect is a midnight suffix."""
    k = F.col("o_orderkey") % 4
    text = F.when(k == 0, "1997-06-30").when(k == 1, "1997-06-30 00:00:00").when(k == 2, "1997-03-31 00:00:00").otherwise("1997-06-30 08:00")
    rows = table(spark, sf_dir, "orders").select("o_custkey", text.alias("report_date"), F.to_date("o_orderdate").cast("string").alias("notice"))
    return snapshots.period_rows(rows, ["o_custkey"], "report_date", "1997-06-30", "notice").withColumn("notice_dates", F.array_join("notice_dates", ","))


@query("S9", "SELECT page_id, CAST('2024-04-01' AS DATE) + CAST(page_id % 30 AS INTEGER) AS due FROM pages")
def disclosure_schedule(spark, sf_dir):
    """A schedule of announcements; a source without rows is an error before anything is read on."""
    return snapshots.not_empty(table(spark, sf_dir, "pages"), "pages").select("page_id", F.date_add(F.lit("2024-04-01").cast("date"), (F.col("page_id") % 30).cast("int")).alias("due"))


@query("P36", """WITH t AS (SELECT s_suppkey AS k, d.dim, m.metric, CASE WHEN s_suppkey % 4 = 1 THEN 'raw-v1' WHEN s_suppkey % 4 = 2 THEN 'note' ELSE 'derived-v1' END AS version, CASE WHEN s_suppkey % 3 = 0 THEN 'FY2023' ELSE 'TTM' END AS period FROM supplier CROSS JOIN (VALUES ('G'), ('V'), ('T')) d(dim) CROSS JOIN (VALUES ('revenue'), ('gross_margin'), ('mood')) m(metric))
SELECT k AS s_suppkey, dim || '.' || metric AS key FROM t WHERE dim = 'G' OR version IN ('raw-v1') OR (metric = 'revenue' AND period = 'FY2023') OR (metric = 'gross_margin' AND period = 'TTM')""")
def projection_values(spark, sf_dir):
    """Feature values that belong to the financial namespace by dimension, version or a registered name and period."""
    k = F.col("s_suppkey")
    names = F.array(*(F.struct(F.lit(d).alias("dim"), F.lit(m).alias("metric")) for d in "GVT" for m in ("revenue", "gross_margin", "mood")))
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", F.when(k % 4 == 1, "raw-v1").when(k % 4 == 2, "note").otherwise("derived-v1").alias("version"), F.when(k % 3 == 0, "FY2023").otherwise("TTM").alias("period"), F.explode(names).alias("n")).select("s_suppkey", "version", "period", "n.*")
    alias = (F.col("metric") == "revenue") & (F.col("period") == "FY2023") | (F.col("metric") == "gross_margin") & (F.col("period") == "TTM")
    return rows.where((F.col("dim") == "G") | F.col("version").isin("raw-v1") | alias).select("s_suppkey", F.concat_ws(".", "dim", "metric").alias("key"))


@query("X6", """WITH p AS (SELECT p_partkey AS key, CASE WHEN p_partkey % 40 = 3 THEN 'Brand#99' WHEN p_partkey % 40 = 4 THEN 'none' ELSE p_brand END AS cohort, p_retailprice + CASE WHEN p_partkey % 40 = 5 AND p_brand < 'Brand#3' THEN 500 ELSE 0 END AS value FROM part),
r AS (SELECT *, rank() OVER (PARTITION BY cohort ORDER BY value) + (count(*) OVER (PARTITION BY cohort, value) - 1) / 2.0 AS k, count(*) OVER (PARTITION BY cohort) AS n FROM p WHERE cohort <> 'none')
SELECT key, cohort, value, round(CASE WHEN n = 1 THEN 50 ELSE (k - 1) / (n - 1) * 100 END, 6) AS percentile FROM r""")
def maintained_ranks(spark, sf_dir):
    """Percentiles within brands after three changes, of which each ranks only the brands anew that it touches: moves, members that leave, new values."""
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("key"), F.col("p_brand").alias("before"), F.col("p_retailprice").alias("value"))
    held = MaintainedRanks(spark, new_path(spark, "ranks"), 16)
    held.full(parts.withColumnRenamed("before", "cohort"))
    own = lambda r: parts.where(F.col("key") % 40 == r)
    held.apply(own(3).withColumn("cohort", F.lit("Brand#99")))
    held.apply(own(4).withColumn("cohort", F.lit(None).cast("string")))
    held.apply(own(5).where("before < 'Brand#3'").withColumns({"cohort": F.col("before"), "value": F.col("value") + 500}))
    return held.rows().withColumn("percentile", F.round("percentile", 6))
