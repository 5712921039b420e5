"""Cleaning, mapping and feature queries over orders, line items and text columns."""

from pyspark.sql import functions as F

from pitpanel.functions import exprs
from pitpanel.functions.redaction import redacted
from pitpanel.operators import audit, contracts, features

from .base import YEARS, query, supplier_years, table

COLUMNS = ("revenue", "discounts", "tax", "quantity")


def tall(spark, sf_dir):
    """(s, y, metric, value, unit): supplier-year measures as facts; some are absent, some in another unit, the net is stated too."""
    x = supplier_years(spark, sf_dir).withColumn("net", F.col("revenue") - F.col("discounts") + F.when(F.col("s") % 9 == 4, 5000.0).otherwise(0.0))
    pairs = F.array(*(F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in (*COLUMNS, "net")))
    long = x.select("s", "y", F.explode(pairs).alias("p")).select("s", "y", "p.*")
    absent = (F.col("metric") == "tax") & (F.col("s") % 5 == 2)
    return long.where(~absent).withColumn("unit", F.when((F.col("metric") == "discounts") & (F.col("s") % 7 == 1), "USD").otherwise("CNY"))


TALL = YEARS + """, net AS (SELECT *, revenue - discounts + CASE WHEN s % 9 = 4 THEN 5000.0 ELSE 0.0 END AS net FROM years),
tall AS (SELECT s, y, metric, value, CASE WHEN metric = 'discounts' AND s % 7 = 1 THEN 'USD' ELSE 'CNY' END AS unit FROM (SELECT s, y, unnest(['revenue', 'discounts', 'tax', 'quantity', 'net']) AS metric, unnest([revenue, discounts, tax, quantity, net]) AS value FROM net) WHERE NOT (metric = 'tax' AND s % 5 = 2)),
wide AS (SELECT s, y, max(value) FILTER (WHERE metric = 'revenue' AND unit = 'CNY') AS revenue, max(value) FILTER (WHERE metric = 'discounts' AND unit = 'CNY') AS discounts, max(value) FILTER (WHERE metric = 'tax' AND unit = 'CNY') AS tax, max(value) FILTER (WHERE metric = 'quantity' AND unit = 'CNY') AS quantity FROM tall GROUP BY 1, 2)"""


@query("A7", f"WITH {TALL}, b AS (SELECT s, y, abs(max(value) FILTER (WHERE metric = 'revenue') - max(value) FILTER (WHERE metric = 'net') - max(value) FILTER (WHERE metric = 'discounts')) AS gap, max(value) FILTER (WHERE metric = 'revenue') AS t FROM tall GROUP BY 1, 2) SELECT s, y, round(gap, 2) AS gap, gap <= greatest(1000.0, 0.001 * abs(t)) AS balanced FROM b")
def balance_identity(spark, sf_dir):
    return audit.balance(tall(spark, sf_dir), ["s", "y"], "metric", "value", "revenue", ("net", "discounts")).select("s", "y", F.round("gap", 2).alias("gap"), "balanced")


STATEMENT = {"revenue": "revenue", "cost": "discounts", "profit": "revenue", "interest": "tax", "tax": "tax", "short_debt": "tax", "long_debt": "discounts", "equity": "revenue", "cash": "quantity", "operating_cash": "revenue", "investment": "discounts", "receivables": "revenue", "inventory": "quantity", "payables": "tax", "net_profit": "quantity"}
DERIVED = ("gross_profit", "gross_margin", "ebit", "tax_rate", "nopat", "free_cash", "debt", "net_debt", "invested_capital", "working_capital", "accruals")
DERIVED_SQL = """d AS (SELECT s, y, revenue - discounts AS gross_profit, (revenue - discounts) / nullif(revenue, 0) AS gross_margin, revenue + tax AS ebit, CASE WHEN tax IS NULL OR revenue IS NULL THEN NULL ELSE least(greatest(tax / nullif(revenue, 0), 0.0), 0.5) END AS tax_rate,
 (revenue + tax) * (1 - CASE WHEN tax IS NULL OR revenue IS NULL THEN NULL ELSE least(greatest(tax / nullif(revenue, 0), 0.0), 0.5) END) AS nopat, revenue - discounts AS free_cash, tax + discounts AS debt, tax + discounts - quantity AS net_debt, revenue + (tax + discounts) - quantity AS invested_capital, revenue + quantity - tax AS working_capital, quantity - revenue AS accruals FROM wide),
lo AS (SELECT s, y, unnest([{names}]) AS feature, unnest([{values}]) AS value FROM d),
f AS (SELECT s, y, feature, CASE WHEN feature = 'accruals' AND s % 4 = 0 THEN NULL ELSE value END AS value, CASE WHEN feature = 'accruals' AND s % 4 = 0 THEN 'not_applicable' WHEN value IS NULL THEN 'missing' ELSE 'derived' END AS status, CASE WHEN feature = 'accruals' AND s % 4 = 0 THEN 'template' WHEN value IS NULL THEN 'operand_missing' END AS reason FROM lo)""".format(names=", ".join(f"'{n}'" for n in DERIVED), values=", ".join(DERIVED))


def _features(spark, sf_dir):
    w = features.wide(tall(spark, sf_dir), ["s", "y"], "metric", "value", list(COLUMNS), "unit")
    made = features.derived({k: F.col(v) for k, v in STATEMENT.items()})
    return features.long_features(w.select("s", "y", *(made[n].alias(n) for n in DERIVED)), ["s", "y"], list(DERIVED), {"accruals": F.col("s") % 4 != 0})


@query("F3 F4", f"WITH {TALL}, {DERIVED_SQL} SELECT s, y, feature, round(value, 6) AS value, status, reason FROM f")
def derived_features(spark, sf_dir):
    return _features(spark, sf_dir).withColumn("value", F.round("value", 6))


@query("A9", f"WITH {TALL}, {DERIVED_SQL} SELECT s, y, count(*) FILTER (WHERE status = 'derived') AS complete, count(*) FILTER (WHERE status <> 'not_applicable') AS applicable, round(count(*) FILTER (WHERE status = 'derived') / count(*) FILTER (WHERE status <> 'not_applicable'), 6) AS coverage, CASE WHEN count(*) FILTER (WHERE status = 'derived') = 0 THEN 'blocked' WHEN count(*) FILTER (WHERE status = 'derived') < count(*) FILTER (WHERE status <> 'not_applicable') THEN 'partial' ELSE 'ready' END AS state FROM f GROUP BY 1, 2")
def feature_coverage(spark, sf_dir):
    return features.coverage(_features(spark, sf_dir), ["s", "y"]).withColumn("coverage", F.round("coverage", 6))


TREE = {"op": "divide", "args": [{"op": "subtract", "args": ["revenue", {"op": "median", "args": ["discounts", "tax", "quantity"]}]}, {"op": "add", "args": [{"op": "minimum", "args": ["discounts", "tax"]}, 1.0]}]}


@query("F7", f"WITH {TALL} SELECT s, y, round((revenue - CASE WHEN discounts IS NOT NULL AND tax IS NOT NULL AND quantity IS NOT NULL THEN list_sort([discounts, tax, quantity])[2] END) / nullif(CASE WHEN discounts IS NOT NULL AND tax IS NOT NULL THEN least(discounts, tax) END + 1, 0), 6) AS value FROM wide")
def formula_tree(spark, sf_dir):
    w = features.wide(tall(spark, sf_dir), ["s", "y"], "metric", "value", features.leaves(TREE), "unit")
    return w.select("s", "y", F.round(features.compiled(TREE, {k: F.col(k) for k in features.leaves(TREE)}), 6).alias("value"))


@query("P15", """WITH m(priority, field, metric, least) AS (VALUES ('1-URGENT', 'a', 'urgent', 0), ('2-HIGH', 'b', 'high', 0), ('3-MEDIUM', 'c', 'medium', 100000), ('9-NONE', 'd', 'none', 0)),
i AS (SELECT o_custkey, o_orderpriority, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS v FROM orders GROUP BY 1, 2)
SELECT o_custkey, o_orderpriority AS item, metric, CASE WHEN metric IS NULL THEN 'unknown_field' WHEN n > 3 THEN 'repeated_field' WHEN v < least THEN 'below_least' END AS issue FROM i LEFT JOIN m ON priority = o_orderpriority""")
def mapped_items(spark, sf_dir):
    rules = spark.createDataFrame([("1-URGENT", "urgent", 0), ("2-HIGH", "high", 0), ("3-MEDIUM", "medium", 100000), ("9-NONE", "none", 0)], "item string, metric string, least int")
    rows = table(spark, sf_dir, "orders").groupBy("o_custkey", F.col("o_orderpriority").alias("item")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("v"))
    broken = exprs.violations(unknown_field=F.col("metric").isNotNull(), repeated_field=F.col("n") <= 3, below_least=F.col("v") >= F.col("least"))
    return rows.join(F.broadcast(rules), "item", "left").select("o_custkey", "item", "metric", F.try_element_at(broken, F.lit(1)).alias("issue"))


@query("P1 P2 P3 P14 P29", r"""WITH t AS (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN ' 1,234.5% ' WHEN 1 THEN 'NaN' WHEN 2 THEN '' WHEN 3 THEN '-12e2' ELSE CAST(o_orderkey AS VARCHAR) END AS x, CASE o_orderkey % 4 WHEN 0 THEN 'sh.' || lpad(CAST(o_orderkey % 1000000 AS VARCHAR), 6, '0') WHEN 1 THEN CAST(o_orderkey % 1000 AS VARCHAR) || '.0' WHEN 2 THEN 'x9' ELSE CAST(o_orderkey % 100 AS VARCHAR) END AS c, round(o_totalprice, 0) / 4099 AS p FROM orders),
n AS (SELECT *, regexp_replace(trim(x), ',|%$', '', 'g') AS y FROM t)
SELECT o_orderkey, CASE WHEN regexp_full_match(y, '[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?') THEN CAST(y AS DOUBLE) END AS number, x IS NULL OR trim(x) = '' AS missing, CASE WHEN regexp_full_match(c, '((sh|sz)\.)?\d{1,6}(\.0)?') THEN lpad(regexp_extract(c, '^(?:(?:sh|sz)\.)?(\d{1,6})(?:\.0)?$', 1), 6, '0') END AS code, round(CASE WHEN p >= 0 AND p <= 1 THEN p WHEN p > 1 AND p <= 100 THEN p / 100 END, 6) AS share FROM n""")
def cleaned_values(spark, sf_dir):
    k = F.col("o_orderkey")
    text = k.cast("string")
    x = F.when(k % 5 == 0, " 1,234.5% ").when(k % 5 == 1, "NaN").when(k % 5 == 2, "").when(k % 5 == 3, "-12e2").otherwise(text)
    c = F.when(k % 4 == 0, F.concat(F.lit("sh."), F.lpad((k % 1000000).cast("string"), 6, "0"))).when(k % 4 == 1, F.concat((k % 1000).cast("string"), F.lit(".0"))).when(k % 4 == 2, "x9").otherwise((k % 100).cast("string"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", x.alias("x"), c.alias("c"), (F.round("o_totalprice", 0) / 4099).alias("p"))
    return rows.select("o_orderkey", exprs.number("x").alias("number"), exprs.missing("x").alias("missing"), exprs.code6("c").alias("code"), F.round(exprs.share("p"), 6).alias("share"))


@query("P6 P7 P8 P12", """WITH t AS (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') || CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN ' 00:00:00' ELSE ' 08:30:15' END AS x FROM orders)
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN CAST(x || ' 23:59:59' AS TIMESTAMP) ELSE CAST(x AS TIMESTAMP) END - INTERVAL 8 HOUR AS instant, CASE WHEN o_orderkey % 3 < 2 THEN CAST(left(x, 10) AS DATE) END AS report_date,
CASE substr(x, 6, 5) WHEN '12-31' THEN 'FY' WHEN '06-30' THEN 'H1' WHEN '03-31' THEN 'Q1' WHEN '09-30' THEN 'Q3' ELSE 'OTHER' END AS kind FROM t""")
def parsed_times(spark, sf_dir):
    k = F.col("o_orderkey") % 3
    x = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.when(k == 0, "").when(k == 1, " 00:00:00").otherwise(" 08:30:15"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", x.alias("x"))
    return rows.select("o_orderkey", exprs.business_instant("x", end_of_day=True).alias("instant"), exprs.report_date("x").alias("report_date"), exprs.period_kind(F.substring("x", 1, 10).cast("date")).alias("kind"))


@query("P9 P10 F17", """WITH t AS (SELECT c_custkey AS k, CASE c_custkey % 5 WHEN 0 THEN ' SH.600' WHEN 1 THEN 'sz.300' WHEN 2 THEN 'sh.688' WHEN 3 THEN CASE WHEN c_custkey % 2 = 0 THEN 'sh.689' ELSE 'sz.000' END ELSE 'bj.830' END || lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') AS code, CASE WHEN c_custkey % 31 = 2 THEN '*st ' || c_custkey ELSE 'plain' END AS name, c_custkey % 17 <> 3 AND c_custkey % 19 <> 4 AS act FROM customer)
SELECT k AS c_custkey, upper(left(trim(code), 2)) || right(code, 6) AS id, upper(left(trim(code), 2)) AS exchange, CASE right(left(trim(code), 6), 3) WHEN '688' THEN 'star' WHEN '300' THEN 'growth' ELSE 'main' END AS board, CASE WHEN name <> 'plain' THEN 'ST' ELSE '' END AS tags FROM t WHERE act AND left(trim(code), 6) NOT IN ('sh.689', 'bj.830')""")
def curated_universe(spark, sf_dir):
    k = F.col("c_custkey")
    code = F.concat(F.when(k % 5 == 0, " SH.600").when(k % 5 == 1, "sz.300").when(k % 5 == 2, "sh.688").when((k % 5 == 3) & (k % 2 == 0), "sh.689").when(k % 5 == 3, "sz.000").otherwise("bj.830"), F.lpad((k % 1000).cast("string"), 3, "0"))
    rows = table(spark, sf_dir, "customer").select("c_custkey", code.alias("code"), F.when(k % 31 == 2, F.concat(F.lit("*st "), k)).otherwise("plain").alias("code_name"), F.when(k % 17 == 3, "2").otherwise("1").alias("type"), F.when(k % 19 == 4, "0").otherwise("1").alias("status"))
    return contracts.curated(rows).select("c_custkey", exprs.security_id("security_id").alias("id"), "exchange", "board", F.array_join("risk_tags", ",").alias("tags"))


@query("P17 F11", "SELECT c_custkey, sha256(coalesce(CAST(c_custkey AS VARCHAR), chr(0)) || chr(31) || coalesce(c_mktsegment, chr(0))) AS row_id, regexp_replace(regexp_replace(CAST(CAST(round(c_acctbal, 0) / 4 AS DECIMAL(18,4)) AS VARCHAR), '0+$', ''), '\\.$', '') AS amount FROM customer".replace("\\\\", "\\"))
def row_identities(spark, sf_dir):
    amount = (F.round("c_acctbal", 0) / 4).cast("decimal(18,4)")
    return table(spark, sf_dir, "customer").select("c_custkey", exprs.row_hash("c_custkey", "c_mktsegment").alias("row_id"), exprs.decimal_text(amount).alias("amount"))


@query("P28")
def redacted_conversations(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", redacted("text").alias("text"))


@query("A1 J1", """WITH x AS (SELECT o.*, c.c_custkey, c.c_mktsegment FROM orders o LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 50 <> 1) c ON o_custkey = c_custkey),
g AS (SELECT count(*) AS n, count(*) FILTER (WHERE c_custkey IS NULL) AS outside, count(DISTINCT c_custkey) AS disclosed, (SELECT count(*) FROM customer WHERE c_custkey % 50 <> 1) AS universe, (count(c_custkey) + count(c_mktsegment) + count(o_totalprice)) / (3.0 * count(*)) AS completeness FROM x)
SELECT n, outside, disclosed, universe, round(disclosed / universe, 6) AS coverage, round(completeness, 6) AS completeness, CASE WHEN completeness >= 0.95 AND outside = 0 AND disclosed / universe >= 0.95 THEN 'passed' ELSE 'failed' END AS status FROM g""")
def disclosure_gate(spark, sf_dir):
    universe = table(spark, sf_dir, "customer").where("c_custkey % 50 <> 1").select("c_custkey", "c_mktsegment")
    rows = table(spark, sf_dir, "orders").join(universe, F.col("o_custkey") == F.col("c_custkey"), "left")
    one = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("c_custkey").isNull()).alias("outside"), F.countDistinct("c_custkey").alias("disclosed"), ((F.count("c_custkey") + F.count("c_mktsegment") + F.count("o_totalprice")) / (3.0 * F.count(F.lit(1)))).alias("completeness"))
    both = one.crossJoin(universe.agg(F.count(F.lit(1)).alias("universe")))  # two one-row frames
    coverage = F.col("disclosed") / F.col("universe")
    why = audit.reasons(completeness=F.col("completeness") >= 0.95, outside=F.col("outside") == 0, coverage=coverage >= 0.95)
    return both.select("n", "outside", "disclosed", "universe", F.round(coverage, 6).alias("coverage"), F.round("completeness", 6).alias("completeness"), F.when(F.size(why) == 0, "passed").otherwise("failed").alias("status"))


@query("P4 F16", """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_totalprice END AS present, coalesce(CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice END, CAST(o_custkey AS DOUBLE)) AS finite, CASE o_orderkey % 3 WHEN 0 THEN 'SH' || lpad(CAST(o_custkey AS VARCHAR), 6, '0') WHEN 1 THEN 'SZ' || lpad(CAST(o_custkey AS VARCHAR), 6, '0') END AS id, CASE WHEN left(o_orderpriority, 1) = '1' THEN 'a,b' ELSE 'b' END AS hashes FROM orders""")
def resolved_aliases(spark, sf_dir):
    """First alias that is a column, first alias with a finite value, an id from several spellings, sorted unique arrays."""
    k, code = F.col("o_orderkey"), F.lpad(F.col("o_custkey").cast("string"), 6, "0")
    o = table(spark, sf_dir, "orders")
    rows = o.select("o_orderkey", "o_orderpriority", F.when(k % 3 != 0, F.col("o_totalprice")).alias("amount"), F.when(k % 2 == 0, F.col("o_totalprice")).otherwise(F.lit(float("nan"))).alias("x"), F.col("o_custkey").alias("y"), F.when(k % 3 == 0, F.concat(F.lit("sh"), code)).alias("id1"), F.when(k % 3 == 1, F.concat(F.lit(" SZ"), code)).alias("id2"))
    tags = F.when(F.substring("o_orderpriority", 1, 1) == "1", F.array(F.lit("b"), F.lit("a"), F.lit("b"))).otherwise(F.array(F.lit("b"), F.lit("b")))
    return rows.select("o_orderkey", exprs.first_present(rows.columns, "total", "amount").alias("present"), exprs.first_finite("x", "y").alias("finite"), F.coalesce(exprs.security_id("id1"), exprs.security_id("id2")).alias("id"), F.array_join(F.array_sort(F.array_distinct(tags)), ",").alias("hashes"))


@query("P27", """SELECT doc_id, nullif(concat_ws(',', CASE WHEN lang IS NULL OR lang NOT IN ('en', 'de', 'fr') THEN 'lang' END, CASE WHEN n_chars IS NULL OR n_chars < 300 THEN 'short' END, CASE WHEN source IS NULL OR NOT regexp_full_match(source, 'src[0-9]') THEN 'source' END), '') AS broken FROM documents""")
def context_violations(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    broken = exprs.violations(lang=F.col("lang").isin("en", "de", "fr"), short=F.col("n_chars") >= 300, source=F.col("source").rlike("^src[0-9]$"))
    return d.select("doc_id", F.when(F.size(broken) > 0, F.array_join(broken, ",")).alias("broken"))


@query("A23", f"WITH {TALL}, {DERIVED_SQL} SELECT s, y, coalesce(list_aggregate(list_sort(list(DISTINCT feature) FILTER (WHERE status = 'missing' AND feature <> 'nopat')), 'string_agg', ','), '') AS blockers, count(*) FILTER (WHERE status = 'missing' AND feature <> 'nopat') = 0 AS ready FROM f GROUP BY 1, 2")
def readiness_gate(spark, sf_dir):
    """Sorted blockers of each supplier-year; one feature is neutral and never blocks."""
    missing = F.when((F.col("status") == "missing") & (F.col("feature") != "nopat"), F.col("feature"))
    out = _features(spark, sf_dir).groupBy("s", "y").agg(F.array_sort(F.collect_set(missing)).alias("b"))
    return out.select("s", "y", F.array_join("b", ",").alias("blockers"), (F.size("b") == 0).alias("ready"))


@query("R13", f"WITH {TALL}, m(metric, need) AS (VALUES ('revenue', 'CNY'), ('discounts', 'CNY'), ('tax', 'CNY'), ('margin', 'CNY')), k AS (SELECT DISTINCT s, y FROM tall) SELECT k.s, k.y, m.metric, CASE WHEN t.unit = need THEN round(t.value, 4) END AS value, CASE WHEN t.metric IS NULL THEN 'absent' WHEN t.unit <> need THEN 'unit' END AS reason FROM k CROSS JOIN m LEFT JOIN tall t ON t.s = k.s AND t.y = k.y AND t.metric = m.metric")
def metric_rows(spark, sf_dir):
    """Every registered metric for every supplier-year, with its value or the first reason why not."""
    need = spark.createDataFrame([("revenue", "CNY"), ("discounts", "CNY"), ("tax", "CNY"), ("margin", "CNY")], "metric string, need string")
    facts = tall(spark, sf_dir)
    slots = facts.select("s", "y").distinct().crossJoin(F.broadcast(need))
    ok = F.col("unit") == F.col("need")
    return slots.join(facts, ["s", "y", "metric"], "left").select("s", "y", "metric", F.when(ok, F.round("value", 4)).alias("value"), F.when(F.col("unit").isNull(), "absent").when(~ok, "unit").alias("reason"))


@query("F13", "SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n, round(max(value), 6) AS high, CAST(CAST(ts AS DATE) - INTERVAL 6 DAY AS DATE) AS from_day, CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL 7 HOUR AS close_at FROM events GROUP BY 1, 2, 5, 6")
def daily_bars(spark, sf_dir):
    """Daily rows of each kind, with the seven-day interval that ends there and the session's close (15:00 in Shanghai)."""
    day = F.to_date("ts")
    bars = table(spark, sf_dir, "events").groupBy("event_type", day.alias("day")).agg(F.count(F.lit(1)).alias("n"), F.round(F.max("value"), 6).alias("high"))
    return bars.withColumn("from_day", F.date_sub("day", 6)).withColumn("close_at", F.to_utc_timestamp(F.to_timestamp("day") + F.expr("INTERVAL 15 HOURS"), "Asia/Shanghai"))
