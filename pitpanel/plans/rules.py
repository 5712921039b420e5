"""Policy, valuation and score queries over supplier-year and customer features."""

from pyspark.sql import functions as F

from pitpanel.functions import exprs
from pitpanel.operators import policy, versions

from .base import YEARS, query, supplier_years, table

#: Supplier-years with gaps: no 1997 for every ninth supplier, no tax of 1998 for every tenth. Only whole five years decide.
LATEST = YEARS + """, gaps AS (SELECT s, y, revenue, CASE WHEN s % 10 = 3 AND y = 1998 THEN NULL ELSE tax END AS tax, discounts, quantity FROM years WHERE NOT (s % 9 = 8 AND y = 1997)),
h0 AS (SELECT s, max_by(revenue, y) AS revenue, max_by(tax, y) AS tax, max_by(discounts, y) AS discounts, max_by(quantity, y) AS quantity, """ + ", ".join(f"[{', '.join(f'max({m}) FILTER (WHERE y = {y})' for y in range(1996, 2001))}] AS past_{m}" for m in ("revenue", "tax")) + """ FROM gaps GROUP BY 1),
h AS (SELECT *, len(list_filter(past_revenue, lambda x: x IS NULL)) = 0 AS whole_revenue, len(list_filter(past_tax, lambda x: x IS NULL)) = 0 AS whole_tax FROM h0)"""


def _latest(spark, sf_dir):
    x = supplier_years(spark, sf_dir).where("NOT (s % 9 = 8 AND y = 1997)").withColumn("tax", F.when(~((F.col("s") % 10 == 3) & (F.col("y") == 1998)), F.col("tax")))
    past = lambda m: policy.last_years(F.col("y"), F.col(m), 2000)
    return x.groupBy("s").agg(*(F.max_by(m, "y").alias(m) for m in ("revenue", "tax", "discounts", "quantity")), past("revenue").alias("past_revenue"), past("tax").alias("past_tax"))


RULES = [("low_revenue", "revenue", "lt", 300000.0), ("high_tax", "tax", "gte", 20000.0), ("no_such", "margin", "gt", 0.0)]
DECIDED = f"""WITH {LATEST}, v AS (SELECT s, unnest(['revenue', 'tax']) AS metric, unnest([revenue, CASE WHEN s % 6 = 5 THEN NULL ELSE tax END]) AS v FROM h),
r(rule_id, metric, op, threshold) AS (VALUES ('low_revenue', 'revenue', 'lt', 300000.0), ('high_tax', 'tax', 'gte', 20000.0), ('no_such', 'margin', 'gt', 0.0)),
d AS (SELECT k.s, r.rule_id, CASE WHEN v.v IS NULL THEN 'pending' WHEN (op = 'lt' AND v.v < threshold) OR (op = 'gte' AND v.v >= threshold) OR (op = 'gt' AND v.v > threshold) THEN 'matched' ELSE 'clear' END AS state FROM (SELECT DISTINCT s FROM v) k CROSS JOIN r LEFT JOIN v ON v.s = k.s AND v.metric = r.metric)"""


def _decided(spark, sf_dir):
    h = _latest(spark, sf_dir)
    tax = F.when(F.col("s") % 6 != 5, F.col("tax"))
    long = h.select("s", F.explode(F.array(F.struct(F.lit("revenue").alias("metric"), F.col("revenue").alias("v")), F.struct(F.lit("tax").alias("metric"), tax.alias("v")))).alias("p")).select("s", "p.*")
    return policy.redlines(long, spark.createDataFrame(RULES, "rule_id string, metric string, op string, threshold double"), ["s"], "metric", "v")


@query("R1 P21", DECIDED + " SELECT s, rule_id, state FROM d")
def redline_rules(spark, sf_dir):
    return _decided(spark, sf_dir)


@query("A18 A19", f"WITH {LATEST} SELECT s, round(CASE WHEN whole_revenue THEN list_sort(past_revenue)[4] END, 4) AS nearest, round(CASE WHEN whole_revenue THEN (SELECT quantile_cont(x, 0.8) FROM unnest(past_revenue) t(x)) END, 4) AS linear, round(CASE WHEN whole_revenue THEN least(revenue, (SELECT quantile_cont(x, 0.5) FROM unnest(past_revenue) t(x))) END, 4) AS basis, round(CASE WHEN whole_tax THEN list_sort(past_tax)[4] END, 4) AS nearest_tax FROM h")
def history_quantiles(spark, sf_dir):
    """Quantiles of exactly five years; a supplier with a gap has none."""
    h = _latest(spark, sf_dir)
    return h.select("s", F.round(policy.nearest_rank(F.col("past_revenue"), 0.8), 4).alias("nearest"), F.round(policy.linear_quantile(F.col("past_revenue"), 0.8), 4).alias("linear"), F.round(policy.profit_basis(F.col("revenue"), F.col("past_revenue")), 4).alias("basis"), F.round(policy.nearest_rank(F.col("past_tax"), 0.8), 4).alias("nearest_tax"))


CYCLIC_SQL = f"""WITH {LATEST}, c0 AS (SELECT s, revenue, past_revenue, whole_revenue, CASE WHEN whole_revenue THEN revenue >= (SELECT quantile_cont(x, 0.8) FROM unnest(past_revenue) t(x)) END AS a, CASE WHEN whole_tax THEN CASE WHEN s % 4 = 1 THEN NULL ELSE tax END >= (SELECT quantile_cont(x, 0.8) FROM unnest(past_tax) t(x)) END AS b, CASE WHEN s % 7 <> 3 AND whole_revenue THEN true END AS p FROM h),
c AS (SELECT s, CASE WHEN (a AND b AND p) IS NULL THEN 'pending' WHEN a AND b AND p THEN 'matched' ELSE 'clear' END AS state, CASE WHEN s % 7 <> 3 AND whole_revenue THEN least(revenue, list_sort(past_revenue)[3]) END AS basis FROM c0)"""


def _cyclic(spark, sf_dir):
    h = _latest(spark, sf_dir)
    tax, profit = F.when(F.col("s") % 4 != 1, F.col("tax")), F.when(F.col("s") % 7 != 3, F.col("revenue"))
    state = policy.cyclic([(F.col("revenue"), F.col("past_revenue")), (tax, F.col("past_tax"))], (profit, F.col("past_revenue")))
    return h.select("s", state.alias("state"), policy.profit_basis(profit, F.col("past_revenue")).alias("basis"))


@query("R3 P22", CYCLIC_SQL + " SELECT s, state, CASE WHEN s % 3 = 0 THEN 'absent' WHEN s % 2 = 0 THEN 'active' ELSE 'inactive' END AS flag FROM c")
def cyclic_protection(spark, sf_dir):
    """Two measures against their own five years and a profit history that must be whole; a gap leaves a supplier pending unless one measure is proven false."""
    flags = F.when(F.col("s") % 3 == 0, F.array().cast("array<struct<flag_id:string,active:boolean>>")).otherwise(F.array(F.struct(F.lit("watch").alias("flag_id"), (F.col("s") % 2 == 0).alias("active"))))
    return _cyclic(spark, sf_dir).select("s", "state", exprs.flag_state(flags, "watch").alias("flag"))


STATE_RULES = [("halted", "boolean_state", "halt", None, None, True, None), ("listed", "enum_state", "status", None, None, None, ["F", "P"]), ("small", "numeric_redline", "price", "lt", 50000.0, None, None), ("wrong_type", "boolean_state", "price", None, None, True, None), ("unseen", "enum_state", "nowhere", None, None, None, ["F"])]


@query("R2 R1", """WITH r(rule_id) AS (VALUES ('halted'), ('listed'), ('small'), ('wrong_type'), ('unseen')), o AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderkey % 2 = 0 END AS halt, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderstatus END AS st, o_totalprice AS p FROM orders),
x AS (SELECT k, rule_id, CASE rule_id WHEN 'halted' THEN halt WHEN 'listed' THEN st IN ('F', 'P') WHEN 'small' THEN p < 50000 END AS holds FROM o CROSS JOIN r) SELECT k, rule_id, CASE WHEN holds IS NULL THEN 'pending' WHEN holds THEN 'matched' ELSE 'clear' END AS state FROM x""")
def state_rules(spark, sf_dir):
    """Boolean, enum and numeric rules over typed states, some of them unknown, one of another type than its rule's."""
    k = F.col("o_orderkey")
    entry = lambda name, number=None, flag=None, label=None: F.struct(F.lit(name).alias("entry"), (F.lit(None) if number is None else number).cast("double").alias("number"), (F.lit(None) if flag is None else flag).cast("boolean").alias("flag"), (F.lit(None) if label is None else label).cast("string").alias("label"))
    values = F.array(entry("halt", flag=F.when(k % 5 != 0, k % 2 == 0)), entry("status", label=F.when(k % 7 != 0, F.col("o_orderstatus"))), entry("price", number=F.col("o_totalprice")))
    long = table(spark, sf_dir, "orders").select(k.alias("k"), F.explode(values).alias("v")).select("k", "v.*")
    rules = spark.createDataFrame(STATE_RULES, "rule_id string, kind string, entry string, op string, threshold double, expected boolean, allowed array<string>")
    return policy.decide(long, rules, ["k"])


@query("R6", CYCLIC_SQL + """ SELECT s, 'cyclic_top' AS rule_id, kind, dimension, cap, pool, CASE WHEN kind = 'valuation_profit_basis' THEN round(basis, 4) END AS profit_basis FROM (
 SELECT s, basis, unnest(['pool_prohibition', 'pool_prohibition', 'independent_status', 'dimension_cap', 'valuation_profit_basis']) AS kind, unnest([NULL, NULL, NULL, 'G', NULL]) AS dimension, unnest([NULL, NULL, NULL, CAST(55 AS DOUBLE), NULL]) AS cap, unnest(['strong', 'wait', NULL, NULL, NULL]) AS pool FROM c WHERE state = 'matched'
 UNION ALL SELECT s, basis, 'pending_evidence', NULL, NULL, NULL FROM c WHERE state = 'pending')""")
def policy_effects(spark, sf_dir):
    """All five effects: two pools barred, a status, a cap and a profit basis where the cyclic rule matches; pending evidence where it waits."""
    given = [("cyclic_top", [("pool_prohibition", None, None, "both"), ("independent_status", None, None, None), ("dimension_cap", "G", 55.0, None), ("valuation_profit_basis", None, None, None)])]
    rules = spark.createDataFrame(given, "rule_id string, effects array<struct<kind:string,dimension:string,cap:double,pool:string>>")
    made = policy.effects(_cyclic(spark, sf_dir).withColumn("rule_id", F.lit("cyclic_top")), rules, "basis")
    return made.select("s", "rule_id", "kind", "dimension", "cap", "pool", F.round("profit_basis", 4).alias("profit_basis"))


EFFECTS = [("low_revenue", [("pool_prohibition", None, None, "both"), ("dimension_cap", "G", 40.0, None)]), ("high_tax", [("independent_status", None, None, None), ("dimension_cap", "G", 60.0, None), ("dimension_cap", "V", 50.0, None)])]


def _effects(spark):
    return spark.createDataFrame(EFFECTS, "rule_id string, effects array<struct<kind:string,dimension:string,cap:double,pool:string>>")


@query("A21 U6", DECIDED + """ SELECT s, list_aggregate(list_sort(coalesce(list(rule_id) FILTER (WHERE state = 'pending'), [])), 'string_agg', ',') AS pending, CASE WHEN bool_or(rule_id = 'low_revenue' AND state = 'matched') THEN 'strong,wait' ELSE '' END AS pools, CASE WHEN bool_or(rule_id = 'high_tax' AND state = 'matched') THEN 'high_tax' ELSE '' END AS statuses, CASE WHEN bool_or(state = 'pending') THEN 'pending' ELSE 'complete' END AS evidence_state FROM d GROUP BY 1""")
def policy_roll_up(spark, sf_dir):
    d = _decided(spark, sf_dir)
    out = policy.roll_up(d, policy.effects(d, _effects(spark)), ["s"])
    text = lambda c: F.array_join(c, ",").alias(c)
    return out.select("s", text("pending"), text("pools"), text("statuses"), "evidence_state")


@query("A20", DECIDED + ", c AS (SELECT s, 'G' AS dimension, 40.0 AS cap FROM d WHERE rule_id = 'low_revenue' AND state = 'matched' UNION ALL SELECT s, 'G', 60.0 FROM d WHERE rule_id = 'high_tax' AND state = 'matched' UNION ALL SELECT s, 'V', 50.0 FROM d WHERE rule_id = 'high_tax' AND state = 'matched') SELECT s, dimension, CAST(min(cap) AS DOUBLE) AS cap FROM c GROUP BY 1, 2")
def dimension_caps(spark, sf_dir):
    d = _decided(spark, sf_dir)
    return policy.caps(policy.effects(d, _effects(spark)), ["s"])


@query("F9 F10", f"""WITH {LATEST}, x AS (SELECT s, CASE WHEN s % 8 = 7 THEN NULL ELSE quantity END AS v, revenue AS cur, CASE WHEN s % 5 <> 4 AND whole_revenue THEN (SELECT quantile_cont(x, 0.5) FROM unnest(past_revenue) t(x)) END AS nor, s % 2 = 0 AS needs, CASE s % 3 WHEN 0 THEN 'pending' WHEN 1 THEN 'matched' ELSE 'clear' END AS dec FROM h),
t AS (SELECT *, CASE WHEN v IS NULL THEN 'value_missing' WHEN NOT needs THEN 'unaffected' WHEN dec = 'pending' THEN 'pending_decision' WHEN dec = 'clear' THEN 'original' WHEN nor IS NULL THEN 'basis_missing' WHEN cur = 0 THEN 'zero_current' ELSE 'adjusted' END AS status FROM x)
SELECT s, status, round(CASE WHEN status = 'adjusted' THEN v * nor / cur WHEN status IN ('unaffected', 'original') THEN v END, 4) AS value FROM t""")
def valuation_adjustment(spark, sf_dir):
    h = _latest(spark, sf_dir)
    value, normal = F.when(F.col("s") % 8 != 7, F.col("quantity")), F.when(F.col("s") % 5 != 4, policy.linear_quantile(F.col("past_revenue"), 0.5))
    decision = F.when(F.col("s") % 3 == 0, "pending").when(F.col("s") % 3 == 1, "matched").otherwise("clear")
    status, adjusted = policy.adjustment(value, F.col("revenue"), normal, F.col("s") % 2 == 0, decision)
    return h.select("s", status.alias("status"), F.round(adjusted, 4).alias("value"))


@query("R11", "WITH due AS (SELECT DISTINCT p_brand, p_size FROM part), have AS (SELECT p_brand, p_size + CASE WHEN p_partkey % 4 = 1 THEN 60 ELSE 0 END AS p_size, count(*) AS n FROM part GROUP BY 1, 2) SELECT coalesce(d.p_brand, h.p_brand) AS p_brand, coalesce(d.p_size, h.p_size) AS p_size, CASE WHEN h.n IS NULL THEN 'absent' WHEN d.p_brand IS NULL THEN 'unexpected' ELSE 'repeated' END AS error FROM due d FULL JOIN have h ON d.p_brand = h.p_brand AND d.p_size = h.p_size WHERE h.n IS NULL OR d.p_brand IS NULL OR h.n > 1")
def rule_coverage(spark, sf_dir):
    """Every brand and size must have one rule; a quarter of the rules name a size that nobody asks for."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    rules = parts.select("p_brand", (F.col("p_size") + F.when(F.col("p_partkey") % 4 == 1, 60).otherwise(0)).alias("p_size"))
    return policy.coverage_errors(parts.select("p_brand", "p_size").distinct(), rules, ["p_brand", "p_size"])


def _rule_sets(spark, sf_dir):
    """Rule sets of 25 templates made from the nations, each defect in some of them."""
    n = table(spark, sf_dir, "nation").select(F.col("n_name").alias("template"), F.col("n_nationkey").cast("long").alias("k"))
    spec = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(name).alias("semantic"), F.lit(kind).alias("kind"), F.lit(field).cast("string").alias("field"), F.lit(effect).alias("effect")) for i, (name, (kind, field, effect)) in enumerate(policy.REQUIRED.items())))
    rows = n.select("template", "k", F.explode(spec).alias("d")).select("template", "k", "d.*").withColumn("z", F.col("k") * 16 + F.col("i"))
    z, by = F.col("z"), F.col("effect") == "prohibits_both"
    effect = lambda kind, pool, status: F.struct(F.lit(kind).alias("kind"), pool.cast("string").alias("pool"), status.cast("string").alias("status"))
    none = F.lit(None)
    effects = F.when(by, F.array(effect("pool_prohibition", F.when(z % 23 == 5, "strong").otherwise("both"), none))).otherwise(F.array(effect("pool_prohibition", F.lit("wait"), none), effect("independent_status", none, F.when(z % 19 == 6, "other").otherwise(F.col("semantic")))))
    rules = rows.where("z % 29 <> 3").select(
        "template", "semantic", F.concat_ws(":", "template", "semantic").alias("rule_id"), F.when(z % 31 == 4, "enum_state").otherwise(F.col("kind")).alias("kind"), F.when(z % 37 == 7, "other").otherwise(F.col("field")).alias("field"),
        (z % 17 != 8).alias("expected"), F.when(z % 3 == 0, F.array(F.lit("delisting_arrangement"), F.lit("x"))).otherwise(F.array(F.lit("delisting_arrangement"))).alias("allowed"), F.when(z % 5 == 1, "lt").otherwise("lte").alias("op"), F.lit(0.0).alias("threshold"), effects.alias("effects"),
    )
    twice = rules.where("length(template) = 5 AND semantic = 'st'").withColumn("rule_id", F.concat("rule_id", F.lit(":b")))
    wants = n.select(F.concat(F.lit("market:"), "template").alias("name"), F.concat_ws(":", F.when(F.col("k") % 6 == 1, "NOWHERE").when(F.col("k") % 6 == 2, "FRANCE").otherwise(F.col("template")), F.when(F.col("k") % 6 == 3, "st").otherwise(F.lit("no_effective_trade_20d"))).alias("rule_id"), "template", F.lit("market_liquidity").alias("want"))
    return n.select("template"), rules.unionByName(twice), wants


RULE_SET_SQL = """WITH n AS (SELECT n_name AS template, CAST(n_nationkey AS BIGINT) AS k FROM nation), q(i, semantic, kind, field, effect) AS (VALUES {spec}), z AS (SELECT template, k, q.*, k * 16 + i AS z FROM n CROSS JOIN q),
r AS (SELECT *, z % 29 <> 3 AS there, length(template) = 5 AND semantic = 'st' AS twice, CASE WHEN z % 31 = 4 THEN 'enum_state' ELSE kind END AS own FROM z),
e AS (SELECT template, semantic, CASE WHEN NOT there THEN 'missing' ELSE concat_ws(',', CASE WHEN twice THEN 'repeated' END, CASE WHEN own <> kind THEN 'kind' END, CASE WHEN field IS NOT NULL AND z % 37 = 7 THEN 'field' END,
 CASE WHEN (kind = 'boolean_state' AND z % 17 = 8) OR (kind = 'enum_state' AND z % 3 = 0) OR (kind = 'numeric_redline' AND z % 5 = 1) THEN 'parameters' END, CASE WHEN effect = 'prohibits_both' AND z % 23 = 5 THEN 'prohibits_both' END, CASE WHEN effect <> 'prohibits_both' AND z % 19 = 6 THEN 'status_and_pool' END) END AS errors FROM r),
known AS (SELECT template, semantic, own FROM r WHERE there),
f AS (SELECT n.template, 'market:' || n.template AS semantic, CASE WHEN x.own IS NULL THEN 'unknown_rule' ELSE concat_ws(',', CASE WHEN x.template <> n.template THEN 'other_template' END, CASE WHEN x.own <> 'market_liquidity' THEN 'other_kind' END) END AS errors FROM n LEFT JOIN known x ON x.template = CASE n.k % 6 WHEN 1 THEN 'NOWHERE' WHEN 2 THEN 'FRANCE' ELSE n.template END AND x.semantic = CASE WHEN n.k % 6 = 3 THEN 'st' ELSE 'no_effective_trade_20d' END)
SELECT * FROM e WHERE errors <> '' UNION ALL SELECT * FROM f WHERE errors <> ''""".format(spec=", ".join(f"({i}, '{n}', '{k}', {'NULL' if f is None else repr(f)}, '{e}')" for i, (n, (k, f, e)) in enumerate(policy.REQUIRED.items())))


@query("R10 R7", RULE_SET_SQL)
def rule_set_coverage(spark, sf_dir):
    """Every template's rule set against what it must hold: semantics, kinds, fields, parameters, pools, statuses, and references that resolve."""
    return policy.rule_set_errors(*_rule_sets(spark, sf_dir)).select("template", "semantic", F.array_join("errors", ",").alias("errors"))


@query("R12 W9", """WITH c AS (SELECT user_id, event_type AS kind, date_trunc('day', ts) AS published, CASE WHEN event_id % 3 = 0 THEN date_trunc('hour', ts) END AS updated, event_id % 40 AS content, CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_id % 2 = 0 END AS halt FROM events),
m AS (SELECT *, rank() OVER (PARTITION BY user_id, kind ORDER BY published DESC, updated DESC NULLS LAST, content DESC) AS r FROM c), t AS (SELECT user_id, kind, count(*) AS n, any_value(halt) AS halt FROM m WHERE r = 1 GROUP BY 1, 2),
s(selector, kind) AS (VALUES ('error.halt', 'error'), ('purchase.halt', 'purchase'), ('none.halt', 'none')), w AS (SELECT DISTINCT user_id, selector, s.kind FROM events CROSS JOIN s)
SELECT w.user_id, selector, CASE WHEN n IS NULL THEN 'absent' WHEN n > 1 THEN 'tie' WHEN halt IS NULL THEN 'state_entry_missing' ELSE 'value' END AS state, CASE WHEN n = 1 THEN halt END AS value FROM w LEFT JOIN t ON t.user_id = w.user_id AND t.kind = w.kind""")
def selected_states(spark, sf_dir):
    """Selectors against each user's latest context of a kind: a value, an entry that isn't there (which is not false), no context, or two that lead alike."""
    e = table(spark, sf_dir, "events")
    k = F.col("event_id")
    flags = F.when(k % 5 != 0, F.create_map(F.lit("halt"), k % 2 == 0)).otherwise(F.create_map(F.lit("other"), F.lit(True)))
    rows = e.select("user_id", F.col("event_type").alias("kind"), F.date_trunc("day", "ts").alias("published"), F.when(k % 3 == 0, F.date_trunc("hour", "ts")).alias("updated"), (k % 40).alias("content"), flags.alias("flags"))
    selectors = F.array(*(F.struct(F.lit(f"{kind}.halt").alias("selector"), F.lit(kind).alias("kind"), F.lit("halt").alias("entry")) for kind in ("error", "purchase", "none")))
    wanted = e.select("user_id").distinct().select("user_id", F.explode(selectors).alias("s")).select("user_id", "s.*")
    found = versions.leading_context(rows, ["user_id", "kind"], [F.col("published"), F.col("updated"), F.col("content")], wanted)
    both = wanted.join(found, ["user_id", "kind"])
    value = F.try_element_at("flags", "entry")
    state = F.when(F.col("context_state") != "chosen", F.col("context_state")).when(value.isNull(), "state_entry_missing").otherwise("value")
    return both.select("user_id", "selector", state.alias("state"), value.alias("value"))
