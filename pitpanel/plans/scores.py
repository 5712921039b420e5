"""Score queries: 25 slots for each customer, their evidence, confidence, caps and weight scenarios.

The SQL states all weights by itself, so that it doesn't share them with the operators.
"""

from pyspark.sql import functions as F

from pitpanel.functions import exprs
from pitpanel.operators import ranks, score, selection

from .base import panel, query, table
from .ranking import SCORED

DIMS = list(score.WEIGHTS)


def six(x):
    """Rounded to six digits, off the halves, where engines differ."""
    return F.round((F.col(x) if isinstance(x, str) else x) + 3e-8, 6)


def slots(spark, sf_dir):
    """(c_custkey, k, dimension, name, dimension_weight, weight, value, quality): slots of mixed percentiles, with the quality of their orders as evidence."""
    rows = ranks.with_fallback(panel(spark, sf_dir), ["c_acctbal", "spend"], "c_nationkey")
    x, y, key = F.col("c_acctbal_pct"), F.coalesce("spend_pct", F.lit(50.0)), F.col("c_custkey")
    made, k = [], 0
    for d, own in score.SLOTS.items():
        for name, w in own:
            v = 100 - x if k % 3 == 0 else (x * (k % 4) + y * (4 - k % 4)) / 4
            if name == "operating_revenue_yoy":
                v = F.when(key % 13 != 4, v)
            if name == "expectation_change":
                v = F.when(key % 11 == 5, 50.0).otherwise(v)
            made.append(F.struct(F.lit(k).alias("k"), F.lit(d).alias("dimension"), F.lit(f"{d}.{name}").alias("name"), F.lit(score.WEIGHTS[d]).alias("dimension_weight"), F.lit(w).alias("weight"), v.alias("value")))
            k += 1
    orders = table(spark, sf_dir, "orders")
    evidence = orders.select(F.col("o_custkey").alias("c_custkey"), (F.col("o_orderkey") % 2).alias("side"), F.when(F.col("o_orderkey") % 3 == 0, "date_only").otherwise("timestamp").alias("precision"))
    quality = score.temporal_quality(evidence, ["c_custkey", "side"], "precision")
    long = rows.select("c_custkey", F.explode(F.array(*made)).alias("p")).select("c_custkey", "p.*").withColumn("side", (F.col("k") % 2).cast("long"))
    return long.join(quality, ["c_custkey", "side"], "left").drop("side")


SLOT_SQL = SCORED + """, b AS (SELECT c_custkey, p_c_acctbal AS x, coalesce(p_spend, 50.0) AS y FROM scored),
w(k, dim, name, dw, iw) AS (VALUES (0, 'G', 'operating_profit_per_share_cagr_3y', 0.18, 0.35), (1, 'G', 'operating_profit_per_share_yoy', 0.18, 0.25), (2, 'G', 'operating_revenue_cagr_3y', 0.18, 0.25), (3, 'G', 'operating_revenue_yoy', 0.18, 0.15),
 (4, 'V', 'normalized_earnings_yield', 0.18, 0.45), (5, 'V', 'normalized_free_cash_flow_yield', 0.18, 0.25), (6, 'V', 'enterprise_value_or_sustainable_roe', 0.18, 0.30),
 (7, 'M', 'return_persistence', 0.18, 0.40), (8, 'M', 'margin_persistence', 0.18, 0.30), (9, 'M', 'cash_conversion_or_asset_efficiency', 0.18, 0.30),
 (10, 'EQ', 'cash_flow_to_operating_profit', 0.12, 0.35), (11, 'EQ', 'accrual_quality', 0.12, 0.25), (12, 'EQ', 'core_profit_share', 0.12, 0.20), (13, 'EQ', 'working_capital_quality', 0.12, 0.20),
 (14, 'FS', 'leverage_or_regulatory_capital', 0.08, 0.40), (15, 'FS', 'liquidity_or_interest_coverage', 0.08, 0.35), (16, 'FS', 'asset_or_contingent_risk', 0.08, 0.25),
 (17, 'CA', 'return_persistence', 0.16, 0.35), (18, 'CA', 'incremental_capital_return', 0.16, 0.30), (19, 'CA', 'shareholder_return_and_dilution', 0.16, 0.20), (20, 'CA', 'capital_discipline', 0.16, 0.15),
 (21, 'T', 'historical_valuation', 0.10, 0.35), (22, 'T', 'price_trend_and_volatility', 0.10, 0.25), (23, 'T', 'expectation_change', 0.10, 0.25), (24, 'T', 'quantified_event_and_liquidity', 0.10, 0.15)),
ev AS (SELECT o_custkey, o_orderkey % 2 AS side, min(CASE WHEN o_orderkey % 3 = 0 THEN 0.8 ELSE 1.0 END) AS quality FROM orders GROUP BY 1, 2),
sl AS (SELECT c_custkey, k, dim, dim || '.' || name AS name, CAST(dw AS DOUBLE) AS dw, CAST(iw AS DOUBLE) AS iw, CAST(quality AS DOUBLE) AS q,
 CASE WHEN k = 3 AND c_custkey % 13 = 4 THEN NULL WHEN k = 23 AND c_custkey % 11 = 5 THEN 50.0 WHEN k % 3 = 0 THEN 100 - x ELSE (x * (k % 4) + y * (4 - k % 4)) / 4 END AS v FROM b CROSS JOIN w LEFT JOIN ev ON o_custkey = c_custkey AND side = k % 2),
ds AS (SELECT c_custkey, dim, CASE WHEN count(v) = count(*) THEN sum(iw * v) END AS score FROM sl GROUP BY 1, 2),
wd AS (SELECT c_custkey, max(score) FILTER (WHERE dim = 'G') AS g, max(score) FILTER (WHERE dim = 'V') AS va, max(score) FILTER (WHERE dim = 'M') AS m, max(score) FILTER (WHERE dim = 'EQ') AS eq, max(score) FILTER (WHERE dim = 'FS') AS fs, max(score) FILTER (WHERE dim = 'CA') AS ca, max(score) FILTER (WHERE dim = 'T') AS t FROM ds GROUP BY 1),
cf AS (SELECT c_custkey, CASE WHEN count(q) = count(*) THEN sum(dw * iw * q) END AS p, least((4 + c_custkey % 2) / 5.0, 1.0) AS h, max(v) FILTER (WHERE k = 7) AS r1, max(v) FILTER (WHERE k = 8) AS r2, max(v) FILTER (WHERE k = 19) AS r3, max(v) FILTER (WHERE k = 20) AS r4,
 list_sort(list(name) FILTER (WHERE v IS NULL OR q IS NULL)) AS pending FROM sl GROUP BY c_custkey),
cc AS (SELECT *, CASE WHEN p IS NOT NULL THEN least(0.6 + 0.4 * (0.3 + 0.25 * p + 0.25 * h + 0.2), CASE WHEN c_custkey % 11 = 5 THEN 0.9 ELSE 1.0 END) END AS c FROM cf)"""


def assembled(spark, sf_dir):
    """A row for each customer: dimensions, risk slots, confidence columns and what is pending."""
    long = slots(spark, sf_dir)
    weight = F.col("dimension_weight") * F.col("weight")
    own = score.spread(score.dimension_scores(long, ["c_custkey"], "dimension", "weight", "value"), ["c_custkey"], "dimension", "score", DIMS)
    pending = F.array_sort(F.collect_list(F.when(F.col("value").isNull() | F.col("quality").isNull(), F.col("name"))))
    risk = [F.max(F.when(F.col("name") == n, F.col("value"))).alias(n.replace(".", "_")) for n in score.RISK_SLOTS]
    rest = long.groupBy("c_custkey").agg(F.when(F.count("quality") == F.count(F.lit(1)), F.sum(weight * F.col("quality"))).alias("quality"), F.count("value").alias("slots"), pending.alias("pending"), *risk)
    return own.join(rest, "c_custkey")


def numbers(wide, dims=None, weights=None):
    key = F.col("c_custkey")
    conf = score.confidence(F.col("quality"), 4 + key % 2, F.when(key % 11 == 5, 0.90))
    return conf, score.arithmetic(dims or {d: F.col(d) for d in DIMS}, conf["C"], {n: F.col(n.replace(".", "_")) for n in score.RISK_SLOTS}, weights)


@query("A16", SLOT_SQL + " SELECT c_custkey, dim AS dimension, round(score + 3e-8, 6) AS score FROM ds")
def dimension_scores(spark, sf_dir):
    return score.dimension_scores(slots(spark, sf_dir), ["c_custkey"], "dimension", "weight", "value").select("c_custkey", "dimension", six("score").alias("score"))


@query("R9 A15 A31", SLOT_SQL + """ SELECT c_custkey, (SELECT count(v) FROM sl WHERE sl.c_custkey = cc.c_custkey) AS slots, round(p + 3e-8, 6) AS quality, coalesce(array_to_string(pending, ','), '') AS pending,
 round((SELECT count(score) / 7.0 FROM ds WHERE ds.c_custkey = cc.c_custkey) + 3e-8, 6) AS dimensions_present FROM cc""")
def score_inputs(spark, sf_dir):
    """All 25 slots of a customer, or the slots for which it is pending."""
    return assembled(spark, sf_dir).select("c_custkey", "slots", six("quality").alias("quality"), F.array_join("pending", ",").alias("pending"), six(score.present_share(DIMS)).alias("dimensions_present"))


NUMBERS_SQL = """, n AS (SELECT c_custkey, p, h, c, g, va, t, 0.18 * g + 0.18 * va + 0.18 * m + 0.12 * eq + 0.08 * fs + 0.16 * ca + 0.10 * t AS s0, (0.18 * g + 0.18 * va + 0.18 * m + 0.12 * eq + 0.08 * fs + 0.16 * ca) / 0.90 AS sbase,
 (0.40 * r1 + 0.30 * r2) / 0.70 AS persistence, (0.20 * r3 + 0.15 * r4) / 0.35 AS downside, 0.40 * fs + 0.25 * eq + 0.20 * (0.40 * r1 + 0.30 * r2) / 0.70 + 0.15 * (0.20 * r3 + 0.15 * r4) / 0.35 AS safety FROM {wide} JOIN cc USING (c_custkey))"""


def _grade(x):
    return f"CASE WHEN {x} >= 90 THEN 'A+' WHEN {x} >= 80 THEN 'A' WHEN {x} >= 70 THEN 'B' WHEN {x} >= 60 THEN 'C' WHEN {x} >= 50 THEN 'D' WHEN {x} IS NOT NULL THEN 'E' END"


@query("A14 A17 P20 X8", SLOT_SQL + NUMBERS_SQL.format(wide="wd") + f""" SELECT c_custkey, CAST(1 AS DOUBLE) AS \"D\", round(p + 3e-8, 6) AS \"P\", round(h + 3e-8, 6) AS \"H\", CAST(1 AS DOUBLE) AS \"K\", round(c + 3e-8, 6) AS \"C\", round(s0 + 3e-8, 6) AS \"S0\", round(50 + c * (s0 - 50) + 3e-8, 6) AS \"Sc\", round(sbase + 3e-8, 6) AS \"Sbase\", round(50 + c * (sbase - 50) + 3e-8, 6) AS \"B\",
 round(persistence + 3e-8, 6) AS \"M_persistence\", round(downside + 3e-8, 6) AS \"CA_downside\", round(safety + 3e-8, 6) AS \"R_safety\", round(100 - safety + 3e-8, 6) AS risk_exposure, {_grade('50 + c * (s0 - 50)')} AS total_grade, {_grade('g')} AS growth_grade, {_grade('va')} AS value_grade, {_grade('safety')} AS risk_grade, {_grade('t')} AS timing_grade FROM n""".replace('\\"', '"'))
def confidence_scores(spark, sf_dir):
    wide = assembled(spark, sf_dir)
    conf, made = numbers(wide)
    grades = {"total_grade": made["Sc"], "growth_grade": F.col("G"), "value_grade": F.col("V"), "risk_grade": made["R_safety"], "timing_grade": F.col("T")}
    return wide.select("c_custkey", *(six(v).alias(n) for n, v in {**conf, **made}.items()), *(exprs.grade(v).alias(n) for n, v in grades.items()))


CAPPED_SQL = """, cp AS (SELECT c_custkey, CASE WHEN g IS NOT NULL THEN least(g, CASE WHEN c_acctbal < 0 THEN 40.0 ELSE 100.0 END) END AS g, CASE WHEN va IS NOT NULL THEN least(va, CASE WHEN c_nationkey = 3 THEN 55.0 ELSE 100.0 END, CASE WHEN c_nationkey = 3 AND c_acctbal < 0 THEN 50.0 ELSE 100.0 END) END AS va, m, eq, fs, ca, t FROM wd JOIN customer USING (c_custkey))"""


@query("A20 X1", SLOT_SQL + CAPPED_SQL + NUMBERS_SQL.format(wide="cp") + ' SELECT c_custkey, round(g + 3e-8, 6) AS growth, round(va + 3e-8, 6) AS value, round(s0 + 3e-8, 6) AS "S0", round(50 + c * (s0 - 50) + 3e-8, 6) AS "Sc", round(50 + c * (sbase - 50) + 3e-8, 6) AS "B" FROM n')
def capped_scores(spark, sf_dir):
    """Caps put on dimensions, the lowest of several, and the scores recomputed from what they leave."""
    c = table(spark, sf_dir, "customer")
    cap = lambda where, d, n: c.where(where).select("c_custkey", F.lit(d).alias("dimension"), F.lit(n).alias("cap"))
    caps = cap("c_acctbal < 0", "G", 40.0).unionByName(cap("c_nationkey = 3", "V", 55.0)).unionByName(cap("c_nationkey = 3 AND c_acctbal < 0", "V", 50.0))
    wide = assembled(spark, sf_dir)
    long = wide.select("c_custkey", F.explode(F.array(*(F.struct(F.lit(d).alias("dimension"), F.col(d).alias("score")) for d in DIMS))).alias("p")).select("c_custkey", "p.*")
    kept = score.spread(score.capped(long, caps, ["c_custkey"]), ["c_custkey"], "dimension", "capped", DIMS)
    both = kept.join(wide.drop(*DIMS), "c_custkey")
    _, made = numbers(both)
    return both.select("c_custkey", six("G").alias("growth"), six("V").alias("value"), *(six(made[n]).alias(n) for n in ("S0", "Sc", "B")))


def candidates(spark, sf_dir, scenarios):
    """(scenario, c_custkey, c_nationkey, pool, reasons and the numbers of the order) of every customer in every scenario: caps, scores and bounds in one pass."""
    wide = assembled(spark, sf_dir).join(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal"), "c_custkey")
    low = F.when(F.col("c_acctbal") < 0, 40.0).otherwise(100.0)
    wide = wide.withColumn("G", F.when(F.col("G").isNotNull(), F.least("G", low)))
    rows = selection.with_scenarios(wide, scenarios)
    conf, made = numbers(rows, weights={d: F.col(f"w_{d}") for d in DIMS})
    rows = rows.withColumns({"C": conf["C"], "Sc": made["Sc"], "B": made["B"], "R_safety": made["R_safety"]})
    barred = F.when(F.col("c_nationkey") == 3, F.array(F.lit("strong"))).when(F.col("c_nationkey") == 7, F.array(F.lit("strong"), F.lit("wait"))).otherwise(F.array().cast("array<string>"))
    rows = rows.withColumn("vetoed", F.col("c_custkey") % 17 == 4).withColumn("prohibited", barred)
    return selection.qualified(rows, "vetoed", "prohibited", POOLS, F.col("shift"))


#: The reference bounds suit real scores; these tables' mixed percentiles lie nearer to 50, so the queries' bounds do too.
POOLS = (selection.Pool("strong", "Sc", 54.0, True, ("Sc", "C", "R_safety"), 4, 20), selection.Pool("wait", "B", 46.0, False, ("B", "C", "V"), 10, 50))


def _scenario_values():
    return ", ".join(f"('{r[0]}', CAST({r[1]} AS DOUBLE), {', '.join(f'CAST({w!r} AS DOUBLE)' for w in r[2:])})" for r in SCENARIOS)


SCENARIOS = selection.scenario_rows(bound=4.0)
POOL_SQL = """, sc(scenario, shift, wg, wv, wm, weq, wfs, wca, wt) AS (VALUES {values}),
bs AS (SELECT c_custkey, c_nationkey, CASE WHEN g IS NOT NULL THEN least(g, CASE WHEN c_acctbal < 0 THEN 40.0 ELSE 100.0 END) END AS g, va, m, eq, fs, ca, t FROM wd JOIN customer USING (c_custkey)),
nn AS (SELECT bs.c_custkey, c_nationkey, scenario, shift, g, va, m, eq, fs, t, c, wg * g + wv * va + wm * m + weq * eq + wfs * fs + wca * ca + wt * t AS s0, (wg * g + wv * va + wm * m + weq * eq + wfs * fs + wca * ca) / (wg + wv + wm + weq + wfs + wca) AS sb,
 0.40 * fs + 0.25 * eq + 0.20 * (0.40 * r1 + 0.30 * r2) / 0.70 + 0.15 * (0.20 * r3 + 0.15 * r4) / 0.35 AS safety FROM bs JOIN cc USING (c_custkey) CROSS JOIN sc),
qq AS (SELECT *, 50 + c * (s0 - 50) AS scs, 50 + c * (sb - 50) AS b2 FROM nn),
rr AS (SELECT *, concat_ws(',', CASE WHEN coalesce(m >= 45, false) THEN NULL ELSE 'M_floor' END, CASE WHEN coalesce(eq >= 45, false) THEN NULL ELSE 'EQ_floor' END, CASE WHEN coalesce(fs >= 45, false) THEN NULL ELSE 'FS_floor' END, CASE WHEN c_custkey % 17 = 4 THEN 'veto' END, CASE WHEN c_nationkey = 7 OR (c_nationkey = 3 AND t >= 55) THEN 'prohibited' END) AS rest FROM qq),
rs AS (SELECT *, CASE WHEN t IS NULL THEN 'timing_unknown' ELSE concat_ws(',', CASE WHEN coalesce(CASE WHEN t >= 55 THEN scs >= 54 + shift ELSE b2 >= 46 + shift END, false) THEN NULL ELSE 'score' END, CASE WHEN coalesce(c >= 0.75, false) THEN NULL ELSE 'confidence' END, nullif(rest, '')) END AS reasons FROM rr),
pl AS (SELECT *, CASE WHEN reasons = '' THEN CASE WHEN t >= 55 THEN 'strong' ELSE 'wait' END END AS pool FROM rs),
od AS (SELECT *, CASE pool WHEN 'strong' THEN scs ELSE b2 END AS o1, CASE pool WHEN 'strong' THEN safety ELSE va END AS o3, CASE pool WHEN 'strong' THEN 4 ELSE 10 END AS cap, CASE pool WHEN 'strong' THEN 20 ELSE 50 END AS room FROM pl WHERE pool IS NOT NULL),
og AS (SELECT *, row_number() OVER (PARTITION BY scenario, pool, c_nationkey ORDER BY o1 DESC, c DESC, o3 DESC, c_custkey) AS gn FROM od),
op AS (SELECT *, row_number() OVER (PARTITION BY scenario, pool, gn <= cap ORDER BY o1 DESC, c DESC, o3 DESC, c_custkey) AS pn FROM og),
oh AS (SELECT *, count(*) FILTER (WHERE gn <= cap AND pn <= room) OVER (PARTITION BY scenario, pool, c_nationkey) AS held FROM op),
dc AS (SELECT *, CASE WHEN gn <= cap AND pn <= room THEN 'selected' WHEN held >= cap THEN 'group_cap' ELSE 'capacity' END AS state, CASE WHEN gn <= cap AND pn <= room THEN gn ELSE held END AS group_count FROM oh)""".format(values=_scenario_values())


@query("X2", SLOT_SQL + POOL_SQL + " SELECT c_custkey, pool, reasons FROM pl WHERE scenario = 'base'")
def pool_qualification(spark, sf_dir):
    """The pool of each customer, or the tests that keep it out: score, confidence, floors, veto, prohibitions, timing."""
    rows = candidates(spark, sf_dir, SCENARIOS[:1])
    return rows.select("c_custkey", "pool", F.array_join("reasons", ",").alias("reasons"))


@query("X3", SLOT_SQL + POOL_SQL + " SELECT c_custkey, pool, c_nationkey, round(o1 + 3e-8, 6) AS first, round(c + 3e-8, 6) AS second, round(o3 + 3e-8, 6) AS third, group_count, state FROM dc WHERE scenario = 'base'")
def pool_selection(spark, sf_dir):
    """Every candidate's place in the order, its industry's count and the decision: 4 and 20 in the strong pool, 10 and 50 in the other."""
    rows = selection.selected(candidates(spark, sf_dir, SCENARIOS[:1]), "c_custkey", "c_nationkey", POOLS)
    return rows.select("c_custkey", "pool", "c_nationkey", *(six(f"comparison.by_{k}").alias(n) for k, n in ((1, "first"), (2, "second"), (3, "third"))), "group_count", "state")


@query("X4", SLOT_SQL + POOL_SQL + """, mb AS (SELECT c_custkey, pool FROM dc WHERE state = 'selected' AND scenario = 'base'), ma AS (SELECT scenario, c_custkey, pool FROM dc WHERE state = 'selected' AND scenario <> 'base'),
md AS (SELECT scenario, mb.c_custkey, mb.pool FROM mb CROSS JOIN (SELECT DISTINCT scenario FROM dc WHERE scenario <> 'base'))
SELECT coalesce(md.scenario, ma.scenario) AS scenario, coalesce(md.c_custkey, ma.c_custkey) AS c_custkey, md.pool AS before, ma.pool AS after, CASE WHEN md.pool IS NULL THEN 'enters' WHEN ma.pool IS NULL THEN 'leaves' WHEN md.pool <> ma.pool THEN 'moves' ELSE 'stays' END AS change FROM md FULL JOIN ma ON md.scenario = ma.scenario AND md.c_custkey = ma.c_custkey""")
def pool_sensitivity(spark, sf_dir):
    """Who enters, leaves or moves when a dimension weighs 5 points more or less, or the bounds on scores move: all scenarios go through caps, scores, bounds and pools in one pass."""
    decided = selection.selected(candidates(spark, sf_dir, SCENARIOS), "c_custkey", "c_nationkey", POOLS, ("scenario",))
    return selection.membership_changes(decided, "c_custkey")


WEIGHTS_SQL = """, sc(d, step) AS (SELECT d, step FROM (VALUES ('G'), ('V'), ('M'), ('EQ'), ('FS'), ('CA'), ('T')) a(d) CROSS JOIN (VALUES (0.05), (-0.05)) b(step)),
base(d, w) AS (VALUES ('G', 0.18), ('V', 0.18), ('M', 0.18), ('EQ', 0.12), ('FS', 0.08), ('CA', 0.16), ('T', 0.10)),
sw AS (SELECT sc.d AS moved, step, b.d AS dim, CAST(CASE WHEN b.d = sc.d THEN b.w + step ELSE CAST(b.w AS DOUBLE) * (1 - (o.w + step)) / (1 - o.w) END AS DOUBLE) AS w FROM sc CROSS JOIN base b JOIN base o ON o.d = sc.d),
s1 AS (SELECT c_custkey, moved, step, CASE WHEN count(score) = 7 THEN sum(w * score) END AS s FROM ds JOIN sw USING (dim) GROUP BY 1, 2, 3),
s0 AS (SELECT c_custkey, CASE WHEN count(score) = 7 THEN sum(CAST(w AS DOUBLE) * score) END AS s FROM ds JOIN base ON d = dim GROUP BY 1)"""


@query("A16", SLOT_SQL + WEIGHTS_SQL + " SELECT moved AS dimension, CAST(step AS DOUBLE) AS step, count(*) FILTER (WHERE s1.s >= 55) AS members, count(*) FILTER (WHERE s1.s >= 55 AND s0.s < 55) AS entered, count(*) FILTER (WHERE s1.s < 55 AND s0.s >= 55) AS gone FROM s1 JOIN s0 USING (c_custkey) GROUP BY 1, 2")
def weight_sensitivity(spark, sf_dir):
    """Who would be above a bound if one dimension weighed 5 points more or less, the others in proportion."""
    wide = assembled(spark, sf_dir)
    values = {d: F.col(d) for d in DIMS}
    cases = []
    for d in DIMS:
        for step in (0.05, -0.05):
            w = {n: v + step if n == d else v * (1 - (score.WEIGHTS[d] + step)) / (1 - score.WEIGHTS[d]) for n, v in score.WEIGHTS.items()}
            cases.append(F.struct(F.lit(d).alias("dimension"), F.lit(step).alias("step"), score.weighted(values, w).alias("s")))
    rows = wide.select(score.weighted(values, score.WEIGHTS).alias("before"), F.explode(F.array(*cases)).alias("c")).select("before", "c.*")
    now, then = F.col("s") >= 55, F.col("before") >= 55
    return rows.groupBy("dimension", "step").agg(F.count_if(now).alias("members"), F.count_if(now & ~then).alias("entered"), F.count_if(~now & then).alias("gone"))
