"""Rank, peer and selection queries over the customer and part panels."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from pitpanel.operators import ranks

from .base import PANEL, panel, query, table

RANKED = """r AS (SELECT *, count({m}) OVER (PARTITION BY c_nationkey) AS n_g_{m}, count({m}) OVER () AS n_t_{m},
  rank() OVER (PARTITION BY c_nationkey, {m} IS NULL ORDER BY {m}) + (count(*) OVER (PARTITION BY c_nationkey, {m}) - 1) / 2.0 AS r_g_{m},
  rank() OVER (PARTITION BY {m} IS NULL ORDER BY {m}) + (count(*) OVER (PARTITION BY {m}) - 1) / 2.0 AS r_t_{m} FROM {src})"""


def _ranked(names, src="panel"):
    out = []
    for k, m in enumerate(names):
        out.append(RANKED.format(m=m, src=src).replace("r AS", f"r{k} AS", 1))
        src = f"r{k}"
    return ",\n".join(out)


def _pct(m):
    scale = lambda r, n: f"CASE WHEN {n} = 1 THEN 50.0 ELSE ({r} - 1) / ({n} - 1) * 100 END"
    return f"CASE WHEN {m} IS NULL THEN NULL WHEN n_g_{m} >= 20 THEN {scale(f'r_g_{m}', f'n_g_{m}')} ELSE {scale(f'r_t_{m}', f'n_t_{m}')} END"


#: Two modules, each a mean of its metrics that are there; the score is the mean of the modules that are there.
MODULES = {"growth": (("spend", 0.5), ("orders", 0.5)), "quality": (("c_acctbal", 1.0),)}
METRICS = (("c_acctbal", 0.45), ("spend", 0.275), ("orders", 0.275))


def _mean(parts):
    total = " + ".join(f"coalesce({v}, 0.0) * CAST({w} AS DOUBLE)" for v, w in parts)
    there = " + ".join(f"CASE WHEN {v} IS NULL THEN CAST(0 AS DOUBLE) ELSE CAST({w} AS DOUBLE) END" for v, w in parts)
    return f"({total}) / nullif({there}, 0)", there


SCORED = f"""WITH {PANEL}, {_ranked([m for m, _ in METRICS])},
pct AS (SELECT c_custkey, c_nationkey, {', '.join(f'{_pct(m)} AS p_{m}, CASE WHEN {m} IS NULL THEN NULL WHEN n_g_{m} >= 20 THEN $$group$$ ELSE $$table$$ END AS s_{m}' for m, _ in METRICS)} FROM r2),
modules AS (SELECT *, {_mean((('p_spend', 0.5), ('p_orders', 0.5)))[0]} AS growth, p_c_acctbal AS quality FROM pct),
scored AS (SELECT *, {_mean((('p_c_acctbal', 0.45), ('p_spend', 0.275), ('p_orders', 0.275)))[1]} AS coverage, {_mean((('growth', 0.55), ('quality', 0.45)))[0]} AS score, count(*) OVER (PARTITION BY c_nationkey) AS members FROM modules)""".replace("$$group$$", "'group'").replace("$$table$$", "'table'")


def scored(spark, sf_dir):
    rows = ranks.with_fallback(panel(spark, sf_dir), [m for m, _ in METRICS], "c_nationkey")
    growth, _ = ranks.weighted_available([(F.col(f"{m}_pct"), w) for m, w in MODULES["growth"]])
    quality, _ = ranks.weighted_available([(F.col(f"{m}_pct"), w) for m, w in MODULES["quality"]])
    rows = rows.withColumn("growth", growth).withColumn("quality", quality)
    score, _ = ranks.weighted_available([(F.col("growth"), 0.55), (F.col("quality"), 0.45)])
    _, there = ranks.weighted_available([(F.col(f"{m}_pct"), w) for m, w in METRICS])
    return rows.withColumn("score", score).withColumn("coverage", there)


@query("W1 W2 A3 A4 W5 K1 K2 F12", SCORED + """, sound AS (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY round(score, 6) DESC, coverage DESC, c_custkey) AS place FROM scored WHERE coverage >= 0.55 AND score IS NOT NULL),
first AS (SELECT c_custkey FROM sound WHERE members >= 20 AND place <= 2 ORDER BY c_nationkey, place LIMIT 120),
fill AS (SELECT c_custkey FROM sound WHERE c_custkey NOT IN (SELECT c_custkey FROM first) ORDER BY round(score, 6) DESC, coverage DESC, c_custkey LIMIT 120),
picked AS (SELECT s.*, u.pick, row_number() OVER (ORDER BY u.pick DESC, round(score, 6) DESC, coverage DESC, s.c_custkey) AS pos FROM scored s JOIN (SELECT c_custkey, 'representative' AS pick FROM first UNION ALL SELECT c_custkey, 'fill' FROM fill) u USING (c_custkey))
SELECT c_custkey, c_nationkey, round(score, 6) AS score, round(coverage, 6) AS coverage, pick FROM picked WHERE pos <= 120""")
def prefilter_candidates(spark, sf_dir):
    picked = ranks.representatives(scored(spark, sf_dir), "c_nationkey", "score", "coverage", "c_custkey")
    return picked.select("c_custkey", "c_nationkey", F.round("score", 6).alias("score"), F.round("coverage", 6).alias("coverage"), "pick")


@query("W1 W2 A3 A4", SCORED + " SELECT c_custkey, round(p_c_acctbal, 6) AS balance_pct, s_c_acctbal AS balance_scope, round(p_spend, 6) AS spend_pct, s_spend AS spend_scope, round(score, 6) AS score, round(coverage, 6) AS coverage FROM scored")
def prefilter_scores(spark, sf_dir):
    return scored(spark, sf_dir).select("c_custkey", F.round("c_acctbal_pct", 6).alias("balance_pct"), F.col("c_acctbal_scope").alias("balance_scope"), F.round("spend_pct", 6).alias("spend_pct"), F.col("spend_scope").alias("spend_scope"), F.round("score", 6).alias("score"), F.round("coverage", 6).alias("coverage"))


@query("A5", SCORED + " SELECT count(*) AS members, count(score) AS scored, count(*) FILTER (WHERE coverage >= 0.55) AS covered, round(avg(coverage), 6) AS mean_coverage FROM scored")
def prefilter_metrics(spark, sf_dir):
    return scored(spark, sf_dir).agg(F.count(F.lit(1)).alias("members"), F.count("score").alias("scored"), F.count_if(F.col("coverage") >= 0.55).alias("covered"), F.round(F.avg("coverage"), 6).alias("mean_coverage"))


def _parts(value):
    return f"""p AS (SELECT p_partkey, p_brand, p_type, p_size, p_retailprice, p_size % 2 = 0 AS higher, p_size <> 13 AS ok, {value} AS v FROM part),
e AS (SELECT *, CASE WHEN ok THEN v END AS x FROM p),
n AS (SELECT *, count(x) OVER (PARTITION BY p_brand, p_type) AS n1, count(x) OVER (PARTITION BY p_brand) AS n2,
 rank() OVER (PARTITION BY p_brand, p_type, x IS NULL ORDER BY x) + (count(*) OVER (PARTITION BY p_brand, p_type, x) - 1) / 2.0 AS r1,
 rank() OVER (PARTITION BY p_brand, x IS NULL ORDER BY x) + (count(*) OVER (PARTITION BY p_brand, x) - 1) / 2.0 AS r2 FROM e),
s AS (SELECT *, CASE WHEN x IS NULL THEN NULL WHEN n1 >= 20 THEN 'fine' WHEN n2 >= 20 THEN 'coarse' END AS scope FROM n),
q AS (SELECT *, CASE scope WHEN 'fine' THEN 100 * (r1 - 0.5) / n1 WHEN 'coarse' THEN 100 * (r2 - 0.5) / n2 END AS up, CASE scope WHEN 'fine' THEN n1 WHEN 'coarse' THEN n2 END AS peers,
 CASE WHEN x IS NULL THEN 'not_eligible' WHEN scope IS NULL THEN 'peer_count_below_20' END AS reason FROM s)"""


def _peers(spark, sf_dir, value):
    rows = table(spark, sf_dir, "part").withColumn("higher", F.col("p_size") % 2 == 0).withColumn("ok", F.col("p_size") != 13).withColumn("v", value)
    return ranks.peer_percentiles(rows, "v", "ok", ["p_type"], ["p_brand"], "higher")


@query("W3 W4", "WITH " + _parts("p_retailprice") + " SELECT p_partkey, scope, peers, reason, round(CASE WHEN higher THEN up ELSE 100 - up END, 6) AS percentile FROM q")
def peer_percentiles(spark, sf_dir):
    return _peers(spark, sf_dir, F.col("p_retailprice")).select("p_partkey", "scope", "peers", "reason", F.round("percentile", 6).alias("percentile"))


MIDDLE = "p_retailprice * least(1.0, (SELECT quantile_cont(p_retailprice, 0.5) FROM part b WHERE b.p_brand = part.p_brand) / p_retailprice)"


@query("W14 A24", "WITH " + _parts(MIDDLE) + " SELECT coalesce(scope, reason) AS state, count(*) AS n, count(*) FILTER (WHERE ok) AS eligible, round(avg(CASE WHEN higher THEN up ELSE 100 - up END), 4) AS mean_percentile FROM q GROUP BY 1")
def adjusted_peer_ranks(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    middle = parts.groupBy("p_brand").agg(F.percentile("p_retailprice", 0.5).alias("m"))
    rows = parts.join(middle, "p_brand").withColumn("higher", F.col("p_size") % 2 == 0).withColumn("ok", F.col("p_size") != 13).withColumn("v", F.col("p_retailprice") * F.least(F.lit(1.0), F.col("m") / F.col("p_retailprice")))
    ranked = ranks.peer_percentiles(rows, "v", "ok", ["p_type"], ["p_brand"], "higher")
    return ranked.groupBy(F.coalesce("scope", "reason").alias("state")).agg(F.count(F.lit(1)).alias("n"), F.count_if("ok").alias("eligible"), F.round(F.avg("percentile"), 4).alias("mean_percentile"))


@query("W16", """WITH g AS (SELECT source, lang, count(*) AS n, sum(n_chars) AS chars FROM documents GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (ORDER BY n DESC, source, lang) AS pos, count(*) OVER () AS reviewed FROM g)
SELECT source, lang, n, CAST(chars AS BIGINT) AS chars, reviewed, count(*) OVER () AS shown, reviewed > 25 AS truncated FROM r WHERE pos <= 25""")
def top_sources(spark, sf_dir):
    g = table(spark, sf_dir, "documents").groupBy("source", "lang").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"))
    shown = g.orderBy(F.desc("n"), "source", "lang").limit(25)
    sizes = g.agg(F.count(F.lit(1)).alias("reviewed"))  # one row
    rows = shown.crossJoin(sizes)
    return rows.withColumn("shown", F.least(F.col("reviewed"), F.lit(25).cast("long"))).withColumn("truncated", F.col("reviewed") > F.col("shown"))


@query("X7", """WITH d AS (SELECT CAST(o_orderdate AS DATE) AS day, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS close, max(o_totalprice) AS high, min(o_totalprice) AS low, o_orderpriority AS p FROM orders GROUP BY 1, 5),
l AS (SELECT *, lag(close) OVER w AS before, lag(close, 20) OVER w / nullif(lag(close, 120) OVER w, 0) - 1 AS momentum FROM d WINDOW w AS (PARTITION BY p ORDER BY day)),
m AS (SELECT day, left(p, 1) IN ('1', '2') AS urgent, avg(momentum) AS mean FROM l GROUP BY 1, 2)
SELECT p, l.day, round(avg(close) OVER (PARTITION BY p ORDER BY l.day ROWS 19 PRECEDING) + 1e-7, 4) AS ma20, round(avg(close) OVER (PARTITION BY p ORDER BY l.day ROWS 59 PRECEDING) + 1e-7, 4) AS ma60, round(avg(close) OVER (PARTITION BY p ORDER BY l.day ROWS 119 PRECEDING) + 1e-7, 4) AS ma120, round(avg(greatest(high - low, abs(high - before), abs(low - before))) OVER (PARTITION BY p ORDER BY l.day ROWS 19 PRECEDING) + 1e-7, 4) AS atr20, round(momentum - mean + 3e-8, 6) AS neutral_momentum FROM l JOIN m ON m.day = l.day AND m.urgent = (left(p, 1) IN ('1', '2'))""")
def technical_levels(spark, sf_dir):
    """Means of 20, 60 and 120 days, the mean true range, and six-minus-one-month momentum less its industry's mean of the day."""
    d = table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("p"), F.to_date("o_orderdate").alias("day")).agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("close"), F.max("o_totalprice").alias("high"), F.min("o_totalprice").alias("low"))
    w = Window.partitionBy("p").orderBy("day")
    rows = d.withColumn("before", F.lag("close").over(w)).withColumn("momentum", F.try_divide(F.lag("close", 20).over(w), F.lag("close", 120).over(w)) - 1)
    reach = F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - F.col("before")), F.abs(F.col("low") - F.col("before")))
    mean = lambda e, n: F.round(F.avg(e).over(w.rowsBetween(1 - n, 0)) + 1e-7, 4)  # off the halves, where engines differ
    levels = rows.select("p", "day", F.substring("p", 1, 1).isin("1", "2").alias("industry"), mean(F.col("close"), 20).alias("ma20"), mean(F.col("close"), 60).alias("ma60"), mean(F.col("close"), 120).alias("ma120"), mean(reach, 20).alias("atr20"), "momentum")
    peers = levels.groupBy("day", "industry").agg(F.avg("momentum").alias("mean"))
    return levels.join(peers, ["day", "industry"]).select("p", "day", "ma20", "ma60", "ma120", "atr20", F.round(F.col("momentum") - F.col("mean") + 3e-8, 6).alias("neutral_momentum"))
