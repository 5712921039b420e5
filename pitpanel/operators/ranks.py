"""Ranks with averaged ties, within groups or over the whole table, and peer cohorts with fallback."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitpanel.functions.shared import cut


def percent_rank(rank: Column, n: Column) -> Column:
    """0 to 100 over n values; a single value is 50."""
    return F.when(n == 1, F.lit(50.0)).otherwise((rank - 1) / (n - 1) * 100)


def midpoint_percentile(rank: Column, n: Column, higher_is_better: Column) -> Column:
    """100 (rank - 0.5) / n, turned over where lower is better."""
    up = 100 * (rank - 0.5) / n
    return F.when(higher_is_better, up).otherwise(100 - up)


#: Different values of a group that one task may number.
ONE_TASK = 500_000


def value_counts(df: DataFrame, values: list[str], group: list[str]) -> DataFrame:
    """(group columns, _m, _v, _n): how often each group has each value of each column."""
    pairs = F.array(*(F.struct(F.lit(m).alias("_m"), F.col(m).cast("double").alias("_v")) for m in values))
    return df.select(*group, F.explode(pairs).alias("p")).select(*group, "p.*").where("_v is not null").groupBy(*group, "_m", "_v").agg(F.count(F.lit(1)).alias("_n"))


def merged_counts(counts: DataFrame, group: list[str]) -> DataFrame:
    """The counts of coarser groups."""
    return counts.groupBy(*group, "_m", "_v").agg(F.sum("_n").alias("_n"))


def count_ranks(counts: DataFrame, group: list[str], buckets: int = 64, one_task: int = ONE_TASK) -> DataFrame:
    """``counts`` with rank and n: the average rank from 1 of each value in its group, and how many values the group has.

    Where no group has more than ``one_task`` different values a window numbers them. Else approximate quantiles deal
    the values into ordered buckets, so that the largest group, or the table itself (no ``group``), is numbered in many tasks, and each
    bucket is shifted by those before it in its group. Any bounds give the same exact ranks.
    """
    place = lambda base, n: base + 1 + (n - 1) / 2
    before = lambda w: F.coalesce(F.sum("_n").over(w.orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    own = Window.partitionBy(*group, "_m")
    most = counts.groupBy(*group, "_m").agg(F.count(F.lit(1)).alias("k")).agg(F.max("k")).first()[0] or 0
    if most <= one_task:
        return counts.select(*group, "_m", "_v", place(before(own), F.col("_n")).alias("rank"), F.sum("_n").over(own).alias("n"))
    names = [r[0] for r in counts.select("_m").distinct().collect()]  # as many as columns are ranked
    probabilities = [k / buckets for k in range(1, buckets)]
    bounds = {m: sorted(set(counts.where(F.col("_m") == m).approxQuantile("_v", probabilities, 0.01))) for m in names}
    above = lambda m: F.aggregate(F.array(*map(F.lit, bounds[m])), F.lit(0), lambda n, b: n + (F.col("_v") > b).cast("int"))
    dealt = cut(counts.withColumn("_b", reduce(lambda e, m: F.when(F.col("_m") == m, above(m)).otherwise(e), names, F.lit(0))))
    sums = dealt.groupBy(*group, "_m", "_b").agg(F.sum("_n").alias("_s"))  # a row a bucket
    sums = sums.select(*group, "_m", "_b", F.coalesce(F.sum("_s").over(own.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"), F.sum("_s").over(own).alias("n"))
    running = dealt.withColumn("_before", before(Window.partitionBy(*group, "_m", "_b")))
    return null_safe_join(running, sums, [*group, "_m", "_b"], "inner").select(*group, "_m", "_v", place(F.col("_base") + F.col("_before"), F.col("_n")).alias("rank"), "n")


def null_safe_join(left: DataFrame, right: DataFrame, key: list[str], how: str) -> DataFrame:
    """A join in which null keys equal each other; the right side's keys are dropped."""
    other = right.withColumnsRenamed({k: f"_r_{k}" for k in key})
    return left.join(other, reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in key)), how).drop(*(f"_r_{k}" for k in key))


def with_fallback(df: DataFrame, values: list[str], group: str, least: int = 20) -> DataFrame:
    """Adds <value>_pct and <value>_scope for each column: the rank in the group if it has ``least`` values of this very metric, else in the table.

    Values are counted once, by group; the table's counts are sums of the groups'.
    """
    counts = cut(value_counts(df, values, [group]))
    inner = count_ranks(counts, [group])
    whole = count_ranks(merged_counts(counts, []), []).withColumnsRenamed({"rank": "table_rank", "n": "table_n"})
    grouped = F.col("n") >= least
    pct = F.when(grouped, percent_rank(F.col("rank"), F.col("n"))).otherwise(percent_rank(F.col("table_rank"), F.col("table_n")))
    placed = inner.join(whole, ["_m", "_v"]).select(group, "_m", "_v", pct.alias("_pct"), F.when(grouped, "group").otherwise("table").alias("_scope"))
    placed, kinds, out = cut(placed), dict(df.dtypes), df
    for value in values:
        own = placed.where(F.col("_m") == value).select(group, F.col("_v").cast(kinds[value]).alias(value), F.col("_pct").alias(f"{value}_pct"), F.col("_scope").alias(f"{value}_scope"))
        out = null_safe_join(out, own, [group, value], "left")
    return out


def peer_percentiles(df: DataFrame, value: str, eligible: str, fine: list[str], coarse: list[str], higher: str, least: int = 20) -> DataFrame:
    """Adds percentile, scope, peers and reason: the fine cohort if it has ``least`` eligible rows, then the coarse one, else none.

    Rows that aren't eligible are nobody's peers and get no percentile. Values are counted once, by fine cohort.
    """
    rows = df.withColumn("_v", F.when(F.col(eligible) & F.col(value).isNotNull(), F.col(value).cast("double")))
    counts = cut(value_counts(rows, ["_v"], [*coarse, *fine]))
    narrow = count_ranks(counts, [*coarse, *fine]).drop("_m").withColumnsRenamed({"rank": "_r1", "n": "_n1"})
    wide = count_ranks(merged_counts(counts, coarse), coarse).drop("_m").withColumnsRenamed({"rank": "_r2", "n": "_n2"})
    placed = null_safe_join(narrow, wide, [*coarse, "_v"], "inner")
    rows = null_safe_join(rows, placed, [*coarse, *fine, "_v"], "left")
    known = F.col("_v").isNotNull()
    scope = F.when(known & (F.col("_n1") >= least), "fine").when(known & (F.col("_n2") >= least), "coarse")
    out = rows.withColumn("scope", scope)
    pct = F.when(F.col("scope") == "fine", midpoint_percentile(F.col("_r1"), F.col("_n1"), F.col(higher))).when(F.col("scope") == "coarse", midpoint_percentile(F.col("_r2"), F.col("_n2"), F.col(higher)))
    reason = F.when(~known, "not_eligible").when(F.col("scope").isNull(), F.lit(f"peer_count_below_{least}"))
    return out.withColumn("percentile", pct).withColumn("peers", F.when(F.col("scope") == "fine", F.col("_n1")).when(F.col("scope") == "coarse", F.col("_n2"))).withColumn("reason", reason).drop("_v", "_r1", "_r2", "_n1", "_n2")


def weighted_available(values: list[tuple[Column, float]]) -> tuple[Column, Column]:
    """(mean over the values that are there, weights renormalised; the share of weight that is there)."""
    there = reduce(lambda a, b: a + b, (F.when(v.isNotNull(), F.lit(w)).otherwise(0.0) for v, w in values))
    total = reduce(lambda a, b: a + b, (F.coalesce(v, F.lit(0.0)) * w for v, w in values))
    return F.try_divide(total, there), there


def representatives(df: DataFrame, group: str, score: str, coverage: str, key: str, each: int = 2, least_members: int = 20, least_coverage: float = 0.55, most: int = 120) -> DataFrame:
    """Adds pick: ``representative`` (the best ``each`` of every large group, groups in name order, up to ``most``), then ``fill`` by rank up to ``most``.

    Ranks go by score rounded to 6, coverage, key. Both caps are top-k sorts over rows that are already few
    for each group, never a window over the table.
    """
    order = [F.round(score, 6).desc(), F.col(coverage).desc(), F.col(key).asc()]
    df = cut(df)  # read three times below
    sound = F.coalesce((F.col(coverage) >= least_coverage) & F.col(score).isNotNull(), F.lit(False))
    rows = df.where(sound)
    # Spark keeps the best ``each`` of a group in every task before the shuffle.
    ranked = rows.withColumn("_place", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("_place") <= each)
    members = df.groupBy(group).agg(F.count(F.lit(1)).alias("_members"))
    chosen = null_safe_join(ranked, members, [group], "inner").where(F.col("_members") >= least_members).orderBy(group, "_place").limit(most)
    first = chosen.select(key, F.lit("representative").alias("pick"))
    fill = rows.join(first.select(key), key, "left_anti").orderBy(*order).limit(most).select(key, F.lit("fill").alias("pick"))
    place = F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(F.desc("pick"), *order))  # at most 2 * most rows
    picked = df.join(F.broadcast(first.unionByName(fill)), key)
    return picked.withColumn("_at", place).where(F.col("_at") <= most).drop("_at")
