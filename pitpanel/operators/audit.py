"""Integrity and quality: exact covers, gates, lineage, fingerprints and closures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitpanel.functions.shared import cut


def cover_errors(universe: DataFrame, decisions: DataFrame, key: list[str]) -> DataFrame:
    """Members without a decision, decisions for strangers, members decided twice."""
    n = decisions.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    both = universe.select(*key).distinct().withColumn("_due", F.lit(True)).join(n, key, "full_outer")
    return both.select(*key, F.when(F.col("_n").isNull(), "absent").when(F.col("_due").isNull(), "foreign").when(F.col("_n") > 1, "repeated").alias("error")).where("error is not null")


def fingerprint(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: a hash of the rows as a multiset, whatever their order and partitioning.

    Each row's SHA-256 is read as four numbers of 60 bits; their sums and the count are hashed. Sums
    combine before the shuffle, so no list of rows is ever gathered.
    """
    rows = df.select(F.sha2(F.concat_ws("\x1f", *(F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns)), 256).alias("h"))
    sums = [F.coalesce(F.sum(F.conv(F.substring("h", 1 + 15 * k, 15), 16, 10).cast("decimal(20,0)")), F.lit(0)).cast("string") for k in range(4)]
    return rows.agg(F.sha2(F.concat_ws(":", F.count(F.lit(1)).cast("string"), *sums), 256).alias("fingerprint"))


def evidence_errors(children: DataFrame, parents: DataFrame, key: list[str], same: dict[str, str]) -> DataFrame:
    """Children whose parent is absent or differs in a column (child column: parent column)."""
    p = parents.select(*key, F.lit(True).alias("_there"), *(F.col(v).alias(f"_p_{v}") for v in dict.fromkeys(same.values())))
    joined = children.join(p, key, "left")
    differs = reduce(lambda a, b: a | b, (~F.col(c).eqNullSafe(F.col(f"_p_{v}")) for c, v in same.items()))
    error = F.when(F.col("_there").isNull(), "absent").when(differs, "differs")
    return joined.withColumn("error", error).where("error is not null").drop("_there", *(f"_p_{v}" for v in dict.fromkeys(same.values())))


def blocked_closure(edges: DataFrame, terminal: DataFrame, rounds: int = 100) -> DataFrame:
    """(node, distance): every node that rests, over any number of edges (node, needs), on a terminal one.

    Each round joins only the nodes found last; lineage is cut in the shared folder.
    """
    found = cut(terminal.select("node").distinct().withColumn("distance", F.lit(0)))
    front = found
    for k in range(1, rounds + 1):
        nxt = edges.join(front.select(F.col("node").alias("needs")), "needs").select("node").distinct().join(found, "node", "left_anti")
        front = cut(nxt.withColumn("distance", F.lit(k)))
        if front.isEmpty():
            return found
        found = cut(found.unionByName(front))
    raise RuntimeError("the closure did not settle")


def ready(edges: DataFrame, done: DataFrame, nodes: DataFrame) -> DataFrame:
    """Nodes not done whose every need is done."""
    unmet = edges.join(done.select(F.col("node").alias("needs")), "needs", "left_anti").select("node").distinct()
    return nodes.select("node").join(done.select("node"), "node", "left_anti").join(unmet, "node", "left_anti")


def unique_match(left: DataFrame, right: DataFrame, key: list[str], name: str) -> DataFrame:
    """``left`` with the one matching ``name`` of ``right``; none or several give null and say so."""
    m = right.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), F.min(name).alias("_m"))
    joined = left.join(m, key, "left")
    return joined.withColumn("match", F.when(F.col("_n") == 1, F.col("_m"))).withColumn("match_state", F.when(F.col("_n").isNull(), "absent").when(F.col("_n") > 1, "ambiguous").otherwise("unique")).drop("_n", "_m")


def reasons(**tests: Column) -> Column:
    """The names of the tests that are not known to hold, in order."""
    return F.array_compact(F.array(*(F.when(~F.coalesce(t, F.lit(False)), F.lit(n)) for n, t in tests.items())))


def page_groups(pages: DataFrame, request: str, index: str, count: str, rows: str, total: str, same: list[str]) -> DataFrame:
    """For each request: whether pages 1 to count are all there once, add up to the total and agree on ``same``."""
    # One column is counted distinct; a second one would make every row several.
    alike = lambda c: F.coalesce(F.min(c) == F.max(c), F.lit(False))
    out = pages.groupBy(request).agg(F.count(F.lit(1)).alias("pages"), F.countDistinct(index).alias("different"), F.max(count).alias("due"), F.min(index).alias("first"), F.max(index).alias("last"), F.sum(rows).alias("have"), F.max(total).alias("want"), *(alike(c).alias(f"_{c}") for c in same))
    whole = (F.col("pages") == F.col("due")) & (F.col("different") == F.col("due")) & (F.col("first") == 1) & (F.col("last") == F.col("due"))
    agree = reduce(lambda a, b: a & b, (F.col(f"_{c}") for c in same), F.lit(True))
    return out.select(request, "pages", "have", whole.alias("complete"), (F.col("have") == F.col("want")).alias("adds_up"), agree.alias("agrees"))


def balance(facts: DataFrame, key: list[str], metric: str, value: str, total: str, parts: tuple[str, str], least: float = 1000.0, share: float = 0.001) -> DataFrame:
    """Whether total = sum of parts within max(least, share of total), for each key; null if a side is missing."""
    m = lambda name: F.max(F.when(F.col(metric) == name, F.col(value)))
    out = facts.groupBy(*key).agg(m(total).alias("_t"), m(parts[0]).alias("_a"), m(parts[1]).alias("_b"))
    gap = F.abs(F.col("_t") - F.col("_a") - F.col("_b"))
    return out.select(*key, gap.alias("gap"), (gap <= F.greatest(F.lit(least), share * F.abs("_t"))).alias("balanced"))


def dimension_state(states: list[str]) -> Column:
    """ready if all of a group's states are derived or not_applicable, blocked if none is derived, else partial; an aggregate over ``status``."""
    return F.when(F.bool_and(F.col("status").isin(*states)), "ready").when(~F.bool_or(F.col("status") == states[0]), "blocked").otherwise("partial")


def state_counts(df: DataFrame, column: str, every: list[str]) -> DataFrame:
    """Counts by state with zeros for states that don't occur."""
    listed = df.sparkSession.createDataFrame([(s,) for s in every], f"{column} string")
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return listed.join(counts, column, "left").select(column, F.coalesce("n", F.lit(0)).cast("long").alias("n"))
