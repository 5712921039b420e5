"""Derived features: tall facts to one row a key, formulas as column expressions, and back to long rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def wide(facts: DataFrame, key: list[str], metric: str, value: str, metrics: list[str], unit: str | None = None, want: str = "CNY") -> DataFrame:
    """One row a key with a column for each metric; a fact in another unit counts as missing."""
    ok = F.col(value) if unit is None else F.when(F.col(unit) == want, F.col(value))
    return facts.groupBy(*key).agg(*(F.max(F.when(F.col(metric) == m, ok)).alias(m) for m in metrics))


def derived(x: dict[str, Column]) -> dict[str, Column]:
    """The statement formulas over named amounts; a null operand makes a result null."""
    gross = x["revenue"] - x["cost"]
    ebit = x["profit"] + x["interest"]
    ratio = F.try_divide(x["tax"], x["profit"])
    rate = F.when(ratio.isNotNull(), F.least(F.greatest(ratio, F.lit(0.0)), F.lit(0.5)))  # least and greatest skip nulls
    debt = x["short_debt"] + x["long_debt"]
    capital = x["equity"] + debt - x["cash"]
    return {
        "gross_profit": gross, "gross_margin": F.try_divide(gross, x["revenue"]), "ebit": ebit, "tax_rate": rate, "nopat": ebit * (1 - rate),
        "free_cash": x["operating_cash"] - x["investment"], "debt": debt, "net_debt": debt - x["cash"], "invested_capital": capital,
        "working_capital": x["receivables"] + x["inventory"] - x["payables"], "accruals": x["net_profit"] - x["operating_cash"],
    }


def over_average(amount: Column, opening: Column, closing: Column) -> Column:
    """A flow over the mean of an opening and a closing balance."""
    return F.try_divide(amount, (opening + closing) / 2)


def long_features(df: DataFrame, key: list[str], features: list[str], applicable: dict[str, Column] | None = None) -> DataFrame:
    """(key, feature, value, status, reason): derived, missing or not_applicable for each feature."""
    rows = []
    for f in features:
        fits = (applicable or {}).get(f, F.lit(True))
        status = F.when(~fits, "not_applicable").when(F.col(f).isNull(), "missing").otherwise("derived")
        rows.append(F.struct(F.lit(f).alias("feature"), F.when(fits, F.col(f)).alias("value"), status.alias("status"), F.when(~fits, "template").when(F.col(f).isNull(), "operand_missing").alias("reason")))
    return df.select(*key, F.explode(F.array(*rows)).alias("f")).select(*key, "f.*")


def coverage(long: DataFrame, key: list[str]) -> DataFrame:
    """complete / applicable features and ready, partial or blocked."""
    out = long.groupBy(*key).agg(F.count_if(F.expr("status = 'derived'")).alias("complete"), F.count_if(F.expr("status <> 'not_applicable'")).alias("applicable"))
    ratio = F.try_divide(F.col("complete"), F.col("applicable"))
    return out.withColumn("coverage", ratio).withColumn("state", F.when(F.col("complete") == 0, "blocked").when(F.col("complete") < F.col("applicable"), "partial").otherwise("ready"))


def compiled(node: dict | str | float, facts: dict[str, Column]) -> Column:
    """A formula tree as a Column: a fact's name, a number, or {op, args} with add, subtract, divide, minimum, median or cagr (years)."""
    if isinstance(node, str):
        return facts[node]
    if isinstance(node, int | float):
        return F.lit(float(node))
    args = [compiled(a, facts) for a in node["args"]]
    if node["op"] == "add":
        return reduce(lambda a, b: a + b, args)
    if node["op"] == "subtract":
        return reduce(lambda a, b: a - b, args)
    if node["op"] == "divide":
        return F.try_divide(*args)
    every = reduce(lambda a, b: a & b, (a.isNotNull() for a in args))
    if node["op"] == "minimum":
        return F.when(every, F.least(*args) if len(args) > 1 else args[0])
    if node["op"] == "median":
        ordered, n = F.array_sort(F.array(*args)), len(args)
        return F.when(every, (ordered[(n - 1) // 2] + ordered[n // 2]) / 2)
    if node["op"] == "cagr":
        start, end = args
        return F.when((start > 0) & (end > 0), 100 * (F.pow(end / start, F.lit(1.0 / node["years"])) - 1))
    raise ValueError(f"unknown operation {node['op']}")


def leaves(node: dict | str | float) -> list[str]:
    """The facts that a formula tree reads, in order, each once."""
    found = [node] if isinstance(node, str) else [x for a in node["args"] for x in leaves(a)] if isinstance(node, dict) else []
    return list(dict.fromkeys(found))


def unit_of(node: dict | str | float, units: dict[str, str]) -> str:
    """The unit of a formula, worked out when the plan is made: sums need one unit, a quotient of equal units is a ratio; anything else is an error."""
    if isinstance(node, str):
        return units[node]
    if isinstance(node, int | float):
        return "number"
    own = [unit_of(a, units) for a in node["args"]]
    kinds = list(dict.fromkeys(u for u in own if u != "number"))
    if node["op"] == "divide":
        return "ratio" if own[0] == own[1] else own[0] if own[1] == "number" else f"{own[0]}_per_{own[1]}"
    if len(kinds) > 1:
        raise ValueError(f"{node['op']} of {' and '.join(kinds)}")
    return "ratio" if node["op"] == "cagr" else kinds[0] if kinds else "number"


def evaluated(node: dict | str | float, facts: dict[str, Column], units: dict[str, str]) -> tuple[Column, str, Column]:
    """(value, unit, reason) of a formula tree; the reason for a null names the first missing fact in alphabetical order, else the domain."""
    value, own = compiled(node, facts), sorted(leaves(node))
    missing = F.coalesce(*(F.when(facts[n].isNull(), F.lit(f"missing:{n}")) for n in own))
    return value, unit_of(node, units), F.when(value.isNull(), F.coalesce(missing, F.lit("domain")))
