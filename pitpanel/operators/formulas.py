"""Formulas over facts of a metric in a period: which leaves they need, how periods are resolved, and what blocks them.

A formula is a number, a leaf (metric, period), or {op, args} with add, subtract, divide, minimum, median or cagr (years). A period is a
fiscal year like FY1998 or a quarter like 1998Q2. Statements are cumulated, so a quarter of a flow is what its period end holds
less the one before (the first is itself); a stock's quarter is what stands at its end.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .features import compiled, unit_of

#: The period kinds of the four ends of a year.
ENDS = ("Q1", "H1", "Q3", "FY")
Leaf = tuple[str, str]


@dataclass
class Shape:
    """What a formula is made of: leaves in order, operations, period families, and the leaves under which it divides."""

    leaves: list[Leaf] = field(default_factory=list)
    operations: set[str] = field(default_factory=set)
    families: set[str] = field(default_factory=set)
    denominators: set[Leaf] = field(default_factory=set)


def shape(node, into: Shape | None = None, below: bool = False) -> Shape:
    """Walks a formula."""
    out = into or Shape()
    if isinstance(node, tuple):
        if node not in out.leaves:
            out.leaves.append(node)
        out.families.add(family(node[1]))
        if below:
            out.denominators.add(node)
    elif isinstance(node, dict):
        out.operations.add(node["op"])
        for k, arg in enumerate(node["args"]):
            shape(arg, out, below or (node["op"] == "divide" and k == 1) or (node["op"] == "cagr" and k == 0))
    return out


def family(period: str) -> str:
    """FY, quarter, or unknown for an identifier that no fact can have."""
    return "FY" if re.fullmatch(r"FY\d{4}", period) else "quarter" if re.fullmatch(r"\d{4}Q[1-4]", period) else "unknown"


def cells(leaf: Leaf, flow: bool) -> list[tuple[str, int, str]]:
    """(metric, year, kind) of the facts that a leaf is made from: its own, and for a later quarter of a flow the one before."""
    metric, period = leaf
    kind = family(period)
    if kind == "unknown":
        return []
    if kind == "FY":
        return [(metric, int(period[2:]), "FY")]
    year, q = int(period[:4]), int(period[5])
    return [(metric, year, ENDS[k]) for k in ((q - 1, q - 2) if flow and q > 1 else (q - 1,))]


def evaluated(facts: DataFrame, issues: DataFrame, formulas: dict[str, tuple], flows: set[str], units: dict[str, str], key: list[str]) -> DataFrame:
    """(key, slot, value, unit, status, reason, leaves, found) of every formula for every key with a fact.

    ``facts`` has (key, metric, year, kind, value), ``issues`` (key, metric, code), where a null metric concerns every formula; ``formulas`` are (tree,
    wanted unit). One aggregation resolves all leaves. A slot is blocked by the first of its blockers in alphabetical order: an issue of one of its metrics,
    a fact that stands there with several values (formula_fact_ambiguous), a flow's end without the one before
    (quarter_missing_prerequisite). Else it is missing with a reason (the first missing leaf, domain, unit), or derived.
    """
    shapes = {n: shape(tree) for n, (tree, _) in formulas.items()}
    every = list(dict.fromkeys(c for s in shapes.values() for leaf in s.leaves for c in cells(leaf, leaf[0] in flows)))
    name = {c: f"_c{k}" for k, c in enumerate(every)}
    here = lambda c: (F.col("metric") == c[0]) & (F.col("year") == c[1]) & (F.col("kind") == c[2])
    wanted = facts.where(F.col("metric").isin(*{c[0] for c in every})) if every else facts
    # Two bounds tell one value from several, so nothing is gathered.
    low = wanted.groupBy(*key).agg(*(e for c, n in name.items() for e in (F.min(F.when(here(c), F.col("value"))).alias(n), F.max(F.when(here(c), F.col("value"))).alias(f"{n}_hi"))))
    told = issues.groupBy(*key).agg(F.collect_set(F.struct("metric", "code")).alias("_issues"))
    rows = facts.select(*key).distinct().join(low, key, "left").join(told, key, "left")

    def resolved(leaf: Leaf) -> Column:
        own = cells(leaf, leaf[0] in flows)
        if not own:
            return F.lit(None).cast("double")
        return F.col(name[own[0]]) if len(own) == 1 else F.col(name[own[0]]) - F.col(name[own[1]])

    made = []
    for slot, (tree, want) in formulas.items():
        s = shapes[slot]
        value = compiled(_named(tree), {_text(leaf): resolved(leaf) for leaf in s.leaves})
        unit = unit_of(_named(tree), {_text(leaf): units[leaf[0]] for leaf in s.leaves})
        metrics = sorted({m for m, _ in s.leaves})
        hit = F.transform(F.filter(F.coalesce("_issues", F.array().cast("array<struct<metric:string,code:string>>")), lambda i: i["metric"].isNull() | i["metric"].isin(*metrics)), lambda i: F.concat(F.lit("formal_fact_issue_"), i["code"]))  # noqa: B023
        several = [F.col(name[c]) != F.col(f"{name[c]}_hi") for leaf in s.leaves for c in cells(leaf, leaf[0] in flows)]
        alone = [F.col(name[own[0]]).isNotNull() & F.col(name[own[1]]).isNull() for leaf in s.leaves if len(own := cells(leaf, leaf[0] in flows)) == 2]
        mark = lambda tests, text: F.when(reduce(lambda a, b: a | b, (F.coalesce(t, F.lit(False)) for t in tests), F.lit(False)), F.lit(text))
        blockers = F.array_sort(F.array_distinct(F.concat(hit, F.array_compact(F.array(mark(several, "formula_fact_ambiguous"), mark(alone, "quarter_missing_prerequisite"))))))
        lacking = F.coalesce(*(F.when(resolved(leaf).isNull(), F.lit(f"missing:{_text(leaf)}")) for leaf in sorted(s.leaves)), F.lit(None).cast("string"))
        reason = F.when(F.size(blockers) > 0, blockers[0]).when(value.isNull(), F.coalesce(lacking, F.lit("domain"))).when(F.lit(unit != want), F.lit("formula_unit_mismatch"))
        status = F.when(F.size(blockers) > 0, "blocked").when(reason.isNotNull(), "missing").otherwise("derived")
        found = sum((resolved(leaf).isNotNull().cast("int") for leaf in s.leaves), F.lit(0))
        made.append(F.struct(F.lit(slot).alias("slot"), F.when(status == "derived", value).alias("value"), F.lit(unit).alias("unit"), status.alias("status"), reason.alias("reason"), F.lit(len(s.leaves)).alias("leaves"), found.alias("found")))
    return rows.select(*key, F.explode(F.array(*made)).alias("m")).select(*key, "m.*")


def _text(leaf: Leaf) -> str:
    return f"{leaf[0]}@{leaf[1]}"


def _named(node):
    """The formula with its leaves as names, as ``features.compiled`` takes them."""
    if isinstance(node, tuple):
        return _text(node)
    return {**node, "args": [_named(a) for a in node["args"]]} if isinstance(node, dict) else node


def rebuilt_facts(sources: dict[str, DataFrame], mapping: dict[str, tuple[str, str, str]], key: list[str]) -> DataFrame:
    """(key, statement, metric, value, unit, nature) from wide statements, a table for each: every mapped column with a value is a fact.

    ``mapping`` is column: (metric, unit, nature); a column that isn't mapped makes no fact, and one that a source lacks none either.
    """
    out = None
    for statement, df in sources.items():
        own = [c for c in df.columns if c in mapping]
        facts = F.array(*(F.struct(F.lit(mapping[c][0]).alias("metric"), F.col(c).cast("double").alias("value"), F.lit(mapping[c][1]).alias("unit"), F.lit(mapping[c][2]).alias("nature")) for c in own))
        rows = df.select(*key, F.lit(statement).alias("statement"), F.explode(facts).alias("f")).select(*key, "statement", "f.*").where("value IS NOT NULL")
        out = rows if out is None else out.unionByName(rows)
    return out


def multiset_differences(stored: DataFrame, derived: DataFrame) -> DataFrame:
    """The rows that one side holds more often than the other, with side (stored or derived) and how many times more.

    One aggregation over both sides, counted before the shuffle; two exceptAll would sort and shuffle each side twice.
    """
    columns = derived.columns
    both = stored.select(*columns, F.lit(1).alias("_n")).unionByName(derived.select(*columns, F.lit(-1).alias("_n")))
    more = both.groupBy(*columns).agg(F.sum("_n").alias("_n")).where("_n <> 0")
    return more.select(*columns, F.when(F.col("_n") > 0, "stored").otherwise("derived").alias("side"), F.abs("_n").alias("times"))
