"""Declarative rules over features: three-valued states, effects, caps, and their roll-up."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitpanel.functions.exprs import compare


def state(applies: Column, holds: Column) -> Column:
    """not_applicable, unresolved (unknown if it applies), pending (unknown if it holds), matched or clear."""
    return F.when(applies.isNull(), "unresolved").when(~applies, "not_applicable").when(holds.isNull(), "pending").when(holds, "matched").otherwise("clear")


def decide(values: DataFrame, rules: DataFrame, key: list[str]) -> DataFrame:
    """(key, rule_id, state) for every key and rule: pending where the rule's entry isn't known, else matched or clear.

    ``values`` has (key, entry, number, flag, label), of which an entry fills what it is; ``rules`` is configuration with (rule_id, kind, entry,
    op, threshold, expected, allowed). kind is numeric_redline (number op threshold), boolean_state (flag is ``expected``) or enum_state
    (label among ``allowed``). An entry of another type than its rule's is not known to the rule.
    """
    keys = values.select(*key).distinct().crossJoin(F.broadcast(rules))
    own = values.select(*key, "entry", "number", "flag", "label")
    kind = F.col("kind")
    holds = F.when(kind == "numeric_redline", compare("op", "number", "threshold")).when(kind == "boolean_state", F.col("flag") == F.col("expected")).when(kind == "enum_state", F.array_contains("allowed", F.col("label")))
    return keys.join(own, [*key, "entry"], "left").select(*key, "rule_id", state(F.lit(True), holds).alias("state"))


def redlines(values: DataFrame, rules: DataFrame, key: list[str], metric: str, value: str) -> DataFrame:
    """(key, rule_id, state) for numeric rules (rule_id, metric, op, threshold) on every key; rules are configuration."""
    long = values.select(*key, F.col(metric).alias("entry"), F.col(value).alias("number"), F.lit(None).cast("boolean").alias("flag"), F.lit(None).cast("string").alias("label"))
    wide = rules.select("rule_id", F.lit("numeric_redline").alias("kind"), F.col("metric").alias("entry"), "op", "threshold", F.lit(None).cast("boolean").alias("expected"), F.lit(None).cast("array<string>").alias("allowed"))
    return decide(long, wide, key)


def last_years(year: Column, value: Column, last: int, n: int = 5) -> Column:
    """An aggregate: the values of the ``n`` years up to ``last`` in order, null where a year isn't there."""
    return F.array(*(F.max(F.when(year == y, value)) for y in range(last - n + 1, last + 1)))


def whole(values: Column, n: int | None) -> Column:
    """Whether an array has ``n`` members (any number above none, if None) and no null."""
    size = F.size(values) > 0 if n is None else F.size(values) == n
    return size & ~F.exists(values, lambda x: x.isNull())


def nearest_rank(values: Column, share: float, n: int | None = 5) -> Column:
    """The ceil(share n)-th smallest of an array of ``n``; null if it has another length or a null."""
    ordered, size = F.array_sort(values), F.size(values)
    return F.when(whole(values, n), F.element_at(ordered, F.greatest(F.lit(1), F.ceil(F.lit(share) * size - 1e-9).cast("int"))))


def linear_quantile(values: Column, share: float, n: int | None = 5) -> Column:
    """The quantile between the two neighbours of share (n - 1) in an array of ``n``; null if it has another length or a null."""
    ordered, size = F.array_sort(values), F.size(values)
    at = F.lit(share) * (size - 1)
    lo = F.floor(at + 1e-9).cast("int")
    low, high = F.element_at(ordered, lo + 1), F.element_at(ordered, F.least(lo + 2, size))
    return F.when(whole(values, n), low + (high - low) * F.greatest(at - lo, F.lit(0.0)))


def cyclic(values: list[tuple[Column, Column]], profit: tuple[Column, Column] | None = None, share: float = 0.8) -> Column:
    """Matched if every current value reaches the quantile of its own five years; one proven false clears even if others are unknown.

    A history of another length or with a gap leaves its value unknown. Nothing matches while ``profit``, current and five years, has a gap.
    """
    reached = [now >= linear_quantile(past, share) for now, past in values]
    if profit:
        reached.append(F.when(profit[0].isNotNull() & whole(profit[1], 5), F.lit(True)))
    return state(F.lit(True), reduce(lambda a, b: a & b, reached))


def profit_basis(current: Column, history: Column) -> Column:
    """The smaller of the current value and the ordered middle of its five years."""
    middle = linear_quantile(history, 0.5)
    return F.when(current.isNotNull() & middle.isNotNull(), F.least(current, middle))


def effects(decisions: DataFrame, rules: DataFrame, basis: str | None = None) -> DataFrame:
    """One row for each effect of a matched rule, and one ``pending_evidence`` for each rule that is pending or unresolved.

    ``rules`` has rule_id and effects array<struct<kind, dimension, cap, pool>>; kinds are pool_prohibition (``both`` becomes two rows),
    independent_status, dimension_cap and valuation_profit_basis, which carries the decision's ``basis`` and is pending evidence itself
    where that isn't known.
    """
    # What a decision gives: its own effects where it matched, one fixed effect where it waits for evidence, else none.
    kind = "struct<kind:string,dimension:string,cap:double,pool:string>"
    waiting = F.array(F.struct(F.lit("pending_evidence").alias("kind"), F.lit(None).cast("string").alias("dimension"), F.lit(None).cast("double").alias("cap"), F.lit(None).cast("string").alias("pool")).cast(kind))
    joined = decisions.where(F.col("state").isin("matched", "pending", "unresolved")).join(F.broadcast(rules.select("rule_id", "effects")), "rule_id", "left")
    given = F.when(F.col("state") == "matched", F.col("effects").cast(f"array<{kind}>")).otherwise(waiting)
    rows = joined.select(*decisions.columns, F.explode(given).alias("e")).select(*decisions.columns, "e.*")
    known = F.lit(None).cast("double") if basis is None else F.when(F.col("kind") == "valuation_profit_basis", F.col(basis))
    rows = rows.withColumn("profit_basis", known)
    if basis is not None:
        rows = rows.withColumn("kind", F.when((F.col("kind") == "valuation_profit_basis") & F.col("profit_basis").isNull(), "pending_evidence").otherwise(F.col("kind")))
    pools = F.when(F.col("pool") == "both", F.array(F.lit("strong"), F.lit("wait"))).otherwise(F.array("pool"))
    return rows.withColumn("pool", F.explode(pools))


def roll_up(decisions: DataFrame, made: DataFrame, key: list[str]) -> DataFrame:
    """For each key: prohibited pools, statuses, pending rules and the evidence state, arrays sorted and unique."""
    base = decisions.groupBy(*key).agg(F.array_sort(F.collect_set(F.when(F.col("state").isin("pending", "unresolved"), F.col("rule_id")))).alias("pending"))
    own = made.groupBy(*key).agg(F.array_sort(F.collect_set(F.when(F.col("kind") == "pool_prohibition", F.col("pool")))).alias("pools"), F.array_sort(F.collect_set(F.when(F.col("kind") == "independent_status", F.col("rule_id")))).alias("statuses"))
    none = F.array().cast("array<string>")
    out = base.join(own, key, "left").select(*key, "pending", F.coalesce("pools", none).alias("pools"), F.coalesce("statuses", none).alias("statuses"))
    return out.withColumn("evidence_state", F.when(F.size("pending") > 0, "pending").otherwise("complete"))


def caps(made: DataFrame, key: list[str]) -> DataFrame:
    """The lowest cap for each key and dimension."""
    return made.where("kind = 'dimension_cap'").groupBy(*key, "dimension").agg(F.min("cap").alias("cap"))


def adjustment(value: Column, current: Column, normal: Column, needs: Column, decision: Column) -> tuple[Column, Column]:
    """(status, value) of a valuation whose profit may have to be put on its normal basis."""
    status = F.when(value.isNull(), "value_missing").when(~needs, "unaffected").when(decision == "pending", "pending_decision").when(decision == "clear", "original").when(normal.isNull(), "basis_missing").when(current == 0, "zero_current").otherwise("adjusted")
    adjusted = F.when(status == "adjusted", F.try_divide(value * normal, current)).when(status.isin("unaffected", "original"), value)
    return status, adjusted


def coverage_errors(expected: DataFrame, rules: DataFrame, key: list[str]) -> DataFrame:
    """Keys that must be covered exactly once: absent, repeated or unexpected."""
    have = rules.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    both = expected.select(*key, F.lit(True).alias("_due")).join(have, key, "full_outer")
    error = F.when(F.col("_n").isNull(), "absent").when(F.col("_due").isNull(), "unexpected").when(F.col("_n") > 1, "repeated")
    return both.select(*key, error.alias("error")).where("error is not null")


#: What every template's rule set must hold: kind, the context field it reads, and what its effects must be.
HARD, INDEPENDENT = "prohibits_both", "status_and_pool"
REQUIRED = {
    "st": ("boolean_state", "security_state.is_st", HARD), "star_st": ("boolean_state", "security_state.is_star_st", HARD), "forced_delist_risk": ("boolean_state", "security_state.forced_delist_risk", HARD),
    "delisting_arrangement": ("enum_state", "security_state.listing_status", HARD), "governance_red": ("boolean_state", "regulatory_state.active", HARD), "audit_qualified": ("boolean_state", "regulatory_state.active", HARD),
    "audit_adverse": ("boolean_state", "regulatory_state.active", HARD), "audit_disclaimer": ("boolean_state", "regulatory_state.active", HARD), "nonpositive_equity": ("numeric_redline", None, HARD),
    "no_effective_trade_20d": ("market_liquidity", None, HARD), "governance_orange": ("boolean_state", "regulatory_state.active", INDEPENDENT), "crowding": ("boolean_state", "regulatory_state.active", INDEPENDENT),
    "major_unlock_window": ("boolean_state", "regulatory_state.active", INDEPENDENT), "major_reduction_window": ("boolean_state", "regulatory_state.active", INDEPENDENT), "major_event": ("boolean_state", "regulatory_state.active", INDEPENDENT),
    "cyclic_top": ("cyclic_protection", None, INDEPENDENT),
}


def rule_set_errors(templates: DataFrame, rules: DataFrame, references: DataFrame) -> DataFrame:
    """(template, semantic, errors) for each required or given semantic of a template that breaks something, and for references.

    ``rules`` has (template, semantic, rule_id, kind, field, expected, allowed, op, threshold, effects array<struct<kind, pool, status>>);
    ``references`` (name, rule_id, template, want) must each name a rule, of their template and kind where these are given.
    Errors are missing, repeated, kind, field, parameters (a state must match true, the listing state exactly its one value, equity
    at most zero), prohibits_both, status_and_pool; unknown_rule, other_template and other_kind for references.
    """
    spec = F.array(*(F.struct(F.lit(n).alias("semantic"), F.lit(k).alias("_kind"), F.lit(f).cast("string").alias("_field"), F.lit(e).alias("_effect")) for n, (k, f, e) in REQUIRED.items()))
    due = templates.select("template", F.explode(spec).alias("d")).select("template", "d.*")
    times = rules.groupBy("template", "semantic").agg(F.count(F.lit(1)).alias("_n"), F.min_by(F.struct(*(c for c in rules.columns if c not in ("template", "semantic"))), "rule_id").alias("r"))
    row = due.join(times, ["template", "semantic"], "left").select("template", "semantic", "_kind", "_field", "_effect", "_n", "r.*")
    parameters = F.when(F.col("_kind") == "boolean_state", F.col("expected")).when(F.col("_kind") == "enum_state", F.col("allowed") == F.array(F.lit("delisting_arrangement"))).when(F.col("_kind") == "numeric_redline", (F.col("op") == "lte") & (F.col("threshold") == 0)).otherwise(F.lit(True))
    barred = F.filter("effects", lambda e: e["kind"] == "pool_prohibition")
    both = F.exists(barred, lambda e: e["pool"] == "both")
    status = F.exists("effects", lambda e: (e["kind"] == "independent_status") & (e["status"] == F.col("semantic"))) & (F.size(barred) > 0)
    fails = lambda ok, name: F.when(F.col("_n").isNotNull() & ~F.coalesce(ok, F.lit(False)), F.lit(name))
    tests = [
        F.when(F.col("_n").isNull(), "missing"), F.when(F.col("_n") > 1, "repeated"), fails(F.col("kind") == F.col("_kind"), "kind"), fails(F.col("_field").isNull() | (F.col("field") == F.col("_field")), "field"), fails(parameters, "parameters"),
        fails((F.col("_effect") != HARD) | both, "prohibits_both"), fails((F.col("_effect") != INDEPENDENT) | status, "status_and_pool"),
    ]
    own = row.select("template", "semantic", F.array_compact(F.array(*tests)).alias("errors"))
    known = rules.select("rule_id", F.col("template").alias("_template"), F.col("kind").alias("_kind")).dropDuplicates(["rule_id"])
    named = references.join(known, "rule_id", "left")
    broken = F.when(F.col("_kind").isNull(), F.array(F.lit("unknown_rule"))).otherwise(F.array_compact(F.array(F.when(F.col("template") != F.col("_template"), "other_template"), F.when(F.col("want") != F.col("_kind"), "other_kind"))))
    return own.unionByName(named.select("template", F.col("name").alias("semantic"), broken.alias("errors"))).where(F.size("errors") > 0)
