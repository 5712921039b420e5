"""What a row rests on: contexts, stored records, jobs and snapshots, bundles, and the reasons where something is absent or differs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitpanel.functions import exprs

from . import versions


def context_reasons(rows: DataFrame, context: DataFrame, key: list[str], same: list[str]) -> DataFrame:
    """``rows`` with reason: context_absent, context_ambiguous (several rows of a key), differs:<columns> in the order given, or null.

    All columns of ``same`` are compared null-safely. The context is one row a key before it meets the rows.
    """
    own = context.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(*(F.col(c).alias(c) for c in same))).alias("_c"))
    joined = rows.join(own, key, "left")
    differs = F.array_compact(F.array(*(F.when(~F.col(c).eqNullSafe(F.col(f"_c.{c}")), F.lit(c)) for c in same)))
    reason = F.when(F.col("_n").isNull(), "context_absent").when(F.col("_n") > 1, "context_ambiguous").when(F.size(differs) > 0, F.concat(F.lit("differs:"), F.array_join(differs, ",")))
    return joined.withColumn("reason", reason).drop("_n", "_c")


def built_context(candidates: DataFrame, facts: DataFrame, key: list[str], strict: bool = False) -> DataFrame:
    """``candidates`` with the columns of their only row of ``facts`` and context_state: built, missing or ambiguous (then without columns).

    ``strict`` raises instead, naming how many candidates lack a row or have several.
    """
    rest = [c for c in facts.columns if c not in key]
    one = facts.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(*rest)).alias("_f"))
    state = F.when(F.col("_n").isNull(), "missing").when(F.col("_n") > 1, "ambiguous").otherwise("built")
    out = candidates.join(one, key, "left").withColumn("context_state", state)
    out = out.select(*candidates.columns, "context_state", *(F.when(F.col("context_state") == "built", F.col(f"_f.{c}")).alias(c) for c in rest))
    if strict:
        bad = out.agg(F.count_if(F.col("context_state") == "missing"), F.count_if(F.col("context_state") == "ambiguous")).first()
        if any(bad):
            raise ValueError(f"{bad[0]} candidates have no fact and {bad[1]} have several")
    return out


def applicable_rules(rows: DataFrame, rules: DataFrame, key: list[str], template: str, industry: str) -> DataFrame:
    """(key, rule_id, applicability) for the rules of each row's template: applicable, not_applicable, or unresolved where the industry isn't known.

    ``rules`` is configuration (template, rule_id, industries array); a null array applies to all of the template.
    """
    own = rows.select(*key, F.col(template).alias("template"), F.col(industry).alias("_industry"))
    both = own.join(F.broadcast(rules), "template")
    state = F.when(F.col("industries").isNull(), "applicable").when(F.col("_industry").isNull(), "unresolved").when(F.array_contains("industries", F.col("_industry")), "applicable").otherwise("not_applicable")
    return both.select(*key, "rule_id", state.alias("applicability"))


def unbacked(rows: DataFrame, stored: DataFrame, key: str, hash_col: str) -> DataFrame:
    """Rows whose hash no stored record has (unbacked), or that only records of another key have (other_key)."""
    own = stored.select(F.col(key).alias("_k"), hash_col).distinct()
    exact = own.withColumnRenamed("_k", key).withColumn("_exact", F.lit(True))
    known = own.select(hash_col).distinct().withColumn("_known", F.lit(True))
    joined = rows.join(exact, [key, hash_col], "left").join(known, hash_col, "left").where(F.col("_exact").isNull())
    return joined.select(*rows.columns, F.when(F.col("_known"), "other_key").otherwise("unbacked").alias("reason"))


def slot_states(members: DataFrame, datasets: tuple[str, ...], jobs: DataFrame, snapshots: DataFrame, key: str) -> DataFrame:
    """(key, dataset, gap) for every member and configured dataset: never_asked, the newest job's status unless it is done, done_without_snapshot, unverified, or verified.

    ``jobs`` has (key, dataset, job, status), ``snapshots`` (key, dataset, job, verified).
    """
    slots = members.select(key, F.explode(F.array(*map(F.lit, datasets))).alias("dataset"))
    newest = jobs.groupBy(key, "dataset").agg(F.max_by(F.struct("job", "status"), "job").alias("j")).select(key, "dataset", "j.job", "j.status")
    seen = snapshots.groupBy(key, "dataset", "job").agg(F.bool_or("verified").alias("_verified"))
    both = slots.join(newest, [key, "dataset"], "left").join(seen, [key, "dataset", "job"], "left")
    gap = F.when(F.col("job").isNull(), "never_asked").when(F.col("status") != "done", F.col("status")).when(F.col("_verified").isNull(), "done_without_snapshot").when(~F.col("_verified"), "unverified").otherwise("verified")
    return both.select(key, "dataset", gap.alias("gap"))


def resolved_values(rows: DataFrame, key: list[str], aliases: dict[str, tuple[str, ...]]) -> DataFrame:
    """(key, metric, alias, value, issue): for each metric its first alias with a finite value, and an ``invalid_financial_value`` row for every alias before or after that holds something else.

    Aliases may be text or numbers. A metric without any finite value has issue rows or none; a null alias says nothing.
    """
    made = []
    for metric, names in aliases.items():
        values = [exprs.number(F.col(n).cast("string")) for n in names]
        first = F.coalesce(*(F.when(v.isNotNull(), F.struct(F.lit(metric).alias("metric"), F.lit(n).alias("alias"), v.alias("value"), F.lit(None).cast("string").alias("issue"))) for n, v in zip(names, values, strict=True)))
        bad = (F.when(~exprs.missing(n) & v.isNull(), F.struct(F.lit(metric).alias("metric"), F.lit(n).alias("alias"), F.lit(None).cast("double").alias("value"), F.lit("invalid_financial_value").alias("issue"))) for n, v in zip(names, values, strict=True))
        made += [first, *bad]
    return rows.select(*key, F.explode(F.array_compact(F.array(*made))).alias("m")).select(*key, "m.*")


def exact_revisions(rows: DataFrame, request: list[str], parser: tuple[str, str, str], want: tuple[str, str, str], published: str, captured: str, content: str, as_of: Column) -> DataFrame:
    """Every revision of each request that was visible at ``as_of`` and made by exactly the wanted parser, contract and mapping, with its place: 1 is the winner.

    The newest published wins, then the newest captured, then the smallest content hash.
    """
    made = reduce(lambda a, b: a & b, (F.col(c) == w for c, w in zip(parser, want, strict=True)))
    seen = rows.where(made & exprs.visible(as_of, published, captured))
    order = [F.col(published).desc(), F.col(captured).desc(), F.col(content).asc()]
    return seen.withColumn("place", F.row_number().over(Window.partitionBy(*request).orderBy(*order)))


def bundle_lookups(wanted: DataFrame, bundles: DataFrame, input_hash: str, key: list[str], at: str) -> DataFrame:
    """``wanted`` (key and an input hash) with by_hash, the bundle of exactly that hash, and latest, the newest one of the key; null where there is none."""
    exact = bundles.groupBy(input_hash).agg(F.max_by("bundle", F.struct(at, "bundle")).alias("by_hash"))
    newest = versions.newest(bundles.where(F.col(at).isNotNull()), key, [F.col(at).desc(), F.col("bundle").desc()]).select(*key, F.col("bundle").alias("latest"))
    return wanted.join(exact, input_hash, "left").join(newest, key, "left")


def bundle_errors(headers: DataFrame, values: DataFrame, key: list[str], slots: tuple[str, ...], coverage: str) -> DataFrame:
    """(key, errors) of each bundle whose slots aren't exactly the expected ones, or whose stated coverage isn't the share of them with a value.

    Errors are absent:<n>, foreign:<n>, repeated:<n> and coverage, in this order.
    """
    expected = F.col("slot").isin(*slots)
    own = values.groupBy(*key, "slot").agg(F.count(F.lit(1)).alias("_n"), F.count("value").alias("_v"))
    sums = own.groupBy(*key).agg(F.count_if(expected).alias("_e"), F.count_if(~expected).alias("_f"), F.count_if(expected & (F.col("_n") > 1)).alias("_r"), F.count_if(expected & (F.col("_v") > 0)).alias("_c"))
    both = headers.join(sums, key, "left")
    n = lambda c: F.coalesce(F.col(c), F.lit(0))
    told = lambda count, name: F.when(count > 0, F.concat(F.lit(f"{name}:"), count.cast("string")))
    share = n("_c") / F.lit(float(len(slots)))
    errors = F.array_compact(F.array(told(F.lit(len(slots)) - n("_e"), "absent"), told(n("_f"), "foreign"), told(n("_r"), "repeated"), F.when(F.abs(F.col(coverage) - share) > 1e-9, "coverage")))
    return both.select(*key, errors.alias("errors")).where(F.size("errors") > 0)


def named_counts(df: DataFrame, kinds: dict[str, Column]) -> DataFrame:
    """(kind, name, n): how often each name occurs in each of several columns, in one pass; nulls aren't counted."""
    pairs = F.array(*(F.struct(F.lit(k).alias("kind"), e.cast("string").alias("name")) for k, e in kinds.items()))
    return df.select(F.explode(pairs).alias("p")).select("p.*").where("name IS NOT NULL").groupBy("kind", "name").agg(F.count(F.lit(1)).alias("n"))


def required_union(parts: dict[str, DataFrame], key: str) -> DataFrame:
    """The rows of all parts with ``part``, and repeated: whether an id stands in several rows of any of them. A part that is empty is an error."""
    absent = sorted(n for n, df in parts.items() if df.isEmpty())
    if absent:
        raise ValueError(f"no rows: {', '.join(absent)}")
    rows = reduce(lambda a, b: a.unionByName(b), (df.withColumn("part", F.lit(n)) for n, df in parts.items()))
    twice = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(key, F.lit(True).alias("repeated"))
    return rows.join(twice, key, "left").withColumn("repeated", F.coalesce("repeated", F.lit(False)))


#: What a job's stored error becomes; pending and running jobs, and those not asked for, are pending.
ERROR_CLASSES = {
    "retryable_network": ("retryable_source", "retryable_network", "retryable"), "source_blocked": ("source_blocked", "blocked"), "terminal_source_missing": ("terminal_source", "terminal_source_missing"),
    "target_period_missing": ("target_period_missing",), "unverified_snapshot": ("unverified_snapshot",),
}


def error_class(status: Column, raw: Column) -> Column:
    """pending, one of ``ERROR_CLASSES``, or null for an error that is none of them."""
    out = F.when(status.isNull() | status.isin("pending", "running"), "pending")
    for name, own in ERROR_CLASSES.items():
        out = out.when(raw.isin(*own), name)
    return out


def lifecycle(gates: DataFrame, counts: DataFrame, key: list[str]) -> DataFrame:
    """(key, state, open, shown): final where every gate passed, provisional where none failed but some wait, else draft; ``open`` lists the gates that
    did not pass, and counts are shown for final ones only.

    ``gates`` has (key, gate, status) with passed, pending or failed; a key without gates is a draft.
    """
    own = gates.groupBy(*key).agg(F.count_if(F.col("status") == "failed").alias("_failed"), F.count_if(F.col("status") == "pending").alias("_pending"), F.array_sort(F.collect_set(F.when(F.col("status") != "passed", F.col("gate")))).alias("open"))
    both = counts.join(own, key, "left")
    state = F.when(F.col("_failed").isNull() | (F.col("_failed") > 0), "draft").when(F.col("_pending") > 0, "provisional").otherwise("final")
    return both.select(*key, state.alias("state"), F.coalesce("open", F.array().cast("array<string>")).alias("open"), F.when(state == "final", F.col("n")).alias("shown"))


def evidence_days(days: DataFrame, day: str, is_open: Column, allowed: Column, n: int = 10) -> DataFrame:
    """The last ``n`` rows of a calendar up to ``allowed``, newest first, with is_open and latest, the last open day among all up to there."""
    upto = days.where(F.col(day) <= allowed)
    last = upto.where(is_open).agg(F.max(day).alias("latest"))
    shown = upto.orderBy(F.col(day).desc()).limit(n).select(day, is_open.alias("is_open"))
    return shown.crossJoin(last)  # one row
