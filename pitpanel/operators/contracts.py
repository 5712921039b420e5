"""Contracts that rows must meet before they count: identities, facts, evidence, sources, market rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitpanel.functions.exprs import finite, number, period_kind, violations

#: The vocabularies of facts.
UNITS = ("CNY", "shares", "ratio", "CNY_per_share")
NATURES = ("instant", "duration")


def identity_error(code: Column, full_code: Column, expected: Column) -> Column:
    """Why a row's two codes don't name the expected id (two letters and six digits); null where they do.

    ``code`` has six digits, ``full_code`` six digits, a dot and the exchange; one of them may be blank.
    """
    short, full = F.coalesce(code, F.lit("")), F.coalesce(full_code, F.lit(""))
    sound = ((short == "") | short.rlike("^[0-9]{6}$")) & ((full == "") | full.rlike(r"^[0-9]{6}\.(SH|SZ|BJ)$"))
    joined = F.when(full != "", F.concat(F.substring(full, 8, 2), F.substring(full, 1, 6))).otherwise(F.concat(F.substring(expected, 1, 2), short))
    agree = ((short == "") | (full == "") | (short == F.substring(full, 1, 6))) & (joined == expected)
    return F.when((short == "") & (full == ""), "missing").when(~sound, "invalid").when(~agree, "mismatch")


def curated(rows: DataFrame) -> DataFrame:
    """Active ordinary shares of two exchanges from (code, code_name, type, status): security_id, code6, exchange, board and risk_tags; 689xxx is left out."""
    code = F.lower(F.trim(F.col("code")))
    kept = rows.where((F.col("type") == "1") & (F.col("status") == "1") & code.rlike(r"^(sh\.6|sz\.[03])\d{5}$") & ~code.rlike(r"^sh\.689"))
    exchange, six = F.upper(F.substring(code, 1, 2)), F.substring(code, 4, 6)
    board = F.when((exchange == "SH") & six.startswith("688"), "star").when((exchange == "SZ") & (six.startswith("300") | six.startswith("301")), "growth").otherwise("main")
    tags = F.when(F.upper(F.coalesce("code_name", F.lit(""))).contains("ST"), F.array(F.lit("ST"))).otherwise(F.array().cast("array<string>"))
    return kept.withColumns({"security_id": F.concat(exchange, six), "code6": six, "exchange": exchange, "board": board, "risk_tags": tags})


def sound_batches(rows: DataFrame, batch: list[str], error: str) -> DataFrame:
    """``rows`` with batch_ok: one row with an error spoils its whole batch."""
    spoilt = rows.where(F.col(error).isNotNull()).select(*batch).distinct().withColumn("_bad", F.lit(True))
    return rows.join(spoilt, batch, "left").withColumn("batch_ok", F.col("_bad").isNull()).drop("_bad")


def fact_violations() -> Column:
    """The rules that a fact breaks; over the columns statement, nature, period_kind, period_start, period_end, value, unit, announced_at, updated_at (may be null) and effective_at."""
    c = F.col
    instant = c("nature") == "instant"
    return violations(
        nature=c("nature").isin(*NATURES), statement=instant == (c("statement") == "balance"), period_kind=c("period_kind") == period_kind("period_end"),
        start=F.when(instant, c("period_start").isNull()).otherwise(c("period_start") == F.trunc("period_end", "year")), value=finite("value").isNotNull(), unit=c("unit").isin(*UNITS),
        effective=(c("effective_at") >= c("announced_at")) & (c("updated_at").isNull() | (c("effective_at") >= c("updated_at"))),
    )


def raw_dimension(metric: Column, statement: Column) -> Column:
    """The dimension that a raw fact feeds."""
    return F.when(metric == "revenue", "G").when(statement == "income", "M").when(metric == "operating_cash_flow", "EQ").when(statement == "cash_flow", "CA").otherwise("FS")


def evidence_reasons(url: Column, hosts: list[str], same: Column, published: Column, effective: Column, captured: Column, precision: Column, binding: Column) -> Column:
    """Sorted reasons to reject a fetched page: scheme, host, identity, times, precision and its calendar binding; none means verified."""
    host, scheme = F.lower(F.try_parse_url(url, F.lit("HOST"))), F.lower(F.try_parse_url(url, F.lit("PROTOCOL")))
    found = violations(
        not_https=scheme == "https", host_not_allowed=host.isin(*hosts), identity_mismatch=same, published_missing=published.isNotNull(), effective_before_publication=published.isNull() | (effective >= published),
        captured_before_publication=published.isNull() | (captured >= published), invalid_precision=precision.isin("timestamp", "date_only"),
        calendar_binding_missing=(precision != "date_only") | binding.isNotNull(), calendar_binding_forbidden=(precision != "timestamp") | binding.isNull(),
    )
    return F.array_sort(found)


def universe_status(in_scope: Column, complete: Column, vetoes: Column) -> Column:
    """One status, the first that fits: out_of_scope, pending_evidence, pool_vetoed, formal_scored."""
    return F.when(~in_scope, "out_of_scope").when(~complete, "pending_evidence").when(F.size(vetoes) > 0, "pool_vetoed").otherwise("formal_scored")


def source_audit(rows: DataFrame, source: list[str], kind: str, accepted: list[str], declared: DataFrame) -> DataFrame:
    """Accepted and excluded rows of each source, and whether they add up to its declared ``row_count``."""
    own = F.coalesce(F.col(kind).isin(*accepted), F.lit(False))
    seen = rows.groupBy(*source).agg(F.count_if(own).alias("accepted"), F.count_if(~own).alias("excluded"), F.count_if(F.col(kind).isNull()).alias("untyped"))
    both = declared.join(seen, source, "full_outer")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return both.select(*source, zero("accepted"), zero("excluded"), zero("untyped"), "row_count", F.coalesce(F.col("accepted") + F.col("excluded") == F.col("row_count"), F.lit(False)).alias("reconciled"))


def effective_price(status: Column, close: Column, previous: Column) -> tuple[Column, Column, Column]:
    """(price, basis, error): the close of an active row, the close before of a suspended one."""
    s = F.lower(F.trim(F.coalesce(status, F.lit(""))))
    off, on = s.isin("0", "false", "suspended"), s.isin("1", "true", "active")
    price = F.when(on, finite(close)).when(off, finite(previous))
    return price, F.when(price.isNotNull(), F.when(on, "close").otherwise("suspended_preclose")), F.when(~(off | on), "market_invalid_tradestatus").when(price.isNull(), "market_missing_close")


def market_gate(rows: DataFrame, universe: DataFrame, key: str, day: str, error: str, date: str) -> DataFrame:
    """One row: counts and the errors of a market snapshot in a fixed order, over rows with a row error each."""
    seen = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    both = seen.where(F.col(key).isNotNull()).join(universe.select(key, F.lit(True).alias("_in")).distinct(), key, "full_outer")
    sums = both.agg(F.count_if(F.col("n") > 1).alias("repeated"), F.count_if(F.col("_in").isNull()).alias("strangers"), F.count_if(F.col("n").isNull()).alias("absent"), F.count("_in").alias("universe"))
    own = rows.agg(F.count(F.lit(1)).alias("records"), F.count_if(F.col(key).isNull()).alias("unnamed"), F.count_if(~F.col(day).eqNullSafe(F.lit(date))).alias("late"), F.array_sort(F.collect_set(error)).alias("found"))
    one = own.crossJoin(sums)  # two one-row frames
    test = lambda bad, name: F.when(bad, F.lit(name))
    errors = F.array_compact(F.array(test(F.col("repeated") > 0, "market_duplicate_security"), test(F.col("strangers") + F.col("unnamed") > 0, "market_outside_universe"), test(F.col("absent") > 0, "market_incomplete_universe"), test(F.col("late") > 0, "market_wrong_date")))
    return one.select("records", "universe", (F.col("universe") - F.col("absent")).alias("covered"), F.concat(errors, "found").alias("errors"))


def adjusted_metrics(metrics: DataFrame, decisions: DataFrame, dependencies: DataFrame, coverage: DataFrame) -> DataFrame:
    """Metrics (security, metric, template, value) with their policy decision (security, decision, current, normal), the decision's dependency
    (decision, metric, policy) and the adapter's coverage (template, metric, policy): status and adjusted value.

    The decision's dependency must be the one that the adapter covers.
    """
    covered = coverage.withColumnRenamed("policy", "_covered")
    rows = metrics.join(decisions, "security", "left").join(dependencies, ["decision", "metric"], "left").join(covered, ["template", "metric"], "left")
    c = F.col
    status = (
        F.when(c("template").isNull(), "invalid_template").when(c("decision").isNull(), "applicability_unresolved").when(c("policy").isNull() | ~c("policy").eqNullSafe(c("_covered")), "coverage_differs")
        .when(c("decision") == "pending", "pending_decision").when(c("value").isNull(), "value_missing").when((c("policy") == "none") | (c("decision") == "clear"), "original")
        .when(c("normal").isNull(), "basis_missing").when(c("current") == 0, "zero_current").otherwise("adjusted")
    )
    adjusted = F.when(status == "original", c("value")).when(status == "adjusted", c("value") * c("normal") / c("current"))
    return rows.select("security", "metric", "template", status.alias("status"), adjusted.alias("adjusted"))


def current_receipts(members: DataFrame, stored: DataFrame, key: str, input_hash: str, content: str) -> DataFrame:
    """Each member's stored bundle under its recomputed input hash: current, content_differs, or an explicit absence."""
    own = stored.select(key, input_hash, F.col(content).alias("_content"), F.lit(True).alias("_there"))
    rows = members.join(own, [key, input_hash], "left")
    return rows.select(key, F.when(F.col("_there").isNull(), "current_receipt_absent").when(F.col("_content") == F.col(content), "current").otherwise("content_differs").alias("state"))


def provenance(issues: DataFrame, bindings: DataFrame, issue: str, key: str) -> DataFrame:
    """Each issue's binding: the one bound to it exactly, else the only one of its key without an issue, else null and why."""
    exact = bindings.where(F.col(issue).isNotNull()).groupBy(issue).agg(F.count(F.lit(1)).alias("_e"), F.min("binding").alias("_exact"))
    legacy = bindings.where(F.col(issue).isNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_l"), F.min("binding").alias("_legacy"))
    rows = issues.join(exact, issue, "left").join(legacy, key, "left")
    state = F.when(F.col("_e") == 1, "exact").when(F.col("_e") > 1, "ambiguous").when(F.col("_l") == 1, "legacy").when(F.col("_l") > 1, "ambiguous").otherwise("absent")
    return rows.select(issue, F.when(state == "exact", F.col("_exact")).when(state == "legacy", F.col("_legacy")).alias("binding"), state.alias("state"))


def inferred_source(dataset: Column, explicit: Column) -> Column:
    """The source that is stated, else the one that the dataset's name speaks of, else unknown."""
    name = F.lower(dataset)
    return F.coalesce(explicit, F.when(name.rlike("security_master|trade_date|daily|market"), "exchange").when(name.rlike("performance|disclosure|balance|profit|cash_?flow|spot"), "filings"), F.lit("unknown"))


def row_priority(status: Column, note: Column) -> Column:
    """0 for what is stuck, 1 for what is under way, 2 for the rest."""
    text = F.lower(F.concat_ws(" ", status, note))
    return F.when(text.rlike("blocked|circuit|terminal|retry|fail|error"), 0).when(text.rlike("pending|running"), 1).otherwise(2)


def rule_violations() -> Column:
    """What is wrong with a rule's shape, over kind, op, threshold, effect, dimension, cap, pool and applies_to."""
    c = F.col
    return violations(
        kind=c("kind").isin("numeric_redline", "boolean_state", "enum_state", "cyclic_protection", "market_liquidity"), operator=(c("kind") != "numeric_redline") | c("op").isin("lt", "lte", "gt", "gte", "eq"), threshold=(c("kind") != "numeric_redline") | finite("threshold").isNotNull(),
        effect=c("effect").isin("pool_prohibition", "dimension_cap", "independent_status"), cap=(c("effect") != "dimension_cap") | (c("cap").between(0, 100) & c("dimension").isin("G", "V", "M", "EQ", "FS", "CA", "T")), pool=(c("effect") != "pool_prohibition") | c("pool").isin("strong", "wait", "both"),
        applies_to=F.size("applies_to") > 0,
    )


def invalidated(changed: DataFrame, cohort: DataFrame, scores: DataFrame) -> DataFrame:
    """(step, id) of what a change of metrics makes stale: the members of the changed metrics' cohorts, their scores, and both pools.

    ``changed`` has metric and cohort; ``cohort`` metric, cohort and member; ``scores`` member, metric and score.
    """
    members = cohort.join(changed.select("metric", "cohort").distinct(), ["metric", "cohort"], "left_semi").select("metric", "member").distinct()
    stale = scores.join(members, ["metric", "member"], "left_semi").select("score").distinct()
    pools = stale.limit(1).select(F.explode(F.array(F.lit("strong"), F.lit("wait"))).alias("id"))
    mark = lambda df, step, column: df.select(F.lit(step).alias("step"), F.col(column).cast("string").alias("id"))
    return mark(members.select("member").distinct(), "member", "member").unionByName(mark(stale, "score", "score")).unionByName(mark(pools, "pool", "id"))


def mapped_facts(items: DataFrame, mapping: DataFrame, key: list[str]) -> DataFrame:
    """Facts and typed issues from item rows (key, field, text) and a mapping (field, metric, required): each item and each required field that a document lacks.

    issue: malformed (no field), unknown_field, duplicate_field, not_numeric or missing_required; null for a fact with its value.
    """
    counted = items.groupBy(*key, "field").agg(F.count(F.lit(1)).alias("_n"), F.min("text").alias("text"))
    known = counted.join(F.broadcast(mapping), "field", "left")
    value = number(F.col("text"))
    issue = F.when(F.coalesce(F.trim("field"), F.lit("")) == "", "malformed").when(F.col("metric").isNull(), "unknown_field").when(F.col("_n") > 1, "duplicate_field").when(value.isNull(), "not_numeric")
    found = known.select(*key, "field", "metric", F.when(issue.isNull(), value).alias("value"), issue.alias("issue"))
    due = F.array(*(F.struct(F.lit(r.field).alias("field"), F.lit(r.metric).alias("metric")) for r in mapping.where("required").collect()))  # the mapping is configuration
    every = items.select(*key).distinct().withColumn("d", F.explode(due)).select(*key, "d.*")
    lacking = every.join(counted.select(*key, "field"), [*key, "field"], "left_anti").select(*key, "field", "metric", F.lit(None).cast("double").alias("value"), F.lit("missing_required").alias("issue"))
    return found.unionByName(lacking)


def context_violations(freeze: Column) -> Column:
    """What a context fact breaks, by its kind, over kind, exchange, days (sorted dates), volume, close, close_date, effective, stale, listing_status, system, industry, valid_from, ids (of flags or events), coverage, no_coverage and estimates."""
    c = F.col
    listed = (F.size("days") > 0) & (c("days") == F.array_sort(F.array_distinct("days")))
    named = (c("ids") == F.array_sort(F.array_distinct("ids"))) & ~F.exists("ids", lambda i: F.trim(i) == "")
    kinds = {
        "trading_calendar": violations(exchange=c("exchange").isin("SH", "SZ", "BJ"), trading_days=listed),
        "market_close": violations(exchange=c("exchange").isin("SH", "SZ", "BJ"), volume=finite("volume") >= 0, close=finite("close") > 0, freshness=F.when(c("effective"), (c("stale") == 0) & (c("close_date") == freeze)).otherwise((c("stale") > 0) & (c("close_date") < freeze))),
        "security_state": violations(listing_status=c("listing_status").isin("listed", "delisting_arrangement", "delisted")),
        "industry_snapshot": violations(system=c("system") == "SW2021", industry=F.trim("industry") != "", effective_date=c("valid_from") <= freeze),
        "regulatory_state": violations(flags=named), "event_calendar": violations(events=named),
        "consensus_snapshot": violations(coverage=F.when(c("coverage") == "covered", ~c("no_coverage") & (c("estimates") > 0)).otherwise((c("coverage") == "no_valid_coverage") & c("no_coverage") & (c("estimates") == 0))),
    }
    own = F.lit(None).cast("array<string>")
    for kind, broken in kinds.items():
        own = F.when(c("kind") == kind, broken).otherwise(own)
    extra = F.when(c("no_coverage") & (c("kind") != "consensus_snapshot"), F.array(F.lit("no_coverage"))).otherwise(F.array().cast("array<string>"))
    return F.when(own.isNull(), F.array(F.lit("kind"))).otherwise(F.concat(own, extra))


#: The classes of evidence in the order in which they are given.
COVERAGE = ("not_applicable_signed", "blocked_schema", "blocked_registry", "blocked_identity", "blocked_integrity", "blocked_temporal", "blocked_ambiguous", "blocked_dependency", "terminal_failed", "retryable_failed", "pending", "missing", "verified_no_coverage", "verified_partial", "verified_complete")


def coverage_class(tests: dict[str, Column]) -> Column:
    """The first class of COVERAGE whose test holds; the last one where none does."""
    out = F.lit(COVERAGE[-1])
    for name in reversed(COVERAGE[:-1]):
        out = F.when(F.coalesce(tests[name], F.lit(False)), name).otherwise(out)
    return out


def pool_of(score: Column, floor: Column, confidence: Column, vetoes: Column, strong: tuple[float, float, float], wait: tuple[float, float, float]) -> Column:
    """strong, wait or none: a bound each on score, weakest dimension and confidence; a veto of a pool or of both keeps out, and nobody is in two pools."""
    reach = lambda b: (score >= b[0]) & (floor >= b[1]) & (confidence >= b[2])
    barred = lambda pool: F.arrays_overlap(vetoes, F.array(F.lit(pool), F.lit("both")))
    return F.when(reach(strong) & ~barred("strong"), "strong").when(reach(wait) & ~barred("wait"), "wait").otherwise("none")


def liquidity_state(veto: Column, price: Column) -> tuple[Column, Column]:
    """(state, effects released) of the market rule: a proven veto with an incomplete price stays pending and releases its pool effect only."""
    half = (veto == "proven") & (price == "incomplete")
    state = F.when(veto.isNull() | half | (veto == "pending") | (price == "incomplete"), "pending_evidence").when(veto == "proven", "matched").otherwise("clear")
    return state, F.when(F.coalesce(half, F.lit(False)), "pool").when(state == "matched", "all").otherwise("none")


def annual_series(facts: DataFrame, key: list[str], year: str, value: str, basis: str, last: int, years: int = 5) -> DataFrame:
    """values of the ``years`` up to ``last`` in order and a state: ready, pending (a year lacks) or domain_conflict (several bases)."""
    rows = facts.where(F.col(year).between(last - years + 1, last) & F.col(value).isNotNull())
    out = rows.groupBy(*key).agg(F.array_sort(F.collect_set(F.struct(F.col(year).alias("y"), F.col(value).alias("v")))).alias("_s"), F.countDistinct(basis).alias("_bases"), F.countDistinct(year).alias("_n"))
    state = F.when(F.col("_bases") > 1, "domain_conflict").when(F.col("_n") < years, "pending").otherwise("ready")
    return out.select(*key, state.alias("state"), F.when(state == "ready", F.transform("_s", lambda x: x["v"])).alias("values"))


def set_differences(stored: DataFrame, derived: DataFrame) -> DataFrame:
    """Rows that one of two multisets has more often, with ``side`` (stored or derived)."""
    return stored.exceptAll(derived).withColumn("side", F.lit("stored")).unionByName(derived.exceptAll(stored).withColumn("side", F.lit("derived")))
