"""Gates that say whether data may be used, with every reason against it, and bounded report tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitpanel.functions import exprs

from .selection import first_rows


def quality_gate(universe: DataFrame, rows: DataFrame, key: str, core: list[str], announced: str, as_of: str, cutoff: str, by: list[str], least: float = 0.95) -> DataFrame:
    """One row for each ``by`` of ``universe``: counts, rates, the failed checks in a fixed order, and status.

    ``announced`` is local text, a date or an instant; ``as_of`` and ``cutoff`` are local instants. A bare date is future from the next day
    on, an instant from the next moment on. status is partial up to the cutoff, then data_ready, or failed if a check fails: an empty
    universe or no rows, completeness or coverage below ``least``, repeated keys in either table, keys outside the universe,
    announcements that are missing, can't be read or lie in the future.
    """
    now, after = F.to_timestamp(F.lit(as_of)), F.lit(as_of > cutoff)
    text = F.trim(F.col(announced).cast("string"))
    blank = text.isNull() | (text == "")
    bare = text.rlike(r"^\d{4}-\d{2}-\d{2}$")
    instant = F.try_to_timestamp(text)
    ahead = F.when(bare, F.to_date(instant) > F.to_date(now)).otherwise(instant > now)
    cells = sum((F.when(exprs.missing(c), 0).otherwise(1) for c in core), F.lit(0))
    sums = {
        "cells": F.sum(cells), "rows": F.count(F.lit(1)), "announcement_missing": F.count_if(blank), "announcement_unparseable": F.count_if(~blank & instant.isNull()), "announcement_future": F.count_if(F.coalesce(ahead, F.lit(False))), "latest": F.max(F.to_date(instant)),
    }
    # Sums by key first, so a key with very many rows is one row where the tables meet.
    own = rows.groupBy(*by, key).agg(*(e.alias(f"_{n}") for n, e in sums.items()))
    due = universe.groupBy(*by, key).agg(F.count(F.lit(1)).alias("_due"))
    both = due.join(own, [*by, key], "full_outer")
    total = lambda n: F.coalesce(F.sum(f"_{n}"), F.lit(0)).alias(n)
    one = both.groupBy(*by).agg(
        F.count("_due").alias("eligible"), F.coalesce(F.sum(F.col("_due") - 1), F.lit(0)).alias("universe_duplicates"), F.count_if(F.col("_due").isNotNull() & F.col("_rows").isNotNull()).alias("disclosed"), F.count_if(F.col("_due").isNull()).alias("outside"),
        F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0)).alias("duplicates"), *(total(n) for n in sums if n != "latest"), F.max("_latest").alias("latest"),
    )
    completeness = F.coalesce(F.try_divide(F.col("cells"), F.col("rows") * len(core)), F.lit(0.0))
    coverage = F.coalesce(F.try_divide(F.col("disclosed"), F.col("eligible")), F.lit(0.0))
    tests = {
        "universe_empty": F.col("eligible") == 0, "performance_empty": F.col("rows") == 0, "completeness": completeness < least, "coverage": coverage < least, "duplicates": F.col("duplicates") > 0, "universe_duplicates": F.col("universe_duplicates") > 0,
        "outside": F.col("outside") > 0, "announcement_missing": F.col("announcement_missing") > 0, "announcement_unparseable": F.col("announcement_unparseable") > 0, "announcement_future": F.col("announcement_future") > 0,
    }
    failed = F.array_compact(F.array(*(F.when(bad, F.lit(n)) for n, bad in tests.items())))
    out = one.withColumns({"completeness": completeness, "coverage": coverage, "failed": failed})
    return out.withColumn("status", F.when(~after, "partial").when(F.size("failed") == 0, "data_ready").otherwise("failed")).drop("cells")


def final_gate(quality: DataFrame, market: DataFrame) -> DataFrame:
    """``quality`` (status and failed checks) with the errors of ``market``, one row: reasons against making the run final, in order, and final_ready.

    A partial gate has not passed its cutoff; a failed one gives each of its checks as a reason; the market's errors follow.
    """
    both = quality.crossJoin(market.select(F.col("errors").alias("_errors")))
    cut = F.when(F.col("status") == "partial", F.array(F.lit("cutoff_not_passed"))).otherwise(F.array().cast("array<string>"))
    checks = F.transform("failed", lambda f: F.concat(F.lit("quality_"), f))
    reasons = F.concat(cut, checks, F.col("_errors"))
    return both.withColumn("reasons", reasons).withColumn("final_ready", F.size("reasons") == 0).drop("_errors")


def history_blockers(annuals: Column, quarters: Column, as_of: Column, cyclic: Column) -> Column:
    """Sorted blockers of a history as of a day; empty where it is mature.

    ``annuals`` (dates as text) must hold the last 4 fiscal year ends, 5 where ``cyclic``, and ``quarters`` (like 2000Q3) must be exactly the last 8
    that have ended. Input that is no history at all (ends that are no year ends, unsorted, repeated or future ones, malformed
    quarters, nulls) is invalid and nothing else is said of it.
    """
    year, day = F.year(as_of), F.date_format(as_of, "MM-dd")
    latest = F.when(day == "12-31", year).otherwise(year - 1)
    need = F.transform(F.sequence(latest - F.when(cyclic, 4).otherwise(3), latest), lambda y: F.concat(F.lpad(y.cast("string"), 4, "0"), F.lit("-12-31")))
    ended = sum(((F.lit(end) <= day).cast("int") for end in ("03-31", "06-30", "09-30", "12-31")), F.lit(0))
    last = year * 4 + ended - 1
    due = F.transform(F.sequence(last - 7, last), lambda i: F.concat(F.lpad(F.floor(i / 4).cast("string"), 4, "0"), F.lit("Q"), (i % 4 + 1).cast("string")))
    plain = F.forall(annuals, lambda a: F.coalesce(a.rlike(r"^\d{4}-12-31$"), F.lit(False)))
    ordered = (annuals == F.array_sort(F.array_distinct(annuals))) & ~F.exists(annuals, lambda a: a > F.date_format(as_of, "yyyy-MM-dd"))
    named = F.forall(quarters, lambda q: F.coalesce(q.rlike(r"^\d{4}Q[1-4]$"), F.lit(False)))
    valid = F.coalesce(plain & ordered & named, F.lit(False))
    short = F.array_compact(F.array(F.when(F.size(F.array_except(need, annuals)) > 0, F.lit("history_annual_window_incomplete")), F.when(quarters != due, F.lit("history_quarter_window_incomplete"))))
    found = F.when(valid, short).otherwise(F.array(F.lit("history_invalid_input")))
    return F.when(F.size(found) > 0, F.array_sort(F.array_append(found, F.lit("pending_evidence/history_not_mature")))).otherwise(F.array().cast("array<string>"))


def bounded_reports(df: DataFrame, reports: dict[str, tuple[str, ...]], sums: dict[str, Column], order: list[Column], most: int = 25) -> DataFrame:
    """(report, the reports' columns, sums, position, reviewed, shown, truncated): the first ``most`` groups of each report.

    All reports come from one scan, as grouping sets; a report's groups are put in ``order`` (then by its columns), and a report says how many
    groups were reviewed, how many are shown, and whether that cuts some off. Columns that a report doesn't group by are null.
    """
    names = list(dict.fromkeys(c for cs in reports.values() for c in cs))
    texts = df.select("*", *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"_t_{c}") for c in names))
    sets = [[F.col(f"_t_{c}") for c in cs] for cs in reports.values()]
    bits = {r: sum((0 if c in cs else 1) << (len(names) - 1 - i) for i, c in enumerate(names)) for r, cs in reports.items()}
    grouped = texts.groupingSets(sets, *(F.col(f"_t_{c}") for c in names)).agg(F.grouping_id().alias("_g"), *(e.alias(n) for n, e in sums.items()))
    report = F.coalesce(*(F.when(F.col("_g") == b, F.lit(r)) for r, b in bits.items()))
    rows = grouped.select(report.alias("report"), *(F.col(f"_t_{c}").alias(c) for c in names), *sums)
    sizes = rows.groupBy("report").agg(F.count(F.lit(1)).alias("reviewed"))
    shown = first_rows(rows, ["report"], [*order, *(F.col(c).asc_nulls_last() for c in names)], most, "position")
    own = F.count(F.lit(1)).over(Window.partitionBy("report"))  # at most ``most`` rows each
    return shown.withColumn("shown", own).join(F.broadcast(sizes), "report").withColumn("truncated", F.col("reviewed") > F.col("shown"))
