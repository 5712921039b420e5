"""Session calendars: contracts over every day, the next session, and the last sessions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def spine(df: DataFrame, start: Column, end: Column) -> DataFrame:
    """One row for each day between two dates of a one-row table; a day column only."""
    return df.select(F.explode(F.sequence(start, end)).alias("day"))


def contract(rows: DataFrame, day: str, flag: str, start: str, end: str) -> DataFrame:
    """One row: missing, repeated, outside and badly flagged days of a calendar that must hold every day once."""
    spark = rows.sparkSession
    days = spark.sql(f"SELECT explode(sequence(DATE'{start}', DATE'{end}')) AS _day")
    counted = rows.groupBy(F.col(day).alias("_day")).agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.coalesce(F.col(flag).isin("0", "1"), F.lit(False))).alias("bad"))
    both = days.withColumn("_due", F.lit(True)).join(counted, "_day", "full_outer")
    return both.agg(F.count_if(F.expr("n is null")).alias("missing"), F.count_if(F.expr("n > 1")).alias("repeated"), F.count_if(F.expr("_due is null")).alias("outside"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad_flag"))


def next_session(days: DataFrame, day: str, is_open: Column, name: str = "next_session") -> DataFrame:
    """Each calendar day with the first session strictly after it (null at the end).

    A calendar has one row a day, so its one-partition window is bounded by its years.
    """
    after = Window.orderBy(F.col(day).desc()).rowsBetween(Window.unboundedPreceding, -1)
    return days.withColumn(name, F.min(F.when(is_open, F.col(day))).over(after))


def attach_next_close(df: DataFrame, calendar: DataFrame, at: str, hour: int = 15) -> DataFrame:
    """Adds next_close: the closing time of the first session after the day of ``at``."""
    near = calendar.select(F.col("day").alias("_day"), "next_session")
    joined = df.withColumn("_day", F.to_date(at)).join(F.broadcast(near), "_day", "left")
    return joined.withColumn("next_close", F.to_timestamp("next_session") + F.expr(f"INTERVAL {hour} HOURS")).drop("_day", "next_session")


def last_sessions(days: DataFrame, day: str, is_open: Column, n: int) -> DataFrame:
    """The last n open days, newest first."""
    return days.where(is_open).orderBy(F.col(day).desc()).limit(n)


def gaps(expected: DataFrame, present: DataFrame, day: str) -> DataFrame:
    """Days of either side that the other lacks, with kind gap or overflow."""
    a, b = expected.select(day).distinct(), present.select(day).distinct()
    return a.join(b, day, "left_anti").withColumn("kind", F.lit("gap")).unionByName(b.join(a, day, "left_anti").withColumn("kind", F.lit("overflow")))


def ranges(days: DataFrame, key: str, day: str, span: int) -> DataFrame:
    """Cuts each key's sorted days, newest first, into ranges of at most ``span`` calendar days.

    The cut is greedy and so sequential: a fold over each key's own days, a list no longer than the calendar, finds the newest day of each
    range; the days then fall between them.
    """
    step = F.expr(f"aggregate(d, CAST(array() AS array<date>), (heads, x) -> CASE WHEN size(heads) = 0 OR datediff(heads[size(heads) - 1], x) >= {span} THEN array_append(heads, x) ELSE heads END)")
    heads = days.groupBy(key).agg(F.sort_array(F.collect_set(day), asc=False).alias("d")).withColumn("heads", step)
    rows = heads.select(key, "heads", F.explode("d").alias("_day"))
    part = F.size(F.filter("heads", lambda h: h >= F.col("_day"))) - 1
    return rows.select(key, part.cast("long").alias("part"), "_day").groupBy(key, "part").agg(F.min("_day").alias("start"), F.max("_day").alias("end"))
