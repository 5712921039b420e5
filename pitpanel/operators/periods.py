"""Period arithmetic on tall facts: single periods out of cumulative ones, opening balances, required histories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def single_quarters(df: DataFrame, family: list[str], year: str, quarter: str, value: str, name: str = "quarter_value") -> DataFrame:
    """Adds the quarter's own value and a reason: a cumulative value less that of the quarter just before in its year.

    The first quarter stands as it is; where the quarter before is absent the value is null.
    """
    w = Window.partitionBy(*family, year).orderBy(quarter)
    before, at = F.lag(value).over(w), F.lag(quarter).over(w)
    own = F.when(F.col(quarter) == 1, F.col(value)).when(at == F.col(quarter) - 1, F.col(value) - before)
    reason = F.when(F.col(value).isNull(), "value_missing").when((F.col(quarter) > 1) & ~F.coalesce(at == F.col(quarter) - 1, F.lit(False)), "previous_missing")
    return df.withColumn(name, own).withColumn("reason", reason)


def with_opening(df: DataFrame, key: list[str], period: str, values: list[str], opening: Column) -> DataFrame:
    """Adds opening_<value>: the same key's values at the period that opens this one (null if absent)."""
    old = df.select(*key, F.col(period).alias("_opening"), *(F.col(v).alias(f"opening_{v}") for v in values))
    return df.withColumn("_opening", opening).join(old, [*key, "_opening"], "left").drop("_opening")


def latest_run(df: DataFrame, key: list[str], year: str, name: str = "run_years") -> DataFrame:
    """How many years in a row, without a gap, end at each key's latest year."""
    years = df.select(*key, year).distinct()
    w = Window.partitionBy(*key).orderBy(F.col(year).desc())
    return years.withColumn("_run", F.col(year) + F.row_number().over(w)).withColumn("_top", F.max(year).over(Window.partitionBy(*key)) + 1).where("_run = _top").groupBy(*key).agg(F.count(F.lit(1)).alias(name))


def missing_periods(df: DataFrame, key: list[str], period: str, expected: Column, name: str = "missing") -> DataFrame:
    """For each key the expected periods it lacks, in order."""
    have = df.groupBy(*key).agg(F.collect_set(period).alias("_have"))
    return have.select(*key, F.array_sort(F.array_except(expected, F.col("_have"))).alias(name))
