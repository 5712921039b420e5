"""Activity windows over a day spine: inactivity vetoes and the last active value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def on_spine(daily: DataFrame, days: DataFrame, key: list[str], day: str) -> DataFrame:
    """Every key on every day of the spine; days are a calendar, bounded by its years."""
    return daily.select(*key).distinct().crossJoin(F.broadcast(days.select(day))).join(daily, [*key, day], "left")


def activity(df: DataFrame, key: list[str], day: str, state: Column, value: str, short: int = 20, long: int = 250) -> DataFrame:
    """Adds veto, last_value, stale_days and price_state from a day's state (active, inactive or null for unknown).

    veto over ``short`` days: clear if any is active, proven if all are known and inactive, else
    pending. Looking back up to ``long`` days, the first active day gives the last value; an unknown
    day on the way makes it incomplete, none at all is no_value.
    """
    order = Window.partitionBy(*key).orderBy(day)
    near, far = order.rowsBetween(1 - short, 0), order.rowsBetween(1 - long, 0)
    rows = df.withColumn("_s", state).withColumn("_i", F.row_number().over(order))
    active, unknown = F.col("_s") == "active", F.col("_s").isNull()
    seen = F.max(F.when(active, 1).otherwise(0)).over(near)
    idle = F.count_if(F.coalesce(F.col("_s") == "inactive", F.lit(False))).over(near)
    last = F.max(F.when(active, F.struct(F.col("_i"), F.col(value)))).over(far)
    hole = F.max(F.when(unknown, F.col("_i"))).over(far)
    found = F.coalesce(last["_i"], F.lit(0)) > F.coalesce(hole, F.lit(0))
    out = rows.withColumn("veto", F.when(seen == 1, "clear").when(idle == short, "proven").otherwise("pending"))
    out = out.withColumn("price_state", F.when(found, "found").when(hole.isNotNull(), "incomplete").when(F.col("_i") < long, "incomplete").otherwise("no_value"))
    return out.withColumn("last_value", F.when(found, last[value])).withColumn("stale_days", F.when(found, F.col("_i") - last["_i"])).drop("_s", "_i")


def price_or_previous(suspended: Column, close: Column, previous: Column) -> Column:
    """The close, or the previous close of a suspended day."""
    return F.when(suspended, previous).otherwise(close)
