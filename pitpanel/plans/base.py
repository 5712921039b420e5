"""Registration of queries with their SQL, and the panels that they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
COVERS: dict[str, str] = {}


def query(covers: str, sql: str | None = None):
    """Registers a function (spark, sf_dir) under its name, with the operators it covers and its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        COVERS[f.__name__] = covers
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(x) -> F.Column:
    return F.col(x).cast("decimal(18,2)") if isinstance(x, str) else x.cast("decimal(18,2)")


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each customer: balance, and the count and sum of orders (null without any)."""
    spent = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.sum(money("o_totalprice")).cast("double").alias("spend"), F.count(F.lit(1)).alias("orders"))
    return table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal").join(spent, "c_custkey", "left")


PANEL = "panel AS (SELECT c_custkey, c_nationkey, c_mktsegment, c_acctbal, spend, orders FROM customer LEFT JOIN (SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS spend, count(*) AS orders FROM orders GROUP BY 1) ON o_custkey = c_custkey)"


def supplier_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(s, y, revenue, discounts, tax, quantity) of line items by supplier and ship year."""
    x = table(spark, sf_dir, "lineitem")
    d = lambda e: F.sum(e.cast("decimal(18,4)")).cast("double")
    return x.groupBy(F.col("l_suppkey").alias("s"), F.year("l_shipdate").alias("y")).agg(d(F.col("l_extendedprice")).alias("revenue"), d(F.col("l_extendedprice") * F.col("l_discount")).alias("discounts"), d(F.col("l_extendedprice") * F.col("l_tax")).alias("tax"), d(F.col("l_quantity")).alias("quantity"))


YEARS = """years AS (SELECT l_suppkey AS s, CAST(year(l_shipdate) AS INTEGER) AS y,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,4))) AS DOUBLE) AS revenue, CAST(sum(CAST(l_extendedprice * l_discount AS DECIMAL(18,4))) AS DOUBLE) AS discounts,
  CAST(sum(CAST(l_extendedprice * l_tax AS DECIMAL(18,4))) AS DOUBLE) AS tax, CAST(sum(CAST(l_quantity AS DECIMAL(18,4))) AS DOUBLE) AS quantity FROM lineitem GROUP BY 1, 2)"""


def daily_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, day, value, bad): each user's day with its last value, and whether an event had no positive value."""
    e = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    return e.groupBy("user_id", "day").agg(F.max_by("value", F.struct("ts", "event_id")).alias("value"), F.count(F.lit(1)).alias("n"), F.max((F.pmod("event_id", F.lit(17)) == 0)).alias("bad"))


DAILY = "daily AS (SELECT user_id, CAST(ts AS DATE) AS day, arg_max(value, (ts, event_id)) AS value, count(*) AS n, bool_or(event_id % 17 = 0) AS bad FROM events GROUP BY 1, 2)"
