"""Queries that write, write again, and read back what a second run must not change."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from pitpanel.functions import exprs
from pitpanel.functions.shared import new_path
from pitpanel.sources import snapshots

from .base import query, table
from .facts import DERIVED_SQL, TALL, _features


@query("S2 S3 F14", """WITH l AS (SELECT o_orderpriority AS dataset, o_custkey AS request, coalesce(o_orderstatus, '') || '|' || CAST(CAST(floor(o_totalprice) AS BIGINT) % 7 AS VARCHAR) AS payload FROM orders)
SELECT dataset, count(*) AS n, count(DISTINCT payload) AS payloads FROM (SELECT DISTINCT dataset, request, payload FROM l) GROUP BY 1""")
def ledger_insert(spark, sf_dir):
    """Snapshots landed in three overlapping batches, unique on source, dataset, request and payload hash."""
    payload = F.concat_ws("|", F.coalesce("o_orderstatus", F.lit("")), (F.floor("o_totalprice") % 7).cast("string"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.lit("desk").alias("source"), F.col("o_orderpriority").alias("dataset"), F.col("o_custkey").alias("request"), payload.alias("payload")).withColumn("payload_hash", snapshots.payload_hash("payload"))
    path = new_path(spark, "ledger")
    for part in ("o_orderkey % 3 <> 0", "o_orderkey % 2 = 0", "o_orderkey >= 0"):
        snapshots.append_new(rows.where(part).drop("o_orderkey"), path, ["source", "dataset", "request", "payload_hash"], ["source", "dataset"])
    return spark.read.parquet(path).groupBy("dataset").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("payload_hash").alias("payloads"))


@query("S14", "SELECT c_nationkey, count(*) AS n, 'written,unchanged,written' AS runs FROM customer WHERE c_acctbal >= 0 GROUP BY 1")
def curated_view(spark, sf_dir):
    """A view put three times: new, the same rows in another order, and other rows."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    path, names = new_path(spark, "view"), ["c_custkey", "c_nationkey"]
    runs = [snapshots.put_view(rows, path, names) for rows in (c, c.repartition(3, "c_acctbal"), c.where("c_acctbal >= 0"))]
    return snapshots.view(spark, path).groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n")).withColumn("runs", F.lit(",".join(runs)))


@query("S15", f"WITH {TALL}, {DERIVED_SQL} SELECT s, y, count(*) AS n_values, count(*) FILTER (WHERE status = 'derived') AS n_derived, count(*) AS stored FROM f GROUP BY 1, 2")
def feature_sink(spark, sf_dir):
    """Feature bundles as header and child rows, written in two runs that overlap."""
    long = _features(spark, sf_dir).withColumn("input_hash", exprs.row_hash("s", "y"))
    path = new_path(spark, "features")
    snapshots.put_features(long.where("s % 2 = 0"), path, ["s", "y"], "input_hash")
    snapshots.put_features(long, path, ["s", "y"], "input_hash")
    headers, values = snapshots.feature_tables(spark, path)
    values = values.groupBy("s", "y").agg(F.count(F.lit(1)).alias("stored"))
    return headers.join(values, ["s", "y"]).select("s", "y", "n_values", "n_derived", "stored")


@query("S17", """WITH q AS (SELECT l_suppkey AS s, CAST(year(l_shipdate) AS INTEGER) AS y, CAST(quarter(l_shipdate) AS INTEGER) AS q, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS v FROM lineitem WHERE l_shipdate < TIMESTAMP '2000-07-01' GROUP BY 1, 2, 3)
SELECT s, y, q, v + CASE WHEN s % 13 = 5 AND q = 3 THEN 1 ELSE 0 END AS stored, CASE WHEN s % 13 = 5 AND q = 3 THEN 'differs' ELSE 'equal' END AS state FROM q""")
def stored_quarters(spark, sf_dir):
    """Stored quarters against their derivation from cumulated facts that are visible."""
    x = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("s"), F.year("l_shipdate").alias("y"), F.quarter("l_shipdate").alias("q"), F.col("l_shipdate").alias("effective_at"), F.col("l_quantity").cast("long").alias("v"))
    cutoff = F.to_timestamp(F.lit("2000-07-01 00:00:00")) - F.expr("INTERVAL 1 MICROSECOND")
    seen = x.where(exprs.visible(cutoff, "effective_at")).groupBy("s", "y", "q").agg(F.sum("v").alias("v"))
    year = Window.partitionBy("s", "y").orderBy("q")
    facts = seen.select("s", "y", "q", F.sum("v").over(year).alias("cumulated"))
    kept = seen.select("s", "y", "q", (F.col("v") + ((F.col("s") % 13 == 5) & (F.col("q") == 3)).cast("long")).alias("stored"))
    derived = facts.select("s", "y", "q", (F.col("cumulated") - F.coalesce(F.lag("cumulated").over(year), F.lit(0))).alias("derived"))
    return kept.join(derived, ["s", "y", "q"], "left").select("s", "y", "q", "stored", F.when(F.col("stored").eqNullSafe(F.col("derived")), "equal").otherwise("differs").alias("state"))


@query("S22", "SELECT c_custkey, count(o_orderkey) AS late, count(o_orderkey) > 0 AS has_issue FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_orderpriority = '5-LOW') ON o_custkey = c_custkey GROUP BY 1")
def quality_issues(spark, sf_dir):
    """An issue log appended to in two runs: exact finds for each customer, and whether there is any."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"), F.when(F.col("o_orderpriority") == "5-LOW", "late").otherwise("open").alias("kind"))
    path = new_path(spark, "issues")
    for rows in (o.where("o_orderkey % 2 = 0"), o):
        snapshots.append_new(rows, path, ["o_orderkey", "kind"], ["kind"])
    found = spark.read.parquet(path).where("kind = 'late'").groupBy("c_custkey").agg(F.count(F.lit(1)).alias("n"))
    rows = table(spark, sf_dir, "customer").join(found, "c_custkey", "left")
    return rows.select("c_custkey", F.coalesce("n", F.lit(0)).cast("long").alias("late"), F.col("n").isNotNull().alias("has_issue"))


@query("K3", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_totalprice DESC, o_orderkey) - 1 AS position FROM orders")
def canonical_order(spark, sf_dir):
    """Facts in one total order at the sink, whatever the partitioning."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return snapshots.write_ordered(o, new_path(spark, "ordered"), [F.col("o_orderdate"), F.col("o_totalprice").desc(), F.col("o_orderkey")]).select("o_orderkey", "position")
