"""Streaming queries: events and line items read as streams, run to the end, twice where a rerun must add nothing."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from pitpanel.functions.shared import ROWS, dealt, new_path
from pitpanel.sources.commits import Items
from pitpanel.streaming import increments, timely

from .base import query, table


def _landed(spark, df, rows=None, parts=3):
    """The table as landed files of at most about ROWS rows, and how many of them a batch takes so that there are ``parts`` batches."""
    path = new_path(spark, "landed")
    files = max(1, -(-(df.count() if rows is None else rows) // (parts * ROWS)))
    df.repartition(parts * files).write.parquet(path)
    return path, files


@query("T1", "SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS day FROM events")
def stream_unique_events(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("user_id", "event_type", F.to_date("ts").alias("day"))
    (path, files), sink, mark = _landed(spark, rows), new_path(spark, "sink"), new_path(spark, "offsets")
    for _ in range(2):  # the second run finds nothing new
        increments.unique_append(increments.stream(spark, path, files=files), sink, mark, ["user_id", "event_type", "day"])
    return spark.read.parquet(sink).select("user_id", "event_type", "day")


@query("T1", "SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS day FROM events")
def stream_unique_within(spark, sf_dir):
    """The same with bounded state: files land in order of time, and a key is remembered for two days behind the newest event, longer than any repeats lie apart."""
    rows = table(spark, sf_dir, "events").select("user_id", "event_type", F.to_date("ts").alias("day"), F.col("ts").cast("timestamp").alias("ts"))
    path, sink, mark = new_path(spark, "landed"), new_path(spark, "sink"), new_path(spark, "offsets")
    for low, high in (("2000-01-01", "2024-01-12"), ("2024-01-12", "2024-01-22"), ("2024-01-22", "2100-01-01")):
        rows.where((F.col("day") >= low) & (F.col("day") < high)).coalesce(2).write.mode("append").parquet(path)
        increments.unique_append(increments.stream(spark, path, files=4), sink, mark, ["user_id", "event_type", "day"], "ts", "2 days")
    return spark.read.parquet(sink).select("user_id", "event_type", "day")


@query("T2", "SELECT CASE WHEN ts <= TIMESTAMP '2024-01-16 00:00:00' THEN 'frozen' ELSE 'observed' END AS view, count(*) AS n, max(ts) AS latest FROM events GROUP BY 1")
def stream_cutoff_views(spark, sf_dir):
    (path, files), sink = _landed(spark, table(spark, sf_dir, "events").select("event_id", "ts")), new_path(spark, "sink")
    increments.cutoff_split(increments.stream(spark, path, files=files), sink, new_path(spark, "offsets"), "ts", "2024-01-16 00:00:00")
    return spark.read.parquet(sink).groupBy("view").agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("latest"))


@query("T1 W6", "SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, max(ts) AS ts FROM events GROUP BY 1")
def stream_latest_upsert(spark, sf_dir):
    (path, files), sink = _landed(spark, table(spark, sf_dir, "events").select("user_id", "event_id", "ts")), new_path(spark, "sink")
    increments.latest_upsert(increments.stream(spark, path, files=files), sink, new_path(spark, "offsets"), ["user_id"], "ts", "event_id")
    return increments.current(spark, sink, ["user_id"]).select("user_id", "event_id", "ts")


@query("T8", "SELECT event_type, count(*) AS n, max(ts) AS latest FROM events GROUP BY 1")
def stream_counters(spark, sf_dir):
    (path, files), sink = _landed(spark, table(spark, sf_dir, "events").select("event_type", "ts")), new_path(spark, "sink")
    increments.running_counts(increments.stream(spark, path, files=files), new_path(spark, "offsets"), sink, ["event_type"], "ts")
    return spark.read.parquet(increments.last_folder(spark, sink, "state"))


@query("T7", """WITH p AS (SELECT l_orderkey, l_linenumber, 1 + l_linenumber % 2 AS generation, count(*) OVER (PARTITION BY l_orderkey, l_linenumber % 2) AS due FROM lineitem), k AS (SELECT * FROM p WHERE NOT (l_orderkey % 10 = 1 AND l_linenumber = 3)),
g AS (SELECT l_orderkey, generation, count(*) AS pages, max(due) AS due FROM k GROUP BY 1, 2) SELECT l_orderkey, max(generation) AS generation, arg_max(pages, generation) AS pages, arg_max(due, generation) AS due, arg_max(pages = due, generation) AS complete FROM g GROUP BY 1""")
def stream_page_groups(spark, sf_dir):
    """Pages of two generations of each order, one of them lost for some; the newest generation counts."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (1 + F.col("l_linenumber") % 2).alias("generation"))
    rows = dealt(lines, "l_orderkey", rows=(n := lines.count())).withColumn("due", F.count(F.lit(1)).over(Window.partitionBy("l_orderkey", "generation"))).where("NOT (l_orderkey % 10 = 1 AND l_linenumber = 3)")
    (path, files), sink = _landed(spark, rows, n), new_path(spark, "sink")
    increments.page_counts(increments.stream(spark, path, files=files), new_path(spark, "offsets"), sink, "l_orderkey", "generation", "due")
    return increments.newest_generations(spark, sink, "l_orderkey", "generation").select("l_orderkey", "generation", "pages", "due", "complete")


CLOSE = "CAST(ts AS DATE) + to_days(CASE dayofweek(ts) WHEN 5 THEN 3 WHEN 6 THEN 2 ELSE 1 END) + INTERVAL 15 HOUR"


@query("T5 P24 F13", f"WITH f AS (SELECT event_id, user_id, ts + to_hours(CAST(event_id % 6 AS INTEGER)) AS arrived, {CLOSE} AS effective FROM events) SELECT event_id, user_id, effective FROM f WHERE effective <= (SELECT max(arrived) - INTERVAL 6 HOUR FROM f)")
def stream_usable_facts(spark, sf_dir):
    """Events as facts that count from the close of the next weekday and arrive up to five hours late, in two runs with a restart between them."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"))
    step = F.when(F.dayofweek("ts") == 6, 3).when(F.dayofweek("ts") == 7, 2).otherwise(1)
    close = F.date_add(F.to_date("ts"), step).cast("timestamp") + F.expr("INTERVAL 15 HOURS")
    facts = e.select("event_id", "user_id", (F.col("ts") + F.make_dt_interval(F.lit(0), (F.col("event_id") % 6).cast("int"))).alias("arrived"), close.alias("effective"))
    path, sink, mark = new_path(spark, "landed"), new_path(spark, "sink"), new_path(spark, "offsets")
    middle = facts.agg(F.percentile_approx("arrived", 0.5)).first()[0]
    for part in (facts.where(F.col("arrived") <= F.lit(middle)), facts.where(F.col("arrived") > F.lit(middle))):
        part.coalesce(2).write.mode("append").parquet(path)
        timely.usable_facts(increments.stream(spark, path, files=4), sink, mark, ["event_id"], "arrived", "effective", "6 hours")
    return spark.read.parquet(sink).select("event_id", "user_id", "effective")


@query("T3 U1 J2", """WITH b AS (SELECT user_id, event_id, ts, CASE WHEN ts <= TIMESTAMP '2024-01-10 00:00:00' THEN 0 WHEN ts <= TIMESTAMP '2024-01-20 00:00:00' THEN 1 ELSE 2 END AS part FROM events),
o AS (SELECT user_id, part, arg_max(event_id, (ts, event_id)) AS event_id, max(ts) AS ts FROM b GROUP BY 1, 2),
k AS (SELECT *, ts <= TIMESTAMP '2024-01-16 00:00:00' AS at_cutoff FROM o)
SELECT user_id, max_by(event_id, part) FILTER (WHERE at_cutoff) AS event_id, max(ts) FILTER (WHERE at_cutoff) AS ts, max(part) > max(part) FILTER (WHERE at_cutoff) AS carried FROM k GROUP BY 1 HAVING count(*) FILTER (WHERE at_cutoff) > 0""")
def stream_late_revisions(spark, sf_dir):
    """A latest-only source read three times; a user whose newest event lies after the cutoff keeps the one that the view held."""
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "ts")
    path, sink, mark = new_path(spark, "landed"), new_path(spark, "sink"), new_path(spark, "offsets")
    bounds = ["2024-01-10 00:00:00", "2024-01-20 00:00:00"]
    first, second = (F.to_timestamp(F.lit(b)) for b in bounds)
    for part in (F.col("ts") <= first, (F.col("ts") > first) & (F.col("ts") <= second), F.col("ts") > second):
        e.where(part).coalesce(1).write.mode("append").parquet(path)
        timely.frozen_view(increments.stream(spark, path), sink, mark, ["user_id"], "ts", "event_id", "2024-01-16 00:00:00")
    return timely.frozen(spark, sink).select("user_id", "event_id", "ts", "carried")


@query("S23", """SELECT c_mktsegment AS run, c_custkey, CASE WHEN c_mktsegment <> 'BUILDING' AND c_custkey % 3 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS score, CASE WHEN c_mktsegment = 'BUILDING' THEN 'final' ELSE 'provisional' END AS state, 2 AS refused FROM customer""")
def guarded_items(spark, sf_dir):
    """Score items by run: a batch for a final run is refused whole, as is one that names an unknown run; others replace their rows."""
    rows = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("run"), "c_custkey", F.col("c_acctbal").alias("score"))
    items = Items(spark, new_path(spark, "items"), "run", "c_custkey", "run string, c_custkey long, score double")
    for r in rows.select("run").distinct().orderBy("run").limit(100).collect():
        items.set_run(r.run, "provisional")
    items.upsert(rows)
    items.set_run("BUILDING", "final")
    more = rows.where("c_custkey % 3 = 0").withColumn("score", F.col("score") + 1)
    refused = 0
    for batch in (more, more.where("run <> 'BUILDING'").unionByName(more.limit(1).withColumn("run", F.lit("none such")))):
        try:
            items.upsert(batch)
        except ValueError:
            refused += 1
    items.upsert(more.where("run <> 'BUILDING'"))
    states = items.log.read()["runs"]
    state = F.coalesce(*(F.when(F.col("run") == r, F.lit(s)) for r, s in states.items()))
    return items.rows().select("run", "c_custkey", "score", state.alias("state"), F.lit(refused).alias("refused"))
