"""Audit, lineage and status queries over orders, line items, customers and documents."""

from pyspark.sql import functions as F

from pitpanel.functions.shared import dealt
from pitpanel.operators import audit
from pitpanel.sources import snapshots

from .base import query, table


@query("U7", "WITH u AS (SELECT c_custkey FROM customer), d AS (SELECT o_custkey + CASE WHEN o_orderkey % 500 = 0 THEN 1000000 ELSE 0 END AS c_custkey FROM orders), n AS (SELECT c_custkey, count(*) AS n FROM d GROUP BY 1) SELECT coalesce(u.c_custkey, n.c_custkey) AS c_custkey, CASE WHEN n IS NULL THEN 'absent' WHEN u.c_custkey IS NULL THEN 'foreign' ELSE 'repeated' END AS error FROM u FULL JOIN n ON u.c_custkey = n.c_custkey WHERE n.n IS NULL OR u.c_custkey IS NULL OR n.n > 1")
def decision_cover(spark, sf_dir):
    d = table(spark, sf_dir, "orders").select((F.col("o_custkey") + F.when(F.col("o_orderkey") % 500 == 0, 1000000).otherwise(0)).alias("c_custkey"))
    return audit.cover_errors(table(spark, sf_dir, "customer"), d, ["c_custkey"])


@query("J19", "SELECT l_orderkey, l_linenumber, CASE WHEN o_orderkey IS NULL THEN 'absent' ELSE 'differs' END AS error FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderkey % 9 <> 2) ON o_orderkey = l_orderkey WHERE o_orderkey IS NULL OR o_orderstatus IS DISTINCT FROM l_linestatus")
def evidence_errors(spark, sf_dir):
    parents = table(spark, sf_dir, "orders").where("o_orderkey % 9 <> 2").withColumnRenamed("o_orderkey", "l_orderkey")
    children = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_linestatus")
    return audit.evidence_errors(children, parents, ["l_orderkey"], {"l_linestatus": "o_orderstatus"}).select("l_orderkey", "l_linenumber", "error")


def _edges(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("node"), F.expr("c_custkey div 2").alias("needs"))


@query("J18", "WITH RECURSIVE e AS (SELECT c_custkey AS node, c_custkey // 2 AS needs FROM customer), t AS (SELECT c_custkey AS node, 0 AS distance FROM customer WHERE c_acctbal < -850 UNION SELECT e.node, t.distance + 1 FROM e JOIN t ON e.needs = t.node) SELECT node, CAST(min(distance) AS INTEGER) AS distance FROM t GROUP BY 1")
def blocked_closure(spark, sf_dir):
    stopped = table(spark, sf_dir, "customer").where("c_acctbal < -850").select(F.col("c_custkey").alias("node"))
    return audit.blocked_closure(_edges(spark, sf_dir), stopped)


@query("J19", "WITH e AS (SELECT c_custkey AS node, c_custkey // 2 AS needs FROM customer), done AS (SELECT c_custkey AS node FROM customer WHERE c_acctbal >= 2000) SELECT c_custkey AS node FROM customer WHERE c_custkey NOT IN (SELECT node FROM done) AND c_custkey NOT IN (SELECT node FROM e WHERE needs NOT IN (SELECT node FROM done))")
def ready_nodes(spark, sf_dir):
    c = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "node")
    return audit.ready(_edges(spark, sf_dir), c.where("c_acctbal >= 2000"), c)


@query("J22", "WITH m AS (SELECT o_custkey, count(*) AS n, min(o_orderkey) AS k FROM orders GROUP BY 1) SELECT c_custkey, CASE WHEN n = 1 THEN k END AS match, CASE WHEN n IS NULL THEN 'absent' WHEN n > 1 THEN 'ambiguous' ELSE 'unique' END AS match_state FROM customer LEFT JOIN m ON o_custkey = c_custkey")
def unique_matches(spark, sf_dir):
    every = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    return audit.unique_match(table(spark, sf_dir, "customer").select("c_custkey"), every, ["c_custkey"], "o_orderkey")


@query("J10", "WITH sl AS (SELECT c_custkey, p FROM customer CROSS JOIN (SELECT DISTINCT o_orderpriority AS p FROM orders) ), j AS (SELECT o_custkey, o_orderpriority, count(*) AS n, max(o_orderstatus) AS st FROM orders GROUP BY 1, 2) SELECT c_custkey, p, CASE WHEN n IS NULL THEN 'never_asked' WHEN st = 'O' THEN 'open' ELSE 'closed' END AS gap FROM sl LEFT JOIN j ON o_custkey = c_custkey AND o_orderpriority = p")
def slot_gaps(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    jobs = o.groupBy(F.col("o_custkey").alias("c_custkey"), F.col("o_orderpriority").alias("p")).agg(F.max("o_orderstatus").alias("st"))
    kinds = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")  # the configured datasets
    slots = table(spark, sf_dir, "customer").select("c_custkey", F.explode(F.array(*map(F.lit, kinds))).alias("p"))
    return slots.join(jobs, ["c_custkey", "p"], "left").select("c_custkey", "p", F.when(F.col("st").isNull(), "never_asked").when(F.col("st") == "O", "open").otherwise("closed").alias("gap"))


DEPENDS = [("income", ["FURNITURE", "BUILDING"]), ("stock", ["MACHINERY"]), ("all", ["AUTOMOBILE", "BUILDING", "HOUSEHOLD"])]


@query("J13", "WITH sl(slot, deps) AS (VALUES ('income', ['FURNITURE', 'BUILDING']), ('stock', ['MACHINERY']), ('all', ['AUTOMOBILE', 'BUILDING', 'HOUSEHOLD'])), i AS (SELECT c_custkey, CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE c_mktsegment END AS m FROM customer) SELECT c_custkey, slot FROM i JOIN sl ON m IS NULL OR list_contains(deps, m)")
def scoped_issues(spark, sf_dir):
    slots = spark.createDataFrame(DEPENDS, "slot string, deps array<string>")
    issues = table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 6 != 0, F.col("c_mktsegment")).alias("m"))
    return issues.join(F.broadcast(slots), F.col("m").isNull() | F.array_contains("deps", F.col("m"))).select("c_custkey", "slot")


@query("J14", "SELECT a.event_id AS job, b.event_id AS snapshot FROM events a JOIN events b ON a.user_id = b.user_id AND b.ts >= a.ts - INTERVAL 5 MINUTE AND b.ts <= a.ts + INTERVAL 15 SECOND WHERE a.event_type = 'purchase' AND b.event_type = 'view'")
def interval_matches(spark, sf_dir):
    """Snapshots within -5 min and +15 s of a job: hour buckets make the range an equi-join, then the range is checked."""
    e = table(spark, sf_dir, "events")
    hour = F.floor(F.unix_timestamp("ts") / 3600)
    jobs = e.where("event_type = 'purchase'").select(F.col("event_id").alias("job"), "user_id", F.col("ts").alias("t"), F.explode(F.array_distinct(F.array(F.floor((F.unix_timestamp("ts") - 301) / 3600), F.floor((F.unix_timestamp("ts") + 16) / 3600)))).alias("h"))
    seen = e.where("event_type = 'view'").select(F.col("event_id").alias("snapshot"), "user_id", "ts", hour.alias("h"))
    near = F.expr("ts >= t - INTERVAL 5 MINUTES AND ts <= t + INTERVAL 15 SECONDS")
    return jobs.join(seen, ["user_id", "h"]).where(near).select("job", "snapshot")


@query("S19", "WITH p AS (SELECT l_orderkey, l_linenumber, count(*) OVER (PARTITION BY l_orderkey) AS due, CAST(l_quantity AS BIGINT) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) OVER (PARTITION BY l_orderkey) AS BIGINT) AS total, l_returnflag FROM lineitem), k AS (SELECT * FROM p WHERE NOT (l_orderkey % 10 = 1 AND l_linenumber = 2)) SELECT l_orderkey, count(*) AS pages, CAST(sum(n) AS BIGINT) AS have, count(*) = max(due) AND count(DISTINCT l_linenumber) = max(due) AND min(l_linenumber) = 1 AND max(l_linenumber) = max(due) AS complete, sum(n) = max(total) AS adds_up, count(DISTINCT l_returnflag) = 1 AS agrees FROM k GROUP BY 1")
def page_groups(spark, sf_dir):
    from pyspark.sql import Window

    w = Window.partitionBy("l_orderkey")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", F.col("l_quantity").cast("long").alias("n"))
    p = dealt(lines, "l_orderkey").withColumn("due", F.count(F.lit(1)).over(w)).withColumn("total", F.sum("n").over(w))
    return audit.page_groups(p.where("NOT (l_orderkey % 10 = 1 AND l_linenumber = 2)"), "l_orderkey", "l_linenumber", "due", "n", "total", ["l_returnflag"])


@query("A11", "WITH r AS (SELECT sha256(coalesce(CAST(c_custkey AS VARCHAR), chr(0)) || chr(31) || coalesce(c_mktsegment, chr(0)) || chr(31) || coalesce(CAST(c_nationkey AS VARCHAR), chr(0))) AS h FROM customer) SELECT sha256(concat_ws(':', count(*), sum(CAST('0x' || substr(h, 1, 15) AS BIGINT)), sum(CAST('0x' || substr(h, 16, 15) AS BIGINT)), sum(CAST('0x' || substr(h, 31, 15) AS BIGINT)), sum(CAST('0x' || substr(h, 46, 15) AS BIGINT)))) AS fingerprint FROM r")
def table_fingerprint(spark, sf_dir):
    return audit.fingerprint(table(spark, sf_dir, "customer"), ["c_custkey", "c_mktsegment", "c_nationkey"])


@query("S6", "WITH s(o_orderstatus) AS (VALUES ('F'), ('O'), ('P'), ('X')) SELECT s.o_orderstatus, count(o.o_orderkey) AS n FROM s LEFT JOIN orders o USING (o_orderstatus) GROUP BY 1")
def status_counts(spark, sf_dir):
    return audit.state_counts(table(spark, sf_dir, "orders"), "o_orderstatus", ["F", "O", "P", "X"])


@query("S6", "WITH a AS (SELECT count(*) AS n, count(*) FILTER (WHERE quality IS NOT NULL) AS q, count(*) FILTER (WHERE toxic = 1) AS t FROM labels), g AS (SELECT unnest(['rows', 'quality', 'toxic']) AS gate, unnest([n > 0, q = n, t = 0]) AS ok, unnest([n, q, t]) AS evidence FROM a) SELECT gate, CASE WHEN ok THEN 'passed' ELSE 'failed' END AS status, evidence FROM g")
def release_gates(spark, sf_dir):
    a = table(spark, sf_dir, "labels").agg(F.count(F.lit(1)).alias("n"), F.count("quality").alias("q"), F.count_if(F.col("toxic") == 1).alias("t"))
    gate = lambda name, ok, seen: F.struct(F.lit(name).alias("gate"), F.when(ok, "passed").otherwise("failed").alias("status"), seen.alias("evidence"))
    return a.select(F.explode(F.array(gate("rows", F.col("n") > 0, F.col("n")), gate("quality", F.col("q") == F.col("n"), F.col("q")), gate("toxic", F.col("t") == 0, F.col("t")))).alias("g")).select("g.*")


@query("U4", "WITH a AS (SELECT doc_id, lang FROM documents WHERE doc_id % 3 <> 0), b AS (SELECT doc_id, CASE WHEN doc_id % 41 = 0 THEN 'xx' ELSE lang END AS lang FROM documents WHERE doc_id % 3 <> 1), u AS (SELECT * FROM a UNION ALL SELECT * FROM b) SELECT doc_id, count(*) AS n, count(DISTINCT lang) > 1 AS conflict FROM u GROUP BY 1")
def merged_sources(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "lang")
    b = d.where("doc_id % 3 <> 1").withColumn("lang", F.when(F.col("doc_id") % 41 == 0, "xx").otherwise(F.col("lang")))
    return d.where("doc_id % 3 <> 0").unionByName(b).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), (F.countDistinct("lang") > 1).alias("conflict"))


@query("A8 S16", "WITH st AS (SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey % 3 = 0), b AS (SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey % 2 = 0 UNION ALL SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey % 4 = 0) SELECT count(*) FILTER (WHERE is_new) AS inserted, (SELECT count(*) FROM b) - count(*) FILTER (WHERE is_new) AS duplicates FROM (SELECT DISTINCT b.l_orderkey, b.l_linenumber, st.l_orderkey IS NULL AS is_new FROM b LEFT JOIN st USING (l_orderkey, l_linenumber))")
def fact_insert(spark, sf_dir):
    x = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    batch = x.where("l_orderkey % 2 = 0").unionByName(x.where("l_orderkey % 4 = 0"))
    fresh = snapshots.new_rows(batch, x.where("l_orderkey % 3 = 0"), ["l_orderkey", "l_linenumber"])
    return fresh.agg(F.count(F.lit(1)).alias("inserted")).crossJoin(batch.agg(F.count(F.lit(1)).alias("_all"))).select("inserted", (F.col("_all") - F.col("inserted")).alias("duplicates"))


@query("S4", "WITH st AS (SELECT user_id, arg_max(event_type, (ts, event_type)) AS last FROM events WHERE ts < TIMESTAMP '2024-01-20' GROUP BY 1) SELECT event_id, e.user_id, event_type FROM events e LEFT JOIN st USING (user_id) WHERE ts >= TIMESTAMP '2024-01-20' AND event_type IS DISTINCT FROM last")
def changed_snapshots(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    edge = F.to_timestamp(F.lit("2024-01-20 00:00:00"))
    return snapshots.changed_rows(e.where(F.col("ts") >= edge), e.where(F.col("ts") < edge), ["user_id"], "event_type", "ts").select("event_id", "user_id", "event_type")


@query("S1", "SELECT o_orderkey, sha256(o_orderstatus || '|' || o_orderpriority) = CASE WHEN o_orderkey % 20 = 0 THEN 'bad' ELSE sha256(o_orderstatus || '|' || o_orderpriority) END AS verified FROM orders")
def verified_snapshots(spark, sf_dir):
    """Envelopes written as JSON lines and read back with their digests recomputed."""
    from pitpanel.functions.shared import new_path

    payload = F.concat_ws("|", "o_orderstatus", "o_orderpriority")
    rows = table(spark, sf_dir, "orders").select(F.lit("desk").alias("source"), F.lit("orders").alias("dataset"), F.col("o_orderkey").cast("string").alias("request"), F.col("o_orderdate").cast("string").alias("fetched_at"), payload.alias("payload"), F.when(F.col("o_orderkey") % 20 == 0, "bad").otherwise(F.sha2(payload, 256)).alias("digest"))
    path = new_path(spark, "envelopes")
    rows.write.json(path)
    return snapshots.read_envelopes(spark, path).select(F.col("request").cast("long").alias("o_orderkey"), "verified")


@query("A6", "SELECT event_type, count(*) AS n, CASE WHEN event_type IN ('error') THEN 'failure' WHEN event_type LIKE 'p%' THEN 'revenue' ELSE 'other' END AS class, max(ts) AS latest FROM events GROUP BY 1")
def issue_classes(spark, sf_dir):
    kind = F.when(F.col("event_type").isin("error"), "failure").when(F.col("event_type").startswith("p"), "revenue").otherwise("other")
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("latest")).withColumn("class", kind)


@query("P32", "SELECT event_id, CAST(d - INTERVAL (CASE dayofweek(d) WHEN 6 THEN 1 WHEN 0 THEN 2 ELSE 0 END) DAY AS DATE) AS session, CASE WHEN json_extract_string(props, '$.ref') IS NULL THEN 'absent' ELSE 'linked' END AS branch FROM (SELECT *, CAST(ts AS DATE) - CASE WHEN strftime(ts, '%H:%M:%S') >= '15:30:00' THEN 0 ELSE 1 END AS d FROM events)")
def session_dates(spark, sf_dir):
    from pitpanel.functions.exprs import session_date

    return table(spark, sf_dir, "events").select("event_id", session_date("ts").alias("session"), F.when(F.get_json_object("props", "$.ref").isNull(), "absent").otherwise("linked").alias("branch"))


@query("P18", "WITH r(seg, template) AS (VALUES ('BUILDING', 'estate'), ('FURNITURE', 'goods'), ('MACHINERY', 'goods')) SELECT c_custkey, coalesce(template, 'unclassified') AS template, n_name, CASE WHEN n_name IS NULL THEN 'absent' WHEN n_regionkey <> c_nationkey % 5 THEN 'mismatch' END AS reason FROM customer LEFT JOIN r ON seg = c_mktsegment LEFT JOIN nation ON n_nationkey = c_nationkey")
def templates_with_context(spark, sf_dir):
    rules = spark.createDataFrame([("BUILDING", "estate"), ("FURNITURE", "goods"), ("MACHINERY", "goods")], "c_mktsegment string, template string")
    nation = table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    rows = table(spark, sf_dir, "customer").join(F.broadcast(rules), "c_mktsegment", "left").join(nation, "c_nationkey", "left")
    return rows.select("c_custkey", F.coalesce("template", F.lit("unclassified")).alias("template"), "n_name", F.when(F.col("n_name").isNull(), "absent").when(F.col("n_regionkey") != F.col("c_nationkey") % 5, "mismatch").alias("reason"))
