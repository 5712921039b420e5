"""Version, calendar, period and activity queries over events, orders and line items."""

from pyspark.sql import functions as F

from pitpanel.functions import exprs
from pitpanel.operators import calendars, market, periods, versions

from .base import DAILY, YEARS, daily_activity, query, supplier_years, table

MID = "TIMESTAMP '2024-01-16 00:00:00'"


def _mid():
    return F.to_timestamp(F.lit("2024-01-16 00:00:00"))


def _versions(spark, sf_dir):
    """Events as revisable facts: announced at a 6-hour mark, updated for some, fetched unless the id ends in 00."""
    e = table(spark, sf_dir, "events")
    mark = F.timestamp_seconds(F.floor(F.unix_timestamp("ts") / 21600) * 21600)
    return e.select("event_id", "user_id", "event_type", mark.alias("announced"), F.when(F.col("event_id") % 3 == 0, F.date_trunc("hour", "ts")).alias("updated"), F.when(F.col("event_id") % 100 != 0, F.date_trunc("hour", "ts")).alias("fetched"), F.round("value", 0).alias("v"))


VERSIONS = "ver AS (SELECT event_id, user_id, event_type, make_timestamp(CAST(floor(epoch(ts) / 21600) AS BIGINT) * 21600 * 1000000) AS announced, CASE WHEN event_id % 3 = 0 THEN date_trunc('hour', ts) END AS updated, CASE WHEN event_id % 100 <> 0 THEN date_trunc('hour', ts) END AS fetched, round(value, 0) AS v FROM events)"


@query("W6", "SELECT user_id, event_type, event_id, ts, round(value, 6) AS value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC NULLS LAST, event_id) AS n FROM events) WHERE n = 1")
def latest_event_version(spark, sf_dir):
    best = versions.newest(table(spark, sf_dir, "events"), ["user_id", "event_type"], [F.col("ts").desc_nulls_last(), F.col("event_id").asc()])
    return best.select("user_id", "event_type", "event_id", "ts", F.round("value", 6).alias("value"))


@query("W7 A8 P23", f"""WITH {VERSIONS}, seen AS (SELECT * FROM ver WHERE announced <= {MID} AND (updated IS NULL OR updated <= {MID})),
r AS (SELECT *, rank() OVER (PARTITION BY user_id, event_type ORDER BY announced DESC, updated DESC NULLS LAST, fetched DESC NULLS LAST) AS k, bool_or(fetched IS NULL) OVER (PARTITION BY user_id, event_type) AS blocked FROM seen),
g AS (SELECT user_id, event_type, bool_or(blocked) AS blocked, max(event_id) FILTER (WHERE k = 1) AS event_id, min(v) FILTER (WHERE k = 1) AS lo, max(v) FILTER (WHERE k = 1) AS hi FROM r GROUP BY 1, 2)
SELECT user_id, event_type, CASE WHEN blocked THEN 'unknown_fetch' WHEN lo IS DISTINCT FROM hi THEN 'conflict' ELSE 'chosen' END AS state, CASE WHEN NOT blocked AND lo IS NOT DISTINCT FROM hi THEN event_id END AS event_id, CASE WHEN NOT blocked AND lo IS NOT DISTINCT FROM hi THEN lo END AS v FROM g""")
def visible_event_versions(spark, sf_dir):
    return versions.visible_versions(_versions(spark, sf_dir), ["user_id", "event_type"], "announced", "updated", "fetched", ["v"], _mid(), "event_id").select("user_id", "event_type", "state", "event_id", "v")


@query("A8", f"""WITH {VERSIONS}, r AS (SELECT *, rank() OVER (PARTITION BY user_id ORDER BY announced DESC, updated DESC NULLS LAST) AS k, count(DISTINCT event_type) OVER (PARTITION BY user_id) > 4 AS mixed FROM ver WHERE announced <= {MID}),
t AS (SELECT *, count(*) OVER (PARTITION BY user_id) AS ties FROM r WHERE k = 1)
SELECT DISTINCT user_id, announced, CASE WHEN mixed THEN 'mixed_kind' WHEN ties > 1 THEN 'tie' ELSE 'chosen' END AS state FROM t""")
def unique_winner_versions(spark, sf_dir):
    rows = _versions(spark, sf_dir).where(F.col("announced") <= _mid())
    kinds = rows.groupBy("user_id").agg((F.countDistinct("event_type") > 4).alias("many"))
    # The kind triple of a user with many event types differs from row to row, else it is one.
    marked = rows.join(kinds, "user_id").withColumn("kind", F.when(F.col("many"), F.col("event_type")).otherwise("one"))
    return versions.unique_winner(marked, ["user_id"], ["kind"], [F.col("announced").desc(), F.col("updated").desc_nulls_last()]).select("user_id", "announced", "state")


@query("J4", f"SELECT user_id, event_id, value > 50 AS valid FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events WHERE ts <= {MID}) WHERE n = 1")
def asof_newest_or_invalid(spark, sf_dir):
    return versions.as_of_newest(table(spark, sf_dir, "events"), ["user_id"], "ts", _mid(), F.col("value") > 50, "event_id").select("user_id", "event_id", "valid")


@query("J4", "SELECT c_custkey AS user_id, event_id, event_id IS NOT NULL AS present FROM (SELECT DISTINCT c_custkey FROM customer) LEFT JOIN (SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id FROM events GROUP BY 1) ON user_id = c_custkey")
def requested_versions(spark, sf_dir):
    wanted = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))
    found = versions.newest(table(spark, sf_dir, "events"), ["user_id"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_id")
    return versions.requested(wanted, found, ["user_id"])


@query("K1", "SELECT l_orderkey, l_linenumber FROM lineitem x WHERE NOT EXISTS (SELECT 1 FROM lineitem y WHERE y.l_orderkey = x.l_orderkey AND y.l_linenumber <> x.l_linenumber AND y.l_quantity >= x.l_quantity AND y.l_discount >= x.l_discount AND (y.l_quantity > x.l_quantity OR y.l_discount > x.l_discount))")
def undominated_lines(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    return versions.undominated(rows, ["l_orderkey"], "l_linenumber", ["l_quantity", "l_discount"]).select("l_orderkey", "l_linenumber")


@query("W10", """WITH v AS (SELECT o_custkey AS k, o_orderkey % 3 AS gen, o_orderkey % 2 AS content, CAST(o_orderdate AS DATE) AS pub, CASE WHEN o_custkey % 4 <> 1 OR o_orderkey % 50 = 7 THEN CAST(o_orderdate AS DATE) + CASE WHEN o_custkey % 3 = 0 THEN CAST(o_orderkey % 400 AS INTEGER) ELSE 5 END END AS upd, CASE WHEN o_custkey % 7 = 2 AND o_orderkey % 5 = 0 THEN 'date' ELSE 'time' END AS pr FROM orders),
t AS (SELECT *, coalesce(upd, pub) AS at_ FROM v), d AS (SELECT DISTINCT * FROM t), p AS (SELECT a.k, bool_or((a.pr <> b.pr OR (a.upd IS NULL) <> (b.upd IS NULL)) AND (a.gen, a.content) <> (b.gen, b.content)) AS incomparable, bool_or(a.pr = b.pr AND (a.upd IS NULL) = (b.upd IS NULL) AND a.at_ > b.at_ AND a.pub < b.pub) AS crossed FROM d a JOIN d b USING (k) GROUP BY 1),
m AS (SELECT k, max(at_) AS top FROM d GROUP BY 1), l AS (SELECT d.k, count(DISTINCT (gen, content)) AS n, min(struct_pack(gen := gen, content := content, pub := pub, upd := upd)) AS b FROM d JOIN m ON m.k = d.k AND at_ = top GROUP BY 1),
s AS (SELECT p.k, CASE WHEN incomparable THEN 'incomparable' WHEN crossed THEN 'contradictory' WHEN n > 1 THEN 'different_content' ELSE 'chosen' END AS state, b FROM p JOIN l USING (k))
SELECT k AS o_custkey, state, CASE WHEN state = 'chosen' THEN b.pub END AS published, CASE WHEN state = 'chosen' THEN b.upd END AS updated, CASE WHEN state = 'chosen' THEN b.gen END AS generation, CASE WHEN state = 'chosen' THEN b.content END AS content FROM s""")
def leading_order_versions(spark, sf_dir):
    """Orders as versions of their customer: which one leads where the order is only partial, or what forbids a choice; the SQL looks at all pairs."""
    k, c, day = F.col("o_orderkey"), F.col("o_custkey"), F.to_date("o_orderdate")
    updated = F.when((c % 4 != 1) | (k % 50 == 7), F.date_add(day, F.when(c % 3 == 0, (k % 400).cast("int")).otherwise(5)))
    rows = table(spark, sf_dir, "orders").select("o_custkey", day.alias("published"), updated.alias("updated"), F.when((c % 7 == 2) & (k % 5 == 0), "date").otherwise("time").alias("precision"), (k % 3).alias("generation"), (k % 2).alias("content"))
    return versions.leading_versions(rows, ["o_custkey"], "published", "updated", "precision", "generation", "content")


@query("T6 U3", """WITH o AS (SELECT c_custkey, round(c_acctbal, 0) AS h FROM customer WHERE c_custkey % 7 <> 0), n AS (SELECT c_custkey, CASE WHEN c_custkey % 11 = 0 THEN 0 ELSE round(c_acctbal, 0) END AS h FROM customer WHERE c_custkey % 13 <> 0)
SELECT coalesce(o.c_custkey, n.c_custkey) AS c_custkey, CASE WHEN o.c_custkey IS NULL THEN 'added' WHEN n.c_custkey IS NULL THEN 'removed' ELSE 'changed' END AS change FROM o FULL JOIN n ON o.c_custkey = n.c_custkey WHERE o.c_custkey IS NULL OR n.c_custkey IS NULL OR o.h IS DISTINCT FROM n.h""")
def snapshot_differences(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", F.round("c_acctbal", 0).alias("h"))
    old = c.where("c_custkey % 7 <> 0")
    new = c.where("c_custkey % 13 <> 0").withColumn("h", F.when(F.col("c_custkey") % 11 == 0, 0.0).otherwise(F.col("h")))
    return versions.differences(old, new, ["c_custkey"], "h")


@query("J2 U1 T2", f"""WITH l AS (SELECT user_id, max(ts) AS ts, arg_max(event_id, (ts, event_id)) AS event_id FROM events GROUP BY 1),
cur AS (SELECT user_id, event_id FROM l WHERE ts <= {MID}), prev AS (SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id FROM events WHERE ts <= {MID} GROUP BY 1)
SELECT user_id, event_id, false AS carried FROM cur UNION ALL SELECT user_id, event_id, true FROM prev WHERE user_id IN (SELECT user_id FROM l) AND user_id NOT IN (SELECT user_id FROM cur)""")
def carried_forward(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    order = [F.desc("ts"), F.desc("event_id")]
    latest = versions.newest(e, ["user_id"], order)
    previous = versions.newest(e.where(F.col("ts") <= _mid()), ["user_id"], order).select("user_id", "event_id")
    return versions.carried_forward(latest.where(F.col("ts") <= _mid()).select("user_id", "event_id"), latest, previous, ["user_id"])


def _calendar(spark, sf_dir):
    """The natural days of the orders, weekdays open."""
    ends = table(spark, sf_dir, "orders").agg(F.to_date(F.min("o_orderdate")).alias("a"), F.to_date(F.max("o_orderdate")).alias("b"))
    return calendars.spine(ends, F.col("a"), F.col("b")).withColumn("open", ~F.dayofweek("day").isin(1, 7))


CALENDAR = "cal AS (SELECT CAST(d AS DATE) AS day, dayofweek(d) NOT IN (0, 6) AS open FROM (SELECT unnest(generate_series(CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE), INTERVAL 1 DAY)) AS d FROM orders))"


@query("S7 J15", """WITH rows AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events), due AS (SELECT CAST(unnest(generate_series(DATE '2024-01-02', DATE '2024-02-03', INTERVAL 1 DAY)) AS DATE) AS day)
SELECT count(*) FILTER (WHERE r.day IS NULL) AS missing, CAST(0 AS BIGINT) AS repeated, count(*) FILTER (WHERE d.day IS NULL) AS outside, CAST(0 AS BIGINT) AS bad_flag FROM due d FULL JOIN rows r ON d.day = r.day""")
def calendar_contract(spark, sf_dir):
    days = table(spark, sf_dir, "events").select(F.to_date("ts").alias("day")).distinct().withColumn("flag", F.lit("1"))
    return calendars.contract(days, "day", "flag", "2024-01-02", "2024-02-03")


@query("J3 P24 T5", f"""WITH {CALENDAR}, nx AS (SELECT o_orderkey, o_orderdate, o_orderpriority, (SELECT min(day) FROM cal WHERE open AND day > CAST(o_orderdate AS DATE)) AS s FROM orders)
SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o_orderdate ELSE CAST(s AS TIMESTAMP) + INTERVAL 15 HOUR END AS effective_at FROM nx""".replace("(SELECT min(day) FROM cal WHERE open AND day > CAST(o_orderdate AS DATE)) AS s FROM orders", "c.day AS s FROM orders ASOF LEFT JOIN (SELECT day FROM cal WHERE open) c ON CAST(o_orderdate AS DATE) < c.day"))
def effective_order_times(spark, sf_dir):
    cal = calendars.next_session(_calendar(spark, sf_dir), "day", F.col("open"))
    rows = calendars.attach_next_close(table(spark, sf_dir, "orders"), cal, "o_orderdate")
    precision = F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "timestamp").otherwise("date_only")
    return rows.select("o_orderkey", exprs.effective_at(precision, "o_orderdate", "next_close").alias("effective_at"))


@query("W13", f"WITH {CALENDAR} SELECT day FROM cal WHERE open ORDER BY day DESC LIMIT 250")
def last_sessions(spark, sf_dir):
    return calendars.last_sessions(_calendar(spark, sf_dir), "day", F.col("open"), 250).select("day")


@query("J15", "WITH w AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders), s AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS day FROM lineitem) SELECT day, 'gap' AS kind FROM w WHERE day NOT IN (SELECT day FROM s) UNION ALL SELECT day, 'overflow' FROM s WHERE day NOT IN (SELECT day FROM w)")
def calendar_gaps(spark, sf_dir):
    return calendars.gaps(table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day")), table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("day")), "day")


@query("F20", """WITH RECURSIVE d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events), h AS (SELECT user_id, max(day) AS hi, 0 AS part FROM d GROUP BY 1 UNION ALL SELECT h.user_id, max(d.day), any_value(part) + 1 FROM h JOIN d ON d.user_id = h.user_id AND d.day <= h.hi - 7 GROUP BY h.user_id)
SELECT h.user_id, CAST(part AS BIGINT) AS part, min(day) AS "start", hi AS "end" FROM h JOIN d ON d.user_id = h.user_id AND day <= hi AND day > hi - 7 GROUP BY h.user_id, part, hi""")
def session_ranges(spark, sf_dir):
    return calendars.ranges(table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("day")), "user_id", "day", 7)


CUMULATIVE = """q AS (SELECT l_suppkey AS s, CAST(year(l_shipdate) AS INTEGER) AS y, CAST(quarter(l_shipdate) AS INTEGER) AS q, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS v FROM lineitem GROUP BY 1, 2, 3),
cum AS (SELECT s, y, q, sum(v) OVER (PARTITION BY s, y ORDER BY q) AS c FROM q WHERE NOT (s % 10 = 3 AND q = 2))"""


@query("J5", f"""WITH {CUMULATIVE}, l AS (SELECT *, lag(c) OVER w AS b, lag(q) OVER w AS bq FROM cum WINDOW w AS (PARTITION BY s, y ORDER BY q))
SELECT s, y, q, round(CASE WHEN q = 1 THEN c WHEN bq = q - 1 THEN c - b END, 2) AS quarter_value, CASE WHEN q > 1 AND bq IS DISTINCT FROM q - 1 THEN 'previous_missing' END AS reason FROM l""")
def quarter_values(spark, sf_dir):
    from pyspark.sql import Window

    x = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("s"), F.year("l_shipdate").alias("y"), F.quarter("l_shipdate").alias("q")).agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("v"))
    cum = x.where("NOT (s % 10 = 3 AND q = 2)").withColumn("c", F.sum("v").over(Window.partitionBy("s", "y").orderBy("q")))
    return periods.single_quarters(cum, ["s"], "y", "q", "c").select("s", "y", "q", F.round("quarter_value", 2).alias("quarter_value"), "reason")


@query("J6 F1 F2 F5", f"""WITH {YEARS} SELECT a.s, a.y, round(200 * (a.revenue - b.revenue) / nullif(abs(a.revenue) + abs(b.revenue), 0), 6) AS growth, round(CASE WHEN c.revenue > 0 AND a.revenue > 0 THEN 100 * (pow(a.revenue / c.revenue, 1.0 / 3) - 1) END, 6) AS cagr, round(a.tax / nullif((a.quantity + b.quantity) / 2, 0), 6) AS over_average
FROM years a LEFT JOIN years b ON a.s = b.s AND b.y = a.y - 1 LEFT JOIN years c ON a.s = c.s AND c.y = a.y - 3""")
def growth_with_opening(spark, sf_dir):
    from pitpanel.operators.features import over_average

    x = supplier_years(spark, sf_dir)
    one = periods.with_opening(x, ["s"], "y", ["revenue", "quantity"], F.col("y") - 1)
    three = periods.with_opening(one.withColumnsRenamed({"opening_revenue": "before", "opening_quantity": "stock"}), ["s"], "y", ["revenue"], F.col("y") - 3)
    return three.select("s", "y", F.round(exprs.symmetric_growth("revenue", "before"), 6).alias("growth"), F.round(exprs.positive_cagr("opening_revenue", "revenue", 3), 6).alias("cagr"), F.round(over_average(F.col("tax"), F.col("stock"), F.col("quantity")), 6).alias("over_average"))


@query("A22", "WITH y AS (SELECT DISTINCT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders), r AS (SELECT *, y + row_number() OVER (PARTITION BY o_custkey ORDER BY y DESC) AS k, max(y) OVER (PARTITION BY o_custkey) + 1 AS top FROM y) SELECT o_custkey, count(*) AS run_years FROM r WHERE k = top GROUP BY 1")
def latest_year_run(spark, sf_dir):
    return periods.latest_run(table(spark, sf_dir, "orders").select("o_custkey", F.year("o_orderdate").alias("y")), ["o_custkey"], "y")


@query("J15", "WITH h AS (SELECT DISTINCT o_custkey, CAST(year(o_orderdate) * 4 + quarter(o_orderdate) AS INTEGER) AS q FROM orders), due AS (SELECT CAST(unnest(generate_series(2000 * 4 + 1, 2000 * 4 + 8)) AS INTEGER) AS q), k AS (SELECT DISTINCT o_custkey FROM h) SELECT k.o_custkey, count(*) FILTER (WHERE h.q IS NULL) AS absent, min(due.q) FILTER (WHERE h.q IS NULL) AS first_absent FROM k CROSS JOIN due LEFT JOIN h ON h.o_custkey = k.o_custkey AND h.q = due.q GROUP BY 1")
def required_history(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_custkey", (F.year("o_orderdate") * 4 + F.quarter("o_orderdate")).alias("q"))
    out = periods.missing_periods(rows, ["o_custkey"], "q", F.array(*(F.lit(2000 * 4 + k) for k in range(1, 9))))
    return out.select("o_custkey", F.size("missing").cast("long").alias("absent"), F.try_element_at("missing", F.lit(1)).alias("first_absent"))


@query("W11 W12", f"""WITH {DAILY}, days AS (SELECT DISTINCT day FROM daily), grid AS (SELECT u.user_id, d.day, CASE WHEN y.user_id IS NULL THEN 'inactive' WHEN bad THEN NULL ELSE 'active' END AS st, y.value FROM (SELECT DISTINCT user_id FROM daily) u CROSS JOIN days d LEFT JOIN daily y ON y.user_id = u.user_id AND y.day = d.day),
i AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY day) AS i FROM grid),
w AS (SELECT *, max(CASE WHEN st = 'active' THEN 1 ELSE 0 END) OVER near AS seen, count(*) FILTER (WHERE st = 'inactive') OVER near AS idle, max(CASE WHEN st = 'active' THEN i END) OVER far AS li, max(CASE WHEN st IS NULL THEN i END) OVER far AS hole FROM i WINDOW near AS (PARTITION BY user_id ORDER BY day ROWS 4 PRECEDING), far AS (PARTITION BY user_id ORDER BY day ROWS 19 PRECEDING))
SELECT w.user_id, w.day, CASE WHEN seen = 1 THEN 'clear' WHEN idle = 5 THEN 'proven' ELSE 'pending' END AS veto, CASE WHEN coalesce(li, 0) > coalesce(hole, 0) THEN 'found' WHEN hole IS NOT NULL OR w.i < 20 THEN 'incomplete' ELSE 'no_value' END AS price_state,
 round(CASE WHEN coalesce(li, 0) > coalesce(hole, 0) THEN l.value END, 6) AS last_value, CAST(CASE WHEN coalesce(li, 0) > coalesce(hole, 0) THEN w.i - li END AS INTEGER) AS stale_days FROM w LEFT JOIN i l ON l.user_id = w.user_id AND l.i = w.li""")
def activity_windows(spark, sf_dir):
    daily = daily_activity(spark, sf_dir)
    grid = market.on_spine(daily, daily.select("day").distinct(), ["user_id"], "day")
    state = F.when(F.col("n").isNull(), "inactive").when(~F.col("bad"), "active")
    out = market.activity(grid, ["user_id"], "day", state, "value", 5, 20)
    return out.select("user_id", "day", "veto", "price_state", F.round("last_value", 6).alias("last_value"), F.col("stale_days").cast("int").alias("stale_days"))
