"""Feeds, watermarks, windows, sessions, retries and schedules, in their batch forms."""

from pyspark.sql import functions as F

from ..operators import feed, merge, summary
from ..streaming import harvest
from .registry import query

EVENTS = "SELECT *, ts::date AS day FROM events"


def _entries(t, even: bool):
    o = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey")).filter(f"o_orderkey % 2 = {0 if even else 1}")
    return o.groupBy(F.to_date("o_orderdate").cast("string").alias("date"), F.col("c_mktsegment").alias("journal"), F.lit("1").alias("volume"), F.col("o_orderstatus").alias("issue")).agg(F.count(F.lit(1)).alias("count"), F.lit("A" if even else "B").alias("source"))


ENTRIES = "SELECT o_orderdate::date AS date, c_mktsegment AS journal, '1' AS volume, o_orderstatus AS issue, CASE WHEN o_orderkey % 2 = 0 THEN 'A' ELSE 'B' END AS source FROM orders JOIN customer ON c_custkey = o_custkey"


@query(f"WITH e AS ({ENTRIES}) SELECT date::varchar AS date, journal, volume, issue, count(*) AS count, string_agg(DISTINCT source, '+' ORDER BY source) AS source FROM e GROUP BY 1, 2, 3, 4 ORDER BY date DESC, journal, volume, issue LIMIT 300")
def q_feed_upsert(t):
    return feed.merge_entries(_entries(t, True), _entries(t, False))


@query(f"WITH e AS ({ENTRIES}) SELECT date::varchar AS date, journal, volume, issue, count(*) FILTER (source = 'A') - count(*) FILTER (source = 'B') AS count FROM e GROUP BY 1, 2, 3, 4 HAVING count(*) FILTER (source = 'A') > count(*) FILTER (source = 'B')")
def q_feed_retract(t):
    return feed.retract(_entries(t, True), _entries(t, False))


@query("SELECT year(o_orderdate)::bigint AS y, month(o_orderdate)::bigint AS m, count(*) AS count, string_agg(DISTINCT c_mktsegment, '+' ORDER BY c_mktsegment) AS source FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_totalprice > 400000 GROUP BY 1, 2")
def q_notice_groups(t):
    o = t.orders.filter("o_totalprice > 400000").join(t.customer, F.col("c_custkey") == F.col("o_custkey")).select(F.year("o_orderdate").cast("long").alias("y"), F.month("o_orderdate").cast("long").alias("m"), "c_mktsegment")
    return feed.notices(o, ["y", "m"], "c_mktsegment")


@query("SELECT event_id, user_id FROM events WHERE ts >= DATE '2024-01-12' AND ts < DATE '2024-01-21'")
def q_watermark_slice(t):
    return harvest.slice_from(t.events, "ts", "2024-01-15", "2024-01-20").select("event_id", "user_id")


@query("SELECT greatest(max(ts)::date, DATE '2024-01-10')::varchar AS last_until FROM events")
def q_high_water(t):
    return harvest.high_water(t.events, "ts", "2024-01-10").select(F.col("last_until").cast("string").alias("last_until"))


@query("SELECT o_orderkey FROM orders WHERE year(o_orderdate) >= (SELECT max(year(o_orderdate)) FROM orders) - 1")
def q_recent_only(t):
    last = t.orders.agg(F.max(F.year("o_orderdate")).alias("last"))
    return t.orders.join(F.broadcast(last), F.year("o_orderdate") >= F.col("last") - 1).select("o_orderkey")


@query("SELECT date_trunc('day', ts) AS day, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def q_tumbling(t):
    e = harvest.event_time(t.events, "ts")
    rows = harvest.windowed(e, "ts", "1 day", ["event_type"], [F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total")])
    return rows.select(F.col("window.start").cast("timestamp_ntz").alias("day"), "event_type", "n", "total")


@query("""WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS first FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
 s AS (SELECT *, sum(first) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM (SELECT * FROM g ORDER BY user_id, ts)) SELECT user_id, min(ts) AS begins, count(*) AS n FROM s GROUP BY user_id, s.s""")
def q_session(t):
    e = harvest.event_time(t.events, "ts")
    rows = harvest.sessions(e, "ts", "6 hours", ["user_id"], [F.count(F.lit(1)).alias("n")])
    return rows.select("user_id", F.col("session_window.start").cast("timestamp_ntz").alias("begins"), "n")


@query(f"""WITH d AS (SELECT DISTINCT user_id, day FROM ({EVENTS})), r AS (SELECT *, day - row_number() OVER (PARTITION BY user_id ORDER BY day)::int AS run FROM d),
 c AS (SELECT *, (row_number() OVER (PARTITION BY user_id, run ORDER BY day) - 1) // 3 AS cut FROM r) SELECT user_id, min(day)::varchar AS first_day, max(day)::varchar AS last_day, count(*) AS n_days FROM c GROUP BY user_id, run, cut""")
def q_islands(t):
    rows = summary.islands(t.events, "ts", ["user_id"], 3)
    return rows.select("user_id", F.col("first_day").cast("string").alias("first_day"), F.col("last_day").cast("string").alias("last_day"), "n_days")


@query("""WITH e AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos, (event_type <> 'purchase')::int AS empty FROM events),
 s AS (SELECT *, (sum(empty) OVER (PARTITION BY user_id ORDER BY pos ROWS 2 PRECEDING) = 3)::int AS full_ FROM e), b AS (SELECT *, coalesce(sum(full_) OVER (PARTITION BY user_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS over_ FROM s)
SELECT event_id, user_id FROM b WHERE over_ = 0""")
def q_stop_after_empty(t):
    e = t.events.withColumn("order", F.struct("ts", "event_id"))
    return summary.stop_after_empty(e, ["user_id"], "order", F.col("event_type") != "purchase").select("event_id", "user_id")


@query(f"SELECT event_id, day <= DATE '2024-01-15' AS is_late, CASE WHEN day <= DATE '2024-01-15' THEN 1 ELSE 0 END AS turn FROM ({EVENTS}) WHERE day >= DATE '2024-01-12'")
def q_late_split(t):
    e = t.events.withColumn("day", F.to_date("ts")).filter("day >= date'2024-01-12'")
    return harvest.late_first_order(e, "day", "2024-01-15").select("event_id", "is_late", "turn")


@query("""SELECT o_orderkey FROM orders LEFT JOIN (SELECT l_orderkey AS k, max(l_shipdate)::date AS missed FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1) s ON k = o_orderkey
WHERE missed IS NULL OR missed < DATE '1998-01-01' - CASE WHEN year(o_orderdate) >= 1997 THEN 7 ELSE 90 END""")
def q_retry_due(t):
    state = t.lineitem.filter("l_returnflag = 'A'").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_shipdate").alias("missed"))
    return harvest.retry_due(t.orders.withColumn("y", F.year("o_orderdate")), state, "o_orderkey", "y", "1998-01-01", 1998).select("o_orderkey")


@query("SELECT event_id, CASE dayofweek(ts) WHEN 1 THEN 'A' WHEN 2 THEN 'B' WHEN 4 THEN 'C' END AS journal FROM events")
def q_schedule(t):
    return harvest.scheduled(t.events, F.col("ts"), {2: "A", 3: "B", 5: "C"}).select("event_id", "journal")


@query("SELECT event_id, user_id, event_type FROM events")
def q_harvest_stream(t):
    """Events arrive as files, pass the stream's upsert twice (the second time nothing is new) and are read back."""
    from ..session import work_folder

    folder = work_folder(t.spark, "harvest")
    e = t.events.withColumn("kind", F.col("event_type"))
    e.write.parquet(f"{folder}/landing")
    for _ in range(2):
        stream = t.spark.readStream.schema(e.schema).parquet(f"{folder}/landing")
        harvest.harvest_stream(stream, "event_id", "ts", f"{folder}/store", "kind", f"{folder}/checkpoint").awaitTermination()
    return merge.read_table(t.spark, f"{folder}/store").select("event_id", "user_id", "event_type")
