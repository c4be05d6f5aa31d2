"""Streams run to the end of what has arrived and compared with the same
question asked of the whole table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from .. import bindings as b
from ..session import scratch_path
from ..streaming import alerts as al
from ..streaming import files as st
from ..streaming.buckets import BucketedTable, newest, totals
from . import query

STATE = "CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'UPSTREAM_FAILED' ELSE 'SUCCEEDED' END"


def stream(spark, sf, name="events"):
    schema = b.table(spark, sf, name).schema
    return st.read_new_files(spark, sf, schema, pathGlobFilter=f"{name}.parquet")


#: Where the weeks of arriving events end.
WEEKS = ["2024-01-08", "2024-01-15", "2024-01-22"]


def arrivals(spark, sf, again=0):
    """Events a week at a time, in the order of time: after the files of a week
    have been written, the stream over all that has arrived is handed out, and
    the caller runs it, so that a week is a batch.  Each week delivers every
    ``again``-th event of the one before once more."""
    events, folder = b.table(spark, sf, "events"), scratch_path(spark, "weeks")
    days = [F.lit(d).cast("timestamp_ntz") for d in WEEKS]
    before = None
    for low, high in zip([None, *days], [*days, None]):
        week = events if low is None else events.where(F.col("ts") >= low)
        week = week if high is None else week.where(F.col("ts") < high)
        late = [] if before is None or not again else [before.where(F.col("event_id") % again == 0)]
        batch = week
        for more in late:
            batch = batch.unionByName(more)
        batch.write.mode("append").parquet(folder)
        before = week
        yield st.read_new_files(spark, folder, events.schema)


def refresh_events(df):
    state = F.when(F.col("event_type") == "error", "FAILED").when(
        F.col("event_type") == "signup", "UPSTREAM_FAILED").otherwise("SUCCEEDED")
    return df.select(F.concat(F.lit("T"), F.lpad(F.col("user_id").cast("string"), 6, "0")).alias("name"),
                     F.col("ts").alias("timestamp"), state.alias("state"))


@query("stream_append", "SELECT event_id, user_id, event_type FROM events")
def _(spark, sf):
    out = scratch_path(spark, "append")
    for _ in range(2):  # the second run finds nothing new
        st.append_new(stream(spark, sf), f"{out}/table", f"{out}/offsets")
    return spark.read.parquet(f"{out}/table").select("event_id", "user_id", "event_type")


@query("stream_upsert_newest", """
SELECT user_id, event_id, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def _(spark, sf):
    out = scratch_path(spark, "upsert")
    order = [F.col("ts").desc(), F.col("event_id").desc()]
    for week in arrivals(spark, sf, again=10):
        st.upsert_newest(week, f"{out}/table", f"{out}/offsets", ["user_id"], order)
    return st.read_newest(spark, f"{out}/table", ["user_id"], order).select("user_id", "event_id", "event_type")


@query("stream_upsert_compacted", """
SELECT user_id, event_id, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def _(spark, sf):
    out = scratch_path(spark, "upsert")
    order = [F.col("ts").desc(), F.col("event_id").desc()]
    for offsets in ("first", "second"):  # a new checkpoint over the same table adds to it
        for week in arrivals(spark, sf):
            st.upsert_newest(week, f"{out}/table", f"{out}/{offsets}", ["user_id"], order)
    st.compact(spark, f"{out}/table", f"{out}/compact", ["user_id"], order)
    return spark.read.parquet(f"{out}/compact").select("user_id", "event_id", "event_type")


@query("stream_upsert_bucketed", """
SELECT user_id, event_id, event_type, ts FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def _(spark, sf):
    """The newest event of every user, in buckets of users that the weeks rewrite as they touch them."""
    out = scratch_path(spark, "buckets")
    table = BucketedTable(spark, f"{out}/table", ["user_id"], "user_id long, event_id long, event_type string, ts timestamp_ntz", parts=16)
    rule = newest(["user_id"], [F.col("ts").desc(), F.col("event_id").desc()])
    for week in arrivals(spark, sf, again=10):
        st.run_available(week.select(F.col("user_id").cast("long"), F.col("event_id").cast("long"), "event_type", "ts"),
                         table.upsert(rule), f"{out}/offsets")
    table.vacuum()
    return table.read()


@query("stream_totals_bucketed", """
SELECT user_id, event_type, count(*) AS event_count, min(ts) AS first_ts, max(ts) AS last_ts FROM events GROUP BY 1, 2""")
def _(spark, sf):
    """Counts and times per user and kind of event, added up as the weeks arrive; no week is read twice."""
    out = scratch_path(spark, "buckets")
    keys = ["user_id", "event_type"]
    table = BucketedTable(spark, f"{out}/table", keys, "user_id long, event_type string, event_count long, first_ts timestamp_ntz, "
                          "last_ts timestamp_ntz", parts=16)
    for week in arrivals(spark, sf):
        ones = week.select(F.col("user_id").cast("long"), "event_type", F.lit(1).cast("long").alias("event_count"),
                           F.col("ts").alias("first_ts"), F.col("ts").alias("last_ts"))
        st.run_available(ones, table.upsert(totals(keys, ["event_count"], ["first_ts"], ["last_ts"])), f"{out}/offsets")
    return table.read()


@query("stream_static_join", """
SELECT event_id, c_name FROM events LEFT JOIN customer ON c_custkey = user_id""")
def _(spark, sf):
    out = scratch_path(spark, "enrich")
    names = b.table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), "c_name")
    joined = st.enrich(stream(spark, sf), names, ["user_id"]).select("event_id", "c_name")
    st.append_new(joined, f"{out}/table", f"{out}/offsets")
    return spark.read.parquet(f"{out}/table").select("event_id", "c_name")


@query("stream_first_within_watermark", "SELECT event_id, event_type FROM events")
def _(spark, sf):
    out = scratch_path(spark, "first")
    for week in arrivals(spark, sf, again=7):
        firsts = st.first_within(week.select("event_id", "event_type", "ts"), ["event_id"], "ts", "1 hour")
        st.append_new(firsts.drop("ts"), f"{out}/table", f"{out}/offsets")
    return spark.read.parquet(f"{out}/table").select("event_id", "event_type")


@query("stream_failure_alert", """
WITH weeks AS (
  SELECT 'T' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS name, CASE WHEN ts < TIMESTAMP '2024-01-08' THEN 1 WHEN ts < TIMESTAMP '2024-01-15' THEN 2
    WHEN ts < TIMESTAMP '2024-01-22' THEN 3 ELSE 4 END AS week FROM events WHERE event_type = 'error'),
names AS (SELECT DISTINCT week, name FROM weeks),
firsts AS (SELECT week, name FROM names QUALIFY row_number() OVER (PARTITION BY week ORDER BY name) <= 10)
SELECT event_count, 'The following tables failed to refresh: ' || string_agg(name, ', ' ORDER BY name) AS message
FROM firsts JOIN (SELECT week, count(*) AS event_count FROM weeks GROUP BY 1) USING (week) GROUP BY week, event_count""")
def _(spark, sf):
    out = scratch_path(spark, "alert")
    for week in arrivals(spark, sf):
        al.alert_on_new(refresh_events(week), f"{out}/table", f"{out}/offsets", "ERROR")
    return spark.read.parquet(f"{out}/table").select("event_count", "message")


@query("stream_changed_rows_export", "SELECT event_id, event_type, CAST(0 AS BIGINT) AS exported_batch FROM events WHERE event_type = 'purchase'")
def _(spark, sf):
    out = scratch_path(spark, "export")
    bought = stream(spark, sf).where("event_type = 'purchase'").select("event_id", "event_type")
    st.run_available(bought, st.changed_rows_export(f"{out}/files"), f"{out}/offsets")
    return spark.read.schema("event_id long, event_type string, exported_batch long").json(f"{out}/files").select(
        "event_id", "event_type", "exported_batch")


@query("scheduled_alert_lookback", f"""
SELECT 'T' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS name, ts AS timestamp, {STATE} AS state FROM events
WHERE event_type = 'error' AND ts > TIMESTAMP '2024-01-20 12:00:00' - INTERVAL 300 MINUTE AND ts <= TIMESTAMP '2024-01-20 12:00:00'""")
def _(spark, sf):
    return al.recent_failures(refresh_events(b.table(spark, sf, "events")), dt.datetime(2024, 1, 20, 12), minutes=300)


@query("upstream_failure_alert", f"""
SELECT 'T' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS name, ts AS timestamp, {STATE} AS state FROM events WHERE event_type = 'signup'""")
def _(spark, sf):
    return al.upstream_failures(refresh_events(b.table(spark, sf, "events")))


@query("events_by_log_level", f"""
SELECT level, count(*) AS event_count FROM (SELECT {STATE} AS state FROM events) JOIN (VALUES
 ('ERROR', 'FAILED'), ('WARN', 'FAILED'), ('WARN', 'UPSTREAM_FAILED'), ('INFO', 'FAILED'), ('INFO', 'UPSTREAM_FAILED'),
 ('INFO', 'SUCCEEDED'), ('INFO', 'SKIPPED'), ('INFO', 'CANCELED')) l(level, s) ON s = state GROUP BY 1""")
def _(spark, sf):
    events = refresh_events(b.table(spark, sf, "events"))
    counts = [F.count_if(al.at_level(level)).alias(level) for level in al.LEVELS]
    return events.agg(*counts).unpivot([], list(al.LEVELS), "level", "event_count")
