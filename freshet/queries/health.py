"""Refresh history, lag and health reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from .. import bindings as b
from ..operators import graph as g
from ..plans import health as h
from . import query

# Refresh history, table settings and edges restated for DuckDB.
HISTORY = """
ev AS (SELECT *, CAST(props->>'$.k' AS BIGINT) AS k, date_trunc('second', ts) AS s, CAST(floor(value) AS BIGINT) AS dur,
         'T' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS name, 'Q' || lpad(CAST(event_id AS VARCHAR), 9, '0') AS query_id FROM events),
hist AS (SELECT name, user_id, query_id, k, value, dur AS duration_sec, s AS refresh_start_time, s + to_seconds(dur) AS refresh_end_time,
  date_trunc('hour', ts) AS data_timestamp,
  CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'SKIPPED' ELSE 'SUCCEEDED' END AS state,
  CASE WHEN event_type = 'error' THEN 'E' || k END AS state_code,
  CASE WHEN event_type = 'error' THEN CASE WHEN k < 20 THEN 'change tracking is off' ELSE 'query failed' END END AS state_message,
  CASE event_type WHEN 'click' THEN 'FULL' WHEN 'purchase' THEN CASE WHEN k < 10 THEN 'REINITIALIZE' ELSE 'INCREMENTAL' END
    WHEN 'signup' THEN 'NO_DATA' ELSE 'INCREMENTAL' END AS refresh_action,
  CASE WHEN event_type = 'view' AND k < 3 THEN 'CREATION' WHEN k >= 90 THEN 'MANUAL' ELSE 'SCHEDULED' END AS refresh_trigger
  FROM ev),
h AS (SELECT *, CASE WHEN refresh_action IN ('INCREMENTAL', 'FULL') AND refresh_trigger <> 'CREATION' THEN duration_sec END AS steady,
  refresh_trigger = 'CREATION' OR refresh_action = 'REINITIALIZE' AS rebuild FROM hist)"""

STATS = """stats AS (SELECT name, count(*) AS total_refreshes, avg(steady) AS avg_duration_sec, max(steady) AS max_duration_sec,
  avg(CASE WHEN rebuild THEN duration_sec END) AS avg_init_duration_sec, round(quantile_cont(steady, 0.95), 6) AS p95_duration_sec,
  count(*) FILTER (refresh_action = 'INCREMENTAL' AND refresh_trigger <> 'CREATION') AS incremental_count,
  count(*) FILTER (refresh_action = 'FULL' AND refresh_trigger <> 'CREATION') AS full_count,
  count(*) FILTER (refresh_action = 'REINITIALIZE') AS reinitialize_count, count(*) FILTER (refresh_action = 'NO_DATA') AS no_data_count,
  count(*) FILTER (refresh_trigger = 'CREATION') AS creation_count, count(*) FILTER (state = 'FAILED') AS failed_count
  FROM h WHERE refresh_start_time > TIMESTAMP '2024-01-24' GROUP BY 1)"""

LAG = """ok AS (SELECT name, data_timestamp, refresh_end_time AS e,
    lead(refresh_end_time) OVER (PARTITION BY name ORDER BY refresh_end_time, query_id) AS nxt FROM h WHERE state = 'SUCCEEDED' {start}),
st AS (SELECT name, date_diff('second', data_timestamp, e) AS low, date_diff('second', e, nxt) AS span FROM ok WHERE nxt IS NOT NULL),
lag AS (SELECT name,
  CASE WHEN sum(span) > 0 THEN CAST(sum(span * (2 * low + span)) AS DOUBLE) / CAST(2 * sum(span) AS DOUBLE) END AS mean_lag_sec,
  max(low + span) AS maximum_lag_sec,
  CAST(sum(greatest(0, least(span, low + span - 36000))) AS BIGINT) AS time_above_target_lag_sec,
  CASE WHEN sum(span) > 0 THEN CAST(sum(span) - sum(greatest(0, least(span, low + span - 36000))) AS DOUBLE) / CAST(sum(span) AS DOUBLE) END AS time_within_target_lag_ratio
  FROM st GROUP BY 1)"""

CONFIG = """config AS (SELECT 'T' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS name,
  CASE WHEN max(value) > 300 THEN 'SUSPENDED' ELSE 'ACTIVE' END AS scheduling_state,
  CASE WHEN count(*) FILTER (event_type = 'click') > count(*) FILTER (event_type = 'view') THEN 'FULL' ELSE 'INCREMENTAL' END AS refresh_mode,
  CASE WHEN max(value) > 150 THEN 'INCREMENTAL' ELSE 'FULL' END AS expected_mode FROM events GROUP BY user_id),
last AS (SELECT name, state AS last_state, state_message FROM h QUALIFY row_number() OVER (PARTITION BY name ORDER BY refresh_end_time DESC, query_id DESC) = 1),
report AS (SELECT config.*, last_state AS last_completed_refresh_state, state_message, mean_lag_sec, time_within_target_lag_ratio,
  CASE WHEN scheduling_state = 'SUSPENDED' OR last_state IN ('FAILED', 'UPSTREAM_FAILED') THEN 'CRITICAL'
    WHEN last_state IS NULL OR last_state = 'CANCELED' OR time_within_target_lag_ratio < 0.9 OR (refresh_mode = 'FULL' AND expected_mode = 'INCREMENTAL') THEN 'WARNING'
    ELSE 'HEALTHY' END AS status FROM config LEFT JOIN last USING (name) LEFT JOIN lag USING (name))"""


def history_sql(body: str, *parts: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in (HISTORY, *parts)) + "\n" + body.strip()


LAG_ALL = LAG.replace("{start}", "")
#: The same with the last stretch of each table closed at the reporting time.
LAG_UP_TO_NOW = LAG_ALL.replace("ok AS (SELECT", "open_ok AS (SELECT").replace("st AS (SELECT name, date_diff", f"""ok AS (
  SELECT name, data_timestamp, e, coalesce(nxt, CASE WHEN e < TIMESTAMP '{b.EVENTS_AS_OF}' THEN TIMESTAMP '{b.EVENTS_AS_OF}' END) AS nxt FROM open_ok),
st AS (SELECT name, date_diff""")


def hist(spark, sf):
    return b.refresh_history(spark, sf)


@query("refresh_details", history_sql("""
SELECT name, query_id, data_timestamp, refresh_start_time, refresh_end_time, duration_sec, state, state_code, state_message, refresh_action, refresh_trigger,
  CAST(k * 10 AS DOUBLE) / 1000 AS compilation_sec, CAST(floor(value * 100) AS DOUBLE) / 1000 AS execution_sec,
  k * 100 AS rows_inserted, k AS rows_deleted, k + user_id AS rows_copied, CAST(1 AS BIGINT) AS partitions_added, CAST(0 AS BIGINT) AS partitions_removed FROM h"""))
def _(spark, sf):
    return h.refresh_details(hist(spark, sf)).drop("graph_history_valid_from")


@query("refresh_details_latest", history_sql("""
SELECT name, query_id, duration_sec, k * 100 AS rows_inserted FROM h ORDER BY refresh_start_time DESC, query_id LIMIT 20"""))
def _(spark, sf):
    return h.refresh_details(hist(spark, sf), 20).select("name", "query_id", "duration_sec", "rows_inserted")


@query("latest_successful_refresh", history_sql("""
SELECT name, query_id, duration_sec FROM h WHERE state = 'SUCCEEDED'
QUALIFY row_number() OVER (PARTITION BY name ORDER BY refresh_start_time DESC, query_id DESC) = 1"""))
def _(spark, sf):
    return h.latest_success(hist(spark, sf))


@query("refresh_errors", history_sql("""
SELECT name, refresh_start_time, state, state_code, state_message FROM h WHERE state = 'FAILED' AND refresh_start_time > TIMESTAMP '2024-01-24'"""))
def _(spark, sf):
    return h.errors(hist(spark, sf), b.EVENTS_AS_OF)


@query("refresh_statistics", history_sql("SELECT * FROM stats", STATS))
def _(spark, sf):
    stats = h.refresh_statistics(hist(spark, sf), b.EVENTS_AS_OF)
    return stats.withColumn("p95_duration_sec", F.round("p95_duration_sec", 6))


@query("hourly_refresh_trend", history_sql("""
SELECT name, date_trunc('hour', refresh_start_time) AS hour, avg(duration_sec) AS avg_duration_sec, count(*) AS refreshes FROM h GROUP BY 1, 2"""))
def _(spark, sf):
    return h.hourly_trend(hist(spark, sf))


DAILY = """daily AS (SELECT name, CAST(refresh_start_time AS DATE) AS refresh_date, count(*) AS refreshes, avg(steady) AS avg_duration_sec,
  count(*) FILTER (state = 'FAILED') AS failed_count, count(*) FILTER (refresh_action = 'FULL' AND refresh_trigger <> 'CREATION') AS full_count
  FROM h WHERE refresh_start_time > TIMESTAMP '2024-01-01' GROUP BY 1, 2)"""


@query("daily_refresh_rollup", history_sql("SELECT * FROM daily", DAILY))
def _(spark, sf):
    return h.daily_rollup(hist(spark, sf), b.EVENTS_AS_OF)


@query("refresh_drift", history_sql("""
SELECT name, refresh_date, avg_duration_sec, avg_duration_sec - lag(avg_duration_sec) OVER (PARTITION BY name ORDER BY refresh_date) AS change_sec FROM daily""", DAILY))
def _(spark, sf):
    return h.drift(hist(spark, sf), b.EVENTS_AS_OF)


@query("before_after_cutoff", history_sql("""
SELECT name, avg(duration_sec) FILTER (refresh_start_time < TIMESTAMP '2024-01-15') AS before_sec,
  avg(duration_sec) FILTER (refresh_start_time >= TIMESTAMP '2024-01-15') AS after_sec,
  count(*) FILTER (refresh_start_time < TIMESTAMP '2024-01-15') AS before_count,
  count(*) FILTER (refresh_start_time >= TIMESTAMP '2024-01-15') AS after_count FROM h GROUP BY 1"""))
def _(spark, sf):
    return h.before_after(hist(spark, sf), dt.datetime(2024, 1, 15))


@query("refresh_action_mix", history_sql("SELECT name, refresh_action, count(*) AS refreshes FROM h GROUP BY 1, 2"))
def _(spark, sf):
    return h.action_mix(hist(spark, sf))


@query("refresh_categories", history_sql("""
SELECT name, CASE WHEN refresh_trigger = 'CREATION' THEN 'CREATION' WHEN refresh_action IN ('REINITIALIZE', 'NO_DATA') THEN refresh_action
  ELSE 'STEADY_STATE' END AS category, count(*) AS refreshes FROM h GROUP BY 1, 2"""))
def _(spark, sf):
    return hist(spark, sf).groupBy("name", h.category().alias("category")).agg(F.count(F.lit(1)).alias("refreshes"))


EPOCHS = """ep AS (SELECT *, CAST(sum(CASE WHEN rebuild THEN 1 ELSE 0 END) OVER (
  PARTITION BY name ORDER BY refresh_start_time, query_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS epoch FROM h)"""


@query("rebuild_epochs", history_sql("SELECT name, query_id, epoch FROM ep", EPOCHS))
def _(spark, sf):
    return h.epochs(hist(spark, sf)).select("name", "query_id", "epoch")


@query("rebuild_epoch_metrics", history_sql("""
SELECT name, epoch, count(*) AS refreshes, count(steady) AS steady_refreshes, avg(steady) AS avg_duration_sec FROM ep GROUP BY 1, 2""", EPOCHS))
def _(spark, sf):
    return h.epoch_metrics(hist(spark, sf))


@query("refresh_with_definition", history_sql("""
SELECT name, query_id, CASE WHEN refresh_start_time < TIMESTAMP '2024-01-22' THEN 'version of ' || strftime(date_trunc('week', refresh_start_time), '%Y-%m-%d') END AS query_text FROM h"""))
def _(spark, sf):
    rows = hist(spark, sf)
    start = F.col("graph_history_valid_from")
    versions = rows.where(start < F.lit("2024-01-22").cast("timestamp_ntz")).select(
        "name", start.alias("valid_from"), F.concat(F.lit("version of "), F.date_format(start, "yyyy-MM-dd")).alias("query_text")).distinct()
    return h.with_definition(rows, versions).select("name", "query_id", "query_text")


@query("lag_metrics", history_sql("SELECT * FROM lag", LAG_ALL))
def _(spark, sf):
    return h.lag_metrics(hist(spark, sf))


@query("lag_metrics_since", history_sql("SELECT * FROM lag", LAG.replace("{start}", "AND data_timestamp >= TIMESTAMP '2024-01-20'")))
def _(spark, sf):
    return h.lag_metrics(hist(spark, sf), dt.datetime(2024, 1, 20))


@query("lag_metrics_up_to_now", history_sql("SELECT * FROM lag", LAG_UP_TO_NOW))
def _(spark, sf):
    return h.lag_metrics(hist(spark, sf), as_of=b.EVENTS_AS_OF)


@query("lag_compliance", history_sql("""
SELECT name, CASE WHEN time_within_target_lag_ratio >= 0.95 THEN 'GOAL_MET' WHEN time_within_target_lag_ratio >= 0.9 THEN 'HEALTHY' ELSE 'LATE' END AS verdict FROM lag""", LAG_ALL))
def _(spark, sf):
    return h.lag_metrics(hist(spark, sf)).select("name", h.compliance("time_within_target_lag_ratio").alias("verdict"))


REPORT = ["name", "scheduling_state", "refresh_mode", "last_completed_refresh_state", "mean_lag_sec", "time_within_target_lag_ratio", "status"]


@query("table_health_report", history_sql(f"""
SELECT {', '.join(REPORT)}, total_refreshes, avg_duration_sec, p95_duration_sec, failed_count
FROM report LEFT JOIN stats USING (name)""", STATS, LAG_UP_TO_NOW, CONFIG))
def _(spark, sf):
    report = h.table_report(hist(spark, sf), b.table_config(spark, sf), b.EVENTS_AS_OF)
    return report.select(*REPORT, "total_refreshes", "avg_duration_sec", F.round("p95_duration_sec", 6).alias("p95_duration_sec"), "failed_count")


GROUPS = """edge AS (SELECT DISTINCT user_id AS n, user_id // 2 AS p FROM events WHERE user_id >= 16
  UNION SELECT DISTINCT user_id, user_id // 4 FROM events WHERE user_id >= 32),
node AS (SELECT DISTINCT user_id AS n FROM events UNION SELECT p FROM edge),
pairs AS (SELECT n AS a, p AS z FROM edge UNION SELECT p, n FROM edge)"""


@query("connected_tables_health", history_sql("""
, reach(n, r) AS (SELECT n, n FROM node UNION SELECT pairs.z, r FROM reach JOIN pairs ON a = reach.n),
comp AS (SELECT n, min(r) AS c FROM reach GROUP BY 1),
walk(n, d) AS (SELECT n, 0 FROM node WHERE n NOT IN (SELECT n FROM edge) UNION SELECT edge.n, d + 1 FROM walk JOIN edge ON p = walk.n),
deep AS (SELECT n, CAST(max(d) AS BIGINT) AS depth FROM walk GROUP BY 1),
rows AS (SELECT name, status, c, depth, CASE status WHEN 'CRITICAL' THEN 2 WHEN 'WARNING' THEN 1 ELSE 0 END AS w
  FROM report JOIN comp ON name = 'T' || lpad(CAST(n AS VARCHAR), 6, '0') JOIN deep USING (n))
SELECT arg_min(name, printf('%05d', 10000 - depth) || name) AS leaf, count(*) AS tables, max(depth) AS depth,
  count(*) FILTER (w = 0) AS healthy, count(*) FILTER (w = 1) AS warning, count(*) FILTER (w = 2) AS critical,
  CASE max(w) WHEN 2 THEN 'CRITICAL' WHEN 1 THEN 'WARNING' ELSE 'HEALTHY' END AS status FROM rows GROUP BY c""",
    LAG_UP_TO_NOW, CONFIG, GROUPS).replace("WITH ", "WITH RECURSIVE ", 1).replace("\n, reach(n, r)", ",\nreach(n, r)"))
def _(spark, sf):
    report = h.table_report(hist(spark, sf), b.table_config(spark, sf), b.EVENTS_AS_OF)
    edges, nodes = g.edges(b.graph(spark, sf), kinds=["MAINTAINED"]), b.nodes(spark, sf)
    return h.group_report(report, g.components(edges, nodes), g.depths(edges, nodes))


@query("suspended_after_failures", history_sql("""
SELECT name, max(n) AS longest_run FROM (SELECT name, r, count(*) AS n FROM (
  SELECT name, state, sum(CASE WHEN state = 'FAILED' THEN 0 ELSE 1 END) OVER (PARTITION BY name ORDER BY refresh_start_time, query_id ROWS UNBOUNDED PRECEDING) AS r FROM h)
  WHERE state = 'FAILED' GROUP BY 1, 2) GROUP BY 1 HAVING max(n) >= 3"""))
def _(spark, sf):
    return h.suspended(hist(spark, sf), 3)


@query("issue_routing", history_sql("""
SELECT name, CASE WHEN scheduling_state = 'SUSPENDED' THEN 'SUSPENDED_TABLE' WHEN last_completed_refresh_state = 'UPSTREAM_FAILED' THEN 'UPSTREAM_FAILURE'
  WHEN refresh_mode = 'FULL' AND expected_mode = 'INCREMENTAL' THEN 'INCREMENTAL_NOT_SUPPORTED' WHEN state_message LIKE '%change tracking%' THEN 'CHANGE_TRACKING'
  WHEN last_completed_refresh_state = 'FAILED' THEN 'REFRESH_ERROR' WHEN time_within_target_lag_ratio < 0.9 THEN 'TARGET_LAG_NOT_MET' END AS issue FROM report""",
    LAG_UP_TO_NOW, CONFIG))
def _(spark, sf):
    rows = hist(spark, sf)
    message = rows.groupBy("name").agg(F.max_by("state_message", F.struct("refresh_end_time", "query_id")).alias("state_message"))
    report = h.table_report(rows, b.table_config(spark, sf), b.EVENTS_AS_OF).join(message, "name", "left")
    return report.select("name", h.issue_route().alias("issue"))


def split_metrics(spark, sf):
    """Measured columns per table: durations and volumes from the history."""
    rows = hist(spark, sf).withColumn("_d", h.duration()).groupBy("name").agg(
        F.avg("_d").alias("avg_duration_sec"), F.max("_d").alias("_max"), F.count(F.lit(1)).alias("_n"))
    measured = rows.select("name", "avg_duration_sec", F.lit(100).alias("target_lag_sec"), (F.col("_n") % 9).alias("joins"),
                           (F.col("_max") / 10).alias("max_operator_percent"), (F.col("_max") * F.col("_n") / 100).alias("gb_scanned"))
    return measured.join(b.table_config(spark, sf).select("name", "refresh_mode", "expected_mode"), "name")


@query("split_indicators", history_sql("""
SELECT m.name, a > 50 AS long_refresh, n % 9 > 5 AS many_joins, refresh_mode = 'FULL' AND expected_mode = 'INCREMENTAL' AS full_unexpected,
  CAST(x AS DOUBLE) / 10 > 30 AS dominant_operator, CAST(x * n AS DOUBLE) / 100 > 100 AS large_scan
FROM (SELECT name, avg(duration_sec) AS a, max(duration_sec) AS x, count(*) AS n FROM h GROUP BY 1) m JOIN report USING (name)""", LAG_ALL, CONFIG))
def _(spark, sf):
    return h.split_indicators(split_metrics(spark, sf)).select(
        "name", "long_refresh", "many_joins", "full_unexpected", "dominant_operator", "large_scan")


@query("slow_operators", """
SELECT CAST(event_id AS VARCHAR) AS operator_id, event_type AS operator_type, value / 10 AS overall_percentage, value / 10 > 20 AS bottleneck
FROM events WHERE user_id = 7 ORDER BY value DESC, operator_id LIMIT 15""")
def _(spark, sf):
    stats = b.table(spark, sf, "events").select(
        F.concat(F.lit("Q"), F.col("user_id").cast("string")).alias("query_id"), F.col("event_id").cast("string").alias("operator_id"),
        F.col("event_type").alias("operator_type"), (F.col("value") / 10).alias("overall_percentage"))
    return h.slow_operators(stats, "Q7").drop("query_id")


@query("query_io_summary", """
SELECT CAST(event_id AS VARCHAR) AS query_id, floor(value) / 1000 AS elapsed_sec, floor(value) * 1048576 / 1073741824 AS gb_scanned,
  CASE WHEN user_id = 0 THEN NULL ELSE round(least(CAST(props->>'$.k' AS DOUBLE), user_id) / user_id * 100, 1) END AS partition_scan_pct,
  CAST(0 AS DOUBLE) AS gb_spilled_local, floor(value) / 1073741824 AS gb_spilled_remote FROM events""")
def _(spark, sf):
    k, n, work = F.get_json_object("props", "$.k").cast("bigint"), F.col("user_id"), F.floor("value")
    queries = b.table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("query_id"), work.alias("total_elapsed_time"), (work * 1048576).alias("bytes_scanned"),
        F.least(k, n).alias("partitions_scanned"), n.alias("partitions_total"),
        F.lit(0).alias("bytes_spilled_to_local_storage"), work.alias("bytes_spilled_to_remote_storage"))
    return h.io_summary(queries)


LISTED = """SELECT name, last_completed_refresh_state, time_within_target_lag_ratio FROM report
ORDER BY CASE last_completed_refresh_state WHEN 'FAILED' THEN 1 WHEN 'UPSTREAM_FAILED' THEN 2 WHEN 'SKIPPED' THEN 3 WHEN 'SUCCEEDED' THEN 4 ELSE 5 END, name LIMIT 60"""


def lag_states(spark, sf):
    rows = hist(spark, sf)
    return b.table_config(spark, sf).select("name").join(h.last_state(rows), "name", "left").join(h.lag_metrics(rows), "name", "left").select(
        "name", "last_completed_refresh_state", "time_within_target_lag_ratio")


@query("state_ordered_listing", history_sql(f"SELECT * FROM ({LISTED}) WHERE last_completed_refresh_state <> 'FAILED'", LAG_ALL, CONFIG))
def _(spark, sf):
    return h.listing(lag_states(spark, sf), 60, F.col("last_completed_refresh_state") != "FAILED")


@query("tables_with_issues", history_sql("""
SELECT name, last_completed_refresh_state, time_within_target_lag_ratio FROM report
WHERE last_completed_refresh_state <> 'SUCCEEDED' OR time_within_target_lag_ratio < 0.9""", LAG_ALL, CONFIG))
def _(spark, sf):
    return h.with_issues(lag_states(spark, sf))


@query("inputs_that_changed", history_sql("""
SELECT name, 'T' || lpad(CAST(p AS VARCHAR), 6, '0') AS input, count(*) AS refreshes, CAST(sum(r) AS BIGINT) AS changed_rows FROM (
  SELECT name, user_id // 2 AS p, k AS r FROM h WHERE user_id >= 16 UNION ALL SELECT name, user_id // 4, k * 2 FROM h WHERE user_id >= 32) GROUP BY 1, 2"""))
def _(spark, sf):
    return h.changed_inputs(hist(spark, sf))


@query("alert_run_history", """
SELECT CAST(event_id AS VARCHAR) AS run_id, ts AS scheduled_time, event_type AS name FROM events WHERE event_type = 'error'
ORDER BY ts DESC, run_id LIMIT 10""")
def _(spark, sf):
    runs = b.table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("run_id"), F.col("ts").alias("scheduled_time"), F.col("event_type").alias("name"))
    return h.alert_runs(runs, "error")
