"""Refresh, lag and health analytics over a refresh history table.

One row of the history is one refresh (``schemas.REFRESH_HISTORY``).  Every
function filters by time first, so on a history partitioned by day only the
days asked for are read.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import instant, seconds_between
from ..functions.semistructured import json_struct
from ..operators.aggregates import percentiles
from ..operators.windows import ordered_windows
from ..sources.schemas import REFRESH_STATISTICS

# Spellings met in the wild -> the one used here.
STATE_NAMES = {
    "SUCCESS": "SUCCEEDED",
    "CANCELLED": "CANCELED",
    "UPSTREAM_FAILURE": "UPSTREAM_FAILED",
}
# Order in which listings show the last refresh state.
STATE_ORDER = ["FAILED", "UPSTREAM_FAILED", "SKIPPED", "SUCCEEDED", "CANCELED"]
# Share of time within the target lag.
HEALTHY_RATIO, GOAL_RATIO = 0.90, 0.95
# Fixed value: failures in a row after which a table is suspended.
SUSPEND_AFTER = 5
# When splitting a table into stages is worth a look.
SPLIT_DURATION_SHARE, SPLIT_JOINS, SPLIT_OPERATOR_PERCENT, SPLIT_SCAN_GB = 0.5, 5, 30, 100
# Operators listed, and the share that makes one a bottleneck.
SLOW_OPERATORS, BOTTLENECK_PERCENT = 15, 20


def normal_state(state: Column | str) -> Column:
    state = F.col(state) if isinstance(state, str) else state
    result = state
    for found, used in STATE_NAMES.items():
        result = F.when(state == found, used).otherwise(result)
    return result


def duration() -> Column:
    return seconds_between("refresh_start_time", "refresh_end_time")


def is_steady() -> Column:
    """Ordinary work: neither the first build nor a rebuild nor a no-op."""
    return F.col("refresh_action").isin("INCREMENTAL", "FULL") & (F.col("refresh_trigger") != "CREATION")


def steady_duration() -> Column:
    return F.when(is_steady(), duration())


def since(column: str, as_of: dt.datetime, **span) -> Column:
    start = instant(as_of - dt.timedelta(**span))
    return F.col(column) > start


def refresh_details(history: DataFrame, limit: int | None = None) -> DataFrame:
    """Refreshes with their statistics as columns, newest first."""
    s = json_struct("statistics", REFRESH_STATISTICS)
    rows = history.withColumn("_s", s).select(
        "name", "data_timestamp", "refresh_start_time", "refresh_end_time", duration().alias("duration_sec"),
        normal_state("state").alias("state"), "state_code", "state_message", "refresh_action", "refresh_trigger",
        "query_id", "graph_history_valid_from",
        (F.col("_s.compilationTimeMs") / 1000).alias("compilation_sec"),
        (F.col("_s.executionTimeMs") / 1000).alias("execution_sec"),
        F.col("_s.numInsertedRows").alias("rows_inserted"),
        F.col("_s.numDeletedRows").alias("rows_deleted"),
        F.col("_s.numCopiedRows").alias("rows_copied"),
        F.col("_s.numAddedPartitions").alias("partitions_added"),
        F.col("_s.numRemovedPartitions").alias("partitions_removed"),
    )
    if limit is None:
        return rows
    return rows.orderBy(F.col("refresh_start_time").desc(), "query_id").limit(limit)


def latest_success(history: DataFrame) -> DataFrame:
    """The newest successful refresh of every table, with its duration."""
    done = history.where(normal_state("state") == "SUCCEEDED")
    newest = F.max_by(F.struct("query_id", duration().alias("duration_sec")), F.struct("refresh_start_time", "query_id"))
    return done.groupBy("name").agg(newest.alias("r")).select("name", "r.query_id", "r.duration_sec")


def errors(history: DataFrame, as_of: dt.datetime, days: int = 7) -> DataFrame:
    bad = normal_state("state").isin("FAILED", "UPSTREAM_FAILED")
    return history.where(since("refresh_start_time", as_of, days=days) & bad).select(
        "name", "refresh_start_time", normal_state("state").alias("state"), "state_code", "state_message"
    )


def refresh_statistics(history: DataFrame, as_of: dt.datetime, days: int = 7) -> DataFrame:
    """Steady-state durations and action counts per table."""
    window = history.where(since("refresh_start_time", as_of, days=days))
    action, trigger = F.col("refresh_action"), F.col("refresh_trigger")
    steady = steady_duration()
    building = F.when((trigger == "CREATION") | (action == "REINITIALIZE"), duration())
    counts = window.groupBy("name").agg(
        F.count(F.lit(1)).alias("total_refreshes"),
        F.avg(steady).alias("avg_duration_sec"),
        F.max(steady).alias("max_duration_sec"),
        F.avg(building).alias("avg_init_duration_sec"),
        F.count_if((action == "INCREMENTAL") & (trigger != "CREATION")).alias("incremental_count"),
        F.count_if((action == "FULL") & (trigger != "CREATION")).alias("full_count"),
        F.count_if(action == "REINITIALIZE").alias("reinitialize_count"),
        F.count_if(action == "NO_DATA").alias("no_data_count"),
        F.count_if(trigger == "CREATION").alias("creation_count"),
        F.count_if(F.col("state") == "FAILED").alias("failed_count"),
    )
    p95 = percentiles(window, ["name"], steady, {"p95_duration_sec": 0.95})
    return counts.join(p95, "name", "left")


def hourly_trend(history: DataFrame) -> DataFrame:
    return history.groupBy("name", F.date_trunc("hour", "refresh_start_time").cast("timestamp_ntz").alias("hour")).agg(
        F.avg(duration()).alias("avg_duration_sec"), F.count(F.lit(1)).alias("refreshes")
    )


def daily_rollup(history: DataFrame, as_of: dt.datetime, days: int = 30) -> DataFrame:
    window = history.where(since("refresh_start_time", as_of, days=days))
    return window.groupBy("name", F.to_date("refresh_start_time").alias("refresh_date")).agg(
        F.count(F.lit(1)).alias("refreshes"),
        F.avg(steady_duration()).alias("avg_duration_sec"),
        F.count_if(F.col("state") == "FAILED").alias("failed_count"),
        F.count_if((F.col("refresh_action") == "FULL") & (F.col("refresh_trigger") != "CREATION")).alias("full_count"),
    )


def drift(history: DataFrame, as_of: dt.datetime, days: int = 30) -> DataFrame:
    """Day-over-day change of the daily rollup.  A table has at most ``days``
    rows there, so an ordinary window is enough."""
    by_day = Window.partitionBy("name").orderBy("refresh_date")
    previous = F.lag("avg_duration_sec").over(by_day)
    return daily_rollup(history, as_of, days).select(
        "name", "refresh_date", "avg_duration_sec", (F.col("avg_duration_sec") - previous).alias("change_sec")
    )


def before_after(history: DataFrame, cutoff: dt.datetime) -> DataFrame:
    """Average duration on both sides of a change."""
    earlier = F.col("refresh_start_time") < instant(cutoff)
    return history.groupBy("name").agg(
        F.avg(F.when(earlier, duration())).alias("before_sec"),
        F.avg(F.when(~earlier, duration())).alias("after_sec"),
        F.count_if(earlier).alias("before_count"),
        F.count_if(~earlier).alias("after_count"),
    )


def action_mix(history: DataFrame) -> DataFrame:
    return history.groupBy("name", "refresh_action").agg(F.count(F.lit(1)).alias("refreshes"))


def category() -> Column:
    return (
        F.when(F.col("refresh_trigger") == "CREATION", "CREATION")
        .when(F.col("refresh_action") == "REINITIALIZE", "REINITIALIZE")
        .when(F.col("refresh_action") == "NO_DATA", "NO_DATA")
        .otherwise("STEADY_STATE")
    )


def epochs(history: DataFrame) -> DataFrame:
    """Refreshes numbered by the rebuild they follow.  Epoch 0 lies before the
    first rebuild on record."""
    rebuild = (F.col("refresh_trigger") == "CREATION") | (F.col("refresh_action") == "REINITIALIZE")
    flagged = history.select(
        "name", "refresh_start_time", "query_id", "refresh_action", "refresh_trigger",
        duration().alias("duration_sec"), F.when(rebuild, 1).otherwise(0).cast("bigint").alias("_start"),
    )
    numbered = ordered_windows(flagged, ["name"], ["refresh_start_time", "query_id"], totals={"epoch": "_start"})
    return numbered.drop("_start")


def epoch_metrics(history: DataFrame) -> DataFrame:
    """Steady-state durations per epoch, never mixed across a rebuild."""
    steady = F.when(is_steady(), F.col("duration_sec"))
    return epochs(history).groupBy("name", "epoch").agg(
        F.count(F.lit(1)).alias("refreshes"), F.count(steady).alias("steady_refreshes"),
        F.avg(steady).alias("avg_duration_sec"),
    )


def with_definition(history: DataFrame, versions: DataFrame) -> DataFrame:
    """Attach the definition each refresh ran with."""
    known = versions.select("name", F.col("valid_from").alias("graph_history_valid_from"), "query_text")
    return history.join(known, ["name", "graph_history_valid_from"], "left")


def lag_metrics(history: DataFrame, start: dt.datetime | None = None, as_of: dt.datetime | None = None) -> DataFrame:
    """Observed lag per table.

    Right after a successful refresh the lag is ``end - data timestamp``; it
    then grows by a second per second until the next success ends.  Over each
    such stretch the mean, the maximum and the time above target follow in
    closed form.  Stretches run between successive successes; the last one of a
    table ends at ``as_of``, and is left out without it, so that a table that
    has stopped refreshing only shows with ``as_of``.
    """
    done = history.where(normal_state("state") == "SUCCEEDED")
    if start is not None:
        done = done.where(F.col("data_timestamp") >= instant(start))
    rows = done.select("name", "query_id", "target_lag_sec", "data_timestamp", F.col("refresh_end_time").alias("_end"))
    rows = ordered_windows(rows, ["name"], ["_end", "query_id"], following={"_next": "_end"})
    if as_of is not None:
        rows = rows.withColumn("_next", F.coalesce("_next", F.when(instant(as_of) > F.col("_end"), instant(as_of))))
    low = seconds_between("data_timestamp", "_end")
    span = seconds_between("_end", "_next")
    stretches = rows.where(F.col("_next").isNotNull()).select(
        "name", "target_lag_sec", low.alias("low"), span.alias("span")
    )
    high = F.col("low") + F.col("span")
    above = F.greatest(F.lit(0), F.least(F.col("span"), high - F.col("target_lag_sec")))
    area = F.col("span") * (F.col("low") + high)
    total = F.sum("span")
    return stretches.groupBy("name").agg(
        F.when(total > 0, F.sum(area) / (F.lit(2) * total)).alias("mean_lag_sec"),
        F.max(high).alias("maximum_lag_sec"),
        F.sum(above).alias("time_above_target_lag_sec"),
        F.when(total > 0, (total - F.sum(above)) / total).alias("time_within_target_lag_ratio"),
    )


def compliance(ratio: Column | str) -> Column:
    ratio = F.col(ratio) if isinstance(ratio, str) else ratio
    return F.when(ratio >= GOAL_RATIO, "GOAL_MET").when(ratio >= HEALTHY_RATIO, "HEALTHY").otherwise("LATE")


def table_status(scheduling: str = "scheduling_state", last: str = "last_completed_refresh_state",
                 ratio: str = "time_within_target_lag_ratio", mode: str = "refresh_mode",
                 expected: str = "expected_mode") -> Column:
    """Worst of the checks on one table."""
    state = normal_state(last)
    critical = (F.col(scheduling) == "SUSPENDED") | state.isin("FAILED", "UPSTREAM_FAILED")
    warning = (
        state.isNull()  # never refreshed
        | (state == "CANCELED")
        | (F.col(ratio) < HEALTHY_RATIO)
        | ((F.col(mode) == "FULL") & (F.col(expected) == "INCREMENTAL"))
    )
    return F.when(critical, "CRITICAL").when(warning, "WARNING").otherwise("HEALTHY")


def severity(status: str = "status") -> Column:
    return F.when(F.col(status) == "CRITICAL", 2).when(F.col(status) == "WARNING", 1).otherwise(0)


def last_state(history: DataFrame) -> DataFrame:
    """The state of the newest completed refresh per table."""
    newest = F.max_by(normal_state("state"), F.struct("refresh_end_time", "query_id"))
    return history.groupBy("name").agg(
        newest.alias("last_completed_refresh_state"), F.max("data_timestamp").alias("latest_data_timestamp")
    )


def table_report(history: DataFrame, config: DataFrame, as_of: dt.datetime, days: int = 7) -> DataFrame:
    """One report row per configured table; tables without history stay in."""
    report = (
        config.join(last_state(history), "name", "left")
        .join(lag_metrics(history, as_of=as_of), "name", "left")
        .join(refresh_statistics(history, as_of, days), "name", "left")
    )
    return report.withColumn("status", table_status())


def group_report(report: DataFrame, members: DataFrame, depth: DataFrame) -> DataFrame:
    """One row per connected group of tables: worst status, counts, depth.

    ``members``: (node, component); ``depth``: (node, depth).  The group takes
    the name of its deepest table (the smallest name among equals).
    """
    rows = (
        report.select("name", "status")
        .join(members.select(F.col("node").alias("name"), "component"), "name")
        .join(depth.select(F.col("node").alias("name"), "depth"), "name", "left")
        .withColumn("_worst", severity())
    )
    worst = F.max("_worst")
    return rows.groupBy("component").agg(
        F.min_by("name", F.struct(-F.col("depth"), F.col("name"))).alias("leaf"),
        F.count(F.lit(1)).alias("tables"),
        F.max("depth").alias("depth"),
        F.count_if(F.col("status") == "HEALTHY").alias("healthy"),
        F.count_if(F.col("status") == "WARNING").alias("warning"),
        F.count_if(F.col("status") == "CRITICAL").alias("critical"),
        F.when(worst == 2, "CRITICAL").when(worst == 1, "WARNING").otherwise("HEALTHY").alias("status"),
    ).drop("component")


def suspended(history: DataFrame, failures: int = SUSPEND_AFTER) -> DataFrame:
    """Tables with a run of consecutive failures, and the longest such run.

    A run is what lies between two other outcomes: numbering the other outcomes
    gives every run a number of its own.
    """
    failed = F.when(F.col("state") == "FAILED", 0).otherwise(1).cast("bigint")
    rows = history.select("name", "refresh_start_time", "query_id", failed.alias("_ok"))
    runs = ordered_windows(rows, ["name"], ["refresh_start_time", "query_id"], totals={"_run": "_ok"})
    lengths = runs.where("_ok = 0").groupBy("name", "_run").agg(F.count(F.lit(1)).alias("n"))
    return lengths.groupBy("name").agg(F.max("n").alias("longest_run")).where(F.col("longest_run") >= failures)


def issue_route() -> Column:
    """Where to look first, by symptom."""
    return (
        F.when(F.col("scheduling_state") == "SUSPENDED", "SUSPENDED_TABLE")
        .when(normal_state("last_completed_refresh_state") == "UPSTREAM_FAILED", "UPSTREAM_FAILURE")
        .when((F.col("refresh_mode") == "FULL") & (F.col("expected_mode") == "INCREMENTAL"), "INCREMENTAL_NOT_SUPPORTED")
        .when(F.col("state_message").ilike("%change tracking%"), "CHANGE_TRACKING")
        .when(normal_state("last_completed_refresh_state") == "FAILED", "REFRESH_ERROR")
        .when(F.col("time_within_target_lag_ratio") < HEALTHY_RATIO, "TARGET_LAG_NOT_MET")
    )


def split_indicators(metrics: DataFrame) -> DataFrame:
    """Flags for tables worth splitting into stages; ``metrics`` holds the
    measured columns."""
    return metrics.withColumns({
        "long_refresh": F.col("avg_duration_sec") > F.col("target_lag_sec") * SPLIT_DURATION_SHARE,
        "many_joins": F.col("joins") > SPLIT_JOINS,
        "full_unexpected": (F.col("refresh_mode") == "FULL") & (F.col("expected_mode") == "INCREMENTAL"),
        "dominant_operator": F.col("max_operator_percent") > SPLIT_OPERATOR_PERCENT,
        "large_scan": F.col("gb_scanned") > SPLIT_SCAN_GB,
    })


def slow_operators(stats: DataFrame, query_id: str, k: int = SLOW_OPERATORS) -> DataFrame:
    """The operators of a query that take the largest share of its time."""
    return (
        stats.where(F.col("query_id") == query_id)
        .withColumn("bottleneck", F.col("overall_percentage") > BOTTLENECK_PERCENT)
        .orderBy(F.col("overall_percentage").desc(), "operator_id").limit(k)
    )


def io_summary(queries: DataFrame) -> DataFrame:
    """Scan and spill volumes per query."""
    gb = F.lit(1024 * 1024 * 1024)
    share = F.col("partitions_scanned") / F.nullif(F.col("partitions_total"), F.lit(0)) * 100
    return queries.select(
        "query_id", (F.col("total_elapsed_time") / 1000).alias("elapsed_sec"),
        (F.col("bytes_scanned") / gb).alias("gb_scanned"),
        F.round(share, 1).alias("partition_scan_pct"),
        (F.col("bytes_spilled_to_local_storage") / gb).alias("gb_spilled_local"),
        (F.col("bytes_spilled_to_remote_storage") / gb).alias("gb_spilled_remote"),
    )


def listing(states: DataFrame, limit: int, wanted: Column | None = None) -> DataFrame:
    """Tables by last state, worst first.  The limit comes before the caller's
    filter, so a small limit can hide rows the filter would have kept."""
    place = F.array_position(F.array(*map(F.lit, STATE_ORDER)), normal_state("last_completed_refresh_state"))
    first = states.orderBy(F.when(place > 0, place).otherwise(len(STATE_ORDER) + 1), "name").limit(limit)
    return first if wanted is None else first.where(wanted)


def with_issues(states: DataFrame) -> DataFrame:
    bad = normal_state("last_completed_refresh_state") != "SUCCEEDED"
    return states.where(bad | (F.col("time_within_target_lag_ratio") < HEALTHY_RATIO))


def changed_inputs(history: DataFrame) -> DataFrame:
    """Which inputs brought changes, and how many rows in total."""
    rows = history.select("name", F.explode("inputs_with_changed_data").alias("i"))
    return rows.groupBy("name", F.col("i.name").alias("input")).agg(
        F.count(F.lit(1)).alias("refreshes"), F.sum("i.rows").alias("changed_rows")
    )


def alert_runs(runs: DataFrame, alert: str, k: int = 10) -> DataFrame:
    """The latest evaluations of one alert."""
    return runs.where(F.col("name") == alert).orderBy(F.col("scheduled_time").desc(), "run_id").limit(k)


def refreshes_of(history: DataFrame, names: Sequence[str]) -> DataFrame:
    return history.where(F.col("name").isin(list(names)))
