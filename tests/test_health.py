import datetime as dt

import pytest
from pyspark.sql import functions as F

from freshet.plans import health as h
from freshet.sources import schemas

DAY = dt.datetime(2026, 1, 1)


def refresh(i, state="SUCCEEDED", action="INCREMENTAL", trigger="SCHEDULED", minutes=None, seconds=10, name="t", target=600):
    start = DAY + dt.timedelta(minutes=10 * i if minutes is None else minutes)
    stats = '{"compilationTimeMs": 1500, "executionTimeMs": 500, "numInsertedRows": 7}'
    return (name, state, None, None, start, start + dt.timedelta(seconds=seconds), start, action, trigger, f"q{i:03d}", stats,
            target, DAY, None, None)


@pytest.fixture
def history(spark):
    return lambda rows: spark.createDataFrame(rows, schemas.REFRESH_HISTORY)


def test_statistics_leave_builds_out(history):
    df = history([refresh(0, action="FULL", trigger="CREATION", seconds=100), refresh(1), refresh(2, seconds=30),
                  refresh(3, action="NO_DATA", seconds=0), refresh(4, action="REINITIALIZE", seconds=50)])
    row = h.refresh_statistics(df, DAY + dt.timedelta(days=1)).first()
    assert (row.avg_duration_sec, row.max_duration_sec, row.avg_init_duration_sec) == (20, 30, 75)
    assert (row.total_refreshes, row.full_count, row.creation_count, row.no_data_count) == (5, 0, 1, 1)
    assert row.p95_duration_sec == pytest.approx(29)


def test_details_unpack_statistics(history):
    row = h.refresh_details(history([refresh(0)]), 5).first()
    assert (row.compilation_sec, row.execution_sec, row.rows_inserted, row.rows_deleted) == (1.5, 0.5, 7, None)


def test_spellings(spark):
    df = spark.createDataFrame([("SUCCESS",), ("CANCELLED",), ("UPSTREAM_FAILURE",), ("FAILED",)], "s string")
    assert [r[0] for r in df.select(h.normal_state("s")).collect()] == ["SUCCEEDED", "CANCELED", "UPSTREAM_FAILED", "FAILED"]


def test_lag_is_integrated_between_successes(history):
    # refreshes every 10 minutes lasting 10 s: lag runs from 10 s to 610 s
    rows = [refresh(0), refresh(1), refresh(2, state="FAILED"), refresh(3)]
    row = h.lag_metrics(history(rows)).first()
    # second stretch spans 20 minutes: up to 1210 s
    assert row.maximum_lag_sec == 1210
    assert row.time_above_target_lag_sec == 10 + 610
    assert row.mean_lag_sec == pytest.approx((310 * 600 + 610 * 1200) / 1800)
    assert row.time_within_target_lag_ratio == pytest.approx((1800 - 620) / 1800)


def test_epochs_and_failures_in_a_row(history):
    rows = [refresh(0, trigger="CREATION"), refresh(1), refresh(2, action="REINITIALIZE")] + [
        refresh(i, state="FAILED") for i in range(3, 8)] + [refresh(8)]
    df = history(rows)
    assert [r.epoch for r in h.epochs(df).orderBy("query_id").collect()] == [1, 1] + [2] * 7
    assert [tuple(r) for r in h.suspended(df).collect()] == [("t", 5)]
    assert h.suspended(history(rows[:7] + rows[8:])).count() == 0


def test_status_takes_the_worst(spark):
    df = spark.createDataFrame([
        ("a", "SUSPENDED", "SUCCEEDED", 1.0, "INCREMENTAL", "INCREMENTAL"), ("b", "ACTIVE", "UPSTREAM_FAILURE", 1.0, "FULL", "FULL"),
        ("c", "ACTIVE", "CANCELLED", 1.0, "FULL", "FULL"), ("d", "ACTIVE", "SUCCEEDED", 0.89, "FULL", "FULL"),
        ("e", "ACTIVE", "SKIPPED", 0.9, "FULL", "FULL"), ("f", "ACTIVE", "SUCCEEDED", 0.99, "FULL", "INCREMENTAL")],
        "name string, scheduling_state string, last_completed_refresh_state string, time_within_target_lag_ratio double, refresh_mode string, expected_mode string")
    got = {r.name: r.status for r in df.withColumn("status", h.table_status()).collect()}
    assert got == {"a": "CRITICAL", "b": "CRITICAL", "c": "WARNING", "d": "WARNING", "e": "HEALTHY", "f": "WARNING"}
    report = df.withColumn("status", h.table_status())
    members = spark.createDataFrame([(n, "a" if n in "abc" else "d") for n in "abcdef"], "node string, component string")
    depth = spark.createDataFrame([(n, i) for i, n in enumerate("abcdef")], "node string, depth long")
    pipes = {r.leaf: r for r in h.group_report(report, members, depth).collect()}
    assert pipes["c"].status == "CRITICAL" and pipes["f"].status == "WARNING"
    assert all(r.healthy + r.warning + r.critical == r.tables for r in pipes.values())


def test_listing_limits_before_it_filters(spark):
    df = spark.createDataFrame([("a", "SUCCEEDED"), ("b", "FAILED"), ("c", "SKIPPED")], "name string, last_completed_refresh_state string")
    assert [r.name for r in h.listing(df, 2).collect()] == ["b", "c"]
    assert h.listing(df, 2, F.col("last_completed_refresh_state") == "SUCCEEDED").count() == 0


def test_open_stretch_counts_up_to_the_reporting_time(spark, history):
    rows = [refresh(0), refresh(1)]
    end = max(r.refresh_end_time for r in history(rows).collect())
    late = h.lag_metrics(history(rows), as_of=end + dt.timedelta(hours=10)).first()
    assert late.maximum_lag_sec == 36010 and late.time_within_target_lag_ratio < 0.1
    assert h.lag_metrics(history(rows[:1])).count() == 0
    assert h.lag_metrics(history(rows[:1]), as_of=end).count() == 1
    never = spark.createDataFrame([("ACTIVE", None, None, "FULL", "FULL")],
                                  "scheduling_state string, last_completed_refresh_state string, time_within_target_lag_ratio double, refresh_mode string, expected_mode string")
    assert never.select(h.table_status()).first()[0] == "WARNING"
