"""Alerts over refresh events.  An alert ends as a row in a table; sending it
on is somebody else's job."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import instant
from ..operators.aggregates import first_names
from .files import run_available

# Which refresh states each log level captures.
LEVELS = {
    "ERROR": ["FAILED"],
    "WARN": ["FAILED", "UPSTREAM_FAILED"],
    "INFO": ["FAILED", "UPSTREAM_FAILED", "SUCCEEDED", "SKIPPED", "CANCELED"],
}
# Fixed value: an alert names at most this many tables; the count is complete.
NAMES_IN_ALERT = 10


def at_level(level: str, state: str = "state") -> Column:
    return F.col(state).isin(LEVELS[level])


def alert_message(events: DataFrame, text: str) -> DataFrame:
    """At most one row: how many events, and the first names in order.  No
    events, no row."""
    counted = events.agg(F.count(F.lit(1)).alias("event_count"))
    names = first_names(events.select("name").distinct(), "name", NAMES_IN_ALERT)
    return counted.where("event_count > 0").select(
        "event_count", F.concat(F.lit(text), names.scalar()).alias("message")
    )


def recent_failures(events: DataFrame, as_of: dt.datetime, minutes: int = 5, level: str = "ERROR") -> DataFrame:
    """Scheduled form: look back a fixed time from ``as_of`` (UTC)."""
    since = instant(as_of) - F.make_dt_interval(mins=F.lit(minutes))
    upto = F.col("timestamp") <= instant(as_of)
    return events.where(at_level(level) & (F.col("timestamp") > since) & upto)


def upstream_failures(events: DataFrame) -> DataFrame:
    return events.where(F.col("state") == "UPSTREAM_FAILED")


def alert_on_new(stream: DataFrame, path: str, checkpoint: str, level: str = "ERROR",
                 text: str = "The following tables failed to refresh: ") -> None:
    """Streaming form: each batch of new events gives at most one alert row."""

    def handle(batch: DataFrame, name: str, batch_id: int) -> None:
        message = alert_message(batch.where(at_level(level)), text)
        message.write.mode("overwrite").parquet(f"{path}/batch={name}")

    run_available(stream, handle, checkpoint)
