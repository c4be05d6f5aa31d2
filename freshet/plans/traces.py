"""Trace spans of refresh cycles: who waited for whom, what broke first, and
where the time went.  All cycles are handled together; a single cycle is a
filter on ``data_timestamp``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import instant, seconds_between, value_map
from ..operators import graph as g
from ..session import cut_lineage

# Reasons for skipping a refresh, lowest priority first.
SKIP_REASONS = [
    "INPUTS_NOT_REFRESHED",
    "TABLE_NOT_FOUND",
    "RUNNING_INSTANCE",
    "NOT_EFFECTIVE_TICK_TO_REFRESH",
    "UPSTREAM_SKIP",
    "UPSTREAM_FAILURE",
]
# State -> style of a timeline bar.
STYLES = {"SUCCEEDED": "done", "SKIPPED": "active", "FAILED": "crit"}


def cycle(spans: DataFrame, data_timestamp: dt.datetime | None = None) -> DataFrame:
    """Spans with their duration, for one refresh cycle or for all."""
    rows = spans if data_timestamp is None else spans.where(
        F.col("data_timestamp") == instant(data_timestamp))
    return rows.withColumn("duration_sec", seconds_between("start_timestamp", "end_timestamp"))


def nearest(spans: DataFrame, name: str, start: dt.datetime, end: dt.datetime, k: int = 5) -> DataFrame:
    """The latest spans of one table within a time window."""
    inside = F.col("start_timestamp").between(instant(start), instant(end))
    return spans.where((F.col("name") == name) & inside).orderBy(F.col("start_timestamp").desc(), "span_id").limit(k)


def links(spans: DataFrame) -> DataFrame:
    """Edges between spans (child reads parent)."""
    return spans.select(F.col("span_id").alias("child"), F.explode("links.span_id").alias("parent"))


def upstream(spans: DataFrame) -> DataFrame:
    """Every span next to the spans it links to, as far as those are known."""
    parents = spans.select(
        F.col("span_id").alias("parent"), F.col("name").alias("upstream_name"),
        F.col("state").alias("upstream_state"), F.col("state_reason").alias("upstream_reason"))
    return links(spans).join(parents, "parent").select(
        F.col("child").alias("span_id"), "upstream_name", "upstream_state", "upstream_reason")


def unresolved(spans: DataFrame) -> DataFrame:
    """Links to spans that are not in the table, for example because the other
    end is recorded elsewhere."""
    known = spans.select(F.col("span_id").alias("parent"))
    return links(spans).join(known, "parent", "left_anti").select(F.col("child").alias("span_id"), F.col("parent").alias("missing"))


def affected(spans: DataFrame, start: DataFrame) -> DataFrame:
    """Spans that depend, directly or not, on the spans in ``start``."""
    reached = g.closure(links(spans), start.select(F.col("span_id").alias("node")), "downstream")
    return reached.where("depth > 0").withColumnRenamed("node", "span_id").join(
        spans.select("span_id", "name", "state", "state_reason"), "span_id")


def root_causes(spans: DataFrame) -> DataFrame:
    """For every span that did not succeed, the failed span behind it.

    Failures with a reason of their own start the search; the name of the
    smallest one is handed down through spans that did not succeed.
    """
    broken = spans.where("state <> 'SUCCEEDED'").select(F.col("span_id").alias("node"), "state", "state_reason")
    own = broken.where("state = 'FAILED' AND state_reason = 'QUERY_FAILURE'")
    found = g.spread_least(links(spans), own.select("node", F.col("node").alias("label")),
                           broken.join(own.select("node"), "node", "left_anti"))
    return broken.join(found, "node", "left").select(
        F.col("node").alias("span_id"), "state", F.col("label").alias("root_cause"))


def reason_rank(reason: Column | str) -> Column:
    reason = F.col(reason) if isinstance(reason, str) else reason
    return F.array_position(F.array(*map(F.lit, SKIP_REASONS)), reason)


def skip_reason(spans: DataFrame) -> DataFrame:
    """The reason each span would be skipped for: the highest one among its
    inputs.  Spans whose inputs are all fine do not appear."""
    reason = F.when(F.col("upstream_state") == "FAILED", "UPSTREAM_FAILURE").when(
        F.col("upstream_state") == "SKIPPED", F.when(F.col("upstream_reason") == "UPSTREAM_FAILURE", "UPSTREAM_FAILURE").otherwise("UPSTREAM_SKIP"))
    ranked = upstream(spans).withColumn("reason", reason).where(F.col("reason").isNotNull())
    return ranked.groupBy("span_id").agg(F.max_by("reason", reason_rank("reason")).alias("skip_reason"))


def slowest(spans: DataFrame, k: int = 10) -> DataFrame:
    return cycle(spans).where("state = 'SUCCEEDED'").orderBy(F.col("duration_sec").desc(), "span_id").limit(k)


def path_totals(spans: DataFrame) -> DataFrame:
    """Per span the longest summed duration from a root down to it."""
    weights = cycle(spans).select(F.col("span_id").alias("node"), F.col("duration_sec").alias("weight"))
    known = spans.select(F.col("span_id").alias("parent"))
    edges = links(spans).join(known, "parent", "left_semi")
    return g.longest_paths(edges, weights)


def critical_ends(spans: DataFrame) -> DataFrame:
    """Per cycle the span at which the critical path ends, with its length."""
    return _ends(spans, path_totals(spans))


def _ends(spans: DataFrame, totals: DataFrame) -> DataFrame:
    totals = totals.withColumnRenamed("node", "span_id").join(spans.select("span_id", "trace_id"), "span_id")
    # greatest total first, smallest span id among equals
    best = F.min_by(F.struct("span_id", "total"), F.struct(-F.col("total"), F.col("span_id")))
    return totals.groupBy("trace_id").agg(best.alias("b")).select("trace_id", "b.span_id", "b.total")


def critical_paths(spans: DataFrame) -> DataFrame:
    """The critical path of every cycle as rows: (trace_id, step, span_id,
    total), from the root (step 0) to the end; ``total`` is the time up to and
    including the span.  Among equally long ways the parent that sorts first is
    on the path."""
    totals = cut_lineage(path_totals(spans))
    ends = cut_lineage(_ends(spans, totals).select("trace_id", F.col("span_id").alias("end")))
    return g.paths_to(totals, ends).join(ends, "end").select("trace_id", "step", F.col("node").alias("span_id"), "total")


def timeline(spans: DataFrame) -> DataFrame:
    """Bars of a timeline: label, style, start, end; an empty span gets one
    second so that it can be seen."""
    label = F.concat(F.col("name"), F.lit(" ["), F.col("state"),
                     F.when(F.col("state") == "SKIPPED", F.concat(F.lit(" — "), F.coalesce("state_reason", F.lit("")))).otherwise(""),
                     F.lit("]"))
    style = value_map("state", STYLES)
    empty = F.col("start_timestamp") == F.col("end_timestamp")
    shown_end = F.when(empty, F.col("end_timestamp") + F.expr("INTERVAL 1 SECOND")).otherwise(F.col("end_timestamp"))
    return spans.select("trace_id", "span_id", label.alias("label"), style.alias("style"),
                        F.col("start_timestamp").alias("bar_start"), shown_end.alias("bar_end"))
