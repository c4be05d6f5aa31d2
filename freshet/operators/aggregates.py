"""Aggregations that take more than one ``groupBy``."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.generators import date_spine
from .windows import null_safe_join, ordered_windows


def zero_filled_daily(
    facts: DataFrame, date_column: str, value: str, start: dt.date, end: dt.date,
    where: Column | None = None, name: str = "daily_total",
) -> DataFrame:
    """Daily totals with a row for every day, zero where nothing happened.

    Facts are filtered and summed per day before they meet the spine, so the
    join handles one row per day whatever the size of the facts.
    """
    kept = facts if where is None else facts.where(where)
    daily = (
        kept.where(F.col(date_column).cast("date").between(F.lit(start), F.lit(end)))
        .groupBy(F.col(date_column).cast("date").alias("day"))
        .agg(F.sum(value).alias(name))
    )
    spine = date_spine(facts.sparkSession, start, end, "day")
    return spine.join(daily, "day", "left").withColumn(name, F.zeroifnull(name))


def two_stage(
    df: DataFrame, fine: Mapping[str, Column], coarse: Mapping[str, Column], value: str,
    distinct: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """A fine rollup, and a coarse one computed from the fine one alone.

    The fine table carries sums, row counts and non-NULL counts, so coarse
    averages stay exact.  A distinct count cannot be added up; the fine grain
    therefore includes the counted column, and the coarse stage counts it.
    """
    grain = {**fine, **({distinct: F.col(distinct)} if distinct else {})}
    daily = df.groupBy(*[expr.alias(name) for name, expr in grain.items()]).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(value).alias("value_rows"),
        F.sum(value).alias("total"),
    )
    measures = [
        F.sum("rows").alias("rows"),
        F.sum("total").alias("total"),
        (F.sum("total").cast("double") / F.sum("value_rows").cast("double")).alias("average"),
    ]
    if distinct:
        measures.append(F.countDistinct(distinct).alias(f"distinct_{distinct}"))
    monthly = daily.groupBy(*[expr.alias(name) for name, expr in coarse.items()]).agg(*measures)
    return daily, monthly


def percentiles(
    df: DataFrame, keys: Sequence[str], value: Column, shares: Mapping[str, float],
) -> DataFrame:
    """Exact interpolated percentiles per key; NULL values do not count.

    Equal values are counted first, the counts are summed up over even ranges of
    the order, and the one or two values at each rank are picked out, so no task
    holds the values of a key.  Runs one job when called (``ordered_windows``).
    """
    keys = list(keys)
    counted = (
        df.select(*keys, value.alias("_value")).where(F.col("_value").isNotNull())
        .groupBy(*keys, "_value").agg(F.count(F.lit(1)).alias("_n"))
    )
    ranked = ordered_windows(counted, keys, ["_value"], totals={"_upto": "_n"})
    whole = counted.groupBy(*keys).agg(F.sum("_n").alias("_whole"))
    placed = null_safe_join(ranked, whole, keys, "inner") if keys else ranked.withColumn("_whole", whole.scalar())

    return interpolated(placed, keys, shares)


def interpolated(placed: DataFrame, keys: Sequence[str], shares: Mapping[str, float]) -> DataFrame:
    """Percentiles from counted values: ``_value``, its rows ``_n``, the rows
    ``_upto`` and including it, and the rows ``_whole`` of its key.  Values at
    no rank that is asked for may be missing."""
    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("_upto") - F.col("_n") <= rank) & (rank < F.col("_upto")), F.col("_value").cast("double")))

    found = []
    for name, share in shares.items():
        place = F.lit(share) * (F.col("_whole") - 1)
        found += [at(F.floor(place)).alias(f"_low_{name}"), at(F.ceil(place)).alias(f"_high_{name}"),
                  F.max(place - F.floor(place)).alias(f"_part_{name}")]
    return placed.groupBy(*keys).agg(*found).select(*keys, *[
        (F.col(f"_low_{n}") + (F.col(f"_high_{n}") - F.col(f"_low_{n}")) * F.col(f"_part_{n}")).alias(n) for n in shares])


def distinct_values(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """ARRAY_AGG(DISTINCT value) per key, sorted, without NULLs.

    Duplicates go in a first aggregation, so the array holds what the result
    needs and nothing more.
    """
    return (
        df.select(*keys, value).where(F.col(value).isNotNull()).distinct()
        .groupBy(*keys).agg(F.array_sort(F.collect_list(value)).alias(name))
    )


def distinct_elements(df: DataFrame, keys: Sequence[str], arrays: str, name: str) -> DataFrame:
    """How many different elements the arrays of a key hold together.

    Exploded and counted instead of gathered, so no array grows with the key.
    """
    return df.select(*keys, F.explode(arrays).alias("_e")).groupBy(*keys).agg(F.countDistinct("_e").alias(name))


def first_names(df: DataFrame, column: str, limit: int, separator: str = ", ") -> DataFrame:
    """The first ``limit`` values in order, as one text (a top-k report)."""
    return (
        df.select(column).orderBy(column).limit(limit)
        .agg(F.array_join(F.array_sort(F.collect_list(column)), separator).alias("names"))
    )
