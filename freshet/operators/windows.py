"""Ordered work per key that does not depend on any key being small.

A plain window puts all rows of one key into one task.  Two ways around that:

* keeping a few rows per key (``keep_latest``, ``top_per_key``) is written so
  that Spark trims every key inside each map task first (WindowGroupLimit);
* running totals, row numbers, lag and lead (``ordered_windows``) work on even
  ranges of the total order, so a hot key is spread over many tasks, and carry
  one small row per range border from range to range.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

# monotonically_increasing_id keeps the partition number above bit 33.
_PARTITION_SHIFT = 33


def _columns(names: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in names]


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows of every key; NULL keys form one key."""
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(ranked)).where(F.col("_rank") <= k).drop("_rank")


def keep_latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``order`` (for example newest first).

    End ``order`` with a unique column, otherwise ties are decided by chance.
    """
    return top_per_key(df, keys, order, 1)


def ordered_windows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    totals: Mapping[str, Column | str] | None = None,
    previous: Mapping[str, str] | None = None,
    following: Mapping[str, str] | None = None,
) -> DataFrame:
    """Running totals, lag and lead per key over a total order.

    ``totals``: new column -> value to sum up to and including the row.
    ``previous`` / ``following``: new column -> column taken from the row
    before / after.  ``order`` must end with a unique column.  Empty ``keys``
    order the whole table.

    Rows are range partitioned by (keys, order) and written once, because the
    sampled range bounds may not differ between the passes below.  Only a key
    standing at a range border can continue in the next range, so at most two
    rows per range are carried over.  Rows are partitioned by (range, key) for the
    windows, which is what the join with the borders needs as well.
    """
    totals, previous, following = dict(totals or {}), dict(previous or {}), dict(following or {})
    line = _columns(keys) + _columns(order)
    key = F.struct(*keys) if keys else F.lit(0)
    placed = cut_lineage(
        df.repartitionByRange(*line)
        .sortWithinPartitions(*line)
        .withColumn("_at", F.monotonically_increasing_id())
    ).withColumns({"_range": F.shiftright("_at", _PARTITION_SHIFT), "_key": key})

    run = Window.partitionBy("_range", "_key").orderBy("_at")
    upto = run.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = {f"_sum_{n}": F.sum(v).over(upto) for n, v in totals.items()}
    local |= {f"_before_{n}": F.lag(c).over(run) for n, c in previous.items()}
    local |= {f"_after_{n}": F.lead(c).over(run) for n, c in following.items()}
    if previous:
        local["_first"] = F.lag("_at").over(run).isNull()
    if following:
        local["_last"] = F.lead("_at").over(run).isNull()

    at_border = (
        placed.groupBy("_range")
        .agg(F.min_by("_key", "_at").alias("low"), F.max_by("_key", "_at").alias("high"))
        .select("_range", F.explode(F.array_distinct(F.array("low", "high"))).alias("_key"))
    )
    measures = [F.sum(v).alias(f"_sum_{n}") for n, v in totals.items()]
    measures += [F.max_by(F.struct(F.col(c)), "_at").alias(f"_end_{n}") for n, c in previous.items()]
    measures += [F.min_by(F.struct(F.col(c)), "_at").alias(f"_start_{n}") for n, c in following.items()]
    across = Window.partitionBy("_key").orderBy("_range")
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    carried = [F.sum(f"_sum_{n}").over(earlier).alias(f"_carry_{n}") for n in totals]
    carried += [F.lag(f"_end_{n}").over(across)[c].alias(f"_carry_{n}") for n, c in previous.items()]
    carried += [F.lead(f"_start_{n}").over(across)[c].alias(f"_carry_{n}") for n, c in following.items()]
    borders = (
        placed.join(at_border, ["_range", "_key"], "left_semi")
        .groupBy("_range", "_key")
        .agg(*measures)
        .select("_range", "_key", *carried)
    )

    joined = placed.withColumns(local).join(borders, ["_range", "_key"], "left")
    result = [F.col(c) for c in df.columns]
    for n in totals:
        both = F.coalesce(F.col(f"_carry_{n}") + F.col(f"_sum_{n}"), F.col(f"_sum_{n}"), F.col(f"_carry_{n}"))
        result.append(both.alias(n))
    for n in previous:
        result.append(F.when(F.col("_first"), F.col(f"_carry_{n}")).otherwise(F.col(f"_before_{n}")).alias(n))
    for n in following:
        result.append(F.when(F.col("_last"), F.col(f"_carry_{n}")).otherwise(F.col(f"_after_{n}")).alias(n))
    return joined.select(*result)


def row_numbers(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], name: str = "row_number") -> DataFrame:
    """Position of every row within its key; with no keys, within the table."""
    return ordered_windows(df, keys, order, totals={name: F.lit(1).cast("bigint")})


def ranks(df: DataFrame, keys: Sequence[str], value: str, descending: bool = True, name: str = "rank") -> DataFrame:
    """RANK with gaps.

    Ties share a rank, so ranks are worked out on the distinct values with
    their counts (pre-aggregated in the map tasks) and joined back.
    """
    counted = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_ties"))
    order = F.col(value).desc() if descending else F.col(value).asc()
    ranked = ordered_windows(counted, keys, [order], totals={"_upto": "_ties"}).select(
        *keys, value, (F.col("_upto") - F.col("_ties") + 1).alias(name)
    )
    return null_safe_join(df, ranked, [*keys, value], "left")


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Equi-join in which NULL matches NULL; the key columns of ``right`` are
    dropped.  Spark plans it as an ordinary hash or sort-merge join."""
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
    condition = None
    for c in on:
        part = F.col(c).eqNullSafe(F.col(f"_r_{c}"))
        condition = part if condition is None else condition & part
    joined = left.join(renamed, condition, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_r_{c}" for c in on])
