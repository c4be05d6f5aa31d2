"""Keeping a stored result up to date from change sets.

Every function maps (old state, change set) to a new state or to the change set
of the result.  Work is proportional to the change wherever the operator allows
it; where it does not (windows, outer joins, deletions below MIN and MAX) the
touched keys are recomputed and replaced, and no others.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .changes import META, data_columns, from_weights, weight
from .relational import anti_null_safe, semi_null_safe
from .windows import null_safe_join


# --- operators that pass changes through ---------------------------------

def delta_select(change_set: DataFrame, where: Column | None = None, select: Sequence[Column | str] = ("*",)) -> DataFrame:
    """Filter and projection of the result, from the changes alone."""
    kept = change_set if where is None else change_set.where(where)
    if list(select) == ["*"]:
        return kept
    return kept.select(*select, *META)


def delta_union(*change_sets: DataFrame) -> DataFrame:
    """UNION ALL: the changes of the branches side by side."""
    result = change_sets[0]
    for change_set in change_sets[1:]:
        result = result.unionByName(change_set)
    return result


# --- joins ----------------------------------------------------------------

def _weighted(df: DataFrame, name: str) -> DataFrame:
    if "_action" in df.columns:
        return df.select(*data_columns(df), weight().alias(name))
    return df.withColumn(name, F.lit(1).cast("bigint"))


def delta_join(a_old: DataFrame, b_old: DataFrame, a_changes: DataFrame, b_changes: DataFrame, on: Sequence[str]) -> DataFrame:
    """Change set of an inner join: dA x B_new plus A_old x dB.

    Each product has a change set on one side; one that was stored by
    ``cut_lineage`` and is small is broadcast, and the big tables stay in place.  Weights multiply, which turns a deletion
    meeting a deletion into the right sign.
    """
    on = list(on)
    da, db = _weighted(a_changes, "_wa"), _weighted(b_changes, "_wb")
    b_new = _weighted(b_old, "_wb").unionByName(db)
    parts = da.join(b_new, on).unionByName(_weighted(a_old, "_wa").join(db, on))
    return from_weights(parts.withColumn("_w", F.col("_wa") * F.col("_wb")).drop("_wa", "_wb"))


def recompute_touched(
    state: DataFrame, keys: Sequence[str], change_sets: Sequence[DataFrame],
    sources: Sequence[DataFrame], compute: Callable[..., DataFrame],
) -> DataFrame:
    """Replace the rows of every key the changes mention.

    ``compute`` gets the new source tables cut down to those keys.  Exact for
    any result in which a key depends on the source rows of that key only:
    windows per partition, outer equi-joins, MIN and MAX below deletions.
    """
    touched = change_sets[0].select(*keys)
    for change_set in change_sets[1:]:
        touched = touched.unionByName(change_set.select(*keys))
    touched = touched.distinct()
    again = compute(*[semi_null_safe(source, touched, keys) for source in sources])
    return anti_null_safe(state, touched, keys).unionByName(again.select(*state.columns))


def delta_outer_join(
    state: DataFrame, a_new: DataFrame, b_new: DataFrame, a_changes: DataFrame, b_changes: DataFrame,
    on: Sequence[str], how: str = "left",
) -> DataFrame:
    """New contents of an outer equi-join."""
    return recompute_touched(
        state, on, [a_changes, b_changes], [a_new, b_new], lambda a, b: a.join(b, list(on), how)
    )


def delta_window(
    state: DataFrame, new_source: DataFrame, change_set: DataFrame, keys: Sequence[str],
    compute: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """New contents of a window result, partitioned by ``keys``."""
    return recompute_touched(state, keys, [change_set], [new_source], compute)


# --- aggregates -------------------------------------------------------------

def agg_state(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """State of GROUP BY with COUNT, SUM and AVG: rows, and per value the sum
    and the number of non-NULL inputs.

    Floating-point sums are refused: what was added to them cannot be taken off
    again exactly, and never if it was NaN or infinite.  Cast to DECIMAL, or
    use ``recompute_touched``.
    """
    kinds = dict(df.dtypes)
    floating = [v for v in values if kinds[v] in ("float", "double")]
    if floating:
        raise TypeError(f"sums of {floating} cannot be maintained in floating point")
    return _partial(df.withColumn("_w", F.lit(1).cast("bigint")), keys, values)


def _partial(weighted: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    measures = [F.sum("_w").alias("row_count")]
    for v in values:
        measures.append(F.sum(F.col(v) * F.col("_w")).alias(f"sum_{v}"))
        measures.append(F.sum(F.when(F.col(v).isNotNull(), F.col("_w")).otherwise(0)).alias(f"n_{v}"))
    return weighted.groupBy(*keys).agg(*measures)


def delta_agg(state: DataFrame, change_set: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Add the signed partial sums of the changes to the state.

    State and change are stacked and summed, which matches NULL groups and
    needs no outer join.  A group with no rows left is dropped.
    """
    delta = _partial(_weighted(change_set, "_w"), keys, values)
    measures = [F.sum(c).cast(state.schema[c].dataType).alias(c) for c in state.columns if c not in keys]
    stacked = state.unionByName(delta.select(*[F.col(c).cast(state.schema[c].dataType) for c in state.columns]))
    return stacked.groupBy(*keys).agg(*measures).where(F.col("row_count") > 0)


def agg_result(state: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """COUNT, SUM and AVG read off the state; no non-NULL input gives NULL."""
    out = [F.col("row_count")]
    for v in values:
        some = F.col(f"n_{v}") > 0
        out.append(F.when(some, F.col(f"sum_{v}")).alias(f"sum_{v}"))
        out.append(F.when(some, F.col(f"sum_{v}").cast("double") / F.col(f"n_{v}").cast("double")).alias(f"avg_{v}"))
    return state.select(*keys, *out)


def minmax_state(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """State of GROUP BY with MIN and MAX: rows, lowest and highest value."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"), F.min(value).alias("low"), F.max(value).alias("high"))


def delta_minmax(state: DataFrame, change_set: DataFrame, new_source: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """New MIN and MAX per group.

    Insertions can only widen a range and are folded in.  Only a deletion that
    reaches the stored minimum or maximum makes its group look at the source.
    Rows are counted, so a group goes with its last row, also if all its values
    were NULL.
    """
    def part(action: str) -> DataFrame:
        return change_set.where(F.col("_action") == action).groupBy(*keys).agg(
            F.sum("_copies").alias("row_count"), F.min(value).alias("low"), F.max(value).alias("high"))

    gone = part("DELETE").withColumnsRenamed({"low": "_low", "high": "_high", "row_count": "_rows"})
    at_edge = (
        null_safe_join(state, gone, keys, "inner")
        .where((F.col("_low") <= F.col("low")) | (F.col("_high") >= F.col("high")))
        .select(*keys)
    )
    kind = state.schema["low"].dataType
    fewer = gone.select(*keys, (-F.col("_rows")).alias("row_count"), F.lit(None).cast(kind).alias("low"), F.lit(None).cast(kind).alias("high"))
    widened = state.unionByName(part("INSERT")).unionByName(fewer).groupBy(*keys).agg(
        F.sum("row_count").alias("row_count"), F.min("low").alias("low"), F.max("high").alias("high")).where("row_count > 0")
    again = minmax_state(semi_null_safe(new_source, at_edge, keys), keys, value)
    return anti_null_safe(widened, at_edge, keys).unionByName(again)


def delta_distinct(state: DataFrame, change_set: DataFrame, count: str = "_copies") -> DataFrame:
    """DISTINCT kept as value -> number of rows; a value goes when its last
    row does."""
    columns = data_columns(change_set)
    stacked = state.select(*columns, count).unionByName(change_set.select(*columns, weight().alias(count)))
    return stacked.groupBy(*columns).agg(F.sum(count).alias(count)).where(F.col(count) > 0)


# --- top-k board ------------------------------------------------------------

def _board(candidates: DataFrame, key: str, score: str, k: int) -> DataFrame:
    """Rank the best ``k``; only those k rows (a top-k report) are ranked in
    one task."""
    best = candidates.orderBy(F.col(score).desc(), F.col(key)).limit(k)
    place = F.row_number().over(_one_task().orderBy(F.col(score).desc(), F.col(key)))
    return best.select(key, score, place.alias("rank"))


def _one_task():
    from pyspark.sql import Window

    return Window.partitionBy(F.lit(0))


def topk(state: DataFrame, change_set: DataFrame, key: str, score: str, k: int, source: DataFrame | None = None) -> DataFrame:
    """Maintain a board of the ``k`` best rows: (key, score, rank).

    Without ``source`` only the stored leaders and the inserted or updated rows
    are ranked.  That is cheap, but a player outside the board never comes back
    when a leader drops or is deleted.  With ``source`` the board is recomputed
    from the table whenever that can happen, which makes it exact.
    """
    arrived = change_set.where(F.col("_action") == "INSERT").select(key, score)
    if source is not None:
        lost = state.join(change_set.where(F.col("_action") == "DELETE").select(key), key, "left_semi")
        lowered = lost.alias("o").join(arrived.alias("n"), key, "left").where(
            F.col(f"n.{score}").isNull() | (F.col(f"n.{score}") < F.col(f"o.{score}"))
        )
        if not lowered.isEmpty():
            return _board(source, key, score, k)
    stayed = state.select(key, score).join(arrived, key, "left_anti")
    if source is not None:
        deleted = change_set.where((F.col("_action") == "DELETE") & ~F.col("_is_update")).select(key)
        stayed = stayed.join(deleted, key, "left_anti")
    return _board(stayed.unionByName(arrived), key, score, k)


def topk_initial(source: DataFrame, key: str, score: str, k: int) -> DataFrame:
    return _board(source, key, score, k)


# --- frozen regions -----------------------------------------------------------

def frozen(predicate: Column) -> Column:
    """A NULL predicate counts as not frozen."""
    return F.coalesce(predicate, F.lit(False))


def refresh_frozen(
    old: DataFrame, source: DataFrame, compute: Callable[[DataFrame], DataFrame], predicate: Column,
) -> DataFrame:
    """Keep the result rows inside the frozen region and recompute the rest.

    The predicate is applied to the source first, so it reaches the scan and
    frozen partitions are not read again.  It must be expressible over both the
    result and the source columns.
    """
    return old.where(frozen(predicate)).unionByName(compute(source.where(~frozen(predicate))).select(*old.columns))


# --- enrichment ----------------------------------------------------------------

def enrich_static(new_rows: DataFrame, dimension: DataFrame, on: Sequence[str] | Column, how: str = "left") -> DataFrame:
    """New rows joined to a dimension as it is now; later dimension changes do
    not rewrite rows already stored."""
    return new_rows.join(dimension, on if isinstance(on, Column) else list(on), how)


def signed_sum(change_set: DataFrame, measures: Mapping[str, str], keys: Sequence[str]) -> DataFrame:
    """Signed totals of a change set, for reports on what a refresh moved."""
    w = weight()
    return change_set.groupBy(*keys).agg(
        *[F.sum(F.col(column) * w).alias(name) for name, column in measures.items()]
    )
