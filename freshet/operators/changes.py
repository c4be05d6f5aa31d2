"""Change sets: how one version of a table differs from another.

A change set has the columns of the table plus

* ``_action``     INSERT or DELETE,
* ``_is_update``  True for both halves of an updated row,
* ``_copies``     how many equal rows the entry stands for.

Keeping equal rows as one entry with a count makes bag semantics cheap: a table
of which a third are copies of one row costs one entry, not millions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .windows import null_safe_join

META = ("_action", "_is_update", "_copies")


def data_columns(change_set: DataFrame) -> list[str]:
    return [c for c in change_set.columns if c not in META]


def weight() -> Column:
    """Signed number of rows an entry stands for."""
    return F.when(F.col("_action") == "INSERT", F.col("_copies")).otherwise(-F.col("_copies"))


def from_weights(weighted: DataFrame, name: str = "_w") -> DataFrame:
    """Net a table of rows with signed weights into a change set without
    update marks."""
    columns = [c for c in weighted.columns if c != name]
    return (
        weighted.groupBy(*columns).agg(F.sum(name).alias(name)).where(F.col(name) != 0)
        .select(
            *columns,
            F.when(F.col(name) > 0, "INSERT").otherwise("DELETE").alias("_action"),
            F.lit(False).alias("_is_update"),
            F.abs(name).cast("bigint").alias("_copies"),
        )
    )


def _mark_updates(net: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A key with both a DELETE and an INSERT left is an update."""
    added = F.when(F.col("_action") == "INSERT", 1).otherwise(0)
    both = (
        net.groupBy(*keys)
        .agg(F.min(added).alias("_low"), F.max(added).alias("_high"))
        .where(F.col("_low") != F.col("_high"))
        .select(*keys, F.lit(True).alias("_hit"))
    )
    marked = null_safe_join(net.drop("_is_update"), both, keys, "left")
    return marked.withColumn("_is_update", F.coalesce("_hit", F.lit(False))).drop("_hit").select(
        *data_columns(net), *META
    )


def changes(old: DataFrame, new: DataFrame, keys: Sequence[str] | None = None, append_only: bool = False) -> DataFrame:
    """The change set leading from ``old`` to ``new``.

    Old rows count -1 and new rows +1; whatever does not cancel has changed.
    The two versions are compared once and the rows that differ are written to
    the shared folder: marking updates and everything a refresh does with the
    change set reads those rows, not the versions again.  With ``append_only`` the rows of ``new`` whose
    key is not in ``old`` are returned without metadata.
    """
    if append_only:
        if not keys:
            raise ValueError("append_only needs keys")
        return null_safe_join(new, old.select(*keys), keys, "left_anti")
    columns = new.columns
    net = cut_lineage(from_weights(
        new.withColumn("_w", F.lit(1)).unionByName(old.select(*columns).withColumn("_w", F.lit(-1)))
    ))
    return _mark_updates(net, keys) if keys else net


def net_changes(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Net a log of changes: a delete and a reinsert of the same row within
    the window cancel out, as they do for a table with a declared key."""
    columns = data_columns(log)
    return _mark_updates(cut_lineage(from_weights(log.select(*columns, weight().alias("_w")))), keys)


def true_deletes(change_set: DataFrame) -> DataFrame:
    """Rows that are gone, not the old halves of updates."""
    kept = change_set.where(~F.col("_is_update") & (F.col("_action") == "DELETE"))
    return kept.drop("_action", "_is_update")


def audit_rows(change_set: DataFrame, version: int) -> DataFrame:
    """Every change as a log row; the log is only ever appended to."""
    return change_set.withColumn("_version", F.lit(version).cast("bigint"))


def apply_changes(state: DataFrame, change_set: DataFrame, keys: Sequence[str]) -> DataFrame:
    """New contents of a table with unique keys.

    The state meets only the keys of the change set, which Spark broadcasts
    when they are few; then no state row is shuffled.
    """
    columns = state.columns
    inserted = change_set.where(F.col("_action") == "INSERT").select(*columns)
    touched = change_set.select(*keys).distinct()
    return null_safe_join(state, touched, keys, "left_anti").unionByName(inserted)


def apply_to_bag(counted: DataFrame, change_set: DataFrame, count: str = "_copies") -> DataFrame:
    """New contents of a table without keys, kept as rows with a count."""
    columns = data_columns(change_set)
    signed = counted.select(*columns, F.col(count).alias("_w")).unionByName(
        change_set.select(*columns, weight().alias("_w"))
    )
    return signed.groupBy(*columns).agg(F.sum("_w").alias(count)).where(F.col(count) > 0)


def as_bag(df: DataFrame, count: str = "_copies") -> DataFrame:
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(count))
