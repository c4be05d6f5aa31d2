"""Joins and set operations with semantics worth a name of their own.

Joins carry no strategy hints: Spark broadcasts a side only after checking its
size, and AQE splits hot keys of the sort-merge joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .windows import null_safe_join


def anti(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``left`` without a partner.  Unlike EXCEPT it keeps duplicates
    and rows with a NULL key."""
    return left.join(right.select(*on), list(on), "left_anti")


def full_outer_as_union(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """FULL OUTER JOIN as a left join plus the unmatched right rows.

    Both halves let AQE split a hot key, which a full outer join does not.
    """
    matched = left.join(right, list(on), "left")
    unmatched = anti(right, left, on)
    return matched.unionByName(unmatched, allowMissingColumns=True)


def natural_join(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on all columns the two tables share by name."""
    shared = [c for c in left.columns if c in set(right.columns)]
    if not shared:
        raise ValueError("the tables share no column")
    return left.join(right, shared, how)


def join_back(conformed: DataFrame, landing: dict[str, tuple[DataFrame, str, list[str]]]) -> DataFrame:
    """Bring source-only columns back to conformed rows.

    ``landing``: source tag -> (landing table, its id column, columns wanted).
    The landing rows of all sources form one narrow table, so the conformed
    table is joined once on (invoice_id, source_system).
    """
    parts = [
        df.select(F.col(id_column).alias("invoice_id"), F.lit(tag).alias("source_system"), *wanted)
        for tag, (df, id_column, wanted) in landing.items()
    ]
    extra = parts[0]
    for part in parts[1:]:
        extra = extra.unionByName(part, allowMissingColumns=True)
    return conformed.join(extra, ["invoice_id", "source_system"], "left")


def recent(df: DataFrame, date_column: str, days: int) -> DataFrame:
    """Rows of the last ``days`` days counted from the newest date present."""
    newest = df.agg(F.max(date_column)).scalar()
    return df.where(F.col(date_column) >= F.date_sub(newest, days))


def table_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that differ between two tables, with how often and on which side.

    One aggregation over the tagged union: equal rows cancel out (duplicates
    and NULLs included) and most cancel inside the map tasks.
    """
    columns = left.columns
    tagged = left.withColumn("_n", F.lit(1)).unionByName(
        right.select(*columns).withColumn("_n", F.lit(-1))
    )
    return (
        tagged.groupBy(*columns)
        .agg(F.sum("_n").alias("_n"))
        .where(F.col("_n") != 0)
        .withColumn("side", F.when(F.col("_n") > 0, "only_left").otherwise("only_right"))
        .withColumn("copies", F.abs("_n"))
        .drop("_n")
    )


def semi_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key occurs in ``right``, NULL matching NULL."""
    return null_safe_join(left, right.select(*on), on, "left_semi")


def anti_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key does not occur in ``right``, NULL matching NULL."""
    return null_safe_join(left, right.select(*on), on, "left_anti")


