"""Distinct counts that add up: bitmaps of ids as state, kept up from changes.

A count of different ids can't be summed over days or regions; a bitmap of the
ids can be ORed.  Ids are cut into buckets of 32,768 consecutive numbers, one
bitmap of 4 KB per group and bucket, so a group with any number of ids is spread
over many rows and no row grows.  That suits dense ids such as surrogate keys;
ids far apart cost a bitmap each, and ``incremental.delta_distinct`` is better.

A bit says nothing about how many rows stand behind it.  Where rows may be
deleted, ``row_counts`` keeps that number per group and id; it decides which
bits go out, and only buckets that lose a bit are built again.

NULL ids are not counted.  A group whose ids are all NULL has a count of 0, and a
group goes with its last row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .changes import weight
from .relational import anti_null_safe, semi_null_safe

BUCKET, BITS, ROWS = "id_bucket", "id_bits", "id_rows"


def row_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys, value, id_rows): rows behind every id of a group."""
    return df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias(ROWS))


def delta_row_counts(counts: DataFrame, change_set: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """New row counts; an id without rows is left out."""
    stacked = counts.unionByName(change_set.select(*keys, value, weight().alias(ROWS)))
    return stacked.groupBy(*keys, value).agg(F.sum(ROWS).alias(ROWS)).where(F.col(ROWS) > 0)


def _bucketed(df: DataFrame, value: str) -> DataFrame:
    return df.withColumn(BUCKET, F.bitmap_bucket_number(F.col(value).cast("bigint")))


def bitmaps(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys, id_bucket, id_bits) of rows or of row counts.

    Partial bitmaps are ORed inside the map tasks, so a hot group shuffles one
    bitmap per task and bucket.  NULL ids have a bucket of their own, without
    bits, which keeps their group alive.
    """
    position = F.bitmap_bit_position(F.col(value).cast("bigint"))
    return _bucketed(df, value).groupBy(*keys, BUCKET).agg(F.bitmap_construct_agg(position).alias(BITS))


def delta_bitmaps(
    state: DataFrame, change_set: DataFrame, keys: Sequence[str], value: str, new_counts: DataFrame | None = None,
) -> DataFrame:
    """New bitmaps after a change set.

    Insertions are ORed into the buckets they fall into.  With ``new_counts``
    (after the change) deletions are followed too: buckets in which an id lost
    its last row are built again from the counts.  Buckets without changes are
    passed on as they are.  Without ``new_counts`` a deletion is an error.
    """
    place = [*keys, BUCKET]
    inserted = change_set.where("_action = 'INSERT'")
    if new_counts is None:
        deletions = F.when(F.col("_action") == "DELETE", F.raise_error(F.lit("deletions need row counts")).cast("boolean"))
        return _ored(state, bitmaps(change_set.where(F.coalesce(deletions, F.lit(True))), keys, value), place)
    deleted = change_set.where("_action = 'DELETE'").select(*keys, value).distinct()
    emptied = _bucketed(anti_null_safe(deleted, new_counts, [*keys, value]), value).select(*place).distinct()
    again = bitmaps(semi_null_safe(_bucketed(new_counts, value), emptied, place).drop(BUCKET), keys, value)
    grown = anti_null_safe(bitmaps(inserted, keys, value), emptied, place)
    return _ored(anti_null_safe(state, emptied, place), grown, place).unionByName(again)


def _ored(state: DataFrame, grown: DataFrame, place: Sequence[str]) -> DataFrame:
    """The state with the bitmaps of ``grown`` ORed in; other rows stay where
    they are and only the buckets that meet are aggregated."""
    touched = grown.select(*place)
    met = semi_null_safe(state, touched, place).unionByName(grown)
    return anti_null_safe(state, touched, place).unionByName(met.groupBy(*place).agg(F.bitmap_or_agg(BITS).alias(BITS)))


def rolled_up(state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bitmaps of a coarser grouping, from those of a finer one alone."""
    return state.groupBy(*keys, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))


def distinct_counts(state: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Number of different ids per group, from bitmaps of that grouping."""
    return state.groupBy(*keys).agg(F.sum(F.bitmap_count(BITS)).alias(name))
