"""Ordered results kept up to date inside a hot key.

``incremental.delta_window`` replaces every row of a key that a change touches,
which is the whole table if one key holds most of it.  Here the order within a
key is cut into segments, and a change touches its segments only:

* ``RunningTotals`` stores what a row's total is within its segment, and the
  totals of the segments.  Rows of later segments stay as stored; they are shifted
  when they are read, by what the segments before them add up to.
* ``ValueCounts`` stores how often a value occurs, and how many rows a range of
  values has.  A percentile is looked for in the one or two ranges its rank falls
  into.

``segment`` is an expression over the rows that never falls while the order (or
value) rises, NULL first: a month of a date, a quotient of a number.  A segment
may be large: all sums run over even ranges, never over a segment in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .aggregates import interpolated
from .changes import weight
from .relational import anti_null_safe, semi_null_safe
from .windows import null_safe_join, ordered_windows

SEGMENT = "_segment"


@dataclass(frozen=True)
class Segmented:
    """Rows of a result, and one row per key and segment."""

    rows: DataFrame
    segments: DataFrame


@dataclass(frozen=True)
class RunningTotals:
    """Running totals per key: ``totals`` maps a new column to the value that is
    summed up to and including the row (1 for a row number).

    ``order`` ends with a unique column.  NULL keys form one key, NULL values add
    nothing, and a total without a value so far is NULL.  Values are integers or
    decimals: sums of segments are added in another order than rows would be,
    which floating point does not survive.
    """

    keys: Sequence[str]
    order: Sequence[str]
    totals: Mapping[str, Column]
    segment: Column

    def _place(self) -> list[str]:
        return [*self.keys, SEGMENT]

    def build(self, source: DataFrame) -> Segmented:
        rows = self._rows(source.withColumn(SEGMENT, self.segment))
        return Segmented(rows, self._sums(rows))

    def _rows(self, placed: DataFrame) -> DataFrame:
        floating = [f.name for f in placed.select(*[v.alias(n) for n, v in self.totals.items()]).schema
                    if f.dataType.typeName() in ("float", "double")]
        if floating:
            raise TypeError(f"running totals {floating} cannot be maintained in floating point")
        within = {f"_in_{n}": v for n, v in self.totals.items()}
        own = {f"_own_{n}": v for n, v in self.totals.items()}
        return ordered_windows(placed.withColumns(own), self._place(), self.order, totals=within)

    def _sums(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self._place()).agg(
            *[F.sum(f"_own_{n}").alias(f"_sum_{n}") for n in self.totals],
            *[F.count(f"_own_{n}").alias(f"_values_{n}") for n in self.totals])

    def replaced(self, new_source: DataFrame, change_set: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The segments that a change set touches, and their new rows."""
        touched = cut_lineage(change_set.withColumn(SEGMENT, self.segment).select(*self._place()).distinct())
        again = semi_null_safe(new_source.withColumn(SEGMENT, self.segment), touched, self._place())
        return touched, self._rows(again)

    def refresh(self, state: Segmented, new_source: DataFrame, change_set: DataFrame) -> Segmented:
        """New state: touched segments are computed again from the new source,
        all others are passed on."""
        touched, again = self.replaced(new_source, change_set)
        again, place = cut_lineage(again), self._place()
        rows = anti_null_safe(state.rows, touched, place).unionByName(again.select(*state.rows.columns))
        sums = anti_null_safe(state.segments, touched, place).unionByName(self._sums(again).select(*state.segments.columns))
        return Segmented(rows, sums)

    def read(self, state: Segmented) -> DataFrame:
        """The columns of the source and the totals."""
        measures = [f"{kind}_{n}" for kind in ("_sum", "_values") for n in self.totals]
        upto = ordered_windows(state.segments, self.keys, [SEGMENT], totals={f"_upto{m}": m for m in measures})
        ahead = upto.select(*self._place(), *[
            (F.coalesce(f"_upto{m}", F.lit(0)) - F.coalesce(m, F.lit(0))).alias(f"_ahead{m}") for m in measures])
        joined = null_safe_join(state.rows, ahead, self._place(), "inner")
        hidden = {SEGMENT, *(f"_own_{n}" for n in self.totals), *(f"_in_{n}" for n in self.totals)}
        columns = [F.col(c) for c in state.rows.columns if c not in hidden]
        shifted = [
            F.when((F.col(f"_ahead_values_{n}") > 0) | F.col(f"_in_{n}").isNotNull(),
                   F.col(f"_ahead_sum_{n}") + F.coalesce(f"_in_{n}", F.lit(0))).alias(n) for n in self.totals]
        return joined.select(*columns, *shifted)


@dataclass(frozen=True)
class ValueCounts:
    """Exact percentiles per key from counted values; NULL values do not count,
    and a key without values has no row.  ``segment`` is the range of a value."""

    keys: Sequence[str]
    value: str
    segment: Column

    def _place(self) -> list[str]:
        return [*self.keys, SEGMENT]

    def _counted(self, weighted: DataFrame) -> DataFrame:
        kept = weighted.where(F.col(self.value).isNotNull()).withColumn(SEGMENT, self.segment)
        return kept.groupBy(*self._place(), F.col(self.value).alias("_value")).agg(F.sum("_n").alias("_n"))

    def _ranges(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self._place()).agg(F.sum("_n").alias("_n"))

    def build(self, source: DataFrame) -> Segmented:
        rows = self._counted(source.select(*self.keys, self.value, F.lit(1).cast("bigint").alias("_n")))
        return Segmented(rows, self._ranges(rows))

    def refresh(self, state: Segmented, change_set: DataFrame) -> Segmented:
        """New state from the changes alone; only ranges with a change are
        aggregated, and the source isn't read."""
        delta = cut_lineage(self._counted(change_set.select(*self.keys, self.value, weight().alias("_n"))))
        place = self._place()
        touched = delta.select(*place).distinct()
        met = semi_null_safe(state.rows, touched, place).unionByName(delta)
        again = cut_lineage(met.groupBy(*place, "_value").agg(F.sum("_n").alias("_n")).where("_n > 0"))
        return Segmented(
            anti_null_safe(state.rows, touched, place).unionByName(again),
            anti_null_safe(state.segments, touched, place).unionByName(self._ranges(again)))

    def hit(self, state: Segmented, shares: Mapping[str, float]) -> DataFrame:
        """The ranges that hold a rank that is asked for, with the rows before
        them (``_ahead``) and those of the key (``_whole``)."""
        upto = ordered_windows(state.segments, self.keys, [SEGMENT], totals={"_upto": F.col("_n")})
        whole = state.segments.groupBy(*self.keys).agg(F.sum("_n").alias("_whole"))
        placed = null_safe_join(upto, whole, self.keys, "inner") if self.keys else upto.withColumn("_whole", whole.scalar())
        wanted = F.lit(False)
        for share in shares.values():
            for rank in (F.floor, F.ceil):
                at = rank(F.lit(share) * (F.col("_whole") - 1))
                wanted = wanted | ((F.col("_upto") - F.col("_n") <= at) & (at < F.col("_upto")))
        return placed.where(wanted).select(*self._place(), (F.col("_upto") - F.col("_n")).alias("_ahead"), "_whole")

    def percentiles(self, state: Segmented, shares: Mapping[str, float]) -> DataFrame:
        """Interpolated percentiles: ``shares`` maps a new column to its share."""
        hits = cut_lineage(self.hit(state, shares))
        place = self._place()
        within = ordered_windows(semi_null_safe(state.rows, hits, place), place, ["_value"], totals={"_in": F.col("_n")})
        placed = null_safe_join(within, hits, place, "inner").withColumn("_upto", F.col("_ahead") + F.col("_in"))
        return interpolated(placed, list(self.keys), shares)
