"""MERGE as a DataFrame operation: (target, source) -> new target."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .windows import keep_latest


class DuplicateMatch(ValueError):
    """Several source rows share one merge key."""


@dataclass(frozen=True)
class Matched:
    """WHEN MATCHED [AND condition] THEN UPDATE or DELETE.

    Expressions are SQL text over the aliases ``t`` (target) and ``s`` (source).
    """

    update: Mapping[str, str] = field(default_factory=dict)
    condition: str = "true"
    delete: bool = False


@dataclass(frozen=True)
class NotMatched:
    """WHEN NOT MATCHED [AND condition] THEN INSERT, over the alias ``s``."""

    insert: Mapping[str, str]
    condition: str = "true"


def _first_true(clauses: Sequence) -> Column:
    """Number of the first clause whose condition holds, else NULL."""
    choice = None
    for i, clause in enumerate(clauses):
        test = F.coalesce(F.expr(clause.condition), F.lit(False))
        choice = F.when(test, i) if choice is None else choice.when(test, i)
    return F.lit(None).cast("int") if choice is None else choice


def require_unique(source: DataFrame, on: Sequence[str]) -> None:
    """Refuse a source in which a non-NULL key occurs twice: the result of the
    merge would depend on row order."""
    known = source.dropna(subset=list(on))
    repeated = known.groupBy(*on).count().where(F.col("count") > 1).limit(1)
    if not repeated.isEmpty():
        raise DuplicateMatch(f"several source rows share one value of {list(on)}")


def merge(
    target: DataFrame,
    source: DataFrame,
    on: Sequence[str],
    clauses: Sequence[Matched | NotMatched],
    on_duplicates: str = "error",
    latest: Sequence[Column] | None = None,
) -> DataFrame:
    """Apply ``clauses`` in order; the first whose condition holds wins.

    NULL keys match nothing, as in SQL.  The target is left-joined to the
    source, so a small source is broadcast and the target is not shuffled, and
    a hot target key can be split.  Inserts come from the source rows whose key
    the target does not have; that test reads the key columns only.
    ``on_duplicates``: ``error`` checks the source first, ``latest`` keeps the
    first row per key in the order ``latest``.
    """
    on = list(on)
    if on_duplicates == "latest":
        if not latest:
            raise ValueError("on_duplicates='latest' needs an order")
        has_key = ~F.greatest(*[F.col(c).isNull() for c in on], F.lit(False))
        source = keep_latest(source.where(has_key), on, latest).unionByName(source.where(~has_key))
    else:
        require_unique(source, on)
    matched = [c for c in clauses if isinstance(c, Matched)]
    unmatched = [c for c in clauses if isinstance(c, NotMatched)]

    equal = None
    for c in on:
        part = F.col(f"t.{c}") == F.col(f"s.{c}")
        equal = part if equal is None else equal & part
    tagged = source.withColumn("_hit", F.lit(True))
    met = target.alias("t").join(tagged.alias("s"), equal, "left").withColumn(
        "_clause", F.when(F.col("s._hit"), _first_true(matched))
    )
    deleted = [i for i, c in enumerate(matched) if c.delete]
    if deleted:
        met = met.where(F.col("_clause").isNull() | ~F.col("_clause").isin(deleted))
    kept = []
    for name in target.columns:
        value = F.col(f"t.{name}")
        for i, clause in enumerate(matched):
            if name in clause.update:
                value = F.when(F.col("_clause") == i, F.expr(clause.update[name])).otherwise(value)
        kept.append(value.cast(target.schema[name].dataType).alias(name))
    result = met.select(*kept)
    if not unmatched:
        return result

    present = target.select(*on).join(source.select(*on), on, "left_semi").distinct()
    fresh = source.join(present, on, "left_anti").alias("s").withColumn("_clause", _first_true(unmatched))
    new_rows = []
    for name, data_type in target.dtypes:
        value = F.lit(None)
        for i, clause in enumerate(unmatched):
            if name in clause.insert:
                value = F.when(F.col("_clause") == i, F.expr(clause.insert[name])).otherwise(value)
        new_rows.append(value.cast(data_type).alias(name))
    return result.unionByName(fresh.where(F.col("_clause").isNotNull()).select(*new_rows))


def upsert_newest(target: DataFrame, source: DataFrame, on: Sequence[str], newer: str, tiebreak: Sequence[Column] = ()) -> DataFrame:
    """Keep the newest row per key: source duplicates are settled first, and a
    source row replaces a target row only when it is strictly newer."""
    columns = {c: f"s.{c}" for c in target.columns}
    return merge(
        target, source, on,
        [Matched(update=columns, condition=f"s.{newer} > t.{newer}"), NotMatched(insert=columns)],
        on_duplicates="latest",
        latest=[F.col(newer).desc(), *tiebreak],
    )


def insert_new_window(
    state: DataFrame, source: DataFrame, ts: str, since: Column, keys: Sequence[str],
) -> DataFrame:
    """Append the source rows of a time window that the state does not hold.

    The window has to reach back at least to the previous run; older rows are
    not looked at again.
    """
    window = source.where(F.col(ts) >= since)
    fresh = window.join(state.select(*keys), list(keys), "left_anti")
    return state.unionByName(fresh.select(*state.columns))


def add_column(state: DataFrame, name: str, data_type: str) -> DataFrame:
    """Schema evolution without a rebuild: old rows hold NULL."""
    return state.withColumn(name, F.lit(None).cast(data_type))
