"""Column expressions shared by the plans.  Everything here stays inside
whole-stage code generation."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def value_map(source: Column | str, mapping: Mapping[str, str], default: str | None = None) -> Column:
    """Simple CASE: listed values are translated, everything else (NULL
    included) becomes ``default``."""
    source = F.col(source) if isinstance(source, str) else source
    result = None
    for key, value in mapping.items():
        test = source == F.lit(key)
        result = F.when(test, F.lit(value)) if result is None else result.when(test, F.lit(value))
    return F.lit(default) if result is None else result.otherwise(F.lit(default))


def as_of_date(as_of=None) -> Column:
    """The reporting day: a fixed date, or today when none is given."""
    return F.current_date() if as_of is None else F.lit(as_of).cast("date")


def instant(value: dt.datetime) -> Column:
    """A timestamp without zone as it reads, whatever zone Python or the
    session are in."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def overdue(due: Column | str, as_of=None) -> Column:
    """True when the due date lies strictly before the reporting day."""
    due = F.col(due) if isinstance(due, str) else due
    return due < as_of_date(as_of)


def sum_where(condition: Column, value: Column | str) -> Column:
    """SUM(CASE WHEN condition THEN value ELSE 0 END)."""
    value = F.col(value) if isinstance(value, str) else value
    return F.sum(F.when(condition, value).otherwise(F.lit(0)))


def masked(column: str, role: str, allowed: Iterable[str], default=0) -> Column:
    """The column for roles that may see it, ``default`` for all others."""
    shown = F.col(column) if role in set(allowed) else F.lit(default)
    return shown.alias(column)


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Whole seconds between two timestamps, both cut to the second first."""
    start = F.col(start) if isinstance(start, str) else start
    end = F.col(end) if isinstance(end, str) else end
    return F.timestamp_diff("SECOND", _whole_second(start), _whole_second(end))


def _whole_second(ts: Column) -> Column:
    # DATE_TRUNC gives a timestamp with zone; back to plain wall-clock time
    return F.date_trunc("second", ts).cast("timestamp_ntz")


def fahrenheit_to_celsius(degrees: Column | str) -> Column:
    """(F - 32) * 5/9 as decimal(35,4); the product is taken before the
    division so that no digits of 5/9 are lost."""
    degrees = F.col(degrees) if isinstance(degrees, str) else degrees
    exact = degrees.cast("decimal(20,4)")
    return ((exact - F.lit(32)) * F.lit(5) / F.lit(9)).cast("decimal(35,4)")


def inch_to_millimeter(inches: Column | str) -> Column:
    """Inches to millimetres as decimal(35,4)."""
    inches = F.col(inches) if isinstance(inches, str) else inches
    return (inches.cast("decimal(20,4)") * F.lit("25.4").cast("decimal(3,1)")).cast("decimal(35,4)")


def row_text(*columns: str) -> Column:
    """One result row as comma-separated text, NULL shown as ``None``."""
    return F.concat_ws(", ", *[F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in columns])


def escape_quotes(text: Column | str) -> Column:
    """Double every single quote."""
    text = F.col(text) if isinstance(text, str) else text
    return F.replace(text, F.lit("'"), F.lit("''"))
