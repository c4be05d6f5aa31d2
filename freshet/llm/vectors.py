"""Vectors of whole numbers, which the two vector operators work on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Scaled components stay below this, so that squared distances of 64 of them fit into 64 bits.
LIMIT = 1 << 27


def usable(vector: Column, dimension: int) -> Column:
    """True for a vector of ``dimension`` components, none of them NULL, NaN or infinite; never NULL."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return F.coalesce((F.size(vector) == dimension) & finite, F.lit(False))


def whole_numbers(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component, x as double.  A component beyond ``LIMIT`` ends the job with a message:
    its squared distances would not fit into the 64 bits of the result."""
    def scaled(x: Column) -> Column:
        y = F.floor(x.cast("double") * scale)
        return F.when(F.abs(x.cast("double") * scale) < LIMIT, y).otherwise(
            F.raise_error(F.lit(f"a component of a vector is beyond {LIMIT // scale}")).cast("bigint")).cast("int")

    return F.transform(vector, scaled)


def floor_mean(total: int, count: int) -> int:
    return total // count  # of Python integers: exact, rounds down
