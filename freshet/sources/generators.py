"""Generated rows: date spines and the sample customers/products/purchases.

Every generator is a ``spark.range`` projection, so rows are produced in
parallel and reproducibly from a seed instead of by one Python loop.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# First identifiers and value ranges of the sample tables.
FIRST_CUSTOMER, FIRST_PRODUCT = 1001, 101
BUYER_IDS, SOLD_IDS = (1001, 1999), (101, 199)


def date_spine(spark: SparkSession, start: dt.date, end: dt.date, name: str = "day") -> DataFrame:
    """Every date from ``start`` to ``end`` inclusive."""
    days = (end - start).days + 1
    return spark.range(days).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias(name))


def _between(low, high, seed: int, digits: int = 0) -> Column:
    """A uniform number in [low, high]; whole numbers hit both ends evenly."""
    if digits:
        return F.round(F.rand(seed) * (high - low) + low, digits)
    return F.floor(F.rand(seed) * (high - low + 1) + low)


def _word(words: list[str], seed: int) -> Column:
    return F.element_at(F.array(*map(F.lit, words)), _between(1, len(words), seed).cast("int"))


def gen_customers(spark: SparkSession, n: int, seed: int = 7) -> DataFrame:
    first = ["Ada", "Ben", "Cleo", "Dan", "Eva", "Finn", "Gia", "Hugo"]
    last = ["Arden", "Brook", "Cole", "Dale", "Ellis", "Frost", "Gray", "Hale"]
    return spark.range(n).select(
        (F.col("id") + FIRST_CUSTOMER).cast("decimal(10,0)").alias("custid"),
        F.concat_ws(" ", _word(first, seed), _word(last, seed + 1)).alias("cname"),
        _between(1000, 10000, seed + 2, 2).cast("decimal(10,2)").alias("spendlimit"),
    )


def gen_products(spark: SparkSession, n: int, seed: int = 11, as_of=None) -> DataFrame:
    kind = ["Adaptive", "Compact", "Durable", "Modular", "Quiet", "Swift"]
    item = ["desk", "lamp", "pump", "router", "scale", "valve"]
    today = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    return spark.range(n).select(
        (F.col("id") + FIRST_PRODUCT).cast("decimal(10,0)").alias("pid"),
        F.concat_ws(" ", _word(kind, seed), _word(item, seed + 1)).alias("pname"),
        _between(500, 1000, seed + 2).cast("decimal(10,2)").alias("stock"),
        F.date_sub(today, _between(0, 90, seed + 3).cast("int")).alias("stockdate"),
    )


def gen_purchases(spark: SparkSession, n: int, days: int, seed: int = 13, as_of=None) -> DataFrame:
    """(custid, purchase) with the purchase as JSON text."""
    today = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    purchase = F.struct(
        _between(*SOLD_IDS, seed).alias("prodid"),
        _between(1, 5, seed + 1).alias("quantity"),
        _between(10, 1000, seed + 2, 2).alias("purchase_amount"),
        F.date_sub(today, _between(0, days, seed + 3).cast("int")).alias("purchase_date"),
    )
    return spark.range(n).select(
        _between(*BUYER_IDS, seed + 4).cast("decimal(10,0)").alias("custid"),
        F.to_json(purchase).alias("purchase"),
    )
