"""Checks that a load is there and complete."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its row count; one small aggregate per table."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, parts)


def load_check(spark: SparkSession, tables: dict[str, DataFrame | None], must_have_rows: str | None = None) -> DataFrame:
    """A one-row report: are all expected tables present, and not empty?

    ``None`` stands for a table that could not be found.  Emptiness is tested
    with a limit, so at most one row of a table is read.
    """
    found = {name: df for name, df in tables.items() if df is not None}
    checked = [must_have_rows] if must_have_rows else list(found)
    if len(found) < len(tables):
        state, message = "INCOMPLETE", f"found {len(found)} of {len(tables)} expected tables"
    elif any(found[name].limit(1).count() == 0 for name in checked):
        state, message = "INCOMPLETE", "all tables exist, but data is missing"
    else:
        state, message = "COMPLETE", f"{len(found)} tables exist and hold data"
    return spark.createDataFrame([(state, len(found), message)], "state string, tables_found long, message string")


def describe(df: DataFrame) -> DataFrame:
    """Schema of a table as rows."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, data_type string")


def compare_columns(left: DataFrame, right: DataFrame) -> DataFrame:
    """Columns of two tables side by side: same, different type, or one-sided."""
    a = describe(left).select("column_name", F.col("data_type").alias("left_type"))
    b = describe(right).select("column_name", F.col("data_type").alias("right_type"))
    status = (
        F.when(F.col("right_type").isNull(), "only_left")
        .when(F.col("left_type").isNull(), "only_right")
        .when(F.col("left_type") == F.col("right_type"), "same")
        .otherwise("type_differs")
    )
    return a.join(b, "column_name", "full").withColumn("status", status)


def column_contents(df: DataFrame) -> DataFrame:
    """Per column its type, NULLs and distinct values, counted in one pass."""
    names = df.columns
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(names)],
                    *[F.countDistinct(F.col(f"`{c}`")).alias(f"d{i}") for i, c in enumerate(names)])
    kinds = dict(df.dtypes)
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(kinds[c]).alias("data_type"), F.col(f"n{i}").alias("nulls"),
                              F.col(f"d{i}").alias("distinct_values")) for i, c in enumerate(names)])
    return counts.select(F.explode(rows).alias("r")).select("r.*")


def compare_contents(left: DataFrame, right: DataFrame) -> DataFrame:
    """``compare_columns`` with what the columns hold: NULLs and distinct
    values of both sides, and ``contents_differ`` where one of them differs."""
    a, b = (column_contents(df).withColumnsRenamed({c: f"{side}_{c}" for c in ("nulls", "distinct_values")}).drop("data_type")
            for side, df in (("left", left), ("right", right)))
    differ = (F.col("left_nulls") != F.col("right_nulls")) | (F.col("left_distinct_values") != F.col("right_distinct_values"))
    return compare_columns(left, right).join(a, "column_name", "left").join(b, "column_name", "left").withColumn(
        "status", F.when((F.col("status") == "same") & differ, "contents_differ").otherwise(F.col("status")))
