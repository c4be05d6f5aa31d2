"""Reading typed files and writing results."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(
    spark: SparkSession,
    path: str | list[str],
    schema: str,
    fmt: str = "csv",
    header: bool = False,
    quote: str = '"',
    multi_line: bool = False,
    mode: str = "FAILFAST",
) -> DataFrame:
    """Files below a path prefix as one typed table.

    The schema is always given, so nothing is read twice to guess types.  A
    row that does not fit stops the load unless another ``mode`` is asked for.
    ``multi_line`` is for quoted cells holding line breaks and keeps a file in
    one task, so it is off by default.
    """
    reader = spark.read.schema(schema)
    if fmt == "csv":
        return reader.csv(path, header=header, quote=quote, escape='"', multiLine=multi_line,
                          mode=mode, dateFormat="yyyy-MM-dd", enforceSchema=True)
    if fmt == "json":
        return reader.json(path, mode=mode)
    return reader.format(fmt).load(path)


def load_tables(spark: SparkSession, sources: dict[str, tuple[str, str]], target: str, **options) -> dict[str, DataFrame]:
    """Bulk load: name -> (path prefix, schema) into Parquet below ``target``.

    Each load is one distributed read-and-write; the returned frames read the
    written files.
    """
    loaded = {}
    for name, (path, schema) in sources.items():
        out = f"{target.rstrip('/')}/{name}"
        read_table(spark, path, schema, **options).write.mode("overwrite").parquet(out)
        loaded[name] = spark.read.parquet(out)
    return loaded


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines; blank lines are skipped by the reader."""
    return read_table(spark, path, schema, fmt="json")


def write_run(df: DataFrame, path: str, run_at: dt.datetime) -> str:
    """Write a result set as JSON lines into a folder named after the run."""
    out = f"{path.rstrip('/')}/run={run_at.strftime('%Y%m%dT%H%M%SZ')}"
    df.write.mode("errorifexists").json(out)
    return out


def write_snapshot(df: DataFrame, path: str) -> None:
    """Transient table: the latest contents only, no history kept."""
    df.write.mode("overwrite").parquet(path)


def write_clustered(df: DataFrame, path: str, by: Sequence[str | Column], files: int, partition_by: Sequence[str] = ()) -> None:
    """Store rows ordered by the clustering expressions.

    Range partitioning gives every file a narrow value range, so Parquet
    min/max statistics can skip files; a hot value is spread by the sampled
    range bounds of the full expression list.
    """
    keys = [F.col(c) if isinstance(c, str) else c for c in by]
    writer = df.repartitionByRange(files, *keys).sortWithinPartitions(*keys).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
