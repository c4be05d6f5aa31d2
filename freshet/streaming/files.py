"""Streams over arriving files and idempotent per-batch sinks.

A batch may be handed to its sink again after a crash.  Every sink here writes
into a folder named after the stream and the batch and overwrites it, so a
replay replaces the first attempt instead of adding to it.  The stream's name is
the id that its checkpoint keeps: a new checkpoint numbers its batches from 0
again, and must not overwrite what another one has stored.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.windows import keep_latest

# Fixed value: a maintained table may not promise to be fresher than this.
SHORTEST_LAG_SECONDS = 60


def read_new_files(spark: SparkSession, path: str, schema, fmt: str = "parquet", per_batch: int | None = None, **options) -> DataFrame:
    """Files as they arrive below ``path``; schema given, nothing inferred."""
    reader = spark.readStream.schema(schema).format(fmt).options(**options)
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    return reader.load(path)


def lag_trigger(lag_seconds: int, upstream_lag_seconds: int = 0) -> dict[str, str]:
    """Trigger arguments for a target lag; a lag below one minute or below the
    lag of the input is refused."""
    if lag_seconds < max(SHORTEST_LAG_SECONDS, upstream_lag_seconds):
        raise ValueError(f"lag of {lag_seconds} s is below the shortest possible one")
    return {"processingTime": f"{lag_seconds} seconds"}


Sink = Callable[[DataFrame, str, int], None]


def run_available(stream: DataFrame, handle: Sink, checkpoint: str) -> None:
    """Process everything that has arrived since the last call, then stop.

    The checkpoint keeps the offset, so no file is taken twice.  ``handle`` gets
    the batch, a name that no other stream uses, and the batch number.
    """
    ids: list[str] = []

    def named(batch: DataFrame, batch_id: int) -> None:
        if not ids:
            ids.append(batch.sparkSession.read.schema("id string").json(f"{checkpoint}/metadata").first()["id"])
        handle(batch, f"{ids[0]}-{batch_id}", batch_id)

    query = (
        stream.writeStream.foreachBatch(named)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def batch_writer(path: str, transform: Callable[[DataFrame], DataFrame] = lambda df: df) -> Sink:
    """A sink that stores ``transform`` of each batch in its own folder."""

    def handle(batch: DataFrame, name: str, batch_id: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{path}/batch={name}")

    return handle


def append_new(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append-only ingestion."""
    run_available(stream, batch_writer(path), checkpoint)


def upsert_newest(stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], order: Sequence[Column]) -> None:
    """Keep the newest row per key of a stream.

    A batch costs what the batch holds: it is deduplicated and stored beside
    the earlier ones.  ``read_newest`` settles the rest when the table is read,
    and ``compact`` folds the batches into one when they have become many.
    """
    run_available(stream, batch_writer(path, lambda df: keep_latest(df, keys, order)), checkpoint)


def read_newest(spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return keep_latest(spark.read.parquet(path).drop("batch"), keys, order)


def compact(spark: SparkSession, path: str, target: str, keys: Sequence[str], order: Sequence[Column]) -> None:
    """Write the newest rows of all batches to a new folder."""
    read_newest(spark, path, keys, order).write.mode("errorifexists").parquet(f"{target}/batch=compacted")


def first_within(stream: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    """First row per key within a watermark, with state bounded by ``delay``.

    Watermarks need an instant, so a timestamp without zone is read as UTC
    (the session time zone).
    """
    stream = stream.withColumn(ts, F.col(ts).cast("timestamp"))
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def enrich(stream: DataFrame, dimension: DataFrame, on: Sequence[str]) -> DataFrame:
    """Stream-static left join: only new stream rows are processed, and each
    batch sees the dimension as it is then."""
    return stream.join(dimension, list(on), "left")


def changed_rows_export(path: str) -> Sink:
    """Post-refresh action: hand the changed rows of a batch to files."""

    def handle(batch: DataFrame, name: str, batch_id: int) -> None:
        batch.withColumn("exported_batch", F.lit(batch_id).cast("bigint")).write.mode("overwrite").json(f"{path}/batch={name}")

    return handle
