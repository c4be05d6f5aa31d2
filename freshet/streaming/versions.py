"""Change sets of a maintained table as a stream whose offsets are versions.

The history of the tables is the announcement: a version has a row there once it
is complete.  Those rows are streamed; a batch of them becomes the range of
versions from the last one handed over to the newest one announced, and what is
handed on is the change set of that range, from the change sets that the table
has stored with its versions.  The range of a batch is noted below the
checkpoint, so a batch that is run again covers the same versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.refresh import HISTORY, MaintainedTables
from .files import Sink, read_new_files, run_available

RANGE = "batch long, since long, upto long"
#: Actions after which a table has new contents.
BUILT = ["PUBLISH", "BACKFILL", "FULL", "REINITIALIZE", "INCREMENTAL"]


def announced(tables: MaintainedTables, name: str) -> DataFrame:
    """Stream of the versions of a table, as they become complete."""
    history = read_new_files(tables.spark, f"{tables.root}/_history", HISTORY)
    done = (F.col("name") == name) & (F.col("state") == "SUCCEEDED") & F.col("refresh_action").isin(BUILT)
    return history.where(done).select("version")


def follow(tables: MaintainedTables, name: str, sink: Sink, checkpoint: str) -> None:
    """Hand the change set of everything new since the last call to ``sink``.

    The first one holds every row of the table as an insert.  A reader that
    comes back after its last version was given up gets ``RetentionError``, and
    starts over with a new checkpoint.
    """
    ranges = f"{checkpoint}/ranges"

    def handle(batch: DataFrame, label: str, batch_id: int) -> None:
        tables.reload()
        newest = batch.agg(F.max("version")).first()[0]
        since = _position(tables, ranges, batch_id)
        last = max(since, newest or 0)
        row = tables.spark.createDataFrame([(batch_id, since, last)], RANGE)
        row.coalesce(1).write.mode("overwrite").parquet(f"{ranges}/r{batch_id:08d}")
        if last > since:
            sink(tables.changes_since(name, since, last), label, batch_id)

    run_available(announced(tables, name), handle, checkpoint)


def _position(tables: MaintainedTables, ranges: str, batch_id: int) -> int:
    """The version that the batch before ended with; 0 before the first."""
    if batch_id == 0:
        return 0
    return tables.spark.read.schema(RANGE).parquet(f"{ranges}/r{batch_id - 1:08d}").first()["upto"]
