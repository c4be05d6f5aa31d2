"""Keyed tables that streams write to, a batch at a time.

The rows are dealt to a fixed number of buckets by the hash of their key.  A
batch is folded to one row per key first, then the buckets of its keys are read,
folded together with it and written to folders of that batch; all others stay.
A version is a manifest: the folder that holds each bucket, and the last batch
that every stream has had taken in.  So a reader opens one folder per bucket,
however many batches there were, and a batch that is handed over again after a
crash is either in the newest manifest, and left out, or overwrites the folders
of its first attempt.

A table has one writer at a time.  ``parts`` is chosen for the table's size: a
batch rewrites at least one bucket per touched bucket, and a bucket should fit
into a few tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.changes import apply_changes
from ..operators.windows import keep_latest
from ..session import cut_lineage
from .files import Sink

MANIFEST = "bucket int, folder string, stream string, batch long"
#: Tasks that write one bucket, so that few large buckets still spread.
WRITERS = 4

#: A folding rule: any rows of the table -> one row per key, the same whatever was folded before.
Fold = Callable[[DataFrame], DataFrame]


def newest(keys: Sequence[str], order: Sequence[Column]) -> Fold:
    """Of all rows of a key the first in ``order`` stays; end it with a unique column."""
    return lambda rows: keep_latest(rows, keys, order)


def totals(keys: Sequence[str], sums: Sequence[str], lowest: Sequence[str] = (), highest: Sequence[str] = ()) -> Fold:
    """Adds up, or keeps the smallest or largest value; NULL where a key has no other value."""
    parts = [F.sum(c).alias(c) for c in sums] + [F.min(c).alias(c) for c in lowest] + [F.max(c).alias(c) for c in highest]
    return lambda rows: rows.groupBy(*keys).agg(*parts).select(*rows.columns)


@dataclass
class BucketedTable:
    """The table below ``root`` with the columns of ``layout`` and unique ``keys``; NULL is a key like any other."""

    spark: SparkSession
    root: str
    keys: Sequence[str]
    layout: str
    parts: int = 64

    # --- reading -----------------------------------------------------------------

    def versions(self) -> list[int]:
        """The complete versions, oldest first."""
        path = self._hadoop(f"{self.root}/manifest")
        if not self._files(path).exists(path):
            return []
        names = [f.getPath().getName() for f in self._files(path).listStatus(path)]
        return sorted(int(n[1:]) for n in names if n.startswith("v") and self._exists(f"{self.root}/manifest/{n}/_SUCCESS"))

    def manifest(self, version: int | None = None) -> tuple[dict[int, str], dict[str, int]]:
        """Bucket -> folder, and stream -> last batch taken in; both bounded by ``parts`` and the number of streams."""
        if version is None:
            version = max(self.versions(), default=0)
        if not version:
            return {}, {}
        rows = self.spark.read.schema(MANIFEST).parquet(self._manifest_path(version)).collect()
        return ({r["bucket"]: r["folder"] for r in rows if r["bucket"] is not None},
                {r["stream"]: r["batch"] for r in rows if r["stream"] is not None})

    def read(self, buckets: Iterable[int] | None = None) -> DataFrame:
        """The newest version, or those buckets of it."""
        listed, _ = self.manifest()
        wanted = set(listed) if buckets is None else set(buckets)
        paths = [f"{self.root}/data/{listed[b]}/_bucket={b}" for b in sorted(wanted & set(listed))]
        return self.spark.read.schema(self.layout).parquet(*paths) if paths else self.spark.createDataFrame([], self.layout)

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.parts)).cast("int")

    # --- writing -----------------------------------------------------------------

    def rewrite(self, concerned: DataFrame, change: Callable[[DataFrame], DataFrame], name: str) -> list[int]:
        """Replaces the buckets of the keys in ``concerned`` by what ``change`` makes of their rows.

        ``name`` is the stream's name and the batch number as ``run_available``
        gives it.  Returns the buckets that were touched, none for a batch that
        is in already.
        """
        stream, _, number = name.rpartition("-")
        listed, taken = self.manifest()
        if taken.get(stream, -1) >= int(number):
            return []
        touched = sorted(r[0] for r in concerned.select(self.bucket().alias("b")).distinct().collect())  # at most ``parts``
        wrote = self._write(change(self.read(touched)), name) if touched else []
        if not set(wrote) <= set(touched):
            raise ValueError(f"batch {name} has changed rows of keys that it does not hold")
        after = {b: folder for b, folder in listed.items() if b not in set(touched)} | {b: name for b in wrote}
        rows = [(b, folder, None, None) for b, folder in sorted(after.items())]
        rows += [(None, None, s, n) for s, n in sorted((taken | {stream: int(number)}).items())]
        version = max(self.versions(), default=0) + 1
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("overwrite").parquet(self._manifest_path(version))
        return touched

    def upsert(self, fold: Fold) -> Sink:
        """A sink that folds every batch into the table."""

        def handle(batch: DataFrame, name: str, batch_id: int) -> None:
            folded = cut_lineage(fold(batch.select(*self.columns)))
            self.rewrite(folded, lambda old: fold(old.unionByName(folded)), name)

        return handle

    def copy(self) -> Sink:
        """A sink for change sets, deletions included: the table becomes a copy of the one that they come from."""

        def handle(change_set: DataFrame, name: str, batch_id: int) -> None:
            self.rewrite(change_set, lambda old: apply_changes(old, change_set, self.keys), name)

        return handle

    def vacuum(self, keep: int = 1) -> list[str]:
        """Deletes the manifests before the newest ``keep`` and the folders that only those list, and names them."""
        versions = self.versions()
        old, kept = versions[:-keep], versions[-keep:]
        used = {(b, folder) for v in kept for b, folder in self.manifest(v)[0].items()}
        gone = [f"{self.root}/data/{folder}/_bucket={b}" for v in old for b, folder in self.manifest(v)[0].items() if (b, folder) not in used]
        gone = list(dict.fromkeys(gone)) + [self._manifest_path(v) for v in old]
        for path in gone:
            where = self._hadoop(path)
            self._files(where).delete(where, True)
        return gone

    @property
    def columns(self) -> list[str]:
        return self.spark.createDataFrame([], self.layout).columns

    def _write(self, rows: DataFrame, name: str) -> list[int]:
        path, columns = f"{self.root}/data/{name}", self.columns
        dealt = rows.select(*columns).withColumn("_bucket", self.bucket())
        dealt.repartition("_bucket", F.pmod(F.xxhash64(*columns), F.lit(WRITERS))).write.mode("overwrite").partitionBy("_bucket").parquet(path)
        where = self._hadoop(path)
        names = [f.getPath().getName() for f in self._files(where).listStatus(where)]
        return sorted(int(n.split("=")[1]) for n in names if n.startswith("_bucket="))

    def _manifest_path(self, version: int) -> str:
        return f"{self.root}/manifest/v{version:08d}"

    def _hadoop(self, path: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)

    def _files(self, path):
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _exists(self, path: str) -> bool:
        where = self._hadoop(path)
        return self._files(where).exists(where)
