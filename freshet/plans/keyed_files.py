"""A keyed table stored as files that know their keys, so that MERGE reads few of them.

The rows are written in ranges of the first key column.  For every file the
table keeps the lowest and highest value of that column and a Bloom filter of
the whole key: bitmaps of 32,768 bits, built by ``bitmap_construct_agg``.  A
MERGE looks up which files may hold a key of its source, first by range, then
by filter, merges the source into those files only and lists its new files in
their place.  A version is a list of files; files are never changed.

NULL keys match nothing in a MERGE, so they are in no range and no filter.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.merge import merge
from ..session import cut_lineage

#: Bits of one bitmap; Bloom filters take as many bitmaps as their file's keys need.
BITMAP = 1 << 15
PROBES, BITS_PER_KEY = 4, 12


@dataclass(frozen=True)
class Merged:
    version: int
    read: int  # files that were read
    of: int  # files there were


@dataclass
class KeyedFiles:
    """A table below ``root`` with the key columns ``on`` and about ``rows_per_file`` rows in a file."""

    spark: SparkSession
    root: str
    on: Sequence[str]
    layout: str
    rows_per_file: int = 1_000_000

    # --- versions ----------------------------------------------------------------

    def versions(self) -> list[int]:
        """The complete versions, oldest first."""
        path = self._hadoop(f"{self.root}/manifest")
        files = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not files.exists(path):
            return []
        names = [f.getPath().getName() for f in files.listStatus(path)]
        return sorted(int(n[1:]) for n in names if n.startswith("v") and files.exists(self._hadoop(f"{self.root}/manifest/{n}/_SUCCESS")))

    def manifest(self, version: int | None = None) -> DataFrame:
        """file, n, low, high: one row per file of a version."""
        known = self.versions()
        if not known:
            return self.spark.createDataFrame([], self._manifest_layout())
        return self.spark.read.schema(self._manifest_layout()).parquet(f"{self.root}/manifest/v{known[-1] if version is None else version:08d}")

    def read(self, version: int | None = None) -> DataFrame:
        return self._rows([r["file"] for r in self.manifest(version).select("file").collect()])

    def _rows(self, files: list[str]) -> DataFrame:
        return self.spark.read.schema(self.layout).parquet(*files) if files else self.spark.createDataFrame([], self.layout)

    def _hadoop(self, path: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)

    def _key_type(self) -> str:
        return T.StructType.fromDDL(self.layout)[self.on[0]].dataType.simpleString()

    def _manifest_layout(self) -> str:
        return f"file string, n long, low {self._key_type()}, high {self._key_type()}, bitmaps int"

    # --- writing -------------------------------------------------------------------

    def _positions(self, bitmaps: Column) -> Column:
        """The bits of a key's filter, as (bitmap, position); NULL for a NULL key."""
        whole = F.greatest(*[F.col(c).isNull() for c in self.on], F.lit(False))
        bits = F.transform(F.array(*[F.lit(i) for i in range(PROBES)]), lambda i: F.pmod(F.xxhash64(i, *self.on), bitmaps.cast("bigint") * BITMAP))
        return F.when(~whole, F.transform(bits, lambda p: F.struct(F.floor(p / BITMAP).cast("int").alias("bitmap"), F.pmod(p, F.lit(BITMAP)).alias("position"))))

    def _write(self, df: DataFrame, version: int) -> DataFrame:
        """Writes ``df`` as files of ``version`` with their filters; their rows of the manifest."""
        folder = f"{self.root}/rows/v{version:08d}"
        # sorted within a task too, so that the files a task writes have ranges of their own
        df.repartitionByRange(*[F.col(c) for c in self.on]).sortWithinPartitions(*self.on).write.mode("overwrite").option(
            "maxRecordsPerFile", self.rows_per_file).parquet(folder)
        stored = self.spark.read.schema(self.layout).parquet(folder).withColumn("file", F.input_file_name())
        bitmaps = F.greatest(F.lit(1), F.ceil(F.col("n") * BITS_PER_KEY / BITMAP)).cast("int")
        listed = cut_lineage(stored.groupBy("file").agg(
            F.count(F.lit(1)).alias("n"), F.min(self.on[0]).alias("low"), F.max(self.on[0]).alias("high")).withColumn("bitmaps", bitmaps))
        bits = stored.select("file", *self.on).join(listed.select("file", "bitmaps"), "file").select("file", F.explode(self._positions(F.col("bitmaps"))).alias("p"))
        bits.groupBy("file", "p.bitmap").agg(F.bitmap_construct_agg("p.position").alias("bits")).write.mode("overwrite").parquet(
            f"{self.root}/filters/v{version:08d}")
        return listed

    def _commit(self, listed: DataFrame, version: int) -> int:
        listed.select("file", "n", "low", "high", "bitmaps").coalesce(1).write.mode("overwrite").parquet(f"{self.root}/manifest/v{version:08d}")
        return version

    def replace(self, df: DataFrame) -> int:
        """Stores ``df`` as the next version, whatever there was."""
        version = (self.versions() or [0])[-1] + 1
        return self._commit(self._write(df, version), version)

    # --- which files may match -------------------------------------------------------

    def candidates(self, source: DataFrame) -> list[str]:
        """The files that may hold a key of ``source``.

        Ranges come to the driver, one per file, as a listing of files does.
        Keys find the ranges they lie in by binary search, and (key, file)
        pairs that do are tested against the filters by joins.
        """
        ranges = sorted(((r["low"], r["high"], r["file"], r["bitmaps"]) for r in self.manifest().where("low IS NOT NULL").collect()), key=lambda r: r[:3])
        if not ranges:
            return []
        lows, reach = [r[0] for r in ranges], []
        for r in ranges:  # the highest key of this file and all before it
            reach.append(r[1] if not reach or r[1] > reach[-1] else reach[-1])

        @F.pandas_udf("array<int>")
        def holding(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                out = []
                for key in batch:
                    own, i = [], bisect_right(lows, key) - 1
                    while i >= 0 and reach[i] >= key:
                        if ranges[i][1] >= key:
                            own.append(i)
                        i -= 1
                    out.append(own)
                yield pd.Series(out, dtype=object)

        keys = source.select(*self.on).dropna().distinct()
        numbered = self.spark.createDataFrame([(i, r[2], r[3]) for i, r in enumerate(ranges)], "at int, file string, bitmaps int")
        pairs = keys.withColumn("at", F.explode(holding(self.on[0]))).join(numbered, "at")
        probes = pairs.select("file", F.xxhash64(*self.on).alias("key"), F.explode(self._positions(F.col("bitmaps"))).alias("p")).select("file", "key", "p.*")
        filters = self.spark.read.schema("file string, bitmap int, bits binary").parquet(f"{self.root}/filters/*")
        met = probes.join(filters, ["file", "bitmap"])
        byte = F.conv(F.hex(F.substring("bits", F.floor(F.col("position") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        is_set = F.pmod(F.floor(byte / F.pow(F.lit(2), F.col("position") % 8)), F.lit(2)) == 1
        hits = met.where(is_set).groupBy("file", "key").agg(F.count_distinct("bitmap", "position").alias("n"))
        asked = probes.groupBy("file", "key").agg(F.count_distinct("bitmap", "position").alias("of"))
        return [r[0] for r in hits.join(asked, ["file", "key"]).where("n = of").select("file").distinct().collect()]

    # --- MERGE ---------------------------------------------------------------------------

    def merge(self, source: DataFrame, clauses: Sequence, **options) -> Merged:
        """MERGE of ``source`` into the table: as ``operators.merge.merge`` over
        the whole, but only files that may match are read and written again."""
        source = cut_lineage(source)
        before, version = self.manifest(), (self.versions() or [0])[-1] + 1
        chosen = self.candidates(source)
        result = merge(self._rows(chosen), source, self.on, clauses, **options)
        new = self._write(result, version)
        kept = before.where(~F.col("file").isin(chosen)) if chosen else before
        total = before.count()
        self._commit(cut_lineage(kept.unionByName(new)), version)
        return Merged(version, len(chosen), total)
