"""Vector codes: product quantisation with codebooks that resident members keep up.

Vectors of whole numbers are cut into equal consecutive parts, and every part
position has a codebook.  A part is a row, and the rows are dealt by (position,
entry, salt): the bucket of such a key owns the members of that entry.  A
round of Lloyd's algorithm is

* **update**: every owner adds up its resident members.  The table is bucketed
  by its key, so the sums need no exchange; only one row per key goes on to
  the floor means, of which there are entries x positions;
* **assign and migrate**: every owner compares its members with the codebook of
  their position.  Members that stay are written where they are, and only
  parts that change their entry go through the shuffle to their new owner.

Salts come from the row and not from the entry, so an entry that holds a third
of all parts has as many owners as any other number of salts.  Every round's
table is written to the shared folder, where a lost executor finds it again.
The codebooks (entries x vector components) are all that the driver holds.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import release_scratch, scratch_path, shuffles_released, written
from .vectors import floor_mean, usable, whole_numbers

PARTS, ENTRIES, ROUNDS, SCALE, DIMENSION = 8, 16, 6, 4096, 64
OWNER = ["position", "entry", "salt"]
#: Distances that a task holds at once.
AT_ONCE = 1 << 20

Codebooks = list[list[list[int]]]  # by position and entry


@dataclass
class Members:
    """A stored table of members, bucketed by its owners."""
    spark: SparkSession
    name: str
    path: str

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        release_scratch(self.spark, [self.path])


def components(width: int) -> list[str]:
    return [f"x{i}" for i in range(width)]


def parts_of(rows: DataFrame, parts: int, width: int, salts: int) -> DataFrame:
    """One row per part of ``rows`` (row, vec_id, label, q); the first part alone carries id and label."""
    return rows.select("row", "vec_id", "label", "q", F.explode(F.array(*[F.lit(p) for p in range(parts)])).alias("position")).select(
        "row", F.when(F.col("position") == 0, F.col("vec_id")).alias("vec_id"), F.when(F.col("position") == 0, F.col("label")).alias("label"),
        "position", F.pmod(F.xxhash64("row"), F.lit(salts)).cast("int").alias("salt"),
        *[F.get("q", F.col("position") * width + i).alias(x) for i, x in enumerate(components(width))])


def nearest(codebooks: Codebooks, width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds the nearest entry of a part's codebook (ties: the lower one) as ``next`` and the squared distance to it."""
    books = [np.array(book, dtype=np.int64).reshape(-1, width) for book in codebooks]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            position = batch.column("position").to_numpy(zero_copy_only=False)
            x = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in components(width)], axis=1)
            entry, distance = np.zeros(len(x), np.int32), np.zeros(len(x), np.int64)
            for p in np.unique(position).tolist():
                at, book = np.flatnonzero(position == p), books[p]
                step = max(1, AT_ONCE // max(1, book.size))
                for k in range(0, len(at), step):
                    own = at[k:k + step]
                    apart = ((x[own, None, :] - book[None]) ** 2).sum(axis=2)
                    entry[own] = apart.argmin(axis=1)
                    distance[own] = apart[np.arange(len(own)), entry[own]]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(entry), pa.array(distance)], names=[*batch.schema.names, "next", "distance"])

    return run


def assigned(members: DataFrame, codebooks: Codebooks, width: int) -> DataFrame:
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in members.schema) + ", next int, distance bigint"
    return members.mapInArrow(nearest(codebooks, width), schema)


def migrated(members: DataFrame, codebooks: Codebooks, width: int, owners: int) -> DataFrame:
    """The members under their new entries; only those that change it are shuffled."""
    names = members.columns
    at = assigned(members, codebooks, width)
    moved = at.where("next <> entry").drop("entry").withColumnRenamed("next", "entry").select(*names).repartition(owners, *OWNER)
    return at.where("next = entry").select(*names).unionByName(moved)


def stored(members: DataFrame, owners: int) -> Members:
    spark = members.sparkSession
    table = Members(spark, f"members_{uuid.uuid4().hex}", scratch_path(spark, "members"))
    with shuffles_released(spark):
        members.write.format("parquet").option("compression", "zstd").option("path", table.path).bucketBy(owners, *OWNER).saveAsTable(table.name)
    return table


def owner_sums(members: DataFrame, width: int) -> DataFrame:
    """Sums and counts of resident members, by owner and then by entry."""
    return (members.groupBy(*OWNER).agg(F.count(F.lit(1)).alias("n"), *[F.sum(x).alias(x) for x in components(width)])
            .groupBy("position", "entry").agg(F.sum("n").alias("n"), *[F.sum(x).alias(x) for x in components(width)]))


def updated(codebooks: Codebooks, members: DataFrame, width: int) -> Codebooks:
    new = [[list(entry) for entry in book] for book in codebooks]
    for r in owner_sums(members, width).collect():  # entries x positions
        new[r["position"]][r["entry"]] = [floor_mean(r[x], r["n"]) for x in components(width)]
    return new


@dataclass
class Codes:
    rows: DataFrame  # vec_id, label, code, error
    codebooks: Codebooks

    def digest(self) -> str:
        numbers = (str(x) for book in self.codebooks for entry in book for x in entry)
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, dimension: int = DIMENSION,
             vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> Codes:
    """Codes of ``vectors`` and the codebooks they refer to.

    Each component becomes floor(scale * x).  Codebooks start as the parts of
    the rows with the smallest ids and follow ``rounds`` rounds; an unused
    entry stays as it is.  ``code`` has two hex digits a part, ``error`` is the
    squared distance between a vector and what its code stands for.

    Rows whose vector is NULL, holds NULL or a non-finite component, or has
    another length than ``dimension`` (a multiple of ``parts``) have no code and
    do not come back.  Repeated rows and ids each have their code; equal ids
    start the codebooks in the order of their vectors, NULL ids last.  With
    fewer rows than entries there are fewer entries; without rows there are
    none, and no codes.  NULL labels are kept.  Other columns are not read.
    """
    if dimension % parts or entries > 256 or rounds < 1:
        raise ValueError("parts have to be equal, a code names at most 256 entries, and there is at least one round")
    spark, width = vectors.sparkSession, dimension // parts
    # as many owners as the session has shuffle partitions, and enough salts that every entry is spread over all of them
    owners = int(spark.conf.get("spark.sql.shuffle.partitions"))
    given = vectors.select(F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{label}`").alias("label"), F.col(f"`{vector}`").alias("v"))
    base, base_path = written(given.where(usable(F.col("v"), dimension)).select(
        F.monotonically_increasing_id().alias("row"), "vec_id", "label", whole_numbers(F.col("v"), scale).alias("q")), "vectors")
    first = base.orderBy(F.col("vec_id").asc_nulls_last(), "q").select("q").limit(entries).collect()
    codebooks: Codebooks = [[list(r["q"][p * width:(p + 1) * width]) for r in first] for p in range(parts)]
    pieces = parts_of(base, parts, width, max(16, owners))
    if not first:
        return Codes(base.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("bigint").alias("error")), codebooks)
    placed = assigned(pieces, codebooks, width).withColumnRenamed("next", "entry").drop("distance")
    members = stored(placed.repartition(owners, *OWNER), owners)
    for _ in range(rounds - 1):
        new = updated(codebooks, members.rows(), width)
        if new == codebooks:
            break  # nothing can change any more
        codebooks, old = new, members
        members = stored(migrated(old.rows(), codebooks, width, owners), owners)
        old.drop()
    codebooks = updated(codebooks, members.rows(), width)
    pair = F.struct("position", "next")
    rows, _ = written(assigned(members.rows(), codebooks, width).groupBy("row").agg(
        F.max("vec_id").alias("vec_id"), F.max("label").alias("label"), F.sum("distance").alias("error"), F.sort_array(F.collect_list(pair)).alias("pairs")
    ).select("vec_id", "label", F.lower(F.array_join(F.transform("pairs", lambda p: F.lpad(F.hex(p["next"].cast("bigint")), 2, "0")), "")).alias("code"), "error"), "codes")
    members.drop()
    release_scratch(spark, [base_path])
    return Codes(rows, codebooks)


def with_label_errors(codes: Codes) -> DataFrame:
    """The codes with the error of all rows of their label (NULL labels together) and the digest of the codebooks."""
    by_label = codes.rows.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return codes.rows.join(by_label, F.col("label").eqNullSafe(F.col("of"))).drop("of").withColumn("codebooks_sha256", F.lit(codes.digest()))
