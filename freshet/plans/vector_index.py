"""An index for exact vector search that skips what can't be among the best.

Vectors are stored by cell: the nearest of a fixed number of centres, and a
ring of the angle to it.  For every cell the index knows the least and the
greatest angle between its vectors and its centre.  By the triangle inequality
of angles no vector of a cell is nearer to a question than the question's own
angle to the centre allows, so a cell whose bound is below the k-th score found
so far is not read.  A search reads the most promising cells of each question,
takes the k-th score from them, and then reads the cells that could still beat
it; the others are pruned as partition folders, before any file is opened.

Centres and rings come from a bounded sample and decide only what can be
skipped; bounds come from all vectors, so the answers are those of a full scan.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .search import MAX_RESULTS, QUESTIONS_PER_PASS, _filtered

CENTRES, RINGS, SAMPLE, ROUNDS = 32, 4, 8192, 8
#: Cells of vectors without direction and without value.
ZERO, MISSING = -1, -2
#: More than the rounding of angles and of scores.
MARGIN = 1e-7


@dataclass(frozen=True)
class VectorIndex:
    spark: SparkSession
    path: str
    id_column: str
    layout: str  # columns and types of the rows

    def rows(self) -> DataFrame:
        """id, vector, attributes, and the cell as partition column."""
        return self.spark.read.schema(self.layout).parquet(f"{self.path}/rows")

    def cells(self) -> DataFrame:
        """One row per cell: centre, least and greatest angle, number of vectors."""
        return self.spark.read.schema("cell int, least double, most double, n long, centre int, point array<double>").parquet(f"{self.path}/cells")


@dataclass(frozen=True)
class Found:
    rows: DataFrame  # question_id, id, score, place
    read: int  # (question, cell) pairs that were read
    of: int  # and that there are


def _unit(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    size = np.linalg.norm(rows, axis=1)
    with np.errstate(invalid="ignore"):
        return np.divide(rows, size[:, None], out=rows * 0, where=size[:, None] > 0), size  # what is no number stays none


def _matrix(column: pa.Array, width: int, name: str) -> np.ndarray:
    """Vectors as rows; one that is NULL or holds NULL is NaN throughout."""
    given = column.is_valid().to_numpy(zero_copy_only=False)
    if (pc.list_value_length(column).to_numpy(zero_copy_only=False)[given] != width).any():
        raise ValueError(f"{name}: a vector does not have {width} elements like the others")
    rows = np.full((len(column), width), np.nan)
    rows[given] = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
    rows[np.isnan(rows).any(axis=1)] = np.nan
    return rows


def _angles(unit: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(unit @ centres.T, -1.0, 1.0))


def centres_of(sample: np.ndarray, count: int, rounds: int = ROUNDS) -> np.ndarray:
    """Unit centres of a sample: the first vectors, moved to the mean of those nearest to them."""
    centres = sample[:count].copy()
    for _ in range(rounds if len(sample) else 0):
        nearest = (sample @ centres.T).argmax(axis=1)
        for c in range(len(centres)):
            if (nearest == c).any():
                mean = sample[nearest == c].sum(axis=0)
                size = np.linalg.norm(mean)
                centres[c] = mean / size if size > 0 else centres[c]
    return centres


def build_vector_index(vectors: DataFrame, id_column: str, vector: str, path: str, attributes: Sequence[str] = (),
                       centres: int = CENTRES, rings: int = RINGS, sample: int = SAMPLE, salts: int = 8) -> VectorIndex:
    """Stores ``vectors`` by cell below ``path``.

    ``sample`` bounds the vectors that reach the driver to choose centres and
    the edges of rings.  A cell, however large, is written by up to ``salts``
    tasks.  All vectors have one length; NULL vectors and vectors with a NULL or
    NaN in them are kept in a cell of their own, and so are those of length 0.
    """
    spark = vectors.sparkSession
    some = vectors.where(F.col(vector).isNotNull()).orderBy(F.xxhash64(id_column), id_column).limit(sample).select(vector).collect()
    width = len(some[0][0]) if some else 0
    whole = [r[0] for r in some if len(r[0]) == width and all(x is not None and np.isfinite(x) for x in r[0])]
    unit, size = _unit(np.array(whole, dtype=np.float64).reshape(len(whole), width))
    chosen = centres_of(unit[size > 0], centres)
    edges = np.zeros((len(chosen), rings - 1))
    if len(chosen):
        angles = _angles(unit[size > 0], chosen)
        nearest = angles.argmin(axis=1)
        for c in range(len(chosen)):
            own = angles[nearest == c, c]
            edges[c] = np.quantile(own, np.arange(1, rings) / rings) if len(own) else 0

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, length = _unit(_matrix(batch.column(0), width, vector))
            cell, angle = np.full(len(own), MISSING, dtype=np.int32), np.zeros(len(own))
            cell[length == 0] = ZERO
            at = np.flatnonzero((length > 0) & np.isfinite(length))
            if len(at):
                every = _angles(own[at], chosen)
                c = every.argmin(axis=1)
                angle[at] = every[np.arange(len(at)), c]
                cell[at] = c * rings + (angle[at, None] > edges[c]).sum(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(angle)], names=[*batch.schema.names, "cell", "angle"])

    kept = vectors.select(F.col(vector).alias("vector"), F.col(id_column), *attributes)
    placed = kept.mapInArrow(place, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema) + ", cell int, angle double")
    placed.repartition("cell", F.pmod(F.xxhash64(id_column), F.lit(salts))).write.partitionBy("cell").parquet(f"{path}/rows")
    index = VectorIndex(spark, path, id_column, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in placed.schema))
    bounds = index.rows().groupBy("cell").agg(F.min("angle").alias("least"), F.max("angle").alias("most"), F.count(F.lit(1)).alias("n"))
    points = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(chosen)], "centre int, point array<double>")
    bounds.withColumn("centre", F.floor(F.col("cell") / rings).cast("int")).join(points, "centre", "left").select(
        "cell", "least", "most", "n", "centre", "point").write.parquet(f"{path}/cells")
    return index


def bounds_of(cells: list, asked: np.ndarray) -> np.ndarray:
    """The greatest cosine that a question (row) can have with a vector of a cell (column); -inf where there is no score."""
    out = np.zeros((len(asked), len(cells)))
    for j, cell in enumerate(cells):
        if cell["cell"] == MISSING:
            out[:, j] = -np.inf
        elif cell["cell"] != ZERO:
            own = _angles(asked, np.array([cell["point"]]))[:, 0]
            out[:, j] = np.cos(np.maximum(0, np.maximum(own - cell["most"], cell["least"] - own)))
    out[~asked.any(axis=1)] = np.where([c["cell"] == MISSING for c in cells], -np.inf, 0.0)  # a question without direction
    return out


def search_vector_index(index: VectorIndex, questions: DataFrame, k: int = MAX_RESULTS, filters: Mapping[str, object] | None = None,
                        digits: int = 9) -> Found:
    """The ``k`` most similar vectors per question, as ``search.vector_topk`` gives them, and how much was read for it.

    ``questions``: (question_id, vector), any number, asked in blocks of about
    ``QUESTIONS_PER_PASS``; the driver holds one block, its k best scores and
    one row per cell.  ``filters`` are over the stored attributes.
    """
    cells = sorted(index.cells().collect(), key=lambda c: c["cell"])  # centres x rings
    blocks = max(1, -(-questions.count() // QUESTIONS_PER_PASS))
    parts, read, total = [], 0, 0
    for i in range(blocks):
        asked = questions.where(F.pmod(F.xxhash64("question_id"), F.lit(blocks)) == i).select("question_id", "vector").collect()
        if not asked or not cells:
            continue
        unit, _ = _unit(np.array([r["vector"] for r in asked], dtype=np.float64))
        bounds = bounds_of(cells, unit)
        first = _promising(bounds, np.array([c["n"] for c in cells]), k)
        best = _best_in(index, cells, first, asked, unit, questions, k, filters, digits)
        reached: dict = {}
        for r in _ranked(best, index.id_column, k).where((F.col("place") == k) & F.col("score").isNotNull()).collect():  # one per question
            reached[r["question_id"]] = r["score"]
        floor = np.array([reached.get(r["question_id"], -np.inf) for r in asked])
        rest = ~first & (bounds >= floor[:, None] - MARGIN)
        parts += [best, _best_in(index, cells, rest, asked, unit, questions, k, filters, digits)]
        read, total = read + int(first.sum() + rest.sum()), total + first.size
    if not parts:
        parts = [_best_in(index, cells, np.zeros((0, len(cells)), dtype=bool), [], np.zeros((0, 0)), questions, k, filters, digits)]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return Found(_ranked(every, index.id_column, k).where(F.col("place") <= k), read, total)


def _ranked(scores: DataFrame, id_column: str, k: int) -> DataFrame:
    best = Window.partitionBy("question_id").orderBy(F.col("score").desc_nulls_last(), id_column)
    return scores.withColumn("place", F.row_number().over(best))


def _promising(bounds: np.ndarray, counts: np.ndarray, k: int) -> np.ndarray:
    """Per question the cells with the highest bounds, as many as hold ``k`` vectors."""
    out = np.zeros(bounds.shape, dtype=bool)
    for q, own in enumerate(bounds):
        order = np.argsort(-own, kind="stable")
        enough = int(np.searchsorted(np.cumsum(counts[order]), k)) + 1
        out[q, order[:enough]] = True
    return out


def _best_in(index: VectorIndex, cells: list, wanted: np.ndarray, asked: list, unit: np.ndarray, questions: DataFrame, k: int,
             filters: Mapping[str, object] | None, digits: int) -> DataFrame:
    """The best ``k`` of each task for the (question, cell) pairs ``wanted``."""
    names, id_column = [r["question_id"] for r in asked], index.id_column
    by_cell = {c["cell"]: np.flatnonzero(wanted[:, j]) for j, c in enumerate(cells) if len(wanted) and wanted[:, j].any()}
    rows = _filtered(index.rows(), filters).where(F.col("cell").isin([int(c) for c in by_cell])).select("cell", "vector", id_column)
    width = unit.shape[1]

    def best_of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, list[tuple[float, object]]] = {}
        for batch in batches:
            cell, ids = batch.column(0).to_numpy(), np.array(batch.column(2).to_pylist())
            for c in np.unique(cell).tolist():
                at = np.flatnonzero(cell == c)
                own, _ = _unit(_matrix(batch.column(1).take(pa.array(at)), width, "vector"))
                scores = own @ unit[by_cell[c]].T
                scores = np.where(np.isnan(scores), -np.inf, np.round(scores, digits))
                for j, q in enumerate(by_cell[c].tolist()):
                    floor = np.partition(scores[:, j], -k)[-k] if len(at) > k else -np.inf
                    better = np.flatnonzero(scores[:, j] >= floor)
                    better = better[np.lexsort((ids[at[better]], -scores[better, j]))[:k]]
                    kept[q] = sorted(kept.get(q, []) + [(-scores[i, j], ids[at[i]].item()) for i in better])[:k]
        rows = [(names[q], key, float(-s) if np.isfinite(s) else None) for q, best in kept.items() for s, key in best]
        if rows:
            yield pa.RecordBatch.from_pydict({"question_id": [r[0] for r in rows], id_column: [r[1] for r in rows],
                                              "score": pa.array([r[2] for r in rows], pa.float64())})

    kinds = {n: df.schema[n].dataType.simpleString() for df, n in ((questions, "question_id"), (rows, id_column))}
    return rows.mapInArrow(best_of_task, f"question_id {kinds['question_id']}, `{id_column}` {kinds[id_column]}, score double")
