"""Ranked text search (BM25) and vector search.

``bm25`` answers one question by scanning the texts once; the frequencies of its
few terms are counted inside each row, so no word is shuffled.
``build_index`` stores postings once for many questions, and ``search_index``
answers a table of them.  ``vector_topk`` keeps the best matches per task before
anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

# The usual BM25 parameters, and the most results a search gives.
K1, B = 1.2, 0.75
MAX_RESULTS = 10
# Vector questions answered in one pass, about so many; their vectors travel to every task.
QUESTIONS_PER_PASS = 256

# Columns a text search over invoices returns (fixed values).
INVOICE_SEARCH_COLUMNS = [
    "invoice_id", "invoice_number", "line_description", "vendor_name", "approval_status",
    "source_system", "cost_center", "gl_account", "po_number",
]


def searchable_invoices(invoices: DataFrame) -> DataFrame:
    return invoices.select(*INVOICE_SEARCH_COLUMNS)


def tokens(text: Column | str) -> Column:
    """Lower-case words: runs of letters and digits."""
    text = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def occurrences(words: Column | str, term: str) -> Column:
    """How often a word occurs; ARRAY_REMOVE stays in generated code, where a
    filter with a lambda would not."""
    return F.size(words) - F.size(F.array_remove(words, term))


def question_terms(question: str) -> list[str]:
    import re

    return list(dict.fromkeys(re.findall(r"[^\W_]+", question.lower())))


def _filtered(docs: DataFrame, filters: Mapping[str, object] | None) -> DataFrame:
    for column, value in (filters or {}).items():
        docs = docs.where(F.col(column).isin(list(value)) if isinstance(value, (list, tuple, set)) else F.col(column) == value)
    return docs


def _idf(total: Column, with_term: Column) -> Column:
    return F.log(F.lit(1.0) + (total - with_term + 0.5) / (with_term + 0.5))


def _saturation(tf: Column, length: Column, average: Column) -> Column:
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / average))


def bm25(docs: DataFrame, id_column: str, text: str, question: str, k: int = MAX_RESULTS,
         filters: Mapping[str, object] | None = None, digits: int = 6) -> DataFrame:
    """The ``k`` texts that match the question best: id, filter columns, score.

    Word statistics come from all texts, filters narrow the answer only.  The
    texts are read and split once; what is kept of each is its length and the
    counts of the question's terms, and both the statistics and the ranking
    work on that.  Scores are rounded before ranking so that equal texts tie
    and the id decides.
    """
    terms = question_terms(question)
    kept = [id_column, *[c for c in (filters or {}) if c != id_column]]
    if not terms:
        return docs.select(*kept, F.lit(0.0).alias("score")).limit(0)
    words = docs.select(*kept, tokens(text).alias("_words"))
    counted = cut_lineage(words.select(
        *kept, F.size("_words").alias("_len"), *[occurrences("_words", t).alias(f"_tf{i}") for i, t in enumerate(terms)]))
    tfs = [F.col(f"_tf{i}") for i in range(len(terms))]
    stats = counted.agg(F.struct(
        F.count(F.lit(1)).alias("n"), F.avg("_len").alias("len"),
        *[F.count_if(tf > 0).alias(f"df{i}") for i, tf in enumerate(tfs)],
    ).alias("s")).scalar()
    score = F.lit(0.0)
    for i, tf in enumerate(tfs):
        score = score + _idf(stats["n"], stats[f"df{i}"]) * _saturation(tf, F.col("_len"), stats["len"])
    matched = _filtered(counted, filters).where(F.greatest(F.lit(0), *tfs) > 0)
    return matched.select(*kept, F.round(score, digits).alias("score")).orderBy(F.col("score").desc(), id_column).limit(k)


def build_index(docs: DataFrame, id_column: str, text: str, attributes: Sequence[str] = ()) -> DataFrame:
    """Postings (term, id, tf, length, attributes): the inverted index.

    Store it clustered by term (``files.write_clustered``) to make searches
    read the files of their terms only.
    """
    # the length is taken before the words are spread over rows, not per word
    split = docs.select(id_column, *attributes, tokens(text).alias("_words")).withColumn("length", F.size("_words"))
    rows = split.select(id_column, *attributes, "length", F.explode("_words").alias("term"))
    return rows.groupBy("term", id_column, "length", *attributes).agg(F.count(F.lit(1)).alias("tf"))


def search_index(index: DataFrame, id_column: str, docs_total: Column, average_length: Column, questions: DataFrame,
                 k: int = MAX_RESULTS, filters: Mapping[str, object] | None = None, digits: int = 6) -> DataFrame:
    """The best ``k`` ids per question; ``questions`` has (question_id, text).

    ``docs_total`` and ``average_length`` describe the indexed texts (scalars).
    """
    asked = questions.select("question_id", F.explode(F.array_distinct(tokens("text"))).alias("term"))
    wanted = index.join(asked.select("term").distinct(), "term", "left_semi")
    frequency = wanted.groupBy("term").agg(F.count(F.lit(1)).alias("_df"))
    weighted = asked.join(frequency, "term").withColumn("_idf", _idf(docs_total, F.col("_df")))
    hits = _filtered(wanted, filters).join(weighted, "term")
    part = F.col("_idf") * _saturation(F.col("tf"), F.col("length"), average_length)
    scored = hits.groupBy("question_id", id_column).agg(F.round(F.sum(part), digits).alias("score"))
    best = Window.partitionBy("question_id").orderBy(F.col("score").desc(), id_column)
    return scored.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k)


def vector_topk(vectors: DataFrame, id_column: str, vector: str, questions: DataFrame, k: int = MAX_RESULTS,
                filters: Mapping[str, object] | None = None, digits: int = 9) -> DataFrame:
    """The ``k`` most similar vectors per question, by cosine.

    ``questions``: (question_id, vector), any number; they are asked in blocks
    of about ``QUESTIONS_PER_PASS``, one pass over the vectors per block.  Each
    task multiplies its batches with the questions and hands on its own best
    ``k`` per question, so the final ranking sees k rows per task and question.
    A NULL vector, or one with a NULL in it, scores NULL and comes last; a
    vector of another length than the questions' is an error.
    """
    blocks = max(1, -(-questions.count() // QUESTIONS_PER_PASS))
    block = F.pmod(F.xxhash64("question_id"), F.lit(blocks))
    local = None
    for i in range(blocks):
        asked = questions.where(block == i).select("question_id", "vector").collect()
        part = _best_of_tasks(vectors, id_column, vector, asked, questions, k, filters, digits)
        local = part if local is None else local.unionByName(part)
    best = Window.partitionBy("question_id").orderBy(F.col("score").desc_nulls_last(), id_column)
    return local.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k)


def _best_of_tasks(vectors: DataFrame, id_column: str, vector: str, asked: list, questions: DataFrame, k: int,
                   filters: Mapping[str, object] | None, digits: int) -> DataFrame:
    """The best ``k`` vectors of each task for one block of questions."""
    names = [row["question_id"] for row in asked]
    matrix = np.array([row["vector"] for row in asked], dtype=np.float64).reshape((len(asked), -1) if asked else (0, 0))
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    matrix = np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)
    width = matrix.shape[1] if len(asked) else 0
    id_type = vectors.select(id_column).schema[0].dataType.simpleString()
    name_type = questions.select("question_id").schema[0].dataType.simpleString()

    def best_of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, list[tuple[float, object]]] = {q: [] for q in range(len(names))}
        for batch in batches:
            ids = np.array(batch.column(0).to_pylist())
            lengths = pc.list_value_length(batch.column(1)).to_numpy(zero_copy_only=False)
            given = batch.column(1).is_valid().to_numpy(zero_copy_only=False)
            if (lengths[given] != width).any():
                raise ValueError(f"{vector}: a vector does not have the {width} elements of the questions")
            rows = np.full((len(ids), width), np.nan)
            rows[given] = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
            whole = ~np.isnan(rows).any(axis=1)
            size = np.linalg.norm(rows, axis=1)
            cosine = np.divide(rows @ matrix.T, size[:, None], out=np.zeros((len(rows), len(names))), where=size[:, None] > 0)
            cosine = np.where(whole[:, None], np.round(cosine, digits), -np.inf)
            for q in kept:
                scores = cosine[:, q]
                # everything from the k-th best score on, ties included
                floor = np.partition(scores, -k)[-k] if len(scores) > k else -np.inf
                better = np.flatnonzero(scores >= floor)
                best = better[np.lexsort((ids[better], -scores[better]))[:k]]
                kept[q] = sorted(kept[q] + [(-scores[i], ids[i].item()) for i in best])[:k]
        rows = [(names[q], key, -score) for q, best in kept.items() for score, key in best]
        if rows:
            yield pa.RecordBatch.from_pydict({
                "question_id": [r[0] for r in rows], id_column: [r[1] for r in rows], "score": [float(r[2]) if np.isfinite(r[2]) else None for r in rows]})

    usable = _filtered(vectors, filters).select(id_column, vector)
    if not names:
        usable = usable.limit(0)
    return usable.mapInArrow(best_of_task, f"question_id {name_type}, `{id_column}` {id_type}, score double")


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine of two vector columns as an expression."""
    def dot(x, y):
        return F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)

    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))
