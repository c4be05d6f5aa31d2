"""A BM25 index whose blocks say how high a score they can give.

Documents are put into buckets by length; a block is what one word has in one
bucket, and the index keeps the greatest impact (the part of the score that
does not depend on the question) of every block.  For a question the bound of a
bucket is the sum, over the question's words, of inverse frequency times
greatest impact.  All postings of a document lie in its bucket, so a bucket
that is read gives final scores.  A search reads the buckets with the highest
bounds, takes the k-th score, and then reads only buckets whose bound reaches
it; a bucket in which no word of the question occurs is never read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .search import MAX_RESULTS, _filtered, _idf, _saturation, tokens

BUCKETS = 32
#: More than the rounding of scores.
MARGIN = 1e-5


@dataclass(frozen=True)
class TextIndex:
    spark: SparkSession
    path: str
    id_column: str
    layout: str  # columns and types of the postings

    def postings(self) -> DataFrame:
        """term, id, length, tf, attributes, and the bucket as partition column."""
        return self.spark.read.schema(self.layout).parquet(f"{self.path}/postings")

    def blocks(self) -> DataFrame:
        """term, bucket, impact, n."""
        return self.spark.read.schema("term string, bucket int, impact double, n long").parquet(f"{self.path}/blocks")

    def statistics(self) -> DataFrame:
        """One row: number of texts, average length."""
        return self.spark.read.schema("n long, len double").parquet(f"{self.path}/statistics")


@dataclass(frozen=True)
class Found:
    rows: DataFrame  # question_id, id, score, place
    read: int  # (question, bucket) pairs that were read
    of: int  # and in which a word of the question occurs


def build_text_index(docs: DataFrame, id_column: str, text: str, path: str, attributes: Sequence[str] = (), buckets: int = BUCKETS,
                     salts: int = 4) -> TextIndex:
    """Stores the postings of ``docs`` by bucket below ``path``.

    Texts are split once.  Edges of the buckets are approximate percentiles of
    the lengths; they decide what can be skipped and not what is found.  A
    bucket is written by up to ``salts`` tasks, each of them sorted by word, so
    that readers skip row groups of other words.
    """
    spark = docs.sparkSession
    split = docs.select(id_column, *attributes, tokens(text).alias("words")).withColumn("length", F.size("words"))
    rows = split.select(id_column, *attributes, "length", F.explode("words").alias("term"))
    counted = cut_lineage(rows.groupBy("term", id_column, "length", *attributes).agg(F.count(F.lit(1)).alias("tf")))
    found = counted.agg(F.sum("tf").alias("words"), F.percentile_approx("length", [i / buckets for i in range(1, buckets)], 1000).alias("edges")).first()
    total, given = docs.agg(F.count(F.lit(1)), F.count(text)).first()
    edges = sorted(set(found["edges"] or []))
    average = (found["words"] or 0) / given if given else 0.0  # a NULL text has no length
    spark.createDataFrame([(total, float(average))], "n long, len double").coalesce(1).write.parquet(f"{path}/statistics")
    bucket = F.size(F.filter(F.array(*[F.lit(e) for e in edges]), lambda e: e < F.col("length"))) if edges else F.lit(0)
    placed = counted.withColumn("bucket", bucket)
    placed.repartition("bucket", F.pmod(F.xxhash64("term"), F.lit(salts))).sortWithinPartitions(
        "bucket", "term").write.partitionBy("bucket").parquet(f"{path}/postings")
    index = TextIndex(spark, path, id_column, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in placed.schema))
    impact = _saturation(F.col("tf"), F.col("length"), F.lit(average))
    index.postings().groupBy("term", "bucket").agg(F.max(impact).alias("impact"), F.count(F.lit(1)).alias("n")).repartitionByRange(
        "term").sortWithinPartitions("term").write.parquet(f"{path}/blocks")
    return index


def search_text_index(index: TextIndex, questions: DataFrame, k: int = MAX_RESULTS, filters: Mapping[str, object] | None = None,
                      digits: int = 6) -> Found:
    """The best ``k`` ids per question with their places, as a full scan gives
    them; ``questions`` has (question_id, text).

    All steps are joins on the question's words; what is compared are blocks
    (words of questions x buckets), never postings.  With ``filters`` the first
    buckets may hold fewer than k texts of a question; then no bucket is
    skipped for it.
    """
    asked = questions.select("question_id", F.explode(F.array_distinct(tokens("text"))).alias("term"))
    stats = index.statistics().first()
    blocks = index.blocks().join(asked.select("term").distinct(), "term", "left_semi")
    frequency = blocks.groupBy("term").agg(F.sum("n").alias("df"))
    weighted = cut_lineage(asked.join(frequency, "term").withColumn("idf", _idf(F.lit(stats["n"]), F.col("df"))))
    bounds = blocks.join(weighted, "term").groupBy("question_id", "bucket").agg(
        F.sum(F.col("idf") * F.col("impact")).alias("bound"), F.max("n").alias("n"))  # a bucket has at least n texts of the question
    order = Window.partitionBy("question_id").orderBy(F.col("bound").desc(), "bucket")
    bounds = cut_lineage(bounds.withColumn("before", F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))))
    first = bounds.where(F.col("before") < k)
    best = cut_lineage(_best_in(index, weighted, first, stats, k, filters, digits))
    reached = best.where(F.col("place") == k).select("question_id", F.col("score").alias("floor"))
    rest = cut_lineage(bounds.where(F.col("before") >= k).join(reached, "question_id", "left").where(
        F.col("floor").isNull() | (F.col("bound") >= F.col("floor") - MARGIN)))
    more = _best_in(index, weighted, rest, stats, k, filters, digits)
    last = Window.partitionBy("question_id").orderBy(F.col("score").desc(), index.id_column)
    rows = best.drop("place").unionByName(more.drop("place")).withColumn("place", F.row_number().over(last)).where(F.col("place") <= k)
    return Found(rows, first.count() + rest.count(), bounds.count())


def _best_in(index: TextIndex, weighted: DataFrame, wanted: DataFrame, stats, k: int, filters: Mapping[str, object] | None, digits: int) -> DataFrame:
    """The best ``k`` per question within the buckets that are wanted for it."""
    buckets = [r[0] for r in wanted.select("bucket").distinct().collect()]  # at most all buckets
    terms = wanted.select("question_id", "bucket").join(weighted, "question_id")
    postings = _filtered(index.postings(), filters).where(F.col("bucket").isin(buckets))
    part = F.col("idf") * _saturation(F.col("tf"), F.col("length"), F.lit(stats["len"]))
    scored = postings.join(terms, ["term", "bucket"]).groupBy("question_id", index.id_column).agg(F.round(F.sum(part), digits).alias("score"))
    best = Window.partitionBy("question_id").orderBy(F.col("score").desc(), index.id_column)
    return scored.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k)
