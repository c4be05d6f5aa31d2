"""A corpus cleaned in five stages, each one operator of ``freshet.llm``.

Every stage is a function of (spark, docs, sf_dir).  What it returns is written
as Parquet and read again as the next one's ``docs``, so a lost executor costs
one stage at most.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm import decontamination, jaccard_join, language_id, line_dedup, sentencepiece_io
from freshet.llm.common import WORD, documents
from freshet.session import release_scratch, scratch_path, scratch_paths

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Share of its n-grams that a language has to hold of a text; unrelated texts stay under 0.06, the documents at hand above 0.5.
MIN_COVERAGE = 0.25
_LEFT: dict[str, list[str]] = {}  # application -> intermediates of the stage that ran last


def stage(work: Stage) -> Stage:
    """A stage that deletes the intermediates of the one before: what that one
    returned has been written by now."""
    @wraps(work)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        application = spark.sparkContext.applicationId
        release_scratch(spark, _LEFT.pop(application, []))
        before = set(scratch_paths(spark))
        result = work(spark, docs, sf_dir)
        _LEFT[application] = [p for p in scratch_paths(spark) if p not in before]
        return result

    return run_stage


@stage
def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the corpus names, with the language found
    as ``lang``.  Texts without letters and texts of whose n-grams that language
    holds less than ``MIN_COVERAGE`` are rejected."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]).alias("row"), "text")
    found = language_id.identify(packed, language_id.fit(docs)).where(
        (F.col("lang_pred") != language_id.UNKNOWN) & (F.col("coverage") >= MIN_COVERAGE))
    return found.select(*[F.col("lang_pred" if c == "lang" else f"row.c{i}").alias(c) for i, c in enumerate(docs.columns)])


@stage
def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of three-line windows are cut; a document of which no
    word is left goes."""
    own = {c: f"given {c}" for c in docs.columns if c == "lines_removed"}  # not to be replaced by the operator's
    return line_dedup.dedup_lines(docs.withColumnsRenamed(own)).where(F.col("text").rlike(WORD)).select(
        *[(F.length("text").cast("long") if c == "n_chars" else F.col(f"`{own.get(c, c)}`")).alias(c) for c in docs.columns])


@stage
def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return jaccard_join.keep_one(docs).select(*[F.col(f"`{c}`") for c in docs.columns])


@stage
def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet").select("item_id", "text")
    return decontamination.decontaminate(docs, items).select(*[F.col(f"`{c}`") for c in docs.columns])


@stage
def as_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the ids of their pieces and how many there are."""
    return sentencepiece_io.encode(docs).withColumn("n_tokens", F.size("token_ids").cast("long"))


STAGES = [
    ("language_id", known_language),
    ("line_dedup", without_repeated_lines),
    ("near_duplicates", one_of_each_group),
    ("decontamination", without_benchmark),
    ("tokens", as_tokens),
]

#: The model of a language and the pieces of a text can't be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, work in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        work(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
