"""Line dedup over windows of three consecutive lines, in DataFrame functions.

A window is three consecutive lines that hold a word, blank lines between them
passed over.  A window that occurs more than once in the whole corpus stays
where it occurs first (lowest doc_id, NULL last; then text hash; then position)
and goes wherever else it occurs; covered line ranges that overlap or touch are
merged before the text is put together again.

Only hashes and line numbers are shuffled: 128 bits per window.  A window that
a third of all documents share is one row per map task in the aggregation, and
its occurrences meet one row in a join that AQE splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD

WIDTH = 3


def _hashes(parts: list[Column]) -> list[Column]:
    """Two 64-bit hashes with different seeds."""
    return [F.xxhash64(*parts), F.xxhash64(F.lit(7), *reversed(parts))]


def windows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """Rows (doc, content, first, last, h1, h2): the line numbers that a window
    spans and its hashes.  ``content`` is the hash of the text, so that rows
    with one doc_id and different texts stay apart."""
    numbered = F.filter(
        F.transform(F.split(text, "\n", -1), lambda line, i: F.struct(i.alias("i"), line.alias("line"))),
        lambda x: x["line"].rlike(WORD))
    count = F.size("_lines") - (width - 1)
    spans = F.transform(
        F.slice(F.sequence(F.lit(0), F.greatest(count, F.lit(1))), F.lit(1), F.greatest(count, F.lit(0))),
        lambda k: F.struct(
            F.get("_lines", k)["i"].alias("first"), F.get("_lines", k + (width - 1))["i"].alias("last"),
            *[h.alias(f"h{n}") for n, h in enumerate(_hashes([F.get("_lines", k + j)["line"] for j in range(width)]), 1)]))
    return (
        docs.where(F.col(text).contains("\n"))
        .select(F.col(doc_id).alias("doc"), F.xxhash64(text).alias("content"), numbered.alias("_lines"))
        # a plain explode filters on its array, and pushing that filter down would split the text once per line
        .select("doc", "content", F.explode_outer(spans).alias("w"))
        .where("w IS NOT NULL")
        .select("doc", "content", "w.*")
    )


def repeats(found: DataFrame) -> DataFrame:
    """Windows that are not the first with their hashes: (doc, content, first, last)."""
    place = F.struct(F.col("doc").isNull().alias("n"), "doc", "content", "first")
    home = (
        found.groupBy("h1", "h2").agg(F.min(place).alias("home"), F.count(F.lit(1)).alias("n"))
        .where("n > 1").select("h1", "h2", "home")
    )
    return found.join(home, ["h1", "h2"]).where(place != F.col("home")).select("doc", "content", "first", "last")


def ranges(covered: DataFrame) -> DataFrame:
    """Merged line ranges per document: (doc, content, cuts), ascending."""
    by_doc = W.partitionBy("doc", "content").orderBy("first")
    islands = covered.distinct().withColumn(
        "opens", F.coalesce(F.col("first") > F.lag("last").over(by_doc) + 1, F.lit(True)).cast("int")
    ).withColumn("island", F.sum("opens").over(by_doc))
    merged = islands.groupBy("doc", "content", "island").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return merged.groupBy("doc", "content").agg(F.array_sort(F.collect_list(F.struct("first", "last"))).alias("cuts"))


def without_ranges(text: Column, cuts: Column) -> Column:
    """The text without the lines inside ``cuts`` (line numbers from 0)."""
    lines = F.split(text, "\n", -1)
    n = F.size(cuts)
    kept = F.flatten(F.transform(F.sequence(F.lit(0), n), lambda k: F.slice(
        lines,
        F.when(k == 0, 0).otherwise(F.get(cuts, k - 1)["last"] + 1) + 1,
        F.when(k == n, F.size(lines)).otherwise(F.get(cuts, k)["first"])
        - F.when(k == 0, 0).otherwise(F.get(cuts, k - 1)["last"] + 1))))
    return F.array_join(kept, "\n")


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """``docs`` with later occurrences of repeated windows taken out of ``text``
    and the number of lines taken out in ``lines_removed``.

    Every row comes back, with an empty text if all of it was repeated.  NULL
    and empty texts, and texts with fewer than ``width`` lines that hold a word,
    are unchanged.  Rows equal in doc_id and text are one document: what is cut
    from one is cut from the others.  Other columns pass through; a column
    ``lines_removed`` is replaced.
    """
    cuts = ranges(repeats(windows(docs, doc_id, text, width)))
    names = [c for c in docs.columns if c != "lines_removed"]
    left = docs.select(*[F.col(f"`{c}`").alias(f"d_{c}") for c in names], F.xxhash64(F.col(f"`{text}`")).alias("_content"))
    joined = left.join(cuts, F.col(f"`d_{doc_id}`").eqNullSafe(F.col("doc")) & (F.col("_content") == F.col("content")), "left")
    new = F.when(F.col("cuts").isNull(), F.col(f"`d_{text}`")).otherwise(without_ranges(F.col(f"`d_{text}`"), F.col("cuts")))
    gone = F.coalesce(F.aggregate("cuts", F.lit(0).cast("long"), lambda a, c: a + (c["last"] - c["first"] + 1)), F.lit(0).cast("long"))
    return joined.select(*[(new if c == text else F.col(f"`d_{c}`")).alias(c) for c in names], gone.alias("lines_removed"))
