"""Substring dedup by relative Lempel-Ziv parsing.

A document is factored against the texts of all documents with smaller ids.  A
factor is a run of its words that also stands in one of them; factors of at
least ``WINDOW`` words are duplicate spans.

* **Anchors.**  Of every window of ``WINDOW`` words the ``ANCHOR``-word shingle
  with the least hash is its anchor.  Equal windows have equal anchors, so a
  factor that is long enough holds an anchor of its source.  Consecutive
  windows of one anchor are a segment: (anchor, document, place, hashes of the
  windows), about one row for five words.
* **Reference blocks.**  The segments are indexed by anchor; a block is what
  has one anchor in common.  An anchor that only one document has can't start
  a factor: its segments are left out before anything else is shuffled.  A
  block holds each distinct window once, with its first place in the corpus
  (least document, then position), so copies in any number and passages that
  a third of all documents share are one entry.  Every document meets every
  block through its anchors.
* **Parsing.**  The windows of a document, from left to right, look up their
  first place.  A factor grows word by word as long as the next window lies
  next to the last one in the same source, and ends where it does not.
* **Boundaries.**  A window across the end of a factor may stand in a third
  document.  Since every window has been looked up, these have too, and start
  factors of their own; overlapping factors become one span.

No pair of documents is ever formed: all joins are on (anchor, window) with one
row per key on one side, aggregates combine in the map tasks, and AQE splits a
hot key of the other side.  Anchors are dealt to ``SLICES`` slices, which are
indexed and looked up one after the other; each reads all texts again and
leaves no shuffle files, so the disk needed at once is that of one slice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import release_scratch, written
from . import shingles
from .common import WORDS

WINDOW, ANCHOR, SLICES = 13, 5, 3
#: The order of a row without id: behind every id.
LAST = (1 << 63) - 1


def least_of_runs(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive values."""
    have = 1
    while 2 * have <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    return np.minimum(values[:len(values) - (width - have)], values[width - have:]) if have < width else values


def _segments(window: int, anchor: int, slices: int, which: int | None):
    """The segments of one slice; without one, (anchor, doc) of all of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end, texts in shingles.text_blocks(batch, 2):
                words, bounds = shingles.word_hashes(texts, fold=False)
                if len(words) < window:
                    continue
                anchors = least_of_runs(shingles.shingles(words, anchor), window - anchor + 1)
                # windows that begin in one text and end in another are none
                owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
                inside = owner[:len(anchors)] == owner[window - 1:]
                fresh = np.ones(len(anchors), dtype=bool)
                fresh[1:] = (anchors[1:] != anchors[:-1]) | ~inside[:-1]
                if which is not None:
                    inside &= anchors % np.uint64(slices) == np.uint64(which)
                at = np.flatnonzero(inside)
                begin = np.flatnonzero(fresh[at])
                first = at[begin]
                text = owner[first]
                rows = pa.array(text + start)
                columns = {"anchor": pa.array(anchors[first].view(np.int64)), "doc": pc.take(batch.column(0), rows)}
                if which is not None:
                    every = shingles.shingles(words, window)
                    edges = np.append(begin, len(at)).astype(np.int32)
                    columns |= {"content": pc.take(batch.column(1), rows), "first": pa.array((first - bounds[text]).astype(np.int32)),
                                "windows": pa.ListArray.from_arrays(edges, pa.array(every[at].view(np.int64)))}
                yield pa.RecordBatch.from_arrays([*columns.values()], names=[*columns])

    return run


def numbered(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc, content, text): ``content`` tells rows with one id and different texts apart."""
    return docs.where(F.col(f"`{text}`").isNotNull()).select(
        order_of(F.col(f"`{doc_id}`")).alias("doc"), F.xxhash64(F.col(f"`{text}`")).alias("content"), F.col(f"`{text}`").alias("text"))


def order_of(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("bigint"), F.lit(LAST))


def shared_anchors(given: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """The anchors that at least two documents have."""
    every = given.mapInArrow(_segments(window, anchor, 1, None), "anchor bigint, doc bigint")
    return every.groupBy("anchor").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where("least < most").select("anchor")


def segments(given: DataFrame, slices: int, which: int, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    return given.mapInArrow(_segments(window, anchor, slices, which), "anchor bigint, doc bigint, content bigint, first int, windows array<bigint>")


def reference_index(places: DataFrame) -> DataFrame:
    """Each window that two documents have, with its first place: (anchor, window, source, source_at)."""
    return (places.groupBy("anchor", "window").agg(F.min(F.struct("doc", "at")).alias("home"), F.max("doc").alias("last"))
            .where("home.doc < last").select("anchor", "window", F.col("home.doc").alias("source"), F.col("home.at").alias("source_at")))


def places_of(known: DataFrame) -> DataFrame:
    return known.select("anchor", "doc", "content", F.posexplode("windows").alias("i", "window"), "first").select(
        "anchor", "window", "doc", "content", (F.col("first") + F.col("i")).alias("at"))


def looked_up(places: DataFrame, index: DataFrame) -> DataFrame:
    """The windows that a document before theirs has: (doc, content, at, source, source_at)."""
    return places.join(index, ["anchor", "window"]).where("source < doc").select("doc", "content", "at", "source", "source_at")


def parsed(matched: DataFrame, window: int = WINDOW) -> DataFrame:
    """Factors, from the windows that were found."""
    row = W.partitionBy("doc", "content").orderBy("at")
    step = F.col("at") - F.lag("at").over(row)  # 0: a row that is there twice
    follows = (step <= 1) & (F.col("source") == F.lag("source").over(row)) & (F.col("source_at") == F.lag("source_at").over(row) + step)
    numbered_rows = matched.withColumn("opens", F.when(follows, 0).otherwise(1)).withColumn("factor", F.sum("opens").over(row.rowsBetween(W.unboundedPreceding, 0)))
    return numbered_rows.groupBy("doc", "content", "factor").agg(
        F.min("at").alias("start"), (F.max("at") - F.min("at") + window).cast("int").alias("length"), F.min("source").alias("source"),
        F.min("source_at").alias("source_at")).drop("factor")


def factors(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, anchor: int = ANCHOR, slices: int = SLICES) -> DataFrame:
    """Rows (doc, content, start, length, source, source_at): ``length`` words of document ``doc`` from word ``start``
    on that also stand in the document ``source`` (a smaller id) from word ``source_at`` on."""
    spark, given = docs.sparkSession, numbered(docs, doc_id, text)
    shared, shared_path = written(shared_anchors(given, window, anchor), "anchors")
    paths = []
    for k in range(slices):
        known, known_path = written(segments(given, slices, k, window, anchor).join(shared, "anchor"), "segments")
        places = places_of(known)
        index, index_path = written(reference_index(places), "index")  # stored, so that AQE can split the places of a hot window
        matched, path = written(looked_up(places, index), "matched")
        release_scratch(spark, [known_path, index_path])
        paths.append(path)
    release_scratch(spark, [shared_path])
    found, _ = written(parsed(spark.read.schema(matched.schema).parquet(*paths), window), "factors")
    release_scratch(spark, paths)
    return found


def spans(found: DataFrame) -> DataFrame:
    """Factors that overlap or touch, merged: (doc, content, spans), ascending, ends exclusive."""
    row = W.partitionBy("doc", "content").orderBy("start", "length")
    before = F.max(F.col("start") + F.col("length")).over(row.rowsBetween(W.unboundedPreceding, -1))
    numbered = found.withColumn("opens", F.when(F.col("start") <= before, 0).otherwise(1)).withColumn("span", F.sum("opens").over(row))
    merged = numbered.groupBy("doc", "content", "span").agg(F.min("start").alias("start"), F.max(F.col("start") + F.col("length")).alias("end"))
    return merged.groupBy("doc", "content").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))


def with_spans(docs: DataFrame, found: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows of ``docs`` as a struct ``row``, with the spans of their text as ``spans`` (NULL: none)."""
    left = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), order_of(F.col(f"`{doc_id}`")).alias("doc"),
                       F.xxhash64(F.col(f"`{text}`")).alias("content"))
    return left.join(found, ["doc", "content"], "left").select("row", "spans")


def _without(text: str, spans: list | None) -> str:
    """The words outside ``spans``, joined by one space."""
    own = WORDS.findall(text)
    kept, at = [], 0
    for s in spans or ():
        kept += own[at:s["start"]]
        at = s["end"]
    return " ".join(kept + own[at:])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, cuts = batch.column("text"), batch.column("spans")
        new, total, gone = [], [], []
        for i in range(batch.num_rows):
            own, span = texts[i].as_py(), cuts[i].as_py() or []
            kept = _without(own or "", span)
            removed = sum(s["end"] - s["start"] for s in span)
            new.append(kept)
            gone.append(removed)
            total.append((kept.count(" ") + 1 if kept else 0) + removed)
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array(new, pa.string()), pa.array(total, pa.int64()), pa.array(gone, pa.int64())], names=["row", "kept", "n_words", "n_removed"])


def dedup_substrings(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """``docs`` with the words of ``text`` that are not part of a duplicate span, joined by one space, and the
    columns ``n_words`` (before) and ``n_removed``, which replace columns of these names.

    Removed is each word covered by ``window`` consecutive words that also stand in a document with a smaller id;
    this is judged on the texts as given.  Every row comes back.  A NULL text counts as one without words and comes
    back empty.  Ids are whole numbers; rows with one id never remove words of each other, whatever their texts, and
    rows without id come behind all others.  Repeats within one document stay.  Texts of any length are read in whole.
    """
    names = [c for c in docs.columns if c not in ("n_words", "n_removed")]
    plain = docs.select(*[F.col(f"`{c}`").alias(f"d{i}") for i, c in enumerate(names)])
    its_id, its_text = f"d{names.index(doc_id)}", f"d{names.index(text)}"
    found = spans(factors(plain, its_id, its_text, window, anchor))
    rest = [c for c in plain.columns if c != its_text]
    joined = with_spans(plain, found, its_id, its_text).select(
        F.struct(*[F.col(f"row.{c}").alias(c) for c in rest]).alias("row"), F.col(f"row.{its_text}").alias("text"), "spans")
    kind = joined.schema["row"].dataType.simpleString()
    cut = joined.mapInArrow(_cut, f"row {kind}, kept string, n_words bigint, n_removed bigint")
    return cut.select(*[(F.col("kept") if f"d{i}" == its_text else F.col(f"row.d{i}")).alias(c) for i, c in enumerate(names)], "n_words", "n_removed")
