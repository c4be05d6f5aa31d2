"""Exact Jaccard join of word-shingle sets in metric space.

Jaccard distance is a metric, but unrelated texts are all at distance 1 from
each other, so regions around whole documents alone would hold everything.  The
join therefore works with two kinds of pivots:

* Level 0: single shingles.  A set is nearer than 1 only to the shingles it
  holds, and a partner within the distance must hold one of the first quarter of
  a set's shingles in a fixed global order.  Each set is replicated into the
  regions of those shingles and no others (the window at this level).  The order
  puts shingles that are frequent in a bounded sample last; any order is exact.
* Level 1: inside a region, documents.  The class whose regions hold most
  members is a region's pivot (the original of near copies shares more with them
  than they share among each other), a set belongs to the pivot it shares most
  regions with, and its distance to it is computed.  What lies within the
  distance is one component.  This is repeated with new pivots for what is left
  of each region.

What remains are pairs across components: members outside their region's largest
component against the region, with triangle-inequality windows where both
distances to one pivot are known, then bounds on size, position, number of
shared regions and on sketches of the sets, none of which can lose a pair.  A
pair is met in the first region it shares: a class with few open regions carries
their list, one with many those just before each, which leaves a few pairs to be
met again after a gap.  The survivors are verified.

Sets that are equal are one class from the start, so copies cost one row each.
Regions of frequent shingles meet a table that is bounded by the sample; the
others are hashed.  Texts are read again only for pairs to be verified.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.graph import components
from ..session import cut_lineage, release_scratch, written
from .shingles import WORDS_PER_SHINGLE, mix, text_blocks, text_shingles

PERCENT = 75
SAMPLE_DOCS = 40_000
FREQUENT = 400_000
ROUNDS = 2
JUMPS = 2
#: A class with more open regions than this does not carry their list.
LISTED = 48
#: So many of the open regions before one go with each region of such a class.
BEFORE = 8
#: Words of 64 bits in the least and the longest sketch of a set.
COARSE, FINE = 4, 256
#: Rows of two or three numbers that may be broadcast, at most 24 bytes each.
BROADCAST_ROWS = 500_000


def prefix_size(n: int) -> int:
    """How many of ``n`` ordered shingles a partner must share one of."""
    return n - -(-PERCENT * n // 100) + 1


def digest(ordered: np.ndarray, seed: int) -> int:
    """A 64-bit digest of a set given in ascending order."""
    if not len(ordered):
        return seed
    return int((mix(ordered + np.uint64(seed)) * mix(np.arange(1, len(ordered) + 1, dtype=np.uint64))).sum(dtype=np.uint64).view(np.int64))


def sketch(own: np.ndarray) -> np.ndarray:
    """The parity of a set's shingles on each of a power of two of bits, about
    one a shingle.  Two sketches differ in no more bits than their sets do in
    shingles; halves combined by XOR are the sketch of half as many bits."""
    size = min(max(COARSE, 1 << max(0, (len(own) - 1).bit_length() - 6)), FINE)
    odd = np.bincount((own & np.uint64(64 * size - 1)).astype(np.int64), minlength=64 * size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<u8")


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0] + [len(a) for a in arrays], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays).view(np.int64)))


def signatures(docs: DataFrame, frequent: np.ndarray, doc_id: str, text: str, n: int) -> DataFrame:
    """(doc, content, class, check, n, cold, hot, bits): class and check are two
    digests of the set; cold and hot are the ordered prefix, cut where the
    frequent shingles begin; bits is the sketch.  Texts without words have n = 0
    and no prefix."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def sign(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = shared.value
        for batch in rows:
            for start, end, texts in text_blocks(batch, 2):
                keys, sizes, cold, hot, bits = [], [], [], [], []
                for own in text_shingles(texts, n):
                    own = np.unique(own)
                    frequent = np.zeros(len(own), dtype=bool)
                    if len(often):
                        frequent = often[np.minimum(np.searchsorted(often, own), len(often) - 1)] == own
                    size = prefix_size(len(own)) if len(own) else 0
                    cold.append(own[~frequent][:size])
                    hot.append(own[frequent][:size - len(cold[-1])])
                    keys.append((digest(own, 1), digest(own, 2)))
                    sizes.append(len(own))
                    bits.append(sketch(own))
                first, second = zip(*keys)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(start, end - start), batch.column(1).slice(start, end - start),
                    pa.array(first, pa.int64()), pa.array(second, pa.int64()), pa.array(sizes, pa.int64()), _lists(cold), _lists(hot), _lists(bits)],
                    ["doc", "content", "class", "check", "n", "cold", "hot", "bits"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(
        F.col(f"`{doc_id}`").alias("doc"), F.xxhash64(F.col(f"`{text}`")).alias("content"), F.col(f"`{text}`").alias("text")
    ).mapInArrow(sign, f"doc {kind}, content long, class long, check long, n long, cold array<long>, hot array<long>, bits array<long>")


def frequent_shingles(docs: DataFrame, text: str, n: int, sample_docs: int, most: int) -> np.ndarray:
    """At most ``most`` shingles that occur in three or more of about
    ``sample_docs`` documents, ascending.  They only order the shingles."""
    share = min(1.0, sample_docs / max(1, docs.count()))
    sample = docs.where(F.pmod(F.xxhash64(F.col(f"`{text}`"), F.lit(5)), F.lit(1 << 30)) < int(share * (1 << 30))).select(F.col(f"`{text}`").alias("t"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, texts in (block for batch in batches for block in text_blocks(batch, 0, 4 << 20)):
            values, counts = np.unique(np.concatenate([np.unique(s) for s in text_shingles(texts, n)]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(counts.astype(np.int64))], ["h", "n"])

    rows = sample.mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where("n >= 3")
    return np.sort(np.array([r["h"] for r in rows.orderBy(F.desc("n"), "h").limit(most).collect()], dtype=np.int64).view(np.uint64))


def _needed(a: Column, b: Column) -> Column:
    """Least overlap of sets of sizes a and b that reach the similarity: J >= p
    means overlap * (100 + p) >= p * (a + b)."""
    return F.ceil(PERCENT * (a + b) / (100 + PERCENT))


def _sizes_fit(a: Column, b: Column) -> Column:
    return (100 * F.least(a, b) >= PERCENT * F.greatest(a, b))


def _prefix(n: Column) -> Column:
    return n - F.ceil(PERCENT * n / 100) + 1


def _differences(a: Column, b: Column) -> Column:
    """In how many bits two sketches differ; the longer one is brought to the
    other's length (sets of similar size differ by one doubling at most)."""
    def cut(bits: Column, size: Column) -> Column:
        halves = F.slice(bits, F.lit(1), size), F.slice(bits, size + 1, size)
        return F.when(F.size(bits) > size, F.zip_with(*halves, lambda x, y: x.bitwiseXOR(y))).otherwise(bits)

    size = F.least(F.size(a), F.size(b))
    return F.aggregate(F.zip_with(cut(a, size), cut(b, size), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda x, y: x + y)


def _coarse(bits: Column) -> Column:
    """A sketch of ``COARSE`` words as a struct, made of a longer one."""
    def word(i: int) -> Column:
        return F.aggregate(F.filter(bits, lambda _, at: at % COARSE == i), F.lit(0).cast("long"), lambda x, y: x.bitwiseXOR(y))

    return F.struct(*[word(i).alias(f"c{i}") for i in range(COARSE)])


def regions(signed: DataFrame) -> DataFrame:
    """Members (h, class, n, at, size) of the regions that hold at least two
    classes; ``at`` is the shingle's place in the class's order, ``size`` the
    number of rows in the region."""
    def pack(at: Column) -> Column:
        return F.shiftleft("n", 32).bitwiseOR(at.cast("long"))

    # one exchange for both uses: all columns are part of the aggregate
    cold = signed.select("class", "n", F.posexplode("cold").alias("at", "h")).select("h", "class", pack(F.col("at")).alias("p")).repartition("h")
    hot = signed.select("class", "n", F.size("cold").alias("c"), F.posexplode("hot").alias("at", "h")).select(
        "h", "class", pack(F.col("at") + F.col("c")).alias("p"))

    def shared(members: DataFrame) -> DataFrame:
        one = F.struct("class", "p")
        return members.groupBy("h").agg(F.min(one).alias("first"), F.max(one).alias("last"), F.count(F.lit(1)).alias("size")).where(
            F.col("first.class") != F.col("last.class")).select("h", "size")

    found = cold.join(shared(cold), "h").unionByName(
        hot.join(F.broadcast(shared(hot)), "h"))  # at most FREQUENT rows
    return found.select("h", "class", F.shiftright("p", 32).alias("n"), F.col("p").bitwiseAND(F.lit((1 << 32) - 1)).alias("at"), "size").distinct()


def small(rows: DataFrame) -> DataFrame:
    """``rows``, stored, and broadcast while they are known to be few."""
    stored = cut_lineage(rows)
    return F.broadcast(stored) if stored.count() <= BROADCAST_ROWS else stored


def fetch_texts(docs: DataFrame, homes: DataFrame, classes: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(class, text) of the wanted classes: one document of each is read again.
    The list is broadcast while it is known to be short, joined otherwise."""
    wanted = small(homes.join(classes, "class"))
    source = docs.select(F.col(f"`{doc_id}`").alias("d"), F.xxhash64(F.col(f"`{text}`")).alias("c"), F.col(f"`{text}`").alias("text"))
    rows = source.join(wanted, F.col("d").eqNullSafe(F.col("home.doc")) & (F.col("c") == F.col("home.content"))).select("class", "text")
    return rows.dropDuplicates(["class"])  # repeated rows of one document


def verified(pairs: DataFrame, docs: DataFrame, homes: DataFrame, doc_id: str, text: str, n: int) -> DataFrame:
    """``pairs`` (a, b) with the overlap and the sizes of both sets, exactly."""
    both = pairs.select(F.col("a").alias("class")).unionByName(pairs.select(F.col("b").alias("class"))).distinct()
    texts = cut_lineage(fetch_texts(docs, homes, both, doc_id, text))

    def compare(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own = None, np.zeros(0, np.uint64)
        for batch in rows:
            for start, end, right in text_blocks(batch, 3):
                out = []
                keys = batch.column(0).slice(start, end - start)
                for i, (key, other) in enumerate(zip(keys.to_pylist(), text_shingles(right, n))):
                    if key != last:  # pairs come sorted by their first class
                        last, own = key, np.unique(next(text_shingles([batch.column(2)[start + i].as_py()], n)))
                    other = np.unique(other)
                    out.append((len(np.intersect1d(own, other, assume_unique=True)), len(own), len(other)))
                yield pa.RecordBatch.from_arrays(
                    [keys, batch.column(1).slice(start, end - start), *(pa.array(c, pa.int64()) for c in zip(*out))],
                    ["a", "b", "overlap", "a_n", "b_n"])

    joined = pairs.join(texts.select(F.col("class").alias("b"), F.col("text").alias("tb")), "b").join(
        texts.select(F.col("class").alias("a"), F.col("text").alias("ta")), "a")
    return joined.select("a", "b", "ta", "tb").mapInArrow(compare, "a long, b long, overlap long, a_n long, b_n long")


def _linked() -> Column:
    return 100 * F.col("overlap") >= PERCENT * (F.col("a_n") + F.col("b_n") - F.col("overlap"))


def hooks(links: DataFrame) -> DataFrame:
    """(class, label): each class under a heavier one that it links to (links
    lead from the heavier ``a``), followed a few steps up.  Equal labels mean
    one component; the reverse need not hold, which costs pairs to look at but
    none of the result."""
    up = links.where(_linked()).groupBy(F.col("b").alias("class")).agg(F.min("a").alias("label"))
    for _ in range(JUMPS):
        up = cut_lineage(up)
        further = up.select(F.col("class").alias("label"), F.col("label").alias("_next"))
        up = up.join(further, "label", "left").select("class", F.coalesce("_next", "label").alias("label"))
    return up


def new_pivots(left: DataFrame) -> DataFrame:
    """(h, main, pivot): per region of more than one label its largest label,
    and the heaviest class outside it."""
    sizes = left.groupBy("h", "label").agg(F.count(F.lit(1)).alias("k"), F.max(F.struct("w", "class", "n")).alias("first"))
    heads = sizes.groupBy("h").agg(F.max(F.struct("k", "first.w", "label")).alias("top"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    return sizes.join(heads, "h").where(F.col("label") != F.col("top.label")).groupBy("h").agg(
        F.max("first").alias("pivot"), F.first("top.label").alias("main"))


def candidates(left: DataFrame, links: DataFrame, marks: DataFrame) -> DataFrame:
    """(a, a_n, b, b_n): the pairs of different labels in the open regions
    ``left`` that no bound excludes, each about once.  ``links`` gives distances
    to pivots, ``marks`` the sketch of every class."""
    overlap = F.col("overlap") / (F.col("a_n") + F.col("b_n") - F.col("overlap"))
    distances = links.select(F.col("b").alias("class"), F.col("a").alias("centre"), (1 - overlap).alias("distance")).groupBy("class").agg(
        F.max_by(F.struct("centre", "distance"), "centre").alias("known"))
    # the open regions of a class, a part of its prefix: what two classes share of them is all they share of their prefixes
    open_regions = left.groupBy("class").agg(F.count(F.lit(1)).alias("k"), F.collect_set("h").alias("open")).withColumn(
        "open", F.when(F.col("k") <= LISTED, F.col("open")))
    before = F.collect_list("h").over(Window.partitionBy("class").orderBy("h").rowsBetween(-BEFORE, -1))
    side = left.join(open_regions, "class").join(distances, "class", "left").select("h", "class", "n", "at", "label", "main", "known", "k", "open")
    window = F.coalesce(  # the triangle inequality, with room for rounding
        (F.col("a.known.centre") != F.col("b.known.centre"))
        | (F.abs(F.col("a.known.distance") - F.col("b.known.distance")) <= 1 - PERCENT / 100 + 1e-9), F.lit(True))
    need = _needed(F.col("a.n"), F.col("b.n"))
    room = F.least(F.col("a.n") - F.col("a.at"), F.col("b.n") - F.col("b.at")) + F.least(F.col("a.at"), F.col("b.at"))
    common = F.array_intersect("a.open", "b.open")
    least = F.least(need - F.col("a.n") + _prefix(F.col("a.n")), need - F.col("b.n") + _prefix(F.col("b.n")))
    fits = ((F.col("a.h") == F.col("b.h")) & (F.col("a.label") != F.col("b.label"))
            & ((F.col("b.label") == F.col("b.main")) | (F.col("a.class") < F.col("b.class")))
            & _sizes_fit(F.col("a.n"), F.col("b.n")) & window & (room >= need))
    heads = F.col("a.class") < F.col("b.class")
    ends = [F.when(heads, F.col(f"a.{c}")).otherwise(F.col(f"b.{c}")).alias(x) for c, x in (("class", "a"), ("n", "a_n"))]
    ends += [F.when(heads, F.col(f"b.{c}")).otherwise(F.col(f"a.{c}")).alias(x) for c, x in (("class", "b"), ("n", "b_n"))]

    def outside(rows: DataFrame) -> DataFrame:
        return rows.where(F.col("label") != F.col("main")).alias("a")

    # the bound on shared regions: from their lists where both are short, and the pair is met in one region only ...
    listed = side.where("open IS NOT NULL").drop("k")
    once = outside(listed).join(listed.alias("b"), fits & (F.size(common) >= least) & (F.array_min(common) == F.col("a.h"))).select(*ends)
    # ... and from their numbers for long texts, whose lists would be compared in every region: the regions just before are
    # compared instead, and the first region that a pair shares has none in common
    plain = side.withColumn("before", before).withColumn("long", F.col("open").isNull()).drop("open").join(
        marks.select("class", _coarse(F.col("bits")).alias("coarse")), "class")
    apart = sum((F.bit_count(F.col(f"a.coarse.c{i}").bitwiseXOR(F.col(f"b.coarse.c{i}"))) for i in range(1, COARSE)),
                F.bit_count(F.col("a.coarse.c0").bitwiseXOR(F.col("b.coarse.c0"))))
    first = outside(plain).join(plain.alias("b"), fits & (F.col("a.long") | F.col("b.long")) & (F.least("a.k", "b.k") >= least)
                                & (apart <= F.col("a.n") + F.col("b.n") - 2 * need) & ~F.arrays_overlap("a.before", "b.before")).select(*ends)
    return once.unionByName(first)


def _labels(links: DataFrame, nodes: DataFrame) -> DataFrame:
    return components(links.select(F.col("a").alias("child"), F.col("b").alias("parent")), nodes).select(
        F.col("node").alias("class"), F.col("component").alias("label"))


def join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = WORDS_PER_SHINGLE, rounds: int = ROUNDS,
         sample_docs: int = SAMPLE_DOCS) -> tuple[DataFrame, DataFrame]:
    """Documents (doc, content, class, n, label) and links (a, b, overlap, a_n,
    b_n) between classes.

    ``label`` names the component of a class.  Links are those that were
    verified: all that cross components found on the way, and enough inside a
    component to hold it together, since listing all pairs of a large group
    would grow with its square.  Texts without words are classes of their own
    without links.  NULL text counts as empty.
    """
    docs = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    frequent = frequent_shingles(docs, "text", n, sample_docs, FREQUENT)
    signed = cut_lineage(signatures(docs, frequent, "doc_id", "text", n))
    place = F.struct(F.col("doc").isNull().alias("none"), "doc", "content")
    homes = signed.where("n > 0").groupBy("class").agg(
        F.min(place).alias("home"), F.min("check").alias("lo"), F.max("check").alias("hi"))
    homes = cut_lineage(homes.select("class", F.when(
        F.col("lo") == F.col("hi"), F.col("home")).otherwise(F.raise_error(F.lit("two sets share a 64-bit digest"))).alias("home")))
    found, found_at = written(regions(signed.where("n > 0")), "cut")
    # the original of near copies shares most with all of them: it is the heaviest of its regions
    weights = found.groupBy("class").agg(F.sum("size").alias("w"))
    members = cut_lineage(found.join(weights, "class").select("h", "class", "n", "at", "w"))
    release_scratch(docs.sparkSession, [found_at])
    nodes = homes.select(F.col("class").alias("node"))

    links, left_at = None, None
    left = members.withColumn("label", F.col("class")).join(
        members.groupBy("h").agg(F.max(F.struct("w", "class", "n")).alias("pivot")), "h")
    for _ in range(rounds):
        near = left.where(F.col("class") != F.col("pivot.class")).where(_sizes_fit(F.col("n"), F.col("pivot.n"))).groupBy(
            "class", "n", "w", "pivot").agg(F.count(F.lit(1)).alias("k"))
        # a set that shares a single region with a pivot is left to the count bound below
        chosen = near.where("10 * k >= n OR k > 3").groupBy("class").agg(
            F.first("w").alias("w"), F.max_by("pivot", F.struct("k", "pivot")).alias("pivot"))
        heavier = F.struct(F.col("pivot.w"), F.col("pivot.class")) > F.struct("w", "class")
        fresh = cut_lineage(verified(chosen.select(
            F.when(heavier, F.col("pivot.class")).otherwise(F.col("class")).alias("a"),
            F.when(heavier, F.col("class")).otherwise(F.col("pivot.class")).alias("b")), docs, homes, "doc_id", "text", n))
        links = fresh if links is None else links.unionByName(fresh)
        left = members.join(small(hooks(links)), "class", "left").withColumn("label", F.coalesce("label", "class"))
        last_at, (left, left_at) = left_at, written(left.join(new_pivots(left), "h"), "cut")  # regions of one label are done
        if last_at:
            release_scratch(docs.sparkSession, [last_at])

    tried = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    marks = cut_lineage(signed.where("n > 0").groupBy("class").agg(F.first("bits").alias("bits")))
    met = candidates(left, links, marks).dropDuplicates(["a", "b"]).join(tried, ["a", "b"], "left_anti")
    pairs = met.join(marks.select(F.col("class").alias("a"), F.col("bits").alias("bits_a")), "a").join(
        marks.select(F.col("class").alias("b"), F.col("bits").alias("bits_b")), "b").where(
        _differences(F.col("bits_a"), F.col("bits_b")) <= F.col("a_n") + F.col("b_n") - 2 * _needed(F.col("a_n"), F.col("b_n"))).select("a", "b")
    links = cut_lineage(links.unionByName(verified(cut_lineage(pairs), docs, homes, "doc_id", "text", n))).where(_linked())
    labels = _labels(links, nodes)
    placed = signed.select("doc", "content", "class", "n").join(labels, "class", "left").withColumn(
        "label", F.when(F.col("n") > 0, F.col("label")))
    return placed, links


def component_ids(placed: DataFrame) -> DataFrame:
    """(doc, content, n, component): the smallest id of the component; a text
    without words is its own component."""
    least = placed.where("label IS NOT NULL").groupBy("label").agg(F.min("doc").alias("least"))
    return placed.join(least, "label", "left").select(
        "doc", "content", "n", F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc")).alias("component"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each component: that with the smallest id
    (NULL last), then the smallest text hash.  Rows without words all stay;
    of rows equal in id and text all stay or go together."""
    placed, _ = join(docs, doc_id, text)
    place = F.struct(F.col("doc").isNull().alias("none"), "doc", "content")
    first = placed.where("label IS NOT NULL").groupBy("label").agg(F.min(place).alias("first"))
    gone = placed.where("label IS NOT NULL").join(first, "label").where(place != F.col("first")).select("doc", "content").distinct()
    # packed, so that no column of the documents can be taken for one of the join
    rows = docs.select(F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]).alias("kept"),
                       F.col(f"`{doc_id}`").alias("its_id"), F.xxhash64(F.col(f"`{text}`")).alias("its_content"))
    left = rows.join(gone, F.col("its_id").eqNullSafe(F.col("doc")) & (F.col("its_content") == F.col("content")), "left_anti")
    return left.select(*[F.col(f"kept.c{i}").alias(c) for i, c in enumerate(docs.columns)])
