"""Language-model scores by stupid backoff over a corpus.

The model has two orders.  A word after another scores ``count(pair) /
count(first word)`` if the pair occurs elsewhere in the corpus, otherwise 0.4
times the share of the word; a word that occurs nowhere else takes 0.4 times the
share of a word counted once.  Scores of the corpus itself leave the scored
document out, or every pair would have been seen.

``fit`` stores two tables that hold every word and every pair by hash with its
count.  ``score`` explodes its documents, joins pairs to the one table and words
to the other and sums up by document.  What is frequent needs no exchange: the
``FREQUENT`` words counted most and the pairs that occur in one of a hundred
sampled documents travel as bounded arrays of exact counts, so no partition
receives a hot key.  With ``vocabulary``, only so many words are known to the
model; others count nothing and form no pairs.

``score_corpus`` scores a corpus by itself without those tables: what its
documents ask for is dealt out by hash in cells of arrays, and a cell holds all
occurrences of its words and pairs, so it counts and answers at once.

Words and pairs are told apart by 64-bit hashes.  Logarithms are kept in whole
millionths, so sums do not depend on their order.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, written
from .shingles import MULTIPLIER, mix, text_blocks, word_hashes

FACTOR = 0.4
SLICES = 4
FREQUENT = 1 << 15
SAMPLE_DOCS = 20_000
HOT_SHARE = 100  # a pair is hot that occurs in one of so many sampled documents
SCALE = 1_000_000
CELL = 1_000_000  # words of the corpus to a cell
KEPT = 2_000_000  # counts that a task keeps before it hands them on
OWN, WORD = 0, -1  # in the place of a pair's count: a document's own row, a word that is looked up


@dataclass
class Frequent:
    """Hashes of frequent words in ascending order, their counts, all words
    counted; hot pairs likewise.  ``closed``: there are no other words."""

    hashes: np.ndarray
    counts: np.ndarray
    words: int
    closed: bool
    hot: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    hot_counts: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    def words_of(self, texts: list[str | None]):
        """Per word its document and the place of its hash among the distinct
        ones, and which words close a pair; per distinct hash its place here, -1 outside."""
        hashes, bounds = word_hashes(texts)
        place, code = _first_places(hashes)
        distinct = hashes[place]
        ids = _places(self.hashes, distinct)
        owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
        inner = np.append(False, owner[1:] == owner[:-1]) if len(owner) else np.zeros(0, bool)
        if self.closed:
            known = ids[code] >= 0
            pairs = inner & known
            pairs[1:] &= known[:-1]
        else:
            pairs = inner
        return owner, distinct, code, ids, inner, pairs

    def pair_hashes(self, texts: list[str | None]) -> np.ndarray:
        if not self.closed:  # every pair counts, so no word is looked up
            hashes, bounds = word_hashes(texts)
            inner = np.ones(len(hashes), dtype=bool)
            inner[bounds[:-1][bounds[:-1] < len(hashes)]] = False
            at = np.flatnonzero(inner)
            return pair_keys(hashes[at - 1], hashes[at])
        _, distinct, code, _, _, pairs = self.words_of(texts)
        at = np.flatnonzero(pairs)
        return pair_keys(distinct[code[at - 1]], distinct[code[at]])

    def frequent_pairs(self, texts: list[str | None]) -> np.ndarray:
        """Pairs of two frequent words, once per text."""
        owner, distinct, code, ids, _, pairs = self.words_of(texts)
        at = np.flatnonzero(pairs)
        at = at[(ids[code[at]] >= 0) & (ids[code[at - 1]] >= 0)]
        size = len(distinct)
        _, first = np.unique((owner[at] * size + code[at - 1]) * size + code[at], return_index=True)
        at = at[first]
        return pair_keys(distinct[code[at - 1]], distinct[code[at]])


@dataclass
class Model:
    """What travels to every task, and the tables (h, n) of all words and pairs."""

    frequent: Frequent
    words: DataFrame
    pairs: DataFrame


def _places(ordered: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Place of each value in an ascending array, -1 outside."""
    if not len(ordered):
        return np.full(len(values), -1, dtype=np.int64)
    if len(values) > 50_000:  # most are told apart by 20 bits
        held = np.zeros(1 << 20, dtype=bool)
        low = np.uint64(len(held) - 1)
        held[ordered & low] = True
        found, some = np.full(len(values), -1, dtype=np.int64), np.flatnonzero(held[values & low])
        at = np.minimum(np.searchsorted(ordered, values[some]), len(ordered) - 1)
        found[some] = np.where(ordered[at] == values[some], at, -1)
        return found
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return np.where(ordered[at] == values, at, -1)


def _sorted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Numbers that are not negative in ascending order, and the place of each, by place where equal; None if number and
    place together do not fit into 63 bits.  Sorting both as one number is several times faster than argsort."""
    bits = len(values).bit_length()
    if not len(values) or int(values.max()).bit_length() + bits > 63:
        return None
    both = np.sort(values.astype(np.int64) << bits | np.arange(len(values)))
    return both >> bits, both & ((1 << bits) - 1)


def _order(values: np.ndarray) -> np.ndarray:
    """Stable ascending order of numbers that are not negative."""
    found = _sorted(values)
    return np.argsort(values, kind="stable") if found is None else found[1]


def _first_places(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each distinct value occurs first, and per value which of them it is; in any order."""
    found = _sorted(values)
    if found is None:
        code = pa.array(values).dictionary_encode().indices.to_numpy().astype(np.int64)
        return np.flatnonzero(code > np.append(-1, np.maximum.accumulate(code)[:-1])), code
    ordered, place = found
    new = np.append(True, ordered[1:] != ordered[:-1])
    code = np.empty(len(values), np.int64)
    code[place] = np.cumsum(new) - 1
    return place[new], code


def pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(mix(first) * MULTIPLIER + second)


def millionths(log: np.ndarray) -> np.ndarray:
    return np.rint(SCALE * log).astype(np.int64)


def explode_texts(known: Frequent, texts: list[str | None], leave_one_out: bool,
                  wanted: Callable[[np.ndarray], np.ndarray] | None = None):
    """What a block of texts has to look up.

    (base, words) per text; (text, word, own count, first, inner) per text and
    word that is not frequent, where first and inner say how often it opens the
    text and how often it follows a word; (text, pair, count, first word, its
    count, second word, its score alone) per text and pair that is not hot.
    A word that is not frequent has its own count in place of count or score.
    ``wanted`` says by the rare word, by a pair's rare first word or else by the
    pair, which of these to return.
    """
    owner, distinct, code, ids, inner, pairs = known.words_of(texts)
    words = np.bincount(owner, minlength=len(texts))
    base = np.zeros(len(texts), dtype=np.int64)
    none = np.zeros(0, np.int64)
    if not len(owner):
        return base, words, (none,) * 5, (none,) * 7
    size, take = len(distinct), int(leave_one_out)
    place, back = _first_places(owner * size + code)
    own, of, word = np.bincount(back), owner[place], code[place]
    rare = (ids < 0)[word] & (not known.closed)
    count = np.where(ids >= 0, known.counts[ids] if len(known.counts) else 0, 0)
    elsewhere = count[word] - take * own
    total = np.maximum(known.words - take * words, 1)[of]
    alone = np.where(elsewhere > 0, np.log(np.maximum(elsewhere, 1) / total), np.log(FACTOR) - np.log(total))
    later, opening = millionths(np.log(FACTOR) + alone), millionths(alone)
    follows = np.bincount(back[inner], minlength=len(own))
    np.add.at(base, of[~rare], (follows * later + (own - follows) * opening)[~rare])
    asked = rare
    if wanted is not None and not known.closed:
        asked = rare & wanted(distinct)[word]
    lookups = of[asked], distinct[word[asked]].view(np.int64), own[asked], (own - follows)[asked], follows[asked]

    held = ((elsewhere > 0) | rare)[back]
    at = np.flatnonzero(pairs)
    at = at[held[at] & held[at - 1]]
    key = pair_keys(distinct[code[at - 1]], distinct[code[at]])
    hot = _places(known.hot, key)
    hot[rare[back[at]] | rare[back[at - 1]]] = -1
    if wanted is not None:  # hot pairs are settled here, whatever is wanted
        kept = np.flatnonzero(np.where(rare[back[at - 1]], wanted(distinct)[code[at - 1]], wanted(key) | (hot >= 0)))
        at, key, hot = at[kept], key[kept], hot[kept]
    first, same = _first_places(back[at - 1] * size + code[at])
    n = np.bincount(same)
    at, key, hot = at[first], key[first], hot[first]
    before, after = back[at - 1], back[at]
    rest = np.where(hot >= 0, (known.hot_counts[hot] if len(known.hot) else 0) - take * n, 0)
    seen = np.flatnonzero(rest > 0)
    np.add.at(base, of[before[seen]], n[seen] * (millionths(np.log(rest[seen] / elsewhere[before[seen]])) - later[after[seen]]))
    open_ = hot < 0
    key, n, before, after = key[open_], n[open_], before[open_], after[open_]

    def hashes(i: np.ndarray) -> pa.Array:
        return pa.array(distinct[word[i]].view(np.int64), mask=~rare[i])

    return base, words, lookups, (of[before], key.view(np.int64), n, hashes(before), np.where(rare, own, elsewhere)[before],
                                  hashes(after), np.where(rare, own, later)[after])


def _counted(texts: DataFrame, count: Callable[[list[str | None]], np.ndarray]) -> DataFrame:
    """(h, n): how often ``count`` names h.  Counts are added up inside a task
    as long as they are few enough to keep, so a frequent h is shuffled once per
    task and not once per block."""
    def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        values, back = np.unique(np.concatenate([v for v, _ in parts]), return_inverse=True)
        return values, np.bincount(back, weights=np.concatenate([n for _, n in parts]), minlength=len(values)).astype(np.int64)

    def rows_of(values: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(n)], ["h", "n"])

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple[np.ndarray, np.ndarray]] = []
        for _, _, part in (block for batch in rows for block in text_blocks(batch, 0, 4 << 20)):
            values, n = np.unique(count(part), return_counts=True)
            kept.append((values, n))
            if sum(len(v) for v, _ in kept) > KEPT:
                kept = [merged(kept)]
                if len(kept[0][0]) > KEPT // 2:
                    yield rows_of(*kept.pop())
        if kept:
            yield rows_of(*merged(kept))

    return texts.mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def _often(texts: DataFrame, shared: Broadcast, n_docs: int, sample_docs: int) -> DataFrame:
    """(h): the hot pairs."""
    share = min(1.0, sample_docs / max(1, n_docs))
    sample = texts.where(F.pmod(F.xxhash64("t", F.lit(9)), F.lit(1 << 30)) < int(share * (1 << 30)))
    often = max(3, share * n_docs / HOT_SHARE)
    return _counted(sample, lambda part: shared.value.frequent_pairs(part)).where(F.col("n") >= often).select("h")


def fit(docs: DataFrame, text: str = "text", vocabulary: int | None = None, sample_docs: int = SAMPLE_DOCS) -> Model:
    """Counts of all words and of all pairs over all documents.

    ``vocabulary`` closes the model to the words counted most; words tied with
    the first one left out are left out as well.  The driver receives the
    frequent words (or ``vocabulary`` + 1 rows) and a bounded number of hot pairs.
    """
    texts = docs.select(F.col(f"`{text}`").alias("t"))
    table = cut_lineage(_counted(texts, lambda part: word_hashes(part)[0]))
    words = table.agg(F.sum("n")).first()[0] or 0
    most = FREQUENT if vocabulary is None else vocabulary
    top = table.orderBy(F.desc("n"), "h").limit(most + 1).collect()
    least = 0
    if vocabulary is None:
        top, closed = top[:most], len(top) <= most
    else:
        least, closed = top[-1]["n"] if len(top) > most else 0, True
    rows = sorted((np.uint64(r["h"] & (2**64 - 1)), r["n"]) for r in top if r["n"] > least)
    frequent = Frequent(np.array([h for h, _ in rows], dtype=np.uint64), np.array([n for _, n in rows], dtype=np.int64), words, closed)
    shared = docs.sparkSession.sparkContext.broadcast(frequent)
    pairs = cut_lineage(_counted(texts, lambda part: shared.value.pair_hashes(part)))

    n_docs = docs.count()
    hot = _often(texts, shared, n_docs, sample_docs)
    exact = sorted((np.uint64(r["h"] & (2**64 - 1)), r["n"]) for r in pairs.join(F.broadcast(hot), "h").collect())
    frequent = Frequent(frequent.hashes, frequent.counts, words, closed,
                        np.array([h for h, _ in exact], dtype=np.uint64), np.array([n for _, n in exact], dtype=np.int64))
    return Model(frequent, table, pairs)


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", leave_one_out: bool = True, slices: int = SLICES) -> DataFrame:
    """(doc_id, n_words, log_score, score): the sum of the logarithms and its
    mean per word, one row per row of ``docs``.

    ``leave_one_out`` takes each document's own words and pairs off the counts:
    right for documents of the fitted corpus, all of them or some.  Documents
    from elsewhere are scored without it.  NULL and empty texts have no words,
    log_score 0 and a NULL mean.  Rows equal in id and text get equal scores;
    each leaves only itself out of the counts.  Other columns are not read.

    What the documents ask for is looked up in ``slices`` of its hash, one after
    the other; each reads the texts again, stores a sum per document and leaves
    no shuffle files, so the disk needed at once is that of one slice.
    """
    spark = docs.sparkSession
    found = [written(_slice_sums(docs, model, doc_id, text, leave_one_out, slices, k), "scores") for k in range(slices)]
    sums = spark.read.schema(found[0][0].schema).parquet(*[path for _, path in found]).groupBy("row").agg(
        F.max("doc").alias("doc"), F.sum("total").alias("total"), F.sum("rows").alias("rows"), F.max("n_words").alias("n_words"))
    log = F.col("total") / F.col("rows") / SCALE
    return sums.select(
        F.col("doc").alias(doc_id), "n_words", log.alias("log_score"),
        F.when(F.col("n_words") > 0, log / F.col("n_words")).alias("score"),
        F.explode(F.sequence(F.lit(1), F.col("rows"))).alias("_row")).drop("_row")


def _slice_sums(docs: DataFrame, model: Model, doc_id: str, text: str, leave_one_out: bool, slices: int, which: int) -> DataFrame:
    """Per document what the lookups of one slice add to its score."""
    known = model.frequent
    shared = docs.sparkSession.sparkContext.broadcast(known)
    take = int(leave_one_out)
    kind = docs.schema[doc_id].dataType.simpleString()

    def explode(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc", "row", "key", "count", "w1", "x1", "w2", "x2", "n_words"]
        for batch in rows:
            row = batch.column(1).to_numpy()
            for a, b, texts in text_blocks(batch, 2):
                base, words, (of, word, own, first, inner), (at, key, count, w1, x1, w2, x2) = explode_texts(shared.value, texts, leave_one_out)
                content = row[a:b]
                zeros, empty = np.zeros(b - a, np.int64), pa.nulls(b - a, pa.int64())
                parts = [
                    (batch.column(0).slice(a, b - a), content, content, zeros + OWN, empty, base, empty, zeros, words),
                    (pa.nulls(len(of), batch.column(0).type), content[of], content[of] ^ word, np.full(len(of), WORD), pa.array(word), own, pa.array(first), inner, words[of]),
                    (pa.nulls(len(at), batch.column(0).type), content[at], key, count, w1, x1, w2, x2, words[at])]
                for part in parts:
                    here = np.flatnonzero(part[2] % slices == which)
                    if len(here):
                        yield pa.RecordBatch.from_arrays([x.take(pa.array(here)) if isinstance(x, pa.Array) else pa.array(x[here]) for x in part], names)

    doc, t = F.col(f"`{doc_id}`"), F.col(f"`{text}`")
    rows = docs.select(doc.alias("doc"), F.xxhash64(doc, t).alias("row"), t.alias("text")).mapInArrow(
        explode, f"doc {kind}, row long, key long, count long, w1 long, x1 long, w2 long, x2 long, n_words long")
    rest = F.col("n") - take * F.col("count")
    # a pair counted once occurs in no other document
    pairs = model.pairs.where((F.pmod("h", F.lit(slices)) == which) & (F.col("n") > take)).withColumnRenamed("h", "key")
    counted = rows.join(pairs, "key", "left").withColumn("rest", rest).where((F.col("count") <= 0) | (F.col("rest") > 0))

    def rounded(log: Column) -> Column:
        return F.round(SCALE * log).cast("long")

    is_pair = F.col("count") > 0
    gain = F.when(is_pair, F.when(F.col("w1").isNull(), F.col("count") * rounded(F.log(F.col("rest") / F.col("x1")))).otherwise(0)
                  - F.when(F.col("w2").isNull(), F.col("count") * F.col("x2")).otherwise(0)).when(F.col("count") == OWN, F.col("x1")).otherwise(0)
    sums = counted.select("row", "doc", "n_words", (F.col("count") == OWN).alias("own"), gain.alias("gain"))
    if not known.closed:
        # What one row leaves to be looked up: a word with how often it follows or opens, or how often a pair after it was seen.
        number = lambda x: F.col(x) if isinstance(x, str) else F.lit(x).cast("long")
        item = lambda word, own, opens, follows, seen, gain, itself=False: F.struct(
            word.alias("h"), number(own).alias("own_n"), number(opens).alias("opens"), follows.alias("follows"),
            (F.col(seen) if seen else F.lit(None).cast("long")).alias("seen"), gain.alias("gain"), F.lit(itself).alias("itself"))
        nothing = F.lit(0).cast("long")
        items = F.when(F.col("count") == OWN, F.array(item(F.col("row"), 0, 0, nothing, None, F.col("x1"), True))) \
            .when(F.col("count") == WORD, F.array(item(F.col("w1"), "x1", "w2", F.col("x2"), None, nothing))) \
            .otherwise(F.filter(F.array(
                item(F.xxhash64("row", "key"), 0, 0, nothing, None, gain),
                F.when(F.col("w1").isNotNull(), item(F.col("w1"), "x1", 0, F.col("count"), "rest", nothing)),
                F.when(F.col("w2").isNotNull(), item(F.col("w2"), "x2", 0, -F.col("count"), None, nothing))), lambda x: x.isNotNull()))
        looked = counted.select("row", "doc", "n_words", F.explode(items).alias("i")).select("row", "doc", "n_words", "i.*").join(model.words, "h", "left")
        elsewhere = F.coalesce("n", F.lit(0)) - take * F.col("own_n")
        others = F.greatest(known.words - take * F.col("n_words"), F.lit(1))
        alone = F.when(elsewhere > 0, F.log(elsewhere / others)).otherwise(F.log(F.lit(FACTOR)) - F.log(others))
        found = F.when(F.col("seen").isNotNull(), F.col("follows") * rounded(F.log(F.col("seen") / F.greatest(elsewhere, F.lit(1))))).otherwise(
            F.col("opens") * rounded(alone) + F.col("follows") * rounded(F.log(F.lit(FACTOR)) + alone))
        sums = looked.select("row", "doc", "n_words", F.col("itself").alias("own"), (F.col("gain") + found).alias("gain"))
    return sums.groupBy("row").agg(
        F.max("doc").alias("doc"), F.sum("gain").alias("total"), F.count_if("own").alias("rows"), F.max(F.when(F.col("own"), F.col("n_words"))).alias("n_words"))


#: Entries of a cell by document: row and size of the document and how many of the entries that follow are its own (run); a
#: document itself (before 0, after -1) with its base as key; a rare word (before 0) with its own count as n and how often it
#: follows as after; a pair with its count, what its first word has elsewhere (before, and over by 2 ** 31; no list over if none
#: has) or minus the own count of a rare one, and the score of its second word alone or the own count of a rare one (after > 0).
#: The rare first and second words stand in lists of their own, in the same order.
CELLS = [("row", pa.int64()), ("size", pa.int32()), ("run", pa.int32()), ("key", pa.int64()), ("n", pa.int32()), ("before", pa.int32()),
         ("over", pa.int32()), ("after", pa.int32()), ("first", pa.int64()), ("second", pa.int64())]
LOW = (1 << 31) - 1


def packed(dealt: pa.RecordBatch) -> pa.RecordBatch:
    """The lists as bytes, which Spark copies as a whole and not number by number."""
    columns = [dealt.column(0)]
    for name, kind in CELLS:
        lists = dealt.column(name)
        ends = pa.array(lists.offsets.to_numpy().astype(np.int64) * (kind.bit_width // 8)).cast(pa.int32())
        columns.append(pa.Array.from_buffers(pa.binary(), len(lists), [None, ends.buffers()[1], lists.values.buffers()[1]]))
    return pa.RecordBatch.from_arrays(columns, names=dealt.schema.names)


def _unpacked(table: pa.Table, name: str, kind: pa.DataType) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all lists of a column, and how many each list has."""
    values, sizes = [np.zeros(0, kind.to_pandas_dtype())], [np.zeros(0, np.int64)]
    for chunk in table.column(name).chunks:
        of_ends = np.dtype(np.int64 if pa.types.is_large_binary(chunk.type) else np.int32)
        ends = np.frombuffer(chunk.buffers()[1], of_ends, len(chunk) + 1, of_ends.itemsize * chunk.offset).astype(np.int64)
        width = kind.bit_width // 8
        sizes.append(np.diff(ends) // width)
        if ends[-1] > ends[0]:
            values.append(np.frombuffer(chunk.buffers()[2], kind.to_pandas_dtype(), int(ends[-1] - ends[0]) // width, int(ends[0])))
    return np.concatenate(values), np.concatenate(sizes)


def deal(known: Frequent, texts: list[str | None], rows: np.ndarray, cells: int, since: int, until: int) -> pa.RecordBatch | None:
    """The entries of a block of texts for the cells ``since`` to ``until`` of
    ``cells``, one row per cell.  Entries of one rare first word, and otherwise
    those of one pair, meet in one cell."""
    def home_of(values: np.ndarray) -> np.ndarray:
        return mix(values) % np.uint64(cells)

    def wanted(values: np.ndarray) -> np.ndarray:
        home = home_of(values)
        return (home >= since) & (home < until)

    base, words, (of, word, own, opens, follows), (at, key, n, w1, x1, w2, x2) = explode_texts(known, texts, True, wanted)
    rare1, rare2 = (w.is_valid().to_numpy(zero_copy_only=False) if isinstance(w, pa.Array) else np.zeros(0, bool) for w in (w1, w2))
    w1, w2 = (w.fill_null(0).to_numpy() if isinstance(w, pa.Array) else w for w in (w1, w2))
    docs, none, zero = np.arange(len(texts)), np.zeros(len(texts), np.int64), np.zeros(len(of), np.int64)
    columns = [
        np.concatenate([docs, of, at]), np.concatenate([base, word, key]), np.concatenate([words, own, n]),
        np.concatenate([none, zero, np.where(rare1, -x1, x1)]), np.concatenate([none - 1, follows, x2]),
        np.concatenate([none, zero, np.where(rare1, w1, 0)]), np.concatenate([none, zero, np.where(rare2, w2, 0)])]
    home = home_of(np.concatenate([rows, word, np.where(rare1, w1, key)]).view(np.uint64))
    here = np.flatnonzero((home >= since) & (home < until))
    # by document inside a cell
    here = here[_order(home[here].astype(np.int64) * len(texts) + columns[0][here])]
    if not len(here):
        return None
    owner, key, n, before, after, first, second = (c[here] for c in columns)
    at_home = home[here]
    changes = np.append(True, at_home[1:] != at_home[:-1])
    starts = np.flatnonzero(changes)
    bounds = np.append(starts, len(here))
    opens = np.flatnonzero(changes | np.append(True, owner[1:] != owner[:-1]))
    runs = np.append(np.searchsorted(opens, starts), len(opens))
    over = np.where(before < 0, 0, before >> 31)
    large = np.repeat(np.maximum.reduceat(over, starts) > 0, np.diff(bounds))
    lists = [(runs, rows[owner[opens]]), (runs, words[owner[opens]]), (runs, np.diff(np.append(opens, len(here)))), (bounds, key), (bounds, n),
             (bounds, np.where(before < 0, before, before & LOW)), (np.append(0, np.cumsum(large))[bounds], over[large]), (bounds, after)]
    for held, v in ((before < 0, first), ((before != 0) & (after > 0), second)):
        lists.append((np.append(0, np.cumsum(held))[bounds], v[held]))
    return pa.RecordBatch.from_arrays(
        [pa.array(at_home[starts].astype(np.int32)), *(pa.ListArray.from_arrays(pa.array(o.astype(np.int32)), pa.array(v).cast(kind))
                                                       for (o, v), (_, kind) in zip(lists, CELLS))], ["cell", *(name for name, _ in CELLS)])


def _spread(values: np.ndarray, sizes: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Zeros for every list that was left out."""
    full = np.zeros(int(wanted.sum()), np.int64)
    full[np.repeat(sizes > 0, wanted)] = values
    return full


def settle(table: pa.Table, words: int) -> pa.Table:
    """What one cell knows, from its ``packed`` rows: (row, n_words, own, gain)
    summed by document, and per pair seen elsewhere whose second word is rare
    that word (h), its own count and how often its score alone has to be taken
    back (again)."""
    found = {name: _unpacked(table, name, kind) for name, kind in CELLS}
    row, size, run, key, n, before, over, after, firsts, seconds = (found[name][0].astype(np.int64) for name, _ in CELLS)
    before += _spread(over, found["over"][1], found["before"][1]) << 31
    document = np.repeat(np.arange(len(row)), run)
    first, second = np.zeros(len(key), np.int64), np.zeros(len(key), np.int64)
    first[before < 0], second[(before != 0) & (after > 0)] = firsts, seconds
    itself = (before == 0) & (after < 0)
    gain = np.where(itself, key, 0)
    word = np.flatnonzero((before == 0) & (after >= 0))
    known, back = np.unique(key[word], return_inverse=True)
    count = np.bincount(back, weights=n[word], minlength=len(known)).astype(np.int64)
    elsewhere, others = count[back] - n[word], np.maximum(words - size[document[word]], 1)
    alone = np.where(elsewhere > 0, np.log(np.maximum(elsewhere, 1) / others), np.log(FACTOR) - np.log(others))
    gain[word] = (n[word] - after[word]) * millionths(alone) + after[word] * millionths(np.log(FACTOR) + alone)
    pair = np.flatnonzero(before != 0)
    keys, back = np.unique(key[pair], return_inverse=True)
    left = np.bincount(back, weights=n[pair], minlength=len(keys)).astype(np.int64)[back] - n[pair]
    pair, left = pair[left > 0], left[left > 0]
    x1 = before[pair]
    rare = x1 < 0
    x1[rare] += count[np.searchsorted(known, first[pair[rare]])]
    gain[pair] = n[pair] * (millionths(np.log(left / x1)) - np.where(after[pair] < 0, after[pair], 0))
    rows, start, back = np.unique(row, return_index=True, return_inverse=True)
    own, total = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
    if len(row):
        begins = np.cumsum(run) - run
        np.add.at(own, back, np.add.reduceat(itself.astype(np.int64), begins))
        np.add.at(total, back, np.add.reduceat(gain, begins))
    ask = pair[after[pair] > 0]
    none, empty = np.zeros(len(ask), np.int64), pa.nulls(len(rows), pa.int64())
    sums = [rows, size[start], own, total, empty, empty, empty]
    asked = [row[document[ask]], size[document[ask]], none, none, second[ask], after[ask], n[ask]]
    return pa.Table.from_arrays([pa.concat_arrays([pa.array(a), pa.array(b)]) for a, b in zip(sums, asked)],
                                ["row", "n_words", "own", "gain", "h", "own_n", "again"])


def score_corpus(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sample_docs: int = SAMPLE_DOCS, slices: int = 2) -> DataFrame:
    """What ``score(docs, fit(docs))`` returns.

    The cells are worked off in ``slices``, each reads the texts again and stores
    sums per document, so the disk needed at once is that of one slice.
    """
    spark = docs.sparkSession
    d, t = F.col(f"`{doc_id}`"), F.col(f"`{text}`")
    texts = docs.select(t.alias("t"))
    table = cut_lineage(_counted(texts, lambda part: word_hashes(part)[0]))
    words = table.agg(F.sum("n")).first()[0] or 0
    top = table.orderBy(F.desc("n"), "h").limit(FREQUENT + 1).collect()
    ordered = sorted((np.uint64(r["h"] & (2**64 - 1)), r["n"]) for r in top[:FREQUENT])
    hashes, counts = np.array([h for h, _ in ordered], dtype=np.uint64), np.array([n for _, n in ordered], dtype=np.int64)
    shared = spark.sparkContext.broadcast(Frequent(hashes, counts, words, len(top) <= FREQUENT))
    hot = np.sort(np.array([r["h"] for r in _often(texts, shared, docs.count(), sample_docs).collect()], dtype=np.int64).view(np.uint64))
    hot_keys = spark.sparkContext.broadcast(hot)

    def hot_pairs(part: list[str | None]) -> np.ndarray:
        keys = shared.value.pair_hashes(part)
        return keys[_places(hot_keys.value, keys) >= 0]

    exact = {r["h"] & (2**64 - 1): r["n"] for r in _counted(texts, hot_pairs).collect()} if len(hot) else {}
    known = spark.sparkContext.broadcast(Frequent(hashes, counts, words, len(top) <= FREQUENT, hot, np.array([exact[int(h)] for h in hot], dtype=np.int64)))
    share = max(1, -(-words // (CELL * slices)))
    source = docs.select(F.xxhash64(d, t).alias("row"), t.alias("text"))
    shape = "cell int, " + ", ".join(f"{name} binary" for name, _ in CELLS)

    def one(which: int) -> DataFrame:
        def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in rows:
                row = batch.column(0).to_numpy()
                for a, b, part in text_blocks(batch, 1, 2 << 20):
                    dealt = deal(known.value, part, row[a:b], share * slices, share * which, share * (which + 1))
                    if dealt is not None:
                        yield packed(dealt)

        return source.mapInArrow(run, shape).groupBy("cell").applyInArrow(
            lambda cell: settle(cell, words), "row long, n_words long, own long, gain long, h long, own_n long, again long")

    found = [written(one(k), "cells") for k in range(slices)]
    answers = spark.read.schema(found[0][0].schema).parquet(*[path for _, path in found])
    asked = answers.where("h IS NOT NULL").join(table, "h")
    elsewhere, others = F.col("n") - F.col("own_n"), F.greatest(F.lit(words) - F.col("n_words"), F.lit(1))
    alone = F.when(elsewhere > 0, F.log(elsewhere / others)).otherwise(F.log(F.lit(FACTOR)) - F.log(others))
    back = -F.col("again") * F.round(SCALE * (F.log(F.lit(FACTOR)) + alone)).cast("long")
    sums = answers.where("h IS NULL").select("row", "n_words", "own", "gain").unionByName(
        asked.select("row", "n_words", "own", back.alias("gain"))).groupBy("row").agg(
        F.sum("gain").alias("total"), F.sum("own").alias("rows"), F.max("n_words").alias("n_words"))
    log = F.col("total") / F.col("rows") / SCALE
    return docs.select(d.alias("doc"), F.xxhash64(d, t).alias("row")).join(sums, "row").select(
        F.col("doc").alias(doc_id), "n_words", log.alias("log_score"), F.when(F.col("n_words") > 0, log / F.col("n_words")).alias("score"))
