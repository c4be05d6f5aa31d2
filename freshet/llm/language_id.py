"""Language identification with bit-sliced n-gram filters.

One array holds the Bloom filters of all languages: slot ``i`` is a bitmask of
the languages whose n-grams hash there.  ANDing the slots of an n-gram gives in
one step every language that contains it.  Per language the masks of a text are
counted; a filter that is too full answers yes by chance, so the expected number
of false yeses is taken off before the shares are compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from ..session import cut_lineage
from .common import beside

ORDERS = (3, 4)
UNKNOWN = "und"
BLOCK = 1 << 19
DEVIATIONS = 5  # what a count must exceed the expected false yeses by, in their standard deviations
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


@cache
def letter_table() -> np.ndarray:
    """For every code point its lower-case letter, 0 for anything else."""
    table = np.zeros(0x110000, dtype=np.uint32)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            low = char.lower()
            table[code] = ord(low) if len(low) == 1 else code
    return table


def letters(text: str) -> np.ndarray:
    """Lower-case letters of a text with one 0 between words and at both ends."""
    codes = letter_table()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")]
    codes = np.concatenate([np.zeros(1, np.uint32), codes, np.zeros(1, np.uint32)])
    return codes[np.append(True, (codes[1:] != 0) | (codes[:-1] != 0))]


def grams(codes: np.ndarray, orders: tuple[int, ...] = ORDERS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per order: 64-bit hashes of the n-grams and where they begin; no n-gram
    reaches over a word's end."""
    wide = codes.astype(np.uint64)
    for n in orders:
        size = len(wide) - n + 1
        if size <= 0:
            continue
        mixed = np.full(size, np.uint64(n), dtype=np.uint64)
        whole = np.ones(size, dtype=bool)
        for k in range(n):
            mixed = (mixed ^ wide[k:k + size]) * MULTIPLIER
            mixed ^= mixed >> np.uint64(29)
            if 0 < k < n - 1:
                whole &= codes[k:k + size] != 0
        at = np.flatnonzero(whole)
        yield mixed[at], at


@dataclass
class LanguageFilters:
    """``masks``: per word of 64 languages one array of slots."""

    languages: list[str]
    masks: np.ndarray
    probes: int
    orders: tuple[int, ...] = ORDERS

    @classmethod
    def build(cls, rows: list[tuple[int, int]], languages: list[str], bits_per_gram: int = 16, probes: int = 4,
              orders: tuple[int, ...] = ORDERS) -> LanguageFilters:
        """From (hash, position of the language) pairs."""
        most = max(np.bincount([r[1] for r in rows], minlength=1).max() if rows else 1, 1)
        slots = 1 << int(np.ceil(np.log2(max(64, bits_per_gram * most))))
        filters = cls(languages, np.zeros((max(1, -(-len(languages) // 64)), slots), dtype=np.uint64), probes, orders)
        hashes = np.array([r[0] for r in rows], dtype=np.int64).view(np.uint64)
        owner = np.array([r[1] for r in rows], dtype=np.int64)
        for language in range(len(languages)):
            for slot in filters.slots(hashes[owner == language]):
                filters.masks[language // 64][slot] |= np.uint64(1 << (language % 64))
        return filters

    def slots(self, hashes: np.ndarray) -> Iterator[np.ndarray]:
        step = (hashes >> np.uint64(32)) | np.uint64(1)
        for k in range(self.probes):
            yield (hashes + np.uint64(k) * step) & np.uint64(self.masks.shape[1] - 1)

    def chance(self) -> np.ndarray:
        """Per language the share of unseen n-grams that its filter accepts."""
        filled = [float(np.count_nonzero(self.masks[i // 64] & np.uint64(1 << (i % 64)))) / self.masks.shape[1] for i in range(len(self.languages))]
        return np.array(filled) ** self.probes

    def counts(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Per text the number of its n-grams and, per language, of those that
        the language's filter holds.  Works on blocks of about ``BLOCK``
        letters, so neither a long text nor many texts need much memory."""
        total = np.zeros(len(texts), dtype=np.int64)
        hits = np.zeros((len(texts), len(self.languages)), dtype=np.int64)
        pending: list[tuple[int, np.ndarray]] = []
        size = 0

        def flush() -> None:
            nonlocal pending, size
            if pending:
                codes = np.concatenate([c for _, c in pending])
                ends = np.cumsum([len(c) for _, c in pending])
                owners = np.array([i for i, _ in pending])
                for mixed, at in grams(codes, self.orders):
                    own = owners[np.searchsorted(ends, at, side="right")]
                    total[:] += np.bincount(own, minlength=len(texts))
                    for word, masks in enumerate(self.masks):
                        both = None
                        for slot in self.slots(mixed):
                            got = masks[slot]
                            both = got if both is None else both & got
                        for i in range(64 * word, min(64 * word + 64, len(self.languages))):
                            hits[:, i] += np.bincount(own[(both >> np.uint64(i % 64)) & np.uint64(1) == 1], minlength=len(texts))
            pending, size = [], 0

        for i, text in enumerate(texts):
            codes = letters(text or "")
            while len(codes) > 1:  # a long text in parts that end between words, or overlap where a word is longer than a part
                part = codes[:BLOCK]
                if len(part) < len(codes):
                    gaps = np.flatnonzero(part == 0)
                    end = int(gaps[-1]) if len(gaps) and gaps[-1] > 0 else len(part) - 1
                    part, codes = codes[:end + 1], codes[end:]
                else:
                    codes = codes[:0]
                pending.append((i, np.concatenate([part, np.zeros(1, np.uint32)])))
                size += len(part)
                if size >= BLOCK:
                    flush()
        flush()
        return total, hits

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and coverage per text.  The score is the winner's share
        of the corrected counts; equal counts go to the name that sorts first.
        The coverage is the winner's corrected count as a share of all n-grams, 0
        if chance alone could have made it."""
        total, hits = self.counts(texts)
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
        chance = self.chance()
        true = np.clip((hits - total[:, None] * chance) / np.maximum(1e-9, 1 - chance), 0, None)
        best = true.argmax(axis=1)
        whole = true.sum(axis=1)
        score = np.where(whole > 0, true.max(axis=1) / np.maximum(whole, 1e-12), 0.0)
        wins, false = hits[np.arange(len(texts)), best], chance[best]
        sure = wins - total * false > DEVIATIONS * np.sqrt(total * false * (1 - false))
        coverage = np.where(sure, true.max(axis=1) / np.maximum(total, 1), 0.0)
        spoken = np.array([any(map(str.isalpha, t)) if t else False for t in texts], dtype=bool)
        return [self.languages[b] if s else UNKNOWN for b, s in zip(best, spoken)], np.where(spoken, score, 0.0), np.where(spoken, coverage, 0.0)


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", sample_docs: int = 4_000,
        grams_per_language: int = 60_000, share_of_most: float = 0.2, orders: tuple[int, ...] = ORDERS) -> LanguageFilters:
    """Filters from rows with a language.

    Of each language about ``sample_docs`` documents are read, chosen by the
    hash of the id, and its ``grams_per_language`` most frequent n-grams kept;
    both bound what reaches the driver.  A language holds an n-gram if it is at
    least ``share_of_most`` times as frequent there as in the language where it
    is most frequent: quotes and license lines would otherwise put the n-grams
    of one language into all.  Rows without text or language are
    passed over.
    """
    known = docs.where(F.col(lang).isNotNull())
    sizes = {r[0]: r[1] for r in known.groupBy(lang).count().collect()}  # one row per language
    languages = sorted(sizes)
    if not languages:
        return LanguageFilters.build([], [], orders=orders)
    share = F.lit(0.0)
    for name, n in sizes.items():
        share = F.when(F.col(lang) == name, F.lit(min(1.0, sample_docs / n))).otherwise(share)
    chosen = known.where(F.pmod(F.xxhash64(doc_id), F.lit(1 << 30)) < share * (1 << 30)).where(F.col(text).isNotNull())

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, texts in batch.groupby(lang, sort=True)[text]:
                for start in range(0, len(texts), 200):
                    codes = np.concatenate([letters(t) for t in texts.iloc[start:start + 200]])
                    for mixed, _ in grams(codes, orders):
                        distinct, n = np.unique(mixed, return_counts=True)
                        yield pd.DataFrame({"lang": name, "gram": distinct.view(np.int64), "n": n})

    rows = chosen.select(lang, text).mapInPandas(count, "lang string, gram long, n long")
    counted = rows.groupBy("lang", "gram").agg(F.sum("n").alias("n")).where("n > 1")
    whole = counted.groupBy("lang").agg(F.sum("n").alias("whole"))  # one row per language
    rates = cut_lineage(counted.join(F.broadcast(whole), "lang").withColumn("rate", F.col("n") / F.col("whole")))
    most = rates.groupBy("gram").agg(F.max("rate").alias("most"))
    counted = cut_lineage(rates.join(most, "gram").where(F.col("rate") >= share_of_most * F.col("most")).select("lang", "gram", "n"))
    kept: list[tuple[int, int]] = []
    for i, name in enumerate(languages):
        top = counted.where(F.col("lang") == name).orderBy(F.desc("n"), "gram").limit(grams_per_language).select("gram")
        kept += [(r[0], i) for r in top.collect()]
    return LanguageFilters.build(kept, languages, orders=orders)


def identify(docs: DataFrame, filters: LanguageFilters, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``coverage``.

    NULL texts and texts without a letter are ``und`` with score 0; a text none
    of whose n-grams is known goes to the language that sorts first, with score
    0.  Equal texts get equal answers.  Columns of these names are replaced.
    Narrow plan; the filters travel as one broadcast of
    ``filters.masks.nbytes``, bounded by ``grams_per_language``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(filters)
    result = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("coverage", T.DoubleType())])

    @F.pandas_udf(result)
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for batch in batches:
            names, scores, shares = [], [], []
            for start in range(0, len(batch), 500):
                n, s, c = model.predict(batch.iloc[start:start + 500].tolist())
                names += n
                scores.append(s)
                shares.append(c)
            yield pd.DataFrame({"lang_pred": names, "score": np.concatenate(scores) if scores else [],
                                "coverage": np.concatenate(shares) if shares else []})

    # as if it were not deterministic: a filter on the result would otherwise be pushed below and predict a second time
    return beside(docs, predicted.asNondeterministic()(F.col(f"`{text}`")), result.fieldNames())
