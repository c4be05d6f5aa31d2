"""Quality rules as a ledger of bits.

Every rule is evaluated once per text.  The ledger keeps what was measured and
one bit per failed rule; a policy is a set of bits with a version, so verdicts
of any version, and what each rule does within it, come from the bits alone
without reading the texts again.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WORDS, beside

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letter_words", "n_letters", "n_upper", "n_run_words"]
SYMBOLS = frozenset("#*$%&|<>")
WINDOW = 8


def _at_most(part: str, whole: str, percent: int) -> Column:
    return 100 * F.col(part) > percent * F.col(whole)


#: Rules in the order of their bits: a name and when a text fails it.  New rules are added at the end, so stored bits keep their meaning.
RULES: dict[str, Column | None] = dict.fromkeys(
    ["few_words", "repeated_words", "short_words", "long_words", "symbols", "repeated_lines", "few_letter_words", "upper_case", "word_runs"])


def failures() -> dict[str, Column]:
    return {
        "few_words": F.col("n_words") < 20,
        "repeated_words": _at_most("n_repeat_words", "n_words", 30),
        "short_words": F.col("word_chars") < 2 * F.col("n_words"),
        "long_words": F.col("word_chars") > 15 * F.col("n_words"),
        "symbols": _at_most("n_symbols", "n_words", 10),
        "repeated_lines": _at_most("n_dup_lines", "n_lines", 40),
        "few_letter_words": 100 * F.col("n_letter_words") < 80 * F.col("n_words"),
        "upper_case": _at_most("n_upper", "n_letters", 50),
        "word_runs": _at_most("n_run_words", "n_words", 30),
    }


#: Versions of the policy: the rules a text must pass.
POLICIES: dict[str, list[str]] = {
    "2026-1": ["few_words", "repeated_words"],
    "2026-2": list(RULES),
}
LATEST = "2026-2"


def repeated_words(words: list[str], window: int = WINDOW) -> int:
    """Words inside windows of ``window`` words that occur at least twice in the
    text, the first occurrence included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    ids = np.fromiter(map(hash, words), dtype=np.int64, count=len(words)).view(np.uint64)
    mixed = np.zeros(n, dtype=np.uint64)
    for k in range(window):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + (ids[k:k + n] ^ (ids[k:k + n] >> np.uint64(29)))
    order = np.argsort(mixed, kind="stable")
    equal = mixed[order[1:]] == mixed[order[:-1]]
    if not equal.any():
        return 0
    twice = np.zeros(n, dtype=bool)
    twice[order[1:][equal]] = twice[order[:-1][equal]] = True
    at: dict[tuple[str, ...], list[int]] = {}  # hashes choose, words decide
    for i in np.flatnonzero(twice).tolist():
        at.setdefault(tuple(words[i:i + window]), []).append(i)
    starts = np.array([i for found in at.values() if len(found) > 1 for i in found], dtype=np.int64)
    covered = np.zeros(len(words), dtype=bool)
    for k in range(window):
        covered[starts + k] = True
    return int(covered.sum())


def measure(text: str | None) -> tuple[int, ...]:
    """The measurements of one text in the order of ``MEASURES``; all 0 for none."""
    if not text:
        return (0,) * len(MEASURES)
    words = WORDS.findall(text)
    lines = [x for x in text.split("\n") if x.strip(" \t\n\v\f\r")]
    chars = set(text)
    letters = len(text) - sum(text.count(c) for c in chars if not c.isalpha())
    upper = sum(text.count(c) for c in chars if c.isalpha() and c.isupper())
    without = sum(1 for w in words if not w.isalpha() and not any(map(str.isalpha, w)))
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in chars & SYMBOLS), len(lines) - len(set(lines)),
            repeated_words(words), len(lines), len(words) - without, letters, upper, sum(map(eq, words, words[1:])))


def ledger(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per document: ``keep``, the measurements and ``fail_bits``.

    Bit ``i`` is set if the text fails the ``i``-th of ``RULES``.  A NULL or
    empty text measures 0 throughout and fails only ``few_words``.  Equal rows
    give equal rows.  Kept columns called like a measurement or ``fail_bits`` are
    replaced.  Narrow plan, texts are read whole.
    """
    schema = T.StructType([T.StructField(m, T.LongType()) for m in MEASURES])

    @F.pandas_udf(schema)
    def measured(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([measure(t) for t in batch], columns=MEASURES, dtype="int64")

    rows = beside(docs, measured(F.col(f"`{text}`")), MEASURES, [c for c in keep if c != "fail_bits"])
    when = failures()
    bits = sum((when[name].cast("long") * F.lit(1 << i) for i, name in enumerate(RULES)), F.lit(0).cast("long"))
    return rows.withColumn("fail_bits", bits)


def mask(rules: list[str]) -> int:
    names = list(RULES)
    return sum(1 << names.index(r) for r in set(rules))


def passes(version: str = LATEST, policies: Mapping[str, list[str]] = POLICIES) -> Column:
    """Whether a ledger row passes every rule of a policy."""
    return F.col("fail_bits").bitwiseAND(F.lit(mask(policies[version]))) == 0


def histogram(rows: DataFrame) -> DataFrame:
    """Documents per combination of failed rules: at most 2 ** rules rows."""
    return rows.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("documents"))


def ablations(rows: DataFrame, policies: Mapping[str, list[str]] = POLICIES) -> DataFrame:
    """What each rule does within each policy, from the bits alone.

    Columns: policy, rule, kept (documents the policy keeps), failed (documents
    that fail the rule), only_this (documents that the policy drops for this
    rule alone) and kept_without (documents kept if the rule were not part of
    it).  An empty ledger gives zeros.
    """
    spark, names = rows.sparkSession, list(RULES)
    plan = spark.createDataFrame(
        [(p, r, mask(chosen), 1 << names.index(r)) for p, chosen in policies.items() for r in chosen],
        "policy string, rule string, mask long, bit long")
    options = F.array(*[F.struct(F.lit(p).alias("policy"), F.lit(r).alias("rule"), F.lit(mask(chosen)).alias("mask"), F.lit(1 << names.index(r)).alias("bit"))
                        for p, chosen in policies.items() for r in chosen])
    within = F.col("fail_bits").bitwiseAND(F.col("o.mask"))
    n = lambda when: F.coalesce(F.sum(F.when(when, F.col("documents"))), F.lit(0))
    counted = histogram(rows).select("fail_bits", "documents", F.explode(options).alias("o")).groupBy("o.policy", "o.rule").agg(
        n(within == 0).alias("kept"), n(F.col("fail_bits").bitwiseAND(F.col("o.bit")) != 0).alias("failed"),
        n(within == F.col("o.bit")).alias("only_this"))
    return plan.join(counted, ["policy", "rule"], "left").select(
        "policy", "rule", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("kept", "failed", "only_this")],
        (F.coalesce("kept", F.lit(0)) + F.coalesce("only_this", F.lit(0))).alias("kept_without"))
