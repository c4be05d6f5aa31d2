"""Sentiment and issue category of free text from word lists.

These are transparent stand-ins for hosted models: the lists are arguments, and
the work is one expression per text.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .search import tokens

POSITIVE = ["good", "great", "happy", "love", "excellent", "perfect", "thanks", "helpful", "fast", "comfortable"]
NEGATIVE = ["bad", "broken", "late", "unhappy", "terrible", "wrong", "refund", "slow", "defective", "disappointed"]
# Labels in tie order, each with weighted keywords.
ISSUES = {
    "Return": {"return": 2, "refund": 2, "exchange": 1, "size": 1},
    "Quality": {"broken": 2, "defective": 2, "quality": 2, "tear": 1, "crack": 1},
    "Shipping": {"shipping": 2, "delivery": 2, "late": 1, "package": 1, "tracking": 1},
}


def _count(words: Column, listed: Sequence[str]) -> Column:
    """Listed words among ``words``; one pass whatever the length of the list."""
    wanted = list(listed)
    return F.size(F.filter(words, lambda w: w.isin(wanted)))


def _weight(words: Column, keywords: Mapping[str, int]) -> Column:
    """Summed keyword points, one pass per different number of points."""
    total = F.lit(0)
    for points in sorted(set(keywords.values())):
        total = total + _count(words, [w for w, p in keywords.items() if p == points]) * points
    return total


def balance(up: Column | str, down: Column | str) -> Column:
    """(up - down) / (up + down); 0 when there is neither."""
    up, down = (F.col(c) if isinstance(c, str) else c for c in (up, down))
    return F.when(up + down > 0, (up - down) / (up + down)).otherwise(F.lit(0.0))


def heaviest(weights: Mapping[str, Column]) -> Column:
    """The label with the highest weight; the first one listed wins a tie, and
    no weight at all gives NULL."""
    best = F.greatest(F.lit(0), *weights.values())
    choice = None
    for label, weight in weights.items():
        hit = (weight == best) & (best > 0)
        choice = F.when(hit, label) if choice is None else choice.when(hit, label)
    return choice


def enrich_cases(
    cases: DataFrame, text: str = "transcript", positive: Sequence[str] = POSITIVE,
    negative: Sequence[str] = NEGATIVE, labels: Mapping[str, Mapping[str, int]] = ISSUES,
) -> DataFrame:
    """Support cases with their sentiment and issue category.

    Splitting, counting and judging are projections of their own: every text is
    split once and every list is counted once, and the generated code stays
    small enough for the JVM to compile.
    """
    words = F.col("_words")
    counts = {"_up": _count(words, positive), "_down": _count(words, negative)}
    counts |= {f"_w{i}": _weight(words, keywords) for i, keywords in enumerate(labels.values())}
    judged = {
        "sentiment": balance("_up", "_down"),
        "issue_category": heaviest({label: F.col(f"_w{i}") for i, label in enumerate(labels)}),
    }
    split = cases.withColumn("_words", tokens(text))
    return split.withColumns(counts).withColumns(judged).drop("_words", *counts)
