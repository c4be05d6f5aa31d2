"""Batch scoring of free-text answers against named checks.

All checks are column expressions, so a table of answers of any size is scored
in one pass without a loop.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words, patterns and notes of the checks.
SOURCE_SYSTEMS = ["SAP", "ORACLE", "BAAN", "WORKDAY"]
CURRENCIES = ["USD", "EUR", "GBP"]
STATUSES = ["APPROVED", "PENDING"]
DIGIT = r"\p{Nd}"
LIST_MARK = r"(-|\p{Nd}\.|,)"
MONTH = "jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec"
DATE = r"\p{Nd}{4}-\p{Nd}{2}(-\p{Nd}{2})?"
OVERDUE = "overdue|due date|past due"
THRESHOLD = "100[,]?000|100k"
HEDGES = [
    "clarify", "which", "what time", "what do you mean", "could you specify", "no matching",
    "not found", "did not find", "based on", "according to", "retrieved",
]
NOTES = {
    "numeric_present": ("found a number", "no number found in answer"),
    "contains_vendor_list": ("answer looks list-shaped with numbers", "answer is missing list structure or numbers"),
    "mentions_source_system": (None, "no source system named"),
    "mentions_currency_codes": (None, "no currency code named"),
    "mentions_approval_status": (None, "no approval status named"),
    "mentions_time_period": ("answer references a time period", "no month or date found in answer"),
    "mentions_acme": ("echoes Acme", "does not echo the vendor named in the question"),
    "mentions_overdue": ("engages with overdue/due-date concept", "answer does not mention overdue or due date"),
    "mentions_threshold": ("reflects the $100,000 threshold", "answer does not reference the threshold"),
    "no_hallucinated_certainty": (
        "answer is grounded or appropriately hedged",
        "answer asserts without grounding or asking for clarification",
    ),
}


def _named(answer: Column, words: list[str]) -> Column:
    """The listed words an answer contains, in list order."""
    upper = F.upper(answer)
    return F.array_compact(F.array(*[F.when(F.contains(upper, F.lit(w)), F.lit(w)) for w in words]))


def _any(answer: Column, words: list[str]) -> Column:
    lower = F.lower(answer)
    hit = F.contains(lower, F.lit(words[0]))
    for word in words[1:]:
        hit = hit | F.contains(lower, F.lit(word))
    return hit


NAMED = {
    "mentions_source_system": SOURCE_SYSTEMS,
    "mentions_currency_codes": CURRENCIES,
    "mentions_approval_status": STATUSES,
}
TESTS: dict[str, Callable[[Column], Column]] = {
    "numeric_present": lambda a: a.rlike(DIGIT),
    "contains_vendor_list": lambda a: a.rlike(LIST_MARK) & a.rlike(DIGIT),
    **{check: (lambda a, words=words: F.size(_named(a, words)) > 0) for check, words in NAMED.items()},
    "mentions_time_period": lambda a: F.lower(a).rlike(MONTH) | a.rlike(DATE),
    "mentions_acme": lambda a: _any(a, ["acme"]),
    "mentions_overdue": lambda a: F.lower(a).rlike(OVERDUE),
    "mentions_threshold": lambda a: F.lower(a).rlike(THRESHOLD),
    "no_hallucinated_certainty": lambda a: _any(a, HEDGES),
}


def _note(check: str, answer: Column, passed: Column) -> Column:
    good, bad = NOTES[check]
    if check in NAMED:
        text = F.concat(F.lit("mentions "), F.array_join(_named(answer, NAMED[check]), ", "))
    else:
        text = F.lit(good)
    return F.when(passed, text).otherwise(F.lit(bad))


def score(answers: DataFrame, answer: str = "answer", check: str = "check") -> DataFrame:
    """Add ``passed`` and ``note``; a check nobody knows gives NULL and says so."""
    passed, note = None, None
    for name, test in TESTS.items():
        chosen, result = F.col(check) == name, test(F.col(answer))
        passed = F.when(chosen, result) if passed is None else passed.when(chosen, result)
        text = _note(name, F.col(answer), result)
        note = F.when(chosen, text) if note is None else note.when(chosen, text)
    unknown = F.concat(F.lit("unknown check: "), F.coalesce(F.col(check), F.lit("none")))
    return answers.withColumns({"passed": passed, "note": note.otherwise(unknown)})


def pass_rate(scored: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Checks passed, overall or per group."""
    return scored.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("answers"), F.count_if("passed").alias("passed_answers"),
        (F.count_if("passed") / F.count(F.lit(1))).alias("pass_rate"))


def failed(scored: DataFrame) -> DataFrame:
    return scored.where(~F.coalesce(F.col("passed"), F.lit(False)))
