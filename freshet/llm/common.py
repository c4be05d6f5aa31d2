"""Pieces that several corpus operators share."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A word is a run of characters other than space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
WORDS = re.compile(WORD)
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = {ord(c): c.lower() for c in LETTERS}


def lower_ascii(text: str) -> str:
    """Lower-cases A-Z and nothing else, as ``translate`` does in SQL."""
    return text.lower() if text.isascii() else text.translate(LOWER)


def lower_ascii_column(text: Column) -> Column:
    return F.translate(text, LETTERS, LETTERS.lower())


def fold(doc_id: Column | str, parts: int) -> Column:
    """crc32 of the id written as text, modulo ``parts``; -1, which is no fold, for a NULL id."""
    text = F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")
    return F.coalesce(F.pmod(F.crc32(text), F.lit(parts)), F.lit(-1))


def beside(docs: DataFrame, found: Column, fields: Sequence[str], keep: Sequence[str] | None = None) -> DataFrame:
    """The columns of ``docs`` (or ``keep`` of them) with the ``fields`` of the
    struct ``found`` after them.

    Columns named like a field are replaced; what the others are called doesn't
    matter, as no helper column ever stands beside them.
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c not in fields]
    packed = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)]) if kept else F.lit(None)
    both = docs.select(packed.alias("kept"), found.alias("found"))
    return both.select(*[F.col(f"kept.c{i}").alias(c) for i, c in enumerate(kept)], *[F.col(f"found.{f}") for f in fields])


def documents(spark, sf_dir: str):
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
