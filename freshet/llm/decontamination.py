"""Benchmark decontamination by size-partitioned MinHash containment search.

Similarity says little when a short item stands in a long document.  So items
are partitioned by size, each partition looks through windows of documents that
are at most four times its smallest item, and within a window containment of
75 % means a Jaccard similarity of 0.17 or more.  An item is a candidate where
any of ``PERMUTATIONS`` minima of window and item are equal (one row per band),
which misses a contained item with a probability below 1 in 100,000; an item of
at most four shingles is a candidate where any of its shingles occurs.  Candidates
are verified with the shingles of the whole document, words against words.

Minima are taken once per eight shingles and combined for larger windows.  The
items are the stated query set: they go to the tasks in blocks of bounded size.
Documents are read once per block, in a narrow plan.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .shingles import WORDS_PER_SHINGLE, batches, exact, text_blocks, text_shingles, words

PERMUTATIONS = 64
PERCENT = 75
BASE = 8
BLOCK = 1 << 15
ITEMS_PER_BLOCK = 20_000


@dataclass
class Partition:
    """Items whose number of shingles is at most ``blocks * BASE`` and more than half of it."""

    blocks: int
    items: list[int]
    minima: np.ndarray  # permutation x item, sorted along the items
    order: np.ndarray
    table: np.ndarray  # permutation x low 16 bits: may an item have this minimum?


class ItemIndex:
    """Signatures and shingles of a block of items."""

    def __init__(self, items: list[tuple[object, str]], n: int = WORDS_PER_SHINGLE):
        self.n = n
        self.ids: list[object] = []
        self.exact: list[set[tuple[bytes, ...]]] = []
        self.hashes: list[np.ndarray] = []
        rng = np.random.default_rng(7)
        self.factors = rng.integers(0, 1 << 31, PERMUTATIONS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        self.offsets = rng.integers(0, 1 << 32, PERMUTATIONS, dtype=np.uint32)
        for (item, text), own in zip(items, text_shingles([t for _, t in items], n)):
            if len(own):
                self.ids.append(item)
                self.exact.append(exact(words(text), n))
                self.hashes.append(np.unique(own))
        groups: dict[int, list[int]] = {}
        tiny: dict[int, list[int]] = {}
        for i, own in enumerate(self.hashes):
            if len(own) <= BASE // 2:
                for value in own.tolist():
                    tiny.setdefault(value, []).append(i)
                continue
            blocks = 1
            while blocks * BASE < len(own):
                blocks *= 2
            groups.setdefault(blocks, []).append(i)
        self.tiny, self.tiny_hashes = tiny, np.array(sorted(tiny), dtype=np.uint64)
        self.partitions = [self.partition(blocks, members) for blocks, members in sorted(groups.items())]

    def values(self, hashes: np.ndarray, k: int) -> np.ndarray:
        return (hashes >> np.uint64(32)).astype(np.uint32) * self.factors[k] + self.offsets[k]

    def partition(self, blocks: int, members: list[int]) -> Partition:
        minima = np.array([[self.values(self.hashes[i], k).min() for i in members] for k in range(PERMUTATIONS)], dtype=np.uint32)
        order = np.argsort(minima, axis=1, kind="stable")
        table = np.zeros((PERMUTATIONS, 1 << 16), dtype=bool)
        for k in range(PERMUTATIONS):
            table[k, minima[k] & np.uint32(0xFFFF)] = True
        return Partition(blocks, members, np.take_along_axis(minima, order, axis=1), order, table)

    def candidates(self, parts: list[np.ndarray]) -> set[tuple[int, int]]:
        """(position in ``parts``, item) pairs with an equal minimum; ``parts``
        are the shingles of documents or of pieces of them."""
        padded = [np.concatenate([p, np.repeat(p[-1:], -len(p) % BASE)]) for p in parts if len(p)]
        pairs: set[tuple[int, int]] = set()
        if self.tiny:
            pairs.update((d, i) for d, p in enumerate(parts) for v in np.intersect1d(p, self.tiny_hashes).tolist() for i in self.tiny[v])
        if not padded or not self.partitions:
            return pairs
        owners = np.repeat([i for i, p in enumerate(parts) if len(p)], [len(p) // BASE for p in padded])
        high = (np.concatenate(padded) >> np.uint64(32)).astype(np.uint32)
        for k in range(PERMUTATIONS):
            low = high * self.factors[k] + self.offsets[k]
            for _ in range(BASE.bit_length() - 1):
                low = np.minimum(low[0::2], low[1::2])
            reach, window = 1, low
            for part in self.partitions:
                while reach < 2 * part.blocks:  # a window over twice the largest item, so that steps of its size miss no run
                    if len(window) > reach:
                        window = np.concatenate([np.minimum(window[:-reach], window[reach:]), window[-reach:]])
                    reach *= 2
                at = np.arange(0, len(window), part.blocks)
                here = window[at]
                hit = np.flatnonzero(part.table[k, here & np.uint32(0xFFFF)])
                if not len(hit):
                    continue
                start = np.searchsorted(part.minima[k], here[hit], side="left")
                end = np.searchsorted(part.minima[k], here[hit], side="right")
                for h, a, b in zip(hit[end > start].tolist(), start[end > start].tolist(), end[end > start].tolist()):
                    first = at[h]
                    docs = np.unique(owners[first:first + reach])
                    pairs.update((int(d), part.items[int(m)]) for m in part.order[k, a:b] for d in docs)
        return pairs

    def search(self, texts: list[str | None]) -> Iterator[tuple[int, int, int]]:
        """(position of the text, item, shingles of the item in the text) where
        the text holds enough of the item."""
        pieces: list[tuple[int, np.ndarray]] = []
        whole: dict[int, np.ndarray] = {}
        size = 0

        def flush() -> Iterator[tuple[int, int]]:
            nonlocal pieces, size
            found = self.candidates([p for _, p in pieces])
            yield from ((pieces[d][0], i) for d, i in found)
            pieces, size = [], 0

        found: set[tuple[int, int]] = set()
        longest = 2 * BASE * max((p.blocks for p in self.partitions), default=1)
        for t, own in enumerate(text_shingles(texts, self.n)):
            whole[t] = own
            step = max(BLOCK, 4 * longest)
            for start in range(0, max(1, len(own)), step):
                piece = own[start:start + step + longest]  # the next piece begins before this one ends
                pieces.append((t, piece))
                size += len(piece)
                if size >= BLOCK:
                    found.update(flush())
        found.update(flush())
        for t, i in sorted(found):
            need = -(-PERCENT * len(self.exact[i]) // 100)
            if np.isin(self.hashes[i], whole[t]).sum() >= need:
                shared = len(self.exact[i] & exact(words(texts[t]), self.n))
                if shared >= need:
                    yield t, i, shared


def item_blocks(items: DataFrame, item_id: str, item_text: str, per_block: int) -> Iterator[ItemIndex]:
    """The items in blocks by hash, each small enough for the driver and one broadcast."""
    items = items.select(F.col(item_id).alias("i"), F.col(item_text).alias("t")).where("t IS NOT NULL").distinct()
    blocks = max(1, -(-items.count() // per_block))
    for block in range(blocks):
        rows = [(r["i"], r["t"]) for r in items.where(F.pmod(F.xxhash64("t", F.lit(3)), F.lit(blocks)) == block).collect()]
        yield ItemIndex(sorted(rows, key=lambda r: (r[0] is None, r[0], r[1])))


def _matches(docs: DataFrame, index: ItemIndex, doc_id: str, text: str, item_type: T.DataType) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(index)
    schema = T.StructType([
        T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("item_id", item_type),
        T.StructField("shared", T.LongType()), T.StructField("item_shingles", T.LongType())])
    target = to_arrow_schema(schema)

    def search(rows_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        for batch in rows_in:
            ids = batch.column(0)
            for start, _, texts in text_blocks(batch, 1):
                rows = [(ids[start + t].as_py(), items.ids[i], n, len(items.exact[i])) for t, i, n in items.search(texts)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), target)], schema=target)

    return docs.select(F.col(f"`{doc_id}`"), F.col(f"`{text}`")).mapInArrow(search, schema)


def contained_items(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    item_id: str = "item_id", item_text: str = "text", items_per_block: int = ITEMS_PER_BLOCK) -> DataFrame:
    """Rows (doc_id, item_id, shared, item_shingles) for each document that holds
    at least 75 % of an item's distinct shingles of five words, wherever in the
    document they stand.

    NULL texts and texts without words hold nothing and are held by nothing.  An
    item or a document of fewer than five words is one shingle.  Repeated rows
    of documents give repeated rows, repeated items count once.  The items reach
    the driver in blocks of ``items_per_block``; each block is one pass.
    """
    return reduce(DataFrame.unionByName, [
        _matches(docs, index, doc_id, text, items.schema[item_id].dataType)
        for index in item_blocks(items, item_id, item_text, items_per_block)])


def _cleaner(shared):
    def clean(column: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in column:
            kept, texts = np.ones(len(batch), dtype=bool), batch.tolist()
            for start, end in batches(texts):
                kept[[start + t for t, _, _ in shared.value.search(texts[start:end])]] = False
            yield pd.Series(kept)

    return clean


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", items_per_block: int = ITEMS_PER_BLOCK) -> DataFrame:
    """``docs`` without the rows whose text holds an item, judged as in
    ``contained_items`` row by row, so repeated or missing ids do no harm."""
    for index in item_blocks(items, item_id, item_text, items_per_block):
        docs = docs.where(F.pandas_udf(_cleaner(docs.sparkSession.sparkContext.broadcast(index)), T.BooleanType())(F.col(f"`{text}`")))
    return docs
