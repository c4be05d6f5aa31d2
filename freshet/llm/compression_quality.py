"""Quality by compression: two zstandard dictionaries, one of good and one of
bad text.  What a text is like compresses better with the dictionary of its
kind; the difference of both sizes per byte is turned into a probability by
isotonic steps fitted on labelled texts that the dictionaries have not seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK, SAMPLE = 256, 4096
LEVEL = 3


@dataclass
class CompressionModel:
    good: bytes
    bad: bytes
    edges: np.ndarray  # differences, ascending
    values: np.ndarray  # probability of a good label at each
    prior: float

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_pair"}

    def compressors(self):
        import zstandard

        if "_pair" not in self.__dict__:
            self._pair = [zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_AUTO),
                                                   write_content_size=False, write_checksum=False, write_dict_id=False)
                          for d in (self.good, self.bad)]
        return self._pair

    def difference(self, text: str) -> float:
        """(size with the bad dictionary - size with the good one) per byte.
        The text is compressed in short chunks, so that the dictionaries
        and not the text's own beginning explain what follows."""
        data = text.encode()
        good, bad = self.compressors()
        parts = [data[i:i + CHUNK] for i in range(0, len(data), CHUNK)]
        return (sum(len(bad.compress(p)) for p in parts) - sum(len(good.compress(p)) for p in parts)) / max(1, len(data))

    def score(self, text: str | None) -> float:
        if not text:
            return self.prior
        return float(np.interp(self.difference(text), self.edges, self.values)) if len(self.edges) else self.prior


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators; returns the middle of each pool and its mean."""
    pools: list[list[float]] = []
    for a, b, c in zip(*(v[np.argsort(x, kind="stable")] for v in (x, y, w))):
        pools.append([a * c, b * c, c])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [p + q for p, q in zip(pools[-1], last)]
    p = np.array(pools)
    return p[:, 0] / p[:, 2], p[:, 1] / p[:, 2]


def train(texts: list[str], labels: list[int], dictionary_bytes: int = 112 << 10) -> CompressionModel:
    """Two dictionaries from the even and the scale from the odd texts of each
    label.  Without examples of both labels every score is the prior."""
    import zstandard

    prior = float(np.mean(labels)) if labels else 0.5
    by = {1: [t for t, y in zip(texts, labels) if y == 1 and t], 0: [t for t, y in zip(texts, labels) if y == 0 and t]}
    if min(len(by[0]), len(by[1])) < 2:
        return CompressionModel(b"", b"", np.array([]), np.array([]), prior)

    def dictionary(samples: list[str]) -> bytes:
        data = [part for t in samples for part in [t.encode()[i:i + SAMPLE] for i in range(0, len(t.encode()), SAMPLE)]]
        try:
            return zstandard.train_dictionary(dictionary_bytes, data).as_bytes()
        except zstandard.ZstdError:  # too little text to choose from: the text itself
            return b"\n".join(data)[-dictionary_bytes:]

    model = CompressionModel(dictionary(by[1][::2]), dictionary(by[0][::2]), np.array([]), np.array([]), prior)
    rest = [(t, 1.0) for t in by[1][1::2]] + [(t, 0.0) for t in by[0][1::2]]
    x = np.array([model.difference(t) for t, _ in rest])
    y = np.array([v for _, v in rest])
    # both labels count as they occur; a pseudo count at each end keeps scores off 0 and 1
    model.edges, model.values = isotonic(np.append(x, [x.min() - 1e-6, x.max() + 1e-6]), np.append(y, [prior, prior]), np.ones(len(x) + 2))
    return model


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "quality",
        sample_docs: int = 3_000, sample_chars: int = 20_000) -> CompressionModel:
    """A model from at most about ``sample_docs`` labelled documents of each
    label, chosen by the hash of the id; texts longer than ``sample_chars`` are
    not chosen, so the driver receives a bounded amount.  Rows without id, text
    or label are passed over; a document labelled twice counts twice."""
    known = labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull()).select(doc_id, F.col(label).alias("_y"))
    sizes = {r[0]: r[1] for r in known.groupBy("_y").count().collect()}
    share = F.lit(0.0)
    for y, n in sizes.items():
        share = F.when(F.col("_y") == y, F.lit(min(1.0, sample_docs / n))).otherwise(share)
    chosen = known.where(F.pmod(F.xxhash64(doc_id), F.lit(1 << 30)) < share * (1 << 30))
    rows = (
        docs.where(F.length(text).between(1, sample_chars)).select(doc_id, F.col(text).alias("_t"))
        .join(F.broadcast(chosen), doc_id)  # bounded by sample_docs
        .select(doc_id, "_t", "_y").collect()
    )
    rows.sort(key=lambda r: (r[0], r["_t"]))
    return train([r["_t"] for r in rows], [r["_y"] for r in rows])


def score(docs: DataFrame, model: CompressionModel, text: str = "text") -> DataFrame:
    """``docs`` with ``score``: the probability of a good label.

    NULL and empty texts get the share of good labels; equal texts get equal
    scores.  A column ``score`` is replaced.  Narrow plan, whole texts.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(T.DoubleType())
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([shared.value.score(t) for t in batch], dtype="float64")

    return docs.withColumn("score", scored(F.col(f"`{text}`")))
