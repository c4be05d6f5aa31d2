"""Word shingles as 64-bit hashes, for whole batches of texts.

Words are runs of characters other than ASCII white space, A-Z lower-cased: what
``bytes.lower().split()`` gives on UTF-8.  A text with fewer words than a
shingle has one shingle, its whole sequence; a text without words has none.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORDS_PER_SHINGLE = 5
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


SLICE = 1 << 17
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
BYTES = np.random.default_rng(11).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
RADIX = 0xD6E8FEB86659FD93  # odd, so that it has an inverse modulo 2 ** 64


def _powers(base: int, count: int) -> np.ndarray:
    return np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(count - 1, np.uint64(base)), dtype=np.uint64)])


HELD = SLICE + (1 << 12)  # a slice runs on to the end of a word
POWERS, INVERSES = _powers(RADIX, HELD), _powers(pow(RADIX, -1, 1 << 64), HELD)


def words(text: str | None) -> list[bytes]:
    return text.encode().lower().split() if text else []


def mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * MULTIPLIER
    return values ^ (values >> np.uint64(29))


def shingles(hashes: np.ndarray, n: int = WORDS_PER_SHINGLE) -> np.ndarray:
    """One hash per shingle in text order, repeated shingles included."""
    if not len(hashes):
        return hashes
    size = min(n, len(hashes))
    count = len(hashes) - size + 1
    mixed = np.full(count, np.uint64(size), dtype=np.uint64)
    for k in range(size):
        mixed = mix(mixed * MULTIPLIER + hashes[k:k + count])
    return mixed


def exact(own: list[bytes], n: int = WORDS_PER_SHINGLE) -> set[tuple[bytes, ...]]:
    """The shingles themselves."""
    return {tuple(own)} if 0 < len(own) < n else set(zip(*(own[k:] for k in range(n))))


def word_hashes(texts: Sequence[str | None], fold: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and where each text's words begin (one
    bound more than texts).  Without ``fold``, A-Z stay as they are.

    A word's hash is a polynomial over its bytes, read off one running sum per
    slice of the joined texts, so no word becomes a Python object.  Slices end
    between words; what is held besides the result does not grow with a text.
    """
    encoded = [t.encode() if t else b"" for t in texts]
    joined = b"\n".join(encoded) + b"\n"
    data = np.frombuffer(joined.lower() if fold else joined, dtype=np.uint8)
    hashes, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    start = 0
    while start < len(data):
        end = min(start + SLICE, len(data))
        while not SPACE[data[end - 1]]:  # at the latest at the closing line feed
            gaps = np.flatnonzero(SPACE[data[end:end + SLICE]])
            end = end + int(gaps[0]) + 1 if len(gaps) else min(end + SLICE, len(data))
        part = data[start:end]
        space = SPACE[part]
        change = np.flatnonzero(np.diff(space, prepend=True))
        opens, closes = change[0::2], change[1::2]  # the slice begins after and ends with a space
        powers, inverses = (POWERS, INVERSES) if len(part) <= HELD else (_powers(RADIX, len(part)), _powers(pow(RADIX, -1, 1 << 64), len(part)))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(BYTES[part] * powers[:len(part)], dtype=np.uint64)])
        hashes.append(mix((sums[closes] - sums[opens]) * inverses[opens] + (closes - opens).astype(np.uint64)))
        places.append(opens + start)
        start = end
    edges = np.cumsum([0] + [len(e) + 1 for e in encoded])
    return np.concatenate(hashes), np.searchsorted(np.concatenate(places), edges)


def batches(texts: Sequence[str | None], chars: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about ``chars`` characters each."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text) if text else 0
        if size >= chars:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def text_blocks(batch: pa.RecordBatch, column: int, size: int = 1 << 20) -> Iterator[tuple[int, int, list[str | None]]]:
    """(start, end, texts) for runs of rows with about ``size`` bytes of text, so
    that only one run at a time exists as Python strings."""
    texts = batch.column(column)
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(texts):
        before = int(ends[start - 1]) if start else 0
        end = min(len(texts), int(np.searchsorted(ends, before + size, side="left")) + 1)
        yield start, end, texts.slice(start, end - start).to_pylist()
        start = end


def text_shingles(texts: Sequence[str | None], n: int = WORDS_PER_SHINGLE) -> Iterator[np.ndarray]:
    """The shingles of each text in text order."""
    for first, last in batches(texts):
        hashes, bounds = word_hashes(texts[first:last])
        mixed = shingles(hashes, n)
        for a, b in zip(bounds.tolist(), bounds[1:].tolist()):
            yield mixed[a:b - n + 1] if b - a >= n else shingles(hashes[a:b], n)
