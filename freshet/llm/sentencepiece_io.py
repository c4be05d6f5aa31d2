"""SentencePiece models run by the tokenizers library.

The model file is a protobuf.  Its wire format is read here, and from what it
says the same tokenizer is built of library parts: normaliser, the marker that
stands for a space, either the unigram scores or the merges of a BPE model, and
the fallback to byte pieces.  Batches are encoded by the library's own threads.

Parity.  A BPE model knows pieces and scores, the library wants merges in order.
Every split of a piece into two pieces is a merge and merges are ordered by the
score of the piece.  Pieces with one score (runs of the marker share one) are
merged from left to right by SentencePiece; the longer piece first gives the
same here.  If no piece holds a marker after another character, no merge can
cross the place before a marker, so the text is cut there: each distinct word of a
block goes to the library once, and the ids of frequent words are remembered.
The same holds for the paths through a unigram model.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import beside
from .shingles import text_blocks

MARKER = "▁"
#: Fixed values of the format: kinds of pieces and of models.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def default_model() -> bytes:
    """The public model of this machine, read on the driver."""
    import public_tokenizers

    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as source:
        return source.read()


def wire_fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of one protobuf message, in order."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind)
        if size is None:
            if kind != 2:
                raise ValueError(f"wire type {kind} is not part of a model file")
            size = varint()
        yield key >> 3, data[at:at + size]
        at += size


class Model:
    """What a model file says, with the format's defaults where it is silent."""

    def __init__(self, data: bytes):
        self.pieces: list[tuple[str, float, int]] = []
        self.kind, self.byte_fallback = UNIGRAM, False
        self.charsmap, self.dummy_prefix, self.remove_extra, self.escape = b"", True, True, True
        self.prefix_at_end = False
        for field, value in wire_fields(data):
            if field == 1:
                piece, score, kind = "", 0.0, NORMAL
                for f, v in wire_fields(value):
                    if f == 1:
                        piece = v.decode()
                    elif f == 2:
                        score = struct.unpack("<f", v)[0]
                    elif f == 3:
                        kind = v
                self.pieces.append((piece, score, kind))
            elif field == 2:
                for f, v in wire_fields(value):
                    if f == 3:
                        self.kind = v
                    elif f == 35:
                        self.byte_fallback = bool(v)
                    elif f == 24:
                        self.prefix_at_end = bool(v)
            elif field == 3:
                for f, v in wire_fields(value):
                    if f == 2:
                        self.charsmap = v
                    elif f == 3:
                        self.dummy_prefix = bool(v)
                    elif f == 4:
                        self.remove_extra = bool(v)
                    elif f == 5:
                        self.escape = bool(v)
        if self.kind not in (UNIGRAM, BPE):
            raise ValueError("word and char models are not supported")
        if self.prefix_at_end or not self.escape:
            raise ValueError("only models that mark spaces in front of words are supported")

    @property
    def unknown(self) -> int:
        return next(i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN)


def merges(model: Model) -> list[tuple[str, str]]:
    score = {p: s for p, s, kind in model.pieces if kind in (NORMAL, USER_DEFINED)}
    found = [(-score[p], -len(p), -cut, p) for p in score for cut in range(1, len(p)) if p[:cut] in score and p[cut:] in score]
    return [(p[:-cut], p[-cut:]) for _, _, cut, p in ((a, b, len(p) + c, p) for a, b, c, p in sorted(found))]


def build(data: bytes):
    """A tokenizer of the tokenizers library with the ids of the model file."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers

    model = Model(data)
    if model.kind == BPE:
        tokenizer = Tokenizer(models.BPE(
            vocab={p: i for i, (p, _, _) in enumerate(model.pieces)}, merges=merges(model), unk_token=model.pieces[model.unknown][0],
            fuse_unk=True, byte_fallback=model.byte_fallback))
    else:
        tokenizer = Tokenizer(models.Unigram(
            [(p, s) for p, s, _ in model.pieces], unk_id=model.unknown, byte_fallback=model.byte_fallback))
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.remove_extra:
        steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Replace(Regex("^ +| +$"), "")]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(" "))
    tokenizer.normalizer = normalizers.Sequence([*steps, normalizers.Replace(" ", MARKER)])
    after = [decoders.Replace(MARKER, " "), decoders.ByteFallback(), decoders.Fuse()]
    tokenizer.decoder = decoders.Sequence([*after, decoders.Strip(" ", 1, 0)] if model.dummy_prefix else after)
    return tokenizer


#: Bytes of text that a task encodes at once.
BLOCK = 1 << 19


class Codec:
    """Encodes and decodes with the rebuilt tokenizer; at most ``memory`` words
    and their ids are kept, about 200 bytes each."""

    def __init__(self, data: bytes, memory: int = 160_000):
        from tokenizers import pre_tokenizers

        self.model, self.whole = Model(data), build(data)
        self.words = build(data)
        self.words.normalizer = None
        self.memory, self.known = memory, {}
        own = {p for p, _, kind in self.model.pieces if kind in (NORMAL, USER_DEFINED)}
        inner = any(MARKER in p.lstrip(MARKER) for p in own)
        self.cut = None if inner or MARKER not in own else re.compile(f"{MARKER}+[^{MARKER}]*|[^{MARKER}]+").findall
        if self.cut:  # words with one marker in front go to the library as one text and come back cut at the markers
            self.joined = build(data)
            self.joined.normalizer = None
            self.joined.pre_tokenizer = pre_tokenizers.Metaspace(replacement=MARKER, prepend_scheme="never", split=True)
        self.opens = np.array([p.startswith(MARKER) for p, _, _ in self.model.pieces])
        self.plain = not (self.model.charsmap or self.model.remove_extra)
        self.bytes = [bytes([int(p[3:5], 16)]) if kind == BYTE else p.replace(MARKER, " ").encode() if kind in (NORMAL, USER_DEFINED)
                      else None for p, _, kind in self.model.pieces]

    def normalise(self, text: str) -> str:
        if not self.plain:
            return self.whole.normalizer.normalize_str(text)
        return (" " + text if self.model.dummy_prefix and text else text).replace(" ", MARKER)

    def learn(self, words: list[str], known: dict[str, bytes]) -> None:
        """Adds the ids of ``words``, as little-endian 32-bit numbers."""
        simple = [w for w in words if w[0] == MARKER and not w.startswith(MARKER, 1)]
        runs = [simple[i:i + 2048] for i in range(0, len(simple), 2048)]
        for few in (runs[i:i + 8] for i in range(0, len(runs), 8)):  # the library's answers take many times their ids
            for run, encoding in zip(few, self.joined.encode_batch_fast(["".join(r) for r in few], add_special_tokens=False)):
                ids = np.array(encoding.ids, dtype="<i4")
                starts = (4 * np.append(np.flatnonzero(self.opens[ids]), len(ids))).tolist()
                data = ids.tobytes()
                known.update(zip(run, (data[a:b] for a, b in zip(starts, starts[1:]))))
        other = [w for w in words if not (w[0] == MARKER and not w.startswith(MARKER, 1))]
        for word, encoding in zip(other, self.words.encode_batch_fast(other, add_special_tokens=False)):
            known[word] = np.array(encoding.ids, dtype="<i4").tobytes()

    def encode(self, texts: Sequence[str], chars: int = 1 << 20) -> Iterator[np.ndarray]:
        """Ids of each text, in order; the library's threads share one block of
        about ``chars`` characters."""
        for start, end in blocks(texts, chars):
            if self.cut is None:
                for e in self.whole.encode_batch_fast(texts[start:end], add_special_tokens=False):
                    yield np.array(e.ids, dtype="<i4")
                continue
            parts = [self.cut(self.normalise(t)) for t in texts[start:end]]
            distinct = set(chain.from_iterable(parts))
            if len(self.known) + len(distinct) > self.memory:
                self.known = {}
            known = self.known if len(distinct) <= self.memory else {}
            self.learn([w for w in distinct if w not in known], known)
            for words in parts:
                yield np.frombuffer(b"".join(map(known.__getitem__, words)), dtype="<i4")

    def decode(self, ids: Sequence[Sequence[int]]) -> list[str]:
        """Joins the bytes of the pieces; ids that are special, or whose bytes
        are no text, go through the library's decoder."""
        out: list[str | None] = []
        for own in ids:
            try:
                text = b"".join(map(self.bytes.__getitem__, own.tolist() if isinstance(own, np.ndarray) else own)).decode()
                out.append(text[1:] if self.model.dummy_prefix and text.startswith(" ") else text)
            except (TypeError, UnicodeDecodeError):
                out.append(None)
        odd = [i for i, t in enumerate(out) if t is None]
        for i, t in zip(odd, self.whole.decode_batch([list(map(int, ids[i])) for i in odd], skip_special_tokens=True) if odd else []):
            out[i] = t
        return out


def blocks(texts: Sequence[str], chars: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about ``chars`` characters each; one text is never cut."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= chars:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def parity(data: bytes, texts: Sequence[str]) -> list[int]:
    """Positions of the texts whose ids or decoded text differ from what the
    sentencepiece library gives; empty where the rebuilt tokenizer is right."""
    import sentencepiece

    own, reference = Codec(data), sentencepiece.SentencePieceProcessor(model_proto=data)
    ids = list(own.encode(texts))
    back = own.decode(ids)
    return [i for i, t in enumerate(texts) if ids[i].tolist() != reference.encode(t) or back[i] != reference.decode(ids[i].tolist())]


def _worker(data: bytes, threads: int) -> Codec:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "true")
    os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
    return Codec(data)


def encode(docs: DataFrame, text: str = "text", ids: str = "token_ids", model: bytes | None = None, threads: int = 2) -> DataFrame:
    """``docs`` with the ids of each text as an array column.

    NULL text has NULL ids, an empty text no ids.  A column already called
    ``ids`` is replaced, whatever others are called.  Narrow plan; ``threads`` is
    the number of cores that a task may use.  A task holds the words and ids of
    about ``BLOCK`` bytes of text at once, or of one text if that is longer.
    """
    data = default_model() if model is None else model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _worker(data, threads)
        for batch in batches:
            for start, end, texts in text_blocks(batch, 1, BLOCK):
                own = list(codec.encode([t or "" for t in texts], BLOCK))
                edges = np.zeros(len(own) + 1, dtype=np.int32)
                np.cumsum([len(x) for x in own], out=edges[1:])
                lists = pa.ListArray.from_arrays(edges, np.concatenate(own), mask=pa.array([t is None for t in texts]))
                yield pa.RecordBatch.from_arrays([*batch.slice(start, end - start).columns, lists], names=["kept", "text", "ids"])

    kept = [c for c in docs.columns if c != ids]
    rest = [c for c in kept if c != text]
    packed = docs.select(F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)], F.lit(0).alias("none")).alias("kept"), F.col(f"`{text}`").alias("text"))
    done = packed.mapInArrow(run, f"kept {packed.schema['kept'].dataType.simpleString()}, text string, ids array<int>")
    return done.select(*[(F.col("text") if c == text else F.col(f"kept.c{rest.index(c)}")).alias(c) for c in kept], F.col("ids").alias(ids))


def decode(docs: DataFrame, ids: str = "token_ids", text: str = "text", model: bytes | None = None, threads: int = 2) -> DataFrame:
    """``docs`` with the text of each array of ids; NULL for NULL."""
    data = default_model() if model is None else model

    @F.pandas_udf(T.StringType())
    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = _worker(data, threads)
        for batch in batches:
            here = batch.notna().to_numpy()
            got = iter(codec.decode(batch[here].tolist()))
            yield pd.Series([next(got) if h else None for h in here], dtype=object)

    return docs.withColumn(text, decoded(F.col(f"`{ids}`")))


DIGEST = T.StructType([
    T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("round_trip", T.BooleanType())])


def digests(docs: DataFrame, text: str = "text", model: bytes | None = None, threads: int = 2) -> DataFrame:
    """Encodes and decodes each text and keeps only figures of it.

    Adds ``n_tokens``, ``ids_sha256`` (of the ids as little-endian 32-bit
    numbers) and ``round_trip``: whether the ids decode to the text again.  All
    three are NULL for a NULL text.
    """
    data = default_model() if model is None else model

    @F.pandas_udf(DIGEST)
    def figures(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codec = _worker(data, threads)
        for batch in batches:
            rows = []
            for start, end in blocks(batch.fillna("").tolist(), 1 << 20):
                part = batch.iloc[start:end]
                texts = [t for t in part if t is not None]
                ids = list(codec.encode(texts))
                got = iter(zip(texts, ids, codec.decode(ids)))
                for t in part:
                    if t is None:
                        rows.append((None, None, None))
                    else:
                        t, own, back = next(got)
                        rows.append((len(own), hashlib.sha256(own.tobytes()).hexdigest(), back == t))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "round_trip"])

    return beside(docs, figures(F.col(f"`{text}`")), DIGEST.fieldNames())
