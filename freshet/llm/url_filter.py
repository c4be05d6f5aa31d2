"""URL filter over a sorted digest array.

The rules become one file: the 64-bit xxhash of every rule in ascending order,
beside them offsets into a blob with the full rule strings.  Spark ships the
file to each executor once, every worker maps it into memory (the pages are
shared between the workers of a host and never read as a whole), probes it with
a vectorised binary search and compares the stored string on each hit, so that
two strings with one digest cannot be confused.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .common import beside, lower_ascii, lower_ascii_column

MAGIC = b"URLDIG1\0"
ALLOW, BLOCK = "allow", "block"
RESULT = T.StructType([T.StructField("rule", T.StringType()), T.StructField("verdict", T.StringType())])


def split_rule(rule: str) -> tuple[str, str]:
    """``example.net/en/`` into host and path; the path begins at the first slash."""
    host, slash, path = rule.partition("/")
    return lower_ascii(host), slash + path


def encode_index(rules: Sequence[tuple[str, str]]) -> bytes:
    """The index file of ``(verdict, rule)`` pairs.

    Layout: magic, number of rules, number of path lengths, the distinct path
    lengths, digests (ascending), offsets, verdicts, blob.  A rule given twice
    with one verdict counts once; with two verdicts it is refused.
    """
    by_rule: dict[str, str] = {}
    for verdict, rule in rules:
        if verdict not in (ALLOW, BLOCK):
            raise ValueError(f"a rule allows or blocks: {verdict!r}")
        host, path = split_rule(rule)
        if not host:
            raise ValueError(f"a rule needs a host: {rule!r}")
        if by_rule.setdefault(host + path, verdict) != verdict:
            raise ValueError(f"rule {rule!r} both allows and blocks")
    keys = [(xxhash.xxh64_intdigest(r.encode()), r.encode(), v) for r, v in by_rule.items()]
    keys.sort()
    lengths = sorted({len(split_rule(r)[1]) for r in by_rule})
    offsets = np.cumsum([0] + [len(r) for _, r, _ in keys], dtype="<u8")
    return b"".join([
        MAGIC, struct.pack("<QQ", len(keys), len(lengths)), np.array(lengths, dtype="<u8").tobytes(),
        np.array([d for d, _, _ in keys], dtype="<u8").tobytes(), offsets.tobytes(),
        np.array([v == ALLOW for _, _, v in keys], dtype="u1").tobytes(), b"".join(r for _, r, _ in keys)])


class DigestArray:
    """A mapped index file."""

    def __init__(self, path: str):
        data = np.memmap(path, dtype="u1", mode="r")
        if data[:8].tobytes() != MAGIC:
            raise ValueError(f"{path} is no digest array")
        count, lengths = (int(x) for x in data[8:24].view("<u8"))
        at = 24
        self.path_lengths = data[at:at + 8 * lengths].view("<u8").astype(int)
        at += 8 * lengths
        self.digests = data[at:at + 8 * count].view("<u8")
        at += 8 * count
        self.offsets = data[at:at + 8 * (count + 1)].view("<u8")
        at += 8 * (count + 1)
        self.allows = data[at:at + count]
        self.blob = data[at + count:]

    def find(self, keys: list[bytes]) -> np.ndarray:
        """Position of each key in the array, -1 where it isn't stored."""
        found = np.full(len(keys), -1, dtype="i8")
        if not len(self.digests) or not keys:
            return found
        wanted = np.fromiter((xxhash.xxh64_intdigest(k) for k in keys), dtype="u8", count=len(keys))
        at = np.searchsorted(self.digests, wanted)
        inside = np.flatnonzero(at < len(self.digests))
        for i in inside[self.digests[at[inside]] == wanted[inside]]:
            k = int(at[i])
            while k < len(self.digests) and self.digests[k] == wanted[i]:  # equal digests stand together
                if self.stored(k) == keys[i]:
                    found[i] = k
                    break
                k += 1
        return found

    def stored(self, k: int) -> bytes:
        return self.blob[int(self.offsets[k]):int(self.offsets[k + 1])].tobytes()

    def judge(self, hosts: Sequence[str], paths: Sequence[str], default: str) -> list[tuple[str | None, str]]:
        """Rule and verdict per url: the longest stored rule whose host is the
        url's host or a parent of it and whose path starts the url's path; among
        rules of one length the one with the longer host."""
        keys: dict[bytes, int] = {}
        options: list[list[tuple[int, int, int]]] = []
        for host, path in zip(hosts, paths):
            own = []
            at = 0 if host else -1
            while at >= 0:
                suffix = host[at:]
                for n in self.path_lengths:
                    if n <= len(path) and suffix:
                        key = (suffix + path[:n]).encode()
                        own.append((len(suffix) + int(n), len(suffix), keys.setdefault(key, len(keys))))
                dot = host.find(".", at)
                at = dot + 1 if dot >= 0 else -1
            options.append(sorted(own, reverse=True))
        found = self.find(list(keys))
        out: list[tuple[str | None, str]] = []
        for own in options:
            hit = next((int(found[k]) for _, _, k in own if found[k] >= 0), -1)
            out.append((None, default) if hit < 0 else (self.stored(hit).decode(), ALLOW if self.allows[hit] else BLOCK))
        return out


def ship_index(spark: SparkSession, rules: Sequence[tuple[str, str]], max_bytes: int = 1 << 30) -> str:
    """Writes the index into the shared folder and lets every executor fetch
    it, also those that join later; returns its file name.
     ``max_bytes`` bounds the file,
    which lies on each executor's disk; a larger list is refused and has to be
    given in several calls, one per block of rules, whose longest match wins.
    """
    data = encode_index(rules)
    if len(data) > max_bytes:
        raise ValueError(f"the rules take {len(data)} bytes, over max_bytes={max_bytes}")
    path = f"{scratch_path(spark, 'digests')}.bin"
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target)
    out.write(bytearray(data))
    out.close()
    spark.sparkContext.addFile(path)
    return path.rsplit("/", 1)[1]


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str]], url: str = "url", default: str = ALLOW) -> DataFrame:
    """``pages`` with the columns ``host``, ``path``, ``rule`` and ``verdict``.

    A NULL url, or one without ``://``, has an empty host and path, fits no rule
    and takes the ``default`` verdict.  The host keeps a port or user part as
    written.  Columns of ``pages`` with one of the four names are replaced.  The
    plan is narrow: no shuffle, one row out per row in.
    """
    name = ship_index(pages.sparkSession, rules)

    @F.pandas_udf(RESULT)
    def judged(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        index = DigestArray(SparkFiles.get(name))
        for hosts, paths in batches:
            yield pd.DataFrame(index.judge(hosts.tolist(), paths.tolist(), default), columns=["rule", "verdict"])

    given = F.col(f"`{url}`")
    at = F.coalesce(F.instr(given, "://"), F.lit(0))
    rest = F.when(at > 0, given.substr(at + 3, F.length(given))).otherwise(F.lit(""))
    split = beside(pages, F.struct(
        lower_ascii_column(F.regexp_extract(rest, r"^[^/?#]*", 0)).alias("host"), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1).alias("path")), ["host", "path"])
    return beside(split, judged("host", "path"), ["rule", "verdict"])
