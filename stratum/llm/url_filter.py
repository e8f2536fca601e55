"""URL rules in a sorted digest array.

A rule is a host and a path prefix. The array holds the rules' 64-bit xxhash
keys in ascending order beside their full strings; executors memory-map it
and probe whole batches with one vectorised binary search. A probe that meets
an equal key is confirmed against the stored string, so a hash collision can
never judge a URL.

Defined cases: a null URL, or one without ``://``, has an empty host and path
and meets no rule; an empty path meets only rules with an empty path. Of the
rules that fit, the longest wins; of equally long ones the one with the
longer host, then ``block``. Repeated rows are judged one by one; other
columns of the input are ignored.
"""

from __future__ import annotations

import mmap
import os
import re
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ASCII_LOWER, emit

#: A list is sent to the executors only up to this many bytes of rules;
#: a longer one is joined on the same keys instead (``judge_urls``).
MAX_LIST_BYTES = 64 << 20
_PARTS = re.compile(r"://([^/?#]*)([^?#]*)", re.S)
_RESULT = pa.schema([("page_id", pa.int64()), ("host", pa.string()), ("path", pa.string()),
                     ("rule", pa.string()), ("verdict", pa.string())])


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path) of a URL as the rules see it."""
    at = _PARTS.search(url) if url else None
    return (at[1].translate(ASCII_LOWER), at[2]) if at else ("", "")


def digest(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"))


class DigestArray:
    """Immutable array of rules, laid out for memory mapping: the number of
    rules, their keys in ascending order, string offsets, then the strings
    (host, NUL, path, NUL, verdict)."""

    def __init__(self, view) -> None:
        (n,) = struct.unpack_from("<q", view, 0)
        self.keys = np.frombuffer(view, np.uint64, n, 8)
        self._at = np.frombuffer(view, np.int64, n + 1, 8 + 8 * n)
        self._view, self._base = view, 8 + 8 * n + 8 * (n + 1)
        rules = [self.rule(i) for i in range(n)]
        self.longest_host = max((len(h) for h, _, _ in rules), default=-1)
        self.path_lengths = sorted({len(p) for _, p, _ in rules})

    @staticmethod
    def pack(rules: Iterable[tuple[str, str, str]]) -> bytes:
        """Bytes of the array; of rules for one host and path ``block`` wins."""
        chosen: dict[tuple[str, str], str] = {}
        for host, path, verdict in rules:
            if verdict not in ("allow", "block"):
                raise ValueError(f"verdict must be allow or block: {verdict!r}")
            chosen[host, path] = max(chosen.get((host, path), "allow"), verdict)
        rows = sorted((digest(h + p), "\0".join((h, p, v)).encode()) for (h, p), v in chosen.items())
        offsets = np.cumsum([0, *(len(s) for _, s in rows)], dtype=np.int64)
        return struct.pack("<q", len(rows)) + np.array([k for k, _ in rows], np.uint64).tobytes() \
            + offsets.tobytes() + b"".join(s for _, s in rows)

    @classmethod
    def mapped(cls, packed: bytes) -> DigestArray:
        """Map the bytes read-only from an anonymous memory file (no folder)."""
        handle = os.memfd_create("url-rules")
        try:
            os.truncate(handle, len(packed))
            with mmap.mmap(handle, len(packed)) as fill:
                fill[:] = packed
            return cls(mmap.mmap(handle, len(packed), access=mmap.ACCESS_READ))
        finally:
            os.close(handle)

    def rule(self, i: int) -> tuple[str, str, str]:
        host, path, verdict = bytes(
            self._view[self._base + self._at[i]:self._base + self._at[i + 1]]).decode().split("\0")
        return host, path, verdict

    def candidates(self, host: str, path: str) -> Iterator[tuple[str, str]]:
        """Every (host, path) that a fitting rule could have."""
        at = 0
        while True:
            if len(host) - at <= self.longest_host:
                for n in self.path_lengths:
                    if n > len(path):
                        break
                    yield host[at:], path[:n]
            at = host.find(".", at) + 1
            if not at:
                return

    def probe(self, wanted: list[tuple[str, str]]) -> list[str | None]:
        """The verdict stored for each (host, path), or None."""
        found: list[str | None] = [None] * len(wanted)
        if not wanted or not len(self.keys):
            return found
        keys = np.fromiter((digest(h + p) for h, p in wanted), np.uint64, len(wanted))
        at = np.searchsorted(self.keys, keys)
        open_ = np.arange(len(wanted))
        while len(open_):  # one step for almost all; more only along equal keys
            open_ = open_[at[open_] < len(self.keys)]
            open_ = open_[self.keys[at[open_]] == keys[open_]]
            missed = []
            for i in open_:
                host, path, verdict = self.rule(int(at[i]))
                if (host, path) == wanted[i]:
                    found[i] = verdict
                else:
                    missed.append(i)
            open_ = np.array(missed, dtype=np.int64)
            at[open_] += 1
        return found


def _best(fits: Iterable[tuple[str, str, str]]) -> tuple[str, str, str] | None:
    return max(fits, key=lambda r: (len(r[0]) + len(r[1]), len(r[0]), r[2] == "block"), default=None)


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow",
               max_list_bytes: int = MAX_LIST_BYTES) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of ``pages``.

    ``rules`` has host, path and verdict. A list of at most
    ``max_list_bytes`` is packed and broadcast; a longer one stays a table
    and is joined on the same 64-bit keys, confirmed on the full strings."""
    rules = rules.select(*(F.col(c).cast("string").alias(c) for c in ("host", "path", "verdict"))) \
        .na.drop().distinct()
    size = rules.agg(F.sum(F.octet_length("host") + F.octet_length("path") + F.lit(32))).first()[0] or 0
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    if size > max_list_bytes:
        return _judge_by_join(pages, rules, default)
    packed = pages.sparkSession.sparkContext.broadcast(DigestArray.pack(map(tuple, rules.collect())))

    def run(batches):
        array = DigestArray.mapped(packed.value)
        for batch in batches:
            parts = [split_url(u) for u in batch.column("url").to_pylist()]
            wanted, owner = [], []
            for i, (host, path) in enumerate(parts):
                for candidate in array.candidates(host, path):
                    wanted.append(candidate)
                    owner.append(i)
            fits: dict[int, list] = {}
            for i, candidate, verdict in zip(owner, wanted, array.probe(wanted)):
                if verdict:
                    fits.setdefault(i, []).append((*candidate, verdict))
            rows = []
            for i, (page_id, (host, path)) in enumerate(zip(batch.column("page_id").to_pylist(), parts)):
                best = _best(fits.get(i, ()))
                rows.append((page_id, host, path, best[0] + best[1] if best else None, best[2] if best else default))
            yield from emit(iter(rows), _RESULT)

    return pages.mapInArrow(run, "page_id long, host string, path string, rule string, verdict string")


def _judge_by_join(pages: DataFrame, rules: DataFrame, default: str) -> DataFrame:
    """For lists too long to broadcast: the host suffixes that have rules bring
    their path lengths, and one row per candidate is joined on the key
    (Spark's xxhash64 of the string) and confirmed on the strings."""
    wrong = F.raise_error(F.concat(F.lit("verdict must be allow or block: "), "verdict")).cast("string")
    rules = rules.withColumn("verdict", F.when(F.col("verdict").isin("allow", "block"), F.col("verdict")).otherwise(wrong))
    lengths = rules.groupBy(F.col("host").alias("h")).agg(F.collect_set(F.char_length("path")).alias("lengths"))
    host = F.translate(F.regexp_extract("url", "^(?s).*?://([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                       "abcdefghijklmnopqrstuvwxyz")
    parts = pages.select(
        F.monotonically_increasing_id().alias("row"), "page_id", F.coalesce(host, F.lit("")).alias("host"),
        F.coalesce(F.regexp_extract("url", "^(?s).*?://[^/?#]*([^?#]*)", 1), F.lit("")).alias("path"))
    labels = F.split("host", r"\.", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), "."))
    prefixes = F.transform(F.filter("lengths", lambda n: n <= F.char_length("path")),
                           lambda n: F.substring("path", F.lit(1), n))
    wide = parts.select("row", F.explode(suffixes).alias("h"), "path").join(lengths, "h") \
        .select("row", "h", F.explode(prefixes).alias("p")).withColumn("key", F.xxhash64(F.concat("h", "p")))
    keyed = rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict")) \
        .select(F.xxhash64(F.concat("host", "path")).alias("key"), F.col("host").alias("rh"),
                F.col("path").alias("rp"), "verdict")
    best = wide.join(keyed, "key").filter("h = rh and p = rp").groupBy("row").agg(F.max(F.struct(
        (F.char_length("rh") + F.char_length("rp")).alias("n"), F.char_length("rh").alias("m"), "verdict",
        F.concat("rh", "rp").alias("rule"))).alias("best"))
    return parts.join(best, "row", "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
