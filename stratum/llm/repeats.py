"""Removal of repeated byte strings with run-length indexes.

Every ``LENGTH``-byte string of a document that also starts in a document
with a smaller id is removed. Texts are cut by content so that equal strings
meet: of the k-mers of each string, the one with the smallest hash is the
string's anchor; the strings of one anchor are neighbours and form one
context of at most 2 x LENGTH - K bytes. Contexts whose anchor occurs in one
document only cannot repeat and go at once. Of the others each distinct one
goes once, with the smallest id it occurs in, to a shard, dealt by anchor. A
shard's strings that share longer k-mers form a run-compressed
Burrows-Wheeler transform, sorted by LENGTH bytes and then by text order, with
samples at the heads of equal strings. They are streamed through it right to
left, keeping the interval of the last LENGTH bytes (the matching statistics
capped at that length); the sample at the interval's head is the smallest id
that holds the string. The results are joined back to every place of the
context.

No key gathers unbounded rows: of the places of one anchor within a buffer
only the first is dealt by anchor where several documents hold it, the others
(known to repeat) are salted; an anchor with very many contexts is cut into
single strings, whose smallest ids are minima by their own bytes, combined
before they are dealt (all contexts of a string have its anchor); the joins
back split skewed keys.

Defined cases: a null text is empty; a document with a null id is never
smaller than another and keeps all its bytes; repeated rows with one id
are one document (a string is removed only if a smaller id has it); other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, emit, keep_on_shared_storage

LENGTH = 50
#: Bytes of an anchor, and of the longer k-mers that a shard looks for.
K, LONG_K = 16, 32
#: Bytes of text whose anchors are found in one go.
BUFFER = 1 << 20
#: Bytes of texts that are hashed at once, so that the arrays stay in a core's cache.
HASHED = 1 << 15
#: Bytes of contexts in one index.
SHARD_BYTES = 1 << 20
#: Distinct contexts of an anchor from which on it is cut into single strings.
HOT_CONTEXTS = 20_000
SALTS = 1 << 16
_GROUP = 0x1E3779B97F4B  # odd; times any salt it is a long

_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    y = x >> np.uint64(31)
    y ^= x
    y *= np.uint64(0xD6E8FEB86659FD93)
    y ^= y >> np.uint64(32)
    return y


_BYTE = _mixed(np.arange(1, 257, dtype=np.uint64))


@lru_cache(4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2 ** 64, and their inverses."""
    odd = int(_MIX)
    powers = [np.full(n, np.uint64(x)) for x in (odd, pow(odd, -1, 1 << 64))]
    for p in powers:
        p[0] = 1
        np.cumprod(p, out=p)
    return powers[0], powers[1]


def _kmer_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of the ``k`` bytes at each place (``k`` a power of two)."""
    h, n = _BYTE[data], 1
    factor = _MIX
    with np.errstate(over="ignore"):
        while n < k:
            left = h[:-n] * factor
            left += h[n:]
            h = np.right_shift(left, np.uint64(29), out=h[:len(left)])
            h ^= left
            factor = factor * _MIX
            n *= 2
    return _mixed(h)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    n = 1
    while 2 * n <= width:
        x = np.minimum(x[:-n], x[n:])
        n *= 2
    rest = width - n
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def contexts(data: np.ndarray, owner: np.ndarray, length: int, k: int):
    """Contexts of a buffer: (start, strings, anchor hash, context hash), where
    a context covers the ``strings`` strings that start from ``start`` on.
    ``owner`` names the text of each byte; no string crosses texts."""
    if len(data) < length:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty.view(np.uint64), empty.view(np.uint64)
    hashes = _kmer_hashes(data, k)
    # Hash above, place below: the minimum is the leftmost smallest k-mer.
    bits = len(data).bit_length()
    low = np.uint64((1 << bits) - 1)
    ranked = hashes & ~low
    ranked |= np.arange(len(hashes), dtype=np.uint64)
    at = _sliding_min(ranked, length - k + 1)
    at &= low
    at = at.view(np.int64)
    whole = owner[:len(at)] == owner[length - 1:]
    starts = np.flatnonzero(whole)
    at = at[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(starts)))
    begin, anchor = starts[first], hashes[at[first]]
    # Polynomial hash of the context's bytes and of where the anchor lies in it.
    powers, inverses = _powers(max(1 << bits, 2 * HASHED))  # few sizes, each made once
    with np.errstate(over="ignore"):
        total = np.zeros(len(data) + 1, np.uint64)
        np.multiply(_BYTE[data], powers[:len(data)], out=total[1:])
        np.cumsum(total, out=total)
        size = count + length - 1
        body = (total[begin + size] - total[begin]) * inverses[begin]
        own = _mixed(body + _mixed(((at[first] - begin) << 8 | size).astype(np.uint64)))
    return begin, count, anchor, own


def _contexts_of(texts: list[bytes], length: int, k: int):
    """``contexts`` of some texts, hashed in blocks of whole texts, and the text
    of each: (text, start in it, strings, anchor hash, context hash)."""
    sizes = np.array([len(t) for t in texts])
    block = (np.cumsum(sizes) - sizes) // HASHED
    edges = np.append(np.flatnonzero(np.diff(block, prepend=-1)), len(texts))
    parts = []
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        data, own = np.frombuffer(b"".join(texts[a:b]), np.uint8), np.repeat(np.arange(b - a), sizes[a:b])
        begin, count, anchor, context = contexts(data, own, length, k)
        who = own[begin]
        parts.append((who + a, begin - (np.cumsum(sizes[a:b]) - sizes[a:b])[who], count, anchor, context))
    return tuple(np.concatenate(c) for c in zip(*parts))


def _bytes_of(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.large_binary()).to_pylist()


_PLACES = pa.schema([("anchor", pa.int64()), ("context", pa.int64()), ("doc_id", pa.int64()), ("place", pa.int64()),
                     ("salt", pa.int32()), ("many", pa.bool_())])
_PLACES_DDL = "anchor long, context long, doc_id long, place long, salt int, many boolean"
#: A place is part << 37 | start << 6 | strings; the part (26 bits of the
#: text's CRC) tells texts with one id apart.
_START, _STRINGS = (1 << 31) - 1, 63


def _part(text: str) -> Column:
    return F.crc32(text).bitwiseAND(F.lit((1 << 26) - 1))


def _places(docs: DataFrame, length: int, k: int) -> DataFrame:
    """The contexts of all texts. Within a buffer, the first place of a
    context (at its smallest id) has salt 0 and tells whether other ids of the
    buffer have the context too (``many``); the other places are salted. Where
    several ids of the buffer hold an anchor, only one place of it keeps salt 0
    (and is ``many``); the first places of its other contexts have salts below 0."""
    if length - k + 1 > _STRINGS:
        raise ValueError("a context would cover too many strings")

    def run(batches):
        ids: list[int] = []
        parts: list[int] = []
        shifts: list[int] = []
        texts: list[bytes] = []
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            if not texts:
                return
            who, start, count, anchor, own = _contexts_of(texts, length, k)
            place = np.array(parts)[who] << 37 | (start + np.array(shifts)[who]) << 6 | count
            doc = np.array(ids)[who]
            if np.all((doc[1:] > doc[:-1]) | (doc[1:] == doc[:-1]) & (place[1:] >= place[:-1])):
                order = np.argsort(own, kind="stable")  # in order but for the context
            else:
                order = np.lexsort((place, doc, own))
            anchor, own, doc, place = (c[order] for c in (anchor.view(np.int64), own.view(np.int64), doc, place))
            head = np.ones(len(order), bool)
            head[1:] = (own[1:] != own[:-1]) | (anchor[1:] != anchor[:-1])
            first = np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))
            many = np.zeros(len(order), bool)
            many[first[doc != doc[first]]] = True
            salt = np.where(head, 0, 1 + (doc + place) % SALTS).astype(np.int32)
            alone = ~head & (doc == doc[first]) & ~many[first]  # again in one document only
            salt[alone] = 0
            zero = np.flatnonzero(salt == 0)
            zero = zero[np.lexsort((doc[zero], anchor[zero]))]
            head = np.ones(len(zero), bool)
            head[1:] = anchor[zero[1:]] != anchor[zero[:-1]]
            group, begin = np.cumsum(head) - 1, np.flatnonzero(head)
            low, high = doc[zero[begin]], doc[zero[np.append(begin[1:], len(zero)) - 1]] if len(zero) else doc[:0]
            several = low < high
            many[zero[begin[several]]] = True
            rest = zero[several[group] & ~head]
            salt[rest] = -1 - (doc[rest] + place[rest]) % SALTS
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in (anchor, own, doc, place, salt, many)], schema=_PLACES)
            for x in (ids, parts, shifts, texts):
                x.clear()

        def whole_texts() -> Iterator[tuple[int, bytes]]:
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    cut = batch.slice(at, 256)
                    yield from zip(cut.column("doc_id").to_pylist(), _bytes_of(cut.column("text")))

        for doc_id, whole in whole_texts():
            part = zlib.crc32(whole) & ((1 << 26) - 1)
            for shift in range(0, max(1, len(whole) - length + 1), BUFFER):  # pieces share length - 1 bytes
                piece = whole[shift:shift + BUFFER + length - 1]
                if len(piece) < length:
                    continue
                ids.append(doc_id)
                parts.append(part)
                shifts.append(shift)
                texts.append(piece)
                held += len(piece)
                if held >= BUFFER:
                    yield from flush()
                    held = 0
        yield from flush()

    return docs.filter("doc_id is not null and text is not null").select("doc_id", "text") \
        .mapInArrow(run, _PLACES_DDL)


class RunLengthIndex:
    """Run-compressed Burrows-Wheeler transform of some strings, sorted by
    ``length`` bytes and then by text order.

    ``ids`` ascend with the strings, so the head of the rows that start with
    the same ``length`` bytes is the smallest id that holds them; heads are
    the sampled rows."""

    def __init__(self, strings: list[bytes], ids: np.ndarray, length: int) -> None:
        if length < 33 or length > 64:
            raise ValueError("length must be from 33 to 64")
        text = np.frombuffer(b"\xff".join([*strings, b""]), np.uint8)  # 0xff is never part of UTF-8
        n = len(text)
        rank = text.astype(np.int64)
        packed = np.append(rank, np.zeros(4, np.int64))
        for width, shift in ((1, 8), (2, 16)):  # four bytes as one number
            packed = (packed[:-width] << shift) | packed[width:]
        rank = self._dense(packed[:n])
        for step in (4, 8, 16):
            rank = self._dense(self._pair(rank, step))
        key = self._pair(rank, length - 32)
        order = self._order(key)
        key = key[order]
        new = np.ones(n, bool)
        new[1:] = key[1:] != key[:-1]
        self.heads = np.append(np.flatnonzero(new), n)  # first rows of equal strings, and the end
        self._class = np.cumsum(new) - 1
        owner = np.repeat(np.arange(len(strings)), [len(s) + 1 for s in strings])
        self.samples = ids[owner[order[self.heads[:-1]]]]
        last = text[order - 1]
        run = np.ones(n, bool)
        run[1:] = last[1:] != last[:-1]
        starts = np.flatnonzero(run)
        chars = last[starts].astype(np.int64)
        sizes = np.diff(np.append(starts, n))
        by_char = np.lexsort((starts, chars))
        self.rows, self.runs = n, len(starts)
        self._sizes = sizes[by_char]
        before = np.cumsum(self._sizes) - self._sizes  # rows of smaller characters and earlier runs
        self._before = before
        self._first = np.searchsorted(chars[by_char], np.arange(257))
        self._keys = chars[by_char] * (n + 1) + starts[by_char]
        self._starts = starts[by_char]
        totals = np.bincount(last, minlength=256)
        self._less = np.cumsum(totals) - totals

    @staticmethod
    def _order(key: np.ndarray) -> np.ndarray:
        """Stable order of keys that are not negative: numbers made of key and
        place are sorted where they fit, which is faster than places by key."""
        bits = len(key).bit_length()
        if int(key.max()) >> (63 - bits):
            return np.argsort(key, kind="stable")
        return np.sort(key << bits | np.arange(len(key))) & ((1 << bits) - 1)

    @classmethod
    def _dense(cls, key: np.ndarray) -> np.ndarray:
        order = cls._order(key)
        key = key[order]
        new = np.zeros(len(key), np.int64)
        new[1:] = key[1:] != key[:-1]
        rank = np.empty(len(key), np.int64)
        rank[order] = np.cumsum(new) + 1
        return rank

    @staticmethod
    def _pair(rank: np.ndarray, step: int) -> np.ndarray:
        right = np.zeros(len(rank), np.int64)
        right[:-step] = rank[step:] if step < len(rank) else right[:-step]
        return rank * (int(rank.max()) + 1) + right

    def _step(self, char: np.ndarray, row: np.ndarray) -> np.ndarray:
        """The row that ``row`` comes to when ``char`` is put in front."""
        run = np.searchsorted(self._keys, char * (self.rows + 1) + row) - 1
        some = run >= self._first[char]
        run = np.maximum(run, 0)
        seen = self._before[run] + np.minimum(row - self._starts[run], self._sizes[run])
        return np.where(some, seen, self._less[char])

    def smallest_ids(self, strings: list[bytes], length: int) -> np.ndarray:
        """For every place of the joined strings (all of them indexed) the
        smallest id that holds the ``length`` bytes there; streamed right to
        left. Places whose string is shorter are 0. The strings are kept in
        the order of their rows, so that each step looks its runs up in order."""
        sizes = np.array([len(s) for s in strings])
        data = np.frombuffer(b"".join(strings), np.uint8)
        ends = np.cumsum(sizes)
        out = np.zeros(len(data), np.int64)
        alive = np.arange(len(strings))
        low, high = np.zeros(len(strings), np.int64), np.full(len(strings), self.rows)
        for step in range(1, int(sizes.max()) + 1):
            goes_on = np.flatnonzero(sizes[alive] >= step)
            by_char = goes_on[np.argsort(data[ends[alive[goes_on]] - step], kind="stable")]
            alive = alive[by_char]
            at = ends[alive] - step
            char = data[at].astype(np.int64)
            low = self._step(char, low[by_char])
            if step >= length:  # the interval of the last ``length`` bytes: widen to its equals
                which = self._class[low]
                out[at] = self.samples[which]
                low, high = self.heads[which], self.heads[which + 1]
            else:
                high = self._step(char, high[by_char])
        return out


def _ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (counts[0] numbers), starts[1], ..."""
    total = int(counts.sum())
    return np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(total)


def smallest_in_shard(data: np.ndarray, sizes: np.ndarray, first: np.ndarray, length: int) -> np.ndarray:
    """For each string of ``length`` bytes of the joined contexts (``sizes``
    bytes each, occurring first in ``first``) the smallest id that holds it."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    strings = sizes - length + 1
    out = np.repeat(first, strings)
    begin, count, anchor, own = contexts(data, owner, length, LONG_K)
    who = owner[begin]
    # Only strings that share a longer k-mer with another context can differ from ``first``.
    _, inverse, times = np.unique(anchor, return_inverse=True, return_counts=True)
    some = np.flatnonzero(times[inverse] > 1)
    if not len(some):
        return out
    begin, count, own, who = begin[some], count[some], own[some], who[some]
    _, one, inverse = np.unique(own, return_index=True, return_inverse=True)
    ids = np.full(len(one), np.iinfo(np.int64).max)
    np.minimum.at(ids, inverse, first[who])
    order = np.argsort(ids, kind="stable")
    texts = [data[b:b + n].tobytes() for b, n in zip(begin[one[order]], count[one[order]] + length - 1)]
    found = RunLengthIndex(texts, ids[order], length).smallest_ids(texts, length)
    at = np.empty(len(one), np.int64)  # where each distinct part starts in the joined parts
    lengths = np.array([len(t) for t in texts])
    at[order] = np.cumsum(lengths) - lengths
    shift = (np.cumsum(strings) - strings)[who] + begin - (np.cumsum(sizes) - sizes)[who]
    out[_ragged(shift, count)] = found[_ragged(at[inverse], count)]
    return out


_CUT = pa.schema([("shard", pa.int64()), ("anchor", pa.int64()), ("context", pa.int64()), ("shift", pa.int64()),
                  ("first", pa.int64()), ("many", pa.bool_()), ("bytes", pa.binary())])
_CUT_DDL = "shard long, anchor long, context long, shift long, first long, many boolean, bytes binary"
_FOUND_DDL = "anchor long, context long, begin long, end long, smallest long"


def _shared_places(docs: DataFrame, length: int, k: int) -> DataFrame:
    """The places of contexts whose anchor occurs in more than one document."""
    # One number sorts faster than anchor and salt. Should two groups meet in it, some places more are kept.
    group = F.col("anchor").bitwiseXOR(F.col("salt").cast("long") * F.lit(_GROUP))
    by_group = Window.partitionBy(group)
    last = F.when(F.col("many"), F.lit((1 << 63) - 1)).otherwise(F.col("doc_id"))  # many: a larger id has it too
    return _places(docs, length, k).repartition(group).select(
        "*", F.min("doc_id").over(by_group).alias("low"), F.max(last).over(by_group).alias("high")) \
        .filter("salt != 0 or low < high").select("anchor", "context", "doc_id", "place", "salt", "many")


def _found_of_strings(strings: DataFrame) -> DataFrame:
    """The same as ``_indexed`` for rows that are single strings."""
    least = strings.groupBy("bytes").agg(F.min("first").alias("smallest"))
    return strings.join(least, "bytes").filter("smallest < first or many").select(
        "anchor", "context", F.col("shift").alias("begin"), (F.col("shift") + 1).alias("end"), "smallest")


def _indexed(shared: DataFrame, docs: DataFrame, length: int, shards: int, hot_contexts: int) -> DataFrame:
    """(anchor, context, begin, end, smallest): the strings begin..end-1 of the
    context occur first in the document ``smallest``; left out where the
    context's only document has them first."""

    def cut(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                yield cut_slice(batch.slice(at, 64))

    def cut_slice(batch):
        wanted = batch.column("wanted")
        counts = np.diff(wanted.offsets.to_numpy())
        anchor, context, place = (wanted.flatten().field(c).to_numpy() for c in ("anchor", "context", "place"))
        many, hot = (wanted.flatten().field(c).to_numpy(zero_copy_only=False) for c in ("many", "hot"))
        whole = [t.encode("utf-8", "surrogatepass") for t in batch.column("text").to_pylist()]
        who = np.repeat(np.arange(len(whole)), counts)
        first = batch.column("doc_id").to_numpy()[who]
        start, strings = place >> 6 & _START, place & _STRINGS
        shift, shard = np.zeros(len(who), np.int64), anchor % shards
        if hot.any():  # one row for each string
            times = np.where(hot, strings, 1)
            own = np.repeat(np.arange(len(who)), times)
            shift = _ragged(shift, times)
            anchor, context, many, hot, who, first, start, shard = (
                c[own] for c in (anchor, context, many, hot, who, first, start, shard))
            start, strings = start + shift, np.where(hot, 1, strings[own])
            shard = np.where(hot, -1, shard)
        cuts = [whole[w][a:a + n] for w, a, n in zip(who.tolist(), start.tolist(), (strings + length - 1).tolist())]
        return pa.RecordBatch.from_arrays(
            [pa.array(c) for c in (shard, anchor, context, shift, first, many)] + [pa.array(cuts, pa.binary())],
            schema=_CUT)

    def search(table: pa.Table) -> pa.Table:
        cuts = table.column("bytes").combine_chunks()
        cuts = cuts if isinstance(cuts, pa.Array) else cuts.chunk(0)
        offsets = np.frombuffer(cuts.buffers()[1], np.int32)[cuts.offset:cuts.offset + len(cuts) + 1].astype(np.int64)
        data = np.frombuffer(cuts.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
        anchor, context, shift, first = (table.column(c).to_numpy() for c in ("anchor", "context", "shift", "first"))
        many = table.column("many").to_numpy()
        sizes = np.diff(offsets)
        found = smallest_in_shard(data, sizes, first, length)
        strings = sizes - length + 1
        who = np.repeat(np.arange(len(sizes)), strings)
        head = np.ones(len(found), bool)
        head[1:] = (found[1:] != found[:-1]) | (who[1:] != who[:-1])
        begin = np.flatnonzero(head)
        end = np.append(begin[1:], len(found))
        told = (found[begin] < first[who[begin]]) | many[who[begin]]
        begin, end = begin[told], end[told]
        smallest, who = found[begin], who[begin]
        base = shift[who] - (np.cumsum(strings) - strings)[who]
        return pa.table({"anchor": anchor[who], "context": context[who], "begin": begin + base, "end": end + base,
                         "smallest": smallest})

    firsts = shared.filter("salt <= 0")
    hot = firsts.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > hot_contexts) \
        .select("anchor", F.lit(True).alias("hot"))
    distinct = firsts.groupBy("anchor", "context").agg(
        F.min(F.struct("doc_id", "place")).alias("at"),
        (F.max("many") | (F.min("doc_id") < F.max("doc_id"))).alias("many")) \
        .join(F.broadcast(hot), "anchor", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    wanted = distinct.groupBy(F.col("at.doc_id").alias("doc_id"), F.shiftright("at.place", 37).alias("part")).agg(
        F.collect_list(F.struct("anchor", "context", F.col("at.place").alias("place"), "many", "hot")).alias("wanted"))
    texts = docs.filter("doc_id is not null and text is not null").withColumn("part", _part("text"))
    wanted = keep_on_shared_storage(wanted, "wanted-contexts")
    cuts = keep_on_shared_storage(wanted.join(texts, ["doc_id", "part"]).select("doc_id", "text", "wanted")
                                  .mapInArrow(cut, _CUT_DDL), "contexts")
    discard(wanted)
    found = keep_on_shared_storage(
        cuts.filter("shard >= 0").groupBy("shard").applyInArrow(search, _FOUND_DDL)
        .union(_found_of_strings(cuts.filter("shard < 0"))), "found-contexts")
    discard(cuts)
    return found


def repeated_spans(documents: DataFrame, length: int = LENGTH, k: int = K, shard_bytes: int = SHARD_BYTES,
                   hot_contexts: int = HOT_CONTEXTS) -> DataFrame:
    """(doc_id, text, spans) for every document; ``spans`` are the byte spans
    [start, end) to remove, not merged (null if none)."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shared = keep_on_shared_storage(_shared_places(docs, length, k), "shared-places")
    places = shared.filter("salt <= 0").count()
    shards = max(1, -(-places * 2 * length // shard_bytes))
    found = _indexed(shared, docs, length, shards, hot_contexts)
    start = F.shiftright("place", 6).bitwiseAND(F.lit(_START))
    spans = shared.select("anchor", "context", "doc_id", "place").join(found, ["anchor", "context"]) \
        .filter("smallest < doc_id").groupBy("doc_id", F.shiftright("place", 37).alias("part")).agg(
            F.collect_list(F.struct((start + F.col("begin")).alias("start"),
                                    (start + F.col("end") + F.lit(length - 1)).alias("end"))).alias("spans"))
    return docs.withColumn("part", _part("text")).join(spans, ["doc_id", "part"], "left").select(
        "doc_id", "text", "spans")


def _merged(owner: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The spans of each owner, merged where they touch, by owner and start."""
    if not len(start):
        return owner, start, end
    order = np.lexsort((start, owner))
    owner, shift = owner[order], owner[order] * (int(end.max()) + 1)  # one line of places, owner after owner
    start, reach = start[order], np.maximum.accumulate(end[order] + shift)
    new = np.ones(len(start), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (start[1:] + shift[1:] > reach[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    return owner[first], start[first], reach[last] - shift[last]


def _without(whole: bytes, merged: list[tuple[int, int]]) -> bytes:
    kept, at = [], 0
    for start, end in merged:
        kept.append(whole[at:start])
        at = end
    return b"".join([*kept, whole[at:]])


def remove_spans(whole: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, list[tuple[int, int]]]:
    """The remaining bytes, and the spans merged where they touch."""
    start, end = np.array(spans, np.int64).reshape(-1, 2).T
    _, start, end = _merged(np.zeros(len(start), np.int64), start, end)
    merged = list(zip(start.tolist(), end.tolist()))
    return _without(whole, merged), merged


_RESULT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                     ("n_spans", pa.int64()), ("kept_sha256", pa.string())])


def removal_digests(documents: DataFrame, **options) -> DataFrame:
    """One row per document: the contract's digest columns."""

    def run(batches):
        def rows():
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    yield from slice_rows(batch.slice(at, 256))

        def slice_rows(batch):
            spans = batch.column("spans")
            counts = pc.fill_null(pc.list_value_length(spans), 0).to_numpy()
            owner, start, end = _merged(np.repeat(np.arange(batch.num_rows), counts),
                                        *(spans.flatten().field(c).to_numpy() for c in ("start", "end")))
            of = np.searchsorted(owner, np.arange(batch.num_rows + 1)).tolist()
            merged = list(zip(start.tolist(), end.tolist()))
            for i, (doc_id, whole) in enumerate(zip(batch.column("doc_id").to_pylist(), _bytes_of(batch.column("text")))):
                whole, own = whole or b"", merged[of[i]:of[i + 1]]
                kept = _without(whole, own)
                yield doc_id, len(whole), len(whole) - len(kept), len(own), hashlib.sha256(kept).hexdigest()

        yield from emit(rows(), _RESULT)

    return repeated_spans(documents, **options).mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
