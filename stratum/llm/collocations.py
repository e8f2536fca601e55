"""Phrase collocations by vertically partitioned, depth-truncated suffix subtrees.

Texts are cut into pieces and words; every word starts a suffix that ends
after ``DEPTH`` words or with its piece. The suffixes are partitioned
vertically: suffixes are counted by the hash bucket of their first word,
buckets are packed into groups of at most ``budget`` suffixes, one above
the budget is extended to the first two words, and a pair that alone is
above it is dealt by the whole suffix. Each group's subtree is built on
its own, by one task: its suffixes in word order, with the common prefixes of
neighbours as inner nodes, and the totals of the leaves below a node as that
phrase's count. Only nodes above a group's prefix are summed over groups.

A phrase can only reach ``least`` occurrences if each of its words and word
pairs does. Two passes count hashes of words and of pairs; the frequent ones
set bits in fixed bitmaps (``FILTER_BITS``, broadcast), and a suffix ends before
a pair whose bit is not set. Collisions only keep a suffix longer than needed, so the
counts stay exact; suffixes themselves are compared by their words, never by
a hash alone. Equal suffixes of a chunk of text are combined before the shuffle.

Defined cases: a null text is empty; a null lang is ``und``; a text or piece
without words gives nothing; repeated rows count as often as they stand; a
text of any length is read in chunks cut between words. Ties go to the smaller
phrase in byte order. An empty table, and a lang without candidates, give no
rows. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import keep_on_shared_storage

#: Words of a phrase at most, and occurrences that a candidate needs.
DEPTH, LEAST = 4, 30
#: A candidate goes when a longer one around it has this percentage of its count.
ABSORBED = 80
TOP = 2000
#: Suffixes of a group at most (but for equal hashes); one group is one task's memory.
BUDGET = 1_000_000
#: Bits of the fixed bitmaps of frequent words and pairs (8 MB each).
FILTER_BITS = 26
#: Prefix buckets of the first word.
FIRST_BITS = 14
#: Bytes of text looked at together.
CHUNK_BITS = 20
CHUNK = 1 << CHUNK_BITS
#: Parts that a lang's candidates are ranked in before they are ranked together.
RANK_PARTS = 64

# Fixed values of the contract: separators and blanks.
_SEPARATORS, _BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
_KIND = np.full(256, 2, np.uint8)
_KIND[list(_SEPARATORS)] = 0
_KIND[list(_BLANKS)] = 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_NO_WORD = re.compile(b"[" + re.escape(_SEPARATORS + _BLANKS) + b"]")
_AHEAD = re.compile(b"(?:[" + re.escape(_SEPARATORS + _BLANKS) + b"]*[^" + re.escape(_SEPARATORS + _BLANKS)
                    + b"]+){0,%d}" % (DEPTH - 1))
# Random values of the bytes (letters of either case share one, others than words' have none) and the
# bases of two rolling sums; a base is odd, so it has an inverse.
_VALUE = np.random.default_rng(11).integers(0, 1 << 63, 256, np.uint64)[_LOWER]
_VALUE[list(_SEPARATORS + _BLANKS)] = 0
_BASE, _SECOND_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


@lru_cache(maxsize=4)
def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """base ** i and its inverse, modulo 2 ** 64, for i below ``size``."""
    out = []
    for x in (base, pow(base, -1, 1 << 64)):
        values = np.full(size, x, np.uint64)
        values[0] = 1
        out.append(np.cumprod(values, dtype=np.uint64))
    return out[0], out[1]


def _word_sums(data: np.ndarray, begin: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """Rolling hash of each word: sum of value * base ** place in the word."""
    up, down = _powers(base, 1 << max(CHUNK_BITS, int(len(data)).bit_length()))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUE[data] * up[:len(data)], out=total[1:])
    return (total[end] - total[begin]) * down[begin]


def _mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads them (splitmix64's finaliser)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _seed(lang: str) -> int:
    return xxhash.xxh3_64_intdigest(lang)


class Chunk:
    """Words of a stretch of text. ``starts`` are the places where documents
    begin, ``seeds`` a number for the lang of each."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, seeds: np.ndarray) -> None:
        kind = _KIND[data]
        word = kind == 2
        edge = np.zeros(len(data) + 1, bool)
        edge[starts] = edge[0] = edge[-1] = True
        opens, closes = edge[:-1].copy(), edge[1:].copy()
        opens[1:] |= ~word[:-1]
        closes[:-1] |= ~word[1:]
        self.data = data
        self.begin = np.flatnonzero(word & opens)
        self.end = np.flatnonzero(word & closes) + 1
        count = np.diff(np.append(np.searchsorted(self.begin, starts), len(self.begin)))
        self.document = np.repeat(np.arange(len(starts)), count)
        self.seed = seeds[self.document]
        gaps = np.cumsum(kind == 0, dtype=np.int32)[self.begin]
        self.joined = np.zeros(len(self.begin), bool)  # to the next word, in the same piece
        self.joined[:-1] = (gaps[1:] == gaps[:-1]) & (self.document[1:] == self.document[:-1])
        self.plain = _mixed(_word_sums(data, self.begin, self.end, _BASE))
        self.hash = _mixed(self.plain ^ self.seed)

    def pair_hash(self) -> np.ndarray:
        """Of each word with the next one (0 at the end of a piece)."""
        out = np.zeros(len(self.hash), np.uint64)
        out[:-1] = _mixed(self.hash[:-1] * np.uint64(_BASE) + self.plain[1:])
        out[~self.joined] = 0
        return out

    def word_ids(self) -> tuple[np.ndarray, np.ndarray]:
        """(id of each word, a place of each id): equal ids for equal words,
        told by two hashes of 64 bits and the length, by the bytes if those differ."""
        ids, found = pd.factorize(self.plain)
        place = np.empty(len(found), np.int64)
        place[ids[::-1]] = np.arange(len(ids))[::-1]
        length = self.end - self.begin
        second = _word_sums(self.data, self.begin, self.end, _SECOND_BASE)
        if not ((length == length[place][ids]) & (second == second[place][ids])).all():
            number: dict[bytes, int] = {}
            ids = np.array([number.setdefault(self.word(i), len(number)) for i in range(len(length))])
            place = np.unique(ids, return_index=True)[1]
        return ids, place

    def word(self, i: int) -> bytes:
        return _LOWER[self.data[self.begin[i]:self.end[i]]].tobytes()


def _chunks(batch: pa.RecordBatch, size: int) -> Iterator[tuple[Chunk, int, list[str]]]:
    """(words, how many of them start a suffix here, langs of the documents):
    a text longer than ``size`` is cut between words; the words behind the cut
    that suffixes before it reach are shown to both sides."""
    texts = pc.fill_null(batch.column("text"), "").cast(pa.large_binary())
    langs = batch.column("lang").to_pylist()
    seeds = np.array([_seed(x) for x in langs], np.uint64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    a = 0
    while a < len(langs):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + size, side="right")) - 1)
        low, high = int(offsets[a]), int(offsets[b])
        while low < high:
            cut = reach = high
            if high - low > size:  # one long text
                found = _NO_WORD.search(data, low + size, high)
                if found:
                    cut = found.start()
                    reach = _AHEAD.match(data, cut, high).end()
            starts = np.maximum(offsets[a:b] - low, 0)
            some = Chunk(data[low:reach], starts, seeds[a:b])
            yield some, int(np.searchsorted(some.begin, cut - low)), langs[a:b]
            low = cut
        a = b


def _has(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys >> np.uint64(64 - FILTER_BITS)
    return (bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def _bitmap(hashes: DataFrame) -> np.ndarray:
    """Bits of the hashes' first ``FILTER_BITS``, as 64-bit words; the driver
    gets no more of them than the bitmap has, however many hashes there are."""
    bit = F.shiftrightunsigned("hash", 64 - FILTER_BITS)
    rows = hashes.select(bit.alias("bit")) \
        .groupBy(F.shiftright("bit", 6).cast("int").alias("at")) \
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("mask")).toArrow()
    bits = np.zeros(1 << FILTER_BITS - 6, np.int64)
    bits[rows["at"].to_numpy()] = rows["mask"].to_numpy()
    return bits.view(np.uint64)


# Hashes travel in packets: those of one chunk that share their first bits, as 32 more bits and a 32-bit
# count each. A packet's range is one group, of which no more comes together than about one entry for
# each different hash and chunk.


def _packets(keys: np.ndarray, bits: int) -> Iterator[tuple[int, bytes]]:
    found, n = np.unique(keys, return_counts=True)
    packed = (found << np.uint64(bits) & np.uint64(0xFFFFFFFF00000000)) | n.astype(np.uint64)
    part = (found >> np.uint64(64 - bits)).astype(np.int64)
    heads = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else []
    for a, b in zip(heads, np.append(heads[1:], len(part))):
        yield int(part[a]), packed[a:b].tobytes()


def _add_up(table: pa.Table, bits: int, least: int) -> pa.Table:
    """(hash, n) of a group's packets: totals from ``least`` on."""
    packed = np.sort(np.concatenate([np.frombuffer(x, np.uint64) for x in table.column("packet").to_pylist()]))
    key = packed >> np.uint64(32)
    heads = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    n = np.add.reduceat(packed & np.uint64(0xFFFFFFFF), heads)
    kept = n >= least
    top = np.uint64(table.column("part")[0].as_py()) << np.uint64(64 - bits)
    found = top | key[heads[kept]] << np.uint64(32 - bits)
    return pa.table({"hash": pa.array(found.view(np.int64)), "n": pa.array(n[kept].view(np.int64))})


def _packet_bits(total: int, budget: int) -> int:
    """So many first bits that a packet's range holds at most ``budget`` entries (about)."""
    return min(max((total // budget).bit_length(), 5), 28)


def _count_langs(docs: DataFrame, chunk: int) -> DataFrame:
    """(lang, n): words of each lang."""
    schema = pa.schema([("lang", pa.string()), ("n", pa.int64())])

    def run(batches):
        for batch in batches:
            texts = pc.fill_null(batch.column("text"), "").cast(pa.large_binary())
            offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
            data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
            n = np.zeros(len(texts), np.int64)
            for a in range(0, len(texts)):
                for low in range(int(offsets[a]), int(offsets[a + 1]), chunk):
                    word = _KIND[data[low:min(low + chunk, int(offsets[a + 1]))]] == 2
                    n[a] += np.count_nonzero(word[1:] & ~word[:-1]) \
                        + (word[0] and (low == offsets[a] or _KIND[data[low - 1]] != 2))
            held = pa.table({"lang": batch.column("lang"), "n": n}).group_by("lang").aggregate([("n", "sum")])
            yield pa.RecordBatch.from_arrays([held["lang"].combine_chunks(), held["n_sum"].combine_chunks()], schema=schema)

    return docs.mapInArrow(run, "lang string, n long").groupBy("lang").agg(F.sum("n").alias("n")).filter("n > 0")


def _frequent(docs: DataFrame, keys, bits: int, least: int, chunk: int, label: str) -> DataFrame:
    """(hash, occurrences) of the hashes that ``keys`` gives for a chunk's
    suffixes and that occur at least ``least`` times, written once."""
    schema = pa.schema([("part", pa.int32()), ("packet", pa.binary())])

    def run(batches):
        for batch in batches:
            for some, counted, _ in _chunks(batch, chunk):
                rows = list(_packets(keys(some, counted), bits))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    packets = docs.mapInArrow(run, "part int, packet binary")
    return keep_on_shared_storage(packets.groupBy("part").applyInArrow(
        lambda t: _add_up(t, bits, least), "hash long, n long"), label)


class Partition:
    """Which group a suffix belongs to: by the bucket of its first word, by
    its first two words if that bucket is above the budget, by all its words
    if those two alone are."""

    def __init__(self, loads: np.ndarray, pairs: dict[int, int], bits: int, budget: int) -> None:
        self.base = np.zeros(len(loads), np.int32)
        self.parts = np.maximum(-(-loads // budget), 1).astype(np.int32)
        self.groups, load = 0, budget
        for b in np.argsort(-loads, kind="stable"):  # next fit, the largest first
            if self.parts[b] == 1 and load + loads[b] <= budget:
                load += loads[b]
                self.base[b] = self.groups - 1
            else:
                self.base[b], load = self.groups, loads[b] if self.parts[b] == 1 else budget
                self.groups += int(self.parts[b])
        # Pairs are known by their first bits; the bits of another pair that shares them go along.
        self.shift = np.uint64(32 - bits)
        self.pair = np.array(sorted(x % (1 << 64) for x in pairs), np.uint64) >> self.shift
        self.pair_parts = np.array([-(-pairs[x] // budget) for x in sorted(pairs, key=lambda x: x % (1 << 64))], np.int32)
        self.pair_base = (self.groups + np.cumsum(self.pair_parts) - self.pair_parts).astype(np.int32)
        self.groups += int(self.pair_parts.sum())

    def of(self, first: np.ndarray, pair: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(group, words of the prefix that lies in this group alone)."""
        b = (first >> np.uint64(64 - FIRST_BITS)).astype(np.int64)
        parts = self.parts[b]
        group = self.base[b] + (pair % parts.astype(np.uint64)).astype(np.int32)
        depth = np.where(parts > 1, 2, 1).astype(np.int8)
        if len(self.pair):
            at = np.minimum(np.searchsorted(self.pair, pair >> self.shift), len(self.pair) - 1)
            far = np.flatnonzero((self.pair[at] == pair >> self.shift) & (parts > 1))
            at = at[far]
            group[far] = self.pair_base[at] + (whole[far] % self.pair_parts[at].astype(np.uint64)).astype(np.int32)
            depth[far] = DEPTH
        return group, depth


def _suffixes(docs: DataFrame, words, pairs, partition, chunk: int) -> DataFrame:
    """Different suffixes of each chunk, in packets of one group, depth and
    lang: (part, depth, lang, suffixes one a line, 32-bit counts)."""
    schema = pa.schema([("part", pa.int32()), ("depth", pa.int8()), ("lang", pa.string()), ("lines", pa.string()),
                        ("counts", pa.binary())])

    def of_chunk(some: Chunk, counted: int, langs: list[str]):
        names = sorted(set(langs))
        number = {x: i for i, x in enumerate(names)}
        lang = np.array([number[x] for x in langs])[some.document]
        kept = _has(words.value, some.hash)
        pair = some.pair_hash()
        on = some.joined & _has(pairs.value, pair)
        on[:-1] &= kept[:-1] & kept[1:]
        kept[counted:] = False
        ids, place = some.word_ids()
        # Suffixes of one word by (lang, word); the others by (lang, two words) and what follows these.
        alone = np.flatnonzero(kept & ~on)
        one, at, n = np.unique(lang[alone] * len(place) + ids[alone], return_index=True, return_counts=True)
        at = alone[at]
        long = np.flatnonzero(kept & on)
        more = np.append(on[1:], False)
        third = more[long]
        fourth = third & np.append(on[2:], [False, False])[:len(on)][long]
        word = lambda k: ids[np.minimum(long + k, len(ids) - 1)] + 1
        front = pd.factorize((lang[long] * (len(place) + 1) + word(0)) * (len(place) + 1) + word(1))[0]
        back, kinds = pd.factorize(np.where(third, word(2), 0) * (len(place) + 1) + np.where(fourth, word(3), 0))
        _, first, many = np.unique(front * max(len(kinds), 1) + back, return_index=True, return_counts=True)
        at = np.concatenate([at, long[first]])
        n = np.concatenate([n, many])
        size = np.concatenate([np.ones(len(one), np.int64), 2 + third[first] + fourth[first]])
        whole = some.hash[at]
        for k in range(1, DEPTH):
            nxt = some.plain[np.minimum(at + k, len(ids) - 1)]
            whole = np.where(size > k, _mixed(whole * np.uint64(_BASE) + nxt), whole)
        group, depth = partition.value.of(some.hash[at], np.where(size > 1, pair[at], whole), whole)
        order = np.lexsort((lang[at], depth, group))
        at, n, size, group, depth = at[order], n[order].astype(np.uint32), size[order], group[order], depth[order]
        used = np.unique(np.concatenate([ids[np.minimum(at + k, len(ids) - 1)] for k in range(DEPTH)]))
        text = dict(zip(used.tolist(), (some.word(i).decode("utf-8") for i in place[used].tolist())))
        columns = [[text[i] for i in ids[np.minimum(at + k, len(ids) - 1)].tolist()] for k in range(DEPTH)]
        lines = [" ".join(own[:k]) for k, *own in zip(size.tolist(), *columns)]
        of = np.stack([group, depth, lang[at]])
        heads = np.flatnonzero(np.append(True, (of[:, 1:] != of[:, :-1]).any(axis=0))) if len(at) else []
        for a, b in zip(heads, np.append(heads[1:], len(at))):
            yield int(group[a]), int(depth[a]), names[of[2, a]], "\n".join(lines[a:b]), n[a:b].tobytes()

    def run(batches):
        for batch in batches:
            for some, counted, langs in _chunks(batch, chunk):
                rows = list(of_chunk(some, counted, langs))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return docs.mapInArrow(run, "part int, depth tinyint, lang string, lines string, counts binary")


def _subtree(table: pa.Table, least: int) -> pa.Table:
    """(lang, phrase, size, f): nodes of one group's subtree. The suffixes in
    word order; a node at depth k is a run of equal first k words, its count
    the total of the leaves in the run."""
    lines = pc.split_pattern(table.column("lines").combine_chunks(), "\n")
    packet = np.repeat(np.arange(len(lines)), pc.list_value_length(lines).to_numpy())
    words = pc.split_pattern(lines.flatten(), " ")
    size = pc.list_value_length(words).to_numpy()
    flat = words.flatten().dictionary_encode()
    langs = table.column("lang").combine_chunks().dictionary_encode()
    n = np.concatenate([np.frombuffer(x, np.uint32) for x in table.column("counts").to_pylist()]).astype(np.int64)
    whole = table.column("depth").to_numpy()[packet]
    code = np.full((DEPTH + 1, len(size)), -1, np.int64)
    code[0] = langs.indices.to_numpy()[packet]
    row = np.repeat(np.arange(len(size)), size)
    code[1 + np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size), row] = flat.indices.to_numpy()
    order = np.lexsort(code[::-1])
    code, size, n, whole = code[:, order], size[order], n[order], whole[order]
    new = np.ones(len(order), bool)
    new[1:] = code[0, 1:] != code[0, :-1]
    out = []
    for k in range(1, DEPTH + 1):
        new[1:] |= code[k, 1:] != code[k, :-1]
        deep = np.flatnonzero(size >= k)
        if not len(deep):
            break
        heads = np.flatnonzero(new[deep] | (deep == 0))
        total = np.add.reduceat(n[deep], heads)
        at = deep[heads]
        told = (total >= least) | (k < whole[at])
        at, total = at[told], total[told]
        phrase = flat.dictionary.take(pa.array(code[1, at]))
        for j in range(2, k + 1):
            phrase = pc.binary_join_element_wise(phrase, flat.dictionary.take(pa.array(code[j, at])), " ")
        out.append(pa.table({"lang": langs.dictionary.take(pa.array(code[0, at])), "phrase": phrase,
                             "size": pa.array(np.full(len(at), k, np.int32)), "f": pa.array(total)}))
    return pa.concat_tables(out)


def phrase_counts(documents: DataFrame, least: int = LEAST, budget: int = BUDGET,
                  chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """((lang, n), (lang, phrase, size, f)): words of each lang, and all
    phrases of up to ``DEPTH`` words that occur at least ``least`` times."""
    docs = documents.select(F.col("text"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    spark = documents.sparkSession
    total = keep_on_shared_storage(_count_langs(docs, chunk), "langs")
    bits = _packet_bits(int(total.agg(F.sum("n")).first()[0] or 0), budget)
    words = _frequent(docs, lambda some, counted: some.hash[:counted], bits, least, chunk, "words")
    word_bits = spark.sparkContext.broadcast(_bitmap(words))

    def pair_keys(some: Chunk, counted: int) -> np.ndarray:
        kept = _has(word_bits.value, some.hash)
        kept[:-1] &= kept[1:]
        return some.pair_hash()[:counted][(kept & some.joined)[:counted]]

    pairs = _frequent(docs, pair_keys, bits, least, chunk, "pairs")
    pair_bits = spark.sparkContext.broadcast(_bitmap(pairs))
    loads = np.zeros(1 << FIRST_BITS, np.int64)
    for row in words.groupBy(F.shiftrightunsigned("hash", 64 - FIRST_BITS).alias("b")).agg(F.sum("n")).collect():
        loads[row[0]] = row[1]
    heavy = {row[0]: row[1] for row in pairs.filter(F.col("n") > budget).collect()}  # fewer than words / budget
    partition = spark.sparkContext.broadcast(Partition(loads, heavy, bits, budget))
    nodes = _suffixes(docs, word_bits, pair_bits, partition, chunk).groupBy("part") \
        .applyInArrow(lambda t: _subtree(t, least), "lang string, phrase string, size int, f long")
    counted = nodes.groupBy("lang", "phrase", "size").agg(F.sum("f").alias("f")).filter(F.col("f") >= least)
    return total, keep_on_shared_storage(counted, "phrases")


def collocations(documents: DataFrame, least: int = LEAST, top: int = TOP, budget: int = BUDGET,
                 chunk: int = CHUNK) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each lang's best phrases.

    ``a`` is the phrase's count, ``l`` and ``r`` those of the two parts of its
    weakest cut; the score is floor(2000000 a / (l + r))."""
    total, counted = phrase_counts(documents, least, budget, chunk)
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    candidates = counted.filter("size > 1").withColumnRenamed("f", "a")
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))) \
        .withColumns({"left": F.expr("substring_index(phrase, ' ', k)"),
                      "right": F.expr("substring_index(phrase, ' ', k - size)")})
    parts = counted.select("lang", "phrase", "f")
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"]) \
        .join(parts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"]) \
        .withColumn("score", F.expr("cast(2000000 as decimal(7,0)) * cast(a as decimal(19,0)) "
                                    "div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))"))
    weakest = cuts.groupBy("lang", "phrase", "size", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inside = candidates.filter("size > 2") \
        .withColumn("words", F.split("phrase", " ")) \
        .withColumn("sub", F.explode(F.expr(
            "flatten(transform(sequence(2, size - 1), w -> transform(sequence(1, size - w + 1), "
            "i -> array_join(slice(words, i, w), ' '))))"))) \
        .groupBy("lang", F.col("sub").alias("phrase")).agg(F.max("a").alias("around"))
    kept = weakest.join(inside, ["lang", "phrase"], "left") \
        .filter(F.coalesce(F.lit(100) * wide("around") < F.lit(ABSORBED) * wide("a"), F.lit(True))) \
        .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # A lang may hold nearly all candidates: the first of each part, then the first of those.
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    best = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang", part).orderBy(*order))) \
        .filter(F.col("rank") <= top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))) \
        .filter(F.col("rank") <= top)
    return best.join(total, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
