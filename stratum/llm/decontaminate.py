"""Benchmark decontamination with a generalised suffix automaton.

All test items, normalised to words, form one automaton. Each document's
words are streamed through it; the state and the longest matching length at
every word tell which spans repeat an item. A span is hit when its match
reaches ``window`` words (or the whole of a shorter item); a document is
contaminated when its hit words reach the coverage limit.

A benchmark above ``block_bytes`` is one automaton for each block of items,
and no block passes through the driver. Hashes of all item windows set bits in
a fixed bitmap, documents' windows that meet a bit are joined with the items'
windows, and each document is sent to the blocks that share a window with it,
where one task builds the automaton of a block and streams some documents.

Defined cases: null or empty texts have no words; an item without words is
ignored; an item with a null id still marks words but is not listed; repeated
items and rows count as they stand; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import emit, keep_on_shared_storage, rows_of, words_of

WINDOW = 13
#: A document is contaminated from this share of hit words on (1 / 20).
COVERAGE = 20
#: Bytes of item texts in one automaton; larger benchmarks are streamed block by block.
BLOCK_BYTES = 2 << 20
#: Bytes of documents streamed through a block's automaton by one task (about).
DOCUMENT_BYTES = 16 << 20
#: Bits of the bitmap of item windows (16 MB).
FILTER_BITS = 27


class ItemAutomaton:
    """Suffix automaton over the words of several items."""

    def __init__(self, items: Iterable[tuple[object, list[bytes]]], window: int = WINDOW) -> None:
        self.window = window
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        items = [(i, words) for i, words in items if words]
        for _, words in items:
            last = 0
            for word in words:
                last = self._extend(last, word)
        # Items of every window (by the state of its words) and of every short item.
        self.above_window = self._above_window()
        self.window_items: dict[int, set] = {}
        self.short_items: dict[int, dict[int, set]] = {}
        for item, words in items:
            state, n = 0, 0
            for word in words:
                state, n = self.next[state][word], n + 1
                if n >= window:
                    self.window_items.setdefault(self.above_window[state], set()).add(item)
            if n < window:
                self.short_items.setdefault(state, {}).setdefault(n, set()).add(item)
        # The nearest state on the way to the root that is a short item.
        self.short_above = [-1] * len(self.next)
        if self.short_items:
            for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
                self.short_above[state] = state if state in self.short_items else self.short_above[self.link[state]]

    def _new(self, length: int, following: dict, link: int) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _clone(self, p: int, q: int, word: bytes) -> int:
        clone = self._new(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p != -1 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, word: bytes) -> int:
        """The state of the item's words so far, one word longer."""
        if (q := self.next[last].get(word)) is not None:  # an earlier item has these words
            return q if self.length[q] == self.length[last] + 1 else self._clone(last, q, word)
        state, p = self._new(self.length[last] + 1, {}, 0), last
        while p != -1 and word not in self.next[p]:
            self.next[p][word] = state
            p = self.link[p]
        if p != -1:
            q = self.next[p][word]
            self.link[state] = q if self.length[q] == self.length[p] + 1 else self._clone(p, q, word)
        return state

    def _above_window(self) -> list[int]:
        """For each state the one of the last ``window`` words of a match that
        ends there (itself, or the nearest on its way to the root)."""
        above = list(range(len(self.next)))
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            if self.length[self.link[state]] >= self.window:
                above[state] = above[self.link[state]]
        return above

    def stream(self, words: list[bytes]) -> tuple[list[list[int]], set]:
        """(hit spans in word numbers, end exclusive, apart and ascending; items)."""
        spans: list[list[int]] = []
        items: set = set()
        following, link, length, window = self.next, self.link, self.length, self.window
        root, short_above, above_window = following[0], self.short_above, self.above_window
        any_short = bool(self.short_items)
        state = n = 0

        def hit(start: int, end: int) -> None:
            while spans and spans[-1][0] >= start:
                spans.pop()
            if spans and spans[-1][1] >= start:
                spans[-1][1] = end
            else:
                spans.append([start, end])

        for at, word in enumerate(words, 1):
            if word not in root:  # no item has the word
                state = n = 0
                continue
            while (to := following[state].get(word)) is None:
                state = link[state]
                n = length[state]
            state, n = to, n + 1
            if n >= window:
                items |= self.window_items[above_window[state]]
                hit(at - window, at)
            if any_short:
                above = short_above[state]
                while above > 0:
                    for size, who in self.short_items[above].items():
                        if size <= n:
                            items |= who
                            hit(at - size, at)
                    above = short_above[link[above]]
        return spans, items


def _items(benchmark: DataFrame, block_bytes: int) -> tuple[DataFrame, int]:
    """(items, blocks): the items, with a block number if there are several."""
    items = benchmark.select(F.col("item_id").cast("string").alias("id"), F.col("text").cast("string").alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // block_bytes))
    if n == 1:
        return items, 1
    return keep_on_shared_storage(items.withColumn("block", F.pmod(F.xxhash64("text", "id"), F.lit(n)).cast("int")), "items"), n


_PARTIAL = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()),
                      ("spans", pa.list_(pa.list_(pa.int64()))), ("items", pa.list_(pa.string()))])
_PARTIAL_DDL = "key long, doc_id long, n_words long, spans array<array<long>>, items array<string>"


def match_spans(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(key, doc_id, n_words, spans, items) for every document; ``key`` is null
    or the row's number. A map over the documents while the benchmark fits one
    automaton; else each document meets the blocks that share a window with it."""
    items, blocks = _items(benchmark, block_bytes)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if blocks == 1:
        return _stream(docs.select(F.lit(None).cast("long").alias("key"), "doc_id", "text"), items.collect(), window)
    return _stream_blocks(_keyed(docs), items, window)


def _keyed(docs: DataFrame) -> DataFrame:
    """A copy of the rows with a number of their own, the same in every pass."""
    return keep_on_shared_storage(docs.withColumn("key", F.monotonically_increasing_id()), "keyed-documents")


def _rows(automaton: ItemAutomaton, rows: Iterable[tuple]):
    for key, doc_id, text in rows:
        words = words_of(text)
        spans, items = automaton.stream(words)
        yield key, doc_id, len(words), spans, sorted(i for i in items if i is not None)


def _stream(docs: DataFrame, block: list, window: int) -> DataFrame:
    held = docs.sparkSession.sparkContext.broadcast([(r["id"], r["text"]) for r in block])

    def run(batches):
        automaton = ItemAutomaton(((i, words_of(t)) for i, t in held.value), window)
        yield from emit(_rows(automaton, rows_of(batches, ["key", "doc_id", "text"])), _PARTIAL)

    return docs.select("key", "doc_id", "text").mapInArrow(run, _PARTIAL_DDL)


def _window_hashes(words: list[bytes], sizes: Iterable[int]) -> set[int]:
    return {xxhash.xxh3_64_intdigest(b" ".join(words[i:i + size])) for size in sizes for i in range(len(words) - size + 1)}


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def _block_pairs(docs: DataFrame, items: DataFrame, window: int) -> DataFrame:
    """(key, block): the blocks with a window that the document has, too. Equal
    hashes of different windows only add a pair that gives nothing."""
    spark = docs.sparkSession

    def of_items(batches):
        schema = pa.schema([("hash", pa.int64()), ("block", pa.int32()), ("size", pa.int32())])

        def out():
            for text, block in rows_of(batches, ["text", "block"]):
                words = words_of(text)
                size = min(window, len(words))
                for h in _window_hashes(words, [size]) if size else ():
                    yield _signed(h), block, size

        yield from emit(out(), schema)

    of_item = keep_on_shared_storage(items.select("text", "block").mapInArrow(
        of_items, "hash long, block int, size int").distinct(), "item-windows")
    sizes = sorted(r[0] for r in of_item.select("size").distinct().collect())  # at most ``window`` different ones
    bit = F.shiftrightunsigned("hash", 64 - FILTER_BITS)
    found = of_item.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).cast("int").alias("at")) \
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("mask")).toArrow()
    bits = np.zeros(1 << FILTER_BITS - 6, np.int64)  # no more than the bitmap reaches the driver
    bits[found["at"].to_numpy()] = found["mask"].to_numpy()
    held = spark.sparkContext.broadcast(bits.view(np.uint64))

    def of_docs(batches):
        schema = pa.schema([("key", pa.int64()), ("hash", pa.int64())])
        for key, text in rows_of(batches, ["key", "text"]):
            own = np.fromiter(_window_hashes(words_of(text), sizes), np.uint64)
            at = own >> np.uint64(64 - FILTER_BITS)
            own = own[(held.value[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1]
            if len(own):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), key)), pa.array(own.view(np.int64))], schema=schema)

    shared = docs.select("key", "text").mapInArrow(of_docs, "key long, hash long")
    return shared.join(of_item.select("hash", "block").distinct(), "hash").select("key", "block").distinct()


def _stream_blocks(docs: DataFrame, items: DataFrame, window: int) -> DataFrame:
    pairs = keep_on_shared_storage(_block_pairs(docs, items, window), "pairs")
    sent = docs.select("key", "doc_id", "text").join(pairs, "key")
    parts = sent.groupBy("block").agg(F.ceil((F.sum(F.coalesce(F.octet_length("text"), F.lit(0))) + 1) / F.lit(DOCUMENT_BYTES))
                                      .cast("int").alias("parts"))
    left = items.join(parts, "block").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    right = sent.join(parts, "block").withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int"))

    def run(own: pa.Table, some: pa.Table) -> pa.Table:
        automaton = ItemAutomaton(((i, words_of(t)) for i, t in zip(own["id"].to_pylist(), own["text"].to_pylist())), window)
        batches = _rows(automaton, rows_of(some.to_batches(), ["key", "doc_id", "text"]))
        return pa.Table.from_batches(emit(batches, _PARTIAL), schema=_PARTIAL)

    found = left.select("block", "part", "id", "text").groupBy("block", "part") \
        .cogroup(right.select("block", "part", "key", "doc_id", "text").groupBy("block", "part")).applyInArrow(run, _PARTIAL_DDL)
    merged = found.groupBy("key").agg(
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))

    def count(batches):
        schema = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64())])
        yield from emit(((k, i, len(words_of(t))) for k, i, t in rows_of(batches, ["key", "doc_id", "text"])), schema)

    # Spans of several blocks, ascending by start: one starts a new run where none before it reaches it.
    joined = F.expr("""aggregate(spans, cast(array() as array<array<bigint>>), (done, s) ->
        case when size(done) > 0 and element_at(done, -1)[1] >= s[0]
             then concat(slice(done, 1, size(done) - 1),
                         array(array(element_at(done, -1)[0], greatest(element_at(done, -1)[1], s[1]))))
             else concat(done, array(s)) end)""")
    return docs.select("key", "doc_id", "text").mapInArrow(count, "key long, doc_id long, n_words long") \
        .join(merged, "key", "left").select(
            "key", "doc_id", "n_words", F.coalesce(joined, F.expr("cast(array() as array<array<bigint>>)")).alias("spans"),
            F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items"))


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  coverage: int = COVERAGE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: the contract's digest columns."""
    found = match_spans(documents, benchmark, window, block_bytes)
    return found.withColumn("n_hit", _n_hit()).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (F.lit(coverage) * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))


def _n_hit():
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                      coverage: int = COVERAGE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents that are not contaminated, with all their columns (map
    only while the benchmark fits one automaton)."""
    items, blocks = _items(benchmark, block_bytes)
    if blocks > 1:
        whole = _keyed(documents.select(F.struct("*").alias("row"), "doc_id", "text"))
        bad = _stream_blocks(whole, items, window).filter(
            (_n_hit() > 0) & (F.lit(coverage) * _n_hit() >= F.col("n_words"))).select("key")
        return whole.join(bad, "key", "left_anti").select("row.*")
    rows = documents.sparkSession.sparkContext.broadcast([(r["id"], r["text"]) for r in items.collect()])
    column = documents.columns.index("text")

    def run(batches):
        automaton = ItemAutomaton(((i, words_of(t)) for i, t in rows.value), window)
        for batch in batches:
            keep = []
            for at in range(0, batch.num_rows, 256):
                for text in batch.column(column).slice(at, 256).to_pylist():
                    words = words_of(text)
                    n = sum(b - a for a, b in automaton.stream(words)[0])
                    keep.append(not (n > 0 and coverage * n >= len(words)))
            yield batch.filter(pa.array(keep, pa.bool_()))

    return documents.mapInArrow(run, documents.schema)


def digest_of(items: Iterable[object]) -> str:
    """The contract's digest of a list of item ids."""
    return hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()
