"""Packing tokenised documents into training windows.

Documents are tokenised and packed where they lie (map only): each group of
documents of one partition is packed by Karmarkar-Karp multiway differencing.
Every remainder starts as a partial partition with one loaded window; the two
partial partitions with the largest spread are merged again and again, the
fuller windows of one onto the emptier windows of the other, until one
partition with near-equal windows is left. The number of windows rises until
none exceeds the capacity; the pieces of the windows that this adds, the
emptiest ones, are then cut to fill what room the others have, so every window
is exactly full and few pieces are cut. The last tokens of a partition, fewer
than one window, become sequences whose lengths are powers of two.

Defined cases: a null text is empty and has only the closing id; repeated
rows are packed each on their own; other columns are ignored. An empty table
gives no rows. Sequence ids are unique; they hold the partition's number, so
a repeated task gives the same ids.
"""

from __future__ import annotations

import heapq
import json
import os
import zlib
from collections.abc import Callable, Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import emit, rows_of

WINDOW = 1024
END_ID = 0
#: Documents whose remainders are packed together.
GROUP_DOCUMENTS = 256

Piece = tuple[int, int, int]  # document, start, length


def _rank_encoder(path: str):
    """The file's byte-level vocabulary and part pattern as a ``tiktoken``
    encoding. Its ids are the ranks of the merges, which is checked here, so
    merging by rank gives the ids of the ``tokenizers`` file, only faster."""
    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]  # bytes shown as themselves
    hidden = [b for b in range(256) if b not in shown]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    ids = [model["vocab"][a + b] for a, b in merges]
    if any(x >= y for x, y in zip(ids, ids[1:])):
        raise ValueError("the vocabulary's ids are not in the order of its merges")
    made = {a + b for a, b in merges} | set(byte_of)
    ranks = {bytes(byte_of[c] for c in token): i for token, i in model["vocab"].items() if token in made}
    return tiktoken.Encoding("vocabulary", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


class TextTokenizer:
    """Token ids by a ``tokenizers`` file. Whole texts are merged by rank; those
    that hold a special token's string go through ``tokenizers`` itself."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self._special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self._ranks = _rank_encoder(path)

    def encode(self, text: str) -> np.ndarray:
        if any(s in text for s in self._special):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4")
        return np.asarray(self._ranks.encode_to_numpy(text), "<u4") if text else np.zeros(0, "<u4")


def difference(sizes: list[int], windows: int) -> list[list[int]]:
    """Karmarkar-Karp multiway differencing: the numbers of the sizes in each
    of ``windows`` near-equal windows. A partial partition is held as its
    loaded windows, (load, what is in it), the fullest first."""
    load_of = itemgetter(0)
    heap = [(-size, i, [(size, i)]) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    count = len(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[2], heap[0][2]
        meet = max(len(a) + len(b) - windows, 0)  # opposing imbalances: only the emptiest windows meet
        both = a[:len(a) - meet] + b[:len(b) - meet] + [
            (x + y, (p, q)) for (x, p), (y, q) in zip(a[len(a) - meet:], reversed(b[len(b) - meet:]))]
        both.sort(key=load_of, reverse=True)
        least = both[-1][0] if len(both) == windows else 0
        heapq.heapreplace(heap, (least - both[0][0], count, both))
        count += 1
    found = [_leaves(tree) for _, tree in heap[0][2]] if heap else []
    return found + [[] for _ in range(windows - len(found))]


def _leaves(tree) -> list[int]:
    found, open_ = [], [tree]
    while open_:
        x = open_.pop()
        if isinstance(x, tuple):
            open_ += x
        elif x is not None:
            found.append(x)
    return sorted(found)


def pack_whole(sizes: list[int], window: int) -> list[list[int]]:
    """Uncut packing of sizes up to ``window``: at first as many windows as
    the capacity needs; the count rises, by the share that the fullest window
    exceeds the capacity, until no window does."""
    if not sizes:
        return []
    if max(sizes) > window:
        raise ValueError("a size exceeds the window")
    windows = -(-sum(sizes) // window)
    while True:
        packed = difference(sizes, windows)
        fullest = max(sum(sizes[i] for i in w) for w in packed)
        if fullest <= window:
            return [w for w in packed if w]
        windows = max(windows + 1, windows * fullest // window)


def fill(windows: list[list[Piece]], count: int, window: int) -> list[list[Piece]]:
    """The ``count`` fullest windows, full: the pieces of the others are cut to
    fill their room (which is as large as these pieces together)."""
    windows = sorted(windows, key=lambda w: -sum(p[2] for p in w))
    kept, spare = windows[:count], [p for w in windows[count:] for p in w]
    spare.sort(key=lambda p: p[2])
    for own in kept:
        room = window - sum(p[2] for p in own)
        while room:
            doc, start, size = spare.pop()
            take = min(size, room)
            own.append((doc, start, take))
            if take < size:
                spare.append((doc, start + take, size - take))
            room -= take
    return kept


def pack_group(rest: list[Piece], window: int) -> tuple[list[list[Piece]], list[Piece]]:
    """Full windows of the pieces, and the pieces (fewer tokens than one
    window) that are left over."""
    total = sum(p[2] for p in rest)
    count, spare = divmod(total, window)
    kept, left = list(rest), []
    while spare:  # the last tokens stay behind
        doc, start, size = kept.pop()
        cut = min(size, spare)
        left.insert(0, (doc, start + size - cut, cut))
        if cut < size:
            kept.append((doc, start, size - cut))
        spare -= cut
    if not count:
        return [], left
    packed = [[kept[i] for i in w] for w in pack_whole([p[2] for p in kept], window)]
    return fill(packed + [[] for _ in range(count - len(packed))], count, window), left


def powers(rest: list[Piece], window: int) -> Iterator[list[Piece]]:
    """The left-over pieces as sequences whose lengths are powers of two."""
    rest, total, size = list(rest), sum(p[2] for p in rest), window
    while total:
        size >>= 1
        if not total & size:
            continue
        sequence, room = [], size
        while room:
            doc, start, n = rest.pop(0)
            take = min(n, room)
            sequence.append((doc, start, take))
            if take < n:
                rest.insert(0, (doc, start + take, n - take))
            room -= take
        total -= size
        yield sequence


def pack_stream(documents: Iterator[np.ndarray], window: int, group: int) -> Iterator[list[tuple]]:
    """Sequences of (document, start, length, ids, tokens of the document);
    holds what whole windows leave of one group's documents, less than a
    window of each."""
    if window < 1 or window & (window - 1):
        raise ValueError("the window must be a power of two")
    held: dict[int, tuple[int, np.ndarray, int]] = {}  # where the rest begins, its ids, tokens of the document
    rest: list[Piece] = []

    def told(pieces: list[Piece]) -> list[tuple]:
        return [(d, s, n, held[d][1][s - held[d][0]:s - held[d][0] + n], held[d][2]) for d, s, n in pieces]

    for doc, ids in enumerate(documents):
        whole = len(ids) // window * window
        for start in range(0, whole, window):
            yield [(doc, start, window, ids[start:start + window], len(ids))]
        held[doc] = whole, ids[whole:].copy(), len(ids)
        if whole < len(ids):
            rest.append((doc, whole, len(ids) - whole))
        if len(held) >= group:
            packed, rest = pack_group(rest, window)
            for w in packed:
                yield told(w)
            held = {d: held[d] for d in {p[0] for p in rest}}
    packed, rest = pack_group(rest, window)
    for w in (*packed, *powers(rest, window)):
        yield told(w)


_RESULT = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                     ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()),
                     ("offset", pa.int64())])
_DDL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def pack_documents(documents: DataFrame, tokenizer_path: Callable[[], str] | str = vocabulary_path,
                   window: int = WINDOW, group: int = GROUP_DOCUMENTS, with_ids: bool = False) -> DataFrame:
    """One row per piece; ``with_ids`` adds the piece's token ids.
    ``tokenizer_path`` is a path that every executor has, or a function that
    gives it there."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = _RESULT.append(pa.field("ids", pa.list_(pa.int32()))) if with_ids else _RESULT

    def run(batches):
        tokenizer = TextTokenizer(tokenizer_path() if callable(tokenizer_path) else tokenizer_path)
        names: list = []

        def tokenised():
            for doc_id, text in rows_of(batches, ["doc_id", "text"]):
                names.append(doc_id)
                yield np.append(tokenizer.encode(text or ""), np.array([END_ID], "<u4"))

        def rows():
            first = TaskContext.get().partitionId() << 40
            for number, sequence in enumerate(pack_stream(tokenised(), window, group)):
                offset = 0
                for doc, start, length, ids, total in sequence:
                    row = (names[doc], start, length, zlib.crc32(ids.tobytes()), total, first + number, offset)
                    yield (*row, ids) if with_ids else row
                    offset += length

        yield from emit(rows(), schema)

    return docs.mapInArrow(run, _DDL + ", ids array<int>" * with_ids)
