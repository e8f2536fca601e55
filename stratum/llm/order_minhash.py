"""Near-duplicates by Order MinHash.

A text's k-mers are its runs of five words, labelled by occurrence. For each
of many hash functions a sketch takes the few k-mers with the smallest hashes
and keeps them in text order, so two texts share a sketch element only if they
share these k-mers in the same order. Texts with an equal element are
candidates; a banded alignment of their k-mers verifies them: ``similarity``
is aligned k-mers / (k-mers of both - aligned), and texts link from 0.8 on.

Equal word sequences are collapsed first, so copies cost nothing. Within an
element's group each text is verified against one pivot, not against all, and
links make components. In groups that are still of several components, k-mers
that one text alone has bound what a pair can align: the text with the least
of them is the second pivot, and at last the texts that the bound lets pass
are compared across components. Texts that merely share a passage, or copies
edited too much, have many k-mers of their own, so they are ruled out without
being paired, and no candidate that could link is lost. The last comparison
goes block by block, so no group meets whole in a task and no pairs are listed.

Defined cases: a null or empty text, or one without words, is in a class of
its own and always kept. A text of fewer than five words has one k-mer, all
its words. Rows with equal words are one class; of a class the row with the
smallest id stays (rows without an id last; of equal rows the first). Other
columns pass through.
"""

from __future__ import annotations

from bisect import bisect_left
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import _WORD_BYTES, connected_components, emit, fewer_tasks, keep_on_shared_storage, rows_of

SHINGLE_WORDS = 5
SIMILARITY = 0.8
#: K-mers of a sketch element, and elements of a sketch: a pair with
#: similarity 0.8 shares none with a chance of (1 - 0.8 ** 6) ** 36 = 2e-5.
PICKED, ELEMENTS = 6, 36
#: Texts with up to so many k-mers also get elements of one k-mer.
SHORT_KMERS, SHORT_ELEMENTS = 12, 8
#: Texts of a group that are compared in one block.
BLOCK_TEXTS = 512
#: Sketches, members of groups and compared pairs of one task.
SKETCHES_OF_TASK, MEMBERS_OF_TASK, PAIRS_OF_TASK = 20_000, 50_000, 5_000
#: Row numbers are broadcast up to so many; more are joined.
MAX_BROADCAST_ROWS = 500_000

_SEEDS = np.random.default_rng(20_240_229).integers(1, 1 << 63, ELEMENTS + SHORT_ELEMENTS, np.int64).astype(np.uint64)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_TABLE = np.random.default_rng(7).integers(1, 1 << 63, 256, np.int64).astype(np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


def word_hashes(text: str | None) -> tuple[np.ndarray, bytes]:
    """A 64-bit hash of each word, and the words joined by single spaces."""
    joined = b" ".join(text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()) if text else b""
    if not joined:
        return np.zeros(0, np.uint64), joined
    data = np.frombuffer(joined, np.uint8)
    spaces = np.flatnonzero(data == 0x20)
    starts, ends = np.append(0, spaces + 1), np.append(spaces, len(data))
    with np.errstate(over="ignore"):
        # Reversed positions from each word's end, so that equal words hash equally.
        back = np.repeat(ends, ends - starts + 1)[:len(data)] - np.arange(len(data))
        value = _mix(_TABLE[data] + back.astype(np.uint64) * _ODD)
        value[spaces] = 0
        return _mix(np.add.reduceat(value, starts) + (ends - starts).astype(np.uint64)), joined


def kmers(words: np.ndarray, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Hashes of the runs of ``size`` words, each labelled by its occurrence."""
    if not len(words):
        return words
    size = min(size, len(words))
    n = len(words) - size + 1
    with np.errstate(over="ignore"):
        h = np.zeros(n, np.uint64)
        for i in range(size):
            h = _mix(h * _ODD + words[i:i + n])
        order = np.argsort(h, kind="stable")
        ranked = h[order]
        new = np.ones(n, bool)
        new[1:] = ranked[1:] != ranked[:-1]
        if new.all():
            return h
        at = np.arange(n)
        label = np.empty(n, np.uint64)
        label[order] = (at - np.maximum.accumulate(np.where(new, at, 0))).astype(np.uint64)
        return np.where(label > 0, _mix(h + label * _ODD), h)


def sketch(found: np.ndarray) -> list[int]:
    """Order MinHash elements, as signed 64-bit keys."""
    out: list[int] = []
    n = len(found)
    with np.errstate(over="ignore"):
        if n >= PICKED:
            step = max(1, 200_000 // n)
            for at in range(0, ELEMENTS, step):
                seeds = _SEEDS[at:min(ELEMENTS, at + step)]
                ranks = _mix(found[None, :] ^ seeds[:, None])
                if n > PICKED:
                    picked = np.sort(np.argpartition(ranks, PICKED - 1, axis=1)[:, :PICKED], axis=1)
                else:
                    picked = np.broadcast_to(np.arange(n), (len(seeds), n))
                h = seeds.copy()
                for i in range(PICKED):
                    h = _mix(h * _ODD + found[picked[:, i]])
                out += h.view(np.int64).tolist()
        if 0 < n <= SHORT_KMERS:
            for seed in _SEEDS[ELEMENTS:]:
                out.append(int(_mix(found[np.argmin(_mix(found ^ seed))] * _ODD + seed).view(np.int64)))
    return out


def aligned_similarity(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """Similarity of two labelled k-mer sequences by their best alignment
    within the band that ``least`` allows; exact from ``least`` on.

    A labelled k-mer occurs once in a text, so the alignment is a longest
    increasing run of matching places. If n + m k-mers reach ``least``, at
    most (n + m)(1 - least)/(1 + least) of them are unaligned, and no match
    lies further than that from the diagonal."""
    n, m = len(a), len(b)
    if not n or not m or min(n, m) < least * max(n, m):
        return 0.0
    band = (n + m) * (1 - least) / (1 + least) + 1e-9
    _, at_a, at_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    near = np.abs(at_a - at_b) <= band
    at_a, at_b = at_a[near], at_b[near]
    if len(at_a) < least * (n + m) / (1 + least) - 1e-9:
        return 0.0
    places = at_b[np.argsort(at_a)]
    if np.all(places[1:] > places[:-1]):
        aligned = len(places)
    else:
        tails: list[int] = []
        for p in places.tolist():
            i = bisect_left(tails, p)
            tails[i:i + 1] = [p]
        aligned = len(tails)
    return aligned / (n + m - aligned)


_SKETCH = pa.schema([("row", pa.int64()), ("text_key", pa.string()), ("kmers", pa.int32()),
                     ("elements", pa.list_(pa.int64()))])


def sketches(keyed: DataFrame) -> DataFrame:
    """(row, text_key, kmers, elements) of every row; ``text_key`` is the
    128-bit hash of the words (null without words)."""

    def run(batches):
        def rows():
            for row, text in rows_of(batches, ["row", "text"]):
                words, joined = word_hashes(text)
                found = kmers(words)
                yield row, xxhash.xxh3_128_hexdigest(joined) if joined else None, len(found), sketch(found)

        yield from emit(rows(), _SKETCH, 1024)

    return keyed.select("row", "text").mapInArrow(run, "row long, text_key string, kmers int, elements array<long>")


def _verified(pairs: DataFrame, texts: DataFrame, least: float, most: int) -> DataFrame:
    """The pairs (a, b), at most ``most``, of nodes whose texts align; ``texts``
    has node and text."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))

    def run(batches):
        def rows():
            last: tuple = (None, None)
            for a, b, x, y in rows_of(batches, ["a", "b", "text_a", "text_b"]):
                if last[0] != a:  # rows of one pivot follow each other
                    last = (a, kmers(word_hashes(x)[0]))
                if aligned_similarity(last[1], kmers(word_hashes(y)[0]), least) >= least:
                    yield a, b

        yield from emit(rows(), pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    joined = fewer_tasks(pairs.join(right, "b"), most, PAIRS_OF_TASK)
    joined = fewer_tasks(joined.join(left, "a").select("a", "b", "text_a", "text_b"), most, PAIRS_OF_TASK)
    return joined.mapInArrow(run, "a long, b long")


def _only_here(texts: DataFrame, n_members: int) -> DataFrame:
    """(node, alone): how many k-mers of a text no other text of ``texts`` has;
    the texts are in ``n_members`` groups altogether."""
    schema = pa.schema([("node", pa.int64()), ("kmer", pa.int64())])

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                found = [kmers(word_hashes(t)[0]) for t in part.column("text").to_pylist()]
                node = np.repeat(part.column("node").to_numpy(), [len(f) for f in found])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node), pa.array(np.concatenate(found).view(np.int64))], schema=schema)

    once = texts.mapInArrow(run, "node long, kmer long").groupBy("kmer").agg(
        F.min("node").alias("node"), F.count(F.lit(1)).alias("n")).filter("n = 1")
    return fewer_tasks(once, n_members, PAIRS_OF_TASK).groupBy("node").agg(F.count(F.lit(1)).alias("alone"))


def _block_links(table: pa.Table, least: float) -> pa.Table:
    """Links across components in one block of a group. The k-mers that two
    texts share bound what they can align, so only pairs that share enough
    are aligned."""
    node, component, chunk = (table.column(c).to_numpy() for c in ("node", "component", "chunk"))
    first, second = (table.column(c)[0].as_py() for c in ("low", "high"))
    apart = component[:, None] != component[None, :]
    if first != second:
        apart &= chunk[:, None] != chunk[None, :]
    found = [kmers(word_hashes(t)[0]) for t in table.column("text").to_pylist()] if apart.any() else []
    links: list[tuple[int, int]] = []
    if found:
        sizes = np.array([len(f) for f in found])
        owner = np.repeat(np.arange(len(found)), sizes)
        _, inverse, times = np.unique(np.concatenate(found), return_inverse=True, return_counts=True)
        several = times > 1
        column = np.cumsum(several) - 1
        keep = several[inverse]
        owner, column = owner[keep], column[inverse[keep]]
        shared = np.zeros((len(found), len(found)), np.float32)
        for at in range(0, int(several.sum()), 4096):  # a bounded part of the k-mers at a time
            part = (column >= at) & (column < at + 4096)
            held = np.zeros((len(found), 4096), np.float32)
            held[owner[part], column[part] - at] = 1
            shared += held @ held.T
        enough = shared >= least * (sizes[:, None] + sizes[None, :] - shared) - 1e-3
        for i, j in zip(*np.nonzero(np.triu(enough & apart, 1))):
            if aligned_similarity(found[i], found[j], least) >= least:
                links.append((int(node[i]), int(node[j])))
    return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})


def _small(df: DataFrame) -> DataFrame:
    """``df``, broadcast if it has few rows."""
    return F.broadcast(df) if df.limit(MAX_BROADCAST_ROWS + 1).count() <= MAX_BROADCAST_ROWS else df


def near_duplicates(keyed: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """(row, class_key) for every row of ``keyed``, a stored frame with a row
    number ``row`` and ``text``; class_key is null without words. A node is
    the first row of those with equal words."""
    rows = keep_on_shared_storage(sketches(keyed), "sketches")
    n_rows = rows.count()
    nodes = fewer_tasks(rows.filter("text_key is not null").groupBy("text_key").agg(
        F.min(F.struct("row", "kmers", "elements")).alias("n")), n_rows, SKETCHES_OF_TASK)
    # Elements that more than one node has; the others cannot link.
    members = nodes.select(F.col("n.row").alias("node"), F.col("n.kmers").alias("kmers"),
                           F.explode("n.elements").alias("element"))
    shared = members.groupBy("element").agg(F.min("node").alias("low"), F.max("node").alias("high")) \
        .filter("low < high").select("element")
    members = keep_on_shared_storage(fewer_tasks(
        members.join(shared, "element").select("element", "node", "kmers"), n_rows, SKETCHES_OF_TASK), "members")
    n_members = members.count()

    def fewer(df: DataFrame) -> DataFrame:
        return fewer_tasks(df, n_members, MEMBERS_OF_TASK)

    wanted = keep_on_shared_storage(fewer(members.select("node").distinct()), "nodes")
    texts = keep_on_shared_storage(fewer_tasks(keyed.select(F.col("row").alias("node"), "text").join(
        _small(wanted), "node").select("node", "text"), n_rows, SKETCHES_OF_TASK), "texts")
    links = None
    component = wanted.select(F.col("node").alias("id"), F.col("node").alias("component"))

    def link(pairs: DataFrame) -> None:
        add(_verified(fewer(fewer(pairs).distinct()), texts, least, n_members))  # a pivot's pairs: one for a member

    def add(new: DataFrame) -> None:
        nonlocal links, component
        found = keep_on_shared_storage(new, "links")
        if links is not None and found.isEmpty():
            return
        links = found if links is None else links.union(found)
        component = keep_on_shared_storage(
            fewer(connected_components(
                wanted.withColumnRenamed("node", "id"), links, n_edges=links.count())), "components")

    def open_groups(members: DataFrame) -> DataFrame:
        """Members of the groups with several components."""
        at = fewer(members.drop("component").join(component, members["node"] == component["id"]).drop("id"))
        several = at.groupBy("element").agg(F.min("component").alias("low"), F.max("component").alias("high")) \
            .filter("low < high").select("element")
        return keep_on_shared_storage(fewer(at.join(several, "element")), "open-groups")

    def pairs_of(members: DataFrame, pivots: DataFrame, *conditions) -> DataFrame:
        """Members beside their group's pivots, if their sizes allow a link."""
        pivots = pivots.select("element", *(F.col(c).alias(f"p_{c}") for c in pivots.columns if c != "element"))
        sizes = F.least("kmers", "p_kmers") >= F.lit(least) * F.greatest("kmers", "p_kmers")
        return members.join(pivots, "element").filter(reduce(Column.__and__, conditions, sizes)) \
            .select(F.col("p_node").alias("a"), F.col("node").alias("b"))

    first = members.groupBy("element").agg(F.min(F.struct("node", "kmers")).alias("p")).select("element", "p.*")
    link(pairs_of(members, first, F.col("node") != F.col("p_node")))
    at = open_groups(members)
    if not at.isEmpty():
        # A link leaves at most ``slack`` of both texts' k-mers unaligned, so at most as many may be in one text only.
        slack = (1 - least) / (1 + least) + 1e-9
        alone = _only_here(texts.join(_small(fewer(at.select("node").distinct())), "node"), n_members)
        at = keep_on_shared_storage(fewer(at.join(alone, "node", "left").na.fill(0, ["alone"])), "open-groups")
        apart = F.col("component") != F.col("p_component")
        bound = F.col("alone") + F.col("p_alone") <= F.lit(slack) * (F.col("kmers") + F.col("p_kmers"))
        light = F.col("alone") <= F.lit(slack) * F.col("kmers")  # one text of a link is light
        best = at.filter(light).groupBy("element").agg(F.min(F.struct(
            (F.col("alone") / F.col("kmers")).alias("share"), "node", "kmers", "component", "alone")).alias("p")) \
            .select("element", "p.node", "p.kmers", "p.component", "p.alone")
        link(pairs_of(at, best, apart, bound))
        # What is left is compared in blocks of a group, if it has a light text.
        at = open_groups(at)
        some = at.filter(light).groupBy("element").agg(F.min(F.col("alone") / F.col("kmers")).alias("least_share"))
        at = at.join(some, "element").filter(F.col("alone") <= F.lit(slack) * (
            F.col("kmers") * (1 + 1 / F.lit(least))) - F.col("least_share") * F.col("kmers") * F.lit(least))
        pieces = at.groupBy("element").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK_TEXTS)).cast("int").alias("pieces"))
        blocks = at.join(pieces, "element").withColumn("chunk", F.pmod(F.hash("node"), F.col("pieces"))) \
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).select(
                "element", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"),
                "chunk", "node", "component")
        add(fewer(blocks.join(texts, "node").groupBy("element", "low", "high").applyInArrow(
            lambda t: _block_links(t, least), "a long, b long").distinct()))
    first_rows = rows.filter("text_key is not null").groupBy("text_key").agg(F.min("row").alias("node"))
    told = fewer_tasks(first_rows.join(component, F.col("node") == component["id"], "left"), n_rows, SKETCHES_OF_TASK)
    return keep_on_shared_storage(fewer_tasks(rows.select("row", "text_key").join(
        told.select("text_key", F.coalesce("component", "node").alias("class_key")), "text_key", "left")
        .select("row", "class_key"), n_rows, SKETCHES_OF_TASK), "class-keys")


def classes(documents: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """(row, doc_id, class_key, first_row, class_id, n) of every row of a stored
    frame with ``row``, ``doc_id`` and ``text``; ``first_row`` is the row that
    stays of the class of ``n`` rows, ``class_id`` its id."""
    found = fewer_tasks(near_duplicates(documents.select("row", "text"), least).join(
        documents.select("row", "doc_id"), "row"), documents.count(), SKETCHES_OF_TASK)
    stays = found.filter("class_key is not null").groupBy("class_key").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first"),
        F.count(F.lit(1)).alias("n"))
    return fewer_tasks(found.join(stays, "class_key", "left"), documents.count(), SKETCHES_OF_TASK).select(
        "row", "doc_id", "class_key", F.coalesce("first.row", "row").alias("first_row"),
        F.when(F.col("first").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("class_id"),
        F.coalesce("n", F.lit(1)).alias("n"))


def _numbered(documents: DataFrame, *more) -> DataFrame:
    return keep_on_shared_storage(documents.select(F.monotonically_increasing_id().alias("row"), *more), "documents")


def class_of_documents(documents: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """(doc_id, class_id, class_size, kept) for every row; class_id is the
    smallest id of the class."""
    numbered = _numbered(documents, F.col("doc_id").cast("long").alias("doc_id"),
                         F.col("text").cast("string").alias("text"))
    return classes(numbered, least).select("doc_id", "class_id", F.col("n").alias("class_size"),
                                           (F.col("row") == F.col("first_row")).alias("kept"))


def deduplicate(documents: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The documents with one row of each class, all columns."""
    numbered = _numbered(documents, F.struct("*").alias("document"))
    told = classes(numbered.select("row", F.col("document.doc_id").cast("long").alias("doc_id"),
                                   F.col("document.text").cast("string").alias("text")), least)
    goes = keep_on_shared_storage(told.filter("row != first_row").select("row"), "copies")
    return numbered.join(_small(goes), "row", "left_anti").select("document.*")
