"""Near-duplicate vectors by a forest of random-projection trees.

Each tree splits the unit vectors again and again at the median of a random
projection; vectors near a split go to both sides (spill), so close pairs are
seldom parted, and many trees make up for the rest. Vectors of one label are
compared within leaves by cosine in double precision; a pair that meets in
several leaves counts in the first of them only. Links make components.

A median would part most pairs of a large dense group, in every tree. So links
among the sample's rows with very many neighbours are watched: a split that
would part more than ``LOST`` of them moves off the median, and a node where
every place would is not split (its blocks compare all its pairs, the square
of the group's size, in the first tree; later trees skip pairs already met).

The trees are fitted on a bounded sample of the vectors (``FIT_ROWS``), every
vector goes down every tree. Where the sample was too small for the table, leaves
hold more than ``LARGE`` vectors: each of these gets a sample of its own
(``LEAF_FIT_ROWS``), is split further by its own subtree, in tasks, and its
vectors go on down; that repeats until no leaf but those of dense groups is
large, so leaves do not grow with the table. Equal vectors of one label are collapsed first.
A leaf with more vectors of one label than ``GROUP_ROWS`` is compared in
blocks, so no task holds an unbounded leaf, and a dense group gives sums and a
spanning forest, not its pairs.

Defined cases: a row whose id, label or vector is null, or whose vector is
empty, zero or holds null or non-finite components links with nothing and is
its own component. Vectors of different lengths never link. Repeated rows are
vectors of their own that link with each other, and an id may come with several
vectors: each is a row of its own. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, keep_on_shared_storage

COSINE = 0.93
TREES = 8
#: Rows that the trees are fitted on at most (about; chosen by hash).
FIT_ROWS = 16_384
#: A leaf is split while more rows than this are expected in it.
LEAF_ROWS = 1_024
#: Share of a node's rows on either side of the median that goes to both.
SPILL = 0.05
#: Rows of one label and leaf that are compared in one block.
GROUP_ROWS = 1_024
MAX_DEPTH, LEAST_FIT = 38, 16
#: Rows of a leaf above which it is split again, rows that this is fitted on, and rows routed by one task.
LARGE, LEAF_FIT_ROWS, ROUTE_ROWS = 4 * LEAF_ROWS, 4_096, 32_768
#: A row with so many expected neighbours belongs to a dense group; sample rows
#: looked at for that, and how many of them are watched at most.
DENSE_ROWS, CANDIDATES, WATCHED = LEAF_ROWS // 2, 4_096, 1_024
#: Share of the watched links that one split may part.
LOST = 0.03
#: Places of a split (quantile, spill) in the order they are tried.
PLACES = [(q, s) for s in (SPILL, 2 * SPILL) for q in (0.5, 0.4, 0.6, 0.3, 0.7, 0.2, 0.8)]


def _direction(dim: int, tree: int, depth: int) -> np.ndarray:
    v = np.random.default_rng((dim, tree, depth)).standard_normal(dim)
    return v / np.linalg.norm(v)


class Watched:
    """Rows of dense groups in the sample, and which of them link."""

    def __init__(self, sample: np.ndarray, rows_of_sample: float) -> None:
        some = np.random.default_rng(len(sample)).permutation(len(sample))[:CANDIDATES]
        unit = sample.astype(np.float32)
        near = np.concatenate([np.zeros(0, np.int64)] + [
            (unit[some[a:a + 256]] @ unit.T >= COSINE).sum(axis=1) for a in range(0, len(some), 256)])
        rows = some[(near - 1) * rows_of_sample >= DENSE_ROWS][:WATCHED]
        self.at = np.full(len(sample), -1)
        self.at[rows] = np.arange(len(rows))
        self.linked = unit[rows] @ unit[rows].T >= COSINE
        np.fill_diagonal(self.linked, False)

    def place(self, rows: np.ndarray, projected: np.ndarray) -> tuple[float, float] | None:
        """Where to split a node's rows, None if that parts links everywhere."""
        own = self.at[rows]
        projected_own, own = projected[own >= 0], own[own >= 0]
        linked = self.linked[np.ix_(own, own)]
        degree = linked.sum(axis=1)
        for middle, spill in PLACES:
            low, high = np.quantile(projected, (middle - spill, middle + spill))
            below, above = projected_own < low, projected_own > high
            parted = linked[np.ix_(below, above)]
            lost = (parted.sum(axis=1) / np.maximum(degree[below], 1)).sum() \
                + (parted.sum(axis=0) / np.maximum(degree[above], 1)).sum()
            if lost <= LOST * np.count_nonzero(degree):
                return float(low), float(high)
        return None


class Tree:
    """Split points by path: a path is 1, then a binary digit for each step."""

    def __init__(self, sample: np.ndarray, tree: int, rows_of_sample: float, watched: Watched | None = None,
                 root: int = 1, leaf_rows: int | None = None) -> None:
        leaf_rows = leaf_rows or LEAF_ROWS
        self.tree, self.root, self.splits = tree, root, {}
        self.whole: set[int] = set()  # paths that no split would help
        watched = watched or Watched(sample, rows_of_sample)
        open_ = [(root, root.bit_length() - 1, np.arange(len(sample)))]
        while open_:
            path, depth, rows = open_.pop()
            if depth >= MAX_DEPTH:
                self.whole.add(path)
            if len(rows) * rows_of_sample <= leaf_rows or len(rows) < LEAST_FIT or depth >= MAX_DEPTH:
                continue
            projected = sample[rows] @ _direction(sample.shape[1], tree, depth)
            place = watched.place(rows, projected)
            if place is None:
                self.whole.add(path)
                continue  # a dense group: blocks do the rest
            low, high = place
            left, right = rows[projected <= high], rows[projected >= low]
            if len(left) == len(rows) or len(right) == len(rows):
                self.whole.add(path)
                continue  # (nearly) equal projections: blocks do the rest
            self.splits[path] = place
            open_ += [(2 * path, depth + 1, left), (2 * path + 1, depth + 1, right)]

    def leaves(self, unit: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
        """(rows, leaf) for every leaf that some rows reach."""
        open_ = [(self.root, self.root.bit_length() - 1, np.arange(len(unit)))]
        while open_:
            path, depth, rows = open_.pop()
            split = self.splits.get(path)
            if split is None:
                yield rows, self.tree << _TREE_BITS | path
                continue
            projected = unit[rows] @ _direction(unit.shape[1], self.tree, depth)
            for side, inside in ((0, projected <= split[1]), (1, projected >= split[0])):
                if inside.any():
                    open_.append((2 * path + side, depth + 1, rows[inside]))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.array(column.to_pylist(), np.float64).reshape(len(column), dim)


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    dims = np.array([len(v) for v in batch.column("vector").to_pylist()])
    for dim in np.unique(dims):
        yield int(dim), batch.take(pa.array(np.flatnonzero(dims == dim)))


def _nodes(rows: DataFrame) -> DataFrame:
    """``rows`` with the name of their vector and label, equal for equal ones."""

    def run(batches):
        schema = pa.schema([("vec_id", pa.int64()), ("label", pa.string()), ("vector", pa.list_(pa.float64())), ("node", pa.string())])
        for batch in batches:
            named = [f"{label}:" + xxhash.xxh3_128_hexdigest(np.array(vector, np.float64).tobytes())
                     for label, vector in zip(batch.column("label").to_pylist(), batch.column("vector").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(f.name).cast(f.type) for f in list(schema)[:3]]
                                             + [pa.array(named, pa.string())], schema=schema)

    return rows.mapInArrow(run, "vec_id long, label string, vector array<double>, node string")


def _forest(nodes: DataFrame, fit_rows: int, trees: int) -> dict[int, list[Tree]]:
    total = nodes.count()
    share = min(1.0, fit_rows / max(total, 1))
    sample = nodes.filter(F.pmod(F.xxhash64("node"), F.lit(1 << 20)) < int(share * (1 << 20))) \
        .select("vector").collect()
    by_dim: dict[int, list] = {}
    for row in sample:
        by_dim.setdefault(len(row[0]), []).append(row[0])
    forest = {}
    for dim, vectors in by_dim.items():
        unit = np.array(vectors, np.float64)
        unit /= np.linalg.norm(unit, axis=1, keepdims=True)
        scale = total / max(len(sample), 1)
        watched = Watched(unit, scale)
        forest[dim] = [Tree(unit, t, scale, watched) for t in range(trees)]
    return forest


def _assign(nodes: DataFrame, forest: dict[int, list[Tree]]) -> DataFrame:
    """``nodes`` with all their leaves, in ascending order."""
    held = nodes.sparkSession.sparkContext.broadcast(forest)
    schema = pa.schema([("node", pa.string()), ("label", pa.string()), ("vector", pa.list_(pa.float64())),
                        ("copies", pa.int64()), ("leaves", pa.list_(pa.int64()))])

    def run(batches):
        for batch in batches:
            for dim, part in _by_length(batch):
                unit = _matrix(part.column("vector"), dim)
                unit /= np.linalg.norm(unit, axis=1, keepdims=True)
                leaves: list[list[int]] = [[] for _ in range(len(unit))]
                for tree in held.value.get(dim, ()):
                    for rows, leaf in tree.leaves(unit):
                        for i in rows.tolist():
                            leaves[i].append(leaf)
                yield pa.RecordBatch.from_arrays(
                    [part.column(c).cast(schema.field(c).type) for c in ("node", "label", "vector", "copies")]
                    + [pa.array([sorted(x) or [0] for x in leaves], pa.list_(pa.int64()))], schema=schema)

    return nodes.select("node", "label", "vector", "copies").mapInArrow(
        run, "node string, label string, vector array<double>, copies long, leaves array<long>")


_TREE_BITS = 40


def _unit(column) -> np.ndarray:
    vectors = np.array(column.to_pylist(), np.float64)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _fit_leaf(table: pa.Table, leaf_rows: int) -> pa.Table:
    """The subtree of one large leaf, from its sample."""
    leaf, n, unit = table["leaf"][0].as_py(), table["n"][0].as_py(), _unit(table["vector"])
    own = Tree(unit, leaf >> _TREE_BITS, n / len(unit), root=(leaf & (1 << _TREE_BITS) - 1) or 1,
               leaf_rows=leaf_rows)
    paths = sorted(own.splits)
    whole = sorted(own.whole | (set() if own.splits else {own.root}))
    return pa.table({"dim": table["dim"][:1], "leaf": table["leaf"][:1], "n": table["n"][:1],
                     "paths": pa.array([paths], pa.list_(pa.int64())),
                     "low": pa.array([[own.splits[p][0] for p in paths]], pa.list_(pa.float64())),
                     "high": pa.array([[own.splits[p][1] for p in paths]], pa.list_(pa.float64())),
                     "whole": pa.array([[leaf >> _TREE_BITS << _TREE_BITS | p for p in whole] + [leaf] * (not own.splits)],
                                       pa.list_(pa.int64()))})


def _route(subtree: pa.Table, rows: pa.Table) -> pa.Table:
    """(node, leaf, below): the leaves of the subtree that some of its rows reach."""
    schema = pa.schema([("node", pa.string()), ("leaf", pa.int64()), ("below", pa.list_(pa.int64()))])
    if not len(subtree) or not len(rows):
        return schema.empty_table()
    leaf, unit = subtree["leaf"][0].as_py(), _unit(rows["vector"])
    own = Tree.__new__(Tree)
    own.tree, own.root = leaf >> _TREE_BITS, (leaf & (1 << _TREE_BITS) - 1) or 1
    own.splits = dict(zip(subtree["paths"][0].as_py(), zip(subtree["low"][0].as_py(), subtree["high"][0].as_py())))
    below: list[list[int]] = [[] for _ in range(len(unit))]
    for some, reached in own.leaves(unit):
        for i in some.tolist():
            below[i].append(reached)
    return pa.table([rows["node"].combine_chunks(), pa.array(np.full(len(unit), leaf)), pa.array(below, pa.list_(pa.int64()))],
                    schema=schema)


def _refined(placed: DataFrame, forest: dict[int, list[Tree]]) -> DataFrame:
    """``placed`` with large leaves split further, until only those are large that no split helps."""
    spark, leaf_rows = placed.sparkSession, LEAF_ROWS
    done = spark.createDataFrame([(dim, tree.tree << _TREE_BITS | path) for dim, trees in forest.items()
                                  for tree in trees for path in tree.whole], "dim int, leaf long")
    while True:
        where = placed.select("node", "vector", F.size("vector").alias("dim"), F.explode("leaves").alias("leaf"))
        large = keep_on_shared_storage(
            where.groupBy("dim", "leaf").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > LARGE)
            .join(done, ["dim", "leaf"], "left_anti"), "large-leaves")
        if large.isEmpty():
            return placed
        rows = where.join(large, ["dim", "leaf"])
        share = F.pmod(F.xxhash64("node", "leaf"), F.lit(1 << 30)) < (F.lit(float(LEAF_FIT_ROWS)) / F.col("n") * (1 << 30))
        subtrees = keep_on_shared_storage(rows.filter(share).groupBy("dim", "leaf").applyInArrow(
            lambda t: _fit_leaf(t, leaf_rows), "dim int, leaf long, n long, paths array<long>, low array<double>, high array<double>, whole array<long>"),
            "subtrees")
        chunks = F.ceil(F.col("n") / F.lit(ROUTE_ROWS)).cast("int")
        left = subtrees.withColumn("chunk", F.explode(F.sequence(F.lit(0), chunks - 1)))
        right = rows.withColumn("chunk", F.pmod(F.hash("node"), chunks)).select("dim", "leaf", "chunk", "node", "vector")
        keys = ["dim", "leaf", "chunk"]
        moved = left.select(*keys, "paths", "low", "high").groupBy(*keys).cogroup(right.groupBy(*keys)) \
            .applyInArrow(_route, "node string, leaf long, below array<long>") \
            .groupBy("node").agg(F.collect_list("leaf").alias("from"), F.flatten(F.collect_list("below")).alias("to"))
        leaves = F.array_sort(F.concat(F.array_except("leaves", "from"), "to"))
        placed = keep_on_shared_storage(placed.join(moved, "node", "left").select(
            "node", "label", "vector", "copies", F.when(F.col("to").isNotNull(), leaves).otherwise(F.col("leaves")).alias("leaves")),
            "leaves")
        done = done.union(subtrees.select("dim", F.explode("whole").alias("leaf")))


def _compare(table: pa.Table, least: float) -> pa.Table:
    """Links of one block: for each node the rows it links with in this leaf
    first, and the smallest node (of this block) that links lead to."""
    leaf = table.column("leaf")[0].as_py()
    first, second = (table.column(c)[0].as_py() for c in ("low", "high"))
    chunk = table.column("chunk").to_numpy()
    nodes = np.array(table.column("node").to_pylist())
    order = np.argsort(nodes)
    nodes, chunk = nodes[order], chunk[order]
    table = table.take(pa.array(order))
    vectors = np.array(table.column("vector").to_pylist(), np.float64)
    copies = table.column("copies").to_numpy().astype(np.float64)
    norms = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
    n = len(nodes)
    # Earlier leaves that two nodes share: their pair counts there.
    leaves = table.column("leaves").to_pylist()
    index: dict[int, int] = {}
    at = [(i, index.setdefault(x, len(index))) for i, own in enumerate(leaves) for x in own if x < leaf]
    earlier = np.zeros((n, len(index)), np.float32)
    if at:
        earlier[tuple(np.array(at).T)] = 1
    # Rows of one earlier leaf met there, all of them: only the rest is compared, with every row.
    met = earlier[:, earlier.sum(axis=0).argmax()] > 0 if len(index) else np.zeros(n, bool)
    rest = np.flatnonzero(~met)
    linked = np.zeros((n, n), bool)
    links = np.zeros(n)
    for a in range(0, len(rest), 256):
        part = rest[a:a + 256]
        cosine = (vectors[part] @ vectors.T) / (norms[part, None] * norms)
        near = cosine >= least
        near[np.arange(len(part)), part] = False
        if first != second:
            near &= chunk[part, None] != chunk[None, :]
        linked[part] = near
        linked[np.ix_(met, part)] = near[:, met].T
        if len(index):
            near = near & (earlier[part] @ earlier.T == 0)
        links[part] = near @ copies
        links[met] += copies[part] @ near[:, met]
    label = np.arange(n)
    while True:  # smallest node that links lead to
        low = np.where(linked, label[None, :], n).min(axis=1, initial=n)
        new = np.minimum(label, low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    return pa.table({"node": pa.array(nodes.tolist()), "links": pa.array(links.astype(np.int64)),
                     "lowest": pa.array(nodes[label].tolist())})


def link_vectors(embeddings: DataFrame, least: float = COSINE, trees: int = TREES, fit_rows: int = FIT_ROWS,
                 group_rows: int = GROUP_ROWS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row."""
    vector = F.transform(F.col("embedding"), lambda x: x.cast("double"))
    sound = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() \
        & (F.size("vector") > 0) & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) \
        & F.exists("vector", lambda x: x != 0)
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
                             vector.alias("vector"))
    sound_rows = rows.filter(sound)
    named = keep_on_shared_storage(_nodes(sound_rows), "vector-nodes")
    # The vector of a node comes with it: an id may stand for several vectors.
    nodes = keep_on_shared_storage(named.groupBy("node").agg(
        F.first("label").alias("label"), F.first("vector").alias("vector"), F.count(F.lit(1)).alias("copies"),
        F.min("vec_id").alias("lowest_id")), "vectors")
    forest = _forest(nodes, fit_rows, trees)
    placed = _refined(keep_on_shared_storage(_assign(nodes, forest), "leaves"), forest)
    where = placed.select("node", "label", F.size("vector").alias("dim"), F.explode("leaves").alias("leaf"))
    pieces = where.groupBy("leaf", "label", "dim").agg(F.count(F.lit(1)).alias("n")).filter("n > 1") \
        .withColumn("pieces", F.ceil(F.col("n") / F.lit(group_rows)).cast("int"))
    wide = placed.select("*", F.size("vector").alias("dim"), F.explode("leaves").alias("leaf")) \
        .join(pieces, ["leaf", "label", "dim"]) \
        .withColumn("chunk", F.pmod(F.hash("node"), F.col("pieces"))) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))) \
        .withColumns({"low": F.least("chunk", "other"), "high": F.greatest("chunk", "other")})
    blocks = keep_on_shared_storage(
        wide.select("leaf", "label", "dim", "low", "high", "chunk", "node", "vector", "copies", "leaves")
        .groupBy("leaf", "label", "dim", "low", "high")
        .applyInArrow(lambda t: _compare(t, least), "node string, links long, lowest string"), "links")
    links = blocks.groupBy("node").agg(F.sum("links").alias("links"))
    component = connected_components(
        nodes.select(F.col("node").alias("id")),
        blocks.filter("node != lowest").select(F.col("node").alias("a"), F.col("lowest").alias("b")).distinct())
    component = component.withColumnRenamed("id", "node")
    known = nodes.select("node", "copies", "lowest_id").join(component, "node").join(links, "node", "left")
    smallest = known.groupBy("component").agg(F.min("lowest_id").alias("component_id"))
    told = known.join(smallest, "component").select(
        "node", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    found = named.select("vec_id", "node").join(told, "node").select("vec_id", "n_links", "component_id")
    alone = rows.filter(~F.coalesce(sound, F.lit(False))).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return found.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
