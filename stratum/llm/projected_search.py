"""Nearest neighbours through stable projections, kd-trees and a chi-square test.

Vectors are made unit vectors of one more dimension (scaled by the largest
length of their space, the new entry fills up), so that a larger inner product
with a query is a smaller distance. A Gaussian, hence 2-stable, matrix projects them to ``PROJECTED``
dimensions: the squared projected distance of two points is their squared
distance times a chi-square variable. A search takes up projected neighbours nearest
first and compares them exactly; it stops when a point nearer than the k-th
one found would have come earlier with probability ``CONFIDENCE``. Each true
neighbour is then found with at least that probability, whatever the data.

In Spark: a kd-tree over the projections of a sample (``FIT_ROWS``) cuts each
space (vectors of one number of dimensions, lengths within a factor of two) into
cells, every vector goes to its cell, and a cell above ``CELL_ROWS`` is dealt
into chunks. A query first looks into its own cell; the k-th product found
there rules out cells by the same test, and it is sent to all others. Each
(cell, chunk, block of queries) is one task's group: a kd-tree of the chunk's
projections, whose leaves each query takes up in order of distance. No group
holds more than ``CELL_ROWS`` vectors and ``QUERY_ROWS`` queries (about).

Copies of a vector are collapsed to their k + 1 smallest ids, as no query can
list more of them (one may be its own). Products are summed by one rule, so equal vectors have equal
scores, and ties go to the smaller id.

Defined cases: rows whose vec_id or vector is null, or whose vector is empty, zero, or holds
null, non-finite or (as products would overflow) entries from 1e150 on take no part. Vectors of
different lengths are not compared. Repeated rows count once; of an id with several vectors each
is a candidate, and a query of its own if the id is one. Rows with the query's id are not among
its candidates. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import keep_on_shared_storage

NEIGHBOURS, EVERY = 20, 20
PROJECTED = 8
CONFIDENCE = 0.97
#: Rows (about, by hash) that the cells are fitted on, and that a leaf of the fit needs.
FIT_ROWS, LEAST_FIT = 16_384, 32
#: Vectors of a chunk, queries of a block, vectors of a leaf of a chunk's tree.
CELL_ROWS, QUERY_ROWS, LEAF_ROWS = 8_192, 4_096, 256
_SLACK = 1e-9


def chi_square_cdf(x: float, degrees: int) -> float:
    """Share of a chi-square variable below ``x`` (series of the incomplete gamma function)."""
    if x <= 0:
        return 0.0
    a, x = degrees / 2, x / 2
    if x > a + 200 + 20 * math.sqrt(a):
        return 1.0
    term = total = math.exp(a * math.log(x) - x - math.lgamma(a + 1))
    k = 1
    while term > total * 1e-17:
        term *= x / (a + k)
        total += term
        k += 1
    return min(total, 1.0)


def stopping_ratio(confidence: float, degrees: int) -> float:
    """The test holds from this ratio of projected to true squared distance on."""
    if confidence >= 1:
        return math.inf
    low, high = 0.0, 1.0
    while chi_square_cdf(high, degrees) < confidence:
        high *= 2
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_cdf(middle, degrees) < confidence else (low, middle)
    return high


def _axes(dim: int, projected: int) -> np.ndarray:
    return np.random.default_rng((12, dim)).standard_normal((dim + 1, projected))


def _project(vectors: np.ndarray, longest: float, projected: int) -> np.ndarray:
    """Of vectors no longer than ``longest``, scaled and filled up to length 1."""
    unit = vectors / longest
    rest = np.sqrt(np.maximum(0.0, 1.0 - np.einsum("ij,ij->i", unit, unit)))
    return np.column_stack([unit, rest]) @ _axes(vectors.shape[1], projected)


def _project_queries(vectors: np.ndarray, projected: int) -> tuple[np.ndarray, np.ndarray]:
    """(projections of the directions, lengths)."""
    most = np.abs(vectors).max(axis=1, keepdims=True)
    length = most[:, 0] * np.sqrt(((vectors / most) ** 2).sum(axis=1))
    return (vectors / length[:, None]) @ _axes(vectors.shape[1], projected)[:-1], length


def _kd_tree(points: np.ndarray, leaf_rows: float) -> tuple[list[np.ndarray], list[tuple], np.ndarray, np.ndarray]:
    """(rows of each leaf, splits, low and high corners of the leaves' cells):
    medians of the widest dimension. A split is (dimension, value, left,
    right); a child is a split's index, or a leaf's complement."""
    leaves, splits, low, high = [], [], [], []
    unbounded = np.full(points.shape[1], np.inf)
    open_ = [(np.arange(len(points)), -unbounded, unbounded, None)]
    while open_:
        rows, a, b, parent = open_.pop()
        at = ~len(leaves)
        if len(rows) > leaf_rows:
            own = points[rows]
            k = int(np.argmax(own.max(axis=0) - own.min(axis=0)))
            value = float(np.median(own[:, k]))
            right = own[:, k] > value
            if right.any():  # else (nearly) all are equal there: one leaf
                at = len(splits)
                splits.append([k, value, None, None])
                for side, part in ((2, ~right), (3, right)):
                    c, d = a.copy(), b.copy()
                    (d if side == 2 else c)[k] = value
                    open_.append((rows[part], c, d, (at, side)))
        if at < 0:
            leaves.append(rows)
            low.append(a)
            high.append(b)
        if parent is not None:
            splits[parent[0]][parent[1]] = at
    return leaves, splits, np.array(low), np.array(high)


class Space:
    """Cells of the vectors of one number of dimensions and about one length."""

    def __init__(self, number: int, dim: int, band: int, longest: float, rows: int, sample: np.ndarray,
                 projected: int, cell_rows: int) -> None:
        self.number, self.dim, self.band, self.longest, self.rows, self.projected = number, dim, band, longest, rows, projected
        scale = rows / max(len(sample), 1)
        points = _project(sample, longest, projected) if len(sample) else np.zeros((0, projected))
        _, self.splits, self.low, self.high = _kd_tree(points, max(cell_rows / scale, LEAST_FIT))

    def cells(self, points: np.ndarray) -> np.ndarray:
        out = np.zeros(len(points), np.int32)
        open_ = [(0 if self.splits else -1, np.arange(len(points)))]
        while open_:
            at, rows = open_.pop()
            if at < 0:
                out[rows] = ~at
                continue
            k, value, left, right = self.splits[at]
            above = points[rows, k] > value
            open_ += [(left, rows[~above]), (right, rows[above])]
        return out

    def reached(self, points: np.ndarray, lengths: np.ndarray, bounds: np.ndarray, ratio: float) -> np.ndarray:
        """(queries x cells) that the test does not rule out."""
        least = bounds / (lengths * self.longest)  # cosine that a better neighbour has at least
        near = _outside(points, self.low, self.high) < ratio * _squared(least)[:, None] if ratio < math.inf \
            else np.ones((len(points), len(self.low)), bool)
        return near & (least <= 1 + _SLACK)[:, None]


def _squared(cosine: np.ndarray) -> np.ndarray:
    """Squared distances of unit vectors; no bound while fewer than k are found."""
    return np.where(cosine == -np.inf, np.inf, np.maximum(2 - 2 * np.maximum(cosine, -1.0), 0.0) + _SLACK)


def _outside(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances of points to boxes."""
    out = np.zeros((len(points), len(low)))
    for k in range(points.shape[1]):
        p = points[:, k, None]
        out += np.maximum(np.maximum(low[:, k] - p, p - high[:, k]), 0.0) ** 2
    return out


def _matrix(column, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _best(query: np.ndarray, row: np.ndarray, score: np.ndarray, tie: np.ndarray, k: int):
    """The first k of each query, by falling score, then by ``tie``."""
    order = np.lexsort((tie, -score, query))
    query, row, score, tie = query[order], row[order], score[order], tie[order]
    head = np.flatnonzero(np.append(True, query[1:] != query[:-1])) if len(query) else np.zeros(0, np.int64)
    rank = np.arange(len(query)) - np.repeat(head, np.diff(np.append(head, len(query))))
    kept = rank < k
    return query[kept], row[kept], score[kept], tie[kept]


def _search(candidates: pa.Table, queries: pa.Table, spaces: list[Space], ratio: float, k: int) -> pa.Table:
    """Rows (query_id, query, vec_id, score): each query's best of one chunk."""
    schema = pa.schema([("query_id", pa.int64()), ("query", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
    if not len(candidates) or not len(queries):
        return schema.empty_table()
    space = spaces[candidates.column("space")[0].as_py()]
    vectors, wanted = _matrix(candidates.column("v"), space.dim), _matrix(queries.column("v"), space.dim)
    ids = candidates.column("ids").to_pylist()
    query_id = queries.column("query_id").to_numpy()
    bound = queries.column("bound").to_numpy()
    points = _project(vectors, space.longest, space.projected)
    directions, lengths = _project_queries(wanted, space.projected)
    leaves = _kd_tree(points, LEAF_ROWS)[0]
    low = np.array([points[rows].min(axis=0) for rows in leaves])
    high = np.array([points[rows].max(axis=0) for rows in leaves])
    away = _outside(directions, low, high)
    turn = np.argsort(away, axis=1)
    # A vector that only the query's own row holds is no candidate of it.
    first = np.array([own[0] for own in ids])
    second = np.array([own[1] if len(own) > 1 else -1 for own in ids])
    single = np.array([len(own) == 1 for own in ids])
    slack = 1e-12 * lengths * space.longest
    found = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.float64, np.int64))
    kth = bound.copy()
    active = np.arange(len(wanted))
    for step in range(len(leaves)):
        leaf = turn[active, step]
        still = away[active, leaf] < ratio * _squared(kth[active] / (lengths[active] * space.longest)) \
            if ratio < math.inf else np.ones(len(active), bool)
        active, leaf = active[still], leaf[still]
        if not len(active):
            break
        new_query, new_row = [], []
        for own in np.unique(leaf):
            asking, rows = active[leaf == own], leaves[own]
            near = wanted[asking] @ vectors[rows].T >= (kth[asking] - slack[asking])[:, None]
            q, r = np.nonzero(near)
            new_query.append(asking[q])
            new_row.append(rows[r])
        q, r = np.concatenate(new_query), np.concatenate(new_row)
        other = ~(single[r] & (first[r] == query_id[q]))
        q, r = q[other], r[other]
        score = np.concatenate([np.zeros(0)] + [(wanted[q[a:a + 65536]] * vectors[r[a:a + 65536]]).sum(axis=1)
                                                for a in range(0, len(q), 65536)])
        tie = np.where(first[r] == query_id[q], second[r], first[r])
        inside = score >= kth[q]
        found = _best(*(np.concatenate([x, y[inside]]) for x, y in zip(found, (q, r, score, tie))), k)
        full = np.bincount(found[0], minlength=len(wanted)) == k
        worst = np.full(len(wanted), np.inf)
        np.minimum.at(worst, found[0], found[2])
        kth = np.where(full, np.maximum(bound, worst), kth)
    q, r, score, _ = found
    rows = [(i, x, s) for i, own, s in zip(q.tolist(), r.tolist(), score.tolist()) for x in ids[own] if x != query_id[i]]
    if not rows:
        return schema.empty_table()
    q, x, s = (np.array(c) for c in zip(*rows))
    q, x, s, _ = _best(q, x, s, x, k)
    return pa.table({"query_id": query_id[q], "query": queries.column("query").to_numpy()[q], "vec_id": x, "score": s},
                    schema=schema)


def sound_rows(embeddings: DataFrame) -> DataFrame:
    """(vec_id, v, length, dim, band) of the rows that take part, each once."""
    sound = F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) \
        & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < 1e150)) & F.exists("v", lambda c: c != 0)
    most = F.array_max(F.transform("v", F.abs))
    total = F.aggregate("v", F.lit(0.0), lambda s, c: s + (c / F.col("most")) * (c / F.col("most")))
    return embeddings.select(F.col("vec_id").cast("long").alias("vec_id"),
                             F.transform("embedding", lambda c: c.cast("double") + F.lit(0.0)).alias("v")) \
        .filter(sound).distinct().withColumn("most", most).withColumn("length", F.col("most") * F.sqrt(total)).drop("most") \
        .withColumns({"dim": F.size("v"), "band": F.floor(F.log2("length") + F.lit(0.5)).cast("int")})


def _spaces(nodes: DataFrame, fit_rows: int, projected: int, cell_rows: int) -> list[Space]:
    known = nodes.groupBy("dim", "band").agg(F.count(F.lit(1)).alias("n"), F.max("length").alias("longest")) \
        .orderBy("dim", "band").collect()
    total = sum(row["n"] for row in known)
    share = min(1.0, fit_rows / max(total, 1))
    sample: dict[tuple, list] = {}
    for row in nodes.filter(F.pmod(F.xxhash64("v"), F.lit(1 << 20)) < int(share * (1 << 20))).select("dim", "band", "v").collect():
        sample.setdefault((row[0], row[1]), []).append(row[2])
    spaces = []
    for i, row in enumerate(known):
        own = np.array(sample.get((row["dim"], row["band"]), np.zeros((0, row["dim"]))), np.float64)
        spaces.append(Space(i, row["dim"], row["band"], row["longest"], row["n"], own, projected, cell_rows))
    return spaces


def _placed(nodes: DataFrame, held, projected: int) -> DataFrame:
    """Nodes with their space and cell."""
    schema = pa.schema([("space", pa.int32()), ("cell", pa.int32()), ("ids", pa.list_(pa.int64())), ("v", pa.list_(pa.float64()))])

    def run(batches):
        of = {(s.dim, s.band): s for s in held.value}
        for batch in batches:
            keys = list(zip(batch.column("dim").to_pylist(), batch.column("band").to_pylist()))
            for key in sorted(set(keys)):
                rows = pa.array([i for i, x in enumerate(keys) if x == key])
                space, v = of[key], batch.column("v").take(rows)
                cell = space.cells(_project(_matrix(v, space.dim), space.longest, projected))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(cell), space.number, np.int32)), pa.array(cell),
                    batch.column("ids").take(rows).cast(schema.field("ids").type), v.cast(schema.field("v").type)], schema=schema)

    return nodes.select("dim", "band", "ids", "v").mapInArrow(run, "space int, cell int, ids array<long>, v array<double>")


def _routed(queries: DataFrame, held, ratio: float | None, projected: int) -> DataFrame:
    """Queries with each cell to look into: without ``ratio`` their own one, in
    the space of their number of dimensions that has most vectors."""
    schema = pa.schema([("query_id", pa.int64()), ("query", pa.int64()), ("v", pa.list_(pa.float64())), ("bound", pa.float64()),
                        ("space", pa.int32()), ("cell", pa.int32())])

    def run(batches):
        by_dim: dict[int, list[Space]] = {}
        for s in held.value:
            by_dim.setdefault(s.dim, []).append(s)
        for batch in batches:
            dims = np.array(batch.column("dim").to_pylist())
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                part = batch.take(pa.array(at))
                directions, lengths = _project_queries(_matrix(part.column("v"), int(dim)), projected)
                bounds = part.column("bound").to_numpy(zero_copy_only=False)
                spaces = by_dim[int(dim)]
                if ratio is None:
                    home = max(spaces, key=lambda s: s.rows)
                    pairs = [(home.number, np.arange(len(at)), home.cells(directions))]
                else:
                    pairs = [(s.number, *np.nonzero(s.reached(directions, lengths, bounds, ratio))) for s in spaces]
                for number, rows, cells in pairs:
                    for a in range(0, len(rows), 4096):
                        own = part.select(["query_id", "query", "v", "bound"]).take(pa.array(rows[a:a + 4096]))
                        yield pa.RecordBatch.from_arrays(
                            [c.cast(f.type) for c, f in zip(own.columns, schema)]
                            + [pa.array(np.full(own.num_rows, number, np.int32)), pa.array(cells[a:a + 4096].astype(np.int32))],
                            schema=schema)

    return queries.select("query_id", "query", "v", "bound", "dim").mapInArrow(
        run, "query_id long, query long, v array<double>, bound double, space int, cell int")


def _compared(asked: DataFrame, placed: DataFrame, pieces: DataFrame, held, ratio: float, k: int, query_rows: int) -> DataFrame:
    """``asked`` (queries with space, cell and chunk) against the chunks' vectors,
    in blocks of queries."""
    blocks = asked.groupBy("space", "cell", "chunk").agg(F.ceil(F.count(F.lit(1)) / F.lit(query_rows)).cast("int").alias("blocks"))
    keys = ["space", "cell", "chunk", "block"]
    left = placed.join(blocks, keys[:3]).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .select(*keys, "ids", "v")
    right = asked.join(blocks, keys[:3]).withColumn("block", F.pmod(F.xxhash64("query_id", "query"), F.col("blocks")).cast("int")) \
        .select(*keys, "query_id", "query", "v", "bound")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        lambda c, q: _search(c, q, held.value, ratio, k), "query_id long, query long, vec_id long, score double")


def nearest(embeddings: DataFrame, k: int = NEIGHBOURS, every: int = EVERY, confidence: float = CONFIDENCE,
            projected: int = PROJECTED, fit_rows: int = FIT_ROWS, cell_rows: int = CELL_ROWS,
            query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest inner products found
    for every row whose id ``every`` divides."""
    spark = embeddings.sparkSession
    rows = keep_on_shared_storage(sound_rows(embeddings), "vectors")
    by_vector = Window.partitionBy("v").orderBy("vec_id")
    nodes = rows.withColumn("place", F.row_number().over(by_vector)).filter(F.col("place") <= k + 1) \
        .groupBy("v", "length", "dim", "band").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    nodes = keep_on_shared_storage(nodes, "nodes")
    spaces = _spaces(nodes, fit_rows, projected, cell_rows)
    held = spark.sparkContext.broadcast(spaces)
    placed = keep_on_shared_storage(_placed(nodes, held, projected), "placed")
    pieces = placed.groupBy("space", "cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(cell_rows)).cast("int").alias("pieces"))
    placed = placed.join(pieces, ["space", "cell"]).withColumn("chunk", F.pmod(F.xxhash64("v"), F.col("pieces")).cast("int"))
    queries = rows.filter(F.pmod("vec_id", F.lit(every)) == 0) \
        .select(F.col("vec_id").alias("query_id"), F.xxhash64("v").alias("query"), "v", "dim", F.lit(float("-inf")).alias("bound"))
    ratio = stopping_ratio(confidence, projected)
    home = _routed(queries, held, None, projected).withColumn("chunk", F.lit(0))
    seen = _compared(home, placed, pieces, held, ratio, k, query_rows)
    bounds = seen.groupBy("query_id", "query").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n")).filter(F.col("n") >= k)
    queries = queries.drop("bound").join(bounds, ["query_id", "query"], "left") \
        .withColumn("bound", F.coalesce("least", F.lit(float("-inf"))))
    asked = keep_on_shared_storage(_routed(queries, held, ratio, projected), "routed")
    asked = asked.join(pieces, ["space", "cell"]).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    found = _compared(asked, placed, pieces, held, ratio, k, query_rows)
    best = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), F.asc("vec_id"))
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
