"""Embedding whitening by pivoted Cholesky and one-sided Jacobi.

Entries become whole numbers (``floor(64 c) + 1000000``). Over the distinct
vectors Spark sums counts and entries exactly, then the products of centred
entries: each task adds up its own scatter, and Spark adds up the tasks'. The
scatter (the square of the vectors' length, whatever the number of rows) is
factored on the driver: Cholesky with the largest remaining diagonal entry as
pivot gives a triangular factor, and Jacobi rotations of that factor's columns
make them orthogonal. The squared lengths of the rotated columns are then the
eigenvalues, the columns at unit length the components. All rows are projected
on the leading components in tasks; the covariance of the projected distinct
vectors is summed again and held against the identity.

Defined cases: rows whose vector is null, empty, or holds null or non-finite
entries, or entries from 2**56 on (whose numbers no long holds), are dropped. Vectors of
different lengths are whitened apart, each length by its own fit. Equal
vectors count once in the fit and all get their rows; a null vec_id stays.
There are as many components as directions with variance (above ``RANK`` of
the largest), 16 at most: none for one distinct vector or an empty table. Of
equal eigenvalues any order may come. The deviation is null where it exceeds a
long. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep_on_shared_storage

COMPONENTS = 16
#: Fixed values of the contract: x = floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Largest entry (exclusive) whose number is held in a long with room to centre it.
LARGEST = float(1 << 56)
#: A pivot below this share of the first one is no direction of its own.
RANK = 1e-11
MAX_SWEEPS = 60
#: Rows projected together.
BLOCK = 2_048


def pivoted_cholesky(a: np.ndarray, rank: float = RANK) -> tuple[np.ndarray, np.ndarray]:
    """(factor, order): ``a[order][:, order] = factor @ factor.T`` with a lower
    triangular factor, as many columns as pivots above ``rank`` of the first."""
    a, size = np.array(a, np.float64), len(a)
    order, factor = np.arange(size), np.zeros((size, size))
    least = rank * max(a.diagonal().max(initial=0.0), 0.0)
    for k in range(size):
        p = k + int(np.argmax(a.diagonal()[k:]))
        if not a[p, p] > least:
            return factor[:, :k], order
        for m in (a, a.T, factor):
            m[[k, p]] = m[[p, k]]
        order[[k, p]] = order[[p, k]]
        factor[k:, k] = a[k:, k] / np.sqrt(a[k, k])
        a[k + 1:, k + 1:] -= np.outer(factor[k + 1:, k], factor[k + 1:, k])
    return factor, order


def _rounds(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """All pairs of ``n`` (even) columns, in rounds of pairs that share none."""
    seats, out = list(range(n)), []
    for _ in range(n - 1):
        out.append((np.array(seats[:n // 2]), np.array(seats[n // 2:][::-1])))
        seats = [seats[0], seats[-1], *seats[1:-1]]
    return out


def rotated_columns(factor: np.ndarray) -> np.ndarray:
    """``factor`` times the rotations that make its columns orthogonal to
    double precision, the longest column first."""
    w = np.hstack([factor, np.zeros((len(factor), factor.shape[1] % 2))])
    rounds = _rounds(w.shape[1]) if w.shape[1] else []
    least = np.finfo(np.float64).eps
    for _ in range(MAX_SWEEPS):
        turned = False
        for p, q in rounds:
            a, b = w[:, p], w[:, q]
            own, other, both = (a * a).sum(0), (b * b).sum(0), (a * b).sum(0)
            turn = np.abs(both) > least * np.sqrt(own * other)
            if not turn.any():
                continue
            turned = True
            half = np.divide(other - own, 2 * both, out=np.zeros_like(both), where=turn)
            tangent = np.where(turn, np.where(half < 0, -1.0, 1.0) / (np.abs(half) + np.hypot(1.0, half)), 0.0)
            cosine = 1 / np.hypot(1.0, tangent)
            w[:, p], w[:, q] = cosine * (a - tangent * b), cosine * (b + tangent * a)
        if not turned:
            break
    w = w[:, (w * w).sum(0) > 0]
    return w[:, np.argsort(-(w * w).sum(0), kind="stable")]


@dataclass
class Fit:
    """What is known of the vectors of one length; ``middle`` is the whole part
    of the mean, ``rest / n`` what remains of it."""

    n: int
    sums: list[int]
    middle: np.ndarray = field(init=False)
    rest: np.ndarray = field(init=False)
    components: np.ndarray | None = None
    values: np.ndarray | None = None
    trace: float = 0.0
    error: float = 0.0

    def __post_init__(self) -> None:
        self.middle = np.array([s // self.n for s in self.sums], np.int64)
        self.rest = np.array([s % self.n for s in self.sums], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.middle).astype(np.float64) - self.rest / self.n

    def decompose(self, covariance: np.ndarray, most: int) -> None:
        factor, order = pivoted_cholesky(covariance)
        w = rotated_columns(factor)[:, :most]
        self.trace = float(np.trace(covariance))
        self.values = (w * w).sum(0)
        self.components = np.zeros_like(w)
        self.components[order] = w / np.sqrt(self.values)
        if w.size:  # one sign for all rows: the largest entry is positive
            lead = self.components[np.abs(self.components).argmax(axis=0), np.arange(w.shape[1])]
            self.components *= np.where(lead < 0, -1.0, 1.0)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.components / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sums of (n x - S) ** 2."""
        away = x - self.middle
        bound = self.n * (int(np.abs(away).max(initial=0)) + 1)
        if bound * bound * x.shape[1] < 1 << 63:
            off = self.n * away - self.rest
            return (off * off).sum(axis=1).tolist()
        sums = [sum((self.n * a - r) ** 2 for a, r in zip(row, self.rest.tolist())) for row in away.tolist()]
        return [s if s < 1 << 63 else None for s in sums]


def _blocks(batches) -> Iterator[tuple[list | None, np.ndarray]]:
    """(ids, x) of rows of one length at a time, ``BLOCK`` at most."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            column = part.column("x")
            length = pc.list_value_length(column).to_numpy()
            for size in np.unique(length):
                rows = np.flatnonzero(length == size)
                own = column if len(rows) == len(length) else column.take(pa.array(rows))
                ids = part.column("vec_id").take(pa.array(rows)).to_pylist() if "vec_id" in part.schema.names else None
                yield ids, own.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, size)


def _sums(fit_list: DataFrame) -> dict[int, Fit]:
    """Exact count and sums of each length, as high and low halves that no task can overflow."""
    schema = pa.schema([(c, pa.int64()) for c in ("size", "i", "n", "high", "low")])

    def run(batches):
        held: dict[int, list] = {}
        for _, x in _blocks(batches):
            own = held.setdefault(x.shape[1], [0, 0, 0])
            for k, part in enumerate((len(x), (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0))):
                own[k] = own[k] + part
        for size, (n, high, low) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(size, size)), pa.array(np.arange(size)),
                                              pa.array(np.full(size, n)), pa.array(high), pa.array(low)], schema=schema)

    wide = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    rows = fit_list.mapInArrow(run, "size long, i long, n long, high long, low long") \
        .groupBy("size", "i").agg(F.sum("n").alias("n"), wide("high"), wide("low")).orderBy("size", "i").collect()
    by_size: dict[int, list] = {}
    for row in rows:
        by_size.setdefault(row["size"], []).append(row)
    return {size: Fit(own[0]["n"], [(int(r["high"]) << 32) + int(r["low"]) for r in own]) for size, own in by_size.items()}


def _scatter(fit_list: DataFrame, fits, of) -> dict[int, np.ndarray]:
    """Sums of products of the columns that ``of`` gives, by length of x."""
    schema = pa.schema([("size", pa.int64()), ("i", pa.int32()), ("j", pa.int32()), ("s", pa.float64())])

    def run(batches):
        held: dict[int, np.ndarray] = {}
        for _, x in _blocks(batches):
            y = of(fits.value[x.shape[1]], x)
            held[x.shape[1]] = held.get(x.shape[1], 0.0) + y.T @ y
        for size, own in held.items():
            i, j = np.triu_indices(len(own))
            for at in range(0, len(i), 1 << 16):
                a, b = i[at:at + (1 << 16)], j[at:at + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(a), size)), pa.array(a.astype(np.int32)),
                                                  pa.array(b.astype(np.int32)), pa.array(own[a, b])], schema=schema)

    rows = fit_list.mapInArrow(run, "size long, i int, j int, s double") \
        .groupBy("size", "i", "j").agg(F.sum("s").alias("s")).toArrow()
    size, i, j, s = (rows[c].to_numpy() for c in ("size", "i", "j", "s"))
    out = {}
    for k in np.unique(size):
        own = size == k
        m = np.zeros((int(j[own].max()) + 1,) * 2)
        m[i[own], j[own]] = s[own]
        out[int(k)] = m + np.triu(m, 1).T
    return out


def whole_numbers(embeddings: DataFrame) -> DataFrame:
    """(vec_id, x) of the rows that are not dropped."""
    sound = F.col("v").isNotNull() & (F.size("v") > 0) & F.forall(
        "v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST))
    return embeddings.select("vec_id", F.transform("embedding", lambda c: c.cast("double")).alias("v")).filter(sound) \
        .select("vec_id", F.transform("v", lambda c: F.floor(F.lit(float(SCALE)) * c) + F.lit(SHIFT).cast("long")).alias("x"))


def whiten(embeddings: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error)
    for every remaining row and each of the leading components."""
    spark = embeddings.sparkSession
    rows = whole_numbers(embeddings)
    fit_list = keep_on_shared_storage(rows.select("x").distinct(), "fit-list")
    fits = _sums(fit_list)
    held = spark.sparkContext.broadcast(fits)
    for size, scatter in _scatter(fit_list, held, lambda fit, x: fit.centred(x)).items():
        fits[size].decompose(scatter / fits[size].n, most)
    held = spark.sparkContext.broadcast(fits)
    for size, scatter in _scatter(fit_list, held, lambda fit, x: fit.whitened(x)).items():
        fits[size].error = float(np.abs(scatter / fits[size].n - np.eye(len(scatter))).max(initial=0.0))
    held = spark.sparkContext.broadcast(fits)
    names = ("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
    schema = pa.schema(list(zip(names, kinds)))

    def run(batches):
        for ids, x in _blocks(batches):
            fit = held.value[x.shape[1]]
            k, n = len(fit.values), len(x)
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()).take(pa.array(np.repeat(np.arange(n), k))),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)), pa.array(np.full(n * k, fit.n)),
                pa.array(fit.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(n), k))),
                pa.array(fit.whitened(x).ravel()), pa.array(np.tile(fit.values / (fit.trace or 1.0), n)),
                pa.array(np.full(n * k, fit.error))], schema=schema)

    return rows.withColumn("vec_id", F.col("vec_id").cast("long")).mapInArrow(
        run, "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
