"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

# The contracts' words: A-Z lower-cased, then maximal runs of 0-9, a-z and
# every character from U+0080 on. In UTF-8 those characters are exactly the
# bytes from 0x80 on, so words can be cut on bytes.
_WORD_BYTES = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80
                    else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))
ASCII_LOWER = {c: c + 32 for c in range(0x41, 0x5B)}
#: Edges of one task in a step of ``connected_components``.
EDGES_OF_TASK = 50_000
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def words_of(text: str | None) -> list[bytes]:
    """Words of a whole text (none for a null)."""
    return text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split() if text else []


def word_line(text: str | None) -> str:
    """The words, each between single spaces: `` a b c `` (one space if none)."""
    found = words_of(text)
    return f" {b' '.join(found).decode('utf-8', 'replace')} " if found else " "


def rows_of(batches: Iterable[pa.RecordBatch], names: list[str]) -> Iterator[tuple]:
    """Rows of Arrow batches, one Python tuple each, converted in small slices
    so that a batch of long texts is never held twice."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            yield from zip(*(part.column(n).to_pylist() for n in names))


def emit(rows: Iterator[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Arrow batches of at most ``size`` rows."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(column, type=field.type) for column, field in zip(zip(*rows), schema)], schema=schema)


def keep_on_shared_storage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a fresh folder under ``spark.checkpoint.dir`` and read
    it back: this cuts the lineage, and every executor can read the copy
    again after another one is lost. The folder goes with ``discard``, or when
    the session ends."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")  # the copy is whole: its shuffle files may go at once
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    kept = spark.read.schema(df.schema).parquet(path)
    kept._kept_at = path
    return kept


def discard(kept: DataFrame) -> None:
    """Delete a copy made by ``keep_on_shared_storage`` that nothing reads any more."""
    spark: SparkSession = kept.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(kept._kept_at)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def fewer_tasks(df: DataFrame, rows: int, rows_of_task: int) -> DataFrame:
    """``df`` of about ``rows`` rows in as many tasks as these rows need, at
    least one for each core: few rows are not dealt over a task for every
    shuffle partition. Never more tasks than ``df`` has."""
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // rows_of_task)))


def connected_components(nodes: DataFrame, edges: DataFrame, max_rounds: int = 50,
                         n_edges: int | None = None) -> DataFrame:
    """(id, component): the smallest id reachable over undirected edges (a, b).

    ``nodes`` has a column ``id`` (distinct, not null); ``n_edges`` tells how
    many rows ``edges`` has, if that is known. Alternating large-star
    and small-star steps: every step replaces the edges by edges to the
    smallest neighbour, so a chain of any length shrinks geometrically and no
    step collects a neighbourhood (minima only, which combine before the
    shuffle). Each round is written to shared storage; the loop ends when no
    edge changes. The steps' tasks are as many as the edges need."""
    def directed(e: DataFrame) -> DataFrame:
        return e.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def fewer(e: DataFrame) -> DataFrame:
        return fewer_tasks(e, size, EDGES_OF_TASK)

    current = directed(edges)
    if n_edges is not None:
        current = fewer_tasks(current, n_edges, EDGES_OF_TASK)
    current = keep_on_shared_storage(current, "edges")
    size, total = _fingerprint(current)
    for _ in range(max_rounds):
        if not size:
            break
        # Large star: each larger neighbour of a node is linked to the node's smallest neighbour.
        both = current.union(current.select(F.col("b"), F.col("a")))
        low = both.groupBy("a").agg(F.min("b").alias("low"))
        low = low.select("a", F.least("a", "low").alias("low"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = fewer(fewer(large).distinct())
        # Small star: a node's smaller neighbours, and the node, go to the smallest of them.
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        joined = large.join(low, "a")
        small = joined.filter("b != low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        current = keep_on_shared_storage(
            fewer(fewer(small.union(low.select("a", F.col("low").alias("b"))).filter("a != b")).distinct()), "edges")
        now = _fingerprint(current)
        if now == (size, total):
            break
        size, total = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    low = current.groupBy("a").agg(F.min("b").alias("component"))
    return nodes.select("id").join(low, nodes["id"] == low["a"], "left") \
        .select("id", F.coalesce("component", "id").alias("component"))


def _fingerprint(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], int(row[1] or 0)
