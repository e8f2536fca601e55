"""Keyed tables on shared storage.

Parquet directories; a Delta table is read when the path holds a Delta log
and the Delta reader is on the classpath. Replacing a table that the new
content was computed from is done by writing a new directory first and
swapping afterwards, so a job never reads files it is overwriting, and a
lost executor only re-runs tasks of a job whose input is still intact.

The swap renames directories, so it needs a file system with atomic directory
renames (HDFS and the like); every rename is checked before anything is
deleted. On an object store, where a rename copies every file, use Delta.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import PySparkAssertionError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.merge import incremental_merge, merge_upsert
from .files import _fs, list_entries, path_exists
from .schema import TableSchema, store_schema, stored_schema

HIVE_NULL = "__HIVE_DEFAULT_PARTITION__"


class RecoveryError(RuntimeError):
    """A table's folder is missing and its copies do not say which one is current."""


class DeltaTableError(RuntimeError):
    """A path holds a Delta table, which plain Parquet writes would damage."""


def is_delta(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, f"{path.rstrip('/')}/_delta_log")


def _writable(spark: SparkSession, path: str) -> str:
    """``path`` without its last slash; Delta tables are read but never written
    here: files beside their log would be lost to its readers, or hide it."""
    path = path.rstrip("/")
    if is_delta(spark, path):
        raise DeltaTableError(f"{path} is a Delta table; use its own MERGE or overwrite")
    return path


def _beside(path: str, label: str) -> str:
    """A fresh folder beside the table; the names sort in write order."""
    return f"{path.rstrip('/')}.__{label}-{time.time_ns():020d}-{uuid.uuid4().hex}"


def _rename(spark: SparkSession, source: str, target: str) -> None:
    fs, s = _fs(spark, source)
    if not fs.rename(s, _fs(spark, target)[1]):
        raise OSError(f"could not rename {source} to {target}")


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def recover(spark: SparkSession, path: str) -> None:
    """Finish a swap that stopped after the old directory was moved away.

    If ``path`` is missing, its one complete staged copy is moved in; without
    a staged copy, the one retired directory is moved back. With several
    candidates nothing is guessed: :class:`RecoveryError` names them."""
    path = path.rstrip("/")
    if path_exists(spark, path):
        return
    parent, name = path.rsplit("/", 1)
    if not path_exists(spark, parent):
        return
    folders = sorted(n for n, is_dir in list_entries(spark, parent) if is_dir)
    staged = [n for n in folders if n.startswith(f"{name}.__new-") and path_exists(spark, f"{parent}/{n}/_SUCCESS")]
    retired = [n for n in folders if n.startswith(f"{name}.__old-")]
    found = staged or retired
    if len(found) > 1:
        raise RecoveryError(f"{path} is missing and has several complete copies: {', '.join(found)}")
    if found:
        _rename(spark, f"{parent}/{found[0]}", path)


def _has_data(spark: SparkSession, path: str) -> bool:
    """Whether data files or partition folders lie directly under ``path``."""
    return any("=" in n if is_dir else n.endswith(".parquet") and not n.startswith(("_", "."))
               for n, is_dir in list_entries(spark, path))


def table_exists(spark: SparkSession, path: str) -> bool:
    """A table lives at ``path``: a commit marker, a Delta log, or data
    (a dynamic partition overwrite leaves partition folders but no marker)."""
    recover(spark, path)
    path = path.rstrip("/")
    if not path_exists(spark, path):
        return False
    return path_exists(spark, f"{path}/_SUCCESS") or is_delta(spark, path) or _has_data(spark, path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Read a keyed table (Delta if present, else Parquet, in the schema
    kept with the table if there is one)."""
    recover(spark, path)
    if is_delta(spark, path):
        return spark.read.format("delta").load(path)
    schema = stored_schema(spark, path)
    return schema.read(spark.read.schema(schema.physical).parquet(path)) if schema else spark.read.parquet(path)


def _clustered(df: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Rows of a partition value side by side, so that a partition gets few
    files; AQE splits values that are large and joins small ones."""
    return df.hint("rebalance", *[F.col(c) for c in parts]) if parts else df


def replace_table(df: DataFrame, path: str, partition_cols: Sequence[str] = ()) -> DataFrame:
    """Overwrite ``path`` with ``df`` even if ``df`` reads from ``path``.

    The content is written to a sibling directory, then the old directory is
    renamed away and the new one into place; the returned DataFrame reads
    the new files (its lineage no longer reaches the inputs). The old
    directory is deleted only after both renames succeeded.
    """
    spark = df.sparkSession
    path = _writable(spark, path)
    staged = _beside(path, "new")
    _clustered(df, partition_cols).write.mode("errorifexists").partitionBy(*partition_cols).parquet(staged)
    if path_exists(spark, path):
        retired = _beside(path, "old")
        _rename(spark, path, retired)
        _rename(spark, staged, path)
        _delete(spark, retired)
    else:
        _rename(spark, staged, path)
    return spark.read.schema(df.schema).parquet(path) if partition_cols else spark.read.parquet(path)


def append_table(df: DataFrame, path: str) -> None:
    """Append rows (audit log)."""
    df.write.mode("append").parquet(_writable(df.sparkSession, path))


def write_run(df: DataFrame, path: str, run_id: str) -> DataFrame:
    """S11 by run: the rows of ``run_id`` in a table of many runs. Writing a run
    again replaces its own rows only, so a repeated run leaves one record.
    ``df`` may hold a ``run_id`` column; it is set to ``run_id``."""
    spark = df.sparkSession
    path = _writable(spark, path)
    df = df.withColumn("run_id", F.lit(run_id).cast("string"))
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path))
    return read_runs(spark, path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """A table written by :func:`write_run`; ``run_id`` is text whatever it looks like."""
    found = spark.read.parquet(path).schema
    text = StructType([StructField(f.name, StringType()) if f.name == "run_id" else f for f in found.fields])
    return spark.read.schema(text).parquet(path)


def staged(df: DataFrame, path: str, *metrics) -> tuple[DataFrame, dict]:
    """``df`` written to ``path`` and read back, with aggregates over its rows
    taken in the same pass (0 rows: as the aggregates say for none)."""
    seen = Observation(f"stratum_{uuid.uuid4().hex}")
    df.observe(seen, *metrics).write.mode("errorifexists").parquet(_writable(df.sparkSession, path))
    return df.sparkSession.read.schema(df.schema).parquet(path), seen.get


def upsert_table(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str],
                 update_set: Mapping[str, object], update_when=None,
                 null_safe_keys: bool = False, check_unique: bool = True) -> DataFrame:
    """S9 + M1–M3: create the table on the first run, MERGE afterwards.
    ``check_unique=False`` skips the duplicate-key check for sources that are
    unique by construction (deduplicated on the merge keys)."""
    path = _writable(spark, path)
    if not table_exists(spark, path):
        source.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)
    target = read_table(spark, path)
    merged = merge_upsert(target, source.select(*target.columns), keys, update_set,
                          update_when, null_safe_keys=null_safe_keys, check_unique=check_unique)
    return replace_table(merged, path)


def _create_partitioned(df: DataFrame, path: str, parts: Sequence[str]) -> DataFrame:
    """First write of a partitioned table. A partitioned write of no rows
    leaves no data file to carry the schema, so an empty first batch leaves
    nothing and returns an empty DataFrame of the right schema; the next
    non-empty run creates the table. Emptiness is read from what was written."""
    spark = df.sparkSession
    (_clustered(df, parts).write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy(*parts).parquet(path))
    if not _has_data(spark, path.rstrip("/")):
        _delete(spark, path)
        return spark.createDataFrame([], df.schema)
    return spark.read.schema(df.schema).parquet(path)


def _touched(target: DataFrame, batch: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Rows of ``target`` in the partitions that ``batch`` has rows in.

    The batch's partition values (one for each folder it writes, which the
    driver lists anyway) become a static partition filter, whatever their
    number: partition columns are those that make folders, such as months; with several partition columns a join narrows the column-wise
    filter to the exact combinations."""
    values = batch.select(*parts).distinct()
    rows = values.collect()
    for c in parts:
        known = sorted({r[c] for r in rows if r[c] is not None})
        keep = F.col(c).isin(known) if known else F.lit(False)
        target = target.filter(keep | F.col(c).isNull() if any(r[c] is None for r in rows) else keep)
    if len(parts) < 2:
        return target
    v = values.alias("v")
    return target.alias("t").join(v, reduce(lambda a, b: a & b, [
        F.col(f"t.{c}").eqNullSafe(F.col(f"v.{c}")) for c in parts]), "left_semi")


def rewrite_partitions(spark: SparkSession, path: str, source: DataFrame,
                       partition_cols: Sequence[str], combine, observe=None) -> DataFrame:
    """Rewrite only the partitions of ``path`` that ``source`` touches, with
    ``combine(scoped_target, source) -> DataFrame`` giving their new content.

    The batch is written once to a staging folder (this also cuts its lineage:
    a retry re-reads the staged batch, not the jobs that built it). Its
    partition values prune the target, so only touched partitions are listed
    and read. Their new content is written once, clustered by partition, with
    dynamic partition overwrite: Spark's commit moves the new files in after
    all tasks have finished reading. One path for any number of partitions.
    The first run writes the source as the table. ``observe`` is an optional
    ``(Observation, Column)`` evaluated over the rows written, in the same pass.
    """
    parts, path = list(partition_cols), _writable(spark, path)

    def watched(df: DataFrame) -> DataFrame:
        return df.observe(observe[0], observe[1]) if observe else df

    if not table_exists(spark, path):
        return _create_partitioned(watched(source), path, parts)
    target = read_table(spark, path)
    batch_dir = _beside(path, "batch")
    source.write.mode("errorifexists").parquet(batch_dir)
    try:
        batch = spark.read.schema(source.schema).parquet(batch_dir)
        if batch.isEmpty():
            return target
        target = target.select(*[F.col(f.name).cast(source.schema[f.name].dataType).alias(f.name)
                                 if f.name in parts else F.col(f.name) for f in target.schema.fields])
        merged = watched(combine(_touched(target, batch, parts), batch)).select(*target.columns)
        schema = stored_schema(spark, path)
        files = schema.write(merged) if schema else merged
        (_clustered(files, parts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*parts).parquet(path))
        return read_table(spark, path) if schema else spark.read.schema(merged.schema).parquet(path)
    finally:
        _delete(spark, batch_dir)


def upsert_partitions(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str],
                      partition_cols: Sequence[str], update_set: Mapping[str, object],
                      update_when=None, null_safe_keys: bool = False,
                      check_unique: bool = True) -> DataFrame:
    """M1–M3 for a partitioned table: only the partitions the source touches
    are read, merged and rewritten. The partition columns must follow from
    the keys (e.g. the month of a key date), so a key never moves between
    partitions; a daily batch then costs its own partitions, not the table."""
    def combine(scoped: DataFrame, src: DataFrame) -> DataFrame:
        return merge_upsert(scoped, src.select(*scoped.columns), keys, update_set, update_when,
                            null_safe_keys=null_safe_keys, check_unique=check_unique)
    return rewrite_partitions(spark, path, source, partition_cols, combine)


def refresh_null_keys(spark: SparkSession, path: str, lookup: DataFrame, on: str, fill: str,
                      unique_key: Sequence[str] | str, partition_cols: Sequence[str],
                      stamps: Mapping[str, object] | None = None) -> DataFrame:
    """Fill the NULL ``fill`` keys of a stored fact whose dimension row
    has arrived since (``lookup``: one row of ``on`` and ``fill`` for each value).

    Rows with a NULL key are looked for by reading only the columns needed;
    those found in ``lookup`` form the batch, and only partitions with such
    rows are rewritten. Keys that are not NULL stay as they are. ``stamps``
    sets columns of repaired rows."""
    keys = [unique_key] if isinstance(unique_key, str) else list(unique_key)
    stamps, path = dict(stamps or {}), _writable(spark, path)
    facts = read_table(spark, path)
    waiting = facts.filter(F.col(fill).isNull() & F.col(on).isNotNull()).select(*dict.fromkeys([*keys, *partition_cols, on]))
    known = lookup.filter(F.col(fill).isNotNull()).select(on, fill)
    found = waiting.join(known, on).select(*dict.fromkeys([*keys, *partition_cols]), fill).withColumns(stamps)

    def combine(scoped: DataFrame, batch: DataFrame) -> DataFrame:
        return merge_upsert(scoped, batch, keys, {c: f"s.{c}" for c in [fill, *stamps]}, insert=False)
    return rewrite_partitions(spark, path, found, partition_cols, combine)


WATERMARK_DIR = "_watermark"


def read_watermark(spark: SparkSession, path: str):
    """The high-water mark kept beside a table (one row), or None."""
    wm = f"{path.rstrip('/')}/{WATERMARK_DIR}"
    if not path_exists(spark, f"{wm}/_SUCCESS"):
        return None
    return spark.read.parquet(wm).first()["mark"]


def _write_watermark(spark: SparkSession, path: str, mark, kind: str) -> None:
    (spark.createDataFrame([(mark,)], f"mark {kind}").coalesce(1)
     .write.mode("overwrite").parquet(f"{path.rstrip('/')}/{WATERMARK_DIR}"))


def load_incremental_partitions(spark: SparkSession, path: str, built: DataFrame,
                                unique_key: Sequence[str] | str, partition_cols: Sequence[str],
                                stamp_col: str, keep_first: Sequence[str] = ()) -> DataFrame:
    """M7 for a partitioned table: rows newer than the table's high-water mark
    replace rows with the same unique key inside the partitions they fall in.

    The mark is kept as a one-row file in ``<table>/_watermark`` (ignored by
    table readers), so a load does not scan the whole table for it. The new
    mark is observed over the rows written, in the same pass: the untouched
    partitions cannot hold anything newer than the old mark. If a run stops
    before the mark is written, the next run re-loads a few rows already
    present, which the keyed replace absorbs.

    Columns are synchronised (S15): when ``built`` has other columns than the
    table, or other types, a new version of the schema kept with the table says
    so before anything is written. Added columns read as NULL from older files
    and dropped ones are not read; no partition but the batch's is touched.
    """
    kind = built.schema[stamp_col].dataType.simpleString()
    old_mark, path = None, _writable(spark, path)
    if table_exists(spark, path):
        stored = read_table(spark, path)
        old_mark = read_watermark(spark, path)
        if old_mark is None:     # table written before marks were kept
            old_mark = stored.select(F.max(stamp_col)).first()[0]
        own = StructType([built.schema[f.name] if f.name in partition_cols else f for f in stored.schema.fields])
        schema = stored_schema(spark, path) or TableSchema.of(own, partition_cols)
        if not schema.same_as(built.schema):
            store_schema(spark, path, schema.evolved(built.schema))
        if old_mark is not None:
            built = built.filter(F.col(stamp_col) > F.lit(old_mark))
    obs = Observation("stratum_watermark")

    def combine(scoped: DataFrame, new: DataFrame) -> DataFrame:
        return incremental_merge(scoped, new, unique_key, keep_first=keep_first)
    out = rewrite_partitions(spark, path, built, partition_cols, combine,
                             observe=(obs, F.max(stamp_col).alias("mark")))
    try:
        seen = obs.get.get("mark")
    except PySparkAssertionError:    # nothing newer: no partition was written
        seen = None
    marks = [m for m in (old_mark, seen) if m is not None]
    if marks and table_exists(spark, path):
        _write_watermark(spark, path, max(marks), kind)
    return out


CLOSED_RUN = "_closed_run"


def snapshot_scd2(spark: SparkSession, path: str, incoming: DataFrame, key: str,
                  check_cols: Sequence[str], run_ts: str,
                  invalidate_hard_deletes: bool = False) -> DataFrame:
    """M4 on a stored history where closed versions are append-only.

    The history is partitioned by the run that closed a version
    (``_closed_run``; NULL = still open). A run reads the open partition only,
    applies the snapshot to it, and rewrites exactly two partitions: first the
    one of this run's closed versions, then the open one. A run that
    stops between the two leaves the closed versions still open beside their
    closed copies; running it again with the same ``run_ts`` finds the same
    old open versions and repairs both. A run repeated on other input keeps
    the versions it closed before: they are merged with the new ones by
    version id. Versions closed by other runs are never read or rewritten.
    Returns the whole history.
    """
    from ..operators.scd import SCD_ID, VALID_TO, scd2_apply

    path = _writable(spark, path)

    def tagged(df: DataFrame) -> DataFrame:
        return df.withColumn(CLOSED_RUN, F.date_format(F.col(VALID_TO), "yyyyMMddHHmmss").cast("string"))

    if not table_exists(spark, path):
        return _create_partitioned(tagged(scd2_apply(None, incoming, key, check_cols, run_ts)),
                                   path, [CLOSED_RUN])
    history = read_table(spark, path).withColumn(CLOSED_RUN, F.col(CLOSED_RUN).cast("string"))
    open_rows = history.filter(F.col(CLOSED_RUN).isNull()).drop(CLOSED_RUN)
    nxt = tagged(scd2_apply(open_rows, incoming, key, check_cols, run_ts,
                            invalidate_hard_deletes)).select(*history.columns)
    # The partition of versions closed at this stamp, from an earlier call of the run.
    label = re.sub(r"\D", "", run_ts)[:14].ljust(14, "0")
    before = history.filter(F.col(CLOSED_RUN) == label)
    if path_exists(spark, f"{path}/{CLOSED_RUN}={label}"):
        closed = nxt.filter(F.col(CLOSED_RUN).isNotNull()).select(SCD_ID)
        nxt = nxt.unionByName(before.join(closed, SCD_ID, "left_anti").select(*history.columns))
    staged = _beside(path, "scd")
    nxt.write.mode("errorifexists").partitionBy(CLOSED_RUN).parquet(staged)
    try:
        # read back with the written schema: a run that closes nothing stages only
        # the NULL partition, whose type could not be inferred from folder names
        written = spark.read.schema(nxt.schema).parquet(staged).select(*history.columns)
        names = [n for n, is_dir in list_entries(spark, staged) if is_dir and n.startswith(f"{CLOSED_RUN}=")]
        is_open = F.col(CLOSED_RUN).isNull()
        for side, there in ((~is_open, any(HIVE_NULL not in n for n in names)),
                            (is_open, f"{CLOSED_RUN}={HIVE_NULL}" in names)):
            if there:
                (written.filter(side).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                 .partitionBy(CLOSED_RUN).parquet(path))
        if f"{CLOSED_RUN}={HIVE_NULL}" not in names:  # every open version was closed
            _delete(spark, f"{path.rstrip('/')}/{CLOSED_RUN}={HIVE_NULL}")
    finally:
        _delete(spark, staged)
    return spark.read.schema(nxt.schema).parquet(path)


def export_table(df: DataFrame, sink_path: str) -> DataFrame:
    """Full replace of the sink with the source table."""
    df.write.mode("overwrite").parquet(_writable(df.sparkSession, sink_path))
    return df.sparkSession.read.parquet(sink_path)


def export_to_catalog(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Full replace of the catalog table ``name`` (schema and rows); created
    if needed. The files lie in the session's warehouse, or under ``path``
    (a fresh folder each time: the one before goes when the new table stands).
    Returns the table as the catalog gives it back."""
    spark = df.sparkSession
    writer = df.write.mode("overwrite").format("parquet")
    if path is None:
        writer.saveAsTable(name)
        return spark.table(name)
    files = f"{path.rstrip('/')}/{uuid.uuid4().hex}"
    known = spark.catalog.tableExists(name)
    before = spark.sql(f"DESCRIBE FORMATTED {name}").filter("col_name = 'Location'").first() if known else None
    writer.option("path", files).saveAsTable(name)
    if before and before["data_type"].rsplit("/", 1)[0].endswith(path.rstrip("/").rsplit(":", 1)[-1]):
        _delete(spark, before["data_type"])
    return spark.table(name)


def reconcile(source: DataFrame, sink: DataFrame, table_name: str) -> DataFrame:
    """Source vs sink row counts in one lazy row (scalar subqueries)."""
    spark = source.sparkSession
    src = source.select(F.count(F.lit(1))).scalar()
    dst = sink.select(F.count(F.lit(1))).scalar()
    return spark.range(1).select(F.lit(table_name).alias("table_name"),
                                 src.alias("source_rows"), dst.alias("sink_rows"),
                                 (src == dst).alias("matches"))


def materialize(df: DataFrame, kind: str, name: str, path: str | None = None,
                unique_key: Sequence[str] | str | None = None,
                stamp_col: str | None = None) -> DataFrame:
    """View (temp view), table (full rebuild) or incremental (merge on
    the unique key with schema sync, S15)."""
    spark = df.sparkSession
    if kind == "view":
        df.createOrReplaceTempView(name)
        return spark.table(name)
    if path is None:
        raise ValueError("table and incremental materializations need a path")
    path = _writable(spark, path)
    if kind == "table":
        return replace_table(df, path)
    if kind == "incremental":
        if not table_exists(spark, path):
            df.write.mode("overwrite").parquet(path)
            return spark.read.parquet(path)
        existing = read_table(spark, path)
        return replace_table(incremental_merge(existing, df, unique_key, stamp_col), path)
    raise ValueError(f"unknown materialization {kind}")
