"""Landing zone and Bronze layer.

Layout: ``<bronze_root>/<table>/ingestion_date=<YYYY-MM-DD>/part-*.parquet``.
Writing with ``partitionBy("ingestion_date")`` and dynamic partition
overwrite makes a re-run of one date replace that date only (S5), and
reading the table root keeps the partition column so date filters prune
directories (S7, S8).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# The lineage stamped on every Bronze row, and the export
# files expected for the film-diary source.
PIPELINE_VERSION = "1.0.0"
LINEAGE_COLUMNS = ["_ingestion_date", "_source_system", "_source_file",
                   "_ingested_at", "_pipeline_version"]
EXPECTED_FILES = {
    "letterboxd": ["diary.csv", "ratings.csv", "watched.csv", "reviews.csv", "watchlist.csv"],
}
PARTITION_COLUMN = "ingestion_date"


class LandingError(FileNotFoundError):
    """Neither the landing zone nor the run's Bronze partition exists."""


# ------------------------------------------------------------ file system


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def list_entries(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """(name, is_directory) of the direct children of ``path`` (metadata only)."""
    fs, p = _fs(spark, path)
    return [(s.getPath().getName(), bool(s.isDirectory())) for s in fs.listStatus(p)]


# ------------------------------------------------------------ landing


def landing_files(spark: SparkSession, landing: str) -> list[str]:
    """Names ending in ``.csv`` (plain files or Spark-written folders)."""
    return sorted(n for n, _ in list_entries(spark, landing) if n.endswith(".csv"))


def missing_inputs(found: DataFrame, expected: Sequence[str], name_col: str = "name") -> DataFrame:
    """Expected names absent from ``found`` (expected − found)."""
    spark = found.sparkSession
    exp = spark.createDataFrame([(n,) for n in expected], f"{name_col} string")
    return exp.join(found.select(name_col).distinct(), name_col, "left_anti")


def check_landing(spark: SparkSession, landing: str, bronze_root: str, tables: Iterable[str],
                  run_date: str) -> list[str]:
    """S3: the files to process.

    A listable landing (even an empty one) returns its CSV names. An
    unlistable landing is fine only when Bronze already holds the run date
    for some table (returns []); otherwise :class:`LandingError`.
    """
    if path_exists(spark, landing):
        return landing_files(spark, landing)
    for t in tables:
        if path_exists(spark, f"{bronze_root}/{t}/{PARTITION_COLUMN}={run_date}"):
            return []
    raise LandingError(f"no files in landing {landing} and no Bronze data for {run_date}")


# ------------------------------------------------------------ Bronze


def read_csv_strings(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Header row, UTF-8, no type inference — every column is a string."""
    return (spark.read.format("csv").option("header", "true")
            .option("inferSchema", "false").option("encoding", "UTF-8").load(path))


def add_bronze_lineage(df: DataFrame, run_date: str, source: str, file_name,
                       ingested_at=None, pipeline_version: str = PIPELINE_VERSION) -> DataFrame:
    """The five lineage columns. ``file_name`` is a name or a Column."""
    file_col = F.lit(file_name) if isinstance(file_name, str) else file_name
    ts = F.current_timestamp() if ingested_at is None else F.lit(ingested_at).cast("timestamp")
    return df.withColumns({
        "_ingestion_date": F.lit(run_date),
        "_source_system": F.lit(source),
        "_source_file": file_col,
        "_ingested_at": ts,
        "_pipeline_version": F.lit(pipeline_version),
    })


def write_bronze(df: DataFrame, bronze_root: str, table: str, run_date: str) -> str:
    """Idempotent write of one run date of one table."""
    path = f"{bronze_root}/{table}"
    (df.withColumn(PARTITION_COLUMN, F.lit(run_date))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(PARTITION_COLUMN).parquet(path))
    return path


def ingest_file(spark: SparkSession, file_path: str, bronze_root: str, run_date: str,
                source: str, ingested_at=None) -> dict:
    """S1+S4+S5+S6 for one landing file: read once, write once; the row count
    comes from an Observation on the write pass (no second scan)."""
    name = file_path.rstrip("/").split("/")[-1]
    table = name[:-4] if name.endswith(".csv") else name
    obs = Observation(f"ingest_{table}")
    df = add_bronze_lineage(read_csv_strings(spark, file_path), run_date, source, name, ingested_at)
    write_bronze(df.observe(obs, F.count(F.lit(1)).alias("rows")), bronze_root, table, run_date)
    return {"file": name, "rows": int(obs.get["rows"]), "status": "SUCCESS"}


#: Landing files read and written at the same time; each is a Spark job of its own.
LANDING_THREADS = 4


def ingest_landing(spark: SparkSession, landing: str, bronze_root: str, run_date: str,
                   source: str, tables: Iterable[str] = (), ingested_at=None) -> DataFrame:
    """Land every CSV found (expected or not) and return the summary
    DataFrame (file, n_rows, status). The files' jobs run side by side, so a
    large file does not hold up the others."""
    names = check_landing(spark, landing, bronze_root, tables, run_date)

    def one(name: str) -> dict:
        return ingest_file(spark, f"{landing.rstrip('/')}/{name}", bronze_root, run_date, source, ingested_at)

    with ThreadPoolExecutor(LANDING_THREADS) as pool:
        results = list(pool.map(one, names))
    return spark.createDataFrame([(r["file"], r["rows"], r["status"]) for r in results],
                                 "file string, n_rows bigint, status string")


def ingest_summary(bronze: DataFrame) -> DataFrame:
    """Rows per source file of a Bronze DataFrame, one aggregate."""
    return bronze.groupBy(F.col("_source_file").alias("file")).agg(
        F.count(F.lit(1)).alias("n_rows"))


def partition_values(spark: SparkSession, table_root: str, column: str = PARTITION_COLUMN) -> list[str]:
    prefix = f"{column}="
    return sorted(n[len(prefix):] for n, is_dir in list_entries(spark, table_root)
                  if is_dir and n.startswith(prefix))


def latest_partition(spark: SparkSession, table_root: str, explicit: str | None = None,
                     column: str = PARTITION_COLUMN) -> str:
    """An explicit date wins; else the greatest partition value by text
    order (read from the directory listing, not the data)."""
    if explicit:
        return explicit
    values = partition_values(spark, table_root, column)
    if not values:
        raise FileNotFoundError(f"no {column}= partitions under {table_root}")
    return values[-1]


def read_bronze(spark: SparkSession, table_root: str, run_date: str | None = None,
                column: str = PARTITION_COLUMN) -> DataFrame:
    """Read a Bronze table from its root, pruned to one run date. A date
    that the table does not hold is an error, not an empty table."""
    date = latest_partition(spark, table_root, run_date, column)
    if not path_exists(spark, f"{table_root.rstrip('/')}/{column}={date}"):
        raise FileNotFoundError(f"no {column}={date} under {table_root}")
    df = spark.read.parquet(table_root)
    return (df.withColumn(column, F.col(column).cast("string"))
            .filter(F.col(column) == F.lit(date)))
