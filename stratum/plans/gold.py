"""Gold models (G1–G10): staging views, dimensions, bridge and facts.

Each model is a function from its input DataFrames to a DataFrame; callers
run them in dependency order in one session (no subprocess, no export hop).
Load stamps are a ``run_ts`` parameter, never ``current_timestamp()``, so a
model's output is a function of its inputs.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import (day_name, day_of_week, is_weekend, month_name,
                                 safe_date, surrogate_key, week_of_year_sunday,
                                 year_quarter)
from ..operators.scd import VALID_FROM, SCD_ID, scd2_apply, scd2_current
from ..operators.merge import incremental_merge

# Spine defaults and the snapshot's configuration.
DATE_SPINE_START = "2000-01-01"
DATE_SPINE_END = "2030-12-31"          # exclusive end, as the spine macro treats it
SNAPSHOT_KEY = "letterboxd_uri"
SNAPSHOT_CHECK_COLS = ["vote_average", "vote_count", "runtime_minutes", "overview",
                       "director_name", "budget_usd", "revenue_usd"]
SNAPSHOT_STATUSES = ("SUCCESS", "FUZZY_MATCH")


def _stamps(run_ts: str, names=("_dbt_created_at", "_dbt_updated_at")) -> dict:
    stamp = F.lit(run_ts).cast("timestamp")
    return {n: stamp for n in names}


# ---------------------------------------------------------------- staging


def stg_movies(silver_movies: DataFrame) -> DataFrame:
    """G1: typed film view."""
    release = safe_date("release_date")
    return silver_movies.select(
        "letterboxd_uri", "lb_movie_title", "lb_movie_year", "enrichment_status",
        F.col("tmdb_id").cast("bigint").alias("tmdb_id"),
        F.coalesce("tmdb_title", "lb_movie_title").alias("title"),
        "tmdb_original_title",
        release.alias("release_date"),
        F.year(release).cast("bigint").alias("release_year"),
        "genres",
        F.col("runtime_minutes").cast("bigint").alias("runtime_minutes"),
        F.col("budget_usd").cast("bigint").alias("budget_usd"),
        F.col("revenue_usd").cast("bigint").alias("revenue_usd"),
        F.col("vote_average").cast("double").alias("vote_average"),
        F.col("vote_count").cast("bigint").alias("vote_count"),
        "overview", "original_language", "poster_path", "director_name",
        F.col("director_tmdb_id").cast("bigint").alias("director_tmdb_id"),
        F.col("_silver_created_at").cast("timestamp").alias("_silver_created_at"),
        F.col("_silver_updated_at").cast("timestamp").alias("_silver_updated_at"),
    )


def stg_diary(silver_diary: DataFrame) -> DataFrame:
    """Typed diary view; rows without uri or watched date dropped."""
    return silver_diary.select(
        "letterboxd_uri", "movie_title",
        safe_date("watched_date").alias("watched_date"),
        safe_date("diary_date").alias("diary_date"),
        F.col("my_rating").cast("double").alias("my_rating"),
        F.col("is_rewatch").cast("boolean").alias("is_rewatch"),
        "tags",
        F.col("_silver_created_at").cast("timestamp").alias("_silver_created_at"),
        F.col("_silver_updated_at").cast("timestamp").alias("_silver_updated_at"),
    ).filter(F.col("letterboxd_uri").isNotNull() & F.col("watched_date").isNotNull())


def stg_ratings(silver_ratings: DataFrame) -> DataFrame:
    """Typed ratings view; uri, date and rating required."""
    return silver_ratings.select(
        "letterboxd_uri", "movie_title",
        safe_date("rating_date").alias("rating_date"),
        F.col("my_rating").cast("double").alias("my_rating"),
        F.col("_silver_created_at").cast("timestamp").alias("_silver_created_at"),
        F.col("_silver_updated_at").cast("timestamp").alias("_silver_updated_at"),
    ).filter(F.col("letterboxd_uri").isNotNull() & F.col("rating_date").isNotNull()
             & F.col("my_rating").isNotNull())


# ---------------------------------------------------------------- snapshot


# The snapshot's columns.
SNAPSHOT_COLUMNS = ["letterboxd_uri", "tmdb_id", "title", "tmdb_original_title",
                    "release_date", "release_year", "genres", "runtime_minutes",
                    "budget_usd", "revenue_usd", "vote_average", "vote_count",
                    "overview", "original_language", "poster_path", "director_name",
                    "director_tmdb_id", "_silver_updated_at"]


def snapshot_source(stg: DataFrame) -> DataFrame:
    """Rows the film snapshot tracks: matched films only."""
    return (stg.filter(F.col("enrichment_status").isin(*SNAPSHOT_STATUSES))
            .select(*SNAPSHOT_COLUMNS))


def snap_dim_movie(history: DataFrame | None, stg: DataFrame, run_ts: str) -> DataFrame:
    """SCD-2 snapshot of films on the configured check columns (M4)."""
    return scd2_apply(history, snapshot_source(stg), SNAPSHOT_KEY, SNAPSHOT_CHECK_COLS, run_ts)


# ---------------------------------------------------------------- dimensions


def spine_days(start: str = DATE_SPINE_START, end: str = DATE_SPINE_END) -> int:
    return (dt.date.fromisoformat(end) - dt.date.fromisoformat(start)).days


def dim_date(spark: SparkSession, start: str = DATE_SPINE_START,
             end: str = DATE_SPINE_END, run_ts: str | None = None) -> DataFrame:
    """One row per day in [start, end). Generated with ``spark.range`` so
    the spine is split across tasks instead of exploding one array row."""
    d = F.date_add(F.lit(start).cast("date"), F.col("id").cast("int"))
    return calendar(spark.range(0, spine_days(start, end)).select(d.alias("date_day")), run_ts)


def calendar(days: DataFrame, run_ts: str | None = None) -> DataFrame:
    """The date columns (P19–P23) of the days in ``date_day``."""
    out = days.select(
        surrogate_key("date_day").alias("date_id"),
        F.col("date_day").alias("full_date"),
        F.year("date_day").alias("year"),
        F.quarter("date_day").alias("quarter_number"),
        year_quarter("date_day").alias("year_quarter"),
        F.month("date_day").alias("month_number"),
        month_name("date_day").alias("month_name"),
        F.dayofmonth("date_day").alias("day_of_month"),
        day_of_week("date_day").alias("day_of_week_number"),
        day_name("date_day").alias("day_of_week_name"),
        is_weekend("date_day").alias("is_weekend"),
        week_of_year_sunday("date_day").alias("week_of_year"),
    )
    return out.withColumns(_stamps(run_ts)) if run_ts else out


def date_lookup(spark: SparkSession, dates: DataFrame | None = None) -> DataFrame:
    """(full_date, date_id) for fact lookups; Spark picks the join by size."""
    dates = dates if dates is not None else dim_date(spark)
    return dates.select("full_date", "date_id")


def dim_director(stg: DataFrame, run_ts: str | None = None) -> DataFrame:
    """One row per director id. A director whose name varies between
    films would fan out the film join; the smallest name is kept."""
    out = (stg.filter(F.col("director_name").isNotNull() & F.col("director_tmdb_id").isNotNull())
           .groupBy("director_tmdb_id").agg(F.min("director_name").alias("director_name"))
           .select(surrogate_key("director_tmdb_id").alias("director_id"),
                   "director_tmdb_id", "director_name"))
    return out.withColumns(_stamps(run_ts)) if run_ts else out


def dim_genre(stg: DataFrame, run_ts: str | None = None) -> DataFrame:
    """Distinct non-NULL genre names from the genre arrays, ordered."""
    out = (stg.filter(F.col("genres").isNotNull())
           .select(F.explode("genres").alias("genre_name"))
           .filter(F.col("genre_name").isNotNull()).distinct()
           .select(surrogate_key("genre_name").alias("genre_id"), "genre_name"))
    if run_ts:
        out = out.withColumns(_stamps(run_ts))
    return out.orderBy("genre_name")


def dim_movie(snapshot: DataFrame, directors: DataFrame, run_ts: str | None = None) -> DataFrame:
    """Current snapshot version + director key."""
    cur = scd2_current(snapshot)
    d = directors.select("director_tmdb_id", "director_id")
    out = (cur.join(d, "director_tmdb_id", "left")
           .select(surrogate_key("letterboxd_uri").alias("movie_id"),
                   F.col(SCD_ID).alias("movie_version_id"),
                   "letterboxd_uri", "tmdb_id", "title", "tmdb_original_title",
                   "release_date", "release_year", "genres", "runtime_minutes",
                   "budget_usd", "revenue_usd", "vote_average", "vote_count",
                   "overview", "original_language", "poster_path", "director_id",
                   "director_name", F.col(VALID_FROM).alias("version_valid_from"),
                   F.lit(True).alias("is_current_version")))
    return out.withColumns(_stamps(run_ts)) if run_ts else out


def bridge_movie_genre(movies: DataFrame, genres: DataFrame, run_ts: str | None = None) -> DataFrame:
    """One row per (film, genre). Duplicate names inside one film's array
    are collapsed first so ``bridge_id`` stays unique."""
    mg = (movies.filter(F.col("genres").isNotNull())
          .select("movie_id", F.explode(F.array_distinct("genres")).alias("genre_name")))
    out = (mg.join(genres.select("genre_id", "genre_name"), "genre_name", "inner")
           .select(surrogate_key("movie_id", "genre_name").alias("bridge_id"),
                   "movie_id", "genre_id", "genre_name"))
    return out.withColumns(_stamps(run_ts, ("_dbt_created_at",))) if run_ts else out


def _fact(rows: DataFrame, movies: DataFrame, dates: DataFrame, date_col: str,
          date_id_col: str, id_col: str, cols: list[str], run_ts: str | None) -> DataFrame:
    m = movies.select("letterboxd_uri", "movie_id")
    d = dates.select(F.col("full_date").alias(date_col), F.col("date_id").alias(date_id_col))
    out = (rows.join(m, "letterboxd_uri", "left").join(d, date_col, "left")
           .select(surrogate_key("letterboxd_uri", date_col).alias(id_col),
                   "movie_id", date_id_col, *cols,
                   F.col("_silver_updated_at").alias("_source_updated_at")))
    return out.withColumns(_stamps(run_ts)) if run_ts else out


def fact_diary_entries(stg: DataFrame, movies: DataFrame, dates: DataFrame,
                       run_ts: str | None = None) -> DataFrame:
    """Diary facts with film and date keys (J2 ×2, P17)."""
    return _fact(stg, movies, dates, "watched_date", "watched_date_id", "diary_entry_id",
                 ["letterboxd_uri", "watched_date", "diary_date", "my_rating",
                  "is_rewatch", "tags"], run_ts)


def fact_ratings(stg: DataFrame, movies: DataFrame, dates: DataFrame,
                 run_ts: str | None = None) -> DataFrame:
    """Rating facts with film and date keys (J2 ×2, P17)."""
    return _fact(stg, movies, dates, "rating_date", "rating_date_id", "rating_id",
                 ["letterboxd_uri", "rating_date", "my_rating"], run_ts)


def load_fact(existing: DataFrame | None, built: DataFrame, unique_key: str) -> DataFrame:
    """Incremental materialization of a fact (A7 + M7): rows whose source stamp
    is newer than the table's mark replace or extend it; the first
    ``_dbt_created_at`` of a replaced row is kept."""
    keep = ["_dbt_created_at"] if existing is not None and "_dbt_created_at" in existing.columns else []
    return incremental_merge(existing, built, unique_key, stamp_col="_source_updated_at",
                             keep_first=keep)
