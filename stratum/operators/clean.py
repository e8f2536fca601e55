"""Bronze -> Silver cleaning (P1, P8–P10) and deterministic dedup (A1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

from ..functions.columns import (flag_tokens, normalize_title, parse_date,
                                 safe_rating, safe_year, split_tags)

# Export headers -> Silver names.
DIARY_RENAMES = {
    "Date": "diary_date_str",
    "Name": "movie_title",
    "Year": "movie_year_str",
    "Letterboxd URI": "letterboxd_uri",
    "Rating": "my_rating_str",
    "Rewatch": "is_rewatch_str",
    "Tags": "tags_raw",
    "Watched Date": "watched_date_str",
}
RATINGS_RENAMES = {
    "Date": "rating_date_str",
    "Name": "movie_title",
    "Year": "movie_year_str",
    "Letterboxd URI": "letterboxd_uri",
    "Rating": "my_rating_str",
}
WATCHED_RENAMES = {
    "Date": "watched_date_str",
    "Name": "movie_title",
    "Year": "movie_year_str",
    "Letterboxd URI": "letterboxd_uri",
}


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _orderable(dtype) -> bool:
    return not isinstance(dtype, (MapType, VariantType))


def dedup_latest(df: DataFrame, keys: Sequence[str],
                 order_by: Sequence = ()) -> DataFrame:
    """A1: one row per key; the row with the greatest ``order_by`` wins.

    ``order_by`` lists columns (or Columns) compared in turn, greatest first,
    NULL smallest; callers make the choice total by listing enough columns.
    Without ``order_by`` every other column is compared, so the survivor is
    the greatest row by content. NULL keys form one group, as with
    ``dropDuplicates``.

    Plan: ``row_number() = 1`` over the key. Spark places a partial group
    limit before the shuffle, so each map task sends at most one row per
    key; a key holding a large share of the rows never reaches one task
    whole. Columns unused downstream are pruned through the window.
    """
    keys = list(keys)
    payload = [f.name for f in df.schema.fields if f.name not in keys]
    if not payload:
        return df.select(*keys).distinct()
    if order_by:
        order = [_as_col(c).desc_nulls_last() for c in order_by]
    else:
        order = [F.col(f.name).desc_nulls_last() for f in df.schema.fields
                 if f.name not in keys and _orderable(f.dataType)] or [F.lit(0)]
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("__rn", F.row_number().over(w))
            .filter(F.col("__rn") == 1).drop("__rn"))


def _clean(df: DataFrame, renames: dict, derived: dict, drop: Sequence[str], source: str,
           run_ts: str, ingestion_date: str | None, keep: Column, keys: Sequence[str],
           order_by: Sequence, dedup: bool) -> DataFrame:
    """Rename, derive, stamp, drop and filter in one projection + one filter
    (one analysis step each), then dedup on ``keys``; without ``dedup`` all
    kept rows, for callers that reduce them by another key themselves."""
    stamp = F.lit(run_ts).cast("timestamp")
    lineage = {"source_file": F.lit(source),
               "_ingestion_date": F.lit(ingestion_date).cast("string"),
               "_silver_created_at": stamp, "_silver_updated_at": stamp}
    names = [renames.get(c, c) for c in df.columns]
    new = {**derived, **lineage}
    # like withColumns: an existing column is replaced where it stands
    cols = [(new[c].alias(c) if c in new else F.col(f"`{c}`")) for c in names if c not in drop]
    cols += [v.alias(k) for k, v in new.items() if k not in names]
    out = df.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(df.columns, names)]).select(*cols)
    return dedup_latest(out.filter(keep), keys, order_by) if dedup else out.filter(keep)


def clean_diary(df: DataFrame, run_ts: str, ingestion_date: str | None = None,
                order_by: Sequence = (), dedup: bool = True) -> DataFrame:
    """Diary export -> Silver diary entries, one row per (uri, watched_date)."""
    derived = {
        "diary_date": parse_date("diary_date_str"),
        "watched_date": parse_date("watched_date_str"),
        "movie_year": safe_year("movie_year_str"),
        "my_rating": safe_rating("my_rating_str"),
        "is_rewatch": flag_tokens("is_rewatch_str"),
        "movie_title_normalized": normalize_title("movie_title"),
        "tags": split_tags("tags_raw"),
    }
    keep = (F.col("letterboxd_uri").isNotNull() & F.col("movie_title").isNotNull()
            & (F.trim("movie_title") != F.lit("")))
    return _clean(df, DIARY_RENAMES, derived,
                  ["diary_date_str", "watched_date_str", "movie_year_str", "my_rating_str",
                   "is_rewatch_str", "tags_raw"], "diary", run_ts, ingestion_date, keep,
                  ["letterboxd_uri", "watched_date"], order_by, dedup)


def clean_ratings(df: DataFrame, run_ts: str, ingestion_date: str | None = None,
                  order_by: Sequence = (), dedup: bool = True) -> DataFrame:
    """Ratings export -> Silver ratings, one row per (uri, rating_date)."""
    derived = {
        "rating_date": parse_date("rating_date_str"),
        "movie_year": safe_year("movie_year_str"),
        "my_rating": safe_rating("my_rating_str"),
        "movie_title_normalized": normalize_title("movie_title"),
    }
    return _clean(df, RATINGS_RENAMES, derived,
                  ["rating_date_str", "movie_year_str", "my_rating_str"], "ratings", run_ts,
                  ingestion_date, F.col("letterboxd_uri").isNotNull(),
                  ["letterboxd_uri", "rating_date"], order_by, dedup)


def clean_watched(df: DataFrame, run_ts: str, ingestion_date: str | None = None,
                  order_by: Sequence = (), dedup: bool = True) -> DataFrame:
    """Watched export -> cleaned rows, one per (uri, watched_date)."""
    derived = {
        "watched_date": parse_date("watched_date_str"),
        "movie_year": safe_year("movie_year_str"),
        "movie_title_normalized": normalize_title("movie_title"),
    }
    return _clean(df, WATCHED_RENAMES, derived, ["watched_date_str", "movie_year_str"], "watched",
                  run_ts, ingestion_date, F.col("letterboxd_uri").isNotNull(),
                  ["letterboxd_uri", "watched_date"], order_by, dedup)
