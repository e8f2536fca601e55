"""Dashboard questions over the Gold tables.

All are grouped aggregates (combined map-side before the shuffle) or
top-k via ``orderBy().limit(k)`` (per-partition top-k, then a k-row merge).
Totals for shares come from scalar subqueries, not a window over the whole
table and not a cross join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.quality import enrichment_rate


def status_counts(movies: DataFrame) -> DataFrame:
    """A5: films per enrichment status."""
    return movies.groupBy(F.col("enrichment_status").alias("status")).agg(
        F.count(F.lit(1)).alias("n"))


#: The audit record's columns for films by status.
AUDIT_STATUSES = {"tmdb_success": "SUCCESS", "tmdb_fuzzy_match": "FUZZY_MATCH", "tmdb_not_found": "NOT_FOUND",
                  "tmdb_error": "ERROR"}


def status_metrics() -> list[Column]:
    """Films by status, to be observed while the film table is written."""
    return [F.count_if(F.col("enrichment_status") == s).alias(c) for c, s in AUDIT_STATUSES.items()]


def audit_record(movies: dict, diary_total: int, ratings_total: int, processed: DataFrame, run_ts: str,
                 run_mode: str, bronze_partition: str, job_status: str = "SUCCESS") -> DataFrame:
    """One run-audit row from counts taken while the Silver tables were
    written (``movies``: total ``n`` and the counts of :func:`status_metrics`),
    so no table is read for them. Counts default to 0 on an empty run; the
    processed films are counted here."""
    number = lambda n: F.lit(int(n or 0)).cast("bigint")
    return processed.agg(F.count(F.lit(1)).alias("movies_processed")).select(
        F.lit(run_ts).alias("pipeline_run_ts"),
        F.lit(run_mode).alias("run_mode"),
        F.lit(bronze_partition).alias("bronze_partition"),
        "movies_processed",
        number(movies.get("n")).alias("silver_movies_total"),
        number(diary_total).alias("silver_diary_total"),
        number(ratings_total).alias("silver_ratings_total"),
        *[number(movies.get(c)).alias(c) for c in AUDIT_STATUSES],
        F.lit(job_status).alias("job_status"),
    )


def kpi_global(diary_facts: DataFrame, movies: DataFrame, silver_movies: DataFrame) -> DataFrame:
    """Films watched, mean personal rating, distinct directors, match rate."""
    views = diary_facts.agg(F.countDistinct("letterboxd_uri").alias("n_films"),
                            F.round(F.avg("my_rating"), 6).alias("avg_rating"))
    directors = movies.select(F.countDistinct("director_id")).scalar()
    rate = enrichment_rate(silver_movies).select("rate").scalar()
    return views.select("n_films", "avg_rating",
                        directors.alias("n_directors"),
                        rate.alias("enrichment_rate"))


TIMELINE_GRAINS = ("year", "quarter", "month", "week", "day")


def timeline(diary_facts: DataFrame, ratings_facts: DataFrame, grain: str = "month") -> DataFrame:
    """A10: films watched and rated per period (configurable grain)."""
    if grain not in TIMELINE_GRAINS:
        raise ValueError(f"grain must be one of {TIMELINE_GRAINS}, not {grain!r}")
    views = diary_facts.select(F.lit("diary").alias("source"),
                               F.col("watched_date").alias("d"), "letterboxd_uri")
    rated = ratings_facts.select(F.lit("ratings").alias("source"),
                                 F.col("rating_date").alias("d"), "letterboxd_uri")
    both = views.unionByName(rated).filter(F.col("d").isNotNull())
    return (both.groupBy("source", F.date_trunc(grain, "d").cast("date").alias("period"))
            .agg(F.count(F.lit(1)).alias("n_entries"),
                 F.countDistinct("letterboxd_uri").alias("n_films")))


def per_film(facts: DataFrame, *extra_keys: str) -> DataFrame:
    """Views per film (and extra keys): count, rated count and rating sum.

    Combined map-side before the shuffle, so a film holding a large share of
    the fact rows arrives at the join below as one row per map task, and the
    joins with film dimensions see one row per film.
    """
    return facts.groupBy("movie_id", *extra_keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.count("my_rating").alias("n_rated"),
        F.sum("my_rating").alias("rating_sum"))


def rating_distribution(ratings_facts: DataFrame, movies: DataFrame) -> DataFrame:
    """Histogram of personal ratings and personal-minus-catalogue mean
    (on a 10-point scale)."""
    m = movies.select("movie_id", "vote_average")
    j = per_film(ratings_facts, "my_rating").join(m, "movie_id", "left")
    has_vote = F.col("vote_average").isNotNull()
    diff_sum = F.sum(F.when(has_vote, F.col("n") * (F.col("my_rating") * 2 - F.col("vote_average"))))
    n_vote = F.sum(F.when(has_vote, F.col("n")))
    return (j.groupBy("my_rating")
            .agg(F.sum("n").alias("n_ratings"),
                 F.coalesce(n_vote, F.lit(0)).alias("n_with_catalogue"),
                 F.round(diff_sum / n_vote, 6).alias("avg_diff_10pt")))


def genre_share(diary_facts: DataFrame, movies: DataFrame) -> DataFrame:
    """Share of viewing minutes per genre. Views are counted per film
    first, joined to the film's unnested genres; the grand total is a scalar
    subquery (no global window, no cross join)."""
    m = movies.select("movie_id", "runtime_minutes",
                      F.explode(F.array_distinct("genres")).alias("genre_name"))
    per_genre = (per_film(diary_facts.filter(F.col("movie_id").isNotNull())).join(m, "movie_id", "inner")
                 .groupBy("genre_name")
                 .agg(F.sum("n").alias("n_views"),
                      F.sum(F.col("n") * F.col("runtime_minutes")).alias("minutes")))
    total = per_genre.select(F.sum("minutes")).scalar()
    return per_genre.withColumn("share", F.round(F.col("minutes") / total, 6))


def fanout_safe_count(bridge: DataFrame, diary_facts: DataFrame) -> DataFrame:
    """Per genre, distinct films viewed vs the inflated row count a naive
    bridge × fact blend would report (views pre-counted per film)."""
    j = per_film(diary_facts.filter(F.col("movie_id").isNotNull())).join(
        bridge.select("movie_id", "genre_name"), "movie_id")
    return j.groupBy("genre_name").agg(F.count(F.lit(1)).alias("n_films"),
                                       F.sum("n").alias("n_views_inflated"))


def unmatched_latest(silver_movies: DataFrame, k: int = 20) -> DataFrame:
    """O2/O3: newest-first films the catalogue did not find (uri breaks ties)."""
    return (silver_movies.filter(F.col("enrichment_status") == "NOT_FOUND")
            .select("letterboxd_uri", "lb_movie_title", "lb_movie_year", "_silver_created_at")
            .orderBy(F.col("_silver_created_at").desc(), F.col("letterboxd_uri").asc())
            .limit(k))


def preview(df, condition, columns, order_by, n: int):
    """O3: the first ``n`` rows of a filtered projection in a stated order
    (a preview; the limit is the feature, the order makes it repeatable)."""
    return df.filter(condition).select(*columns).orderBy(*order_by).limit(n)


def _film_filter(movies: DataFrame, year: int | None, genre: str | None) -> DataFrame:
    if year is not None:
        movies = movies.filter(F.col("release_year") == year)
    if genre is not None:
        movies = movies.filter(F.array_contains("genres", genre))
    return movies


def _avg(sum_col: str = "rating_sum", n_col: str = "n_rated"):
    return F.round(F.sum(sum_col) / F.sum(n_col), 6)


def top_directors(facts: DataFrame, movies: DataFrame, k: int = 10,
                  year: int | None = None, genre: str | None = None) -> DataFrame:
    """Directors by views (name breaks ties), optional year/genre filter."""
    m = _film_filter(movies, year, genre).select("movie_id", "director_name")
    j = per_film(facts.filter(F.col("movie_id").isNotNull())).join(m, "movie_id", "inner")
    return (j.filter(F.col("director_name").isNotNull())
            .groupBy("director_name")
            .agg(F.sum("n").alias("n_views"),
                 F.count(F.lit(1)).alias("n_films"),
                 _avg().alias("avg_rating"))
            .orderBy(F.col("n_views").desc(), F.col("director_name").asc())
            .limit(k))


def top_movies(facts: DataFrame, movies: DataFrame, k: int = 10,
               year: int | None = None, genre: str | None = None) -> DataFrame:
    """Films by views (uri breaks ties), optional year/genre filter."""
    m = _film_filter(movies, year, genre).select("movie_id", "letterboxd_uri", "title")
    j = per_film(facts.filter(F.col("movie_id").isNotNull())).join(m, "movie_id", "inner")
    return (j.select("letterboxd_uri", "title", F.col("n").alias("n_views"),
                     F.round(F.col("rating_sum") / F.col("n_rated"), 6).alias("avg_rating"))
            .orderBy(F.col("n_views").desc(), F.col("letterboxd_uri").asc())
            .limit(k))
