"""Run the layers end to end: landing -> Bronze -> Silver -> Gold.

Plain function calls in dependency order in one session. Every layer is
written to shared storage before the next one reads it, so lineage stays
short: a lost executor re-runs tasks of the current step only, and a failed
run restarts from the last table written. Tables live under one root:

    <root>/bronze/<table>/ingestion_date=<date>/
    <root>/silver/{movies,_audit_log}, <root>/silver/diary_entries/watched_month=<month>/,
    <root>/silver/ratings/rating_month=<month>/
    <root>/gold/snap_dim_movie/_closed_run=<run>/ (NULL = open versions)
    <root>/gold/{dim_date,dim_director,dim_genre,dim_movie,
                 bridge_movie_genre,dq_results}
    <root>/gold/fact_diary_entries/watched_month=<month>/, <root>/gold/fact_ratings/rating_month=<month>/
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import match, quality
from ..operators.clean import clean_diary, clean_ratings, clean_watched
from ..sources import files, tables
from ..sources.rules import expectation_rules, model_test_rules
from . import contracts, gold, reports

# The match-rate floor, the tables' merge keys, columns and clauses.
MIN_MATCH_RATE = 0.70
SILVER_KEYS = {
    "movies": ["letterboxd_uri"],
    "diary_entries": ["letterboxd_uri", "watched_date"],
    "ratings": ["letterboxd_uri", "rating_date"],
}
MOVIE_UPDATE_COLUMNS = ["tmdb_id", "tmdb_title", "tmdb_original_title", "release_date", "genres",
                        "runtime_minutes", "budget_usd", "revenue_usd", "vote_average",
                        "vote_count", "overview", "original_language", "poster_path",
                        "director_name", "director_tmdb_id", "enrichment_status",
                        "_silver_updated_at"]
MOVIE_UPDATE_WHEN = ("s.enrichment_status = 'SUCCESS' AND (t.enrichment_status != 'SUCCESS' "
                     "OR s.vote_count > t.vote_count OR t.tmdb_id IS NULL)")
DIARY_UPDATE_WHEN = "s.my_rating IS NOT NULL AND s.my_rating != t.my_rating"
RATINGS_UPDATE_WHEN = "s.my_rating != t.my_rating"
SILVER_MOVIE_COLUMNS = ["letterboxd_uri", "lb_movie_title", "lb_movie_year", "enrichment_status",
                        "enrichment_timestamp", "tmdb_id", "tmdb_title", "tmdb_original_title",
                        "release_date", "genres", "runtime_minutes", "budget_usd", "revenue_usd",
                        "vote_average", "vote_count", "overview", "original_language",
                        "poster_path", "director_name", "director_tmdb_id",
                        "_silver_created_at", "_silver_updated_at", "_ingestion_date"]
BRONZE_TABLES = ["diary", "ratings", "watched", "reviews", "watchlist"]


def land(spark: SparkSession, landing: str, root: str, run_date: str,
         source: str = "letterboxd") -> DataFrame:
    """Entry point A: every landing CSV -> Bronze; returns the summary."""
    return files.ingest_landing(spark, landing, f"{root}/bronze", run_date, source, BRONZE_TABLES)


def _enriched_movies(todo: DataFrame, catalogue: DataFrame, details: DataFrame,
                     run_ts: str, run_date: str) -> DataFrame:
    stamp = F.lit(run_ts).cast("timestamp")
    st = match.enrichment_status(match.match_catalogue(todo, catalogue), details)
    return st.select(
        "letterboxd_uri", F.col("movie_title").alias("lb_movie_title"),
        F.col("movie_year").cast("int").alias("lb_movie_year"), "enrichment_status",
        F.lit(run_ts).alias("enrichment_timestamp"), F.col("tmdb_id").cast("int").alias("tmdb_id"),
        "tmdb_title", "tmdb_original_title", "release_date", "genres",
        F.col("runtime_minutes").cast("int"), F.col("budget_usd").cast("bigint"),
        F.col("revenue_usd").cast("bigint"), F.col("vote_average").cast("double"),
        F.col("vote_count").try_cast("int").alias("vote_count"), "overview", "original_language", "poster_path",
        "director_name", F.col("director_tmdb_id").cast("int"),
        stamp.alias("_silver_created_at"), stamp.alias("_silver_updated_at"),
        F.lit(run_date).alias("_ingestion_date"))


def build_silver(spark: SparkSession, root: str, catalogue: DataFrame, details: DataFrame,
                 run_ts: str, run_date: str | None = None, run_mode: str = "incremental",
                 min_match_rate: float = MIN_MATCH_RATE) -> dict[str, DataFrame]:
    """Entry point B: Bronze -> Silver (clean, match, MERGE, assert, audit).
    Stops when fewer films than ``min_match_rate`` are matched."""
    bronze = f"{root}/bronze"
    date = files.latest_partition(spark, f"{bronze}/diary", run_date)
    raw = {t: files.read_bronze(spark, f"{bronze}/{t}", date) for t in ("diary", "ratings", "watched")}
    # Duplicates inside one export carry no order; the survivor is the
    # greatest row by content, so reruns pick the same one.
    diary = clean_diary(raw["diary"], run_ts, date)
    ratings = clean_ratings(raw["ratings"], run_ts, date)
    watched = clean_watched(raw["watched"], run_ts, date)

    silver = f"{root}/silver"
    movies_path = f"{silver}/movies"
    films = match.union_catalog([diary.withColumn("sort_date", F.col("watched_date")),
                                 ratings.withColumn("sort_date", F.col("rating_date")),
                                 watched.withColumn("sort_date", F.col("watched_date"))])
    existing = tables.read_table(spark, movies_path) if tables.table_exists(spark, movies_path) else None
    todo = match.to_enrich(films, existing, full_refresh=(run_mode == "full_refresh"))
    # The batch to merge is written once, so the MERGE, the audit counts and
    # a retry after a lost executor all read the same rows.
    batch = tables.replace_table(_enriched_movies(todo, catalogue, details, run_ts, date),
                                 f"{silver}/_batches/movies")
    out = {
        "movies": tables.upsert_table(spark, movies_path, batch.select(*SILVER_MOVIE_COLUMNS),
                                      SILVER_KEYS["movies"],
                                      {c: f"s.{c}" for c in MOVIE_UPDATE_COLUMNS}, MOVIE_UPDATE_WHEN),
        # Diary and ratings are partitioned by the month of their key date, so
        # a run rewrites only the months its batch touches.
        "diary_entries": tables.upsert_partitions(
            spark, f"{silver}/diary_entries",
            diary.withColumn("watched_month", F.trunc("watched_date", "month")),
            SILVER_KEYS["diary_entries"], ["watched_month"],
            {"my_rating": "s.my_rating", "tags": "s.tags",
             "_silver_updated_at": "s._silver_updated_at"}, DIARY_UPDATE_WHEN,
            check_unique=False),  # deduplicated on the merge keys by the cleaner
        "ratings": tables.upsert_partitions(
            spark, f"{silver}/ratings",
            ratings.withColumn("rating_month", F.trunc("rating_date", "month")),
            SILVER_KEYS["ratings"], ["rating_month"],
            {"my_rating": "s.my_rating", "_silver_updated_at": "s._silver_updated_at"},
            RATINGS_UPDATE_WHEN, check_unique=False),
    }
    # One aggregate for each table: the assertions' and the audit's counts.
    counts = {name: quality.assert_table(df, "letterboxd_uri", f"silver_{name}",
                                         reports.status_metrics() if name == "movies" else [])
              for name, df in out.items()}
    quality.assert_rate(counts["movies"]["tmdb_success"], counts["movies"]["n_rows"], min_match_rate)
    audit = reports.audit_record({"n": counts["movies"]["n_rows"], **counts["movies"]}, counts["diary_entries"]["n_rows"],
                                 counts["ratings"]["n_rows"], batch, run_ts, run_mode, date)
    # A run repeated under the same stamp replaces its record.
    out["audit"] = tables.write_run(audit, f"{silver}/_audit_log", run_ts)
    return out


SILVER_EXPORTS = {"movies": "src_silver_movies", "diary_entries": "src_silver_diary_entries",
                  "ratings": "src_silver_ratings"}


def export_silver(spark: SparkSession, root: str, sink_root: str | None = None, database: str | None = None) -> DataFrame:
    """Silver -> warehouse staging: full replace of each sink table, then a
    count reconciliation (one row per table; source and sink counts are
    scalar subqueries, read lazily). The sinks are Parquet folders under
    ``sink_root``, or tables of the catalog's ``database`` (whose files lie
    under ``sink_root`` if that is given too, else in the warehouse)."""
    from functools import reduce
    parts = []
    for name, sink in SILVER_EXPORTS.items():
        src = tables.read_table(spark, f"{root}/silver/{name}")
        out = (tables.export_to_catalog(src, f"{database}.{sink}", sink_root and f"{sink_root}/{sink}") if database
               else tables.export_table(src, f"{sink_root}/{sink}"))
        parts.append(tables.reconcile(src, out, sink))
    return reduce(lambda a, b: a.unionByName(b), parts)


def build_gold(spark: SparkSession, root: str, run_ts: str, refresh_null_keys: bool = False,
               gate_sources: bool = False) -> dict[str, DataFrame]:
    """Entry point C: Silver -> Gold (snapshot, dimensions, bridge, facts, DQ).

    ``refresh_null_keys`` gives facts without a film the key of a film that
    has arrived since. The model tests stop the run; the tests of the Silver
    tables do so only with ``gate_sources``, as staging drops the rows that
    they name. A run repeated under the same stamp replaces its results."""
    silver, g = f"{root}/silver", f"{root}/gold"
    sources = {f"src_silver_{t}": tables.read_table(spark, f"{silver}/{t}") for t in ("movies", "diary_entries", "ratings")}
    stg_m = gold.stg_movies(sources["src_silver_movies"])
    stg_d = gold.stg_diary(sources["src_silver_diary_entries"])
    stg_r = gold.stg_ratings(sources["src_silver_ratings"])

    # Snapshot history: closed versions are append-only; a run rewrites the
    # open versions and adds the ones it closes.
    snap = tables.snapshot_scd2(spark, f"{g}/snap_dim_movie", gold.snapshot_source(stg_m),
                                gold.SNAPSHOT_KEY, gold.SNAPSHOT_CHECK_COLS, run_ts)
    dates = tables.materialize(gold.dim_date(spark, run_ts=run_ts), "table", "dim_date", f"{g}/dim_date")
    directors = tables.materialize(gold.dim_director(stg_m, run_ts), "table", "dim_director",
                                   f"{g}/dim_director")
    genres = tables.materialize(gold.dim_genre(stg_m, run_ts), "table", "dim_genre", f"{g}/dim_genre")
    movies = tables.materialize(gold.dim_movie(snap, directors, run_ts), "table", "dim_movie",
                                f"{g}/dim_movie")
    bridge = tables.materialize(gold.bridge_movie_genre(movies, genres, run_ts), "table",
                                "bridge_movie_genre", f"{g}/bridge_movie_genre")
    lookup = gold.date_lookup(spark, dates)
    # Facts are partitioned by the month of their date (part of the unique
    # key), so an incremental load rewrites only the months it touches.
    facts = {}
    for name, built, key, date_col in (
            ("fact_diary_entries", gold.fact_diary_entries(stg_d, movies, lookup, run_ts),
             "diary_entry_id", "watched_date"),
            ("fact_ratings", gold.fact_ratings(stg_r, movies, lookup, run_ts), "rating_id",
             "rating_date")):
        built = built.withColumn(f"{date_col[:-5]}_month", F.trunc(date_col, "month"))
        facts[name] = tables.load_incremental_partitions(
            spark, f"{g}/{name}", built, key, [f"{date_col[:-5]}_month"], "_source_updated_at",
            keep_first=["_dbt_created_at"])
        if refresh_null_keys:
            facts[name] = tables.refresh_null_keys(
                spark, f"{g}/{name}", movies, "letterboxd_uri", "movie_id", key, [f"{date_col[:-5]}_month"],
                {"_dbt_updated_at": F.lit(run_ts).cast("timestamp")})
    results = tables.write_run(quality.evaluate_all([
        ("dim_movie", movies, expectation_rules(contracts.DIM_MOVIE_RULES)),
        ("fact_diary_entries", facts["fact_diary_entries"],
         expectation_rules(contracts.FACT_DIARY_ENTRIES_RULES)),
        ("fact_ratings", facts["fact_ratings"], expectation_rules(contracts.FACT_RATINGS_RULES)),
    ]), f"{g}/dq_results", run_ts)
    models = {"stg_silver_movies": stg_m, "stg_silver_diary_entries": stg_d, "stg_silver_ratings": stg_r,
              "dim_date": dates, "dim_director": directors, "dim_genre": genres, "dim_movie": movies,
              "bridge_movie_genre": bridge, **facts}
    # The model tests gate the run; their results are kept either way.
    tests = tables.replace_table(model_tests(models), f"{g}/model_test_results")
    of_sources = tables.replace_table(source_tests(sources), f"{g}/source_test_results")
    quality.assert_rules(tests.union(of_sources) if gate_sources else tests)
    return {"snapshot": snap, "dim_date": dates, "dim_director": directors, "dim_genre": genres,
            "dim_movie": movies, "bridge_movie_genre": bridge, **facts,
            "dq_results": results, "model_test_results": tests, "source_test_results": of_sources}


def model_tests(models: dict[str, DataFrame]) -> DataFrame:
    """One result row for every model test of the given tables."""
    rules = model_test_rules(contracts.MODEL_TESTS, models)
    return quality.evaluate_all([(name, models[name], rules[name]) for name in rules])


def source_tests(sources: dict[str, DataFrame]) -> DataFrame:
    """One result row for every test of the Silver tables, as staging finds them."""
    rules = model_test_rules(contracts.SOURCE_TESTS)
    return quality.evaluate_all([(name, sources[name], rules[name]) for name in rules])
