"""Query registry: one callable per operator key, (spark, sf_dir) -> DataFrame.

Every query reads the driver's tables through ``adapters`` and runs whole
tables through the library; outputs use the column names of the matching
DuckDB oracle in ``oracle.py``. Stamp columns are set from fixed run
timestamps so results are reproducible.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import (flag_tokens, normalize_title,
                                 parse_date, safe_divide, safe_rating, safe_year,
                                 split_tags, surrogate_key)
from ..functions.json import (DETAILS_SCHEMA, first_director, genre_names, number,
                              parse_payload, zero_to_null)
from ..functions.columns import year_prefix
from ..operators import match, merge, quality, scd, search
from ..operators.clean import (clean_diary, clean_ratings, clean_watched,
                               dedup_latest)
from ..session import scratch_path
from ..sources import files, tables
from ..sources.rules import expectation_rules
from . import adapters as A
from . import contracts, gold, reports
from .medallion import (DIARY_UPDATE_WHEN, MOVIE_UPDATE_COLUMNS, MOVIE_UPDATE_WHEN,
                        RATINGS_UPDATE_WHEN, model_tests, source_tests)
from pyspark.sql.types import IntegerType, StructField, StructType

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


def _t(spark, sf, name):
    return A.table(spark, sf, name)


# ------------------------------------------------------------ shared builds


def silver_diary(spark, sf, events: DataFrame | None = None, run_ts=A.RUN_TS):
    ev = events if events is not None else _t(spark, sf, "events")
    return clean_diary(A.raw_diary(ev), run_ts, A.INGESTION_DATE, A.DIARY_ORDER)


def silver_ratings(spark, sf, lineitem: DataFrame | None = None, run_ts=A.RUN_TS):
    li = lineitem if lineitem is not None else _t(spark, sf, "lineitem")
    return clean_ratings(A.raw_ratings(li), run_ts, A.INGESTION_DATE, A.RATINGS_ORDER)


def silver_watched(spark, sf):
    return clean_watched(A.raw_watched(_t(spark, sf, "part")), A.RUN_TS, A.INGESTION_DATE)


def silver_movies(spark, sf):
    return A.silver_movies(_t(spark, sf, "part"))


class GoldTables:
    """The Gold star schema, each table built on first use (lazy), in
    dependency order. Queries only pay for the tables they touch. With
    ``written`` each is written once, as the layer run does, so that tables
    and queries built on it do not compute it again; staging stays a view, as
    its casts of written Silver cost less than another copy of every row."""

    VIEWS = ("stg_movies", "stg_diary", "stg_ratings")

    def __init__(self, spark, sf, written=False):
        self.spark, self.sf, self.written, self._built = spark, sf, written, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            df = getattr(self, f"_{name}")()
            self._built[name] = tables.replace_table(df, scratch_path(self.spark, name)) if self.written and name not in self.VIEWS else df
        return self._built[name]

    def _silver_movies(self):
        return silver_movies(self.spark, self.sf)

    def _silver_diary(self):
        return silver_diary(self.spark, self.sf)

    def _silver_ratings(self):
        return silver_ratings(self.spark, self.sf)

    def _dim_date(self):
        return gold.dim_date(self.spark)

    def _stg_movies(self):
        return gold.stg_movies(self["silver_movies"])

    def _snapshot(self):
        return gold.snap_dim_movie(None, self["stg_movies"], A.PREVIOUS_RUN_TS)

    def _dim_director(self):
        return gold.dim_director(self["stg_movies"])

    def _dim_genre(self):
        return gold.dim_genre(self["stg_movies"])

    def _dim_movie(self):
        return gold.dim_movie(self["snapshot"], self["dim_director"])

    def _bridge(self):
        return gold.bridge_movie_genre(self["dim_movie"], self["dim_genre"])

    def _dates(self):
        return gold.date_lookup(self.spark, self["dim_date"])

    def _stg_diary(self):
        return gold.stg_diary(self["silver_diary"])

    def _stg_ratings(self):
        return gold.stg_ratings(self["silver_ratings"])

    def _fact_diary(self):
        return gold.fact_diary_entries(self["stg_diary"], self["dim_movie"], self["dates"])

    def _fact_ratings(self):
        return gold.fact_ratings(self["stg_ratings"], self["dim_movie"], self["dates"])


def gold_tables(spark, sf, written=False) -> GoldTables:
    """The Gold star schema for the driver tables (lazy mapping)."""
    return GoldTables(spark, sf, written)


def _no_stamps(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in df.columns
                       if not c.startswith("_silver_") and not c.startswith("_dbt_")
                       and c != "_source_updated_at"])


# ------------------------------------------------------------ sources / sinks


@query("csv_string_scan")
def q_csv_string_scan(spark, sf):
    path = scratch_path(spark, "events-csv")
    _t(spark, sf, "events").select("event_id", "user_id", "event_type", "props").write.option("header", "true").csv(path)
    return files.read_csv_strings(spark, path).select("event_id", "user_id", "event_type", "props")


@query("missing_inputs")
def q_missing_inputs(spark, sf):
    # events stand for arrivals: three of their types are expected exports, the others are not
    arrived = (F.when(F.col("event_type") == "signup", F.lit("diary"))
               .when(F.col("event_type") == "purchase", F.lit("ratings"))
               .when(F.col("event_type") == "view", F.lit("watched")).otherwise(F.col("event_type")))
    found = _t(spark, sf, "events").select(F.concat(arrived, F.lit(".csv")).alias("name"))
    return files.missing_inputs(found, files.EXPECTED_FILES["letterboxd"])


@query("bronze_lineage")
def q_bronze_lineage(spark, sf):
    out = files.add_bronze_lineage(_t(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), A.INGESTION_DATE,
                                   "letterboxd", "orders.csv")
    return out.drop("_ingested_at")


@query("ingest_summary")
def q_ingest_summary(spark, sf):
    landing = scratch_path(spark, "landing")
    (_t(spark, sf, "events").withColumn("file", F.concat("event_type", F.lit(".csv")))
     .write.option("header", "true").partitionBy("file").csv(landing))
    raw = files.read_csv_strings(spark, landing)
    bronze = files.add_bronze_lineage(raw, A.INGESTION_DATE, "letterboxd", F.col("file"))
    return files.ingest_summary(bronze)


@query("latest_partition")
def q_latest_partition(spark, sf):
    root = scratch_path(spark, "bronze-events")
    (_t(spark, sf, "events").select("event_id", "event_type",
                                    F.date_format("ts", "yyyy-MM-dd").alias("ingestion_date"))
     .hint("rebalance", F.col("ingestion_date"))  # few files for each date
     .write.partitionBy("ingestion_date").parquet(root))
    return files.read_bronze(spark, root).select("event_id", "ingestion_date")


EXPORTED_ORDERS = "stratum_src_orders"


@query("export_reconcile")
def q_export_reconcile(spark, sf):
    """Two exports to one catalog table; the second replaces the first, columns included."""
    src, path = _t(spark, sf, "orders"), scratch_path(spark, "export-orders")
    tables.export_to_catalog(src.select("o_orderkey", F.lit(1).alias("stale")), EXPORTED_ORDERS, path)
    sink = tables.export_to_catalog(src, EXPORTED_ORDERS, path)
    return tables.reconcile(src, sink, "orders").withColumn("same_columns", F.lit(sink.columns == src.columns))


SHIFTED_KEY = 1_000_000_000


@query("schema_sync")
def q_schema_sync(spark, sf):
    part = _t(spark, sf, "part")
    # The new batch is a changed copy of every part: a third of the keys are replaced, the others are new.
    k = F.col("p_partkey")
    old = part.drop("p_size")
    new = part.drop("p_brand").withColumns({
        "p_partkey": F.when(k % 3 == 0, k).otherwise(k + SHIFTED_KEY), "p_retailprice": F.col("p_retailprice") + 1})
    return merge.incremental_merge(old, new, "p_partkey").select(
        "p_partkey", "p_name", "p_type", "p_size", "p_retailprice")


_FILM_SCHEMA = StructType([StructField("id", IntegerType())] + list(DETAILS_SCHEMA.fields))


@query("json_details_project")
def q_json_details_project(spark, sf):
    p = A.film_payloads(_t(spark, sf, "part")).select(parse_payload("payload", _FILM_SCHEMA).alias("p"))
    return p.select(F.col("p.id").cast("bigint").alias("tmdb_id"),
                    F.col("p.title").alias("title"),
                    F.array_join(genre_names(F.col("p.genres")), ",").alias("genres_csv"),
                    number(F.col("p.runtime"), "int").alias("runtime"),
                    zero_to_null(number(F.col("p.budget"), "bigint")).alias("budget"))


@query("json_first_match")
def q_json_first_match(spark, sf):
    p = A.film_payloads(_t(spark, sf, "part")).select(
        "film_id", parse_payload("payload", _FILM_SCHEMA).alias("p"))
    d = first_director(F.col("p.credits.crew"))
    return p.select("film_id", d["name"].alias("director_name"), number(d["id"], "int").alias("director_id"))


# ------------------------------------------------------------ scalar functions


def _raw_diary(spark, sf):
    return A.raw_diary(_t(spark, sf, "events"))


@query("clean_diary")
def q_clean_diary(spark, sf):
    return silver_diary(spark, sf).withColumns({
        "my_rating": F.col("my_rating").cast("double"), "tags": F.array_join("tags", "|")})


@query("parse_dates")
def q_parse_dates(spark, sf):
    return _raw_diary(spark, sf).select("event_id", parse_date("Date").alias("diary_date"),
                                        parse_date("Watched Date").alias("watched_date"))


@query("safe_year")
def q_safe_year(spark, sf):
    return _raw_diary(spark, sf).select("event_id", safe_year("Year").alias("movie_year"))


@query("safe_rating")
def q_safe_rating(spark, sf):
    return _raw_diary(spark, sf).select(
        "event_id", safe_rating("Rating").cast("double").alias("my_rating"))


@query("flag_tokens")
def q_flag_tokens(spark, sf):
    return _raw_diary(spark, sf).select("event_id", flag_tokens("Rewatch").alias("is_rewatch"))


@query("normalize_title")
def q_normalize_title(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", normalize_title("text").alias("title_norm"))


@query("split_tags")
def q_split_tags(spark, sf):
    tags = split_tags("Tags")
    return _raw_diary(spark, sf).select("event_id", F.array_size(tags).alias("n_tags"),
                                        F.try_element_at(tags, F.lit(1)).alias("first_tag"))


@query("surrogate_key")
def q_surrogate_key(spark, sf):
    o = _t(spark, sf, "orders")
    status = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderstatus"))
    return o.select("o_orderkey", surrogate_key("o_orderkey", status).alias("sk"))


@query("safe_divide")
def q_safe_divide(spark, sf):
    li = _t(spark, sf, "lineitem")
    return (li.groupBy("l_orderkey", "l_linenumber")
            .agg(F.sum("l_quantity").alias("q"), F.sum("l_tax").alias("t"))
            .select("l_orderkey", "l_linenumber",
                    F.round(safe_divide("q", "t"), 6).alias("ratio")))


# ------------------------------------------------------------ staging


@query("stg_movies")
def q_stg_movies(spark, sf):
    return _no_stamps(gold.stg_movies(silver_movies(spark, sf)))


@query("stg_diary")
def q_stg_diary(spark, sf):
    return _no_stamps(gold.stg_diary(silver_diary(spark, sf)))


@query("stg_ratings")
def q_stg_ratings(spark, sf):
    return _no_stamps(gold.stg_ratings(silver_ratings(spark, sf)))


# ------------------------------------------------------------ catalogue


def _catalog_union(spark, sf):
    """From the cleaned rows: one reduction by film finds what deduplication
    by film and day, then by film, would leave."""
    def sort_key(a, b=F.lit(0).cast("bigint"), c=F.lit(0.0)):
        return F.struct(a.cast("bigint").alias("a"), b.cast("bigint").alias("b"), c.cast("double").alias("c"))

    d = clean_diary(A.raw_diary(_t(spark, sf, "events")), A.RUN_TS, A.INGESTION_DATE, dedup=False)
    r = clean_ratings(A.raw_ratings(_t(spark, sf, "lineitem")), A.RUN_TS, A.INGESTION_DATE, dedup=False)
    w = clean_watched(A.raw_watched(_t(spark, sf, "part")), A.RUN_TS, A.INGESTION_DATE, dedup=False)
    return match.union_catalog([
        d.withColumns({"sort_date": F.col("watched_date"), "sort_key": sort_key(F.col("event_id"))}),
        r.withColumns({"sort_date": F.col("rating_date"), "sort_key": sort_key(
            F.col("l_orderkey"), F.col("l_linenumber"), F.col("my_rating"))}),
        w.withColumns({"sort_date": F.col("watched_date"), "sort_key": sort_key(F.lit(0))})])


@query("union_catalog")
def q_union_catalog(spark, sf):
    return _catalog_union(spark, sf)


@query("incremental_anti_join")
def q_incremental_anti_join(spark, sf):
    return match.to_enrich(_catalog_union(spark, sf), silver_movies(spark, sf)).select("letterboxd_uri")


def _matched(spark, sf):
    part = _t(spark, sf, "part")
    return match.match_catalogue(A.match_films(part), A.match_catalogue(part))


@query("catalog_match")
def q_catalog_match(spark, sf):
    return _matched(spark, sf).select("letterboxd_uri", "tmdb_id", "match_tier")


def _searched(spark, sf):
    part = _t(spark, sf, "part")
    index = search.Index(A.search_catalogue(part), year_prefix("release_date"))
    return A.search_films(part), index.written(scratch_path(spark, "search-index"))


@query("catalog_match_ranked")
def q_catalog_match_ranked(spark, sf):
    return search.search_catalogue(*_searched(spark, sf)).select("letterboxd_uri", "rank", "tmdb_id", "score")


@query("catalog_match_fuzzy")
def q_catalog_match_fuzzy(spark, sf):
    return search.match_ranked(*_searched(spark, sf)).select("letterboxd_uri", "tmdb_id", "match_tier")


@query("match_status")
def q_match_status(spark, sf):
    part = _t(spark, sf, "part")
    st = match.enrichment_status(_matched(spark, sf),
                                 A.catalogue_details(part).withColumn("tmdb_id", F.col("tmdb_id").cast("bigint")))
    return st.select("letterboxd_uri", "tmdb_id", "enrichment_status", "runtime_minutes", "vote_count",
                     F.size("genres").alias("n_genres"))


@query("dedup_composite")
def q_dedup_composite(spark, sf):
    raw = _raw_diary(spark, sf).select(
        F.col("Letterboxd URI").alias("letterboxd_uri"),
        parse_date("Watched Date").alias("watched_date"), "event_id")
    return dedup_latest(raw, ["letterboxd_uri", "watched_date"], ["event_id"])


# ------------------------------------------------------------ run statistics


@query("status_counts")
def q_status_counts(spark, sf):
    return reports.status_counts(silver_movies(spark, sf))


@query("enrichment_rate")
def q_enrichment_rate(spark, sf):
    return quality.enrichment_rate(silver_movies(spark, sf))


@query("audit_record")
def q_audit_record(spark, sf):
    """Each Silver table is written once, its counts taken on the way; the films
    to process follow from the written tables."""
    def stage(label, df, *more):
        return tables.staged(df, scratch_path(spark, label), F.count(F.lit(1)).alias("n"), *more)

    movies, of_movies = stage("audit-movies", silver_movies(spark, sf).select(
        "letterboxd_uri", "lb_movie_title", "lb_movie_year", "enrichment_status"), *reports.status_metrics())
    diary, of_diary = stage("audit-diary", silver_diary(spark, sf).select(
        "letterboxd_uri", "movie_title", "movie_year", F.col("watched_date").alias("sort_date")))
    ratings, of_ratings = stage("audit-ratings", silver_ratings(spark, sf).select(
        "letterboxd_uri", "movie_title", "movie_year", F.col("rating_date").alias("sort_date")))
    watched = movies.select("letterboxd_uri", F.col("lb_movie_title").alias("movie_title"),
                            F.col("lb_movie_year").alias("movie_year"), F.lit("2024-01-15").cast("date").alias("sort_date"))
    processed = match.to_enrich(match.union_catalog([diary, ratings, watched]), movies)
    return reports.audit_record(of_movies, of_diary["n"], of_ratings["n"], processed,
                                A.RUN_TS, "incremental", A.INGESTION_DATE)


@query("table_assertions")
def q_table_assertions(spark, sf):
    return quality.table_assertions(_t(spark, sf, "orders"), "o_orderkey")


# ------------------------------------------------------------ keyed mutation


HWM_SPLIT = "1998-01-01"


@query("high_water_mark")
def q_high_water_mark(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    existing = o.filter(F.col("o_orderdate") < F.lit(HWM_SPLIT).cast("timestamp"))
    return merge.newer_than(o, existing, "o_orderdate")


@query("high_water_mark_first_load")
def q_high_water_mark_first_load(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return merge.newer_than(o, o.filter(F.lit(False)), "o_orderdate")


def merge_movies(spark, sf):
    part = _t(spark, sf, "part")
    k = F.col("p_partkey")
    # Target: the table before the run. Source: this run's batch = a re-enrichment of half the
    # films plus every film the target lacks (inserts); together they cover every film.
    target = A.silver_movies(part.filter(k % 5 != 0))
    src_status = (F.when(k % 6 == 0, F.lit("FUZZY_MATCH")).when(k % 8 == 0, F.lit("NOT_FOUND"))
                  .otherwise(F.lit("SUCCESS")))
    source = A.silver_movies(part.filter((k % 2 == 0) | (k % 5 == 0)), status=src_status,
                             vote_bump=F.when(k % 3 == 0, F.lit(1)).otherwise(F.lit(0)))
    stamp = F.lit(A.RUN_TS).cast("timestamp")
    source = source.withColumns({"_silver_created_at": stamp, "_silver_updated_at": stamp})
    return merge.merge_upsert(target, source, ["letterboxd_uri"],
                              {c: f"s.{c}" for c in MOVIE_UPDATE_COLUMNS}, MOVIE_UPDATE_WHEN,
                              with_action=True)


@query("merge_conditional")
def q_merge_conditional(spark, sf):
    return merge_movies(spark, sf).select(
        "letterboxd_uri", "enrichment_status", "tmdb_id", "vote_count", "_silver_updated_at",
        F.col(merge.ACTION).alias("action"))


def _diary_batches(spark, sf):
    ev = _t(spark, sf, "events")
    target = silver_diary(spark, sf, ev.filter(F.col("event_id") % 2 == 0), A.PREVIOUS_RUN_TS)
    changed = A.raw_diary(ev).withColumn(
        "Rating", F.when(F.col("event_id") % 3 == 0, F.lit("4.0")).otherwise(F.col("Rating")))
    return target, clean_diary(changed, A.RUN_TS, A.INGESTION_DATE, A.DIARY_ORDER)


@query("merge_composite_key")
def q_merge_composite_key(spark, sf):
    target, source = _diary_batches(spark, sf)
    out = merge.merge_upsert(
        target, source, ["letterboxd_uri", "watched_date"],
        {"my_rating": "s.my_rating", "tags": "s.tags", "_silver_updated_at": "s._silver_updated_at"},
        DIARY_UPDATE_WHEN, with_action=True,
        check_unique=False)  # the cleaner already keeps one row per key
    return out.select("letterboxd_uri", "watched_date",
                      F.col("my_rating").cast("double").alias("my_rating"),
                      F.col(merge.ACTION).alias("action"))


def _ratings_batches(spark, sf):
    li = _t(spark, sf, "lineitem")
    target = silver_ratings(spark, sf, li.filter(F.col("l_orderkey") % 2 == 0), A.PREVIOUS_RUN_TS)
    changed = A.raw_ratings(li).withColumn(
        "Rating", F.when(F.col("l_orderkey") % 3 == 0, F.lit("2.5")).otherwise(F.col("Rating")))
    return target, clean_ratings(changed, A.RUN_TS, A.INGESTION_DATE, A.RATINGS_ORDER)


@query("merge_ratings")
def q_merge_ratings(spark, sf):
    target, source = _ratings_batches(spark, sf)
    out = merge.merge_upsert(
        target, source, ["letterboxd_uri", "rating_date"],
        {"my_rating": "s.my_rating", "_silver_updated_at": "s._silver_updated_at"},
        RATINGS_UPDATE_WHEN, with_action=True,
        check_unique=False)  # the cleaner already keeps one row per key
    return out.select("letterboxd_uri", "rating_date",
                      F.col("my_rating").cast("double").alias("my_rating"),
                      F.col(merge.ACTION).alias("action"))


def _stored_merge(spark, batches, label, date_col, updates, when):
    """Both batches through a stored table partitioned by month."""
    path = scratch_path(spark, label)
    for batch in batches:
        out = tables.upsert_partitions(
            spark, path, batch.withColumn("month", F.trunc(date_col, "month")), ["letterboxd_uri", date_col],
            ["month"], {c: f"s.{c}" for c in updates}, when, check_unique=False)
    return out.select("letterboxd_uri", date_col, F.col("my_rating").cast("double").alias("my_rating"), "month")


@query("stored_merge_diary")
def q_stored_merge_diary(spark, sf):
    return _stored_merge(spark, _diary_batches(spark, sf), "stored-diary", "watched_date",
                         ["my_rating", "tags", "_silver_updated_at"], DIARY_UPDATE_WHEN)


@query("stored_merge_ratings")
def q_stored_merge_ratings(spark, sf):
    return _stored_merge(spark, _ratings_batches(spark, sf), "stored-ratings", "rating_date",
                         ["my_rating", "_silver_updated_at"], RATINGS_UPDATE_WHEN)


SCD_CHECK = ["c_acctbal", "c_mktsegment"]
SCD_AS_OF = "2024-01-15 00:00:00"


def _scd_runs(spark, sf):
    c = _t(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    k = F.col("c_custkey")
    first = c.filter(k % 11 != 0)
    # run 1 lacks keys % 11 (they arrive in run 2); run 2 lacks keys % 13 that run 1 had
    # (they vanish and stay open); every customer appears in at least one run
    second = c.filter((k % 13 != 0) | (k % 11 == 0)).withColumns({
        "c_acctbal": F.when(k % 7 == 0, F.col("c_acctbal") + 100).otherwise(F.col("c_acctbal")),
        "c_name": F.when(k % 5 == 0, F.concat("c_name", F.lit(" (renamed)"))).otherwise(F.col("c_name")),
    })
    h1 = scd.scd2_apply(None, first, "c_custkey", SCD_CHECK, A.PREVIOUS_RUN_TS)
    h2 = scd.scd2_apply(h1, second, "c_custkey", SCD_CHECK, A.RUN_TS)
    return h1, h2


def _scd_out(df):
    return df.select("c_custkey", "c_name", "c_acctbal",
                     F.col(scd.VALID_FROM).alias("valid_from"),
                     F.col(scd.VALID_TO).alias("valid_to"),
                     F.col(scd.SCD_ID).alias("scd_id"))


@query("scd2_initial")
def q_scd2_initial(spark, sf):
    return _scd_out(_scd_runs(spark, sf)[0])


@query("scd2_changes")
def q_scd2_changes(spark, sf):
    return _scd_out(_scd_runs(spark, sf)[1])


@query("scd2_current")
def q_scd2_current(spark, sf):
    return _scd_out(scd.scd2_current(_scd_runs(spark, sf)[1]))


@query("scd2_as_of")
def q_scd2_as_of(spark, sf):
    return _scd_out(scd.scd2_as_of(_scd_runs(spark, sf)[1], SCD_AS_OF))


@query("stored_scd2")
def q_stored_scd2(spark, sf):
    """A stored history over three runs, the last two of one stamp: the third
    run changes other customers, and some of the second run's again."""
    c = _t(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    k = F.col("c_custkey")

    def changed(*steps):
        value = F.col("c_acctbal")
        for when, by in steps:
            value = F.when(when, value + by).otherwise(value)
        return c.withColumn("c_acctbal", value)

    path = scratch_path(spark, "stored-scd2")
    for batch, stamp in ((c.filter(k % 11 != 0), A.PREVIOUS_RUN_TS), (changed((k % 7 == 0, 100)), A.RUN_TS),
                         (changed((k % 7 == 0, 100), (k % 5 == 0, 10), (k % 21 == 0, 1)), A.RUN_TS)):
        out = tables.snapshot_scd2(spark, path, batch, "c_custkey", SCD_CHECK, stamp)
    return _scd_out(out)


def _fact_batches(spark, sf, first=(), second=()):
    """Two builds of a fact over all orders, with extra columns each."""
    o = _t(spark, sf, "orders")
    early = F.col("o_orderdate") < F.lit(HWM_SPLIT).cast("timestamp")
    restated = early & (F.col("o_orderkey") % 10 == 0)

    def build(df, price, stamp, created, more):
        return df.select(surrogate_key("o_orderkey").alias("fact_id"), "o_orderkey",
                         price.alias("o_totalprice"), stamp.alias("updated_at"),
                         F.lit(created).cast("timestamp").alias("created_at"), *more)

    v1 = build(o.filter(early), F.col("o_totalprice"), F.col("o_orderdate"), A.PREVIOUS_RUN_TS, first)
    v2 = build(o, F.when(restated, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")),
               F.when(restated, F.lit("2002-01-01").cast("timestamp")).otherwise(F.col("o_orderdate")),
               A.RUN_TS, second)
    return v1, v2


@query("incremental_fact")
def q_incremental_fact(spark, sf):
    v1, v2 = _fact_batches(spark, sf)
    return merge.incremental_merge(v1, v2, "fact_id", stamp_col="updated_at", keep_first=["created_at"])


@query("stored_incremental_fact")
def q_stored_incremental_fact(spark, sf):
    """A stored fact over two runs; the second adds one column and drops one."""
    month = F.trunc("o_orderdate", "month").alias("month")
    path = scratch_path(spark, "stored-fact")
    for batch in _fact_batches(spark, sf, ["o_orderstatus", month], ["o_custkey", month]):
        out = tables.load_incremental_partitions(spark, path, batch, "fact_id", ["month"], "updated_at",
                                                 keep_first=["created_at"])
    return out


@query("stored_fact_late_films")
def q_stored_fact_late_films(spark, sf):
    """Diary facts stored while a third of the films is missing; these arrive
    later, and only facts without a film get its key and a new stamp."""
    path = scratch_path(spark, "late-films")
    films = gold_tables(spark, sf)["dim_movie"].select("letterboxd_uri", "movie_id")
    late = F.col("letterboxd_uri").rlike("[147]$")
    facts = gold.fact_diary_entries(gold_tables(spark, sf)["stg_diary"], films.filter(~late),
                                    gold.date_lookup(spark), A.PREVIOUS_RUN_TS)
    tables.load_incremental_partitions(spark, path, facts.withColumn("month", F.trunc("watched_date", "month")),
                                       "diary_entry_id", ["month"], "_source_updated_at")
    # The later lookup gives another key to films that were known: their facts keep the first one.
    later = films.withColumn("movie_id", F.when(late, F.col("movie_id")).otherwise(F.lit("changed")))
    out = tables.refresh_null_keys(spark, path, later, "letterboxd_uri", "movie_id", "diary_entry_id", ["month"],
                                   {"_dbt_updated_at": F.lit(A.RUN_TS).cast("timestamp")})
    return out.select("diary_entry_id", "movie_id", "letterboxd_uri", "watched_date", "month",
                      (F.col("_dbt_updated_at") == F.lit(A.RUN_TS).cast("timestamp")).alias("repaired"))


# ------------------------------------------------------------ gold models


@query("dim_date")
def q_dim_date(spark, sf):
    """The date columns of every day on which something was ordered or shipped."""
    days = _t(spark, sf, "orders").select(F.to_date("o_orderdate").alias("date_day")).union(
        _t(spark, sf, "lineitem").select(F.to_date("l_shipdate")))
    return gold.calendar(days.filter("date_day is not null").distinct())


@query("dim_director")
def q_dim_director(spark, sf):
    return gold.dim_director(gold.stg_movies(silver_movies(spark, sf)))


@query("dim_genre")
def q_dim_genre(spark, sf):
    return gold.dim_genre(gold.stg_movies(silver_movies(spark, sf)))


@query("dim_movie")
def q_dim_movie(spark, sf):
    return gold_tables(spark, sf)["dim_movie"]


@query("bridge_movie_genre")
def q_bridge_movie_genre(spark, sf):
    return gold_tables(spark, sf)["bridge"]


@query("fact_diary")
def q_fact_diary(spark, sf):
    return _no_stamps(gold_tables(spark, sf)["fact_diary"])


@query("fact_ratings")
def q_fact_ratings(spark, sf):
    return _no_stamps(gold_tables(spark, sf)["fact_ratings"])


# ------------------------------------------------------------ data quality


def _dq_out(df):
    return df.select("table_name", "rule", "total", "failed", "pass_ratio")


@query("dq_not_null")
def q_dq_not_null(spark, sf):
    g = gold_tables(spark, sf)
    return _dq_out(quality.evaluate(g["fact_ratings"], "fact_ratings", [
        {"kind": "not_null", "column": "rating_id"},
        {"kind": "not_null", "column": "rating_date_id"},
        {"kind": "not_null", "column": "movie_id"},
    ]))


@query("dq_unique")
def q_dq_unique(spark, sf):
    return _dq_out(quality.evaluate_all([
        ("lineitem", _t(spark, sf, "lineitem"),
         [{"kind": "unique", "column": ["l_orderkey", "l_linenumber"]}]),
        ("orders", _t(spark, sf, "orders"), [{"kind": "unique", "column": "o_orderkey"}]),
    ]))


@query("dq_accepted_values")
def q_dq_accepted_values(spark, sf):
    return _dq_out(quality.evaluate_all([
        ("silver_movies", silver_movies(spark, sf),
         [{"kind": "accepted_values", "column": "enrichment_status",
           "values": contracts.ACCEPTED_STATUSES}]),
        ("orders", _t(spark, sf, "orders"),
         [{"kind": "accepted_values", "column": "o_orderstatus", "values": ["F", "O"]}]),
    ]))


@query("dq_relationships")
def q_dq_relationships(spark, sf):
    labels = _t(spark, sf, "labels")
    orphaned = labels.withColumn("doc_id", F.when(F.col("doc_id") % 10 == 3, F.col("doc_id") + 1_000_000_000)
                                 .otherwise(F.col("doc_id")))
    g = gold_tables(spark, sf, written=True)
    return _dq_out(quality.evaluate_all([
        ("labels", orphaned, [{"kind": "relationship", "column": "doc_id",
                               "parent": _t(spark, sf, "documents")}]),
        ("fact_diary_entries", g["fact_diary"],
         [{"kind": "relationship", "column": "movie_id", "parent": g["dim_movie"],
           "where": "movie_id IS NOT NULL"}]),
    ]))


@query("dq_range")
def q_dq_range(spark, sf):
    g = gold_tables(spark, sf, written=True)
    return _dq_out(quality.evaluate_all([
        ("fact_ratings", g["fact_ratings"],
         [{"kind": "range", "column": "my_rating", **contracts.rating_bounds()}]),
        ("fact_diary_entries", g["fact_diary"],
         [{"kind": "range", "column": "my_rating", **contracts.rating_bounds(),
           "where": "my_rating IS NOT NULL"},
          {"kind": "range", "name": "range_strict_nulls(my_rating)", "column": "my_rating",
           **contracts.rating_bounds(), "ignore_null": False}]),
        ("dim_movie", g["dim_movie"],
         [{"kind": "range", "column": "release_year", "min": 1888, "max": 2030, "ignore_null": True}]),
    ]))


@query("dq_regex")
def q_dq_regex(spark, sf):
    g = gold_tables(spark, sf)
    return _dq_out(quality.evaluate_all([
        ("fact_diary_entries", g["fact_diary"],
         [{"kind": "regex", "column": "letterboxd_uri", "regex": contracts.uri_regex()}]),
        ("pages", _t(spark, sf, "pages"),
         [{"kind": "regex", "column": "url", "regex": r"^https://[a-z.]+\.example\.(com|org|net)/"}]),
    ]))


@query("dq_row_condition")
def q_dq_row_condition(spark, sf):
    g = gold_tables(spark, sf, written=True)
    return _dq_out(quality.evaluate_all([
        ("fact_diary_entries", g["fact_diary"],
         [{"kind": "row_condition", "column": "watched_date",
           "expression": "watched_date <= DATE'2024-12-31'"}]),
        ("dim_movie", g["dim_movie"],
         [{"kind": "row_condition", "column": "runtime_minutes",
           "expression": "runtime_minutes >= 0"}]),
    ]))


def contract_results(spark, sf) -> DataFrame:
    g = gold_tables(spark, sf, written=True)
    return quality.evaluate_all([
        ("dim_movie", g["dim_movie"], expectation_rules(contracts.DIM_MOVIE_RULES)),
        ("fact_diary_entries", g["fact_diary"], expectation_rules(contracts.FACT_DIARY_ENTRIES_RULES)),
        ("fact_ratings", g["fact_ratings"], expectation_rules(contracts.FACT_RATINGS_RULES)),
    ])


@query("dq_contract_report")
def q_dq_contract_report(spark, sf):
    return contract_results(spark, sf).select(
        "table_name", "rule", "column_name", "dimension", "total", "passed", "pass_ratio", "ok")


@query("dq_model_tests")
def q_dq_model_tests(spark, sf):
    g = gold_tables(spark, sf, written=True)
    of_sources = source_tests({"src_silver_movies": g["silver_movies"], "src_silver_diary_entries": g["silver_diary"],
                               "src_silver_ratings": g["silver_ratings"]})
    return of_sources.unionAll(model_tests({
        "stg_silver_movies": g["stg_movies"], "stg_silver_diary_entries": g["stg_diary"], "stg_silver_ratings": g["stg_ratings"],
        "dim_date": g["dim_date"], "dim_director": g["dim_director"], "dim_genre": g["dim_genre"],
        "dim_movie": g["dim_movie"], "bridge_movie_genre": g["bridge"], "fact_diary_entries": g["fact_diary"],
        "fact_ratings": g["fact_ratings"]})).select("table_name", "rule", "total", "failed", "ok")


@query("dq_scorecard")
def q_dq_scorecard(spark, sf):
    """A results history of two runs, the second written twice: it counts once."""
    path = scratch_path(spark, "results-history")
    tables.write_run(contract_results(spark, sf), path, A.PREVIOUS_RUN_TS)
    for _ in range(2):
        history = tables.write_run(
            tables.read_runs(spark, path).filter(F.col("run_id") == A.PREVIOUS_RUN_TS), path, A.RUN_TS)
    return quality.scorecard(history).select(
        "table_name", "dimension", "run_id", "total", "passed", "score", "is_perfect")


# ------------------------------------------------------------ dashboard


@query("kpi_global")
def q_kpi_global(spark, sf):
    g = gold_tables(spark, sf)
    # the films seen and their ratings are staging's; film and date keys are not part of the answer
    return reports.kpi_global(g["stg_diary"], g["dim_movie"], g["silver_movies"])


@query("timeline_month")
def q_timeline_month(spark, sf):
    g = gold_tables(spark, sf)  # film and date keys are not part of the answer: staging has all it needs
    return reports.timeline(g["stg_diary"], g["stg_ratings"], "month")


@query("timeline_year")
def q_timeline_year(spark, sf):
    g = gold_tables(spark, sf)  # film and date keys are not part of the answer: staging has all it needs
    return reports.timeline(g["stg_diary"], g["stg_ratings"], "year")


@query("rating_distribution")
def q_rating_distribution(spark, sf):
    g = gold_tables(spark, sf)
    return reports.rating_distribution(g["fact_ratings"], g["dim_movie"])


@query("genre_share")
def q_genre_share(spark, sf):
    g = gold_tables(spark, sf)
    return reports.genre_share(g["fact_diary"], g["dim_movie"])


@query("fanout_safe_count")
def q_fanout_safe_count(spark, sf):
    g = gold_tables(spark, sf)
    return reports.fanout_safe_count(g["bridge"], g["fact_diary"])


@query("unmatched_latest")
def q_unmatched_latest(spark, sf):
    return reports.unmatched_latest(silver_movies(spark, sf))


@query("preview_enriched")
def q_preview_enriched(spark, sf):
    return reports.preview(silver_movies(spark, sf), F.col("enrichment_status") == "SUCCESS",
                           ["lb_movie_title", "lb_movie_year", "tmdb_id", "director_name",
                            "vote_average", "runtime_minutes", "letterboxd_uri"],
                           [F.col("letterboxd_uri")], 5)


@query("preview_not_found")
def q_preview_not_found(spark, sf):
    return reports.preview(silver_movies(spark, sf), F.col("enrichment_status") == "NOT_FOUND",
                           ["lb_movie_title", "lb_movie_year", "letterboxd_uri"],
                           [F.col("letterboxd_uri")], 10)


@query("top_directors")
def q_top_directors(spark, sf):
    g = gold_tables(spark, sf)
    return reports.top_directors(g["fact_ratings"], g["dim_movie"], k=10)


@query("top_movies")
def q_top_movies(spark, sf):
    g = gold_tables(spark, sf)
    return reports.top_movies(g["fact_ratings"], g["dim_movie"], k=10, genre="widget")


@query("top_movies_year")
def q_top_movies_year(spark, sf):
    g = gold_tables(spark, sf)
    return reports.top_movies(g["fact_ratings"], g["dim_movie"], k=10, year=1975)
