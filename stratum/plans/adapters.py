"""Driver tables -> library inputs.

The driver only provides TPC-H-like tables, so these functions render them in
the shapes the library works on (raw exports, Silver films, a catalogue,
merge and SCD inputs). Every row of every source table is used; faults are
planted by key arithmetic so the cleaning and quality operators have
something to catch. ``stratum.plans.oracle`` repeats each projection in
DuckDB SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

URI_PREFIX = "https://boxd.it/"
RUN_TS = "2024-02-01 00:00:00"
PREVIOUS_RUN_TS = "2024-01-01 00:00:00"
INGESTION_DATE = "2024-01-31"
REWATCH_TOKENS = ["Yes", "yes", "TRUE", "1", "No", "YES"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _uri(key: Column) -> Column:
    return F.concat(F.lit(URI_PREFIX), key.cast("string"))


def _mod(c: str, n: int, r: int = 0) -> Column:
    return (F.col(c) % n) == r


def raw_diary(events: DataFrame) -> DataFrame:
    """Diary export (all text) from ``events``: film = user, day = ts."""
    day = F.date_format("ts", "yyyy-MM-dd")
    half_stars = ((F.floor("value").cast("bigint") % 10) + 1) / F.lit(2.0)
    return events.select(
        "event_id",
        F.when(_mod("event_id", 37), F.date_format("ts", "yyyy/MM/dd"))
         .when(_mod("event_id", 43), F.lit("2023-02-29"))
         .otherwise(day).alias("Date"),
        F.when(_mod("event_id", 29), F.lit("   "))
         .when(_mod("event_id", 31), F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("Film "), F.col("user_id").cast("string"))).alias("Name"),
        F.when(_mod("event_id", 13), F.lit("n/a"))
         .otherwise((F.lit(1950) + F.col("user_id") % 50).cast("string")).alias("Year"),
        F.when(_mod("event_id", 23), F.lit(None).cast("string"))
         .otherwise(_uri(F.col("user_id"))).alias("Letterboxd URI"),
        F.when(_mod("event_id", 11), F.lit(""))
         .when(_mod("event_id", 19), F.lit("3."))
         .when(_mod("event_id", 61), F.lit("9"))
         .when(_mod("event_id", 53), F.lit("-1"))
         .otherwise(half_stars.cast("string")).alias("Rating"),
        F.when(F.col("event_type") == "error", F.lit(None).cast("string"))
         .otherwise(F.element_at(F.array(*[F.lit(t) for t in REWATCH_TOKENS]),
                                 (F.col("event_id") % 6 + 1).cast("int"))).alias("Rewatch"),
        F.when(_mod("event_id", 47), F.lit(""))
         .when(_mod("event_id", 59), F.lit(None).cast("string"))
         .otherwise(F.concat("event_type", F.lit(", k"),
                             F.get_json_object("props", "$.k"))).alias("Tags"),
        F.when(_mod("event_id", 41), F.lit("")).otherwise(day).alias("Watched Date"),
    )


def raw_ratings(lineitem: DataFrame) -> DataFrame:
    """Ratings export from ``lineitem``: film = part, day = ship date."""
    return lineitem.select(
        "l_orderkey", "l_linenumber",
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("Date"),
        F.when(_mod("l_partkey", 97), F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("Film "), F.col("l_partkey").cast("string"))).alias("Name"),
        (F.lit(1950) + F.col("l_partkey") % 50).cast("string").alias("Year"),
        _uri(F.col("l_partkey")).alias("Letterboxd URI"),
        (F.ceil(F.col("l_quantity") / 5) / F.lit(2.0)).cast("string").alias("Rating"),
    )


RATINGS_ORDER = ["l_orderkey", "l_linenumber", "my_rating"]
DIARY_ORDER = ["event_id"]


def raw_watched(part: DataFrame) -> DataFrame:
    """Watched export from ``part``: one row per film."""
    return part.select(
        F.lit("2024-01-15").alias("Date"),
        F.col("p_name").alias("Name"),
        (F.lit(1950) + F.col("p_size")).cast("string").alias("Year"),
        _uri(F.col("p_partkey")).alias("Letterboxd URI"),
    )


def status_by_key(key: Column) -> Column:
    """Enrichment outcome per film: 0 NOT_FOUND, 1 FUZZY_MATCH, 2 ERROR, else SUCCESS."""
    r = key % 10
    return (F.when(r == 0, F.lit("NOT_FOUND")).when(r == 1, F.lit("FUZZY_MATCH"))
            .when(r == 2, F.lit("ERROR")).otherwise(F.lit("SUCCESS")))


def silver_movies(part: DataFrame, status: Column | None = None,
                  vote_bump: Column | None = None, run_ts: str = RUN_TS) -> DataFrame:
    """Silver film table (Silver movies schema) from ``part``."""
    k = F.col("p_partkey")
    status = status_by_key(k) if status is None else status
    vote_bump = F.lit(0) if vote_bump is None else vote_bump
    found = status.isin("SUCCESS", "FUZZY_MATCH")

    def when_found(c: Column) -> Column:
        return F.when(found, c)

    release = (F.when(k % 47 == 0, F.lit("2001-13-45"))
               .otherwise(F.concat((F.lit(1950) + F.col("p_size")).cast("string"), F.lit("-"),
                                   F.lpad((k % 12 + 1).cast("string"), 2, "0"), F.lit("-"),
                                   F.lpad((k % 28 + 1).cast("string"), 2, "0"))))
    genres = F.split(F.when(k % 17 == 0, F.concat_ws(" ", "p_name", "p_name"))
                     .otherwise(F.col("p_name")), " ")
    created = F.timestamp_add("DAY", F.col("p_size"), F.lit(PREVIOUS_RUN_TS).cast("timestamp"))
    return part.select(
        _uri(k).alias("letterboxd_uri"),
        F.col("p_name").alias("lb_movie_title"),
        (F.lit(1950) + F.col("p_size")).cast("int").alias("lb_movie_year"),
        status.alias("enrichment_status"),
        F.lit(run_ts).alias("enrichment_timestamp"),
        when_found((k + 100000).cast("int")).alias("tmdb_id"),
        when_found(F.when(k % 3 != 0, F.upper("p_name"))).alias("tmdb_title"),
        when_found(F.col("p_name")).alias("tmdb_original_title"),
        when_found(release).alias("release_date"),
        when_found(genres).alias("genres"),
        when_found(F.when(k % 83 == 0, F.lit(-1))
                   .otherwise(F.lit(60) + F.col("p_size") * 2).cast("int")).alias("runtime_minutes"),
        when_found(F.when(k % 4 != 0, k * 1000)).cast("bigint").alias("budget_usd"),
        when_found(k * 2500).cast("bigint").alias("revenue_usd"),
        when_found(F.col("p_size") / F.lit(5.0)).alias("vote_average"),
        when_found(F.col("p_size") * 10 + vote_bump).cast("int").alias("vote_count"),
        when_found(F.col("p_type")).alias("overview"),
        when_found(F.lit("en")).alias("original_language"),
        when_found(F.concat(F.lit("/p/"), k.cast("string"), F.lit(".jpg"))).alias("poster_path"),
        when_found(F.col("p_brand")).alias("director_name"),
        when_found(F.substring("p_brand", 7, 10).try_cast("int")).alias("director_tmdb_id"),
        created.alias("_silver_created_at"),
        created.alias("_silver_updated_at"),
        F.lit(INGESTION_DATE).alias("_ingestion_date"),
    )


def _film_title(key: Column, title: Column) -> Column:
    """Titles with planted ones whose normalised form is empty."""
    return (F.when(key % 46 == 0, F.lit("羅生門")).when(key % 23 == 0, F.lit("七人の侍")).otherwise(title))


def match_films(part: DataFrame) -> DataFrame:
    """Films to match: every part; some without a year."""
    k = F.col("p_partkey")
    return part.select(
        _uri(k).alias("letterboxd_uri"),
        _film_title(k, F.col("p_name")).alias("movie_title"),
        F.when(k % 9 == 0, F.lit(None)).otherwise(F.lit(1950) + F.col("p_size"))
         .cast("int").alias("movie_year"),
    )


def match_catalogue(part: DataFrame) -> DataFrame:
    """Catalogue search index: every part, title variants, popularity."""
    k = F.col("p_partkey")
    year = F.lit(1950) + F.col("p_size") + (k % 7) - 3
    title = F.when(k % 3 == 0, F.concat(F.upper("p_name"), F.lit("!"))).otherwise(F.col("p_name"))
    return part.select(
        k.alias("tmdb_id"),
        _film_title(k, title).alias("title"),
        F.when(k % 19 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(year.cast("string"), F.lit("-06-15"))).alias("release_date"),
        F.col("p_retailprice").alias("popularity"),
    )


def search_films(part: DataFrame) -> DataFrame:
    """Films to search for: titles of two names and a brand, some without the
    brand, one in eleven of words that no title has; some without a year."""
    k = F.col("p_partkey")
    title = (F.when(k % 97 == 0, F.lit("...")).when(k % 11 == 0, F.concat(F.lit("Unheard of "), k.cast("string")))
             .when(k % 7 == 0, F.initcap("p_name")).otherwise(F.concat("p_name", F.lit(" "), "p_brand")))
    return part.select(
        _uri(k).alias("letterboxd_uri"), title.alias("movie_title"),
        F.when(k % 9 == 0, F.lit(None)).otherwise(F.lit(1950) + F.col("p_size")).cast("int").alias("movie_year"))


def search_catalogue(part: DataFrame) -> DataFrame:
    """Catalogue entries whose titles hold the same words with accents, hyphens
    or apostrophes, in another order or in capitals; two editions of some."""
    k = F.col("p_partkey")
    plain = F.concat("p_name", F.lit(" "), "p_brand")
    variant = (F.when(k % 5 == 0, F.translate(plain, "aeiou", "áèîöú"))
               .when(k % 5 == 1, F.translate(plain, " ", "-"))
               .when(k % 5 == 2, F.concat("p_brand", F.lit(": the "), "p_name"))
               .when(k % 5 == 3, F.concat(F.upper(plain), F.lit("!")))
               .otherwise(F.regexp_replace(plain, "r", "r'")))
    year = F.lit(1950) + F.col("p_size") + (k % 7) - 3
    return part.select(
        k.alias("tmdb_id"), F.when(k % 101 != 0, variant).alias("title"),
        F.when(k % 19 == 0, F.lit(None).cast("string")).otherwise(F.concat(year.cast("string"), F.lit("-06-15"))).alias("release_date"),
        F.floor("p_retailprice").alias("popularity"))


def catalogue_details(part: DataFrame) -> DataFrame:
    """Catalogue detail payloads (JSON text) of every part: some cut off, some
    with fractional or very large numbers, some without genres."""
    k = F.col("p_partkey")
    base_year = F.lit(1950) + F.col("p_size") + (k % 7) - 3
    year = F.when(k % 11 == 0, base_year + 3).otherwise(base_year)
    payload = F.to_json(F.struct(
        F.col("p_name").alias("title"),
        F.col("p_name").alias("original_title"),
        F.concat(year.cast("string"), F.lit("-06-15")).alias("release_date"),
        F.when(k % 29 != 0, F.transform(F.split("p_name", " "), lambda g: F.struct(g.alias("name")))).alias("genres"),
        (F.col("p_size") * 3).alias("runtime"),
        F.when(k % 4 == 0, F.lit(0)).otherwise(k * 1000).alias("budget"),
        F.lit(0).alias("revenue"),
        (F.col("p_size") / F.lit(5.0)).alias("vote_average"),
        (F.col("p_size").cast("bigint") * F.when(k % 31 == 0, F.lit(10_000_000_000)).otherwise(F.lit(10)))
        .alias("vote_count"),
        F.struct(crew(part_key=k)).alias("credits"),
    ))
    payload = F.when(k % 17 == 0, F.regexp_replace(payload, '"runtime":([0-9]+)', '"runtime":$1.0')).otherwise(payload)
    bad = F.concat(F.lit('{"title": "'), F.col("p_name"))
    return part.select(
        k.alias("tmdb_id"),
        F.when(k % 13 == 0, bad).otherwise(payload).alias("payload"))


def crew(part_key: Column) -> Column:
    """Crew list with zero, one or two 'Director' entries."""
    brand_no = F.substring("p_brand", 7, 10).try_cast("int")
    return F.array(
        F.struct(F.lit("Writer").alias("job"),
                 F.concat(F.lit("Writer "), part_key.cast("string")).alias("name"),
                 part_key.cast("int").alias("id")),
        F.struct(F.when(part_key % 5 == 0, F.lit("Producer")).otherwise(F.lit("Director")).alias("job"),
                 F.col("p_brand").alias("name"), brand_no.alias("id")),
        F.struct(F.when(part_key % 7 == 0, F.lit("Editor")).otherwise(F.lit("Director")).alias("job"),
                 F.concat(F.lit("Co-"), F.col("p_brand")).alias("name"),
                 (brand_no + 1000).alias("id")),
    ).alias("crew")


def film_payloads(part: DataFrame) -> DataFrame:
    """Every film's detail payload (JSON text), keyed by part key."""
    k = F.col("p_partkey")
    payload = F.to_json(F.struct(
        k.alias("id"),
        F.col("p_name").alias("title"),
        F.transform(F.split("p_name", " "), lambda g: F.struct(g.alias("name"))).alias("genres"),
        (F.col("p_size") * 3).alias("runtime"),
        F.when(k % 4 == 0, F.lit(0)).otherwise(k * 1000).alias("budget"),
        F.struct(crew(part_key=k)).alias("credits"),
    ))
    return part.select(k.alias("film_id"), payload.alias("payload"))
