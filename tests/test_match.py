import json

from pyspark.sql import functions as F

from stratum.operators.match import enrichment_status, match_catalogue, to_enrich

from .conftest import rows

CAT = "tmdb_id long, title string, release_date string, popularity double"
FILMS = "letterboxd_uri string, movie_title string, movie_year int"


def catalogue(spark):
    return spark.createDataFrame([
        (1, "Alpha", "2000-01-01", 9.0),   # alpha: exact year 2000
        (2, "ALPHA!", "1990-01-01", 10.0),  # alpha: best ranked
        (10, "Beta", "2003-01-01", 9.0),    # beta rank 1: off by 2 from 2001 -> near
        (11, "Beta", "2010-01-01", 10.0),   # beta rank 0
        (20, "Gamma", "2010-01-01", 9.0),   # gamma: off by 3 only
        (30, "Delta", "1980-01-01", 10.0),  # delta: ranks 1-3 too far, rank 4 close
        (31, "Delta", "1981-01-01", 9.0),
        (32, "Delta", "1982-01-01", 8.0),
        (33, "Delta", "2005-01-01", 7.0),
        (40, "Eps", None, 5.0),
    ], CAT)


def test_catalogue_tiers(spark):
    films = spark.createDataFrame([
        ("exact", "alpha", 2000), ("near", "beta", 2001), ("far", "gamma", 2007),
        ("rank4", "delta", 2006), ("noyear", "ALPHA", None), ("notitle", "zeta", 2000),
        ("nulltitle", None, 2000),
    ], FILMS)
    got = {r.letterboxd_uri: (r.tmdb_id, r.match_tier)
           for r in match_catalogue(films, catalogue(spark)).collect()}
    assert got == {
        "exact": (1, "EXACT_YEAR"), "near": (10, "NEAR_YEAR"), "far": (None, None),
        "rank4": (None, None), "noyear": (2, "TITLE_ONLY"), "notitle": (None, None),
        "nulltitle": (None, None),
    }


def test_titles_without_latin_letters_do_not_match_each_other(spark):
    cat = spark.createDataFrame([(1, "羅生門", "1950-08-26", 9.0), (2, "七人の侍", "1954-04-26", 8.0),
                                 (3, "???", "1950-01-01", 9.5), (4, None, "1950-01-01", 9.9), (5, "  ", None, 1.0)], CAT)
    films = spark.createDataFrame([("r", "羅生門", 1950), ("s", "七人の侍", 1953), ("k", "기생충", None), ("q", "!!!", 1950),
                                   ("blank", " ", 1950), ("null", None, 1950)], FILMS)
    got = {r.letterboxd_uri: r.tmdb_id for r in match_catalogue(films, cat).collect()}
    assert got == {"r": 1, "s": 2, "k": None, "q": None, "blank": None, "null": None}


def test_odd_numbers_and_missing_genres_are_not_errors(spark):
    matched = spark.createDataFrame([("a", "t", 2000, 1), ("b", "t", 2000, 2)], FILMS + ", tmdb_id long")
    details = spark.createDataFrame([
        (1, '{"title": "t", "runtime": 101.0, "vote_count": 99999999999, "budget": 5, "vote_average": 7}'),
        (2, "[broken")], "tmdb_id long, payload string")
    out = {r.letterboxd_uri: r for r in enrichment_status(matched, details).collect()}
    a = out["a"]
    assert (a.enrichment_status, a.runtime_minutes, a.vote_count, a.budget_usd, a.vote_average, a.genres) == (
        "SUCCESS", 101, 99999999999, 5, 7.0, [])
    assert out["b"].enrichment_status == "ERROR" and out["b"].tmdb_id is None


def test_match_status(spark):
    films = spark.createDataFrame([("a", "alpha", 2000), ("b", "beta", 2001), ("z", "zeta", 2000)],
                                  FILMS)
    matched = match_catalogue(films, catalogue(spark))
    good = json.dumps({"title": "Alpha", "release_date": "2003-05-01", "genres": [{"name": "x"}],
                       "budget": 0, "credits": {"crew": [{"job": "Writer", "name": "w", "id": 1},
                                                         {"job": "Director", "name": "d", "id": 7}]}})
    details = spark.createDataFrame([(1, good), (10, '{"title": "Be')], "tmdb_id long, payload string")
    out = {r.letterboxd_uri: r for r in enrichment_status(matched, details).collect()}
    assert out["a"].enrichment_status == "FUZZY_MATCH"   # detail year off by 3
    assert out["a"].director_name == "d" and out["a"].director_tmdb_id == 7
    assert out["a"].budget_usd is None and out["a"].genres == ["x"]
    assert out["b"].enrichment_status == "ERROR" and out["b"].error_msg
    assert out["z"].enrichment_status == "NOT_FOUND"


def test_to_enrich_retries_everything_but_success(spark):
    films = spark.createDataFrame([("a", "t", 1), ("b", "t", 1), ("c", "t", 1)], FILMS)
    silver = spark.createDataFrame([("a", "SUCCESS"), ("b", "ERROR")],
                                   "letterboxd_uri string, enrichment_status string")
    assert rows(to_enrich(films, silver).select("letterboxd_uri")) == [("b",), ("c",)]
    assert to_enrich(films, silver, full_refresh=True).count() == 3


def test_popular_title_fans_out_to_at_most_top_n(spark):
    # one title holds every catalogue entry; the candidate join must stay bounded
    cat = spark.range(0, 500).select(F.col("id").alias("tmdb_id"), F.lit("same").alias("title"),
                                     F.concat((F.lit(1900) + F.col("id") % 100).cast("string"),
                                              F.lit("-01-01")).alias("release_date"),
                                     F.col("id").cast("double").alias("popularity"))
    films = spark.range(0, 200).select(F.col("id").cast("string").alias("letterboxd_uri"),
                                       F.lit("same").alias("movie_title"),
                                       F.lit(1850).cast("int").alias("movie_year"))
    out = match_catalogue(films, cat)
    assert out.count() == 200 and out.filter("tmdb_id IS NOT NULL").count() == 0
