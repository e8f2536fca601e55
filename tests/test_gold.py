import datetime as dt

from pyspark.sql import functions as F

from stratum.plans import gold

from .conftest import rows

RUN = "2024-02-01 00:00:00"


def stg_movies(spark):
    silver = spark.createDataFrame([
        ("u1", "A", 2000, "SUCCESS", 1, "A!", "2000-05-01", ["Drama", "Drama", None], 100, 0, "Dir", 7, 7.0, 10),
        ("u2", "B", 2001, "FUZZY_MATCH", 2, None, "bad-date", ["Comedy"], None, None, "Dir2", 7, None, None),
        ("u3", "C", 2002, "NOT_FOUND", None, None, None, None, None, None, None, None, None, None),
    ], "letterboxd_uri string, lb_movie_title string, lb_movie_year int, enrichment_status string, "
       "tmdb_id int, tmdb_title string, release_date string, genres array<string>, runtime_minutes int, "
       "budget_usd bigint, director_name string, director_tmdb_id int, vote_average double, vote_count int")
    silver = silver.withColumns({
        "tmdb_original_title": F.lit(None).cast("string"), "revenue_usd": F.lit(None).cast("bigint"),
        "overview": F.lit(None).cast("string"), "original_language": F.lit("en"),
        "poster_path": F.lit(None).cast("string"),
        "_silver_created_at": F.lit(RUN).cast("timestamp"), "_silver_updated_at": F.lit(RUN).cast("timestamp")})
    return gold.stg_movies(silver)


def test_staging_and_dimensions(spark):
    stg = stg_movies(spark)
    by = {r.letterboxd_uri: r for r in stg.collect()}
    assert by["u1"].title == "A!" and by["u3"].title == "C"            # COALESCE(catalogue, diary)
    assert by["u1"].release_year == 2000 and by["u2"].release_date is None
    d = gold.dim_director(stg)
    assert rows(d, "director_tmdb_id", "director_name") == [(7, "Dir")]   # one name per id
    g = gold.dim_genre(stg)
    assert [r.genre_name for r in g.collect()] == ["Comedy", "Drama"]     # distinct, NOT NULL, ordered
    snap = gold.snap_dim_movie(None, stg, RUN)
    assert snap.count() == 2                                              # matched films only
    movies = gold.dim_movie(snap, d)
    assert movies.filter("director_id IS NULL").count() == 0
    bridge = gold.bridge_movie_genre(movies, g)
    assert bridge.count() == 2 and bridge.select("bridge_id").distinct().count() == 2


def test_facts_keep_unmatched_rows(spark):
    stg = stg_movies(spark)
    movies = gold.dim_movie(gold.snap_dim_movie(None, stg, RUN), gold.dim_director(stg))
    diary = spark.createDataFrame([
        ("u1", dt.date(2024, 1, 1), 4.0), ("u9", dt.date(2024, 1, 2), 3.0),   # film absent
        ("u1", dt.date(1999, 12, 31), 2.0),                                   # before the spine
    ], "letterboxd_uri string, watched_date date, my_rating double").withColumns({
        "movie_title": F.lit("x"), "diary_date": F.col("watched_date"), "is_rewatch": F.lit(False),
        "tags": F.array(F.lit("t")), "_silver_created_at": F.lit(RUN).cast("timestamp"),
        "_silver_updated_at": F.lit(RUN).cast("timestamp")})
    stg_d = gold.stg_diary(diary)
    fact = gold.fact_diary_entries(stg_d, movies, gold.date_lookup(spark), RUN)
    assert fact.count() == stg_d.count() == 3                            # no row lost or duplicated
    got = {(r.letterboxd_uri, r.watched_date): r for r in fact.collect()}
    assert got[("u9", dt.date(2024, 1, 2))].movie_id is None
    assert got[("u1", dt.date(1999, 12, 31))].watched_date_id is None
    assert got[("u1", dt.date(2024, 1, 1))].watched_date_id is not None
    # incremental load: the same build again changes nothing
    again = gold.load_fact(fact, fact, "diary_entry_id")
    assert rows(again.drop("_dbt_created_at", "_dbt_updated_at")) == rows(
        fact.drop("_dbt_created_at", "_dbt_updated_at"))


def test_timeline_grains(spark):
    import pytest
    from stratum.plans.reports import timeline
    facts = spark.createDataFrame([("u1", dt.date(2024, 3, 5)), ("u2", dt.date(2024, 3, 6))],
                                  "letterboxd_uri string, watched_date date")
    ratings = spark.createDataFrame([("u1", dt.date(2023, 1, 1))], "letterboxd_uri string, rating_date date")
    got = {(r.source, str(r.period)): (r.n_entries, r.n_films)
           for r in timeline(facts, ratings, "week").collect()}
    assert got == {("diary", "2024-03-04"): (2, 2), ("ratings", "2022-12-26"): (1, 1)}
    with pytest.raises(ValueError):
        timeline(facts, ratings, "fortnight")
