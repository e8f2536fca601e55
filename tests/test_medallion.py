import json
import os

import pytest

from pyspark.sql import functions as F

from stratum.plans import medallion
from stratum.operators.quality import AssertionFailed
from stratum.sources import tables

from .conftest import rows


def write_csv(path, header, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(header + "\n" + "\n".join(lines) + "\n")


def landing(base):
    write_csv(f"{base}/diary.csv", "Date,Name,Year,Letterboxd URI,Rating,Rewatch,Tags,Watched Date", [
        "2024-01-02,Alpha,2000,https://boxd.it/a,4.5,Yes,\"x,y\",2024-01-01",
        "2024-01-03,Alpha,2000,https://boxd.it/a,3,No,,2024-01-03",
        "2024-01-03,Beta,1999,https://boxd.it/b,,No,,2024-01-03",
        "2024-01-04,,1999,https://boxd.it/c,2,No,,2024-01-04",
    ])
    write_csv(f"{base}/ratings.csv", "Date,Name,Year,Letterboxd URI,Rating", [
        "2024-01-05,Alpha,2000,https://boxd.it/a,4.5",
        "2024-01-05,Gamma,2010,https://boxd.it/g,1",
    ])
    write_csv(f"{base}/watched.csv", "Date,Name,Year,Letterboxd URI", [
        "2024-01-05,Delta,1980,https://boxd.it/d",
    ])


def catalogue(spark):
    cat = spark.createDataFrame([(1, "Alpha", "2000-03-01", 5.0), (2, "Beta", "1999-01-01", 5.0),
                                 (3, "Gamma", "2011-01-01", 5.0)],
                                "tmdb_id long, title string, release_date string, popularity double")

    def payload(title, date, runtime):
        return json.dumps({"title": title, "release_date": date, "runtime": runtime,
                           "genres": [{"name": "Drama"}, {"name": "Drama"}], "vote_count": 10,
                           "vote_average": 7.5,
                           "credits": {"crew": [{"job": "Director", "name": "Dir", "id": 9}]}})
    details = spark.createDataFrame([(1, payload("Alpha", "2000-03-01", 100)),
                                     (2, payload("Beta", "1999-01-01", 90)), (3, "{broken")],
                                    "tmdb_id long, payload string")
    return cat, details


def test_layers_end_to_end_and_rerun(spark, tmp_dir):
    land, root = f"{tmp_dir}/landing", f"{tmp_dir}/lake"
    landing(land)
    summary = medallion.land(spark, land, root, "2024-01-31")
    assert rows(summary, "file", "n_rows") == [("diary.csv", 4), ("ratings.csv", 2), ("watched.csv", 1)]
    cat, details = catalogue(spark)
    s = medallion.build_silver(spark, root, cat, details, "2024-02-01 00:00:00", min_match_rate=0.5)
    status = {r.letterboxd_uri: r.enrichment_status for r in s["movies"].collect()}
    assert status == {"https://boxd.it/a": "SUCCESS", "https://boxd.it/b": "SUCCESS",
                      "https://boxd.it/g": "ERROR", "https://boxd.it/d": "NOT_FOUND"}
    assert s["diary_entries"].count() == 3          # blank-title row dropped
    diary_before = rows(s["diary_entries"].select("letterboxd_uri", "watched_date", "my_rating"))
    recon = medallion.export_silver(spark, root, f"{tmp_dir}/warehouse")
    assert all(r.matches for r in recon.collect()) and recon.count() == 3
    g = medallion.build_gold(spark, root, "2024-02-01 00:00:00")
    assert g["dim_movie"].count() == 2 and g["bridge_movie_genre"].count() == 2
    assert g["fact_diary_entries"].count() == 3 and g["fact_ratings"].count() == 2
    assert g["dq_results"].filter("NOT ok").count() == 0
    before = {k: rows(v.drop("_dbt_created_at", "_dbt_updated_at")) for k, v in g.items()
              if k not in ("dq_results",)}
    # second run with the same inputs: Silver and Gold unchanged, audit grows
    s2 = medallion.build_silver(spark, root, cat, details, "2024-02-02 00:00:00", min_match_rate=0.5)
    assert s2["audit"].count() == 2
    assert rows(s2["diary_entries"].select("letterboxd_uri", "watched_date", "my_rating")) == diary_before
    snapshot_rows = g["snapshot"].count()
    g2 = medallion.build_gold(spark, root, "2024-02-02 00:00:00")
    assert g2["snapshot"].count() == snapshot_rows
    after = {k: rows(v.drop("_dbt_created_at", "_dbt_updated_at")) for k, v in g2.items()
             if k not in ("dq_results",)}
    assert after["fact_ratings"] == before["fact_ratings"]
    assert after["dim_movie"] == before["dim_movie"]


def test_match_rate_gate_and_model_test_gate(spark, tmp_dir):
    land, root = f"{tmp_dir}/landing", f"{tmp_dir}/lake"
    landing(land)
    medallion.land(spark, land, root, "2024-01-31")
    cat, details = catalogue(spark)
    with pytest.raises(AssertionFailed):      # 2 of 4 films are matched, below the default floor
        medallion.build_silver(spark, root, cat, details, "2024-02-01 00:00:00")
    medallion.build_silver(spark, root, cat, details, "2024-02-01 00:00:00", min_match_rate=0.5)
    movies = spark.read.parquet(f"{root}/silver/movies")
    tables.replace_table(movies.withColumn("enrichment_status", F.when(
        F.col("enrichment_status") == "NOT_FOUND", F.lit("LOST")).otherwise(F.col("enrichment_status"))),
        f"{root}/silver/movies")
    with pytest.raises(AssertionFailed, match="accepted_values"):
        medallion.build_gold(spark, root, "2024-02-01 00:00:00")
    results = spark.read.parquet(f"{root}/gold/model_test_results")
    assert [r.rule for r in results.filter("not ok").collect()] == ["accepted_values(enrichment_status)"]


def test_a_repeated_run_leaves_one_record(spark, tmp_dir):
    land, root = f"{tmp_dir}/landing", f"{tmp_dir}/lake"
    landing(land)
    medallion.land(spark, land, root, "2024-01-31")
    cat, details = catalogue(spark)
    ts = "2024-02-01 00:00:00"
    for _ in range(2):
        s = medallion.build_silver(spark, root, cat, details, ts, min_match_rate=0.5)
        g = medallion.build_gold(spark, root, ts)
    audit = s["audit"].collect()
    assert [(r.run_id, r.silver_movies_total, r.silver_diary_total, r.silver_ratings_total, r.tmdb_success, r.tmdb_error)
            for r in audit] == [(ts, 4, 3, 2, 2, 1)]
    assert g["dq_results"].count() == 7 and g["dq_results"].select("run_id").distinct().count() == 1


def test_late_films_and_source_tests(spark, tmp_dir):
    land, root = f"{tmp_dir}/landing", f"{tmp_dir}/lake"
    landing(land)
    with open(f"{land}/diary.csv", "a") as f:
        f.write("2024-01-09,Beta,1999,https://boxd.it/b,3,No,,\n")  # no watched date: staging drops it
    medallion.land(spark, land, root, "2024-01-31")
    cat, details = catalogue(spark)
    medallion.build_silver(spark, root, cat.filter("title <> 'Beta'"), details, "2024-02-01 00:00:00", min_match_rate=0.2)
    g = medallion.build_gold(spark, root, "2024-02-01 00:00:00")
    beta = "letterboxd_uri = 'https://boxd.it/b'"
    assert g["fact_diary_entries"].filter(beta).first().movie_id is None
    failed = g["source_test_results"].filter("NOT ok").collect()
    assert [(r.table_name, r.rule, r.failed) for r in failed] == [("src_silver_diary_entries", "not_null(watched_date)", 1)]
    with pytest.raises(AssertionFailed, match="src_silver_diary_entries.not_null"):
        medallion.build_gold(spark, root, "2024-02-01 00:00:00", gate_sources=True)
    medallion.build_silver(spark, root, cat, details, "2024-02-02 00:00:00", min_match_rate=0.2)
    g = medallion.build_gold(spark, root, "2024-02-02 00:00:00")
    assert g["fact_diary_entries"].filter(beta).first().movie_id is None  # as the models do it: facts load once
    g = medallion.build_gold(spark, root, "2024-02-03 00:00:00", refresh_null_keys=True)
    movie = g["dim_movie"].filter(beta).first().movie_id
    assert g["fact_diary_entries"].filter(beta).first().movie_id == movie is not None
