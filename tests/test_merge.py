import pytest
from pyspark.sql import functions as F

from stratum.operators.merge import (incremental_merge, merge_upsert, newer_than,
                                     sync_columns)
from stratum.plans.queries import MOVIE_UPDATE_COLUMNS, MOVIE_UPDATE_WHEN

from .conftest import rows

FILM = ("letterboxd_uri string, enrichment_status string, tmdb_id int, vote_count int, "
        "title string, _silver_updated_at string")


def films(spark, data):
    df = spark.createDataFrame(data, FILM)
    return df


def test_merge_films_conditional_update(spark):
    target = films(spark, [
        ("nf", "NOT_FOUND", None, None, "t", "old"),
        ("hi", "SUCCESS", 1, 10, "t", "old"),
        ("eq", "SUCCESS", 2, 10, "t", "old"),
        ("fz", "NOT_FOUND", None, None, "t", "old"),
    ])
    source = films(spark, [
        ("nf", "SUCCESS", 5, 1, "new", "new"),
        ("hi", "SUCCESS", 1, 11, "new", "new"),
        ("eq", "SUCCESS", 2, 10, "new", "new"),
        ("fz", "FUZZY_MATCH", 9, 1, "new", "new"),
        ("ins", "ERROR", None, None, "new", "new"),
    ])
    cols = [c for c in MOVIE_UPDATE_COLUMNS if c in target.columns]
    out = merge_upsert(target, source, ["letterboxd_uri"], {c: f"s.{c}" for c in cols},
                       MOVIE_UPDATE_WHEN, with_action=True)
    got = {r.letterboxd_uri: (r.enrichment_status, r.vote_count, r.title, r._merge_action)
           for r in out.collect()}
    assert got == {
        "nf": ("SUCCESS", 1, "t", "update"),          # title is not an update column
        "hi": ("SUCCESS", 11, "t", "update"),
        "eq": ("SUCCESS", 10, "t", "keep"),
        "fz": ("NOT_FOUND", None, "t", "keep"),
        "ins": ("ERROR", None, "new", "insert"),
    }
    # merging the same source again changes nothing (idempotent)
    again = merge_upsert(out.drop("_merge_action"), source, ["letterboxd_uri"],
                         {c: f"s.{c}" for c in cols}, MOVIE_UPDATE_WHEN)
    assert rows(again) == rows(out.drop("_merge_action"))


DIARY = "letterboxd_uri string, watched_date date, my_rating double, tags array<string>"


def test_merge_diary_clause_and_null_keys(spark):
    target = spark.createDataFrame([
        ("a", "2024-01-01", 3.0, ["x"]), ("b", "2024-01-01", None, ["x"]),
        ("c", "2024-01-01", 2.0, ["x"]), ("d", None, 1.0, ["x"]),
    ], "letterboxd_uri string, watched_date string, my_rating double, tags array<string>") \
        .withColumn("watched_date", F.to_date("watched_date"))
    source = spark.createDataFrame([
        ("a", "2024-01-01", 4.0, ["y"]), ("b", "2024-01-01", 4.0, ["y"]),
        ("c", "2024-01-01", 2.0, ["y"]), ("d", None, 1.0, ["y"]),
    ], "letterboxd_uri string, watched_date string, my_rating double, tags array<string>") \
        .withColumn("watched_date", F.to_date("watched_date"))
    out = merge_upsert(target, source, ["letterboxd_uri", "watched_date"],
                       {"my_rating": "s.my_rating", "tags": "s.tags"},
                       "s.my_rating IS NOT NULL AND s.my_rating != t.my_rating", with_action=True)
    got = sorted((r.letterboxd_uri, r.my_rating, tuple(r.tags), r._merge_action) for r in out.collect())
    assert got == [("a", 4.0, ("y",), "update"), ("b", None, ("x",), "keep"),
                   ("c", 2.0, ("x",), "keep"), ("d", 1.0, ("x",), "keep"), ("d", 1.0, ("y",), "insert")]
    # null-safe keys match the NULL date instead
    out2 = merge_upsert(target, source, ["letterboxd_uri", "watched_date"], {"tags": "s.tags"},
                        None, null_safe_keys=True)
    assert out2.count() == 4


def test_merge_duplicate_source_rows_raise(spark):
    t = spark.createDataFrame([("a", 1)], "k string, v int")
    s = spark.createDataFrame([("a", 2), ("a", 3)], "k string, v int")
    with pytest.raises(Exception, match="duplicate merge keys"):
        merge_upsert(t, s, ["k"], {"v": "s.v"}).collect()
    nulls = spark.createDataFrame([(None, 2), (None, 3)], "k string, v int")
    assert merge_upsert(t, nulls, ["k"], {"v": "s.v"}).count() == 3     # NULL keys cannot match


def test_merge_reads_each_input_once(spark, tmp_dir):
    for name in ("t", "s"):
        spark.range(100).selectExpr("id as k", "id as v").write.parquet(f"{tmp_dir}/{name}")
    t, s = (spark.read.parquet(f"{tmp_dir}/{name}") for name in ("t", "s"))
    for out in (merge_upsert(t, s, ["k"], {"v": "s.v"}), incremental_merge(t, s, "k")):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Relation [") == 2


def test_incremental_merge_watermark_and_keep_first(spark):
    old = spark.createDataFrame([("k1", 1, "2024-01-01", "c0"), ("k2", 2, "2024-01-02", "c0")],
                                "id string, v int, stamp string, created string")
    new = spark.createDataFrame([("k1", 1, "2024-01-01", "c1"), ("k2", 20, "2024-01-05", "c1"),
                                 ("k3", 3, "2024-01-06", "c1")],
                                "id string, v int, stamp string, created string")
    out = incremental_merge(old, new, "id", stamp_col="stamp", keep_first=["created"])
    assert rows(out) == [("k1", 1, "2024-01-01", "c0"), ("k2", 20, "2024-01-05", "c0"),
                         ("k3", 3, "2024-01-06", "c1")]
    # re-running with the same watermark changes nothing
    assert rows(incremental_merge(out, new, "id", stamp_col="stamp", keep_first=["created"])) == rows(out)
    # nothing newer than the mark
    assert newer_than(old, old, "stamp").count() == 0


def test_schema_sync(spark):
    old = spark.createDataFrame([(1, "a", "gone")], "k int, s string, dropped string")
    new = spark.createDataFrame([(2, "b", 5)], "k int, s string, added int")
    aligned = sync_columns(old, new)
    assert aligned.columns == ["k", "s", "added"] and rows(aligned) == [(1, "a", None)]
    assert rows(incremental_merge(old, new, "k")) == [(1, "a", None), (2, "b", 5)]
