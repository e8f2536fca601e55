from stratum.operators.clean import clean_diary, clean_ratings, dedup_latest
from stratum.operators.match import union_catalog

from .conftest import rows

TS = "2024-02-01 00:00:00"
HEAD = "event_id long, `Date` string, `Name` string, `Year` string, `Letterboxd URI` string, " \
       "`Rating` string, `Rewatch` string, `Tags` string, `Watched Date` string"


def diary(spark, data):
    return spark.createDataFrame(data, HEAD)


def test_diary_title_filter_and_dedup(spark):
    df = diary(spark, [
        (1, "2024-01-01", "A", "2001", "u1", "3.5", "Yes", "x", "2024-01-01"),
        (2, "2024-01-01", "A", "2001", "u1", "4.0", "No", "x", "2024-01-01"),   # same key, later
        (3, "2024-01-01", "A", "2001", "u1", "1.0", "No", "x", "2024-01-01"),
        (4, "2024-01-01", "B", "2001", "u2", "1.0", "No", "x", ""),             # NULL date
        (5, "2024-01-01", "B", "2001", "u2", "2.0", "No", "x", "bad"),          # NULL date too
        (6, "2024-01-01", None, "2001", "u3", "1.0", "No", "x", "2024-01-01"),  # NULL title
        (7, "2024-01-01", "   ", "2001", "u4", "1.0", "No", "x", "2024-01-01"),  # blank title
        (8, "2024-01-01", "C", "2001", None, "1.0", "No", "x", "2024-01-01"),   # NULL uri
    ])
    out = clean_diary(df, TS, "2024-01-31", ["event_id"])
    got = rows(out, "letterboxd_uri", "watched_date", "my_rating", "event_id")
    assert [(r[0], r[3]) for r in got] == [("u1", 3), ("u2", 5)]
    assert got[0][2] == 1.0


def test_ratings_keep_blank_titles(spark):
    df = spark.createDataFrame([("2024-01-01", "   ", "2001", "u1", "3"),
                                ("2024-01-02", None, "2001", "u1", "3")],
                               "`Date` string, `Name` string, `Year` string, `Letterboxd URI` string, "
                               "`Rating` string")
    assert clean_ratings(df, TS).count() == 2


def test_dedup_without_order_is_total(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0), (1, "b", 1.0), (None, "x", 0.0),
                                (None, "y", 0.0)], "k int, s string, v double")
    assert rows(dedup_latest(df, ["k"])) == [(1, "b", 2.0), (None, "y", 0.0)]


def test_union_catalog_priority(spark):
    def src(title, date):
        return spark.createDataFrame([("u1", title, 2000, date)],
                                     "letterboxd_uri string, movie_title string, movie_year int, "
                                     "sort_date string")
    out = union_catalog([src("diary", "2024-01-01"), src("ratings", "2024-05-01"),
                         src("watched", "2024-09-01")])
    assert rows(out) == [("u1", "diary", 2000)]
    # the survivor has no title -> the uri is dropped
    out = union_catalog([src(None, "2024-01-01"), src("ratings", "2024-05-01")])
    assert out.count() == 0
