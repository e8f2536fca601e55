import datetime as dt

from pyspark.sql import functions as F

from stratum.functions import columns as C
from stratum.plans import gold

from .conftest import rows


def one_col(spark, values, typ="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}")


def test_parse_date_bad_values_are_null(spark):
    df = one_col(spark, ["2024-02-29", "2023-02-29", "", None, "2024/01/01"])
    got = [r[0] for r in df.orderBy("i").select(C.parse_date("v")).collect()]
    assert got == [dt.date(2024, 2, 29), None, None, None, None]


def test_safe_year(spark):
    df = one_col(spark, ["1999", "99", "19990", "abcd", None])
    got = [r[0] for r in df.orderBy("i").select(C.safe_year("v")).collect()]
    assert got == [1999, None, None, None, None]


def test_safe_rating_has_no_bound(spark):
    df = one_col(spark, ["3.5", "3.", "5", "-1", "9", "", None])
    got = [r[0] for r in df.orderBy("i").select(C.safe_rating("v")).collect()]
    assert got == [3.5, 3.0, 5.0, None, 9.0, None, None]


def test_flag_tokens(spark):
    df = one_col(spark, ["Yes", "yes", "TRUE", "1", "No", "YES", None])
    got = [r[0] for r in df.orderBy("i").select(C.flag_tokens("v")).collect()]
    assert got == [True, True, True, True, False, False, None]


def test_normalize_title_deletes_accents_and_punctuation(spark):
    df = one_col(spark, ["Amélie: 2!  "])
    assert df.select(C.normalize_title("v")).first()[0] == "amlie 2"


def test_split_tags_keeps_spaces(spark):
    df = one_col(spark, ["a, b", "", None])
    got = [r[0] for r in df.orderBy("i").select(C.split_tags("v")).collect()]
    assert got == [["a", " b"], [""], None]


def test_surrogate_key_null_token_and_separator(spark):
    df = spark.createDataFrame([("a", None), ("a", "b")], "x string, y string")
    got = rows(df.select(C.surrogate_key("x", "y").alias("k"),
                         F.md5(F.lit("a-_dbt_utils_surrogate_key_null_")).alias("n"),
                         F.md5(F.lit("a-b")).alias("ab")))
    assert {r[0] for r in got} == {got[0][1], got[0][2]}


def test_safe_divide_and_zero_to_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (3.0, 2.0)], "n double, d double")
    got = rows(df.select(C.safe_divide("n", "d").alias("r")))
    assert got == [(1.5,), (None,), (None,)]
    z = spark.createDataFrame([(0,), (5,), (None,)], "v int").select(C.zero_to_null("v").alias("v"))
    assert rows(z) == [(5,), (None,), (None,)]


def test_year_prefix(spark):
    df = one_col(spark, ["1999-05-01", "99-01-01", None, "abcd-01"])
    got = [r[0] for r in df.orderBy("i").select(C.year_prefix("v")).collect()]
    assert got == [1999, None, None, None]


def test_dim_date_spine_and_calendar(spark):
    d = gold.dim_date(spark)
    assert d.count() == 11322
    days = {r.full_date: r for r in d.filter(
        F.col("full_date").isin(dt.date(2000, 1, 1), dt.date(2030, 12, 30), dt.date(2030, 12, 31),
                                dt.date(2024, 1, 6), dt.date(2024, 1, 7))).collect()}
    assert dt.date(2000, 1, 1) in days and dt.date(2030, 12, 30) in days
    assert dt.date(2030, 12, 31) not in days
    sat, sun = days[dt.date(2024, 1, 6)], days[dt.date(2024, 1, 7)]
    assert (sat.week_of_year, sun.week_of_year) == (0, 1)       # first Sunday starts week 1
    assert (sun.day_of_week_number, sun.day_of_week_name, sun.is_weekend) == (1, "Sunday", True)
    assert sat.year_quarter == "2024-Q1" and sat.month_name == "January"
    assert d.select(F.countDistinct("date_id")).first()[0] == 11322
