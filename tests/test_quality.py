import pytest
from pyspark.sql import functions as F

from stratum.operators import quality as Q
from stratum.plans import contracts
from stratum.sources.rules import expectation_rules, model_test_rules

from .conftest import rows


def test_rules_null_handling_and_threshold(spark):
    df = spark.createDataFrame([(1, 1.0, "https://boxd.it/ab"), (2, None, "bad"), (3, 9.0, None),
                                (4, 2.0, "https://boxd.it/cd")], "id int, r double, u string")
    rules = [
        {"kind": "range", "column": "r", "min": 0.5, "max": 5.0, "ignore_null": True, "name": "ign"},
        {"kind": "range", "column": "r", "min": 0.5, "max": 5.0, "ignore_null": False, "name": "strict"},
        {"kind": "row_condition", "column": "r", "expression": "r < 5", "name": "cond"},
        {"kind": "regex", "column": "u", "regex": contracts.uri_regex(), "name": "re"},
        {"kind": "not_null", "column": "r", "name": "nn", "threshold": 0.7},
        {"kind": "accepted_values", "column": "u", "values": ["bad"], "name": "av"},
        {"kind": "unique", "column": "id", "name": "uq"},
    ]
    got = {r.rule: (r.total, r.failed, r.ok) for r in Q.evaluate(df, "t", rules).collect()}
    assert got["ign"] == (4, 1, False)       # NULL passes, 9.0 fails
    assert got["strict"] == (4, 2, False)    # NULL fails too
    assert got["cond"] == (4, 2, False)      # NULL predicate fails
    assert got["re"] == (4, 2, False)
    assert got["nn"] == (4, 1, True)         # 0.75 >= 0.7
    assert got["av"] == (4, 2, False)        # NULL is not a failure
    assert got["uq"] == (4, 0, True)


def test_unique_and_relationship(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (2,)], "k int")
    got = {r.rule: (r.total, r.failed) for r in Q.evaluate(child, "c", [
        {"kind": "unique", "column": "k"},
        {"kind": "relationship", "column": "k", "parent": parent},
        {"kind": "relationship", "column": "k", "parent": parent, "where": "k < 3", "name": "w"},
    ]).collect()}
    assert got["unique(k)"] == (5, 2)
    assert got["relationship(k)"] == (4, 1)
    assert got["w"] == (3, 0)


def test_expectation_files_parse():
    r = expectation_rules(contracts.DIM_MOVIE_RULES)
    assert [x["kind"] for x in r] == ["unique", "range", "row_condition"]
    assert r[1]["min"] == 1888 and r[1]["ignore_null"] is True
    f = expectation_rules(contracts.FACT_DIARY_ENTRIES_RULES)
    assert f[2]["regex"] == r"^https://boxd\.it/[a-zA-Z0-9]+$"
    assert expectation_rules(contracts.FACT_RATINGS_RULES)[0]["max"] == 5.0


def test_model_tests_parse():
    yml = """
models:
  - name: fact_ratings
    columns:
      - name: rating_id
        tests: [not_null, unique]
      - name: movie_id
        tests:
          - relationships:
              to: ref('dim_movie')
              field: movie_id
              where: "movie_id IS NOT NULL"
      - name: my_rating
        tests:
          - dbt_utils.accepted_range:
              min_value: 0.5
              max_value: 5.0
              inclusive: true
"""
    r = model_test_rules(yml, {"dim_movie": None})["fact_ratings"]
    assert [x["kind"] for x in r] == ["not_null", "unique", "relationship", "range"]
    assert r[2]["parent_name"] == "dim_movie" and r[2]["where"] == "movie_id IS NOT NULL"


def test_scorecard_and_assertions(spark):
    df = spark.createDataFrame([(1,), (None,)], "k int")
    res = Q.evaluate(df, "t", [{"kind": "not_null", "column": "k", "dimension": "COMPLETENESS"}])
    sc = Q.scorecard(res, "run1").first()
    assert (sc.score, sc.is_perfect) == (50.0, False)
    with pytest.raises(Q.AssertionFailed):
        Q.assert_table(df, "k", "t")
    with pytest.raises(Q.AssertionFailed):
        Q.assert_table(df.filter("k > 5"), "k", "t")
    movies = spark.createDataFrame([("SUCCESS",), ("ERROR",)], "enrichment_status string")
    assert rows(Q.enrichment_rate(movies)) == [(1, 2, 0.5)]
    with pytest.raises(Q.AssertionFailed):
        Q.assert_enrichment_rate(movies, 0.7)


def test_scorecard_over_time(spark):
    df = spark.createDataFrame([(1,), (None,)], "k int")
    rule = [{"kind": "not_null", "column": "k", "dimension": "COMPLETENESS"}]
    history = Q.evaluate(df, "t", rule).withColumn("run_id", F.lit("r1")).unionByName(
        Q.evaluate(df.filter("k IS NOT NULL"), "t", rule).withColumn("run_id", F.lit("r2")))
    got = {r.run_id: (r.score, r.is_perfect) for r in Q.scorecard(history).collect()}
    assert got == {"r1": (50.0, False), "r2": (100.0, True)}


def test_rule_files_bounds_and_parents(spark):
    from stratum.operators import quality
    from stratum.sources.rules import expectation_rules, model_test_rules
    import pytest as _pytest
    df = spark.createDataFrame([(1.0,), (None,), (9.0,), (5.0,)], "v double")
    strict = expectation_rules("rules:\n  - column: v\n    ignoreNull: true\n    rangeExpectation:\n"
                               "      minValue: '1'\n      maxValue: '5'\n      strictMinEnabled: true\n")
    assert quality.evaluate(df, "t", strict).first().failed == 2          # 1.0 and 9.0, not 5.0
    text = ("models:\n  - name: t\n    columns:\n      - name: v\n        tests:\n"
            "          - dbt_utils.accepted_range: {min_value: 0.5, max_value: 5.0}\n")
    assert quality.evaluate(df, "t", model_test_rules(text)["t"]).first().failed == 1     # NULL passes
    with _pytest.raises(KeyError, match="parent_table"):
        model_test_rules("models:\n  - name: t\n    columns:\n      - name: v\n        tests:\n"
                         "          - relationships: {to: ref('parent_table'), field: v}\n")


def test_a_contract_scans_each_table_once(spark, tmp_dir):
    import re
    child = spark.createDataFrame([(1, 1, "x"), (1, 2, "x"), (2, 5, None), (None, 1, "y")], "id int, p int, s string")
    child.write.parquet(f"{tmp_dir}/child")
    spark.createDataFrame([(1,), (2,), (None,)], "p bigint").write.parquet(f"{tmp_dir}/parent")
    child, parent = spark.read.parquet(f"{tmp_dir}/child"), spark.read.parquet(f"{tmp_dir}/parent")
    result = Q.evaluate_all([
        ("child", child, [{"kind": "unique", "column": "id"}, {"kind": "unique", "column": ["id", "s"]},
                          {"kind": "unique", "column": "p", "where": "s = 'x'"},
                          {"kind": "relationship", "column": "p", "parent": parent},
                          {"kind": "not_null", "column": "s"}, {"kind": "not_null", "column": "id", "where": "p = 1"}]),
        ("parent", parent, [{"kind": "unique", "column": "p"}, {"kind": "not_null", "column": "p"}])])
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("FileScan parquet", plan)) == 2
    got = [(r.table_name, r.rule, r.total, r.failed) for r in result.collect()]
    assert sorted(got) == [
        ("child", "not_null(id)", 2, 1), ("child", "not_null(s)", 4, 1), ("child", "relationship(p)", 4, 1),
        ("child", "unique(id)", 4, 2), ("child", "unique(id,s)", 4, 2), ("child", "unique(p)", 2, 0),
        ("parent", "not_null(p)", 3, 1), ("parent", "unique(p)", 3, 0)]


def test_keys_of_different_types_and_empty_tables(spark):
    child = spark.createDataFrame([(1.0, "1"), (2.5, "b"), (-0.0, None)], "d double, s string")
    parent = spark.createDataFrame([(1, b"b"), (0, b"c")], "i int, raw binary")
    got = {r.rule: (r.total, r.failed, r.ok) for r in Q.evaluate(child, "c", [
        {"kind": "relationship", "column": "d", "parent": parent, "parent_column": "i", "name": "numbers"},
        {"kind": "relationship", "column": "s", "parent": parent, "parent_column": "i", "name": "text"}]).collect()}
    assert got == {"numbers": (3, 1, False), "text": (2, 1, False)}
    rules = [{"kind": "unique", "column": "i"}, {"kind": "not_null", "column": "i"}, {"kind": "unique", "column": "raw"}]
    assert [(r.total, r.failed, r.pass_ratio, r.ok) for r in Q.evaluate(parent.limit(0), "p", rules).collect()] == [(0, 0, None, True)] * 3
