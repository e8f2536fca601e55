"""Physical-plan guards: what every registered query must (not) contain."""

import re

import pytest

import __spark_entry__ as E
from stratum.plans.queries import REGISTRY, gold_tables

from .conftest import SF_SMOKE

FORBIDDEN = re.compile(r"CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython|"
                       r"ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    """Plans as for tables too large to broadcast."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("large", [False, True])
def test_no_cross_products_or_python_in_any_query(spark, request, large):
    if large:
        request.getfixturevalue("no_broadcast")
    for name, fn in REGISTRY.items():
        p = plan(fn(spark, SF_SMOKE))
        assert not FORBIDDEN.search(p), f"{name}: {FORBIDDEN.findall(p)}"
        assert not large or "BroadcastHashJoin" not in p, name


def test_inputs_are_scanned_once_per_side(spark, no_broadcast):
    for name, scans in (("merge_ratings", 2), ("merge_composite_key", 2), ("merge_conditional", 2),
                        ("timeline_month", 2), ("catalog_match", 3)):
        p = plan(REGISTRY[name](spark, SF_SMOKE))
        assert len(re.findall("FileScan parquet", p)) == scans, name


def test_rules_read_each_written_table_once_per_side(spark, no_broadcast):
    """Ten models and three sources, whatever the number of rules; the audit row
    needs the written tables only for the films still to enrich."""
    for name, scans in (("dq_model_tests", 13), ("dq_contract_report", 3), ("dq_range", 3), ("kpi_global", 4), ("audit_record", 4)):
        p = plan(REGISTRY[name](spark, SF_SMOKE))
        found = len(re.findall("FileScan parquet", p))
        assert found <= scans, (name, found)


def test_tagged_keys_are_compiled_and_summed_before_the_rules_share_them(spark):
    """No function of lambdas runs on the rows, and only sums by tag are spread
    over the rules; staging is read from written Silver, not written again."""
    p = plan(REGISTRY["dq_model_tests"](spark, SF_SMOKE))
    assert "lambdafunction" not in p
    for inline in re.finditer(r"Generate inline\(.*", p[p.index("Initial Plan"):] if "Initial Plan" in p else p):
        below = p[inline.end():inline.end() + 3000]
        assert "tag" not in inline[0] or re.search(r"HashAggregate\(keys=\[tag[^\]]*\], functions=\[sum\(n", below), inline[0][:200]
    g = gold_tables(spark, SF_SMOKE, written=True)
    for view, table in (("stg_movies", "silver_movies"), ("stg_diary", "silver_diary"), ("stg_ratings", "silver_ratings")):
        assert set(g[view].inputFiles()) == set(g[table].inputFiles())
    assert not set(g["dim_movie"].inputFiles()) & set(g["silver_movies"].inputFiles())


def test_dedup_limits_rows_before_the_shuffle(spark):
    for name in ("clean_diary", "dedup_composite", "catalog_match"):
        p = plan(E.queries()[name](spark, SF_SMOKE))
        assert "WindowGroupLimit" in p and "Partial" in p, name


def test_scans_are_pruned(spark):
    p = plan(E.queries()["fact_ratings"](spark, SF_SMOKE))
    # lineitem is read with only the five columns the ratings export uses
    m = re.search(r"ReadSchema: struct<(l_[^\s>]*)", p)
    assert m and set(c.split(":")[0] for c in m.group(1).split(",")) == {
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_shipdate"}
