from pyspark.sql import functions as F

from stratum.operators.scd import scd2_apply, scd2_as_of, scd2_current

T1, T2, T3 = "2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00"
SCHEMA = "k string, a double, b string, other string"


def snap(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def versions(h):
    return sorted(((r.k, r.a, r.b, r.other, str(r.dbt_valid_from), str(r.dbt_valid_to))
                   for r in h.collect()), key=lambda t: tuple(str(x) for x in t))


def test_scd2_cases(spark):
    first = snap(spark, [("same", 1.0, "x", "o"), ("chg", 1.0, "x", "o"), ("noncheck", 1.0, "x", "o"),
                         ("nullv", None, "x", "o"), ("gone", 1.0, "x", "o"), ("back", 1.0, "x", "o")])
    h1 = scd2_apply(None, first, "k", ["a", "b"], T1)
    assert h1.count() == 6 and h1.filter("dbt_valid_to IS NULL").count() == 6
    second = snap(spark, [("same", 1.0, "x", "o"), ("chg", 2.0, "x", "o"), ("noncheck", 1.0, "x", "NEW"),
                          ("nullv", 5.0, "x", "o"), ("back", 2.0, "x", "o"), ("new", 1.0, "x", "o")])
    h2 = scd2_apply(h1, second, "k", ["a", "b"], T2)
    v = versions(h2)
    by_key = {}
    for r in v:
        by_key.setdefault(r[0], []).append(r)
    assert len(by_key["same"]) == 1
    assert len(by_key["noncheck"]) == 1 and by_key["noncheck"][0][3] == "o"
    assert sorted(r[5] for r in by_key["chg"]) == ["2024-02-01 00:00:00", "None"]
    assert len(by_key["nullv"]) == 2
    assert len(by_key["gone"]) == 1 and by_key["gone"][0][5] == "None"      # stays open
    assert len(by_key["new"]) == 1 and by_key["new"][0][4] == "2024-02-01 00:00:00"
    # change back to the old value -> third row
    third = second.withColumn("a", F.when(F.col("k") == "back", F.lit(1.0)).otherwise(F.col("a")))
    h3 = scd2_apply(h2, third, "k", ["a", "b"], T3)
    assert h3.filter("k = 'back'").count() == 3
    # the same input again is a no-op
    h4 = scd2_apply(h3, third, "k", ["a", "b"], "2024-04-01 00:00:00")
    assert versions(h4) == versions(h3)
    # invariants: one open row per key; intervals do not overlap
    cur = scd2_current(h4)
    assert cur.count() == cur.select("k").distinct().count() == 7
    assert scd2_as_of(h3, "2024-02-15 00:00:00").filter("k = 'back'").first().a == 2.0
    assert scd2_as_of(h3, "2024-01-15 00:00:00").filter("k = 'back'").first().a == 1.0
    assert h4.select(F.countDistinct("dbt_scd_id")).first()[0] == h4.count()


def test_scd2_hard_deletes(spark):
    h1 = scd2_apply(None, snap(spark, [("a", 1.0, "x", "o"), ("b", 1.0, "x", "o")]), "k", ["a"], T1)
    h2 = scd2_apply(h1, snap(spark, [("a", 1.0, "x", "o")]), "k", ["a"], T2, invalidate_hard_deletes=True)
    assert h2.filter("k = 'b' AND dbt_valid_to IS NOT NULL").count() == 1


def test_scd2_rejects_duplicate_keys(spark):
    import pytest
    twice = snap(spark, [("a", 1.0, "x", "o"), ("a", 2.0, "x", "o")])
    history = scd2_apply(None, snap(spark, [("b", 1.0, "x", "o")]), "k", ["a"], T1)
    for before in (None, history):
        out = scd2_apply(before, twice, "k", ["a"], T2)  # fails when it runs, not while the plan is built
        with pytest.raises(Exception, match="duplicate merge keys"):
            out.collect()


def test_stored_history_is_append_only(spark, tmp_dir):
    from stratum.sources import tables
    path = f"{tmp_dir}/snap"
    runs = [
        [("a", 1.0, "x", "o"), ("b", 1.0, "x", "o")],
        [("a", 2.0, "x", "o"), ("b", 1.0, "x", "o"), ("c", 1.0, "x", "o")],
        [("a", 3.0, "x", "o"), ("b", 5.0, "x", "o"), ("c", 1.0, "x", "o")],
    ]
    in_memory = None
    for i, data in enumerate(runs):
        ts = f"2024-0{i + 1}-01 00:00:00"
        stored = tables.snapshot_scd2(spark, path, snap(spark, data), "k", ["a"], ts)
        in_memory = scd2_apply(in_memory, snap(spark, data), "k", ["a"], ts)
        assert versions(stored.drop(tables.CLOSED_RUN)) == versions(in_memory)
    # one folder per closing run plus the open one; earlier folders untouched
    import os
    parts = sorted(n for n in os.listdir(path) if n.startswith(tables.CLOSED_RUN))
    assert parts == [f"{tables.CLOSED_RUN}=20240201000000", f"{tables.CLOSED_RUN}=20240301000000",
                     f"{tables.CLOSED_RUN}=__HIVE_DEFAULT_PARTITION__"]


def test_stored_history_when_every_version_closes(spark, tmp_dir):
    from stratum.sources import tables
    path = f"{tmp_dir}/snap2"
    tables.snapshot_scd2(spark, path, snap(spark, [("a", 1.0, "x", "o")]), "k", ["a"], T1)
    empty = snap(spark, [("z", 1.0, "x", "o")]).filter("k = 'none'")
    out = tables.snapshot_scd2(spark, path, empty, "k", ["a"], T2, invalidate_hard_deletes=True)
    assert out.count() == 1 and out.filter("dbt_valid_to IS NULL").count() == 0


def test_stored_history_starts_empty(spark, tmp_dir):
    from stratum.sources import tables
    path = f"{tmp_dir}/snap3"
    empty = snap(spark, [("z", 1.0, "x", "o")]).filter("k = 'none'")
    first = tables.snapshot_scd2(spark, path, empty, "k", ["a"], T1)
    assert first.count() == 0 and not tables.table_exists(spark, path)
    second = tables.snapshot_scd2(spark, path, snap(spark, [("a", 1.0, "x", "o")]), "k", ["a"], T2)
    assert second.count() == 1


def test_stored_history_of_a_repeated_run_keeps_what_it_closed(spark, tmp_dir):
    from stratum.sources import tables
    path = f"{tmp_dir}/again"
    stored = None
    for data, ts in (([("a", 1.0, "x", "o"), ("b", 1.0, "x", "o")], T1), ([("a", 2.0, "x", "o"), ("b", 1.0, "x", "o")], T2),
                     ([("a", 2.0, "x", "o"), ("b", 2.0, "x", "o")], T2), ([("a", 3.0, "x", "o"), ("b", 2.0, "x", "o")], T2),
                     ([("a", 3.0, "x", "o"), ("b", 2.0, "x", "o")], T2)):
        stored = tables.snapshot_scd2(spark, path, snap(spark, data), "k", ["a"], ts)
    got = sorted((r.k, r.a, str(r.dbt_valid_from), str(r.dbt_valid_to)) for r in stored.collect())
    assert got == [("a", 1.0, T1, T2), ("a", 3.0, T2, "None"), ("b", 1.0, T1, T2), ("b", 2.0, T2, "None")]
    assert stored.select("dbt_scd_id").distinct().count() == 4
