import os

import pytest
from pyspark.sql import functions as F

from stratum.sources import files, tables

from .conftest import rows


def write_csv(path, header, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(header + "\n" + "\n".join(lines) + "\n")


def test_csv_scan_all_strings(spark, tmp_dir):
    write_csv(f"{tmp_dir}/l/diary.csv", "Date,Name,Year", ["2024-01-01,Amélie,2001"])
    df = files.read_csv_strings(spark, f"{tmp_dir}/l/diary.csv")
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["string"] * 3
    assert df.first().Name == "Amélie"


def test_landing_ingest_idempotent_and_summary(spark, tmp_dir):
    land, bronze = f"{tmp_dir}/landing", f"{tmp_dir}/bronze"
    write_csv(f"{land}/diary.csv", "Date,Name", ["2024-01-01,A", "2024-01-02,B"])
    write_csv(f"{land}/extra.csv", "x", ["1"])
    write_csv(f"{land}/notes.txt", "x", ["1"])
    found = spark.createDataFrame([(n,) for n in files.landing_files(spark, land)], "name string")
    assert rows(files.missing_inputs(found, files.EXPECTED_FILES["letterboxd"])) == [
        ("ratings.csv",), ("reviews.csv",), ("watched.csv",), ("watchlist.csv",)]
    s1 = files.ingest_landing(spark, land, bronze, "2024-01-01", "letterboxd", ["diary"])
    assert rows(s1, "file", "n_rows") == [("diary.csv", 2), ("extra.csv", 1)]
    files.ingest_landing(spark, land, bronze, "2024-01-02", "letterboxd", ["diary"])
    files.ingest_landing(spark, land, bronze, "2024-01-02", "letterboxd", ["diary"])   # re-run
    all_rows = spark.read.parquet(f"{bronze}/diary")
    assert all_rows.count() == 4                                  # 2 dates x 2 rows, no duplicates
    assert set(all_rows.columns) >= set(files.LINEAGE_COLUMNS)
    assert files.latest_partition(spark, f"{bronze}/diary") == "2024-01-02"
    assert files.latest_partition(spark, f"{bronze}/diary", "2024-01-01") == "2024-01-01"
    b = files.read_bronze(spark, f"{bronze}/diary")
    assert b.count() == 2 and rows(files.ingest_summary(b)) == [("diary.csv", 2)]
    # partition pruning reaches the scan
    plan = b._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "ingestion_date" in plan


def test_missing_landing(spark, tmp_dir):
    with pytest.raises(files.LandingError):
        files.check_landing(spark, f"{tmp_dir}/nope", f"{tmp_dir}/bronze", ["diary"], "2024-01-01")
    os.makedirs(f"{tmp_dir}/bronze/diary/ingestion_date=2024-01-01")
    assert files.check_landing(spark, f"{tmp_dir}/nope", f"{tmp_dir}/bronze", ["diary"],
                               "2024-01-01") == []
    os.makedirs(f"{tmp_dir}/empty")
    assert files.check_landing(spark, f"{tmp_dir}/empty", f"{tmp_dir}/bronze", ["diary"],
                               "2024-01-09") == []
    with pytest.raises(FileNotFoundError):
        files.latest_partition(spark, f"{tmp_dir}/empty")


def test_tables_upsert_replace_append_export(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    assert not tables.table_exists(spark, path)
    src = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    t1 = tables.upsert_table(spark, path, src, ["k"], {"v": "s.v"}, "s.v > t.v")
    assert rows(t1) == [("a", 1), ("b", 2)]
    src2 = spark.createDataFrame([("a", 5), ("b", 0), ("c", 3)], "k string, v int")
    t2 = tables.upsert_table(spark, path, src2, ["k"], {"v": "s.v"}, "s.v > t.v")
    assert rows(t2) == [("a", 5), ("b", 2), ("c", 3)]
    # replacing a table with something computed from itself
    t3 = tables.replace_table(tables.read_table(spark, path).withColumn("v", F.col("v") * 10), path)
    assert rows(t3) == [("a", 50), ("b", 20), ("c", 30)]
    tables.append_table(src, f"{tmp_dir}/log")
    tables.append_table(src, f"{tmp_dir}/log")
    assert spark.read.parquet(f"{tmp_dir}/log").count() == 4
    sink = tables.export_table(src, f"{tmp_dir}/sink")
    assert rows(tables.reconcile(src, sink, "t")) == [("t", 2, 2, True)]


def test_materializations(spark, tmp_dir):
    df = spark.createDataFrame([("a", 1, "2024-01-01")], "k string, v int, ts string")
    v = tables.materialize(df, "view", "stratum_test_view")
    assert spark.table("stratum_test_view").count() == 1 and v.count() == 1
    tables.materialize(df, "table", "t", f"{tmp_dir}/tab")
    tables.materialize(df, "incremental", "inc", f"{tmp_dir}/inc", "k", "ts")
    newer = spark.createDataFrame([("a", 2, "2024-01-05", "x"), ("b", 3, "2023-01-01", "y")],
                                  "k string, v int, ts string, extra string")
    out = tables.materialize(newer, "incremental", "inc", f"{tmp_dir}/inc", "k", "ts")
    assert rows(out) == [("a", 2, "2024-01-05", "x")]
    with pytest.raises(ValueError):
        tables.materialize(df, "snapshot", "x", f"{tmp_dir}/x")


def test_interrupted_swap_is_recovered(spark, tmp_dir):
    src = spark.createDataFrame([("a", 1)], "k string, v int")
    src.write.parquet(f"{tmp_dir}/t.__new-0001")      # staged copy, old dir already moved away
    assert tables.table_exists(spark, f"{tmp_dir}/t")
    assert rows(tables.read_table(spark, f"{tmp_dir}/t")) == [("a", 1)]


def test_partition_scoped_merge(spark, tmp_dir):
    path = f"{tmp_dir}/pt"
    first = spark.createDataFrame([("a", "2024-01", 1), ("b", "2024-02", 2), ("c", None, 3)],
                                  "k string, month string, v int")
    tables.upsert_partitions(spark, path, first, ["k", "month"], ["month"], {"v": "s.v"})
    # untouched partition 2024-02 must survive; NULL partition merged null-safely
    batch = spark.createDataFrame([("a", "2024-01", 10), ("d", "2024-01", 4), ("e", None, 5)],
                                  "k string, month string, v int")
    out = tables.upsert_partitions(spark, path, batch, ["k", "month"], ["month"], {"v": "s.v"},
                                   null_safe_keys=True)
    assert rows(out.select("k", "month", "v")) == [
        ("a", "2024-01", 10), ("b", "2024-02", 2), ("c", None, 3), ("d", "2024-01", 4), ("e", None, 5)]


def test_partition_merge_prunes_the_scan(spark, tmp_dir):
    path = f"{tmp_dir}/pp"
    data = spark.range(0, 300).selectExpr("cast(id as string) as k", "id % 30 as day", "id as v")
    tables.upsert_partitions(spark, path, data, ["k", "day"], ["day"], {"v": "s.v"})
    batch = spark.createDataFrame([("1", 1, 100)], "k string, day bigint, v bigint")
    target = tables.read_table(spark, path)
    scoped = target.filter(target["day"].eqNullSafe(1))
    p = scoped._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in p and "day" in p.split("PartitionFilters: [")[1].split("]")[0]
    out = tables.upsert_partitions(spark, path, batch, ["k", "day"], ["day"], {"v": "s.v"})
    assert out.count() == 300 and out.filter("k = '1'").first().v == 100


def test_partitioned_incremental_load(spark, tmp_dir):
    path = f"{tmp_dir}/fact"
    v1 = spark.createDataFrame([("k1", "2024-01", 1, "2024-01-05", "c0"),
                                ("k2", "2024-02", 2, "2024-02-05", "c0")],
                               "id string, month string, v int, stamp string, created string")
    tables.load_incremental_partitions(spark, path, v1, "id", ["month"], "stamp", ["created"])
    v2 = spark.createDataFrame([("k1", "2024-01", 10, "2024-03-01", "c1"),   # restated, newer
                                ("k2", "2024-02", 99, "2024-01-01", "c1"),   # older than the mark
                                ("k3", "2024-03", 3, "2024-03-02", "c1")],
                               "id string, month string, v int, stamp string, created string")
    out = tables.load_incremental_partitions(spark, path, v2, "id", ["month"], "stamp", ["created"])
    assert rows(out.select("id", "v", "created", "month")) == [
        ("k1", 10, "c0", "2024-01"), ("k2", 2, "c0", "2024-02"), ("k3", 3, "c1", "2024-03")]
    assert tables.read_watermark(spark, path) == "2024-03-02"     # kept beside the table
    assert "_watermark" not in spark.read.parquet(path).columns
    again = tables.load_incremental_partitions(spark, path, v2, "id", ["month"], "stamp", ["created"])
    assert again.count() == 3 and tables.read_watermark(spark, path) == "2024-03-02"


def test_partition_merge_from_a_null_only_table(spark, tmp_dir):
    path = f"{tmp_dir}/np"
    first = spark.createDataFrame([("a", None, 1)], "k string, month string, v int")
    tables.upsert_partitions(spark, path, first, ["k", "month"], ["month"], {"v": "s.v"})
    batch = spark.createDataFrame([("b", "2024-01", 2)], "k string, month string, v int")
    out = tables.upsert_partitions(spark, path, batch, ["k", "month"], ["month"], {"v": "s.v"})
    assert rows(out.select("k", "month", "v")) == [("a", None, 1), ("b", "2024-01", 2)]


def test_recovery_moves_the_only_copy_and_never_guesses(spark, tmp_dir):
    old = spark.createDataFrame([("stale", 1)], "k string, v int")
    new = spark.createDataFrame([("newest", 2)], "k string, v int")
    old.write.parquet(f"{tmp_dir}/t.__new-00000000000000000001-ff")
    new.write.parquet(f"{tmp_dir}/t.__new-00000000000000000002-aa")
    with pytest.raises(tables.RecoveryError):
        tables.read_table(spark, f"{tmp_dir}/t")
    old.write.parquet(f"{tmp_dir}/u.__old-00000000000000000001-ff")   # stopped before the new one was moved in
    new.write.parquet(f"{tmp_dir}/u.__new-00000000000000000002-aa")
    assert rows(tables.read_table(spark, f"{tmp_dir}/u")) == [("newest", 2)]
    old.write.parquet(f"{tmp_dir}/w.__old-00000000000000000001-ff")
    assert rows(tables.read_table(spark, f"{tmp_dir}/w")) == [("stale", 1)]


def test_failed_rename_keeps_the_old_table(spark, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/t"
    spark.createDataFrame([("a", 1)], "k string, v int").write.parquet(path)

    def refuse(spark, source, target):
        raise OSError("refused")
    monkeypatch.setattr(tables, "_rename", refuse)
    with pytest.raises(OSError):
        tables.replace_table(spark.createDataFrame([("b", 2)], "k string, v int"), path)
    assert rows(spark.read.parquet(path)) == [("a", 1)]


def test_thousands_of_partitions_twice(spark, tmp_dir):
    path = f"{tmp_dir}/many"
    n = 2500
    first = spark.range(n).selectExpr("cast(id as string) as k", "id as p", "id as v")
    tables.upsert_partitions(spark, path, first, ["k", "p"], ["p"], {"v": "s.v"})
    second = spark.range(n).selectExpr("cast(id as string) as k", "id as p", "id + 1 as v")
    out = tables.upsert_partitions(spark, path, second, ["k", "p"], ["p"], {"v": "s.v"})
    assert out.agg(F.count("*"), F.sum("v")).first()[:] == (n, n * (n + 1) // 2)
    one = spark.createDataFrame([("7", 7, -1), ("new", 7, 5)], "k string, p bigint, v bigint")
    out = tables.upsert_partitions(spark, path, one, ["k", "p"], ["p"], {"v": "s.v"})
    assert out.count() == n + 1 and out.filter("k = '7'").first().v == -1
    assert sum(d.startswith("p=") for d in os.listdir(path)) == n


def test_several_partition_columns(spark, tmp_dir):
    path = f"{tmp_dir}/two"
    first = spark.createDataFrame([("a", 1, "x", 1), ("b", 2, "y", 2), ("c", 1, "y", 3), ("d", None, "x", 4)],
                                  "k string, p int, q string, v int")
    tables.upsert_partitions(spark, path, first, ["k"], ["p", "q"], {"v": "s.v"})
    batch = spark.createDataFrame([("a", 1, "x", 10), ("b", 2, "y", 20), ("e", None, "x", 5)],
                                  "k string, p int, q string, v int")
    out = tables.upsert_partitions(spark, path, batch, ["k"], ["p", "q"], {"v": "s.v"})
    assert rows(out.select("k", "v")) == [("a", 10), ("b", 20), ("c", 3), ("d", 4), ("e", 5)]


def test_first_watermark_is_the_true_maximum(spark, tmp_dir):
    path = f"{tmp_dir}/wm"
    built = spark.range(1000).repartition(4).selectExpr("id as k", "id % 3 as p", "id as stamp")
    tables.load_incremental_partitions(spark, path, built, "k", ["p"], "stamp")
    assert tables.read_watermark(spark, path) == 999
    nothing = built.filter("stamp < 0")
    assert tables.load_incremental_partitions(spark, f"{tmp_dir}/none", nothing, "k", ["p"], "stamp").count() == 0
    assert not tables.table_exists(spark, f"{tmp_dir}/none")


def test_stored_fact_follows_the_schema(spark, tmp_dir):
    path = f"{tmp_dir}/sync"
    one = spark.createDataFrame([("a", 1, 1, "gone"), ("b", 2, 1, "gone")], "k string, p int, stamp int, old string")
    tables.load_incremental_partitions(spark, path, one, "k", ["p"], "stamp")
    two = spark.createDataFrame([("a", 1, 5, 7)], "k string, p int, stamp int, new int")
    out = tables.load_incremental_partitions(spark, path, two, "k", ["p"], "stamp")
    assert rows(out.select("k", "p", "stamp", "new")) == [("a", 1, 5, 7), ("b", 2, 1, None)]
    assert set(tables.read_table(spark, path).columns) == {"k", "p", "stamp", "new"}
    assert tables.read_watermark(spark, path) == 5


def test_absent_bronze_date_is_an_error(spark, tmp_dir):
    root = f"{tmp_dir}/bronze/ratings"
    files.write_bronze(spark.createDataFrame([("a",)], "k string"), f"{tmp_dir}/bronze", "ratings", "2024-01-01")
    assert files.read_bronze(spark, root, "2024-01-01").count() == 1
    with pytest.raises(FileNotFoundError):
        files.read_bronze(spark, root, "2024-01-02")


def delta_folder(spark, path):
    spark.createDataFrame([("a", 1)], "k string, v int").write.parquet(path)
    os.makedirs(f"{path}/_delta_log")
    with open(f"{path}/_delta_log/00000000000000000000.json", "w") as f:
        f.write("{}")


def test_no_writer_touches_a_delta_table(spark, tmp_dir):
    path = f"{tmp_dir}/delta"
    delta_folder(spark, path)
    before = sorted(os.listdir(path))
    df = spark.createDataFrame([("a", 2, "2024-01-01 00:00:00")], "k string, v int, s string")
    for write in (lambda: tables.replace_table(df, path), lambda: tables.append_table(df, path),
                  lambda: tables.write_run(df, path, "r"), lambda: tables.staged(df, path, F.count("k").alias("n")),
                  lambda: tables.upsert_table(spark, path, df, ["k"], {"v": "s.v"}),
                  lambda: tables.upsert_partitions(spark, path, df, ["k"], ["v"], {"s": "s.s"}),
                  lambda: tables.load_incremental_partitions(spark, path, df, "k", ["v"], "s"),
                  lambda: tables.snapshot_scd2(spark, path, df, "k", ["v"], "2024-01-01 00:00:00"),
                  lambda: tables.refresh_null_keys(spark, path, df, "k", "v", "k", ["s"]),
                  lambda: tables.materialize(df, "table", "t", path), lambda: tables.materialize(df, "incremental", "t", path, "k"),
                  lambda: tables.export_table(df, path)):
        with pytest.raises(tables.DeltaTableError):
            write()
    assert sorted(os.listdir(path)) == before and tables.table_exists(spark, path)


def test_catalog_export_replaces_rows_and_columns(spark, tmp_dir):
    first = spark.createDataFrame([("a", 1), ("b", 2)], "k string, old int")
    second = spark.createDataFrame([("c", 3.5)], "k string, v double")
    for path in (f"{tmp_dir}/files", None):
        name = f"stratum_test_export_{'files' if path else 'managed'}"
        if path is None and not spark.conf.get("spark.sql.warehouse.dir", "").startswith(("/tmp", "file:/tmp")):
            continue  # a managed table would lie in the working folder
        assert rows(tables.export_to_catalog(first, name, path)) == [("a", 1), ("b", 2)]
        sink = tables.export_to_catalog(second, name, path)
        assert rows(sink) == [("c", 3.5)] and sink.columns == ["k", "v"] and rows(spark.table(name)) == [("c", 3.5)]
        assert rows(tables.reconcile(second, sink, name)) == [(name, 1, 1, True)]
        if path:
            assert len(os.listdir(path)) == 1  # the files of the first export are gone
        spark.sql(f"DROP TABLE {name}")


def test_a_run_written_again_replaces_its_rows(spark, tmp_dir):
    path = f"{tmp_dir}/runs"
    row = lambda v: spark.createDataFrame([("t", v)], "name string, v int")
    tables.write_run(row(1), path, "2024-01-01 00:00:00")
    tables.write_run(row(2), path, "2024-01-02 00:00:00")
    out = tables.write_run(row(3), path, "2024-01-02 00:00:00")
    assert rows(out) == [("t", 1, "2024-01-01 00:00:00"), ("t", 3, "2024-01-02 00:00:00")]


def test_counts_are_taken_while_a_table_is_written(spark, tmp_dir):
    df = spark.range(7).withColumn("odd", F.col("id") % 2 == 1)
    out, seen = tables.staged(df, f"{tmp_dir}/s", F.count(F.lit(1)).alias("n"), F.count_if("odd").alias("odd"))
    assert seen == {"n": 7, "odd": 3} and out.count() == 7
    assert tables.staged(df.filter("id < 0"), f"{tmp_dir}/none", F.count(F.lit(1)).alias("n"))[1] == {"n": 0}


def test_repeated_keys_in_a_batch_fail(spark, tmp_dir):
    path = f"{tmp_dir}/twice"
    one = spark.createDataFrame([("a", 1, 1)], "k string, p int, stamp int")
    tables.load_incremental_partitions(spark, path, one, "k", ["p"], "stamp")
    batch = spark.createDataFrame([("a", 1, 5), ("a", 1, 6)], "k string, p int, stamp int")
    with pytest.raises(Exception, match="duplicate merge keys"):
        tables.load_incremental_partitions(spark, path, batch, "k", ["p"], "stamp")
    assert rows(tables.read_table(spark, path).select("k", "p", "stamp")) == [("a", 1, 1)]


def data_files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(path) for f in names if f.endswith(".parquet") and "/_" not in d}


def test_late_films_rewrite_only_their_partitions(spark, tmp_dir):
    path = f"{tmp_dir}/late"
    facts = spark.createDataFrame([("f1", "u1", None, 1), ("f2", "u2", "m2", 1), ("f3", "u3", None, 2), ("f4", None, None, 3),
                                   ("f5", "u1", "kept", 4)], "id string, uri string, movie_id string, p int")
    tables.replace_table(facts, path, ["p"])
    before = data_files(path)
    lookup = spark.createDataFrame([("u1", "m1"), ("u2", "other"), ("u9", "m9"), ("u8", None)], "uri string, movie_id string")
    out = tables.refresh_null_keys(spark, path, lookup, "uri", "movie_id", "id", ["p"])
    assert rows(out.select("id", "movie_id")) == [("f1", "m1"), ("f2", "m2"), ("f3", None), ("f4", None), ("f5", "kept")]
    changed = {f for f in before.items() ^ data_files(path).items()}
    assert changed and all("/p=1/" in f for f, _ in changed)
    again = data_files(path)
    assert rows(tables.refresh_null_keys(spark, path, lookup, "uri", "movie_id", "id", ["p"])) == rows(out)
    assert data_files(path) == again  # nothing left to repair
    with pytest.raises(Exception, match="duplicate merge keys"):
        tables.refresh_null_keys(spark, path, spark.createDataFrame([("u3", "a"), ("u3", "b")], "uri string, movie_id string"),
                                 "uri", "movie_id", "id", ["p"])
