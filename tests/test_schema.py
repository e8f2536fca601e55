"""Schema kept with a table (S15): no data file is rewritten when it changes."""

import pytest
from pyspark.sql.types import StructType

from stratum.sources import schema as S
from stratum.sources import tables

from .conftest import rows
from .test_io import data_files


def load(spark, path, data, ddl):
    return tables.load_incremental_partitions(spark, path, spark.createDataFrame(data, ddl), "k", ["p"], "stamp")


def test_columns_come_and_go_without_rewriting(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    load(spark, path, [("a", 1, 1, "x"), ("b", 2, 1, "y")], "k string, p int, stamp int, old string")
    first = data_files(path)
    out = load(spark, path, [("c", 3, 2, 7)], "k string, p int, stamp int, new int")
    assert rows(out.select("k", "p", "new")) == [("a", 1, None), ("b", 2, None), ("c", 3, 7)] and "old" not in out.columns
    second = data_files(path)
    assert first.items() <= second.items() and all("/p=3/" in f for f in second.keys() - first.keys())
    # a dropped column that comes back starts empty
    out = load(spark, path, [("d", 4, 3, 8, "z")], "k string, p int, stamp int, new int, old string")
    assert rows(out.select("k", "new", "old")) == [("a", None, None), ("b", None, None), ("c", 7, None), ("d", 8, "z")]
    # a touched partition is written in the newest schema, the others stay
    out = load(spark, path, [("a", 1, 4, 9, "w")], "k string, p int, stamp int, new int, old string")
    assert rows(out.select("k", "new", "old")) == [("a", 9, "w"), ("b", None, None), ("c", 7, None), ("d", 8, "z")]
    third = data_files(path)
    assert {f for f in second if "/p=1/" not in f} <= third.keys()
    assert rows(tables.read_table(spark, path)) == rows(out) and tables.read_watermark(spark, path) == 4


def test_a_type_changes_without_rewriting(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    load(spark, path, [("a", 1, 1, "5"), ("b", 2, 1, "five")], "k string, p int, stamp int, v string")
    first = data_files(path)
    out = load(spark, path, [("c", 3, 2, 6)], "k string, p int, stamp int, v bigint")
    assert rows(out.select("k", "v")) == [("a", 5), ("b", None), ("c", 6)] and dict(out.dtypes)["v"] == "bigint"
    assert first.items() <= data_files(path).items()
    out = load(spark, path, [("a", 1, 3, None)], "k string, p int, stamp int, v bigint")
    assert rows(out.select("k", "v")) == [("a", None), ("b", None), ("c", 6)]


def test_nested_types_do_not_change_by_nullability(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    df = spark.range(2).selectExpr("cast(id as string) k", "cast(id as int) p", "cast(id as int) stamp", "array('x') tags",
                                   "named_struct('a', 1) s")
    tables.load_incremental_partitions(spark, path, df, "k", ["p"], "stamp")
    tables.load_incremental_partitions(spark, path, df.selectExpr("k", "p", "stamp + 5 as stamp", "tags", "s"), "k", ["p"], "stamp")
    assert S.stored_schema(spark, path) is None


def test_names_in_the_files_are_never_used_twice():
    ddl = StructType.fromDDL
    one = S.TableSchema.of(ddl("a int, p int, b string"), ["p"])
    two = one.evolved(ddl("p int, b string"))
    assert two.retired == ["a"] and [c[0] for c in two.columns] == ["p", "b"]
    three = two.evolved(ddl("a int, b string, p int, a__2 int"))
    assert {n: held[0][0] for n, held in three.columns} == {"a": "a__2", "b": "b", "p": "p", "a__2": "a__2__2"}
    assert three.logical.fieldNames() == ["a", "b", "p", "a__2"] and three.same_as(ddl("a int, b string, p int, a__2 int"))
    with pytest.raises(ValueError, match="partition"):
        three.evolved(ddl("a int"))
