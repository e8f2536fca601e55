"""Declarative data-quality contracts (Q1–Q10).

A rule is a plain dict:

    {"kind": "not_null" | "accepted_values" | "range" | "regex" |
             "row_condition" | "unique" | "relationship",
     "column": "c" (or a list for unique), "dimension": "VALIDITY",
     "threshold": 1.0, "ignore_null": False, "where": "sql predicate",
     "values": [...], "min": x, "max": y, "inclusive": True (or "min_inclusive", "max_inclusive"),
     "regex": "...", "expression": "sql", "parent": DataFrame, "parent_column": "c"}

A whole contract is answered by one scan of each table and one shuffle. A row
becomes a few tagged keys: the outcomes of the table's row-level rules as one
short text, one key for each uniqueness rule and relationship, and one for
each relationship that the table is the parent of. Equal (tag, side, key) are
counted map-side, so a hot key, or millions of passing rows, leave a task as
one row. The counts of a key tell whether it is repeated, or has no parent;
their sums by rule are the result, a DataFrame that is never collected.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BinaryType, ByteType, DataType, DecimalType, DoubleType, FloatType,
                               IntegerType, LongType, MapType, NumericType, ShortType, StringType, StructType)

#: What a tagged key stands for.
UNIQUE, CHILD, PARENT, ROWS = range(4)
ROW_KINDS = ("not_null", "accepted_values", "range", "regex", "row_condition")


def rule_name(rule: dict) -> str:
    col = rule["column"]
    col = ",".join(col) if isinstance(col, (list, tuple)) else col
    return rule.get("name") or f"{rule['kind']}({col})"


def _fails(rule: dict) -> Column:
    """Row-level failure predicate (never NULL)."""
    kind = rule["kind"]
    c = F.col(rule["column"]) if kind != "row_condition" else None
    ignore_null = bool(rule.get("ignore_null", False))
    null_fails = F.lit(not ignore_null)
    if kind == "not_null":
        return c.isNull()
    if kind == "accepted_values":
        # SQL NOT IN semantics of the model tests: NULL is not a failure.
        return F.coalesce(~c.isin(*rule["values"]), F.lit(False))
    if kind == "range":
        lo, hi = rule.get("min"), rule.get("max")
        inclusive = rule.get("inclusive", True)
        ok = F.lit(True)
        if lo is not None:
            ok = ok & ((c >= F.lit(lo)) if rule.get("min_inclusive", inclusive) else (c > F.lit(lo)))
        if hi is not None:
            ok = ok & ((c <= F.lit(hi)) if rule.get("max_inclusive", inclusive) else (c < F.lit(hi)))
        return F.when(c.isNull(), null_fails).otherwise(~ok)
    if kind == "regex":
        return F.when(c.isNull(), null_fails).otherwise(~c.rlike(rule["regex"]))
    if kind == "row_condition":
        # A NULL predicate result is a failure.
        return ~F.coalesce(F.expr(rule["expression"]), F.lit(False))
    raise ValueError(f"not a row-level rule: {kind}")


def _scope(rule: dict) -> Column:
    where = rule.get("where")
    return F.coalesce(F.expr(where), F.lit(False)) if where else F.lit(True)


def _columns(rule: dict) -> list[str]:
    return list(rule["column"]) if isinstance(rule["column"], (list, tuple)) else [rule["column"]]


def _result(table_name: str, rule: dict, number: int) -> Column:
    """What is known of a rule before its table is read."""
    return F.struct(
        F.lit(number).alias("__rule"), F.lit(table_name).alias("table_name"), F.lit(rule_name(rule)).alias("rule"),
        F.lit(",".join(_columns(rule))).alias("column_name"),
        F.lit(rule.get("dimension")).cast("string").alias("dimension"),
        F.lit(float(rule.get("threshold", 1.0))).alias("threshold"))


def _key(df: DataFrame, columns: Sequence[str], like: Sequence[DataType]) -> Column:
    """Text that is equal for equal values (NULL for one NULL column): numbers
    of several columns or of two sides are compared as ``like`` says."""
    parts = []
    for name, kind in zip(columns, like):
        c = F.col(name).cast(kind)
        if isinstance(kind, (FloatType, DoubleType)):
            c = c + F.lit(0.0)  # one zero
        parts.append(F.base64(c) if isinstance(kind, BinaryType) else
                     F.to_json(F.struct(c)) if isinstance(kind, (ArrayType, MapType, StructType)) else c.cast("string"))
    if len(parts) == 1:
        return parts[0]
    any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
    return F.when(~any_null, F.to_json(F.array(*parts)))


def _common(a: DataType, b: DataType) -> DataType:
    """What values of two types are compared as."""
    if a == b:
        return a
    whole = (ByteType, ShortType, IntegerType, LongType)
    if isinstance(a, whole) and isinstance(b, whole):
        return LongType()
    if isinstance(a, DecimalType) and isinstance(b, (DecimalType, *whole)) or isinstance(b, DecimalType) and isinstance(a, whole):
        return DecimalType(38, max(getattr(x, "scale", 0) for x in (a, b)))
    if isinstance(a, NumericType) and isinstance(b, NumericType):
        return DoubleType()
    return StringType()


def evaluate_all(contract: Sequence[tuple[str, DataFrame, Sequence[dict]]]) -> DataFrame:
    """Q8/Q10: a whole contract (several tables) -> one result row per rule.

    ``parent`` of a relationship may be one of the contract's own DataFrames
    (the same object), which is then not scanned again."""
    tables: list[tuple[DataFrame, list[Column]]] = []  # scans, and the tagged keys each gives
    at: dict[int, int] = {}

    def keys_of(df: DataFrame) -> list[Column]:
        if id(df) not in at:
            at[id(df)] = len(tables)
            tables.append((df, []))
        return tables[at[id(df)]][1]

    def tagged(tag: int, side: int, key: Column) -> Column:
        return F.struct(F.lit(tag).alias("tag"), F.lit(side).alias("side"), key.alias("key"))

    known, outcomes = [], {}
    for name, df, rules in contract:
        mine, row_level = keys_of(df), []
        for rule in rules:
            number = len(known)
            known.append(_result(name, rule, number))
            if rule["kind"] in ROW_KINDS:
                row_level.append((number, F.when(~_scope(rule), F.lit("-")).when(_fails(rule), F.lit("F")).otherwise(F.lit("P"))))
            elif rule["kind"] == "unique":
                columns = _columns(rule)
                key = _key(df, columns, [df.schema[c].dataType for c in columns])
                mine.append(F.when(_scope(rule), tagged(number, UNIQUE, key)))
            elif rule["kind"] == "relationship":
                c, parent = rule["column"], rule["parent"]
                field = rule.get("parent_column", c)
                kind = _common(df.schema[c].dataType, parent.schema[field].dataType)
                mine.append(F.when(_scope(rule) & F.col(c).isNotNull(), tagged(number, CHILD, _key(df, [c], [kind]))))
                keys_of(parent).append(F.when(F.col(field).isNotNull(), tagged(number, PARENT, _key(parent, [field], [kind]))))
            else:
                raise ValueError(f"unknown rule kind {rule['kind']}")
        if row_level:
            tag = row_level[0][0]  # one text for all of them, a letter a rule
            outcomes[tag] = [number for number, _ in row_level]
            mine.append(tagged(tag, ROWS, F.concat(*[c for _, c in row_level])))

    rows = reduce(lambda a, b: a.unionAll(b), [
        df.select(F.explode(F.array(*keys)).alias("k")).filter("k is not null").select("k.tag", "k.side", "k.key")
        for df, keys in tables if keys])
    counted = rows.groupBy("tag", "key").agg(
        F.count_if(F.col("side") != PARENT).alias("n"), F.max("side").alias("side"),
        (F.count_if(F.col("side") == PARENT) > 0).alias("has_parent"))
    n, none = F.col("n"), F.lit(0).cast("bigint")

    def counts(number, total: Column, failed: Column) -> Column:
        return F.struct(F.lit(number).alias("__rule") if isinstance(number, int) else number.alias("__rule"),
                        total.alias("total"), failed.alias("failed"))

    failed = F.when((F.col("side") == UNIQUE) & (n > 1) & F.col("key").isNotNull(), n) \
        .when((F.col("side") != UNIQUE) & ~F.col("has_parent"), n).otherwise(none)
    # Keys are summed by tag (outcomes: by text) before the rules take their share.
    counted = counted.select("tag", F.when(F.col("side") == ROWS, F.col("key")).alias("key"), n.alias("n"), failed.alias("failed")) \
        .groupBy("tag", "key").agg(F.sum("n").alias("n"), F.sum("failed").alias("failed"))
    parts = F.array(counts(F.col("tag"), n, F.col("failed")))
    for tag, numbers in outcomes.items():
        letter = [F.substring("key", i + 1, 1) for i in range(len(numbers))]
        parts = F.when(F.col("tag") == tag, F.array(*[
            counts(number, F.when(x != "-", n).otherwise(none), F.when(x == "F", n).otherwise(none))
            for number, x in zip(numbers, letter)])).otherwise(parts)
    sums = counted.select(F.inline(parts)).groupBy("__rule").agg(F.sum("total").alias("total"), F.sum("failed").alias("failed"))
    spark = contract[0][1].sparkSession
    rules = spark.range(1).select(F.inline(F.array(*known)))
    passed = F.col("total") - F.col("failed")
    return rules.join(sums, "__rule", "left").withColumns(
        {"total": F.coalesce("total", none), "failed": F.coalesce("failed", none)}) \
        .withColumn("passed", passed) \
        .withColumn("pass_ratio", F.when(F.col("total") > 0, F.round(F.col("passed") / F.col("total"), 6))) \
        .select("table_name", "rule", "column_name", "dimension", "total", "failed", "passed", "pass_ratio", "threshold",
                F.coalesce(F.col("pass_ratio") >= F.col("threshold"), F.lit(True)).alias("ok"))


def evaluate(df: DataFrame, table_name: str, rules: Sequence[dict]) -> DataFrame:
    """Evaluate ``rules`` against ``df``: one result row per rule."""
    return evaluate_all([(table_name, df, rules)])


def scorecard(results: DataFrame, run_id: str | None = None) -> DataFrame:
    """Score per table × dimension, 100 % flag.

    With ``run_id`` the results are one run's; without it ``results`` is a
    history (the appended results table) and is scored per run, giving the
    score over time.
    """
    runs = results.withColumn("run_id", F.lit(run_id)) if run_id is not None else results
    return (runs.groupBy("table_name", "dimension", "run_id")
            .agg(F.sum("total").alias("total"), F.sum("passed").alias("passed"))
            .withColumn("score", F.when(F.col("total") > 0,
                                        F.round(F.col("passed") * 100.0 / F.col("total"), 4)))
            .withColumn("is_perfect", F.coalesce(F.col("score") == 100.0, F.lit(True))))


class AssertionFailed(AssertionError):
    pass


def table_assertions(df: DataFrame, key: str) -> DataFrame:
    """Q9: non-empty and zero NULL keys, as one aggregate (lazy)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.count_if(F.col(key).isNull()).alias("null_keys"))


def assert_table(df: DataFrame, key: str, name: str, more: Sequence[Column] = ()) -> dict:
    """Q9 fail-fast: raise unless the table has rows and no NULL keys. Returns
    these counts, and ``more`` aggregates of the same pass."""
    row = df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(key).isNull()).alias("null_keys"), *more).first()
    if row["n_rows"] == 0:
        raise AssertionFailed(f"{name}: table is empty")
    if row["null_keys"]:
        raise AssertionFailed(f"{name}: {row['null_keys']} rows with NULL {key}")
    return row.asDict()


def assert_rules(results: DataFrame) -> None:
    """Fail-fast: raise naming the rules that did not hold (one row per rule
    is read, so the result is as small as the contract)."""
    failed = results.filter(~F.col("ok")).select("table_name", "rule", "failed").collect()
    if failed:
        raise AssertionFailed("; ".join(f"{r.table_name}.{r.rule}: {r.failed} rows" for r in failed))


def enrichment_rate(movies: DataFrame, status_col: str = "enrichment_status") -> DataFrame:
    """SUCCESS / all (0 when empty), one lazy row."""
    return movies.agg(F.count_if(F.col(status_col) == "SUCCESS").alias("success"),
                      F.count(F.lit(1)).alias("total")).withColumn(
        "rate", F.coalesce(F.round(F.try_divide(F.col("success"), F.nullif(F.col("total"), F.lit(0))), 6),
                           F.lit(0.0)))


def assert_enrichment_rate(movies: DataFrame, min_rate: float = 0.70) -> float:
    """A6 fail-fast: raise when the match rate is below ``min_rate``."""
    row = enrichment_rate(movies).first()
    return assert_rate(row["success"], row["total"], min_rate)


def assert_rate(success: int, total: int, min_rate: float = 0.70) -> float:
    """A6 fail-fast on counts that are known already."""
    rate = round(success / total, 6) if total else 0.0
    if rate < min_rate:
        raise AssertionFailed(f"enrichment rate {rate:.1%} below {min_rate:.0%}")
    return rate
