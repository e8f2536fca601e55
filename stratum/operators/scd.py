"""Slowly changing dimension, type 2, by check columns (M4–M6).

History rows carry the incoming columns plus ``dbt_scd_id``,
``dbt_updated_at``, ``dbt_valid_from`` and ``dbt_valid_to`` (NULL = open).
One full outer join of the open rows with the incoming snapshot on the key
decides every key's fate; closed history passes through untouched.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .merge import unique_or_fail

SCD_ID = "dbt_scd_id"
UPDATED_AT = "dbt_updated_at"
VALID_FROM = "dbt_valid_from"
VALID_TO = "dbt_valid_to"
META = [SCD_ID, UPDATED_AT, VALID_FROM, VALID_TO]
TS_TEXT = "yyyy-MM-dd HH:mm:ss"


def version_id(key: Column, stamp: Column) -> Column:
    """Version id: md5 of key text, '|', stamp text."""
    return F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit("|"),
                          F.coalesce(F.date_format(stamp, TS_TEXT), F.lit(""))))


def _open_rows(incoming: DataFrame, key: str, stamp: Column) -> DataFrame:
    return incoming.withColumns({
        SCD_ID: version_id(F.col(key), stamp),
        UPDATED_AT: stamp,
        VALID_FROM: stamp,
        VALID_TO: F.lit(None).cast("timestamp"),
    })


def scd2_apply(history: DataFrame | None, incoming: DataFrame, key: str,
               check_cols: Sequence[str], run_ts: str,
               invalidate_hard_deletes: bool = False, check_unique: bool = True) -> DataFrame:
    """M4: apply one snapshot run at ``run_ts``.

    * new key                      -> open row
    * a check column changed (NULL-aware) -> old row closed at run_ts, new row opened
    * unchanged, or only non-check columns changed -> nothing
    * key absent from ``incoming``  -> stays open (closed if ``invalidate_hard_deletes``)
    * a version opened at ``run_ts`` itself (the run is repeated on other input)
      -> replaced, or dropped, instead of closed: it was never valid

    ``incoming`` must hold one row per key (unless ``check_unique`` is False, a
    key that occurs twice makes the query fail). Running the same input twice
    is a no-op.
    """
    stamp = F.lit(run_ts).cast("timestamp")
    data_cols = incoming.columns
    new = unique_or_fail(incoming, [key], "__n") if check_unique else incoming.withColumn("__n", F.lit(True))
    if history is None:
        return _open_rows(new.filter("__n"), key, stamp).select(*data_cols, *META)

    closed = history.filter(F.col(VALID_TO).isNotNull())
    open_ = history.filter(F.col(VALID_TO).isNull()).withColumn("__h", F.lit(True))
    j = open_.alias("h").join(new.alias("n"), F.col(f"h.{key}") == F.col(f"n.{key}"), "full_outer")

    in_h = F.col("h.__h").isNotNull()
    in_n = F.col("n.__n").isNotNull()
    changed = reduce(lambda a, b: a | b,
                     [~F.col(f"h.{c}").eqNullSafe(F.col(f"n.{c}")) for c in check_cols])
    is_changed = in_h & in_n & changed
    vanished = in_h & ~in_n
    never_valid = (F.col(f"h.{VALID_FROM}") == stamp) & (is_changed | (vanished & F.lit(invalidate_hard_deletes)))

    h_valid_to = (F.when(is_changed, stamp)
                  .when(vanished & F.lit(invalidate_hard_deletes), stamp)
                  .otherwise(F.col(f"h.{VALID_TO}")))
    h_row = F.struct(*[F.col(f"h.{c}").alias(c) for c in data_cols],
                     F.col(f"h.{SCD_ID}").alias(SCD_ID),
                     F.col(f"h.{UPDATED_AT}").alias(UPDATED_AT),
                     F.col(f"h.{VALID_FROM}").alias(VALID_FROM),
                     h_valid_to.alias(VALID_TO))
    n_row = F.struct(*[F.col(f"n.{c}").alias(c) for c in data_cols],
                     version_id(F.col(f"n.{key}"), stamp).alias(SCD_ID),
                     stamp.alias(UPDATED_AT), stamp.alias(VALID_FROM),
                     F.lit(None).cast("timestamp").alias(VALID_TO))
    rows = F.array(F.when(in_h & ~F.coalesce(never_valid, F.lit(False)), h_row), F.when(in_n & (~in_h | changed), n_row))
    current = j.select(F.inline(F.filter(rows, lambda r: r.isNotNull())))
    return closed.select(*data_cols, *META).unionByName(current)


def scd2_current(history: DataFrame) -> DataFrame:
    """M5: the open version of every key."""
    return history.filter(F.col(VALID_TO).isNull())


def scd2_as_of(history: DataFrame, as_of: str) -> DataFrame:
    """M6: the version valid at ``as_of``: valid_from <= t < coalesce(valid_to, ∞)."""
    t = F.lit(as_of).cast("timestamp")
    return history.filter((F.col(VALID_FROM) <= t) &
                          (F.col(VALID_TO).isNull() | (t < F.col(VALID_TO))))
