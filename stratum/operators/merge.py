"""Keyed table maintenance without a table format.

``merge_upsert`` gives MERGE semantics (update-when-matched with a condition,
insert-when-not-matched) as one full outer join on the keys; which side a row
came from decides between keep, update and insert, so target and source are
each computed once. Rows with a NULL key never match; a spread value in the
join keeps them from meeting in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (DateType, MapType, TimestampNTZType, TimestampType,
                               VariantType)

from ..functions.columns import epoch_timestamp

ACTION = "_merge_action"
#: Stamp types whose high-water mark has a floor on an empty table.
_WITH_FLOOR = (TimestampType, TimestampNTZType, DateType)


def _expr(e) -> Column:
    return F.expr(e) if isinstance(e, str) else e


SPREAD = "__spread"


def _with_spread(df: DataFrame, keys: Sequence[str], null_safe: bool) -> DataFrame:
    """Adds a join value that is 0 for rows that can match and differs between
    rows with a NULL key (which cannot), so these are dealt over all tasks."""
    if null_safe:
        return df.withColumn(SPREAD, F.lit(0).cast("bigint"))
    usable = [f.name for f in df.schema.fields if not isinstance(f.dataType, (MapType, VariantType))]
    some_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return df.withColumn(SPREAD, F.when(some_null, F.xxhash64(*usable)).otherwise(F.lit(0).cast("bigint")))


def _key_condition(keys: Sequence[str], null_safe: bool) -> Column:
    parts = [(F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) if null_safe
              else F.col(f"t.{k}") == F.col(f"s.{k}")) for k in keys]
    return reduce(lambda a, b: a & b, [*parts, F.col(f"t.{SPREAD}") == F.col(f"s.{SPREAD}")])


def _checked(source: DataFrame, keys: Sequence[str], null_safe: bool, flag: str = "__s_hit") -> DataFrame:
    """``source`` (with its spread) and a true ``flag``, failing at run time where
    a key that can match occurs twice. Partitioned like the join that follows."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys, SPREAD))
    can_match = F.lit(True) if null_safe else reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    message = F.concat(F.lit("source has duplicate merge keys, e.g. "), F.to_json(F.struct(*keys)))
    return source.withColumn(flag, F.when((n > 1) & can_match, F.raise_error(message).cast("boolean"))
                             .otherwise(F.lit(True)))


def unique_or_fail(source: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """``source`` with a true column ``flag`` whose computation fails where a
    key without NULLs occurs twice; the flag must be used for the check to run."""
    return _checked(_with_spread(source, keys, False), keys, False, flag).drop(SPREAD)


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
                 update_set: Mapping[str, object], update_when=None,
                 insert: bool = True, null_safe_keys: bool = False,
                 check_unique: bool = True, with_action: bool = False) -> DataFrame:
    """MERGE ``source`` into ``target`` on ``keys`` and return the new table.

    ``update_set`` maps target columns to expressions over ``t.*`` (target)
    and ``s.*`` (source); ``update_when`` is the matched-clause condition
    (SQL text or Column, same aliases). Unmatched source rows are inserted
    with all target columns (``insert=True``). Keys compare with ``=`` by
    default, so NULL keys never match and such source rows are inserted
    again; ``null_safe_keys=True`` uses ``<=>`` instead. A key that occurs
    twice in the source makes the query fail (``check_unique``).
    """
    keys = list(keys)
    cols = target.columns
    source = _with_spread(source, keys, null_safe_keys)
    s = (_checked(source, keys, null_safe_keys) if check_unique
         else source.withColumn("__s_hit", F.lit(True))).alias("s")
    t = _with_spread(target, keys, null_safe_keys).withColumn("__t_hit", F.lit(True)).alias("t")
    joined = t.join(s, _key_condition(keys, null_safe_keys), "full_outer" if insert else "left")
    in_t, in_s = F.col("t.__t_hit").isNotNull(), F.col("s.__s_hit").isNotNull()
    update = in_t & in_s
    if update_when is not None:
        update = update & F.coalesce(_expr(update_when), F.lit(False))

    def column(c: str) -> Column:
        old = F.when(update, _expr(update_set[c])).otherwise(F.col(f"t.{c}")) if c in update_set else F.col(f"t.{c}")
        return (F.when(in_t, old).otherwise(F.col(f"s.{c}")) if insert else old).alias(c)

    action = F.when(update, F.lit("update")).when(in_t, F.lit("keep")).otherwise(F.lit("insert"))
    return joined.select(*map(column, cols), *[action.alias(ACTION)] * with_action)


def high_water_mark(existing: DataFrame, stamp_col: str) -> Column:
    """COALESCE(MAX(stamp), 1900-01-01) as an uncorrelated scalar subquery.

    The epoch floor applies to timestamp and date stamps; for other stamp
    types (e.g. an integer version) an empty table has no mark (NULL).
    """
    mark = existing.select(F.max(stamp_col)).scalar()
    dtype = existing.schema[stamp_col].dataType
    if isinstance(dtype, _WITH_FLOOR):
        return F.coalesce(mark, epoch_timestamp().cast(dtype))
    return mark


def newer_than(incoming: DataFrame, existing: DataFrame, stamp_col: str,
               existing_stamp_col: str | None = None) -> DataFrame:
    """Rows of ``incoming`` strictly newer than the table's high-water mark
    (all rows when the table has no mark)."""
    column = existing_stamp_col or stamp_col
    mark = high_water_mark(existing, column)
    if isinstance(existing.schema[column].dataType, _WITH_FLOOR):  # never NULL: the subquery is needed once
        return incoming.filter(F.col(stamp_col) > mark)
    return incoming.filter(mark.isNull() | (F.col(stamp_col) > mark))


def sync_columns(old: DataFrame, new_schema_df: DataFrame) -> DataFrame:
    """Align ``old`` rows to the new schema: vanished columns dropped,
    new columns added as typed NULLs."""
    have = set(old.columns)
    return old.select(*[(F.col(f.name) if f.name in have else F.lit(None))
                        .cast(f.dataType).alias(f.name)
                        for f in new_schema_df.schema.fields])


def incremental_merge(existing: DataFrame | None, new_rows: DataFrame,
                      unique_key: Sequence[str] | str, stamp_col: str | None = None,
                      keep_first: Sequence[str] = ()) -> DataFrame:
    """M7: incremental model load.

    New rows (already filtered by ``newer_than`` if ``stamp_col`` is given)
    replace existing rows with the same unique key; the rest are inserted.
    The old table is aligned to the new schema first (S15). Columns in
    ``keep_first`` keep the value of the row being replaced (insert-only
    stamps such as a created-at). A key that occurs twice among the new rows
    makes the query fail, as a MERGE would.
    """
    keys = [unique_key] if isinstance(unique_key, str) else list(unique_key)
    if existing is None:
        return new_rows
    if stamp_col is not None:
        new_rows = newer_than(new_rows, existing, stamp_col)
    columns = new_rows.columns
    t = _with_spread(sync_columns(existing, new_rows), keys, False).withColumn("__t_hit", F.lit(True)).alias("t")
    s = _checked(_with_spread(new_rows, keys, False), keys, False).alias("s")
    joined = t.join(s, _key_condition(keys, False), "full_outer")
    replaced, is_new = F.col("t.__t_hit").isNotNull(), F.col("s.__s_hit").isNotNull()
    return joined.select(*[
        (F.when(replaced & is_new, F.coalesce(f"t.{c}", f"s.{c}")).when(is_new, F.col(f"s.{c}"))
         if c in keep_first else F.when(is_new, F.col(f"s.{c}"))).otherwise(F.col(f"t.{c}")).alias(c)
        for c in columns])
