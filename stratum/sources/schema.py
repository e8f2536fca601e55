"""A table's schema, kept beside its files and applied when they are read.

``<table>/_schema/v-<number>.json`` lists the table's columns and, for each,
the names it has in the files, newest first. A column that is added, dropped,
or given another type changes this file only: no data file is rewritten.

* added: older files lack it, and a missing Parquet column reads as NULL;
* dropped: its name in the files is retired, so a later column of the same
  name gets a name of its own there and never shows the old values;
* another type: new files hold it under a new name, and it reads as the first
  of its names that a file has, cast to the current type.

Readers skip folders that start with ``_``. The file of a new version is
written under a temporary name and renamed, so a reader sees all of it or the
version before. Filters on a column that never changed its type reach the
files as before; those on one that did are applied after reading.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructField, StructType

from .files import _fs, list_entries, path_exists

SCHEMA_DIR = "_schema"


def _nullable(kind: DataType) -> DataType:
    """The type as files give it back: nothing inside is sure not to be NULL."""
    if isinstance(kind, ArrayType):
        return ArrayType(_nullable(kind.elementType))
    if isinstance(kind, MapType):
        return MapType(_nullable(kind.keyType), _nullable(kind.valueType))
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, _nullable(f.dataType)) for f in kind.fields])
    return kind


def _type(text: str) -> DataType:
    return StructType.fromJson(json.loads(text)).fields[0].dataType


def _text(kind: DataType) -> str:
    return json.dumps(StructType([StructField("c", _nullable(kind))]).jsonValue())


@dataclass
class TableSchema:
    """Columns in order: (name, [(name in the files, type), ...] newest first)."""

    columns: list[tuple[str, list[tuple[str, str]]]]
    parts: list[str]
    retired: list[str] = field(default_factory=list)

    @classmethod
    def of(cls, schema: StructType, parts=()) -> TableSchema:
        """The schema of a table whose files hold its columns under their own names."""
        return cls([(f.name, [(f.name, _text(f.dataType))]) for f in schema.fields], list(parts))

    @property
    def logical(self) -> StructType:
        return StructType([StructField(name, _type(held[0][1])) for name, held in self.columns])

    @property
    def physical(self) -> StructType:
        return StructType([StructField(inner, _type(kind)) for _, held in self.columns for inner, kind in held])

    def same_as(self, new: StructType) -> bool:
        """Whether ``new`` has these columns, in order and type (partition columns aside)."""
        return [(n, held[0][1]) for n, held in self.columns if n not in self.parts] == \
            [(f.name, _text(f.dataType)) for f in new.fields if f.name not in self.parts]

    def evolved(self, new: StructType) -> TableSchema:
        """This schema with the columns of ``new``, in its order; partition
        columns keep their place in the files and must be there."""
        known, taken = dict(self.columns), {inner for _, held in self.columns for inner, _ in held} | set(self.retired)
        columns = []
        for f in new.fields:
            kind, held = _text(f.dataType), known.get(f.name, [])
            if f.name in self.parts or held and held[0][1] == kind:
                columns.append((f.name, held))
                continue
            inner, n = f.name, 1
            while inner in taken:
                n += 1
                inner = f"{f.name}__{n}"
            taken.add(inner)
            columns.append((f.name, [(inner, kind), *held]))
        missing = [p for p in self.parts if p not in dict(columns)]
        if missing:
            raise ValueError(f"partition columns cannot be dropped: {', '.join(missing)}")
        used = {inner for _, held in columns for inner, _ in held}
        return TableSchema(columns, self.parts, sorted(taken - used))

    def read(self, files: DataFrame) -> DataFrame:
        """The table's columns from its files (read with ``physical``)."""
        def column(name: str, held: list[tuple[str, str]]) -> Column:
            kind = _type(held[0][1])
            parts = [F.col(f"`{inner}`") for inner, _ in held]
            if len(parts) == 1:
                return parts[0].alias(name)
            return F.coalesce(parts[0], *[c.try_cast(kind) for c in parts[1:]]).alias(name)
        return files.select(*[column(*c) for c in self.columns])

    def write(self, rows: DataFrame) -> DataFrame:
        """``rows`` under the names that new files use."""
        return rows.select(*[F.col(f"`{name}`").cast(_type(held[0][1])).alias(held[0][0]) for name, held in self.columns])


def stored_schema(spark: SparkSession, path: str) -> TableSchema | None:
    """The latest schema kept with the table, None if it keeps none."""
    folder = f"{path.rstrip('/')}/{SCHEMA_DIR}"
    if not path_exists(spark, folder):
        return None
    found = sorted(n for n, is_dir in list_entries(spark, folder) if re.fullmatch(r"v-\d+\.json", n))
    if not found:
        return None
    fs, p = _fs(spark, f"{folder}/{found[-1]}")
    stream = fs.open(p)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    held = json.loads(text)
    return TableSchema([(name, [tuple(x) for x in inner]) for name, inner in held["columns"]], held["parts"], held["retired"])


def store_schema(spark: SparkSession, path: str, schema: TableSchema) -> None:
    """Keep ``schema`` as the table's next version."""
    folder = f"{path.rstrip('/')}/{SCHEMA_DIR}"
    versions = [int(m[1]) for n, _ in (list_entries(spark, folder) if path_exists(spark, folder) else [])
                if (m := re.fullmatch(r"v-(\d+)\.json", n))]
    fs, target = _fs(spark, f"{folder}/v-{max(versions, default=0) + 1:08d}.json")
    _, draft = _fs(spark, f"{folder}/.draft-{uuid.uuid4().hex}")
    stream = fs.create(draft)
    try:
        stream.write(bytearray(json.dumps({"columns": schema.columns, "parts": schema.parts, "retired": schema.retired}).encode()))
    finally:
        stream.close()
    if not fs.rename(draft, target):
        raise OSError(f"could not rename {draft} to {target}")
