"""Catalogue payloads: JSON text -> typed columns, all JVM-side.

The studied pipeline receives catalogue records as JSON and projects them in
Python dictionaries on the driver. Here the same payloads live in a column
and are parsed with ``from_json`` on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from .columns import zero_to_null

CORRUPT_COLUMN = "_corrupt_record"

# Numbers are read as text: a fractional or very large number must not make
# the whole record unparsable. ``number`` casts them.
CREW_MEMBER = StructType([
    StructField("job", StringType()),
    StructField("name", StringType()),
    StructField("id", StringType()),
])

DETAILS_SCHEMA = StructType([
    StructField("title", StringType()),
    StructField("original_title", StringType()),
    StructField("release_date", StringType()),
    StructField("genres", ArrayType(StructType([StructField("name", StringType())]))),
    StructField("runtime", StringType()),
    StructField("budget", StringType()),
    StructField("revenue", StringType()),
    StructField("vote_average", StringType()),
    StructField("vote_count", StringType()),
    StructField("overview", StringType()),
    StructField("original_language", StringType()),
    StructField("poster_path", StringType()),
    StructField("credits", StructType([StructField("crew", ArrayType(CREW_MEMBER))])),
])


def number(text: Column, kind: str) -> Column:
    """A number read as text as ``kind``; NULL where it does not fit."""
    if kind == "double":
        return text.try_cast("double")
    return F.coalesce(text.try_cast("decimal(38,6)"), text.try_cast("double").try_cast("decimal(38,6)")).try_cast(kind)


def parse_payload(c, schema: StructType = DETAILS_SCHEMA) -> Column:
    """JSON text -> struct; absent keys -> NULL, extra keys ignored.

    A malformed document keeps its raw text in ``_corrupt_record``
    (PERMISSIVE mode), because a permissive parse of bad text is a struct of
    NULLs rather than NULL and would otherwise be indistinguishable.
    """
    with_corrupt = StructType(list(schema.fields) + [StructField(CORRUPT_COLUMN, StringType())])
    c = F.col(c) if isinstance(c, str) else c
    return F.from_json(c, with_corrupt,
                       {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN})


def is_corrupt(parsed: Column, raw: Column) -> Column:
    """True when the text could not be parsed (or is missing)."""
    return raw.isNull() | parsed[CORRUPT_COLUMN].isNotNull()


def first_match(arr: Column, predicate) -> Column:
    """First element satisfying ``predicate`` or NULL (never raises)."""
    return F.try_element_at(F.filter(arr, predicate), F.lit(1))


def first_director(crew: Column) -> Column:
    """The first crew member whose job is 'Director' (struct or NULL)."""
    return first_match(crew, lambda m: m["job"] == F.lit("Director"))


def genre_names(genres: Column) -> Column:
    """``genres[].name`` as array<string> (empty when absent)."""
    return F.coalesce(F.transform(genres, lambda g: g["name"]), F.array().cast("array<string>"))


def project_details(parsed: Column) -> dict[str, Column]:
    """The catalogue fields the Silver film table keeps."""
    director = first_director(parsed["credits"]["crew"])
    return {
        "tmdb_title": parsed["title"],
        "tmdb_original_title": parsed["original_title"],
        "release_date": parsed["release_date"],
        "genres": genre_names(parsed["genres"]),
        "runtime_minutes": number(parsed["runtime"], "int"),
        "budget_usd": zero_to_null(number(parsed["budget"], "bigint")),
        "revenue_usd": zero_to_null(number(parsed["revenue"], "bigint")),
        "vote_average": number(parsed["vote_average"], "double"),
        "vote_count": number(parsed["vote_count"], "bigint"),
        "overview": parsed["overview"],
        "original_language": parsed["original_language"],
        "poster_path": parsed["poster_path"],
        "director_name": director["name"],
        "director_tmdb_id": number(director["id"], "int"),
    }
