"""Quality contracts of the Gold layer.

The expectation rules below are fixed values: they must equal the studied
project's rule files for the same verdicts, so they are stated as the YAML
text those files hold.
"""

from __future__ import annotations

from ..functions.columns import ENRICHMENT_STATUSES
from ..sources.rules import expectation_rules

# Expectation rules per Gold table.
DIM_MOVIE_RULES = r"""
rules:
  - column: "movie_id"
    dimension: "UNIQUENESS"
    threshold: 1.0
    uniquenessExpectation: {}

  - column: "release_year"
    ignoreNull: true
    dimension: "VALIDITY"
    threshold: 1.0
    rangeExpectation:
      minValue: "1888"
      maxValue: "2030"

  - column: "runtime_minutes"
    dimension: "CONSISTENCY"
    threshold: 1.0
    rowConditionExpectation:
      sqlExpression: "runtime_minutes >= 0"
"""

FACT_DIARY_ENTRIES_RULES = r"""
rules:
  - column: "letterboxd_uri"
    dimension: "COMPLETENESS"
    threshold: 1.0
    nonNullExpectation: {}

  - column: "watched_date"
    dimension: "VALIDITY"
    threshold: 1.0
    rowConditionExpectation:
      sqlExpression: "watched_date <= CURRENT_DATE()"

  - column: "letterboxd_uri"
    dimension: "CONFORMANCE"
    threshold: 1.0
    regexExpectation:
      regex: "^https://boxd\\.it/[a-zA-Z0-9]+$"
"""

FACT_RATINGS_RULES = r"""
rules:
  - column: "my_rating"
    ignoreNull: false
    dimension: "VALIDITY"
    threshold: 1.0
    rangeExpectation:
      minValue: "0.5"
      maxValue: "5.0"
"""

# The accepted enrichment statuses of the model tests (the fixed list).
ACCEPTED_STATUSES = list(ENRICHMENT_STATUSES)


def rating_bounds() -> dict:
    """The rating rule's bounds, as ``min`` and ``max``."""
    rule, = expectation_rules(FACT_RATINGS_RULES)
    return {"min": rule["min"], "max": rule["max"]}


def uri_regex() -> str:
    return next(r["regex"] for r in expectation_rules(FACT_DIARY_ENTRIES_RULES) if r["kind"] == "regex")


# The tests of the Silver tables that staging reads.
SOURCE_TESTS = """
sources:
  - name: silver_staging
    tables:
      - name: src_silver_movies
        columns:
          - {name: letterboxd_uri, tests: [not_null, unique]}
          - name: enrichment_status
            tests: [not_null, accepted_values: {values: [SUCCESS, FUZZY_MATCH, NOT_FOUND, ERROR]}]
      - name: src_silver_diary_entries
        columns:
          - {name: letterboxd_uri, tests: [not_null]}
          - {name: watched_date, tests: [not_null]}
      - name: src_silver_ratings
        columns:
          - {name: letterboxd_uri, tests: [not_null]}
          - {name: my_rating, tests: [not_null]}
"""

# The model tests of the staging views and Gold tables.
MODEL_TESTS = """
models:
  - name: stg_silver_movies
    columns:
      - {name: letterboxd_uri, tests: [not_null, unique]}
      - name: enrichment_status
        tests: [not_null, accepted_values: {values: [SUCCESS, FUZZY_MATCH, NOT_FOUND, ERROR]}]
      - {name: title, tests: [not_null]}
  - name: stg_silver_diary_entries
    columns:
      - {name: letterboxd_uri, tests: [not_null]}
      - {name: watched_date, tests: [not_null]}
  - name: stg_silver_ratings
    columns:
      - {name: letterboxd_uri, tests: [not_null]}
      - {name: my_rating, tests: [not_null]}
  - name: dim_date
    columns:
      - {name: date_id, tests: [not_null, unique]}
      - {name: full_date, tests: [not_null, unique]}
      - {name: year, tests: [not_null]}
  - name: dim_director
    columns:
      - {name: director_id, tests: [not_null, unique]}
      - {name: director_tmdb_id, tests: [not_null, unique]}
      - {name: director_name, tests: [not_null]}
  - name: dim_genre
    columns:
      - {name: genre_id, tests: [not_null, unique]}
      - {name: genre_name, tests: [not_null, unique]}
  - name: dim_movie
    columns:
      - {name: movie_id, tests: [not_null, unique]}
      - {name: letterboxd_uri, tests: [not_null, unique]}
      - {name: title, tests: [not_null]}
      - name: director_id
        tests: [relationships: {to: ref('dim_director'), field: director_id, where: director_id IS NOT NULL}]
  - name: bridge_movie_genre
    columns:
      - {name: bridge_id, tests: [not_null, unique]}
      - {name: movie_id, tests: [not_null, relationships: {to: ref('dim_movie'), field: movie_id}]}
      - {name: genre_id, tests: [not_null, relationships: {to: ref('dim_genre'), field: genre_id}]}
  - name: fact_diary_entries
    columns:
      - {name: diary_entry_id, tests: [not_null, unique]}
      - name: movie_id
        tests: [relationships: {to: ref('dim_movie'), field: movie_id, where: movie_id IS NOT NULL}]
      - {name: watched_date_id, tests: [not_null, relationships: {to: ref('dim_date'), field: date_id}]}
      - name: my_rating
        tests:
          - dbt_utils.accepted_range: {min_value: 0.5, max_value: 5.0, inclusive: true, where: my_rating IS NOT NULL}
  - name: fact_ratings
    columns:
      - {name: rating_id, tests: [not_null, unique]}
      - name: movie_id
        tests: [relationships: {to: ref('dim_movie'), field: movie_id, where: movie_id IS NOT NULL}]
      - {name: rating_date_id, tests: [not_null, relationships: {to: ref('dim_date'), field: date_id}]}
      - name: my_rating
        tests: [not_null, dbt_utils.accepted_range: {min_value: 0.5, max_value: 5.0, inclusive: true}]
"""
