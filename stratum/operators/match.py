"""Film catalogue: union, incremental selection and matching.

The studied pipeline collects the film list to the driver and calls a search
service per film. Here the catalogue is a table and the search becomes a
distributed equi join on the normalised title (a title without any letter
that normalising keeps is compared as it stands, in lower case):

* tier 1 — same title and same year: the best-ranked entry of that
  (title, year);
* tier 2 — the film has a year: among the title's top ``top_n`` entries, the
  best-ranked one within ``year_tolerance`` years;
* tier 3 — the film has no year: the title's best entry;
* otherwise no match.

The catalogue is pre-reduced before it meets the films — one row per
(title, year), and one row per title with its ``top_n`` entries as an array —
so two left joins find a film's candidates and no film fans out, however
popular its title is. Ranking uses ``row_number() <= n`` windows, which Spark
turns into a partial (map-side) group limit ahead of the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import normalize_title, year_prefix
from ..functions.json import DETAILS_SCHEMA, is_corrupt, parse_payload, project_details

# The search heuristics' limits.
YEAR_TOLERANCE = 2
TOP_N = 3
TIER_EXACT, TIER_NEAR, TIER_TITLE = "EXACT_YEAR", "NEAR_YEAR", "TITLE_ONLY"


def union_catalog(sources: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL of (uri, title, year) projections, one row per uri.

    Earlier sources win (diary > ratings > watched); inside one source the
    latest ``sort_date`` wins, then the greatest ``sort_key`` (optional; of one
    type in all sources), title and year. Rows whose survivor has no title are
    dropped afterwards, as in the studied pipeline.

    One reduction by uri, combined map-side. Sources need not be deduplicated
    when ``sort_key`` holds the order that their deduplication follows.
    """
    keyed = any("sort_key" in s.columns for s in sources)
    parts = [s.select("letterboxd_uri", F.struct(
        F.lit(-i).alias("priority"), F.col("sort_date"), *["sort_key"] * keyed, "movie_title", "movie_year").alias("best"))
        for i, s in enumerate(sources)]
    best = reduce(lambda a, b: a.unionByName(b), parts).groupBy("letterboxd_uri").agg(F.max("best").alias("best"))
    return (best.select("letterboxd_uri", "best.movie_title", "best.movie_year")
            .filter(F.col("movie_title").isNotNull()))


def to_enrich(films: DataFrame, silver_movies: DataFrame | None,
              full_refresh: bool = False) -> DataFrame:
    """Films not yet enriched with status SUCCESS (others retried)."""
    if full_refresh or silver_movies is None:
        return films
    done = silver_movies.filter(F.col("enrichment_status") == "SUCCESS").select("letterboxd_uri")
    return films.join(done, "letterboxd_uri", "left_anti")


def title_key(title) -> Column:
    """What titles are joined on; NULL for a missing or blank title. The
    prefixes keep raw titles apart from normalised ones."""
    raw = F.col(title) if isinstance(title, str) else title
    norm, text = normalize_title(title), F.lower(F.trim(raw))
    return (F.when(F.trim(norm) != "", F.concat(F.lit("n:"), norm))
            .when(text != "", F.concat(F.lit("r:"), text)))


def _ranked_catalogue(catalogue: DataFrame, rank_by: Sequence) -> DataFrame:
    return catalogue.select(
        "tmdb_id",
        title_key("title").alias("title_key"),
        year_prefix("release_date").alias("cat_year"),
        *[F.col(c) if isinstance(c, str) else c for c in rank_by],
    ).filter(F.col("title_key").isNotNull())


def match_catalogue(films: DataFrame, catalogue: DataFrame,
                    rank_by: Sequence | None = None,
                    year_tolerance: int = YEAR_TOLERANCE, top_n: int = TOP_N) -> DataFrame:
    """films(letterboxd_uri, movie_title, movie_year) x catalogue(tmdb_id,
    title, release_date, rank columns) -> films + tmdb_id, match_tier.

    ``rank_by`` orders a title's entries (default: popularity desc, id asc).
    """
    if rank_by is None:
        rank_by = (F.col("popularity").desc(), F.col("tmdb_id").asc())
    rank_cols = [c for c in catalogue.columns if c not in ("tmdb_id", "title", "release_date")]
    cat = _ranked_catalogue(catalogue, rank_cols)
    by_title = Window.partitionBy("title_key").orderBy(*rank_by)
    by_title_year = Window.partitionBy("title_key", "cat_year").orderBy(*rank_by)

    top = (cat.withColumn("rank", F.row_number().over(by_title)).filter(F.col("rank") <= top_n)
           .groupBy("title_key").agg(F.sort_array(F.collect_list(F.struct("rank", "tmdb_id", "cat_year"))).alias("top")))
    exact = (cat.filter(F.col("cat_year").isNotNull())
             .withColumn("r", F.row_number().over(by_title_year))
             .filter(F.col("r") == 1)
             .select("title_key", F.col("cat_year").alias("exact_year"), F.col("tmdb_id").alias("exact_id")))

    f = films.withColumn("title_key", title_key("movie_title")).alias("f")
    j = (f.join(top.alias("t"), F.col("f.title_key") == F.col("t.title_key"), "left")
         .join(exact.alias("e"), (F.col("f.title_key") == F.col("e.title_key"))
               & (F.col("f.movie_year") == F.col("e.exact_year")), "left"))
    no_year = F.col("f.movie_year").isNull()
    near = F.filter("t.top", lambda c: F.abs(c["cat_year"] - F.col("f.movie_year")) <= year_tolerance)
    near_id = F.try_element_at(F.when(no_year, F.col("t.top")).otherwise(near), F.lit(1))["tmdb_id"]
    return j.select(
        *[F.col(f"f.{c}") for c in films.columns],
        F.coalesce("e.exact_id", near_id).cast("bigint").alias("tmdb_id"),
        F.when(F.col("e.exact_id").isNotNull(), F.lit(TIER_EXACT))
         .when(near_id.isNotNull() & no_year, F.lit(TIER_TITLE))
         .when(near_id.isNotNull(), F.lit(TIER_NEAR)).alias("match_tier"))


def enrichment_status(matched: DataFrame, details: DataFrame,
                      year_tolerance: int = YEAR_TOLERANCE) -> DataFrame:
    """Status per film from the match and the matched entry's payload.

    NOT_FOUND without a match; ERROR when the payload cannot be parsed;
    FUZZY_MATCH when both years are known and differ by more than the
    tolerance; SUCCESS otherwise. An ERROR row carries no ``tmdb_id``. Also
    projects the payload (P26–P28).
    """
    # Join first, then parse: only the payloads of matched entries are read
    # as JSON, not the whole catalogue.
    j = (matched.join(details.select("tmdb_id", "payload"), "tmdb_id", "left")
         .withColumn("p", parse_payload("payload", DETAILS_SCHEMA)))
    detail_year = year_prefix(F.col("p.release_date"))
    found = F.col("tmdb_id").isNotNull()
    corrupt = is_corrupt(F.col("p"), F.col("payload"))
    status = (F.when(~found, F.lit("NOT_FOUND"))
              .when(corrupt, F.lit("ERROR"))
              .when(F.col("movie_year").isNotNull() & detail_year.isNotNull()
                    & (F.abs(detail_year - F.col("movie_year")) > year_tolerance),
                    F.lit("FUZZY_MATCH"))
              .otherwise(F.lit("SUCCESS")))
    good = found & ~corrupt
    fields = {k: F.when(good, v) for k, v in project_details(F.col("p")).items()}
    own = [F.when(~(found & corrupt), F.col(c)).alias(c) if c == "tmdb_id" else F.col(c) for c in matched.columns]
    return j.select(*own, status.alias("enrichment_status"),
                    F.when(found & corrupt, F.lit("unparsable catalogue payload"))
                     .alias("error_msg"),
                    *[v.alias(k) for k, v in fields.items()])
