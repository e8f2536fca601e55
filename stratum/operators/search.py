"""Ranked catalogue search over an inverted index of title words.

The studied pipeline asks a search service, which returns ranked hits for a
title however its words are punctuated, accented or ordered. Here the
catalogue's titles become sets of folded words. A word weighs the more the
rarer it is among the different titles, and two titles score the weight of
the words they share over the weight of all their words, in millionths
(weights and scores are whole numbers, so ranks do not depend on rounding).

Candidates come from an inverted index that is exact for ``min_score``: with
all words in one order, rarest first, titles that score enough share a word
among the first ones of both, up to where the rest weighs too little to score
alone (prefix filtering). Common words are therefore not looked up where a
rarer one decides, and titles whose weights differ too much are not compared.
Equal word sets are one title in the index: it lists its ``k`` best entries,
and the films of one title are searched once. Every step is a join or a
grouping over all titles; a title keeps its ``k`` best candidates.

Defined cases: a title that is NULL or has no word finds nothing and is not
found; words of a film that the catalogue lacks weigh as much as one that a
single title has; apostrophes are left out, so ``Schindler's`` is
``schindlers``; an empty catalogue or film list gives no rows. Ties go to the
greater popularity, then to the smaller id.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .match import TIER_EXACT, TIER_NEAR, TIER_TITLE, TOP_N, YEAR_TOLERANCE

#: Score in millionths from which a title is a hit, and the factor of weights.
MIN_SCORE, UNIT = 500_000, 1_000
MILLION = 1_000_000
#: Accented Latin letters and what they fold to, by decomposition.
_FOLDED = {chr(c): d[0] for c in range(0xC0, 0x250)
           if (d := unicodedata.normalize("NFD", chr(c))) != chr(c) and d[0].isascii()}


def fold(title) -> Column:
    """Lower case without accents, apostrophes and combining marks."""
    c = F.translate(title, "".join(_FOLDED), "".join(_FOLDED.values()))
    return F.lower(F.regexp_replace(c, r"[\p{M}'’]", ""))


def title_words(title) -> Column:
    """The different words of a title, sorted; NULL if there is none."""
    words = F.array_sort(F.array_distinct(F.split(F.trim(F.regexp_replace(fold(title), r"[^\p{L}\p{N}]+", " ")), " ")))
    return F.when(F.try_element_at(words, F.lit(1)) != "", words)


def _weighed(titles: DataFrame, weights: DataFrame, unseen: Column) -> DataFrame:
    """(title, words, total): each title's words with weights, rarest first."""
    each = titles.select("title", F.explode("words").alias("word")).join(weights, "word", "left") \
        .withColumn("weight", F.coalesce("weight", unseen))
    return each.groupBy("title").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("weight")).alias("light"), "word"))).alias("words"),
        F.sum("weight").alias("total"))


def _first_words(titles: DataFrame, min_score: int) -> DataFrame:
    """One row for each word that has to be looked up: those before which the
    remaining words weigh at least ``min_score`` of the title."""
    before = F.aggregate(F.slice("words", 1, F.col("at")), F.lit(0).cast("bigint"), lambda s, x: s - x["light"])
    return titles.select("*", F.posexplode("words").alias("at", "w")) \
        .filter((F.col("total") - before) * MILLION >= F.col("total") * min_score) \
        .select("title", "words", "total", F.col("w.word").alias("word"))


class Index:
    """A catalogue (tmdb_id, title, release_date, popularity) made ready for search."""

    def __init__(self, catalogue: DataFrame, year: Column, k: int = TOP_N, min_score: int = MIN_SCORE) -> None:
        self.k, self.min_score = k, min_score
        words = title_words("title")
        self.entries = catalogue.select(
            "tmdb_id", "popularity", year.alias("cat_year"), F.array_join(words, " ").alias("title"), words.alias("words")) \
            .filter(F.col("words").isNotNull())
        titles = self.entries.groupBy("title").agg(F.any_value("words").alias("words"))
        n = titles.select(F.count(F.lit(1)).cast("double")).scalar()
        weigh = lambda df: F.floor(F.lit(UNIT) * F.ln(F.lit(1.0) + n / df)).cast("bigint")
        self.weights = titles.select(F.explode("words").alias("word")).groupBy("word") \
            .agg(F.count(F.lit(1)).alias("df")).select("word", weigh(F.col("df")).alias("weight"))
        self.unseen = weigh(F.lit(1))
        self.titles = _weighed(titles, self.weights, self.unseen)

    def written(self, path: str) -> Index:
        """The same index with its three tables written under ``path``, so that
        searches read them instead of building them again."""
        for name in ("entries", "weights", "titles"):
            df: DataFrame = getattr(self, name)
            df.write.mode("errorifexists").parquet(f"{path}/{name}")
            setattr(self, name, df.sparkSession.read.schema(df.schema).parquet(f"{path}/{name}"))
        n = self.titles.select(F.count(F.lit(1)).cast("double")).scalar()
        self.unseen = F.floor(F.lit(UNIT) * F.ln(F.lit(1.0) + n)).cast("bigint")
        return self

    def pairs(self, films: DataFrame) -> DataFrame:
        """(film, title, score): titles of films and titles of the catalogue
        that score at least ``min_score``. ``films`` has ``title`` and ``words``."""
        mine = _weighed(films.groupBy("title").agg(F.any_value("words").alias("words")), self.weights, self.unseen)
        a = _first_words(mine, self.min_score).select(F.col("title").alias("film"), F.col("words").alias("film_words"),
                                                      F.col("total").alias("film_total"), "word")
        b = _first_words(self.titles, self.min_score)
        shared = F.aggregate(F.array_intersect("film_words", "words"), F.lit(0).cast("bigint"), lambda s, x: s - x["light"])
        both = a.join(b, "word").filter(
            F.least("film_total", "total") * MILLION >= F.greatest("film_total", "total") * self.min_score) \
            .withColumn("shared", shared) \
            .withColumn("score", F.expr(f"shared * {MILLION} div (film_total + total - shared)")) \
            .filter(F.col("score") >= self.min_score)
        return both.select("film", "title", "score").distinct()

    def best(self, pairs: DataFrame) -> DataFrame:
        """(film, hits): the ``k`` best entries of each title, first to last."""
        order = [F.col("popularity").desc(), F.col("tmdb_id").asc()]
        ranked = self.entries.withColumn("place", F.row_number().over(Window.partitionBy("title").orderBy(*order))) \
            .filter(F.col("place") <= self.k) \
            .groupBy("title").agg(F.sort_array(F.collect_list(F.struct(
                "place", "popularity", "tmdb_id", "cat_year"))).alias("own"))
        # A title's first entry decides its place among the candidates: more than k titles never matter.
        first = F.col("own")[0]
        among = Window.partitionBy("film").orderBy(F.desc("score"), first["popularity"].desc(), first["tmdb_id"].asc())
        few = pairs.join(ranked, "title").withColumn("place", F.row_number().over(among)).filter(F.col("place") <= self.k)
        hit = few.select("film", "score", F.inline("own"))
        rank = F.row_number().over(Window.partitionBy("film").orderBy(F.desc("score"), *order)).alias("rank")
        return hit.select("film", "score", "tmdb_id", "cat_year", rank).filter(F.col("rank") <= self.k) \
            .groupBy("film").agg(F.sort_array(F.collect_list(F.struct("rank", "tmdb_id", "score", "cat_year"))).alias("hits"))

    def best_of_year(self, pairs: DataFrame, films: DataFrame) -> DataFrame:
        """(film, movie_year, exact_id): the best hit among entries of the film's own year."""
        order = [F.col("popularity").desc(), F.col("tmdb_id").asc()]
        entries = self.entries.filter(F.col("cat_year").isNotNull()) \
            .withColumn("place", F.row_number().over(Window.partitionBy("title", "cat_year").orderBy(*order))) \
            .filter(F.col("place") == 1).select("title", "cat_year", "tmdb_id", "popularity")
        asked = films.filter(F.col("movie_year").isNotNull()).select(F.col("title").alias("film"), "movie_year").distinct()
        found = asked.join(pairs, "film").join(entries.withColumnRenamed("cat_year", "movie_year"), ["title", "movie_year"])
        place = F.row_number().over(Window.partitionBy("film", "movie_year").orderBy(F.desc("score"), *order))
        return found.withColumn("place", place).filter(F.col("place") == 1) \
            .select("film", "movie_year", F.col("tmdb_id").alias("exact_id"))


def _asked(films: DataFrame) -> DataFrame:
    words = title_words("movie_title")
    return films.select("*", F.array_join(words, " ").alias("title"), words.alias("words"))


def search_catalogue(films: DataFrame, index: Index) -> DataFrame:
    """(films' columns, rank, tmdb_id, score): each film's ranked hits."""
    asked = _asked(films)
    hits = index.best(index.pairs(asked.filter(F.col("words").isNotNull())))
    return asked.join(hits.withColumnRenamed("film", "title"), "title") \
        .select(*films.columns, F.inline("hits")).select(*films.columns, "rank", "tmdb_id", "score")


def match_ranked(films: DataFrame, index: Index, year_tolerance: int = YEAR_TOLERANCE) -> DataFrame:
    """Films + tmdb_id, match_tier by the tiers of :func:`match.match_catalogue`,
    over ranked hits instead of equal titles: the best hit of the film's year;
    else the first of its top hits within ``year_tolerance`` years; without a
    year the best hit."""
    asked = _asked(films)
    pairs = index.pairs(asked.filter(F.col("words").isNotNull()))
    hits = index.best(pairs).select(F.col("film").alias("title"), "hits")
    exact = index.best_of_year(pairs, asked).withColumnRenamed("film", "title")
    j = asked.join(hits, "title", "left").join(exact, ["title", "movie_year"], "left")
    no_year = F.col("movie_year").isNull()
    near = F.filter("hits", lambda h: F.abs(h["cat_year"] - F.col("movie_year")) <= year_tolerance)
    near_id = F.try_element_at(F.when(no_year, F.col("hits")).otherwise(near), F.lit(1))["tmdb_id"]
    return j.select(*films.columns, F.coalesce("exact_id", near_id).cast("bigint").alias("tmdb_id"),
                    F.when(F.col("exact_id").isNotNull(), F.lit(TIER_EXACT))
                    .when(near_id.isNotNull() & no_year, F.lit(TIER_TITLE))
                    .when(near_id.isNotNull(), F.lit(TIER_NEAR)).alias("match_tier"))
