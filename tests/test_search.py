"""Ranked catalogue search against a comparison of all titles."""

import math
import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from stratum.functions.columns import year_prefix
from stratum.operators import search as S

from .conftest import rows


def words(title):
    if title is None:
        return ()
    folded = "".join(c for c in unicodedata.normalize("NFD", title) if not unicodedata.combining(c)).lower()
    return tuple(sorted(set(re.findall(r"[^\W_]+", re.sub("['’]", "", folded)))))


def brute(films, catalogue, k=3, least=S.MIN_SCORE):
    titles = {words(t) for _, t, _, _ in catalogue} - {()}
    weight = lambda df: math.floor(1000 * math.log(1 + len(titles) / df))
    df = {}
    for t in titles:
        for w in t:
            df[w] = df.get(w, 0) + 1
    w_of = lambda w: weight(df.get(w, 1))
    out = []
    for uri, title, _ in films:
        mine, hits = set(words(title)), []
        for tmdb_id, t, _, popularity in catalogue:
            theirs = set(words(t))
            if mine and theirs:
                score = sum(map(w_of, mine & theirs)) * 1000000 // sum(map(w_of, mine | theirs))
                if score >= least:
                    hits.append((-score, -popularity, tmdb_id))
        out += [(uri, i + 1, x, -s) for i, (s, _, x) in enumerate(sorted(hits)[:k])]
    return sorted(out)


def frames(spark, films, catalogue, **options):
    f = spark.createDataFrame(films, "letterboxd_uri string, movie_title string, movie_year int")
    c = spark.createDataFrame(catalogue, "tmdb_id long, title string, release_date string, popularity double")
    return f, S.Index(c, year_prefix("release_date"), **options)


def hits(spark, films, catalogue, **options):
    found = S.search_catalogue(*frames(spark, films, catalogue, **options))
    return sorted((r.letterboxd_uri, r["rank"], r.tmdb_id, r.score) for r in found.collect())


CATALOGUE = [(1, "Spider-Man", "2002-05-01", 9.0), (2, "Amélie", "2001-04-25", 8.0), (3, "The Good, the Bad and the Ugly", "1966", 7.0),
             (4, "Schindler's List", "1993", 6.0), (5, "Spider-Man: No Way Home", "2021", 9.5), (6, "SPIDER MAN", "2019", 1.0),
             (7, None, "2000", 5.0), (8, "…", "2000", 5.0), (9, "The List", "2023", 2.0), (10, "七人の侍", "1954", 3.0)]
FILMS = [("a", "Spider Man", 2002), ("b", "Amelie", None), ("c", "Ugly, Bad and Good: The the", 1966), ("d", "schindlers list!", 1993),
         ("e", "七人の侍", 1954), ("f", None, 2000), ("g", "!!!", 2000), ("h", "Nothing Like It", 1999), ("i", "Man-Spider", 2020)]


def test_punctuation_accents_and_order(spark):
    got = hits(spark, FILMS, CATALOGUE)
    assert got == brute(FILMS, CATALOGUE)
    best = {r[0]: r[2] for r in got if r[1] == 1}
    assert best == {"a": 1, "b": 2, "c": 3, "d": 4, "e": 10, "i": 1}


def test_a_written_index_finds_the_same(spark, tmp_dir):
    films, index = frames(spark, FILMS, CATALOGUE)
    found = S.search_catalogue(films, index.written(f"{tmp_dir}/index")).collect()
    assert sorted((r.letterboxd_uri, r["rank"], r.tmdb_id, r.score) for r in found) == brute(FILMS, CATALOGUE)


def test_tiers(spark):
    got = {r.letterboxd_uri: (r.tmdb_id, r.match_tier) for r in S.match_ranked(*frames(spark, FILMS, CATALOGUE)).collect()}
    assert got["a"] == (1, S.TIER_EXACT) and got["b"] == (2, S.TIER_TITLE) and got["i"] == (6, S.TIER_NEAR)
    assert got["f"] == got["g"] == got["h"] == (None, None) and len(got) == len(FILMS)


@pytest.mark.parametrize("least", [300_000, 500_000, 900_000])
def test_random_titles_match_brute_force(spark, least):
    rnd = random.Random(least)
    vocabulary = [f"w{i}" for i in range(40)] + ["the"] * 30 + ["of"] * 10
    title = lambda: " ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(1, 6)))
    catalogue = [(i, title(), str(1950 + i % 60), float(i % 5)) for i in range(300)]
    films = [(f"u{i}", title(), 1950 + i % 60) for i in range(200)] + [(f"v{i}", catalogue[i][1], None) for i in range(50)]
    assert hits(spark, films, catalogue, min_score=least) == brute(films, catalogue, least=least)


def test_one_title_with_very_many_entries(spark):
    films = spark.range(500).select(F.concat(F.lit("u"), "id").alias("letterboxd_uri"), F.lit("the hot title").alias("movie_title"),
                                    F.lit(None).cast("int").alias("movie_year"))
    catalogue = spark.range(5000).select(F.col("id").alias("tmdb_id"), F.lit("Hot: the Title").alias("title"),
                                         F.lit("2000").alias("release_date"), F.lit(1.0).alias("popularity"))
    got = S.search_catalogue(films, S.Index(catalogue, year_prefix("release_date")))
    assert got.groupBy("rank", "tmdb_id").count().orderBy("rank").collect() == [(i + 1, i, 500) for i in range(3)]
    none = S.search_catalogue(films, S.Index(catalogue.limit(0), year_prefix("release_date")))
    assert none.count() == 0 and rows(S.match_ranked(films.limit(0), S.Index(catalogue, year_prefix("release_date")))) == []
