"""A key holding a third of all rows: results stay whole and exact."""

from pyspark.sql import functions as F

from stratum.operators.clean import dedup_latest
from stratum.plans.reports import per_film

N = 90_000


def skewed(spark):
    # a third of the rows carry film "hot"; the rest spread over 3,000 films
    return spark.range(0, N).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 3000).cast("string"))
         .alias("movie_id"),
        F.date_add(F.lit("2024-01-01"), (F.col("id") % 7).cast("int")).alias("d"),
        F.col("id").alias("event_id"),
        (F.col("id") % 5 + 1).cast("double").alias("my_rating"))


def test_dedup_with_a_hot_key(spark):
    df = skewed(spark)
    out = dedup_latest(df, ["movie_id", "d"], ["event_id"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    got = {(r.movie_id, str(r.d)): r.event_id for r in out.collect()}
    want = {}
    for r in df.collect():
        k = (r.movie_id, str(r.d))
        want[k] = max(want.get(k, -1), r.event_id)
    assert got == want                                   # every key, exact survivor


def test_per_film_counts_with_a_hot_key(spark):
    agg = {r.movie_id: (r.n, r.n_rated) for r in per_film(skewed(spark)).collect()}
    assert agg["hot"] == (N // 3, N // 3)
    assert sum(n for n, _ in agg.values()) == N          # no row dropped or capped
