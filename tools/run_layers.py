"""Run entry points A/B/C (landing -> Bronze -> Silver -> Gold) on a driver
data directory, twice, and print row counts and timings per step.

The driver tables are rendered as the three CSV exports (titles and years
taken from `part`, so the catalogue has something to match) into a fresh
folder under the session's shared directory.

usage: python tools/run_layers.py [--min-match-rate R] [sf_dir]

The match-rate floor defaults to the studied pipeline's 0.70; a run below it
stops with the assertion's message (exit code 1).
"""

from __future__ import annotations

import sys
import time

sys.path.insert(0, ".")
from pyspark.sql import functions as F  # noqa: E402

from stratum.operators.quality import AssertionFailed  # noqa: E402
from stratum.plans import adapters as A, medallion  # noqa: E402
from stratum.session import build_session, scratch_path  # noqa: E402

RUNS = ["2024-02-01 00:00:00", "2024-02-02 00:00:00"]


def main():
    args = sys.argv[1:]
    floor = 0.70
    if args[:1] == ["--min-match-rate"]:
        floor, args = float(args[1]), args[2:]
    sf = args[0] if args else "/root/testdata/sf0.1"
    spark = build_session(shuffle_partitions=16)
    base = scratch_path(spark, "layers")
    land, root = f"{base}/landing", f"{base}/lake"
    part = A.table(spark, sf, "part")
    names = part.select(F.col("p_partkey").cast("string").alias("k"), F.col("p_name").alias("pn"),
                        (F.lit(1950) + F.col("p_size")).cast("string").alias("py"))

    def titled(df):
        k = F.regexp_extract(F.col("Letterboxd URI"), r"(\d+)$", 1)
        return (df.withColumn("k", k).join(names, "k", "left")
                .withColumn("Name", F.coalesce("pn", F.col("Name")))
                .withColumn("Year", F.coalesce("py", F.col("Year"))).drop("k", "pn", "py"))

    titled(A.raw_diary(A.table(spark, sf, "events")).drop("event_id")) \
        .write.option("header", True).csv(f"{land}/diary.csv")
    titled(A.raw_ratings(A.table(spark, sf, "lineitem")).drop("l_orderkey", "l_linenumber")) \
        .write.option("header", True).csv(f"{land}/ratings.csv")
    A.raw_watched(part).write.option("header", True).csv(f"{land}/watched.csv")
    catalogue = A.match_catalogue(part)
    details = A.catalogue_details(part).withColumn("tmdb_id", F.col("tmdb_id").cast("bigint"))
    for ts in RUNS:
        t = time.perf_counter()
        summary = medallion.land(spark, land, root, "2024-01-31")
        print("land  ", [tuple(r) for r in summary.collect()], f"{time.perf_counter() - t:.1f}s")
        t = time.perf_counter()
        try:
            silver = medallion.build_silver(spark, root, catalogue, details, ts, min_match_rate=floor)
        except AssertionFailed as exc:
            print("silver stopped:", exc)
            sys.exit(1)
        print("silver", {k: v.count() for k, v in silver.items()}, f"{time.perf_counter() - t:.1f}s")
        t = time.perf_counter()
        recon = medallion.export_silver(spark, root, f"{base}/warehouse")
        print("export", [tuple(r) for r in recon.collect()], f"{time.perf_counter() - t:.1f}s")
        t = time.perf_counter()
        gold = medallion.build_gold(spark, root, ts)
        print("gold  ", {k: v.count() for k, v in gold.items()}, f"{time.perf_counter() - t:.1f}s")


if __name__ == "__main__":
    main()
