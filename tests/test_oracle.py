"""Every registered query against its DuckDB oracle on the smoke data."""

import duckdb

import __spark_entry__ as E
from stratum.plans.queries import REGISTRY
from tools.check_oracle import TABLES, key, norm

from .conftest import SF_SMOKE


def test_all_queries_match_their_oracle(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMOKE}/{t}.parquet')")
    sqls = E.oracle_sql()
    bad = []
    for name in REGISTRY:
        fn = E.queries()[name]
        df = fn(spark, SF_SMOKE)
        cols = sorted(df.columns)
        got = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=key)
        cur = con.execute(sqls[name])
        names = [d[0] for d in cur.description]
        if sorted(names) != cols:
            bad.append((name, "columns", names, df.columns))
            continue
        idx = {c: i for i, c in enumerate(names)}
        want = sorted((tuple(norm(r[idx[c]]) for c in cols) for r in cur.fetchall()), key=key)
        if got != want:
            bad.append((name, "values", len(got), len(want)))
    assert not bad, bad
