"""Property tests: library operators against brute force on random inputs."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from stratum.operators.clean import dedup_latest
from stratum.operators.scd import scd2_apply, scd2_current

KEYS = st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))
ROWS = st.lists(st.tuples(KEYS, st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 50)),
                min_size=1, max_size=25)
SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(data=ROWS)
def test_dedup_matches_brute_force(spark, data):
    df = spark.createDataFrame(data, "k string, o int, v int")
    got = sorted((r.k or "", r.o, r.v) for r in dedup_latest(df, ["k"], ["o", "v"]).collect())
    best = {}
    for k, o, v in data:
        rank = (o is not None, o if o is not None else 0, v)
        if k not in best or rank > best[k][0]:
            best[k] = (rank, (k or "", o, v))
    assert got == sorted(x[1] for x in best.values())


SNAP = st.dictionaries(st.sampled_from(["a", "b", "c", "d"]),
                       st.one_of(st.none(), st.integers(0, 2)), max_size=4)


@SETTINGS
@given(runs=st.lists(SNAP, min_size=1, max_size=4))
def test_scd2_invariants(spark, runs):
    history = None
    for i, snap in enumerate(runs):
        df = spark.createDataFrame(sorted(snap.items()), "k string, v int")
        history = scd2_apply(history, df, "k", ["v"], f"2024-01-0{i + 1} 00:00:00")
    rows = history.collect()
    seen = {k for s in runs for k in s}
    cur = {r.k: r.v for r in scd2_current(history).collect()}
    assert set(cur) == seen                        # every key ever seen has exactly one open row
    assert len(cur) == sum(1 for r in rows if r.dbt_valid_to is None)
    for k in seen:                                 # the open row holds the last value seen
        last = [s[k] for s in runs if k in s][-1]
        assert cur[k] == last
    by_key = {}
    for r in rows:
        by_key.setdefault(r.k, []).append((r.dbt_valid_from, r.dbt_valid_to))
    for spans in by_key.values():                  # intervals are disjoint and contiguous
        spans.sort()
        for (f1, t1), (f2, _) in zip(spans, spans[1:]):
            assert t1 is not None and t1 == f2


TARGET = st.dictionaries(st.sampled_from(["a", "b", "c", "d", "e"]),
                         st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 9)), max_size=5)
SOURCE = st.dictionaries(st.sampled_from(["b", "c", "e", "f", "g"]),
                         st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 9)), max_size=5)


@SETTINGS
@given(target=TARGET, source=SOURCE)
def test_merge_matches_brute_force(spark, target, source):
    from stratum.operators.merge import merge_upsert
    schema = "k string, v int, w int"
    t = spark.createDataFrame([(k, v, w) for k, (v, w) in sorted(target.items())], schema)
    s = spark.createDataFrame([(k, v, w) for k, (v, w) in sorted(source.items())], schema)
    out = merge_upsert(t, s, ["k"], {"v": "s.v"}, "s.v IS NOT NULL AND s.v != t.v")
    got = sorted((r.k, r.v, r.w) for r in out.collect())
    want = dict(target)
    for k, (v, w) in source.items():
        if k not in want:
            want[k] = (v, w)                               # insert all columns
        elif v is not None and want[k][0] is not None and v != want[k][0]:
            want[k] = (v, want[k][1])                      # update v only
    assert got == sorted((k, v, w) for k, (v, w) in want.items())


TITLES = st.sampled_from(["alpha", "beta"])
CATALOGUE = st.lists(st.tuples(TITLES, st.one_of(st.none(), st.integers(1995, 2005)),
                               st.integers(0, 5)), min_size=0, max_size=12)
FILMS = st.lists(st.tuples(st.sampled_from(["alpha", "beta", "gamma"]),
                           st.one_of(st.none(), st.integers(1995, 2005))), min_size=1, max_size=6)


def brute_force_match(films, catalogue):
    """The search rules, film by film, straight from their definition."""
    entries = [(i, t, y, p) for i, (t, y, p) in enumerate(catalogue)]
    out = {}
    for n, (title, year) in enumerate(films):
        hits = sorted((e for e in entries if e[1] == title), key=lambda e: (-e[3], e[0]))
        same_year = [e for e in hits if year is not None and e[2] == year]
        if same_year:
            out[n] = (same_year[0][0], "EXACT_YEAR")
        elif year is None:
            out[n] = (hits[0][0], "TITLE_ONLY") if hits else (None, None)
        else:
            near = [e for e in hits[:3] if e[2] is not None and abs(e[2] - year) <= 2]
            out[n] = (near[0][0], "NEAR_YEAR") if near else (None, None)
    return out


@SETTINGS
@given(films=FILMS, catalogue=CATALOGUE)
def test_catalogue_match_matches_brute_force(spark, films, catalogue):
    from stratum.operators.match import match_catalogue
    cat = spark.createDataFrame(
        [(i, t, None if y is None else f"{y}-06-01", float(p)) for i, (t, y, p) in enumerate(catalogue)],
        "tmdb_id long, title string, release_date string, popularity double")
    f = spark.createDataFrame([(str(n), t, y) for n, (t, y) in enumerate(films)],
                              "letterboxd_uri string, movie_title string, movie_year int")
    got = {int(r.letterboxd_uri): (r.tmdb_id, r.match_tier) for r in match_catalogue(f, cat).collect()}
    assert got == brute_force_match(films, catalogue)


VALUES = st.lists(st.tuples(st.one_of(st.none(), st.integers(-2, 7)),
                            st.one_of(st.none(), st.sampled_from(["x1", "y", "x22", ""]))),
                  min_size=0, max_size=20)


@SETTINGS
@given(data=VALUES, ignore_null=st.booleans())
def test_quality_rules_match_brute_force(spark, data, ignore_null):
    from stratum.operators.quality import evaluate
    df = spark.createDataFrame(data, "n int, s string")
    rules = [
        {"kind": "not_null", "column": "n", "name": "nn"},
        {"kind": "range", "column": "n", "min": 0, "max": 5, "ignore_null": ignore_null, "name": "rg"},
        {"kind": "regex", "column": "s", "regex": "^x[0-9]+$", "ignore_null": ignore_null, "name": "re"},
        {"kind": "row_condition", "column": "n", "expression": "n % 2 = 0", "name": "rc"},
        {"kind": "accepted_values", "column": "s", "values": ["y", ""], "name": "av"},
        {"kind": "range", "column": "n", "min": 1, "max": 3, "where": "s IS NOT NULL", "name": "wh"},
        {"kind": "unique", "column": "s", "name": "uq"},
    ]
    got = {r.rule: (r.total, r.failed) for r in evaluate(df, "t", rules).collect()}
    import re as _re
    counts = {}
    for _, s in data:
        if s is not None:
            counts[s] = counts.get(s, 0) + 1
    want = {
        "nn": (len(data), sum(n is None for n, _ in data)),
        "rg": (len(data), sum((not ignore_null) if n is None else not (0 <= n <= 5) for n, _ in data)),
        "re": (len(data), sum((not ignore_null) if s is None else not _re.match(r"^x[0-9]+$", s)
                              for _, s in data)),
        "rc": (len(data), sum(n is None or n % 2 != 0 for n, _ in data)),
        "av": (len(data), sum(s is not None and s not in ("y", "") for _, s in data)),
        "wh": (sum(s is not None for _, s in data),
               sum(s is not None and (n is None or not (1 <= n <= 3)) for n, s in data)),
        "uq": (len(data), sum(c for c in counts.values() if c > 1)),
    }
    assert got == want


KEYED = st.dictionaries(st.tuples(st.sampled_from(["a", "b", "c", "d"]),
                                  st.one_of(st.none(), st.sampled_from(["m1", "m2", "m3"]))),
                        st.integers(0, 9), max_size=6)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=KEYED, source=KEYED)
def test_partition_scoped_merge_equals_whole_table_merge(spark, target, source):
    import tempfile

    from stratum.operators.merge import merge_upsert
    from stratum.sources.tables import upsert_partitions
    schema = "k string, m string, v int"
    t = spark.createDataFrame([(k, m, v) for (k, m), v in sorted(target.items(), key=str)], schema)
    s = spark.createDataFrame([(k, m, v) for (k, m), v in sorted(source.items(), key=str)], schema)
    whole = merge_upsert(t, s, ["k", "m"], {"v": "s.v"}, "s.v > t.v", null_safe_keys=True)
    path = tempfile.mkdtemp(prefix="stratum-prop-") + "/t"
    upsert_partitions(spark, path, t, ["k", "m"], ["m"], {"v": "s.v"}, "s.v > t.v", null_safe_keys=True)
    scoped = upsert_partitions(spark, path, s, ["k", "m"], ["m"], {"v": "s.v"}, "s.v > t.v",
                               null_safe_keys=True)

    def norm(df):
        return sorted((r.k, r.m or "", r.v) for r in df.select("k", "m", "v").collect())
    assert norm(scoped) == norm(whole)


SOURCE_ROWS = st.lists(st.tuples(st.sampled_from(["u1", "u2", "u3"]),
                                 st.one_of(st.none(), st.sampled_from(["A", "B"])),
                                 st.integers(1990, 1992), st.integers(1, 4)), max_size=6)


@SETTINGS
@given(d=SOURCE_ROWS, r=SOURCE_ROWS, w=SOURCE_ROWS)
def test_union_catalog_matches_brute_force(spark, d, r, w):
    from stratum.operators.match import union_catalog
    schema = "letterboxd_uri string, movie_title string, movie_year int, sort_date int"
    got = sorted(tuple(x) for x in union_catalog(
        [spark.createDataFrame(rows, schema) for rows in (d, r, w)]).collect())
    best = {}
    for prio, rows in enumerate((d, r, w)):
        for uri, title, year, day in rows:
            rank = (-prio, day, title is not None, title or "", year)
            if uri not in best or rank > best[uri][0]:
                best[uri] = (rank, (uri, title, year))
    want = sorted(v[1] for v in best.values() if v[1][1] is not None)
    assert got == want


FACTS = st.dictionaries(st.sampled_from(["k1", "k2", "k3", "k4"]),
                        st.tuples(st.integers(0, 9), st.integers(1, 5)), max_size=4)


@SETTINGS
@given(old=FACTS, new=FACTS)
def test_incremental_merge_matches_brute_force(spark, old, new):
    from stratum.operators.merge import incremental_merge
    schema = "id string, v int, stamp int, created string"
    o = spark.createDataFrame([(k, v, s, "old") for k, (v, s) in sorted(old.items())], schema)
    n = spark.createDataFrame([(k, v, s, "new") for k, (v, s) in sorted(new.items())], schema)
    got = sorted(tuple(x) for x in incremental_merge(o, n, "id", stamp_col="stamp",
                                                     keep_first=["created"]).collect())
    mark = max((s for _, s in old.values()), default=None)
    want = {k: (k, v, s, "old") for k, (v, s) in old.items()}
    for k, (v, s) in new.items():
        if mark is None or s > mark:
            want[k] = (k, v, s, "old" if k in old else "new")
    assert got == sorted(want.values())
