import random

import duckdb
import pytest

from stratum.llm import queries, url_filter
from stratum.llm.url_filter import DigestArray, judge_urls, split_url

from ..conftest import SF_SMALL, rows

RULES = queries.URL_RULES


def brute(url, rules, default="allow"):
    host, path = split_url(url)
    fits = [(len(h) + len(p), len(h), v == "block", h + p, v) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[4] if best else default


@pytest.mark.parametrize("url, want", [
    (None, ("", "")), ("", ("", "")), ("no scheme/x", ("", "")), ("http://A.b?x/y", ("a.b", "")),
    ("x://h://i/j#k", ("h:", "//i/j")), ("HTTP://ÀB.net/En/?q", ("Àb.net", "/En/")), ("://", ("", ""))])
def test_split(url, want):
    assert split_url(url) == want


def random_urls():
    rnd = random.Random(5)
    urls = [None, "", "net/", "http://net", "http://net/", "http://xnet/", "http://a.example.net/en/x",
            "http://example.com/de", "https://" + "a." * 3000 + "net/" + "x" * 5000]
    for _ in range(500):
        host = ".".join(rnd.choice(["a", "example", "net", "com", "org", ""]) for _ in range(rnd.randint(1, 4)))
        urls.append(f"http://{host}{rnd.choice(['', '/', '/en/', '/de/x', '/fr/', '/f', '?/en/', '#'])}{rnd.choice(['', 'q', '?z'])}")
    return urls


@pytest.mark.parametrize("limit", [1 << 20, 0])  # broadcast array, and the join
def test_judging_matches_brute_force(spark, limit):
    rules = [*RULES, ("", "/q", "block"), ("com", "", "block"), ("example.com", "", "allow")]
    urls = random_urls()
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)],
                                  "page_id long, url string, host string, verdict string")
    got = judge_urls(pages, spark.createDataFrame(rules, "host string, path string, verdict string"),
                     max_list_bytes=limit)
    assert rows(got) == sorted(((i, *brute(u, rules)) for i, u in enumerate(urls)),
                               key=lambda t: tuple((x is None, str(x)) for x in t))


def test_a_long_list_has_any_number_of_path_lengths_and_only_known_verdicts(spark):
    rules = [("a.com", "/" + "x" * i, "block") for i in range(4500)] + [("b.com", "/y", "allow")]
    urls = ["http://a.com/" + "x" * 4400 + "z", "http://w.b.com/y", "http://c.com/x"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    frame = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = judge_urls(pages, frame, max_list_bytes=0).select("page_id", "rule", "verdict")
    assert rows(got) == [(0, "a.com/" + "x" * 4400, "block"), (1, "b.com/y", "allow"), (2, None, "allow")]
    wrong = spark.createDataFrame([("a.com", "/", "deny")], "host string, path string, verdict string")
    for limit in (0, 1 << 20):
        with pytest.raises(Exception, match="allow or block"):
            judge_urls(pages, wrong, max_list_bytes=limit).collect()


def test_collisions_are_confirmed(monkeypatch):
    monkeypatch.setattr(url_filter, "digest", lambda text: len(text) % 2)
    rules = [(f"h{i}", "/", "block") for i in range(50)]
    array = DigestArray.mapped(DigestArray.pack(rules))
    assert array.probe([("h7", "/"), ("h77", "/"), ("h49", "/"), ("x", "/")]) == ["block", None, "block", None]


def test_empty_list_and_empty_table(spark):
    rules = spark.createDataFrame([], "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://a/b")], "page_id long, url string")
    assert rows(judge_urls(pages, rules)) == [(1, "a", "/b", None, "allow")]
    assert judge_urls(pages.limit(0), rules).count() == 0


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view pages as select * from read_parquet('{SF_SMALL}/pages.parquet')")
    got = queries.op8(spark, SF_SMALL).select("page_id", "host", "path", "rule", "verdict")
    want = con.execute(queries.ORACLE_SQL["op8_url_filter"]).fetchall()
    assert rows(got) == sorted(want, key=lambda t: tuple((x is None, str(x)) for x in t))
