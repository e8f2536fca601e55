import random
import time

import duckdb

from stratum.llm import decontaminate, queries
from stratum.llm.common import words_of
from stratum.llm.decontaminate import ItemAutomaton, contamination, digest_of, drop_contaminated

from ..conftest import SF_SMALL, rows


def brute(text, items, window):
    words = words_of(text)
    hit, names = set(), set()
    for name, item in items:
        own = words_of(item)
        size = min(window, len(own))
        for w in {tuple(own[i:i + size]) for i in range(len(own) - size + 1)} if size else ():
            for i in range(len(words) - size + 1):
                if tuple(words[i:i + size]) == w:
                    hit |= set(range(i, i + size))
                    names.add(str(name))
    names.discard("None")
    return len(words), len(hit), len(names), digest_of(names), len(hit) > 0 and 20 * len(hit) >= len(words)


def cases():
    rnd = random.Random(11)
    word = lambda: rnd.choice("abc")
    items = [(i, " ".join(word() for _ in range(rnd.choice([0, 1, 2, 4, 5, 6, 9, 14])))) for i in range(25)]
    items += [(30, items[3][1]), (31, None), (None, "a b c a b c a"), (32, "Zé, zé!")]
    docs = [(i, " ".join(word() for _ in range(rnd.randrange(60)))) for i in range(150)]
    docs += [(900, None), (901, ""), (902, "zé ZÉ zé"), (902, "ZÉ zé"), (None, "a b c a b c"), (903, "x " * 50_000 + "a b c a b c a")]
    return docs, items


def test_matches_brute_force_in_one_block_and_in_many(spark):
    docs, items = cases()
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as n_words", "'x' as key")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = sorted(((d, *brute(t, items, 5)) for d, t in docs), key=lambda t: tuple((x is None, str(x)) for x in t))
    for block in (1 << 20, 60):
        assert rows(contamination(frame, bench, window=5, block_bytes=block)) == want
        kept = drop_contaminated(frame, bench, window=5, block_bytes=block)
        assert kept.columns == frame.columns
        assert sorted(map(str, kept.select("doc_id", "text").collect())) == sorted(
            str(r) for r in frame.select("doc_id", "text").collect() if not brute(r.text, items, 5)[4])


def test_an_item_of_very_many_equal_words():
    start = time.time()
    automaton = ItemAutomaton([(1, [b"x"] * 100_000), (2, [b"x", b"y"] * 50_000)])
    spans, items = automaton.stream([b"x"] * 100_000 + [b"y"] + [b"x"] * 12)
    assert spans == [[0, 100_000]] and items == {1} and time.time() - start < 60


def test_documents_meet_only_blocks_that_share_a_window(spark):
    items = [(i, " ".join(f"w{i}x{j}" for j in range(30))) for i in range(40)]
    docs = [(i, " ".join(f"w{i}x{j}" for j in range(5, 20)) + " tail " * i) for i in range(40)] + [(99, "nothing shared " * 50)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench, blocks = decontaminate._items(spark.createDataFrame(items, "item_id long, text string"), 500)
    keyed = decontaminate._keyed(frame)
    pairs = decontaminate._block_pairs(keyed, bench, 13)
    assert blocks > 10 and pairs.count() == 40  # one block each, not each block for all


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert rows(contamination(docs, none)) == [(1, 2, 0, 0, digest_of([]), False)]
    assert contamination(docs.limit(0), none).count() == 0


def test_query_matches_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    got = queries.op9(spark, SF_SMALL)
    assert rows(got) == sorted(con.execute(queries.ORACLE_SQL["op9_decontaminate"]).fetchall(),
                               key=lambda t: tuple((x is None, str(x)) for x in t))
