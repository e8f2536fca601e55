import hashlib
import random

import numpy as np
import pytest

from stratum.llm import repeats as R
from stratum.llm.repeats import RunLengthIndex, removal_digests, remove_spans

from ..conftest import rows


def brute(docs, length=50):
    first = {}
    for d, t in docs:
        b = (t or "").encode()
        for i in range(len(b) - length + 1):
            if d is not None:
                first[b[i:i + length]] = min(d, first.get(b[i:i + length], d))
    out = []
    for d, t in docs:
        b = (t or "").encode()
        covered = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if d is not None and first[b[i:i + length]] < d:
                covered[i:i + length] = b"\1" * length
        kept = bytes(x for x, c in zip(b, covered) if not c)
        spans = sum(c and not (i and covered[i - 1]) for i, c in enumerate(covered))
        out.append((d, len(b), sum(covered), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def corpus():
    rnd = random.Random(1)
    base = ["".join(rnd.choice("ab ") for _ in range(300)) for _ in range(3)] + ["é漢" * 100]
    docs = []
    for i in range(150):
        t = ""
        for _ in range(rnd.randrange(6)):
            b, p = rnd.choice(base), rnd.randrange(250)
            t += b[p:p + rnd.randrange(20, 140)]
            if rnd.random() < .4:
                t += "".join(rnd.choice("xyzé") for _ in range(rnd.randrange(60)))
            if rnd.random() < .1:
                t += "a" * rnd.randrange(120)
        docs.append((i * 7 % 151, t))
    docs += [(500, docs[3][1]), (501, "x" * 49), (502, None), (503, ""), (None, docs[3][1]), (500, docs[3][1]),
             (500, docs[4][1]), (-5, docs[9][1]), (504, base[0] * 40)]
    return docs


@pytest.mark.parametrize("options", [{}, {"hot_contexts": 1, "shard_bytes": 2000}])
def test_matches_brute_force(spark, options):
    docs = corpus()
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as place", "2 as spans").repartition(4)
    assert rows(removal_digests(frame, **options)) == brute(docs)


def test_a_passage_in_all_documents_does_not_gather(spark, monkeypatch):
    """Every document has the passage between its own words: as many contexts at its edges as documents."""
    passage = " ".join(f"passage{i}" for i in range(20))
    docs = [(i, f"{random.Random(i).random()} {passage} {random.Random(-i).random()}" * (1 + i % 2)) for i in range(1, 600)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    dealt = R._places(frame, R.LENGTH, R.K).groupBy("anchor", "salt").count().agg({"count": "max"}).first()[0]
    assert dealt < 20  # rows of one anchor that meet in a task
    largest = []
    kept = R.keep_on_shared_storage

    def keep(df, label):
        out = kept(df, label)
        if label == "contexts":  # rows of one string that a shard's search holds
            largest.append(out.filter("shard >= 0").groupBy("shard", "bytes").count().agg({"count": "max"}).first()[0] or 0)
        return out

    monkeypatch.setattr(R, "keep_on_shared_storage", keep)
    got = {r.doc_id: r.n_removed for r in R.removal_digests(frame, hot_contexts=100).collect()}
    want = {i: removed for i, _, removed, *_ in brute(docs)}
    assert got == want and largest and largest[0] < 20


def test_texts_longer_than_a_buffer(spark, monkeypatch):
    rnd = random.Random(4)
    passage = "".join(rnd.choice("abcdefgh ") for _ in range(400))
    long_text = "".join(rnd.choice("abcdefgh ") for _ in range(1_048_500)) + passage + "tail" * 10
    docs = [(1, passage), (2, long_text)]
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in
           removal_digests(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {1: (0, 0), 2: (400, 1)}


def test_index_finds_the_smallest_id():
    rnd = random.Random(3)
    base = "".join(rnd.choice("ab") for _ in range(400)).encode()
    strings = list(dict.fromkeys(base[p:p + 50 + rnd.randrange(35)] for p in (rnd.randrange(300) for _ in range(60))))
    ids = np.arange(len(strings)) * 3
    index = RunLengthIndex(strings, ids, 50)
    found, at = index.smallest_ids(strings, 50), 0
    for s in strings:
        for j in range(len(s) - 49):
            assert found[at + j] == min(i for i, x in zip(ids, strings) if s[j:j + 50] in x)
        at += len(s)
    assert index.runs < index.rows


def test_spans_merge():
    assert remove_spans(b"abcdefgh", [(4, 6), (0, 2), (1, 3), (6, 7)]) == (b"dh", [(0, 3), (4, 7)])


def test_empty_table(spark):
    assert removal_digests(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_texts_are_hashed_in_small_blocks_and_dealt_once(spark, monkeypatch):
    rnd = random.Random(4)
    texts = ["".join(rnd.choice("abcd é") for _ in range(rnd.randrange(50, 9000))).encode() for _ in range(60)]
    whole, seen = R.contexts, []

    def hashed(data, *more):
        seen.append(len(data))
        return whole(data, *more)

    sizes = np.array([len(t) for t in texts])
    begin, *want = whole(np.frombuffer(b"".join(texts), np.uint8), np.repeat(np.arange(60), sizes), 50, 16)
    monkeypatch.setattr(R, "contexts", hashed)
    who, start, *got = R._contexts_of(texts, 50, 16)
    assert ((np.cumsum(sizes) - sizes)[who] + start).tolist() == begin.tolist()
    assert [g.tolist() for g in got] == [w.tolist() for w in want]
    assert sum(seen) == sum(sizes) and max(seen) <= R.HASHED + max(sizes)
    frame = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    plan = R._shared_places(frame, 50, 16)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count(" ASC NULLS FIRST") == 1  # sorted by one number
