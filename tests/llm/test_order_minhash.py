import random

import numpy as np
import pyarrow.parquet as pq
import pytest

from stratum.llm import order_minhash as O

from ..conftest import SF_SMALL, rows


def shingles(text):
    return O.kmers(O.word_hashes(text)[0])


def brute_classes(docs):
    """Class (smallest id) of every document by comparing all pairs that share a k-mer."""
    known = {i: shingles(t) for i, t in docs}
    by_kmer, parent = {}, {i: i for i in known}
    for i, k in known.items():
        for h in k.tolist():
            by_kmer.setdefault(h, []).append(i)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in {(a, b) for own in by_kmer.values() for a in own for b in own if a < b}:
        if O.aligned_similarity(known[a], known[b]) >= O.SIMILARITY:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in known}


def naive_similarity(a, b):
    """Longest common subsequence by the full table."""
    table = np.zeros((len(a) + 1, len(b) + 1), int)
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
    s = table[-1, -1]
    return s / (len(a) + len(b) - s)


def test_alignment_is_exact_from_the_threshold_on():
    rnd = random.Random(6)
    for _ in range(150):
        words = [str(rnd.randrange(30)) for _ in range(rnd.randrange(5, 60))]
        other = list(words)
        for _ in range(rnd.randrange(4)):
            at = rnd.randrange(len(other) + 1)
            other[at:at + rnd.randrange(2)] = [str(rnd.randrange(30)) for _ in range(rnd.randrange(3))]
        a, b = shingles(" ".join(words)), shingles(" ".join(other))
        want = naive_similarity(a.tolist(), b.tolist()) if len(a) and len(b) else 0.0
        got = O.aligned_similarity(a, b)
        assert got == pytest.approx(want) if want >= 0.8 else got < 0.8


def test_order_and_repetition_matter():
    words = [f"w{i}" for i in range(100)]
    assert O.aligned_similarity(shingles(" ".join(words)), shingles(" ".join(words[50:] + words[:50]))) < 0.8
    assert len(set(shingles("a b c d e " * 10).tolist())) == 46  # occurrences are told apart


def test_classes_of_the_test_table_match_brute_force(spark):
    path = f"{SF_SMALL}/documents.parquet"
    table = pq.read_table(path, columns=["doc_id", "text"]).to_pydict()
    want = brute_classes(list(zip(table["doc_id"], table["text"])))
    got = {r.doc_id: (r.class_id, r.kept) for r in O.class_of_documents(spark.read.parquet(path)).collect()}
    assert got == {i: (c, c == i) for i, c in want.items()}


def test_large_groups_and_odd_rows(spark):
    rnd = random.Random(8)
    base = [f"b{i}" for i in range(120)]
    docs = [(i, " ".join(base[:i % 100] + ["edit" + str(i)] + base[i % 100 + 1:])) for i in range(120)]  # near copies
    docs += [(1000 + i, docs[0][1].upper() + "!") for i in range(30)]  # equal words
    docs += [(2000 + i, " ".join(base[:40] + [f"u{rnd.random()}" for _ in range(200)])) for i in range(40)]  # a shared passage
    docs += [(3000, None), (3001, None), (3002, ""), (3003, "one two"), (3004, "One, two."), (None, "one two"),
             (3003, "one two"), (None, None), (3005, "!!! ???")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as row", "'k' as text_key")
    got = O.class_of_documents(frame).collect()
    assert len(got) == len(docs)
    classes = {r.doc_id: r.class_id for r in got}
    assert {classes[i] for i in range(120)} == {0} and {classes[1000 + i] for i in range(30)} == {0}
    assert [classes[2000 + i] for i in range(40)] == [2000 + i for i in range(40)]
    kept = O.deduplicate(frame)
    assert kept.columns == frame.columns
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(
        map(str, [0, *range(2000, 2040), 3000, 3001, 3002, 3003, None, 3005]))


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert O.class_of_documents(empty).count() == 0 and O.deduplicate(empty).count() == 0


def test_components_of_a_long_chain(spark):
    from stratum.llm.common import connected_components
    edges = spark.createDataFrame([(f"{i:04}", f"{i + 1:04}") for i in range(0, 300) if i != 150], "a string, b string")
    nodes = spark.createDataFrame([(f"{i:04}",) for i in range(302)], "id string")
    got = dict(rows(connected_components(nodes, edges)))
    assert got == {f"{i:04}": "0000" if i <= 150 else "0151" if i <= 300 else "0301" for i in range(302)}


def test_few_rows_do_not_take_a_task_for_every_shuffle_partition(spark):
    conf = {"spark.sql.shuffle.partitions": "97", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    context = spark.sparkContext
    words = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(words[:i] + [f"edit{i}"] + words[i + 1:])) for i in range(40)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        context.setJobGroup("few-rows", "few rows")
        assert {r.class_id for r in O.class_of_documents(frame).collect()} == {0}
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    told = context.statusTracker()
    stages = [told.getStageInfo(s) for j in told.getJobIdsForGroup("few-rows") for s in told.getJobInfo(j).stageIds]
    tasks = sorted(s.numTasks for s in stages if s and s.numCompletedTasks)
    assert len(tasks) > 20 and sum(t >= 97 for t in tasks) <= len(tasks) // 5, tasks
