import duckdb
import pyarrow.parquet as pq

import corpus_pipeline as C
from stratum.llm import queries
from stratum.llm.packing import TextTokenizer, vocabulary_path

from ..conftest import SF_SMOKE
from .test_decontaminate import brute as contaminated
from .test_order_minhash import brute_classes
from .test_pii import brute as personal


def test_run_matches_a_brute_force_pipeline(spark):
    table = pq.read_table(f"{SF_SMOKE}/documents.parquet").to_pydict()
    docs = list(zip(table["doc_id"], table["text"]))
    classes = brute_classes(docs)
    items = [tuple(r) for r in duckdb.sql(f"select item_id, text from '{SF_SMOKE}/benchmark.parquet'").fetchall()]
    want = {}
    tokenizer = TextTokenizer(vocabulary_path())
    for i, text in docs:
        if classes[i] != i or contaminated(text, items, 13)[4]:
            continue
        at, out = 0, []
        for kind, a, b in sorted(personal(text), key=lambda s: s[1]):
            if b > at:
                out += [text[at:max(a, at)], f"[{kind.upper()}]"]
                at = b
        want[i] = len(tokenizer.encode("".join(out) + text[at:])) + 1
    got = {}
    for r in C.run(spark, SF_SMOKE).collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
        assert r.doc_tokens == want[r.doc_id]
    assert got == want


def test_stages_keep_the_columns_and_empty_tables(spark):
    docs = spark.read.parquet(f"{SF_SMOKE}/documents.parquet")
    for _, stage in C.STAGES[:-1]:
        out = stage(spark, docs.limit(0), SF_SMOKE)
        assert out.columns == docs.columns and out.count() == 0


def test_registry():
    assert {f"op{n}" for n in range(1, 14)} == {k.split("_")[0] for k in queries.REGISTRY if k != "pipeline"}
    assert "pipeline" in queries.REGISTRY and set(queries.ORACLE_SQL) <= set(queries.REGISTRY)
