import random

from stratum.llm import language_id as L

from ..conftest import SF_SMALL


def test_held_out_accuracy(spark):
    """Rows outside the fitted sample, judged without their declaration."""
    rows = L.evidence_of_documents(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    evidence, _ = L.gather_evidence(rows, fit_rows=40)
    judged = [(r.declared, evidence.judge(r.text, None, None, None)[0]) for r in rows.collect()]
    assert len(judged) > 900
    assert sum(a == b for a, b in judged) >= 0.99 * len(judged)


def test_all_documents_and_pages_are_identified(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert L.accepted_documents(docs).count() == docs.count()
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    got = L.identify(L.evidence_of_pages(pages)).collect()
    assert len(got) == pages.count() and all(r.language == r.declared and r.accepted for r in got)


def texts():
    en, de = "the cat and the dog went to the house with them ", "der hund und die katze gehen in das haus mit ihnen "
    out = [(i, en * 3 + str(i), "en", "a.example.uk") for i in range(30)] + [(100 + i, de * 3 + str(i), "de", "b.example.de") for i in range(30)]
    return out, en, de


def test_evidence_is_fused(spark):
    known, en, de = texts()
    extra = [(200, "hotel", None, "a.example.uk"), (201, "hotel", None, "b.example.de"), (202, "hotel", "de", None),
             (203, "hotel", "xx", "new.example.de"), (204, de, "en", "a.example.uk")]
    rows = spark.createDataFrame([(i, t, d, L_host and L_host.rpartition(".")[2], L_host) for i, t, d, L_host in known + extra],
                                 "id long, text string, declared string, suffix string, host string")
    got = {r.id: r.language for r in L.identify(rows).collect()}
    assert [got[i] for i in (200, 201, 202, 203)] == ["en", "de", "de", "de"]  # host, host, declaration, suffix
    assert got[204] == "de"  # a clear text outweighs the rest


def test_odd_rows(spark):
    known, en, _ = texts()
    odd = [(300, None, "en", "a"), (301, "", "en", "a"), (302, "1234 !!", "en", None), (303, en, None, None), (None, en, "en", "a"),
           (304, en * 20_000, "en", "a"), (303, en, None, None)]
    docs = spark.createDataFrame([(*r, 1) for r in known + odd],
                                 "doc_id long, text string, lang string, source string, counts int")
    kept = L.accepted_documents(docs)
    assert kept.columns == docs.columns
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(
        map(str, [*(r[0] for r in known), 303, None, 304, 303]))
    assert L.accepted_documents(docs.limit(0)).count() == 0
    undeclared = docs.selectExpr("doc_id", "text", "cast(null as string) as lang", "source")
    assert L.accepted_documents(undeclared).count() == docs.count()


def test_more_languages_than_64_and_unknown_ones(spark):
    """90 languages of their own words, one text in none of them, gibberish; 2,500 suffixes."""
    rnd = random.Random(5)

    def words(n=60):
        letters = rnd.sample("abcdefghijklmnopqrstuvwxyz", 9)
        return ["".join(rnd.choice(letters) for _ in range(rnd.randrange(3, 8))) for _ in range(n)]

    data, want = [], {}
    for k in range(90):
        vocabulary = words()
        for _ in range(14 + k % 3):
            i = len(data)
            want[i] = f"l{k}"
            data.append((i, " ".join(rnd.choices(vocabulary, k=80)), f"l{k}", f"s{i}", f"h{i}.s{i}"))
    strange = [" ".join(rnd.choices(words(), k=80)) for _ in range(5)]
    strange += ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(500)) for _ in range(5)]
    data += [(10_000 + i, t, None, None, None) for i, t in enumerate(strange)]
    data += [(20_000 + i, data[0][1], None, f"z{i}", None) for i in range(2_500)]
    rows = spark.createDataFrame(data, "id long, text string, declared string, suffix string, host string")
    evidence, by_key = L.gather_evidence(rows)
    assert len(evidence.model.languages) == 90 and by_key["suffix"].count() == 2_500 + len(want)
    got = {r.id: r for r in L.identify(rows).collect()}
    assert all(got[i].language == language and got[i].accepted for i, language in want.items())
    assert not any(got[10_000 + i].accepted for i in range(len(strange)))


def test_sample_is_over_different_texts(spark):
    """100 texts of one language in 20,000 rows, 40 of them in the sample; one text has most rows."""
    data = [(f"text {i} of a language", "en") for i in range(100) for _ in range(100)] + [("text 0 of a language", "en")] * 10_000
    languages, sample = L._sample(spark.createDataFrame(data, "text string, declared string"), 40)
    texts = [r.text for r in sample.collect()]
    assert languages == ["en"] and len(texts) == len(set(texts)) and 20 <= len(texts) <= 60
    assert L._sample(spark.createDataFrame(data, "text string, declared string"), 400)[1].count() == 100
