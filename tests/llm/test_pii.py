import hashlib
import random
import re
import time

from stratum.llm import pii

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
            "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
            "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def brute(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or "", re.A):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(len(p.lstrip("0")) > 3 or int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def told(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def test_base_spans_match_brute_force(spark):
    rnd = random.Random(3)
    texts = ["".join(rnd.choice("a.@1+-_ 9(0é𝒳4,:%") for _ in range(rnd.randrange(200))) for _ in range(300)]
    texts += ["".join(rnd.choice("0123456789 -.+") for _ in range(rnd.randrange(200))) for _ in range(300)]
    texts += [None, "", "a@b.c_d@e.f x 4173893178530722 1.2.3.4.5.6.7.8 000.001.0255.3", "9" * 3000, "a" * 100_000 + " b",
              "1." * 3000, "x@" + "a." * 5000, "1 " * 5000, "𝒳𝒳 4111 1111 1111 1111 𝒳 +49 (30) 123-456"]
    docs = [(i, t) for i, t in enumerate(texts)] + [(2, "again a@b.co"), (None, "n a@b.co")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as base", "'x' as key", "2 as added")
    got = sorted(map(tuple, pii.find_personal_data(frame).collect()), key=str)
    want = []
    for i, t in docs:
        spans = brute(t)
        want.append((i, *(sum(k == x for k, _, _ in spans) for x in PATTERNS),
                     hashlib.sha256(told(spans).encode()).hexdigest(), told(spans)))
    assert got == sorted(want, key=str)


def test_a_text_of_very_many_matches(spark):
    text = "".join(f"a{i}@b.co {i % 256}.1.2.3\n" for i in range(100_000))
    start = time.time()
    row = pii.find_personal_data(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    spans = brute(text)
    assert (row.n_email, row.n_ip, row.base_sha256) == (100_000, 100_000, hashlib.sha256(told(spans).encode()).hexdigest())
    assert time.time() - start < 120


def test_places_do_not_depend_on_the_block(spark, monkeypatch):
    text = " ".join(f"x{i}@y.z" for i in range(23))
    frame = spark.createDataFrame([(1, text), (2, "a@b.c"), (3, "")], "doc_id long, text string")
    want = [tuple(r) for r in pii.find_personal_data(frame).orderBy("doc_id").collect()]
    for block in (1, 2, 23, 24):
        monkeypatch.setattr(pii, "BLOCK", block)
        assert [tuple(r) for r in pii.find_personal_data(frame).orderBy("doc_id").collect()] == want


def labelled(n):
    return [(i, f"Name: bob {i}\nPhone: +1 (555) 010-{1000 + i} and mail: u{i}@ex.org") for i in range(n)]


def test_bootstrapping_finds_unseen_identifiers_only_behind_proven_labels(spark):
    docs = labelled(30) + [(50, "𝒳 Phone: 555 123 4567."), (51, "phone: hello"), (52, "Total: 555 123 4567"),
                           (53, "Mail: ann(at)ex.org")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r for r in pii.find_personal_data(frame).collect()}
    assert (got[50].spans, got[50].n_phone) == ("phone:9:21", 0)
    assert got[51].spans == got[52].spans == "" and got[53].spans == "email:6:19"
    few = {r.doc_id: r.spans for r in pii.find_personal_data(frame.filter("doc_id < 2 or doc_id = 50")).collect()}
    assert few[50] == ""


def test_few_values_do_not_take_a_task_for_every_shuffle_partition(spark):
    conf = {"spark.sql.shuffle.partitions": "97", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    context = spark.sparkContext
    frame = spark.createDataFrame(labelled(30) + [(50, "Phone: 555 123 4567.")], "doc_id long, text string")
    want = sorted(map(tuple, pii.find_personal_data(frame).collect()))
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        context.setJobGroup("few-values", "few values")
        got = sorted(map(tuple, pii.find_personal_data(frame).collect()))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == want and got[-1][-1] == "phone:7:19"
    told = context.statusTracker()
    stages = [told.getStageInfo(s) for j in told.getJobIdsForGroup("few-values") for s in told.getJobInfo(j).stageIds]
    tasks = sorted(s.numTasks for s in stages if s and s.numCompletedTasks)
    assert len(tasks) > 20 and tasks[-1] < 97, tasks


def test_redaction(spark):
    docs = labelled(30) + [(50, "𝒳 Phone: 555 123 4567."), (60, None), (61, ""), (62, "no data"),
                           (63, "a@1.2.3.4 end +1 555 123 45678 x")]
    frame = spark.createDataFrame([(i, t, "en", len(t or ""), 1) for i, t in docs],
                                  "doc_id long, text string, lang string, n_chars long, spans int")
    clean = pii.redact(frame)
    assert clean.columns == frame.columns and clean.schema["n_chars"].dataType == frame.schema["n_chars"].dataType
    got = {r.doc_id: r for r in clean.collect()}
    assert got[0].text == "Name: bob 0\nPhone: [PHONE] and mail: [EMAIL]"
    assert (got[50].text, got[60].text, got[61].text, got[62].text) == ("𝒳 Phone: [PHONE].", None, "", "no data")
    assert got[63].text == "[EMAIL] end [PHONE] x"
    assert all(r.n_chars == len(r.text) for r in got.values() if r.text is not None) and got[60].n_chars == 0


def test_main_path_is_native(spark):
    frame = spark.createDataFrame(labelled(5), "doc_id long, text string")
    plan = pii.find_personal_data(frame)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert pii.find_personal_data(empty).count() == 0 and pii.redact(empty).count() == 0
