import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from stratum.llm import collocations as C


def brute(rows, least=C.LEAST, top=C.TOP):
    lower = {c: c + 32 for c in range(65, 91)}
    f, n = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        counts = f.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for i in range(len(words)):
                for k in range(1, min(4, len(words) - i) + 1):
                    counts[tuple(words[i:i + k])] += 1
    out = []
    for lang, counts in f.items():
        found = []
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        around = Counter()
        for p, a in candidates.items():
            for w in range(2, len(p)):
                for i in range(len(p) - w + 1):
                    around[p[i:i + w]] = max(around[p[i:i + w]], a)
        for p, a in candidates.items():
            cuts = []
            for k in range(1, len(p)):
                left, right = counts[p[:k]], counts[p[k:]]
                cuts.append((int(Fraction(2000000 * a, left + right)), k, left, right))
            score, _, left, right = min(cuts)
            if around[p] and 100 * around[p] >= 80 * a:
                continue
            found.append((-score, -a, " ".join(p).encode(), left, right))
        found.sort()
        out += [(lang, i + 1, p.decode(), -a, left, right, n[lang], -score)
                for i, (score, a, p, left, right) in enumerate(found[:top])]
    return sorted(out)


def planted(seed=3, n=400):
    rnd = random.Random(seed)
    vocabulary = ["the", "of", "New", "york", "Stock", "exchange", "é", "日本", "a-b", "x'y", "\x00", "\x1c", " ", "ß"]
    rows = []
    for i in range(n):
        words = [rnd.choice(vocabulary) for _ in range(rnd.randint(0, 40))]
        for _ in range(rnd.randint(0, 4)):
            words[rnd.randint(0, len(words)):0] = rnd.choice([["new", "YORK", "stock", "exchange"], ["of", "the"], ["red", "tape", "worm"]])
        text = "".join(w + rnd.choice([" ", " ", " ", " ", "\t", "  ", ". ", ",", "\n", "\x0b", "?"]) for w in words)
        rows.append((text, rnd.choice(["en", "en", "en", "fr", None, "und", ""])))
    return rows + [(None, "en"), ("", "de"), (" ,. ", "es"), ("one word", None), (rows[0][0], rows[0][1])] * 2


def frame(spark, rows):
    return spark.createDataFrame([(i, *r, 1, 2, 3) for i, r in enumerate(rows)],
                                 "doc_id long, text string, lang string, n int, f int, hash int")


def got(df):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


@pytest.mark.parametrize("options", [{}, {"budget": 50}, {"budget": 2000, "chunk": 60}, {"least": 5, "top": 7, "chunk": 300}])
def test_matches_brute_force(spark, options):
    rows = planted()
    want = brute(rows, options.get("least", C.LEAST), options.get("top", C.TOP))
    assert want and got(C.collocations(frame(spark, rows).repartition(3), **options)) == want


def test_a_hot_passage_and_a_very_long_text(spark):
    rows = [("to be or not to be that is the question " * 300, "en")] * 20 + [("to be, or not", "en")] * 50 + [("la la " * 3000, None)]
    want = brute(rows)
    assert got(C.collocations(frame(spark, rows).repartition(4), budget=500, chunk=256)) == want


def test_words_of_one_hash_stay_apart(monkeypatch):
    monkeypatch.setattr(C, "_mixed", lambda h: h * np.uint64(0))  # every word collides
    words = np.frombuffer(b"ab cd ab ef", np.uint8)
    ids, place = C.Chunk(words, np.array([0]), np.array([1], np.uint64)).word_ids()
    assert ids.tolist() == [0, 1, 0, 2] and [words[i * 3] for i in place] == [97, 99, 101]


def test_partition_keeps_to_the_budget():
    loads = np.array([5, 90, 250, 40, 0, 60])
    p = C.Partition(loads, {7 << 40: 230, -1: 120}, 5, 100)
    assert p.parts.tolist() == [1, 1, 3, 1, 1, 1] and p.pair_parts.tolist() == [3, 2]
    light = {}
    for b in np.flatnonzero(p.parts == 1):
        light[p.base[b]] = light.get(p.base[b], 0) + loads[b]
    assert max(light.values()) <= 100 and p.groups == len(light) + 3 + 5
    assert len({*light, *range(p.base[2], p.base[2] + 3), *range(p.pair_base[0], p.groups)}) == p.groups


def test_an_empty_table_and_no_candidates(spark):
    assert got(C.collocations(frame(spark, [("a b", "en")]).limit(0))) == []
    assert got(C.collocations(frame(spark, [("a b", "en"), (None, None)]))) == []
