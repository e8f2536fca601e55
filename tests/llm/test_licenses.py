import re

import pytest

from stratum.llm import licenses
from stratum.llm.licenses import parse_expression, scan_licenses

from ..conftest import SF_SMALL


def brute(text):
    found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    starts, labels = [], set()
    for phrase, label in licenses.BASE_PHRASES.items():
        want = phrase.split()
        for i in range(len(found) - len(want) + 1):
            if found[i:i + len(want)] == want:
                starts.append(i)
                labels.add(label)
    return len(found), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


TEXTS = [None, "", "Under the MIT License.", "under-the MIT_license under the mit licenses", "é under the mit license",
         "cc by nc cc by nc", "Apache License, Version 2.0" * 50, "x " * 100_000 + "cc-by-nc", "CC by ncé", "\x7fcc by nc\x00"]


def test_base_places_match_brute_force(spark):
    texts = TEXTS + [r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("text").collect()]
    docs = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], "doc_id long, text string, n_words int")
    for r in scan_licenses(docs).collect():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(texts[r.doc_id]), r
        assert 0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))


@pytest.mark.parametrize("text, labels, exceptions, permissive", [
    ("MIT", {"mit"}, set(), True), ("MIT OR GPL-3.0-only", {"mit", "gpl-3"}, set(), True),
    ("MIT AND GPL-3.0-only", {"mit", "gpl-3"}, set(), False),
    ("GPL-2.0-or-later WITH Classpath-exception-2.0 OR Apache-2.0", {"gpl-2", "apache-2"},
     {"classpath-exception-2.0"}, True),
    ("MIT AND (BSD-3-Clause OR GPL-3.0-only)", {"mit", "bsd", "gpl-3"}, set(), True),
    ("MIT OR Apache-2.0 AND GPL-2.0", {"mit", "apache-2", "gpl-2"}, set(), True),
    ("Apache-2.0 then prose and more", {"apache-2"}, set(), True)])
def test_expressions(text, labels, exceptions, permissive):
    got = parse_expression(text)
    assert (got.labels, got.exceptions, got.permissive) == (labels, exceptions, permissive)


@pytest.mark.parametrize("text", ["", "AND MIT", "(MIT", "MIT OR", "()", "MIT AND )", "see the file", "unknown and lost",
                                  "MIT or later versions", "GPL-2.0 WITH care"])
def test_malformed_expressions(text):
    assert parse_expression(text) is None


def test_tags_add_labels(spark):
    docs = spark.createDataFrame([(1, "/* SPDX-License-Identifier: (MIT OR GPL-2.0-only) */ code"),
                                  (2, "spdx license identifier: mit or"), (3, "see the MPL"),
                                  (4, "// SPDX-License-Identifier: ISC\nunder the MIT license")], "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.score) for r in scan_licenses(docs).collect()}
    assert got == {1: ("gpl-2,mit", 1.0), 2: ("", 0.0), 3: ("", 0.0), 4: ("isc,mit", 1.0)}
    assert scan_licenses(docs.limit(0)).count() == 0


@pytest.mark.parametrize("text, labels", [
    ("This is GNU GPL v3 code", "gpl-3"), ("Apache-2.0 licensed", "apache-2"), ("Creative Commons Attribution 4.0", "cc-by"),
    ("Creative Commons Attribution-ShareAlike 4.0", "cc-by-sa"), ("public domain (CC0)", "cc0"), ("New 3-clause BSD terms", "bsd"),
    ("SPDX-License-Identifier: see the file", ""), ("SPDX-License-Identifier: unknown and lost", ""),
    ("SPDX-License-Identifier: LicenseRef-Acme OR EPL-2.0", "epl,licenseref-acme"), ("see the MPL, by MIT people", "")])
def test_common_notices_and_known_identifiers_only(text, labels):
    automaton = licenses.build_automaton(licenses.BASE_PHRASES, licenses.NOTICE_PHRASES)
    assert ",".join(sorted(licenses.scan(text, automaton)["labels"])) == labels
