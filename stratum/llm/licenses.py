"""Licence scan: identifier tags and notice phrases.

One Aho-Corasick automaton over a document's words finds notice phrases and
the words of identifier tags in a single pass over the whole text. Behind a
tag a shunting-yard parser evaluates the licence expression (``and``, ``or``,
``with``, parentheses).

Defined cases: a null or empty text has no words, no places and score 0.
Repeated rows are scanned one by one; other columns of the input are ignored.
A tag whose expression cannot be parsed, or names a licence that is neither
known nor an owner's own (``LicenseRef-``), adds no label.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import emit, rows_of, word_line

# Fixed values of the contract: phrases (as words) and their labels.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Further notices of the method, as words.
NOTICE_PHRASES = {
    "gnu general public license version 2": "gpl-2",
    "gnu general public license version 3": "gpl-3",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license version 2": "mpl-2",
    "redistribution and use in source and binary forms": "bsd",
    "permission is hereby granted free of charge": "mit",
    "licensed under cc by sa": "cc-by-sa",
    "licensed under cc by 4": "cc-by",
    "all rights reserved": "reserved",
    "gnu gpl v2": "gpl-2", "gnu gpl version 2": "gpl-2", "gplv2": "gpl-2", "gpl v2": "gpl-2",
    "gnu gpl v3": "gpl-3", "gnu gpl version 3": "gpl-3", "gplv3": "gpl-3", "gpl v3": "gpl-3",
    "gnu lgpl": "lgpl", "gnu library general public license": "lgpl", "gnu agpl": "agpl",
    "apache 2 0 licensed": "apache-2", "apache 2 0 license": "apache-2", "apache license 2 0": "apache-2",
    "licensed under the apache license": "apache-2",
    "mit licensed": "mit", "the mit license": "mit", "licensed under mit": "mit",
    "bsd 2 clause": "bsd", "bsd 3 clause": "bsd", "2 clause bsd": "bsd", "3 clause bsd": "bsd", "under the bsd license": "bsd",
    "isc license": "isc", "mpl 2 0": "mpl-2", "boost software license": "bsl", "eclipse public license": "epl",
    "european union public licence": "eupl", "zlib license": "zlib", "this is free and unencumbered software": "unlicense",
    "creative commons attribution 4 0": "cc-by", "creative commons attribution 3 0": "cc-by",
    "creative commons attribution 4 0 international": "cc-by", "creative commons attribution license": "cc-by",
    "creative commons attribution sharealike": "cc-by-sa", "creative commons attribution share alike": "cc-by-sa",
    "creative commons attribution noncommercial": "cc-by-nc", "creative commons attribution non commercial": "cc-by-nc",
    "creative commons zero": "cc0", "cc0 1 0": "cc0", "public domain cc0": "cc0", "cc0 public domain": "cc0",
    "dedicated to the public domain": "cc0",
}
TAG = "spdx license identifier"
# Labels of identifiers, longest prefix first.
IDENTIFIERS = {
    "mit": "mit", "apache-2": "apache-2", "cc-by-nc": "cc-by-nc", "cc-by-sa": "cc-by-sa", "cc-by": "cc-by",
    "cc0": "cc0", "gpl-2": "gpl-2", "gpl-3": "gpl-3", "lgpl": "lgpl", "agpl": "agpl", "mpl-2": "mpl-2",
    "bsd": "bsd", "isc": "isc", "0bsd": "bsd", "apache-1": "apache-1", "gpl-1": "gpl-1", "mpl-1": "mpl-1", "epl": "epl",
    "eupl": "eupl", "cddl": "cddl", "bsl": "bsl", "zlib": "zlib", "unlicense": "unlicense", "artistic": "artistic",
    "wtfpl": "wtfpl", "ofl": "ofl", "python": "python", "psf": "python", "postgresql": "postgresql", "openssl": "openssl",
    "x11": "mit", "ncsa": "ncsa", "libpng": "zlib", "cc-pddc": "cc0", "gfdl": "gfdl", "ms-pl": "ms-pl", "ms-rl": "ms-rl",
}
#: Identifiers of an owner's own licences, and what an exception's name holds.
OWN, EXCEPTION = ("licenseref-", "documentref-"), "exception"
PERMISSIVE = frozenset({"mit", "apache-2", "bsd", "isc", "cc0", "cc-by", "zlib", "unlicense", "bsl", "ncsa", "postgresql", "wtfpl", "python"})
# Weight of the strongest evidence of a document.
TAG_SCORE, PHRASE_SCORE, NOTICE_SCORE = 1.0, 0.9, 0.6

_TAG_AT = re.compile(r"spdx[\x00-\x2F\x3A-\x60\x7B-\x7F]+license[\x00-\x2F\x3A-\x60\x7B-\x7F]+identifier\s*:[ \t]*"
                     r"([^\r\n]*)", re.I | re.A)
_TOKEN = re.compile(r"\s*([()]|[A-Za-z0-9][A-Za-z0-9.+:-]*)")
_BINDING = {"or": 1, "and": 2, "with": 3}


@dataclass(frozen=True)
class Terms:
    """Value of an expression: labels named, exceptions named, and whether a
    user may choose only permissive licences."""
    labels: frozenset[str]
    exceptions: frozenset[str]
    permissive: bool


def label_of(identifier: str) -> str | None:
    """The label of a known identifier, an owner's own one as it stands, else None."""
    name = identifier.lower()
    known = next((IDENTIFIERS[k] for k in sorted(IDENTIFIERS, key=len, reverse=True)
                  if name == k or name.startswith((k + "-", k + ".", k + "+"))), None)
    return known or (name if name.startswith(OWN) else None)


def _operand(name: str, behind_with: bool) -> Terms | None:
    """None for a word that is no identifier (or, behind ``with``, no exception)."""
    if behind_with:
        return Terms(frozenset(), frozenset({name.lower()}), False) if EXCEPTION in name.lower() else None
    label = label_of(name)
    return Terms(frozenset({label}), frozenset(), label in PERMISSIVE) if label else None


def _apply(op: str, a: Terms, b: Terms) -> Terms:
    if op == "with":  # b names an exception, which only relaxes a
        return Terms(a.labels, a.exceptions | b.exceptions, a.permissive)
    either = a.permissive or b.permissive if op == "or" else a.permissive and b.permissive
    return Terms(a.labels | b.labels, a.exceptions | b.exceptions, either)


def parse_expression(text: str) -> Terms | None:
    """Evaluate the longest expression at the start of ``text`` with the
    shunting-yard algorithm; None if there is none, it is malformed or names
    something unknown. Prose after a complete expression ends it."""
    values: list[Terms] = []
    ops: list[str] = []
    want_operand, at, depth = True, 0, 0

    def reduce(limit: int) -> bool:
        while ops and ops[-1] != "(" and _BINDING[ops[-1]] >= limit:
            if len(values) < 2:
                return False
            b = values.pop()
            values.append(_apply(ops.pop(), values.pop(), b))
        return True

    while match := _TOKEN.match(text, at):
        token = match[1]
        word = token.lower()
        if want_operand:
            if token == "(":
                ops.append(token)
                depth += 1
            elif token == ")" or word in _BINDING:
                return None
            else:
                value = _operand(token.rstrip(".:"), bool(ops) and ops[-1] == "with")
                if value is None:  # prose
                    return None
                values.append(value)
                want_operand = False
        elif token == ")":
            if not depth:
                break
            if not reduce(1):
                return None
            ops.pop()
            depth -= 1
        elif word in _BINDING:
            if not reduce(_BINDING[word]):
                return None
            ops.append(word)
            want_operand = True
        else:
            break
        at = match.end()
    if want_operand or depth or not reduce(1):
        return None
    return values[0]


def build_automaton(base: dict[str, str], notices: dict[str, str]):
    automaton = ahocorasick.Automaton()
    kinds: dict[str, list] = {}
    for phrases, kind in ((base, "base"), (notices, "notice"), ({TAG: ""}, "tag")):
        for phrase, label in phrases.items():
            kinds.setdefault(phrase, []).append((kind, label))
    for phrase, meanings in kinds.items():
        automaton.add_word(f" {phrase} ", (len(phrase) + 2, meanings))
    automaton.make_automaton()
    return automaton


def scan(text: str | None, automaton) -> dict:
    """Places, labels, expressions and score of one text."""
    line = word_line(text)
    n_words = line.count(" ") - 1
    starts: list[int] = []
    base, added, tagged = set(), set(), False
    counted, at = 0, 0
    hits = sorted((end - n + 1, meanings) for end, (n, meanings) in automaton.iter(line)) if n_words else []
    for start, meanings in hits:
        at += line.count(" ", counted, start)  # words before the place
        counted = start
        for kind, label in meanings:
            if kind == "base":
                starts.append(at)
                base.add(label)
            elif kind == "notice":
                added.add(label)
            else:
                tagged = True
    expressions = []
    if tagged:
        for match in _TAG_AT.finditer(text):
            if terms := parse_expression(match[1]):
                expressions.append(terms)
                added |= terms.labels
    score = TAG_SCORE if expressions else PHRASE_SCORE if base else NOTICE_SCORE if added else 0.0
    return {"n_words": n_words, "starts": starts, "base": base, "labels": base | added, "score": score,
            "exceptions": frozenset().union(*(e.exceptions for e in expressions)),
            "permissive": all(e.permissive for e in expressions) if expressions
            else bool(base | added) and (base | added) <= PERMISSIVE}


_RESULT = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
    ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
    ("exceptions", pa.string()), ("permissive", pa.bool_())])


def scan_licenses(documents: DataFrame, base: dict[str, str] = BASE_PHRASES,
                  notices: dict[str, str] = NOTICE_PHRASES) -> DataFrame:
    """One row per document (map only, no shuffle)."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches):
        automaton = build_automaton(base, notices)

        def rows():
            for doc_id, text in rows_of(batches, ["doc_id", "text"]):
                x = scan(text, automaton)
                s = x["starts"]
                yield (doc_id, x["n_words"], len(s), s[0] if s else None, s[-1] if s else None,
                       ",".join(sorted(x["base"])), ",".join(sorted(x["labels"])), x["score"],
                       ",".join(sorted(x["exceptions"])), x["permissive"])

        yield from emit(rows(), _RESULT)

    return docs.mapInArrow(run, "doc_id long, n_words long, n_base long, first_word long, last_word long, "
                                "base_labels string, labels string, score double, exceptions string, "
                                "permissive boolean")
