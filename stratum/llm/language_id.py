"""Language identification by Bayesian evidence fusion.

For every text and language four pieces of evidence are added as logarithms:
the text's likelihood under character trigrams, the declared markup language,
the address suffix and the host. The host's prior is smoothed towards its
suffix's, that one towards the corpus's (Dirichlet smoothing, level by level);
the counts behind them, and how often a language is declared as another, come
from grouped aggregation over all rows of what the text alone says.

The trigram model is fitted on a bounded sample of rows with a declared
declared language (``FIT_ROWS`` different texts of each, chosen by hash); all counts cover all rows.
Each sample row's likelihood under the rest of its language's sample tells
what is usual there: a text far below that under its best language (an unknown
language, gibberish) is rejected, and its language is only the nearest known.

Defined cases: a text that is null, empty or without letters has no likelihood
and is rejected (language null). A null or unknown declaration, suffix or host
adds no evidence; so does a language that fewer than ``LEAST_ROWS`` rows
declare. Without any declared language in the table every text is accepted
with language null, as there is nothing to compare. Repeated rows are
judged one by one; other columns pass through or are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import emit, keep_on_shared_storage, rows_of

#: Different texts of each declared language that the trigram model is fitted on at most (about).
FIT_ROWS = 400
#: Rows that declare a language before the model knows it.
LEAST_ROWS = 10
BUCKETS = 1 << 15
#: Weight of a trigram's log likelihood (neighbouring trigrams are not independent).
TEXT_WEIGHT = 0.3
#: Pseudo-counts of the smoothing.
STRENGTH = 20.0
#: A posterior below this rejects a text: no language is clearly more likely.
LEAST_POSTERIOR = 0.5
#: A text is unusual when the mean log likelihood of its trigrams lies so many
#: deviations below its language's; texts of a language deviate by so much at least.
UNUSUAL, LEAST_DEVIATION = 6.0, 0.6
#: Counts of hosts, suffixes or declarations are broadcast up to so many; more are joined.
MAX_BROADCAST_KEYS = 100_000

# Letters in lower case keep their bytes, all else is one space.
_FOLD = np.array([b if b >= 0x80 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20
                  for b in range(256)], np.uint8)


def trigrams(text: str | None) -> np.ndarray:
    """Buckets of the byte trigrams of a whole text, without those of spaces only."""
    if not text:
        return np.zeros(0, np.int64)
    data = _FOLD[np.frombuffer(f" {text} ".encode("utf-8", "surrogatepass"), np.uint8)]
    keep = np.ones(len(data), bool)
    keep[1:] = (data[1:] != 0x20) | (data[:-1] != 0x20)  # runs of spaces count once
    data = data[keep].astype(np.uint32)
    if len(data) < 3:
        return np.zeros(0, np.int64)
    code = (data[:-2] * np.uint32(65_599 ** 2 & 0xFFFFFFFF) + data[1:-1] * np.uint32(65_599) + data[2:])
    code = (code ^ (code >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return ((code ^ (code >> np.uint32(12))) & np.uint32(BUCKETS - 1)).astype(np.int64)


class TrigramModel:
    def __init__(self, languages: list[str], counts: np.ndarray) -> None:
        self.languages = languages
        total = counts.sum(axis=1, keepdims=True)
        self.logs = np.log((counts + 0.1) / (total + 0.1 * BUCKETS)).astype(np.float32).T.copy()
        #: For each language the mean of a text's mean log likelihood, its
        #: variance between texts and that between trigrams.
        self.usual = np.zeros((len(languages), 3))

    def likelihoods(self, text: str | None) -> np.ndarray | None:
        """Weighted log likelihood for each language, None without letters."""
        return self.measure(text)[0]

    def measure(self, text: str | None) -> tuple[np.ndarray | None, int]:
        """The same, and the number of trigrams."""
        found = trigrams(text)
        if not len(found) or not self.languages:
            return None, 0
        total = np.zeros(len(self.languages))
        for at in range(0, len(found), 1 << 18):
            total += self.logs[found[at:at + (1 << 18)]].sum(axis=0, dtype=np.float64)
        return TEXT_WEIGHT * total, len(found)

    def is_usual(self, language: int, weighted: float, length: int) -> bool:
        mean, between, within = self.usual[language]
        deviation = np.sqrt(max(between, LEAST_DEVIATION ** 2) + within / (TEXT_WEIGHT * length))
        return bool(weighted / TEXT_WEIGHT / length >= mean - UNUSUAL * deviation)


def _sample(rows: DataFrame, fit_rows: int) -> tuple[list[str], DataFrame]:
    """The model's languages, and about ``fit_rows`` different texts (declared, text) of each."""
    sizes = rows.filter("declared is not null and text is not null") \
        .groupBy("declared", F.xxhash64("text").alias("hash")).agg(F.count(F.lit(1)).alias("n")) \
        .groupBy("declared").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("texts")).filter(F.col("n") >= LEAST_ROWS)
    # The share of the hash range that gives about fit_rows of them.
    share = F.least(F.lit(1.0), F.lit(float(fit_rows)) / F.col("texts"))
    bounds = keep_on_shared_storage(sizes.select("declared", (share * (1 << 30)).cast("long").alias("bound")), "languages")
    sample = rows.filter("text is not null").join(F.broadcast(bounds), "declared") \
        .withColumn("hash", F.xxhash64("text")).filter(F.pmod("hash", F.lit(1 << 30)) < F.col("bound")) \
        .groupBy("declared", "hash").agg(F.first("text").alias("text")).select("declared", "text")
    return sorted(r["declared"] for r in bounds.collect()), sample


def fit(rows: DataFrame, fit_rows: int = FIT_ROWS) -> TrigramModel:
    """A trigram model of the declared languages of ``rows`` (text, declared)."""
    languages, sample = _sample(rows, fit_rows)
    if not languages:
        return TrigramModel([], np.zeros((0, BUCKETS)))
    # By language: a task holds the counts of one at a time, and sends each once.
    sample = keep_on_shared_storage(sample, "language-sample")

    def measure(table: pa.Table) -> pa.Table:
        """Counts of a language, and its row of ``usual``: each text against the others."""
        texts = [trigrams(t) for t in table.column("text").to_pylist()]
        counts = np.zeros(BUCKETS)
        for found in texts:
            counts += np.bincount(found, minlength=BUCKETS)
        means, within = [], []
        for found in texts:
            if len(found):
                own = np.bincount(found, minlength=BUCKETS)
                logs = np.log((counts - own + 0.1)[found] / (counts.sum() - len(found) + 0.1 * BUCKETS))
                means.append(logs.mean())
                within.append(logs.var())
        usual = [np.mean(means), np.var(means), np.mean(within)] if means else [0.0, 0.0, 0.0]
        return pa.table({"declared": table.column("declared")[:1], "counts": pa.array([counts.astype(np.int32).tobytes()]),
                         "usual": pa.array([[float(x) for x in usual]], pa.list_(pa.float64()))})

    counts = np.zeros((len(languages), BUCKETS), np.float32)
    usual = np.zeros((len(languages), 3))
    at = {language: i for i, language in enumerate(languages)}
    for r in sample.groupBy("declared").applyInArrow(
            measure, "declared string, counts binary, usual array<double>").toLocalIterator():
        counts[at[r["declared"]]] = np.frombuffer(r["counts"], np.int32)
        usual[at[r["declared"]]] = r["usual"]
    model = TrigramModel(languages, counts)
    model.usual = usual
    return model


def _smoothed(counts: np.ndarray, prior: np.ndarray) -> np.ndarray:
    return (counts + STRENGTH * prior) / (counts.sum() + STRENGTH)


class Evidence:
    """Priors and declaration rates; ``judge`` fuses the evidence of a row.

    Counts of a row's declaration, suffix and host come as (language, count,
    language, count, ...) of the languages with any, None where there are none."""

    def __init__(self, model: TrigramModel, corpus: np.ndarray, declared: np.ndarray, kinds: int) -> None:
        n = max(1, len(model.languages))
        self.model = model
        self.corpus = _smoothed(corpus, np.full(n, 1 / n))
        # Rows of each language that declare one, and the number of declarations.
        self.totals, self.kinds = declared, max(1, kinds)

    def _dense(self, pairs: list[int]) -> np.ndarray:
        out = np.zeros(len(self.corpus))
        out[pairs[::2]] = pairs[1::2]
        return out

    def judge(self, text: str | None, declared: list[int] | None, suffix: list[int] | None,
              host: list[int] | None) -> tuple[str | None, float, bool]:
        """(language, posterior, the text is usual for it), (None, 0.0, False) without likelihood."""
        told, length = self.model.measure(text)
        if told is None:
            return None, 0.0, False
        prior = self.corpus if suffix is None else _smoothed(self._dense(suffix), self.corpus)
        logs = told + np.log(prior if host is None else _smoothed(self._dense(host), prior))
        if declared is not None:  # log P(declared | language): each language spreads over all declarations
            logs = logs + np.log((self._dense(declared) + STRENGTH / self.kinds) / (self.totals + STRENGTH))
        logs -= logs.max()
        posterior = np.exp(logs) / np.exp(logs).sum()
        best = int(posterior.argmax())
        return self.model.languages[best], float(posterior[best]), self.model.is_usual(best, told[best], length)


def gather_evidence(rows: DataFrame, fit_rows: int = FIT_ROWS) -> tuple[Evidence, dict[str, DataFrame]]:
    """The evidence of all ``rows`` (text, declared, suffix, host), and the
    counts of each declaration, suffix and host as stored frames by column."""
    model = fit(rows, fit_rows)
    held = rows.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("host", pa.string()), ("suffix", pa.string()), ("declared", pa.string()),
                        ("best", pa.int32()), ("n", pa.int64())])

    def run(batches):
        counts: dict[tuple, int] = {}
        for text, declared, suffix, host in rows_of(batches, ["text", "declared", "suffix", "host"]):
            logs = held.value.likelihoods(text)
            if logs is not None:
                key = (host, suffix, declared, int(logs.argmax()))
                counts[key] = counts.get(key, 0) + 1
                if len(counts) >= 50_000:  # many hosts: give out what there is
                    yield from emit(((*k, n) for k, n in counts.items()), schema)
                    counts.clear()
        yield from emit(((*k, n) for k, n in counts.items()), schema)

    counts = keep_on_shared_storage(
        rows.select("text", "declared", "suffix", "host")
        .mapInArrow(run, "host string, suffix string, declared string, best int, n long")
        .groupBy("host", "suffix", "declared", "best").agg(F.sum("n").alias("n")), "language-counts")

    def tally(column: str) -> DataFrame:
        pairs = counts.filter(F.col(column).isNotNull()).groupBy(column, "best").agg(F.sum("n").alias("n"))
        pairs = pairs.groupBy(column).agg(F.collect_list(F.array(F.col("best").cast("long"), "n")).alias("pairs"))
        return keep_on_shared_storage(pairs.select(column, F.flatten("pairs").alias(f"{column}_counts")), f"{column}-counts")

    corpus, declared = np.zeros((2, max(1, len(model.languages))))
    for r in counts.groupBy("best").agg(
            F.sum("n").alias("n"), F.sum(F.when(F.col("declared").isNotNull(), F.col("n")).otherwise(0)).alias("told")).collect():
        corpus[r["best"]], declared[r["best"]] = r["n"], r["told"]
    by_key = {column: tally(column) for column in ("declared", "suffix", "host")}
    return Evidence(model, corpus, declared, by_key["declared"].count()), by_key


def _with_counts(rows: DataFrame, by_key: dict[str, DataFrame]) -> DataFrame:
    for column, counts in by_key.items():
        small = counts.limit(MAX_BROADCAST_KEYS + 1).count() <= MAX_BROADCAST_KEYS
        rows = rows.join(F.broadcast(counts) if small else counts, column, "left")
    return rows


_COUNTS = ["declared_counts", "suffix_counts", "host_counts"]


def identify(rows: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """(id, declared, language, posterior, accepted) for every row of ``rows``
    (id, text, declared, suffix, host)."""
    evidence, by_key = gather_evidence(rows, fit_rows)
    held = rows.sparkSession.sparkContext.broadcast(evidence)
    schema = pa.schema([("id", pa.int64()), ("declared", pa.string()), ("language", pa.string()),
                        ("posterior", pa.float64()), ("accepted", pa.bool_())])

    def run(batches):
        def out() -> Iterator[tuple]:
            for i, declared, text, *counts in rows_of(batches, ["id", "declared", "text", *_COUNTS]):
                judged = held.value.judge(text, *counts)
                yield i, declared, *judged[:2], _accepted(held.value, *judged)

        yield from emit(out(), schema)

    return _with_counts(rows, by_key).select("id", "declared", "text", *_COUNTS).mapInArrow(
        run, "id long, declared string, language string, posterior double, accepted boolean")


def _accepted(evidence: Evidence, language: str | None, posterior: float, usual: bool) -> bool:
    return not evidence.model.languages or language is not None and posterior >= LEAST_POSTERIOR and usual


def suffix_of(host: Column) -> Column:
    """The last label of a host with several labels, else null."""
    return F.nullif(F.regexp_extract(host, r"\.([^.:]+)(?::[0-9]*)?$", 1), F.lit(""))


def evidence_of_documents(documents: DataFrame) -> DataFrame:
    """(id, text, declared, suffix, host) of ``documents``: the declared
    language is ``lang``, the host ``source``."""
    source = F.lower(F.col("source").cast("string"))
    return documents.select(
        F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"),
        F.lower(F.col("lang").cast("string")).alias("declared"), suffix_of(source).alias("suffix"),
        source.alias("host"))


def evidence_of_pages(pages: DataFrame) -> DataFrame:
    """The same of ``pages``: the language that the markup declares, the URL's
    host and its suffix; the text is the page without markup."""
    host = F.nullif(F.lower(F.regexp_extract("url", "^(?s).*?://([^/?#]*)", 1)), F.lit(""))
    page = F.col("html").cast("string")
    declared = F.lower(F.regexp_extract(page, r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})", 1))
    text = F.regexp_replace(page, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*+>", " ")
    return pages.select(F.col("page_id").cast("long").alias("id"), text.alias("text"),
                        F.nullif(declared, F.lit("")).alias("declared"), suffix_of(host).alias("suffix"),
                        host.alias("host"))


def accepted_documents(documents: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """The documents whose language is identified, all columns."""
    rows = evidence_of_documents(documents)
    evidence, by_key = gather_evidence(rows, fit_rows)
    held = documents.sparkSession.sparkContext.broadcast(evidence)
    whole = documents.select(
        F.struct("*").alias("row"), F.col("text").cast("string").alias("text"),
        F.lower(F.col("lang").cast("string")).alias("declared"),
        F.lower(F.col("source").cast("string")).alias("host"))
    whole = _with_counts(whole.withColumn("suffix", suffix_of(F.col("host"))), by_key)

    def run(batches):
        for batch in batches:
            judged = [held.value.judge(*x) for x in rows_of([batch], ["text", *_COUNTS])]
            keep = pa.array([_accepted(held.value, *j) for j in judged], pa.bool_())
            yield pa.RecordBatch.from_struct_array(batch.column("row")).filter(keep)

    return whole.select("row", "text", *_COUNTS).mapInArrow(run, documents.schema)
