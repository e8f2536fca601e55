"""Personal data by patterns and bootstrapped contexts, in DataFrame functions only.

Base spans are the matches of four fixed patterns. The method adds spans that
no pattern knows: every labelled value of the corpus (``word: value``,
``word = value``) is an edge of a graph between lexical patterns (the label)
and instances (the value). Values that are base matches are the seeds. Spark
scores the graph in rounds: a pattern's score for a kind is the share of its
instances, weighted by their confidence, that are of the kind; an instance
takes the best score of its patterns. Patterns with enough seeds and a high
score make unseen values of a fitting shape instances, which support further
patterns in the next round.

Defined cases: a null or empty text has no spans. Positions are code points,
end exclusive. A label has 2 to 24 letters; a labelled value ends after 64
characters and six more groups of up to nine. Added spans that touch a base span are dropped; of overlapping
added spans all stay. Repeated rows are scanned one by one; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fewer_tasks, keep_on_shared_storage

KINDS = ("email", "ip", "card", "phone")
# The contract's patterns. Possessive quantifiers and the look-behinds give the
# same matches (what follows never needs a step back, and a match that fails
# from the start of a run fails from its inside) in time linear in the text.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without a match of this has none of the kind.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
#: A labelled value: a word, a separator, an identifier.
LABELLED = (r"\b(\p{L}{2,24})[ \t]{0,3}[:=#][ \t]{0,3}[\"'(]?"
            r"([+]?[A-Za-z0-9(][A-Za-z0-9@._%+()/-]{0,63}(?:[ -][0-9()][0-9()-]{1,8}){0,6})")
#: What an unseen value of a kind must look like as a whole.
SHAPES = {
    "email": r"[A-Za-z0-9._%+-]+(?:@|\(at\)|_at_)[A-Za-z0-9._()-]+",
    "ip": r"[0-9A-Fa-f]{1,4}(?:[.:][0-9A-Fa-f]{1,4}){3,7}",
    "card": r"[0-9](?:[ -]?[0-9]){10,20}",
    "phone": r"[+(]?[0-9](?:[ ()./-]{0,2}[0-9]){6,16}",
}
#: Distinct seeds that a pattern needs, the score from which on it counts, and rounds.
MIN_SEEDS, MIN_SCORE, ROUNDS = 3, 0.8, 3


#: Matches of a text that are placed together.
BLOCK = 256
#: Added spans are broadcast up to so many; more are joined by row.
MAX_BROADCAST_SPANS = 20_000
#: Labelled values of one task in a step of the graph.
VALUES_OF_TASK = 50_000

_SPAN = "array<struct<kind:int,start:bigint,end:bigint>>"
_VALUE = "array<struct<label:string,value:string,start:bigint,end:bigint>>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)
    parts = F.transform(F.sequence(F.lit(1), n), lambda i: F.when(
        i % 2 == 1, F.substring(digits, n - i + 1, F.lit(1)).try_cast("int")).otherwise(
            F.element_at(F.array(*map(F.lit, (0, 2, 4, 6, 8, 1, 3, 5, 7, 9))),
                         F.substring(digits, n - i + 1, F.lit(1)).try_cast("int") + 1)))
    return F.aggregate(parts, F.lit(0), lambda total, x: total + x) % 10 == 0


def is_valid(kind: str, value: Column) -> Column:
    """Whether a match of the kind's pattern counts."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda part: (
            F.length(F.regexp_replace(part, "^0+", "")) <= 3)
            & (F.coalesce(F.regexp_replace(part, "^0+(?=.)", "").try_cast("int"), F.lit(256)) <= 255))
    digits = _digits(value)
    if kind == "card":
        return F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(F.lit(False))
    return F.length(digits).between(8, 15)


def _placed(matches: str, gaps: str, kind: str, add) -> Column:
    """The matches with their places: the lengths of the texts between matches
    give the distances. ``add(match, begin, end)`` gives (whether it counts,
    the element). Matches are taken ``BLOCK`` at a time: the blocks' lengths
    are summed first, then each block from where it begins, so that no array
    of all matches grows step by step."""
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(matches) - 1) / BLOCK).cast("int")), lambda i: F.zip_with(
        F.slice(matches, i * BLOCK + 1, F.lit(BLOCK)),
        F.slice(gaps, i * BLOCK + 1, F.least(F.size(matches) - i * BLOCK, F.lit(BLOCK))),  # one more gap than matches
        lambda m, g: F.struct(m.alias("match"), g.alias("gap"))))
    zero = F.lit(0).cast("long")

    def length(block):
        return F.aggregate(block, zero, lambda n, x: n + x["gap"] + F.char_length(x["match"]))

    begins = F.aggregate(
        blocks, F.struct(zero.alias("at"), F.array().cast("array<bigint>").alias("out")),
        lambda done, block: F.struct((done["at"] + length(block)).alias("at"), F.concat(done["out"], F.array(done["at"])).alias("out")),
        lambda done: done["out"])

    def step(done, x):
        at = done["at"] + x["gap"]
        end = at + F.char_length(x["match"])
        counts, element = add(x["match"], at, end)
        return F.struct(end.alias("at"), F.when(counts, F.concat(done["out"], F.array(element).cast(kind)))
                        .otherwise(done["out"]).alias("out"))

    placed = F.flatten(F.zip_with(blocks, begins, lambda block, at: F.aggregate(
        block, F.struct(at.alias("at"), F.array().cast(kind).alias("out")), step, lambda done: done["out"])))
    return F.when(F.size(matches) > 0, placed).otherwise(F.array().cast(kind))


def _matches(docs: DataFrame, name: str, pattern: str, hint: str) -> DataFrame:
    """Adds the matches and the code points before, between and behind them."""
    has = F.col("text").rlike(hint)
    return docs.withColumns({
        f"m_{name}": F.when(has, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))),
        f"g_{name}": F.when(has, F.transform(F.split("text", pattern, -1), lambda g: F.char_length(g).cast("long")))})


def with_base_spans(docs: DataFrame) -> DataFrame:
    """``docs`` (with ``text``) and the column ``base``: base spans by kind and start."""
    kept = docs.columns
    for kind in KINDS:
        docs = _matches(docs, kind, PATTERNS[kind], HINTS[kind])
    spans = [_placed(f"m_{kind}", f"g_{kind}", _SPAN, lambda m, a, b, i=i, kind=kind: (is_valid(kind, m), F.struct(
        F.lit(i).alias("kind"), a.alias("start"), b.alias("end")))) for i, kind in enumerate(KINDS)]
    return docs.withColumn("base", F.concat(*spans)).select(*kept, "base")


def labelled_values(docs: DataFrame) -> DataFrame:
    """(key, label, value, start, end) of every labelled value of the corpus."""
    found = _matches(docs.filter(F.col("text").rlike("[:=#]")), "v", LABELLED, "[:=#]").filter("size(m_v) > 0")

    def value_of(match, _, end):
        raw = F.regexp_extract(match, LABELLED, 2)
        value = F.regexp_replace(raw, r"[.()/+%_-]+$", "")
        start = end - F.char_length(raw)
        return F.char_length(value) >= 5, F.struct(
            F.lower(F.regexp_extract(match, LABELLED, 1)).alias("label"), value.alias("value"),
            start.alias("start"), (start + F.char_length(value)).alias("end"))

    return found.select("key", F.explode(_placed("m_v", "g_v", _VALUE, value_of)).alias("v")).select("key", "v.*")


def _fits(kind: Column, value: Column, patterns: dict[str, str], check: bool) -> Column:
    """Whether the whole value has the form of the kind (a number)."""
    out = F.lit(False)
    for i, name in enumerate(KINDS):
        whole = value.rlike(f"^(?:{patterns[name]})$")
        out = F.when(kind == i, whole & is_valid(name, value) if check else whole).otherwise(out)
    return out


def bootstrap(values: DataFrame, min_seeds: int = MIN_SEEDS, min_score: float = MIN_SCORE,
              rounds: int = ROUNDS, n_values: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Scored patterns (label, kind, score) and instances (value, kind, score)
    of the graph of labelled values. ``n_values`` tells how many rows
    ``values`` has, if that is known; the steps' tasks are as many as these need."""
    n = values.count() if n_values is None else n_values

    def fewer(df: DataFrame) -> DataFrame:
        return fewer_tasks(df, n, VALUES_OF_TASK)

    graph = keep_on_shared_storage(fewer(values.select("label", "value").distinct()), "label-graph")
    totals = keep_on_shared_storage(fewer(graph.groupBy("label").agg(F.count(F.lit(1)).alias("total"))), "label-totals")
    kinds = F.explode(F.array(*map(F.lit, range(len(KINDS))))).alias("kind")
    seeds = fewer(graph.select("value").distinct()).select("value", kinds) \
        .filter(_fits(F.col("kind"), F.col("value"), PATTERNS, True)).withColumn("score", F.lit(1.0))
    seeds = keep_on_shared_storage(seeds, "seeds")
    instances = seeds
    for _ in range(rounds):
        weights = fewer(fewer(graph.join(instances, "value")).groupBy("label", "kind").agg(
            F.sum("score").alias("weight")).filter(F.col("weight") >= min_seeds))
        patterns = fewer(weights.join(totals, "label")) \
            .select("label", "kind", (F.col("weight") / F.col("total")).alias("score")) \
            .filter(F.col("score") >= min_score)
        patterns = keep_on_shared_storage(patterns, "patterns")
        new = fewer(graph.join(patterns, "label")).filter(_fits(F.col("kind"), F.col("value"), SHAPES, False)) \
            .select("value", "kind", "score")
        instances = fewer(new.union(seeds).groupBy("value", "kind").agg(F.max("score").alias("score")))
        instances = keep_on_shared_storage(instances, "instances")
    return patterns, instances


def _keyed(documents: DataFrame) -> DataFrame:
    """A key of each row's id and text (equal rows share it and their spans)."""
    return documents.withColumn("key", F.struct(F.xxhash64("doc_id", "text").alias("a"),
                                                F.hash("text", "doc_id").alias("b")))


def added_spans(docs: DataFrame) -> DataFrame:
    """(key, added): spans that the bootstrapped patterns find, from keyed
    ``docs``; one row for each key that has some."""
    values = keep_on_shared_storage(labelled_values(docs), "labelled-values")
    n = values.count()
    patterns, instances = bootstrap(values, n_values=n)
    found = fewer_tasks(values.join(patterns.select("label", "kind"), "label"), n, VALUES_OF_TASK)
    found = fewer_tasks(found.join(instances.select("value", "kind"), ["value", "kind"]), n, VALUES_OF_TASK)
    return fewer_tasks(found.groupBy("key").agg(F.collect_set(
        F.struct(F.col("kind").cast("int").alias("kind"), "start", "end")).alias("added")), n, VALUES_OF_TASK)


def with_spans(docs: DataFrame) -> DataFrame:
    """Keyed ``docs`` with ``base`` and ``spans`` (base and added, sorted)."""
    added = keep_on_shared_storage(added_spans(docs), "added-spans")
    n = added.limit(MAX_BROADCAST_SPANS + 1).count()
    found = with_base_spans(docs)
    if not n:
        return found.withColumn("spans", F.array_sort("base"))
    found = found.join(F.broadcast(added) if n <= MAX_BROADCAST_SPANS else added, "key", "left")
    apart = F.filter(F.coalesce("added", F.array().cast(_SPAN)), lambda x: ~F.exists(
        "base", lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])))
    return found.withColumn("spans", F.array_sort(F.concat("base", apart))).drop("added")


def _text_of(spans: str) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _count(kind: int) -> Column:
    return F.size(F.filter("base", lambda span: span["kind"] == kind))


def find_personal_data(documents: DataFrame) -> DataFrame:
    """One row per document: the contract's digest columns."""
    docs = _keyed(documents.select(F.col("doc_id").cast("long").alias("doc_id"),
                                   F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")))
    return with_spans(docs).select(
        "doc_id", *(_count(i).cast("long").alias(f"n_{kind}") for i, kind in enumerate(KINDS)),
        F.sha2(_text_of("base"), 256).alias("base_sha256"), _text_of("spans").alias("spans"))


def redact(documents: DataFrame) -> DataFrame:
    """The documents with every span's text replaced by its kind in capitals
    and brackets; ``n_chars``, if there, follows the new text."""
    row = _keyed(documents.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                                  F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")))
    found = with_spans(row)
    marks = F.array(*(F.lit(f"[{kind.upper()}]") for kind in KINDS))
    ordered = F.array_sort(F.transform("spans", lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    begin = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(done, s):
        before = F.substring("text", (done["at"] + 1).cast("int"),
                             F.greatest(s["start"] - done["at"], F.lit(0)).cast("int"))
        return F.when(s["end"] <= done["at"], done).otherwise(F.struct(
            s["end"].alias("at"), F.concat(done["out"], before, F.element_at(marks, s["kind"] + 1)).alias("out")))

    cut = F.aggregate(ordered, begin, step, lambda d: F.concat(
        d["out"], F.substring("text", (d["at"] + 1).cast("int"), F.length("text"))))
    found = found.withColumn("clean", F.when(F.size("spans") > 0, cut).otherwise(F.col("text")))
    return found.select(*(
        F.when(F.col("row.text").isNotNull(), F.col("clean")).alias(c) if c.lower() == "text"
        else F.when(F.col("row.text").isNotNull(), F.char_length("clean").cast(documents.schema[c].dataType))
        .otherwise(F.col(f"row.`{c}`")).alias(c) if c.lower() == "n_chars"
        else F.col(f"row.`{c}`").alias(c) for c in documents.columns))
