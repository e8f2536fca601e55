"""Main text of web pages by union-free wrapper inference.

The pages of a host share a template. Each page is a balanced stream of block
tags and texts; the host's wrapper is a union-free regular expression found by
aligning the wrapper so far with one page after another: a text that differs
becomes a slot, a run of equal siblings becomes a repeated group, and what one
side lacks becomes optional. Wrappers are folded on the map side, one for each
host and partition, and partial wrappers are aligned in rounds of few each, so
a host with most of all pages never meets in one task.

The wrapper names the container that holds the article (an ``article`` or
``main`` element, else the element with most slot text) and the fixed texts of
the template. A page's main text is what lies in that container, without
boilerplate elements and, outside articles, without fixed texts. Elements are
boilerplate by their tag, or by a class, id or role that says so as a whole
(``sidebar``, ``cookie-notice``, not ``with-sidebar`` or ``form-factor``); such
a name never hides an element that holds the main container. A page that its
host's wrapper gives nothing of (another template) is read by its own.

A wrapper held in a task stays bounded: above ``MAX_NODES`` its optional parts
without a main container are cut out, so that what remains is about the size of
a page, aligning a page takes the same time however many came before, and
partial wrappers are merged ``FAN_IN`` at a time, in rounds. What is cut out is
not lost: its elements and texts are rows, each with its place in the wrapper
(the keys on the way to it, equal siblings told apart by their order), and
Spark merges rows of one place as the wrapper merges nodes: texts that differ,
or that some of the cuts lack, are slots, one that is always there is fixed. A
host with such rows has its template texts and heaviest container from both.

A fixed text belongs to the template if ``TEMPLATE_PAGES`` pages or more of the
host have it; one of a part that fewer pages have is their own.

Every open element of a page is tracked, however deep. Only the wrapper is
flat below ``MAX_DEPTH``: deeper elements are siblings there, known by the path
of that depth and their own name, and what lies in boilerplate is left out.

Defined cases: a null or empty page has the text ''. A null URL, or one
without ``://``, belongs to the host ''. Markup cut off at the end of a page
ends there, and open elements are closed. Repeated rows are extracted one by
one; other columns are ignored. Quotes open an attribute's value only behind
``=``; one that never closes belongs to the attribute's name.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache, reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import emit, keep_on_shared_storage, rows_of
from .url_filter import split_url

#: Wrappers are broadcast only up to this many bytes; larger sets are joined by host.
MAX_WRAPPER_BYTES = 8 << 20
#: Partial wrappers of a host that one task aligns in one round.
FAN_IN = 32
#: Nodes of a wrapper above which its optional parts are kept as rows.
MAX_NODES = 2_000
#: A fixed text counts as template from so many pages of a host on.
TEMPLATE_PAGES = 3
#: Share of the slots' text that the heaviest container holds.
HEAVY = 0.6
#: Depth of a wrapper; deeper elements become siblings in it.
MAX_DEPTH = 48
#: Rows of a table of common orders between those that are kept.
STEP = 256

INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rb rp rt s "
                   "samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title xmp iframe noframes svg math object canvas".split())
#: Elements that an opening tag closes, and where the search for them ends.
IMPLIED_END = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
               "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
               "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
BOILERPLATE_TAGS = frozenset("head nav footer aside form button select menu dialog fieldset audio video header".split())
BOILERPLATE_WORDS = frozenset(
    "ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies disqus footer form header login masthead menu modal nav navbar navigation newsletter notice notices "
    "pager pagination popup privacy promo promoted recommended related replies reply search share sharing sidebar "
    "signup social sponsor sponsored subscribe subscription toolbar widget widgets".split())
#: Parts of a name that say nothing beside a word of boilerplate.
NEUTRAL_WORDS = frozenset("area bar block bottom box btn button buttons col column container content fixed group inner item items "
                          "left link links list outer panel right section site slot sticky top unit wrap wrapper".split())
MAIN_TAGS = frozenset({"article", "main"})
MAIN_WORDS = frozenset({"main"})

_VALUE = r"""(?:"([^"]*+)"|'([^']*+)'|([^\s>"'][^\s>]*+))"""
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?>[\s/]++|=|[^\s/>=]++(?:\s*+=\s*+" + _VALUE.replace("(", "(?:").replace("(?:?:", "(?:")
                  + r")?+)*+)>")
_ATTRIBUTE = re.compile(r"([^\s/>=]++)(?:\s*+=\s*+" + _VALUE + r")?+")
_WORD = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")


@lru_cache(4096)
def _element(tag: str, attributes: str) -> str:
    """The element's name: its tag and its classes, ids and roles, letters only
    in what they are told apart by."""
    names: list[str] = []
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        if name.lower() in ("class", "id", "role"):
            names += ["-".join(_WORD.findall(x)) for x in (a or b or c).lower().split()]
    return ".".join([tag, *dict.fromkeys(x for x in names if x)])


@lru_cache(4096)
def _named_boilerplate(name: str) -> bool:
    """Whether a whole class, id or role says boilerplate."""
    for own in name.split(".")[1:]:
        parts = own.split("-")
        if not BOILERPLATE_WORDS.isdisjoint(parts) and all(p in BOILERPLATE_WORDS or p in NEUTRAL_WORDS for p in parts):
            return True
    return False


def stream(page: str | None) -> Iterator[tuple[str, str]]:
    """Balanced tokens of a page: ("<", name), (">", "") and ("#", text) for
    blocks of text, decoded and with single spaces."""
    open_: list[str] = []  # tags of open block elements
    times: Counter[str] = Counter()  # how often each of them is open
    run: list[str] = []

    def block() -> Iterator[tuple[str, str]]:
        if run:
            text = _SPACE.sub(" ", "".join(run)).strip()
            run.clear()
            if text:
                yield "#", text

    page = page or ""
    at, end = 0, len(page)
    while at < end:
        mark = page.find("<", at)
        if mark < 0:
            run.append(entities.unescape(page[at:]))
            break
        if mark > at:
            run.append(entities.unescape(page[at:mark]))
        after = page[mark + 1:mark + 2]
        if after in ("!", "?"):
            comment = page.startswith("<!--", mark)
            close = page.find("-->" if comment else ">", mark + (4 if comment else 2))
            at = end if close < 0 else close + (3 if comment else 1)
            continue
        found = _TAG.match(page, mark)
        if not found:
            if after == "/" and page[mark + 2:mark + 3].isalpha() or after.isalpha() and after.isascii():
                break  # the page ends inside a tag
            run.append("<")
            at = mark + 1
            continue
        at = found.end()
        closing, tag, attributes = found[1], found[2].lower(), found[3]
        if tag == "br":
            run.append(" ")
            continue
        if tag in VOID:
            if tag == "hr":
                yield from block()
            continue
        if tag in RAW and not closing:
            if not attributes.endswith("/"):
                close = re.compile(rf"</{tag}\b[^>]*(?:>|$)", re.I).search(page, at)
                at = close.end() if close else end
            if tag != "title" and tag not in ("svg", "math", "object", "canvas"):
                yield from block()
            continue
        name = _element(tag, attributes)
        if tag in INLINE and not times[tag] and (closing or not _named_boilerplate(name)):
            continue
        yield from block()
        if closing:
            if times[tag]:
                while open_:
                    yield ">", ""
                    times[open_[-1]] -= 1
                    if open_.pop() == tag:
                        break
            continue
        if tag in IMPLIED_END:
            closes, stop = IMPLIED_END[tag]
            at_ = next((i for i in range(len(open_) - 1, -1, -1) if open_[i] in closes or open_[i] in stop), -1)
            if at_ >= 0 and open_[at_] in closes:
                while len(open_) > at_:
                    times[open_.pop()] -= 1
                    yield ">", ""
        if tag not in INLINE:
            while open_ and (open_[-1] == "p" or open_[-1] in INLINE):
                times[open_.pop()] -= 1
                yield ">", ""
        open_.append(tag)
        times[tag] += 1
        yield "<", name
    yield from block()
    for _ in open_:
        yield ">", ""


# ---- wrappers: a node is [name, optional, repeated, children], a text
# ["#", optional, repeated, [fixed text or None for a slot, characters]] and a
# repeated group of several siblings ["()", optional, True, children].

def page_wrapper(page: str | None) -> list:
    root: list = []
    levels = [root]
    hidden = 0  # open elements from a boilerplate element below MAX_DEPTH on
    for kind, value in stream(page):
        if kind == "<":
            deep = len(levels) > MAX_DEPTH
            if hidden or deep and _is_boilerplate(value):
                hidden += 1
                continue
            node: list = [value, False, False, []]
            levels[MAX_DEPTH if deep else -1].append(node)
            levels.append(node[3])
        elif hidden:
            hidden -= kind == ">"
        elif kind == ">":
            levels[-1][:] = fold(levels[-1])
            levels.pop()
        else:
            levels[-1].append(["#", False, False, [value, len(value)]])
    return fold(root)


def _key(node: list) -> str:
    return node[0] if node[0] != "()" else "(" + " ".join(map(_key, node[3])) + ")"


def merge(a: list, b: list) -> list:
    if a[0] == "#":
        (x, n), (y, m) = a[3], b[3]
        return ["#", a[1] or b[1], a[2] or b[2], [x if x == y else None, n + m]]
    return [a[0], a[1] or b[1], a[2] or b[2], align(a[3], b[3])]


def fold(nodes: list) -> list:
    """Adjacent equal siblings become one repeated group; so do runs of equal
    sequences of up to four siblings."""
    out: list = []
    for node in nodes:
        if out and _key(out[-1]) == _key(node):
            both = merge(out.pop(), node)
            out.append([both[0], both[1], True, both[3]])
        else:
            out.append(node)
    for size in (2, 3, 4):
        at = 0
        while at + 2 * size <= len(out):
            keys = [_key(x) for x in out[at:at + size]]
            stop = at + size
            while [_key(x) for x in out[stop:stop + size]] == keys:
                stop += size
            if stop > at + size:
                body = out[at:at + size]
                for i in range(at + size, stop, size):
                    body = [merge(x, y) for x, y in zip(body, out[i:i + size])]
                out[at:stop] = [["()", False, True, body]]
            at += 1
    return out


def align(a: list, b: list) -> list:
    """One list of siblings that generalises both: equal keys in a longest
    common order are merged, the rest becomes optional."""
    ka, kb = [_key(x) for x in a], [_key(x) for x in b]
    if ka == kb:
        return [merge(x, y) for x, y in zip(a, b)]
    out, i, j = [], 0, 0
    for x, y in _common(ka, kb):
        out += [[n[0], True, n[2], n[3]] for n in (*a[i:x], *b[j:y])]
        out.append(merge(a[x], b[y]))
        i, j = x + 1, y + 1
    out += [[n[0], True, n[2], n[3]] for n in (*a[i:], *b[j:])]
    return fold(out)


def _common(ka: list, kb: list) -> list[tuple[int, int]]:
    """Pairs of a longest common subsequence.

    Rows of the table of lengths (of what follows i and j) are bit vectors, one
    bit for each place of ``kb`` from its end: 0 where the length grows. Every
    ``STEP``-th row is kept, those between are made again when they are needed."""
    n, m = len(ka), len(kb)
    places: dict = {}
    for j, k in enumerate(kb):
        places[k] = places.get(k, 0) | 1 << (m - 1 - j)
    full = (1 << m) - 1

    def before(row: int, key) -> int:
        both = row & places.get(key, 0)
        return (row + both | row - both) & full

    row, kept = full, {n: full}
    for i in range(n - 1, -1, -1):
        row = before(row, ka[i])
        if i % STEP == 0:
            kept[i] = row
    rows: dict[int, int] = {}
    pairs, i, j = [], 0, 0
    while i < n and j < m:
        if ka[i] == kb[j]:
            pairs.append((i, j))
            i, j = i + 1, j + 1
            continue
        if i not in rows or i + 1 not in rows:
            stop = min(n, (i // STEP + 1) * STEP)
            rows = {stop: kept[stop]}
            for x in range(stop - 1, i - 1, -1):
                rows[x] = before(rows[x + 1], ka[x])
        # Lengths after leaving out ka[i], or kb[j].
        down = m - j - (rows[i + 1] & (1 << (m - j)) - 1).bit_count()
        right = m - j - 1 - (rows[i] & (1 << (m - j - 1)) - 1).bit_count()
        if down >= right:
            i += 1
        else:
            j += 1
    return pairs


def expression(nodes: list) -> str:
    """The wrapper as a union-free regular expression (``#`` is a slot)."""
    out = []
    for name, optional, repeated, inner in nodes:
        if name == "#":
            body = "#" if inner[0] is None else entities.escape(inner[0])
        else:
            body = expression(inner) if name == "()" else f"<{name}>{expression(inner)}</{name.split('.')[0]}>"
        out.append(f"({body}){'*' if optional and repeated else '+' if repeated else '?'}"
                   if optional or repeated else body)
    return "".join(out)


def _is_main(name: str) -> bool:
    tag, *names = name.split(".")
    return tag in MAIN_TAGS or not MAIN_WORDS.isdisjoint(names)


def _is_boilerplate(name: str) -> bool:
    return (name.split(".")[0] in BOILERPLATE_TAGS or _named_boilerplate(name)) and not _is_main(name)


def _size(nodes: list) -> int:
    return sum(1 if n[0] == "#" else 1 + _size(n[3]) for n in nodes)


def _has_main(node: list) -> bool:
    return node[0] != "#" and (node[0] != "()" and _is_main(node[0]) or any(map(_has_main, node[3])))


def _text_id(path: str, text: str) -> bytes:
    """A text at a path, as the rows of cut parts and the pages name it."""
    return hashlib.blake2b(f"{path}\0{text}".encode("utf-8", "surrogatepass"), digest_size=16).digest()


def _times(text: str, chars: int) -> int:
    """How often a fixed text was merged."""
    return chars // len(text)


class Cut:
    """What is cut out of a wrapper, as rows (place, leaf, path, text, chars,
    times): one without a leaf for an element, one for each text in it."""

    def __init__(self):
        self.rows: list[tuple] = []

    def take(self, node: list, place: bytes, order: int, path: tuple, boiler: bool) -> None:
        name, optional, _, inner = node
        if name == "#":
            text, chars = inner
            fixed = text is not None and not optional
            at = "/".join(path)
            self.rows.append((place, order, at, _text_id(at, text) if fixed else None, 0 if boiler else chars,
                              _times(text, chars) if fixed else 0))
            return
        place = _below(place, _key(node), order)
        self.rows.append((place, None, None, None, 0, 0))
        if name != "()":
            path, boiler = (*path, name), boiler or _is_boilerplate(name)
        for child, order in _ordered(inner):
            self.take(child, place, order, path, boiler)


def _below(place: bytes, key: str, order: int) -> bytes:
    return hashlib.blake2b(place + f"{order} {key}".encode("utf-8", "surrogatepass"), digest_size=16).digest()


def _ordered(nodes: list) -> Iterator[tuple[list, int]]:
    """Siblings, each with the number of those before it that have its key."""
    before: Counter[str] = Counter()
    for node in nodes:
        key = _key(node)
        yield node, before[key]
        before[key] += 1


def bounded(wrapper: list, most: int = MAX_NODES, cut: Cut | None = None) -> list:
    """The wrapper, without the optional parts that hold no main container if it
    is too large; these go to ``cut``."""
    return _pruned(wrapper, cut or Cut()) if _size(wrapper) > most else wrapper


def _pruned(nodes: list, cut: Cut, place: bytes = b"", path: tuple = (), boiler: bool = False, group: bool = False) -> list:
    out = []
    for node, order in _ordered(nodes):
        name, optional, repeated, inner = node
        if optional and not group and not _has_main(node):  # what a group holds is its key
            cut.take(node, place, order, path, boiler)
        elif name == "#":
            out.append(node)
        else:
            at = _below(place, _key(node), order)
            below = (path, boiler) if name == "()" else ((*path, name), boiler or _is_boilerplate(name))
            out.append([name, optional, repeated, _pruned(inner, cut, at, *below, name == "()")])
    return out


def _measured(nodes: list, pages: int) -> tuple[list[str], dict[str, list[str]], dict[str, int]]:
    """Of a wrapper the paths of its main containers, the template's fixed texts
    by path, and the weight of its slots by path ('' for all)."""
    mains: list[str] = []
    named: list[str] = []  # main containers in elements whose names say boilerplate
    fixed: dict[str, list[str]] = {}
    weights: dict[str, int] = {}

    def walk(nodes: list, path: tuple, boiler: bool, by_name: bool) -> int:
        own = 0
        for name, optional, _, inner in nodes:
            if name == "#":
                if inner[0] is not None and not optional and pages >= TEMPLATE_PAGES and _times(*inner) >= TEMPLATE_PAGES:
                    fixed.setdefault("/".join(path), []).append(inner[0])
                elif not boiler and not by_name:
                    own += inner[1]
            elif name == "()":
                own += walk(inner, path, boiler, by_name)
            else:
                below = (*path, name)
                if _is_main(name) and not boiler:
                    (named if by_name else mains).append("/".join(below))
                tagged = name.split(".")[0] in BOILERPLATE_TAGS and not _is_main(name)
                n = walk(inner, below, boiler or tagged, by_name or _is_boilerplate(name))
                weights["/".join(below)] = weights.get("/".join(below), 0) + n
                own += n
        return own

    weights[""] = walk(nodes, (), False, False)
    return mains or named, fixed, weights


def roles(nodes: list, pages: int, heavy: list[str] | None = None) -> dict:
    """What extraction needs of a wrapper: the paths of its main containers
    and the template's fixed texts by path. ``heavy`` are the paths that hold
    most of the slots' text, if the wrapper alone does not tell."""
    mains, fixed, weights = _measured(nodes, pages)
    if not mains:  # the deepest element that still holds most of the slots' text
        total = weights.pop("")
        heavy = [p for p, n in weights.items() if total and n >= HEAVY * total] if heavy is None else heavy
        mains = [max(heavy, key=lambda p: (p.count("/"), p))] if heavy else [""]
        leaf = mains[0].rpartition("/")[2].split(".")[0]
        if leaf in ("p", "li", "h1", "h2", "h3"):
            mains = [mains[0].rpartition("/")[0]]
    outer = [p for p in mains if not any(p != q and p.startswith(q + "/") for q in mains)]
    return {"mains": sorted(set(outer)), "fixed": fixed}


def _place(path: list[str]) -> str:
    """The path of an element in the wrapper."""
    return "/".join(path if len(path) <= MAX_DEPTH else [*path[:MAX_DEPTH], path[-1]])


def blocks(page: str | None, known: dict) -> Iterator[tuple[str | None, str]]:
    """Texts of a page that are in its main container and no boilerplate, with
    the path of those outside articles, which the template may hold."""
    mains = known["mains"]
    path: list[str] = []
    boiler: list[bool] = []
    inside: list[bool] = []
    article: list[bool] = []
    all_in = mains == [""]
    holders = {m[:i] for m in mains for i in range(len(m) + 1) if i == len(m) or m[i] == "/"}
    for kind, value in stream(page):
        if kind == "<":
            path.append(value)
            in_article = bool(article and article[-1]) or value.split(".")[0] == "article"
            article.append(in_article)
            inside.append(bool(inside and inside[-1]) or _place(path) in mains)
            header = value.split(".")[0] == "header" and article[-1] and len(article) > 1
            boiler.append(bool(boiler and boiler[-1]) or _is_boilerplate(value) and not header and _place(path) not in holders)
        elif kind == ">":
            for held in (path, boiler, inside, article):
                held.pop()
        elif not (boiler and boiler[-1]) and (all_in or inside and inside[-1]):
            yield None if article and article[-1] else _place(path), value


def extract(page: str | None, known: dict, template: frozenset = frozenset()) -> str:
    """The main text of one page, given its host's roles, and which of its texts
    are the template's by the rows of cut parts."""
    fixed = known["fixed"]
    return "\n".join(value for place, value in blocks(page, known) if place is None or value not in fixed.get(place, ())
                     and not (template and _text_id(place, value) in template))


def main_text(page: str | None, known: dict, template: frozenset = frozenset()) -> str:
    """The main text by the host's roles; by the page's own where these give nothing."""
    text = extract(page, known, template) if page else ""
    return text or (extract(page, roles(page_wrapper(page), 1)) if page else "")


_CUT = [("place", pa.binary()), ("leaf", pa.int32()), ("path", pa.string()), ("text", pa.binary()), ("chars", pa.int64()),
        ("times", pa.int64())]
_PARTIAL = pa.schema([("host", pa.string()), ("salt", pa.int32()), ("pages", pa.int64()), ("wrapper", pa.string()), *_CUT])
_PARTIAL_DDL = ("host string, salt int, pages long, wrapper string, "
                "place binary, leaf int, path string, text binary, chars long, times long")
_NO_CUT = (None,) * len(_CUT)


def _written(host: str | None, salt: int, pages: int, wrapper: list) -> tuple:
    return host, salt, pages, json.dumps(wrapper, ensure_ascii=False), *_NO_CUT


def _given(host: str | None, cut: Cut) -> Iterator[tuple]:
    """The rows of what was cut out of a host's wrapper so far."""
    rows, cut.rows = cut.rows, []
    for row in rows:
        yield host, None, None, None, *row


def _merged(table: pa.Table, max_nodes: int = MAX_NODES) -> pa.Table:
    """The partial wrappers of one group as one, and what was cut out of it."""
    wrapper, cut = None, Cut()
    for text in table.column("wrapper"):
        other = json.loads(text.as_py())
        wrapper = other if wrapper is None else bounded(align(wrapper, other), max_nodes, cut)
    host, salt = table.column("host")[0].as_py(), table.column("salt")[0].as_py()
    rows = [_written(host, salt, sum(table.column("pages").to_pylist()), wrapper), *_given(host, cut)]
    return pa.Table.from_batches(emit(iter(rows), _PARTIAL), _PARTIAL)


def infer_wrappers(pages: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """(host, pages, wrapper) for every host; the wrapper as JSON, without the
    parts that were cut out of it."""
    return _inferred(pages, fan_in)[0].select("host", "pages", "wrapper")


def _inferred(pages: DataFrame, fan_in: int = FAN_IN, max_nodes: int = MAX_NODES) -> tuple[DataFrame, DataFrame | None]:
    """The wrappers (host, pages, wrapper, is_cut) and the rows of all that was
    cut out of them, if any was."""
    def merged(table: pa.Table) -> pa.Table:
        return _merged(table, max_nodes)

    def partial(batches):
        from pyspark import TaskContext

        salt = TaskContext.get().partitionId()
        held: dict[str, tuple[int, list]] = {}
        cut = Cut()

        def rows():
            for url, page in rows_of(batches, ["url", "html"]):
                host, own = split_url(url)[0], page_wrapper(page)
                if host in held:
                    n, wrapper = held[host]
                    held[host] = (n + 1, bounded(align(wrapper, own), max_nodes, cut))
                    yield from _given(host, cut)
                else:
                    held[host] = (1, own)
                if len(held) > 2000:  # many hosts: give out what there is, it is merged later
                    yield from given()
                    held.clear()
            yield from given()

        def given():
            for host, (n, wrapper) in held.items():
                yield _written(host, salt, n, wrapper)

        yield from emit(rows(), _PARTIAL, 256)

    def trimmed(batches):
        """Wrappers of hosts with cut parts lose all such parts: one place, one way."""
        def rows():
            for host, n, text in rows_of(batches, ["host", "pages", "wrapper"]):
                cut = Cut()
                yield _written(host, 0, n, _pruned(json.loads(text), cut))
                yield from _given(host, cut)

        yield from emit(rows(), _PARTIAL, 256)

    def split(rows: DataFrame) -> DataFrame:
        cuts.append(rows.filter("wrapper is null"))
        return rows.filter("wrapper is not null")

    cuts: list[DataFrame] = []
    parts = split(keep_on_shared_storage(pages.mapInArrow(partial, _PARTIAL_DDL), "partial-wrappers"))
    most = parts.agg(F.max("salt")).first()[0] or 0
    parts = split(keep_on_shared_storage(parts.groupBy("host", "salt").applyInArrow(merged, _PARTIAL_DDL), "partial-wrappers"))
    while most:  # a round for each power of the fan-in
        most //= fan_in
        parts = parts.withColumn("salt", F.floor(F.col("salt") / fan_in).cast("int")) \
            .groupBy("host", "salt").applyInArrow(merged, _PARTIAL_DDL)
        parts = split(keep_on_shared_storage(parts, "partial-wrappers"))
    rows = reduce(DataFrame.unionAll, cuts)
    if rows.isEmpty():
        return parts.select("host", "pages", "wrapper", F.lit(False).alias("is_cut")), None
    hosts = rows.select("host").distinct()
    last = keep_on_shared_storage(parts.join(hosts, "host", "left_semi").mapInArrow(trimmed, _PARTIAL_DDL), "cut-wrappers")
    whole = parts.join(hosts, "host", "left_anti").select("host", "pages", "wrapper", F.lit(False).alias("is_cut"))
    wrappers = whole.unionAll(last.filter("wrapper is not null").select("host", "pages", "wrapper", F.lit(True).alias("is_cut")))
    return wrappers, rows.unionAll(last.filter("wrapper is null"))


def _told_by_cuts(cuts: DataFrame, wrappers: DataFrame) -> DataFrame:
    """(host, path, text, chars) for every text of the cut parts: the id of a
    template's text, or NULL and the weight of a slot."""
    leaves = cuts.filter("leaf is not null").groupBy("host", "place", "leaf").agg(
        F.min("path").alias("path"), F.min("text").alias("text"), F.max("text").alias("other"), F.count("text").alias("fixed"),
        F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars"), F.sum("times").alias("times"))
    elements = cuts.filter("leaf is null").groupBy("host", "place").agg(F.count(F.lit(1)).alias("whole"))
    always = (F.col("text") == F.col("other")) & (F.col("fixed") == F.col("n")) & (F.col("n") == F.col("whole"))
    return leaves.join(elements, ["host", "place"], "left").join(wrappers.select("host", "pages"), "host") \
        .select("host", "path", F.when(always & (F.least("times", "pages") >= TEMPLATE_PAGES), F.col("text")).alias("text"), "chars")


def _heavy_paths(wrappers: DataFrame, told: DataFrame) -> DataFrame:
    """(host, heavy): the paths that hold most of the text of slots, for hosts
    with cut parts and no main container."""
    schema = pa.schema([("host", pa.string()), ("path", pa.string()), ("chars", pa.int64())])

    def weights(batches):
        def rows():
            for host, n, wrapper in rows_of(batches, ["host", "pages", "wrapper"]):
                mains, _, found = _measured(json.loads(wrapper), n)
                if not mains:
                    for path, chars in found.items():
                        yield host, path, chars

        yield from emit(rows(), schema)

    own = wrappers.filter("is_cut").mapInArrow(weights, "host string, path string, chars long")
    names = F.split("path", "/")
    above = F.transform(F.sequence(F.lit(0), F.when(F.col("path") == "", 0).otherwise(F.size(names))),
                        lambda i: F.array_join(F.slice(names, F.lit(1), i), "/"))
    slots = told.filter("text is null").groupBy("host", "path").agg(F.sum("chars").alias("chars"))
    slots = slots.join(own.select("host").distinct(), "host", "left_semi").select("host", F.explode(above).alias("path"), "chars")
    sums = own.unionAll(slots).groupBy("host", "path").agg(F.sum("chars").alias("chars"))
    total = sums.filter("path = ''").select("host", F.col("chars").alias("total"))
    heavy = (F.col("path") != "") & (F.col("total") > 0) & (F.col("chars") >= F.col("total") * F.lit(HEAVY))
    return total.select("host").join(sums.join(total, "host").filter(heavy), "host", "left") \
        .groupBy("host").agg(F.collect_list("path").alias("heavy"))


def _roles_frame(wrappers: DataFrame) -> DataFrame:
    def run(batches):
        schema = pa.schema([("host", pa.string()), ("roles", pa.string())])

        def rows():
            for host, n, wrapper, heavy in rows_of(batches, ["host", "pages", "wrapper", "heavy"]):
                yield host, json.dumps(roles(json.loads(wrapper), n, heavy), ensure_ascii=False)

        yield from emit(rows(), schema)

    return wrappers.mapInArrow(run, "host string, roles string")


def _template_texts(pages: DataFrame, told: DataFrame) -> DataFrame:
    """(host, digest, template): the texts of every page that are the template's
    by the rows of cut parts. ``pages`` has host, digest, html and roles."""
    schema = pa.schema([("host", pa.string()), ("digest", pa.string()), ("text", pa.binary())])
    known = told.filter("text is not null").select("host", "text").distinct()

    def texts(batches):
        load = lru_cache(1024)(json.loads)

        def rows():
            for host, digest, page, held in rows_of(batches, ["host", "digest", "html", "roles"]):
                for text in {_text_id(place, value) for place, value in blocks(page, load(held)) if place is not None}:
                    yield host, digest, text

        yield from emit(rows(), schema)

    found = pages.join(known.select("host").distinct(), "host", "left_semi").filter("html is not null and roles is not null") \
        .mapInArrow(texts, "host string, digest string, text binary").distinct()
    return found.join(known, ["host", "text"], "left_semi").groupBy("host", "digest").agg(F.collect_list("text").alias("template"))


_RESULT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def extract_main_text(pages: DataFrame, max_wrapper_bytes: int = MAX_WRAPPER_BYTES, max_nodes: int = MAX_NODES) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages``."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                         F.col("html").cast("string").alias("html"))
    wrappers, cuts = _inferred(pages, max_nodes=max_nodes)
    if cuts is None:
        wrappers = wrappers.withColumn("heavy", F.lit(None).cast("array<string>"))
    else:
        told = keep_on_shared_storage(_told_by_cuts(cuts, wrappers), "cut-parts")
        wrappers = wrappers.join(_heavy_paths(wrappers, told), "host", "left")
    known = keep_on_shared_storage(_roles_frame(wrappers), "wrappers")
    size = known.agg(F.sum(F.octet_length("host") + F.octet_length("roles"))).first()[0] or 0
    if size <= max_wrapper_bytes:
        known = F.broadcast(known)
    host = F.coalesce(F.translate(F.regexp_extract("url", "^(?s).*?://([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                                  "abcdefghijklmnopqrstuvwxyz"), F.lit(""))
    joined = pages.withColumn("host", host).join(known, "host", "left")
    if cuts is None:
        joined = joined.withColumn("template", F.lit(None).cast("array<binary>"))
    else:
        joined = joined.withColumn("digest", F.sha2("html", 256))
        joined = joined.join(_template_texts(joined, told), ["host", "digest"], "left")

    def run(batches):
        load = lru_cache(1024)(json.loads)
        nothing = {"mains": [""], "fixed": {}}

        def rows():
            for page_id, url, page, told, template in rows_of(batches, ["page_id", "url", "html", "roles", "template"]):
                text = main_text(page, load(told) if told else nothing, frozenset(template or ()))
                yield page_id, url, text, len(text)

        yield from emit(rows(), _RESULT, 512)

    return joined.select("page_id", "url", "html", "roles", "template") \
        .mapInArrow(run, "page_id long, url string, text string, n_chars long")
