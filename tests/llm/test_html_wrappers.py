import html
import random
import re

from stratum.llm.html_wrappers import (MAX_NODES, Cut, _common, _size, align, bounded, expression, extract, extract_main_text, infer_wrappers,
                                       main_text, page_wrapper, roles)

from ..conftest import SF_SMALL


def brute(page):
    """Main text of the test tables' pages, whose article holds h1 and p only."""
    inner = re.search(r"<article>(.*?)(</article>|$)", page, re.S)[1]
    inner = re.sub(r"<[a-zA-Z/][^>]*$", "", inner)
    parts = re.split(r"</?(?:p|h1)>", inner)
    parts = [re.sub(r"\s+", " ", html.unescape(re.sub(r"</?b>", "", x).replace("<br>", " "))).strip() for x in parts]
    return "\n".join(x for x in parts if x)


def test_articles_of_the_test_table(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    want = {r.page_id: (r.url, brute(r.html)) for r in pages.collect()}
    got = {r.page_id: (r.url, r.text) for r in extract_main_text(pages).collect()}
    assert got == want
    assert {r.page_id: r.text for r in extract_main_text(pages, max_wrapper_bytes=0).collect()} == {
        i: t for i, (_, t) in want.items()}


def test_wrappers_generalise_pages():
    a = page_wrapper("<div><h1>A</h1><p>x</p><i>.</i></div><div class=ad>Buy</div>")
    b = page_wrapper("<div><h1>B</h1><p>x<p>y</p><p>z</div>")
    assert expression(align(a, b)) == "<div><h1>#</h1>(<p>#</p>)+(.)?</div>(<div.ad>Buy</div>)?"


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="<p>no</p>";</script></head><body>
<header>Site</header><nav><ul><li>Home<li>About</ul></nav><div class="cookie-notice">We use cookies</div>
<main><article><header><h1>Head&nbsp;%d</h1></header><p>First &amp; &#x41; <b>bold</b>  text<br>line<p>Second
&lt;x&gt;<!-- hidden --></p><aside>Side</aside><div class="ad banner">Ad</div>
<form><input value=a>Mail<button>Go</button></form><ul><li>one<li>two</ul></article>
<div id="comments"><p>Reader says</p></div></main><footer>(c)</footer></body></html>"""


def test_boilerplate_and_malformed_pages(spark):
    cut = PAGE[:PAGE.index("Second") + 10]
    pages = [(i, f"http://h/{i}", PAGE % i) for i in range(3)]
    pages += [(10, None, None), (11, "http://h/x", ""), (12, "nope", "plain & text < 3"), (13, "http://h/y", cut % 13 + "<p cla"),
              (14, "http://h/z", "<div " * 3000), (15, "http://q/z", "<div>" * 3000 + "deep" + "</div>" * 3000), (0, "http://h/0", PAGE % 0)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "'x' as text", "'y' as host")
    got = extract_main_text(frame).collect()
    assert len(got) == len(pages)
    texts = {r.page_id: r.text for r in got}
    assert texts[1] == "Head 1\nFirst & A bold text line\nSecond <x>\none\ntwo"
    assert (texts[10], texts[11], texts[12], texts[14], texts[15]) == ("", "", "plain & text < 3", "", "deep")
    assert texts[13] == "Head 13\nFirst & A bold text line\nSecond <"
    assert all(r.n_chars == len(r.text) for r in got)
    assert extract_main_text(frame.limit(0)).count() == 0


def test_pages_without_article_use_the_heaviest_container_and_drop_fixed_text(spark):
    page = "<body><div class=top>Same everywhere</div><div class=body><p>{0} one {0}</p><p>{0} two</p><p>Share this</p></div></body>"
    pages = [(i, "http://n/", page.format("word%d " % i * 20)) for i in range(4)]
    got = extract_main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    for r in got:
        w = ("word%d " % r.page_id * 20).strip()
        assert r.text == f"{w} one {w}\n{w} two\nShare this"
    assert roles([], 0) == {"mains": [""], "fixed": {}}


def test_text_behind_a_deep_nest_stays_in_the_article(spark):
    def nest(inner, n=60):
        return "<div>" * n + inner + "</div>" * n

    page = "<html><body><div><article><p>before {0}</p>" + nest("deep {0}<nav>Menu</nav><ul class=comments><li>Reader</ul>end {0}") \
        + "<p>after {0}</p></article><p>outside {0}</p></div></body></html>"
    far = "<html><body>" + nest("<div class=sidebar><div><p>Links</p></div></div><article><h1>Head {0}</h1><p>far {0}</p></article><p>Foot</p>") \
        + "<p>outside {0}</p></body></html>"
    pages = [(i, "http://a/", page.format(i)) for i in range(4)] + [(10 + i, "http://b/", far.format(i)) for i in range(4)]
    got = extract_main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    want = {i: f"before {i}\ndeep {i}\nend {i}\nafter {i}" for i in range(4)} | {10 + i: f"Head {i}\nfar {i}" for i in range(4)}
    assert {r.page_id: r.text for r in got} == want
    assert extract("<div>" * 100_000 + "deep" + "</div>" * 100_000 + "<p>end", {"mains": [""], "fixed": {}}) == "deep\nend"


def longest_common(ka, kb):
    """The plain table, and the same choice among orders of equal length."""
    best = [[0] * (len(kb) + 1) for _ in range(len(ka) + 1)]
    for i in range(len(ka) - 1, -1, -1):
        for j in range(len(kb) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if ka[i] == kb[j] else max(best[i + 1][j], best[i][j + 1])
    pairs, i, j = [], 0, 0
    while i < len(ka) and j < len(kb):
        if ka[i] == kb[j]:
            pairs.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return pairs


def test_siblings_align_in_a_longest_common_order_at_every_size():
    rnd = random.Random(3)
    for n, m, keys in [(0, 5, 2), (5, 0, 2), (1, 1, 1), *((rnd.randrange(1, 40), rnd.randrange(1, 40), k) for k in (2, 3, 8, 30) for _ in range(50)),
                       (700, 600, 5), (520, 900, 300)]:
        ka, kb = ([f"k{rnd.randrange(keys)}" for _ in range(x)] for x in (n, m))
        assert _common(ka, kb) == longest_common(ka, kb)
    late = [f"k{i}" for i in range(5000)]
    assert len(_common([late[-1], *late[:-1]], late)) == 4999


def alone(page):
    return main_text(page, roles(page_wrapper(page), 1))


def test_names_that_hold_a_word_of_boilerplate_do_not_hide_text():
    assert alone('<body class="search"><article><p>Text</p></article></body>') == "Text"
    assert alone('<div class="content with-sidebar"><article>A<p class="form-factor">B<p id="search-results">C'
                 '<div class="related-work">D</div><figure><img><figcaption>E</figcaption></figure></article></div>') == "A\nB\nC\nD\nE"
    assert alone('<div class="sidebar"><article>Only one</article></div>') == "Only one"
    assert alone('<div class="related-links"><article>Teaser</article></div><article>Story<div class="ad-box">Buy</div>'
                 '<div id="comments"><p>Me too</p></div><p class="share-buttons">Tweet</p>end</article>') == "Story\nend"


def test_attributes_follow_the_tokenizer():
    assert alone("<p title=it's>one</p><p>two's</p>") == "one\ntwo's"
    assert alone("<p a'b=1>one</p><p x='>' y=\">\" z = >two</p><p ='>three</p><div / class=x/>four</div>") == "one\ntwo\nthree\nfour"
    assert alone('<p title="never closed>one</p><p>two</p>') == "one\ntwo"
    assert alone("<article data-a='\"' class=main><p CLASS = 'lead'>x</article>") == "x"
    assert alone("<p " + "a='" * 20000) == ""  # and in linear time


def test_a_host_of_two_templates_and_one_of_varied_pages(spark):
    rnd = random.Random(1)
    word = lambda: "".join(rnd.choice("abcdefghijklmnop") for _ in range(6))
    one = "<body><div class=top>Top</div><article><h1>{0}</h1><p>text {0}</p></article></body>"
    other = "<body class=search><div class=sidebar><main><p>found {0}</p></main></div></body>"
    varied = lambda i: "<body><article>" + "".join(f"<div class={word()}><p>t{i} {j}</p></div>" for j in range(30)) + "</article></body>"
    pages = [(i, "http://two/", (one if i % 3 else other).format(i)) for i in range(60)]
    pages += [(100 + i, "http://varied/", varied(i)) for i in range(300)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(9)
    got = {r.page_id: r.text for r in extract_main_text(frame).collect()}
    assert got == {i: f"{i}\ntext {i}" if i % 3 else f"found {i}" for i in range(60)} | {
        100 + i: "\n".join(f"t{i} {j}" for j in range(30)) for i in range(300)}
    found = infer_wrappers(frame, fan_in=2).collect()
    assert sorted((r.host, r.pages) for r in found) == [("two", 60), ("varied", 300)]
    assert all(len(r.wrapper) < 60 * MAX_NODES for r in found)


def test_a_wrapper_stays_bounded_and_keeps_its_main_container():
    wrapper = page_wrapper("<div><article><p>a</p></article></div>")
    for i in range(400):
        extra = "".join(f"<section class={'abcdefghij'[k]}{'klmnopqrst'[i % 10]}{'uvwxyzabcd'[i // 10 % 10]}>text {i}</section>" for k in range(10))
        wrapper = bounded(align(wrapper, page_wrapper(f"<div>{extra}<article><p>a{i}</p></article></div>")), 100)
        assert _size(wrapper) <= 130
    assert roles(wrapper, 401)["mains"] == ["div/article"]


def letters(rnd):
    return "".join(rnd.choice("abcdefghijklmnop") for _ in range(6))


def test_parts_cut_out_of_a_wrapper_still_tell_the_template(spark):
    """A text of a part that most pages have is the template's, one of a part of
    its own page is not, whether the wrapper holds them or not."""
    rnd = random.Random(5)
    own = {i: [(letters(rnd), f"t{i} {j}") for j in range(8)] for i in range(120)}
    note = "<div class=note><h3>Read this first</h3><p>seen {0}</p></div>"

    def page(i, main):
        parts = "".join(f"<div class={c}><p>{t}</p></div>" for c, t in own[i])
        return f"<body><div class=top>Top</div>{main[0]}<h1>Head {i}</h1>{note.format(i) if i % 4 else ''}{parts}<p>end {i}</p>{main[1]}</body>"

    mains = {"named": ("<main>", "</main>"), "heavy": ("<div class=body>", "</div>")}
    pages = [(100 * k + i, f"http://{host}/{i}", page(i, main)) for k, (host, main) in enumerate(mains.items(), 0) for i in range(100)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(6)
    want = {100 * k + i: "\n".join([f"Head {i}", *([f"seen {i}"] if i % 4 else []), *(t for _, t in own[i]), f"end {i}"])
            for k in range(2) for i in range(100)}
    for most in (60, 300, 1_000_000):
        got = {r.page_id: r.text for r in extract_main_text(frame, max_nodes=most).collect()}
        assert got == want, most


def test_a_container_is_found_by_the_weight_of_cut_parts(spark):
    rnd = random.Random(6)
    page = "<body><div class=links><p>a {0}</p></div><div class=body>{1}</div></body>"
    pages = [(i, "http://c/", page.format(i, "".join(f"<div class={letters(rnd)}><div><p>long text {i} {j}</p></div></div>" for j in range(9))))
             for i in range(80)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(4)
    for most in (40, 1_000_000):
        got = {r.page_id: r.text for r in extract_main_text(frame, max_nodes=most).collect()}
        assert got == {i: "\n".join(f"long text {i} {j}" for j in range(9)) for i in range(80)}, most


def test_cut_parts_merge_as_nodes_do():
    """Equal texts stay fixed, others and those that a cut lacks become slots."""
    def cut(part):
        rows = Cut()
        wrapper = align(page_wrapper(f"<main><p>x</p>{part}</main>"), page_wrapper("<main><p>x</p></main>"))
        assert expression(bounded(wrapper, 1, rows)) == "<main><p>x</p></main>"
        return rows.rows

    one, other = cut("<div class=k><p>same</p><i>one</i></div>"), cut("<div class=k><p>same</p><i>two</i></div>")
    assert [r[:3] for r in one] == [r[:3] for r in other] and len(one) == 4
    assert [r[3] == s[3] for r, s in zip(one, other) if r[3]] == [True, False]
    assert {r[2]: r[4] for r in one if r[2]} == {"main/div.k/p": 4, "main/div.k": 3}
    assert sum(r[4] for r in cut("<div class=sidebar><p>links</p></div>")) == 0  # boilerplate weighs nothing
