"""Operator 9: tree matching by exhaustion, templates, the articles of real pages."""

import html
import itertools
import re
import time

import pytest
from pyspark.sql import functions as F

from starload.llm import dom, wrapper
from tests.llm import helpers as h


def lists(a, b):
    """Size of the best ordered pairing, by trying all."""
    best = 0
    for n in range(min(len(a), len(b)) + 1):
        for x in itertools.combinations(range(len(a)), n):
            for y in itertools.combinations(range(len(b)), n):
                if all(a[i][0] == b[j][0] for i, j in zip(x, y, strict=True)):
                    best = max(best, sum(1 + lists(a[i][1], b[j][1]) for i, j in zip(x, y, strict=True)))
    return best


def t(label, *children):
    return (label, list(children))


def test_simple_tree_matching():
    a = [t("h1"), t("div", t("p"), t("ul", t("li"))), t("p"), t("div", t("p"))]
    b = [t("div", t("ul", t("li"), t("p"))), t("h1"), t("p"), t("div"), t("div", t("p"), t("ul"))]
    for x, y in itertools.product([a, b, a[1:], b[:3], []], repeat=2):
        size, pairs = wrapper.matching(x, y)
        assert size == lists(x, y) and pairs == sorted(pairs)
        assert sum(wrapper.tree_match(x[i], y[j]) for i, j in pairs) == size
    assert wrapper.tree_match(t("p"), t("div")) == 0


def test_alignment_maps_partners_to_one_slot():
    ref = t("body", t("nav"), t("div", t("h1"), t("p")), t("footer"))
    other = t("body", t("header"), t("nav"), t("div", t("p"), t("table")), t("aside"))
    got = wrapper.aligned(other, ref)
    assert got["/nav.0"] == "/nav.0" and got["/div.0/p.0"] == "/div.0/p.0"
    assert got["/header.0"] == "/+header.0" and got["/div.0/table.0"] == "/div.0/+table.0"


def text_of(page):
    with wrapper.deep_trees():
        root = wrapper.straight(dom.parse(page))
        return [x[1] for x in wrapper.readable(wrapper.texts_of(root, wrapper.skeleton(root)))]


@pytest.mark.parametrize(
    "page, want",
    [
        ("<p>a<p>b</p>c", ["a", "b", "c"]),
        ("<p>x<b>y</b> z<br>w &amp; &lt; &#233;&eacute; &copy</p>", ["xy z w & < éé ©"]),
        ("<script>if (a < b) '</p>'</script><style>p{}</style><p>t</p><!-- <p>no</p> -->", ["t"]),
        ("<div>a<div>b</div>c</div>", ["a", "b", "c"]),
        ("<ul><li>a<li>b</ul><table><tr><td>1<td>2<tr><td>3</table>", ["a", "b", "1", "2", "3"]),
        ("<nav>n</nav><div class='sidebar-left'>s</div><div class=ad>x</div><div class='comments'>c</div><form>f</form><p>k</p>", ["k"]),
        ("<p>unclosed <a title=\"5 > 4\" href=x>link", ["unclosed link"]),
        ("<p>broken <a href=\"x", ["broken"]),
        ("a < b and <3", ["a < b and <3"]),
        ("", []),
        ("</p></div>", []),
        ("<p> \n\t </p><p> a  b </p>", ["a b"]),
        ("<article><header><h1>T</h1></header><p>x</p><footer>f</footer></article>", ["T", "x"]),
        ("<div>" * 3000 + "deep" + "</div>" * 3000, ["deep"]),
        ("<p>" + "<" * 5000 + "</p>", ["<" * 5000]),
        ("<div>" * 400 + "<nav>menu</nav><p>text" + "</div>" * 400, ["text"]),
        ("<div><section>" * 400 + "<nav>menu</nav><p>text", ["text"]),
        ("<nav class=top/>Menu</nav><p>see <a href=http://x.com/>link</a></p>", ["see link"]),
        ('<div class="page sidebar-right"><p>Article text here.</p></div>', ["Article text here."]),
        ("<div class='layout-sidebar-left'><p>One.</p><div class='sidebar'>s</div></div>", ["One."]),
        ("<div class='search-results-page'><p>Found words.</p></div>", ["Found words."]),
        ("<div id='social-history'><h2>Old</h2><p>Long ago there was.</p></div><div class=share>Share</div>", ["Old", "Long ago there was."]),
        ("<p>Short.</p><div class='comments'><p>A very long comment of a reader, longer than the text.</p></div>", ["Short."]),
    ],
)
def test_blocks(page, want):
    assert text_of(page) == want


def expected(page):
    a = re.search(r"<article>(.*?)(?:</article>|\Z)", page, re.S)[1]
    a = re.sub(r"<[^>]+>", "", re.sub(r"</?(p|h1|li|ul)[^>]*>|<br>", " ", a))
    return " ".join(html.unescape(a).split())


def test_pages(spark):
    pages = h.pages(spark)
    got = {r.page_id: r for r in wrapper.main_texts(pages).collect()}
    given = pages.collect()
    assert len(got) == len(given)
    for r in given:
        assert got[r.page_id].text == expected(r.html)
        assert (got[r.page_id].url, got[r.page_id].n_chars) == (r.url, len(got[r.page_id].text))


def site(spark, pages):
    return spark.createDataFrame([(i, u, p) for i, (u, p) in enumerate(pages)], "page_id long, url string, html string")


def test_constant_slots_are_template(spark):
    """No element here names itself as chrome: only the comparison of pages tells."""
    page = lambda i: f"<body><div id=top>Our daily site</div><div id=x><h2>Title {i}</h2><p>Body {i}.</p><p>More {i}.</p></div><div id=end>All rights</div></body>"
    got = wrapper.main_texts(site(spark, [(f"http://a.example/{i}", page(i)) for i in range(5)] + [("http://b.example/1", page(9))]))
    by = {r.page_id: r.text for r in got.collect()}
    assert by == {**{i: f"Title {i} Body {i}. More {i}." for i in range(5)}, 5: "Our daily site Title 9 Body 9. More 9. All rights"}


def test_templates_hold_across_different_skeletons(spark):
    """A slot that stands elsewhere on some pages is found by alignment."""
    page = lambda i: "<body>" + ("<section>Extra %d</section>" % i if i % 2 else "") + f"<div id=top>Same words</div><div id=x><p>Text {i}</p></div></body>"
    by = {r.page_id: r.text for r in wrapper.main_texts(site(spark, [(f"//a.example/{i}", page(i)) for i in range(6)])).collect()}
    assert by == {i: (f"Extra {i} " if i % 2 else "") + f"Text {i}" for i in range(6)}


def test_copies_of_one_article_stay(spark):
    page = lambda i: f"<nav>n{i}</nav><article><h1>Same</h1><p>One text.</p></article><footer>f{i}</footer>"
    near = lambda i: f"<article><h1>Same</h1><p>One text, edit {i}.</p></article>"
    got = wrapper.main_texts(site(spark, [("http://c.example/", page(i)) for i in range(4)] + [("http://d.example/", near(i)) for i in range(4)]))
    by = {r.page_id: r.text for r in got.collect()}
    assert by == {**dict.fromkeys(range(4), "Same One text."), **{4 + i: f"Same One text, edit {i}." for i in range(4)}}


def test_marks_that_name_no_chrome(spark):
    around = "<div class='content-with-sidebar'><p>Text {0}</p></div>"
    has = "<body><div id=page class='has-sidebar no-menu'><p>Text {0}</p><div class='sidebar-left'>s{0}</div></div></body>"
    holds = "<div class='menu-page'><main><p>Text {0}</p></main></div>"
    within = "<article><p>Text {0}</p><section id=related-work><p>Work {0}</p></section><section id=discussion><p>Talk {0}</p></section>"
    within += "<div class=comments>c{0}</div><div class=related><a href=x>Link {0}</a></div><div class=notice>Same</div></article>"
    sites = [around, has, holds, within]
    pages = [(f"//h{k}.example/{i}", s.format(i)) for k, s in enumerate(sites) for i in range(5)]
    by = {r.page_id: r.text for r in wrapper.main_texts(site(spark, pages)).collect()}
    assert by == {5 * k + i: f"Text {i}" + (f" Work {i} Talk {i}" if k == 3 else "") for k in range(4) for i in range(5)}


def test_like_siblings_are_judged_block_by_block(spark):
    page = lambda i: f"<body><div>Site name</div><div>Article {i}</div><div>All rights reserved</div></body>"
    by = {r.page_id: r.text for r in wrapper.main_texts(site(spark, [(f"//a.example/{i}", page(i)) for i in range(6)])).collect()}
    assert by == {i: f"Article {i}" for i in range(6)}


def test_each_layout_has_its_own_template(spark):
    """Three layouts on one host, none on half of its pages."""
    tops = ["<div id=news>News of the day</div>", "<section id=shop>Our shop</section>", "<ul id=forum><li>Forum rules</li></ul>"]
    pages = [(f"//a.example/{i}", f"<body>{tops[i % 3]}<div id=x><p>Text number {i} is here</p></div></body>") for i in range(15)]
    by = {r.page_id: r.text for r in wrapper.main_texts(site(spark, pages)).collect()}
    assert by == {i: f"Text number {i} is here" for i in range(15)}


def test_pages_without_main_elements(spark):
    """The given pages with article made div, class and id removed: the wrapper alone decides."""
    pages = spark.read.parquet(f"{h.SF01}/pages.parquet")
    bare = pages.withColumn("html", F.regexp_replace(F.regexp_replace("html", "(</?)article", "$1div"), r"<(\w+) (class|id)=[^>]*>", "<$1>"))
    got = {r.page_id: r.text for r in wrapper.main_texts(bare).collect()}
    host = F.regexp_extract("url", wrapper.HOST, 1)
    large = pages.groupBy(host.alias("host")).count().where("count >= 5")
    given = pages.withColumn("host", host).join(large, "host").collect()
    right = sum(got[r.page_id] == expected(r.html) for r in given)
    print(len(given), right)
    assert len(given) > 100 and right >= 0.6 * len(given)


def test_a_long_page_of_alternating_blocks():
    page = "<body>" + "".join(f"<h2>Head {i}</h2><p>Text {i}</p>" for i in range(10_000)) + "</body>"
    start = time.perf_counter()
    root = wrapper.straight(dom.parse(page))
    tree = wrapper.skeleton(root)
    assert len(wrapper.readable(wrapper.texts_of(root, tree))) == 20_000
    wrapper.aligned(tree, wrapper.skeleton(dom.parse("<body><nav></nav>" + "<p>a</p><h2>b</h2>" * 500 + "</body>")))
    assert time.perf_counter() - start < 30


def test_packed_trees_come_back():
    tree = wrapper.skeleton(dom.parse("<div class='a 1'><p>x</p><ul><li>y<li>z</ul></div><section><p>q</p></section>"))
    assert wrapper._tree(wrapper._pack(tree)) == tree


def test_odd_rows(spark):
    rows = [(1, None, None), (1, None, None), (2, "not a url", ""), (None, "http://x/", "<p>a</p>"), (3, "http://x/", "plain"), (4, "http://x/", "<p>" + "long " * 50_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'own' as host", "1 as reference", "2 as text")
    got = sorted(((r.page_id or 0), r.url, r.text, r.n_chars) for r in wrapper.main_texts(df).collect() if r.page_id != 4)
    assert got == [(0, "http://x/", "a", 1), (1, None, "", 0), (1, None, "", 0), (2, "not a url", "", 0), (3, "http://x/", "plain", 5)]
    assert wrapper.main_texts(df.where("page_id = 4")).first().n_chars == 249_999
    assert wrapper.main_texts(df.limit(0)).collect() == []
