import html
import itertools
import random
import re

import pyarrow.parquet as pq
import pytest

from orderlake.llm import html_extraction as H
from orderlake.llm.dom import Run, parse
from orderlake.llm.queries import QUERIES
from tests.conftest import SF_SMALL

SCHEMA = "page_id long, url string, html string, text string, site string, shape string, row int, n_chars string"


def frame(spark, rows):
    return spark.createDataFrame([(i, u, h, "t", "s", "x", 1, "n") for i, u, h in rows], SCHEMA)


def extracted(spark, rows):
    return {r["page_id"]: r["text"] for r in H.extract(frame(spark, rows)).collect()}


def tree(node):
    return node.text if isinstance(node, Run) else (node.tag, *[tree(k) for k in node.kids])


def test_query_equals_the_marked_articles(spark):
    """Independent of the operator: the given pages mark their article by name."""
    got = {r["page_id"]: r for r in QUERIES["op11_html_extraction"](spark, SF_SMALL).collect()}
    for row in pq.read_table(f"{SF_SMALL}/pages.parquet").to_pylist():
        article = re.search("(?s)<article>(.*?)</article>", row["html"]).group(1)
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:h1|p)>", article)]
        want = "\n\n".join(b for b in blocks if b)
        assert (got[row["page_id"]]["text"], got[row["page_id"]]["n_chars"]) == (want, len(want))


def test_parse():
    assert tree(parse("<p>a <b>b</b>c<p>d<ul><li>e<li>f<ul><li>g</ul></ul>h")) == (
        "html", ("p", "a bc"), ("p", "d"), ("ul", ("li", "e"), ("li", "f", ("ul", ("li", "g")))), "h")
    assert tree(parse("x<script>var t='</p>';<b></script>y<!-- <p> -->z<style>p{}</style>")) == ("html", "x yz")
    assert tree(parse("1 < 2 &amp; 3 &am &lt;b&gt; &#x41;&nbsp;<br>q")) == ("html", "1 < 2 & 3 &am <b> A q")
    assert tree(parse("<div title='a>b' data-x=\"<p>\">t</div> it's <i>\"so\"</i>")) == ("html", ("div", "t"), 'it\'s "so"')
    assert tree(parse("<table><tr><td>1<td>2<tr><td></div>3</table>4")) == (
        "html", ("table", ("tr", ("td", "1"), ("td", "2")), ("tr", ("td", "3"))), "4")
    assert tree(parse("<script>never closed <p>x")) == ("html",) == tree(parse("")) == tree(parse("<p")) == tree(parse("<!-- x"))
    assert tree(parse("a <span class=ad>buy</span> b <my-ad>c</my-ad> d")) == ("html", "a b d")


def test_deep_wide_and_broken_pages():
    deep = parse("<div>" * 50_000 + "x" + "</div>" * 50_000 + "<p>y")
    assert [r.text for r in H.runs(deep)] == ["x", "y"]
    assert len(list(H.runs(parse("<p>w</p><h2>h</h2>" * 20_000)))) == 40_000
    assert H.shape_of(parse("<p>w</p><h2>h</h2>" * 20_000)) == ("html", (("p", (("#", ()),)), ("h2", (("#", ()),))))
    rng = random.Random(1)
    for _ in range(300):
        parse("".join(rng.choice(["<", ">", "</", "p", "div", " class=", '"', "'", "!--", "--", "&", "a", "script", "td", "/", "="])
                      for _ in range(60)))
    parse('<a b="' * 30_000)
    parse("<a b='x' " * 30_000)


def brute(a, b):
    """Largest ordered matching, by trying all of them."""
    if a[0] != b[0]:
        return 0
    best = 0
    for n in range(min(len(a[1]), len(b[1])) + 1):
        for xs in itertools.combinations(a[1], n):
            for ys in itertools.combinations(b[1], n):
                gains = [brute(x, y) for x, y in zip(xs, ys)]
                best = max(best, sum(gains) if all(gains) else 0)
    return 1 + best


def test_simple_tree_matching_against_all_matchings():
    rng = random.Random(2)

    def grow(depth):
        return (rng.choice("ab"), tuple(grow(depth - 1) for _ in range(rng.randint(0, 3 if depth else 0))))
    for _ in range(60):
        a, b = grow(2), grow(2)
        assert H.match(a, b) == brute(a, b) == H.match(b, a)
        if a[0] == b[0]:
            assert H.size(H.union(a, b)) == H.size(a) + H.size(b) - H.match(a, b)


def site(n, host="h", notice="Sign up now for news", extra=""):
    rng = random.Random(n)

    def words(k):
        return " ".join(f"w{rng.randint(0, 9999)}" for _ in range(k))
    pages = []
    for i in range(n):
        title, paras = words(5), [words(30) for _ in range(rng.randint(1, 6))]
        page = (f"<html><body><div id='top'><div>{host} site</div><ul><li><a href=/a>{words(1)}</a><li><a href=/b>{words(1)}</a></ul></div>"
                f"<div class='x'><h1>{title}</h1><div class='body-{i}'><p>{notice}</p>" + "".join(f"<p>{p}" for p in paras)
                + f"<form>{words(3)}</form><aside>{words(9)}</aside></div>{extra}</div>"
                f"<div class='comments'><p>{words(40)}</p></div><div>all rights kept by {host}</div></body></html>")
        pages.append((i, f"http://{host}/{i}", page, "\n\n".join([title, *paras])))
    return pages


def test_constant_text_is_template_and_varying_text_is_content(spark):
    """No element says where the article is; the notice inside it is found by being the same everywhere."""
    pages = site(40)
    got = extracted(spark, [p[:3] for p in pages])
    assert got == {i: want for i, _, _, want in pages}


def test_copies_of_an_article_are_no_template(spark):
    pages = site(30)
    same = [(100 + k, "http://h/copy", pages[0][2]) for k in range(200)]
    got = extracted(spark, [p[:3] for p in pages] + same)
    assert {got[100 + k] for k in range(200)} == {pages[0][3]}
    assert all(got[i] == want for i, _, _, want in pages)


def test_joined_models_equal_broadcast_ones(spark, monkeypatch):
    rows = [p[:3] for p in site(30)] + [(1000 + p[0], *p[1:3]) for p in site(30, "g", "Other notice")]
    want = extracted(spark, rows)
    monkeypatch.setattr(H, "BROADCAST_BYTES", -1)
    assert extracted(spark, rows) == want


def test_edges(spark):
    long = "<article><p>" + "word " * 200_000 + "</p></article>"
    rows = [(1, None, None), (2, "http://a/", None), (3, "http://a/", ""), (None, "x", "plain text"), (5, "http://b/", "<article><p>one"),
            (5, "http://b/", "<article><p>one"), (6, "http://B/?", "<p>two &copy; <li>three"), (7, "http://c/", long),
            (8, "", "<nav>menu</nav>"), (9, "://", "<<<>>>&#0;&#xD800; \x00")]
    got = H.extract(frame(spark, rows).repartition(4)).collect()
    assert len(got) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in got)
    by_id = {r["page_id"]: r["text"] for r in got}
    assert by_id[1] == by_id[2] == by_id[3] == by_id[8] == "" and by_id[None] == "plain text" and by_id[5] == "one"
    assert by_id[6] == "two ©\n\nthree" and by_id[7] == " ".join(["word"] * 200_000)
    assert H.extract(frame(spark, rows).limit(0)).count() == 0


@pytest.mark.parametrize("parts", [1, 7])
def test_partitioning_does_not_matter(spark, parts):
    df = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    texts = H.extract(df.repartition(parts)).agg({"n_chars": "sum"}).first()[0]
    assert texts == QUERIES["op11_html_extraction"](spark, SF_SMALL).agg({"n_chars": "sum"}).first()[0]
