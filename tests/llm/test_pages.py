"""Main text of pages: given markup beside the text expected of it."""

import html
import re

import pytest

from carespan.llm import html_text
from tests.llm.conftest import rows_by

NONE = frozenset()


@pytest.mark.parametrize("page, text", [
    ("<article><h1>Title</h1><p>One  two\n three</p></article>", "Title\nOne two three"),
    ("<html><head><title>t</title><style>p{}</style><script>var a='</p>';</script></head><body><nav>x</nav><article><p>a<p>b</article><footer>c</footer>", "a\nb"),
    ("<article><p><b>bold</b> and <i>it</i>al<br>next</p></article>", "bold and ital next"),
    ("<article><p>a &amp; b &lt;c&gt; &copy; &#233; &#x1F642; &am</p></article>", "a & b <c> © é 🙂 &am"),
    ("<article><p>cut off in a ta<a hre", "cut off in a ta"),
    ("<article><p>one</p><!-- <p>not</p> --><p>two</p><!-- never closed", "one\ntwo"),
    ("<div class='sidebar'>side</div><main><header><h1>T</h1></header><p>x</p><footer>y</footer></main>", "T\nx"),
    ("<div id=page class='has-sidebar'><article><p>in a frame</p></article></div>", "in a frame"),
    ("<article><p>text</p><div class='comments'><p>first!</p></div><form>mail</form><aside>more</aside></article>", "text"),
    ("<article><div class=\"share-buttons\">f t</div><ul><li>one<li>two</ul></article>", "one\ntwo"),
    ("<article><div class=ad>buy<p>now</article><p>after</p>", ""),
    ("<p>plain page</p><div class='cookie-notice'>cookies</div><div role=navigation>menu</div>", "plain page"),
    ("<table><tr><td>a<td>b</table>", "a\nb"),
    ("no markup, 1 < 2 & 3 > 2", "no markup, 1 < 2 & 3 > 2"),
    ("<article><p title='a > b' data-x=\"<p>\">quoted</p></article>", "quoted"),
    ("<article><p it's>stray</p></article>", "stray"),
    ("<ARTICLE><P>Upper</P></ARTICLE>", "Upper"),
    ("<article>a<script>x</article><p>b", "a"),
    ("", ""), ("<", "<"), ("</p></article>", ""), ("<article></article>", ""),
])
def test_main_text(page, text):
    assert html_text.main_text(page, NONE) == text


def test_hard_pages_take_linear_time():
    for page in ("<" * 20_000, "<p>" * 3000 + "x", "<a b='" * 3000, "<!--" * 10_000, "&" * 100_000, "<p a=" + '"' * 9_999):
        html_text.main_text(page, NONE)


def expected(page):
    """The blocks of the article of a test page, whose markup is regular but for its end."""
    found = re.search(r"<article>(.*?)(?:</article>|\Z)", page or "", re.S)
    body = re.sub(r"</?[a-zA-Z][^>]*\Z", "", found[1] if found else "")
    blocks = re.split(r"</?(?:p|h1)>", body.replace("<br>", " "))
    lines = (" ".join(html.unescape(re.sub(r"</?[a-z]+>", "", b)).split()) for b in blocks)
    return "\n".join(x for x in lines if x)


def test_query(spark):
    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        rows = spark.read.parquet(f"{sf}/pages.parquet").collect()
        got = rows_by(html_text.op6_html_text(spark, sf), "page_id")
        assert len(got) == len(rows)
        for row in rows:
            r, want = got[row["page_id"]], expected(row["html"])
            assert (r["url"], r["text"], r["n_chars"]) == (row["url"], want, len(want))


def site(spark, bodies, host="h.example"):
    return spark.createDataFrame(
        [(i, f"https://{host}/{i}", b) for i, b in enumerate(bodies)], "page_id bigint, url string, html string"
    )


def test_branches_that_all_pages_share_are_cut(spark):
    bodies = [
        f"<div class=top><p>Welcome to our site</p></div><div class=body><p>Story {i} {'abcdefgh'[i % 8] * (i + 3)}</p></div>"
        for i in range(12)
    ]
    pages = site(spark, bodies).unionByName(site(spark, bodies[:2], "few.example"))
    trees = {(r["host"], r["path"]): r for r in html_text.style_trees(pages).collect()}
    assert trees["h.example", "/div:top"]["importance"] == pytest.approx(0)
    assert trees["h.example", "/div:body"]["importance"] == pytest.approx(0.9)
    texts = {r["url"]: r["text"] for r in html_text.page_texts(pages).collect()}
    assert texts["https://h.example/3"] == "Story 3 dddddd"
    assert texts["https://few.example/1"].startswith("Welcome to our site\n")  # too few pages to tell


def test_copies_of_a_page_cut_nothing(spark):
    page = "<article><h1>Same</h1><div class=lead><p>Same text on each</p></div></article>"
    texts = {r["text"] for r in html_text.page_texts(site(spark, [page] * 30)).collect()}
    assert texts == {"Same\nSame text on each"}


def test_importance_is_the_entropy(spark):
    bodies = [f"<div class=a><p>{'x' if i < 6 else i}</p></div><p>n{i}</p>" for i in range(8)]
    row = [r for r in html_text.style_trees(site(spark, bodies)).collect() if r["path"] == "/div:a"][0]
    import math

    entropy = -(6 / 8 * math.log(6 / 8) + 2 * (1 / 8 * math.log(1 / 8))) / math.log(8)
    assert row["n_pages"] == 8 and row["importance"] == pytest.approx(0.9 * entropy)


def test_awkward_pages(spark):
    rows = [
        (1, None, None, "x"), (2, "", "", "x"), (None, "no host", "<p>a</p>", None), (4, "http://u@H.example:8/x", "<article>b</article>", "x"),
        (4, "http://u@H.example:8/x", "<article>b</article>", "x"), (5, "https://h.example", "<p>" + "long " * 100_000, "y"),
    ]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, host string")
    got = html_text.page_texts(pages).collect()
    assert sorted(r["n_chars"] for r in got) == [0, 0, 1, 1, 1, 499_999]
    assert html_text.page_texts(pages.where("false")).count() == 0
