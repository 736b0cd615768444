import html
import re
import time

import pytest

from cardlake.llm import html_text as H

TREE = H.Tree(H.LABELLED)
LONG = "word " * 40


def text(page):
    return H.main_text(page, TREE)


def test_tree_learns_its_table():
    import numpy as np
    data = np.array(H.LABELLED, float)
    assert (TREE.predict(data[:, :-1]) == data[:, -1].astype(bool)).all()


@pytest.mark.parametrize("page, want", [
    (None, ""), ("", ""), ("   ", ""), ("<p></p>", ""), ("<script>var a='</p>x'</script>", ""),
    ("<article><p>a &lt;b&gt;&nbsp;&amp;  c\n d</p><p>e</article>", "a <b> & c d\n\ne"),
    ("<article><h1>T</h1><p>x<br>y<!-- no --><script>z</script></p></article>", "T\n\nx y"),
    ("<nav>menu</nav><article><p>one</p></article><footer>f</footer>", "one"),
    ("<article><p>body</p><section class='user-comments'><article><p>great!</p></article></section></article>", "body"),
    ("<article><header><h1>T</h1></header><p>b</p><aside>side</aside><form>f</form></article>", "T\n\nb"),
    ("<div class=ad>buy<article><p>in</p></article></div>", "in"),
    ("<article><p>a<ul><li>one<li>two</ul></article>", "a\n\none\n\ntwo"),
    ("<article><p title='a > b'>x</p><p hidden>y</p><p style='display: none'>z</p></article>", "x"),
    ("<article><p>open", "open"), ("<article><p>a < b and c > d</p></article>", "a < b and c > d"),
    ("<article><p>x</p><!-- open comment <p>y</p>", "x"), ("<article><p>x</p><!-- open", "x"),
    ("<article><p>x</p><script>var a = 1", "x"), ("<article><p>x</p><script>var a</script>y", "x\n\ny"),
    ("<article><p>x</p><!-- c -->y", "x\n\ny"), ("<article><p>x<b", "x<b"),
    (f"<div><h2>Head</h2><p>{LONG}</p><p>short one</p><p>{LONG}</p></div><ul><li><a href=x>a</a><li><a>b</a></ul>",
     f"Head\n\n{LONG.strip()}\n\nshort one\n\n{LONG.strip()}"),
])
def test_pages(page, want):
    assert text(page) == want


@pytest.mark.parametrize("inner, want", [
    ('<p class="promotion-history">a b</p>', "a b"), ('<section id="search-results"><p>a b</p></section>', "a b"),
    ('<section class="legal-analysis"><p>a b</p></section>', "a b"), ("<p>let <math><mi>x</mi></math> be</p>", "let x be"),
    ("<ul><li><a>one</a><li><a>two</a><li><a>three</a></ul>", "one\n\ntwo\n\nthree"),
    ('<div class="ad-slot-1">buy</div>', ""), ('<div class="cookieBanner">c</div>', ""),
    ('<div id="post-comments">c<article>d</article></div>', ""), ('<ul class="share-links"><li>s</ul>', ""),
    ('<div class="related-posts">r</div>', ""), ('<p class="lead notice">n</p>', ""),
])
def test_articles_keep_all_that_is_theirs(inner, want):
    assert text(f"<article><p>start</p>{inner}</article>") == f"start\n\n{want}".strip()


def test_a_page_of_one_block():
    assert text("<body><p>Hello world</p></body>") == "Hello world"
    assert text("<body><p><a href=x>Hello world</a></p></body>") == ""


@pytest.mark.parametrize("page", ["<i>" * 50_000 + "</b>" * 50_000, "<span><p>x</p>" * 50_000,
                                  "<div>" * 50_000 + "x" + "</div>" * 50_000, "<a><h2>" * 50_000 + "</p>" * 50_000,
                                  "<p><b><i><u><s><span>x" * 10_000 + "<div>y"], ids=range(5))
def test_time_is_linear(page):
    def seconds(p):
        begin = time.process_time()
        H.blocks(p)
        return time.process_time() - begin
    half = page[:len(page) // 2]
    assert seconds(page) < max(6 * seconds(half), 2)


def test_unmarked_pages(spark):
    """Without marks, classes and structural elements the tree has the dealt features alone."""
    right = found = wanted = 0
    for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").collect():
        marked = H.blocks(r.html or "")
        bare = re.sub(r"<(/?)(?:article|main|nav|header|footer|aside|form|section)\b[^>]*>", r"<\1div>", r.html or "")
        bare = re.sub(r"\s(?:class|id|role|hidden|style)(?:=(?:\"[^\"]*\"|'[^']*'|[^\s>]+))?(?=[\s>])", "", bare)
        shown = H.blocks(bare)
        assert [b[0] for b in shown] == [b[0] for b in marked] and all(b[4] == 1 for b in shown)
        if shown:
            kept = TREE.predict(H.features(shown))
            truth = TREE.predict(H.features(marked))
            right, found, wanted = right + (kept & truth).sum(), found + kept.sum(), wanted + truth.sum()
    assert right / found > 0.9 and right / wanted > 0.9, (right / found, right / wanted)


def test_long_and_odd_pages_are_linear():
    assert text("<" * 200_000) in ("", "<" * 200_000)
    assert len(text("<article>" + "<p>a" * 50_000)) == 50_000 + 2 * 49_999
    text("<a title=\"" * 20_000)
    text("<div>" * 50_000 + "x")


def test_whole_table_against_the_known_structure(spark):
    """The driver's pages hold their article in <article>: a direct reading must agree."""
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: (r.text, r.n_chars) for r in H.with_main_text(pages).collect()}

    def want(h):
        m = re.search(r"(?s)<article>(.*?)(</article>|\Z)", h or "")
        parts = re.split(r"</?(?:p|h1)>", m[1]) if m else []
        parts = [" ".join(html.unescape(re.sub(r"</?b>|<br>", " ", x)).split()) for x in parts]
        return "\n\n".join(p for p in parts if p)
    for r in pages.collect():
        assert got[r.page_id] == (want(r.html), len(want(r.html)))


def test_table_edges(spark):
    schema = "page_id long, url string, html string, text string, words int"
    rows = [(1, "u", None, "old", 1), (1, "u", None, "old", 1), (None, None, "<article>x</article>", None, None)]
    out = H.with_main_text(spark.createDataFrame(rows, schema))
    assert set(out.columns) == {"page_id", "url", "html", "words", "text", "n_chars"}
    assert sorted((r.text, r.n_chars) for r in out.collect()) == [("", 0), ("", 0), ("x", 1)]
    assert H.with_main_text(spark.createDataFrame([], schema)).collect() == []
