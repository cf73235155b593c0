"""Main text of web pages."""

import pytest

from termloom.llm import pages, queries

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def model(spark):
    return pages.fit(spark.read.parquet(f"{DATA}/pages.parquet"))


def texts(page):
    return [b.text for b in pages.leaf_blocks(page)]


def test_blocks():
    page = (
        "<html><head><title>no</title><style>p{}</style></head><body>"
        "<!-- <p>no</p> --><script>var t='</p><p>no';</script>"
        "<div>a &amp; b<p>c<br>d<b> e<p>f</div><ul><li>g<li>h</ul>stray</p> &lt;i&gt;"
    )
    assert texts(page) == ["a & b", "c d e", "f", "g", "h", "stray", "<i>"]


@pytest.mark.parametrize("tag", ["h1", "p", "section", "ul", "table", "blockquote", "a", "span", "body"])
def test_open_head_ends_at_body_content(tag):
    page = f"<html><head><meta charset=x><title>no</title><script>no</script><{tag}>one</{tag}><p>two"
    assert texts(page) == ["one", "two"]
    assert texts("<head><title>no</title> bare<p>two") == ["bare", "two"]


@pytest.mark.parametrize("page", [None, "", "<", "<p", "<!--", "<script>x", "</p></p>", "<a href='x>y", "&#x0;<p>&bad;"])
def test_broken_markup(page, model):
    assert isinstance(pages.main_text(page, model), str)


def test_held_out_labelled_pages(model):
    wrong = total = 0
    for page, labels in pages.labelled_pages(["Some plain words, and more of them."] * 3, 100, seed=5):
        blocks = pages.leaf_blocks(page)
        assert len(blocks) == len(labels)
        wrong += sum(a != b for a, b in zip(model.decode(pages.features(blocks)), labels))
        total += len(labels)
    assert wrong < 0.03 * total


def test_chrome_goes(model):
    story = "".join(f"<p>The story goes on, and on, in its part {i}.</p>" for i in range(5))
    page = (
        "<body><header><h2>The Daily</h2></header><nav><ul><li><a href=/>Home</a></ul></nav>"
        "<div class='cookie-notice'>We use cookies.</div>"
        f"<article><h1>A title</h1>{story}<div class=ad>Buy now, it is cheap.</div></article>"
        "<aside class=sidebar><h3>Related</h3><ul><li><a href=/x>Other story</a></ul></aside>"
        "<section class=comments><h3>2 Comments</h3><div class=comment><p>I like it, really.</p></div></section>"
        "<form class=newsletter><label>Your mail</label><button>Go</button></form>"
        "<footer>&copy; 2020 The Daily</footer>"
    )
    wanted = ["A title", *(f"The story goes on, and on, in its part {i}." for i in range(5))]
    assert pages.main_text(page, model) == "\n\n".join(wanted)


def test_query(spark):
    rows = queries.op5_html_text(spark, DATA).collect()
    html = {r.page_id: r.html for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()}
    assert len(rows) == len(html)
    for row in rows:
        article = html[row.page_id].split("<article>")[1].split("</article>")[0]
        assert row.text == "\n\n".join(texts(article)) and row.n_chars == len(row.text)


def test_odd_rows(spark, model):
    rows = [(1, None, "mine"), (1, None, "mine"), (None, "<p>" * 3000 + "x", "mine"), (3, "", "mine")]
    df = spark.createDataFrame(rows, "page_id bigint, html string, text string")
    found = pages.extract(df, model).collect()
    assert len(found) == 4 and all(r.n_chars == len(r.text) for r in found)
    assert pages.extract(df.limit(0), pages.fit(df.limit(0))).count() == 0


def test_references_end_with_their_piece():
    """A reference does not go on behind a tag; one that is whole is decoded once."""
    blocks = pages.leaf_blocks("<p>A&am<b>p;</b> &lt;x&gt; &amp;lt; &amp; caf&eacute;</p>")
    assert [b.text for b in blocks] == ["A&amp; <x> &lt; & caf\u00e9"]
