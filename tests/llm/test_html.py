import re
from html import unescape

import pytest

from tests.llm.cases import empty
from tidemark.llm.html import extract, main_text

PAGES = "page_id long, url string, html string"
LONG = "This is a sentence of the article, with words, and with commas. " * 4


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("", ""),
        ("plain text only.", "plain text only."),
        (f"<article><h1>T</h1><p>{LONG}<p>two &amp; &#233;\n <b>x</b>y</article><footer>{LONG}</footer>", f"T\n{LONG.strip()}\ntwo & é xy"),
        (f"<nav><p>{LONG}</p></nav><p>{LONG}</p><aside><p>{LONG}</p></aside>", LONG.strip()),
        (f"<div class='side-bar sidebar'>{LONG}</div><div id=main>{LONG}</div><div class=comments><p>{LONG}</div>", LONG.strip()),
        (f"<script>var x = '<p>{LONG}</p>';</script><style>p{{}}</style><p>{LONG}<!-- <p>no</p> --></p>", LONG.strip()),
        (f"<p>{LONG}</p><!-- open {LONG}", LONG.strip()),
        (f"<p>{LONG}</p><script>open {LONG}", LONG.strip()),
        ("<p>a < b and b > c", "a < b and b > c"),
        ("<p title='a>b'>x</p>", "x"),
        ("<p>one<br>two</p>", "one two"),
        ("<main><ul><li>first item.<li>second item.</ul></main>", "first item.\nsecond item."),
        ("<div hidden>gone</div><p>here.</p>", "here."),
        ("<p>&nbsp; </p>", ""),
        (f"<article><h1>A</h1><h2>B</h2><h3>C</h3><p>{LONG}</p><h2>D</h2><h3>E</h3></article>", f"A\nB\nC\n{LONG.strip()}\nD\nE"),
        (f"<header>{LONG}</header><article><header><h1>Kept</h1></header><p>{LONG}</p></article>", f"Kept\n{LONG.strip()}"),
        (f"<ul><li><a href=x>{'link ' * 30}</a></ul><div><p>{LONG}</p></div>", LONG.strip()),
    ],
)
def test_pages(html, text):
    assert main_text(html) == text


def test_deep_and_long_pages():
    deep = "<div>" * 20_000 + LONG + "</div>" * 20_000
    assert main_text(deep) == LONG.strip()
    assert main_text("<" * 50_000) == "<" * 50_000
    assert main_text("</p>" * 50_000) == ""
    assert len(main_text(f"<p>{LONG}</p>" * 5_000)) == 5_000 * (len(LONG.strip()) + 1) - 1


def test_articles_of_the_pages(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r["page_id"]: r for r in extract(rows).collect()}
    assert len(got) == rows.count()
    for r in rows.collect():
        article = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        parts = (" ".join(unescape(re.sub(r"<[^>]*>", "", p)).split()) for p in re.split(r"</?(?:h1|p)>", article))
        want = "\n".join(p for p in parts if p)
        assert (got[r["page_id"]]["text"], got[r["page_id"]]["n_chars"]) == (want, len(want))


def test_odd_rows(spark):
    rows = [(1, None, None), (1, None, None), (None, "u", "<p>\U0001f600é</p>")]
    got = extract(spark.createDataFrame(rows, PAGES).selectExpr("*", "1 AS text", "2 AS n_chars")).collect()
    assert sorted(map(tuple, got), key=str) == [(1, None, "", 0), (1, None, "", 0), (None, "u", "\U0001f600é", 2)]
    assert extract(empty(spark, PAGES)).collect() == []


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (f"<div class='content-sidebar-wrap'><main><p>{LONG}</p></main><div class=sidebar>{LONG}</div></div>", LONG.strip()),
        (f"<article class='post comments-open'><h1>T</h1><p>{LONG}</p></article>", f"T\n{LONG.strip()}"),
        (f"<div class='site has-sidebar'><p>{LONG}</p><p>{LONG}</p><aside>{LONG}</aside></div>", f"{LONG.strip()}\n{LONG.strip()}"),
        (f"<main><h1>T</h1><div id='page-with-nav'><div class=nav>x</div><p>{LONG}</p></div></main>", f"T\n{LONG.strip()}"),
        (f"<div class='page has-header'><p>{LONG}</p></div>", LONG.strip()),
        (f"<form id=f><p>{LONG}</p></form>", LONG.strip()),
        (f"<article><p>short.</article><div class=comments>{LONG}</div>", "short."),
        (f"<p>one <span class=ad>buy</span> two. {LONG}</p>", f"one\ntwo. {LONG.strip()}"),
        (f"<p>one <span class=share-row>{LONG}</span> two</p>", f"one {LONG.strip()} two"),
    ],
)
def test_words_of_wrappers_exclude_no_page(html, text):
    assert main_text(html) == text


@pytest.mark.parametrize(
    "short",
    [
        f"<ul>{''.join(f'<li>list item number {i}' for i in range(6))}</ul>",
        f"<table>{''.join(f'<tr><td>{i}<td>cell' for i in range(6))}</table>",
        "<h2>One</h2><h3>Two</h3><h4>Three</h4><h5>Four</h5>",
        "<div>one</div><div>two</div><div>three</div><div>four</div>",
    ],
)
def test_short_blocks_between_content_stay_without_an_article(short):
    parts = [" ".join(p.split()) for p in re.split("<[^>]*>", short)]
    want = "\n".join([LONG.strip(), *filter(None, parts), LONG.strip()])
    assert main_text(f"<nav>{LONG}</nav><div><p>{LONG}</p>{short}<div class=ad>{LONG}</div><p>{LONG}</p></div><footer>{LONG}</footer>") == want


COMMENT = "A reader says something about it, at length, and then some more. " * 6


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (f"<article><p>{LONG}</p></article><section id=comments><article>{COMMENT}</article><article>{COMMENT}</article></section>", LONG.strip()),
        (f"<article><p>{LONG}</p><section class='comments-area'><article>{COMMENT}</article></section></article>", LONG.strip()),
        (f"<main><article><p>{LONG}</p></article><div class='related-posts'><article><h2>Other</h2><p>{COMMENT}</p></article></div></main>", LONG.strip()),
        (f"<article><p>{LONG}</p></article><article class=comment>{COMMENT}</article>", LONG.strip()),
        (f"<div><p>{LONG}</p><p>{LONG}</p></div><section id=comments><article>{LONG}</article></section>", f"{LONG.strip()}\n{LONG.strip()}"),
        (f"<div class='single comments-open'><article><h1>T</h1><p>{LONG}</p></article></div><article>x</article>", f"T\n{LONG.strip()}\nx"),
        (f"<main><h1>T</h1><div class='has-comments'><article>{LONG}</article></div></main>", f"T\n{LONG.strip()}"),
    ],
)
def test_comments_and_cards_go(html, text):
    assert main_text(html) == text


@pytest.mark.parametrize("wrap", ["{}", "<body>{}</body>", "<div>{}</div>", "<nav><ul><li><a>menu</a></ul></nav><div>{}</div>"])
@pytest.mark.parametrize("order", [(0, 1), (1, 0)])
def test_lists_at_the_ends_of_content_stay(wrap, order):
    prose, items = f"<p>{LONG}</p><p>{LONG}</p>", "<ul><li>alpha<li>beta<li>gamma<li>delta</ul>"
    lines = [f"{LONG.strip()}\n{LONG.strip()}", "alpha\nbeta\ngamma\ndelta"]
    assert main_text(wrap.format("".join((prose, items)[i] for i in order))) == "\n".join(lines[i] for i in order)


@pytest.mark.parametrize(
    ("name", "kept"),
    [("notice-board-content", True), ("share-price", True), ("search-results-story", True), ("ad", False), ("share-links", False), ("newsletter-box", False), ("related", False)],
)
def test_inside_an_article_a_name_must_say_nothing_else(name, kept):
    got = main_text(f"<article><p>{LONG}</p><p>{LONG}</p><div class='{name}'>Some words here.</div></article>")
    assert got == "\n".join([LONG.strip(), LONG.strip(), *(["Some words here."] if kept else [])])


def test_paths_of_any_depth_and_far_siblings():
    """Paths that differ only near the root are told apart; items end however deep the open elements are."""
    deep = "<div>" * 60
    page = f"<section>{deep}<p>{LONG}</p>{'</div>' * 60}</section><ul><li><a>x</a></ul>"
    assert main_text(page) == LONG.strip()
    inline = "<b><i><u><em><strong>"
    assert main_text(f"<ul><li>{inline}one, {LONG}<li>{inline}two, {LONG}</ul>") == f"one, {LONG.strip()}\ntwo, {LONG.strip()}"
    nested = f"<ul><li>one, {LONG}<ul><li>inner, {LONG}</ul><li>two, {LONG}</ul>"
    assert main_text(nested) == f"one, {LONG.strip()}\ninner, {LONG.strip()}\ntwo, {LONG.strip()}"
