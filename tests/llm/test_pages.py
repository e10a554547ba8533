"""Main text of pages."""

import pytest

from tabulyst.llm.html import extract, main_text

PARAGRAPH = "This is a paragraph of the article with a fair number of words in it, and it ends here."
ARTICLE = f"<article><h1>The title</h1><p>{PARAGRAPH}</p><p>Second &amp; <b>bold</b>\n  text &eacute;&#8364;, {PARAGRAPH}</p></article>"
TEXT = f"The title\n{PARAGRAPH}\nSecond & bold text é€, {PARAGRAPH}"


@pytest.mark.parametrize("page", [
    ARTICLE,
    f"<html><head><title>T</title><style>p{{}}</style><script>var t='</p><p>no'</script></head><body><nav><a href=x>Home</a></nav>{ARTICLE}<footer>&copy; us</footer></body></html>",
    f"<body><div class='ad'>Buy this thing now, it is cheap and good.</div><div id=sidebar><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></div>{ARTICLE}"
    f"<div class=\"comments\"><p>{PARAGRAPH} says a reader</p></div><form><input value=1><label>Name</label></form></body>",
    f"<body><header><p>{PARAGRAPH}</p></header><!-- <p>gone</p> --><div><div>{ARTICLE}</div></div><aside>{PARAGRAPH}</aside>",
    f"<body><div><a href=1>many links</a> <a href=2>more links</a> <a href=3>and more</a></div>{ARTICLE}",
])
def test_article_alone(page):
    assert main_text(page) == TEXT


@pytest.mark.parametrize("name", [
    "content has-sidebar", "no-sidebar", "container no-comments", "elementor-widget elementor-widget-text-editor", "widget Blog", "post-content social-share",
])
def test_names_do_not_discard_wrappers(name):
    inner = ARTICLE.replace("article>", "div>")
    furniture = "<div class='sidebar'><p>See also the other pages.</p></div><div id=footer><p>Made by us</p></div>"
    comments = "<div class='comments'><ol><li class='comment'><article><p>Well said.</p></article></ol></div>"
    for article in (ARTICLE, f"<main>{inner}</main>", inner):
        assert main_text(f"<body><div class='{name}'>{article}{furniture}{comments}</div></body>") == TEXT
        assert main_text(f"<body>{furniture}<div id='{name}'><div>{article}</div></div>{comments}</body>") == TEXT


def test_open_tags_and_broken_markup():
    assert main_text("<p><b>one two<br><p>three <i>four</p> five < six</p>") == "one two\nthree four\nfive < six"
    assert main_text("plain  text\nhere") == "plain text here"
    assert main_text("<p>a</p><script>never closed") == "a"
    assert main_text("<p>a<!-- never closed") == "a"
    assert main_text('<p title="a>b">c</p><p class="x>d') == "c\nd"  # an open quote ends at the bracket
    assert main_text("<nav>only a menu</nav>") == main_text("") == main_text("<p> \n </p>") == ""


def test_pages_of_all_kinds(spark):
    rows = [(1, "u", ARTICLE, 1), (1, "u", ARTICLE, 1), (2, None, None, 2), (None, "v", "", 3), (3, "w", "<div>" * 3000 + "<p>deep</p>", 4), (4, "w", "<p>" + "long words " * 100000, 5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, x int").toDF("page_id", "url", "html", "PAGE_ID")
    found = extract(pages).collect()
    assert sorted((str(r["page_id"]), r["n_chars"]) for r in found) == sorted([("1", len(TEXT)), ("1", len(TEXT)), ("2", 0), ("None", 0), ("3", 4), ("4", 1099999)])
    assert extract(pages.limit(0)).count() == 0
