"""Markup of pages: what an article's names may hide, and time on hostile markup."""

import time

import pytest

from ledgerspark.llm.page_text import page_lines


def kept(page):
    return [text for text, kind in page_lines(page) if kind == "article"]


@pytest.mark.parametrize(
    "block",
    [
        "<h2 id='search-algorithms'>kept</h2>", "<h2 id='comments'>kept</h2>", "<section id='related-work'><p>kept</p></section>",
        "<div class='social-science'>kept</div>", "<div class='alert-levels table'>kept</div>", "<p id='notice'>kept</p>",
        "<table class='menu'><tr><td>kept</td></tr></table>", "<ul class='search'><li id='share'>kept</li></ul>",
    ],
)
def test_article_text_stays_whatever_its_names(block):
    assert kept(f"<article><p>first</p>{block}<p>last</p></article>") == ["first", "kept", "last"]


@pytest.mark.parametrize(
    "block",
    [
        "<div class='share-buttons'>gone</div>", "<div class='related-posts'>gone</div>", "<div id='comments'><p>gone</p></div>",
        "<section class='ad slot-2'>gone</section>", "<aside>gone</aside>", "<nav><ul><li>gone</li></ul></nav>",
        "<form><p>gone</p></form>", "<div class='newsletter box'>gone</div>", "<div class='comment-list'><p>gone</p></div>",
    ],
)
def test_named_boxes_of_an_article_go(block):
    assert kept(f"<article><p>first</p>{block}<p>last</p></article>") == ["first", "last"]


@pytest.mark.parametrize(
    "part", ['<a "x ', "<p <", '<a ">" ', "<a '\">", "<!-- x", "<script ", "<script>", "<a b='", "<!x ", "</p "]
)
def test_time_grows_with_the_page(part):
    page = part * (1_000_000 // len(part))
    for ending in ("", ">"):
        start = time.monotonic()
        page_lines(page + ending)
        assert time.monotonic() - start < 10  # quadratic scanning took minutes at a tenth of this size


def test_unended_markup():
    assert page_lines("a <b") == [("a <b", "")]
    assert page_lines("a<!-- b > c") == [("a", "")] and page_lines("a<!-- b") == [("a", "")]
    assert page_lines("x<p title='y>z</p> w") == [("x", ""), ("z", ""), ("w", "")]
    assert page_lines("<p title='a > b'>c</p>") == [("c", "")]
