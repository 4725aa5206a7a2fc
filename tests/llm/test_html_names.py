"""Names of elements are one sign among others."""

import pytest

from textflow.llm.html_extract import GOOD, label_blocks

LONG = ("The river was high and the people of the town had gone to the bridge "
        "to see what it would do to the old mill. ") * 2
BODY = " ".join(LONG.split())


def _text(html):
    return "\n".join(b.text for b in label_blocks(html) if b.label == GOOD)


@pytest.mark.parametrize("opening, closing", [
    ('<div class="has-sidebar">', "</div>"),
    ('<div id="page-with-nav">', "</div>"),
    ('<div class="sidebar-right">', "</div>"),
    ('<form id="f">', "</form>"),
    ('<div class="menu-open"><div class="widget">', "</div></div>"),
])
@pytest.mark.parametrize("tag", ["article", "div"])
def test_named_wrapper_of_the_page(opening, closing, tag):
    page = (f"{opening}<{tag}><h1>Title</h1><p>{LONG}</p><p>{LONG}</p></{tag}>"
            f'<div class="sidebar"><p>{LONG}</p></div>'
            f'<div id="comments"><p>{LONG}</p></div>{closing}'
            "<footer>foot</footer>")
    assert _text(page) == "\n".join(["Title", BODY, BODY])


def test_article_named_for_its_comments():
    assert _text(f'<article class="post comments-open"><p>{LONG}</p>'
                 f'<section id="comments"><p>{LONG}</p></section></article>'
                 ) == BODY


def test_inline_mark_stands_for_itself():
    assert _text(f'<article><p><span class="ad">x</span> {LONG}</p><p>a '
                 f'<span class="ad">y</span> b</p></article>'
                 ) == BODY + "\na b"
    assert _text(f'<p><span class="ad">x</span> {LONG}</p>') == BODY


def test_weak_names_yield_to_running_text():
    assert _text(f'<article><div class="notice"><p>{LONG}</p></div>'
                 f'<p>x</p><div class="share">Tell all</div></article>'
                 ) == BODY + "\nx"
    assert _text(f'<div class="el-widget"><p>{LONG}</p></div>') == BODY


def test_names_still_hold_beside_the_text():
    page = (f"<h1>T</h1><p>{LONG}</p>" + f'<div id="comments">'
            f"<article><p>{LONG}</p></article></div>" * 5
            + f'<div class="cookie-notice"><p>{LONG}</p></div>')
    assert _text(page) == "T\n" + BODY
