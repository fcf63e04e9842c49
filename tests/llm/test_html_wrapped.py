"""Pages that an element for forms, dialogs or widgets holds as a whole, many classes, and a second extraction on all pages."""

import html
import re
from collections import Counter

import pytest
from caremill.llm import html_extract
from caremill.llm.common import table

SF = "/root/testdata/sf0.001"
PROSE = "".join(f"<p>Paragraph {i} of the story goes on with many words that somebody may like to read today.</p>" for i in range(12))
WANT = "\n".join(f"Paragraph {i} of the story goes on with many words that somebody may like to read today." for i in range(12))
MENU = "<nav><a href='/a'>Home</a> <a href='/b'>About us</a></nav>"
FOOT = "<footer>All rights reserved <a href='/c'>Imprint</a></footer>"
WRAPS = ["<form>{}</form>", "<form action='/' id='aspnetForm'>{}</form>", "<dialog open>{}</dialog>", "<div class='widget'>{}</div>", "<div id='social'>{}</div>", "<div class='widget'><form>{}</form></div>", "<aside><div>{}</div></aside>"]


@pytest.fixture(scope="module")
def learned(spark):
    return html_extract.learned_weights(table(spark, SF, "pages"))


@pytest.mark.parametrize("wrap", WRAPS)
def test_wrapped_pages(learned, wrap):
    for weights in (learned, html_extract.weights_of(Counter(), Counter())):
        for inner in (PROSE, f"<div>{PROSE}</div>"):
            assert html_extract.main_text(f"<html><body>{wrap.format(MENU + inner + FOOT)}</body></html>", weights) == WANT
            assert html_extract.main_text(f"<html><body>{MENU}{wrap.format(inner)}{FOOT}</body></html>", weights) == WANT


def test_parts_that_are_set_apart_go_in_wrapped_pages_too(learned):
    form = "<form><label>Your name</label><input name='n'> <button>Send it to us now</button></form>"
    page = f"<html><body><div class='widget'>{MENU}<main>{PROSE}<aside>A note beside the story</aside>{form}</main>{FOOT}</div></body></html>"
    assert html_extract.main_text(page, learned) == WANT


def test_long_comments_do_not_become_the_text(learned):
    comments = "".join(f"<div class='comment'><p>I think so too, and here is why I do, reader {i} says at great length.</p></div>" for i in range(300))
    for name in ("comments", "comments-area"):
        page = f"<html><body>{MENU}<main>{PROSE}</main><div class='{name}'>{comments}</div>{FOOT}</body></html>"
        assert html_extract.main_text(page, learned) == WANT


def test_a_class_counts_in_any_place(learned):
    for n in (0, 1, 16, 400):
        names = " ".join([*(f"x{i}" for i in range(n)), "comments"])
        page = f"<html><body><main>{PROSE}</main><div class='{names}'><p>A reader says what a reader says.</p></div></body></html>"
        assert html_extract.main_text(page, learned) == WANT


def test_against_a_second_extraction(spark):
    """Pages of the test tables have their text in one article: cut it out with expressions and compare."""
    rows = html_extract.op8_html_extract(spark, SF).collect()
    pages = {r.page_id: r.html for r in table(spark, SF, "pages").collect()}
    checked = 0
    for r in rows:
        page = pages[r.page_id] or ""
        if len(re.findall(r"<article", page)) != 1:
            continue
        body = re.search(r"<article[^>]*>(.*)</article>", page, re.S)[1]
        body = re.sub(r"<(script|style|aside|nav|form|footer)\b.*?</\1>", "", body, flags=re.S)
        body = re.sub(r'<div class="(?:ad|share|comments)".*?</div>', "", body, flags=re.S)
        lines = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1|h2|h3|li|ul|ol|div|blockquote|pre|table|tr|td|th|figure|figcaption|header)\b[^>]*>", body))
        assert r.text == "\n".join(x for x in lines if x), r.page_id
        assert r.n_chars == len(r.text)
        checked += 1
    assert checked > 20
