"""Pages that are broken, deep or wrapped."""

import time

import pytest

from fleetspark.llm.html_extract import extract_text, main_text

STORY = "The story goes on, and on. " * 20


@pytest.mark.parametrize(
    "html, text",
    [
        ("<p>a</p><![foo[x]]>", "a"), ("<p>a</p><![ x >b", "a b"), ("<p>a</p><!foo", "a"), ("<p>a</p><!-- b <p>c</p>", "a"), ("<p>a</p><div", "a"),
        ("<p>a < b</p>", "a < b"), ("<p>a</p><![CDATA[x<p>y]]>z", "a z"), ("<p>x &lt", "x <"), ("<p>x</p></", "x"), ("<p>x</p><?php echo", "x"),
    ],
)
def test_broken_markup_is_no_text(html, text):
    assert main_text(html) == text


@pytest.mark.parametrize(
    "html",
    [
        "<p>x</p>" + "<font>a " * 50_000, "<div>a " * 20_000, "<ul><li>x" + "<div>" * 10_000 + "<li>a</li>" * 10_000, "<font>" * 30_000 + "<p>x</p>" * 30_000,
        "<div>" * 20_000 + "</b>" * 50_000, "<table><tr>" + "<td>x<b>" * 30_000,
    ],
)
def test_time_is_linear_in_the_page(html):
    began = time.process_time()
    main_text(html)
    assert time.process_time() - began < 5


def test_deep_nesting_keeps_the_text():
    assert main_text("<div>" * 5000 + f"<p>{STORY}</p>") == STORY.strip()
    deep = f"<article><p>{STORY}</p>" + "<div>" * 5000 + "<p>The last words, far below.</p></article>"
    assert main_text(deep) == f"{STORY.strip()} The last words, far below."


def test_a_form_around_the_page_is_no_form_in_it():
    page = '<html><body><form action="x"><div class="nav">menu</div><div><p>{0}</p><p>{0}</p><input name=a><button>Go</button></div></form></body></html>'
    assert main_text(page.format(STORY)) == f"{STORY.strip()} {STORY.strip()}"
    small = f"<html><body><div><p>{STORY}</p><form><p>Your name, please</p><label>Name</label></form></div></body></html>"
    assert main_text(small) == STORY.strip()
    assert main_text("<form><label>Name</label> sign in</form>") == ""


def test_a_broken_page_does_not_end_the_job(spark):
    rows = [(1, "u", "<p>a</p><![foo[x]]>"), (2, "v", None), (3, "w", "<div>" * 3000 + "deep")]
    got = extract_text(spark.createDataFrame(rows, "page_id long, url string, html string"), keep_columns=("url",)).collect()
    assert sorted((r.page_id, r.url, r.text, r.n_chars) for r in got) == [(1, "u", "a", 1), (2, "v", "", 0), (3, "w", "deep", 4)]
