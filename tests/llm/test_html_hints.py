import pytest

from lakepipe.llm import html_text

LONG = "A sentence of the main text that is long enough to be one. " * 3
MAIN = f"<h1>Title</h1><p>{LONG}</p><p>Short.</p><p>{LONG}</p>"
WANT = "\n".join(["Title", LONG.strip(), "Short.", LONG.strip()])


def text(*body):
    return html_text.main_text("<html><head><title>T</title></head><body>" + "".join(body) + "</body></html>")


@pytest.mark.parametrize(
    "attributes",
    [
        'class="content has-sidebar"', "class=no-sidebar", "class='menu-open'", 'class="story share-enabled"',
        'id=sidebar-page class="x with-nav"', 'class="sidebar content"', "class=modal", 'class="comments"', "hidden",
    ],
)
def test_wrappers_of_the_text_are_not_skipped(attributes):
    assert text(f"<div {attributes}>{MAIN}</div>") == WANT


@pytest.mark.parametrize("wrapper", ["<div class=modal>{}</div>", "<form action=/x>{}</form>", "<div class=widget><div>{}</div></div>"])
def test_an_element_with_most_of_the_text_stays(wrapper):
    noise = "<div class=ad>An advert.</div>"
    assert text(f"<p>{LONG}</p>", noise, wrapper.format(noise + MAIN)) == "\n".join([LONG.strip(), WANT])


@pytest.mark.parametrize("name", ["cookie-notice", "ad", "ad-1", "left-sidebar", "site-footer", "main-nav", "x comments", "comment-list", "page-header"])
def test_hints_in_whole_tokens_still_skip(name):
    assert text(f"<div class='{name}'>{LONG}</div><div>{MAIN}</div>") == WANT


def test_long_comments_and_empty_pages():
    comments = f"<section class=comments>{f'<p>{LONG}</p>' * 20}</section>"
    assert text(f"<div>{MAIN}</div>{comments}") == WANT
    assert text("<nav><p>Home</p></nav>") == "" == text("")


def test_deeply_nested_wrappers():
    assert text("<div class=widget>" * 3000 + MAIN) == WANT
