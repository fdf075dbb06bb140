"""Text that must stay, and the window rule by brute force over lines on all given pages."""

import pytest

from lakepipe.llm import html_text, queries

LONG = "A sentence of the main text that is long enough to be one. " * 3
MAIN = f"<h1>Title</h1><p>{LONG}</p><p>Short.</p><p>{LONG}</p>"
WANT = "\n".join(["Title", LONG.strip(), "Short.", LONG.strip()])


def text(*body):
    return html_text.main_text("<html><head><title>T</title></head><body>" + "".join(body) + "</body></html>")


def test_custom_elements_are_no_raw_ones():
    assert html_text.main_text("<article><p>A</p><svg-icon></svg-icon><p>B</p></article>") == "A\nB"
    assert text("<title-bar></title-bar>", f"<div>{MAIN}</div>") == WANT
    assert text("<style-guide>x</style-guide>", f"<article>{MAIN}</article>") == WANT
    assert html_text.main_text("<article><p>A</p><svg><path d='<p>no'/></svg><style>p{}</style\n><p>B</p></article>") == "A\nB"


def test_quoted_attributes():
    assert text(f"<div><p>See <a title=\"a > b\" href='x'>this</a> {LONG}</p><p title='1>0'>{LONG}</p></div>") == f"See this {LONG.strip()}\n{LONG.strip()}"
    assert text(f"<article><p data-x=\"it's > that\">{LONG}</p></article>") == LONG.strip()
    assert text(f'<article><p title="left open>{LONG}</p></article>') == LONG.strip()


@pytest.mark.parametrize("name", ["comment-thread", "wp-comments-area", "comments", "disqus_thread", "x reply-42"])
def test_reader_comments_go(name):
    assert text(f"<div>{MAIN}</div><section class=\"{name}\"><p>{LONG}</p><p>{LONG}</p></section>") == WANT


@pytest.mark.parametrize("name", ["has-comments", "comments-open", "no-comments", "comment-count"])
def test_elements_with_or_without_comments_stay(name):
    assert text(f"<div class='{name}'>{MAIN}</div>") == WANT


def test_captions_link_paragraphs_and_closing_lines_stay():
    figure = "<figure><img src=x><figcaption>A caption.</figcaption></figure>"
    assert text(f"<div><p>{LONG}</p>{figure}<p>{LONG}</p></div>") == f"{LONG.strip()}\nA caption.\n{LONG.strip()}"
    link = "<p><a href=/x>A paragraph that is one link</a></p>"
    assert text(f"<div><p>{LONG}</p>{link}<p>{LONG}</p></div>") == f"{LONG.strip()}\nA paragraph that is one link\n{LONG.strip()}"
    assert text(f"<div><p>{LONG}</p><aside>{LONG}</aside><p>End.</p></div>") == f"{LONG.strip()}\nEnd."
    assert text(f"<div><p>So.</p><div class=ad>{LONG}</div><p>{LONG}</p></div>") == f"So.\n{LONG.strip()}"
    assert text(f"<div><p>{LONG}</p></div><aside>x</aside><div><p>Elsewhere.</p></div>") == LONG.strip()
    assert text(f"<div><p>{LONG}</p></div><ul><li><a href=/x>Home</a><li><a href=/y>Imprint</a></ul>") == LONG.strip()


@pytest.mark.parametrize("depth", [1, 20, 21, 200])
def test_hints_still_skip_in_nested_wrappers(depth):
    notice = f"<div class=cookie-notice>{LONG}</div>"
    assert text("<div class=widget>" * depth + notice + MAIN * 2 + "</div>" * depth) == f"{WANT}\n{WANT}"


def by_windows(page):
    """The module's last step without arrays: every line's window sums, then the stretches that reach the level."""
    lines = [line for line in html_text.lines_of(page) if not (line[1] and line[2])]
    size = [0 if blank else len(t) for t, _, blank, _ in lines]
    if not any(size):
        return ""
    half = 2 * sum(n for n, line in zip(size, lines) if line[1]) > sum(size)
    weight = [n * (0.5 if half and not line[1] else 1.0) for n, line in zip(size, lines)]
    group, groups = None, []
    for k, line in enumerate(lines):
        key = (line[1], size[k] > 0)
        if size[k] and key == group:
            groups[-1].append(k)
        elif size[k]:
            groups.append([k])
        group = key
    highest = [max(sum(weight[k] for k in g[max(0, j - html_text.WINDOW + 1) : j + 1]) for j in range(len(g))) for g in groups]
    level = min(html_text.SURGE, max(highest))
    kept = {i for i, h in enumerate(highest) if h >= level}
    while True:
        more = {
            i for i in range(len(groups)) for j in (i - 1, i + 1)
            if j in kept and lines[groups[max(i, j)][0]][3] == lines[groups[min(i, j)][-1]][3]
        } - kept
        if not more:
            break
        kept |= more
    return "\n".join(lines[k][0] for i, g in enumerate(groups) if i in kept for k in g)


@pytest.mark.parametrize("renamed", [False, True])
def test_the_window_rule_on_all_given_pages(spark, renamed):
    folder = "/root/testdata/sf0.01"
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    if renamed:
        assert all(html_text.main_text(p) == by_windows(p) for p in (h.replace("article>", "div>") for h in pages.values()))
    else:
        assert {r["page_id"]: r["text"] for r in queries.op10_main_text(spark, folder).collect()} == {
            i: by_windows(page) for i, page in pages.items()
        }
