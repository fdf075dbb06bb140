import pytest

from lakepipe.llm import line_templates as lines
from test_line_thresholds import dropped, words

DOCS = 12


def own(prefix, k):
    """A word without digits that differs from document to document."""
    return prefix + "abcdefghijkl"[k]


@pytest.mark.parametrize(
    "row",
    [
        lambda k: f"{k}.5 {k * 7} {k + 2000} {k * k}",
        lambda k: " ".join(str(100 * k + j) for j in range(60)),
        lambda k: f"| {k} | {k * 3} | {k * 5} |",
        lambda k: f"│ {k} │ {k * 3} │ {k * 5} │",
        lambda k: f"total {k} {k * 3} {k * 5} {k * 9} {k * 11} {k + 1} {k + 2} {k + 3}",
        lambda k: "5",
    ],
)
def test_rows_of_figures_stay(spark, row):
    rows = [(k, f"{row(k)}\n{own('text', k)}") for k in range(DOCS)]
    assert dropped(spark, rows) == {k: () for k in range(DOCS)}
    only = spark.createDataFrame([(k, row(k)) for k in range(DOCS)], "doc_id long, text string")
    assert lines.cleaned(only).count() == DOCS


@pytest.mark.parametrize("begin", [0, 50, 100, 200])
def test_long_fields_are_text_of_their_own(spark, begin):
    common = words("same", 100).split() * 3
    rows = []
    for k in range(DOCS):
        line = list(common)
        line[begin : begin + 100] = words(own("own", k), 100).split()
        rows.append((k, " ".join(line)))
    assert dropped(spark, rows) == {k: () for k in range(DOCS)}


def test_short_fields_still_vary(spark):
    rows = []
    for k in range(DOCS):
        line = words("same", 100).split()
        line[50] = own("own", k)
        rows.append((k, f"{' '.join(line)}\npage {k} of {k + 20}\nthe job named {own('j', k)} has ended now with no error"))
    assert dropped(spark, rows) == {k: (0, 2) if k else () for k in range(DOCS)}


def test_equal_long_rows_of_figures_go(spark):
    row = " ".join(str(1000 + j) for j in range(60))
    assert dropped(spark, [(1, row), (2, row), (3, row + " 7")]) == {1: (), 2: (0,), 3: ()}
