import re
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from lakepipe.llm import line_templates as lines, queries

SMALL = "/root/testdata/sf0.01"


def dropped(spark, rows, **options):
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return {r["doc_id"]: tuple(r["dropped_lines"]) for r in lines.drop_recurring(frame, **options).collect()}


def words(prefix, n):
    letters = "abcdefghij"
    return " ".join(f"{prefix}{letters[k // 10 % 10]}{letters[k % 10]}" for k in range(n))


def test_planted_passages_of_every_length(spark):
    # (tokens of the passage, documents that hold it, whether it goes)
    planted = [(1, 12, False), (9, 12, False), (10, 10, True), (12, 8, False), (20, 5, True), (20, 4, False), (51, 2, True), (80, 3, True)]
    rows, want, at = [], {}, 0
    for k, (n, docs, goes) in enumerate(planted):
        for d in range(docs):
            rows.append((at, f"{words('own' + 'qrstuvwx'[k] + 'klmnopqrstuv'[d], 6)}\n{words('xyzuvwst'[k] + 'p', n)}"))
            want[at] = (1,) if goes and d else ()
            at += 1
    assert dropped(spark, rows) == want


CODE = ["if __name__ == '__main__':", "    main()", "    else:", "        return None", "Thank you."]


@pytest.mark.parametrize("copies", [1, 2])
def test_short_lines_of_source_files_stay(spark, copies):
    """Twelve files share four lines and a courtesy; in a corpus of twice the size they stay as well."""
    files = 12 * copies
    rows = [(i, "\n".join(f"value_{i}_{k} = {i * 97 + k}\n{line}" for k, line in enumerate(CODE))) for i in range(files)]
    assert dropped(spark, rows) == {i: () for i in range(files)}


def test_short_lines_go_in_runs(spark):
    notice = "Terms of use apply here\n\nRead them with care now\nWrite to us with questions"
    rows = [(i, f"own {words('abcdefghijkl'[i], 3)}\n{notice}\nRead them with care now") for i in range(12)]
    assert dropped(spark, rows) == {i: (1, 3, 4, 5) if i else () for i in range(12)}
    assert dropped(spark, rows[:6]) == {i: () for i in range(6)}


@pytest.mark.parametrize("stage", ["op3", "pipeline"])
def test_whole_lines_of_the_given_texts(spark, stage):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    if stage == "op3":
        left = {r["doc_id"]: r["text"] for r in queries.op3_line_templates(spark, SMALL).collect()}
    else:
        left = {r["doc_id"]: r["text"] for r in corpus_pipeline.line_dedup(spark, docs, SMALL).collect()}
    split = lambda text: {tuple(re.findall(r"[^\x20\x09-\x0D]+", part.lower())) for part in (text or "").split("\n")}
    given, held = defaultdict(set), Counter()
    for r in docs.collect():
        for line in split(r["text"]):
            given[line].add(r["doc_id"])
    for text in left.values():
        held.update(split(text))
    needed = lambda n: max(2, min(10, -(-100 // n)))
    repeated = [line for line, ids in given.items() if len(line) >= lines.MIN_TOKENS and len(ids) >= needed(len(line))]
    assert sum(len(line) > 50 for line in repeated) == 178 and min(map(len, repeated)) < 20
    assert all(held[line] <= 1 for line in repeated)
