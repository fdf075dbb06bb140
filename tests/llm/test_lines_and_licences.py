import re
import sys
from collections import defaultdict

from lakepipe.llm import line_templates as lines, queries
from test_ngram_join import FOLD

SMALL = "/root/testdata/sf0.01"


def letters(token):
    return any(c in "abcdefghijklmnopqrstuvwxyz" or 0xC0 <= ord(c) < 0x2000 or 0x3000 <= ord(c) < 0x10000 for c in token)


def templates(line):
    """{template: tokens it fixes} of one line, as the module states the rule."""
    w = tokens(line)
    n = len(w)
    if n < lines.MIN_TOKENS:
        return {}
    out = {("line", *w): n} if any(map(letters, w)) or n >= lines.VARIABLE_FROM else {}
    masked = ["<*>" if re.search("[0-9]", x) else x for x in w]
    fixed = [m != "<*>" and letters(m) for m in masked]

    def enough(k):
        return k >= lines.FIXED_WORDS and 2 * k >= n

    if masked != w and enough(sum(fixed)):
        out["digits", *masked] = sum(fixed)
    blocks = max(lines.FIELDS, -(-(n - lines.DEPTH) // lines.FIELD_TOKENS))
    block = [0 if i < lines.DEPTH else 1 + (i - lines.DEPTH) * blocks // (n - lines.DEPTH) for i in range(n)]
    for f in range(1, blocks + 1):
        left = sum(ok for ok, b in zip(fixed, block) if b != f)
        if f in block and enough(left):
            out["field", n, f, *(m for m, b in zip(masked, block) if b != f)] = left
    return out


def tokens(line):
    return re.findall(r"[^\x20\x09-\x0D]+", line.translate(FOLD))


def by_line(text):
    """Every line's {template: tokens it fixes}, those of the runs it lies in included."""
    parts = (text or "").split("\n")
    found = [templates(part) for part in parts]
    said = [k for k, part in enumerate(parts) if tokens(part)]
    for at in range(len(said) - lines.RUN + 1):
        run = [tokens(parts[k]) for k in said[at : at + lines.RUN]]
        if min(map(len, run)) < lines.MIN_TOKENS <= sum(map(len, run)):
            for k in said[at : at + lines.RUN]:
                found[k]["run", *map(tuple, run)] = sum(map(len, run))
    return found


def needed(fixed, min_docs):
    return min(max(2, -(-lines.REPEATED_TOKENS // max(1, fixed))), min_docs)


def brute(rows, min_docs):
    holders = defaultdict(list)
    for i, text in rows:
        for key in {k for found in by_line(text) for k in found}:
            holders[key].append(sys.maxsize if i is None else i)
    out = []
    for i, text in rows:
        own = sys.maxsize if i is None else i
        gone = [
            k for k, found in enumerate(by_line(text))
            if any(len(holders[t]) >= needed(fixed, min_docs) and min(holders[t]) < own for t, fixed in found.items())
        ]
        parts = (text or "").split("\n")
        left = "\n".join(p for k, p in enumerate(parts) if k not in gone) if gone else text
        out.append((str(i), len(parts), tuple(gone), left))
    return sorted(out, key=str)


def found(frame, min_docs):
    rows = lines.drop_recurring(frame, min_docs).collect()
    return sorted(((str(r["doc_id"]), r["n_lines"], tuple(r["dropped_lines"]), r["text"]) for r in rows), key=str)


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    out = queries.op3_line_templates(spark, SMALL).collect()
    got = sorted(((str(r["doc_id"]), r["n_lines"], tuple(r["dropped_lines"]), r["text"]) for r in out), key=str)
    assert got == brute(rows, lines.MIN_DOCS)


def test_variable_fields(spark):
    rows = [(i, f"own words of text number {'abcdefgh'[i]}x\nerror 1{i} at host h{i} while reading block {i} of the file f.txt") for i in range(6)]
    rows += [(10 + i, f"the job named {'stuvwx'[i]} has ended now with no error at all") for i in range(6)]
    rows += [(30, "error at another host while writing"), (31, "the job")]
    rows += [(40 + i, f"short line\n\nand another one of them\nthe third says so{' ' * i}\nown {'abcdef'[i]}") for i in range(6)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = found(frame, 5)
    assert got == brute(rows, 5)
    dropped = {i for i, _, gone, _ in got if gone}
    assert dropped == {*map(str, range(1, 6)), *map(str, range(11, 16)), *map(str, range(41, 46))}
    assert {gone for i, _, gone, _ in got if i in map(str, range(41, 46))} == {(0, 2, 3)}
    kept = {r["doc_id"] for r in lines.cleaned(frame, 5).collect()}
    assert kept == {*range(6), 10, 30, 31, *range(40, 46)}  # those of which nothing is left go


def test_odd_rows(odd_docs, no_docs):
    rows = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    for min_docs in (2, 3):
        assert found(odd_docs, min_docs) == brute(rows, min_docs)
    kept = lines.cleaned(odd_docs, 2)
    assert kept.columns == odd_docs.columns and kept.dtypes == odd_docs.dtypes
    assert kept.where("doc_id = 0 AND text IS NULL").count() == 1 and kept.where("doc_id = 6").isEmpty()
    assert lines.cleaned(no_docs).count() == 0
