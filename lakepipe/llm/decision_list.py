"""Learned quality rules: an ordered list of threshold conjunctions, as native column expressions.

Sequential covering over labelled text statistics. A rule grows one threshold at a time by information
gain on two thirds of the labelled rows until none gains, loses its last thresholds again where that helps on
the other third, and is accepted if it is precise; the rows it covers leave the table, and the next rule is
grown. After a rule that is not accepted the next one must begin with another statistic or direction; learning ends
when none is left or too few bad texts are. Every decision needs only counts per (statistic, bin), which Spark aggregates; the driver sees
bins, never rows. The result is a chain of ``when`` expressions.

Statistics are array and string functions in the row, so a text is never exploded or shuffled.

Candidate thresholds are approximate quantiles (within a 10,000th of the rows), which may depend on how the labelled
rows are spread over tasks; all counts are exact.

Defined results: a null text has no words; a text without words has every share 0; without labels, or
with one class only, the list is empty and keeps everything that passes the base rule. Rows that share an
id are judged each by its own text, whole whatever its length; a document with contradicting labels is not learnt from.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from itertools import islice

from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F

from lakepipe.session import written_once

GAPS = "[ \\t\\n\\x0B\\f\\r]+"
GAP_CHARACTERS = " \t\n\x0b\x0c\r"
STATISTICS = [
    "mean_word", "symbol_share", "duplicate_line_share", "repeat_share", "upper_share", "digit_share",
    "loud_share", "distinct_share", "words_per_line",
]
BINS = 24
LEAST_PRECISION, LEAST_COVERED = 0.95, 5


def _count(pattern: str) -> Column:
    return F.length("body") - F.length(F.regexp_replace("body", pattern, ""))


def _equal_window(other: str) -> str:
    """SQL: whether window ``w`` has the hash and the words of another one, false where there is none."""

    def place(window):
        return f"CAST({window} & (shiftleft(1L, place_bits) - 1) AS INT)"

    words = [f"get(words, {place('w')} + {k}) = get(words, {place(other)} + {k})" for k in range(3)]
    hashes = f"shiftrightunsigned(w, place_bits) = shiftrightunsigned({other}, place_bits)"
    return f"coalesce({hashes} AND {' AND '.join(words)}, false)"


def text_statistics(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (text and anything else) with the counts of the base rule and the learner's statistics.

    Columns: ``row`` (a struct of all columns but the text, so that no name can clash), ``given`` (the
    text), the counts and STATISTICS.

    ``n_repeat_words`` counts words in three-word windows that occur twice or more. Windows are hashed
    into the upper bits of a number whose lower bits are the window's place, so that sorting the numbers
    puts equal windows side by side. Neighbours with equal hashes count only if their words are equal; the next but
    one is compared as well, should a window with the same hash and other words stand between two equal ones.
    """
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    frame = docs.select(others.alias("row"), F.col("text").alias("given"), F.coalesce("text", F.lit("")).alias("body"))
    trimmed = F.btrim("body", F.lit(GAP_CHARACTERS))
    frame = frame.withColumn("words", F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, GAPS)))
    lines = F.filter(F.split("body", "\n"), lambda line: F.btrim(line, F.lit(GAP_CHARACTERS)) != "")
    frame = frame.withColumns(
        {
            "n_words": F.size("words").cast("long"),
            "word_chars": F.length(F.array_join("words", "")).cast("long"),
            "n_symbols": _count("[#*$%&|<>]").cast("long"),
            "n_upper": _count("\\p{Lu}"),
            "n_digits": _count("[0-9]"),
            "n_loud": _count("[!?]"),
            "lines": lines,
            "n_distinct": F.size(F.array_distinct("words")),
            "place_bits": F.length(F.bin(F.size("words").cast("long"))),
        }
    )
    keys = F.expr(
        "transform(CASE WHEN size(words) >= 3 THEN sequence(0, size(words) - 3) ELSE array() END, i -> "
        "shiftleft(xxhash64(get(words, i), get(words, i + 1), get(words, i + 2)), place_bits) | i)"
    )
    frame = frame.withColumn("windows", F.sort_array(keys)).withColumns(
        {"n_lines": F.size("lines"), "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long")}
    )
    # Most windows differ from both neighbours in their hash; the words are compared for the others only.
    top = "shiftrightunsigned({}, place_bits)"
    beside = [f"coalesce({top.format('w')} = {top.format(f'get(windows, j {step})')}, false)" for step in ("- 1", "+ 1")]
    frame = frame.withColumn("alike", F.expr(f"filter(windows, (w, j) -> {' OR '.join(beside)})"))
    equal = [_equal_window(f"get(alike, j {step})") for step in ("- 1", "+ 1", "- 2", "+ 2")]
    frame = frame.withColumn("repeated", F.expr(f"filter(alike, (w, j) -> {' OR '.join(equal)})"))
    frame = frame.withColumn("places", F.expr("sort_array(transform(repeated, w -> w & (shiftleft(1L, place_bits) - 1)))"))
    frame = frame.withColumn(
        "n_repeat_words",
        F.expr(
            "aggregate(transform(places, (p, k) -> least(3L, coalesce(get(places, k + 1), p + 3) - p)), 0L, (t, x) -> t + x)"
        ),
    )
    words, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    return frame.select(
        "row", "given",
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (F.col("word_chars") / words).alias("mean_word"),
        (F.col("n_symbols") / words).alias("symbol_share"),
        (F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))).alias("duplicate_line_share"),
        (F.col("n_repeat_words") / words).alias("repeat_share"),
        (F.col("n_upper") / chars).alias("upper_share"),
        (F.col("n_digits") / chars).alias("digit_share"),
        (F.col("n_loud") / words).alias("loud_share"),
        (F.col("n_distinct") / words).alias("distinct_share"),
        (F.col("n_words") / F.greatest(F.col("n_lines"), F.lit(1))).alias("words_per_line"),
    )


@dataclass(frozen=True)
class Condition:
    statistic: str
    above: bool
    threshold: float

    def holds(self) -> Column:
        value = F.col(self.statistic)
        return value > self.threshold if self.above else value <= self.threshold


@dataclass
class DecisionList:
    """Ordered rules; a text that one of them covers is rejected."""

    rules: list[list[Condition]] = field(default_factory=list)

    def keeps(self) -> Column:
        verdict = None
        for rule in self.rules:
            covered = _all(rule)
            verdict = F.when(covered, F.lit(False)) if verdict is None else verdict.when(covered, F.lit(False))
        return F.lit(True) if verdict is None else verdict.otherwise(F.lit(True))

    def __str__(self) -> str:
        lines = [" and ".join(f"{c.statistic} {'>' if c.above else '<='} {c.threshold:.4g}" for c in r) for r in self.rules]
        return "\n".join([f"reject if {line}" for line in lines] + ["keep"])


def _all(conditions: list[Condition]) -> Column:
    held = F.lit(True)
    for condition in conditions:
        held = held & condition.holds()
    return held


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _cuts(labelled: DataFrame) -> dict[str, list[float]]:
    """Candidate thresholds: the middles between neighbouring quantiles of either class."""
    steps = [k / BINS for k in range(BINS + 1)]
    rows = labelled.groupBy("bad").agg(*[F.percentile_approx(s, steps, 10_000).alias(s) for s in STATISTICS]).collect()
    cuts = {}
    for s in STATISTICS:
        values = sorted({v for row in rows for v in row[s] or []})
        cuts[s] = [(x + y) / 2 for x, y in zip(values[:-1], values[1:], strict=True)]
    return cuts


def _placed(labelled: DataFrame, cuts: dict[str, list[float]]) -> DataFrame:
    """``labelled`` with ``places``: a sparse vector with a 1 at the bin of each statistic, all statistics' bins in a row."""

    def bin_of(statistic: str) -> Column:
        edges = F.array(*[F.lit(c) for c in cuts[statistic]]).cast("array<double>")
        return F.size(F.filter(edges, lambda edge: edge < F.col(statistic)))

    names = F.array(*[F.concat(F.lit(f"{s} "), bin_of(s).cast("string")) for s in STATISTICS])
    places = [f"{s} {k}" for s in STATISTICS for k in range(len(cuts[s]) + 1)]
    vectors = CountVectorizerModel.from_vocabulary(places, inputCol="names", outputCol="places")
    return vectors.transform(labelled.select("bad", "grow", *STATISTICS, names.alias("names"))).drop("names")


def _tally(rows: DataFrame) -> DataFrame:
    """The numbers of bad and of good rows at every place; a task adds its rows up in place and sends one vector for each."""
    return rows.groupBy("bad").agg(Summarizer.numNonZeros(F.col("places")).alias("n"))


def _counts(rows: DataFrame, cuts: dict[str, list[float]]) -> dict[str, list[tuple[int, int]]]:
    """For every statistic and bin the numbers of bad and of good rows."""
    size = sum(len(cuts[s]) + 1 for s in STATISTICS)
    found = {True: [0] * size, False: [0] * size}
    for row in _tally(rows).collect():
        found[row["bad"] == 1] = [int(n) for n in row["n"]]
    pairs = iter(zip(found[True], found[False], strict=True))
    return {s: list(islice(pairs, len(cuts[s]) + 1)) for s in STATISTICS}


def _best(
    table: dict[str, list[tuple[int, int]]], cuts: dict[str, list[float]], tried: set[tuple[str, bool]] = frozenset()
) -> tuple[float, Condition | None]:
    """The condition with the highest information gain on the counted rows, but for the directions in ``tried``."""
    best: tuple[float, Condition | None] = (0.0, None)
    for s, bins in table.items():
        total_p, total_n = (sum(b[k] for b in bins) for k in (0, 1))
        if not total_p:
            continue
        before = math.log2(total_p / (total_p + total_n))
        low_p = low_n = 0
        for k, cut in enumerate(cuts[s]):
            low_p, low_n = low_p + bins[k][0], low_n + bins[k][1]
            for above, p, n in ((False, low_p, low_n), (True, total_p - low_p, total_n - low_n)):
                gain = p * (math.log2(p / (p + n)) - before) if p and (s, above) not in tried else 0.0
                if gain > best[0] + 1e-9:
                    best = (gain, Condition(s, above, cut))
    return best


def _next_rule(left: DataFrame, cuts: dict[str, list[float]]) -> list[Condition] | None:
    """The first rule for the rows in ``left`` that is precise; each begins with another statistic or direction.

    All begin on the same rows, which are counted once.
    """
    start = _counts(left.where("grow"), cuts)
    tried: set[tuple[str, bool]] = set()  # first conditions that led to no rule
    while True:
        rule: list[Condition] = []
        _, condition = _best(start, cuts, tried)
        while condition is not None:
            rule.append(condition)
            _, condition = _best(_counts(left.where(F.col("grow") & _all(rule)), cuts), cuts)
        if not rule:
            return None
        prefixes = range(1, len(rule) + 1)
        sums = left.agg(
            *[
                F.coalesce(F.sum(F.when((F.col("grow") == grow) & (F.col("bad") == bad) & _all(rule[:k]), 1)), F.lit(0)).alias(
                    f"{'g' if grow else 'p'}{bad}{k}"
                )
                for k in prefixes
                for grow in (True, False)
                for bad in (1, 0)
            ]
        ).first()
        # The shortest of the best on the pruning rows; one row of each kind is added to both counts.
        worth = {k: (sums[f"p1{k}"] - sums[f"p0{k}"]) / (sums[f"p1{k}"] + sums[f"p0{k}"] + 2) for k in prefixes}
        size = max(prefixes, key=lambda k: (worth[k], -k))
        bad, good = (sums[f"g{c}{size}"] + sums[f"p{c}{size}"] for c in (1, 0))
        if bad >= LEAST_COVERED and bad >= LEAST_PRECISION * (bad + good):
            return rule[:size]
        tried.add((rule[0].statistic, rule[0].above))


def learn(labelled: DataFrame) -> DecisionList:
    """A list for ``labelled``: STATISTICS, ``bad`` (1 for texts to reject, else 0) and ``grow`` (else the row prunes)."""
    cuts = _cuts(labelled)
    table = written_once(_placed(labelled, cuts), "labelled")
    learned = DecisionList()
    while True:
        left = table.where(learned.keeps())
        if left.where("bad = 1").count() < LEAST_COVERED:
            break
        rule = _next_rule(left, cuts)
        if rule is None:
            break
        learned.rules.append(rule)
    return learned


def learn_from(statistics: DataFrame, labels: DataFrame) -> DecisionList:
    """Learns ``quality`` of ``labels`` (doc_id, quality) on texts that pass the base rule."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id")
    known = known.agg(F.min("quality").alias("label"), F.max("quality").alias("other")).where("label = other")
    rows = statistics.where(~base_failed()).select(F.col("row.doc_id").alias("doc_id"), *STATISTICS)
    rows = rows.join(known, "doc_id").select(
        (F.col("label") == 0).cast("int").alias("bad"), (F.pmod(F.xxhash64("doc_id"), F.lit(3)) != 0).alias("grow"), *STATISTICS
    )
    return learn(rows)


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``text_statistics`` of ``docs`` with base_failed and kept; the rules are learnt from ``labels``."""
    statistics = written_once(text_statistics(docs), "statistics")
    rules = learn_from(statistics, labels)
    return statistics.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & rules.keeps())


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns."""
    kept = judged(docs, labels).where("kept")
    return kept.select(*[F.col("given").alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
