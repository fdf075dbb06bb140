"""Classification metrics as aggregates. A scored frame has ``label``, ``prediction`` and ``score``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakepipe.functions.bounds import quantile_bounds, with_buckets

EXACT = "decimal(38,0)"


def _ranges_for(scored: DataFrame) -> int:
    return max(2, min(10_000, int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def roc_auc(scored: DataFrame, ranges: int | None = None) -> DataFrame:
    """One row ``auc``: the share of (positive, negative) pairs ranked right, ties counting half.

    Exact, without sorting all scores in one task. Rows are first counted per distinct score, so
    a score shared by a third of all rows is one row from there on. The distinct scores are then
    cut into ranges of even size; the negatives below a score are those of the lower ranges (a
    running sum over ``ranges`` rows) plus those below it in its own range. The cut points only
    spread the work: any others give the same number. NULL if a class is absent.
    """
    ranges = ranges or _ranges_for(scored)
    cuts = quantile_bounds(scored, ["score"], ranges)[0]
    counted = (
        with_buckets(scored.select(F.col("score").cast("double"), "label"), {"score": cuts}, "_range")
        .groupBy("score_range", "score")
        .agg(F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg"))
    )
    lower = Window.partitionBy(F.lit(0)).orderBy("score_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        counted.groupBy("score_range")
        .agg(F.sum("neg").alias("neg"))
        .select("score_range", F.coalesce(F.sum("neg").over(lower), F.lit(0)).alias("lower_neg"))
    )
    within = Window.partitionBy("score_range").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    below = F.col("lower_neg") + F.coalesce(F.sum("neg").over(within), F.lit(0))
    halves = F.col("pos").cast("decimal(19,0)") * (2 * F.col("below") + F.col("neg")).cast("decimal(19,0)")
    joined = counted.join(F.broadcast(offsets), "score_range").withColumn("below", below)
    return joined.agg(
        F.try_divide(
            F.sum(halves.cast(EXACT)).cast("double"),
            F.lit(2.0) * F.sum("pos").cast("double") * F.sum("neg").cast("double"),
        ).alias("auc")
    )


def auc_bounds(scored: DataFrame, bins: int = 10_000, low: float = 0.0, high: float = 1.0) -> DataFrame:
    """One row ``auc``, ``error_bound``, ``lower``, ``upper``, ``bins_used``: the area from a histogram of the scores.

    Every task counts ``bins`` bins of fixed width between ``low`` and ``high``, one below, one from ``high`` on and one for
    NaN, which ranks highest; so memory and what is exchanged do not grow with the rows or with the number of different
    scores, as they do for ``roc_auc``. Pairs in different bins are ranked for certain. A pair within one bin adds between
    0 and 1, which gives exact bounds; ``auc`` is their middle. Rows without a score are left out; NULL if a class is absent.
    """
    score = F.col("score").cast("double")
    place = F.floor((score - low) / (high - low) * bins).cast("bigint")
    place = F.when(F.isnan(score), bins + 1).when(score < low, -1).when(score >= high, bins).otherwise(place)
    counted = (
        scored.where("score IS NOT NULL")
        .groupBy(place.alias("bin"))
        .agg(F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg"))
    )
    below = Window.partitionBy(F.lit(0)).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)  # of the bins, not of rows
    lower_neg = F.coalesce(F.sum("neg").over(below), F.lit(0)).cast("decimal(19,0)")
    pos = F.col("pos").cast("decimal(19,0)")
    counted = counted.withColumns({"sure": (pos * lower_neg).cast(EXACT), "within": (pos * F.col("neg")).cast(EXACT)})
    sure, within = (F.sum(c).cast("double") for c in ("sure", "within"))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return counted.agg(
        F.try_divide(sure + within / 2, pairs).alias("auc"),
        F.try_divide(within / 2, pairs).alias("error_bound"),
        F.try_divide(sure, pairs).alias("lower"),
        F.try_divide(sure + within, pairs).alias("upper"),
        F.count(F.lit(1)).alias("bins_used"),
    )


def _f1(hits: Column, predicted: Column, actual: Column) -> Column:
    return F.coalesce(F.try_divide(2.0 * hits, (predicted + actual).cast("double")), F.lit(0.0))


def confusion(scored: DataFrame) -> DataFrame:
    """One row: hits, predictions and rows of either class."""
    actual, predicted = F.col("label"), F.col("prediction")
    counts = []
    for c in (0, 1):
        counts += [
            F.count_if((actual == c) & (predicted == c)).alias(f"hit_{c}"),
            F.count_if(predicted == c).alias(f"pred_{c}"),
            F.count_if(actual == c).alias(f"real_{c}"),
        ]
    return scored.agg(*counts)


def _rows() -> Column:
    return (F.col("real_0") + F.col("real_1")).cast("double")


def _f1_score() -> Column:
    parts = [F.col(f"real_{c}") * _f1(F.col(f"hit_{c}"), F.col(f"pred_{c}"), F.col(f"real_{c}")) for c in (0, 1)]
    return F.try_divide(parts[0] + parts[1], _rows())


def _accuracy() -> Column:
    return F.try_divide((F.col("hit_0") + F.col("hit_1")).cast("double"), _rows())


def f1_weighted(scored: DataFrame) -> DataFrame:
    """One row ``f1_score``: the F1 of both classes, weighted by how many rows each class has."""
    return confusion(scored).select(_f1_score().alias("f1_score"))


def accuracy(scored: DataFrame) -> DataFrame:
    return confusion(scored).select(_accuracy().alias("accuracy"))


def evaluate(scored: DataFrame) -> DataFrame:
    """(metric, value) rows for auc, f1_score and accuracy."""
    counted = {"f1_score": _f1_score(), "accuracy": _accuracy()}
    pairs = [F.struct(F.lit(name).alias("metric"), value.alias("value")) for name, value in counted.items()]
    auc = roc_auc(scored).select(F.lit("auc").alias("metric"), F.col("auc").alias("value"))
    return auc.unionByName(confusion(scored).select(F.inline(F.array(*pairs))))
