import os
import random
import subprocess
import sys

import numpy
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from lakepipe.ml import features, metrics, runs, split
from lakepipe.ml.scoring import as_predictions
from lakepipe.operators import cleaning, gold
from lakepipe.session import written_once
from lakepipe.sources.adapted import raw_events
from lakepipe.ml.training import PRIORITY, apply, fit, train_and_log

few = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


@pytest.fixture
def scored(spark):
    def build(rows):
        return spark.createDataFrame([(s, y, int(s >= 0.5)) for s, y in rows], "score double, label int, prediction int")

    return build


def pairs_auc(rows):
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    if not pos or not neg:
        return None
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_auc_of_special_tables(scored):
    assert metrics.roc_auc(scored([(0.9, 1), (0.1, 0)])).first()["auc"] == 1.0
    assert metrics.roc_auc(scored([(0.1, 1), (0.9, 0)])).first()["auc"] == 0.0
    assert metrics.roc_auc(scored([(0.3, 1), (0.3, 0), (0.3, 0)])).first()["auc"] == 0.5
    assert metrics.roc_auc(scored([(0.3, 1), (0.4, 1)])).first()["auc"] is None


@few
@given(
    st.lists(st.tuples(st.sampled_from([0.0, 0.1, 0.25, 0.5, 0.7, 1.0]) | st.floats(0, 1), st.integers(0, 1)), min_size=2, max_size=60),
    st.sampled_from([2, 3, 17]),
)
def test_auc_against_all_pairs(scored, rows, ranges):
    got = metrics.roc_auc(scored(rows).repartition(3), ranges).first()["auc"]
    want = pairs_auc(rows)
    assert (got is None) == (want is None) and (want is None or got == pytest.approx(want, abs=1e-12))
    flipped = metrics.roc_auc(scored([(-s, y) for s, y in rows]), ranges).first()["auc"]
    assert want is None or got + flipped == pytest.approx(1.0)


def test_auc_with_a_hot_score_and_many_distinct_ones(spark):
    """A third of the rows share one score; the rest are distinct. The cut points change nothing."""
    spread = F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 1_000_003.0
    frame = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0.5).otherwise(spread).alias("score"),
        (F.pmod(F.xxhash64(F.col("id") + 1), F.lit(10)) < 3).cast("int").alias("label"),
    )
    rows = sorted((r["score"], r["label"]) for r in frame.collect())
    positives = sum(y for _, y in rows)
    halves, below, i = 0, 0, 0
    while i < len(rows):
        j = i
        while j < len(rows) and rows[j][0] == rows[i][0]:
            j += 1
        p = sum(y for _, y in rows[i:j])
        halves += p * (2 * below + (j - i - p))
        below += j - i - p
        i = j
    want = halves / (2.0 * positives * (len(rows) - positives))
    assert {metrics.roc_auc(frame, n).first()["auc"] for n in (2, 8, 100)} == {want}


def test_f1_and_accuracy_against_plain_python(scored):
    rng = random.Random(1)
    rows = [(rng.random(), int(rng.random() < 0.3)) for _ in range(300)]
    got = {r["metric"]: r["value"] for r in metrics.evaluate(scored(rows)).collect()}
    weighted = 0.0
    for c in (0, 1):
        hit = sum(y == c and int(s >= 0.5) == c for s, y in rows)
        predicted, actual = sum(int(s >= 0.5) == c for s, _ in rows), sum(y == c for _, y in rows)
        weighted += actual / len(rows) * (2 * hit / (predicted + actual))
    assert got["f1_score"] == pytest.approx(weighted)
    assert got["accuracy"] == sum(int(s >= 0.5) == y for s, y in rows) / len(rows)
    assert got["auc"] == pytest.approx(pairs_auc(rows))


def test_metrics_of_no_rows(scored):
    assert {r["value"] for r in metrics.evaluate(scored([])).collect()} == {None}


@pytest.fixture
def users(spark):
    def build(n, buyers):
        return spark.range(n).select(
            F.col("id").alias("user_id"), (F.col("id") < buyers).cast("int").alias("label")
        )

    return build


@pytest.mark.parametrize("n,buyers", [(1000, 150), (1003, 333), (7, 3), (5, 0), (4, 4), (1, 1), (0, 0), (101, 50)])
def test_stratified_split_has_exact_sizes(users, n, buyers):
    parts = split.stratified_split(users(n, buyers)).collect()
    assert len(parts) == n
    wanted = -(-n * 20 // 100)
    shares = {1: buyers * wanted / n, 0: (n - buyers) * wanted / n} if n else {}
    test = [p["label"] for p in parts if not p["is_train"]]
    assert len(test) == wanted
    for label, share in shares.items():
        assert abs(test.count(label) - share) < 1


def test_splits_do_not_depend_on_partitioning(users):
    for cut in (split.stratified_split, split.hash_split):
        one = {tuple(r) for r in cut(users(500, 100)).collect()}
        assert one == {tuple(r) for r in cut(users(500, 100).repartition(5)).collect()}
        other = {tuple(r) for r in cut(users(500, 100), seed=7).collect()}
        assert one != other and len(one) == 500


def test_hash_split_needs_no_exchange(users):
    assert "Exchange" not in split.hash_split(users(10, 5))._jdf.queryExecution().executedPlan().toString()


def metric_table(spark, **values):
    return spark.createDataFrame([(n, n, "auc", v) for n, v in values.items()], "run_id string, run_name string, metric string, value double")


@pytest.mark.parametrize(
    "values,winner",
    [
        (dict(random_forest=0.8, logistic_regression=0.8), "random_forest"),
        (dict(random_forest=0.7, logistic_regression=0.8), "logistic_regression"),
        (dict(random_forest=None, logistic_regression=0.1), "logistic_regression"),
        (dict(random_forest=None, logistic_regression=None), "random_forest"),
    ],
)
def test_best_run(spark, values, winner):
    assert runs.best_run(metric_table(spark, **values)).first()["run_name"] == winner


def feature_rows(spark, n=200):
    """Purchases grow with the number of views."""
    u = F.col("id")
    return features.with_label(
        spark.range(n).select(
            u.alias("user_id"),
            (u % 10 + 1).alias("total_events"),
            F.when(u % 10 > 5, 1).otherwise(0).cast("bigint").alias("purchases"),
            (u % 10).alias("views"),
            (u % 3).alias("cart_adds"),
            F.when(u % 10 > 5, 9.5).otherwise(0.0).alias("total_spent"),
            (u % 7 + 1.0).alias("avg_price"),
            (u % 4).alias("unique_products"),
            F.lit(1).cast("bigint").alias("active_days"),
        )
    )


def test_feature_sets():
    assert "total_spent" in features.FEATURE_SETS["reference"] and len(features.FEATURE_SETS["reference"]) == 7
    left_out = set(features.FEATURE_SETS["reference"]) - set(features.FEATURE_SETS["no_leak"])
    assert left_out == {"total_spent", "total_events", "unique_products"}


def test_no_mix_of_the_features_gives_the_purchases(spark):
    users = gold.user_features(cleaning.clean(raw_events(spark, "/root/testdata/sf0.01"))).toPandas()
    target = users["purchases"].to_numpy(float)

    def share_left(feature_set):
        columns = users[list(features.FEATURE_SETS[feature_set])].to_numpy(float)
        columns = numpy.column_stack([columns, numpy.ones(len(columns))])
        rest = target - columns @ numpy.linalg.lstsq(columns, target, rcond=None)[0]
        return (rest**2).sum() / ((target - target.mean()) ** 2).sum()

    assert share_left("reference") < 1e-9  # the leak, as it was
    assert share_left("no_leak") > 0.5


SCORES = """
import sys
from lakepipe.session import local_session
from lakepipe.ml import features, split
from lakepipe.ml.training import apply, fit
cores, path = sys.argv[1:]
spark = local_session(cores, 4, "2g")
table = spark.read.parquet(path)
rows = table.where("is_train").count()
scored = apply(fit(table.where("is_train"), "random_forest", "no_leak", rows), table)
print(sorted((r["user_id"], r["score"]) for r in scored.collect()))
"""


def test_the_same_forest_on_other_cores(spark, tmp_path):
    path = str(tmp_path / "parts")
    split.stratified_split(feature_rows(spark)).repartition(5).write.parquet(path)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    found = {
        subprocess.run(
            [sys.executable, "-c", SCORES, cores, path], cwd=root, capture_output=True, text=True, check=True, timeout=300
        ).stdout
        for cores in ("2", "4")
    }
    assert len(found) == 1 and len(found.pop()) > 1000


def test_run_is_logged_and_the_model_reloads(spark, tmp_path):
    log = runs.RunLog(spark, str(tmp_path))
    parts = written_once(split.stratified_split(feature_rows(spark)), "parts")
    trained = [train_and_log(parts, kind, log) for kind in PRIORITY]
    table = {(r["run_id"], r["kind"], r["key"]): r["value"] for r in log.table().collect()}
    for run in trained:
        assert table[run.run_id, "param", "train_size"] == "160"
        assert float(table[run.run_id, "metric", "auc"]) == run.metrics["auc"] > 0.9
        again = log.load_model(run.run_id)
        before = {tuple(r) for r in as_predictions(apply(run.model, parts)).collect()}
        assert {tuple(r) for r in as_predictions(apply(again, parts)).collect()} == before
    compared = {r["metric"]: r for r in runs.compare(runs.metric_rows(log.table())).collect()}
    assert set(compared) == {"auc", "f1_score", "accuracy"}
    assert compared["auc"]["random_forest"] == trained[0].metrics["auc"]


def test_the_same_model_from_other_partitions(spark):
    """Not so without the fixed order: bagging draws per row and partition."""
    predictions = set()
    for parts in (1, 3):
        frame = split.stratified_split(feature_rows(spark).repartition(parts))
        table = written_once(split.in_fixed_order(frame, 200), "parts")
        scored = apply(fit(table.where("is_train"), "random_forest", "no_leak", 160), table)
        predictions.add(tuple(sorted((r["user_id"], r["score"]) for r in scored.collect())))
    assert len(predictions) == 1


@pytest.mark.parametrize("kind", PRIORITY)
def test_one_class_only_does_not_crash(spark, kind):
    rows = feature_rows(spark).withColumn("label", F.lit(0))
    scored = apply(fit(rows, kind, "no_leak", 200), rows)
    assert scored.where("prediction <> 0").isEmpty()
    assert metrics.roc_auc(scored).first()["auc"] is None


def area(pairs):
    pos, neg = [s for s, y in pairs if y == 1], [s for s, y in pairs if y == 0]
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg)) if pos and neg else None


@pytest.mark.parametrize("bins", [1, 7, 1000])
@pytest.mark.parametrize("low,high", [(0.0, 1.0), (0.3, 0.6), (-5.0, 5.0)])
def test_area_lies_within_the_histogram_bounds(spark, bins, low, high):
    rng = random.Random(bins)
    pairs = [(rng.random(), rng.randint(0, 1)) for _ in range(300)] + [(0.5, 1), (0.5, 0), (0.0, 1), (1.0, 0)]
    scored = spark.createDataFrame(pairs, "score double, label int")
    r = metrics.auc_bounds(scored, bins, low, high).first()
    assert r["lower"] <= area(pairs) <= r["upper"] and abs(r["auc"] - area(pairs)) <= r["error_bound"] + 1e-12
    assert r["bins_used"] <= bins + 2
    assert abs(r["upper"] - r["lower"] - 2 * r["error_bound"]) < 1e-12


def test_more_bins_narrow_the_bound_to_the_exact_area(spark):
    pairs = [(k / 512, (k * 7919) % 3 == 0) for k in range(512)]
    scored = spark.createDataFrame([(s, int(y)) for s, y in pairs], "score double, label int")
    bounds = [metrics.auc_bounds(scored, bins).first()["error_bound"] for bins in (4, 64, 512)]
    assert bounds[0] > bounds[1] > bounds[2] == 0.0
    assert metrics.auc_bounds(scored, 512).first()["auc"] == metrics.roc_auc(scored).first()["auc"]


def test_odd_scores_have_bins_of_their_own(spark):
    odd = [(float("nan"), 1), (float("inf"), 1), (-float("inf"), 0), (None, 1), (0.2, 0)]
    r = metrics.auc_bounds(spark.createDataFrame(odd, "score double, label int"), 10).first()
    assert (r["auc"], r["error_bound"], r["bins_used"]) == (1.0, 0.0, 4)
    one = spark.createDataFrame([(0.2, 1)], "score double, label int")
    assert metrics.auc_bounds(one).first()["auc"] is None and metrics.auc_bounds(one.where("false")).first()["auc"] is None
