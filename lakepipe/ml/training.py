"""Fit, evaluate, log and compare the two purchase models on Spark ML."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from lakepipe.ml import features, metrics
from lakepipe.ml.runs import PRIORITY, RunLog, best_run, metric_rows
from lakepipe.ml.split import in_fixed_order

# The hyper-parameters.
TREES = 100
DEPTH = 5
ITERATIONS = 100
SEED = 42

ROWS_PER_PARTITION = 20_000


def estimator(kind: str, train_rows: int):
    if kind == "random_forest":
        return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED)
    if kind == "logistic_regression":
        # An L2 penalty of 1 on the raw features against the summed loss; Spark averages the loss.
        return LogisticRegression(
            maxIter=ITERATIONS, regParam=1.0 / max(train_rows, 1), elasticNetParam=0.0, standardization=False
        )
    raise ValueError(f"unknown model {kind!r}")


def parameters(kind: str) -> dict[str, object]:
    if kind == "random_forest":
        return {"model_type": "RandomForestClassifier", "n_estimators": TREES, "max_depth": DEPTH}
    return {"model_type": "LogisticRegression", "max_iter": ITERATIONS}


def fit(train: DataFrame, kind: str, feature_set: str, train_rows: int, key: str = "user_id") -> PipelineModel:
    """Fit on partitions whose number, rows and order follow from the keys and the number of rows alone.

    Bagging draws per row and partition, and how files are packed into input splits depends on the
    number of cores; so the rows are dealt out anew, just before the fit.
    """
    dealt = in_fixed_order(train, train_rows, key, ROWS_PER_PARTITION)
    return Pipeline(stages=[features.assembler(feature_set), estimator(kind, train_rows)]).fit(dealt)


def apply(model: PipelineModel, frame: DataFrame) -> DataFrame:
    """Add ``prediction`` (int) and ``score`` (probability of class 1)."""
    scored = model.transform(frame)
    probability = vector_to_array("probability")
    # A model fitted on one class only has no second entry.
    return scored.withColumns(
        {
            "score": F.coalesce(F.try_element_at(probability, F.lit(2)), F.lit(0.0)),
            "prediction": F.col("prediction").cast("int"),
        }
    ).drop("features", "rawPrediction", "probability")


@dataclass(frozen=True)
class Trained:
    run_id: str
    kind: str
    model: PipelineModel
    metrics: dict[str, float | None]


def train_and_log(split: DataFrame, kind: str, log: RunLog, feature_set: str = features.DEFAULT_FEATURES) -> Trained:
    """One run over a frame with ``label`` and ``is_train``.

    The fit passes over the rows many times, so ``split`` should come from a published table.
    What reaches the driver are two counts, the model and three numbers.
    """
    sizes = split.agg(
        F.count_if("is_train").alias("train"), F.count_if(~F.col("is_train")).alias("test")
    ).first()
    run_id = log.start()
    shape = {
        "features": ",".join(features.FEATURE_SETS[feature_set]),
        "train_size": sizes["train"],
        "test_size": sizes["test"],
    }
    log.log(run_id, kind, param={**parameters(kind), **shape})
    columns = [*features.FEATURE_SETS[feature_set], "label"]
    model = fit(split.where("is_train").select("user_id", *columns), kind, feature_set, sizes["train"])
    scored = log.save_scored(run_id, apply(model, split.where("NOT is_train").select(*columns)))
    measured = {row["metric"]: row["value"] for row in metrics.evaluate(scored).collect()}
    log.log(run_id, kind, metric=measured, model={"uri": log.save_model(run_id, model)})
    return Trained(run_id, kind, model, measured)


def train_all(split: DataFrame, log: RunLog, feature_set: str = features.DEFAULT_FEATURES) -> str:
    """Train both models and return the winner's run id."""
    runs = [train_and_log(split, kind, log, feature_set).run_id for kind in PRIORITY]
    mine = metric_rows(log.table()).where(F.col("run_id").isin(runs))
    return best_run(mine).first()["run_id"]
