"""Training runs as a table: one row per parameter, metric and model of a run."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakepipe.schemas import parse

ROW_DDL = "run_id string, run_name string, kind string, key string, value string"
RUNS_DDL = f"{ROW_DDL}, logged_at timestamp"
PRIORITY = ("random_forest", "logistic_regression")  # who wins a tie


class RunLog:
    """Runs under one folder: the table in ``runs``, each run's model in ``models/<run_id>``, its scored test rows in ``scored/<run_id>``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def start(self) -> str:
        return uuid.uuid4().hex

    def log(self, run_id: str, run_name: str, **values: Mapping[str, object]) -> None:
        """``values`` maps a kind (param, metric, model) to its keys and values."""
        rows = [
            (run_id, run_name, kind, key, None if value is None else str(value))
            for kind, pairs in values.items()
            for key, value in pairs.items()
        ]
        plain = self.spark.createDataFrame(rows, ROW_DDL).coalesce(1)
        plain.withColumn("logged_at", F.current_timestamp()).write.mode("append").parquet(f"{self.root}/runs")

    def save_model(self, run_id: str, model: PipelineModel) -> str:
        uri = f"{self.root}/models/{run_id}"
        model.write().overwrite().save(uri)
        return uri

    def load_model(self, run_id: str) -> PipelineModel:
        return PipelineModel.load(f"{self.root}/models/{run_id}")

    def save_scored(self, run_id: str, scored: DataFrame) -> DataFrame:
        """Write what the metrics need, so that the model is applied once and not once per metric."""
        path = f"{self.root}/scored/{run_id}"
        scored.select("label", "prediction", "score").write.mode("overwrite").parquet(path)
        return self.scored(run_id)

    def scored(self, run_id: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/scored/{run_id}")

    def table(self) -> DataFrame:
        return self.spark.read.schema(parse(RUNS_DDL)).parquet(f"{self.root}/runs")


def metric_rows(runs: DataFrame) -> DataFrame:
    return runs.where("kind = 'metric'").select(
        "run_id", "run_name", F.col("key").alias("metric"), F.col("value").cast("double").alias("value")
    )


def compare(metrics: DataFrame, names: tuple[str, ...] = PRIORITY) -> DataFrame:
    """One row per metric, one column per run name (run names must be distinct)."""
    return metrics.groupBy("metric").pivot("run_name", list(names)).agg(F.first("value"))


def best_run(metrics: DataFrame, names: tuple[str, ...] = PRIORITY, by: str = "auc") -> DataFrame:
    """The run with the highest metric; on a tie the one named first; a NULL metric loses."""
    order = F.lit(len(names))
    for place, name in reversed(list(enumerate(names))):
        order = F.when(F.col("run_name") == name, place).otherwise(order)
    return (
        metrics.where(F.col("metric") == by)
        .orderBy(F.desc_nulls_last("value"), order.asc(), F.col("run_name").asc())
        .limit(1)
    )
