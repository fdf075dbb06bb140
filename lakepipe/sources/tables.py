"""Catalog tables: the three layers as schemas, managed writes, and appends that are checked first."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lakepipe.operators.quality import schema_problems

LAYER_SCHEMAS = ("bronze", "silver", "gold")
REPORTED_CHARS = 80


class SchemaMismatch(ValueError):
    def __init__(self, target: str, problems: list):
        self.problems = problems
        listed = ", ".join(f"{name}: {problem}" for name, problem, _, _ in problems)
        super().__init__(f"append to {target} rejected ({listed})")


def create_layers(spark: SparkSession) -> None:
    for name in LAYER_SCHEMAS:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")


def save_table(frame: DataFrame, table: str) -> None:
    frame.write.mode("overwrite").saveAsTable(table)


def require_schema(frame: DataFrame, expected: T.StructType, target: str) -> None:
    problems = schema_problems(frame.schema, expected)
    if problems:
        raise SchemaMismatch(target, problems)


def append_table(frame: DataFrame, table: str) -> None:
    require_schema(frame, frame.sparkSession.table(table).schema, table)
    frame.write.mode("append").saveAsTable(table)


def append_files(frame: DataFrame, path: str, expected: T.StructType) -> None:
    """Append to a folder of parquet files.

    Spark itself accepts any columns here, and later reads one schema's columns as NULL for the
    files written with the other one.
    """
    require_schema(frame, expected, path)
    frame.select(*expected.names).write.mode("append").parquet(path)


def append_outcome(append, *args) -> tuple[bool, str]:
    """(accepted, first 80 characters of why not). Only a schema mismatch counts as a rejection."""
    try:
        append(*args)
    except SchemaMismatch as error:
        return False, str(error)[:REPORTED_CHARS]
    return True, ""
