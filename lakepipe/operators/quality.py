"""Profiles and checks of a frame before it is cleaned or appended."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

PROBLEM_DDL = "column_name string, problem string, expected string, actual string"


def null_profile(frame: DataFrame) -> DataFrame:
    """Number of NULLs per column, in one pass; 0 for an empty frame."""
    return frame.select(*[F.count_if(F.col(c).isNull()).alias(c) for c in frame.columns])


def schema_report(frame: DataFrame) -> DataFrame:
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(frame.schema, 1)]
    return frame.sparkSession.createDataFrame(rows, "ordinal int, name string, type string, nullable boolean")


def schema_problems(actual: T.StructType, expected: T.StructType) -> list[tuple[str, str, str | None, str | None]]:
    """(column, problem, expected type, actual type) for each missing, extra or mistyped column."""
    have = {f.name: f.dataType.simpleString() for f in actual}
    want = {f.name: f.dataType.simpleString() for f in expected}
    found = []
    for name in sorted(have.keys() | want.keys()):
        if name not in have:
            found.append((name, "missing", want[name], None))
        elif name not in want:
            found.append((name, "unexpected", None, have[name]))
        elif have[name] != want[name]:
            found.append((name, "type", want[name], have[name]))
    return found


def check_schema(frame: DataFrame, expected: T.StructType) -> DataFrame:
    """The problems as rows; empty when ``frame`` may be appended."""
    return problems_frame(frame.sparkSession, schema_problems(frame.schema, expected))


def problems_frame(spark: SparkSession, problems: list) -> DataFrame:
    return spark.createDataFrame(problems, PROBLEM_DDL)
