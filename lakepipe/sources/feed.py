"""The raw event feed: CSV files with a header."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from lakepipe.schemas import UNREADABLE, raw_schema

_LINE = "_line"


def declared_schema(spark: SparkSession, path: str) -> T.StructType:
    """The header's columns in file order: known ones with their contract type, others as text.

    Reads one line. Type inference would read the whole feed once more and would make the width of
    the ids depend on the data.
    """
    known = {field.name: field.dataType for field in raw_schema()}
    header = spark.read.option("header", True).csv(path).columns
    return T.StructType([T.StructField(name, known.get(name, T.StringType())) for name in header])


def read_csv_events(spark: SparkSession, path: str, infer_schema: bool = False) -> DataFrame:
    """The feed's rows, and the whole line as text in ``UNREADABLE`` where a value does not fit its type.

    Such a value is NULL in its own column. The cleaning step rejects the row under its own reason.
    """
    reader = spark.read.option("header", True)
    if infer_schema:
        return reader.option("inferSchema", True).csv(path)
    # With enforceSchema off, every file's header is compared with the schema, so a file whose
    # columns stand in another order fails instead of being read into the wrong columns.
    declared = declared_schema(spark, path)
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in declared]).add(_LINE, "string")
    reader = reader.option("enforceSchema", False).option("columnNameOfCorruptRecord", _LINE)
    lines = reader.schema(text).csv(path)
    typed = {f.name: _typed(f) for f in declared}
    unfit = [F.col(f.name).isNotNull() & typed[f.name].isNull() for f in declared]
    # Of a line with too few or too many values the parser keeps the text. The expression reads every column,
    # so that a query which selects a few of them judges the line by all.
    line = F.concat_ws(",", *[F.coalesce(f.name, F.lit("")) for f in declared])
    unreadable = F.coalesce(_LINE, F.when(reduce(Column.__or__, unfit), line))
    return lines.select(*[typed[f.name].alias(f.name) for f in declared], unreadable.alias(UNREADABLE))


def _typed(field: T.StructField) -> Column:
    """The value in its declared type, NULL if its text does not fit."""
    value = F.trim(field.name)
    if isinstance(field.dataType, T.StringType):
        return F.col(field.name)
    if isinstance(field.dataType, T.LongType):  # a cast alone would cut 1.5 to 1
        value = F.when(value.rlike("^[+-]?[0-9]+$"), value)
    return value.try_cast(field.dataType)


def stamp_ingestion(frame: DataFrame, at: Column | None = None) -> DataFrame:
    """Add the audit column; pass ``at`` to make a run reproducible."""
    return frame.withColumn("ingestion_ts", F.current_timestamp() if at is None else at)
