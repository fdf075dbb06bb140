"""Lay a table's rows out in files so that a filter on any of its leading columns reads little."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def laid_out(frame: DataFrame, columns: Sequence[str], files: int) -> DataFrame:
    """The same rows in ``files`` ranges of ``columns``, each range sorted by the last of them first.

    A range holds a narrow part of the first column, so a filter on it skips files; within a file the rows of one
    value of the last column lie together, so a filter on that one skips row groups and pages. Spark's sample of
    the rows sets the borders. Rows that agree in all columns are told apart by a hash of their place, so that a
    value with a third of all rows, even of exact copies, fills as many files as its size asks for.
    """
    if files <= 1:
        return frame.coalesce(1).sortWithinPartitions(*reversed(columns))
    place = "_place"
    while place in frame.columns:
        place += "_"
    placed = frame.withColumn(place, F.xxhash64(F.monotonically_increasing_id()))
    ranged = placed.repartitionByRange(files, *columns, place)
    return ranged.sortWithinPartitions(*reversed(columns)).drop(place)
