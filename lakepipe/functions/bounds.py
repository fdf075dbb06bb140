"""Quantile bounds of a column, used to cut work or files into even ranges."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, functions as F

SAMPLE_ROWS = 1_000_000


def quantile_bounds(frame: DataFrame, columns: list[str], buckets: int) -> list[list[float]]:
    """At most ``buckets - 1`` increasing cut points per numeric column.

    Only the cut points are estimated, from about a million rows, so what reaches the driver is
    bounded by ``buckets``. Callers use them to place rows; no row is left out because of them and
    no result value depends on them.
    """
    narrow = frame.select(*columns)
    rows = narrow.count()
    if rows > SAMPLE_ROWS:
        narrow = narrow.sample(fraction=SAMPLE_ROWS / rows, seed=42)
    finite = narrow.select(
        *[F.when(F.abs(F.col(c)) < float("inf"), F.col(c).cast("double")).alias(c) for c in columns]
    )
    shares = [i / buckets for i in range(1, buckets)]
    found = finite.approxQuantile(columns, shares, 1 / (2 * buckets))
    return [sorted(set(cuts)) for cuts in found]


def with_buckets(frame: DataFrame, bounds: dict[str, list[float]], suffix: str = "_bucket") -> DataFrame:
    """Add ``<column><suffix>``: the index of the range a value falls in (binary search in the JVM)."""
    # Bucketizer wants two ranges at least, also for a column without values.
    edges = [[float("-inf"), *(cuts or [0.0]), float("inf")] for cuts in bounds.values()]
    return Bucketizer(
        splitsArray=edges,
        inputCols=list(bounds),
        outputCols=[f"{c}{suffix}" for c in bounds],
        handleInvalid="keep",
    ).transform(frame)
