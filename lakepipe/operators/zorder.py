"""Rewrite a table so that a filter on any of several columns skips files.

Each column is cut into ranges of about equal row counts. The range numbers are stretched over the
full width of bits, so that a column with three values decides as much about the files as one with
three million; their bits are interleaved into one sort value. Rows are counted per cell of that curve, and
whole cells are laid into files of about equal size, so that no file straddles a border it need not.
Every file then covers a small box of the columns, which the files' min/max statistics expose to the
scan; within a file the rows are sorted along the curve and then by the columns' whole values.

The table is read four times: twice for the counts and the cut points, once for the cells, all three
narrow, and once to be written. The driver sees cut points only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from lakepipe.functions.bounds import quantile_bounds, with_buckets

_PREFIX_BYTES = 6  # 48 bits, exact in a double; only cells are told apart by them, not rows
_MOST_BITS = 12  # of one column: its cut points pass the driver
_CELLS_PER_FILE_BITS = 3


def _common_prefix(frame: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """Length of the prefix all values of a text column share, from its smallest and largest one."""
    if not columns:
        return {}
    ends = frame.agg(*[f(c).alias(f"{c}_{n}") for c in columns for n, f in (("lo", F.min), ("hi", F.max))]).first()
    shared = {}
    for c in columns:
        lo, hi = ends[f"{c}_lo"] or "", ends[f"{c}_hi"] or ""
        same = 0
        while same < min(len(lo), len(hi)) and lo[same] == hi[same]:
            same += 1
        shared[c] = same
    return shared


def _as_number(name: str, kind: T.DataType, skip: int) -> Column:
    """A double that orders like the column; NULL comes first."""
    value = F.col(name)
    if isinstance(kind, T.StringType):
        head = F.substring(F.substring(value, skip + 1, _PREFIX_BYTES).cast("binary"), 1, _PREFIX_BYTES)
        number = F.conv(F.rpad(F.hex(head), 2 * _PREFIX_BYTES, "0"), 16, 10).cast("double")
    elif isinstance(kind, T.DateType):
        number = F.unix_date(value).cast("double")
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        number = F.unix_micros(value.cast("timestamp")).cast("double")
    else:
        number = value.cast("double")
    return F.coalesce(number, F.lit(float("-inf")))


def _interleaved(buckets: Sequence[Column], bits: int) -> Column:
    width = len(buckets)
    z = F.lit(0).cast("bigint")
    for position, bucket in enumerate(buckets):
        for bit in range(bits):
            taken = F.shiftright(bucket, bit).bitwiseAND(F.lit(1).cast("bigint"))
            z = z.bitwiseOR(F.shiftleft(taken, bit * width + width - 1 - position))
    return z


def depth(files: int, width: int) -> int:
    """Bits per column: enough for all columns together to tell a few cells per file apart."""
    return max(2, min(_MOST_BITS, 63 // width, files.bit_length() + 2))


def zorder(frame: DataFrame, columns: Sequence[str], files: int) -> DataFrame:
    """The same rows in ``files`` range partitions along the Z-order curve of ``columns``.

    One pair of values may hold a third of all rows. A cell with more rows than a file takes, even of
    exact copies, is cut by a hash of the rows' places over as many files as its size asks for. A table
    that fits one file is not laid out at all.
    """
    if files <= 1:
        return frame.coalesce(1)
    bits = depth(files, len(columns))
    kinds = {f.name: f.dataType for f in frame.schema}
    skip = _common_prefix(frame, [c for c in columns if isinstance(kinds[c], T.StringType)])
    numbers = {f"_z_{c}": _as_number(c, kinds[c], skip.get(c, 0)) for c in columns}
    ranged = frame.withColumns(numbers)
    bounds = dict(zip(numbers, quantile_bounds(ranged, list(numbers), 2**bits - 1), strict=True))
    placed = with_buckets(ranged, bounds)
    top = F.lit(2**bits - 1).cast("bigint")
    stretched = [
        F.least(F.floor(F.col(f"{n}_bucket") * 2**bits / max(2, len(cuts) + 1)).cast("bigint"), top)
        for n, cuts in bounds.items()
    ]
    curve = _interleaved(stretched, bits)
    shift = max(0, bits * len(columns) - files.bit_length() - _CELLS_PER_FILE_BITS)
    keyed = placed.withColumns({"_z": curve, "_cell": F.shiftright(curve, shift)})
    counted = keyed.groupBy("_cell").agg(F.count(F.lit(1)).alias("_rows"))
    along = Window.orderBy("_cell")  # at most a few cells per file
    target = F.sum("_rows").over(Window.partitionBy(F.lit(0))) / files
    placed_cells = counted.select(
        "_cell",
        (F.sum("_rows").over(along.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_rows")).alias("_before"),
        "_rows",
        target.alias("_target"),
    )
    part = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 20)) / (1 << 20)
    at = F.when(F.col("_rows") > F.col("_target"), part).otherwise(0.5)
    file = F.floor((F.col("_before") + at * F.col("_rows")) / F.col("_target")).cast("int")
    # Cells are bounded by the number of files, not by the rows.
    located = keyed.join(F.broadcast(placed_cells), "_cell").withColumn("_file", F.least(file, F.lit(files - 1)))
    return (
        located.repartitionById(files, "_file")
        .sortWithinPartitions("_z", *columns)
        .select(*frame.columns)
    )
