"""Session helpers: a local session for tests, scratch space, shuffle sizing."""

from __future__ import annotations

import math
import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

SHUFFLE_TARGET_BYTES = 64 * 1024 * 1024  # of parquet; two to three times that once decoded


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, memory: str = "12g", **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("lakepipe")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        # Recording the Python line of every column expression doubles the time to build a plan.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def importable_by_workers(spark: SparkSession) -> SparkSession:
    """Python workers look for this package where the driver found it.

    Enough where workers see the driver's folders; elsewhere install the package or pass it with --py-files.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = spark.sparkContext.environment
    known = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([*known, root])
    return spark


def _scratch_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh directory every executor can reach.

    The root is the session's ``spark.checkpoint.dir``; where that is unset, the session's warehouse
    folder, which a cluster shares as well. No folder of one machine is ever chosen here.
    """
    return f"{_scratch_root(spark)}/lakepipe/{purpose}-{uuid.uuid4().hex}"


def written_once(frame: DataFrame, purpose: str) -> DataFrame:
    """``frame`` as a table in the scratch folder.

    For a frame several later steps read: none of them repeats its work, and an executor lost in
    one of them costs no shuffle files of an earlier one.
    """
    spark = frame.sparkSession
    path = scratch_dir(spark, purpose)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def stored_bytes(spark: SparkSession, path: str, pattern: str = "*.parquet") -> tuple[int, int]:
    """(files, bytes) under ``path``; the file contents are pruned, only the listing is read."""
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(path)
    )
    row = listing.agg(F.count("path").alias("files"), F.sum("length").alias("bytes")).first()
    return row["files"], row["bytes"] or 0


def shuffle_partitions_for(input_bytes: int, floor: int) -> int:
    """One partition per 64 MB of stored input, whatever the size: 1.6 million for 100 TB."""
    return max(floor, math.ceil(input_bytes / SHUFFLE_TARGET_BYTES))


@contextmanager
def sized_shuffles(spark: SparkSession, input_bytes: int) -> Iterator[int]:
    """Within the block a shuffle partition holds about 64 MB of stored ``input_bytes``.

    Never lowers the session's own setting, which holds again after the block: adaptive execution merges
    partitions that turn out small, but cannot split an aggregation's or a window's that turn out too big.
    """
    key = "spark.sql.shuffle.partitions"
    own = spark.conf.get(key)
    wanted = shuffle_partitions_for(input_bytes, int(own))
    spark.conf.set(key, str(wanted))
    try:
        yield wanted
    finally:
        spark.conf.set(key, own)


def clear_scratch(spark: SparkSession) -> None:
    """Delete every scratch table of this package under the session's shared folder.

    Results that still read one fail afterwards; call it between jobs, not during them.
    """
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{_scratch_root(spark)}/lakepipe")
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
