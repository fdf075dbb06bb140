"""Layer tables in Spark's own catalog: partitioned by day, or bucketed by a key, and counted while they are written.

A publish replaces a table, an append adds files, and re-running days replaces their partitions only. An
append or a re-run must have exactly the table's columns and types; Spark alone would fill or cast some
of them. Rows and NULLs are counted by the write itself, so no profile reads a table a second time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from lakepipe.session import scratch_dir
from lakepipe.sources.tables import require_schema

DAY = "event_date"
VERSION, OPERATION = "version", "operation"
ROWS = "rows"


def scratch_schema(spark: SparkSession, purpose: str) -> str:
    """A new schema whose tables lie in the session's shared scratch folder."""
    name = f"lakepipe_{purpose}_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE SCHEMA {name} LOCATION '{scratch_dir(spark, purpose)}'")
    return name


def with_day(frame: DataFrame) -> DataFrame:
    """The day of the event as the last column, which tables are partitioned by; a NULL time has a partition of its own."""
    return frame.withColumn(DAY, F.to_date("event_time"))


def day_last(frame: DataFrame) -> DataFrame:
    return frame.select(*[c for c in frame.columns if c != DAY], DAY)


def _apart(frame: DataFrame) -> DataFrame:
    """The same plan in a copy of its session, with the same settings and tables.

    A session of Spark 4.1 that was ever used to observe keeps an object that cannot be sent to tasks, and models of
    Spark ML do send theirs. So each observed write has a session of its own.
    """
    spark = frame.sparkSession
    copy = spark._jsparkSession.cloneSession()
    plan = frame._jdf.queryExecution().analyzed()
    return DataFrame(spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(copy, plan), SparkSession(spark.sparkContext, copy))


def observed(frame: DataFrame) -> tuple[DataFrame, Observation]:
    """``frame`` in a session of its own, and the counts of its rows and of each column's NULLs that its next action
    leaves behind."""
    counts = Observation(f"profile-{uuid.uuid4().hex}")
    nulls = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"null {c}") for c in frame.columns]
    return _apart(frame).observe(counts, F.count(F.lit(1)).alias(ROWS), *nulls), counts


def _written(counts: Observation, frame: DataFrame, table: str) -> dict[str, int]:
    """The counts of a write that is done. A plan that Spark has found to be empty leaves none: all are 0."""
    frame.sparkSession.catalog.refreshTable(table)  # the files it knows are from before
    if counts._jo.getRow().length():
        return counts.get
    return {ROWS: 0} | {f"null {c}": 0 for c in frame.columns}


def null_counts(profile: dict[str, int]) -> dict[str, int]:
    """Column to number of NULLs, of a profile as the writes here return it."""
    return {name.removeprefix("null "): n for name, n in profile.items() if name != ROWS}


def create(spark: SparkSession, table: str, ddl: str, by: str | None = DAY) -> None:
    """An empty table of the given columns."""
    spark.sql(f"CREATE TABLE {table} ({ddl}) USING parquet" + (f" PARTITIONED BY ({by})" if by else ""))


def publish(frame: DataFrame, table: str, by: str | None = DAY) -> dict[str, int]:
    """Write ``frame`` as the table's whole content, one partition per value of ``by``; returns the write's counts.

    ``table`` must not be among the sources of ``frame``. Rows are dealt by the partition column and, within a day,
    at random, so that adaptive execution writes files of a useful size and a day with most of the rows is split.
    """
    counted, counts = observed(frame)
    if by:
        counted = counted.hint("rebalance", by)
    writer = counted.write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).saveAsTable(table)
    return _written(counts, frame, table)


def append(frame: DataFrame, table: str) -> dict[str, int]:
    """Add rows; a frame with other columns or types is refused before anything is written."""
    expected = frame.sparkSession.table(table).schema
    require_schema(frame, expected, table)
    counted, counts = observed(frame.select(*expected.names))
    counted.write.mode("append").insertInto(table)
    return _written(counts, frame, table)


def replace_days(frame: DataFrame, table: str) -> dict[str, int]:
    """Replace the partitions ``frame`` has rows of and leave all others as they are."""
    expected = frame.sparkSession.table(table).schema
    require_schema(frame, expected, table)
    counted, counts = observed(frame.select(*expected.names))
    # Given as the writer's option it would not reach an insert into a table of the catalog.
    counted.sparkSession.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    counted.write.mode("overwrite").insertInto(table)
    return _written(counts, frame, table)


def publish_bucketed(frame: DataFrame, table: str, key: str, buckets: int) -> dict[str, int]:
    """Write ``frame`` into ``buckets`` files by the hash of ``key``, sorted by it.

    Plans that group or join by ``key`` read a bucket per task and need no exchange. A key with a large share of all
    rows makes a large bucket, which one task reads as a stream; tables with such keys are better read unbucketed,
    where the aggregates of this package split them.
    """
    counted, counts = observed(frame)
    counted.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return _written(counts, frame, table)


def files_by_day(spark: SparkSession, table: str) -> DataFrame:
    """(day, file) of every file of a table partitioned by day; reads no column."""
    return spark.table(table).select(DAY, F.col("_metadata.file_path").alias("file")).distinct()


def publish_version(frame: DataFrame, table: str, operation: str = "WRITE") -> dict[str, int]:
    """Add ``frame`` as the table's next version, from 0, and return the write's counts.

    A later version must have exactly the columns and types of the first. ``frame`` may come from an older version.
    A write that dies leaves no version: Spark adds the partition to the catalog when all files are there.
    """
    if not operation.isidentifier():
        raise ValueError(f"an operation is a plain word, not {operation!r}")
    spark, number = frame.sparkSession, 0
    if spark.catalog.tableExists(table):
        expected = spark.table(table).drop(VERSION, OPERATION).schema
        require_schema(frame, expected, table)
        frame = frame.select(*expected.names)
        number = 1 + max((r[VERSION] for r in _versions(spark, table).collect()), default=-1)
    counted, counts = observed(frame)
    labelled = counted.withColumns({VERSION: F.lit(number).cast("bigint"), OPERATION: F.lit(operation)})
    labelled.write.mode("append").partitionBy(VERSION, OPERATION).saveAsTable(table)
    written = _written(counts, frame, table)
    if not written[ROWS]:  # Spark writes no file for it, but the version exists
        spark.sql(f"ALTER TABLE {table} ADD PARTITION ({VERSION} = {number}, {OPERATION} = '{operation}')")
    return written


def _versions(spark: SparkSession, table: str) -> DataFrame:
    """(version, operation) as the catalog lists them; one row per version, reads no file."""
    return spark.sql(f"SHOW PARTITIONS {table}").select(
        F.regexp_extract("partition", f"{VERSION}=([0-9]+)/", 1).cast("bigint").alias(VERSION),
        F.regexp_extract("partition", f"/{OPERATION}=(.*)$", 1).alias(OPERATION),
    )


def version(spark: SparkSession, table: str, number: int | None = None) -> DataFrame:
    """The rows of a version, by default of the newest one; only its partition is read."""
    known = [r[VERSION] for r in _versions(spark, table).collect()]
    number = max(known, default=None) if number is None else number
    if number not in known:
        raise LookupError(f"{table} has no version {number}")
    return spark.table(table).where(F.col(VERSION) == number).drop(VERSION, OPERATION)


def history(spark: SparkSession, table: str) -> DataFrame:
    """(version, operation, rows) of every version, newest first; rows are counted from the files' footers."""
    rows = spark.table(table).groupBy(VERSION).agg(F.count(F.lit(1)).alias("rows"))
    listed = _versions(spark, table).join(rows, VERSION, "left").withColumn("rows", F.coalesce("rows", F.lit(0)))
    return listed.select(VERSION, OPERATION, "rows").orderBy(F.desc(VERSION))
