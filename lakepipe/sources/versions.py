"""Published tables with a version log.

A publish writes all files of the new version into a folder of its own with a name that is used once,
and only then adds the version to the table's log: one small file set per version, whose folder must
not exist yet, so of two writers that choose the same number one fails. Readers pick the folders from
the log, so a publish that dies half-way is never seen, a table may be read while its successor is
written, and older versions stay readable. An append adds one folder and lists the earlier ones again;
nothing is rewritten.

The first version of a table must have the columns its contract asks for; every later one must have
exactly the columns and types of the version before it, unless a new schema is asked for.
"""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql import types as T

from lakepipe.operators.quality import schema_problems
from lakepipe.schemas import CONTRACT_DDL, contract, parse
from lakepipe.session import stored_bytes
from lakepipe.sources.tables import SchemaMismatch, require_schema

LOG_DDL = (
    "version bigint, timestamp timestamp, operation string, operationMetrics map<string,string>, "
    "folders array<string>, schema string"
)


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _log_path(self, table: str) -> str:
        return f"{self.root}/{table}/log"

    def _log(self, table: str) -> DataFrame | None:
        try:
            return (
                self.spark.read.schema(LOG_DDL).option("recursiveFileLookup", "true").parquet(self._log_path(table))
            )
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def history(self, table: str) -> DataFrame:
        """Newest first; empty for a table that was never published."""
        log = self._log(table)
        if log is None:
            log = self.spark.createDataFrame([], parse(LOG_DDL))
        return log.select("version", "timestamp", "operation", "operationMetrics").orderBy(F.desc("version"))

    def _entry(self, table: str, version: int | None = None) -> Row | None:
        """The log row of a version, of the newest one by default."""
        log = self._log(table)
        if log is None:
            return None
        chosen = log if version is None else log.where(F.col("version") == version)
        return chosen.orderBy(F.desc("version")).limit(1).first()

    def rows(self, table: str) -> int:
        """Rows of the newest version, as logged."""
        return int(self._entry(table)["operationMetrics"]["numOutputRows"])

    def _commit(self, table: str, frame: DataFrame, operation: str, before: Row | None, kept: list[str]) -> DataFrame:
        version = before["version"] + 1 if before else 0
        folder = f"{self.root}/{table}/data-{uuid.uuid4().hex}"
        frame.write.parquet(folder)
        added = self.spark.read.schema(frame.schema).parquet(folder)
        files, size = stored_bytes(self.spark, folder)
        metrics = {"numFiles": files, "numOutputRows": added.count(), "numOutputBytes": size}  # rows: from the footers
        if kept:
            metrics = {k: v + int(before["operationMetrics"][k]) for k, v in metrics.items()}
        row = self.spark.range(0, 1, 1, 1).select(
            F.lit(version).cast("bigint").alias("version"),
            F.current_timestamp().alias("timestamp"),
            F.lit(operation).alias("operation"),
            F.create_map(*[F.lit(str(x)) for pair in metrics.items() for x in pair]).alias("operationMetrics"),
            F.array(*[F.lit(f) for f in [*kept, folder]]).alias("folders"),
            F.lit(frame.schema.json()).alias("schema"),
        )
        row.write.mode("error").parquet(f"{self._log_path(table)}/{version:020d}")
        return self.read(table, version)

    def publish(
        self, frame: DataFrame, table: str, operation: str = "WRITE", overwrite_schema: bool = False
    ) -> DataFrame:
        """Write ``frame`` as the table's next version and return that version, read from its files."""
        before = self._entry(table)
        if before and not overwrite_schema:
            require_schema(frame, _schema(before), table)
        if table in CONTRACT_DDL:
            problems = [p for p in schema_problems(frame.schema, contract(table)) if p[1] != "unexpected"]
            if problems:
                raise SchemaMismatch(table, problems)
        return self._commit(table, frame, operation, before, [])

    def append(self, frame: DataFrame, table: str) -> DataFrame:
        """Add the rows of ``frame`` as the next version; the files of the version before it are part of it."""
        before = self._entry(table)
        if before is None:
            raise LookupError(f"{table} has no published version")
        expected = _schema(before)
        require_schema(frame, expected, table)
        return self._commit(table, frame.select(*expected.names), "APPEND", before, list(before["folders"]))

    def read(self, table: str, version: int | None = None) -> DataFrame:
        entry = self._entry(table, version)
        if entry is None:
            raise LookupError(f"{table} has no published version {'' if version is None else version}".rstrip())
        return self.spark.read.schema(_schema(entry)).parquet(*entry["folders"])

    def register(self, table: str) -> None:
        """Point the catalog view ``schema.table`` at the newest version."""
        folders = self._entry(table)["folders"]
        self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {table.split('.')[0]}")
        union = " UNION ALL ".join(f"SELECT * FROM parquet.`{folder}`" for folder in folders)
        self.spark.sql(f"CREATE OR REPLACE VIEW {table} AS {union}")


def _schema(entry: Row) -> T.StructType:
    return T.StructType.fromJson(json.loads(entry["schema"]))
