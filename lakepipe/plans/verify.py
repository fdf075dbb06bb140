"""Checks over the published tables that can fail."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from lakepipe.schemas import BRONZE, DAILY, LAYERS, PREDICTIONS, SILVER, TABLE_KEYS, USERS


def _measure(name: str, frame: DataFrame, value) -> DataFrame:
    return frame.agg(F.coalesce(value, F.lit(0)).cast("bigint").alias("value")).select(
        F.lit(name).alias("measure"), "value"
    )


def _repeated_keys(table: str, frame: DataFrame) -> DataFrame:
    repeated = frame.groupBy(*TABLE_KEYS[table]).count().where("count > 1")
    return _measure(f"repeated {table}", repeated, F.count(F.lit(1)))


def layer_checks(tables: dict[str, DataFrame | None]) -> DataFrame:
    """One row (check, relation, expected, actual, ok) per check.

    A table that is absent (``None``) has 0 rows, so its own check fails and so do those that
    compare it. The measures are one-row aggregates, put side by side by one more aggregate.
    """
    present = {name: tables[name] for name in LAYERS if tables.get(name) is not None}
    measures = [_measure(f"rows {name}", frame, F.count(F.lit(1))) for name, frame in present.items()]
    measures += [_repeated_keys(name, frame) for name, frame in present.items() if name in TABLE_KEYS]
    for name, column in ((DAILY, "total_purchases"), (USERS, "purchases")):
        if name in present:
            measures.append(_measure(f"purchases {name}", present[name], F.sum(column)))
    if not measures:
        raise LookupError("none of the tables exists")

    def of(measure: str):
        return F.coalesce(F.max(F.when(F.col("measure") == measure, F.col("value"))), F.lit(0))

    checks = [(f"{name} has rows", ">=", F.lit(1).cast("bigint"), of(f"rows {name}")) for name in LAYERS]
    checks += [
        ("cleaning adds no rows", "<=", of(f"rows {BRONZE}"), of(f"rows {SILVER}")),
        ("every user is scored", "=", of(f"rows {USERS}"), of(f"rows {PREDICTIONS}")),
        ("purchases agree", "=", of(f"purchases {DAILY}"), of(f"purchases {USERS}")),
    ]
    checks += [(f"{name} keys are unique", "=", F.lit(0).cast("bigint"), of(f"repeated {name}")) for name in TABLE_KEYS]
    rows = F.array(
        *[
            F.struct(
                F.lit(check).alias("check"),
                F.lit(relation).alias("relation"),
                expected.alias("expected"),
                actual.alias("actual"),
            )
            for check, relation, expected, actual in checks
        ]
    )
    ok = (
        F.when(F.col("relation") == ">=", F.col("actual") >= F.col("expected"))
        .when(F.col("relation") == "<=", F.col("actual") <= F.col("expected"))
        .otherwise(F.col("actual") == F.col("expected"))
    )
    united = reduce(DataFrame.unionByName, measures)
    return united.agg(rows.alias("rows")).select(F.inline("rows")).withColumn("ok", ok)
