"""Raw events to clean events: validity rules, one row per event key, derived columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakepipe.functions.columns import CART_EVENTS, PURCHASE, all_of, price_band
from lakepipe.schemas import SILVER, TABLE_KEYS, UNREADABLE
from lakepipe.session import written_once

EVENT_KEY = TABLE_KEYS[SILVER]

# Checked in this order; the first one a row breaks is the reason it is rejected.
RULES = (
    ("bad_price", "price > 0"),
    ("no_user", "user_id IS NOT NULL"),
    ("no_type", "event_type IS NOT NULL"),
)
DUPLICATE = "duplicate"


def _rules(frame: DataFrame) -> tuple[tuple[str, str], ...]:
    """A row that could not be read breaks no other rule: its values are not known."""
    return (("unreadable", f"{UNREADABLE} IS NULL"), *RULES) if UNREADABLE in frame.columns else RULES


def passing(frame: DataFrame, *rules: str) -> DataFrame:
    """Rows that satisfy the named rules (all of them by default); unknown counts as broken."""
    chosen = [F.expr(test) for name, test in _rules(frame) if not rules or name in rules]
    return frame.where(all_of(chosen))


def broken_rule(frame: DataFrame) -> Column:
    """Name of the first broken rule, NULL for a valid row."""
    reason = F.lit(None).cast("string")
    for name, test in reversed(_rules(frame)):
        reason = F.when(F.coalesce(F.expr(test), F.lit(False)), reason).otherwise(name)
    return reason


def survivor_order(columns: Sequence[str], cart_events: Sequence[str] = CART_EVENTS) -> list[Column]:
    """Total order that picks the row to keep: purchases, then carts, then the dearest, ...

    The event type is not part of the key, so an arbitrary survivor would change revenue from run
    to run. Columns the rule does not name come last in name order, which leaves only rows equal in
    every column tied.
    """
    kind = F.col("event_type")
    ranked = [
        F.when(kind == PURCHASE, 0).when(kind.isin(*cart_events), 1).otherwise(2).asc(),
        F.col("price").desc_nulls_last(),
        F.col("user_id").asc_nulls_last(),
        F.col("brand").asc_nulls_last(),
    ]
    named = {"price", "user_id", "brand", *EVENT_KEY}
    return ranked + [F.col(c).asc_nulls_last() for c in sorted(set(columns) - named)]


def one_per_event(
    frame: DataFrame, cart_events: Sequence[str] = CART_EVENTS, last: Sequence[str] = ()
) -> DataFrame:
    """One row per event key; keys compare NULL equal to NULL.

    Of rows equal in all other columns the one with the largest values of the columns ``last`` stays.
    Spark cuts each task's rows to one per key before the exchange (WindowGroupLimit), so a key
    that holds a third of all rows sends one row per task, not the group.
    """
    order = survivor_order([c for c in frame.columns if c not in last], cart_events)
    by_key = Window.partitionBy(*EVENT_KEY).orderBy(*order, *[F.col(c).desc() for c in last])
    return frame.withColumn("_rank", F.row_number().over(by_key)).where("_rank = 1").drop("_rank")


def with_derived(frame: DataFrame) -> DataFrame:
    return frame.withColumns(
        {
            "event_date": F.to_date("event_time"),
            "event_hour": F.hour("event_time"),
            "price_category": price_band(F.col("price")),
        }
    )


def clean(bronze: DataFrame, cart_events: Sequence[str] = CART_EVENTS) -> DataFrame:
    """The silver table."""
    return with_derived(one_per_event(passing(bronze.drop("ingestion_ts")).drop(UNREADABLE), cart_events))


def rejected(bronze: DataFrame, cart_events: Sequence[str] = CART_EVENTS) -> DataFrame:
    """Every row ``clean`` leaves out, with its reason.

    The rows are written once, with their reason and the number of the input split they were read in. Most rows have no
    duplicate: the keys are counted with partial sums, and only rows of keys that occur twice or more are ranked. Spark
    broadcasts the repeated keys if they are few and else exchanges both sides, where adaptive execution splits the
    partition of a hot key; nothing after the join depends on where it put a row.

    The duplicates of one key can be a third of the table, and all of them are wanted. They are ranked in two steps:
    first within (key, input split), where a group is never larger than a split, then the one leader of each such group
    against the other leaders of its key. A row that is no leader is out already and stays in its own group in step two.
    """
    frame = bronze.drop("ingestion_ts")
    names = frame.columns
    marked = written_once(frame.withColumns({"reason": broken_rule(frame), "_split": F.spark_partition_id()}), "reasons")
    valid = marked.where("reason IS NULL")
    repeated = valid.groupBy(*EVENT_KEY).agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1").drop("_rows")
    same = [F.col(f"own.{k}").eqNullSafe(F.col(f"key.{k}")) for k in EVENT_KEY]
    rows = valid.alias("own").join(repeated.alias("key"), all_of(same), "left_semi")
    order = survivor_order([c for c in names if c != UNREADABLE], cart_events)
    local = Window.partitionBy(*EVENT_KEY, "_split").orderBy(*order)
    leaders = Window.partitionBy(*EVENT_KEY, "_group").orderBy(*order)
    duplicates = (
        rows.withColumn("_local", F.row_number().over(local))
        .withColumn("_group", F.when(F.col("_local") > 1, F.col("_split")))
        .withColumn("_final", F.row_number().over(leaders))
        .where("_local > 1 OR _final > 1")
        .withColumn("reason", F.lit(DUPLICATE))
        .select(*names, "reason")
    )
    return marked.where("reason IS NOT NULL").select(*names, "reason").unionByName(duplicates)
