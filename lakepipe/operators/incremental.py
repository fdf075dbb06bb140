"""Clean a batch into a table that is clean already, without cleaning the table again.

The event time is part of an event's key, so a batch can only meet published rows of its own days, and of
those only rows with its own keys. Of the published table only these days are read, a Bloom filter of the
batch's keys lets few of their rows pass, these are joined exactly, and only they are ranked against the batch,
by the same order as in a full run. So cleaning batch by batch gives the table a full run over all batches gives,
whatever the batches and their order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakepipe.functions.columns import CART_EVENTS, all_of
from lakepipe.operators import cleaning
from lakepipe.session import written_once
from lakepipe.sources import catalog

KEY_HASH = "_key"


def key_hash() -> Column:
    """64 bits of the event key that treat NULL as a value; equal keys have equal ones, so it can only let too much pass."""
    return F.xxhash64(*[F.struct(F.col(c).isNull(), F.col(c)) for c in cleaning.EVENT_KEY])


def _on_days(frame: DataFrame, days: Sequence) -> DataFrame:
    """The rows of these days; on a table partitioned by day its other partitions are not read."""
    test = F.col(catalog.DAY).isin([d for d in days if d is not None])
    return frame.where(test | F.col(catalog.DAY).isNull() if None in days else test)


def _days(frame: DataFrame) -> list:
    return [r[0] for r in frame.select(catalog.DAY).distinct().collect()]  # one value per day


def _same_key(left: str, right: str) -> list[Column]:
    return [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in cleaning.EVENT_KEY]


def met_rows(published: DataFrame, batch: DataFrame) -> DataFrame:
    """The rows of ``published`` whose key occurs in ``batch``; days the batch does not have are not read.

    The join is on a hash of the key as well, one plain column without NULLs. A small batch is broadcast; else both
    sides are exchanged, and Spark filters the published rows by a Bloom filter of the batch's hashes before that, if
    the days read are more than spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold.
    """
    days = _days(batch)
    old = _on_days(published, days).withColumn(KEY_HASH, key_hash()).alias("old")
    keys = _on_days(batch, days).withColumn(KEY_HASH, key_hash()).select(*cleaning.EVENT_KEY, KEY_HASH).alias("new")
    same = [F.col(f"old.{KEY_HASH}") == F.col(f"new.{KEY_HASH}"), *_same_key("old", "new")]
    return old.join(keys, all_of(same), "left_semi").drop(KEY_HASH)


def changes(published: DataFrame, batch: DataFrame, cart_events: Sequence[str] = CART_EVENTS) -> DataFrame:
    """What cleaning a raw ``batch`` into the clean table ``published`` changes, one row per key of a valid batch row.

    Columns of ``published`` and ``change``: "added" for a key that was not there, "replaced" for a row that wins against
    the published one, "kept" where the published row wins or is equal. The batch is cleaned by itself first, so two
    rows of a key meet here at most.
    """
    columns = published.columns
    new = written_once(cleaning.clean(batch, cart_events).select(*columns), "batch")
    rivals = met_rows(published, new).withColumn("_old", F.lit(True)).unionByName(new.withColumn("_old", F.lit(False)))
    met = rivals.withColumn("_met", F.max("_old").over(Window.partitionBy(*cleaning.EVENT_KEY)))
    winners = cleaning.one_per_event(met, cart_events, last=["_old", "_met"])
    change = F.when(F.col("_old"), "kept").when(F.col("_met"), "replaced").otherwise("added")
    return winners.select(*columns, change.alias("change"))


def clean_into(batch: DataFrame, table: str, cart_events: Sequence[str] = CART_EVENTS) -> DataFrame:
    """Clean a raw ``batch`` into the catalog table ``table`` (clean events partitioned by day).

    Only days on which a row is added or replaced are rewritten: their untouched rows and the batch's winners. Returns
    (change, rows) as counted by the write's own input.
    """
    published = batch.sparkSession.table(table)
    changed = written_once(changes(published, batch, cart_events), "changes")
    effective = changed.where("change <> 'kept'")
    gone = changed.where("change = 'replaced'").select(*cleaning.EVENT_KEY)
    rewritten = _on_days(published, _days(effective))
    stays = rewritten.alias("old").join(gone.alias("gone"), all_of(_same_key("old", "gone")), "left_anti")
    # A table cannot be read while it is overwritten, so its new days are written beside it first.
    content = written_once(stays.unionByName(effective.drop("change")), "days")
    catalog.replace_days(content, table)
    return changed.groupBy("change").agg(F.count(F.lit(1)).alias("rows"))
