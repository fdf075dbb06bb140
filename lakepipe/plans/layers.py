"""The whole chain: raw feed, bronze, silver, three gold tables, models, predictions, checks."""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakepipe import schemas
from lakepipe.functions.columns import CART_EVENTS, CART_EVENTS_STRICT
from lakepipe.ml import features
from lakepipe.ml.runs import RunLog
from lakepipe.ml.scoring import score_users
from lakepipe.ml.split import in_fixed_order, stratified_split
from lakepipe.ml.training import train_all
from lakepipe.operators import cleaning, gold
from lakepipe.operators.zorder import zorder
from lakepipe.plans.verify import layer_checks
from lakepipe.session import sized_shuffles
from lakepipe.sources.feed import read_csv_events, stamp_ingestion
from lakepipe.sources.versions import Store

# Columns the two event tables are clustered by.
BRONZE_CLUSTER = ("user_id", "event_type")
SILVER_CLUSTER = ("user_id", "event_date")
SPLIT_TABLE = "ml.labelled_users"
FILE_TARGET_BYTES = 256 * 1024 * 1024


class StepLog:
    """What was done, how many rows it left and how long it took. A count of 0 is kept."""

    def __init__(self, store: Store):
        self.spark, self.store = store.spark, store
        self.rows: list[tuple] = []

    def run(self, step: str, table: str, work: Callable[[], DataFrame]) -> DataFrame:
        """``work`` publishes ``table``; its rows are those that the publish logged."""
        started = time.time()
        written = work()
        self.rows.append((step, self.store.rows(table), time.time() - started))
        return written

    def frame(self) -> DataFrame:
        plain = self.spark.createDataFrame(self.rows, "step string, rows bigint, seconds double")
        return plain.withColumn("finished_at", F.current_timestamp())


def _published_bytes(store: Store, table: str) -> int:
    return int(store.history(table).first()["operationMetrics"]["numOutputBytes"])


def _clustered(store: Store, table: str, columns: Sequence[str]) -> DataFrame:
    """Rewrite the newest version along the Z-order of ``columns`` as the next version."""
    files = max(1, math.ceil(_published_bytes(store, table) / FILE_TARGET_BYTES))
    return store.publish(zorder(store.read(table), columns, files), table, "OPTIMIZE")


def publish_events(store: Store, raw: DataFrame, cluster: bool, cart_events: Sequence[str], steps: StepLog) -> DataFrame:
    """Bronze and silver; returns silver as published."""
    bronze, silver = schemas.BRONZE, schemas.SILVER
    rows = steps.run(bronze, bronze, lambda: store.publish(stamp_ingestion(raw), bronze))
    with sized_shuffles(store.spark, _published_bytes(store, bronze)):
        if cluster:
            rows = steps.run(f"{bronze} clustered", bronze, lambda: _clustered(store, bronze, BRONZE_CLUSTER))
        clean = steps.run(silver, silver, lambda: store.publish(cleaning.clean(rows, cart_events), silver))
        if cluster:
            clean = steps.run(f"{silver} clustered", silver, lambda: _clustered(store, silver, SILVER_CLUSTER))
    return clean


def publish_gold(store: Store, silver: DataFrame, cart_events: Sequence[str], steps: StepLog) -> DataFrame:
    """The three aggregate tables; returns the user features as published."""
    plans = {
        schemas.DAILY: gold.daily_revenue(silver),
        schemas.PRODUCTS: gold.product_performance(silver, cart_events),
        schemas.USERS: gold.user_features(silver, cart_events),
    }
    written = {name: steps.run(name, name, lambda n=name, p=plan: store.publish(p, n)) for name, plan in plans.items()}
    return written[schemas.USERS]


def publish_predictions(store: Store, users: DataFrame, feature_set: str, steps: StepLog) -> DataFrame:
    log = RunLog(store.spark, f"{store.root}/ml")
    split = in_fixed_order(stratified_split(features.with_label(users)), users.count())
    split = store.publish(split, SPLIT_TABLE)
    winner = train_all(split, log, feature_set)
    scored = score_users(log.load_model(winner), split)
    return steps.run(schemas.PREDICTIONS, schemas.PREDICTIONS, lambda: store.publish(scored, schemas.PREDICTIONS))


def run_layers(
    spark: SparkSession,
    source: str | DataFrame,
    root: str,
    *,
    feature_set: str = features.DEFAULT_FEATURES,
    strict_cart_events: bool = False,
    cluster: bool = True,
    register: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Run everything into ``root`` and return (checks, steps).

    ``source`` is the path of the CSV feed or a frame in its shape. Each table is written once and
    its successors read the written files; no plan runs twice, and an executor lost in a later
    step costs no earlier one.
    """
    cart_events = CART_EVENTS_STRICT if strict_cart_events else CART_EVENTS
    store = Store(spark, root)
    steps = StepLog(store)
    if isinstance(source, str):
        source = read_csv_events(spark, source)
    silver = publish_events(store, source, cluster, cart_events, steps)
    with sized_shuffles(spark, _published_bytes(store, schemas.SILVER)):
        users = publish_gold(store, silver, cart_events, steps)
        publish_predictions(store, users, feature_set, steps)
    if register:
        for table in schemas.LAYERS:
            store.register(table)
    return layer_checks(published(store)), steps.frame()


def published(store: Store) -> dict[str, DataFrame | None]:
    tables: dict[str, DataFrame | None] = {}
    for name in schemas.LAYERS:
        try:
            tables[name] = store.read(name)
        except LookupError:
            tables[name] = None
    return tables
