"""The named queries: each maps (spark, sf_dir) to a frame over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from lakepipe import schemas
from lakepipe.functions.columns import CART_EVENTS_STRICT, price_band, verdict
from lakepipe.ml import features, metrics, runs, split
from lakepipe.ml.scoring import as_predictions, score_users
from lakepipe.ml.training import apply, train_all, train_and_log
from lakepipe.operators import cleaning, gold, incremental, quality, reports, sketches
from lakepipe.operators.layout import laid_out
from lakepipe.plans import report_sql
from lakepipe.plans.verify import layer_checks
from lakepipe.session import scratch_dir, written_once
from lakepipe.sources import catalog, tables
from lakepipe.sources.adapted import raw_events
from lakepipe.sources.feed import read_csv_events, stamp_ingestion

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _wall_clock(frame: DataFrame) -> DataFrame:
    """Timestamps without a zone, so that no client shifts them on the way out."""
    local = {
        f.name: F.col(f.name).cast("timestamp_ntz") for f in frame.schema if isinstance(f.dataType, T.TimestampType)
    }
    return frame.withColumns(local)


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean(raw_events(spark, sf_dir))


def _users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.user_features(_silver(spark, sf_dir))


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.with_label(_users(spark, sf_dir))


# Two fixed scoring rules stand in for models where a result must be reproducible in plain SQL.
def _rule_scored(labelled: DataFrame, score: Column, threshold: float) -> DataFrame:
    scored = labelled.withColumn("score", score)
    return scored.withColumn("prediction", (F.col("score") >= threshold).cast("int"))


def _price_rule(labelled: DataFrame) -> DataFrame:
    price = F.col("avg_price")
    return _rule_scored(labelled, price / (price + 100.0 * F.col("views") + 1.0), 0.6)


def _views_rule(labelled: DataFrame) -> DataFrame:
    return _rule_scored(labelled, 1.0 - F.col("views") / F.col("total_events"), 0.5)


RULES = {"price_rule": _price_rule, "views_rule": _views_rule}


def _rule_predictions(labelled: DataFrame) -> DataFrame:
    return as_predictions(split.hash_split(_price_rule(labelled)))


def _rule_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(run_id, run_name, metric, value) of both rules, each scored once and written."""
    labelled = _labelled(spark, sf_dir)
    log = runs.RunLog(spark, scratch_dir(spark, "rules"))
    users = written_once(labelled, "labelled")
    measured = [
        metrics.evaluate(log.save_scored(name, rule(users))).select(
            F.lit(name).alias("run_id"), F.lit(name).alias("run_name"), "metric", "value"
        )
        for name, rule in RULES.items()
    ]
    return reduce(DataFrame.unionByName, measured)


# --- ingest and publish -------------------------------------------------------------------------


@query
def ingest_csv_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "feed")
    raw_events(spark, sf_dir).write.option("header", True).csv(path)
    events = read_csv_events(spark, path)
    return _wall_clock(events.where(F.col(schemas.UNREADABLE).isNull()).drop(schemas.UNREADABLE))


@query
def ingest_unreadable(spark, sf_dir):
    """A written feed with damaged times and prices: what cleaning keeps, and what it rejects for which reason."""
    path = scratch_dir(spark, "damaged")
    raw = raw_events(spark, sf_dir)
    time = F.when(F.col("user_id") % 50 == 0, "01/10/2019 00:00").otherwise(F.col("event_time").cast("string"))
    price = F.when(F.col("user_id") % 70 == 1, "oops").otherwise(F.col("price").cast("string"))
    raw.withColumns({"event_time": time, "price": price}).write.option("header", True).csv(path)
    bronze = written_once(read_csv_events(spark, path), "bronze")
    kept = cleaning.clean(bronze).select(F.lit("kept").alias("reason"))
    outcomes = cleaning.rejected(bronze).select("reason").unionByName(kept)
    return outcomes.groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))


@query
def bronze_audit(spark, sf_dir):
    at = F.lit("2024-02-01 00:00:00").cast("timestamp")
    return _wall_clock(stamp_ingestion(raw_events(spark, sf_dir), at))


@query
def schema_check(spark, sf_dir):
    """Three batches offered to a published table; a batch that breaks the contract adds no row."""
    raw = raw_events(spark, sf_dir)
    batches = {
        "as_declared": raw,
        "price_as_text": raw.withColumn("price", F.col("price").cast("string")),
        "other_table": spark.read.parquet(f"{sf_dir}/events.parquet"),
    }
    table = f"{catalog.scratch_schema(spark, 'append')}.events"
    catalog.create(spark, table, f"{schemas.CONTRACT_DDL[schemas.BRONZE]}, {catalog.DAY} date")
    rows, before = [], 0
    for name, batch in batches.items():
        whole = catalog.with_day(batch) if "event_time" in batch.columns else batch
        tables.append_outcome(catalog.append, stamp_ingestion(whole), table)
        problems = quality.schema_problems(batch.schema, schemas.raw_schema())
        listed = ",".join(f"{column}:{problem}" for column, problem, _, _ in problems)
        now = spark.table(table).count()
        rows.append(
            batch.agg(
                F.lit(name).alias("batch"),
                F.lit(listed).alias("problems"),
                F.count(F.lit(1)).alias("rows_offered"),
                F.lit(now - before).cast("bigint").alias("rows_accepted"),
            )
        )
        before = now
    return reduce(DataFrame.unionByName, rows)


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.with_day(stamp_ingestion(raw_events(spark, sf_dir)))


@query
def publish_table(spark, sf_dir):
    table = f"{catalog.scratch_schema(spark, 'publish')}.events"
    catalog.publish(_bronze(spark, sf_dir), table)
    return _wall_clock(spark.table(table).drop("ingestion_ts", catalog.DAY))


@query
def append_published(spark, sf_dir):
    """A feed appended to the published table: each version's rows, and whether older files are still its own."""
    table = f"{catalog.scratch_schema(spark, 'days')}.events"
    raw = _bronze(spark, sf_dir)
    later = F.coalesce(F.col("product_id") % 3 == 0, F.lit(False))
    written = catalog.publish(raw.where(~later), table)[catalog.ROWS]
    read = spark.table(table).count()
    files = written_once(catalog.files_by_day(spark, table), "files")
    added = catalog.append(raw.where(later), table)[catalog.ROWS]
    now = catalog.files_by_day(spark, table)
    kept = files.join(now, "file", "left_anti").isEmpty() and now.count() > files.count()
    rows = [(0, "WRITE", written, read, kept), (1, "APPEND", written + added, spark.table(table).count(), kept)]
    return spark.createDataFrame(rows, "version long, operation string, rows_logged long, rows_read long, files_kept boolean")


RERUN_DAY = "2024-01-10"


@query
def rerun_day(spark, sf_dir):
    """One day of the clean table run again without its views: each day's rows, and whether its files are new."""
    table = f"{catalog.scratch_schema(spark, 'rerun')}.events"
    catalog.publish(catalog.day_last(_silver(spark, sf_dir)), table)
    files = written_once(catalog.files_by_day(spark, table), "files")
    again = catalog.day_last(_silver(spark, sf_dir)).where(F.col(catalog.DAY) == F.lit(RERUN_DAY).cast("date"))
    catalog.replace_days(again.where("event_type <> 'view'"), table)
    now = catalog.files_by_day(spark, table).join(files.withColumn("known", F.lit(True)), [catalog.DAY, "file"], "left")
    new = now.groupBy(catalog.DAY).agg(F.bool_and(F.col("known").isNull()).alias("rewritten"))
    rows = spark.table(table).groupBy(catalog.DAY).agg(F.count(F.lit(1)).alias("rows"))
    return rows.join(new, catalog.DAY)


@query
def publish_profile(spark, sf_dir):
    """Rows and NULLs per column of two published tables, as their own writes counted them."""
    schema = catalog.scratch_schema(spark, "profile")
    bronze = catalog.publish(_bronze(spark, sf_dir), f"{schema}.bronze")
    silver = catalog.publish(catalog.day_last(cleaning.clean(spark.table(f"{schema}.bronze").drop(catalog.DAY))), f"{schema}.silver")
    rows = [
        (name, column, profile[catalog.ROWS], nulls)
        for name, profile in ((schemas.BRONZE, bronze), (schemas.SILVER, silver))
        for column, nulls in catalog.null_counts(profile).items()
    ]
    return spark.createDataFrame(rows, "layer string, column_name string, rows long, nulls long")


BATCHES = ("others", "purchases", "sent_again")


def _batches(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The feed in three deliveries: purchases come after the events they repeat, and some products' events twice."""
    raw = raw_events(spark, sf_dir)
    bought = F.coalesce(F.col("event_type") == "purchase", F.lit(False))
    return dict(zip(BATCHES, (raw.where(~bought), raw.where(bought), raw.where("product_id % 3 = 0")), strict=True))


def _cleaned_in_batches(spark: SparkSession, sf_dir: str) -> tuple[str, dict[str, DataFrame]]:
    table = f"{catalog.scratch_schema(spark, 'batches')}.events"
    catalog.create(spark, table, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in catalog.day_last(_silver(spark, sf_dir)).schema))
    return table, {name: incremental.clean_into(batch, table) for name, batch in _batches(spark, sf_dir).items()}


@query
def incremental_clean(spark, sf_dir):
    """The clean table after three batches; equal to cleaning all of them at once."""
    table, _ = _cleaned_in_batches(spark, sf_dir)
    return _wall_clock(spark.table(table))


@query
def incremental_changes(spark, sf_dir):
    """What each batch added, replaced and left as it was."""
    _, changed = _cleaned_in_batches(spark, sf_dir)
    return reduce(DataFrame.unionByName, [c.withColumn("batch", F.lit(name)) for name, c in changed.items()])


@query
def publish_history(spark, sf_dir):
    schema = catalog.scratch_schema(spark, "history")
    bronze, silver = f"{schema}.bronze_events", f"{schema}.silver_events"
    catalog.publish_version(stamp_ingestion(raw_events(spark, sf_dir)), bronze)
    catalog.publish_version(_silver(spark, sf_dir), silver)
    catalog.publish_version(laid_out(catalog.version(spark, bronze, 0), ["user_id", "event_type"], 4), bronze, "OPTIMIZE")
    listed = [
        catalog.history(spark, table).select(
            F.lit(name).alias("table_name"), catalog.VERSION, catalog.OPERATION, F.col("rows").alias("rows_written")
        )
        for name, table in ((schemas.BRONZE, bronze), (schemas.SILVER, silver))
    ]
    return reduce(DataFrame.unionByName, listed)


@query
def zorder_rewrite(spark, sf_dir):
    """The rows of a bronze table after they were laid out anew; named for the command that it stands for."""
    table = f"{catalog.scratch_schema(spark, 'layout')}.events"
    catalog.publish_version(stamp_ingestion(raw_events(spark, sf_dir)), table)
    catalog.publish_version(laid_out(catalog.version(spark, table, 0), ["user_id", "event_type"], 8), table, "OPTIMIZE")
    return _wall_clock(catalog.version(spark, table).drop("ingestion_ts"))


# --- quality and cleaning -----------------------------------------------------------------------


@query
def null_profile(spark, sf_dir):
    return quality.null_profile(raw_events(spark, sf_dir))


@query
def filter_price(spark, sf_dir):
    return _wall_clock(cleaning.passing(raw_events(spark, sf_dir), "bad_price"))


@query
def filter_not_null(spark, sf_dir):
    return _wall_clock(cleaning.passing(raw_events(spark, sf_dir), "no_user", "no_type"))


@query
def dedup_events(spark, sf_dir):
    return _wall_clock(cleaning.one_per_event(raw_events(spark, sf_dir)))


@query
def silver_events(spark, sf_dir):
    return _wall_clock(_silver(spark, sf_dir))


@query
def price_bands(spark, sf_dir):
    priced = raw_events(spark, sf_dir).withColumn("price_category", price_band(F.col("price")))
    return priced.groupBy("price_category").agg(
        F.count(F.lit(1)).alias("rows"), F.min("price").alias("lowest"), F.max("price").alias("highest")
    )


@query
def cleaning_delta(spark, sf_dir):
    raw = raw_events(spark, sf_dir)
    return reports.cleaning_delta(raw, cleaning.clean(raw))


@query
def cleaning_rejects(spark, sf_dir):
    return _wall_clock(cleaning.rejected(raw_events(spark, sf_dir)))


# --- aggregate tables and reports ---------------------------------------------------------------


@query
def daily_revenue(spark, sf_dir):
    return gold.by_day(gold.daily_revenue(_silver(spark, sf_dir)))


@query
def product_performance(spark, sf_dir):
    return gold.product_performance(_silver(spark, sf_dir))


@query
def user_features(spark, sf_dir):
    return _users(spark, sf_dir)


BUCKETS = 16


@query
def user_features_bucketed(spark, sf_dir):
    """From a clean table bucketed by user, without an exchange."""
    table = f"{catalog.scratch_schema(spark, 'bucketed')}.events"
    catalog.publish_bucketed(_silver(spark, sf_dir), table, "user_id", BUCKETS)
    return gold.user_features(spark.table(table), by_user=True)


def _day_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each day's buyers as published sketches, in two deliveries that share days and users."""
    table = f"{catalog.scratch_schema(spark, 'sketches')}.buyers"
    silver = written_once(_silver(spark, sf_dir), "silver")
    late = F.coalesce(F.col("product_id") % 3 == 0, F.lit(False))
    catalog.publish(catalog.day_last(sketches.daily_buyers(silver.where(~late))), table)
    catalog.append(catalog.day_last(sketches.daily_buyers(silver.where(late))), table)
    return spark.table(table)


def _compared(estimated: DataFrame, exact: DataFrame, key: str) -> DataFrame:
    """The exact numbers of buyers beside estimates, and whether these are within their bound."""
    joined = estimated.join(exact, estimated[key].eqNullSafe(exact[key])).drop(exact[key])
    near = ~sketches.off_by_more(F.col("estimate"), F.col("buyers_exact"))
    return joined.select(key, "purchases", F.col("buyers_exact").alias("buyers"), near.alias("within_bound"))


def _buyers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir).where("event_type = 'purchase'").select("event_date", "user_id").distinct()


@query
def weekly_buyers(spark, sf_dir):
    """Buyers per week from merged sketches, held against the exact count."""
    week = F.date_trunc("week", "event_date").cast("date")
    exact = _buyers(spark, sf_dir).groupBy(week.alias("week")).agg(F.count_distinct("user_id").alias("buyers_exact"))
    return _compared(sketches.by_week(_day_sketches(spark, sf_dir)), exact, "week")


@query
def trailing_buyers(spark, sf_dir):
    """Buyers of the seven days up to each day from merged sketches, held against the exact count."""
    days = F.explode(F.sequence("event_date", F.date_add("event_date", 6))).alias("until")
    exact = _buyers(spark, sf_dir).select("user_id", days).groupBy("until").agg(F.count_distinct("user_id").alias("buyers_exact"))
    return _compared(sketches.trailing(_day_sketches(spark, sf_dir), 7), exact, "until")


def _as_views(tables_of: dict[str, DataFrame]) -> dict[str, str]:
    """Each frame registered under a name of its own, for SQL."""
    names = {name: f"lakepipe_{uuid.uuid4().hex}" for name in tables_of}
    for name, view in names.items():
        tables_of[name].createOrReplaceTempView(view)
    return names


@query
def event_type_distribution_sql(spark, sf_dir):
    return report_sql.event_type_distribution(spark, _as_views({"silver": _silver(spark, sf_dir)})["silver"])


@query
def top_revenue_days_sql(spark, sf_dir):
    return report_sql.top_revenue_days(spark, _as_views({"daily": gold.daily_revenue(_silver(spark, sf_dir))})["daily"])


@query
def purchase_funnel_sql(spark, sf_dir):
    products = gold.product_performance(_silver(spark, sf_dir))
    return report_sql.purchase_funnel(spark, _as_views({"products": products})["products"])


@query
def prediction_summary_sql(spark, sf_dir):
    predictions = _rule_predictions(_labelled(spark, sf_dir))
    return report_sql.prediction_summary(spark, _as_views({"predictions": predictions})["predictions"])


@query
def product_performance_strict(spark, sf_dir):
    return gold.product_performance(_silver(spark, sf_dir), CART_EVENTS_STRICT)


@query
def user_features_strict(spark, sf_dir):
    return gold.user_features(_silver(spark, sf_dir), CART_EVENTS_STRICT)


@query
def purchase_funnel_strict(spark, sf_dir):
    return reports.purchase_funnel(gold.product_performance(_silver(spark, sf_dir), CART_EVENTS_STRICT))


@query
def event_type_distribution(spark, sf_dir):
    return reports.event_type_distribution(_silver(spark, sf_dir))


@query
def top_revenue_days(spark, sf_dir):
    return reports.top_revenue_days(gold.daily_revenue(_silver(spark, sf_dir)))


@query
def purchase_funnel(spark, sf_dir):
    return reports.purchase_funnel(gold.product_performance(_silver(spark, sf_dir)))


@query
def prediction_summary(spark, sf_dir):
    return reports.prediction_summary(_rule_predictions(_labelled(spark, sf_dir)))


def _layers(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The six tables, each written once. Predictions by rule."""
    bronze = written_once(raw_events(spark, sf_dir), "bronze")
    silver = written_once(cleaning.clean(bronze), "silver")
    users = written_once(gold.user_features(silver), "users")
    return {
        schemas.BRONZE: bronze,
        schemas.SILVER: silver,
        schemas.DAILY: written_once(gold.daily_revenue(silver), "daily"),
        schemas.PRODUCTS: written_once(gold.product_performance(silver), "products"),
        schemas.USERS: users,
        schemas.PREDICTIONS: written_once(_rule_predictions(features.with_label(users)), "predictions"),
    }


@query
def layer_counts(spark, sf_dir):
    return reports.layer_counts(_layers(spark, sf_dir))


@query
def layer_counts_sql(spark, sf_dir):
    return report_sql.layer_counts(spark, _as_views(_layers(spark, sf_dir)))


@query
def layer_verification(spark, sf_dir):
    return layer_checks(_layers(spark, sf_dir))


# --- labels, features, splits -------------------------------------------------------------------


@query
def label_users(spark, sf_dir):
    return _labelled(spark, sf_dir).select("user_id", "purchases", "label")


@query
def label_distribution(spark, sf_dir):
    return features.label_distribution(_labelled(spark, sf_dir))


@query
def buyer_rate(spark, sf_dir):
    return features.buyer_rate(_labelled(spark, sf_dir))


@query
def feature_matrix(spark, sf_dir):
    return features.feature_matrix(_users(spark, sf_dir), "reference")


@query
def split_users(spark, sf_dir):
    return split.hash_split(_labelled(spark, sf_dir)).select("user_id", "label", "is_train")


@query
def split_users_stratified(spark, sf_dir):
    users = written_once(_users(spark, sf_dir), "users")
    return split.stratified_split(features.with_label(users)).select("user_id", "label", "is_train")


@query
def split_summary(spark, sf_dir):
    return split.split_summary(split_users_stratified(spark, sf_dir))


# --- metrics, runs, predictions -----------------------------------------------------------------


@query
def metric_auc(spark, sf_dir):
    return metrics.roc_auc(written_once(_price_rule(_labelled(spark, sf_dir)), "scored"))


@query
def metric_auc_bounds(spark, sf_dir):
    """The area from a histogram of the scores: its middle and bound, and whether the exact area lies within them."""
    scored = written_once(_price_rule(_labelled(spark, sf_dir)), "scored")
    exact = F.lit(metrics.roc_auc(scored).first()["auc"])
    found = metrics.auc_bounds(scored, bins=1000)
    inside = (F.col("lower") <= exact) & (exact <= F.col("upper"))
    return found.select("auc", "error_bound", "bins_used", inside.alias("exact_inside"))


@query
def metric_f1_weighted(spark, sf_dir):
    return metrics.f1_weighted(_price_rule(_labelled(spark, sf_dir)))


@query
def metric_accuracy(spark, sf_dir):
    return metrics.accuracy(_price_rule(_labelled(spark, sf_dir)))


@query
def model_comparison(spark, sf_dir):
    return runs.compare(_rule_metrics(spark, sf_dir), tuple(RULES))


@query
def select_best_run(spark, sf_dir):
    return runs.best_run(_rule_metrics(spark, sf_dir), tuple(RULES))


@query
def label_text(spark, sf_dir):
    scored = _price_rule(_labelled(spark, sf_dir))
    return scored.select("user_id", "prediction", verdict(F.col("prediction")).alias("purchase_label"))


def _split_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled users with their part; written, since a fit passes over them many times."""
    users = written_once(_users(spark, sf_dir), "users")
    parts = split.stratified_split(features.with_label(users))
    return written_once(split.in_fixed_order(parts, users.count()), "split")


def _trained(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """One real training run, as (check, value) rows of what must hold for any model."""
    log = runs.RunLog(spark, scratch_dir(spark, kind))
    parts = _split_users(spark, sf_dir)
    run = train_and_log(parts, kind, log, "reference")
    logged = log.table()
    scored = log.scored(run.run_id)
    logged_metrics = runs.metric_rows(logged).select("metric", F.col("value").alias("logged"))
    again = metrics.evaluate(scored).join(logged_metrics, "metric")
    off = ~F.coalesce(F.abs(F.col("value") - F.col("logged")) < 1e-12, F.lit(False))

    def param(key):
        return logged.where((F.col("kind") == "param") & (F.col("key") == key)).agg(F.max("value").cast("bigint").alias("v"))

    def number(frame, value):
        return frame.agg(value.cast("bigint").alias("v"))

    checks = {
        "train_size": param("train_size"),
        "test_size": param("test_size"),
        "train_buyers": number(parts.where("is_train"), F.sum("label")),
        "test_buyers": number(scored, F.sum("label")),
        "features": number(logged.where("key = 'features'"), F.max(F.size(F.split("value", ",")))),
        "rows_scored": number(scored, F.count(F.lit(1))),
        "probability_out_of_range": number(scored, F.count_if(~F.col("score").between(0.0, 1.0))),
        "class_against_threshold": number(scored, F.count_if((F.col("score") > 0.5) != (F.col("prediction") == 1))),
        "metrics_recomputed": number(again, F.count(F.lit(1))),
        "metrics_not_as_logged": number(again, F.count_if(off)),
        "models_stored": number(logged.where("kind = 'model'"), F.count(F.lit(1))),
    }
    rows = [frame.select(F.lit(name).alias("check"), F.col("v").alias("value")) for name, frame in checks.items()]
    return reduce(DataFrame.unionByName, rows)


@query
def ml_random_forest(spark, sf_dir):
    return _trained(spark, sf_dir, "random_forest")


@query
def ml_logistic_regression(spark, sf_dir):
    return _trained(spark, sf_dir, "logistic_regression")


def _chosen(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, runs.RunLog, str]:
    parts = _split_users(spark, sf_dir)
    log = runs.RunLog(spark, scratch_dir(spark, "models"))
    return parts, log, train_all(parts, log)


@query
def ml_model_choice(spark, sf_dir):
    """Comparison and choice over two trained runs, against the metrics as logged."""
    _, log, winner = _chosen(spark, sf_dir)
    measured = runs.metric_rows(log.table())
    compared = runs.compare(measured)
    auc = compared.where("metric = 'auc'")
    forest, regression = F.col("random_forest"), F.col("logistic_regression")
    won = measured.where((F.col("run_id") == winner) & (F.col("metric") == "auc")).select("run_name", "value")
    by_rule = F.when(forest >= regression, "random_forest").otherwise("logistic_regression")
    return auc.join(won.withColumn("metric", F.lit("auc")), "metric").select(
        F.lit(measured.select("run_id").distinct().count()).cast("bigint").alias("runs"),
        F.lit(compared.count()).cast("bigint").alias("metrics_compared"),
        (F.col("value") == F.greatest(forest, regression)).alias("winner_has_highest_auc"),
        (F.col("run_name") == by_rule).alias("winner_by_tie_rule"),
        (F.greatest(forest, regression) <= 1.0).alias("auc_in_range"),
    )


@query
def ml_score_users(spark, sf_dir):
    """All users scored by the winner: the columns that SQL can derive, and what must hold for the others."""
    parts, log, winner = _chosen(spark, sf_dir)
    model = log.load_model(winner)
    raw = apply(model, parts).select("user_id", "score")
    scored = score_users(model, parts).join(raw, "user_id")
    text = F.when(F.col("will_purchase") == 1, "Likely to Purchase").otherwise("Not Likely to Purchase")
    return scored.select(
        "user_id",
        "total_events",
        "total_spent",
        "avg_price",
        "is_train",
        F.col("purchase_probability").between(0.0, 1.0).alias("probability_in_range"),
        (F.col("purchase_probability") == F.bround("score", 4)).alias("probability_rounded"),
        ((F.col("score") > 0.5) == (F.col("will_purchase") == 1)).alias("class_by_threshold"),
        (F.col("purchase_label") == text).alias("text_by_class"),
    )
