"""Tables of Spark's catalog: counted writes, appends, re-run days, buckets."""

import datetime

import pytest
from pyspark.sql import functions as F

from lakepipe.operators import cleaning, gold
from lakepipe.sources import catalog, tables
from test_cleaning import row

DAYS = ["2019-10-01 10:00:00", "2019-10-02 10:00:00", "2019-10-03 23:59:59", None]


@pytest.fixture
def table(spark):
    return f"{catalog.scratch_schema(spark, 'test')}.events"


def feed(raw, n=40):
    return catalog.with_day(raw([row(time=DAYS[i % 4], product=i, user=i % 5 or None) for i in range(n)]))


def by_day(spark, table):
    return {r["event_date"]: r["n"] for r in spark.table(table).groupBy("event_date").agg(F.count("*").alias("n")).collect()}


def test_a_publish_counts_itself_and_replaces_the_table(spark, raw, table):
    profile = catalog.publish(feed(raw), table)
    assert profile[catalog.ROWS] == 40 == spark.table(table).count()
    nulls = catalog.null_counts(profile)
    assert nulls == {"event_time": 10, "event_date": 10, "user_id": 8} | {
        c: 0 for c in ("event_type", "product_id", "brand", "price", "user_session")
    }
    assert set(spark.table(table).columns) == set(nulls) and spark.table(table).columns[-1] == "event_date"
    assert catalog.publish(feed(raw, 4), table)[catalog.ROWS] == 4 == spark.table(table).count()


def test_the_profile_needs_no_second_read(spark, raw, table):
    """Rows are counted where they pass into the files, in the plan of the write."""
    counted, counts = catalog.observed(feed(raw))
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "CollectMetrics" in plan
    counted.write.partitionBy("event_date").saveAsTable(table)
    assert counts.get[catalog.ROWS] == 40


def test_empty_tables_are_counted(spark, raw, table):
    assert catalog.publish(feed(raw).where("product_id < 0"), table)[catalog.ROWS] == 0
    assert spark.table(table).count() == 0 and catalog.append(feed(raw, 4), table)[catalog.ROWS] == 4
    assert catalog.append(feed(raw).where("product_id < 0"), table)[catalog.ROWS] == 0


def test_a_day_run_again_changes_its_partition_only(spark, raw, table):
    catalog.publish(feed(raw), table)
    before = {(r["event_date"], r["file"]) for r in catalog.files_by_day(spark, table).collect()}
    day = datetime.date(2019, 10, 2)
    again = feed(raw).where(F.col("event_date") == F.lit(day)).where("product_id < 10")
    assert catalog.replace_days(again, table)[catalog.ROWS] == 3
    after = {(r["event_date"], r["file"]) for r in catalog.files_by_day(spark, table).collect()}
    assert {d for d, _ in before ^ after} == {day}
    assert by_day(spark, table) == {datetime.date(2019, 10, 1): 10, day: 3, datetime.date(2019, 10, 3): 10, None: 10}
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_the_partition_of_no_date_can_be_run_again(spark, raw, table):
    catalog.publish(feed(raw), table)
    catalog.replace_days(feed(raw).where("event_date IS NULL AND product_id < 8"), table)
    assert by_day(spark, table)[None] == 2 and spark.table(table).count() == 32


def test_nothing_to_replace_leaves_everything(spark, raw, table):
    catalog.publish(feed(raw), table)
    assert catalog.replace_days(feed(raw).where("product_id < 0"), table)[catalog.ROWS] == 0
    assert spark.table(table).count() == 40


@pytest.mark.parametrize("write", [catalog.append, catalog.replace_days])
def test_other_schemas_are_refused(spark, raw, table, write):
    catalog.publish(feed(raw), table)
    good = feed(raw, 4)
    for bad in (good.drop("brand"), good.withColumn("x", F.lit(1)), good.withColumn("price", F.col("price").cast("string"))):
        accepted, why = tables.append_outcome(write, bad, table)
        assert not accepted and "rejected" in why
    assert spark.table(table).count() == 40
    shuffled = good.select(*reversed(good.columns))  # by name, not by place
    assert tables.append_outcome(write, shuffled, table) == (True, "")
    assert spark.table(table).where("brand <> 'b' OR user_session <> 's'").isEmpty()


def test_a_day_is_pruned_to_its_partition(spark, raw, table):
    catalog.publish(feed(raw), table)
    plan = spark.table(table).where("event_date = DATE '2019-10-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_a_bucketed_table_needs_no_exchange_for_its_key(spark, raw, table):
    rows = [row(time=f"2019-10-0{1 + i % 9} 10:00:00", product=i % 50, user=i % 30, session=str(i)) for i in range(600)]
    silver = cleaning.clean(raw(rows))
    profile = catalog.publish_bucketed(silver, table, "user_id", 4)
    assert profile[catalog.ROWS] == 600
    features = gold.user_features(spark.table(table), by_user=True)
    assert sorted(map(tuple, features.collect())) == sorted(map(tuple, gold.user_features(silver).collect()))
    plan = features._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Expand" not in plan and "Bucketed: true" in plan
    files = spark.table(table).select(F.input_file_name()).distinct().count()
    assert files <= 4


def test_models_score_a_bucketed_table_by_user_without_an_exchange(spark, raw, table):
    """A join of features and events by user, both bucketed alike."""
    silver = cleaning.clean(raw([row(product=i, user=i % 30, session=str(i)) for i in range(300)]))
    catalog.publish_bucketed(silver, table, "user_id", 4)
    features = f"{table}_features"
    catalog.publish_bucketed(gold.user_features(spark.table(table), by_user=True), features, "user_id", 4)
    joined = spark.table(table).hint("merge").join(spark.table(features), "user_id")
    assert joined.count() == 300 and "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()


def test_models_can_be_trained_in_a_session_that_has_counted(spark, raw, table):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    profile = catalog.publish(feed(raw), table)
    rows = spark.table(table).selectExpr("price + product_id AS x", "CAST(product_id % 2 AS INT) AS label")
    model = LogisticRegression(maxIter=2).fit(VectorAssembler(inputCols=["x"], outputCol="features").transform(rows))
    assert model.transform(VectorAssembler(inputCols=["x"], outputCol="features").transform(rows)).count() == profile[catalog.ROWS]
