import math
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lakepipe.functions import money
from lakepipe.functions.columns import CART_EVENTS_STRICT
from lakepipe.operators import cleaning, gold, reports
from lakepipe.registry import _silver
from oracle import SMALL
from test_cleaning import row


def silver_of(frame):
    return cleaning.with_derived(frame)


@pytest.fixture(scope="module")
def silver(spark):
    return _silver(spark, SMALL).cache()


def test_users_against_plain_python(silver):
    want = defaultdict(lambda: defaultdict(float))
    products, days = defaultdict(set), defaultdict(set)
    for r in silver.collect():
        u = want[r["user_id"]]
        u["total_events"] += 1
        u["purchases"] += r["event_type"] == "purchase"
        u["views"] += r["event_type"] == "view"
        u["cart_adds"] += r["event_type"] in ("cart", "add_to_cart")
        u["total_spent"] += r["price"] * (r["event_type"] == "purchase")
        u["sum"] += r["price"]
        products[r["user_id"]].add(r["product_id"])
        days[r["user_id"]].add(r["event_date"])
    got = gold.user_features(silver).collect()
    assert len(got) == len(want)
    for r in got:
        u = want[r["user_id"]]
        for c in ("total_events", "purchases", "views", "cart_adds"):
            assert r[c] == u[c]
        assert r["total_spent"] == pytest.approx(u["total_spent"])
        assert r["avg_price"] == pytest.approx(u["sum"] / u["total_events"])
        assert (r["unique_products"], r["active_days"]) == (len(products[r["user_id"]]), len(days[r["user_id"]]))


def test_null_product_and_day_are_not_counted(raw):
    frame = silver_of(raw([row(product=None), row(product=None, time=None), row(product=5)]))
    only = gold.user_features(frame).first()
    assert (only["total_events"], only["unique_products"], only["active_days"]) == (3, 1, 1)


def test_null_user_is_one_group(raw):
    users = gold.user_features(silver_of(raw([row(user=None), row(user=None, product=2), row()]))).collect()
    assert sorted((r["user_id"], r["total_events"]) for r in users) == [(0, 2), (1, 1)]


def test_nan_price(raw):
    frame = silver_of(raw([row(kind="purchase", price=float("nan")), row(kind="purchase", price=1.0, product=2)]))
    assert math.isnan(gold.daily_revenue(frame).first()["total_revenue"])
    user = gold.user_features(frame).first()
    assert user["total_spent"] == 0 and user["avg_price"] == 0


def test_money_handles_nulls_and_huge_amounts(spark):
    frame = spark.createDataFrame([("n", None), ("s", 0.1), ("s", 0.2), ("h", 1e300), ("h", 0.5), ("i", math.inf)], "k string, v double")
    got = {r["k"]: r["t"] for r in frame.groupBy("k").agg(money.total(F.col("v")).alias("t")).collect()}
    assert got == {"n": None, "s": 0.3, "h": 1e300, "i": math.inf}


def test_sums_do_not_depend_on_partitioning(spark):
    events = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    totals = {
        events.repartition(n).agg(money.total(F.col("value")).alias("t"), money.mean(F.col("value")).alias("m")).first()
        for n in (1, 3, 7, 16)
    }
    assert len(totals) == 1


def test_purchases_agree_between_the_tables(silver):
    of = lambda frame, c: frame.agg(F.sum(c)).first()[0]
    daily = of(gold.daily_revenue(silver), "total_purchases")
    products = gold.product_performance(silver)
    assert daily == of(products, "purchases") == of(gold.user_features(silver), "purchases")
    assert products.where("conversion_rate NOT BETWEEN 0 AND 100").isEmpty()


def test_null_day_forms_a_group_and_sorts_first(raw):
    daily = gold.by_day(gold.daily_revenue(silver_of(raw([row(kind="purchase"), row(kind="purchase", time=None)]))))
    assert [r["event_date"] is None for r in daily.collect()] == [True, False]


def test_null_brand_is_its_own_product_group(raw):
    frame = silver_of(raw([row(brand=None), row(brand=None, price=11.0), row()]))
    got = {r["brand"]: r["total_views"] for r in gold.product_performance(frame).collect()}
    assert got == {None: 2, "b": 1}


def test_cart_event_names(raw):
    frame = silver_of(raw([row(kind="cart"), row(kind="add_to_cart"), row()]))
    assert gold.product_performance(frame).first()["cart_adds"] == 2
    assert gold.product_performance(frame, CART_EVENTS_STRICT).first()["cart_adds"] == 1
    assert gold.user_features(frame, CART_EVENTS_STRICT).first()["cart_adds"] == 1


def test_funnel_without_cart_events_is_null(raw):
    funnel = reports.purchase_funnel(gold.product_performance(silver_of(raw([row(kind="purchase"), row()])))).first()
    assert tuple(funnel) == (0.0, None, 50.0)


def test_funnel_of_an_empty_table(raw):
    assert tuple(reports.purchase_funnel(gold.product_performance(silver_of(raw([])))).first()) == (None,) * 3


def test_approximate_counts_stay_close(silver):
    exact = {r["user_id"]: r for r in gold.user_features(silver).collect()}
    for r in gold.user_features(silver, approximate=True).collect():
        assert abs(r["unique_products"] - exact[r["user_id"]]["unique_products"]) <= 1
        assert r["total_spent"] == exact[r["user_id"]]["total_spent"]
    assert gold.daily_revenue(silver, approximate=True).count() == gold.daily_revenue(silver).count()


def test_top_days_is_a_bounded_top_k(silver):
    top = reports.top_revenue_days(gold.daily_revenue(silver))
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()
    assert top.count() == 10 and reports.top_revenue_days(gold.daily_revenue(silver), 3).count() == 3


def test_scan_reads_only_what_is_needed(spark, silver, tmp_path):
    path = str(tmp_path / "silver")
    silver.write.parquet(path)
    stored = spark.read.parquet(path)
    plan = gold.daily_revenue(stored)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(event_type,purchase)" in plan
    assert "ReadSchema: struct<event_type:string,price:double,user_id:bigint,event_date:date>" in plan
    users = gold.user_features(stored)._jdf.queryExecution().executedPlan().toString()
    # One scan of five columns; the two distinct counts copy no rows.
    assert users.count("FileScan") == 1 and "event_hour" not in users and "user_session" not in users
    assert "Expand" not in users


def test_distinct_counts_are_bitmaps_and_copy_no_rows(raw):
    """Products beyond one range, negative and NULL ones, and days long before and after the common range."""
    products = [1, 32_768, 32_769, 70_000, -5, -40_000, 2**62, None, 1]
    days = ["2019-10-01", "1969-12-31", "1970-01-02", "2059-09-18", "2059-09-19", "0001-01-01", "9999-12-31", "2019-10-01", None]
    events = [
        row(time=d and f"{d} 10:00:00", product=p, user=u, session=f"{u}-{i}-{j}")
        for u in (1, 2)
        for i, p in enumerate(products[:: u])
        for j, d in enumerate(days[:: u])
    ]
    features = gold.user_features(cleaning.clean(raw(events)))
    got = {r["user_id"]: (r["unique_products"], r["active_days"], r["total_events"]) for r in features.collect()}
    assert got == {
        u: (len(set(products[::u]) - {None}), len(set(days[::u]) - {None}), len(products[::u]) * len(days[::u])) for u in (1, 2)
    }
    plan = features._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "bitmap_construct_agg" in plan and "bitmap_or_agg" in plan
