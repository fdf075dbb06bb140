import pytest
from pyspark.sql import functions as F

from lakepipe.functions import money
from lakepipe.operators import gold
from lakepipe.operators.cleaning import clean
from test_cleaning import row

NAN, INF = float("nan"), float("inf")


@pytest.fixture(params=["true", "false"])
def totals(spark, conf, request):
    conf("spark.sql.ansi.enabled", request.param)

    def build(values, parts=1):
        frame = spark.createDataFrame([(v,) for v in values], "x double").repartition(parts)
        return frame.agg(money.total(F.col("x")).alias("t"), money.mean(F.col("x")).alias("m")).first()

    return build


@pytest.mark.parametrize(
    "values,total",
    [
        ([0.004] * 1000, 4.0),
        ([1.125, 2.376], 3.501),
        ([0.1] * 10, 1.0),
        ([-33.7, 0.1, 0.2], -33.4),
        ([3e12] * 5 + [1e-3], 15000000000000.001),
        ([9e13 + 0.5, 0.25, -0.01], 90000000000000.74),
        ([None, 5.0], 5.0),
        ([None], None),
        ([], None),
        ([INF, 1.0], INF),
        ([1e300, 1.0], 1e300),
        ([9e25] * 20, 1.8e27),
    ],
)
def test_nothing_is_lost(totals, values, total):
    found = totals(values)["t"]
    assert found == total or abs(found - total) <= 2e-16 * abs(total)


def test_nan_reaches_the_result(totals):
    assert totals([NAN, 1.0])["t"] != totals([NAN, 1.0])["t"]


def test_order_and_partitions_do_not_matter(totals):
    values = [((i * 7919) % 10007) / 997 - 3 for i in range(3000)]
    assert len({(totals(values, p)["t"], totals(values, p)["m"]) for p in (1, 4, 64)}) == 1


def test_many_large_amounts_do_not_overflow(spark, conf):
    conf("spark.sql.ansi.enabled", "false")
    frame = spark.range(0, 3_000_000, 1, 4).select(F.lit(4.0e13).alias("x"))
    assert frame.agg(money.total(F.col("x")).alias("t")).first()["t"] == 1.2e20


def test_tables_keep_amounts_below_a_cent(raw):
    rows = [row(kind="purchase", user=1, product=i, price=0.004) for i in range(250)]
    silver = clean(raw(rows))
    assert gold.daily_revenue(silver).first()["total_revenue"] == 1.0
    users = gold.user_features(silver).first()
    assert (users["total_spent"], users["avg_price"]) == (1.0, 0.004)
    assert gold.product_performance(silver).first()["avg_price"] == 0.004
