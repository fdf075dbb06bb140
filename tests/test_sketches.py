"""Mergeable sketches of buyers."""

import datetime

import pytest
from pyspark.sql import functions as F

from lakepipe.operators import cleaning, sketches
from test_cleaning import row


def silver_of(raw, rows):
    return cleaning.clean(raw([row(time=f"{day} 10:00:00" if day else None, kind=kind, user=user, session=str(k)) for k, (day, kind, user) in enumerate(rows)]))


ROWS = [(f"2024-01-{1 + d:02d}", "purchase", d * 37 % 200 + u) for d in range(20) for u in range(60)]
ROWS += [("2024-01-01", "view", 9999), ("2024-01-01", "purchase", 0), (None, "purchase", 5)]


def exact(rows, first, last):
    return len({u for d, kind, u in rows if d and kind == "purchase" and first <= datetime.date.fromisoformat(d) <= last})


def test_small_counts_are_exact_and_copies_count_once(raw):
    daily = sketches.daily_buyers(silver_of(raw, ROWS))
    weeks = {r["week"]: (r["purchases"], r["estimate"]) for r in sketches.by_week(daily.union(daily)).collect()}
    for monday in (datetime.date(2024, 1, 1), datetime.date(2024, 1, 8), datetime.date(2024, 1, 15)):
        assert weeks[monday][1] == exact(ROWS, monday, monday + datetime.timedelta(6))
    assert weeks[datetime.date(2024, 1, 8)][0] == 2 * 7 * 60 and weeks[None] == (2, 1)


def test_trailing_windows(raw):
    daily = sketches.daily_buyers(silver_of(raw, ROWS))
    found = {r["until"]: r["estimate"] for r in sketches.trailing(daily, 7).collect()}
    assert found == {
        d: exact(ROWS, d - datetime.timedelta(6), d) for d in (datetime.date(2024, 1, 1) + datetime.timedelta(k) for k in range(20))
    }


@pytest.mark.parametrize("lg_k", [8, 12])
def test_estimates_within_their_bound(spark, raw, lg_k):
    """Many buyers in few registers: every merge of days is off by no more than five deviations."""
    events = spark.range(40_000).selectExpr(
        "date_add(DATE '2024-01-01', CAST(id % 8 AS INT)) AS event_date", "id * 7919 % 15000 AS user_id", "'purchase' AS event_type"
    )
    daily = sketches.daily_buyers(events, lg_k)
    weekly = events.selectExpr("CAST(date_trunc('week', event_date) AS DATE) AS week", "user_id").distinct()
    truth = {r["week"]: r["count"] for r in weekly.groupBy("week").count().collect()}
    for r in sketches.by_week(daily).collect():
        assert abs(r["estimate"] - truth[r["week"]]) <= truth[r["week"]] * sketches.relative_error(lg_k, 5) + 0.5
    assert sketches.relative_error(lg_k) == 3 * 1.04 / 2 ** (lg_k / 2)


def test_off_by_more(spark):
    frame = spark.createDataFrame([(1000, 1000), (1020, 1000), (1030, 1000), (0, 0), (1, 0)], "e long, x long")
    off = [r["off"] for r in frame.select(sketches.off_by_more(F.col("e"), F.col("x")).alias("off")).collect()]
    assert off == [False, False, True, False, True]


def test_no_purchases(raw):
    none = sketches.daily_buyers(silver_of(raw, [("2024-01-01", "view", 1)]))
    assert none.count() == sketches.by_week(none).count() == sketches.trailing(none, 7).count() == 0
