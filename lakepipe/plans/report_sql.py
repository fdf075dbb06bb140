"""The reports as SQL over registered tables or views: the same results as ``operators.reports``, for users of SQL.

Table names and numbers are named arguments; names go through IDENTIFIER, so no text is pasted into a statement.
Sums of money are exact for amounts of up to twelve places, as in ``functions.money``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakepipe.schemas import DAILY, LAYERS, PREDICTIONS, PRODUCTS, SILVER

TOP_REVENUE_DAYS = """
SELECT event_date, total_revenue, total_purchases, unique_buyers
FROM IDENTIFIER(:daily)
WHERE (:since IS NULL OR event_date >= :since) AND (:until IS NULL OR event_date <= :until)
ORDER BY total_revenue DESC NULLS LAST, event_date ASC NULLS LAST
LIMIT :n
"""

PURCHASE_FUNNEL = """
WITH totals AS (
  SELECT CAST(SUM(total_views) AS DOUBLE) AS views, CAST(SUM(cart_adds) AS DOUBLE) AS carts,
    CAST(SUM(purchases) AS DOUBLE) AS bought
  FROM IDENTIFIER(:products))
SELECT ROUND(try_divide(carts * 100, views), 2) AS view_to_cart_pct,
  ROUND(try_divide(bought * 100, carts), 2) AS cart_to_purchase_pct,
  ROUND(try_divide(bought * 100, views), 2) AS overall_conversion_pct
FROM totals
"""

PREDICTION_SUMMARY = """
SELECT purchase_label, COUNT(*) AS user_count,
  ROUND(try_divide(CAST(SUM(CAST(total_spent AS DECIMAL(38,12))) AS DOUBLE), COUNT(total_spent)), 2) AS avg_spend,
  ROUND(try_divide(CAST(SUM(CAST(purchase_probability AS DECIMAL(38,12))) AS DOUBLE), COUNT(purchase_probability)), 4)
    AS avg_score
FROM IDENTIFIER(:predictions)
GROUP BY purchase_label
ORDER BY avg_spend DESC NULLS LAST, purchase_label ASC NULLS LAST
"""

LAYER_COUNTS = """
SELECT layer, rows FROM (
  SELECT :bronze AS layer, COUNT(*) AS rows FROM IDENTIFIER(:bronze_table)
  UNION ALL SELECT :silver, COUNT(*) FROM IDENTIFIER(:silver_table)
  UNION ALL SELECT :daily, COUNT(*) FROM IDENTIFIER(:daily_table)
  UNION ALL SELECT :products, COUNT(*) FROM IDENTIFIER(:products_table)
  UNION ALL SELECT :users, COUNT(*) FROM IDENTIFIER(:users_table)
  UNION ALL SELECT :predictions, COUNT(*) FROM IDENTIFIER(:predictions_table))
ORDER BY layer
"""

EVENT_TYPE_DISTRIBUTION = """
SELECT event_type, COUNT(*) AS count
FROM IDENTIFIER(:silver)
GROUP BY event_type
ORDER BY count DESC, event_type ASC NULLS LAST
"""


def top_revenue_days(spark: SparkSession, daily: str = DAILY, n: int = 10, since=None, until=None) -> DataFrame:
    """The ``n`` days with the highest revenue, of the days from ``since`` to ``until`` where these are given."""
    return spark.sql(TOP_REVENUE_DAYS, args={"daily": daily, "n": n, "since": since, "until": until})


def purchase_funnel(spark: SparkSession, products: str = PRODUCTS) -> DataFrame:
    return spark.sql(PURCHASE_FUNNEL, args={"products": products})


def prediction_summary(spark: SparkSession, predictions: str = PREDICTIONS) -> DataFrame:
    return spark.sql(PREDICTION_SUMMARY, args={"predictions": predictions})


def event_type_distribution(spark: SparkSession, silver: str = SILVER) -> DataFrame:
    return spark.sql(EVENT_TYPE_DISTRIBUTION, args={"silver": silver})


def layer_counts(spark: SparkSession, names: dict[str, str] | None = None) -> DataFrame:
    """Rows per layer; ``names`` maps a layer to the table that holds it, where that is another name."""
    names = names or {}
    keys = dict(zip(("bronze", "silver", "daily", "products", "users", "predictions"), LAYERS, strict=True))
    args = dict(keys) | {f"{key}_table": names.get(layer, layer) for key, layer in keys.items()}
    return spark.sql(LAYER_COUNTS, args=args)
