"""Column contracts of the raw feed and of the six published tables."""

from __future__ import annotations

from pyspark.sql import types as T

BRONZE = "bronze.events"
SILVER = "silver.events"
DAILY = "gold.daily_revenue"
PRODUCTS = "gold.product_performance"
USERS = "gold.user_features"
PREDICTIONS = "gold.user_purchase_predictions"

# The text of a feed line that does not fit the contract; only tables read from files have it.
UNREADABLE = "unreadable_line"

LAYERS = (BRONZE, SILVER, DAILY, PRODUCTS, USERS, PREDICTIONS)

RAW_DDL = (
    "event_time timestamp, event_type string, product_id bigint, brand string, "
    "price double, user_id bigint, user_session string"
)

CONTRACT_DDL = {
    BRONZE: f"{RAW_DDL}, ingestion_ts timestamp",
    SILVER: f"{RAW_DDL}, event_date date, event_hour int, price_category string",
    DAILY: (
        "event_date date, total_purchases bigint, total_revenue double, "
        "avg_order_value double, unique_buyers bigint"
    ),
    PRODUCTS: (
        "product_id bigint, brand string, price_category string, total_views bigint, "
        "view_events bigint, purchases bigint, cart_adds bigint, avg_price double, "
        "conversion_rate double"
    ),
    USERS: (
        "user_id bigint, total_events bigint, purchases bigint, views bigint, "
        "cart_adds bigint, total_spent double, avg_price double, "
        "unique_products bigint, active_days bigint"
    ),
    PREDICTIONS: (
        "user_id bigint, total_events bigint, total_spent double, avg_price double, "
        "will_purchase int, purchase_probability double, purchase_label string, "
        "is_train boolean"
    ),
}

# The grain of each table that has one.
TABLE_KEYS = {
    SILVER: ("user_session", "event_time", "product_id"),
    DAILY: ("event_date",),
    PRODUCTS: ("product_id", "brand", "price_category"),
    USERS: ("user_id",),
    PREDICTIONS: ("user_id",),
}


def parse(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def contract(table: str) -> T.StructType:
    return parse(CONTRACT_DDL[table])


def raw_schema() -> T.StructType:
    return parse(RAW_DDL)
