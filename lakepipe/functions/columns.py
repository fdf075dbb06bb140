"""Column expressions shared by the layers. All of them stay in generated JVM code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Event names, price bands and the wording of the two verdicts.
PURCHASE = "purchase"
VIEW = "view"
CART_EVENTS = ("cart", "add_to_cart")
CART_EVENTS_STRICT = ("add_to_cart",)
PRICE_BANDS = (("budget", 100), ("mid_range", 1000))
TOP_BAND = "premium"
VERDICTS = {1: "Likely to Purchase", 0: "Not Likely to Purchase"}


def price_band(price: Column) -> Column:
    """Half-open bands; NULL, NaN and everything from the last limit up is the top band."""
    band = F.lit(TOP_BAND)
    for name, limit in reversed(PRICE_BANDS):
        band = F.when(price < limit, name).otherwise(band)
    return band


def verdict(prediction: Column) -> Column:
    return F.when(prediction == 1, VERDICTS[1]).otherwise(VERDICTS[0])


def events_of(*names: str, column: str = "event_type") -> Column:
    """How many rows of the group carry one of these event names (0, never NULL)."""
    return F.count_if(F.col(column).isin(*names))


def percentage(part: Column, whole: Column) -> Column:
    """``part / whole`` in percent with two decimals; NULL where ``whole`` is 0."""
    return F.round(F.try_divide(part.cast("double") * 100, whole.cast("double")), 2)


def key_hash(key: Column, seed: int) -> Column:
    """60 bits of MD5 over ``key:seed`` as a non-negative bigint; the same on every engine."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def all_of(conditions: Sequence[Column]) -> Column:
    combined = conditions[0]
    for condition in conditions[1:]:
        combined = combined & condition
    return combined
