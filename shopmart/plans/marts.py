"""The three marts and the queries they are made of."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from shopmart.functions.rates import ratio, top_category
from shopmart.operators.intervals import holiday_events
from shopmart.schemas import (
    BROAD_LABEL,
    EXCLUDED_CATEGORIES,
    HOLIDAYS,
    LAST_SALE_DAY,
    NARROW_CATEGORIES,
    NARROW_LABEL,
    SALE_DAYS,
    SALE_LABELS,
    SALE_WINDOW,
)

TRIPLE = ["user_id", "user_session", "product_id"]


def event_totals(events: DataFrame, cart: str = "cart", purchase: str = "purchase") -> DataFrame:
    """All purchases and all carts, from one pass over the event type."""
    kind = F.col("event_type")
    return events.filter(kind.isin(cart, purchase)).agg(
        F.count_if(kind == purchase).alias("overall_purchases"),
        F.count_if(kind == cart).alias("overall_carts"),
    )


def triple_times(pairs: DataFrame, cart: str = "cart", purchase: str = "purchase") -> DataFrame:
    """Per user, session and product: row count, carts, first cart time, last purchase time."""
    kind, time = F.col("event_type"), F.col("event_time")
    return pairs.groupBy(*TRIPLE).agg(
        F.count("*").alias("rows"),
        F.count_if(kind == cart).alias("carts"),
        F.min(F.when(kind == cart, time)).alias("added_to_cart_time"),
        F.max(F.when(kind == purchase, time)).alias("purchased_time"),
    )


# Exactly two rows in the triple, a cart and a later purchase; a missing time fails the test.
CONVERTED = "rows = 2 AND added_to_cart_time < purchased_time"


def cart_then_purchase(pairs: DataFrame, cart: str = "cart", purchase: str = "purchase") -> DataFrame:
    """The triples that hold one cart and one later purchase and nothing else."""
    return (
        triple_times(pairs, cart, purchase)
        .filter(CONVERTED)
        .select(*TRIPLE, "added_to_cart_time", "purchased_time")
    )


def holiday_conversion(
    events: DataFrame,
    holidays: DataFrame,
    names: Sequence[str] = HOLIDAYS,
    cart: str = "cart",
    purchase: str = "purchase",
    inclusive_end_day: bool = False,
    null_on_zero: bool = False,
) -> DataFrame:
    """Conversion on holidays and on the remaining days.

    The holiday numerator counts converted triples, its denominator holiday carts; the other
    rate is the same on what is left of all purchases and carts. The events are read twice:
    the totals need the event type of every row, the triples only rows within the calendar.
    Without a cart on either side the job fails, or that rate is null with ``null_on_zero``.
    """
    pairs = holiday_events(events, holidays, names, (cart, purchase), inclusive_end_day=inclusive_end_day)
    on_holidays = triple_times(pairs, cart, purchase).agg(
        F.count_if(F.expr(CONVERTED)).alias("holiday_purchases"),
        F.coalesce(F.sum("carts"), F.lit(0)).alias("holiday_carts"),
    )
    overall = event_totals(events, cart, purchase)
    counts = on_holidays.unionByName(overall, allowMissingColumns=True).agg(
        *[F.sum(name).alias(name) for name in on_holidays.columns + overall.columns]
    )
    holiday_carts = F.col("holiday_carts")
    other_carts = F.col("overall_carts") - holiday_carts
    if null_on_zero:
        holiday_carts, other_carts = F.nullif(holiday_carts, F.lit(0)), F.nullif(other_carts, F.lit(0))
    return counts.select(
        ratio(F.col("holiday_purchases"), holiday_carts).alias("holiday_conversion"),
        ratio(F.col("overall_purchases") - F.col("holiday_purchases"), other_carts).alias("overall_conversion"),
    )


def category_conversion(
    events: DataFrame,
    cart: str = "cart",
    purchase: str = "purchase",
    excluded: Sequence[str] = EXCLUDED_CATEGORIES,
    narrow: Sequence[str] = NARROW_CATEGORIES,
    labels: tuple[str, str] = (NARROW_LABEL, BROAD_LABEL),
) -> DataFrame:
    """Carts, purchases and their ratio per top category that has a cart, best ratio first."""
    kind, top = F.col("event_type"), F.col("top_category")
    carts, purchases = F.col("add_to_cart_count"), F.col("purchase_count")
    counted = (
        events.filter(kind.isin(cart, purchase))
        .select(top_category(F.col("category_code")).alias("top_category"), "event_type")
        .filter(~top.isin(list(excluded)))
        .groupBy("top_category")
        .agg(
            F.count_if(kind == cart).alias("add_to_cart_count"),
            F.count_if(kind == purchase).alias("purchase_count"),
        )
        .filter(carts > 0)
    )
    return counted.select(
        "top_category",
        "add_to_cart_count",
        "purchase_count",
        F.round(ratio(purchases, F.nullif(carts, F.lit(0))), 4).alias("conversion_rate"),
        F.when(top.isin(list(narrow)), labels[0]).otherwise(labels[1]).alias("category"),
    ).orderBy(F.desc("conversion_rate"), "top_category")


def daily_purchases(events: DataFrame, window: tuple[str, str] = SALE_WINDOW, purchase: str = "purchase") -> DataFrame:
    """Purchases per day from the first to the last day of the window."""
    day = F.to_date("event_time")
    inside = day.between(F.lit(window[0]).cast("date"), F.lit(window[1]).cast("date"))
    return (
        events.filter((F.col("event_type") == purchase) & inside)
        .groupBy(day.alias("day"))
        .agg(F.count("*").alias("purchases"))
    )


def black_friday_sales(
    events: DataFrame,
    holidays: DataFrame,
    window: tuple[str, str] = SALE_WINDOW,
    sale: tuple[str, str] = SALE_DAYS,
    last_day: str = LAST_SALE_DAY,
    labels: tuple[str, str, str] = SALE_LABELS,
    purchase: str = "purchase",
) -> DataFrame:
    """Daily purchases with a sale label, by day; a date that the calendar repeats is repeated."""
    day = F.col("day")
    daily = daily_purchases(events, window, purchase)
    calendar = holidays.select(F.col("date").alias("day"))
    label = (
        F.when(day.between(F.lit(sale[0]).cast("date"), F.lit(sale[1]).cast("date")), labels[0])
        .when(day == F.lit(last_day).cast("date"), labels[1])
        .otherwise(labels[2])
    )
    return daily.join(calendar, "day", "left").select("purchases", "day", label.alias("saleday")).orderBy("day")
