import datetime
from decimal import Decimal

import pytest

from shopmart.plans import marts
from shopmart.schemas import BROAD_LABEL, NARROW_LABEL

EVENT = "event_time timestamp_ntz, event_type string, product_id long, category_code string, user_id long, user_session string"


def at(day, hour=0, month=1):
    return datetime.datetime(2024, month, day, hour)


def events(spark, *rows):
    """(time, type, product, session) rows of one user."""
    return spark.createDataFrame([(t, kind, product, "auto.x", 1, session) for t, kind, product, session in rows], EVENT)


def calendar(spark, *rows):
    return spark.createDataFrame(list(rows), "holiday string, start_date date, end_date date, date date")


NEW_YEAR = ("New Year", datetime.date(2024, 1, 1), datetime.date(2024, 1, 9), datetime.date(2024, 1, 1))


def test_only_one_cart_before_one_purchase_counts(spark):
    pairs = events(
        spark,
        (at(1, 1), "cart", 1, "two carts"),
        (at(1, 2), "cart", 1, "two carts"),
        (at(1, 1), "purchase", 1, "two purchases"),
        (at(1, 2), "purchase", 1, "two purchases"),
        (at(1, 2), "cart", 1, "late cart"),
        (at(1, 1), "purchase", 1, "late cart"),
        (at(1, 1), "cart", 1, "same time"),
        (at(1, 1), "purchase", 1, "same time"),
        (at(1, 1), "cart", 1, "three rows"),
        (at(1, 2), "purchase", 1, "three rows"),
        (at(1, 3), "purchase", 1, "three rows"),
        (at(1, 1), "cart", 1, "good"),
        (at(1, 2), "purchase", 1, "good"),
        (at(1, 1), "cart", 2, None),
        (at(1, 2), "purchase", 2, None),
    )
    found = {row.user_session for row in marts.cart_then_purchase(pairs).collect()}
    assert found == {"good", None}


def test_holiday_conversion(spark):
    data = events(
        spark,
        (at(1, 1), "cart", 1, "a"),
        (at(1, 2), "purchase", 1, "a"),
        (at(2, 1), "cart", 2, "b"),
        (at(20), "cart", 3, "c"),
        (at(20), "cart", 3, "d"),
        (at(20), "cart", 3, "e"),
        (at(21), "purchase", 3, "c"),
        (at(21), "view", 3, "c"),
    )
    row = marts.holiday_conversion(data, calendar(spark, NEW_YEAR)).first()
    assert row.holiday_conversion == Decimal("0.5")
    assert abs(row.overall_conversion - Decimal(1) / 3) < Decimal("1e-17")


def test_overlapping_holidays_repeat_events(spark):
    data = events(spark, (at(1, 1), "cart", 1, "a"), (at(1, 2), "purchase", 1, "a"), (at(20), "cart", 1, "b"), (at(20), "cart", 1, "c"), (at(20), "cart", 1, "d"))
    twice = calendar(spark, NEW_YEAR, ("Black Friday", *NEW_YEAR[1:]))
    row = marts.holiday_conversion(data, twice).first()
    # four joined rows in the triple: not converted; two holiday carts
    assert row.holiday_conversion == 0 and row.overall_conversion == Decimal("0.5")


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_no_holiday_cart_is_an_error(spark, session_conf, ansi):
    session_conf("spark.sql.ansi.enabled", ansi)
    data = events(spark, (at(20), "cart", 1, "a"), (at(20), "purchase", 1, "a"))
    with pytest.raises(Exception, match="division by zero"):
        marts.holiday_conversion(data, calendar(spark, NEW_YEAR)).collect()
    row = marts.holiday_conversion(data, calendar(spark, NEW_YEAR), null_on_zero=True).first()
    assert row.holiday_conversion is None and row.overall_conversion == 1


def test_category_conversion(spark):
    rows = [("auto.a", "cart")] * 3 + [("auto.b", "purchase")] * 2 + [("kids", "cart"), ("electronics.a", "cart")]
    rows += [("sport.a", "purchase"), (None, "cart"), ("kids", "view"), ("medicine", "cart"), ("medicine", "purchase")]
    frame = spark.createDataFrame(rows, "category_code string, event_type string")
    found = [tuple(row) for row in marts.category_conversion(frame).collect()]
    assert found == [
        ("medicine", 1, 1, Decimal("1.0000"), NARROW_LABEL),
        ("auto", 3, 2, Decimal("0.6667"), NARROW_LABEL),
        ("kids", 1, 0, Decimal("0.0000"), BROAD_LABEL),
    ]


def test_rate_rounds_half_up(spark):
    rows = [("kids", "cart")] * 32 + [("kids", "purchase")]
    frame = spark.createDataFrame(rows, "category_code string, event_type string")
    assert marts.category_conversion(frame).first().conversion_rate == Decimal("0.0313")


def test_black_friday_sales(spark):
    days = [(2019, 11, 9), (2019, 11, 10), (2019, 11, 21), (2019, 11, 22), (2019, 12, 2), (2019, 12, 3), (2019, 12, 4)]
    rows = [(datetime.datetime(*day, 23, 59, 59), kind) for day in days for kind in ("purchase", "cart")]
    frame = spark.createDataFrame(rows + [(datetime.datetime(2019, 12, 3), "purchase")], "event_time timestamp_ntz, event_type string")
    day = datetime.date(2019, 11, 22)
    dates = calendar(spark, ("Black Friday", day, day, day), ("Again", day, day, day))
    found = [(row.purchases, row.day.isoformat(), row.saleday) for row in marts.black_friday_sales(frame, dates).collect()]
    assert found == [
        (1, "2019-11-10", "no sale"),
        (1, "2019-11-21", "no sale"),
        (1, "2019-11-22", "Black Friday"),
        (1, "2019-11-22", "Black Friday"),
        (1, "2019-12-02", "Black Friday"),
        (2, "2019-12-03", "Last sale day"),
    ]


def test_marts_push_their_filters_down(spark, tmp_path, plan):
    path = str(tmp_path / "final")
    events(spark, (at(1), "cart", 1, "a")).write.parquet(path)
    stored = spark.read.parquet(path)
    text = plan(marts.daily_purchases(stored))
    assert "EqualTo(event_type,purchase)" in text and "GreaterThanOrEqual(event_time" in text
    assert "ReadSchema: struct<event_time:timestamp_ntz,event_type:string>" in text
    text = plan(marts.event_totals(stored))
    assert "In(event_type, [cart,purchase])" in text and "ReadSchema: struct<event_type:string>" in text
    text = plan(marts.holiday_conversion(stored, calendar(spark, NEW_YEAR)))
    assert "Cartesian" not in text and "NestedLoop" not in text
