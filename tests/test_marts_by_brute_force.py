"""The marts on random events against plain Python."""

import datetime
import random
from collections import Counter, defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest

from shopmart.plans import marts
from shopmart.schemas import BROAD_LABEL, HOLIDAY_SCHEMA, HOLIDAYS, NARROW_LABEL

START = datetime.datetime(2019, 11, 5)
CODES = ["auto.x", "auto", "kids.toy", "electronics.tv", "medicine.a.b", "sport", None]
SCHEMA = (
    "event_time timestamp_ntz, event_type string, product_id long, category_code string,"
    " user_id long, user_session string"
)


def random_events(rng, count):
    return [
        (
            START + datetime.timedelta(hours=rng.randrange(24 * 35)),
            rng.choice(["view", "cart", "cart", "purchase"]),
            rng.randrange(3),
            rng.choice(CODES),
            rng.randrange(12),
            rng.choice(["s1", "s2", "s3", "s4", None]),
        )
        for _ in range(count)
    ]


def random_holidays(rng):
    rows = []
    for name in [*HOLIDAYS, HOLIDAYS[0], "Unlisted"]:
        first = (START + datetime.timedelta(days=rng.randrange(33))).date()
        last = first + datetime.timedelta(days=rng.randrange(6))
        rows.append((name, first, last, rng.choice([first, last])))
    return rows


def midnight(day):
    return datetime.datetime.combine(day, datetime.time())


def expected_conversion(events, holidays):
    rows = [
        event
        for event in events
        for name, first, last, _ in holidays
        if name in HOLIDAYS and event[1] in ("cart", "purchase") and midnight(first) <= event[0] <= midnight(last)
    ]
    triples = defaultdict(list)
    for time, kind, product, _, user, session in rows:
        triples[user, session, product].append((kind, time))
    matched = 0
    for found in triples.values():
        carts = [time for kind, time in found if kind == "cart"]
        purchases = [time for kind, time in found if kind == "purchase"]
        matched += len(found) == 2 and bool(carts) and bool(purchases) and min(carts) < max(purchases)
    kinds, on_holiday = Counter(event[1] for event in events), Counter(row[1] for row in rows)
    return (
        Decimal(matched) / on_holiday["cart"],
        Decimal(kinds["purchase"] - matched) / (kinds["cart"] - on_holiday["cart"]),
    )


@pytest.mark.parametrize("seed", range(3))
def test_holiday_conversion(spark, seed):
    rng = random.Random(seed)
    events, holidays = random_events(rng, 600), random_holidays(rng)
    mart = marts.holiday_conversion(spark.createDataFrame(events, SCHEMA), spark.createDataFrame(holidays, HOLIDAY_SCHEMA))
    found, expected = mart.first(), expected_conversion(events, holidays)
    assert expected[0] > 0 or seed == 1  # the second sample happens to match nothing
    assert all(abs(left - right) < Decimal("1e-17") for left, right in zip(found, expected))


@pytest.mark.parametrize("seed", range(2))
def test_category_conversion(spark, seed):
    events = random_events(random.Random(seed), 500)
    counts = defaultdict(Counter)
    for _, kind, _, code, _, _ in events:
        if code is not None and code.split(".")[0] != "electronics":
            counts[code.split(".")[0]][kind] += 1
    expected = [
        (
            top,
            kinds["cart"],
            kinds["purchase"],
            (Decimal(kinds["purchase"]) / kinds["cart"]).quantize(Decimal("0.0001"), ROUND_HALF_UP),
            NARROW_LABEL if top in ("auto", "medicine") else BROAD_LABEL,
        )
        for top, kinds in counts.items()
        if kinds["cart"]
    ]
    found = [tuple(row) for row in marts.category_conversion(spark.createDataFrame(events, SCHEMA)).collect()]
    assert found == sorted(expected, key=lambda row: (-row[3], row[0]))


@pytest.mark.parametrize("seed", range(2))
def test_black_friday_sales(spark, seed):
    rng = random.Random(seed)
    events, holidays = random_events(rng, 500), random_holidays(rng)
    days = Counter(event[0].date().isoformat() for event in events if event[1] == "purchase")
    dates = Counter(row[3].isoformat() for row in holidays)
    expected = []
    for day in sorted(days):
        if "2019-11-10" <= day <= "2019-12-03":
            label = "Last sale day" if day == "2019-12-03" else "Black Friday" if day >= "2019-11-22" else "no sale"
            expected += [(days[day], day, label)] * max(1, dates[day])
    mart = marts.black_friday_sales(spark.createDataFrame(events, SCHEMA), spark.createDataFrame(holidays, HOLIDAY_SCHEMA))
    assert [(row.purchases, row.day.isoformat(), row.saleday) for row in mart.collect()] == expected
