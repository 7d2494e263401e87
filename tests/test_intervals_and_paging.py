import datetime
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shopmart.operators import paging
from shopmart.operators.intervals import holiday_events, interval_join

DAY = datetime.timedelta(days=1)


def sample(seed, events=400, intervals=12):
    rng = random.Random(seed)
    start = datetime.datetime(1969, 12, 20)
    times = [start + datetime.timedelta(seconds=rng.randrange(40 * 86400)) for _ in range(events)]
    times += [start + n * DAY for n in range(40)]
    spans = []
    for number in range(intervals):
        first = (start + rng.randrange(-2, 38) * DAY).date()
        spans.append((f"h{number}", first, first + rng.randrange(-1, 9) * DAY))
    return list(enumerate(times)), spans


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("options", [{}, {"bin_days": 1}, {"bin_days": 30}, {"broadcast_bytes": 0}])
@pytest.mark.parametrize("whole_days", [False, True])
def test_interval_join_equals_brute_force(spark, seed, options, whole_days):
    times, spans = sample(seed)
    events = spark.createDataFrame(times, "n int, event_time timestamp_ntz")
    calendar = spark.createDataFrame(spans, "holiday string, start_date date, end_date date")
    midnight = datetime.time()
    expected = {
        (n, name)
        for n, time in times
        for name, first, last in spans
        if datetime.datetime.combine(first, midnight) <= time
        and (
            time < datetime.datetime.combine(last + DAY, midnight)
            if whole_days
            else time <= datetime.datetime.combine(last, midnight)
        )
    }
    joined = interval_join(events, calendar, inclusive_end_day=whole_days, **options)
    found = [(row.n, row.holiday) for row in joined.collect()]
    assert len(found) == len(expected) and set(found) == expected
    assert joined.columns == ["n", "event_time", "holiday", "start_date", "end_date"]


def test_timestamp_bounds(spark):
    events = spark.sql("SELECT timestamp_ntz'2024-01-01 10:00:00' + make_interval(0,0,0,0,id) AS event_time FROM range(5)")
    calendar = spark.sql(
        "SELECT 'x' AS holiday, timestamp_ntz'2024-01-01 11:00:00' AS start_date, timestamp_ntz'2024-01-01 12:30:00' AS end_date"
    )
    assert interval_join(events, calendar).count() == 2


def test_empty_calendar(spark):
    events = spark.sql("SELECT timestamp_ntz'2024-01-01 10:00:00' AS event_time")
    calendar = spark.createDataFrame([], "holiday string, start_date date, end_date date")
    assert interval_join(events, calendar).isEmpty()


def test_no_nested_loop_and_filter_in_the_scan(spark, tmp_path, plan):
    times, spans = sample(3)
    path = str(tmp_path / "events")
    spark.createDataFrame(times, "n int, event_time timestamp_ntz").write.parquet(path)
    calendar = spark.createDataFrame(spans, "holiday string, start_date date, end_date date")
    text = plan(interval_join(spark.read.parquet(path), calendar))
    assert "BroadcastHashJoin" in text and "NestedLoop" not in text and "Cartesian" not in text
    assert "GreaterThanOrEqual(event_time" in text and "LessThanOrEqual(event_time" in text


def test_holiday_events(spark):
    events = spark.createDataFrame(
        [
            ("cart", datetime.datetime(2024, 1, 26, 10)),
            ("cart", datetime.datetime(2024, 1, 25, 10)),
            ("view", datetime.datetime(2024, 1, 25, 10)),
        ],
        "event_type string, event_time timestamp_ntz",
    )
    calendar = spark.createDataFrame(
        [
            ("Black Friday", datetime.date(2024, 1, 19), datetime.date(2024, 1, 26)),
            ("New Year", datetime.date(2024, 1, 25), datetime.date(2024, 1, 25)),
            ("Other", datetime.date(2024, 1, 1), datetime.date(2024, 1, 31)),
        ],
        "holiday string, start_date date, end_date date",
    )
    # a DATE end is midnight: 10:00 on the end date lies outside
    assert [row.holiday for row in holiday_events(events, calendar).collect()] == ["Black Friday"]
    whole = holiday_events(events, calendar, inclusive_end_day=True)
    assert sorted(row.holiday for row in whole.collect()) == ["Black Friday", "Black Friday", "New Year"]


def shuffled_keys(spark, count):
    names = [f"b{n:05d}" for n in range(count)]
    random.Random(5).shuffle(names)
    return spark.createDataFrame([(name,) for name in names], "brand string").repartition(7)


def test_ranks_and_batches_equal_a_global_sort(spark):
    keys = shuffled_keys(spark, 1003)
    ranked = paging.key_ranks(keys, "brand").collect()
    assert [row.brand for row in sorted(ranked, key=lambda row: row.position)] == [f"b{n:05d}" for n in range(1003)]
    assert sorted(row.position for row in ranked) == list(range(1003))
    batches = paging.number_batches(keys, "brand", 25).groupBy("batch_id").count().collect()
    assert {row.batch_id: row["count"] for row in batches} == {n: 25 if n < 40 else 3 for n in range(41)}


def test_batches_without_adaptive_merging(spark, session_conf):
    session_conf("spark.sql.adaptive.enabled", "false")
    ranked = paging.key_ranks(shuffled_keys(spark, 500), "brand")
    assert ranked.filter(F.col("brand") != F.format_string("b%05d", "position")).isEmpty()


def test_empty_key_set(spark):
    assert paging.number_batches(spark.createDataFrame([], "brand string"), "brand").isEmpty()


def test_pages(spark):
    keys = shuffled_keys(spark, 60)
    assert [row.brand for row in paging.page(keys, "brand", 25, 50).collect()] == [f"b{n:05d}" for n in range(50, 60)]
    assert paging.page(keys, "brand", 25, 75).isEmpty()
    assert [row.brand for row in paging.page(keys, "brand").collect()] == [f"b{n:05d}" for n in range(25)]


@pytest.mark.parametrize("options", [{}, {"bin_days": 1}, {"bin_days": 7}])
def test_the_size_bound_holds(spark, monkeypatch, options):
    """The bytes passed to the join are never fewer than the binned calendar has."""
    from shopmart.operators import intervals, joins

    times, spans = sample(4, events=5, intervals=60)
    seen = {}

    def watch(facts, dimension, keys, **sizes):
        seen.update(sizes, actual=joins.value_bytes(dimension))
        return joins.dimension_join(facts, dimension, keys, **sizes)

    monkeypatch.setattr(intervals, "dimension_join", watch)
    calendar = spark.createDataFrame(spans, "holiday string, start_date date, end_date date")
    interval_join(spark.createDataFrame(times, "n int, event_time timestamp_ntz"), calendar, **options)
    assert 0 < seen["actual"] <= seen["dimension_bytes"]


def test_pages_are_sought_in_few_ranges(spark, monkeypatch):
    """Pages by number and by key equal slices of the sorted keys, write nothing and open only the ranges they lie in."""
    keys = shuffled_keys(spark, 1000)
    names = sorted(row.brand for row in keys.collect())
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        index = paging.store_pages(keys, "brand")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    ranges = {r["range"]: (r["start"], r["start"] + r["rows"]) for r in index.ranges().collect()}
    assert index.rows() == 1000 and len(ranges) > 2
    files = {str(path) for path in Path(index.place.removeprefix("file:")).rglob("*")}
    again = paging.PageIndex(spark, index.place, "brand", keys.schema)
    for offset in (0, 1, 130, 499, 985, 999, 1000, 5000):
        found = again.page(20, offset)
        assert [row.brand for row in found.collect()] == names[offset : offset + 20]
        opened = {int(name.split("_range=")[1].split("/")[0]) for name in found.inputFiles()}
        assert opened == {n for n, (start, end) in ranges.items() if start < offset + 20 and end > offset}
    for value in ("", names[0], names[130], names[130] + "!", names[984], names[999], "zzz"):
        later = [name for name in names if name > value][:20]
        assert [row.brand for row in again.after(value, 20).collect()] == later
    assert {str(path) for path in Path(index.place.removeprefix("file:")).rglob("*")} == files


def test_pages_of_no_keys(spark):
    index = paging.store_pages(spark.createDataFrame([], "brand string"), "brand")
    assert index.rows() == 0 and index.page().isEmpty() and index.after("").isEmpty()
