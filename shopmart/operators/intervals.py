"""Interval join of events with a calendar."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from shopmart.operators.joins import BROADCAST_BYTES, dimension_join, row_bytes
from shopmart.schemas import HOLIDAYS


def _bin(day: Column, width: int) -> Column:
    return F.floor(F.unix_date(day) / F.lit(width))


def interval_join(
    events: DataFrame,
    intervals: DataFrame,
    time: str = "event_time",
    start: str = "start_date",
    end: str = "end_date",
    *,
    bin_days: int | None = None,
    inclusive_end_day: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Every pair of an event and an interval that contains it, as an equi-join on a time bin.

    Each interval is repeated once per bin it touches and each event lies in one bin, so a
    pair meets once and overlapping intervals repeat the event. ``bin_days`` defaults to the
    average interval length, which keeps the repetition near two bins per interval.

    One row of calendar totals is fetched first. It gives the bin width, the covered time
    range, which reaches the event scan as a plain filter, and a bound for the bytes of the
    binned calendar: up to ``broadcast_bytes`` it is broadcast and the events are not
    shuffled, beyond that crowded bins are joined apart from the rest.

    A DATE end bound means midnight; ``inclusive_end_day`` counts the whole last day.
    """
    if inclusive_end_day:
        intervals = intervals.withColumn("_until", F.date_add(F.to_date(end), 1))
        inside = F.col(time) < F.col("_until")
        last_day = F.col("_until")
    else:
        intervals = intervals.withColumn("_until", F.col(end))
        inside = F.col(time) <= F.col("_until")
        last_day = F.to_date("_until")
    first_day = F.to_date(start)
    valid = intervals.filter(F.col(start) <= F.col("_until"))

    totals = valid.agg(
        F.count("*").alias("intervals"),
        F.sum(F.datediff(last_day, first_day) + 1).alias("days"),
        F.min(start).cast("string").alias("opening"),
        F.max("_until").cast("string").alias("closing"),
        F.max(row_bytes(valid)).alias("widest"),
    ).first()
    if totals.intervals:
        width = bin_days or max(1, round(totals.days / totals.intervals))
        opening = F.lit(totals.opening).cast(valid.schema[start].dataType)
        closing = F.lit(totals.closing).cast(valid.schema["_until"].dataType)
        events = events.filter(F.col(time).between(opening, closing))
        # an interval of n days touches at most n / width + 2 bins
        most_bytes = (totals.days // width + 2 * totals.intervals) * (totals.widest + 8)
    else:
        width, most_bytes = bin_days or 1, 0

    binned = valid.withColumn("_bin", F.explode(F.sequence(_bin(first_day, width), _bin(last_day, width))))
    joined = dimension_join(
        events.withColumn("_bin", _bin(F.to_date(time), width)),
        binned,
        ["_bin"],
        dimension_bytes=most_bytes,
        broadcast_bytes=broadcast_bytes,
    )
    return joined.filter((F.col(time) >= F.col(start)) & inside).drop("_bin", "_until")


def holiday_events(
    events: DataFrame,
    holidays: DataFrame,
    names: Sequence[str] = HOLIDAYS,
    event_types: Sequence[str] = ("cart", "purchase"),
    *,
    bin_days: int | None = None,
    inclusive_end_day: bool = False,
) -> DataFrame:
    """Events of the given types inside each listed holiday, once per holiday."""
    return interval_join(
        events.filter(F.col("event_type").isin(list(event_types))),
        holidays.filter(F.col("holiday").isin(list(names))).select("holiday", "start_date", "end_date"),
        bin_days=bin_days,
        inclusive_end_day=inclusive_end_day,
    )
