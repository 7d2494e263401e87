"""Exact ratios and category levels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """Exact decimal quotient of two counts.

    A zero divisor is an error in every session; wrap it in ``nullif`` for a null instead.
    """
    quotient = numerator.cast("decimal(20,0)") / denominator.cast("decimal(20,0)")
    return F.when(denominator == 0, F.raise_error(F.lit("division by zero")).cast("decimal(38,18)")).otherwise(quotient)


def top_category(category_code: Column) -> Column:
    """First level of a dotted category code; the whole code when it has no dot."""
    return F.split_part(category_code, F.lit("."), F.lit(1))
