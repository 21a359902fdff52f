"""Scalar helpers shared by all indicator levels."""

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_THIRDS = 2.0 / 3.0


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives NULL, not an error, for a zero denominator."""
    return F.try_divide(numerator, denominator)


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def weighted_mean(value: Column, weight: Column) -> Column:
    """Mean weighted over all rows: the weight of a row without a value still counts."""
    return ratio(F.sum(weight * value), F.sum(weight))
