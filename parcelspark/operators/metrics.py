"""Counts, sums and ratios side by side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def count_where(condition: Column, counted: Column | None = None) -> Column:
    """Non-NULL values (or rows) for which the condition holds; 0 when there are none."""
    return F.count(F.when(condition, F.lit(1) if counted is None else counted))


def sum_where(condition: Column, summed: Column) -> Column:
    """Sum over the rows for which the condition holds; NULL when there are none."""
    return F.sum(F.when(condition, summed))


def pivot_counts(
    df: DataFrame, group: Sequence[str], conditions: Mapping[str, Column], counted: Column | None = None
) -> DataFrame:
    return df.groupBy(*group).agg(*[count_where(c, counted).alias(n) for n, c in conditions.items()])


def pivot_sums(df: DataFrame, group: Sequence[str], summed: Column, conditions: Mapping[str, Column]) -> DataFrame:
    return df.groupBy(*group).agg(*[sum_where(c, summed).alias(n) for n, c in conditions.items()])


def ratio(numerator: Column, denominator: Column) -> Column:
    """DOUBLE division with 0/0 = NaN, also under ANSI."""
    num, den = numerator.cast("double"), denominator.cast("double")
    by_zero = F.when(num == 0, float("nan")).otherwise(F.signum(num) * float("inf"))
    return F.when(den == 0, by_zero).otherwise(num / den)


def mean_interval(took: Column) -> Column:
    """Average of a day-time interval, to the nearest microsecond; NULL when there are none. Seconds are summed as
    decimals: `avg` sums microseconds in 64 bits, which some hundred million days exceed."""
    seconds = took.cast("interval second").cast("decimal(19,6)")
    mean = (F.sum(seconds) / F.nullif(F.count(seconds), F.lit(0))).cast("decimal(19,6)")
    return mean.cast("interval second").cast("interval day to second")
