"""Numeric conventions: missing is NULL, never NaN, and no division fails."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def divide(a: Column, b: Column) -> Column:
    """``a / b`` as double; NULL when ``b`` is zero."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def three_digits(x: Column) -> Column:
    """Half-up to three digits. Rounding to nine first makes ties of means that sums in another
    order put next to one."""
    return F.round(F.round(x, 9), 3)


def correlation(x: Column, y: Column) -> Column:
    """Pearson correlation aggregate; NULL for a constant column, where ``corr`` raises."""
    spread = F.stddev_pop(x) * F.stddev_pop(y)
    return F.try_divide(F.covar_pop(x, y), F.nullif(spread, F.lit(0.0)))


def effect_columns(value: Column, band: Column) -> list[Column]:
    """Aggregates comparing ``value`` inside and outside ``band``.

    ``mean_improvement`` is the difference of the means; ``effect_size`` divides it by the
    root of the averaged sample variances, and is 0 when those are 0. Rows whose ``band``
    is unknown count as outside.
    """
    inside = F.coalesce(band, F.lit(False))
    within = F.when(inside, value.cast("double"))
    beyond = F.when(~inside, value.cast("double"))
    gap = F.avg(within) - F.avg(beyond)
    pooled = F.sqrt((F.var_samp(within) + F.var_samp(beyond)) / 2)
    size = F.when(pooled == 0, F.lit(0.0)).otherwise(F.try_divide(gap, pooled))
    return [gap.alias("mean_improvement"), size.alias("effect_size")]
