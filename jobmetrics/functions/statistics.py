"""Aggregate expressions for one metric of one series. NULL samples are ignored."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

DISTRIBUTION = ("mean", "max", "min", "std", "skew", "kurtosis", "iof")


def _if_spread(x: Column, moment: Column) -> Column:
    # A constant series has no shape; rounding noise of the central moments must not invent one.
    return F.when(F.max(x) > F.min(x), moment)


def fluctuation_index(x: Column) -> Column:
    """Sample variance over mean: 0 when the mean is 0, NULL without samples."""
    mean, spread = F.avg(x), F.stddev_samp(x)
    return F.when(mean == 0, F.lit(0.0)).otherwise(spread * spread / F.nullif(mean, F.lit(0.0)))


def distribution(x: Column) -> dict[str, Column]:
    """The seven distribution statistics: sample spread, population skewness and excess kurtosis."""
    return {
        "mean": F.avg(x),
        "max": F.max(x),
        "min": F.min(x),
        "std": F.stddev_samp(x),
        "skew": _if_spread(x, F.skewness(x)),
        "kurtosis": _if_spread(x, F.kurtosis(x)),
        "iof": fluctuation_index(x),
    }


def share_above(x: Column, threshold: float) -> Column:
    """Share of the samples strictly above `threshold`."""
    return F.count_if(x > F.lit(float(threshold))) / F.nullif(F.count(x), F.lit(0))


def clipped_ratio(x: Column, decimals: int | None) -> Column:
    clipped = F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))
    return clipped if decimals is None else F.round(clipped, decimals)
