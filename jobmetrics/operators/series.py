"""Two-level statistics: describe each series on its own, then average over the series."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from jobmetrics.functions.statistics import DISTRIBUTION, distribution, share_above
from jobmetrics.operators.quantiles import refined_quantiles

QUARTILES = (0.25, 0.75, 0.95)


@dataclass(frozen=True)
class Metric:
    """What to compute for one sample column; output columns start with `prefix`."""

    column: str
    prefix: str
    stats: tuple[str, ...] = DISTRIBUTION
    quantiles: tuple[float, ...] = ()
    above: dict[str, float] = field(default_factory=dict)  # output column -> threshold

    def quantile_names(self) -> list[str]:
        return [f"{self.prefix}_p{round(q * 100)}" for q in self.quantiles]

    def outputs(self) -> list[str]:
        return [f"{self.prefix}_{s}" for s in self.stats] + self.quantile_names() + list(self.above)


def series_stats(
    df: DataFrame,
    keys: list[str],
    metrics: Iterable[Metric],
    extra: Iterable[Column] = (),
) -> DataFrame:
    """One row per series (`keys`) with the statistics of every metric and the `extra` aggregates.

    Samples are brought together by node, the first two keys, and then described by one hash
    aggregation on numbers. Partials of so many statistics are larger than the samples of a short
    series, and a task would hold one for every series it meets. Quantiles are refined from
    histograms of just their columns. Series with a NULL key get none.
    """
    metrics = list(metrics)
    df = by_node(df, keys)
    aggregates = list(extra)
    for m in metrics:
        x = F.col(m.column)
        described = distribution(x)
        aggregates += [described[s].alias(f"{m.prefix}_{s}") for s in m.stats]
        aggregates += [share_above(x, t).alias(name) for name, t in m.above.items()]

    with_quantiles = [m for m in metrics if m.quantiles]
    quantiles = _series_quantiles(df, keys, with_quantiles) if with_quantiles else None
    if not aggregates:
        return quantiles
    stats = df.groupBy(*keys).agg(*aggregates)
    return stats if quantiles is None else stats.join(quantiles, keys, "left")


def by_node(samples: DataFrame, keys: list[str]) -> DataFrame:
    """The samples dealt out by job and node, the first two of `keys`: what a task holds and what is
    shuffled follow from the number of samples, and the nodes of one large job are in many tasks."""
    return samples.repartition(*keys[:2])


def _series_quantiles(df: DataFrame, keys: list[str], metrics: list[Metric]) -> DataFrame:
    present = F.lit(True)
    for key in keys:
        present = present & F.col(key).isNotNull()
    samples = df.where(present).select(*keys, *dict.fromkeys(m.column for m in metrics))
    quantiles = refined_quantiles(samples, keys, {m.column: m.quantiles for m in metrics})
    named = [
        F.get(F.col(f"q_{m.column}"), F.lit(i)).alias(name)
        for m in metrics
        for i, name in enumerate(m.quantile_names())
    ]
    return quantiles.select(*keys, *named)


def series_averages(names: Iterable[str], active: Column | None = None) -> list[Column]:
    """Aggregates that average per-series statistics, over the `active` series if given."""
    return [F.avg(F.col(n) if active is None else F.when(active, F.col(n))).alias(n) for n in names]


def average_over_series(
    stats: DataFrame, keys: list[str], names: Iterable[str], active: Column | None = None
) -> DataFrame:
    """One row per `keys` with the statistics `names` averaged over its (active) series."""
    return stats.groupBy(*keys).agg(*series_averages(names, active))
