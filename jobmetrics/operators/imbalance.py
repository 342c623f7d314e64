"""Temporal and spatial resource imbalance of a job from per-node signals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from jobmetrics.functions.statistics import clipped_ratio


def node_signal(df: DataFrame, keys: list[str], time: str, columns: list[str]) -> DataFrame:
    """One value per node and instant: the mean over the devices of the node.

    All instants of a node are in one task, so that nothing else is shuffled to describe the node.
    """
    return df.repartition(*keys).groupBy(*keys, time).agg(*[F.avg(c).alias(c) for c in columns])


def imbalance(
    signal: DataFrame,
    job: str,
    node: str,
    metrics: dict[str, str],
    decimals: int | None = 4,
) -> DataFrame:
    """`ri_temporal_<label>` and `ri_spatial_<label>` per job for every label -> column.

    Peak, sum and count of each node are all that the definitions need:
    temporal is the worst node's 1 - sum / (peak * count); spatial is the mean shortfall of the
    node peaks below the highest peak, relative to it. Nodes without samples peak at 0.
    """
    per_node = signal.groupBy(job, node).agg(*node_parts(metrics))
    return per_node.groupBy(job).agg(*imbalance_of_nodes(metrics, decimals))


def node_parts(metrics: dict[str, str]) -> list[Column]:
    """Aggregates of a node's samples that `imbalance_of_nodes` is computed from."""
    return [
        agg
        for label, column in metrics.items()
        for agg in (
            F.max(column).alias(f"peak_{label}"),
            F.sum(column).alias(f"sum_{label}"),
            F.count(column).alias(f"n_{label}"),
        )
    ]


def imbalance_of_nodes(metrics: dict[str, str], decimals: int | None, counted: Column | None = None) -> list[Column]:
    """Aggregates of one job's rows of `node_parts`; only `counted` rows are nodes, NULL without any."""
    counted = F.lit(True) if counted is None else counted
    nodes = F.count_if(counted)
    results = []
    for label in metrics:
        peak, total, n = F.col(f"peak_{label}"), F.col(f"sum_{label}"), F.col(f"n_{label}")
        idle_share = F.when(counted & (peak != 0), 1 - total / F.nullif(peak * n, F.lit(0.0)))
        worst = F.max(F.greatest(F.coalesce(idle_share, F.lit(0.0)), F.lit(0.0)))
        filled = F.when(counted, F.coalesce(peak, F.lit(0.0)))
        highest = F.max(filled)
        shortfall = (highest * nodes - F.sum(filled)) / F.nullif(highest * nodes, F.lit(0.0))
        spatial = F.when((nodes <= 1) | (highest == 0), F.lit(0.0)).otherwise(shortfall)
        for kind, value in (("temporal", worst), ("spatial", spatial)):
            results.append(F.when(nodes > 0, clipped_ratio(value, decimals)).alias(f"ri_{kind}_{label}"))
    return results
