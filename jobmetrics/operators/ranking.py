"""Exact running totals over an ordering, without putting one group into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from jobmetrics.session import materialise


def running_total(
    df: DataFrame,
    weight: Column,
    order: list[str],
    by: list[str] | None = None,
    out: str = "running",
    total_out: str = "total",
) -> DataFrame:
    """Add the running sum of `weight` along `order` within `by`, and the sum over all of `by`.

    `by + order` must identify rows. Rows are range-partitioned on `by + order`, which splits a
    large group over many partitions, each partition sums its own piece, and every piece is
    shifted by the total of the pieces before it.
    """
    by = by or []
    rows = df.withColumn("_weight", weight)
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The piece number is stored, so both reads below see the same split.
    pieces = materialise(
        rows.repartitionByRange(parts, *by, *order).withColumn("_piece", F.spark_partition_id()),
        "pieces",
    )
    # At most one row per piece and group in it: for one large group, as many as there are pieces.
    ordered = Window.partitionBy(*by).orderBy("_piece")
    before = F.sum("_sum").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    whole = F.sum("_sum").over(ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    shifts = (
        pieces.groupBy(*by, "_piece")
        .agg(F.sum("_weight").alias("_sum"))
        .select(*by, "_piece", F.coalesce(before, F.lit(0)).alias("_shift"), whole.alias(total_out))
    )
    within = Window.partitionBy(*by, "_piece").orderBy(*order)
    joined = _null_safe_join(pieces, shifts, [*by, "_piece"])
    local = F.sum("_weight").over(within.rowsBetween(Window.unboundedPreceding, 0))
    return joined.select(*rows.columns, (local + F.col("_shift")).alias(out), total_out).drop("_weight")


def _null_safe_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    condition = None
    for key in keys:
        match = F.col(key).eqNullSafe(F.col(f"_r_{key}"))
        condition = match if condition is None else condition & match
    return left.join(renamed, condition, "inner").drop(*[f"_r_{k}" for k in keys])


def batch_numbers(df: DataFrame, order: list[Column | str], id_col: str, size: int) -> DataFrame:
    """Number rows along `order` in batches of `size`, counted from 0; `id_col` breaks ties."""
    named = [F.col(c) if isinstance(c, str) else c for c in order]
    keyed = df.select("*", *[c.alias(f"_o{i}") for i, c in enumerate(named)])
    keys = [f"_o{i}" for i in range(len(named))] + [id_col]
    ranked = running_total(keyed, F.lit(1), keys, out="_rank")
    batch = F.floor((F.col("_rank") - 1) / F.lit(size)).cast("bigint")
    return ranked.withColumn("batch", batch).drop("_rank", "total", *[k for k in keys if k != id_col])
