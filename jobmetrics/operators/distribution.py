"""Empirical distributions and histograms over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from jobmetrics.operators.quantiles import refined_quantiles
from jobmetrics.operators.ranking import running_total
from jobmetrics.session import materialise


def value_counts(df: DataFrame, value: str, by: list[str] | None = None) -> DataFrame:
    """Distinct values with their `count`; NULL values are left out."""
    return df.where(F.col(value).isNotNull()).groupBy(*(by or []), value).agg(F.count(F.lit(1)).alias("count"))


def ecdf(df: DataFrame, value: str, by: list[str] | None = None, of_all: bool = False) -> DataFrame:
    """Empirical distribution per distinct value: `count`, `cdf` = share of rows up to the value,
    and `cdf_first` / `cdf_last` = zero-based rank of its first / last row over the row count.

    Rows without a value are not ranked; with `of_all` they count in the row count, as if they came last.
    """
    by = by or []
    if of_all:  # NULL is the last value while ranks are summed up
        counts = df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("count"))
        counts = counts.withColumn("_unknown", F.col(value).isNull())
        order = ["_unknown", value]
    else:
        counts, order = value_counts(df, value, by), [value]
    ranked = running_total(counts, F.col("count"), order, by, out="_end", total_out="_n").where(F.col(value).isNotNull())
    end, n = F.col("_end"), F.col("_n")
    return ranked.select(
        *by,
        value,
        "count",
        (end / n).alias("cdf"),
        ((end - F.col("count")) / n).alias("cdf_first"),
        ((end - 1) / n).alias("cdf_last"),
    )


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """`bins` equal-width bins over [min, max]; the last one is closed. Empty bins are kept.

    A value counts for the bin whose computed edges enclose it. A single distinct value gets a
    range of one around it. The table is reduced to its distinct values once; range and bins are
    both taken from those.
    """
    counts = materialise(value_counts(df, value), "value-counts")
    range_ = counts.agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    single = F.col("lo") == F.col("hi")
    edges = range_.select(
        F.when(single, F.col("lo") - 0.5).otherwise(F.col("lo")).cast("double").alias("lo"),
        F.when(single, F.col("hi") + 0.5).otherwise(F.col("hi")).cast("double").alias("hi"),
    ).select(F.struct("lo", ((F.col("hi") - F.col("lo")) / bins).alias("step")))
    placed = counts.withColumn("_e", edges.scalar())
    lo, step, x = F.col("_e.lo"), F.col("_e.step"), F.col(value)
    guess = F.floor((x - lo) / step)
    shifted = (
        guess
        - F.when(x < lo + guess * step, 1).otherwise(0)
        + F.when(x >= lo + (guess + 1) * step, 1).otherwise(0)
    )
    bin_ = F.least(shifted, F.lit(bins - 1)).cast("int")
    filled = placed.groupBy(bin_.alias("bin")).agg(F.sum("count").alias("count"))
    spark = df.sparkSession
    every = spark.range(bins).select(F.col("id").cast("int").alias("bin"), edges.scalar().alias("_e"))
    return (
        every.where(F.col("_e.lo").isNotNull())
        .join(filled, "bin", "left")
        .select(
            "bin",
            (F.col("_e.lo") + F.col("bin") * F.col("_e.step")).alias("lower"),
            (F.col("_e.lo") + (F.col("bin") + 1) * F.col("_e.step")).alias("upper"),
            F.coalesce("count", F.lit(0)).alias("count"),
        )
    )


def log_histogram_density(df: DataFrame, value: str, by: str, edges: int, floor: float) -> DataFrame:
    """Density per group over `edges` log-spaced edges shared by all groups, from `floor` to the
    largest value plus one. Values below `floor` are outside; density integrates to 1 per group."""
    counts = materialise(value_counts(df, value, [by]), "value-counts")
    top = counts.agg(F.max(value)).scalar()
    lo = F.log10(F.lit(float(floor)))
    bins = edges - 1
    placed = (
        counts.where(F.col(value) >= floor)
        .withColumn("_step", (F.log10(top + 1) - lo) / bins)
        .withColumn("bin", F.least(F.floor((F.log10(value) - lo) / F.col("_step")), F.lit(bins - 1)).cast("int"))
    )
    filled = placed.groupBy(by, "bin").agg(F.sum("count").alias("count"), F.max("_step").alias("_step"))
    # Every group has all bins, also the empty ones.
    sizes = filled.groupBy(by).agg(F.sum("count").alias("_n"), F.max("_step").alias("_step"))
    every = sizes.select(by, "_n", "_step", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    filled = every.join(filled.select(by, "bin", "count"), [by, "bin"], "left").fillna(0, ["count"])
    lower = F.pow(F.lit(10.0), lo + F.col("bin") * F.col("_step"))
    upper = F.pow(F.lit(10.0), lo + (F.col("bin") + 1) * F.col("_step"))
    return filled.select(
        by,
        "bin",
        lower.alias("lower"),
        upper.alias("upper"),
        "count",
        (F.col("count") / (F.col("_n") * (upper - lower))).alias("density"),
    )


def table_quantiles(df: DataFrame, value: str, quantiles: dict[str, float], by: list[str] | None = None) -> DataFrame:
    """Exact interpolated quantiles of a whole column."""
    by = by or []
    samples = df.select(*by, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    result = refined_quantiles(samples, by, {"_v": tuple(quantiles.values())})
    return result.select(*by, *[F.get("q__v", F.lit(i)).alias(n) for i, n in enumerate(quantiles)])
