"""Exact interpolated quantiles per series by refining histograms, for series of any length."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from jobmetrics.session import materialise

# The first histogram is logarithmic, with this many bins to a factor of e; infinite values, and
# NaN above them, have bins beyond the largest finite one (710 * LOG_BINS).
LOG_BINS = 1 << 16
INFINITE = 1 << 26
# Each later one cuts a bin evenly between its least and its greatest value.
FINE_BINS = 1 << 20


def refined_quantiles(df: DataFrame, keys: list[str], columns: dict[str, tuple[float, ...]]) -> DataFrame:
    """One row per series with an array `q_<column>` per column; without values it holds NULLs.

    Every series is counted into bins, with the least and greatest value of each; the partial counts
    are made before the shuffle, and a series never has more bins than the histogram. An order
    statistic is known if its bin holds one distinct value, or if it is the first or last of its bin.
    Bins that hold others are cut again, together with the samples in them only, until all are known.
    """
    names, series = list(columns), [*keys, "_metric"]
    wanted = sorted({q for qs in columns.values() for q in qs})
    values = df.select(*keys, *names).unpivot(keys, names, "_metric", "_x")
    bins = _histogram(values, series, _log_bin(F.col("_x")))
    size = F.sum("_n").over(Window.partitionBy(*series))
    found = _within(bins, series).withColumn("_size", size)
    # Of both order statistics around each quantile; a series without values keeps one row.
    ranks = F.filter(_ranks(wanted, F.col("_size")), lambda r: _holds(r["rank"]))
    kept = F.when(F.col("_bin").isNull(), F.array(_rank(-1, F.lit(0)))).otherwise(ranks)
    found = found.withColumn("_r", F.explode(kept)).select(
        *series, "_size", F.col("_r.slot").alias("_slot"), (F.col("_r.rank") - F.col("_before")).alias("_rank"),
        "_n", "_low", "_high",
    )
    found = materialise(found.withColumn("_value", _known()), "quantiles")
    known, rest = [found], found.where(_is_open())
    while not rest.isEmpty():
        found = materialise(_refined(values, rest, series).withColumn("_value", _known()), "quantiles")
        known.append(found)
        rest = found.where(_is_open())
    done = reduce(DataFrame.unionByName, known).where(~_is_open())
    return done.groupBy(*keys).agg(*[_interpolated(n, columns[n], wanted) for n in names])


def _log_bin(x: Column) -> Column:
    """A bin that never falls as x grows; NULL for NULL."""
    size = F.least(F.floor(F.log1p(F.abs(x)) * F.lit(float(LOG_BINS))), F.lit(INFINITE).cast("bigint"))
    return F.when(F.isnan(x), F.lit(INFINITE + 1).cast("bigint")).otherwise(F.signum(x).cast("bigint") * size)


def _histogram(values: DataFrame, groups: list[str], bin_: Column) -> DataFrame:
    return values.groupBy(*groups, bin_.alias("_bin")).agg(
        F.count("_x").alias("_n"), F.min("_x").alias("_low"), F.max("_x").alias("_high")
    )


def _within(bins: DataFrame, groups: list[str]) -> DataFrame:
    """Add the number of values of the group in lower bins."""
    lower = Window.partitionBy(*groups).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    return bins.withColumn("_before", F.coalesce(F.sum("_n").over(lower), F.lit(0)))


def _rank(slot: int, rank: Column) -> Column:
    return F.struct(F.lit(slot).alias("slot"), rank.cast("bigint").alias("rank"))


def _ranks(wanted: list[float], size: Column) -> Column:
    at = [(size - 1) * F.lit(float(q)) for q in wanted]
    return F.array(*[_rank(2 * i + side, f(p)) for i, p in enumerate(at) for side, f in enumerate((F.floor, F.ceil))])


def _holds(rank: Column) -> Column:
    return (rank >= F.col("_before")) & (rank < F.col("_before") + F.col("_n"))


def _known() -> Column:
    first = (F.col("_low") == F.col("_high")) | (F.col("_rank") == 0)
    return F.when(first, F.col("_low")).when(F.col("_rank") == F.col("_n") - 1, F.col("_high"))


def _is_open() -> Column:
    return F.col("_value").isNull() & (F.col("_slot") >= 0)


def _refined(values: DataFrame, rest: DataFrame, series: list[str]) -> DataFrame:
    """The order statistics `rest` in the bins of their bins. Only samples between the bounds are read on."""
    rest = rest.select(*series, "_size", "_slot", "_rank", F.col("_low").alias("_from"), F.col("_high").alias("_to"))
    cells = rest.select(*series, "_from", "_to").distinct()
    same = [F.col(f"c.{k}").eqNullSafe(F.col(f"v.{k}")) for k in series]
    inside = F.col("_x").between(F.col("_from"), F.col("_to"))
    inner = values.alias("v").join(cells.alias("c"), reduce(Column.__and__, same) & inside)
    inner = inner.select(*[F.col(f"v.{k}") for k in series], "_x", "_from", "_to")
    fine = F.floor((F.col("_x") - F.col("_from")) / (F.col("_to") - F.col("_from")) * F.lit(float(FINE_BINS)))
    bins = _within(_histogram(inner, [*series, "_from", "_to"], fine), [*series, "_from", "_to"])
    cell = [*series, "_from", "_to"]
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"b.{k}")) for k in cell]
    met = rest.alias("r").join(bins.alias("b"), reduce(Column.__and__, same) & _holds(F.col("_rank")))
    return met.select(
        *[F.col(f"r.{k}") for k in series], "_size", "_slot", (F.col("_rank") - F.col("_before")).alias("_rank"),
        "_n", "_low", "_high",
    )


def _interpolated(name: str, quantiles: tuple[float, ...], wanted: list[float]) -> Column:
    mine = F.col("_metric") == name
    size = F.max(F.when(mine, F.col("_size")))

    def value(q: float) -> Column:
        slot = 2 * wanted.index(q)
        low, high = (F.max(F.when(mine & (F.col("_slot") == s), F.col("_value"))) for s in (slot, slot + 1))
        part = (size - 1) * F.lit(float(q))
        between = (F.ceil(part) - part) * low + (part - F.floor(part)) * high
        return F.when(low == high, low).otherwise(between)

    return F.array(*[value(q) for q in quantiles]).alias(f"q_{name}")
