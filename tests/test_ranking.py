import numpy as np
from pyspark.sql import functions as F

from jobmetrics.operators import distribution
from jobmetrics.operators.distribution import ecdf
from jobmetrics.operators.ranking import batch_numbers, running_total


def test_running_total_without_a_single_task(spark):
    rows = [(g, i, i % 7 + 1) for g, n in (("hot", 500), ("b", 3), (None, 40)) for i in range(n)]
    df = spark.createDataFrame(rows, "g string, x int, w int")
    expected = {}
    for g in ("hot", "b", None):
        weights = [w for gg, _, w in rows if gg == g]
        for i, total in enumerate(np.cumsum(weights)):
            expected[(g, i)] = (int(total), sum(weights))
    out = running_total(df, F.col("w"), ["x"], ["g"]).collect()
    assert {(r.g, r.x): (r.running, r.total) for r in out} == expected
    assert set(out[0].asDict()) == {"g", "x", "w", "running", "total"}


def test_running_total_over_the_whole_table(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x"))
    out = running_total(df, F.lit(1), ["x"])
    assert out.where("running <> x + 1 OR total <> 1000").count() == 0


def test_batches_follow_the_order(spark):
    rows = [(i, None if i % 50 == 0 else float(1000 - i)) for i in range(410)]
    df = spark.createDataFrame(rows, "job_id bigint, t double")
    out = {r.job_id: r.batch for r in batch_numbers(df, [F.col("t").isNull(), "t"], "job_id", 100).collect()}
    order = sorted(rows, key=lambda r: (r[1] is None, r[1] or 0, r[0]))
    assert out == {job: k // 100 for k, (job, _) in enumerate(order)}
    assert max(out.values()) + 1 == 5


def test_ecdf_and_quantiles(spark):
    values = [1.0, 1.0, 2.0, 5.0, 5.0, 5.0, None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    rows = {r.x: r for r in distribution.ecdf(df, "x").collect()}
    assert {x: (r["count"], r.cdf, r.cdf_first, r.cdf_last) for x, r in rows.items()} == {
        1.0: (2, 2 / 6, 0.0, 1 / 6),
        2.0: (1, 0.5, 2 / 6, 2 / 6),
        5.0: (3, 1.0, 0.5, 5 / 6),
    }
    q = distribution.table_quantiles(df, "x", {"m": 0.5, "p90": 0.9}).first()
    assert np.allclose([q.m, q.p90], np.quantile(values[:-1], [0.5, 0.9]))


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(3)
    for values in ([3.0] * 4, list(map(float, rng.integers(1, 8, 200))), list(rng.normal(size=300))):
        df = spark.createDataFrame([(float(v),) for v in values], "x double")
        rows = sorted(distribution.histogram(df, "x", 50).collect(), key=lambda r: r.bin)
        counts, edges = np.histogram(values, bins=50)
        assert [r["count"] for r in rows] == list(counts)
        assert np.allclose([r.lower for r in rows] + [rows[-1].upper], edges)


def test_empty_histogram(spark):
    assert distribution.histogram(spark.createDataFrame([], "x double"), "x", 5).count() == 0


def test_log_histogram_matches_numpy(spark):
    rng = np.random.default_rng(4)
    data = {t: np.exp(rng.normal(size=200)) for t in (True, False)}
    df = spark.createDataFrame([(t, float(x)) for t, xs in data.items() for x in xs], "t boolean, x double")
    edges = np.logspace(np.log10(1e-3), np.log10(max(x.max() for x in data.values()) + 1), 60)
    rows = distribution.log_histogram_density(df, "x", "t", 60, 1e-3).collect()
    for t, xs in data.items():
        density, _ = np.histogram(xs, bins=edges, density=True)
        got = np.zeros(59)
        for r in rows:
            if r.t == t:
                got[r.bin] = r.density
        assert np.allclose(got, density)


def test_ecdf_of_all_rows_counts_those_without_a_value(spark):
    rows = spark.createDataFrame([(1.0,), (None,), (2.0,), (2.0,), (None,)], "v double")
    got = sorted(map(tuple, ecdf(rows, "v", of_all=True).select("v", "count", "cdf_first", "cdf_last").collect()))
    assert got == [(1.0, 1, 0.0, 0.0), (2.0, 2, 0.2, 0.4)]
    assert {r.cdf for r in ecdf(rows, "v").collect()} == {1 / 3, 1.0}
