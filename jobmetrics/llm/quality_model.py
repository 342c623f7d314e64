"""Quality scores: random Fourier features of document statistics, ridge regression, isotonic calibration.

Every text becomes a few statistics. A fixed random map turns the standardised statistics into
features whose inner products approximate a Gaussian kernel; ridge weights solve the normal
equations, which each task sums over its labelled rows and Spark sums over tasks, so any number of
labels can be used. Isotonic regression over a fixed grid of raw scores, on labelled rows that the
weights have not seen, makes scores probabilities.

Null and empty texts have zero statistics and are scored like others, as are repeated rows and
rows without id. Without labels every score is 0.5. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from jobmetrics.llm.common import WORD, label_split, map_batches, one_label, small_batches, texts_of
from jobmetrics.session import materialise

STATISTICS = 14
FEATURES = 128
KERNEL_WIDTH = 3.0
RIDGE = 1.0
SEED = 20240229
GRID = np.linspace(-0.5, 1.5, 401)
_SYMBOL = re.compile(r"[#*$%&|<>~^=_{}\[\]\\]")
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_DIGITS = re.compile(r"[0-9]")
_STOP = re.compile(r"[.,;:]")


def statistics(text: str) -> list[float]:
    words = WORD.findall(text)
    if not words:
        return [0.0] * STATISTICS
    n, chars = len(words), sum(map(len, words))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = list(zip(words, words[1:], words[2:]))
    counts = [len(p.findall(text)) / chars for p in (_SYMBOL, _UPPER, _DIGITS, _STOP)]
    return [
        np.log1p(n),
        chars / n,
        *[float(np.sqrt(c)) for c in counts],
        float(np.sqrt(text.count("!") / chars)),
        float(np.sqrt(text.count("|") / chars)),
        len(set(words)) / n,
        len(set(windows)) / len(windows) if windows else 1.0,
        len(set(lines)) / len(lines),
        np.log1p(n / len(lines)),
        sum(len(w) == 1 for w in words) / n,
        sum(w.isupper() and len(w) > 1 for w in words) / n,
    ]


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and stats (array) of every row."""
    kind = dict(docs.dtypes)["doc_id"]

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        stats = pa.array([[float(v) for v in statistics(t)] for t in texts_of(batch)], pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), stats], names=["doc_id", "stats"])

    return map_batches(docs.select("doc_id", "text"), lambda: step, f"doc_id {kind}, stats array<double>")


class FourierMap:
    """Cosine features of standardised statistics, beside the statistics themselves and a constant."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray):
        random = np.random.default_rng(SEED)
        self.mean, self.spread = mean, spread
        self.directions = random.normal(size=(STATISTICS, FEATURES)) / KERNEL_WIDTH
        self.phases = random.uniform(0, 2 * np.pi, FEATURES)

    def __call__(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.spread, -6, 6)
        waves = np.sqrt(2 / FEATURES) * np.cos(x @ self.directions + self.phases)
        return np.hstack([waves, x / 6, np.ones((len(x), 1))])


def _stats_matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("stats").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, STATISTICS)


def fit_ridge(rows: DataFrame, features: FourierMap) -> np.ndarray | None:
    """Weights for `label` from `stats`; each task sums its part of the normal equations."""
    small_batches(rows.sparkSession)
    width = FEATURES + STATISTICS + 1

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((width, width + 1)), False
        for batch in batches:
            if batch.num_rows:
                z = features(_stats_matrix(batch))
                y = batch.column("label").to_numpy(zero_copy_only=False).astype(float)
                total += z.T @ np.hstack([z, y[:, None]])
                seen = True
        if seen:
            cells = np.arange(total.size)
            yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int32()), pa.array(total.ravel())], names=["cell", "v"])

    cells = rows.select("stats", "label").mapInArrow(sums, "cell int, v double").groupBy("cell").agg(F.sum("v").alias("v"))
    found = cells.collect()  # as many rows as the equations have cells, whatever the input
    if not found:
        return None
    total = np.zeros(width * (width + 1))
    for cell, v in found:
        total[cell] = v
    total = total.reshape(width, width + 1)
    return np.linalg.solve(total[:, :width] + RIDGE * np.eye(width), total[:, width])


def isotonic(weights: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Non-decreasing fit of sums / weights by pooling adjacent violators; empty cells are bridged."""
    blocks: list[list[float]] = []  # weight, sum, cells
    where = np.flatnonzero(weights)
    for k in where:
        blocks.append([weights[k], sums[k], 1])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            w, s, n = blocks.pop()
            blocks[-1] = [blocks[-1][0] + w, blocks[-1][1] + s, blocks[-1][2] + n]
    values = np.concatenate([np.full(int(n), s / w) for w, s, n in blocks])
    return np.interp(np.arange(len(weights)), where, values)


def calibrate(rows: DataFrame, features: FourierMap, weights: np.ndarray) -> np.ndarray | None:
    """Calibrated score at each point of the grid."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw = features(_stats_matrix(batch)) @ weights
        cell = np.clip(np.searchsorted(GRID, raw), 0, len(GRID) - 1)
        return pa.RecordBatch.from_arrays(
            [pa.array(cell, pa.int32()), batch.column("label").cast(pa.float64())], names=["cell", "y"]
        )

    counted = map_batches(rows.select("stats", "label"), lambda: step, "cell int, y double").groupBy("cell")
    found = counted.agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("y")).collect()  # one row per grid cell
    if not found:
        return None
    n, y = np.zeros(len(GRID)), np.zeros(len(GRID))
    for cell, count, total in found:
        n[cell], y[cell] = count, total
    return np.clip(isotonic(n, y), 0, 1)


def score_quality(docs: DataFrame, labels: DataFrame, modulus: int = 4, held_out: int = 2, calibration: int = 3) -> DataFrame:
    """doc_id, held_out, score and predicted of every document.

    The weights use the labelled rows whose id hash modulo `modulus` is neither `held_out` nor
    `calibration`; the calibration uses those of the latter.
    """
    stats = materialise(document_statistics(docs), "statistics")
    moments = stats.select(*[F.get("stats", F.lit(k)).alias(f"s{k}") for k in range(STATISTICS)]).agg(
        *[F.avg(f"s{k}").alias(f"m{k}") for k in range(STATISTICS)],
        *[F.stddev_pop(f"s{k}").alias(f"d{k}") for k in range(STATISTICS)],
    ).first()
    mean = np.array([moments[f"m{k}"] or 0.0 for k in range(STATISTICS)])
    spread = np.array([moments[f"d{k}"] or 0.0 for k in range(STATISTICS)])
    features = FourierMap(mean, np.where(spread > 1e-9, spread, 1.0))
    # Statistics are narrow, so labels join them rather than the texts.
    known = stats.join(one_label(labels, "quality"), "doc_id").withColumn("_part", label_split("doc_id", modulus))
    weights = fit_ridge(known.where(~F.col("_part").isin(held_out, calibration)), features)
    curve = None if weights is None else calibrate(known.where(F.col("_part") == calibration), features, weights)
    kind = dict(docs.dtypes)["doc_id"]

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        if weights is None:
            scores = np.full(batch.num_rows, 0.5)
        else:
            raw = features(_stats_matrix(batch)) @ weights
            scores = np.clip(raw, 0, 1) if curve is None else np.interp(raw, GRID, curve)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    scored = map_batches(stats, lambda: step, f"doc_id {kind}, score double")
    return scored.select(
        "doc_id",
        F.coalesce(label_split("doc_id", modulus) == held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )
