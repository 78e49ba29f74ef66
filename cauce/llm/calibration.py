"""Isotonic calibration on a grid of scores: Spark counts the grid's cells, pooling runs on the bounded counts."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

CELLS = 1000


def counted(labelled: DataFrame, low: float, high: float) -> list[tuple[float, float, float]]:
    """(middle, rows, positives) of the CELLS grid cells between low and high that have rows; columns raw, label."""
    step = (high - low) / CELLS
    cell = F.least(F.greatest(F.floor((F.col("raw") - low) / step), F.lit(0)), F.lit(CELLS - 1))
    rows = labelled.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("yes")).collect()
    return [(low + (r["cell"] + 0.5) * step, float(r["n"]), float(r["yes"])) for r in sorted(rows)]


def isotonic(cells: list[tuple[float, float, float]]) -> tuple[np.ndarray, np.ndarray]:
    """Scores and chances between which to interpolate: the pooled cells' means, smoothed by one row of the mean rate.

    Without cells every chance is one half."""
    if not cells:
        return np.array([0.0]), np.array([0.5])
    rate = sum(c[2] for c in cells) / sum(c[1] for c in cells)
    pools: list[list[float]] = []  # weighted score sum, rows, positives
    for score, n, yes in cells:
        pools.append([score * n, n, yes])
        while len(pools) > 1 and pools[-2][2] * pools[-1][1] >= pools[-1][2] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    return np.array([s / n for s, n, _ in pools]), np.array([(yes + rate) / (n + 1) for _, n, yes in pools])


def chance(raw: np.ndarray, steps: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Calibrated chances; beyond the outer pools they close in on 0 and 1, so scores keep their order."""
    xs, ys = steps
    ys = np.maximum.accumulate(ys)
    inner = np.interp(raw, xs, ys)
    under, over = np.maximum(xs[0] - raw, 0), np.maximum(raw - xs[-1], 0)
    return np.clip(inner * np.exp(-under / 100) + (1 - inner) * (1 - np.exp(-over / 100)), 0.0, 1.0)
