"""One-dimensional k-means by iteration from many starts, to check the exact segmentation by.

A solver of another kind than :mod:`tidewatch.operators.segments`: for each number
of clusters, centres are drawn at random (far ones likelier), values go to the
nearest centre and centres to their mean until nothing moves, and the best of all
starts counts.  It runs in Arrow-batched Python workers, a series at a time, and is
many times slower; production runs use the exact one.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.config import DetectorConfig
from tidewatch.operators.segments import gather

STARTS, SEED, ROUNDS = 40, 42, 100


def settle(values: np.ndarray, centres: np.ndarray) -> tuple[float, np.ndarray]:
    """Moves ``centres`` (rising) until nothing changes; the cost, and where each cluster ends in the sorted ``values``."""
    ends = np.zeros(0)
    for _ in range(ROUNDS):
        now = np.append(np.searchsorted(values, (centres[1:] + centres[:-1]) / 2, "right"), values.size)
        if np.array_equal(now, ends):
            break
        ends = now
        begins = np.append(0, ends[:-1])
        centres = np.sort([values[a:b].mean() if b > a else c for a, b, c in zip(begins, ends, centres, strict=True)])
    parts = np.split(values, ends[:-1].astype(int))
    return sum(float(((p - p.mean()) ** 2).sum()) for p in parts if p.size), ends.astype(int)


def best_of(values: np.ndarray, k: int, starts: int = STARTS, seed: int = SEED) -> tuple[float, np.ndarray]:
    """The cheapest division of sorted ``values`` into ``k`` clusters among all starts."""
    rng, found = np.random.default_rng(seed), []
    for _ in range(starts if k > 1 else 1):
        centres = [rng.choice(values)]
        while len(centres) < k:
            away = np.min((values[:, None] - np.array(centres)) ** 2, axis=1)
            centres.append(rng.choice(values, p=away / away.sum()) if away.sum() > 0 else rng.choice(values))
        found.append(settle(values, np.sort(centres)))
    return min(found, key=lambda x: x[0])


def farthest_from_chord(costs: list[float]) -> int:
    """The number of clusters at the bend of the curve of costs."""
    y = np.array(costs)
    y = (y - y.min()) / (np.ptp(y) or 1.0)
    line = np.linspace(y[0], y[-1], y.size)
    return int(np.argmax(np.round(np.abs(line - y), 12))) + 1


def segment(rows: DataFrame, config: DetectorConfig) -> DataFrame:
    """As :func:`tidewatch.operators.segments.segment`: one row per series and window with k and segs."""
    return solve(gather(rows, config), config)


def solve(groups: DataFrame, config: DetectorConfig) -> DataFrame:
    limit = config.k_max

    @F.pandas_udf("inertias array<double>, k int, segs array<struct<rank:int,a:int,n:int,lo:double,hi:double,center:double>>")
    def found(series: pd.Series) -> pd.DataFrame:
        out = []
        for s in series:
            s = np.asarray(s, np.float64)
            most = min(limit, s.size - 1, np.unique(s).size)
            if most < 2:
                out.append(([], 1, None))
                continue
            tried = [best_of(s, k) for k in range(1, most + 1)]
            k = farthest_from_chord([c for c, _ in tried])
            ends = tried[k - 1][1]
            begins = np.append(0, ends[:-1])
            segs = [{"rank": r, "a": int(a), "n": int(b - a), "lo": float(s[a]), "hi": float(s[b - 1]), "center": float(s[a:b].mean())} for r, (a, b) in enumerate(zip(begins, ends, strict=True))]
            out.append(([c for c, _ in tried], k, segs if k > 1 else None))
        return pd.DataFrame(out, columns=["inertias", "k", "segs"])

    return groups.withColumn("_found", found("s")).select("*", "_found.*").drop("_found")
