"""The whole decision as one callable per series, run as a grouped map.

:func:`decide_series` takes the months of one series and window and needs no Spark;
:func:`decide` runs it over all series with ``groupBy(series).applyInArrow``, all
windows of a series in one call.  Results are those of
:mod:`tidewatch.operators.segments` and :mod:`tidewatch.operators.decide`, which
stay the production path (expressions on one row per series); this one is for use
outside of Spark, for long series and to check the other by.

The segmentation uses that an optimal last cut never moves back as values are
added: the cut for the middle value bounds those to its left and right, so a layer
of n values takes about n log n steps instead of n squared.

A series whose segmentation fails does not end the run: it gets the fence rule and
the method ``IQR_MAD_ERROR``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidewatch.config import DetectorConfig
from tidewatch.functions.scalar import MAD_SCALE
from tidewatch.operators import fences
from tidewatch.operators.segments import POINT

#: What a decision says of each month beyond its series, window and :data:`POINT`.
RESULT = (
    "metodo string, k_elegido int, cluster_id int, cluster_rank int, cluster_center double, cluster_n int, n_meses int, q1 double, mediana double, q3 double, iqr double, "
    "p25_log double, p50_log double, p75_log double, frontera_inf_cluster double, frontera_sup_cluster double, frontera_inf_log double, frontera_sup_log double, "
    "limite_inf double, limite_sup double, limite_inf_iqr double, limite_sup_iqr double, dif_inf_p25_log double, dif_sup_p75_log double, "
    "pctl_valida_inf boolean, pctl_valida_sup boolean, mad double, mod_zscore double, es_outlier boolean, tipo string"
)
_ARROW = {"string": pa.string(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_()}
NAMES = tuple(x.split()[0] for x in RESULT.split(", "))


class Costs:
    """Costs of runs of sorted values: squared deviations from their mean, from two running sums."""

    def __init__(self, s: np.ndarray):
        self.p, self.q = (np.append(0.0, np.cumsum(x)) for x in (s, s * s))

    def __call__(self, a: np.ndarray | int, b: np.ndarray | int) -> np.ndarray:
        total = self.p[b] - self.p[a]
        return np.maximum(0.0, self.q[b] - self.q[a] - total * total / (b - a))


def layer(before: np.ndarray, costs: Costs, k: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Least costs of ``k`` clusters for the first i values, and where the last cluster begins, from those of k - 1."""
    best, cut = np.full(n + 1, np.inf), np.zeros(n + 1, np.int64)
    todo = [(k, n, k - 1, n - 1)]
    while todo:
        low, high, first, last = todo.pop()
        if low > high:
            continue
        i = (low + high) // 2
        j = np.arange(max(first, k - 1), min(last, i - 1) + 1)
        c = before[j] + costs(j, i)
        at = int(c.argmin())
        best[i], cut[i] = c[at], j[at]
        todo += ((low, i - 1, first, int(j[at])), (i + 1, high, int(j[at]), last))
    return best, cut


def segment(s: np.ndarray, k_max: int) -> tuple[list[float], list[int]]:
    """Optimal costs of 1, 2 and more clusters of sorted values, and the edges of the clusters at the bend of that curve."""
    n = s.size
    most = min(k_max, n - 1, np.unique(s).size)
    if most < 2:
        return [], [0, n]
    costs, cuts = Costs(s), []
    best = np.append(np.inf, costs(0, np.arange(1, n + 1)))
    curve = [float(best[n])]
    for k in range(2, most + 1):
        best, cut = layer(best, costs, k, n)
        curve.append(float(best[n]))
        cuts.append(cut)
    y = np.array(curve)
    spread = y.max() - y.min()
    y = (y - y.min()) / (spread if spread > 0 else 1.0)
    gaps = np.abs((y[-1] - y[0]) * np.arange(most) / (most - 1) - y + y[0])
    k = int(gaps.argmax()) + 1
    edges = [n]
    for m in range(k, 1, -1):
        edges.append(int(cuts[m - 2][edges[-1]]))
    return curve, [0, *edges[::-1]]


def quantile(s: np.ndarray, share: float) -> float:
    """Interpolated quantile of sorted values."""
    at = (s.size - 1) * share
    low = int(np.floor(at))
    return float(s[low] + (s[int(np.ceil(at))] - s[low]) * (at - low))


def _tail(main: tuple, other: tuple, s: np.ndarray, config: DetectorConfig, below: bool) -> float | None:
    """The frontier between the principal cluster and its neighbour, if what lies beyond is apart and small."""
    (lo, hi, *_), (other_lo, other_hi, *_) = main, other
    gap, frontier = (lo - other_hi, (other_hi + lo) / 2) if below else (other_lo - hi, (hi + other_lo) / 2)
    beyond = int((s <= frontier).sum() if below else (s >= frontier).sum())
    apart = gap >= config.gap_factor * max(hi - lo, other_hi - other_lo, 1e-9)
    return float(frontier) if apart and beyond <= config.max_outlier_share * s.size else None


def _clusters(s: np.ndarray, config: DetectorConfig) -> tuple[str, list[tuple[float, float, int, float]]]:
    """The method, and each cluster's least and greatest value, size and centre (none unless the method is CLUSTER)."""
    if not config.use_clustering:
        return "IQR_MAD_DESHABILITADO", []
    if s.size < config.min_months_cluster:
        return "IQR_MAD_POCOS_MESES", []
    if np.unique(s).size < 2:
        return "IQR_MAD_DEGENERADO", []
    try:
        _, edges = segment(s, config.k_max)
        p = np.append(0.0, np.cumsum(s))
        found = [(float(s[a]), float(s[b - 1]), b - a, float((p[b] - p[a]) / (b - a))) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    except (ArithmeticError, ValueError, IndexError):
        return "IQR_MAD_ERROR", []
    return ("CLUSTER", found) if len(found) > 1 else ("IQR_MAD_FALLBACK_K1", [])


def decide_series(y: np.ndarray, config: DetectorConfig) -> dict[str, list]:
    """For the months of one series and window (values on the detection scale, any order): every column of :data:`RESULT`, a value for each month."""
    y = np.asarray(y, np.float64)
    order = np.argsort(y, kind="stable")
    s, n = y[order], y.size
    p25, p50, p75 = (quantile(s, x) for x in (0.25, 0.5, 0.75))
    mad = quantile(np.sort(np.abs(s - p50)), 0.5)
    li, ls = p25 - config.iqr_factor * (p75 - p25), p75 + config.iqr_factor * (p75 - p25)
    z = (y - p50) * MAD_SCALE / mad if mad else np.zeros(n)
    method, found = _clusters(s, config)
    rank, low, high = np.full(n, -1), None, None
    if found:
        rank[order] = np.repeat(np.arange(len(found)), [c[2] for c in found])
        main = min(range(len(found)), key=lambda r: (-found[r][2], abs(found[r][3] - p50), r))
        low = _tail(found[main], found[main - 1], s, config, True) if main else None
        high = _tail(found[main], found[main + 1], s, config, False) if main + 1 < len(found) else None
        is_low, is_high = (y <= low if low is not None else np.zeros(n, bool)), (y >= high if high is not None else np.zeros(n, bool))
        flagged = is_low | is_high
        kind = np.where(is_high, "ALTO", np.where(is_low, "BAJO", None))
    else:
        flagged = (n >= config.min_months) & ((y < li) | (y > ls) | (np.abs(z) > config.mad_threshold))
        kind = np.where(flagged, np.where(y > p50, "ALTO", "BAJO"), None)
    back = lambda v: None if v is None else float(np.power(10.0, v)) if config.log_scale else float(v)
    diff_low, diff_high = (None if low is None else low - p25), (None if high is None else high - p75)
    within = lambda d: None if d is None else bool(abs(d) <= config.percentile_tolerance)
    whole = {
        "metodo": method, "k_elegido": len(found), "n_meses": n, "q1": back(p25), "mediana": back(p50), "q3": back(p75), "iqr": back(p75) - back(p25), "p25_log": p25, "p50_log": p50, "p75_log": p75,
        "frontera_inf_cluster": back(low), "frontera_sup_cluster": back(high), "frontera_inf_log": low, "frontera_sup_log": high,
        "limite_inf": back(li if low is None else low), "limite_sup": back(ls if high is None else high), "limite_inf_iqr": back(li), "limite_sup_iqr": back(ls),
        "dif_inf_p25_log": diff_low, "dif_sup_p75_log": diff_high, "pctl_valida_inf": within(diff_low), "pctl_valida_sup": within(diff_high), "mad": mad,
    }
    months = {
        "cluster_id": rank.tolist(), "cluster_rank": rank.tolist(), "cluster_center": [back(found[r][3]) if found else None for r in rank], "cluster_n": [found[r][2] if found else n for r in rank],
        "mod_zscore": z.tolist(), "es_outlier": flagged.tolist(), "tipo": kind.tolist(),
    }
    return {c: months[c] if c in months else [whole[c]] * n for c in NAMES}


def decide(months: DataFrame, config: DetectorConfig) -> DataFrame:
    """Every month of each window with its decision; ``months`` have dif_meses and lie within the longest window."""
    rows = fences.on_scale(months, config).select(*config.cell, "dif_meses", *POINT)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    names = [*config.cell, "ventana_meses", *POINT, "y_log", *NAMES]
    schema = ", ".join([*(f"{c} {kinds[c]}" for c in config.cell), "ventana_meses int", *(f"{c} {kinds[c]}" for c in POINT), "y_log double", RESULT])
    fields = dict(x.split() for x in RESULT.split(", "))

    def run(groups: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        series = pa.Table.from_batches(groups).sort_by("mes_idx")
        distance, y = series.column("dif_meses").to_numpy(), series.column("y").to_numpy()
        for w in config.windows:
            # months in order: a window is the end of the series
            first = int(np.searchsorted(-distance, -w))
            if first < series.num_rows:
                part = series.slice(first)
                said = decide_series(y[first:], config)
                cols = {**{c: part.column(c) for c in (*config.cell, *POINT)}, "ventana_meses": [w] * part.num_rows, "y_log": part.column("y"), **said}
                out = pa.table({c: cols[c] if isinstance(cols[c], pa.ChunkedArray) else pa.array(cols[c], _ARROW[fields.get(c, "int")]) for c in names})
                yield from out.combine_chunks().to_batches()

    return rows.groupBy(*config.cell).applyInArrow(run, schema)
