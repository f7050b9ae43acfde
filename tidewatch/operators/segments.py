"""Exact one-dimensional k-means over each series, in array expressions.

An optimal clustering of sorted values is a division into intervals, found by
dynamic programming over prefix sums; the number of clusters is where the curve
of optimal costs is farthest from its chord.  A series has at most as many
values as its window has months, so a group is one short array, gathered by a
single aggregate; all the rest is expressions on that row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.config import DetectorConfig
from tidewatch.functions.scalar import pinned

POINT = ("y", "codmes", "mes_idx", "valor_mes", "suma_mes", "n_dias")


def gather(rows: DataFrame, config: DetectorConfig) -> DataFrame:
    """One row per series and window: pts (months by value, then month), n, s (sorted values)."""
    groups = rows.groupBy(*config.cell, "ventana_meses").agg(F.array_sort(F.collect_list(F.struct(*POINT))).alias("pts"))
    return pinned(groups, {"n": F.size("pts"), "s": F.col("pts.y")})


def gather_windows(months: DataFrame, config: DetectorConfig) -> DataFrame:
    """As :func:`gather`, from months with y and dif_meses: each month is gathered once, and every window is a part of its series's one array."""
    series = months.groupBy(*config.cell).agg(F.collect_list(F.struct("dif_meses", *POINT)).alias("_all"))
    window = lambda w: F.struct(F.lit(w).alias("ventana_meses"), F.filter("_all", lambda m: m["dif_meses"] <= w).alias("_own"))
    parts = series.select(*config.cell, F.inline(F.array(*[window(w) for w in config.windows]))).where(F.size("_own") > 0)
    points = F.array_sort(F.transform("_own", lambda m: F.struct(*[m[c].alias(c) for c in POINT])))
    groups = pinned(parts.select(*config.cell, "ventana_meses", points.alias("pts")), {"_p": F.col("pts")}).drop("pts").withColumnRenamed("_p", "pts")
    return pinned(groups, {"n": F.size("pts"), "s": F.col("pts.y")})


def quantile_of(array: str, share: float) -> str:
    """Interpolated quantile of a sorted, nonempty array, as SQL."""
    at = f"((size({array}) - 1) * {share}D)"
    low = f"cast(floor({at}) as int)"
    high = f"cast(ceil({at}) as int)"
    return f"({array}[{low}] + ({array}[{high}] - {array}[{low}]) * ({at} - floor({at})))"


def prefix_sums(groups: DataFrame) -> DataFrame:
    """Adds p and q: sums and sums of squares of the first i values, i from 0 to n."""
    running = "aggregate(s, array(0D), (a, v) -> array_append(a, element_at(a, -1) + {}))"
    return pinned(groups, {"p": F.expr(running.format("v")), "q": F.expr(running.format("v * v"))})


def _cost(a: str, b: str) -> str:
    """Cost of the values from ``a`` (0-based) up to but without ``b``: squared deviations from their mean, not under 0."""
    total = f"(p[{b}] - p[{a}])"
    return f"greatest(0D, q[{b}] - q[{a}] - {total} * {total} / ({b} - {a}))"


def optimal_costs(groups: DataFrame, config: DetectorConfig) -> DataFrame:
    """Adds kmax and d: for k clusters and the first i values, the least cost and where the last cluster begins.

    ``d[k - 1][i]`` is a struct (c, j); on equal cost the smallest j wins, as the
    least struct does.  Groups that cannot have two clusters get a null.
    """
    distinct = "size(array_distinct(s))"
    groups = pinned(prefix_sums(groups), {"kmax": F.expr(f"least({config.k_max}, n - 1, {distinct})").cast("int")})
    none = "struct(double('infinity') as c, 0 as j)"
    first = f"transform(sequence(0, n), i -> if(i < 1, {none}, struct({_cost('0', 'i')} as c, 0 as j)))"
    groups = pinned(groups, {"_d1": F.expr(f"if(kmax >= 2, {first}, null)")})
    for k in range(2, config.k_max + 1):
        step = f"array_min(transform(sequence({k - 1}, i - 1), j -> struct(_d{k - 1}[j].c + {_cost('j', 'i')} as c, j as j)))"
        row = f"transform(sequence(0, n), i -> if(i < {k}, {none}, {step}))"
        groups = pinned(groups, {f"_d{k}": F.expr(f"if(kmax >= {k}, {row}, null)")})
    names = [f"_d{k}" for k in range(1, config.k_max + 1)]
    return pinned(groups, {"d": F.array(*names)}).drop(*names)


def elbow(groups: DataFrame) -> DataFrame:
    """Adds inertias (least cost for 1 to kmax clusters) and k, 1 when there is no structure."""
    curve = "if(kmax >= 2, transform(sequence(1, kmax), k -> d[k - 1][n].c), array())"
    scaled = "transform(inertias, v -> (v - array_min(inertias)) / if(array_max(inertias) > array_min(inertias), array_max(inertias) - array_min(inertias), 1D))"
    # distance from the chord between the ends, up to a constant factor
    gaps = "transform(_y, (v, i) -> abs((element_at(_y, -1) - _y[0]) * i / (size(_y) - 1) - v + _y[0]))"
    groups = pinned(pinned(groups, {"inertias": F.expr(f"cast({curve} as array<double>)")}), {"_y": F.expr(scaled)})
    groups = pinned(groups, {"_gaps": F.expr(f"if(kmax >= 2, {gaps}, array(0D))")})
    return groups.withColumn("k", F.expr("if(kmax >= 2, array_position(_gaps, array_max(_gaps)), 1)").cast("int")).drop("_y", "_gaps")


def clusters(groups: DataFrame) -> DataFrame:
    """Adds segs when k is over 1: the clusters in rising order as structs (rank, a, n, lo, hi, center)."""
    cuts = "aggregate(reverse(sequence(1, k)), array(n), (a, m) -> array_prepend(a, d[m - 1][a[0]].j))"
    seg = "transform(sequence(0, k - 1), r -> struct(r as rank, cuts[r] as a, cuts[r + 1] - cuts[r] as n, s[cuts[r]] as lo, s[cuts[r + 1] - 1] as hi, (p[cuts[r + 1]] - p[cuts[r]]) / (cuts[r + 1] - cuts[r]) as center))"
    groups = pinned(groups, {"cuts": F.expr(f"if(k >= 2, {cuts}, null)")}).drop("d")
    return pinned(groups, {"segs": F.expr(f"if(k >= 2, {seg}, null)")})


def solve(groups: DataFrame, config: DetectorConfig) -> DataFrame:
    """optimal_costs, elbow and clusters in a row."""
    return clusters(elbow(optimal_costs(groups, config)))


def segment(rows: DataFrame, config: DetectorConfig) -> DataFrame:
    """gather and solve; ``rows`` have y."""
    return solve(gather(rows, config), config)
