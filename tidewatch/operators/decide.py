"""From segments to verdicts: method, isolated tails, limits and their validation.

All of it is expressions on the one row per series and window; months come back
by exploding the group's array at the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.config import DetectorConfig
from tidewatch.functions.scalar import from_scale, pinned, robust_score
from tidewatch.operators.segments import POINT, quantile_of


def group_statistics(groups: DataFrame, config: DetectorConfig) -> DataFrame:
    """Adds interpolated quartiles p25, p50, p75, mad and the fences li and ls."""
    groups = pinned(groups, {name: F.expr(quantile_of("s", share)) for name, share in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))})
    groups = pinned(groups, {"_dev": F.expr("array_sort(transform(s, v -> abs(v - p50)))")}).withColumn("mad", F.expr(quantile_of("_dev", 0.5))).drop("_dev")
    spread = F.lit(config.iqr_factor) * (F.col("p75") - F.col("p25"))
    return groups.withColumns({"li": F.col("p25") - spread, "ls": F.col("p75") + spread})


def route(groups: DataFrame, config: DetectorConfig) -> DataFrame:
    """Adds metodo.  Expressions cannot fail half-way, so there is no method for errors."""
    if not config.use_clustering:
        return groups.withColumn("metodo", F.lit("IQR_MAD_DESHABILITADO"))
    method = (
        F.when(F.col("n") < config.min_months_cluster, "IQR_MAD_POCOS_MESES")
        .when(F.size(F.array_distinct("s")) < 2, "IQR_MAD_DEGENERADO")
        .when(F.col("k") < 2, "IQR_MAD_FALLBACK_K1")
        .otherwise("CLUSTER")
    )
    return groups.withColumn("metodo", method)


def principal(groups: DataFrame) -> DataFrame:
    """Adds main, the largest cluster (nearest to the median, then lowest, on ties); null without clusters."""
    best = "array_min(transform(segs, g -> struct(-g.n as size, abs(g.center - p50) as gap, g.rank as rank))).rank"
    return pinned(groups, {"main": F.expr(f"if(metodo = 'CLUSTER', segs[{best}], null)")})


def isolation(groups: DataFrame, config: DetectorConfig) -> DataFrame:
    """Adds finf and fsup, the frontiers to tails that are isolated and small enough, else null.

    Only the cluster next to the principal one decides; the tail is every month
    beyond the frontier, the frontier included.
    """
    near = {
        "finf": ("segs[main.rank - 1]", "main.rank >= 1", "main.lo - {o}.hi", "({o}.hi + main.lo) / 2", "v <= {f}"),
        "fsup": ("segs[main.rank + 1]", "main.rank + 1 < k", "{o}.lo - main.hi", "(main.hi + {o}.lo) / 2", "v >= {f}"),
    }
    for name, (other, exists, gap, frontier, beyond) in near.items():
        groups = pinned(groups, {"_o": F.expr(f"if(main is not null and {exists}, {other}, null)")})
        groups = pinned(groups, {"_f": F.expr(frontier.format(o="_o"))})
        apart = f"{gap.format(o='_o')} >= {config.gap_factor}D * greatest(main.hi - main.lo, _o.hi - _o.lo, 1e-9D)"
        small = f"size(filter(s, v -> {beyond.format(f='_f')})) <= {config.max_outlier_share}D * n"
        groups = pinned(groups, {name: F.expr(f"if(_o is not null and {apart} and {small}, _f, null)")}).drop("_o", "_f")
    return groups


def limits(groups: DataFrame, config: DetectorConfig) -> DataFrame:
    """Adds what is reported: limits (frontier or else fence), differences from quartiles and their validity."""
    diff_low, diff_high = F.col("finf") - F.col("p25"), F.col("fsup") - F.col("p75")
    back = lambda c: from_scale(c, config.log_scale)
    return groups.withColumns({
        "q1": back(F.col("p25")), "mediana": back(F.col("p50")), "q3": back(F.col("p75")), "iqr": back(F.col("p75")) - back(F.col("p25")),
        "frontera_inf_cluster": back(F.col("finf")), "frontera_sup_cluster": back(F.col("fsup")),
        "limite_inf": back(F.coalesce("finf", "li")), "limite_sup": back(F.coalesce("fsup", "ls")), "limite_inf_iqr": back(F.col("li")), "limite_sup_iqr": back(F.col("ls")),
        "dif_inf_p25_log": diff_low, "dif_sup_p75_log": diff_high,
        "pctl_valida_inf": F.abs(diff_low) <= config.percentile_tolerance, "pctl_valida_sup": F.abs(diff_high) <= config.percentile_tolerance,
    })


def by_month(groups: DataFrame, config: DetectorConfig) -> DataFrame:
    """One row per month: its cluster, mod_zscore, es_outlier and tipo, with the group's columns."""
    clustered = F.col("metodo") == "CLUSTER"
    rows = groups.select("*", F.posexplode("pts").alias("_i", "_m"))
    rows = rows.withColumns({c: F.col(f"_m.{c}") for c in POINT}).withColumn("_seg", F.expr("if(metodo = 'CLUSTER', filter(segs, g -> _i >= g.a and _i < g.a + g.n)[0], null)"))
    z = robust_score("y", "p50", "mad")
    low, high = F.coalesce(F.col("y") <= F.col("finf"), F.lit(False)), F.coalesce(F.col("y") >= F.col("fsup"), F.lit(False))
    fenced = (F.col("n") >= config.min_months) & ((F.col("y") < F.col("li")) | (F.col("y") > F.col("ls")) | (F.abs(z) > config.mad_threshold))
    rows = rows.withColumns({
        "mod_zscore": z, "es_outlier": F.when(clustered, low | high).otherwise(fenced),
        "k_elegido": F.when(clustered, F.col("k")).otherwise(0).cast("int"), "cluster_rank": F.when(clustered, F.col("_seg.rank")).otherwise(-1).cast("int"),
        "cluster_center": from_scale(F.col("_seg.center"), config.log_scale), "cluster_n": F.when(clustered, F.col("_seg.n")).otherwise(F.col("n")).cast("int"),
    })
    kind = F.when(clustered, F.when(high, "ALTO").when(low, "BAJO")).when(F.col("es_outlier"), F.when(F.col("y") > F.col("p50"), "ALTO").otherwise("BAJO"))
    return rows.withColumns({
        "tipo": kind, "cluster_id": F.col("cluster_rank"), "n_meses": F.col("n").cast("int"), "y_log": F.col("y"),
        "p25_log": F.col("p25"), "p50_log": F.col("p50"), "p75_log": F.col("p75"), "frontera_inf_log": F.col("finf"), "frontera_sup_log": F.col("fsup"),
    }).drop("_i", "_m", "_seg", "pts", "segs", "main", "cuts", "s", "p", "q")


def decide(groups: DataFrame, config: DetectorConfig) -> DataFrame:
    """All of the above, from the rows of :func:`tidewatch.operators.segments.segment`."""
    return by_month(limits(isolation(principal(route(group_statistics(groups, config), config)), config), config), config)
