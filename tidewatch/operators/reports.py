"""Report layouts, summaries, the acceptance probe and the consumer's anti-join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.config import DetectorConfig
from tidewatch.functions.scalar import weekday_label

#: Fixed layouts.
KEYS = ("metrica", "canal_dsc", "flujo_dsc", "objetivo_dsc", "productos_dsc", "dia_semana")
FENCE_COLUMNS = ("codmes_val", "ventana_meses", "codmes", *KEYS, "dia_semana_dsc", "tipo", "valor_mes", "suma_mes", "n_dias", "n_meses", "q1", "mediana", "q3", "iqr", "limite_inf", "limite_sup", "mad", "mod_zscore")
CLUSTER_COLUMNS = (
    "codmes_val", "ventana_meses", "codmes", *KEYS, "dia_semana_dsc", "tipo", "valor_mes", "suma_mes", "n_dias", "n_meses",
    "metodo", "k_elegido", "cluster_id", "cluster_rank", "cluster_center", "cluster_n",
    "frontera_inf_cluster", "frontera_sup_cluster", "limite_inf", "limite_sup", "limite_inf_iqr", "limite_sup_iqr",
    "q1", "mediana", "q3", "iqr", "dif_inf_p25_log", "dif_sup_p75_log", "pctl_valida_inf", "pctl_valida_sup", "mad", "mod_zscore", "es_outlier",
)
DETAIL_COLUMNS = (
    "codmes_val", "ventana_meses", "codmes", *KEYS, "valor_mes", "suma_mes", "n_dias", "n_meses", "y_log",
    "metodo", "k_elegido", "cluster_id", "cluster_rank", "cluster_center", "cluster_n", "q1", "mediana", "q3", "iqr", "p25_log", "p50_log", "p75_log",
    "frontera_inf_cluster", "frontera_sup_cluster", "frontera_inf_log", "frontera_sup_log", "limite_inf", "limite_sup", "limite_inf_iqr", "limite_sup_iqr",
    "dif_inf_p25_log", "dif_sup_p75_log", "pctl_valida_inf", "pctl_valida_sup", "mad", "mod_zscore", "es_outlier", "tipo",
)
ORDER = ("ventana_meses", *KEYS, "codmes")
PROBE_COLUMNS = ("ventana_meses", "codmes", "valor_mes", "metodo", "k_elegido", "cluster_rank", "cluster_n", "frontera_inf_cluster", "limite_inf", "limite_inf_iqr", "es_outlier", "tipo")
#: The case that a run is accepted by (metric, weekday, calendar month, words in dimensions).
ACCEPTANCE = ("ENVIOS", 1, 1, {"productos_dsc": "VENTA TC", "flujo_dsc": "MARKETING CONTEXTUAL", "objetivo_dsc": "VENTAS", "canal_dsc": "HTML"})


def layout(rows: DataFrame, config: DetectorConfig, columns: Sequence[str]) -> DataFrame:
    """``columns`` of ``rows``, with the evaluation month and the weekday's label."""
    return rows.withColumns({"codmes_val": F.lit(config.eval_month).cast("int"), "dia_semana_dsc": weekday_label("dia_semana")}).select(*columns)


def ordered(report: DataFrame) -> DataFrame:
    """A report in reading order."""
    return report.orderBy(*ORDER)


def outliers_only(rows: DataFrame) -> DataFrame:
    return rows.where("es_outlier")


def summary(outliers: DataFrame, by: Sequence[str] = ("ventana_meses",)) -> DataFrame:
    """Flagged months and the series they belong to, by window (and method, or evaluation month)."""
    return outliers.groupBy(*by).agg(F.count(F.lit(1)).alias("n_outliers"), F.count_distinct(*KEYS).alias("combinaciones_afectadas")).orderBy(*by)


def stored_months(stored: DataFrame) -> DataFrame:
    """Rows and series by evaluation month of an accumulated table."""
    return stored.groupBy("codmes_val").agg(F.count(F.lit(1)).alias("n_filas"), F.count_distinct(*KEYS).alias("combinaciones")).orderBy("codmes_val")


def clean_months(series: DataFrame, outliers: DataFrame) -> DataFrame:
    """Months for building bands: those of ``series`` that are not flagged for the same evaluation month, window, series and month.

    Frames of a single run may leave ``codmes_val`` out, both of them.
    """
    keys = ["ventana_meses", *KEYS, "codmes"]
    have = ["codmes_val" in f.columns for f in (series, outliers)]
    if have[0] != have[1]:
        raise ValueError("codmes_val is in one of the two frames only")
    keys = ["codmes_val", *keys] if have[0] else keys
    return series.join(outliers.select(*keys), keys, "left_anti")


def stored_clean_months(spark: SparkSession, detail_table: str, outlier_table: str) -> DataFrame:
    """As :func:`clean_months`, over stored tables whose files are dealt by series: no exchange on either side.

    The frame belongs to a session of its own, in which a join may rely on a part
    of its keys being dealt alike; the caller's settings stay as they are.
    """
    own = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions", "spark.sql.ansi.enabled"):
        own.conf.set(key, spark.conf.get(key))
    own.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    own.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    # tables grow with months: neither side has a proven bound
    own.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    own.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    return clean_months(own.table(detail_table), own.table(outlier_table))


def probe(detail: DataFrame, metric: str, weekday: int, month: int, contains: dict[str, str]) -> DataFrame:
    """Rows of one metric, weekday and calendar month whose dimensions contain the given words, case ignored."""
    hit = (F.col("metrica") == metric) & (F.col("dia_semana") == weekday) & (F.col("codmes") % 100 == month)
    for column, words in contains.items():
        hit &= F.upper(column).contains(words.upper())
    return detail.where(hit).select(*PROBE_COLUMNS).orderBy("ventana_meses", "codmes")
