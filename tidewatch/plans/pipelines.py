"""Entry points: from a wide source to reports and tables, one plan each."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from tidewatch.config import DetectorConfig
from tidewatch.operators import decide, fences, grouped, iterative, reports, rollup, segments
from tidewatch.sources import daily_store, facts, sinks


def monthly_series(source: DataFrame, config: DetectorConfig) -> DataFrame:
    """Months within the longest window, with their distance."""
    return rollup.look_back(rollup.monthly(rollup.daily(facts.long_facts(source, config), config), config), config)


def stored_series(spark: SparkSession, daily_table: str, config: DetectorConfig) -> DataFrame:
    """As :func:`monthly_series`, from maintained daily totals; only the window's months are read."""
    return rollup.look_back(rollup.monthly(daily_store.days(spark, daily_table, config), config), config)


def windowed(source: DataFrame | None, config: DetectorConfig, months: DataFrame | None = None) -> DataFrame:
    """Months of each window, on the detection scale; from ``months``, where they are given, instead of ``source``."""
    return fences.on_scale(rollup.explode_windows(monthly_series(source, config) if months is None else months, config), config)


def fence_detail(source: DataFrame | None, config: DetectorConfig, months: DataFrame | None = None) -> DataFrame:
    """Every month with discrete statistics, fences and verdict."""
    return fences.in_units(fences.fences(fences.statistics(windowed(source, config, months), config), config), config)


def fence_outliers(source: DataFrame | None, config: DetectorConfig, months: DataFrame | None = None) -> DataFrame:
    """Flagged months, base layout."""
    return reports.layout(reports.outliers_only(fence_detail(source, config, months)), config, reports.FENCE_COLUMNS)


def series_segments(months: DataFrame, config: DetectorConfig) -> DataFrame:
    """One row per series and window with its clusters; each month is gathered once for all windows."""
    solver = iterative if config.solver == "iterative" else segments
    return solver.solve(segments.gather_windows(fences.on_scale(months, config), config), config)


def cluster_detail(source: DataFrame | None, config: DetectorConfig, months: DataFrame | None = None) -> DataFrame:
    """Every month with its cluster, frontiers, limits and verdict."""
    months = monthly_series(source, config) if months is None else months
    if config.solver == "grouped":
        return grouped.decide(months, config)
    return decide.decide(series_segments(months, config), config)


def cluster_outliers(detail: DataFrame, config: DetectorConfig) -> DataFrame:
    """Flagged months of a cluster detail, outlier layout."""
    return reports.layout(reports.outliers_only(detail), config, reports.CLUSTER_COLUMNS)


def run_fences(source: DataFrame | None, config: DetectorConfig, table: str, path: str | None = None, months: DataFrame | None = None) -> DataFrame:
    """Replaces ``table`` by the flagged months of all windows; returns the summary by window."""
    flagged = fence_outliers(source, config, months)
    sinks.replace_table(flagged, table, path, ("ventana_meses",), reports.ORDER)
    return reports.summary(flagged.sparkSession.table(table))


def run_clusters(source: DataFrame | None, config: DetectorConfig, outlier_table: str, detail_table: str | None = None, outlier_path: str | None = None, detail_path: str | None = None, months: DataFrame | None = None, migrate: bool = False) -> DataFrame:
    """Accumulates the run's month in both tables; returns the summary by window and method."""
    detail = cluster_detail(source, config, months).persist(StorageLevel.MEMORY_AND_DISK)
    targets = [(config.eval_month, w) for w in config.windows]
    dealt = {"order": reports.ORDER, "buckets": config.buckets, "by": config.cell, "migrate": migrate}
    try:
        sinks.accumulate(cluster_outliers(detail, config), outlier_table, targets, outlier_path, **dealt)
        if detail_table:
            sinks.accumulate(reports.layout(detail, config, reports.DETAIL_COLUMNS), detail_table, targets, detail_path, **dealt)
    finally:
        detail.unpersist()
    spark = detail.sparkSession
    return reports.summary(spark.table(outlier_table).where(f"codmes_val = {config.eval_month}"), ("ventana_meses", "metodo"))
