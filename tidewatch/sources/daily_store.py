"""Daily totals that are kept up to date, so that monthly runs need not scan the wide table.

The store holds mergeable partials (sum and number of rows by series and day),
partitioned by calendar month.  New rows, late ones among them, are summed on
their own first; the months they touch are known from what that wrote, and only
those are read, merged and written.  Batches carry a name, which is published in
the same step as their rows: a batch that comes again changes nothing, so a run
that failed anywhere can simply be repeated.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.config import DetectorConfig
from tidewatch.functions.scalar import month_code
from tidewatch.operators import rollup
from tidewatch.sources import facts, versions

MONTH = "codmes"


def partials(source: DataFrame, config: DetectorConfig, months: Sequence[int] = ()) -> DataFrame:
    """cantidad_dia, n_filas by series and day, with the day's month last; of ``months`` alone, if any are given."""
    rows = facts.long_facts(source, config, in_window=False).withColumn(MONTH, month_code("fecha_dt"))
    rows = rows.where(F.col(MONTH).isin(*months)) if months else rows
    return merged(rows.select(*_without_weekday(config), F.col("cantidad").alias("cantidad_dia"), F.lit(1).cast("long").alias("n_filas"), MONTH), config)


def _without_weekday(config: DetectorConfig) -> list[str]:
    return [*(c for c in config.cell if c != "dia_semana"), "fecha_dt"]


def merged(parts: DataFrame, config: DetectorConfig) -> DataFrame:
    """One partial for each series and day."""
    return parts.groupBy(*_without_weekday(config), MONTH).agg(F.sum("cantidad_dia").alias("cantidad_dia"), F.sum("n_filas").alias("n_filas")).select(*_without_weekday(config), "cantidad_dia", "n_filas", MONTH)


def batches(spark: SparkSession, table: str) -> list[str]:
    """Names of all batches that the store has taken in."""
    return json.loads(versions.properties(spark, table).get("tidewatch.batches", "[]"))


def add(source: DataFrame, config: DetectorConfig, table: str, batch: str, path: str | None = None) -> list[int]:
    """Takes a batch of rows in; returns the months that were written anew, none if the batch was taken in before."""
    spark, known = source.sparkSession, batches(source.sparkSession, table)
    if batch in known:
        return []
    versions.sweep(spark, table)
    delta, touched = versions.write(partials(source, config), table, path, (MONTH,))
    now = versions.live(spark, table)
    old = {values: now[values] for values in touched if values in now}
    fresh = dict.fromkeys(touched, delta)
    if old:
        # months that were there before are merged, all others stand as written
        keep = [v for (v,) in old]
        stored = spark.table(table).where(F.col(MONTH).isin(*keep))
        both = stored.unionByName(versions.rows_of(spark, table, delta).where(F.col(MONTH).isin(*keep)))
        version, found = versions.write(merged(both, config), table, path, (MONTH,))
        fresh |= dict.fromkeys(found, version)
    versions.switch(spark, table, now | fresh, {"tidewatch.batches": json.dumps([*known, batch])})
    return sorted(v for (v,) in touched)


def rebuild(source: DataFrame, config: DetectorConfig, table: str, months: Sequence[int], path: str | None = None) -> None:
    """Puts ``months`` as the whole source has them in the place of what is stored, where rows were corrected or withdrawn."""
    spark = source.sparkSession
    versions.sweep(spark, table)
    version, found = versions.write(partials(source, config, months), table, path, (MONTH,))
    now = {values: v for values, v in versions.live(spark, table).items() if values[0] not in set(months)}
    versions.switch(spark, table, now | dict.fromkeys(found, version), {"tidewatch.batches": json.dumps(batches(spark, table))})


def days(spark: SparkSession, table: str, config: DetectorConfig, in_window: bool = True) -> DataFrame:
    """Daily totals as :func:`tidewatch.operators.rollup.daily` has them; of the longest window's months alone, unless told otherwise."""
    stored = spark.table(table)
    if in_window:
        first, after = config.date_range
        stored = stored.where(F.col(MONTH).between(first.year * 100 + first.month, after.year * 100 + after.month) & (F.col("fecha_dt") >= F.lit(first)) & (F.col("fecha_dt") < F.lit(after)))
    return rollup.with_weekday(stored).select(*config.cell, "fecha_dt", "cantidad_dia")
