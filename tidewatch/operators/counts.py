"""Exact numbers of affected series that merge over windows, months and tables.

A count of distinct series cannot be added up, and counting anew exchanges every
row's whole key.  Here series are numbered 0, 1, 2 and so on once; a partial holds,
for each group and each run of 32,768 series, how many rows there are and which
series they belong to, as a bitmap of 4 KB.  Partials of any groups merge by adding
and by or-ing, so a summary reads a few small rows for each window and month.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.reports import KEYS


def number_series(rows: DataFrame, path: str, keys: Sequence[str] = KEYS, known: DataFrame | None = None) -> DataFrame:
    """``keys`` and serie, dense numbers from 0 by the order of keys; ``known`` series keep their numbers and new ones follow.

    New series are written to ``path``, in order, before they are numbered: a second
    computation could deal them over partitions otherwise.
    """
    series = rows.select(*keys).distinct()
    begin = 0
    if known is not None:
        # null keys are the same series
        same = F.lit(True)
        for k in keys:
            same = same & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
        series = series.alias("a").join(known.alias("b"), same, "left_anti")
        begin = known.agg(F.coalesce(F.max("serie") + 1, F.lit(0))).first()[0]
    series.orderBy(*keys).withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    placed = rows.sparkSession.read.parquet(path)
    part = F.shiftright("_at", 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()
    before = itertools.accumulate((r.n for r in sizes), initial=begin)
    # a number per partition
    starts = rows.sparkSession.createDataFrame([(r.part, b) for r, b in zip(sizes, before, strict=False)], "_part long, _before long")
    numbered = placed.withColumn("_part", part).join(F.broadcast(starts), "_part").select(*keys, (F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1)).alias("serie"))
    return numbered if known is None else known.select(*keys, "serie").unionByName(numbered)


def partials(rows: DataFrame, numbers: DataFrame, by: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """One row per group and run of series: by, cubo, n_filas, mapa (bitmap)."""
    own = rows.select(*by, *keys).join(numbers, list(keys))
    return own.groupBy(*by, F.bitmap_bucket_number("serie").alias("cubo")).agg(F.count(F.lit(1)).alias("n_filas"), F.bitmap_construct_agg(F.bitmap_bit_position("serie")).alias("mapa"))


def merge(parts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Partials of coarser groups."""
    return parts.groupBy(*by, "cubo").agg(F.sum("n_filas").alias("n_filas"), F.bitmap_or_agg("mapa").alias("mapa"))


def summary(parts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows and different series by group, in order."""
    return merge(parts, by).groupBy(*by).agg(F.sum("n_filas").alias("n_outliers"), F.sum(F.bitmap_count("mapa")).alias("combinaciones_afectadas")).orderBy(*by)
