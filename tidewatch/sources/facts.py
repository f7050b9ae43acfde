"""From a wide fact table, one (date, value) pair of columns per metric, to long facts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.config import DetectorConfig, Metric
from tidewatch.functions.scalar import or_default


def read_source(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table, or Parquet files when ``name`` is a path."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def present(metric: Metric) -> Column:
    """A dated, positive value; null and, unlike plain comparison, NaN are not."""
    value = F.col(metric.value_col)
    return F.col(metric.date_col).isNotNull() & (value > 0) & (value.cast("double") < float("inf"))


def in_range(metric: Metric, config: DetectorConfig) -> Column:
    """The metric's date lies in the longest window."""
    first, after = config.date_range
    day = F.col(metric.date_col)
    return (day >= F.lit(first)) & (day < F.lit(after))


def parsed(source: DataFrame, config: DetectorConfig) -> tuple[DataFrame, DataFrame]:
    """The source with dates and values of text columns read, and what could not be read.

    One unreadable value would end a run; here it costs its metric's entry of its
    row alone.  The second frame has a row for each: metrica, the dimensions, fecha
    and valor as they were written, motivo (what is unreadable).  Columns that are
    dates and numbers already stay as they are, and conditions on them still reach
    the reader.
    """
    kinds = {f.name.lower(): f.dataType.typeName() for f in source.schema}
    text = lambda c: kinds[c.lower()] in ("string", "varchar", "char")
    columns, rejected = {}, []
    # columns that several metrics share are read once
    for c in {m.date_col for m in config.metrics if text(m.date_col)}:
        columns[c] = F.col(c).try_cast("timestamp")
    for c in {m.value_col for m in config.metrics if text(m.value_col)}:
        columns[c] = F.col(c).try_cast("double")
    for m in config.metrics:
        bad = [F.when(F.col(c).isNotNull() & columns[c].isNull(), F.lit(what)) for c, what in ((m.date_col, "fecha"), (m.value_col, "valor")) if c in columns]
        if bad:
            why = F.concat_ws(",", *bad)
            rejected.append(F.when(why != "", F.struct(F.lit(m.name).alias("metrica"), F.col(m.date_col).cast("string").alias("fecha"), F.col(m.value_col).cast("string").alias("valor"), why.alias("motivo"))))
    dims = [or_default(column, default).alias(name) for name, column, default in config.dimensions]
    kind = "array<struct<metrica:string,fecha:string,valor:string,motivo:string>>"
    quarantined = source.select(*dims, F.explode(F.array(*rejected) if rejected else F.array().cast(kind)).alias("_r")).where("_r is not null")
    return source.withColumns(columns) if columns else source, quarantined.select("_r.metrica", *[name for name, _, _ in config.dimensions], "_r.fecha", "_r.valor", "_r.motivo")


def long_facts(source: DataFrame, config: DetectorConfig, in_window: bool = True) -> DataFrame:
    """Columns metrica, fecha_dt, the dimensions and cantidad; one scan for all metrics.

    The condition before the unpivot is made of source columns only, so dates and
    values reach the Parquet reader; with ``in_window`` off, all dates stay.
    """
    keep = [present(m) & in_range(m, config) if in_window else present(m) for m in config.metrics]
    entries = [
        F.when(ok, F.struct(F.lit(m.name).alias("metrica"), F.to_date(m.date_col).alias("fecha_dt"), F.col(m.value_col).cast("double").alias("cantidad")))
        for m, ok in zip(config.metrics, keep, strict=True)
    ]
    dims = [or_default(column, default).alias(name) for name, column, default in config.dimensions]
    rows = source.where(reduce(lambda a, b: a | b, keep)).select(*dims, F.explode(F.array(*entries)).alias("_m")).where("_m is not null")
    return rows.select("_m.metrica", "_m.fecha_dt", *[name for name, _, _ in config.dimensions], "_m.cantidad")
