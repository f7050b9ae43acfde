"""The query catalogue over the driver's tables, and the same queries in DuckDB SQL.

The wide source is made of lineitem, orders and customer: three metrics (two of
them share a date column), four dimensions of which one has nulls and empty
strings.  Amounts are whole cents and percent points, so sums do not depend on
their order.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.config import DetectorConfig, Metric
from tidewatch.functions.scalar import iso_weekday, month_code, month_index, weekday_label
from tidewatch.operators import counts, decide, fences, grouped, reports, rollup, segments
from tidewatch.plans import pipelines
from tidewatch.sources import daily_store, facts, sinks

EVAL_MONTH = 200001
METRICS = (Metric("ORDERED", "fecha_pedido", "cantidad_pedida"), Metric("SHIPPED", "fecha_envio", "importe"), Metric("DISCOUNTED", "fecha_envio", "descuento"))
BASE = DetectorConfig(eval_month=EVAL_MONTH, metrics=METRICS)
CLUSTER = DetectorConfig(eval_month=EVAL_MONTH, metrics=METRICS, windows=(6, 24))


def wide_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with its order and customer, in the layout of a wide fact table."""
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    lines, orders, customers = read("lineitem"), read("orders"), read("customer")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select(
        F.col("c_mktsegment").alias("canal_dsc"), F.col("o_orderpriority").alias("flujo_dsc"), F.col("l_returnflag").alias("productos_dsc"),
        F.when(F.col("o_orderstatus") == "F", F.lit(None)).when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderstatus")).alias("objetivos_dsc"),
        F.col("o_orderdate").alias("fecha_pedido"), F.col("l_quantity").alias("cantidad_pedida"), F.col("l_shipdate").alias("fecha_envio"),
        F.round(F.col("l_extendedprice") * 100).alias("importe"), F.round(F.col("l_discount") * 100).alias("descuento"),
    )


SRC = """src AS (SELECT c_mktsegment AS canal_dsc, o_orderpriority AS flujo_dsc, l_returnflag AS productos_dsc,
  CASE o_orderstatus WHEN 'F' THEN NULL WHEN 'P' THEN '' ELSE o_orderstatus END AS objetivos_dsc,
  o_orderdate AS fecha_pedido, l_quantity AS cantidad_pedida, l_shipdate AS fecha_envio, round(l_extendedprice * 100) AS importe, round(l_discount * 100) AS descuento
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)"""
DIMS = "canal_dsc, flujo_dsc, productos_dsc, objetivo_dsc"
CELL = f"metrica, {DIMS}, dia_semana"
GROUP = f"{CELL}, ventana_meses"


def _long(config: DetectorConfig, in_window: bool) -> str:
    first, after = config.date_range
    part = " UNION ALL ".join(
        f"""SELECT '{m.name}' AS metrica, CAST({m.date_col} AS DATE) AS fecha_dt, coalesce(nullif(canal_dsc, ''), 'SIN CANAL') AS canal_dsc, coalesce(nullif(flujo_dsc, ''), 'SIN FLUJO') AS flujo_dsc,
  coalesce(nullif(productos_dsc, ''), 'SIN PRODUCTO') AS productos_dsc, coalesce(nullif(objetivos_dsc, ''), 'SIN OBJETIVO') AS objetivo_dsc, CAST({m.value_col} AS DOUBLE) AS cantidad
  FROM src WHERE {m.date_col} IS NOT NULL AND {m.value_col} > 0"""
        + (f" AND {m.date_col} >= DATE '{first}' AND {m.date_col} < DATE '{after}'" if in_window else "")
        for m in config.metrics
    )
    return f"facts AS ({part})"


DAILY = f"days AS (SELECT {CELL}, fecha_dt, sum(cantidad) AS cantidad_dia FROM (SELECT *, CAST(isodow(fecha_dt) AS INTEGER) AS dia_semana FROM facts) GROUP BY ALL)"
MONTHLY = f"""months AS (SELECT {CELL}, CAST(year(fecha_dt) * 100 + month(fecha_dt) AS INTEGER) AS codmes, CAST(year(fecha_dt) * 12 + month(fecha_dt) AS INTEGER) AS mes_idx,
  avg(cantidad_dia) AS valor_mes, sum(cantidad_dia) AS suma_mes, count(*) AS n_dias FROM days GROUP BY ALL)"""


def _windowed(config: DetectorConfig) -> str:
    windows = ", ".join(f"({w})" for w in config.windows)
    return f"""{SRC}, {_long(config, True)}, {DAILY}, {MONTHLY},
back AS (SELECT *, CAST({config.eval_index} - mes_idx AS INTEGER) AS dif_meses FROM months WHERE {config.eval_index} - mes_idx BETWEEN 1 AND {max(config.windows)}),
win AS (SELECT back.*, CAST(w AS INTEGER) AS ventana_meses, log10(greatest(valor_mes, 1e-9)) AS y FROM back JOIN (VALUES {windows}) AS v(w) ON dif_meses <= w)"""


def _statistics(kind: str) -> str:
    return f"""quart AS (SELECT {GROUP}, count(*) AS n_meses, quantile_{kind}(y, 0.25) AS q1_y, quantile_{kind}(y, 0.5) AS med_y, quantile_{kind}(y, 0.75) AS q3_y FROM win GROUP BY ALL),
dev AS (SELECT {GROUP}, quantile_{kind}(abs(y - med_y), 0.5) AS mad FROM win JOIN quart USING ({GROUP}) GROUP BY ALL),
stat AS (SELECT win.*, n_meses, q1_y, med_y, q3_y, mad, q1_y - 1.5::DOUBLE * (q3_y - q1_y) AS li_y, q3_y + 1.5::DOUBLE * (q3_y - q1_y) AS ls_y,
  CASE WHEN mad > 0 THEN 0.6745::DOUBLE * (y - med_y) / mad ELSE 0.0::DOUBLE END AS mod_zscore FROM win JOIN quart USING ({GROUP}) JOIN dev USING ({GROUP})),
verdict AS (SELECT *, n_meses >= 4 AND (y < li_y OR y > ls_y OR abs(mod_zscore) > 3.5) AS es_outlier FROM stat),
fence AS (SELECT *, CASE WHEN es_outlier THEN CASE WHEN y > med_y THEN 'ALTO' ELSE 'BAJO' END END AS tipo,
  pow(10.0, q1_y) AS q1, pow(10.0, med_y) AS mediana, pow(10.0, q3_y) AS q3, pow(10.0, q3_y) - pow(10.0, q1_y) AS iqr, pow(10.0, li_y) AS limite_inf, pow(10.0, ls_y) AS limite_sup FROM verdict)"""


def _segments(config: DetectorConfig) -> str:
    cost = "greatest(0.0::DOUBLE, b.q - a.q - (b.p - a.p) * (b.p - a.p) / (b.i - a.i))"
    parts = [
        f"pts AS (SELECT *, row_number() OVER (PARTITION BY {GROUP} ORDER BY y, codmes) AS i FROM win)",
        f"pre AS (SELECT {GROUP}, i, sum(y) OVER o AS p, sum(y * y) OVER o AS q FROM pts WINDOW o AS (PARTITION BY {GROUP} ORDER BY i ROWS UNBOUNDED PRECEDING) UNION ALL SELECT DISTINCT {GROUP}, 0, 0.0, 0.0 FROM pts)",
        f"grp AS (SELECT {GROUP}, count(*) AS n, least({config.k_max}, count(*) - 1, count(DISTINCT y)) AS kmax FROM pts GROUP BY ALL)",
        f"d1 AS (SELECT {GROUP}, b.i, {{'c': {cost}, 'j': 0::BIGINT}} AS m FROM pre b JOIN (SELECT * FROM pre WHERE i = 0) a USING ({GROUP}) JOIN grp USING ({GROUP}) WHERE b.i >= 1 AND kmax >= 2)",
    ]
    for k in range(2, config.k_max + 1):
        parts.append(f"d{k} AS (SELECT {GROUP}, b.i, min({{'c': d.m.c + {cost}, 'j': a.i}}) AS m FROM pre b JOIN pre a USING ({GROUP}) JOIN d{k - 1} d USING ({GROUP}) JOIN grp USING ({GROUP}) WHERE d.i = a.i AND a.i >= {k - 1} AND a.i < b.i AND kmax >= {k} GROUP BY {GROUP}, b.i)")
    parts.append("best AS (" + " UNION ALL ".join(f"SELECT {GROUP}, {k} AS k, i, m.c AS c, m.j AS j FROM d{k}" for k in range(1, config.k_max + 1)) + ")")
    parts.append(f"curve AS (SELECT {GROUP}, n, kmax, k, c FROM best JOIN grp USING ({GROUP}) WHERE i = n)")
    parts.append(f"scaled AS (SELECT *, (c - min(c) OVER g) / CASE WHEN max(c) OVER g > min(c) OVER g THEN max(c) OVER g - min(c) OVER g ELSE 1 END AS v FROM curve WINDOW g AS (PARTITION BY {GROUP}))")
    parts.append(f"ends AS (SELECT {GROUP}, max(v) FILTER (WHERE k = 1) AS v0, max(v) FILTER (WHERE k = kmax) AS v1 FROM scaled GROUP BY ALL)")
    parts.append(f"gaps AS (SELECT {GROUP}, k, abs((v1 - v0) * (k - 1) / (kmax - 1) - v + v0) AS gap FROM scaled JOIN ends USING ({GROUP}))")
    parts.append(f"chosen AS (SELECT {GROUP}, n, kmax, CAST(coalesce(k, 1) AS INTEGER) AS k FROM grp LEFT JOIN (SELECT {GROUP}, -max({{'g': gap, 'k': -k}}).k AS k FROM gaps GROUP BY ALL) USING ({GROUP}))")
    # the cuts, from the last cluster to the first
    parts.append(f"""cut AS (SELECT {GROUP}, chosen.k AS r, n AS hi_i FROM chosen WHERE k >= 2
  UNION ALL SELECT {GROUP}, cut.r - 1, best.j FROM cut JOIN best USING ({GROUP}) WHERE best.k = cut.r AND best.i = cut.hi_i AND cut.r >= 2)""")
    parts.append(f"seg AS (SELECT {GROUP}, r - 1 AS rank, coalesce(lag(hi_i) OVER (PARTITION BY {GROUP} ORDER BY r), 0) AS lo_i, hi_i FROM cut)")
    parts.append(f"segs AS (SELECT {GROUP}, rank, CAST(count(*) AS INTEGER) AS size, min(y) AS lo, max(y) AS hi, avg(y) AS center FROM seg JOIN pts USING ({GROUP}) WHERE i > lo_i AND i <= hi_i GROUP BY {GROUP}, rank)")
    return "RECURSIVE " + f"{_windowed(config)}, {_statistics('cont').split('verdict AS')[0].rstrip().rstrip(',')}, " + ", ".join(parts)


def _decisions(config: DetectorConfig) -> str:
    """On top of _segments: one row per month, all columns of the detail."""
    return f"""{_segments(config)},
g0 AS (SELECT DISTINCT {GROUP}, n_meses, q1_y AS p25, med_y AS p50, q3_y AS p75, mad, li_y AS li, ls_y AS ls FROM stat),
g1 AS (SELECT g0.*, chosen.k, CASE WHEN n_meses < 6 THEN 'IQR_MAD_POCOS_MESES' WHEN dy < 2 THEN 'IQR_MAD_DEGENERADO' WHEN chosen.k < 2 THEN 'IQR_MAD_FALLBACK_K1' ELSE 'CLUSTER' END AS metodo
  FROM g0 JOIN chosen USING ({GROUP}) JOIN (SELECT {GROUP}, count(DISTINCT y) AS dy FROM win GROUP BY ALL) USING ({GROUP})),
main AS (SELECT {GROUP}, min({{'s': -size, 'd': abs(center - p50), 'r': rank}}).r AS main FROM segs JOIN g1 USING ({GROUP}) WHERE metodo = 'CLUSTER' GROUP BY ALL),
mains AS (SELECT {GROUP}, main, lo AS mlo, hi AS mhi FROM main JOIN segs USING ({GROUP}) WHERE rank = main),
low AS (SELECT {GROUP}, (l.hi + mlo) / 2 AS f, mlo - l.hi >= greatest(mhi - mlo, l.hi - l.lo, 1e-9) AS apart FROM mains JOIN segs l USING ({GROUP}) WHERE l.rank = main - 1),
high AS (SELECT {GROUP}, (mhi + h.lo) / 2 AS f, h.lo - mhi >= greatest(mhi - mlo, h.hi - h.lo, 1e-9) AS apart FROM mains JOIN segs h USING ({GROUP}) WHERE h.rank = main + 1),
finf AS (SELECT {GROUP}, any_value(f) AS finf FROM low JOIN win USING ({GROUP}) WHERE apart GROUP BY {GROUP} HAVING count(*) FILTER (WHERE y <= f) <= 0.4::DOUBLE * count(*)),
fsup AS (SELECT {GROUP}, any_value(f) AS fsup FROM high JOIN win USING ({GROUP}) WHERE apart GROUP BY {GROUP} HAVING count(*) FILTER (WHERE y >= f) <= 0.4::DOUBLE * count(*)),
own AS (SELECT {GROUP}, i, rank, size, center FROM pts JOIN seg USING ({GROUP}) JOIN segs USING ({GROUP}, rank) WHERE i > lo_i AND i <= hi_i),
rows_ AS (SELECT pts.*, stat.mod_zscore, g1.* EXCLUDE ({GROUP}), finf, fsup, rank, size, center,
  metodo = 'CLUSTER' AS cl, coalesce(pts.y <= finf, FALSE) AS is_low, coalesce(pts.y >= fsup, FALSE) AS is_high
  FROM pts JOIN (SELECT {GROUP}, codmes, mod_zscore FROM stat) stat USING ({GROUP}, codmes) JOIN g1 USING ({GROUP}) LEFT JOIN finf USING ({GROUP}) LEFT JOIN fsup USING ({GROUP}) LEFT JOIN own USING ({GROUP}, i)),
flag AS (SELECT *, CASE WHEN cl THEN is_low OR is_high ELSE n_meses >= 4 AND (y < li OR y > ls OR abs(mod_zscore) > 3.5) END AS es_outlier FROM rows_),
detail AS (SELECT {config.eval_month} AS codmes_val, ventana_meses, codmes, metrica, canal_dsc, flujo_dsc, objetivo_dsc, productos_dsc, dia_semana, valor_mes, suma_mes, n_dias, CAST(n_meses AS INTEGER) AS n_meses, y AS y_log,
  metodo, CASE WHEN cl THEN k ELSE 0 END AS k_elegido, CAST(CASE WHEN cl THEN rank ELSE -1 END AS INTEGER) AS cluster_id, CAST(CASE WHEN cl THEN rank ELSE -1 END AS INTEGER) AS cluster_rank,
  CASE WHEN cl THEN pow(10.0, center) END AS cluster_center, CAST(CASE WHEN cl THEN size ELSE n_meses END AS INTEGER) AS cluster_n,
  pow(10.0, p25) AS q1, pow(10.0, p50) AS mediana, pow(10.0, p75) AS q3, pow(10.0, p75) - pow(10.0, p25) AS iqr, p25 AS p25_log, p50 AS p50_log, p75 AS p75_log,
  pow(10.0, finf) AS frontera_inf_cluster, pow(10.0, fsup) AS frontera_sup_cluster, finf AS frontera_inf_log, fsup AS frontera_sup_log,
  pow(10.0, coalesce(finf, li)) AS limite_inf, pow(10.0, coalesce(fsup, ls)) AS limite_sup, pow(10.0, li) AS limite_inf_iqr, pow(10.0, ls) AS limite_sup_iqr,
  finf - p25 AS dif_inf_p25_log, fsup - p75 AS dif_sup_p75_log, abs(finf - p25) <= 0.5 AS pctl_valida_inf, abs(fsup - p75) <= 0.5 AS pctl_valida_sup, mad, mod_zscore, es_outlier,
  CASE WHEN cl THEN CASE WHEN is_high THEN 'ALTO' WHEN is_low THEN 'BAJO' END WHEN es_outlier THEN CASE WHEN y > p50 THEN 'ALTO' ELSE 'BAJO' END END AS tipo FROM flag)"""


#: Doubles are rounded in both engines before they are compared; flags are not derived from rounded values.
_WIDE = {"valor_mes", "suma_mes", "cantidad_dia", "cantidad", "q1", "mediana", "q3", "iqr", "limite_inf", "limite_sup", "limite_inf_iqr", "limite_sup_iqr", "cluster_center", "frontera_inf_cluster", "frontera_sup_cluster"}
_FINE = {"y", "y_log", "q1_y", "med_y", "q3_y", "mad", "li_y", "ls_y", "mod_zscore", "p25_log", "p50_log", "p75_log", "frontera_inf_log", "frontera_sup_log", "dif_inf_p25_log", "dif_sup_p75_log", "inertia"}


def _digits(column: str) -> int | None:
    return 3 if column in _WIDE else 6 if column in _FINE else None


def _rounded(frame: DataFrame) -> DataFrame:
    return frame.select(*[F.round(c, d).alias(c) if (d := _digits(c)) is not None else F.col(c) for c in frame.columns])


def _sql(prefix: str, columns: tuple[str, ...] | list[str], source: str) -> str:
    picked = ", ".join(f"round({c}, {d}) AS {c}" if (d := _digits(c)) is not None else c for c in columns)
    return f"WITH {prefix} SELECT {picked} FROM {source}"


DIM = ("canal_dsc", "flujo_dsc", "productos_dsc", "objetivo_dsc")
MONTH = ("metrica", *DIM, "dia_semana", "codmes")
KEY = (*MONTH, "ventana_meses")
_ALL_MONTHS = f"{SRC}, {_long(BASE, False)}, {DAILY}, {MONTHLY}"
_DISCRETE = f"{_windowed(BASE)}, {_statistics('disc')}"
_CONT = f"{_windowed(BASE)}, {_statistics('cont')}"

Query = Callable[[SparkSession, str], DataFrame]


def _source(name: str, columns: tuple[str, ...], build: Callable[[DataFrame], DataFrame], prefix: str, source: str) -> tuple[str, Query, str]:
    return name, lambda spark, sf: _rounded(build(wide_source(spark, sf)).select(*columns)), _sql(prefix, columns, source)


def _discrete(src: DataFrame) -> DataFrame:
    return fences.statistics(pipelines.windowed(src, BASE), BASE)


def _interpolated(src: DataFrame) -> DataFrame:
    return fences.fences(fences.statistics(pipelines.windowed(src, BASE), BASE, interpolated=True), BASE)


def _fence_report(src: DataFrame) -> DataFrame:
    return pipelines.fence_outliers(src, BASE)


def _detail(src: DataFrame) -> DataFrame:
    return reports.layout(pipelines.cluster_detail(src, CLUSTER), CLUSTER, reports.DETAIL_COLUMNS)


def _groups(src: DataFrame) -> DataFrame:
    return pipelines.series_segments(pipelines.monthly_series(src, CLUSTER), CLUSTER)


def _curve(src: DataFrame) -> DataFrame:
    return _groups(src).select(*CLUSTER.cell, "ventana_meses", F.posexplode("inertias").alias("k0", "inertia")).withColumn("k", (F.col("k0") + 1).cast("int"))


def _decided(src: DataFrame) -> DataFrame:
    return pipelines.cluster_detail(src, CLUSTER)


def _principal(src: DataFrame) -> DataFrame:
    groups = decide.principal(decide.route(decide.group_statistics(_groups(src), CLUSTER), CLUSTER)).where("main is not null")
    return groups.select(*CLUSTER.cell, "ventana_meses", F.col("main.rank").cast("int").alias("principal"), F.col("main.n").cast("int").alias("tamano"))


_PROBE = {"productos_dsc": "r", "flujo_dsc": "high", "canal_dsc": "build", "objetivo_dsc": "sin"}
_PROBE_SQL = "metrica = 'ORDERED' AND dia_semana = 1 AND codmes % 100 = 1 AND contains(upper(productos_dsc), 'R') AND contains(upper(flujo_dsc), 'HIGH') AND contains(upper(canal_dsc), 'BUILD') AND contains(upper(objetivo_dsc), 'SIN')"
_DECIDED = _decisions(CLUSTER)
_COMBOS = "count(DISTINCT (metrica, canal_dsc, flujo_dsc, objetivo_dsc, productos_dsc, dia_semana))"
_LABEL = "['Lun', 'Mar', 'Mie', 'Jue', 'Vie', 'Sab', 'Dom'][dia_semana] AS dia_semana_dsc"
_FENCED = f"{_DISCRETE}, report AS (SELECT {EVAL_MONTH} AS codmes_val, {_LABEL}, * FROM fence WHERE es_outlier)"
_FLAGGED = f"{_DECIDED}, flagged AS (SELECT {_LABEL}, * FROM detail WHERE es_outlier)"
EARLIER = replace(CLUSTER, eval_month=199912)
_FLAGGED_EARLIER = f"{_decisions(EARLIER)}, flagged AS (SELECT {_LABEL}, * FROM detail WHERE es_outlier)"
_CELL_COLUMNS = (*CLUSTER.cell, "ventana_meses")

#: Tables that an earlier call of a query has written, by application and name.
_PLACED: dict[tuple[str, str], str] = {}


def _place(spark: SparkSession, name: str) -> tuple[str, str]:
    """A new table's name and its folder, in the folder that driver and executors share (a local one where none is set, on one machine)."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="tidewatch-")
    own = f"{name}_{uuid.uuid4().hex[:12]}"
    # the table of the call before goes now, the last one's files with the application
    at = (spark.sparkContext.applicationId, name)
    if at in _PLACED:
        sinks.drop_table(spark, _PLACED[at])
    _PLACED[at] = own
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{shared}/{own}")
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return own, f"{shared}/{own}"


def _replaced(spark: SparkSession, sf: str) -> DataFrame:
    """The base run into a table, twice; what the table holds."""
    table, path = _place(spark, "flagged_base")
    for _ in range(2):
        pipelines.run_fences(wide_source(spark, sf), BASE, table, path)
    return spark.table(table)


def _accumulated(spark: SparkSession, sf: str) -> tuple[str, str]:
    """Cluster runs of two months into tables, the later one twice; names of the tables."""
    (table, path), (detail, detail_path) = _place(spark, "flagged"), _place(spark, "detail")
    source = wide_source(spark, sf)
    for config in (EARLIER, CLUSTER, CLUSTER):
        pipelines.run_clusters(source, config, table, detail, path, detail_path)
    return table, detail


def _sink_layout(spark: SparkSession, sf: str) -> DataFrame:
    table, path = _place(spark, "layout")
    rows = pipelines.fence_outliers(wide_source(spark, sf), BASE)
    before = sinks.table_exists(spark, table)
    done = [sinks.accumulate(rows, table, [(EVAL_MONTH, w) for w in BASE.windows], path) for _ in range(2)]
    said = {"existed": before, "exists": sinks.table_exists(spark, table), "first": done[0], "second": done[1], "partitions": ",".join(sinks.partition_columns(spark, table)), "last_columns": ",".join(spark.table(table).columns[-2:])}
    return spark.table(table).groupBy("codmes_val", "ventana_meses").agg(F.count(F.lit(1)).alias("n")).withColumns({c: F.lit(v) for c, v in said.items()})


def _maintained(spark: SparkSession, sf: str) -> str:
    """A store of daily totals: first all but the late rows, then those, then the same batch once more; its name."""
    table, path = _place(spark, "daily")
    source = wide_source(spark, sf)
    late = (F.col("fecha_pedido") >= F.lit("1999-10-05").cast("date")) & (F.col("cantidad_pedida") % 5 == 0)
    late = F.coalesce(late, F.lit(False))
    daily_store.add(source.where(~late), BASE, table, "history", path)
    for _ in range(2):
        daily_store.add(source.where(late), BASE, table, "late", path)
    return table


def _bands_of_two_months(spark: SparkSession, sf: str) -> DataFrame:
    """The anti-join over the tables of two evaluation months; each month is cleaned of its own outliers alone."""
    flagged, detail = _accumulated(spark, sf)
    return _rounded(reports.stored_clean_months(spark, detail, flagged).select("codmes_val", *KEY, "valor_mes"))


def _migrated(spark: SparkSession, sf: str) -> DataFrame:
    """A table of the layout before (by window only) with one month in it, taken over by the run of the next month."""
    table, path = _place(spark, "migrated")
    source = wide_source(spark, sf)
    pipelines.cluster_outliers(pipelines.cluster_detail(source, EARLIER), EARLIER).write.partitionBy("ventana_meses").format("parquet").option("path", f"{path}/before").saveAsTable(table)
    pipelines.run_clusters(source, CLUSTER, table, None, f"{path}/versions", migrate=True)
    spark.sql(f"DROP TABLE {table}__before_0")
    return _rounded(spark.table(table).select(*reports.CLUSTER_COLUMNS))


def _merged_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and different series by evaluation month, merged from bitmaps by month, window and method."""
    flagged = spark.table(_accumulated(spark, sf)[0])
    numbers = counts.number_series(flagged, _place(spark, "series")[1])
    return counts.summary(counts.partials(flagged, numbers, ("codmes_val", "ventana_meses", "metodo")), ("codmes_val",))


_BAD = "cantidad_pedida = 13 AND descuento = 4"
_DIMS = "dims AS (SELECT coalesce(nullif(canal_dsc, ''), 'SIN CANAL') AS canal_dsc, coalesce(nullif(flujo_dsc, ''), 'SIN FLUJO') AS flujo_dsc, coalesce(nullif(productos_dsc, ''), 'SIN PRODUCTO') AS productos_dsc, coalesce(nullif(objetivos_dsc, ''), 'SIN OBJETIVO') AS objetivo_dsc, * EXCLUDE (canal_dsc, flujo_dsc, productos_dsc) FROM src)"
PLAIN = replace(BASE, log_scale=False)
_LINEAR = f"{_windowed(BASE)}, {_statistics('disc')}".replace("log10(greatest(valor_mes, 1e-9)) AS y", "valor_mes AS y").replace("pow(10.0, ", "(")
_WRITTEN = "CAST(CAST(cantidad_pedida AS BIGINT) AS VARCHAR) || ' pcs'"


def _written_source(spark: SparkSession, sf: str) -> DataFrame:
    """The wide source with quantities as text, some of which are no numbers."""
    bad = (F.col("cantidad_pedida") == 13) & (F.col("descuento") == 4)
    whole = F.col("cantidad_pedida").cast("bigint").cast("string")
    return wide_source(spark, sf).withColumn("cantidad_pedida", F.when(bad, F.concat(whole, F.lit(" pcs"))).otherwise(F.col("cantidad_pedida").cast("string")))


def _bands_of_stored(spark: SparkSession, sf: str) -> DataFrame:
    """Both sides of the anti-join from one stored detail, as a consumer of the tables has them."""
    table, path = _place(spark, "fence_detail")
    sinks.replace_table(fences.fences(_discrete(wide_source(spark, sf)), BASE), table, path)
    detail = spark.table(table)
    return _rounded(reports.clean_months(detail, reports.outliers_only(detail)).select(*KEY, "valor_mes"))


def _both_months(columns: Sequence[str], flagged: bool) -> str:
    source = "flagged" if flagged else "detail"
    return " UNION ALL ".join(f"(SELECT * FROM ({_sql(prefix, columns, source)}))" for prefix in (_FLAGGED_EARLIER, _FLAGGED))


CATALOGUE: list[tuple[str, Query, str]] = [
    ("presence_filter", lambda spark, sf: wide_source(spark, sf).select(*[F.count(F.when(facts.present(m), 1)).alias(m.name.lower()) for m in METRICS]), f"WITH {SRC} SELECT " + ", ".join(f"count(*) FILTER (WHERE {m.date_col} IS NOT NULL AND {m.value_col} > 0) AS {m.name.lower()}" for m in METRICS) + " FROM src"),
    _source("unpivot_metrics", ("metrica", "fecha_dt", *DIM, "cantidad"), lambda s: facts.long_facts(s, BASE, in_window=False), f"{SRC}, {_long(BASE, False)}", "facts"),
    _source("source_filter", ("metrica", "fecha_dt", *DIM, "cantidad"), lambda s: facts.long_facts(s, BASE), f"{SRC}, {_long(BASE, True)}", "facts"),
    ("normalize_dims", lambda spark, sf: facts.long_facts(wide_source(spark, sf), BASE, in_window=False).groupBy(*DIM).agg(F.count(F.lit(1)).alias("n")), f"WITH {SRC}, {_long(BASE, False)} SELECT {DIMS}, count(*) AS n FROM facts GROUP BY ALL"),
    ("iso_weekday", lambda spark, sf: spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", iso_weekday("o_orderdate").alias("dia_semana")), "SELECT o_orderkey, CAST(isodow(o_orderdate) AS INTEGER) AS dia_semana FROM orders"),
    ("weekday_label", lambda spark, sf: spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", weekday_label(iso_weekday("o_orderdate")).alias("dia_semana_dsc")), f"SELECT o_orderkey, {_LABEL} FROM (SELECT o_orderkey, isodow(o_orderdate) AS dia_semana FROM orders)"),
    ("month_index", lambda spark, sf: spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", month_code("o_orderdate").alias("codmes"), month_index("o_orderdate").alias("mes_idx")), "SELECT o_orderkey, CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS codmes, CAST(year(o_orderdate) * 12 + month(o_orderdate) AS INTEGER) AS mes_idx FROM orders"),
    _source("daily_total", (*BASE.cell, "fecha_dt", "cantidad_dia"), lambda s: rollup.daily(facts.long_facts(s, BASE, in_window=False), BASE), f"{SRC}, {_long(BASE, False)}, {DAILY}", "days"),
    _source("monthly_value", (*MONTH, "mes_idx", "valor_mes", "suma_mes", "n_dias"), lambda s: rollup.monthly(rollup.daily(facts.long_facts(s, BASE, in_window=False), BASE), BASE), _ALL_MONTHS, "months"),
    _source("lookback_filter", (*MONTH, "dif_meses", "valor_mes"), lambda s: pipelines.monthly_series(s, BASE), _windowed(BASE), "back"),
    _source("explode_windows", (*KEY, "dif_meses", "valor_mes"), lambda s: rollup.explode_windows(pipelines.monthly_series(s, BASE), BASE), _windowed(BASE), "win"),
    _source("log_scale", (*KEY, "y"), lambda s: pipelines.windowed(s, BASE), _windowed(BASE), "win"),
    _source("quartiles_discrete", (*KEY, "n_meses", "q1_y", "med_y", "q3_y"), _discrete, _DISCRETE, "stat"),
    _source("mad_discrete", (*KEY, "mad"), _discrete, _DISCRETE, "stat"),
    _source("quartiles_interpolated", (*KEY, "n_meses", "q1_y", "med_y", "q3_y"), _interpolated, _CONT, "stat"),
    _source("mad_interpolated", (*KEY, "mad"), _interpolated, _CONT, "stat"),
    _source("tukey_fence", (*KEY, "li_y", "ls_y"), lambda s: fences.fences(_discrete(s), BASE), _DISCRETE, "stat"),
    _source("modified_zscore", (*KEY, "mod_zscore"), lambda s: fences.fences(_discrete(s), BASE), _DISCRETE, "stat"),
    _source("fence_verdict", (*KEY, "es_outlier", "tipo"), lambda s: fences.fences(_discrete(s), BASE), _DISCRETE, "fence"),
    _source("fence_fallback", (*KEY, "es_outlier", "tipo"), _interpolated, _CONT, "fence"),
    _source("fence_outliers", ("codmes_val", *KEY, "tipo", "valor_mes", "n_meses", "limite_inf", "limite_sup"), _fence_report, _FENCED, "report"),
    _source("fence_report_23", reports.FENCE_COLUMNS, _fence_report, _FENCED, "report"),
    ("fence_summary", lambda spark, sf: reports.summary(_fence_report(wide_source(spark, sf))), f"WITH {_FENCED} SELECT ventana_meses, count(*) AS n_outliers, {_COMBOS} AS combinaciones_afectadas FROM report GROUP BY ALL"),
    _source("segment_inertia", (*_CELL_COLUMNS, "k", "inertia"), _curve, _segments(CLUSTER), "(SELECT * EXCLUDE (k, c), CAST(k AS INTEGER) AS k, c AS inertia FROM curve)"),
    _source("elbow_k", (*_CELL_COLUMNS, "k"), _groups, _segments(CLUSTER), "chosen"),
    _source("segment_labels", (*KEY, "k_elegido", "cluster_id", "cluster_rank", "cluster_n", "cluster_center"), _decided, _DECIDED, "detail"),
    _source("principal_cluster", (*_CELL_COLUMNS, "principal", "tamano"), _principal, _DECIDED, f"(SELECT {GROUP}, CAST(main AS INTEGER) AS principal, size AS tamano FROM main JOIN segs USING ({GROUP}) WHERE rank = main)"),
    _source("method_router", (*KEY, "metodo", "n_meses"), _decided, _DECIDED, "detail"),
    _source("isolation_low", (*KEY, "frontera_inf_log"), lambda s: _decided(s).where("finf is not null"), _DECIDED, "detail WHERE frontera_inf_log IS NOT NULL"),
    _source("isolation_high", (*KEY, "frontera_sup_log"), lambda s: _decided(s).where("fsup is not null"), _DECIDED, "detail WHERE frontera_sup_log IS NOT NULL"),
    _source("reported_limits", (*KEY, "limite_inf", "limite_sup", "limite_inf_iqr", "limite_sup_iqr"), _decided, _DECIDED, "detail"),
    _source("percentile_validation", (*KEY, "dif_inf_p25_log", "dif_sup_p75_log", "pctl_valida_inf", "pctl_valida_sup"), _decided, _DECIDED, "detail"),
    _source("cluster_detail_43", reports.DETAIL_COLUMNS, _detail, _DECIDED, "detail"),
    _source("cluster_outliers_38", reports.CLUSTER_COLUMNS, lambda s: pipelines.cluster_outliers(_decided(s), CLUSTER), _FLAGGED, "flagged"),
    ("method_summary", lambda spark, sf: reports.summary(reports.outliers_only(_decided(wide_source(spark, sf))), ("ventana_meses", "metodo")), f"WITH {_DECIDED} SELECT ventana_meses, metodo, count(*) AS n_outliers, {_COMBOS} AS combinaciones_afectadas FROM detail WHERE es_outlier GROUP BY ALL"),
    ("anti_join_bands", _bands_of_stored, _sql(_DISCRETE, (*KEY, "valor_mes"), "fence WHERE NOT es_outlier")),
    ("acceptance_probe", lambda spark, sf: _rounded(reports.probe(_decided(wide_source(spark, sf)), "ORDERED", 1, 1, _PROBE)), _sql(_DECIDED, ["ventana_meses", "codmes", "valor_mes", "metodo", "k_elegido", "cluster_rank", "cluster_n", "frontera_inf_cluster", "limite_inf", "limite_inf_iqr", "es_outlier", "tipo"], f"detail WHERE {_PROBE_SQL}")),
    ("stored_months", lambda spark, sf: reports.stored_months(spark.table(_accumulated(spark, sf)[0])), f"SELECT codmes_val, count(*) AS n_filas, {_COMBOS} AS combinaciones FROM ({_both_months(reports.CLUSTER_COLUMNS, True)}) GROUP BY ALL"),
    ("sink_replaced_23", lambda spark, sf: _rounded(_replaced(spark, sf).select(*reports.FENCE_COLUMNS)), _sql(_FENCED, reports.FENCE_COLUMNS, "report")),
    ("sink_accumulated_38", lambda spark, sf: _rounded(spark.table(_accumulated(spark, sf)[0]).select(*reports.CLUSTER_COLUMNS)), _both_months(reports.CLUSTER_COLUMNS, True)),
    ("sink_detail_43", lambda spark, sf: _rounded(spark.table(_accumulated(spark, sf)[1]).select(*reports.DETAIL_COLUMNS)), _both_months(reports.DETAIL_COLUMNS, False)),
    ("sink_layout", _sink_layout, f"WITH {_FENCED} SELECT codmes_val, ventana_meses, count(*) AS n, FALSE AS existed, TRUE AS exists, 'created' AS first, 'updated' AS second, 'codmes_val,ventana_meses' AS partitions, 'codmes_val,ventana_meses' AS last_columns FROM report GROUP BY ALL"),
    ("maintained_daily", lambda spark, sf: _rounded(daily_store.days(spark, _maintained(spark, sf), BASE, in_window=False)), _sql(f"{SRC}, {_long(BASE, False)}, {DAILY}", (*BASE.cell, "fecha_dt", "cantidad_dia"), "days")),
    ("maintained_report_23", lambda spark, sf: _rounded(pipelines.fence_outliers(None, BASE, pipelines.stored_series(spark, _maintained(spark, sf), BASE))), _sql(_FENCED, reports.FENCE_COLUMNS, "report")),
    _source("grouped_detail_43", reports.DETAIL_COLUMNS, lambda s: reports.layout(grouped.decide(pipelines.monthly_series(s, CLUSTER), CLUSTER), CLUSTER, reports.DETAIL_COLUMNS), _DECIDED, "detail"),
    ("bands_of_two_months", _bands_of_two_months, " UNION ALL ".join(f"(SELECT * FROM ({_sql(prefix, ('codmes_val', *KEY, 'valor_mes'), 'detail WHERE NOT es_outlier')}))" for prefix in (_decisions(EARLIER), _DECIDED))),
    ("migrated_history", _migrated, _both_months(reports.CLUSTER_COLUMNS, True)),
    ("merged_series_counts", _merged_counts, f"SELECT codmes_val, count(*) AS n_outliers, {_COMBOS} AS combinaciones_afectadas FROM ({_both_months(reports.CLUSTER_COLUMNS, True)}) GROUP BY ALL"),
    ("quarantined_values", lambda spark, sf: facts.parsed(_written_source(spark, sf), BASE)[1], f"WITH {SRC}, {_DIMS} SELECT 'ORDERED' AS metrica, {DIMS}, strftime(fecha_pedido, '%Y-%m-%d %H:%M:%S') AS fecha, {_WRITTEN} AS valor, 'valor' AS motivo FROM dims WHERE fecha_pedido IS NOT NULL AND {_BAD}"),
    ("daily_without_quarantined", lambda spark, sf: _rounded(rollup.daily(facts.long_facts(facts.parsed(_written_source(spark, sf), BASE)[0], BASE, in_window=False), BASE)), _sql(f"{SRC.replace('src AS', 'every AS')}, src AS (SELECT * REPLACE (CASE WHEN {_BAD} THEN NULL ELSE cantidad_pedida END AS cantidad_pedida) FROM every), {_long(BASE, False)}, {DAILY}", (*BASE.cell, "fecha_dt", "cantidad_dia"), "days")),
    _source("linear_scale", (*KEY, "li_y", "ls_y", "limite_inf", "limite_sup", "es_outlier", "tipo"), lambda s: pipelines.fence_detail(s, PLAIN), _LINEAR, "fence"),
]


def queries() -> dict[str, Query]:
    return {name: query for name, query, _ in CATALOGUE}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, _, sql in CATALOGUE}
