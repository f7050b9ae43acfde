"""Tables that change in one step.

What readers know by name is a view over a store table, in which rows lie by the
readers' partitions and by version.  A run writes its rows under a version of its
own, which no reader sees; then one ``CREATE OR REPLACE VIEW`` names the live
version of each partition anew.  A run that fails before that has changed nothing,
for however many partitions it stands.  The view's condition is one of partition
columns only, so readers list and read live folders alone.

Versions that are no longer live are removed when the next run begins, so readers
who began before a switch can end.  One writer at a time: of two that switch at
once, the later one wins.  Facts that must change together with the rows (batches
taken in, for one) are kept as properties of the view.
"""

from __future__ import annotations

import json
import urllib.parse
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VERSION = "version"
Values = tuple[int | str, ...]


def store_name(table: str) -> str:
    """The table that holds all versions of ``table``."""
    return f"{table}__versions"


def is_published(spark: SparkSession, table: str) -> bool:
    """Whether ``table`` is a view of this module (a plain table is not)."""
    return spark.catalog.tableExists(table) and spark.catalog.tableExists(store_name(table)) and spark.catalog.getTable(table).tableType == "VIEW"


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    """The readers' partition columns of a published table, in order."""
    return [c.name for c in spark.catalog.listColumns(store_name(table)) if c.isPartition and c.name != VERSION]


def properties(spark: SparkSession, table: str) -> dict[str, str]:
    """What was published together with the rows."""
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").collect() if is_published(spark, table) else []
    return {r.key: r.value for r in rows if r.key.startswith("tidewatch.")}


def live(spark: SparkSession, table: str) -> dict[Values, str]:
    """The live version of each partition; empty where there is no such table."""
    found = json.loads(properties(spark, table).get("tidewatch.live", "{}"))
    return {tuple(values): version for version, many in found.items() for values in many}


def _stored(spark: SparkSession, table: str, version: str | None = None) -> list[tuple[Values, str, str]]:
    """Partitions of the store (of one version): values, version and folder."""
    part = f" PARTITION ({VERSION} = '{version}')" if version else ""
    kinds = {f.name: f.dataType.simpleString() for f in spark.table(store_name(table)).schema}
    out = []
    for row in spark.sql(f"SHOW PARTITIONS {store_name(table)}{part}").collect():
        named = {c: urllib.parse.unquote(v) for c, v in (x.split("=", 1) for x in row[0].split("/"))}
        own = named.pop(VERSION)
        out.append((tuple(v if kinds[c] == "string" else int(v) for c, v in named.items()), own, row[0]))
    return out


def write(frame: DataFrame, table: str, path: str | None, partitions: Sequence[str], order: Sequence[str] = (), buckets: int = 0, by: Sequence[str] = ()) -> tuple[str, list[Values]]:
    """Writes rows under a new version, in one job; returns it and the partitions that it has rows for.

    With ``buckets``, files of each partition are dealt by the columns ``by``, so
    joins on them need no exchange.
    """
    version = uuid.uuid4().hex[:16]
    rows = frame.sortWithinPartitions(*order) if order and not buckets else frame
    writer = rows.withColumn(VERSION, F.lit(version)).write.mode("append").format("parquet").partitionBy(*partitions, VERSION)
    if buckets:
        named = {p.lower() for p in partitions}
        writer = writer.bucketBy(buckets, *by).sortBy(*([c for c in order if c.lower() not in named] or by))
    (writer.option("path", path) if path else writer).saveAsTable(store_name(table))
    return version, [values for values, *_ in _stored(frame.sparkSession, table, version)]


def _literal(value: int | str) -> str:
    return str(value) if isinstance(value, int) else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def switch(spark: SparkSession, table: str, versions: Mapping[Values, str], facts: Mapping[str, str] | None = None) -> None:
    """Makes ``versions`` the live ones (partitions that are not among them are empty), and ``facts`` the table's properties."""
    names = partition_columns(spark, table)
    columns = [c for c in spark.table(store_name(table)).columns if c not in (*names, VERSION)] + names
    by_version: dict[str, list[Values]] = {}
    for values, version in sorted(versions.items()):
        by_version.setdefault(version, []).append(values)
    of = lambda values: " AND ".join(f"`{c}` = {_literal(v)}" for c, v in zip(names, values, strict=True))
    hits = [f"{VERSION} = '{version}' AND ({' OR '.join(f'({of(v)})' for v in many)})" for version, many in by_version.items()]
    kept = {**(facts or {}), "tidewatch.live": json.dumps(by_version)}
    said = ", ".join(f"{_literal(k)} = {_literal(v)}" for k, v in kept.items())
    spark.sql(f"CREATE OR REPLACE VIEW {table} TBLPROPERTIES ({said}) AS SELECT {', '.join(f'`{c}`' for c in columns)} FROM {store_name(table)} WHERE {' OR '.join(f'({h})' for h in hits) or 'FALSE'}")


def rows_of(spark: SparkSession, table: str, version: str) -> DataFrame:
    """Rows of one version, published or not."""
    return spark.table(store_name(table)).where(F.col(VERSION) == version).drop(VERSION)


def sweep(spark: SparkSession, table: str, keep: Sequence[str] = ()) -> int:
    """Removes versions that are neither live nor among ``keep``; returns how many partitions went."""
    if not spark.catalog.tableExists(store_name(table)):
        return 0
    now = set(live(spark, table).items())
    gone = [x for x in _stored(spark, table) if x[:2] not in now and x[1] not in keep]
    if not gone:
        return 0
    names = partition_columns(spark, table)
    location = spark.sql(f"DESCRIBE FORMATTED {store_name(table)}").where("col_name = 'Location'").first().data_type
    specs = [{**dict(zip(names, values, strict=True)), VERSION: version} for values, version, _ in gone]
    spark.sql(f"ALTER TABLE {store_name(table)} DROP IF EXISTS " + ", ".join("PARTITION (" + ", ".join(f"`{c}` = {_literal(v)}" for c, v in s.items()) + ")" for s in specs))
    for *_, folder in gone:  # an external table's files stay when its partition is dropped
        _delete(spark, f"{location}/{folder}")
    return len(gone)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop(spark: SparkSession, table: str) -> None:
    """Removes a published table with all its versions and files."""
    if spark.catalog.tableExists(store_name(table)):
        location = spark.sql(f"DESCRIBE FORMATTED {store_name(table)}").where("col_name = 'Location'").first().data_type
        spark.sql(f"DROP VIEW IF EXISTS {table}")
        spark.sql(f"DROP TABLE {store_name(table)}")
        _delete(spark, location)
