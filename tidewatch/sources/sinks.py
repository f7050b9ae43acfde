"""Partitioned Parquet tables: replaced as a whole, or accumulated month by month, in one step each."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession

from tidewatch.sources import versions

PARTITIONS = ("codmes_val", "ventana_meses")


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    """Partition columns of a table, in order."""
    if versions.is_published(spark, table):
        return versions.partition_columns(spark, table)
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def partitions_last(frame: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """The same columns, partition columns at the end."""
    named = {p.lower() for p in partitions}
    return frame.select(*[c for c in frame.columns if c.lower() not in named], *partitions)


def _retired(spark: SparkSession, table: str) -> str:
    """Gives a plain table another name, under which it stays until somebody drops it."""
    n = 0
    while spark.catalog.tableExists(f"{table}__before_{n}"):
        n += 1
    spark.sql(f"ALTER TABLE {table} RENAME TO {table.rsplit('.', 1)[-1]}__before_{n}" if "." not in table else f"ALTER TABLE {table} RENAME TO {table}__before_{n}")
    return f"{table}__before_{n}"


def replace_table(frame: DataFrame, table: str, path: str | None = None, partitions: Sequence[str] = ("ventana_meses",), order: Sequence[str] = (), buckets: int = 0, by: Sequence[str] = ()) -> None:
    """Replaces the rows of ``table``; rows are sorted within files, no global sort.

    The old rows can be read until the new ones are whole.  A plain table of that
    name is kept under another one.
    """
    spark = frame.sparkSession
    if versions.is_published(spark, table) and partition_columns(spark, table) != list(partitions):
        raise ValueError(f"{table} is partitioned by {partition_columns(spark, table)}, not by {list(partitions)}; drop_table it first")
    versions.sweep(spark, table)
    version, found = versions.write(partitions_last(frame, partitions), table, path, partitions, order, buckets, by)
    if table_exists(spark, table) and not versions.is_published(spark, table):
        _retired(spark, table)
    versions.switch(spark, table, dict.fromkeys(found, version))


def accumulate(frame: DataFrame, table: str, targets: Iterable[Sequence[int]], path: str | None = None, partitions: Sequence[str] = PARTITIONS, migrate: bool = False, order: Sequence[str] = (), buckets: int = 0, by: Sequence[str] = ()) -> str:
    """Writes the partitions of one run, keeps all others; returns what was done.

    ``targets`` are the partitions that the run stands for, (month, window) each.
    Those that ``frame`` has no rows for are emptied, so a second run with fewer
    rows or windows leaves nothing stale.  All partitions of the run are written by
    one job and take the place of the old ones in one step: a run that fails leaves
    the table as it was.  A plain table with another layout is only taken over when
    ``migrate`` says so: its rows are written in the new layout first, and it stays
    under another name.
    """
    spark, moved = frame.sparkSession, {}
    there, ours = table_exists(spark, table), versions.is_published(spark, table)
    if there and [c.lower() for c in partition_columns(spark, table)] != [p.lower() for p in partitions] and (ours or not migrate):
        raise ValueError(f"{table} is partitioned by {partition_columns(spark, table)}, not by {list(partitions)}; pass migrate=True to take a plain table over")
    versions.sweep(spark, table)
    if there and not ours:
        moved = _take_over(frame, table, path, partitions, order, buckets, by)
    version, found = versions.write(partitions_last(frame, partitions), table, path, partitions, order, buckets, by)
    if there and not ours:
        _retired(spark, table)
    now = {**(moved or versions.live(spark, table))}
    for values in map(tuple, targets):
        now.pop(values, None)
    versions.switch(spark, table, now | dict.fromkeys(found, version))
    return "updated" if ours else "migrated" if there else "created"


def _take_over(frame: DataFrame, table: str, path: str | None, partitions: Sequence[str], order: Sequence[str], buckets: int, by: Sequence[str]) -> dict[versions.Values, str]:
    """Writes the rows of a plain table in the new layout; the live versions that they make."""
    old = frame.sparkSession.table(table)
    lacking = {c.lower() for c in frame.columns} - {c.lower() for c in old.columns}
    if lacking:
        raise ValueError(f"{table} cannot be taken over, it lacks {sorted(lacking)}")
    version, found = versions.write(partitions_last(old.select(*frame.columns), partitions), table, path, partitions, order, buckets, by)
    return dict.fromkeys(found, version)


def drop_table(spark: SparkSession, table: str) -> None:
    """Removes a table with its rows."""
    if versions.is_published(spark, table):
        versions.drop(spark, table)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
