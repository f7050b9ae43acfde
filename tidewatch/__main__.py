"""python -m tidewatch: one run of the detector over a table, with its summaries printed."""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import date

from pyspark.sql import SparkSession

from tidewatch.config import BASE_WINDOWS, CLUSTER_WINDOWS, DetectorConfig, previous_month
from tidewatch.operators import reports
from tidewatch.plans import pipelines
from tidewatch.sources import daily_store
from tidewatch.sources.facts import read_source


def arguments(given: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tidewatch", description=__doc__)
    parser.add_argument("kind", choices=("fences", "clusters", "daily"), help="fences replaces its table, clusters accumulates months in its tables, daily takes a batch of rows into maintained daily totals")
    parser.add_argument("--source", help="wide fact table (daily: the rows of the batch)")
    parser.add_argument("--daily", help="table of maintained daily totals, to read in place of --source (daily: to keep up to date)")
    parser.add_argument("--batch", help="name of the batch; one that was taken in before changes nothing (daily only)")
    parser.add_argument("--table", help="table of flagged months")
    parser.add_argument("--detail", help="table of all months (clusters only)")
    parser.add_argument("--path", help="folder of --table")
    parser.add_argument("--detail-path", help="folder of --detail")
    parser.add_argument("--month", default="previous", help="evaluation month as yyyymm, or previous: the calendar month before today")
    parser.add_argument("--windows", help="look-back windows in months, comma-separated")
    parser.add_argument("--list", type=int, default=0, help="print so many flagged months, in reading order")
    parser.add_argument("--migrate", action="store_true", help="take over a plain table of another layout, with its rows (clusters only)")
    out = parser.parse_args(given)
    need = {"daily": ("source", "daily", "batch")}.get(out.kind, ("table",))
    if missing := [f"--{n}" for n in need if not getattr(out, n)] or ([] if out.source or out.daily else ["--source or --daily"]):
        parser.error(f"{out.kind} needs {', '.join(missing)}")
    return out


def run(spark: SparkSession, given: argparse.Namespace, today: date | None = None, **settings) -> None:
    """Runs and prints; ``settings`` are further fields of the configuration."""
    windows = tuple(map(int, given.windows.split(","))) if given.windows else BASE_WINDOWS if given.kind == "fences" else CLUSTER_WINDOWS
    month = previous_month(today or date.today()) if given.month == "previous" else int(given.month)
    config = DetectorConfig(eval_month=month, windows=windows, **settings)
    source = read_source(spark, given.source) if given.source else None
    if given.kind == "daily":
        months = daily_store.add(source, config, given.daily, given.batch, given.path)
        print(f"Months written anew: {', '.join(map(str, months)) or 'none'}")
        return
    series = pipelines.stored_series(spark, given.daily, config) if given.daily else pipelines.monthly_series(source, config)
    if given.kind == "fences":
        print("Flagged months by window")
        pipelines.run_fences(source, config, given.table, given.path, series).show(truncate=False)
        print(f"Replaced {given.table}")
        if given.list:
            reports.ordered(spark.table(given.table)).show(given.list, truncate=False)
        return
    print("Flagged months by window and method")
    pipelines.run_clusters(source, config, given.table, given.detail, given.path, given.detail_path, series, given.migrate).show(truncate=False)
    if given.list:
        reports.ordered(spark.table(given.table).where(f"codmes_val = {month}")).show(given.list, truncate=False)
    print("Acceptance case: " + ", ".join(map(str, reports.ACCEPTANCE[:3])) + ", " + ", ".join(reports.ACCEPTANCE[3].values()))
    detail = spark.table(given.detail).where(f"codmes_val = {month}") if given.detail else pipelines.cluster_detail(source, config, series)
    reports.probe(detail, *reports.ACCEPTANCE).show(truncate=False)
    print(f"Month {month} is in " + " and ".join(filter(None, (given.table, given.detail))))
    print("Stored months")
    reports.stored_months(spark.table(given.table)).show(truncate=False)


if __name__ == "__main__":
    run(SparkSession.builder.enableHiveSupport().getOrCreate(), arguments())
