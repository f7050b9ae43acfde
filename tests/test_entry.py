"""The catalogue against DuckDB on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tidewatch.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "isoformat"):
        return str(v)[:10]
    return repr(float(v)) if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", ["presence_filter", "normalize_dims", "weekday_label", "monthly_value", "explode_windows", "fence_report_23", "fence_fallback", "elbow_k", "cluster_detail_43", "method_summary", "anti_join_bands", "stored_months", "sink_replaced_23", "sink_accumulated_38", "sink_layout", "maintained_daily", "maintained_report_23", "grouped_detail_43", "bands_of_two_months", "migrated_history", "merged_series_counts", "quarantined_values", "daily_without_quarantined"])
def test_query_equals_sql(spark, duck, name):
    df = catalog.queries()[name](spark, SF)
    found = duck.execute(catalog.oracle_sql()[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == sorted(df.columns)
    theirs = sorted(str([plain(r[names.index(c)]) for c in df.columns]) for r in found.fetchall())
    assert sorted(str([plain(v) for v in r]) for r in df.collect()) == theirs


def test_every_catalogue_query_has_sql():
    assert set(catalog.queries()) == set(catalog.oracle_sql()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
