from datetime import datetime, timezone

from tidewatch.streaming.monthly import closed_months, daily_totals, end_of_month, for_each_closed_batch, run_closed_months


def test_final_days_reach_the_batch_run(spark, tmp_path):
    source = str(tmp_path / "in")
    rows = [("a", datetime(2025, 1, 1, 5), 1.0), ("a", datetime(2025, 1, 1, 9), 2.0), ("b", datetime(2025, 1, 2), 4.0), ("a", datetime(2025, 2, 1), 8.0)]
    schema = "k string, t timestamp, v double"
    spark.createDataFrame(rows, schema).write.parquet(source)
    got = []
    stream = daily_totals(spark.readStream.schema(schema).parquet(source), "t", "v", ("k",))
    for_each_closed_batch(stream, lambda days, _: got.extend(tuple(r) for r in days.collect()), str(tmp_path / "c")).awaitTermination(120)
    assert sorted((k, str(d), v, n) for k, d, v, n in got) == [("a", "2025-01-01", 3.0, 2), ("b", "2025-01-02", 4.0, 1)]


def test_each_month_is_announced_once_and_late_rows_name_theirs(spark, tmp_path):
    source, schema = str(tmp_path / "in"), "k string, t timestamp, v double"
    steps = [
        [("a", datetime(2025, 1, 5)), ("b", datetime(2025, 1, 30)), ("c", datetime(2024, 12, 31))],
        [("a", datetime(2025, 2, 2)), ("a", datetime(2025, 1, 31)), ("z", None)],  # December closes; January may still grow
        [("d", datetime(2025, 2, 20)), ("e", datetime(2025, 1, 9))],  # January closes after this one
        [("f", datetime(2025, 3, 1)), ("g", datetime(2025, 1, 3))],  # a late row of January
        [("h", datetime(2025, 3, 2)), ("i", datetime(2024, 11, 1))],  # a late row of a month never seen
        [("j", datetime(2025, 4, 9))],
        [("k", datetime(2025, 4, 9))],
    ]
    closed, again = [], []

    def run(months, late, _):
        closed.extend(months)
        again.extend(late)

    for n, rows in enumerate(steps):
        spark.createDataFrame([(k, t, 1.0) for k, t in rows], schema).coalesce(1).write.parquet(f"{source}/{n}")
        stream = spark.readStream.schema(schema).parquet(f"{source}/*")
        run_closed_months(closed_months(stream, "t", shards=3), run, str(tmp_path / "c")).awaitTermination(120)
    assert sorted(closed) == [202412, 202501, 202502, 202503] and len(set(closed)) == len(closed)
    assert sorted(again) == [202411, 202501]


def test_ends_of_months():
    assert [datetime.fromtimestamp(end_of_month(m) / 1000, timezone.utc).strftime("%Y-%m-%d") for m in (202501, 202512, 202402)] == ["2025-02-01", "2026-01-01", "2024-03-01"]
