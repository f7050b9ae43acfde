"""Maintained daily totals against totals computed anew."""

from datetime import datetime

import pytest

from tidewatch.config import DetectorConfig, Metric
from tidewatch.operators import rollup
from tidewatch.plans import pipelines
from tidewatch.sources import daily_store, facts, sinks, versions

SOURCE = "canal_dsc string, flujo_dsc string, productos_dsc string, objetivos_dsc string, d1 timestamp, v1 double, d2 timestamp, v2 double"
CONFIG = DetectorConfig(eval_month=202601, windows=(6, 12), metrics=(Metric("A", "d1", "v1"), Metric("B", "d2", "v2")))


def wide(spark, *rows):
    return spark.createDataFrame([("c", None if i % 2 else "f", "p", "", a and datetime(*a), x, b and datetime(*b), y) for i, (a, x, b, y) in enumerate(rows)], SOURCE)


FIRST = [((2025, 8, 4), 1.0, (2025, 9, 4), 2.0), ((2025, 8, 4), 3.0, (2025, 9, 4), 4.0), ((2025, 10, 1), 5.0, None, 6.0), ((2024, 3, 1), 7.0, (2025, 8, 4), 8.0)]
LATE = [((2025, 8, 4), 16.0, None, None), ((2025, 8, 5), 32.0, (2025, 12, 31), 64.0), (None, 1.0, (2025, 12, 1), -1.0)]


def totals(frame):
    return sorted(tuple(r) for r in frame.collect())


def anew(frame):
    return totals(rollup.daily(facts.long_facts(frame, CONFIG, in_window=False), CONFIG).select(*CONFIG.cell, "fecha_dt", "cantidad_dia"))


@pytest.fixture
def store(spark):
    name = "daily_totals"
    yield name
    sinks.drop_table(spark, name)


def test_late_rows_touch_their_months_alone(spark, store, monkeypatch):
    first, late = wide(spark, *FIRST), wide(spark, *LATE)
    assert daily_store.add(first, CONFIG, store, "first") == [202403, 202508, 202509, 202510]
    assert totals(daily_store.days(spark, store, CONFIG, in_window=False)) == anew(first)
    before, read = versions.live(spark, store), []
    merged = daily_store.merged
    monkeypatch.setattr(daily_store, "merged", lambda parts, config: read.append(parts) or merged(parts, config))
    assert daily_store.add(late, CONFIG, store, "late") == [202508, 202512]
    # the merge read the one month that was there and is touched, and no other file
    files = read[-1].inputFiles()
    assert files and all("codmes=202508" in f for f in files)
    after = versions.live(spark, store)
    assert {m for m in before if after[m] == before[m]} == {(202403,), (202509,), (202510,)}
    both = first.unionByName(late)
    assert totals(daily_store.days(spark, store, CONFIG, in_window=False)) == anew(both)
    # a batch that comes again changes nothing
    assert daily_store.add(late, CONFIG, store, "late") == [] and versions.live(spark, store) == after
    assert daily_store.batches(spark, store) == ["first", "late"]
    # months of the longest window, from the store as from the source; other months are not read
    want, stored = pipelines.monthly_series(both, CONFIG), pipelines.stored_series(spark, store, CONFIG)
    assert totals(stored) == totals(want) and stored.count() > 0
    files = daily_store.days(spark, store, CONFIG).inputFiles()
    assert files and not any("codmes=202403" in f for f in files)


def test_a_batch_that_fails_can_be_repeated(spark, store, monkeypatch):
    first, late = wide(spark, *FIRST), wide(spark, *LATE)
    daily_store.add(first, CONFIG, store, "first")
    with monkeypatch.context() as m:
        m.setattr(versions, "switch", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            daily_store.add(late, CONFIG, store, "late")
    assert totals(daily_store.days(spark, store, CONFIG, in_window=False)) == anew(first)
    assert daily_store.add(late, CONFIG, store, "late") == [202508, 202512]
    assert totals(daily_store.days(spark, store, CONFIG, in_window=False)) == anew(first.unionByName(late))


def test_corrected_months_are_rebuilt(spark, store):
    daily_store.add(wide(spark, *FIRST), CONFIG, store, "first")
    right = wide(spark, *(r for r in FIRST if r[1] != 3.0 and r[1] != 5.0))
    daily_store.rebuild(right, CONFIG, store, [202508, 202509, 202510])
    assert totals(daily_store.days(spark, store, CONFIG, in_window=False)) == anew(right)
    assert daily_store.batches(spark, store) == ["first"]


def test_empty_batches(spark, store):
    assert daily_store.add(wide(spark), CONFIG, store, "none") == []
    assert daily_store.days(spark, store, CONFIG).count() == 0
    daily_store.add(wide(spark, *FIRST), CONFIG, store, "first")
    assert daily_store.add(wide(spark), CONFIG, store, "nothing") == []
    assert totals(daily_store.days(spark, store, CONFIG, in_window=False)) == anew(wide(spark, *FIRST))
