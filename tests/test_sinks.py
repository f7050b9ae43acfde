import pytest
from pyspark.sql import functions as F

from tidewatch.sources import sinks, versions


def rows(spark, *data):
    return spark.createDataFrame(list(data), "codmes_val int, ventana_meses int, x int")


def stored(spark, table):
    return sorted(tuple(r) for r in spark.table(table).select("codmes_val", "ventana_meses", "x").collect())


@pytest.mark.parametrize("external", [False, True])
def test_accumulate(spark, tmp_path, external):
    table, path = f"acc_{external}", str(tmp_path / "t") if external else None
    put = lambda targets, *data: sinks.accumulate(rows(spark, *data), table, targets, path)
    assert put([(202601, 6)], (202601, 6, 1)) == "created"
    assert put([(202602, 6), (202602, 12)], (202602, 6, 2), (202602, 12, 3)) == "updated"
    put([(202601, 6)], (202601, 6, 9))
    assert stored(spark, table) == [(202601, 6, 9), (202602, 6, 2), (202602, 12, 3)]
    put([(202602, 6), (202602, 12)], (202602, 6, 4))
    assert stored(spark, table) == [(202601, 6, 9), (202602, 6, 4)]
    put([(202601, 6)])
    assert stored(spark, table) == [(202602, 6, 4)]
    # rows of partitions that were not announced take their place as well, whatever the session says of overwriting
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    for mode in ("dynamic", "static"):
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
        put([(202602, 6)], (202603, 12, 5), (202603, 12, 4))
        assert stored(spark, table) == [(202603, 12, 4), (202603, 12, 5)]
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode
        put([(202602, 6)], (202602, 6, 4))
        put([(202603, 12)])
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
    assert stored(spark, table) == [(202602, 6, 4)]
    sinks.drop_table(spark, table)
    assert not spark.catalog.tableExists(table) and not spark.catalog.tableExists(versions.store_name(table))
    assert path is None or not (tmp_path / "t").exists()


def test_layout_changes_only_when_asked(spark, tmp_path):
    rows(spark, (202512, 6, 7), (202601, 6, 1), (202601, 12, 8)).write.partitionBy("ventana_meses").option("path", str(tmp_path / "old")).saveAsTable("other")
    assert sinks.partition_columns(spark, "other") == ["ventana_meses"]
    with pytest.raises(ValueError):
        sinks.accumulate(rows(spark, (202601, 6, 2)), "other", [(202601, 6)])
    assert stored(spark, "other") == [(202512, 6, 7), (202601, 6, 1), (202601, 12, 8)]
    # all that was there is there afterwards, but for what the run stands for
    assert sinks.accumulate(rows(spark, (202601, 6, 2)), "other", [(202601, 6)], migrate=True) == "migrated"
    assert stored(spark, "other") == [(202512, 6, 7), (202601, 6, 2), (202601, 12, 8)]
    assert sinks.partition_columns(spark, "other") == list(sinks.PARTITIONS)
    assert stored(spark, "other__before_0") == [(202512, 6, 7), (202601, 6, 1), (202601, 12, 8)]
    with pytest.raises(ValueError):
        sinks.replace_table(rows(spark), "other")
    sinks.drop_table(spark, "other")
    spark.createDataFrame([(1, 2)], "a int, b int").write.saveAsTable("other")
    with pytest.raises(ValueError):
        sinks.accumulate(rows(spark, (202601, 6, 2)), "other", [(202601, 6)], migrate=True)
    sinks.drop_table(spark, "other")
    sinks.drop_table(spark, "other__before_0")


@pytest.mark.parametrize("fails", ["write", "switch"])
def test_a_run_that_fails_changes_nothing(spark, monkeypatch, fails):
    whole = [(202601, 6, 1), (202601, 12, 2), (202602, 6, 3)]
    sinks.accumulate(rows(spark, *whole), "atomic", [])
    sinks.replace_table(rows(spark, *whole), "replaced")
    bad = rows(spark, (202601, 6, 8), (202601, 12, 9))
    if fails == "switch":
        monkeypatch.setattr(versions, "switch", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    else:  # half of the rows are written when a task fails
        bad = bad.repartition(1).withColumn("x", F.when(F.col("x") == 9, F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("x")))
    with pytest.raises(Exception, match="lost"):
        sinks.accumulate(bad, "atomic", [(202601, 6), (202601, 12)])
    with pytest.raises(Exception, match="lost"):
        sinks.replace_table(bad, "replaced")
    monkeypatch.undo()
    assert stored(spark, "atomic") == stored(spark, "replaced") == whole
    # the next run succeeds and removes what the failed one left
    assert sinks.accumulate(rows(spark, (202601, 6, 8)), "atomic", [(202601, 6), (202601, 12)]) == "updated"
    sinks.replace_table(rows(spark, (202601, 6, 8)), "replaced")
    assert stored(spark, "atomic") == [(202601, 6, 8), (202602, 6, 3)] and stored(spark, "replaced") == [(202601, 6, 8)]
    versions.sweep(spark, "atomic")
    assert {x[:2] for x in versions._stored(spark, "atomic")} == set(versions.live(spark, "atomic").items())
    for t in ("atomic", "replaced"):
        sinks.drop_table(spark, t)


def test_readers_prune_and_text_partitions(spark):
    frame = spark.createDataFrame([("it's", 1), ("a\\b", 2), ("c", 3)], "zone string, x int")
    sinks.replace_table(frame, "texts", partitions=("zone",))
    assert sorted(r.x for r in spark.table("texts").collect()) == [1, 2, 3]
    assert [r.x for r in spark.table("texts").where("zone = 'c'").collect()] == [3]
    assert all("zone=c" in f for f in spark.table("texts").where("zone = 'c'").inputFiles())
    sinks.replace_table(frame.where("x < 3"), "texts", partitions=("zone",))
    versions.sweep(spark, "texts")
    assert {x[0][0] for x in versions._stored(spark, "texts")} == {"it's", "a\\b"} and spark.table("texts").count() == 2
    sinks.drop_table(spark, "texts")
    sinks.accumulate(rows(spark, *((202601, w, w) for w in (6, 12, 18, 24))), "pruned", [])
    plan = spark.table("pruned").where("ventana_meses = 6")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "ventana_meses" in plan and "version" in plan
    sinks.drop_table(spark, "pruned")
