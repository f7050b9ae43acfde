"""Series fixtures through segmentation and decision, and the operators before them."""

import itertools
from datetime import date, datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch import __main__ as cli
from tidewatch.config import DetectorConfig, Metric, previous_month
from tidewatch.operators import counts, decide, fences, grouped, iterative, reports, rollup, segments
from tidewatch.plans import pipelines
from tidewatch.sources import facts, sinks

CONFIG = DetectorConfig(eval_month=202701, windows=(24,))
COLUMNS = "metrica string, canal_dsc string, flujo_dsc string, productos_dsc string, objetivo_dsc string, dia_semana int, ventana_meses int, codmes int, mes_idx int, valor_mes double, suma_mes double, n_dias long"


def frame(spark, series, config=CONFIG):
    """Rows of several named series, on the detection scale; months count back from the evaluation month."""
    rows = []
    for name, values in series.items():
        for i, v in enumerate(values):
            idx = config.eval_index - len(values) + i
            rows.append((name, "HTML", "Marketing Contextual", "Venta TC", "Ventas", 1, 24, (idx - 1) // 12 * 100 + (idx - 1) % 12 + 1, idx, float(v), 4.0 * float(v), 4))
    return fences.on_scale(spark.createDataFrame(rows, COLUMNS), config)


def decided(spark, series, config=CONFIG):
    out = decide.decide(segments.segment(frame(spark, series, config), config), config).collect()
    return {name: sorted((r for r in out if r.metrica == name), key=lambda r: r.mes_idx) for name in series}


RNG = np.random.default_rng(3)
SERIES = {
    "low": [191.0, *RNG.uniform(100000, 180000, 23)],
    "high": [*RNG.uniform(1000, 2000, 17), 500000.0],
    "few": [100.0, 110000, 120000, 115000, 118000],
    "constant": [5000.0] * 12,
    "zeros": [0.0, 0.0, *RNG.uniform(100000, 120000, 10)],
    "two_values": [1, 1, 1, 1, 1, 1000],
    "three": [10, 10, 1000],
    "four": [10, 10, 10, 1000],
    "forty": [1, 1.01, 1.02, 1.03, 1000, 1001, 1002, 1003, 1004, 1005],
    "fifty": [1, 1.01, 1.02, 1.03, 1.04, 1000, 1001, 1002, 1003, 1004],
    "both": [1.0, 1000, 1010, 1020, 1030, 1040, 1050, 1060, 1070, 1080, 1e6],
}


@pytest.fixture(scope="module")
def results(spark):
    return decided(spark, SERIES)


def test_methods_and_flags(results):
    kind = {n: r[0].metodo for n, r in results.items()}
    flags = {n: [i for i, r in enumerate(rs) if r.es_outlier] for n, rs in results.items()}
    assert (kind["low"], flags["low"], results["low"][0].tipo, results["low"][0].k_elegido) == ("CLUSTER", [0], "BAJO", 2)
    assert flags["high"] == [17] and results["high"][17].tipo == "ALTO"
    assert kind["few"] == "IQR_MAD_POCOS_MESES" and results["few"][0].k_elegido == 0 and results["few"][0].cluster_id == -1
    assert kind["constant"] == "IQR_MAD_DEGENERADO" and not flags["constant"]
    assert kind["zeros"] == "CLUSTER"
    assert kind["two_values"] == "IQR_MAD_FALLBACK_K1" and results["two_values"][5].tipo == "ALTO"
    assert not flags["three"] and flags["four"] == [3]
    assert flags["forty"] == [0, 1, 2, 3] and not flags["fifty"]
    assert flags["both"] == [0, 10] and results["both"][10].tipo == "ALTO" and results["both"][0].tipo == "BAJO"


def test_reported_limits_and_nulls(results):
    low = results["low"][5]
    assert low.limite_inf == low.frontera_inf_cluster and low.frontera_sup_cluster is None and low.pctl_valida_sup is None
    assert low.limite_sup == low.limite_sup_iqr and low.iqr == pytest.approx(low.q3 - low.q1)
    assert results["constant"][0].mod_zscore == 0.0 and results["few"][0].cluster_center is None and results["few"][0].cluster_n == 5


def test_fence_rule_applies_only_outside_clusters(spark):
    off = decided(spark, {"low": SERIES["low"]}, DetectorConfig(eval_month=202701, windows=(24,), use_clustering=False))["low"]
    assert off[0].metodo == "IQR_MAD_DESHABILITADO" and off[0].es_outlier and off[0].tipo == "BAJO"


def test_costs_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    series = {f"s{i}": np.round(10 ** rng.uniform(0, 4, int(rng.integers(6, 10))), int(rng.integers(0, 3))) + 1 for i in range(12)}
    rows = segments.elbow(segments.optimal_costs(segments.gather(frame(spark, series), CONFIG), CONFIG)).collect()
    for r in rows:
        y = np.sort(np.log10(series[r.metrica]))
        for k, cost in enumerate(r.inertias, 1):
            best = min(sum(((y[a:b] - y[a:b].mean()) ** 2).sum() for a, b in itertools.pairwise((0, *c, len(y)))) for c in itertools.combinations(range(1, len(y)), k - 1))
            assert cost == pytest.approx(best, abs=1e-9)


def test_order_of_rows_does_not_matter(spark):
    values = [3.0, 3.0, 7.0, 7.0, 7.0, 90.0, 91.0, 500.0]
    a = decided(spark, {"x": values})["x"]
    b = decide.decide(segments.segment(frame(spark, {"x": values}).orderBy("valor_mes", ascending=False).repartition(3), CONFIG), CONFIG).collect()
    assert sorted((r.codmes, r.cluster_id, r.es_outlier) for r in a) == sorted((r.codmes, r.cluster_id, r.es_outlier) for r in b)


SOURCE = "canal_dsc string, flujo_dsc string, productos_dsc string, objetivos_dsc string, d1 timestamp, v1 double, d2 timestamp, v2 double"
INGEST = DetectorConfig(eval_month=202601, windows=(6, 12), metrics=(Metric("A", "d1", "v1"), Metric("B", "d2", "v2")))


def test_ingest_drops_absent_values_and_names_missing_dimensions(spark):
    day = datetime(2025, 8, 4, 13)
    rows = [(None, "", "  ", "x", day, 5.0, None, 7.0), ("c", "f", "p", "o", day, None, day, 0.0), ("c", "f", "p", "o", day, -1.0, day, float("nan")), ("c", "f", "p", "o", datetime(2024, 12, 31), 1.0, day, 2.0)]
    out = facts.long_facts(spark.createDataFrame(rows, SOURCE), INGEST).collect()
    assert sorted((r.metrica, r.canal_dsc, r.flujo_dsc, r.productos_dsc, r.cantidad) for r in out) == [("A", "SIN CANAL", "SIN FLUJO", "  ", 5.0), ("B", "c", "f", "p", 2.0)]


def test_months_weekdays_and_windows(spark):
    days = [datetime(2025, 8, 4), datetime(2025, 8, 11), datetime(2025, 8, 11), datetime(2025, 7, 7), datetime(2025, 1, 6), datetime(2025, 12, 29), datetime(2026, 1, 5), datetime(2025, 8, 10)]
    rows = [("c", "f", "p", "o", d, 2.0, None, None) for d in days]
    months = rollup.look_back(rollup.monthly(rollup.daily(facts.long_facts(spark.createDataFrame(rows, SOURCE), INGEST, in_window=False), INGEST), INGEST), INGEST)
    got = {(r.codmes, r.dia_semana): (r.valor_mes, r.suma_mes, r.n_dias, r.dif_meses) for r in months.collect()}
    assert got == {(202508, 1): (3.0, 6.0, 2, 5), (202507, 1): (2.0, 2.0, 1, 6), (202501, 1): (2.0, 2.0, 1, 12), (202512, 1): (2.0, 2.0, 1, 1), (202508, 7): (2.0, 2.0, 1, 5)}
    exploded = sorted((r.codmes, r.ventana_meses) for r in rollup.explode_windows(months, INGEST).where("dia_semana = 1").collect())
    assert exploded == [(202501, 12), (202507, 6), (202507, 12), (202508, 6), (202508, 12), (202512, 6), (202512, 12)]


def test_filters_reach_the_reader(spark, tmp_path):
    path = str(tmp_path / "wide")
    spark.createDataFrame([("c", "f", "p", "o", datetime(2025, 8, 4), 2.0, None, None)], SOURCE).write.parquet(path)
    plan = facts.long_facts(spark.read.parquet(path), INGEST)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(" in plan and "GreaterThan(v1,0.0)" in plan and "GreaterThanOrEqual(" in plan  # the plan is printed in part


def test_calendar_and_validation():
    assert previous_month(date(2026, 1, 15)) == 202512 and previous_month(date(2026, 7, 1)) == 202606
    assert CONFIG.for_previous_month(date(2026, 1, 15)).eval_month == 202512
    for bad in ({"eval_month": 202613}, {"windows": ()}, {"k_max": 0}):
        with pytest.raises(ValueError):
            DetectorConfig(**bad)


def test_anti_join_keeps_unflagged_months(spark):
    rows = fences.fences(fences.statistics(frame(spark, {"four": SERIES["four"]}), CONFIG), CONFIG)
    assert sorted(r.valor_mes for r in reports.clean_months(rows, reports.outliers_only(rows)).collect()) == [10, 10, 10]


def many_series(count=150, seed=71):
    """Series of one level, with a lone low or high month, of two levels, and spread over orders of magnitude."""
    rng = np.random.default_rng(seed)
    kinds = [
        lambda n: np.abs(rng.normal(40_000, 9_000, n)) + 1,
        lambda n: np.append(rng.uniform(40, 400, 1), rng.uniform(70_000, 220_000, n - 1)),
        lambda n: np.append(rng.uniform(900, 3_100, n - 1), rng.uniform(250_000, 950_000, 1)),
        lambda n: np.append(rng.uniform(900, 2_100, n // 2), rng.uniform(85_000, 125_000, n - n // 2)),
        lambda n: 10.0 ** rng.uniform(2, 5.5, n),
    ]
    return {f"s{i}": kinds[i % 5](int(rng.integers(6, 25))).tolist() for i in range(count)}


def test_both_solvers_decide_alike(spark):
    config = DetectorConfig(eval_month=202701, windows=(24,))
    rows = frame(spark, many_series(), config)
    keys = ("metodo", "k_elegido", "cluster_rank", "es_outlier", "tipo")
    real = ("frontera_inf_log", "frontera_sup_log", "limite_inf", "limite_sup", "cluster_center")
    exact, other = ({(r.metrica, r.codmes): r for r in decide.decide(solver.segment(rows, config), config).collect()} for solver in (segments, iterative))
    assert exact.keys() == other.keys() and len({m for m, _ in exact}) == 150
    for at, a in exact.items():
        b = other[at]
        assert [a[c] for c in keys] == [b[c] for c in keys], at
        assert [a[c] is None for c in real] == [b[c] is None for c in real], at
        assert [a[c] or 0.0 for c in real] == pytest.approx([b[c] or 0.0 for c in real], rel=1e-6, abs=1e-9), at


def test_grouped_map_decides_alike(spark):
    """150 series: the callable, the grouped map over all windows and the expressions say the same."""
    config = DetectorConfig(eval_month=202701, windows=(6, 12, 24))
    rows = frame(spark, many_series(), config).drop("ventana_meses", "y").withColumn("dif_meses", F.lit(config.eval_index) - F.col("mes_idx"))
    groups = segments.solve(segments.gather_windows(fences.on_scale(rows, config), config), config)
    exact = {(r.metrica, r.ventana_meses, r.codmes): r for r in decide.decide(groups, config).collect()}
    mapped = {(r.metrica, r.ventana_meses, r.codmes): r for r in grouped.decide(rows, config).collect()}
    # windows gathered one by one
    apart = {(r.metrica, r.ventana_meses, r.codmes): r for r in decide.decide(segments.segment(fences.on_scale(rollup.explode_windows(rows, config), config), config), config).collect()}
    assert exact.keys() == mapped.keys() == apart.keys() and len({m for m, *_ in exact}) == 150
    for at, a in exact.items():
        for c in grouped.NAMES:
            for other in (mapped[at][c], apart[at][c]):
                assert other == (pytest.approx(a[c], rel=1e-9, abs=1e-9) if isinstance(a[c], float) else a[c]), (at, c)


def test_decision_without_spark(monkeypatch):
    config = DetectorConfig(eval_month=202701, windows=(24,))
    said = grouped.decide_series(np.log10([191.0, *RNG.uniform(100000, 180000, 11)]), config)
    assert said["metodo"][0] == "CLUSTER" and said["tipo"] == ["BAJO"] + [None] * 11 and said["k_elegido"][0] == 2
    assert grouped.decide_series(np.full(8, 2.0), config)["metodo"] == ["IQR_MAD_DEGENERADO"] * 8
    # a segmentation that fails is contained: the fence rule decides
    monkeypatch.setattr(grouped, "segment", lambda *_: (_ for _ in ()).throw(ZeroDivisionError))
    said = grouped.decide_series(np.log10([191.0, *RNG.uniform(100000, 180000, 11)]), config)
    assert said["metodo"][0] == "IQR_MAD_ERROR" and said["es_outlier"] == [True] + [False] * 11 and said["cluster_center"] == [None] * 12


def test_monotone_splits_are_optimal():
    rng = np.random.default_rng(8)

    def by_all_cuts(s, most):
        costs, n = grouped.Costs(s), s.size
        best = np.append(np.inf, costs(0, np.arange(1, n + 1)))
        out = [best[n]]
        for k in range(2, most + 1):
            best = np.array([np.inf] * k + [min(best[j] + costs(j, i) for j in range(k - 1, i)) for i in range(k, n + 1)])
            out.append(best[n])
        return out

    for n in [*range(3, 30), 80]:
        s = np.sort(np.round(10 ** rng.uniform(0, 3, n), int(rng.integers(0, 3))))
        most = min(5, n - 1, np.unique(s).size)
        assert grouped.segment(s, 5)[0] == pytest.approx(by_all_cuts(s, most) if most > 1 else [], abs=1e-6)
    # steps grow with n log n: four times the values, about five times the steps, not sixteen
    steps = []
    for n in (600, 2400):
        s, count = np.sort(rng.normal(size=n)), [0]
        costs = grouped.Costs(s)
        before = np.append(np.inf, costs(0, np.arange(1, n + 1)))

        def counted(a, b, costs=costs, count=count):
            count[0] += np.size(a)
            return costs(a, b)

        grouped.layer(before, counted, 2, n)
        steps.append(count[0])
    assert steps[1] < 7 * steps[0] and steps[0] < 600 * 600 / 10


def test_unreadable_values_are_set_apart(spark):
    rows = [("c", "f", "p", "o", "2025-08-04 13:00:00", "5", "2025-08-05", "x1"), ("c", "f", "p", "o", "4 August", "7", "2025-08-05", "2"), (None, "f", "p", "o", None, None, "2025-08-06", "3")]
    source = spark.createDataFrame(rows, "canal_dsc string, flujo_dsc string, productos_dsc string, objetivos_dsc string, d1 string, v1 string, d2 string, v2 string")
    clean, apart = facts.parsed(source, INGEST)
    assert sorted((r.metrica, r.canal_dsc, r.fecha, r.valor, r.motivo) for r in apart.collect()) == [("A", "c", "4 August", "7", "fecha"), ("B", "c", "2025-08-05", "x1", "valor")]
    assert sorted((r.metrica, r.cantidad) for r in facts.long_facts(clean, INGEST).collect()) == [("A", 5.0), ("B", 2.0), ("B", 3.0)]
    typed = spark.createDataFrame([("c", "f", "p", "o", datetime(2025, 8, 4), 2.0, None, None)], SOURCE)
    same, none = facts.parsed(typed, INGEST)
    assert same.schema == typed.schema and none.count() == 0


def test_counts_merge_over_groups(spark, tmp_path):
    rng = np.random.default_rng(2)
    rows = [(int(w), "AB"[i % 2], f"s{int(rng.integers(40))}" if i % 7 else None) for i, w in enumerate(rng.choice([6, 12], 400))]
    frame_ = spark.createDataFrame(rows, "ventana_meses int, metodo string, serie_dsc string").fillna("none")
    numbers = counts.number_series(frame_, str(tmp_path / "a"), ("serie_dsc",))
    assert sorted(r.serie for r in numbers.collect()) == list(range(numbers.count()))
    parts = counts.partials(frame_, numbers, ("ventana_meses", "metodo"), ("serie_dsc",))
    for by in (("ventana_meses", "metodo"), ("ventana_meses",), ("metodo",)):
        want = {tuple(r[c] for c in by): (r.n, r.d) for r in frame_.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("serie_dsc").alias("d")).collect()}
        assert {tuple(r[c] for c in by): (r.n_outliers, r.combinaciones_afectadas) for r in counts.summary(parts, by).collect()} == want
    # series that come later get the numbers that follow
    more = frame_.unionByName(spark.createDataFrame([(6, "A", "new")], frame_.schema))
    later = {r.serie_dsc: r.serie for r in counts.number_series(more, str(tmp_path / "b"), ("serie_dsc",), numbers).collect()}
    assert later.pop("new") == len(later) and later == {r.serie_dsc: r.serie for r in numbers.collect()}


def test_stored_anti_join_needs_no_exchange(spark):
    series = {f"s{i}": np.append(RNG.uniform(900, 1100, 11), 9e6).tolist() for i in range(30)}
    for month in (202701, 202702):
        config = DetectorConfig(eval_month=month, windows=(12,), buckets=4)
        months = frame(spark, series, config).drop("ventana_meses", "y").withColumn("dif_meses", F.lit(config.eval_index) - F.col("mes_idx"))
        if month == 202702:  # nothing is flagged in the second evaluation
            months = months.where("valor_mes < 1e6")
        pipelines.run_clusters(months, config, "bands_flagged", "bands_detail", months=months)
    clean = reports.stored_clean_months(spark, "bands_detail", "bands_flagged")
    plan = clean._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan and "LeftAnti" in plan
    got = clean.groupBy("codmes_val").count().collect()
    flagged = spark.table("bands_flagged").groupBy("codmes_val").count().collect()
    every = spark.table("bands_detail").groupBy("codmes_val").count().collect()
    as_dict = lambda rs: {r[0]: r[1] for r in rs}
    assert as_dict(got) == {m: n - as_dict(flagged).get(m, 0) for m, n in as_dict(every).items()} and as_dict(flagged) == {202701: 30}
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"
    for t in ("bands_flagged", "bands_detail"):
        sinks.drop_table(spark, t)
    with pytest.raises(ValueError):
        reports.clean_months(clean, clean.drop("codmes_val"))


def test_summaries_come_in_order(spark, results):
    rows = spark.createDataFrame([(w, m, i) for i, (w, m) in enumerate([(24, "B"), (6, "B"), (6, "A"), (12, "A")])], "ventana_meses int, metodo string, dia_semana int")
    rows = rows.withColumns({c: F.lit("x") for c in reports.KEYS if c != "dia_semana"}).withColumn("codmes_val", F.lit(202701) - F.col("dia_semana"))
    assert [r.ventana_meses for r in reports.summary(rows).collect()] == [6, 12, 24]
    assert [(r.ventana_meses, r.metodo) for r in reports.summary(rows, ("ventana_meses", "metodo")).collect()] == [(6, "A"), (6, "B"), (12, "A"), (24, "B")]
    assert [r.codmes_val for r in reports.stored_months(rows).collect()] == sorted(202701 - i for i in range(4))


@pytest.mark.parametrize(("kind", "stored"), [("fences", False), ("clusters", False), ("clusters", True)])
def test_command_line(spark, capsys, kind, stored):
    rng, rows = np.random.default_rng(5), []
    for back in range(1, 13):
        at = 2026 * 12 + 6 - 1 - back
        for day in (1, 8, 15, 22):
            rows.append((date(at // 12, at % 12 + 1, day), 5.0 if back == 3 else float(rng.integers(90_000, 120_000)), "HTML", "Marketing Contextual", "Venta TC", "Ventas"))
    source = spark.createDataFrame(rows, "d date, v double, canal_dsc string, flujo_dsc string, productos_dsc string, objetivos_dsc string").drop_duplicates()
    source.createOrReplaceTempView("wide")
    table = f"cli_{kind}"
    metrics = (Metric("ENVIOS", "d", "v"),)
    if stored:
        for said in ("202506, 202507", "none"):
            cli.run(spark, cli.arguments(["daily", "--source", "wide", "--daily", "cli_daily", "--batch", "one"]), today=date(2026, 7, 3), metrics=metrics)
            assert f"Months written anew: {said}" in capsys.readouterr().out
    given = cli.arguments([kind, *(["--daily", "cli_daily"] if stored else ["--source", "wide"]), "--table", table, "--windows", "12", "--list", "3", *(["--detail", f"{table}_all"] if kind == "clusters" else [])])
    cli.run(spark, given, today=date(2026, 7, 3), metrics=metrics, min_months=1)
    said = capsys.readouterr().out
    assert "Flagged months by window" in said and table in said
    if kind == "clusters":
        assert "Acceptance case: ENVIOS, 1, 1" in said and "|202606" in said
        assert [r.codmes_val for r in reports.stored_months(spark.table(table)).collect()] == [202606]
        sinks.drop_table(spark, f"{table}_all")
    flagged = spark.table(table).where("tipo = 'BAJO'")
    assert flagged.count() >= 1 and {r.codmes for r in flagged.collect()} == {202603}
    sinks.drop_table(spark, table)
    sinks.drop_table(spark, "cli_daily")
    for bad in (["clusters", "--table", "t"], ["daily", "--source", "s"], ["fences", "--source", "s"]):
        with pytest.raises(SystemExit):
            cli.arguments(bad)
