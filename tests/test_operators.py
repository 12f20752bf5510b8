"""Operators on small hand-made panels."""

import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from panelyx.functions import cross_section as xs
from panelyx.functions import windows as win
from panelyx.operators import backtest, dataset, joins, pit, risk
from panelyx.sources.tables import TableSpec, run_all

D = dt.date


def panel(spark, rows, schema="ix int, tk int, x double"):
    return spark.createDataFrame(rows, schema).withColumn("td", F.date_add(F.lit("2024-01-01").cast("date"), "ix"))


def test_lag_counts_positions_not_rows(spark):
    p = panel(spark, [(0, 1, 1.0), (2, 1, 3.0), (3, 1, 4.0)])
    out = {r.ix: r.l for r in p.select("ix", win.lagged("x", 1).alias("l")).collect()}
    assert out == {0: None, 2: None, 3: 3.0}


def test_rolling_needs_min_periods(spark):
    p = panel(spark, [(i, 1, float(i)) for i in range(5)])
    out = [r.m for r in p.select("ix", win.rolling_mean("x", 3, 2).alias("m")).orderBy("ix").collect()]
    assert out == [None, 0.5, 1.0, 2.0, 3.0]


def test_calendar_last_date_ends_nothing(spark):
    days = spark.createDataFrame([(D(2023, 12, 29),), (D(2024, 1, 2),), (D(2024, 1, 3),)], "td date")
    out = joins.calendar(days).orderBy("td").collect()
    assert [(r.is_year_end, r.is_month_end, r.is_week_end) for r in out] == [(1, 1, 1), (0, 0, 0), (0, 0, 0)]


def test_interval_join_is_closed_and_open_ended(spark):
    days = spark.createDataFrame([(D(2024, 1, i),) for i in range(1, 6)], "td date")
    iv = spark.createDataFrame([(1, D(2024, 1, 2), D(2024, 1, 3)), (2, D(2024, 1, 5), None), (3, D(2023, 1, 1), D(2023, 2, 1))], "k int, a date, z date")
    out = sorted((r.k, r.td.day) for r in joins.interval_join(days, iv, "a", "z", bucket_days=2).collect())
    assert out == [(1, 2), (1, 3), (2, 5)]


def test_as_of_takes_latest_and_can_be_strict(spark):
    left = spark.createDataFrame([(1, D(2024, 1, 2)), (1, D(2024, 1, 5)), (2, D(2024, 1, 5))], "k int, t date")
    right = spark.createDataFrame([(1, D(2024, 1, 2), 10.0), (1, D(2024, 1, 4), 20.0)], "k int, s date, v double")
    got = lambda strict: sorted((r.k, r.t.day, r.v or -1) for r in joins.as_of(left, right, "k", "t", "s", ["v"], strictly=strict).collect())
    assert got(False) == [(1, 2, 10.0), (1, 5, 20.0), (2, 5, -1)]
    assert got(True) == [(1, 2, -1), (1, 5, 20.0), (2, 5, -1)]


def test_groups_drop_the_remainder_at_the_top(spark):
    p = panel(spark, [(0, k, float(k)) for k in range(11)])
    out = {r.tk: r.grp for r in backtest.quantile_groups(p, "x", 3).collect()}
    assert out == {k: k // 3 + 1 for k in range(9)}


def test_winsorize_keeps_nulls_and_zero_heavy_dates(spark):
    p = panel(spark, [(0, 1, None), *((0, k, 0.0) for k in range(2, 8)), (0, 8, 1.0), (0, 9, 50.0)])
    out = {r.tk: r.w for r in xs.winsorize_mad(p, "x", "w").collect()}
    assert out[1] is None and out[2] == 0.0 and out[9] > 1.0


def test_residual_is_orthogonal(spark):
    rng = np.random.default_rng(0)
    rows = [(0, k, float(v), float(a), float(b), float(w)) for k, (v, a, b, w) in enumerate(rng.uniform(0.5, 2, (40, 4)))]
    p = panel(spark, rows, "ix int, tk int, x double, a double, b double, w double")
    out = xs.orthogonalize(p, "x", ["a", "b"], "w", "r").toPandas()
    assert abs((out.w * out.r * out.a).sum()) < 1e-8 and abs((out.w * out.r * out.b).sum()) < 1e-8


def test_buy_and_hold_equals_a_day_loop(spark):
    rng = np.random.default_rng(1)
    r = rng.normal(0, 0.02, (3, 6))
    held = spark.createDataFrame([(0, k, w, 1, 5) for k, w in enumerate((0.5, 0.3, 0.2))], "seg int, tk int, w0 double, from_ix int, to_ix int")
    rets = spark.createDataFrame([(k, i, float(r[k, i])) for k in range(3) for i in range(6)], "tk int, ix int, r double")
    grown = backtest.drifted_weights(held, rets)
    got = [x.ret for x in backtest.basket_returns(grown).orderBy("ix").collect()]
    w, want = np.array([0.5, 0.3, 0.2]), []
    for i in range(1, 6):
        want.append(float(w @ r[:, i]))
        w = w * (1 + r[:, i])
        w /= w.sum()
    assert np.allclose(got, want)


def test_drawdown_episodes(spark):
    nav = spark.createDataFrame([(1, i, v) for i, v in enumerate((1.0, 0.9, 1.1, 1.0, 0.95, 1.2))], "g int, ix int, nav double")
    out = sorted((r["first"], r["last"], r["days"]) for r in backtest.drawdown_episodes(backtest.drawdowns(nav, "g"), "g").collect())
    assert out == [(1, 1, 1), (3, 4, 2)]
    assert backtest.drawdown_episodes(backtest.drawdowns(nav.filter("ix = 0"), "g"), "g").count() == 0


def test_point_in_time_sees_only_what_was_announced(spark):
    rows = [(1, D(2024, 4, 20), 8096, 10.0, 1), (1, D(2024, 5, 20), 8096, 12.0, 2), (1, D(2025, 4, 20), 8100, 15.0, 3), (1, D(2024, 4, 25), 8100, 99.0, 4)]
    f = spark.createDataFrame(rows, "tk int, ann date, q int, v double, rid long")
    out = {r.rid: r.v for r in pit.change(f, 4, "diff").collect()}
    assert out == {3: 3.0, 4: 89.0}


def test_screens_are_skipped_when_they_leave_too_few(spark):
    p = panel(spark, [(0, k, float(k)) for k in range(20)])
    assert backtest.screen(p, [("x", 5)], least=10).count() == 20
    assert sorted(r.tk for r in backtest.screen(p, [("x", -12)], least=10).collect()) == list(range(8, 20))


def test_medcouple_signs():
    rng = np.random.default_rng(2)
    right = rng.exponential(1, 200)
    assert xs.medcouple(right) > 0.1 > -0.1 > xs.medcouple(-right)
    assert abs(xs.medcouple(np.arange(21.0))) < 1e-9


def test_half_life_weights():
    w = risk.half_life_weights(3, 1)
    assert np.isclose(sum(w), 3) and w[2] == 2 * w[1]
    assert risk.half_life_weights(3, None) == [1.0, 1.0, 1.0]


def test_windows_and_filters(spark):
    p = panel(spark, [(i, 1, float(i)) for i in range(6)])
    rows = dataset.windows(p, "x", 2, 2).orderBy("ix").collect()
    assert [r.x for r in rows] == [[1.0, 3.0], [2.0, 4.0], [3.0, 5.0]]


def test_sync_prefers_fresh_rows(spark):
    old = spark.createDataFrame([(1, D(2024, 1, 1), "a"), (2, D(2024, 3, 1), "a")], "k int, d date, v string")
    fresh = spark.createDataFrame([(1, D(2024, 1, 1), "b"), (2, D(2024, 3, 1), "b"), (3, D(2024, 3, 2), "b")], "k int, d date, v string")
    assert sorted((r.k, r.v) for r in joins.roll_back_sync(old, fresh, "d", ["k"]).collect()) == [(1, "a"), (2, "b"), (3, "b")]


def test_table_spec_sql_and_isolated_failures():
    s = TableSpec("t", "prices", ("a", "b"), "a IN (1, 2)", "d", ("a",))
    assert s.sql() == "SELECT a, b FROM prices WHERE (a IN (1, 2))"
    assert s.sql("20240101") == "SELECT a, b FROM prices WHERE (a IN (1, 2)) AND d > '20240101'"
    assert list(run_all({"x": 1, "y": 0}, lambda v: 1 / v)) == ["y"]


def test_empty_panel(spark):
    p = panel(spark, [])
    assert xs.winsorize_mad(p, "x", "w").count() == 0 and backtest.quantile_groups(p, "x", 3).count() == 0
    assert pd.DataFrame(backtest.information_coefficient(p.withColumn("f", F.col("x")), "x", "f", "td").collect()).empty


def test_trees_of_files_and_their_names(spark, tmp_path):
    from panelyx.sources.tables import list_tables, load_tree

    for k, name in enumerate(("a", "b/c", "b/d/e")):
        folder = tmp_path / name
        folder.parent.mkdir(parents=True, exist_ok=True)
        spark.createDataFrame([(k, f"v{k}")], "k int, v string").toPandas().to_parquet(str(folder) + ".parquet")
    (tmp_path / "note.txt").write_text("no table")
    assert {r.k for r in load_tree(spark, str(tmp_path)).collect()} == {0, 1, 2}
    assert {r.v for r in load_tree(spark, str(tmp_path), key="k", values=[1, 2]).collect()} == {"v1", "v2"}
    assert {r.name for r in list_tables(spark, str(tmp_path)).collect()} == {"a", "c", "e"}


def test_append_panel_replaces_the_dates_it_holds(spark, tmp_path):
    from panelyx.sources.tables import append_panel

    path = str(tmp_path / "panel")
    rows = lambda *x: spark.createDataFrame(list(x), "td string, v int")
    append_panel(spark, path, rows(("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-03", 3)))
    append_panel(spark, path, rows(("2024-01-02", 20), ("2024-01-04", 4)))
    assert {(str(r.td), r.v) for r in spark.read.parquet(path).collect()} == {("2024-01-01", 1), ("2024-01-02", 20), ("2024-01-03", 3), ("2024-01-04", 4)}


def test_functions_are_bound_by_the_names_of_their_arguments(spark):
    from panelyx.sources.tables import run_named

    out = run_named({"twice": lambda base: base.selectExpr("x * 2 as x"), "both": lambda base, twice: base.unionByName(twice)}, {"base": spark.range(3).toDF("x")})
    assert sorted(r.x for r in out["both"].collect()) == [0, 0, 1, 2, 2, 4]
