"""The exposure graph, its numerics and what feeds it, against plain loops."""

import datetime as dt
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelyx.functions import cross_section as xs
from panelyx.functions import windows as win
from panelyx.operators import graph, joins, pit, risk, risk_formulas

DAY = dt.date(2020, 1, 6)


def day(i):
    return DAY + dt.timedelta(days=i)


@pytest.fixture(scope="module")
def panel(spark):
    rng = random.Random(1)
    rows = [(day(i), tk, i, float(10 + tk + rng.random()), float(rng.randrange(1, 9)), float(tk % 3 + 1)) for i in range(6) for tk in range(14) if rng.random() < 0.9]
    return spark.createDataFrame(rows, "td date, tk int, ix int, close double, amount double, cap double")


def one_factor(formulas, *subs, **more):
    return graph.Graph([graph.Node("f", subfactors=subs, **more)], formulas)


def test_formulas_are_bound_by_name_and_shared(spark, panel):
    calls = []

    def doubled(close):
        calls.append("doubled")
        return F.col(close) * 2

    def shifted(doubled, *, by):
        return F.col(doubled) + by

    def product(doubled, shifted_up):
        return F.col(doubled) * F.col(shifted_up)

    g = graph.Graph([graph.Node("f", subfactors=(graph.Sub("product_sub", "product"), graph.Sub("shifted_sub", "shifted", {"by": 1}))), graph.Node("m", kind="market")], {"doubled": doubled, "shifted": shifted, "product": product}, inputs=[graph.Sub("shifted_up", "shifted", {"by": 3})])
    out = g.exposures(panel, {}, weight="cap", with_subfactors=True).join(panel, ["td", "tk"]).collect()
    assert calls == ["doubled"] and len(out) == panel.count()
    for r in out:
        assert r.m == 1.0 and r.sub_product_sub == pytest.approx(2 * r.close * (2 * r.close + 3)) and r.f == pytest.approx((r.sub_product_sub + 2 * r.close + 1) / 2)
    order = [[s.name for s in generation] for generation in g.order(panel.columns, [])]
    assert order == [["doubled"], ["shifted_sub", "shifted_up"], ["product_sub"]]


@pytest.mark.parametrize(("formulas", "subs", "says"), [
    ({"a": lambda b: F.lit(1), "b": lambda a: F.lit(1)}, [graph.Sub("s", "a")], "cycle"),
    ({"a": lambda nowhere: F.lit(1)}, [graph.Sub("s", "a")], "nothing is named nowhere"),
    ({"a": lambda close: F.lit(1)}, [graph.Sub("s", "b")], "no formula b"),
    ({"a": lambda close: F.lit(1)}, [graph.Sub("s", "a", {"n": 1})], "no parameter n"),
    ({"a": lambda close, *, n: F.lit(1)}, [graph.Sub("s", "a")], "needs n"),
    ({"a": lambda close: F.lit(1)}, [graph.Sub("s", "a", steps=("polish",))], "no step polish"),
    ({"a": lambda close: F.lit(1)}, [graph.Sub("s", "a"), graph.Sub("s", "a")], "one name"),
    ({"a": lambda close: F.lit(1)}, [graph.Sub("s", "a", universe="big")], "no universe big"),
    ({"a": lambda close, facts: F.lit(1)}, [graph.Sub("s", "a")], "mixes tables and columns"),
    ({"a": lambda close: F.lit(1)}, [graph.Sub("cap", "a")], "named like what is computed"),
])
def test_graphs_that_cannot_be_computed_say_why(panel, formulas, subs, says):
    with pytest.raises(graph.GraphError, match=says):
        one_factor(formulas, *subs).exposures(panel, {"facts": panel}, weight="cap")


@pytest.mark.parametrize(("config", "says"), [({"name": "x", "type": "other"}, "invalid type"), ({"name": "x", "type": "style"}, "no subfactors")])
def test_configuration_is_checked(config, says):
    with pytest.raises(graph.GraphError, match=says):
        graph.from_config([config])


def test_masks_steps_tables_and_industries(spark, panel):
    member = panel.filter("tk <> 13").select("td", "tk")
    young = panel.filter("tk < 12").select("td", "tk")
    table = spark.createDataFrame([(day(i), tk, float(tk)) for i in range(6) for tk in range(0, 14, 2)], "td date, tk int, v double")
    inds = spark.createDataFrame([(day(2), 0, "A"), (day(2), 0, "B"), (day(2), 2, "A"), (day(3), 4, "C")], "td date, tk int, industry string")
    config = [{"name": "f", "type": "style", "subfactors": [{"name": "x", "formula": "level", "universe": "young", "steps": ["standardize"]}, {"name": "y", "formula": "given"}], "steps": ["compress"]}, {"name": "i", "type": "industry", "values": ["A", "B"]}]
    g = graph.Graph(graph.from_config(config), {"level": lambda close: F.col(close), "given": lambda facts: facts})
    out = {(r.td, r.tk): r for r in g.exposures(panel, {"facts": table, "inds": inds}, weight="cap", member="m", universes={"m": member, "young": young}, industries="inds", start=str(day(1)), with_subfactors=True).collect()}
    rows = [r for r in panel.collect() if r.td >= day(1)]
    assert len(out) == len(rows)
    for d in {r.td for r in rows}:
        held = [r for r in rows if r.td == d and r.tk < 12]
        x, w = np.array([r.close for r in held]), np.array([r.cap for r in held])
        z = (x - (x * w).sum() / w.sum()) / (x.std(ddof=1) + 1e-8)
        for r, v in zip(held, z, strict=True):
            assert out[d, r.tk].sub_x == pytest.approx(v)
        for r in (r for r in rows if r.td == d):
            o = out[d, r.tk]
            assert (o.sub_x is None) == (r.tk >= 12) and (o.sub_y is None) == (r.tk % 2 == 1 or r.tk == 13)
            assert (o.f is None) == (r.tk == 13)
            assert (o.A, o.B) == (float(d == day(2) and r.tk in (0, 2)), float(d == day(2) and r.tk == 0))


def test_the_models_plan_reads_the_panel_once(spark, sf_dir):
    from panelyx.plans import exposure_queries

    plan = exposure_queries.exposures(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_extendedprice") and len([line for line in plan.splitlines() if "Relation" in line and "l_orderkey" in line]) == 1
    assert len(exposure_queries.model().nodes) == 12


def test_units_come_in_few_phases_and_late():
    reads = {"ret": [], "market": ["ret"], "sums": ["ret", "market"], "slope": ["sums"], "trend": [], "root": [], "size.steps": ["root"], "slope.steps": ["slope", "root"]}
    layouts = {"ret": "tk", "trend": "tk", "root": None, "market": "td", "size.steps": "td", "sums": "tk", "slope": None, "slope.steps": "td"}
    phase, of = graph.phases(layouts, reads)
    assert of == ["tk", "td", "tk", "td"]
    assert phase == {"ret": 0, "market": 1, "trend": 2, "sums": 2, "slope": 2, "root": 3, "size.steps": 3, "slope.steps": 3}
    assert graph.phases(layouts, reads, ["sums"])[0]["slope"] == 3  # its argument is sent anyway
    assert graph.phases({"m": "td", "x": "tk"}, {"m": [], "x": ["m"]}) == ({"m": 0, "x": 1}, ["td", "tk"])
    assert graph.phases({"a": None, "b": None}, {"a": [], "b": ["a"]}) == ({"a": 0, "b": 0}, ["tk"])


def test_the_models_panel_is_laid_out_four_times(spark, sf_dir):
    from panelyx.plans import exposure_queries

    plan, shuffles = exposure_queries.exposures(spark, sf_dir)._jdf.queryExecution().executedPlan(), []
    while True:
        if plan.nodeName() == "AdaptiveSparkPlan":
            plan = plan.executedPlan()
        if plan.nodeName() == "Exchange":
            shuffles.append(plan)
        if not plan.children().size():
            break
        plan = plan.children().apply(0)  # the panel is the left side of every join
    keys = [re.sub(r"#\d+", "", s.outputPartitioning().toString()) for s in shuffles]
    assert [re.sub(r", \d+\)", ")", k) for k in keys] == [f"hashpartitioning({k})" for k in ("td", "tk", "td", "tk", "td, tk")]
    sent = [{s.output().apply(i).name() for i in range(s.output().size())} for s in shuffles]
    assert not any(c.startswith("_w") for columns in sent for c in columns)  # arguments of windows are computed behind their shuffle
    assert not {"max_ret_6", "turnover_sub", "coverage_sub"} & (sent[1] | sent[2] | sent[3])


def plain_medcouple(v):
    v = np.sort(np.asarray(v, float))
    m = np.median(v)
    high, low = v[v >= m], v[v <= m]
    h = []
    for i, a in enumerate(high):
        for j, b in enumerate(low):
            if a == b:  # both the median: by their places among its copies
                p = (v == m).sum()
                h.append(float(np.sign(p - 1 - i - (j - (len(low) - p)))))
            else:
                h.append((a + b - 2 * m) / (a - b))
    return float(np.median(h))


def test_medcouple_equals_the_matrix_of_pairs():
    rng = np.random.default_rng(3)
    cases = [rng.normal(size=n) for n in (1, 2, 3, 11, 50, 101)] + [rng.exponential(size=n) for n in (40, 97)] + [rng.integers(0, k, size=60).astype(float) for k in (1, 2, 3, 7, 20)] + [np.array([0.0, 0.0, 0.0, 1.0, -5.0])]
    for v in cases:
        assert xs.medcouple(v) == pytest.approx(plain_medcouple(v), abs=1e-12)
    assert np.isnan(xs.medcouple(np.array([])))


def test_medcouple_of_a_hundred_thousand_values():
    v = np.random.default_rng(4).lognormal(size=100_000)
    mc = xs.medcouple(v)
    x, y = np.sort(v[v > np.median(v)] - np.median(v)), np.sort(np.median(v) - v[v < np.median(v)])
    # as many of the 2.5 billion pairs lie below as above
    ratio = (1 + mc) / (1 - mc)
    below = int(np.searchsorted(x, y * ratio, "left").sum())
    assert abs(below / (len(x) * len(y)) - 0.5) < 1e-6 and 0.3 < mc < 0.6


def test_boxes_clip_several_columns(spark):
    rng = np.random.default_rng(5)
    rows = [(day(d), i, float(a), float(b)) for d, n in ((0, 60), (1, 10), (2, 35)) for i, (a, b) in enumerate(zip(rng.lognormal(size=n) ** 2, rng.standard_cauchy(size=n), strict=True))]
    rows += [(day(0), 99, None, None)]
    df = spark.createDataFrame(rows, "td date, tk int, a double, b double")
    out = {(r.td, r.tk): r for r in xs.winsorize_boxes(df, ["a", "b"]).collect()}
    for d in range(3):
        for col in (2, 3):
            own = {r[1]: r[col] for r in rows if r[0] == day(d) and r[col] is not None}
            v = np.array(list(own.values()))
            mc, q1, q3 = plain_medcouple(v), *np.quantile(v, [0.25, 0.75])
            k = (-3.5, 4) if mc >= 0 else (-4, 3.5)
            low, high = q1 - 1.5 * np.exp(k[0] * mc) * (q3 - q1), q3 + 1.5 * np.exp(k[1] * mc) * (q3 - q1)
            for tk, x in own.items():
                want = x if len(v) <= 10 else min(max(x, low), high)
                assert out[day(d), tk][col] == pytest.approx(want)
    assert out[day(0), 99].a is None


def test_residuals_around_several_factors(spark):
    rng = np.random.default_rng(6)
    rows = []
    for tk in range(3):
        for i in range(40):
            a, b = rng.normal(size=2)
            y = None if rng.random() < 0.1 else float(2 * a - b + rng.normal())
            rows.append((tk, i, float(a), float(b), float(3 * a + 1) if tk == 1 else float(rng.normal()), y))
    df = spark.createDataFrame(rows, "tk int, ix int, a double, b double, c double, y double")
    out = {(r.tk, r.ix): r.s for r in win.rolling_residual_std(df, "y", ["a", "b", "c"], 15, 8, "s").collect()}
    assert "Python" not in win.rolling_residual_std(df, "y", ["a", "b", "c"], 15, 8, "s")._jdf.queryExecution().executedPlan().toString()
    for tk, i, *_ in rows:
        part = np.array([r[2:] for r in rows if r[0] == tk and i - 15 < r[1] <= i and r[5] is not None], float)
        if len(part) < 8:
            assert out[tk, i] is None
            continue
        x = np.column_stack([np.ones(len(part)), part[:, :3]])
        residual = part[:, 3] - x @ np.linalg.lstsq(x, part[:, 3], rcond=None)[0]
        assert out[tk, i] == pytest.approx(residual.std(), rel=1e-6)


def test_the_graphs_own_residual_equals_the_operators(spark):
    rng = np.random.default_rng(7)
    rows = [(tk, i, *map(float, rng.normal(size=4))) for tk in range(2) for i in range(30)]
    df = spark.createDataFrame(rows, "tk int, ix int, ret double, market_return double, smb double, hml double")
    f = risk_formulas.FORMULAS
    df = df.withColumn("factor_products", f["factor_products"]("ret", "market_return", "smb", "hml", window=12))
    for before, name in zip(("factor_products", "less_constant", "less_market", "less_size"), ("less_constant", "less_market", "less_size", "less_all"), strict=True):
        df = df.withColumn(name, f[name](before))
    df = win.rolling_residual_std(df.withColumn("ivff", f["ivff"]("less_all", min_periods=6)), "ret", ["market_return", "smb", "hml"], 12, 6, "want")
    out = df.select("ivff", "want").collect()
    assert sum(r.want is not None for r in out) == 50
    for r in out:
        assert r.ivff == (None if r.want is None else pytest.approx(r.want))


def calendar(spark, days):
    return spark.createDataFrame([(d, i) for i, d in enumerate(days)], "td date, ix int")


def test_institution_share(spark):
    days = calendar(spark, [dt.date(2020, 4, 29), dt.date(2020, 5, 6), dt.date(2020, 8, 28), dt.date(2020, 9, 1), dt.date(2021, 4, 29), dt.date(2021, 5, 3)])
    rows = [
        (1, dt.date(2019, 12, 31), dt.date(2020, 1, 20), 5e4), (1, dt.date(2019, 12, 31), dt.date(2020, 4, 30), 5e4), (1, dt.date(2019, 12, 31), dt.date(2020, 5, 1), 9e9),  # the last is too late
        (2, dt.date(2019, 12, 31), dt.date(2020, 4, 1), 4e4), (3, dt.date(2019, 12, 31), dt.date(2020, 4, 1), 4e4), (1, dt.date(2020, 3, 31), dt.date(2020, 4, 1), 7e9),  # the quarter does not count
        (2, dt.date(2020, 6, 30), dt.date(2020, 8, 1), 8e4), (1, dt.date(2020, 12, 31), dt.date(2021, 1, 1), None), (None, dt.date(2020, 12, 31), dt.date(2021, 1, 1), 1.0), (2, dt.date(2021, 12, 31), dt.date(2022, 1, 1), 1.0),
    ]
    holdings = spark.createDataFrame(rows, "tk int, end_dt date, ann_dt date, quantity double")
    shares = spark.createDataFrame([(d, tk, s) for d in (dt.date(2020, 4, 29), dt.date(2020, 8, 28), dt.date(2021, 4, 29)) for tk, s in ((1, 10.0), (2, 4.0), (3, 0.0))], "td date, tk int, shares double")
    out = {(r.td, r.tk): r.v for r in risk.institution_share(holdings, shares, days).collect()}
    # name 1 has nothing in the second report, so on that date it has nothing: the fill is by date, not by name
    assert out == {(dt.date(2020, 4, 29), 1): 1.0, (dt.date(2020, 4, 29), 2): 1.0, (dt.date(2020, 5, 6), 1): 1.0, (dt.date(2020, 5, 6), 2): 1.0, **{(d, 2): 2.0 for d in (dt.date(2020, 8, 28), dt.date(2020, 9, 1), dt.date(2021, 4, 29), dt.date(2021, 5, 3))}}


def test_state_share_takes_the_latest_change_and_announcement(spark):
    days = calendar(spark, [day(0), day(1), day(5)])
    rows = [(1, day(1), day(0), 1.0, 4.0), (1, day(1), day(1), 2.0, 4.0), (1, day(3), day(0), 3.0, 4.0), (1, day(4), day(0), 1.0, 0.0), (2, day(-3), day(0), 1.0, 2.0), (2, day(9), day(0), 1.0, 2.0)]
    out = {(r.td, r.tk): r.v for r in risk.state_share(spark.createDataFrame(rows, "tk int, ann_dt date, change_dt date, state double, total double"), days).collect()}
    assert out == {(day(1), 1): None, (day(5), 2): 0.5}


def test_snap_back_on_gaps_and_ends(spark):
    days = calendar(spark, [day(0), day(1), day(5)])
    events = spark.createDataFrame([(i, day(i)) for i in (-1, 0, 1, 3, 5, 50)] + [(99, None)], "i int, d date")
    for strictly, want in ((False, {-1: None, 0: day(0), 1: day(1), 3: day(1), 5: day(5), 50: day(5), 99: None}), (True, {-1: None, 0: None, 1: day(0), 3: day(1), 5: day(1), 50: day(5), 99: None})):
        assert {r.i: r.td for r in joins.snap_back(events, days, "d", strictly=strictly).collect()} == want


def facts_frame(spark, seed, n=160):
    rng = random.Random(seed)
    rows = [(rng.randrange(4), day(rng.randrange(60)), 8000 + rng.randrange(9), rng.choice([0.0, 1.5, -2.0, 7.0]) + rng.randrange(5)) for _ in range(n)]
    rows.sort(key=lambda r: (r[0], r[1], r[2]))
    return [(*r, i + 1) for i, r in enumerate(rows)], spark.createDataFrame([(*r, i + 1) for i, r in enumerate(rows)], "tk int, ann date, q int, v double, rid long")


def test_two_inputs_meet_as_in_a_loop(spark):
    a, x = facts_frame(spark, 1)
    b, y = facts_frame(spark, 2)
    out = {(r.tk, r.rid): r.v for r in pit.combine(x, y, "multiply").collect()}
    want = {}
    for tk, ann, q, v, rid in a:
        seen = [(q2, ann2, rid2, v2) for tk2, ann2, q2, v2, rid2 in b if tk2 == tk and q2 <= q and ann2 <= ann]
        if seen:
            want[tk, rid] = v * max(seen)[3]
    assert out == want and len(want) > 100


def test_history_and_visible_as_in_a_loop(spark):
    a, x = facts_frame(spark, 3)
    found = {r.rid: r for r in pit.visible(x, 2, "o").join(pit.history(x, 4).select("rid", "h"), "rid").collect()}
    for tk, ann, q, v, rid in a:
        latest = lambda k: max(((n, i, w) for t, n, z, w, i in a if t == tk and z == k and n <= ann), default=(None, None, None))[2]  # noqa: B023, E731
        assert found[rid].o == latest(q - 2) and found[rid].v == v
        assert [(h.q, h.v) for h in found[rid].h] == [(k, latest(k)) for k in range(q - 3, q + 1) if latest(k) is not None]


def test_the_two_newest_quarters_as_in_a_loop(spark):
    a, x = facts_frame(spark, 5, 70)
    got = sorted((r.tk, r.ann, r.place, r.q, r.v) for r in pit.newest_two(x).collect())
    want = []
    for tk, ann in sorted({(r[0], r[1]) for r in a}):
        seen = [r for r in a if r[0] == tk and r[1] <= ann]
        several = sum(r[1] == ann for r in seen) > 1
        newest = sorted(r[2] for r in seen)[-2:] if several else [max(r[2] for r in seen)]
        for place, q in zip((1, 2) if several else (2,), newest, strict=True):
            want.append((tk, ann, place, q, max((r[1], r[4], r[3]) for r in seen if r[2] == q)[2]))
    assert got == sorted(want) and len({w[:2] for w in want}) < len(want)


def test_growth_over_nothing_but_zeros_gives_no_row(spark):
    f = spark.createDataFrame([(1, day(i), 8000 + i, 0.0, i) for i in range(5)], "tk int, ann date, q int, v double, rid long")
    assert pit.window_stat(f, "cagr", 4).collect() == []


def test_a_calendar_has_to_be_one(spark):
    with pytest.raises(ValueError, match="more than 3 dates"):
        joins.local(calendar(spark, [day(i) for i in range(4)]), 3)


def test_regression_on_lagged_volumes_equals_least_squares(spark):
    from panelyx.operators import intraday

    rng = np.random.default_rng(9)
    rows = [(day(d), tk, b, float(rng.normal()), float(rng.integers(1, 50))) for d in range(3) for tk in range(2) for b in range((30, 12, 5)[d])]
    df = spark.createDataFrame(rows, "td date, tk int, bar int, ret double, volume double")
    out = {(r.td, r.tk): r for r in intraday.lag_regression(df, 2).collect()}
    assert "Python" not in intraday.lag_regression(df, 2)._jdf.queryExecution().executedPlan().toString()
    for d in range(3):
        for tk in range(2):
            own = [r for r in rows if r[0] == day(d) and r[1] == tk]
            dv = np.diff([r[4] for r in own])
            x = np.column_stack([np.ones(len(dv) - 2), dv[2:], dv[1:-1], dv[:-2]])
            y = np.array([r[3] for r in own])[3:]
            n, k = x.shape
            r = out[day(d), tk]
            if n <= k:
                assert r.t_std is None and r.f_value is None
                continue
            b = np.linalg.lstsq(x, y, rcond=None)[0]
            mse = ((y - x @ b) ** 2).sum() / (n - k)
            t = b / np.sqrt(mse * np.diag(np.linalg.inv(x.T @ x)))
            assert r.t_std == pytest.approx(t[1:].std()) and r.intercept_t == pytest.approx(t[0]) and r.f_value == pytest.approx(((x @ b - y.mean()) ** 2).sum() / (k - 1) / mse)
