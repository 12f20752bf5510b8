"""Whole reports against day-by-day loops."""

import datetime as dt
import statistics as st

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelyx.operators import joins, report

DAYS = [dt.date(2019, 11, 4) + dt.timedelta(days=4 * i) for i in range(60)]


@pytest.fixture(scope="module")
def market(spark):
    rng = np.random.default_rng(1)
    bars = {}
    for tk in range(17):
        price = 10.0
        for i in range(len(DAYS)):
            price *= float(np.exp(rng.normal() / 25))
            if rng.random() < 0.85:
                bars[tk, i] = (price, price * float(np.exp(rng.normal() / 90)), None if rng.random() < 0.1 else round(float(rng.normal()), 1))
    rows = [(DAYS[i], tk, i, c, v, f) for (tk, i), (c, v, f) in bars.items()]
    days = joins.calendar(spark.createDataFrame([(d,) for d in DAYS], "td date")).cache()
    return bars, spark.createDataFrame(rows, "td date, tk int, ix int, close double, vwap double, f double"), days


def plain(bars, chosen, groups, deal):
    """Daily returns and turnovers of each group, one day after the other."""
    change = lambda tk, i, a, b: 0.0 if a is None or b is None else b / a - 1
    close = lambda tk, i: bars[tk, i][0] if (tk, i) in bars else None
    dealt = lambda tk, i: bars[tk, i][1] if (tk, i) in bars else None
    daily, turns = {}, {}
    for g in range(1, groups + 1):
        weights = None
        for i in range(chosen[0], len(DAYS)):
            if i == chosen[0]:
                daily[g, i] = 0.0
                continue
            if i - 1 in chosen:
                names = sorted((bars[tk, i - 1][2], tk) for tk in range(17) if (tk, i - 1) in bars and bars[tk, i - 1][2] is not None)
                size = len(names) // groups
                new = {tk: 1 / size for _, tk in names[size * (g - 1) : size * g]}
                old, gain = weights, 1.0
                if old is not None and deal != "preclose":
                    sold = {tk: w * (1 + change(tk, i, close(tk, i - 1), dealt(tk, i))) for tk, w in old.items()}
                    gain = sum(sold.values())
                    old = {tk: w / gain for tk, w in sold.items()}
                if old is not None:
                    turns[g, i] = sum(abs(old.get(tk, 0) - new.get(tk, 0)) for tk in {*old, *new})
                first = weights is None or deal == "preclose"
                grown = {tk: w * (1 + (change(tk, i, close(tk, i - 1), close(tk, i)) if first else change(tk, i, dealt(tk, i), close(tk, i)))) for tk, w in new.items()}
                daily[g, i] = gain * sum(grown.values()) - 1
            else:
                grown = {tk: w * (1 + change(tk, i, close(tk, i - 1), close(tk, i))) for tk, w in weights.items()}
                daily[g, i] = sum(grown.values()) - 1
            whole = sum(grown.values())
            weights = {tk: w / whole for tk, w in grown.items()}
    return daily, turns


CHOSEN = [5, 6, 19, 33, 50]


@pytest.fixture(scope="module", params=["preclose", "vwap"])
def tested(request, spark, market):
    bars, panel, days = market
    chosen = days.filter(F.col("ix").isin([*CHOSEN, len(DAYS) - 1]))
    return request.param, report.test_factor(panel, "f", 3, days, chosen, deal=request.param, per_year=90, rebalances=6.0)


def test_daily_returns_and_turnover_equal_the_loop(market, tested):
    deal, out = tested
    daily, turns = plain(market[0], CHOSEN, 3, deal)
    got = {(r.grp, r.ix): r.ret for r in out["daily"].collect()}
    assert set(got) == set(daily)
    for key, value in daily.items():
        assert got[key] == pytest.approx(value, abs=1e-12), key
    got = {(r.grp, r.ix): r.turnover for r in out["turnover"].collect()}
    assert set(got) == set(turns) and all(got[k] == pytest.approx(v) for k, v in turns.items())


def test_names_are_laid_out_with_their_last_value(spark, market):
    bars, panel, days = market
    plan = report.schedule(days, days.filter(F.col("ix").isin(CHOSEN)))
    own = report.held(report.grouped(report.prices(panel), "f", 3), plan)
    laid = report.laid_out(own, plan)
    value = {(r.grp, r.ix): r.v for r in laid.groupBy("grp", "ix").agg(F.sum("grown").alias("v")).collect()}
    daily, _ = plain(bars, CHOSEN, 3, "preclose")
    for g in (1, 2, 3):
        at = 1.0
        for i in range(CHOSEN[0] + 1, len(DAYS)):
            at = (1.0 if i - 1 in CHOSEN else at) * (1 + daily[g, i])
            assert value[g, i] == pytest.approx(at)
    assert laid.groupBy("seg", "tk", "ix").count().filter("count > 1").count() == 0


def test_coefficients_and_the_table_by_period(market, tested):
    bars, _, _ = market
    deal, out = tested
    ic = {}
    for a, b in zip(CHOSEN, CHOSEN[1:], strict=False):
        x = [(bars[tk, a][2], bars[tk, b][0] / bars[tk, a][0] - 1 if (tk, b) in bars else 0.0) for tk in range(17) if (tk, a) in bars and bars[tk, a][2] is not None]
        ic[a] = float(np.corrcoef(np.array(x).T)[0, 1])
    got = {r.td: r.ic for r in out["coefficients"].collect()}
    assert got == {DAYS[a]: pytest.approx(v) for a, v in ic.items()}
    daily, turns = plain(bars, CHOSEN, 3, deal)
    table = {r.period: r for r in out["performance"].collect()}
    assert set(table) == {"2019", "2020", "all"}
    for period, r in table.items():
        days = [i for i in range(CHOSEN[0], len(DAYS)) if period in ("all", str(DAYS[i].year))]
        lms = np.array([daily[3, i] - daily[1, i] for i in days])
        nav = np.cumprod(1 + lms)
        assert r.lms_max_drawdown == pytest.approx((nav / np.maximum.accumulate(nav) - 1).min(), abs=1e-12) and r.lms_win == pytest.approx((lms > 0).mean())
        assert r.lms_annual == pytest.approx(nav[-1] ** (90 / (len(days) - 1)) - 1 if period == "all" else nav[-1] - 1)
        assert r.lmm_sharpe == pytest.approx((x := np.array([daily[3, i] - np.mean([daily[g, i] for g in (1, 2, 3)]) for i in days])).mean() / x.std(ddof=1) * 90**0.5)
        own = [v for (g, i), v in turns.items() if g == 3 and i in days]
        assert r.long_turnover == (pytest.approx(sum(own) / len(own) * 6 if period == "all" else sum(own)) if own else None)
        mine = [v for a, v in ic.items() if a in days]
        assert r.ic == (pytest.approx(np.mean(mine)) if mine else None)


def figures(returns, months, per_year):
    """returns: (day, return), the first one is the base."""
    r = np.array([x for _, x in returns])
    nav = np.cumprod(1 + r)
    dd = nav / np.maximum.accumulate(nav) - 1
    at_month = [n for (d, _), n in zip(returns, nav, strict=True) if d in months]
    month = [b / a - 1 for a, b in zip(at_month, at_month[1:], strict=False)]
    runs, run = [], []
    for (d, _), x in zip([*returns, (None, 0)], [*dd, 0.0], strict=True):
        if x < 0:
            run.append((x, d))
        elif run:
            runs.append(run)
            run = []
    deep = [x for x in runs if min(x)[0] < -0.01]
    total = nav[-1] - 1
    annual = (1 + total) ** (per_year / (len(r) - 1)) - 1
    worst = min(runs, key=lambda x: min(x)[0]) if runs else None
    falls = [min((n / max(part[: k + 1]) - 1 for k, n in enumerate(part)), default=0) for part in (nav[max(0, i - 59) : i + 1] for i in range(len(nav)))]
    return {
        "total": total, "annual": annual, "max_drawdown": dd.min(), "daily_win": (r[1:] > 0).mean(), "monthly_win": np.mean([m > 0 for m in month]) if month else None, "volatility": r.std(ddof=1) * per_year**0.5, "sharpe": annual / (r.std(ddof=1) * per_year**0.5) if r.std() else None,
        "drop_share": (r[1:] < -0.005).mean(), "rolling_drawdown": st.median(falls), "deep_count": len(deep), "deep_depth": np.mean([min(x)[0] for x in deep]) if deep else 0.0, "deep_days": np.mean([len(x) for x in deep]) if deep else 0.0, "worst": (worst[0][1], worst[-1][1]) if worst else (None, None),
    }


def test_portfolio_report_equals_plain_figures(spark, market):
    _, _, days = market
    rng = np.random.default_rng(3)
    own = {i: 0.0 if i == 4 else float(rng.normal() / 60) for i in range(4, len(DAYS))}
    base = {i: float(rng.normal() / 90) for i in range(2, len(DAYS)) if i != 30}
    turns = {9: 0.5, 20: 1.5, 31: 0.0, 40: 0.25}
    frame = lambda x, c, **more: spark.createDataFrame([(1, DAYS[i], v) for i, v in x.items()], f"grp int, td date, {c} double")
    out = {r.period: r for r in report.portfolio_report(frame(own, "ret"), frame(turns, "turnover"), days, benchmark=frame(base, "ret").drop("grp"), per_year=90).collect()}
    months = {r.td for r in days.filter("is_month_end = 1").collect()}
    paid = {i: v - 0.0015 * turns.get(i, 0) for i, v in own.items()}
    held = {i: 0.0 if i == 4 else base.get(i, 0.0) for i in own}
    series = {"own": paid, "base": held, "excess": {i: (1 + paid[i]) / (1 + held[i]) - 1 for i in own}}
    assert set(out) == {"2019", "2020", "all"}
    for period, r in out.items():
        want = {}
        for name, values in series.items():
            inside = [i for i in values if period == "all" or str(DAYS[i].year) == period]
            first = inside[0] if inside[0] == 4 else inside[0] - 1
            inside = sorted({first, *inside})
            want[name] = figures([(DAYS[i], 0.0 if i == first else values[i]) for i in inside], months, 90)
        gain = "annual" if period == "all" else "total"
        assert (r.own, r.base, r.excess) == tuple(pytest.approx(want[s][gain]) for s in ("own", "base", "excess"))
        e = want["excess"]
        for c in ("max_drawdown", "daily_win", "monthly_win", "drop_share", "rolling_drawdown", "deep_count", "deep_depth", "deep_days"):
            assert getattr(r, c) == (None if e[c] is None else pytest.approx(e[c])), (period, c)
        assert r.tracking_error == pytest.approx(e["volatility"]) and r.information_ratio == pytest.approx(e["sharpe"]) and r.sharpe == pytest.approx(want["own"]["sharpe"])
        assert (r.worst_since, r.worst_until) == e["worst"]
        changes = [(DAYS[i].year, v) for i, v in turns.items() if v and (period == "all" or str(DAYS[i].year) == period)]
        per = [sum(y == k for y, _ in changes) for k in sorted({y for y, _ in changes})]
        assert r.turnover_each == (pytest.approx(np.mean([v for _, v in changes])) if changes else None)
        assert r.turnover_year == (pytest.approx(np.mean([v for _, v in changes]) * st.median(per)) if changes else None)


def test_a_portfolio_that_never_falls(spark, market):
    _, _, days = market
    flat = spark.createDataFrame([(1, d, 0.0 if i == 0 else 0.001) for i, d in enumerate(DAYS)], "grp int, td date, ret double")
    none = spark.createDataFrame([], "grp int, td date, turnover double")
    out = {r.period: r for r in report.portfolio_report(flat, none, days).collect()}
    r = out["all"]
    assert r.max_drawdown == 0 and r.worst_since is None and r.deep_count == 0 and r.deep_depth == 0 and r.daily_win == 1.0 and r.turnover_year is None and r.base == 0


def test_weights_are_equal_where_none_are_given(spark):
    rows = spark.createDataFrame([(DAYS[0], 1, 0.7), (DAYS[0], 2, 0.3), (DAYS[1], 1, 1.0)], "td date, tk int, weight double")
    assert [r.w0 for r in report.equal_weights(rows).orderBy("td", "tk").collect()] == [0.7, 0.3, 1.0]
    assert [r.w0 for r in report.equal_weights(rows.drop("weight")).orderBy("td", "tk").collect()] == [0.5, 0.5, 1.0]


def test_net_performance_reads_the_line_items_twice_at_most(spark, sf_dir):
    from panelyx.plans import QUERIES

    for name in ("net_performance", "portfolio_turnover", "portfolio_return", "portfolio_return_vwap"):
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
        assert sum("Relation" in line and "l_orderkey" in line for line in plan.splitlines()) <= 2, name


def test_a_group_without_names_holds_nothing(spark):
    days = joins.calendar(spark.createDataFrame([(d,) for d in DAYS[:8]], "td date"))
    # four names, but only one of them with a factor at the second decision: two groups of half a name each
    rows = [(DAYS[i], tk, i, 10.0 * 1.1**i, None if i == 3 and tk else float(tk)) for i in range(8) for tk in range(4)]
    panel = spark.createDataFrame(rows, "td date, tk int, ix int, close double, f double")
    out = report.test_factor(panel, "f", 2, days, days.filter(F.col("ix").isin([1, 3, 5])))
    daily = {(r.grp, r.ix): r.ret for r in out["daily"].collect()}
    assert daily == {(g, i): pytest.approx(0.1 if i in (2, 3, 6, 7) else 0.0) for g in (1, 2) for i in range(1, 8)}
    assert {(r.grp, r.ix): r.turnover for r in out["turnover"].collect()} == {(g, i): 1.0 for g in (1, 2) for i in (4, 6)}
