"""The whole consensus and the three-factor run against plain loops."""

import datetime as dt
import random
from collections import defaultdict

import pytest

from panelyx.operators import analyst, three_factors

DAYS = [dt.date(2019, 6, 3) + dt.timedelta(days=4 * i) for i in range(230)]
EST = "tk int, inst int, est_dt date, period date, est double, seq int"
REP = "tk int, ann_dt date, period date, profit double, seq int, statement_type string"


def days(spark):
    return spark.createDataFrame([(d, i) for i, d in enumerate(DAYS)], "td date, ix int")


def year(y):
    return dt.date(y, 12, 31)


def plain(estimates, reports, window, half_life, year_positions):
    ix = {d: i for i, d in enumerate(DAYS)}
    snap = lambda d: max((x for x in DAYS if x <= d), default=None)
    first = {y: min(i for d, i in ix.items() if d.year == y) for y in {d.year for d in DAYS}}
    out = {}
    for tk in {e[0] for e in estimates}:
        own = [(snap(e[2]), *e[1:]) for e in estimates if e[0] == tk and e[4] and snap(e[2])]
        own_reports = sorted((r for r in reports if r[0] == tk), key=lambda r: (r[1], r[4]))
        for t in DAYS:
            known = [r for r in own_reports if r[1] <= t]
            seen = [e for e in own if ix[t] - window <= ix[e[0]] <= ix[t]]
            if not known or not seen:
                continue
            period, lr = known[-1][2], known[-1][3]
            values = [lr]
            for k in (1, 2, 3):
                newest = defaultdict(list)
                for e in seen:
                    if e[3] == year(period.year + k):
                        newest[e[1]].append((ix[e[0]], e[5], e[4]))
                best = [max(v) for v in newest.values()]
                w = [0.5 ** ((ix[t] - b[0]) / half_life) for b in best]
                values.append(sum(b[2] * 10_000 * x for b, x in zip(best, w, strict=True)) / sum(w) if best else None)
            gap, day = t.year - period.year, ix[t] - first[t.year] + 1
            left, done = max(year_positions - day, 0), max(day, 0)
            at = [values[g] if 0 <= g < 4 else None for g in (gap, gap + 1)]
            out[t, tk] = (period, *values, None if None in at else (at[0] * left + at[1] * done) / (left + done))
    return out


def check(spark, estimates, reports, **options):
    out = analyst.consensus(spark.createDataFrame(estimates, EST), spark.createDataFrame([(*r, "a") for r in reports], REP), days(spark), **options).collect()
    want = plain(estimates, reports, options.get("window", 122), options.get("half_life", 21.0), options.get("year_positions", 252))
    got = {(r.td, r.tk): (r.last_period, r.lr, r.fy0, r.fy1, r.fy2, r.fttm) for r in out}
    assert set(got) == set(want) and len(out) == len(got)
    for key, values in want.items():
        assert got[key][0] == values[0]
        for a, b in zip(got[key][1:], values[1:], strict=True):
            assert a == (None if b is None else pytest.approx(b)), key
    return got


def test_consensus_equals_a_loop(spark):
    rng = random.Random(1)
    some = lambda: DAYS[0] + dt.timedelta(days=rng.randrange(-40, 900))
    estimates = [(rng.randrange(3), rng.randrange(4), some(), year(rng.randrange(2018, 2025)), rng.choice([0.0, None, 1.0, 5.5, -2.0]), i) for i in range(220)]
    reports = [(rng.randrange(3), some(), year(rng.randrange(2017, 2021)), float(i), i) for i in range(14)]
    got = check(spark, estimates, reports, window=30, half_life=5.0, year_positions=60)
    assert len(got) > 300 and sum(v[-1] is not None for v in got.values()) > 50


def test_a_new_report_moves_the_targets(spark):
    estimates = [(1, 1, DAYS[0], year(2019), 1.0, 0), (1, 1, DAYS[1], year(2020), 2.0, 1), (1, 1, DAYS[1], year(2021), 3.0, 2), (1, 2, DAYS[1], year(2020), 4.0, 3), (1, 2, DAYS[1], year(2020), 6.0, 4)]
    got = check(spark, estimates, [(1, DAYS[2], year(2018), 9.0, 1), (1, DAYS[5] - dt.timedelta(days=1), year(2019), 8.0, 2)], window=10)
    assert (DAYS[1], 1) not in got and (DAYS[11], 1) in got and (DAYS[12], 1) not in got
    rounded = lambda i: [x if x is None or isinstance(x, dt.date) else round(x, 6) for x in got[DAYS[i], 1][:5]]
    assert rounded(4) == [year(2018), 9.0, 10_000.0, 40_000.0, 30_000.0] and rounded(5) == [year(2019), 8.0, 40_000.0, 30_000.0, None]


def test_reports_of_a_year_behind_and_of_the_same_year(spark):
    estimates = [(1, 1, DAYS[-30], year(y), float(y), y) for y in range(2019, 2025)]
    for last in (2017, 2018, 2019, 2020, 2021, 2022):
        check(spark, estimates, [(1, DAYS[0], year(last), 7.0, 1)])


def test_whole_years_of_one_type(spark):
    rows = spark.createDataFrame([(1, DAYS[0], year(2019), 1.0, 1, "a"), (1, DAYS[0], dt.date(2019, 6, 30), 1.0, 2, "a"), (1, DAYS[0], year(2019), 1.0, 3, "b"), (1, None, year(2019), 1.0, 4, "a")], REP)
    assert [r.seq for r in analyst.annual_reports(rows, statement_type="a").collect()] == [1]
    assert [r.seq for r in analyst.annual_reports(rows).orderBy("seq").collect()] == [1, 3]


def test_no_estimates(spark):
    assert analyst.consensus(spark.createDataFrame([], EST), spark.createDataFrame([], REP), days(spark)).collect() == []


def test_three_factors_equal_a_loop(spark):
    import numpy as np

    rng = np.random.default_rng(2)
    rows = [(DAYS[i], tk, i, float(rng.normal() / 8), float(rng.integers(1, 9)), float(rng.normal()) + 3) for i in range(40) for tk in range(25) if rng.random() < 0.85]
    index = [(DAYS[i], float(i) / 100) for i in range(40) if i != 20]
    panel = spark.createDataFrame(rows, "td date, tk int, ix int, ret double, cap double, pb double")
    out = {r.td: (r.hml, r.smb, r.mkt) for r in three_factors.run(panel, spark.createDataFrame(index, "td date, ret double"), positions=10).collect()}
    by = {(r[1], r[2]): r for r in rows}

    def spread(i, indicator, cuts):
        names = [tk for tk in range(25) if (tk, i) in by]
        x = {tk: indicator(by[tk, i - 1]) for tk in names if (tk, i - 1) in by}
        p = np.quantile(list(x.values()), cuts) if x else []
        fit = {tk: by[tk, i][3] for tk in names if (i < 10 or (tk, i - 10) in by) and abs(by[tk, i][3]) <= 0.2}
        first, last = [fit[t] for t in fit if t in x and x[t] <= p[1]], [fit[t] for t in fit if t in x and x[t] > p[-2]]
        return np.mean(first) - np.mean(last) if first and last else None

    for i in range(40):
        want = (spread(i, lambda r: 1 / r[5], [0, 0.3, 0.7, 1]), spread(i, lambda r: r[4], [0, 0.5, 1])) if i else (None, None)
        if None in want or i == 20:
            assert DAYS[i] not in out
        else:
            assert out[DAYS[i]] == (pytest.approx(want[0]), pytest.approx(want[1]), i / 100)
    assert len(out) > 30
    turned = {r.td: r.hml for r in three_factors.run(panel, spark.createDataFrame(index, "td date, ret double"), positions=10, sign=-1).collect()}
    assert all(turned[d] == pytest.approx(-v[0]) for d, v in out.items())
