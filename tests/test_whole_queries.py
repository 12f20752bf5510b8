"""Queries without SQL cover their whole table: brute force in pandas."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelyx.operators import dataset, factors, joins, pit
from panelyx.plans import QUERIES
from panelyx.plans.more_queries import items
from panelyx.plans.panel_queries import momentum
from panelyx.plans.roles import table, weekly


@pytest.mark.parametrize("name", ["bp", "ep_ttm", "ep_mrq", "np_mrq_yoy", "roe_ttm", "roe_mrq_yoy", "eps_ttm_qoq"])
def test_factors_on_every_week(name, spark, sf_dir):
    """The chain's facts, held by a loop over the weeks."""
    recipe = factors.LIBRARY[name]
    of = items(spark, sf_dir)
    f = of(recipe.item)
    if recipe.per:
        per = of(recipe.per)
        # profits count with the shares of their date of announcement alone
        f = f.join(per.select("tk", "rid"), ["tk", "rid"], "left_semi") if recipe.per == "shares" else f
        f = pit.combine(pit.trailing_year(f), pit.window_stat(per, "mean", 4))
    chained = pit.chain(f, recipe.steps)
    days = sorted(r.td for r in joins.calendar(weekly(spark, sf_dir)).collect())
    cap = {r.c_custkey: abs(r.c_acctbal) + 1 for r in table(spark, sf_dir, "customer").collect()}
    want = {}
    for tk, rows in chained.toPandas().sort_values(["ann", "q", "rid"]).groupby("tk"):
        rows = list(rows.itertuples(index=False))
        starts = [max([d for d in days if d < r.ann], default=days[0]) for r in rows]
        for k, r in enumerate(rows):
            until = r.ann + dt.timedelta(days=365)
            if k + 1 < len(rows):
                until = min(until, starts[k + 1] - dt.timedelta(days=1))
            for d in days:
                if starts[k] <= d <= until and r.q >= d.year * 4 + (d.month - 1) // 3 - 4 and (not recipe.value or tk in cap):
                    want[d, tk] = r.v / cap[tk] if recipe.value else r.v
    got = {(r.td, r.tk): r.v for r in QUERIES[f"factor_{name}"](spark, sf_dir).collect()}
    assert got.keys() == want.keys() and (not want or len({d for d, _ in want}) > len(days) / 8)
    assert all(got[k] == pytest.approx(want[k], abs=6e-6, rel=1e-9) for k in want)


def test_tree_forecast_tests_every_year_with_four_before_it(spark, sf_dir):
    p = momentum(spark, sf_dir).selectExpr("td", "tk", "mom", "ln(amount) size", "ln(1 + volume) heavy", "high / low - 1 swing", "fwd").toPandas().dropna()
    years = pd.to_datetime(p.td).dt.year
    first = weekly(spark, sf_dir).agg(F.min(F.year("td"))).first()[0]
    p = p[years >= first + 4]
    want = {(r.td, r.tk): r.z for r in p.assign(z=p.groupby("td").fwd.transform(lambda x: (x - x.mean()) / x.std(ddof=0))).itertuples()}
    out = QUERIES["tree_forecast"](spark, sf_dir).collect()
    assert {r.td.year for r in out} == {d.year for d, _ in want} and len({r.td.year for r in out}) > 1
    assert all(r.label == pytest.approx(want[r.td, r.tk], abs=2e-6) for r in out)


def similar_panel():
    rng = np.random.default_rng(0)
    rows = [(tk, ix, float(rng.normal() + (ix % 3 if tk % 2 else 0)), float(rng.normal())) for tk in range(9) for ix in range(14) if rng.random() > 0.15]
    return [(t, i, None if i == 0 else 1.5 if t == 8 else r, None if i > 11 else y) for t, i, r, y in rows]


def test_similar_labels_on_every_full_window(spark):
    rows = similar_panel()
    p = spark.createDataFrame(rows, "tk int, ix int, r double, y double")
    got = {(r.ix, r.tk): (r.similar_label, r.near_mean, r.near_std) for r in dataset.rolling_similar_labels(p, length=6, neighbours=3).collect()}
    assert {ix for ix, _ in got} == set(range(6, 12))
    for at in range(6, 12):
        one = dataset.similar_labels(p.filter(f"ix between {at - 5} and {at} and r is not null").select("tk", "ix", "r"), p.filter(f"ix = {at} and y is not null").select("tk", "y"), neighbours=3)
        want = {(at, r.tk): (r.similar_label, r.near_mean, r.near_std) for r in one.collect()}
        assert {k for k in got if k[0] == at} == want.keys()
        assert all(got[k][i] == pytest.approx(want[k][i]) for k in want for i in range(3))


def test_similar_labels_query_covers_all_dates(spark, sf_dir):
    out = QUERIES["label_similar"](spark, sf_dir)
    assert out.select("td").distinct().count() > 200
    assert out.groupBy("td", "tk").count().filter("count > 1").isEmpty()
