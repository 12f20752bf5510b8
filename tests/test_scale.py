"""Work that grows with the input: right results on odd inputs, and how many rows are laid out on the way."""

import datetime as dt
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelyx.functions import cross_section as xs
from panelyx.functions import windows as win
from panelyx.operators import dataset, factors, pit, processing
from panelyx.plans import QUERIES
from panelyx.sources import stores


def laid_out(df) -> int:
    """Rows that explode makes, of a plan that has run."""
    total = 0

    def walk(plan):
        nonlocal total
        name = plan.nodeName()
        if name == "Generate":
            total += plan.metrics().apply("numOutputRows").value()
        if name == "AdaptiveSparkPlan":
            return walk(plan.executedPlan())
        if name.endswith("QueryStage"):
            return walk(plan.plan())
        for i in range(plan.children().size()):
            walk(plan.children().apply(i))

    plan = df._jdf.queryExecution()
    plan.executedPlan().execute().count()
    walk(plan.executedPlan())
    return total


DAY = dt.date(2000, 1, 1)


def versions(n: int, seed: int, ordered: bool):
    """tk, ann, q, v, rid; ordered: later announcements are of later quarters."""
    r = random.Random(seed)
    rows = [(r.randrange(4), DAY + dt.timedelta(days=r.randrange(300)), r.randrange(8000, 8012), float(r.randrange(1, 50))) for _ in range(n)]
    if ordered:
        rows = [(tk, ann, 8000 + (ann - DAY).days // 30, v) for tk, ann, _, v in rows]
    return [(*row, i) for i, row in enumerate(sorted(rows))]


FACT = "tk int, ann date, q int, v double, rid bigint"


@pytest.mark.parametrize("ordered", [False, True])
def test_combine_in_any_order_of_quarters(spark, ordered):
    xs, ys = versions(60, 1, ordered), versions(60, 2, ordered)
    want = {}
    for tk, ann, q, v, rid in xs:
        seen = [(y[2], y[1], y[4], y[3]) for y in ys if y[0] == tk and y[1] <= ann and y[2] <= q]
        if seen:
            want[tk, rid] = v / max(seen)[3]
    got = {(r.tk, r.rid): r.v for r in pit.combine(spark.createDataFrame(xs, FACT), spark.createDataFrame(ys, FACT)).collect()}
    assert got == pytest.approx(want)


def test_combine_lays_out_only_what_is_open(spark):
    f = spark.createDataFrame(versions(120, 3, True), FACT)
    out = pit.combine(f.filter("rid % 2 = 1"), f.filter("rid % 2 = 0"))
    assert laid_out(out) <= 60


def test_combine_own_is_combine(spark):
    f = spark.createDataFrame(versions(120, 4, False), FACT)
    two = pit.combine(f.filter("rid % 2 = 1"), f.filter("rid % 2 = 0"), "multiply")
    assert sorted(pit.combine_own(f, F.col("rid") % 2 == 1, "multiply").collect()) == sorted(two.collect())


def test_history_asks_only_for_quarters_that_are_there(spark):
    rows = [(tk, DAY + dt.timedelta(days=40 * k), 8000 + 5 * k, float(k), k) for tk in range(3) for k in range(10)]
    f = spark.createDataFrame(rows, FACT)
    out = pit.history(f, 8)
    assert laid_out(out) <= 3 * len(rows)
    assert all([tuple(h) for h in r.h] == [(8000 + 5 * k, float(k)) for k in (r.rid - 1, r.rid) if k >= 0] for r in out.collect())


def test_coverage_counts_institutions_by_steps(spark):
    r = random.Random(5)
    rows = [(r.choice("ab"), r.choice([None, 1, 2, 3, 4]), None if r.random() < 0.05 else DAY + dt.timedelta(days=r.randrange(400))) for _ in range(80)]
    days = [DAY + dt.timedelta(days=7 * k) for k in range(70)]
    out = pit.coverage(spark.createDataFrame(rows, "tk string, inst int, est_dt date"), spark.createDataFrame([(d,) for d in days], "td date"), window_days=60)
    want = {}
    for d in days:
        for tk in "ab":
            seen = [i for t, i, e in rows if t == tk and e and e <= d <= e + dt.timedelta(days=60)]
            if seen:
                want[d, tk] = len(set(seen) - {None})
    assert {(x.td, x.tk): x.n for x in out.collect()} == want


def test_coverage_does_not_lay_estimates_out_over_dates(spark):
    rows = [("a", i % 3, DAY + dt.timedelta(days=i % 10)) for i in range(500)]
    days = [(DAY + dt.timedelta(days=k),) for k in range(400)]
    out = pit.coverage(spark.createDataFrame(rows, "tk string, inst int, est_dt date"), spark.createDataFrame(days, "td date"), window_days=300)
    assert laid_out(out) <= 2 * 3 * 10 + 100


@pytest.mark.parametrize("gathered", [20_000, 3])
def test_medians_are_exact_whatever_is_gathered(spark, monkeypatch, gathered):
    monkeypatch.setattr(dataset, "_GATHERED", gathered)
    r = random.Random(6)
    columns = {
        "even": [r.uniform(-5, 5) for _ in range(200)], "odd": [r.gauss(0, 1e6) for _ in range(199)], "two": [0.0] * 100 + [1.0] * 100, "most": [7.0] * 190 + [r.random() for _ in range(10)],
        "one": [3.0], "none": [], "gaps": [float("nan"), None, 1.0, 2.0, 4.0, float("inf")],
    }
    rows = [tuple(c[i] if i < len(c) else None for c in columns.values()) for i in range(200)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns))
    want = {c: statistics.median(x for x in v if x is not None and x == x) if v else None for c, v in columns.items()}
    assert dataset.medians(df, {c: F.col(c) for c in columns}) == want


def test_fitting_sends_no_values_whole(spark, monkeypatch):
    """The global median held every value in one task; no plan of a fit may ask for it."""
    monkeypatch.setattr(F, "median", lambda *_: pytest.fail("a median over all rows in one task"))
    df = spark.createDataFrame([(float(i), [float(i), float(2 * i)]) for i in range(101)], "x double, w array<double>")
    assert dataset.fit_clip(df, ["x"], 1.0)["x"] == pytest.approx((50 - 1.483 * 25, 50 + 1.483 * 25))
    found = processing.window_statistics(df, ["w"])["w"]
    assert found["median"] == [50.0, 100.0] and found["mad"] == [25.0, 50.0] and found["mean"] == [50.0, 100.0]


def test_tree_forecast_reads_the_kept_panel(spark, sf_dir):
    assert not any("lineitem" in f for f in QUERIES["tree_forecast"](spark, sf_dir).inputFiles())


def test_medcouple_looks_at_few_pairs(spark, monkeypatch):
    """Kernels computed for each value: a pivot costs one sorted search, copies of values cost nothing more."""
    seen, kernel = [], xs._kernel
    monkeypatch.setattr(xs, "_kernel", lambda x, y: seen.append(len(x)) or kernel(x, y))
    draw = np.random.default_rng(7)
    for v in (draw.normal(size=20_000), np.exp(draw.normal(size=20_001) * 3), np.repeat(draw.normal(size=400), 50)):
        seen.clear()
        got = xs.medcouple(v)
        assert sum(seen) <= 40 * len(v)
        x, y = v[v > np.median(v)] - np.median(v), np.median(v) - v[v < np.median(v)]
        below, upto = (sum(int((kernel(a, y) < got).sum()) for a in x), sum(int((kernel(a, y) <= got).sum()) for a in x))
        assert below <= len(x) * len(y) // 2 + len(v) and upto >= len(x) * len(y) // 2 - len(v)


def window_functions(df) -> int:
    """Aggregates of the windows of df's plan."""
    return df._jdf.queryExecution().optimizedPlan().toString().count("windowspecdefinition(")


@pytest.mark.parametrize(("name", "most"), [("rolling_beta", 9), ("beta_shrink", 12), ("liquidity_beta", 10)])
def test_regressions_sum_each_product_once(spark, sf_dir, name, most):
    """Six sums, and the windows around them; each mention in a formula was a sum of its own."""
    assert window_functions(QUERIES[name](spark, sf_dir)) <= most


def test_feature_store_daily_writes_each_quote_once(spark, sf_dir, monkeypatch):
    written, replace = [], stores.DateStore.replace

    def counted(store, df, since=None):
        if "/quote-" in store.path:
            written.extend(r.td for r in df.select("td").distinct().collect())
        replace(store, df, since)

    monkeypatch.setattr(stores.DateStore, "replace", counted)
    QUERIES["feature_store_daily"](spark, sf_dir)
    assert written and len(written) == len(set(written))


@pytest.mark.parametrize("name", ["eps_ttm", "eps_ttm_yoy", "eps_ttm_qoq", "roe_ttm_yoy"])
def test_factors_of_two_items_shuffle_orders_once(spark, sf_dir, name):
    """One exchange by customer; the others hold the calendar's ends, a row each."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = QUERIES[f"factor_{name}"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("shared", [False, True])
def test_trailing_over_mean_is_combine_of_both(spark, shared):
    r = random.Random(8)
    rows = [(r.randrange(4), DAY + dt.timedelta(days=40 * r.randrange(18)), float(r.randrange(1, 50)), r.choice([None, 0.0, 1.0, 2.0, 3.0])) for _ in range(150)]
    rows = [(tk, ann, dt.date(2000, 3, 31) + dt.timedelta(days=91 * (max(0, (ann - DAY).days - r.randrange(200)) // 91)), v if shared or r.random() < 0.9 else None, w, i) for i, (tk, ann, v, w) in enumerate(rows)]
    df = spark.createDataFrame([*rows, (None, DAY, DAY, 1.0, 1.0, 150), (1, None, DAY, 1.0, 1.0, 151)], "tk int, ann date, end date, v double, w double, i int")
    whole = df.filter("tk is not null and ann is not null")
    if shared:
        f = pit.facts(whole, "tk", "ann", "end", "v", "i")
        daily = whole.groupBy("tk", "ann").agg(F.max("w").alias("w")).withColumnRenamed("ann", "td")
        per = factors.at_announcement(f, daily, "w")
        f = f.join(per.select("tk", "rid"), ["tk", "rid"], "left_semi")
    else:
        # row numbers of all rows, so that both sides name them alike
        f, per = (pit.facts(whole.withColumn("x", F.coalesce(c, F.lit(-1.0))), "tk", "ann", "end", "x", "i").filter("v <> -1") for c in ("v", "w"))
    want = pit.combine(pit.trailing_year(f), pit.window_stat(per, "mean", 4))
    got = pit.trailing_over_mean(pit.paired(df, "tk", "ann", "end", "v", "w", "i", by_date=shared))
    assert got.count() > 20 and sorted(got.collect()) == sorted(want.collect())


def test_regression_sums_take_no_nulls(spark):
    """Rows without a pair add 0, an entity without any pair has no slope, and infinities stay out of the frames behind them."""
    r = random.Random(9)
    rows = [(tk, ix, None if tk == 2 or r.random() < 0.3 else r.uniform(-1, 1), None if r.random() < 0.2 else r.uniform(-1, 1)) for tk in range(3) for ix in range(40) if r.random() < 0.8]
    rows.append((3, 0, None, float("inf")))
    rows += [(3, ix, float(ix * ix), float(ix)) for ix in range(1, 20)]
    rows.append((3, 20, float("inf"), 1.0))
    rows += [(3, ix, float(ix * ix), float(ix)) for ix in range(21, 40)]
    df = spark.createDataFrame(rows, "tk int, ix int, y double, x double")
    sums = df.select("tk", win.pair_sums("y", "x", 8).alias("s"))
    assert {tuple(s.s) for s in sums.filter("tk = 2").collect()} == {(0.0,) * 6}
    seen = 0
    for o in win.rolling_regression(df, "y", "x", 8, 4, "slope", "se2").collect():
        pairs = [(y, x) for tk, ix, y, x in rows if tk == o.tk and o.ix - 8 < ix <= o.ix and y is not None and x is not None]
        if len(pairs) < 4:
            assert o.slope is None and o.se2 is None
        elif all(map(np.isfinite, np.ravel(pairs))):
            y, x = np.array(pairs).T
            b = np.cov(x, y)[0, 1] / np.var(x, ddof=1)
            e = y - y.mean() - b * (x - x.mean())
            assert (o.slope, o.se2) == pytest.approx((b, e @ e / (len(y) - 2) / ((x - x.mean()) ** 2).sum()), rel=1e-6, abs=1e-9)
            seen += 1
    assert seen > 60


def test_similar_labels_send_a_return_six_times(spark):
    r = random.Random(5)
    rows = [(tk, ix, None if r.random() < 0.2 else r.gauss(0, 1), None if r.random() < 0.2 else r.gauss(0, 1)) for tk in range(12) for ix in range(3, 70) if r.random() > 0.2]
    p = spark.createDataFrame([*rows, (None, 30, 1.0, 1.0)], "tk int, ix int, r double, y double")
    out = dataset.rolling_similar_labels(p, length=20, neighbours=5)
    assert laid_out(out) <= 12 * 19 * 6  # arrays of four positions each, once for every stretch; it was 20 rows for each return
    got = {(x.ix, x.tk): (x.similar_label, x.near_mean, x.near_std) for x in out.collect()}
    for at in (21, 22, 47, 69):
        one = dataset.similar_labels(p.filter(f"ix between {at - 19} and {at} and r is not null").select("tk", "ix", "r"), p.filter(f"ix = {at} and y is not null").select("tk", "y"), neighbours=5)
        want = {(at, x.tk): (x.similar_label, x.near_mean, x.near_std) for x in one.collect()} if at >= 22 else {}
        assert {k for k in got if k[0] == at} == want.keys() and (at < 22 or want)
        assert all(got[k] == pytest.approx(want[k]) for k in want)


def test_nearest_labels_in_tiles_with_ties(monkeypatch):
    rng = np.random.default_rng(7)
    m = (rng.random((40, 9)) > 0.4).astype(float)
    x, y = rng.integers(-2, 3, (40, 9)) * m, np.where(rng.random(40) < 0.2, np.nan, rng.normal(size=40))
    want = []
    for i in range(40):
        near = []
        for j in range(40):
            both = (m[i] * m[j]) > 0
            if i != j and both.any():
                a, b = x[i, both], x[j, both]
                flat = np.ptp(a) == 0 or np.ptp(b) == 0
                near.append((2.0 if flat else -round(float(np.corrcoef(a, b)[0, 1]), 9), j))
        want.append(sorted(v for _, j in sorted(near)[:6] if not np.isnan(v := y[j])))
    for tile, waiting in ((2**16, 2**22), (50, 130)):
        monkeypatch.setattr(dataset, "TILE", tile)
        monkeypatch.setattr(dataset, "WAITING", waiting)
        got = dataset._nearest_labels(x, m, y, 6)
        assert [[v for v in row.tolist() if not np.isnan(v)] for row in got] == want
