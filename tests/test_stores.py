"""Stores by date, feature managers and basic sets."""

import datetime as dt
import types

import pytest
from pyspark.sql import functions as F

from panelyx.functions import windows as win
from panelyx.sources import stores

DATES = [dt.date(2021, 1, 4) + dt.timedelta(days=7 * i) for i in range(50)]


@pytest.fixture()
def prices(spark, tmp_path):
    def stored(upto=len(DATES), name="prices"):
        rows = [(d, tk, i, float((i * 7 + tk * 3) % 11 + 1)) for i, d in enumerate(DATES[:upto]) for tk in range(3) if (i + tk) % 9]
        store = stores.DateStore(spark, f"{tmp_path}/{name}")
        store.replace(spark.createDataFrame(rows, "td date, tk int, ix int, close double"), "0001-01-01")
        return store

    return stored


@stores.feature(reach=9)
def mean10(prices):
    return prices.select("td", "tk", win.rolling_mean("close", 10, 3).alias("v"))


def two(prices):
    inverse = F.when(F.col("tk") == 0, F.lit(float("inf"))).otherwise(1 / F.col("close"))
    return prices.select("td", "tk", F.col("close").alias("plain"), inverse.alias("inverse"))


def broken(prices):
    return prices.select("td", "tk", F.raise_error(F.lit("no such luck")).cast("double").alias("v"))


def unresolved(prices):
    return prices.select("td", "tk", F.col("missing").alias("v"))


FUNCTIONS = {"mean10": mean10, "two": two, "broken": broken, "unresolved": unresolved}


def scanned(df):
    """Files and partitions that the scans of df opened."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        again = df.select("*")
        again.collect()
        leaves = again._jdf.queryExecution().executedPlan().collectLeaves()
        metric = lambda i, name: int(leaves.apply(i).metrics().get(name).get().value())
        return [(metric(i, "numFiles"), metric(i, "numPartitions")) for i in range(leaves.size()) if leaves.apply(i).metrics().contains("numPartitions")]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_slices_open_only_their_dates(spark, prices):
    store = prices()
    assert scanned(store.between(str(DATES[10]), str(DATES[14]))) == [(5, 5)]
    assert [r.td for r in store.between(str(DATES[48])).select("td").distinct().orderBy("td").collect()] == DATES[48:]
    assert store.dates() == [str(d) for d in DATES]


def test_dates_known_at_run_time_prune_the_scan(spark, prices, tmp_path):
    store = prices()
    spark.createDataFrame([(DATES[3], 1), (DATES[30], 1), (DATES[7], 0)], "td date, wanted int").write.parquet(f"{tmp_path}/dates")
    dates = spark.read.parquet(f"{tmp_path}/dates").filter("wanted = 1")
    out = store.on(dates)
    assert {r.td for r in out.collect()} == {DATES[3], DATES[30]}
    assert "dynamicpruning" in out._jdf.queryExecution().executedPlan().toString().lower()
    assert (2, 2) in scanned(out)


def test_two_steps_equal_one(spark, prices, tmp_path):
    manager = lambda source, folder: stores.FeatureManager(spark, ["mean10", "two"], FUNCTIONS, {"prices": source}, f"{tmp_path}/{folder}", roll_back=5)
    assert manager(prices(), "one").run() == {}
    assert manager(prices(30, "early"), "steps").run() == {}
    assert manager(prices(), "steps").run(str(DATES[30])) == {}
    for name in ("mean10", "two"):
        one, steps = (sorted(map(str, stores.DateStore(spark, f"{tmp_path}/{f}/{name}").read().collect())) for f in ("one", "steps"))
        assert one == steps and len(one) > 100
    assert manager(prices(), "one").read("two").filter("tk = 0 and inverse <> 0").count() == 0
    assert manager(prices(), "one").read().columns == ["td", "tk", "mean10", "plain", "inverse"]


def test_a_run_reads_what_its_windows_need(spark, prices, tmp_path):
    manager = stores.FeatureManager(spark, ["mean10"], FUNCTIONS, {"prices": prices()}, f"{tmp_path}/f", roll_back=5)
    rows, replaced = manager.compute("mean10", str(DATES[40]))
    assert replaced == str(DATES[35])
    # from 9 dates before the first replaced one
    assert scanned(rows) == [(24, 24)]
    assert manager.compute("mean10", "2030-01-01") is None
    assert manager.span(str(DATES[2]), 9, [str(d) for d in DATES]) == (str(DATES[0]), str(DATES[0]))


def test_a_feature_that_fails_leaves_others_stored(spark, prices, tmp_path):
    manager = stores.FeatureManager(spark, ["broken", "unresolved", "two"], FUNCTIONS, {"prices": prices()}, f"{tmp_path}/f")
    failed = manager.run()
    assert set(failed) == {"broken", "unresolved"} and "no such luck" in failed["broken"]
    assert manager.store("two").read().count() > 100 and not manager.store("unresolved").exists()


def test_replaced_dates_that_are_gone_go(spark, tmp_path):
    store = stores.DateStore(spark, f"{tmp_path}/s")
    frame = lambda *days: spark.createDataFrame([(DATES[i], 1, float(i)) for i in days], "td date, tk int, v double")
    store.replace(frame(0, 1, 2, 3))
    store.replace(frame(1, 3), str(DATES[1]))
    assert store.dates() == [str(DATES[i]) for i in (0, 1, 3)]
    store.replace(frame(2))
    assert store.dates() == [str(DATES[i]) for i in range(4)]


def test_registry_keeps_the_first_of_two_names():
    a, b = types.ModuleType("a"), types.ModuleType("b")
    exec("def f(x): return 1\ndef _hidden(x): return 2\nclass K: pass\nn = 3", a.__dict__)
    exec("def f(x): return 4\ndef g(x): return 5", b.__dict__)
    with pytest.warns(UserWarning, match="f of b is ignored"):
        found = stores.registry([a, b])
    assert set(found) == {"f", "g"} and found["f"](0) == 1


def test_basic_sets_replace_their_last_dates(spark, tmp_path):
    source = stores.DateStore(spark, f"{tmp_path}/source")
    frame = lambda days, x: spark.createDataFrame([(DATES[i], 1, x, 50.0) for i in days], "td date, tk int, total_mv double, pctchg double")
    source.replace(frame(range(20), 1.0))
    keeper = stores.Maintainer(spark, f"{tmp_path}/basic", {"s": source}, {"size": ("s", {"total_mv": stores.SIZE["total_mv"]}), "quote": ("s", {"pctchg": stores.QUOTE["pctchg"]})}, roll_back=4)
    assert keeper.run() == {}
    source.replace(frame(range(22), 2.0))
    assert keeper.update("size") == str(DATES[18])
    assert {r.td: r.total_mv for r in keeper.store("size").read().collect()} == {d: 1e4 if i < 18 else 2e4 for i, d in enumerate(DATES[:22])}
    assert keeper.update("size", str(DATES[5])) == str(DATES[5]) and keeper.store("size").read().filter("total_mv = 10000").count() == 5
    assert keeper.store("quote").read().first().pctchg == 0.5
    days, names = keeper.index()
    assert days.count() == 22 and [r.tk for r in names.collect()] == [1]


def test_descriptions_and_ticker_numbers(spark):
    names = spark.createDataFrame([(1, "a", None, None), (2, "b", dt.date(2000, 1, 1), dt.date(2001, 1, 1)), (3, "c", None, None)], "tk int, name string, list_dt date, delist_dt date")
    out = {r.tk: tuple(r)[1:] for r in stores.description(names, spark.createDataFrame([(1,), (2,)], "tk int")).collect()}
    assert out == {1: ("a", dt.date(1900, 1, 1), dt.date(2100, 1, 1)), 2: ("b", dt.date(2000, 1, 1), dt.date(2001, 1, 1))}
    codes = spark.createDataFrame([(c,) for c in ("600000.XY", "000001.XZ", "300750", "800001.XY", "60000.XY", "A12345.XY", "6000001.X", "", None)], "c string")
    assert [r.n for r in codes.select(stores.ticker_number(F.col("c")).alias("n")).collect()] == [600000, 1, 300750, None, None, None, None, None, None]


def test_factors_are_kept_in_three_stages(spark, tmp_path):
    import random

    from panelyx.operators import factor_manager

    rng = random.Random(1)
    panel = spark.createDataFrame([(d, tk, i, rng.random() * 10, rng.random(), float(1 + tk % 3)) for i, d in enumerate(DATES[:12]) for tk in range(9)], "td date, tk int, ix int, close double, size double, w double")
    specs = [factor_manager.Spec("level", "level", {}, ("standardize",), ("size",)), factor_manager.Spec("plain", "level"), factor_manager.Spec("broken", "level", {}, ("polish",)), factor_manager.Spec("unknown", "nothing")]
    manager = factor_manager.FactorManager(spark, f"{tmp_path}/f", specs, {"level": lambda close: F.col(close)})
    mask = panel.filter("tk <> 8").select("td", "tk")
    failed = manager.run(panel, {}, weight="w", member="m", universes={"m": mask}, start=str(DATES[3]))
    assert set(failed) == {"broken", "unknown"}
    stage = lambda name, s: {(r.td, r.tk): r.value for r in manager.store(name, s).read().collect()}
    raw, z, rest = (stage("level", s) for s in factor_manager.STAGES)
    assert set(raw) == set(z) == set(rest) == {(d, tk) for d in DATES[3:12] for tk in range(8)}
    assert stage("plain", "primitive") == stage("plain", "orthogonalized") == raw
    rows = {(r.td, r.tk): r for r in panel.collect()}
    for d in DATES[3:12]:
        # what is left has no weighted covariance with the size, and weighs up to nothing
        assert abs(sum(rest[d, k] * rows[d, k].w for k in range(8))) < 1e-9 and abs(sum(rest[d, k] * rows[d, k].w * rows[d, k].size for k in range(8))) < 1e-9
        assert abs(sum(z[d, k] * rows[d, k].w for k in range(8))) < 1e-9
    assert manager.run(panel, {}, ["plain"], weight="w", start=str(DATES[11])) == {} and len(stage("plain", "primitive")) == 8 * 8 + 9
    with pytest.raises(ValueError, match="no stage raw"):
        manager.store("level", "raw")
