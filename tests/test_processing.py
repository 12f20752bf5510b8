"""Catalogue, windows of several features, and stages that are fitted, saved and loaded."""

import datetime as dt

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from panelyx.operators import processing as pr

DAYS = [dt.date(2020, 1, 1) + dt.timedelta(days=i) for i in range(12)]
NAN = float("nan")


def windows(spark, rows):
    return spark.createDataFrame([(DAYS[i % 3], i, a, b) for i, (a, b) in enumerate(rows)], "td date, tk int, a array<double>, b array<double>")


def kept(stage, df):
    return sorted(r.tk for r in stage.transform(df).collect())


def test_catalogue_filters_and_joins(spark):
    prices = spark.createDataFrame([(DAYS[0], 1, 1.0, 2.0), (DAYS[1], 1, 3.0, 4.0)], "td date, tk int, close double, volume double")
    labels = spark.createDataFrame([(DAYS[1], 1, 9.0), (DAYS[2], 2, 8.0)], "td date, tk int, label double")
    c = pr.Catalogue(spark).register("bars", prices).register("labels", labels, type="label", names="label")
    assert c.names() == ["close", "volume", "label"] and c.names(type="feature") == ["close", "volume"] and c.names(group="labels", type=["label", "risk"]) == ["label"]
    assert {tuple(r) for r in c.info().collect()} == {("close", "feature", "bars"), ("volume", "feature", "bars"), ("label", "label", "labels")}
    with pytest.raises(ValueError, match="no such field"):
        c.names(colour="red")
    with pytest.raises(ValueError, match="has no depth"):
        c.register("more", prices, names=["depth"])
    with pytest.raises(ValueError, match="registered already: close"):
        c.register("more", prices)
    assert {tuple(r) for r in c.prepare().collect()} == {(DAYS[0], 1, 1.0, 2.0, None), (DAYS[1], 1, 3.0, 4.0, 9.0), (DAYS[2], 2, None, None, 8.0)}
    with pytest.raises(ValueError, match="prepared"):
        c.register("late", prices.withColumnsRenamed({"close": "x", "volume": "y"}))


def test_windows_of_several_columns(spark):
    df = spark.createDataFrame([(DAYS[i], 1, i, float(i), None if i == 3 else -float(i)) for i in range(8)], "td date, tk int, ix int, a double, b double")
    out = {r.ix: r for r in pr.window_columns(df, ["a", "b"], 3, 2).collect()}
    assert set(out) == {5, 6, 7} and out[5].a == [1.0, 3.0, 5.0] and out[5].b == [-1.0, None, -5.0] and out[6].a == [2.0, 4.0, 6.0]


def test_filters(spark):
    df = windows(spark, [([1.0, 2.0], [3.0, 4.0]), ([0.0, 2.0], [3.0, 0.0]), ([0.0, 1.0], [0.0, 1.0]), ([None, 1.0], [1.0, 1.0]), ([-1.0, 5.0], [9.0, 9.0]), ([NAN, 1.0], [1.0, 1.0]), ([None, None], [None, None])])
    assert kept(pr.AllPositive(cols=["a", "b"]), df) == [0, 5]  # NaN counts as the largest value
    assert kept(pr.AllPositive(cols=["a", "b"], at=[-1]), df) == [0, 2, 3, 4, 5]
    assert kept(pr.NotAllZero(cols=["a", "b"]), df) == [0, 1, 3, 4, 5]
    assert kept(pr.InRange(cols=["a", "b"], low=0.0, high=4.0), df) == [0, 1, 2]
    assert kept(pr.InRange(cols=["a"], low=4.0, high=6.0, how="any"), df) == [4]
    assert kept(pr.WithoutValue(cols=["a", "b"], unwanted=1.0, how="any"), df) == [1, 4, 6]
    assert kept(pr.WithoutValue(cols=["b"], unwanted=1.0, how="all"), df) == [0, 1, 2, 4, 6]
    assert kept(pr.WithoutValue(cols=["a", "b"], unwanted=1.0, how="all"), df) == [0, 1, 2, 3, 4, 5, 6]
    assert kept(pr.DropMissing(cols=["a", "b"]), df) == [0, 1, 2, 4]
    assert kept(pr.DropMissing(cols=["a", "b"], how="all"), df) == [0, 1, 2, 3, 4, 5]
    assert kept(pr.DropMissing(cols=["a"], at=[1]), df) == [0, 1, 2, 3, 4, 5]


def test_changes(spark):
    df = windows(spark, [([1.0, 2.0], [3.0, 4.0]), ([None, NAN], [-9.0, 9.0]), ([6.0, 0.0], [1.0, 1.0])])
    values = lambda stage, c="a": [r[c] for r in stage.transform(df).orderBy("tk").collect()]
    assert values(pr.FillMissing(cols=["a"])) == [[1.0, 2.0], [0.0, 0.0], [6.0, 0.0]]
    assert values(pr.FillMissing(cols=["a"], filler=5.0, at=[0]))[1][0] == 5.0 and np.isnan(values(pr.FillMissing(cols=["a"], at=[0]))[1][1])
    assert values(pr.Bound(cols=["b"], low=0.0, high=3.5), "b") == [[3.0, 3.5], [0.0, 3.5], [1.0, 1.0]]
    assert values(pr.LastValue(cols=["a"]))[0] == [0.5, 1.0] and values(pr.LastValue(cols=["a"]))[2] == [None, None]
    assert values(pr.LastValue(cols=["a"], by=["b"]))[0] == [0.25, 0.5]
    with pytest.raises(ValueError, match="as many features"):
        pr.LastValue(cols=["a", "b"], by=["b"]).transform(df)


def test_positions_are_standardised_by_date(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(9, 3))
    df = windows(spark, [(list(map(float, r)), [0.0, 0.0, 0.0]) for r in x])
    out = np.array([r.a for r in pr.SelfStandard(cols=["a"], at=[0, -1]).transform(df).orderBy("tk").collect()])
    for d in range(3):
        own = x[d::3]
        for k in (0, 2):
            assert out[d::3, k] == pytest.approx((own[:, k] - own[:, k].mean()) / (own[:, k].std(ddof=1) + 1e-8))
    assert out[:, 1] == pytest.approx(x[:, 1])


def test_a_saved_pipeline_gives_the_same_rows(spark, tmp_path):
    rng = np.random.default_rng(2)
    x = rng.lognormal(size=(60, 2, 3))
    x[7, 0, 1] = 1e6
    x[9, 1, 2] = -1.0
    df = windows(spark, [(list(map(float, a)), list(map(float, b))) for a, b in x])
    stages = [pr.AllPositive(cols=["a", "b"], pred=False), pr.FitWindows(cols=["a", "b"], kind="clip", min_names=5), pr.FitWindows(cols=["a"], kind="scale", min_names=5)]
    model = pr.fit(stages, df)
    model.write().overwrite().save(f"{tmp_path}/p")
    loaded = PipelineModel.load(f"{tmp_path}/p")
    rows = lambda m, mode: sorted(map(str, pr.process(m, df, mode=mode).collect()))
    assert rows(model, "train") == rows(loaded, "train") and rows(model, "pred") == rows(loaded, "pred")
    assert len(rows(loaded, "train")) == 59 and len(rows(loaded, "pred")) == 60
    good = np.delete(x, 9, axis=0)
    med = np.median(good, axis=0)
    mad = np.median(np.abs(good - med), axis=0)
    want = np.clip(x, med - 5 * 1.483 * mad, med + 5 * 1.483 * mad)
    want[:, 0] = (want[:, 0] - good[:, 0].mean(axis=0)) / (good[:, 0].std(axis=0, ddof=1) + 1e-8)
    got = np.array([[r.a, r.b] for r in pr.process(loaded, df, mode="pred").orderBy("tk").collect()])
    assert got == pytest.approx(want)
    with pytest.raises(ValueError, match="train or pred"):
        pr.process(loaded, df, mode="eval")


def test_small_dates_do_not_count_in_fitting(spark):
    rows = [(DAYS[0], i, [float(i)]) for i in range(5)] + [(DAYS[1], 0, [1e9])]
    df = spark.createDataFrame(rows, "td date, tk int, a array<double>")
    assert pr.window_statistics(df, ["a"], min_names=5)["a"]["mean"] == [2.0]
    assert pr.window_statistics(df, ["a"], min_names=5)["a"]["max"] == [2.0 + 5 * 1.483]


def test_splits(spark):
    df = windows(spark, [([1.0], [2.0])]).withColumn("label", F.lit(3.0))
    out = pr.split(df, {"inputs": ["a", "b"], "labels": ["label"]}).first()
    assert out.inputs == [[1.0], [2.0]] and out.labels == [3.0]
