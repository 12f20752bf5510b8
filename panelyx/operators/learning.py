"""Walk-forward tree forecasts over a panel, by Spark's own gradient-boosted trees."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .dataset import clip, fit_clip, walk_forward


def prepared(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """Per-date standardised features and label (population deviation); rows without a value go."""
    w = Window.partitionBy("td")
    rows = df.dropna(subset=[*features, label])
    return rows.withColumns({c: F.try_divide(F.col(c) - F.avg(c).over(w), F.stddev_pop(c).over(w)) for c in (*features, label)}).dropna(subset=[*features, label])


def forecast(df: DataFrame, features: list[str], label: str, first_year: int, last_year: int, *, trees: int = 10, depth: int = 3, seed: int = 1) -> DataFrame:
    """td, tk, label and prediction of every test year, each from a model of the years before it. df is read several times for each year."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    found: list[DataFrame] = []
    for parts in walk_forward(df, first_year, last_year).values():
        ends = fit_clip(parts["train"].dropna(subset=features), features, 3.0)
        train = prepared(clip(parts["train"], ends), features, label).filter(F.abs(label) <= 3)
        test = prepared(clip(parts["test"], ends), features, label)
        assemble = VectorAssembler(inputCols=features, outputCol="__features")
        # fitting reads its rows several times
        kept = assemble.transform(train).select("__features", label).persist()
        model = GBTRegressor(featuresCol="__features", labelCol=label, maxIter=trees, maxDepth=depth, seed=seed).fit(kept)
        kept.unpersist()
        found.append(model.transform(assemble.transform(test)).select("td", "tk", F.col(label).alias("label"), "prediction"))
    # without test years the result is empty
    out = df.limit(0).select("td", "tk", F.col(label).alias("label"), F.lit(0.0).alias("prediction"))
    for more in found:
        out = out.unionByName(more)
    return out
