"""A dataset from its catalogue through a saved and loaded pipeline."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from ..operators import dataset, joins, processing
from ..sources import stores
from .panel_queries import AHEAD
from .registry import query, sql_tidy, tidy
from .roles import WEEKLY, bars, trading_days

OUT = ["p1", "p4", "v1", "v4", "label"]


def _windows(spark, sf_dir):
    """Catalogue of prices, volumes and a label, laid side by side; windows of four, every second row."""
    days = joins.local(trading_days(spark, sf_dir))
    p = bars(spark, sf_dir).join(F.broadcast(days.select("td", "ix")), "td").withColumn("label", dataset.simple_label("close", "close", 4, 1))
    catalogue = processing.Catalogue(spark).register("bars", p, names=["close", "volume", "ix"]).register("labels", p, type="label", names="label")
    return processing.window_columns(catalogue.prepare(), [c for c in catalogue.names(type="feature") if c != "ix"], 4, 2)


@query("dataset_processed", f"""WITH {WEEKLY}, a AS (SELECT td, tk, ix, close, volume, max(close) OVER {AHEAD(5)} / max(close) OVER {AHEAD(1)} - 1 AS label FROM wk),
 w AS (SELECT td, tk, label, list(close) OVER r AS c, list(volume) OVER r AS v, count(*) OVER r AS n FROM a WINDOW r AS (PARTITION BY tk ORDER BY ix ROWS BETWEEN 7 PRECEDING AND CURRENT ROW)),
 f AS (SELECT td, tk, label, [c[2], c[4], c[6], c[8]] AS c, [v[2], v[4], v[6], v[8]] AS v FROM w WHERE n = 8), g AS MATERIALIZED (SELECT td, tk, label, list_transform(c, lambda x: x / c[4]) AS c, v FROM f WHERE list_max(v) <= 200 AND list_min(v) >= 2),
 t AS (SELECT td, tk, 'c' AS k, unnest(c) AS x, unnest([1, 2, 3, 4]) AS i FROM g WHERE td < DATE '1999-01-01' UNION ALL SELECT td, tk, 'v', unnest(v), unnest([1, 2, 3, 4]) FROM g WHERE td < DATE '1999-01-01'),
 m AS (SELECT k, i, median(x) AS med, avg(x) AS mean, stddev_samp(x) AS sd FROM t GROUP BY k, i), s AS MATERIALIZED (SELECT m.k AS k, m.i AS i, any_value(med) AS med, any_value(mean) AS mean, any_value(sd) AS sd, median(abs(x - med)) AS mad FROM t JOIN m ON t.k = m.k AND t.i = m.i GROUP BY m.k, m.i),
 e AS (SELECT td, tk, label, k, i, x FROM (SELECT td, tk, label, 'c' AS k, unnest(c) AS x, unnest([1, 2, 3, 4]) AS i FROM g WHERE td >= DATE '1999-01-01' UNION ALL SELECT td, tk, label, 'v', unnest(v), unnest([1, 2, 3, 4]) FROM g WHERE td >= DATE '1999-01-01')),
 z AS (SELECT td, tk, label, e.k AS k, e.i AS i, (least(greatest(x, med - 5 * 1.483::DOUBLE * mad), med + 5 * 1.483::DOUBLE * mad) - mean) / (sd + 1e-8) AS z FROM e JOIN s ON s.k = e.k AND s.i = e.i),
 o AS (SELECT td, tk, max(z) FILTER (k = 'c' AND i = 1) AS p1, max(z) FILTER (k = 'c' AND i = 4) AS p4, max(z) FILTER (k = 'v' AND i = 1) AS v1, max(z) FILTER (k = 'v' AND i = 4) AS v4, any_value(label) AS label FROM z GROUP BY td, tk) """ + sql_tidy("td, tk", OUT, "o", 5))
def dataset_processed(spark, sf_dir):
    """Fitted on the years before 1999, saved, loaded, applied to the years from then on; rows without a label only leave training."""
    rows = _windows(spark, sf_dir)
    both = ["close", "volume"]
    stages = [
        processing.AllPositive(cols=both), processing.InRange(cols=["volume"], low=2.0, high=200.0), processing.LastValue(cols=["close"]),
        processing.FitWindows(cols=both, kind="clip", min_names=1), processing.FitWindows(cols=both, kind="scale", min_names=1),
    ]
    folder = stores.scratch(spark, "pipeline")
    processing.fit(stages, rows.filter("td < date'1999-01-01'")).write().save(folder)
    out = processing.process(PipelineModel.load(folder), rows.filter("td >= date'1999-01-01'"), mode="pred")
    at = lambda c, i: F.element_at(c, i)
    return tidy(out.select("td", "tk", at("close", 1).alias("p1"), at("close", 4).alias("p4"), at("volume", 1).alias("v1"), at("volume", 4).alias("v4"), "label"), ["td", "tk"], OUT, 5)
