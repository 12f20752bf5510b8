"""Queries that keep tables by date and bring them up to date in steps."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import windows as win
from ..operators import factor_manager, features, joins
from ..sources import stores
from .panel_queries import KEYS, LAG, TRAIL
from .registry import query, sql_tidy, tidy
from .roles import INTRADAY, WEEKLY, bars, intraday, trading_days

DAILY = ["open", "close", "volume", "high5d", "vwap5d", "open5d", "activity"]


def quotes(spark, sf_dir):
    """The weekly bars with a factor of adjustment."""
    days = joins.local(trading_days(spark, sf_dir))
    return bars(spark, sf_dir).join(F.broadcast(days.select("td", "ix")), "td").withColumn("adj", F.sqrt(2 + F.col("ix") * F.col("ix")))


@query("feature_store_daily", f"""WITH {WEEKLY}, a AS (SELECT *, sqrt(2 + ix * ix) AS adj FROM wk), x AS (SELECT td, tk, ix, adj, open * adj AS open, high * adj AS high, close * adj AS close, ln(1 + volume) AS volume, volume AS v, amount AS a FROM a),
 o AS (SELECT td, tk, open, close, volume, CASE WHEN count(*) OVER t = 5 THEN max(high) OVER t END AS high5d, CASE WHEN count(*) OVER t = 5 THEN sum(a) OVER t / sum(v) OVER t * adj ELSE close END AS vwap5d, max(open) OVER {LAG(4)} AS open5d, CASE WHEN count(a) OVER u >= 10 THEN a / avg(a) OVER u END AS activity FROM x WINDOW t AS {TRAIL(5)}, u AS {TRAIL(20)}) """ + sql_tidy("td, tk", DAILY, "o", 3))
def feature_store_daily(spark, sf_dir):
    """A first run over the dates up to 1999, a second one over what came later; together they are one run over everything.

    The quotes grow by their later dates too: what is stored is not written again.
    """
    p, day = quotes(spark, sf_dir), F.lit("1999-06-30").cast("date")
    quote = stores.DateStore(spark, stores.scratch(spark, "quote"))
    manager = stores.FeatureManager(spark, ["daily_bar", "weekly_bar", "activity"], stores.registry([features]), {"quote": quote}, stores.scratch(spark, "features"))
    for part, since in ((p.filter(F.col("td") <= day), "0001-01-01"), (p.filter(F.col("td") > day), "1999-07-01")):
        quote.replace(part)
        if failed := manager.run(since):
            raise RuntimeError(f"features failed: {failed}")
    return tidy(manager.read(), KEYS, DAILY, 3)


MINUTE = ["r_rsj", "v_pct_open", "v_pct_close"]


@query("feature_store_minute", f"WITH {INTRADAY}, o AS (SELECT td, tk, sum(CASE WHEN ret > 0 THEN ret * ret WHEN ret < 0 THEN -ret * ret ELSE 0 END) / nullif(sum(ret * ret), 0) AS r_rsj, sum(CASE WHEN bar < 6 THEN share END) AS v_pct_open, sum(CASE WHEN bar > t_max - 6 THEN share END) AS v_pct_close FROM p GROUP BY td, tk) " + sql_tidy("td, tk", MINUTE, "o", 5))
def feature_store_minute(spark, sf_dir):
    """Features of intraday bars that are kept by date; the second run does the last dates again."""
    store = stores.DateStore(spark, stores.scratch(spark, "minute"))
    store.replace(intraday(spark, sf_dir))
    manager = stores.FeatureManager(spark, ["r_rsj", "volume_shares"], stores.registry([features]), {"minute": store}, stores.scratch(spark, "features"))
    for since in ("0001-01-01", store.dates()[-1]):
        if failed := manager.run(since):
            raise RuntimeError(f"features failed: {failed}")
    return tidy(manager.read(), KEYS, MINUTE, 5)


QUOTE = ["open", "close", "pctchg", "volume", "total_mv"]


@query("basic_sets", f"WITH {WEEKLY}, o AS (SELECT td, tk, open, close, volume / 100 AS pctchg, volume, round(amount * 10000, 0) AS total_mv FROM wk) " + sql_tidy("td, tk", QUOTE, "o", 7))
def basic_sets(spark, sf_dir):
    """Quotes and sizes in their own units, first whole, then the last sixty dates again."""
    days = joins.local(trading_days(spark, sf_dir))
    p = bars(spark, sf_dir).join(F.broadcast(days.select("td", "ix")), "td").withColumns({"pctchg": F.col("volume"), "total_mv": F.col("amount")})
    source = stores.DateStore(spark, stores.scratch(spark, "source"))
    source.replace(p)
    quote = {k: v for k, v in stores.QUOTE.items() if k in ("open", "close", "pctchg", "volume")}
    keeper = stores.Maintainer(spark, stores.scratch(spark, "basic"), {"prices": source}, {"quote": ("prices", quote), "size": ("prices", {"total_mv": stores.SIZE["total_mv"]})})
    for _ in range(2):
        if failed := keeper.run():
            raise RuntimeError(f"sets failed: {failed}")
    both = keeper.store("quote").read().join(keeper.store("size").read(), KEYS).withColumn("total_mv", F.round("total_mv", 0))
    return tidy(both, KEYS, QUOTE, 7)


FACTOR_STAGES = ["primitive", "standardized", "orthogonalized"]


@query("factor_stages", f"""WITH {WEEKLY}, x AS (SELECT *, ln(amount) AS size, close / max(close) OVER {LAG(4)} - 1 AS p FROM wk), m1 AS (SELECT *, median(p) OVER (PARTITION BY td) AS med FROM x), m2 AS (SELECT *, median(abs(p - med)) OVER (PARTITION BY td) AS mad, median(CASE WHEN p <> 0 THEN abs(p - med) END) OVER (PARTITION BY td) AS nz FROM m1),
 m3 AS (SELECT *, CASE WHEN p IS NOT NULL THEN least(greatest(p, med - 3 * 1.483::DOUBLE * CASE WHEN mad > 0 THEN mad ELSE coalesce(nz, 0) END), med + 3 * 1.483::DOUBLE * CASE WHEN mad > 0 THEN mad ELSE coalesce(nz, 0) END) END AS w FROM m2),
 z AS (SELECT td, tk, p, size, volume, (w - sum(w * volume) OVER d / sum(CASE WHEN w IS NOT NULL THEN volume END) OVER d) / (stddev_samp(w) OVER d + 1e-8) AS z FROM m3 WINDOW d AS (PARTITION BY td)),
 s AS (SELECT *, sum(CASE WHEN z IS NOT NULL THEN volume END) OVER d AS sw, sum(CASE WHEN z IS NOT NULL THEN volume * size END) OVER d AS sx, sum(volume * z) OVER d AS sy, sum(CASE WHEN z IS NOT NULL THEN volume * size * size END) OVER d AS sxx, sum(volume * size * z) OVER d AS sxy, count(z) OVER d AS n FROM z WINDOW d AS (PARTITION BY td)),
 u AS (SELECT *, (sw * sxy - sx * sy) / nullif(sw * sxx - sx * sx, 0) AS b FROM s),
 o AS (SELECT td, tk, p AS primitive, z AS standardized, CASE WHEN n - 2 > 2 THEN z - (sy - b * sx) / sw - b * size END AS orthogonalized FROM u WHERE p IS NOT NULL) """ + sql_tidy("td, tk", FACTOR_STAGES, "o", 4))
def factor_stages(spark, sf_dir):
    """Momentum as computed, standardised, and freed of size, each from its own store."""
    days = joins.local(trading_days(spark, sf_dir))
    p = bars(spark, sf_dir).join(F.broadcast(days.select("td", "ix")), "td").withColumn("size", F.log("amount"))
    spec = factor_manager.Spec("momentum", "change", {"n": 4}, ("winsorize_mad", "standardize"), ("size",))
    manager = factor_manager.FactorManager(spark, stores.scratch(spark, "factors"), [spec], {"change": lambda close, *, n: F.col(close) / win.lagged(close, n) - 1})
    if failed := manager.run(p, {}, weight="volume"):
        raise RuntimeError(f"factors failed: {failed}")
    out = None
    for stage in factor_manager.STAGES:
        one = manager.store("momentum", stage).read().withColumnRenamed("value", stage)
        out = one if out is None else out.join(one, KEYS, "full")
    return tidy(out, KEYS, FACTOR_STAGES, 4)
