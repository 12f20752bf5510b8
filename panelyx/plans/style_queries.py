"""Queries of further bars, styles and stacked features."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import cross_section as xs
from ..functions import windows as win
from ..operators import bars, pit
from ..sources.tables import stacked
from .fact_queries import STEPS, _lists
from .panel_queries import KEYS, LAG, MOM, RET, TRAIL, momentum, returns
from .registry import query, sql_tidy, tidy
from .roles import DENSE_FACTS, ESTIMATES, FACTS, WEEKLY, dense_facts, estimates, facts, trading_days, weekly

DAILY = ["open", "high", "low", "close", "volume", "amount"]


@query("daily_bar", f"WITH {WEEKLY}, o AS (SELECT td, tk, open * sqrt(2 + ix * ix) AS open, high * sqrt(2 + ix * ix) AS high, low * sqrt(2 + ix * ix) AS low, close * sqrt(2 + ix * ix) AS close, ln(1 + volume) AS volume, ln(1 + amount) AS amount FROM wk) " + sql_tidy("td, tk", DAILY, "o", 3))
def daily_bar(spark, sf_dir):
    return tidy(bars.daily(weekly(spark, sf_dir).withColumn("adj", F.sqrt(2 + F.col("ix") * F.col("ix"))), "adj"), KEYS, DAILY, 3)


@query("weekly_vwap", f"WITH {WEEKLY}, x AS (SELECT *, count(*) OVER t AS n, sum(CASE WHEN tk % 4 = 0 THEN 0 ELSE amount END) OVER t AS a5, sum(volume) OVER t AS v5 FROM wk WINDOW t AS {TRAIL(5)}), o AS (SELECT td, tk, ln(CASE WHEN a5 > 0 THEN a5 / v5 ELSE close END) AS log_vwap5 FROM x WHERE n = 5) " + sql_tidy("td, tk", ["log_vwap5"], "o"))
def weekly_vwap(spark, sf_dir):
    p = weekly(spark, sf_dir).withColumn("amount", F.when(F.col("tk") % 4 == 0, F.lit(0.0)).otherwise(F.col("amount")))
    return tidy(bars.weekly_vwap(p, 5).filter("vwap5 is not null").withColumn("log_vwap5", F.log("vwap5")), KEYS, ["log_vwap5"])


@query("residual_month_end", f"""WITH {MOM}, fl AS (SELECT td FROM (SELECT td, lead(month(td)) OVER (ORDER BY td) <> month(td) AS e FROM cal) WHERE e), s AS (SELECT m.*, ln(amount) AS x FROM m JOIN fl USING (td) WHERE mom IS NOT NULL),
 t AS (SELECT *, sum(volume) OVER d AS sw, sum(volume * x) OVER d AS sx, sum(volume * mom) OVER d AS sy, sum(volume * x * x) OVER d AS sxx, sum(volume * x * mom) OVER d AS sxy, count(*) OVER d AS n FROM s WINDOW d AS (PARTITION BY td)),
 u AS (SELECT *, (sw * sxy - sx * sy) / nullif(sw * sxx - sx * sx, 0) AS b FROM t WHERE n > 4), o AS (SELECT td, tk, mom - (sy - b * sx) / sw - b * x AS residual FROM u) """ + sql_tidy("td, tk", ["residual"], "o", 3))
def residual_month_end(spark, sf_dir):
    p = momentum(spark, sf_dir).filter("mom is not null").withColumns({"x": F.log("amount"), "one": F.lit(1.0)})
    out = xs.orthogonalize_on(p, trading_days(spark, sf_dir).filter("is_month_end = 1"), "mom", ["x", "one"], "volume", "residual")
    return tidy(out.filter("residual is not null"), KEYS, ["residual"], 3)


@query("liquidity_beta", f"""WITH {RET}, k AS (SELECT *, sum(amount) OVER {TRAIL(13)} AS cap FROM r), l AS (SELECT *, ln(amount / nullif(max(cap) OVER {LAG(1)}, 0)) AS y FROM k), i AS (SELECT *, ln(sum(amount) OVER (PARTITION BY td)) AS x FROM l),
 o AS (SELECT td, tk, regr_slope(y, x) OVER t AS beta, regr_count(y, x) OVER t AS n FROM i WINDOW t AS {TRAIL(52)}) """ + sql_tidy("td, tk", ["beta"], "o WHERE n >= 26", 3))
def liquidity_beta(spark, sf_dir):
    """Slope of a name's log turnover on that of the whole market."""
    from pyspark.sql import Window

    from ..operators import risk

    p = returns(spark, sf_dir).withColumn("cap", F.sum("amount").over(win.trailing(13)))
    p = p.withColumns({"y": risk.liquidity("amount", "cap"), "x": F.log(F.sum("amount").over(Window.partitionBy("td")))})
    return tidy(win.rolling_regression(p, "y", "x", 52, 26, "beta").filter("beta is not null"), KEYS, ["beta"], 3)


_T = f"t0 AS MATERIALIZED (SELECT tk, ann, q, rid, {STEPS['ttm']('f')} AS v FROM f x), t AS MATERIALIZED (SELECT * FROM t0 WHERE v IS NOT NULL)"
_R = "r0 AS MATERIALIZED (SELECT tk, ann, q, rid, v / nullif(abs((SELECT last(y.v ORDER BY y.q, y.ann, y.rid) FROM f y WHERE y.tk = x.tk AND y.q <= x.q AND y.ann <= x.ann)), 0) AS v FROM t x), r AS MATERIALIZED (SELECT * FROM r0 WHERE v IS NOT NULL)"
_D = f"c0 AS MATERIALIZED (SELECT tk, ann, q, rid, {STEPS['yoy_diff']('r')} AS v FROM r x), c AS MATERIALIZED (SELECT * FROM c0 WHERE v IS NOT NULL)"


@query("delta_roe", f"WITH {DENSE_FACTS}, {_T}, {_R}, {_D}, {_lists(12, 'c')}, o AS (SELECT tk, rid, list_aggregate(a, 'avg') AS v FROM hl WHERE len(a) >= 2) " + sql_tidy("tk, rid", ["v"], "o WHERE v IS NOT NULL", 5))
def delta_roe(spark, sf_dir):
    """Mean over twelve quarters of the year-on-year difference of trailing profit over equity."""
    f = dense_facts(spark, sf_dir)
    return tidy(pit.delta_of_ratio(f, f), ["tk", "rid"], ["v"], 5)


@query("growth_cagr", f"WITH {DENSE_FACTS}, {_T}, {_lists(12, 't')}, o AS (SELECT tk, rid, CASE WHEN a[-1] / a[1] > 0 THEN pow(a[-1] / a[1], 4.0::DOUBLE / (qs[-1] - qs[1])) - 1 END AS v FROM hl WHERE len(a) >= 2) " + sql_tidy("tk, rid", ["v"], "o WHERE v IS NOT NULL", 5))
def growth_cagr(spark, sf_dir):
    """Compound growth of the trailing year over twelve quarters."""
    return tidy(pit.window_stat(pit.trailing_year(dense_facts(spark, sf_dir)), "cagr", 12), ["tk", "rid"], ["v"], 5)


@query("coverage_residual", f"""WITH {WEEKLY}, {ESTIMATES}, k AS (SELECT td, tk, count(DISTINCT inst) AS y FROM cal JOIN est ON td BETWEEN est_dt AND est_dt + 60 GROUP BY td, tk), b AS (SELECT DISTINCT p_brand AS tk, ln(sum(p_retailprice) OVER (PARTITION BY p_brand)) AS x FROM part),
 g AS (SELECT cal.td AS td, b.tk AS tk, coalesce(y, 0) AS y, x FROM cal CROSS JOIN b LEFT JOIN k ON k.td = cal.td AND k.tk = b.tk), s AS (SELECT *, avg(x) OVER d AS mx, avg(y) OVER d AS my, regr_slope(y, x) OVER d AS beta FROM g WINDOW d AS (PARTITION BY td)), o AS (SELECT td, tk, y - my - beta * (x - mx) AS residual FROM s) """ + sql_tidy("td, tk", ["residual"], "o", 4))
def coverage_residual(spark, sf_dir):
    """Number of institutions (none: 0) less what the size of the brand explains on the date."""
    from .roles import table

    days = trading_days(spark, sf_dir)
    size = table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("tk")).agg(F.log(F.sum("p_retailprice")).alias("x"))
    # the calendar is small and sent to all tasks
    grid = size.withColumn("one", F.lit(1)).join(F.broadcast(days.select("td", F.lit(1).alias("one"))), "one")
    y = grid.join(pit.coverage(estimates(spark, sf_dir), days, window_days=60), KEYS, "left").select(*KEYS, "x", F.coalesce("n", F.lit(0)).cast("double").alias("y"), F.lit(1.0).alias("w"))
    return tidy(y.withColumn("residual", xs.weighted_residual("y", "x", "w")), KEYS, ["residual"], 4)


@query("stacked_features", f"WITH {MOM}, a AS (SELECT td, tk, mom FROM m WHERE mom IS NOT NULL AND tk % 2 = 0), b AS (SELECT td, tk, ln(amount) AS size FROM wk WHERE ix % 2 = 0) SELECT coalesce(a.td, b.td) AS td, coalesce(a.tk, b.tk) AS tk, round(mom, 6) AS mom, round(size, 6) AS size FROM a FULL JOIN b ON a.td = b.td AND a.tk = b.tk")
def stacked_features(spark, sf_dir):
    p = momentum(spark, sf_dir)
    parts = {"mom": p.filter("mom is not null and tk % 2 = 0").select(*KEYS, F.col("mom").alias("value")), "size": p.filter("ix % 2 = 0").select(*KEYS, F.log("amount").alias("value"))}
    return tidy(stacked(parts, KEYS), KEYS, ["mom", "size"])


@query("facts_by_date", f"WITH {FACTS} SELECT ann, count(*) AS n, round(sum(v), 2) AS total FROM f GROUP BY ann HAVING count(*) > 1")
def facts_by_date(spark, sf_dir):
    f = facts(spark, sf_dir).groupBy("ann").agg(F.count("*").alias("n"), F.round(F.sum("v"), 2).alias("total"))
    return f.filter("n > 1")
