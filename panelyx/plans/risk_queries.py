"""Queries of risk factors over the weekly panel."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import windows as win
from ..operators import joins, risk
from .panel_queries import KEYS, LAG, RET, TRAIL, returns
from .registry import query, sql_tidy, tidy
from .roles import WEEKLY, table, trading_days, weekly

BASE = f"{RET}, k AS (SELECT *, sum(amount) OVER {TRAIL(13)} AS cap FROM r), b AS (SELECT *, ln(1 + cap) AS size, ln(amount / nullif(max(cap) OVER {LAG(1)}, 0)) AS liquidity, CASE WHEN count(ret) OVER {TRAIL(20)} >= 10 THEN stddev_samp(ret) OVER {TRAIL(20)} END AS vol FROM k)"


def base(spark, sf_dir):
    p = returns(spark, sf_dir).withColumn("cap", F.sum("amount").over(win.trailing(13)))
    return p.withColumns({"size": risk.size("cap"), "liquidity": risk.liquidity("amount", "cap"), "vol": win.rolling_std("ret", 20, 10)})


@query("risk_subfactors", f"WITH {BASE} " + sql_tidy("td, tk", ["size", "liquidity", "vol"], "b"))
def risk_subfactors(spark, sf_dir):
    return tidy(base(spark, sf_dir), KEYS, ["size", "liquidity", "vol"])


def _standard(x: str) -> str:
    clip = f"least(greatest({x}, {x}_med - 3 * 1.483::DOUBLE * {x}_mad), {x}_med + 3 * 1.483::DOUBLE * {x}_mad)"
    return f"CASE WHEN {x} IS NOT NULL THEN {clip} END AS {x}_w"


_Z = lambda x: f"({x}_w - sum({x}_w * cap) OVER d / sum(CASE WHEN {x}_w IS NOT NULL THEN cap END) OVER d) / (stddev_samp({x}_w) OVER d + 1e-8)"


@query("risk_exposures", f"""WITH {BASE}, m1 AS (SELECT *, median(size) OVER d AS size_med, median(liquidity) OVER d AS liquidity_med FROM b WINDOW d AS (PARTITION BY td)),
 m2 AS (SELECT *, median(abs(size - size_med)) OVER d AS size_mad, median(abs(liquidity - liquidity_med)) OVER d AS liquidity_mad FROM m1 WINDOW d AS (PARTITION BY td)),
 m3 AS (SELECT *, {_standard('size')}, {_standard('liquidity')} FROM m2 WHERE ix > 20), z AS (SELECT td, tk, {_Z('size')} AS a, {_Z('liquidity')} AS c FROM m3 WINDOW d AS (PARTITION BY td)),
 o AS (SELECT td, tk, a AS big, (coalesce(a, 0) + coalesce(c, 0)) / nullif(CAST(a IS NOT NULL AS INTEGER) + CAST(c IS NOT NULL AS INTEGER), 0) AS active FROM z) """ + sql_tidy("td, tk", ["big", "active"], "o", 4))
def risk_exposures(spark, sf_dir):
    p = base(spark, sf_dir).filter("ix > 20")
    return tidy(risk.exposures(p, [risk.Factor("big", ["size"], "cap"), risk.Factor("active", ["size", "liquidity"], "cap")]), KEYS, ["big", "active"], 4)


@query("non_linear_size", f"""WITH {BASE}, z AS (SELECT td, tk, sqrt(cap) AS w, (size - sum(size * cap) OVER d / sum(CASE WHEN size IS NOT NULL THEN cap END) OVER d) / (stddev_samp(size) OVER d + 1e-8) AS x FROM b WINDOW d AS (PARTITION BY td)),
 t AS (SELECT *, x ** 3 AS y, sum(w) OVER d AS sw, sum(w * x) OVER d AS sx, sum(w * x ** 3) OVER d AS sy, sum(w * x * x) OVER d AS sxx, sum(w * x ** 4) OVER d AS sxy FROM z WHERE x IS NOT NULL WINDOW d AS (PARTITION BY td)),
 u AS (SELECT *, (sw * sxy - sx * sy) / nullif(sw * sxx - sx * sx, 0) AS beta FROM t), o AS (SELECT td, tk, y - (sy - beta * sx) / sw - beta * x AS nls FROM u) """ + sql_tidy("td, tk", ["nls"], "o", 3))
def non_linear_size(spark, sf_dir):
    return tidy(risk.non_linear_size(base(spark, sf_dir), "size", "cap"), KEYS, ["nls"], 3)


@query("listed_days", f"WITH {WEEKLY}, l AS (SELECT o_custkey AS tk, CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS z FROM orders GROUP BY o_custkey) SELECT td, tk, CAST(td - a AS INTEGER) AS listed_days FROM cal JOIN l ON td BETWEEN a AND z")
def listed_days(spark, sf_dir):
    l = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("ck")).agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("z"))  # noqa: E741
    return risk.listed_days(trading_days(spark, sf_dir), l, "ck", "a", "z")


@query("carried_value", f"WITH {RET}, o AS (SELECT td, tk, last(CASE WHEN volume > 60 THEN close END IGNORE NULLS) OVER {TRAIL(11)} AS carried FROM r) " + sql_tidy("td, tk", ["carried"], "o", 7))
def carried_value(spark, sf_dir):
    p = weekly(spark, sf_dir).withColumn("x", F.when(F.col("volume") > 60, F.col("close")))
    return tidy(p.withColumn("carried", risk.carried("x", 10)), KEYS, ["carried"], 7)
