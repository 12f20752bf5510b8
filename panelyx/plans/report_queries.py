"""Queries of deal prices, factor reports and exposures."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import cross_section as xs
from ..operators import backtest, report
from .panel_queries import GROUPS, HOLD, KEYS, LAG, MAD, MOM, NAV, PERF, baskets, holdings, market, momentum
from .registry import query, sql_tidy, tidy
from .roles import table, trading_days, weekly


def _deal_sql(deal: str) -> str:
    return f"""{HOLD}, q AS (SELECT tk, ix, close / b - 1 AS r, {deal} / b - 1 AS sell, close / {deal} - 1 AS buy FROM (SELECT *, max(close) OVER {LAG(1)} AS b FROM wk)), f0 AS (SELECT min(seg) AS lo FROM h),
 g2 AS (SELECT dd.seg, dd.tk, dd.ix, dd.w0, dd.to_ix, dd.w0 * product(1 + CASE WHEN dd.ix = dd.seg * 13 + 1 AND dd.seg > lo THEN coalesce(buy, 0) ELSE coalesce(r, 0) END) OVER (PARTITION BY dd.seg, dd.tk ORDER BY dd.ix) AS grown FROM f0, dd LEFT JOIN q ON dd.tk = q.tk AND dd.ix = q.ix),
 v2 AS (SELECT seg, ix, sum(grown) AS v, sum(w0) AS w FROM g2 GROUP BY seg, ix), b2 AS (SELECT seg, ix, v / coalesce(lag(v) OVER (PARTITION BY seg ORDER BY ix), w) - 1 AS ret FROM v2),
 e2 AS (SELECT g2.seg + 1 AS seg, g2.ix + 1 AS ix, sum(grown * coalesce(sell, 0)) / sum(grown) AS sold FROM g2 LEFT JOIN q ON g2.tk = q.tk AND g2.ix + 1 = q.ix WHERE g2.ix = g2.to_ix GROUP BY 1, 2),
 dr2 AS (SELECT b2.seg, b2.ix, (1 + coalesce(sold, 0)) * (1 + ret) - 1 AS ret FROM b2 LEFT JOIN e2 ON b2.seg = e2.seg AND b2.ix = e2.ix)"""


def dealt(spark, sf_dir, deal: str):
    plan, own = baskets(spark, sf_dir, deal)
    return report.basket_days(own, plan).filter("seg is not null")


for _deal in ("open", "vwap", "close"):
    query(f"portfolio_return_{_deal}", f"WITH {_deal_sql(_deal)} " + sql_tidy("seg, ix", ["ret"], "dr2"))(lambda spark, sf_dir, deal=_deal: tidy(dealt(spark, sf_dir, deal), ["seg", "ix"], ["ret"]))


@query("latest_scores", f"WITH {MOM}, x AS (SELECT td, tk, mom FROM m WHERE mom IS NOT NULL), o AS (SELECT x.*, CAST(row_number() OVER (ORDER BY mom DESC, tk) AS INTEGER) AS place FROM x WHERE td = (SELECT max(td) FROM x)) SELECT td, tk, place, s_nationkey, round(mom, 6) AS mom FROM o LEFT JOIN (SELECT CAST(s_suppkey AS INTEGER) AS sk, s_nationkey FROM supplier) ON tk = sk")
def latest_scores(spark, sf_dir):
    names = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("int").alias("tk"), "s_nationkey")
    return tidy(backtest.latest_scores(momentum(spark, sf_dir), "mom", names), [*KEYS, "place", "s_nationkey"], ["mom"])


def grouped(spark, sf_dir):
    return backtest.quantile_groups(xs.winsorize_mad(momentum(spark, sf_dir), "mom", "w"), "w", 5)


SPREADS = f"{MOM}, {MAD}, {GROUPS}, gr AS (SELECT td, grp, avg(fwd) AS r FROM g GROUP BY td, grp), sp AS (SELECT td, max(r) FILTER (grp = 5) AS top, max(r) FILTER (grp = 1) AS bottom, avg(r) AS mean FROM gr GROUP BY td), ls AS (SELECT td, top, bottom, top - bottom AS lms, top - mean AS lmm FROM sp)"


@query("group_spreads", f"WITH {SPREADS} " + sql_tidy("td", ["top", "bottom", "lms", "lmm"], "ls"))
def group_spreads(spark, sf_dir):
    return tidy(backtest.group_spreads(grouped(spark, sf_dir), "fwd", 5), ["td"], ["top", "bottom", "lms", "lmm"])


@query("demeaned_groups", f"WITH {SPREADS}, d AS (SELECT grp, r - avg(r) OVER (PARTITION BY td) AS d FROM gr), o AS (SELECT grp, count(d) AS n, avg(d) * 52 AS annual FROM d GROUP BY grp) " + sql_tidy("grp, n", ["annual"], "o", 5))
def demeaned_groups(spark, sf_dir):
    return tidy(backtest.demeaned_group_returns(grouped(spark, sf_dir), "fwd"), ["grp", "n"], ["annual"], 5)


@query("long_short_performance", f"WITH {SPREADS}, mk AS (SELECT td, 1 + lms / 1000 AS g FROM ls WHERE lms IS NOT NULL), y AS (SELECT CAST(year(td) AS VARCHAR) AS period, {PERF} FROM mk GROUP BY year(td) UNION ALL SELECT 'all', {PERF} FROM mk), o AS (SELECT *, annual / nullif(vol, 0) AS sharpe FROM y) " + sql_tidy("period, n", ["total", "annual", "vol", "win", "sharpe"], "o", 3))
def long_short_performance(spark, sf_dir):
    """A thousandth in the spread between top and bottom group: performance by year and of the whole."""
    m = backtest.group_spreads(grouped(spark, sf_dir), "fwd", 5).filter("lms is not null").select("td", (F.col("lms") / 1000).alias("ret"))
    years = m.select("*", report.periods())
    return tidy(backtest.performance(years, ["period"]), ["period", "n"], ["total", "annual", "vol", "win", "sharpe"], 3)


@query("index_returns", f"WITH {NAV}, o AS (SELECT td, CASE WHEN row_number() OVER (ORDER BY td) = 1 THEN 0 ELSE g - 1 END AS ret FROM mk) " + sql_tidy("td", ["ret"], "o"))
def index_returns(spark, sf_dir):
    m = market(spark, sf_dir).select("td", "one", (F.col("ret") * 100).alias("pct"))
    return tidy(backtest.index_returns(m, by="one"), ["td"], ["ret"])


TURNOVERS = f"""{HOLD}, e AS (SELECT seg + 1 AS seg, tk, grown / sum(grown) OVER (PARTITION BY seg) AS w FROM gr WHERE ix = to_ix), tn AS (SELECT coalesce(h.seg, e.seg) AS seg, sum(abs(coalesce(w, 0) - coalesce(w0, 0))) AS turnover FROM h FULL JOIN e ON h.seg = e.seg AND h.tk = e.tk
 WHERE coalesce(h.seg, e.seg) > (SELECT min(seg) FROM h) AND coalesce(h.seg, e.seg) <= (SELECT max(seg) FROM h) GROUP BY 1), dated AS (SELECT td, ix, seg, turnover FROM tn JOIN cal ON cal.ix = seg * 13 + 1)"""


def turnovers(spark, sf_dir):
    plan, own = baskets(spark, sf_dir)
    return report.basket_turnover(own, plan)


@query("turnover_statistics", f"WITH {TURNOVERS}, y AS (SELECT year(td) AS y, count(*) AS k, sum(turnover) AS s FROM dated WHERE turnover <> 0 GROUP BY 1), o AS (SELECT sum(s) / sum(k) AS mean, median(k) AS times, sum(s) / sum(k) * median(k) AS annual FROM y) " + sql_tidy("1 AS one", ["mean", "times", "annual"], "o", 4))
def turnover_statistics(spark, sf_dir):
    return tidy(backtest.turnover_statistics(turnovers(spark, sf_dir)).withColumn("one", F.lit(1)), ["one"], ["mean", "times", "annual"], 4)


@query("net_performance", f"WITH {TURNOVERS}, n0 AS (SELECT cal.td AS td, br.ret - 0.0015::DOUBLE * coalesce(turnover, 0) AS ret FROM br JOIN cal ON br.ix = cal.ix LEFT JOIN dated ON dated.ix = br.ix AND dated.seg = br.seg), mk AS (SELECT td, 1 + ret / 100 AS g FROM n0), y AS (SELECT CAST(year(td) AS VARCHAR) AS period, {PERF} FROM mk GROUP BY year(td) UNION ALL SELECT 'all', {PERF} FROM mk), o AS (SELECT *, annual / nullif(vol, 0) AS sharpe FROM y) " + sql_tidy("period, n", ["total", "annual", "vol", "win", "sharpe"], "o", 3))
def net_performance(spark, sf_dir):
    """A hundredth in the baskets, after a cost of 0.0015 of what is turned over: performance by year and of the whole."""
    plan, own = baskets(spark, sf_dir)
    paid = report.basket_turnover(own, plan).select("seg", "ix", "turnover")
    r = report.basket_days(own, plan).filter("seg is not null").join(paid, ["seg", "ix"], "left")
    r = r.select(report.periods(), ((F.col("ret") - 0.0015 * F.coalesce("turnover", F.lit(0.0))) / 100).alias("ret"))
    return tidy(backtest.performance(r, ["period"]), ["period", "n"], ["total", "annual", "vol", "win", "sharpe"], 3)


@query("active_exposure", f"WITH {HOLD}, p AS (SELECT ix, tk, grown / sum(grown) OVER (PARTITION BY ix) AS w FROM gr), b AS (SELECT ix, tk, amount / sum(amount) OVER (PARTITION BY ix) AS w FROM wk WHERE ix IN (SELECT ix FROM gr)), u AS (SELECT * FROM p UNION ALL SELECT ix, tk, -w FROM b), o AS (SELECT u.ix AS ix, sum(w * s_acctbal) AS balance, sum(w * ln(volume)) AS activity FROM u JOIN wk ON u.ix = wk.ix AND u.tk = wk.tk JOIN (SELECT CAST(s_suppkey AS INTEGER) AS sk, s_acctbal FROM supplier) ON u.tk = sk GROUP BY u.ix) " + sql_tidy("ix", ["balance", "activity"], "o", 4))
def active_exposure(spark, sf_dir):
    """Exposure of the held baskets less that of all names by amount."""
    p = weekly(spark, sf_dir)
    held = holdings(spark, sf_dir).select("ix", "tk", F.col("grown").alias("w"))
    index = p.select("ix", "tk", F.col("amount").alias("w")).join(held.select("ix").distinct(), "ix", "left_semi")
    styles = p.join(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("int").alias("tk"), F.col("s_acctbal").alias("balance")), "tk").withColumn("activity", F.log("volume"))
    return tidy(backtest.active_exposure(held, index, styles, ["balance", "activity"], date="ix"), ["ix"], ["balance", "activity"], 4)
