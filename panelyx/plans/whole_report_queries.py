"""Whole reports over the weekly panel: a factor's test with all its groups, a portfolio's figures by year and of the whole."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import windows as win
from ..operators import joins, report
from .panel_queries import LAG
from .registry import query, sql_tidy, tidy
from .roles import WEEKLY, bars, trading_days

N, EVERY = 5, 8
MEASURES = ["lms_annual", "lms_sharpe", "lms_max_drawdown", "lms_win", "lmm_annual", "lmm_sharpe", "lmm_max_drawdown", "lmm_win", "ic", "ric", "ic_ir", "ric_ir", "t", "ic_win", "ric_win", "long_turnover"]
FIGURES = ["own", "base", "excess", "max_drawdown", "daily_win", "monthly_win", "tracking_error", "information_ratio", "sharpe", "drop_share", "rolling_drawdown", "deep_depth", "deep_count", "deep_days", "turnover_each", "turnover_year"]


def _panel(spark, sf_dir):
    """Weekly bars with momentum, on a calendar that is held as rows. Prices are damped, so that products of returns stay in bounds."""
    days = joins.local(trading_days(spark, sf_dir))
    p = bars(spark, sf_dir).join(F.broadcast(days.select("td", "ix")), "td")
    p = p.withColumns({"vwap": F.pow(F.col("amount") / F.col("volume"), 0.05), "close": F.pow("close", F.lit(0.05))})
    return days, p.withColumn("mom", F.col("close") / win.lagged("close", 4) - 1)


def tested(spark, sf_dir) -> dict:
    """Momentum of nine names in ten, five groups, changed every eighth week at the price paid on average."""
    days, p = _panel(spark, sf_dir)
    p = p.withColumn("mom", F.when(F.col("tk") % 10 != 3, F.col("mom")))
    chosen = days.filter(f"ix % {EVERY} = 0 and ix >= {EVERY}").select("td")
    return report.test_factor(p.select("td", "tk", "ix", "close", "vwap", "mom"), "mom", N, days, chosen, deal="vwap", per_year=52, rebalances=52 / EVERY) | {"days": days}


TESTED = f"""{WEEKLY}, p0 AS MATERIALIZED (SELECT td, tk, ix, pow(vwap, 0.05::DOUBLE) AS vwap, pow(close, 0.05::DOUBLE) AS close FROM wk), p1 AS MATERIALIZED (SELECT *, max(close) OVER {LAG(1)} AS b, CASE WHEN tk % 10 <> 3 THEN close / max(close) OVER {LAG(4)} - 1 END AS mom FROM p0),
 p AS MATERIALIZED (SELECT *, close / b - 1 AS r, vwap / b - 1 AS sell, close / vwap - 1 AS buy FROM p1),
 rb AS (SELECT ix AS r0, CAST(row_number() OVER (ORDER BY ix) - 1 AS INTEGER) AS seg FROM cal WHERE ix % {EVERY} = 0 AND ix >= {EVERY} AND ix < (SELECT max(ix) FROM cal)), sg AS MATERIALIZED (SELECT *, lead(r0) OVER (ORDER BY seg) AS nx, coalesce(lead(r0) OVER (ORDER BY seg), (SELECT max(ix) FROM cal)) AS z FROM rb),
 gp AS MATERIALIZED (SELECT seg, r0, nx, z, tk, mom, close, CAST(floor((k - 1) / nullif(size, 0)) + 1 AS INTEGER) AS grp, size FROM (SELECT *, row_number() OVER (PARTITION BY ix ORDER BY mom, tk) AS k, count(*) OVER (PARTITION BY ix) // {N} AS size FROM p JOIN sg ON p.ix = sg.r0 WHERE mom IS NOT NULL)),
 hb AS MATERIALIZED (SELECT *, 1.0::DOUBLE / size AS w0 FROM gp WHERE grp <= {N}),
 dx AS (SELECT *, CAST(unnest(range(r0 + 1, z + 1)) AS INTEGER) AS ix FROM hb),
 gw AS MATERIALIZED (SELECT dx.grp, dx.seg, dx.tk, dx.ix, dx.z, dx.w0, dx.w0 * product(1 + CASE WHEN dx.ix = dx.r0 + 1 AND dx.seg > 0 THEN coalesce(buy, 0) ELSE coalesce(r, 0) END) OVER (PARTITION BY dx.seg, dx.tk ORDER BY dx.ix) AS grown FROM dx LEFT JOIN p ON p.tk = dx.tk AND p.ix = dx.ix),
 bk AS (SELECT grp, seg, ix, sum(grown) AS v, sum(w0) AS w FROM gw GROUP BY ALL), bt AS (SELECT grp, ix, v / coalesce(lag(v) OVER (PARTITION BY grp, seg ORDER BY ix), w) AS g FROM bk),
 en AS MATERIALIZED (SELECT gw.grp, gw.seg, gw.tk, gw.ix, grown, grown * (1 + coalesce(sell, 0)) AS sold FROM gw LEFT JOIN p ON p.tk = gw.tk AND p.ix = gw.ix + 1 WHERE gw.ix = gw.z),
 sl AS (SELECT grp, ix + 1 AS ix, sum(sold) / sum(grown) AS g FROM en WHERE seg < (SELECT max(seg) FROM hb) GROUP BY grp, seg, ix),
 al AS (SELECT * FROM bt UNION ALL SELECT * FROM sl UNION ALL SELECT grp, r0, 1.0::DOUBLE FROM hb WHERE seg = 0 GROUP BY grp, r0), da AS MATERIALIZED (SELECT b.grp AS grp, cal.td AS td, cal.ix AS ix, coalesce(product(al.g) - 1, 0) AS ret FROM (SELECT grp, min(ix) AS lo FROM al GROUP BY grp) b JOIN cal ON cal.ix >= b.lo LEFT JOIN al ON al.grp = b.grp AND al.ix = cal.ix GROUP BY b.grp, cal.td, cal.ix),
 ow AS (SELECT grp, seg + 1 AS seg, tk, sold / sum(sold) OVER (PARTITION BY grp, seg) AS w FROM en), tu AS MATERIALIZED (SELECT grp, seg, (SELECT td FROM cal JOIN sg ON cal.ix = sg.r0 + 1 WHERE sg.seg = j.seg) AS td, sum(abs(coalesce(w, 0) - coalesce(w0, 0))) AS turnover
   FROM (SELECT coalesce(hb.grp, ow.grp) AS grp, coalesce(hb.seg, ow.seg) AS seg, w, w0 FROM hb FULL JOIN ow ON hb.grp = ow.grp AND hb.seg = ow.seg AND hb.tk = ow.tk) j WHERE seg BETWEEN 1 AND (SELECT max(seg) FROM hb) GROUP BY grp, seg)"""


@query("factor_test_daily", f"WITH {TESTED}, o AS (SELECT *, product(1 + ret) OVER (PARTITION BY grp ORDER BY ix) AS nav FROM da) " + sql_tidy("grp, td, ix", ["ret", "nav"], "o", 6))
def factor_test_daily(spark, sf_dir):
    return tidy(tested(spark, sf_dir)["daily"], ["grp", "td", "ix"], ["ret", "nav"], 6)


@query("factor_test_turnover", f"WITH {TESTED} " + sql_tidy("grp, td", ["turnover"], "tu", 6))
def factor_test_turnover(spark, sf_dir):
    return tidy(tested(spark, sf_dir)["turnover"], ["grp", "td"], ["turnover"], 6)


def _of(source: str) -> str:
    return f"SELECT *, CAST(year(td) AS VARCHAR) AS period FROM {source} UNION ALL SELECT *, 'all' FROM {source}"


IC = f""" x AS (SELECT gp.*, cal.td AS td, coalesce(p.close / gp.close - 1, 0) AS y FROM gp JOIN cal ON cal.ix = gp.r0 LEFT JOIN p ON p.tk = gp.tk AND p.ix = gp.nx WHERE nx IS NOT NULL),
 k AS (SELECT *, rank() OVER (PARTITION BY td ORDER BY mom) + (count(*) OVER (PARTITION BY td, mom) - 1) / 2.0::DOUBLE AS rx, rank() OVER (PARTITION BY td ORDER BY y) + (count(*) OVER (PARTITION BY td, y) - 1) / 2.0::DOUBLE AS ry FROM x),
 ci AS (SELECT td, ic, ric, CASE WHEN n > 2 AND abs(ic) < 1 THEN ic * sqrt((n - 2) / (1 - ic * ic)) END AS t FROM (SELECT td, count(*) AS n, corr(mom, y) AS ic, corr(rx, ry) AS ric FROM k GROUP BY td)),
 cp AS ({_of('ci')}), cb AS (SELECT period, avg(ic) AS ic, avg(ric) AS ric, avg(ic) / stddev_samp(ic) * sqrt({52 / EVERY}::DOUBLE) AS ic_ir, avg(ric) / stddev_samp(ric) * sqrt({52 / EVERY}::DOUBLE) AS ric_ir, avg(t) AS t, avg(CAST(ic > 0 AS INTEGER)) AS ic_win, avg(CAST(ric > 0 AS INTEGER)) AS ric_win FROM cp GROUP BY period)"""
_half = lambda c: f"CASE WHEN period = 'all' THEN pow(product(1 + {c}), 52.0::DOUBLE / (count(*) - 1)) - 1 ELSE product(1 + {c}) - 1 END AS {c}_annual, avg({c}) / stddev_samp({c}) * sqrt(52.0::DOUBLE) AS {c}_sharpe, min({c}_dd) AS {c}_max_drawdown, avg(CAST({c} > 0 AS INTEGER)) AS {c}_win"


@query("factor_test", f"""WITH {TESTED}, sp AS (SELECT td, ix, max(ret) FILTER (grp = {N}) - max(ret) FILTER (grp = 1) AS lms, max(ret) FILTER (grp = {N}) - avg(ret) AS lmm FROM da GROUP BY td, ix HAVING count(*) = {N}),
 s0 AS ({_of('sp')}), s1 AS (SELECT *, product(1 + lms) OVER w AS n1, product(1 + lmm) OVER w AS n2 FROM s0 WINDOW w AS (PARTITION BY period ORDER BY ix)), s2 AS (SELECT *, n1 / max(n1) OVER w - 1 AS lms_dd, n2 / max(n2) OVER w - 1 AS lmm_dd FROM s1 WINDOW w AS (PARTITION BY period ORDER BY ix)),
 sa AS (SELECT period, {_half('lms')}, {_half('lmm')} FROM s2 GROUP BY period), {IC},
 t0 AS (SELECT td, turnover FROM tu WHERE grp = {N}), t1 AS ({_of('t0')}), tc AS (SELECT period, CASE WHEN period = 'all' THEN sum(turnover) / count(*) * {52 / EVERY}::DOUBLE ELSE sum(turnover) END AS long_turnover FROM t1 GROUP BY period),
 o AS (SELECT sa.*, cb.* EXCLUDE (period), long_turnover FROM sa LEFT JOIN cb USING (period) LEFT JOIN tc USING (period)) """ + sql_tidy("period", MEASURES, "o", 5))
def factor_test(spark, sf_dir):
    """The whole table of a factor's test, by year and of the whole."""
    return tidy(tested(spark, sf_dir)["performance"], ["period"], MEASURES, 5)


@query("factor_test_groups", f"WITH {TESTED}, d AS (SELECT grp, ret - avg(ret) OVER (PARTITION BY td) AS d FROM da), o AS (SELECT grp, pow(product(1 + d), 52.0::DOUBLE / (count(*) - 1)) - 1 AS annual FROM d GROUP BY grp) " + sql_tidy("grp", ["annual"], "o", 6))
def factor_test_groups(spark, sf_dir):
    return tidy(tested(spark, sf_dir)["group_performance"], ["grp"], ["annual"], 6)


@query("portfolio_whole_report", f"""WITH {TESTED}, me AS (SELECT td, coalesce(CAST(lead(month(td)) OVER (ORDER BY td) <> month(td) AS INTEGER), 0) AS is_month_end FROM cal),
 b0 AS (SELECT td, avg(ret) AS b FROM da GROUP BY td), d0 AS (SELECT da.grp, da.td, is_month_end, ret - 0.0015::DOUBLE * coalesce(turnover, 0) AS own, CASE WHEN row_number() OVER (PARTITION BY da.grp ORDER BY da.td) = 1 THEN 0 ELSE b END AS base FROM da JOIN me USING (td) JOIN b0 USING (td) LEFT JOIN tu ON tu.grp = da.grp AND tu.td = da.td),
 d1 AS (SELECT *, (1 + own) / (1 + base) - 1 AS excess, row_number() OVER (PARTITION BY grp ORDER BY td) = 1 AS f, year(lead(td) OVER (PARTITION BY grp ORDER BY td)) > year(td) AS turns FROM d0),
 d2 AS (SELECT *, 'all' AS period, f AS first_ FROM d1 UNION ALL SELECT *, CAST(year(td) AS VARCHAR), f FROM d1 WHERE NOT (f AND coalesce(turns, FALSE)) UNION ALL SELECT *, CAST(year(td) + 1 AS VARCHAR), TRUE FROM d1 WHERE turns),
 d3 AS (SELECT grp, td, period, first_, is_month_end, s, CASE WHEN first_ THEN 0 ELSE CASE s WHEN 'own' THEN own WHEN 'base' THEN base ELSE excess END END AS ret FROM d2, (VALUES ('own'), ('base'), ('excess')) v(s)),
 d4 AS MATERIALIZED (SELECT *, product(1 + ret) OVER w AS nav FROM d3 WINDOW w AS (PARTITION BY grp, period, s ORDER BY td)), d5 AS MATERIALIZED (SELECT *, nav / max(nav) OVER w - 1 AS dd, list(nav) OVER (PARTITION BY grp, period, s ORDER BY td ROWS BETWEEN 59 PRECEDING AND CURRENT ROW) AS l FROM d4 WINDOW w AS (PARTITION BY grp, period, s ORDER BY td)),
 d6 AS MATERIALIZED (SELECT *, list_min(list_transform(l, lambda x, i: x / list_max(l[1:i]) - 1)) AS fall, sum(CAST(dd >= 0 AS INTEGER)) OVER (PARTITION BY grp, period, s ORDER BY td) AS run FROM d5),
 mo AS (SELECT grp, period, s, avg(CAST(m > 1e-12 AS INTEGER)) AS monthly_win FROM (SELECT *, nav / lag(nav) OVER (PARTITION BY grp, period, s ORDER BY td) - 1 AS m FROM d6 WHERE is_month_end = 1) WHERE m IS NOT NULL GROUP BY ALL),
 ep AS (SELECT grp, period, s, run, min(dd) AS depth, count(*) AS days FROM d6 WHERE dd < 0 GROUP BY ALL), ea AS (SELECT grp, period, s, count(*) FILTER (depth < -0.01::DOUBLE) AS deep_count, coalesce(avg(depth) FILTER (depth < -0.01::DOUBLE), 0) AS deep_depth, coalesce(avg(days) FILTER (depth < -0.01::DOUBLE), 0) AS deep_days FROM ep GROUP BY ALL),
 st AS (SELECT grp, period, s, product(1 + ret) - 1 AS total, pow(product(1 + ret), 52.0::DOUBLE / nullif(count(*) - 1, 0)) - 1 AS annual, min(dd) AS max_drawdown, stddev_samp(ret) * sqrt(52.0::DOUBLE) AS vol, avg(CASE WHEN NOT first_ THEN CAST(ret > 0 AS INTEGER) END) AS daily_win, avg(CASE WHEN NOT first_ THEN CAST(ret < -0.005::DOUBLE AS INTEGER) END) AS drop_share, median(fall) AS rolling_drawdown FROM d6 GROUP BY ALL),
 ys AS (SELECT grp, year(td) AS y, count(*) AS k, sum(turnover) AS t FROM tu WHERE turnover <> 0 GROUP BY ALL), yt AS (SELECT grp, CAST(y AS VARCHAR) AS period, t / k AS turnover_each, t / k * k AS turnover_year FROM ys UNION ALL SELECT grp, 'all', sum(t) / sum(k), sum(t) / sum(k) * median(k) FROM ys GROUP BY grp),
 gn AS (SELECT *, CASE WHEN period = 'all' THEN annual ELSE total END AS gain FROM st),
 o AS (SELECT e.grp, e.period, a.gain AS own, b.gain AS base, e.gain AS excess, e.max_drawdown, e.daily_win, monthly_win, e.vol AS tracking_error, e.annual / nullif(e.vol, 0) AS information_ratio, a.annual / nullif(a.vol, 0) AS sharpe, e.drop_share, e.rolling_drawdown, coalesce(deep_depth, 0) AS deep_depth, coalesce(deep_count, 0) AS deep_count, coalesce(deep_days, 0) AS deep_days, turnover_each, turnover_year
  FROM gn e JOIN gn a ON a.grp = e.grp AND a.period = e.period AND a.s = 'own' JOIN gn b ON b.grp = e.grp AND b.period = e.period AND b.s = 'base' LEFT JOIN mo ON mo.grp = e.grp AND mo.period = e.period AND mo.s = 'excess' LEFT JOIN ea ON ea.grp = e.grp AND ea.period = e.period AND ea.s = 'excess' LEFT JOIN yt ON yt.grp = e.grp AND yt.period = e.period WHERE e.s = 'excess')
 """ + sql_tidy("grp, period", FIGURES, "o", 5))
def portfolio_whole_report(spark, sf_dir):
    """Every group as a portfolio after costs, against the mean of all groups."""
    out = tested(spark, sf_dir)
    mean = out["daily"].groupBy("td").agg(F.avg("ret").alias("ret"))
    return tidy(report.portfolio_report(out["daily"].select("grp", "td", "ret"), out["turnover"], out["days"], benchmark=mean, per_year=52), ["grp", "period"], FIGURES, 5)
