"""Queries over the weekly price panel."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import cross_section as xs
from ..functions import windows as win
from ..operators import backtest, dataset, joins, report
from .registry import query, sql_tidy, tidy
from .roles import WEEKLY, bars, table, trading_days, weekly

#: Frames of the SQL: n positions back, and the trailing n.
LAG = lambda n: f"(PARTITION BY tk ORDER BY ix RANGE BETWEEN {n} PRECEDING AND {n} PRECEDING)"
AHEAD = lambda n: f"(PARTITION BY tk ORDER BY ix RANGE BETWEEN {n} FOLLOWING AND {n} FOLLOWING)"
TRAIL = lambda n: f"(PARTITION BY tk ORDER BY ix RANGE BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
KEYS = ["td", "tk"]

RET = f"{WEEKLY}, r AS (SELECT *, close / max(close) OVER {LAG(1)} - 1 AS ret FROM wk)"


def returns(spark, sf_dir):
    return weekly(spark, sf_dir).withColumn("ret", F.col("close") / win.lagged("close", 1) - 1)


MOM = f"{RET}, m AS (SELECT *, close / max(close) OVER {LAG(4)} - 1 AS mom, max(close) OVER {AHEAD(4)} / close - 1 AS fwd FROM r)"


def momentum(spark, sf_dir):
    return returns(spark, sf_dir).withColumn("mom", F.col("close") / win.lagged("close", 4) - 1).withColumn("fwd", win.lagged("close", -4) / F.col("close") - 1)


MAD = "med AS (SELECT *, median(mom) OVER d AS med FROM m WINDOW d AS (PARTITION BY td)), dev AS (SELECT *, abs(mom - med) AS dev FROM med), mad AS (SELECT *, median(dev) OVER d AS mad, median(CASE WHEN mom <> 0 THEN dev END) OVER d AS nz FROM dev WINDOW d AS (PARTITION BY td)), wins AS (SELECT *, CASE WHEN mom IS NOT NULL THEN least(greatest(mom, med - 3 * 1.483::DOUBLE * CASE WHEN mad > 0 THEN mad ELSE coalesce(nz, 0) END), med + 3 * 1.483::DOUBLE * CASE WHEN mad > 0 THEN mad ELSE coalesce(nz, 0) END) END AS w FROM mad)"
GROUPS = "g0 AS (SELECT *, row_number() OVER (PARTITION BY td ORDER BY w, tk) AS rn, count(*) OVER (PARTITION BY td) // 5 AS sz FROM wins WHERE w IS NOT NULL), g AS (SELECT *, CAST((rn - 1) // sz + 1 AS INTEGER) AS grp FROM g0 WHERE sz > 0 AND (rn - 1) // sz + 1 <= 5)"


@query("factor_groups_forward_return", f"WITH {MOM}, {MAD}, {GROUPS} SELECT td, grp, count(*) AS n, round(avg(fwd), 6) AS forward_return FROM g GROUP BY td, grp")
def factor_groups_forward_return(spark, sf_dir):
    """Flagship: momentum, clipped per date, in five groups, with the groups' mean forward returns."""
    f = xs.winsorize_mad(momentum(spark, sf_dir), "mom", "w")
    return backtest.quantile_groups(f, "w", 5).groupBy("td", "grp").agg(F.count("*").alias("n"), F.round(F.avg("fwd"), 6).alias("forward_return"))


@query("calendar_flags", """WITH d AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS td FROM lineitem)
SELECT td, CAST(row_number() OVER w - 1 AS INTEGER) AS ix, coalesce(CAST(lead(weekofyear(td)) OVER w <> weekofyear(td) AS INTEGER), 0) AS is_week_end,
 coalesce(CAST(lead(month(td)) OVER w <> month(td) AS INTEGER), 0) AS is_month_end, coalesce(CAST(lead(year(td)) OVER w <> year(td) AS INTEGER), 0) AS is_year_end FROM d WINDOW w AS (ORDER BY td)""")
def calendar_flags(spark, sf_dir):
    return joins.calendar(table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("td")))


@query("snap_to_week", f"WITH {WEEKLY}, e AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders) SELECT d, (SELECT max(td) FROM cal WHERE td < d) AS td FROM e")
def snap_to_week(spark, sf_dir):
    """Latest calendar date strictly before each order date."""
    e = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("d")).distinct()
    return joins.snap_back(e, trading_days(spark, sf_dir), "d", strictly=True)


INTERVALS = "iv AS (SELECT o_custkey AS ck, CAST(min(o_orderdate) AS DATE) AS a, CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE CAST(max(o_orderdate) AS DATE) END AS z FROM orders GROUP BY o_custkey)"


@query("universe_interval", f"WITH {WEEKLY}, {INTERVALS} SELECT td, count(*) AS members FROM cal JOIN iv ON td >= a AND td <= coalesce(z, DATE '2100-01-01') GROUP BY td")
def universe_interval(spark, sf_dir):
    o = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("ck")).agg(F.to_date(F.min("o_orderdate")).alias("a"), F.to_date(F.max("o_orderdate")).alias("z"))
    iv = o.withColumn("z", F.when(F.col("ck") % 10 != 0, F.col("z")))
    return joins.interval_join(trading_days(spark, sf_dir), iv, "a", "z").groupBy("td").agg(F.count("*").alias("members"))


@query("universe_masks", f"""WITH {RET}, s AS (SELECT *, min(td) OVER (PARTITION BY tk) AS born, max(CAST(NOT (low > 1 AND amount > 1 AND volume > 20) AS INTEGER)) OVER {TRAIL(8)} AS thin,
 max(CASE WHEN abs(ret) > 5 THEN 1 ELSE 0 END) OVER {AHEAD(1)} AS moved FROM r) SELECT td, tk FROM s WHERE td >= born + 365 AND thin = 0 AND coalesce(moved, 1) = 0""")
def universe_masks(spark, sf_dir):
    """Listed for a year, no thin bar in eight positions, not about to hit a price limit."""
    p = returns(spark, sf_dir).withColumn("born", F.min("td").over(Window.partitionBy("tk")))
    p = p.withColumn("bad", (~((F.col("low") > 1) & (F.col("amount") > 1) & (F.col("volume") > 20))).cast("int")).withColumn("far", F.when(F.abs("ret") > 5, 1).otherwise(0))
    p = p.withColumn("thin", F.max("bad").over(win.trailing(8))).withColumn("moved", win.lagged("far", -1))
    return p.filter((F.col("td") >= F.date_add("born", 365)) & (F.col("thin") == 0) & (F.coalesce("moved", F.lit(1)) == 0)).select("td", "tk")


@query("weekly_bar", f"""WITH {WEEKLY}, x AS (SELECT *, count(*) OVER t AS n, max(open) OVER {LAG(4)} AS o5, max(high) OVER t AS h5, min(low) OVER t AS l5, sum(volume) OVER t AS v5, sum(amount) OVER t AS a5 FROM wk WINDOW t AS {TRAIL(5)}) """ + sql_tidy("td, tk", ["o5", "h5", "l5", "v5", "a5"], "x WHERE n = 5", 7))
def weekly_bar(spark, sf_dir):
    t = win.trailing(5)
    p = weekly(spark, sf_dir).withColumns({"n": F.count("*").over(t), "o5": win.lagged("open", 4), "h5": F.max("high").over(t), "l5": F.min("low").over(t), "v5": F.sum("volume").over(t), "a5": F.sum("amount").over(t)})
    return tidy(p.filter("n = 5"), KEYS, ["o5", "h5", "l5", "v5", "a5"], 7)


@query("panel_lag_return", f"WITH {RET} " + sql_tidy("td, tk", ["ret"], "r"))
def panel_lag_return(spark, sf_dir):
    return tidy(returns(spark, sf_dir), KEYS, ["ret"])


def _guard(sql: str, col: str, n: int, m: int) -> str:
    return f"CASE WHEN count({col}) OVER {TRAIL(n)} >= {m} THEN {sql} OVER {TRAIL(n)} END"


@query("rolling_features", f"WITH {RET}, x AS (SELECT td, tk, {_guard('stddev_samp(ret)', 'ret', 20, 10)} AS vol, {_guard('avg(amount)', 'amount', 20, 10)} AS turnover, {_guard('max(high)', 'high', 20, 10)} / {_guard('min(low)', 'low', 20, 10)} - 1 AS price_range FROM r) " + sql_tidy("td, tk", ["vol", "turnover", "price_range"], "x", 6))
def rolling_features(spark, sf_dir):
    p = returns(spark, sf_dir)
    t = win.trailing(20)
    p = p.withColumns({"vol": win.rolling_std("ret", 20, 10), "turnover": win.rolling_mean("amount", 20, 10), "price_range": win.guarded(F.max("high"), "high", t, 10) / win.guarded(F.min("low"), "low", t, 10) - 1})
    return tidy(p, KEYS, ["vol", "turnover", "price_range"], 6)


def _ewm(h: int, m: int) -> str:
    w = "(PARTITION BY tk ORDER BY ix RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count(close) OVER {w} >= {m} THEN sum(close * pow(2, ix / {h}.0::DOUBLE)) OVER {w} / sum(pow(2, ix / {h}.0::DOUBLE)) OVER {w} END"


@query("ewm_trend", f"WITH {WEEKLY}, x AS (SELECT td, tk, {_ewm(20, 10)} / {_ewm(120, 10)} AS trend FROM wk) " + sql_tidy("td, tk", ["trend"], "x"))
def ewm_trend(spark, sf_dir):
    return tidy(weekly(spark, sf_dir).withColumn("trend", win.ewm_mean("close", 20, 10) / win.ewm_mean("close", 120, 10)), KEYS, ["trend"])


@query("rolling_beta", f"""WITH {RET}, i AS (SELECT *, avg(ret) OVER (PARTITION BY td) AS mkt FROM r), s AS (SELECT td, tk, regr_slope(ret, mkt) OVER t AS beta, regr_count(ret, mkt) OVER t AS n, regr_sxx(ret, mkt) OVER t AS sxx,
 (regr_syy(ret, mkt) OVER t - pow(regr_sxy(ret, mkt) OVER t, 2) / nullif(regr_sxx(ret, mkt) OVER t, 0)) / nullif(regr_count(ret, mkt) OVER t - 2, 0) / nullif(regr_sxx(ret, mkt) OVER t, 0) AS se2 FROM i WINDOW t AS {TRAIL(52)}) """ + sql_tidy("td, tk", ["beta", "se2"], "s WHERE n >= 26", 3))
def rolling_beta(spark, sf_dir):
    p = returns(spark, sf_dir).withColumn("mkt", F.avg("ret").over(Window.partitionBy("td")))
    p = win.rolling_regression(p, "ret", "mkt", 52, 26, "beta", "se2")
    return tidy(p.filter("beta is not null"), KEYS, ["beta", "se2"], 3)


@query("topk_mean_return", f"WITH {RET}, x AS (SELECT td, tk, list_aggregate(list_sort(list(ret) FILTER (ret IS NOT NULL) OVER t, 'DESC')[1:6], 'avg') AS top6, list_aggregate(list_sort(list(ret) FILTER (ret IS NOT NULL) OVER t)[1:6], 'avg') AS low6, count(ret) OVER t AS n FROM r WINDOW t AS {TRAIL(40)}) " + sql_tidy("td, tk", ["top6", "low6"], "x WHERE n >= 20"))
def topk_mean_return(spark, sf_dir):
    p = returns(spark, sf_dir).withColumns({"top6": win.extreme_mean("ret", 40, 6, True, 20), "low6": win.extreme_mean("ret", 40, 6, False, 20)})
    return tidy(p.filter("top6 is not null"), KEYS, ["top6", "low6"])


@query("winsor_mad", f"WITH {MOM}, {MAD} " + sql_tidy("td, tk", ["w"], "wins"))
def winsor_mad(spark, sf_dir):
    return tidy(xs.winsorize_mad(momentum(spark, sf_dir), "mom", "w"), KEYS, ["w"])


@query("zscores", f"WITH {MOM}, {MAD}, z AS (SELECT td, tk, (w - avg(w) OVER d) / (stddev_samp(w) OVER d + 1e-8) AS z, (w - sum(w * amount) OVER d / sum(CASE WHEN w IS NOT NULL THEN amount END) OVER d) / (stddev_samp(w) OVER d + 1e-8) AS wz FROM wins WINDOW d AS (PARTITION BY td)) " + sql_tidy("td, tk", ["z", "wz"], "z WHERE z IS NOT NULL"))
def zscores(spark, sf_dir):
    p = xs.winsorize_mad(momentum(spark, sf_dir), "mom", "w").withColumns({"z": xs.zscore("w"), "wz": xs.weighted_zscore("w", "amount")})
    return tidy(p.filter("z is not null"), KEYS, ["z", "wz"])


@query("compressed_tails", f"""WITH {MOM}, z AS (SELECT td, tk, (mom - avg(mom) OVER d) / (stddev_samp(mom) OVER d + 1e-8) AS z FROM m WINDOW d AS (PARTITION BY td)),
 e AS (SELECT *, greatest(0, least(1, 0.5::DOUBLE / nullif(max(z) OVER d - 3, 0))) AS up, greatest(0, least(1, 0.5::DOUBLE / nullif(-min(z) OVER d - 3, 0))) AS dn FROM z WINDOW d AS (PARTITION BY td)),
 c AS (SELECT td, tk, CASE WHEN z > 3 THEN 3 * (1 - up) + z * up WHEN z < -3 THEN -3 * (1 - dn) + z * dn ELSE z END AS c FROM e) """ + sql_tidy("td, tk", ["c"], "c WHERE c IS NOT NULL"))
def compressed_tails(spark, sf_dir):
    p = momentum(spark, sf_dir).withColumn("z", xs.zscore("mom")).withColumn("c", xs.compress_tails("z"))
    return tidy(p.filter("c is not null"), KEYS, ["c"])


@query("log_cap_exposure", f"WITH {WEEKLY}, c AS (SELECT td, tk, ln(sum(amount) OVER {TRAIL(13)}) AS x FROM wk), z AS (SELECT td, tk, (x - avg(x) OVER d) / (stddev_samp(x) OVER d + 1e-8) AS mom FROM c WINDOW d AS (PARTITION BY td)), m AS (SELECT * FROM z), {MAD} " + sql_tidy("td, tk", ["w"], "wins"))
def log_cap_exposure(spark, sf_dir):
    p = weekly(spark, sf_dir).withColumn("x", F.log(F.sum("amount").over(win.trailing(13)))).withColumn("z", xs.zscore("x"))
    return tidy(xs.winsorize_mad(p, "z", "w"), KEYS, ["w"])


@query("bucket_returns", f"""WITH {MOM}, q AS (SELECT *, quantile_cont(mom, 0.3) OVER d AS lo, quantile_cont(mom, 0.7) OVER d AS hi FROM m WHERE mom IS NOT NULL WINDOW d AS (PARTITION BY td)),
 b AS (SELECT *, CASE WHEN mom <= lo THEN 1 WHEN mom <= hi THEN 2 ELSE 3 END AS bucket FROM q), s AS (SELECT td, avg(CASE WHEN bucket = 1 THEN fwd END) AS first, avg(CASE WHEN bucket = 3 THEN fwd END) AS third FROM b GROUP BY td),
 o AS (SELECT td, first, third, first - third AS spread FROM s) """ + sql_tidy("td", ["first", "third", "spread"], "o"))
def bucket_returns(spark, sf_dir):
    b = xs.percentile_bucket(momentum(spark, sf_dir).filter("mom is not null"), "mom", "bucket", [0.0, 0.3, 0.7, 1.0])
    s = b.groupBy("td").agg(F.avg(F.when(F.col("bucket") == 1, F.col("fwd"))).alias("first"), F.avg(F.when(F.col("bucket") == 3, F.col("fwd"))).alias("third"))
    return tidy(s.withColumn("spread", F.col("first") - F.col("third")), ["td"], ["first", "third", "spread"])


@query("xsec_residual", f"""WITH {MOM}, s AS (SELECT *, ln(amount) AS x FROM m WHERE mom IS NOT NULL), t AS (SELECT *, sum(volume) OVER d AS sw, sum(volume * x) OVER d AS sx, sum(volume * mom) OVER d AS sy, sum(volume * x * x) OVER d AS sxx, sum(volume * x * mom) OVER d AS sxy, count(*) OVER d AS n FROM s WINDOW d AS (PARTITION BY td)),
 u AS (SELECT *, (sw * sxy - sx * sy) / nullif(sw * sxx - sx * sx, 0) AS b FROM t WHERE n > 4), v AS (SELECT td, tk, mom - (sy - b * sx) / sw - b * x AS residual, mom - x * sxy / nullif(sxx, 0) AS residual0 FROM u) """ + sql_tidy("td, tk", ["residual", "residual0"], "v", 4))
def xsec_residual(spark, sf_dir):
    p = momentum(spark, sf_dir).filter("mom is not null").withColumn("x", F.log("amount")).withColumn("n", F.count("*").over(Window.partitionBy("td")))
    p = p.withColumns({"residual": xs.weighted_residual("mom", "x", "volume"), "residual0": xs.weighted_residual("mom", "x", "volume", intercept=False)})
    return tidy(p.filter("n > 4"), KEYS, ["residual", "residual0"], 4)


@query("orthogonal_factor", f"""WITH {MOM}, s AS (SELECT *, ln(amount) AS x1, ln(volume) AS x2 FROM m WHERE mom IS NOT NULL), a AS (SELECT *, count(*) OVER d AS n, sum(volume * x1) OVER d / sum(volume) OVER d AS m1, sum(volume * x2) OVER d / sum(volume) OVER d AS m2, sum(volume * mom) OVER d / sum(volume) OVER d AS my FROM s WINDOW d AS (PARTITION BY td)),
 c AS (SELECT *, sum(volume * (x1 - m1) ** 2) OVER d AS s11, sum(volume * (x2 - m2) ** 2) OVER d AS s22, sum(volume * (x1 - m1) * (x2 - m2)) OVER d AS s12, sum(volume * (x1 - m1) * (mom - my)) OVER d AS s1y, sum(volume * (x2 - m2) * (mom - my)) OVER d AS s2y FROM a WINDOW d AS (PARTITION BY td)),
 o AS (SELECT td, tk, mom - my - (x1 - m1) * (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) - (x2 - m2) * (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS residual FROM c WHERE n > 5) """ + sql_tidy("td, tk", ["residual"], "o", 3))
def orthogonal_factor(spark, sf_dir):
    """Residual of momentum on size, volume and volatility, weighted."""
    p = momentum(spark, sf_dir).filter("mom is not null").withColumns({"x1": F.log("amount"), "x2": F.log("volume"), "x3": F.lit(1.0)})
    return tidy(xs.orthogonalize(p, "mom", ["x1", "x2", "x3"], "volume", "residual").filter("residual is not null"), KEYS, ["residual"], 3)


NATION = "JOIN (SELECT CAST(s_suppkey AS INTEGER) AS sk, s_nationkey, s_acctbal FROM supplier) ON tk = sk"


def with_supplier(spark, sf_dir, p):
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("int").alias("tk"), "s_nationkey", "s_acctbal")
    return p.join(s, "tk")


@query("beta_shrink", f"""WITH {RET}, i AS (SELECT *, avg(ret) OVER (PARTITION BY td) AS mkt FROM r), s AS (SELECT td, tk, amount, regr_slope(ret, mkt) OVER t AS beta, regr_count(ret, mkt) OVER t AS n,
 (regr_syy(ret, mkt) OVER t - pow(regr_sxy(ret, mkt) OVER t, 2) / nullif(regr_sxx(ret, mkt) OVER t, 0)) / nullif(regr_count(ret, mkt) OVER t - 2, 0) / nullif(regr_sxx(ret, mkt) OVER t, 0) AS se2 FROM i WINDOW t AS {TRAIL(52)}),
 j AS (SELECT *, var_pop(beta) OVER g AS v, sum(beta * amount) OVER g / sum(amount) OVER g AS prior FROM s {NATION} WHERE n >= 26 WINDOW g AS (PARTITION BY td, s_nationkey)),
 o AS (SELECT td, tk, v / (v + se2) * beta + (1 - v / (v + se2)) * prior AS shrunk FROM j WHERE v + se2 > 1e-9) """ + sql_tidy("td, tk", ["shrunk"], "o", 3))
def beta_shrink(spark, sf_dir):
    p = returns(spark, sf_dir).withColumn("mkt", F.avg("ret").over(Window.partitionBy("td")))
    p = with_supplier(spark, sf_dir, win.rolling_regression(p, "ret", "mkt", 52, 26, "beta", "se2").filter("beta is not null"))
    g = Window.partitionBy("td", "s_nationkey")
    p = p.withColumns({"v": F.var_pop("beta").over(g), "prior": F.sum(F.col("beta") * F.col("amount")).over(g) / F.sum("amount").over(g)}).filter("v + se2 > 1e-9")
    c = F.col("v") / (F.col("v") + F.col("se2"))
    return tidy(p.withColumn("shrunk", c * F.col("beta") + (1 - c) * F.col("prior")), KEYS, ["shrunk"], 3)


def _ic_sql(by: str, source: str) -> str:
    ranks = lambda c: f"rank() OVER (PARTITION BY {by} ORDER BY {c}) + (count(*) OVER (PARTITION BY {by}, {c}) - 1) / 2.0::DOUBLE"
    return f"""x AS (SELECT {by}, mom, coalesce(fwd, 0) AS y FROM {source} WHERE mom IS NOT NULL), k AS (SELECT *, {ranks('mom')} AS rx, {ranks('y')} AS ry FROM x),
 c AS (SELECT {by}, count(*) AS n, corr(mom, y) AS ic, corr(rx, ry) AS rank_ic FROM k GROUP BY {by}), o AS (SELECT *, CASE WHEN n > 2 AND abs(ic) < 1 THEN ic * sqrt((n - 2) / (1 - ic * ic)) END AS t FROM c)"""


@query("information_coefficient", f"WITH {MOM}, {_ic_sql('td', 'm')} " + sql_tidy("td, n", ["ic", "rank_ic", "t"], "o WHERE n > 3"))
def information_coefficient(spark, sf_dir):
    return tidy(backtest.information_coefficient(momentum(spark, sf_dir), "mom", "fwd", "td").filter("n > 3"), ["td", "n"], ["ic", "rank_ic", "t"])


@query("ic_by_industry", f"WITH {MOM}, ms AS (SELECT * FROM m {NATION}), {_ic_sql('td, s_nationkey', 'ms')} " + sql_tidy("td, s_nationkey, n", ["ic"], "o WHERE n > 3"))
def ic_by_industry(spark, sf_dir):
    return tidy(backtest.information_coefficient(with_supplier(spark, sf_dir, momentum(spark, sf_dir)), "mom", "fwd", "td", "s_nationkey").filter("n > 3"), ["td", "s_nationkey", "n"], ["ic"])


@query("style_correlation", f"WITH {MOM}, ms AS (SELECT td, tk, mom, s_acctbal AS fwd FROM m {NATION}), {_ic_sql('td', 'ms')} " + sql_tidy("td, n", ["rank_ic"], "o WHERE n > 3"))
def style_correlation(spark, sf_dir):
    return tidy(backtest.information_coefficient(with_supplier(spark, sf_dir, momentum(spark, sf_dir)), "mom", "s_acctbal", "td").filter("n > 3"), ["td", "n"], ["rank_ic"])


#: Portfolio: every 13th week the twenty largest names by amount, equal weights, held from the next week on.
HOLD = f"""{RET}, top AS (SELECT ix // 13 AS seg, tk, row_number() OVER (PARTITION BY ix ORDER BY amount DESC, tk) AS k, ix + 1 AS from_ix FROM r WHERE ix % 13 = 0), last AS (SELECT max(ix) AS m FROM cal),
 h AS (SELECT CAST(seg AS INTEGER) AS seg, tk, 1.0::DOUBLE / count(*) OVER (PARTITION BY seg) AS w0, from_ix, least(from_ix + 12, m) AS to_ix FROM top, last WHERE k <= 20 AND from_ix <= m),
 dd AS (SELECT seg, tk, w0, to_ix, CAST(unnest(range(from_ix, to_ix + 1)) AS INTEGER) AS ix FROM h), gr AS (SELECT dd.*, w0 * product(1 + coalesce(ret, 0)) OVER (PARTITION BY seg, dd.tk ORDER BY dd.ix) AS grown FROM dd LEFT JOIN (SELECT tk, ix, ret FROM r) rr ON dd.tk = rr.tk AND dd.ix = rr.ix),
 bv AS (SELECT seg, ix, sum(grown) AS v, sum(w0) AS w FROM gr GROUP BY seg, ix), br AS (SELECT seg, ix, v / coalesce(lag(v) OVER (PARTITION BY seg ORDER BY ix), w) - 1 AS ret FROM bv)"""


def baskets(spark, sf_dir, deal: str = report.PRECLOSE):
    """The calendar with its segments, and what every held name is worth (see report.held): the line items are read once."""
    days = joins.local(trading_days(spark, sf_dir))
    p = bars(spark, sf_dir).join(F.broadcast(days.select("td", "ix")), "td").withColumn("vwap", F.col("amount") / F.col("volume"))
    place = F.row_number().over(Window.partitionBy("ix").orderBy(F.desc("amount"), "tk"))
    p = report.prices(p, deal).withColumn("grp", F.when((F.col("ix") % 13 == 0) & (place <= 20), F.lit(1)))
    p = p.withColumn("w0", F.when(F.col("grp") == 1, F.lit(1.0) / F.count("grp").over(Window.partitionBy("ix"))))
    plan = report.schedule(days, days.filter("ix % 13 = 0"))
    return plan, report.held(p, plan, deal)


def holdings(spark, sf_dir):
    """seg, tk, ix, w0, grown of every held name on every day."""
    plan, own = baskets(spark, sf_dir)
    return report.laid_out(own, plan)


@query("portfolio_return", f"WITH {HOLD} " + sql_tidy("seg, ix", ["ret"], "br"))
def portfolio_return(spark, sf_dir):
    return tidy(backtest.basket_returns(holdings(spark, sf_dir)), ["seg", "ix"], ["ret"])


@query("portfolio_turnover", f"""WITH {HOLD}, e AS (SELECT seg + 1 AS seg, tk, grown / sum(grown) OVER (PARTITION BY seg) AS w FROM gr WHERE ix = to_ix)
SELECT coalesce(h.seg, e.seg) AS seg, round(sum(abs(coalesce(w, 0) - coalesce(w0, 0))), 6) AS turnover FROM h FULL JOIN e ON h.seg = e.seg AND h.tk = e.tk
WHERE coalesce(h.seg, e.seg) > (SELECT min(seg) FROM h) AND coalesce(h.seg, e.seg) <= (SELECT max(seg) FROM h) GROUP BY 1""")
def portfolio_turnover(spark, sf_dir):
    plan, own = baskets(spark, sf_dir)
    return tidy(report.basket_turnover(own, plan), ["seg"], ["turnover"])


@query("portfolio_exposure", f"WITH {HOLD}, w AS (SELECT *, grown / sum(grown) OVER (PARTITION BY seg, ix) AS w FROM gr), o AS (SELECT seg, ix, s_nationkey, sum(w) AS exposure, sum(w * s_acctbal) AS style FROM w {NATION} GROUP BY ALL) " + sql_tidy("seg, ix, s_nationkey", ["exposure", "style"], "o", 4))
def portfolio_exposure(spark, sf_dir):
    g = holdings(spark, sf_dir).withColumn("w", F.col("grown") / F.sum("grown").over(Window.partitionBy("seg", "ix")))
    o = with_supplier(spark, sf_dir, g).groupBy("seg", "ix", "s_nationkey").agg(F.sum("w").alias("exposure"), F.sum(F.col("w") * F.col("s_acctbal")).alias("style"))
    return tidy(o, ["seg", "ix", "s_nationkey"], ["exposure", "style"], 4)


@query("portfolio_capacity", f"WITH {HOLD}, j AS (SELECT gr.ix, gr.grown AS w, amount FROM gr JOIN wk ON gr.tk = wk.tk AND gr.ix = wk.ix), o AS (SELECT ix, sum(amount) AS total, sum(w * amount) / sum(w) AS mean_amount, min(amount) AS min_amount, max(amount) AS max_amount, min(w) AS min_weight, max(w) AS max_weight, 0.1::DOUBLE * sum(amount) AS capacity FROM j GROUP BY ix) " + sql_tidy("ix", ["total", "mean_amount", "min_amount", "max_amount", "min_weight", "max_weight", "capacity"], "o", 3))
def portfolio_capacity(spark, sf_dir):
    j = holdings(spark, sf_dir).select("tk", "ix", F.col("grown").alias("w")).join(weekly(spark, sf_dir).select("tk", "ix", "amount"), ["tk", "ix"])
    return tidy(backtest.capacity(j, date="ix"), ["ix"], ["total", "mean_amount", "min_amount", "max_amount", "min_weight", "max_weight", "capacity"], 3)


NAV = f"{RET}, mk AS (SELECT td, ix, 1 + median(ret) / 10 AS g FROM r WHERE ret IS NOT NULL GROUP BY td, ix), nav AS (SELECT td, ix, product(g) OVER (ORDER BY ix) AS nav FROM mk), dr AS (SELECT *, nav / max(nav) OVER (ORDER BY ix) - 1 AS dd FROM nav)"


def market(spark, sf_dir):
    m = returns(spark, sf_dir).filter("ret is not null").groupBy("td", "ix").agg((F.median("ret") / 10).alias("ret")).withColumn("one", F.lit(1))
    return m.withColumn("nav", F.product(1 + F.col("ret")).over(Window.partitionBy("one").orderBy("ix")))


@query("drawdown_runs", f"WITH {NAV}, k AS (SELECT *, sum(CAST(dd >= 0 AS INTEGER)) OVER (ORDER BY ix) AS run FROM dr) SELECT min(ix) AS first, max(ix) AS last, count(*) AS days, round(min(dd), 6) AS depth FROM k WHERE dd < 0 GROUP BY run")
def drawdown_runs(spark, sf_dir):
    e = backtest.drawdown_episodes(backtest.drawdowns(market(spark, sf_dir), "one"), "one")
    return tidy(e, ["first", "last", "days"], ["depth"])


PERF = "count(*) AS n, product(g) - 1 AS total, pow(product(g), 52.0::DOUBLE / count(*)) - 1 AS annual, stddev_samp(g) * sqrt(52) AS vol, avg(CAST(g > 1 AS INTEGER)) AS win"


@query("performance_by_year", f"WITH {NAV}, y AS (SELECT CAST(year(td) AS VARCHAR) AS period, {PERF} FROM mk GROUP BY year(td) UNION ALL SELECT 'all', {PERF} FROM mk), o AS (SELECT *, annual / nullif(vol, 0) AS sharpe FROM y) " + sql_tidy("period, n", ["total", "annual", "vol", "win", "sharpe"], "o", 4))
def performance_by_year(spark, sf_dir):
    m = market(spark, sf_dir)
    years = m.select("*", report.periods())
    return tidy(backtest.performance(years, ["period"]), ["period", "n"], ["total", "annual", "vol", "win", "sharpe"], 4)


@query("screened_portfolio", f"""WITH {MOM}, a AS (SELECT *, row_number() OVER (PARTITION BY td ORDER BY amount DESC NULLS LAST, tk) AS ra, row_number() OVER (PARTITION BY td ORDER BY mom ASC NULLS LAST, tk) AS rm, count(mom) OVER (PARTITION BY td) AS n FROM m),
 s AS (SELECT *, ra <= 50 AS i1, count(*) FILTER (ra <= 50) OVER (PARTITION BY td) >= 10 AS k1 FROM a), u AS (SELECT *, CASE WHEN k1 THEN i1 ELSE TRUE END AS in1 FROM s), v AS (SELECT *, in1 AND mom IS NOT NULL AND rm <= greatest(1, floor(n * 0.4::DOUBLE)) AS i2 FROM u),
 x AS (SELECT *, count(*) FILTER (i2) OVER (PARTITION BY td) >= 10 AS k2 FROM v) SELECT td, tk FROM x WHERE CASE WHEN k2 THEN i2 ELSE in1 END""")
def screened_portfolio(spark, sf_dir):
    return backtest.screen(momentum(spark, sf_dir), [("amount", -50), ("mom", 0.4)]).select("td", "tk")


@query("label_simple", f"WITH {WEEKLY}, x AS (SELECT td, tk, max(vwap) OVER {AHEAD(5)} / max(close) OVER {AHEAD(1)} - 1 AS label FROM wk) " + sql_tidy("td, tk", ["label"], "x WHERE label IS NOT NULL"))
def label_simple(spark, sf_dir):
    return tidy(weekly(spark, sf_dir).withColumn("label", dataset.simple_label("close", "vwap", 4, 1)).filter("label is not null"), KEYS, ["label"])


@query("label_similar")
def label_similar(spark, sf_dir):
    """On every date with 60 positions of returns: labels less the median of the names whose returns correlate most."""
    p = returns(spark, sf_dir).withColumn("y", dataset.simple_label("close", "close", 4, 1)).select("tk", "ix", F.col("ret").alias("r"), "y")
    found = dataset.rolling_similar_labels(p, length=60, neighbours=30).join(F.broadcast(trading_days(spark, sf_dir).select("td", "ix")), "ix")
    return tidy(found, KEYS, ["similar_label", "near_mean", "near_std"])


@query("window_dataset", f"WITH {WEEKLY}, x AS (SELECT td, tk, list(close) OVER w AS xs, count(*) OVER w AS n FROM wk WINDOW w AS (PARTITION BY tk ORDER BY ix ROWS BETWEEN 7 PRECEDING AND CURRENT ROW)), y AS (SELECT td, tk, list_filter(xs, lambda v, i: i % 2 = 0) AS s FROM x WHERE n = 8), o AS (SELECT td, tk, s[1] / s[-1] AS first_ratio, list_sum(s) / s[-1] AS ratio_sum FROM y WHERE list_min(s) > 0) " + sql_tidy("td, tk", ["first_ratio", "ratio_sum"], "o"))
def window_dataset(spark, sf_dir):
    d = dataset.windows(weekly(spark, sf_dir), "close", 4, 2).filter(dataset.all_positive("x")).withColumn("x", dataset.by_last_value("x"))
    return tidy(d.withColumn("first_ratio", F.element_at("x", 1)).withColumn("ratio_sum", F.aggregate("x", F.lit(0.0), lambda s, v: s + v)), KEYS, ["first_ratio", "ratio_sum"])


@query("fitted_clip_scale", f"""WITH {MOM}, tr AS (SELECT mom FROM m WHERE year(td) < 2000 AND mom IS NOT NULL), md AS (SELECT median(mom) AS med FROM tr), mm AS (SELECT med, median(abs(mom - med)) AS mad FROM tr, md GROUP BY med),
 c AS (SELECT td, tk, CASE WHEN mom IS NOT NULL THEN least(greatest(mom, med - 5 * 1.483::DOUBLE * mad), med + 5 * 1.483::DOUBLE * mad) END AS c FROM m, mm), s AS (SELECT avg(c) AS mu, stddev_samp(c) AS sd FROM c WHERE year(td) < 2000), o AS (SELECT td, tk, (c - mu) / sd AS x FROM c, s) """ + sql_tidy("td, tk", ["x"], "o WHERE x IS NOT NULL"))
def fitted_clip_scale(spark, sf_dir):
    p = momentum(spark, sf_dir).select(*KEYS, F.col("mom").alias("x"))
    train = p.filter("year(td) < 2000").persist()
    ends = dataset.fit_clip(train, ["x"])
    fitted = dataset.fit_scale(dataset.clip(train, ends), ["x"])
    train.unpersist()
    return tidy(dataset.scale(dataset.clip(p, ends), fitted).filter("x is not null"), KEYS, ["x"])


@query("upsert_by_date", f"WITH {WEEKLY}, old AS (SELECT td, tk, close FROM wk WHERE ix < 200), new AS (SELECT td, tk, close * 2 AS close FROM wk WHERE ix >= 150) " + sql_tidy("td, tk", ["close"], "(SELECT * FROM old WHERE td < (SELECT min(td) FROM new) UNION ALL SELECT * FROM new)", 7))
def upsert_by_date(spark, sf_dir):
    p = weekly(spark, sf_dir).select("td", "tk", "close", "ix")
    new = p.filter("ix >= 150").withColumn("close", F.col("close") * 2)
    return tidy(joins.upsert_by_date(p.filter("ix < 200"), new), KEYS, ["close"], 7)
