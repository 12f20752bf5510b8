"""The whole consensus over the driver's orders in the roles of estimates and annual reports."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import windows as win
from ..operators import analyst, joins
from ..operators import three_factors as ff
from .panel_queries import KEYS, LAG, RET, TRAIL, returns
from .registry import clean, query, sql_clean, sql_tidy, tidy
from .roles import WEEKLY, table, trading_days


def order_estimates(spark, sf_dir):
    """Orders as estimates of 100 names by 30 institutions for this year and the next ones; every 13th is empty or 0."""
    o, key = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    return o.select(
        (F.col("o_custkey") % 100).alias("tk"), (F.col("o_custkey") % 30).alias("inst"), F.to_date("o_orderdate").alias("est_dt"), F.make_date((F.year("o_orderdate") + key % 4 - 1).cast("int"), F.lit(12), F.lit(31)).alias("period"),
        F.when(key % 13 == 0, F.lit(0.0)).when(key % 13 == 1, F.lit(None)).otherwise(F.col("o_totalprice")).alias("est"), key.alias("seq"),
    )


def order_statements(spark, sf_dir):
    """Orders as statements: of the year before, some of half years, of two types."""
    o, key = table(spark, sf_dir, "orders").filter("o_orderkey % 6 = 0"), F.col("o_orderkey")
    end = F.when(key % 5 == 0, F.make_date(F.year("o_orderdate"), F.lit(6), F.lit(30))).otherwise(F.make_date((F.year("o_orderdate") - 1 - F.when(key % 7 == 0, 1).otherwise(0)).cast("int"), F.lit(12), F.lit(31)))
    return o.select((F.col("o_custkey") % 100).alias("tk"), F.to_date("o_orderdate").alias("ann_dt"), end.alias("period"), F.col("o_totalprice").alias("profit"), F.when(key % 4 == 0, "consolidated").otherwise("parent").alias("statement_type"), key.alias("seq"))


W, H, Y = 26, 5, 52
OUT = ["lr", "fy0", "fy1", "fy2", "fttm"]


@query("consensus_whole", f"""WITH {WEEKLY},
 e AS MATERIALIZED (SELECT tk, inst, period, est * 10000 AS est, seq, (SELECT max(ix) FROM cal WHERE td <= est_dt) AS ix FROM (
   SELECT o_custkey % 100 AS tk, o_custkey % 30 AS inst, CAST(o_orderdate AS DATE) AS est_dt, make_date(year(o_orderdate) + o_orderkey % 4 - 1, 12, 31) AS period, CASE WHEN o_orderkey % 13 < 2 THEN NULL ELSE o_totalprice END AS est, o_orderkey AS seq FROM orders) WHERE est IS NOT NULL),
 r AS MATERIALIZED (SELECT o_custkey % 100 AS tk, CAST(o_orderdate AS DATE) AS ann, make_date(year(o_orderdate) - 1 - CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END, 12, 31) AS period, o_totalprice AS profit, o_orderkey AS seq FROM orders WHERE o_orderkey % 6 = 0 AND o_orderkey % 5 > 0 AND o_orderkey % 4 = 0),
 g AS MATERIALIZED (SELECT cal.td AS td, cal.ix AS ix, r.tk AS tk, arg_max(period, (ann, seq)) AS last_period, arg_max(profit, (ann, seq)) AS lr FROM cal JOIN r ON r.ann <= cal.td GROUP BY ALL),
 s AS MATERIALIZED (SELECT g.td, g.tk, g.ix, e.inst, e.est, g.ix - e.ix AS age, datediff('year', g.last_period, e.period) AS k, row_number() OVER (PARTITION BY g.td, g.tk, e.inst, e.period ORDER BY e.ix DESC, e.seq DESC) AS n FROM g JOIN e ON e.tk = g.tk AND e.ix BETWEEN g.ix - {W} AND g.ix),
 c AS (SELECT td, tk, {', '.join(f'sum(CASE WHEN k = {k} THEN est * pow(0.5::DOUBLE, age / {H}.0::DOUBLE) END) / sum(CASE WHEN k = {k} THEN pow(0.5::DOUBLE, age / {H}.0::DOUBLE) END) AS fy{k - 1}' for k in (1, 2, 3))} FROM s WHERE n = 1 GROUP BY td, tk),
 d AS (SELECT td, ix - min(ix) OVER (PARTITION BY year(td)) + 1 AS day FROM cal),
 x AS (SELECT c.*, g.last_period, g.lr, day, year(td) - year(last_period) AS gap, greatest({Y} - day, 0) AS left_, greatest(day, 0) AS done FROM c JOIN g USING (td, tk) JOIN d USING (td)),
 o AS (SELECT *, (CASE gap WHEN 0 THEN lr WHEN 1 THEN fy0 WHEN 2 THEN fy1 WHEN 3 THEN fy2 END * left_ + CASE gap WHEN 0 THEN fy0 WHEN 1 THEN fy1 WHEN 2 THEN fy2 END * done) / (left_ + done) AS fttm FROM x)
 SELECT td, tk, last_period, {', '.join(sql_clean(v, v, 2) for v in OUT)} FROM o""")
def consensus_whole(spark, sf_dir):
    """Target years follow from the last annual report that each date knows; windows and decay count positions; the next twelve months are a blend."""
    days = joins.local(trading_days(spark, sf_dir))
    reports = analyst.annual_reports(order_statements(spark, sf_dir), statement_type="consolidated")
    out = analyst.consensus(order_estimates(spark, sf_dir), reports, days, window=W, half_life=H, year_positions=Y)
    return out.select(*KEYS, "last_period", *(clean(F.col(c), 2).alias(c) for c in OUT))


@query("three_factors", f"""WITH {RET}, k AS (SELECT *, sum(amount) OVER {TRAIL(13)} AS cap, volume * (1 + tk % 3) AS pb FROM r),
 l AS (SELECT *, CASE WHEN (ix < 52 OR max(ret) OVER {LAG(52)} IS NOT NULL) AND abs(ret) <= 0.5::DOUBLE THEN ret END AS fit, max(cap) OVER {LAG(1)} AS size, 1 / max(pb) OVER {LAG(1)} AS value FROM k),
 q AS (SELECT *, quantile_cont(size, 0.5) OVER d AS s, quantile_cont(value, 0.3) OVER d AS v1, quantile_cont(value, 0.7) OVER d AS v2, sum(amount * close) OVER d / sum(amount) OVER d AS level FROM l WINDOW d AS (PARTITION BY td)),
 o AS (SELECT td, avg(CASE WHEN value <= v1 THEN fit END) - avg(CASE WHEN value > v2 THEN fit END) AS hml, avg(CASE WHEN size <= s THEN fit END) - avg(CASE WHEN size > s THEN fit END) AS smb, any_value(level) AS level FROM q GROUP BY td),
 x AS (SELECT td, hml, smb, level / lag(level) OVER (ORDER BY td) - 1 AS mkt FROM o) """ + sql_tidy("td", ["hml", "smb", "mkt"], "x WHERE hml IS NOT NULL AND smb IS NOT NULL AND mkt IS NOT NULL", 6))
def three_factors(spark, sf_dir):
    """Size, value and market returns by week; the market is the amount-weighted price level."""
    p = returns(spark, sf_dir).withColumns({"cap": F.sum("amount").over(win.trailing(13)), "pb": F.col("volume") * (1 + F.col("tk") % 3)})
    level = p.groupBy("td").agg((F.sum(F.col("amount") * F.col("close")) / F.sum("amount")).alias("level"))
    # one row a date: a calendar's size
    index = level.select("td", (F.col("level") / F.lag("level").over(Window.orderBy("td")) - 1).alias("ret"))
    return tidy(ff.run(p, index, positions=52, limit=0.5), ["td"], ["hml", "smb", "mkt"], 6)
