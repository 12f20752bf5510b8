"""Queries of universe masks over the weekly panel, and of the calendar."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import joins
from ..operators import universe as un
from .panel_queries import AHEAD, KEYS, TRAIL
from .registry import query
from .roles import WEEKLY, table, trading_days, weekly

SPANS = f"{WEEKLY}, s AS (SELECT tk, min(td) AS a, max(td) AS z FROM wk GROUP BY tk), iv AS (SELECT tk, a + 200 AS entry_dt, CASE WHEN tk % 3 = 0 THEN NULL ELSE a + 600 END AS remove_dt, CASE WHEN tk % 2 = 0 THEN 'S' ELSE 'R' END AS kind, CAST(tk % 5 AS VARCHAR) AS code FROM s)"


def spans(spark, sf_dir):
    return weekly(spark, sf_dir).groupBy("tk").agg(F.min("td").alias("list_dt"), F.max("td").alias("delist_dt"))


def intervals(spark, sf_dir):
    remove = F.when(F.col("tk") % 3 != 0, F.date_add("list_dt", 600))
    return spans(spark, sf_dir).select("tk", F.date_add("list_dt", 200).alias("entry_dt"), remove.alias("remove_dt"), F.when(F.col("tk") % 2 == 0, "S").otherwise("R").alias("kind"), (F.col("tk") % 5).cast("string").alias("code"))


LISTED = "SELECT td, tk FROM cal JOIN s ON td BETWEEN a + 365 AND z"
THIN = f"SELECT td, tk FROM (SELECT *, max(CAST(NOT volume > 10 AS INTEGER)) OVER {TRAIL(8)} AS bad FROM wk) WHERE bad = 1 AND ix >= 7"
SPECIAL = "SELECT DISTINCT td, tk FROM cal JOIN iv ON td BETWEEN entry_dt AND coalesce(remove_dt, DATE '2100-01-01') WHERE kind <> 'R'"
SUSPENDED = "SELECT td, tk FROM wk WHERE CAST(floor(volume) AS INTEGER) % 7 = 0"
LIMITED = f"SELECT td, tk FROM (SELECT *, max(CASE WHEN close >= open * 1.9::DOUBLE OR close <= open * 0.5::DOUBLE THEN 1 ELSE 0 END) OVER {AHEAD(1)} AS hit FROM wk) WHERE coalesce(hit, 1) = 1"


@query("universe_listed", f"WITH {SPANS} {LISTED}")
def universe_listed(spark, sf_dir):
    return un.listed(trading_days(spark, sf_dir), spans(spark, sf_dir))


@query("universe_thin", f"WITH {SPANS} {THIN}")
def universe_thin(spark, sf_dir):
    return un.thinly_traded(weekly(spark, sf_dir), 8, F.col("volume") > 10)


@query("universe_special", f"WITH {SPANS} {SPECIAL}")
def universe_special(spark, sf_dir):
    return un.special_treatment(trading_days(spark, sf_dir), intervals(spark, sf_dir))


@query("universe_suspended", f"WITH {SPANS} {SUSPENDED}")
def universe_suspended(spark, sf_dir):
    return un.suspended(weekly(spark, sf_dir).withColumn("status", F.floor("volume").cast("int") % 7))


@query("universe_price_limit", f"WITH {SPANS} {LIMITED}")
def universe_price_limit(spark, sf_dir):
    return un.price_limited(weekly(spark, sf_dir).withColumns({"up_limit": F.col("open") * 1.9, "down_limit": F.col("open") * 0.5}))


@query("universe_members", f"WITH {SPANS} SELECT DISTINCT td, tk FROM cal JOIN iv ON td BETWEEN entry_dt AND coalesce(remove_dt, DATE '2100-01-01') WHERE code = '2'")
def universe_members(spark, sf_dir):
    return un.members(trading_days(spark, sf_dir), intervals(spark, sf_dir), "2", start="entry_dt", end="remove_dt")


@query("universe_industry", f"WITH {SPANS} SELECT td, code AS industry, count(*) AS n FROM cal JOIN iv ON td BETWEEN entry_dt AND coalesce(remove_dt, DATE '2100-01-01') GROUP BY td, code")
def universe_industry(spark, sf_dir):
    d = un.industry(trading_days(spark, sf_dir), intervals(spark, sf_dir).withColumnRenamed("code", "industry"), start="entry_dt", end="remove_dt")
    return d.groupBy("td", "industry").agg(F.count("*").alias("n"))


@query("universe_all", f"WITH {SPANS} SELECT td, tk FROM wk WHERE (td, tk) IN ({LISTED}) AND (td, tk) NOT IN ({THIN}) AND (td, tk) NOT IN ({SPECIAL}) AND (td, tk) NOT IN ({SUSPENDED}) AND (td, tk) NOT IN ({LIMITED})")
def universe_all(spark, sf_dir):
    masks = [f(spark, sf_dir) for f in (universe_thin, universe_special, universe_suspended, universe_price_limit)]
    return un.universe(weekly(spark, sf_dir).select(*KEYS), [universe_listed(spark, sf_dir)], masks)


ORDER_DAYS = "e AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)"


@query("shift_trading_days", f"WITH {WEEKLY}, {ORDER_DAYS} SELECT d, (SELECT min(td) FROM cal WHERE td > d) AS next1, (SELECT max(td) FROM cal WHERE td < d) AS previous1, (SELECT td FROM cal WHERE td > d ORDER BY td LIMIT 1 OFFSET 2) AS next3, (SELECT td FROM cal WHERE td < d ORDER BY td DESC LIMIT 1 OFFSET 2) AS previous3 FROM e")
def shift_trading_days(spark, sf_dir):
    days = trading_days(spark, sf_dir)
    e = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("d")).distinct()
    for name, n in (("next1", 1), ("previous1", -1), ("next3", 3), ("previous3", -3)):
        e = joins.shift_dates(e, days, "d", n, out=name)
    return e


@query("dates_between", f"WITH {WEEKLY} SELECT '[]' AS bounds, count(*) AS n FROM cal WHERE td BETWEEN DATE '1995-01-02' AND DATE '1996-01-01' UNION ALL SELECT '(]', count(*) FROM cal WHERE td > DATE '1995-01-02' AND td <= DATE '1996-01-01' UNION ALL SELECT '[)', count(*) FROM cal WHERE td >= DATE '1995-01-02' AND td < DATE '1996-01-01' UNION ALL SELECT '()', count(*) FROM cal WHERE td > DATE '1995-01-02' AND td < DATE '1996-01-01'")
def dates_between(spark, sf_dir):
    days = trading_days(spark, sf_dir)
    parts = [joins.dates_between(days, "1995-01-02", "1996-01-01", b).agg(F.lit(b).alias("bounds"), F.count("*").alias("n")) for b in ("[]", "(]", "[)", "()")]
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


@query("align_to_grid", f"WITH {WEEKLY}, g AS (SELECT cal.td AS td, sk AS tk FROM cal JOIN (SELECT CAST(s_suppkey AS INTEGER) AS sk FROM supplier WHERE s_nationkey = 3) ON cal.ix % 2 = 0) SELECT g.td, g.tk, round(close, 6) AS close FROM g LEFT JOIN wk ON g.td = wk.td AND g.tk = wk.tk")
def align_to_grid(spark, sf_dir):
    """Closing prices of one nation's suppliers on every second week."""
    days = trading_days(spark, sf_dir).filter("ix % 2 = 0").withColumn("one", F.lit(1))
    names = table(spark, sf_dir, "supplier").filter("s_nationkey = 3").select(F.col("s_suppkey").cast("int").alias("tk"), F.lit(1).alias("one"))
    grid = names.join(F.broadcast(days), "one").select(*KEYS)
    return joins.align(weekly(spark, sf_dir).select(*KEYS, F.round("close", 6).alias("close")), grid)


@query("ordered_report", "SELECT p_brand, n, CAST(row_number() OVER (ORDER BY n DESC, p_brand) AS INTEGER) AS place FROM (SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand) ORDER BY n DESC, p_brand LIMIT 10")
def ordered_report(spark, sf_dir):
    """The ten brands with most parts, in order; the place makes the order visible."""
    top = table(spark, sf_dir, "part").groupBy("p_brand").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "p_brand").limit(10)
    return top.withColumn("place", F.row_number().over(Window.orderBy(F.desc("n"), "p_brand"))).orderBy(F.desc("n"), "p_brand")


@query("column_comparison", "SELECT l_returnflag, count(*) AS n FROM lineitem WHERE l_discount < l_tax AND l_suppkey < l_partkey GROUP BY l_returnflag")
def column_comparison(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").filter("l_discount < l_tax and l_suppkey < l_partkey").groupBy("l_returnflag").agg(F.count("*").alias("n"))
