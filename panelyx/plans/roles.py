"""The driver's tables in the roles of a panel library: price panel, facts, estimates, intervals, intraday bars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import joins, pit


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trading_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar of weeks, from one column of the line items."""
    return joins.calendar(table(spark, sf_dir, "lineitem").select(F.date_trunc("week", "l_shipdate").alias("td")))


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """td (week), tk (supplier), open, high, low, close, volume, amount."""
    line = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    line = line.select("*", F.to_date(F.date_trunc("week", "l_shipdate")).alias("td"), F.col("l_suppkey").cast("int").alias("tk")).drop("l_suppkey")
    # a bar has hardly two line items: these are shuffled, not states of the aggregates, which hold two prices with their order each
    line = line.repartition("td", "tk").withColumn("u", F.col("l_extendedprice") / F.col("l_quantity"))
    order = F.struct("l_shipdate", "l_orderkey", "l_linenumber", "u")
    return line.groupBy("td", "tk").agg(
        F.min_by("u", order).alias("open"), F.max("u").alias("high"), F.min("u").alias("low"), F.max_by("u", order).alias("close"),
        F.sum("l_quantity").alias("volume"), F.sum("l_extendedprice").alias("amount"),
    )


def weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """bars with ix and vwap."""
    # a calendar has at most some ten thousand rows
    return bars(spark, sf_dir).join(F.broadcast(trading_days(spark, sf_dir).select("td", "ix")), "td").withColumn("vwap", F.col("amount") / F.col("volume"))


#: The same panel for DuckDB, as common table expressions wk (panel) and cal (calendar).
WEEKLY = """
li AS (SELECT CAST(date_trunc('week', l_shipdate) AS DATE) AS td, CAST(l_suppkey AS INTEGER) AS tk, l_extendedprice / l_quantity AS u, * FROM lineitem),
wk0 AS (SELECT td, tk, first(u ORDER BY l_shipdate, l_orderkey, l_linenumber, u) AS open, max(u) AS high, min(u) AS low,
               last(u ORDER BY l_shipdate, l_orderkey, l_linenumber, u) AS close, sum(l_quantity) AS volume, sum(l_extendedprice) AS amount
        FROM li GROUP BY td, tk),
cal AS (SELECT td, CAST(row_number() OVER (ORDER BY td) - 1 AS INTEGER) AS ix FROM (SELECT DISTINCT td FROM wk0)),
wk AS (SELECT wk0.*, cal.ix, amount / volume AS vwap FROM wk0 JOIN cal USING (td))
"""


def intraday(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly bars of events by date and user group (10 groups): td, tk, bar, open ... trades."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value").filter(F.col("value").isNotNull())
    key = F.struct("ts", "event_id")
    v = F.abs("value") + 1
    return (
        e.groupBy(F.to_date("ts").alias("td"), (F.col("user_id") % 10).cast("int").alias("tk"), F.hour("ts").alias("bar"))
        .agg(F.min_by(v, key).alias("open"), F.max(v).alias("high"), F.min(v).alias("low"), F.max_by(v, key).alias("close"), F.sum(v).alias("volume"), F.sum(v * (F.col("event_id") % 7 + 1)).alias("amount"), F.count("*").alias("trades"))
        .withColumn("preclose", F.col("low"))
    )


INTRADAY = """
b AS (SELECT CAST(ts AS DATE) AS td, CAST(user_id % 10 AS INTEGER) AS tk, CAST(hour(ts) AS INTEGER) AS bar,
        first(abs(value) + 1 ORDER BY ts, event_id) AS open, max(abs(value) + 1) AS high, min(abs(value) + 1) AS low, last(abs(value) + 1 ORDER BY ts, event_id) AS close,
        sum(abs(value) + 1) AS volume, sum((abs(value) + 1) * (event_id % 7 + 1)) AS amount, count(*) AS trades FROM events WHERE value IS NOT NULL GROUP BY 1, 2, 3),
p0 AS (SELECT *, low AS preclose, close / coalesce(lag(close) OVER w, open) - 1 AS ret, volume / sum(volume) OVER d AS share, max(bar) OVER d AS t_max,
        row_number() OVER (PARTITION BY td, tk ORDER BY volume DESC, bar) AS by_volume, close - lag(close) OVER w AS dclose, count(*) OVER d AS t
       FROM b WINDOW w AS (PARTITION BY td, tk ORDER BY bar), d AS (PARTITION BY td, tk)),
p AS (SELECT *, lead(ret) OVER w AS next_ret, lead(volume) OVER w AS next_volume FROM p0 WINDOW w AS (PARTITION BY td, tk ORDER BY bar))
"""


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as versioned facts: customer, announcement = order date, quarter = the one before it, value = total price."""
    o = table(spark, sf_dir, "orders").withColumn("end", F.date_sub(F.to_date(F.date_trunc("quarter", "o_orderdate")), 1))
    return pit.facts(o, "o_custkey", "o_orderdate", "end", "o_totalprice", "o_orderkey")


FACTS = """
f AS (SELECT tk, ann, q, v, row_number() OVER (PARTITION BY tk ORDER BY ann, q, o_orderkey) AS rid FROM (
        SELECT o_custkey AS tk, CAST(o_orderdate AS DATE) AS ann, CAST(year(e) * 4 + quarter(e) - 1 AS INTEGER) AS q, o_totalprice AS v, o_orderkey
        FROM (SELECT *, date_trunc('quarter', o_orderdate) - INTERVAL 1 DAY AS e FROM orders) WHERE o_totalprice IS NOT NULL))
"""


def dense_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly order values of 50 customer groups as versioned facts; every quarter has up to three versions."""
    o = table(spark, sf_dir, "orders").groupBy((F.col("o_custkey") % 50).alias("tk"), F.to_date(F.date_trunc("month", "o_orderdate")).alias("m"))
    o = o.agg(F.to_date(F.max("o_orderdate")).alias("ann"), F.round(F.sum("o_totalprice"), 2).alias("v")).withColumn("end", F.date_sub(F.to_date(F.date_trunc("quarter", "m")), 1))
    return pit.facts(o, "tk", "ann", "end", "v", "m")


DENSE_FACTS = """
f AS (SELECT tk, ann, q, v, row_number() OVER (PARTITION BY tk ORDER BY ann, q, m) AS rid FROM (
        SELECT tk, m, ann, v, CAST(year(e) * 4 + quarter(e) - 1 AS INTEGER) AS q FROM (
          SELECT o_custkey % 50 AS tk, date_trunc('month', o_orderdate) AS m, CAST(max(o_orderdate) AS DATE) AS ann, round(sum(o_totalprice), 2) AS v,
                 date_trunc('quarter', date_trunc('month', o_orderdate)) - INTERVAL 1 DAY AS e FROM orders GROUP BY ALL) WHERE v IS NOT NULL))
"""


def estimates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as estimates: brand, supplier as institution, date, period one to three years ahead."""
    line = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    return line.select(
        F.col("p_brand").alias("tk"), F.col("l_suppkey").alias("inst"), F.to_date("l_shipdate").alias("est_dt"), (F.year("l_shipdate") + F.col("l_linenumber") % 3 + 1).cast("int").alias("period"),
        F.col("l_extendedprice").alias("est"), F.struct("l_orderkey", "l_linenumber", "l_extendedprice").alias("seq"),
    )


ESTIMATES = """
est AS (SELECT p_brand AS tk, l_suppkey AS inst, CAST(l_shipdate AS DATE) AS est_dt, CAST(year(l_shipdate) + l_linenumber % 3 + 1 AS INTEGER) AS period, l_extendedprice AS est, l_orderkey, l_linenumber
        FROM lineitem JOIN part ON l_partkey = p_partkey)
"""
