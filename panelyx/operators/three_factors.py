"""Returns of size, value and the market by date, from one panel."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import windows as win


def run(panel: DataFrame, index: DataFrame, *, positions: int = 244, limit: float = 0.2, sign: int = 1) -> DataFrame:
    """td, hml, smb, mkt of every date that has all three.

    panel: td, tk, ix, ret, cap, pb (price to book). index: td, ret. A return counts if the name had one ``positions`` before (in the first
    ``positions`` dates all do) and if it is not beyond the limit. Names are dealt by what their cap and 1 / pb were a position before: halves by
    cap, the lowest 30, middle 40 and highest 30 percent by 1 / pb, among all names of the date with a row; a factor is the mean return
    of the first part less that of the last. sign -1 turns hml to high less low.

    One window by name, one by date for the percentiles, one sum by date.
    """
    fit = ((F.col("ix") < positions) | win.lagged("ret", positions).isNotNull()) & (F.abs("ret") <= limit)
    p = panel.select("td", "tk", "ix", "ret", F.when(fit, F.col("ret")).alias("r"), win.lagged("cap", 1).alias("size"), F.try_divide(F.lit(1.0), win.lagged("pb", 1)).alias("value"))
    date = Window.partitionBy("td")
    p = p.withColumn("s", F.percentile("size", F.lit(0.5)).over(date)).withColumn("v", F.percentile("value", F.array(F.lit(0.3), F.lit(0.7))).over(date))
    mean = lambda where: F.avg(F.when(where, F.col("r")))
    low, high = F.element_at("v", 1), F.element_at("v", 2)
    both = p.groupBy("td").agg(
        (sign * (mean(F.col("value") <= low) - mean(F.col("value") > high))).alias("hml"),
        (mean(F.col("size") <= F.col("s")) - mean(F.col("size") > F.col("s"))).alias("smb"),
    )
    return both.join(index.select(F.col("td"), F.col("ret").alias("mkt")), "td").select("td", "hml", "smb", "mkt").dropna()
