"""Daily and weekly bars of a price panel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import windows as win

PRICES = ("open", "high", "low", "close")


def daily(panel: DataFrame, adjustment: str | None = None, prices: tuple[str, ...] = PRICES, totals: tuple[str, ...] = ("volume", "amount")) -> DataFrame:
    """Prices times the adjustment factor, and the log of one plus volume and amount."""
    out = panel.withColumns({t: F.log1p(t) for t in totals})
    return out.withColumns({p: F.col(p) * F.col(adjustment) for p in prices}) if adjustment else out


def weekly_vwap(panel: DataFrame, n: int = 5, out: str = "vwap5") -> DataFrame:
    """Amount over volume of n positions, the close where nothing was paid; NULL where a position is missing."""
    t = win.trailing(n)
    a, v = F.sum("amount").over(t), F.sum("volume").over(t)
    return panel.withColumn(out, F.when(F.count("close").over(t) == n, F.when(a > 0, a / v).otherwise(F.col("close"))))
