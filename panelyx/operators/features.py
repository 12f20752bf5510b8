"""Features of stored daily and intraday bars, for a feature manager: functions of stores' slices that return td, tk and a column for each feature.

``reach`` says how many dates before a date a value depends on. Quotes are td, tk, ix, prices, volume, amount and the adjustment
factor adj; bars are as in ``operators.intraday``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import windows as win
from ..sources.stores import feature
from . import bars as _bars
from . import intraday as _intraday

_PRICES = ("open", "high", "low", "close")


def daily_bar(quote: DataFrame) -> DataFrame:
    """Adjusted prices; logs of one plus volume and amount."""
    return _bars.daily(quote, "adj").select("td", "tk", *_PRICES, "volume", "amount")


@feature(reach=4)
def weekly_bar(quote: DataFrame) -> DataFrame:
    """Bars of five positions: the first open, extremes, the last close, sums, and the adjusted price paid on average."""
    p = _bars.daily(quote, "adj", totals=())
    w = win.trailing(5)
    whole = lambda x: F.when(F.count("close").over(w) == 5, x)
    amount, volume = F.sum("amount").over(w), F.sum("volume").over(w)
    p = p.withColumns({
        "open5d": win.lagged("open", 4), "high5d": whole(F.max("high").over(w)), "low5d": whole(F.min("low").over(w)), "close5d": F.col("close"),
        "volume5d": whole(volume), "amount5d": whole(amount), "vwap5d": F.when(whole(amount) > 0, F.try_divide(amount, volume) * F.col("adj")).otherwise(F.col("close")),
    })
    return p.select("td", "tk", *(f"{c}5d" for c in (*_PRICES, "volume", "amount", "vwap")))


@feature(reach=19)
def activity(quote: DataFrame) -> DataFrame:
    """Amount over the mean amount of twenty positions."""
    return quote.select("td", "tk", F.try_divide("amount", win.rolling_mean("amount", 20, 10)).alias("v"))


def risk_factor(exposure: DataFrame) -> DataFrame:
    """Every exposure as a feature of its own."""
    return exposure


def r_skew(minute: DataFrame) -> DataFrame:
    return _intraday.moments(_intraday.prepared(minute)).select("td", "tk", F.col("r_skew").alias("v"))


def r_rsj(minute: DataFrame) -> DataFrame:
    """Squared gains less squared losses, over all squares."""
    r2 = F.col("ret") * F.col("ret")
    gain, loss = F.sum(F.when(F.col("ret") > 0, r2).otherwise(0.0)), F.sum(F.when(F.col("ret") < 0, r2).otherwise(0.0))
    return _intraday.prepared(minute).groupBy("td", "tk").agg(F.try_divide(gain - loss, F.sum(r2)).alias("v"))


def volume_shares(minute: DataFrame) -> DataFrame:
    """Shares of the day's volume at its edges."""
    return _intraday.shares(_intraday.prepared(minute), 6).select("td", "tk", "v_pct_open", "v_pct_close")
