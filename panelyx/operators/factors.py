"""The factor library: each factor is a chain of point-in-time operators, put on the calendar and, for value factors, divided by capital."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import pit


@dataclass(frozen=True)
class Recipe:
    item: str  # what the facts are of
    steps: str  # a name of pit.CHAINS
    per: str | None = None  # a second item: the chain runs on item's trailing year over per's four-quarter mean
    value: bool = False  # divided by the entity's capital of the day


#: Names and chains of the 24 factors.
LIBRARY: dict[str, Recipe] = {
    "bp": Recipe("equity", "last", value=True),
    "ep_ttm": Recipe("net_profit", "ttm", value=True),
    "ep_mrq": Recipe("net_profit", "mrq", value=True),
    "sp_ttm": Recipe("revenue", "ttm", value=True),
    "sp_mrq": Recipe("revenue", "mrq", value=True),
    "op_ttm": Recipe("operating_profit", "ttm", value=True),
    "op_mrq": Recipe("operating_profit", "mrq", value=True),
    "ocfp_ttm": Recipe("cash_received", "ttm", value=True),
    "ocfp_mrq": Recipe("cash_received", "mrq", value=True),
    "np_mrq_yoy": Recipe("net_profit", "mrq_yoy"),
    "np_ttm_yoy": Recipe("net_profit", "ttm_yoy"),
    "rev_mrq_yoy": Recipe("revenue", "mrq_yoy"),
    "rev_ttm_yoy": Recipe("revenue", "ttm_yoy"),
    "op_mrq_yoy": Recipe("operating_profit", "mrq_yoy"),
    "op_ttm_yoy": Recipe("operating_profit", "ttm_yoy"),
    "roe_mrq": Recipe("quarterly_roe", "last"),
    "roe_ttm": Recipe("net_profit", "last", per="equity"),
    "roe_mrq_yoy": Recipe("quarterly_roe", "yoy_diff"),
    "roe_ttm_yoy": Recipe("net_profit", "yoy_diff", per="equity"),
    "eps_mrq": Recipe("quarterly_eps", "last"),
    "eps_ttm": Recipe("net_profit", "last", per="shares"),
    "eps_mrq_yoy": Recipe("quarterly_eps", "yoy"),
    "eps_ttm_yoy": Recipe("net_profit", "yoy", per="shares"),
    "eps_ttm_qoq": Recipe("net_profit", "qoq", per="shares"),
}
pit.CHAINS.setdefault("qoq", [(pit.change, {"n": 1})])


def compute(name: str, items: Callable[[str], DataFrame], days: DataFrame, capital: DataFrame | None = None, *, pairs: Callable[[str, str], DataFrame] | None = None, **fill) -> DataFrame:
    """td, tk, v of a factor. items gives the facts of an item; capital has tk, cap and, if it changes, td.

    pairs, where given, has the facts of two items side by side (see pit.paired), so that nothing is joined.

    Shares are known by date: their facts (see at_announcement) are statements whose date of announcement has any, and profits count with these alone.
    """
    recipe = LIBRARY[name]
    if recipe.per and pairs:
        facts = pit.trailing_over_mean(pairs(recipe.item, recipe.per))
    elif recipe.per:
        facts, per = items(recipe.item), items(recipe.per)
        if recipe.per == "shares":
            facts = facts.join(per.select("tk", "rid"), ["tk", "rid"], "left_semi")
        facts = pit.combine(pit.trailing_year(facts), pit.window_stat(per, "mean", 4))
    else:
        facts = items(recipe.item)
    panel = pit.fill_to_dates(pit.chain(facts, recipe.steps), days, **fill)
    if not recipe.value:
        return panel
    return panel.join(capital, [c for c in ("td", "tk") if c in capital.columns]).select("td", "tk", F.try_divide("v", "cap").alias("v"))


def at_announcement(facts: DataFrame, daily: DataFrame, value: str) -> DataFrame:
    """facts with the value of a daily table (tk, td, value) on their date of announcement; those without one go."""
    found = daily.select("tk", F.to_date("td").alias("ann"), F.col(value).cast("double").alias("v")).filter("v is not null")
    return facts.drop("v").join(found, ["tk", "ann"]).select("tk", "ann", "q", "v", "rid")
