"""Window specifications over a long panel: date td, entity tk, position ix of the date in the calendar.

Frames are RANGE frames over ix, so that "n rows ago" means n calendar positions ago even where an entity has no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def trailing(n: int, entity: str = "tk", index: str = "ix") -> WindowSpec:
    """The last n calendar positions, the current one included."""
    return Window.partitionBy(entity).orderBy(index).rangeBetween(-(n - 1), 0)


def at_lag(n: int, entity: str = "tk", index: str = "ix") -> WindowSpec:
    """Exactly n positions back (negative: ahead)."""
    return Window.partitionBy(entity).orderBy(index).rangeBetween(-n, -n)


def ever(entity: str = "tk", index: str = "ix") -> WindowSpec:
    return Window.partitionBy(entity).orderBy(index).rangeBetween(Window.unboundedPreceding, 0)


def lagged(value: Column | str, n: int, **roles) -> Column:
    """value n positions back; NULL where the entity has no row there."""
    return F.max(value).over(at_lag(n, **roles))


def guarded(aggregate: Column, value: Column | str, window: WindowSpec, min_periods: int) -> Column:
    """An aggregate over a window, NULL under min_periods values."""
    return F.when(F.count(value).over(window) >= min_periods, aggregate.over(window))


def rolling_mean(value: str, n: int, min_periods: int | None = None, **roles) -> Column:
    return guarded(F.avg(value), value, trailing(n, **roles), min_periods or n)


def rolling_std(value: str, n: int, min_periods: int | None = None, **roles) -> Column:
    return guarded(F.stddev_samp(value), value, trailing(n, **roles), min_periods or n)


def extreme_mean(value: str, n: int, k: int, largest: bool, min_periods: int, **roles) -> Column:
    """Mean of the k largest or smallest values of the window; NULLs never count."""
    w = trailing(n, **roles)
    ends = F.slice(F.sort_array(F.collect_list(value).over(w), asc=not largest), 1, k)
    return F.when(F.count(value).over(w) >= min_periods, F.aggregate(ends, F.lit(0.0), lambda s, x: s + x) / F.size(ends))


def ewm_mean(value: str, half_life: float, min_periods: int = 1, entity: str = "tk", index: str = "ix") -> Column:
    """Exponentially weighted mean over all rows so far, by position: weights double every half_life positions."""
    w = ever(entity, index)
    weight = F.when(F.col(value).isNotNull(), F.pow(F.lit(2.0), F.col(index) / F.lit(float(half_life))))
    return F.when(F.count(value).over(w) >= min_periods, F.sum(F.col(value) * weight).over(w) / F.sum(weight).over(w))


def pair_sums(y: str, x: str, n: int, **roles) -> Column:
    """Window sums of a regression of y on x as one column; each sum stands once in the plan.

    A row without a pair adds 0: each row of a frame is summed in less time where nothing can be NULL.
    """
    w, both = trailing(n, **roles), F.col(y).isNotNull() & F.col(x).isNotNull()
    s = lambda v: F.sum(F.coalesce(F.when(both, v.cast("double")), F.lit(0.0))).over(w)
    a, b = F.col(x), F.col(y)
    return F.struct(s(F.lit(1.0)).alias("n"), s(a).alias("x"), s(b).alias("y"), s(a * a).alias("xx"), s(b * b).alias("yy"), s(a * b).alias("xy"))


def slope_of(sums: str, min_periods: int) -> Column:
    """slope and se2 (its squared standard error) of pair_sums, NULL under min_periods pairs."""
    s = {k: F.col(sums)[k] for k in ("n", "x", "y", "xx", "yy", "xy")}
    # a frame without pairs has no sums
    s["n"] = F.when(s["n"] > 0, s["n"])
    sxx, sxy, syy = s["xx"] - s["x"] * s["x"] / s["n"], s["xy"] - s["x"] * s["y"] / s["n"], s["yy"] - s["y"] * s["y"] / s["n"]
    enough = (s["n"] >= min_periods) & (s["n"] > 2) & (sxx > 1e-12)
    return F.struct(F.when(enough, sxy / sxx).alias("slope"), F.when(enough, (syy - sxy * sxy / sxx) / (s["n"] - 2) / sxx).alias("se2"))


def rolling_regression(df: DataFrame, y: str, x: str, n: int, min_periods: int, slope: str, se2: str | None = None, **roles) -> DataFrame:
    """df with the slope and its squared standard error of y on x (with intercept) over the window.

    Every mention of a window sum in an expression is summed anew for each row; so the sums are a column of their own first.
    """
    df = df.withColumn("__sums", pair_sums(y, x, n, **roles)).withColumn("__fit", slope_of("__sums", min_periods))
    found = {slope: F.col("__fit")["slope"]} | ({se2: F.col("__fit")["se2"]} if se2 else {})
    return df.withColumns(found).drop("__sums", "__fit")


def rolling_residual_std(df: DataFrame, y: str, xs: list[str], n: int, min_periods: int, out: str, **roles) -> DataFrame:
    """df with the population deviation of y's residuals from a regression on several columns and a constant over the window.

    The window's cross products (constant, columns, y) are eliminated column by column: each stage takes one regressor out of
    all products that are left, and what remains of y * y is the sum of squared residuals. A regressor that the ones before
    explain takes nothing out. Column expressions only; NULL under min_periods complete rows.
    """
    terms = [None, *xs, y]
    k, w = len(terms) - 1, trailing(n, **roles)
    complete = F.col(y).isNotNull()
    for x in xs:
        complete = complete & F.col(x).isNotNull()
    value = lambda i: F.lit(1.0) if terms[i] is None else F.col(terms[i]).cast("double")
    name = lambda i, j: f"__s{min(i, j)}_{max(i, j)}"
    pairs = [(i, j) for i in range(k + 1) for j in range(i, k + 1)]
    df = df.withColumns({name(i, j): F.sum(F.when(complete, value(i) * value(j))).over(w) for i, j in pairs})
    df = df.withColumns({f"__o{i}": F.col(name(i, i)) for i in range(k)})
    for p in range(k):
        pivot = F.when(F.col(name(p, p)) > 1e-10 * F.col(f"__o{p}"), 1 / F.col(name(p, p))).otherwise(F.lit(0.0))
        df = df.withColumn("__pivot", pivot)
        df = df.withColumns({name(i, j): F.col(name(i, j)) - F.col(name(p, i)) * F.col(name(p, j)) * F.col("__pivot") for i, j in pairs if i > p})
    enough = F.col("__o0") >= max(min_periods, k + 1)
    std = F.sqrt(F.greatest(F.col(name(k, k)), F.lit(0.0)) / F.col("__o0"))
    return df.withColumn(out, F.when(enough, std)).drop("__pivot", *(name(i, j) for i, j in pairs), *(f"__o{i}" for i in range(k)))
