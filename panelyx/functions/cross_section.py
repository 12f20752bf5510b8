"""Per-date (cross-sectional) transformations of one column of a long panel; all are window expressions over the date."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAD_SCALE = 1.483


def correlation(x: str, y: str) -> Column:
    """Pearson correlation of the pairs without NULLs; NULL (not an error) where either side is constant."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    a, b = F.when(both, F.col(x)), F.when(both, F.col(y))
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def _by(*date: str):
    return Window.partitionBy(*date)


def winsorize_mad(df: DataFrame, col: str, out: str | None = None, *, bounds: float = 3.0, by: tuple[str, ...] = ("td",)) -> DataFrame:
    """Clip to median +- bounds * 1.483 * MAD of the date. Dates whose MAD is zero use the MAD of their non-zero values."""
    w = _by(*by)
    df = df.withColumn("__med", F.median(col).over(w)).withColumn("__dev", F.abs(F.col(col) - F.col("__med")))
    df = df.withColumn("__mad", F.median("__dev").over(w)).withColumn("__nz", F.median(F.when(F.col(col) != 0, F.col("__dev"))).over(w))
    reach = bounds * MAD_SCALE * F.when(F.col("__mad") > 0, F.col("__mad")).otherwise(F.coalesce("__nz", F.lit(0.0)))
    clipped = F.when(F.col(col).isNotNull(), F.least(F.greatest(F.col(col), F.col("__med") - reach), F.col("__med") + reach))
    return df.withColumn(out or col, clipped).drop("__med", "__dev", "__mad", "__nz")


def zscore(col: str, *, by: tuple[str, ...] = ("td",)) -> Column:
    w = _by(*by)
    return (F.col(col) - F.avg(col).over(w)) / (F.stddev_samp(col).over(w) + 1e-8)


def weighted_zscore(col: str, weight: str, *, by: tuple[str, ...] = ("td",)) -> Column:
    """Weighted mean, unweighted sample deviation."""
    w = _by(*by)
    held = F.when(F.col(col).isNotNull(), F.col(weight))
    return (F.col(col) - F.sum(F.col(col) * held).over(w) / F.sum(held).over(w)) / (F.stddev_samp(col).over(w) + 1e-8)


def compress_tails(col: str, *, limit: float = 3.0, by: tuple[str, ...] = ("td",)) -> Column:
    """Values beyond +-limit are squeezed into half a unit beyond it, in proportion to the date's extreme."""
    w = _by(*by)
    top, low = F.max(col).over(w), F.min(col).over(w)
    up = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.lit(0.5) / (top - limit)))
    down = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.lit(0.5) / (-low - limit)))
    x = F.col(col)
    return F.when(x > limit, limit * (1 - up) + x * up).when(x < -limit, -limit * (1 - down) + x * down).otherwise(x)


def percentile_bucket(df: DataFrame, col: str, out: str, cuts: list[float], *, by: tuple[str, ...] = ("td",)) -> DataFrame:
    """Bucket i (from 1) holds values in (p[i-1], p[i]] of the date's linearly interpolated percentiles; the minimum is in 1."""
    df = df.withColumn("__p", F.percentile(col, F.array(*(F.lit(float(c)) for c in cuts))).over(_by(*by)))
    bucket = F.lit(len(cuts) - 1)
    for i in range(len(cuts) - 2, 0, -1):
        bucket = F.when(F.col(col) <= F.element_at("__p", i + 1), F.lit(i)).otherwise(bucket)
    return df.withColumn(out, F.when(F.col(col).isNotNull(), bucket)).drop("__p")


def weighted_residual(y: str, x: str, weight: str, *, intercept: bool = True, by: tuple[str, ...] = ("td",)) -> Column:
    """Residual of the date's weighted regression of y on one x, in closed form."""
    w = _by(*by)
    held = F.when(F.col(y).isNotNull() & F.col(x).isNotNull(), F.col(weight))
    s = lambda v: F.sum(held * v).over(w)
    sw, sx, sy, sxx, sxy = s(F.lit(1.0)), s(F.col(x)), s(F.col(y)), s(F.col(x) * F.col(x)), s(F.col(x) * F.col(y))
    if not intercept:
        return F.col(y) - F.col(x) * F.try_divide(sxy, sxx)
    slope = F.try_divide(sw * sxy - sx * sy, sw * sxx - sx * sx)
    return F.col(y) - (sy - slope * sx) / sw - slope * F.col(x)


def orthogonalize(df: DataFrame, y: str, xs: list[str], weight: str, out: str, *, date: str = "td") -> DataFrame:
    """Residual of y on several regressors, weighted, without intercept; NULL where rows - regressors <= 2.

    The normal equations are sums over the date, so a date never has to fit into one task: only its k x k system does.
    """
    k = len(xs)
    held = F.when(F.array_position(F.transform(F.array(y, weight, *xs), lambda v: v.isNull()), True) == 0, F.col(weight))
    terms = [F.sum(held * F.col(a) * F.col(b)).alias(f"a{i}_{j}") for i, a in enumerate(xs) for j, b in enumerate(xs)] + [F.sum(held * F.col(a) * F.col(y)).alias(f"b{i}") for i, a in enumerate(xs)]
    sums = df.groupBy(date).agg(F.count(held).alias("n"), *terms)

    def solved(batches):
        for pdf in batches:
            betas = []
            for r in pdf.to_dict("records"):
                a = np.array([[r[f"a{i}_{j}"] for j in range(k)] for i in range(k)], float)
                b = np.array([r[f"b{i}"] for i in range(k)], float)
                betas.append(np.linalg.lstsq(a, b, rcond=None)[0].tolist() if r["n"] - k > 2 and np.isfinite(a).all() else None)
            yield pd.DataFrame({date: pdf[date], "__beta": betas})

    kind = dict(df.dtypes)[date]
    betas = sums.mapInPandas(solved, f"{date} {kind}, __beta array<double>")
    fitted = sum(F.col(x) * F.element_at("__beta", i + 1) for i, x in enumerate(xs))
    return df.join(betas, date, "left").withColumn(out, F.col(y) - fitted).drop("__beta")


def orthogonalize_on(df: DataFrame, dates: DataFrame, y: str, xs: list[str], weight: str, out: str, *, date: str = "td") -> DataFrame:
    """orthogonalize on some dates alone, such as month ends (a small table); on all others the result is NULL."""
    marked = df.join(F.broadcast(dates.select(date).distinct().withColumn("__on", F.lit(True))), date, "left")
    kept = F.when(F.col("__on"), F.col(weight))
    out_of = orthogonalize(marked.withColumn("__kept", kept), y, xs, "__kept", out, date=date)
    return out_of.withColumn(out, F.when(F.col("__on"), F.col(out))).drop("__on", "__kept")


#: Pairs drawn to place the next pivots.
_DRAWN = 4096


def _kernel(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (x - y) / (x + y)


def _places(x: np.ndarray, y: np.ndarray, pivot: float, or_equal: bool) -> np.ndarray:
    """For each x, how many of the falling y give a kernel below the pivot (or equal to it).

    The kernel is below the pivot where y is above x (1 - pivot) / (1 + pivot): one sorted search finds the place. Rows where
    rounding puts it beside the place that the kernel itself has are halved.
    """
    n, every = len(y), np.arange(len(x))
    with np.errstate(divide="ignore", invalid="ignore"):
        a = n - np.searchsorted(y[::-1], x * ((1 - pivot) / (1 + pivot)), "left" if or_equal else "right")
    below = lambda h: h <= pivot if or_equal else h < pivot
    wrong = (a > 0) & ~below(_kernel(x, y[np.maximum(a - 1, 0)])) | (a < n) & below(_kernel(x, y[np.minimum(a, n - 1)]))
    if wrong.any():
        rows = every[wrong]
        low, high = np.zeros(len(rows), np.int64), np.full(len(rows), n, np.int64)
        while (open_ := low < high).any():
            mid = (low + high) // 2
            under = below(_kernel(x[rows], y[np.minimum(mid, n - 1)]))
            low, high = np.where(open_ & under, mid + 1, low), np.where(open_ & ~under, mid, high)
        a[rows] = low
    return a


def _select(x: np.ndarray, y: np.ndarray, k: int) -> float:
    """The k-th smallest (from 0) of (x - y) / (x + y) over all pairs of positive x and y, in memory of the order of both.

    Rows of x, columns of y falling: values rise along each row, so that a row's part below a pivot ends at one place. Pairs
    drawn from what is left give a pivot on each side of the rank, between which a few hundredths of it lie; a rank outside
    them still makes less of it. What stays is taken as it is.
    """
    y = np.sort(y)[::-1]
    n, draw = len(y), np.random.default_rng(0)
    low, high = np.zeros(len(x), np.int64), np.full(len(x), n, np.int64)
    while (left := int((high - low).sum())) > 4 * (len(x) + n):
        ends = np.cumsum(high - low)
        at = np.sort(draw.integers(0, left, _DRAWN))
        rows = np.searchsorted(ends, at, "right")
        drawn = np.sort(_kernel(x[rows], y[high[rows] - ends[rows] + at]))
        share = (k - int(low.sum())) / left
        reach = 3 * (_DRAWN * share * (1 - share)) ** 0.5 + 1
        for pivot in (drawn[int(max(share * _DRAWN - reach, 0))], drawn[int(min(share * _DRAWN + reach, _DRAWN - 1))]):
            under = _places(x, y, pivot, False)
            if k < under.sum():
                high = np.minimum(high, under)
                continue
            up_to = _places(x, y, pivot, True)
            if k < up_to.sum():
                return float(pivot)
            low = np.maximum(low, up_to)
    counts = np.maximum(high - low, 0)
    rows = np.repeat(np.arange(len(x)), counts)
    cols = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(low, counts)
    rest = _kernel(x[rows], y[cols])
    at = k - int(low.sum())
    return float(np.partition(rest, at)[at])


def _next(x: np.ndarray, y: np.ndarray, k: int, before: float) -> float:
    """_select of k, where ``before`` is that of k - 1."""
    y = np.sort(y)[::-1]
    up_to = _places(x, y, before, True)
    if k < up_to.sum():
        return before
    more = up_to < len(y)
    return float(_kernel(x[more], y[up_to[more]]).min())


def medcouple(values: np.ndarray) -> float:
    """Robust skewness: the median of h(a, b) = (a + b - 2 m) / (a - b) over values a >= median m >= b.

    Among the p values equal to the median the kernel is -1, 0 or 1 by their order: p zeros, and as many of 1 as of -1. With x = a - m
    and y = m - b the kernel is (x - y) / (x + y), of which only the middle is looked for; no matrix of pairs is built.
    """
    v = np.sort(np.asarray(values, float))
    if not len(v):
        return float("nan")
    m = float((v[(len(v) - 1) // 2] + v[len(v) // 2]) / 2)
    x, y, p = v[v > m] - m, (m - v[v < m])[::-1], int((v == m).sum())
    ties = p * (p - 1) // 2
    low, inner, high = p * len(y) + ties, len(x) * len(y), p * len(x) + ties
    negative, upto_zero = int((len(y) - np.searchsorted(y, x, "right")).sum()), int((len(y) - np.searchsorted(y, x, "left")).sum())

    def place(k: int) -> float | int:
        """The kernel's value at a rank, or (as an int) the rank among the pairs of x and y."""
        if k < low:
            return -1.0
        k -= low
        if k < negative:
            return k
        if k < upto_zero + p:
            return 0.0
        return k - p if k - p < inner else 1.0

    total = low + inner + high + p
    first, second = place((total - 1) // 2), place(total // 2)
    a = _select(x, y, first) if isinstance(first, int) else first
    if not isinstance(second, int):
        b = second
    elif not isinstance(first, int):
        b = _select(x, y, second)
    else:
        b = a if second == first else _next(x, y, second, a)
    return (a + b) / 2


def box_limits(values: np.ndarray) -> list[float] | None:
    """Lower and upper end of the skewness-adjusted box; None for ten values or fewer."""
    v = np.sort(values[~np.isnan(values)])
    if len(v) <= 10:
        return None
    q1, q3 = np.quantile(v, [0.25, 0.75])
    mc = medcouple(v)
    down, up = (-3.5, 4.0) if mc >= 0 else (-4.0, 3.5)
    return [float(q1 - 1.5 * np.exp(down * mc) * (q3 - q1)), float(q3 + 1.5 * np.exp(up * mc) * (q3 - q1))]


def winsorize_boxes(df: DataFrame, cols: list[str], *, by: tuple[str, ...] = ("td",)) -> DataFrame:
    """Every column clipped to its skewness-adjusted box: q1 - 1.5 e^(kl mc) iqr to q3 + 1.5 e^(ku mc) iqr; dates of ten values or fewer stay.

    One window over the date serves all columns, and df is not joined with itself.
    """

    # an Arrow scalar, repeated as such: a list of Python would be converted once for each row
    @F.arrow_udf("array<double>")
    def limits(x: pa.Array) -> pa.Scalar:
        return pa.scalar(box_limits(x.to_numpy(zero_copy_only=False).astype(float)), pa.list_(pa.float64()))

    df = df.withColumns({f"__box_{c}": limits(F.col(c).cast("double")).over(_by(*by)) for c in cols})
    ends = lambda c: (F.element_at(f"__box_{c}", 1), F.element_at(f"__box_{c}", 2))
    clipped = lambda c: F.when(F.col(f"__box_{c}").isNull() | F.col(c).isNull(), F.col(c)).otherwise(F.least(F.greatest(F.col(c), ends(c)[0]), ends(c)[1]))
    return df.withColumns({c: clipped(c) for c in cols}).drop(*(f"__box_{c}" for c in cols))


def winsorize_box(df: DataFrame, col: str, out: str, *, by: tuple[str, ...] = ("td",)) -> DataFrame:
    return winsorize_boxes(df.withColumn(out, F.col(col)), [out], by=by)
