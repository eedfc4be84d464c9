"""Numeric expressions (X-09 .. X-13). All return Columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# X-09 ---------------------------------------------------------------------
def cut(x, edges: Sequence[float], labels: Sequence[str] | None = None,
        right: bool = True) -> Column:
    """pandas.cut with explicit edges: right-closed (a, b] by default, or [a, b)
    with ``right=False``. Outside every interval gives null."""
    c = _c(x)
    if labels is None:
        labels = [(f"({a}, {b}]" if right else f"[{a}, {b})") for a, b in zip(edges[:-1], edges[1:])]
    expr = None
    for (a, b), lab in zip(zip(edges[:-1], edges[1:]), labels):
        cond = (c > a) & (c <= b) if right else (c >= a) & (c < b)
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def tier(x, thresholds: Sequence[float], values: Sequence, descending: bool = False) -> Column:
    """X-10 nested if: the first threshold t_i with x <= t_i gives values[i];
    beyond all gives values[-1]. ``len(values) == len(thresholds) + 1``."""
    c = _c(x)
    expr = None
    for t, v in zip(thresholds, values):
        expr = F.when(c <= t, F.lit(v)) if expr is None else expr.when(c <= t, F.lit(v))
    return expr.otherwise(F.lit(values[-1]))


# X-11 ---------------------------------------------------------------------
EARTH_RADIUS_KM = 6371.0


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dphi = p2 - p1
    dl = F.radians(_c(lon2)) - F.radians(_c(lon1))
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dl / 2), 2)
    return F.lit(2 * EARTH_RADIUS_KM) * F.atan2(F.sqrt(a), F.sqrt(F.lit(1.0) - a))


# X-12 ---------------------------------------------------------------------
def round_half_even(x, digits: int = 0) -> Column:
    """pandas/numpy rounding sites: numpy scales the binary double, rounds half
    to even, and scales back (``rint(x * 10^d) / 10^d``); ``bround`` would
    round the decimal text instead and differ on near-ties."""
    scale = float(10 ** digits)
    return F.rint(_c(x) * F.lit(scale)) / F.lit(scale)


def round_half_away(x, digits: int = 0) -> Column:
    """SQL ROUND sites."""
    return F.round(_c(x), digits)


# X-13 ---------------------------------------------------------------------
def safe_div(a, b) -> Column:
    """Null instead of an error on a zero divisor (ANSI mode)."""
    return F.try_divide(_c(a), _c(b))


def div_or_zero(a, b) -> Column:
    """The reference's inf/NaN -> 0 rule."""
    return F.coalesce(F.try_divide(_c(a), _c(b)), F.lit(0.0))


def clamp_low(x, low: float = 0.0) -> Column:
    return F.greatest(_c(x), F.lit(low))


def min_max_scale(x, lo, hi, invert: bool = False) -> Column:
    s = F.try_divide(_c(x) - lo, hi - lo)
    return (F.lit(1.0) - s) if invert else s


def equal_width_bin(x, lo, hi, bins: int = 20) -> Column:
    """pd.cut(x, bins) label 0..bins-1 (right-closed, first edge widened);
    an all-equal group gets the middle label like pandas."""
    width = hi - lo
    raw = F.greatest(F.ceil(F.try_divide(_c(x) - lo, width) * F.lit(bins)) - 1, F.lit(0))
    return F.when(width == 0, F.lit((bins - 1) // 2)).otherwise(raw).cast("bigint")


def money_sum(x, scale: int = 2) -> Column:
    """Exact sum of money: each value as DECIMAL(20+scale, scale), summed, back to double.
    Sums of doubles differ in the last bits between partitionings; this does not."""
    return F.sum(_c(x).cast(f"decimal({18 + scale},{scale})")).cast("double")
