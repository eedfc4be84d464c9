"""Fitted lifetime value (C-18, C-19, C-22).

Purchases follow the beta-geometric / negative-binomial model (r, alpha, a, b; Fader, Hardie and Lee 2005), spend the
gamma-gamma model (p, q, v). Both are fitted by maximum likelihood. Customers are reduced to cells of equal statistics with
counts, written once and packed; each step of the driver's optimiser is one Spark job that sums likelihood and gradient over the
cells for several points at once. Nothing but those sums comes to the driver. Gamma functions are worked out once for each count
of purchases in a batch of cells, the hypergeometric series of C-22 once for each count of purchases and age.
"""

from __future__ import annotations

import dataclasses
import math
import sys
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.functions import special
from marketlens.functions.special import digamma, log_gamma
from marketlens.plans.customers import clv_repeat_buyers, clv_rfm
from marketlens.session import cut_lineage, dealt, kept
from marketlens.sources.tables import Tables

# The likelihoods go to tasks by value: executors need no copy of the library.
for _module in (sys.modules[__name__], special):
    cloudpickle.register_pickle_by_value(_module)

#: Steps tried at once along a search direction.
STEPS = (1.0, 0.5, 0.2, 0.05, 0.01, 2.0)
ITERATIONS, TOLERANCE = 60, 1e-9
#: Logarithms of parameters stay within this.
WIDEST = 12.0
#: Weight of the squared logarithms of parameters; it keeps a parameter that the data don't tell from running off.
PENALTY = 1e-6
#: Terms of the hypergeometric series.
TERMS = 256
#: Cells of one task of a fit, whose many short jobs take a task for each part.
CELLS_A_TASK = 50_000
DAYS, MONTHS, RATE, MONTH_DAYS = 365, 12, 0.01, 30


# Likelihoods: values and gradients by the logarithm of each parameter, of every cell.
def purchase_likelihood(point: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cells are (repeat purchases x, last purchase tx, age T)."""
    r, alpha, a, b = np.exp(point)
    x, tx, age = cells.T
    c, at = np.unique(x, return_inverse=True)                 # counts are few, cells many
    again = x > 0
    later = np.maximum(x - 1.0, 0.0)                          # x - 1 where it counts
    log_age, log_tx = np.log(alpha + age), np.log(alpha + tx)
    alive = -(r + x) * log_age
    gone = np.where(again, np.log(a) - np.log(b + later) - (r + x) * log_tx, -np.inf)
    both = np.logaddexp(alive, gone)
    w = np.exp(gone - both)
    value = (log_gamma(r + c) - log_gamma(r) + r * np.log(alpha) + log_gamma(a + b) + log_gamma(b + c) - log_gamma(b)
             - log_gamma(a + b + c))[at] + both
    in_r = (digamma(r + c) - digamma(r) + np.log(alpha))[at] - (1 - w) * log_age - w * log_tx
    in_alpha = r / alpha - (r + x) * ((1 - w) / (alpha + age) + w / (alpha + tx))
    in_a = (digamma(a + b) - digamma(a + b + c))[at] + w / a
    in_b = (digamma(a + b) + digamma(b + c) - digamma(b) - digamma(a + b + c))[at] - w / (b + later)
    return value, np.stack([in_r * r, in_alpha * alpha, in_a * a, in_b * b], axis=1)


def spend_likelihood(point: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cells are (repeat purchases x, their mean value m)."""
    p, q, v = np.exp(point)
    x, m = cells.T
    c, at = np.unique(x, return_inverse=True)
    total, log_m = np.log(x * m + v), np.log(m)
    value = ((log_gamma(p * c + q) - log_gamma(p * c) - log_gamma(q) + q * np.log(v))[at] + (p * x - 1) * log_m + (p * c * np.log(c))[at]
             - (p * x + q) * total)
    in_p = x * ((digamma(p * c + q) - digamma(p * c))[at] + log_m + np.log(c)[at] - total)
    in_q = (digamma(p * c + q) - digamma(q) + np.log(v))[at] - total
    in_v = q / v - (p * x + q) / (x * m + v)
    return value, np.stack([in_p * p, in_q * q, in_v * v], axis=1)


def packed(cells: DataFrame, n_cells: int) -> DataFrame:
    """``cells`` as rows of many cells each, one binary column of doubles, written once: every step of a fit reads them. As few
    parts as the cells need, so that a step has no more tasks than that."""
    width = len(cells.columns)

    def pack(batches):
        for batch in batches:
            if len(batch):
                m = np.stack([np.asarray(c, np.float64) for c in batch.columns], axis=1)
                yield pa.RecordBatch.from_arrays([pa.array([width], pa.int32()), pa.array([m.tobytes()], pa.binary())], ["width", "cells"])

    parts = max(math.ceil(n_cells / CELLS_A_TASK), 1)
    return cut_lineage(cells.mapInArrow(pack, "width int, cells binary").coalesce(parts))


def summed(cells: DataFrame, likelihood: Callable, n: int) -> Callable[[list[np.ndarray]], tuple[np.ndarray, np.ndarray]]:
    """A function from points to (values, gradients), means over ``n`` customers; ``cells`` are packed, and the last number of
    each is their count."""

    def evaluate(points: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        def add(batches):
            for batch in batches:
                for width, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    m, out = np.frombuffer(data, np.float64).reshape(-1, width), np.zeros((len(points), len(points[0]) + 1))
                    for i, point in enumerate(points):
                        value, slope = likelihood(point, m[:, :-1])
                        out[i, 0] = m[:, -1] @ value
                        out[i, 1:] = m[:, -1] @ slope
                    i, k = np.indices(out.shape)
                    yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(k.ravel(), pa.int32()), pa.array(out.ravel())], ["i", "k", "v"])

        total = np.zeros((len(points), len(points[0]) + 1))
        for row in cells.mapInArrow(add, "i int, k int, v double").groupBy("i", "k").agg(F.sum("v").alias("v")).collect():
            total[row["i"], row["k"]] = row["v"] / n
        at = np.array(points)
        return total[:, 0] - PENALTY * (at ** 2).sum(axis=1), total[:, 1:] - 2 * PENALTY * at

    return evaluate


def maximise(evaluate: Callable, start: np.ndarray, iterations: int = ITERATIONS) -> tuple[np.ndarray, float, int]:
    """(point, value, iterations) of a quasi-Newton ascent (BFGS): one evaluation of all STEPS an iteration."""
    at = np.asarray(start, float)
    values, slopes = evaluate([at])
    value, slope, inverse = values[0], slopes[0], np.eye(len(at))
    for done in range(1, iterations + 1):
        way = inverse @ slope
        if way @ slope <= 0:
            inverse, way = np.eye(len(at)), slope
        way = way * min(1.0, 2.0 / max(np.abs(way).max(), 1e-300))       # a factor of e^2 in a step at most
        points = [np.clip(at + s * way, -WIDEST, WIDEST) for s in STEPS]
        values, slopes = evaluate(points)
        best = int(np.nanargmax(np.where(np.isfinite(values), values, -np.inf)))
        if not values[best] > value:
            if (inverse == np.eye(len(at))).all():
                return at, float(value), done
            inverse = np.eye(len(at))
            continue
        step, change, gained = points[best] - at, slope - slopes[best], values[best] - value
        at, value, slope = points[best], values[best], slopes[best]
        if (curve := step @ change) > 1e-12:
            turn = np.eye(len(at)) - np.outer(step, change) / curve
            inverse = turn @ inverse @ turn.T + np.outer(step, step) / curve
        if gained < TOLERANCE and np.abs(slope).max() < 1e-5:
            return at, float(value), done
    return at, float(value), iterations


@dataclasses.dataclass(frozen=True)
class Fit:
    """Parameters by name, mean log-likelihood (less the penalty), customers, iterations."""

    model: str
    values: dict[str, float]
    log_likelihood: float
    customers: int
    iterations: int


def fit_purchases(customers: DataFrame) -> Fit | None:
    """BG/NBD fit of rows with frequency, recency and T (days); None without customers. Days are scaled to their mean age."""
    cells = dealt(customers.groupBy("frequency", "recency", "T").agg(F.count(F.lit(1)).alias("n")), "frequency", "recency", "T")
    cells = cut_lineage(cells.select(*[F.col(c).cast("double").alias(c) for c in cells.columns]))
    s = cells.agg(F.count(F.lit(1)).alias("cells"), F.sum("n").alias("n"), (F.sum(F.col("T") * F.col("n")) / F.sum("n")).alias("age")).first()
    if not s["n"]:
        return None
    unit = s["age"] or 1.0
    scaled = cells.select("frequency", (F.col("recency") / unit).alias("tx"), (F.col("T") / unit).alias("age"), "n")
    point, value, done = maximise(summed(packed(scaled, s["cells"]), purchase_likelihood, s["n"]), np.zeros(4))
    r, alpha, a, b = np.exp(point).tolist()
    return Fit("purchases", {"r": r, "alpha": alpha * unit, "a": a, "b": b}, value, int(s["n"]), done)


def fit_spend(buyers: DataFrame) -> Fit | None:
    """Gamma-gamma fit of rows with positive frequency and monetary_value; values are scaled to their mean."""
    cells = dealt(buyers.groupBy("frequency", "monetary_value").agg(F.count(F.lit(1)).alias("n")), "frequency", "monetary_value")
    cells = cut_lineage(cells.select(*[F.col(c).cast("double").alias(c) for c in cells.columns]))
    s = cells.agg(F.count(F.lit(1)).alias("cells"), F.sum("n").alias("n"), (F.sum(F.col("monetary_value") * F.col("n")) / F.sum("n")).alias("mean")).first()
    if not s["n"]:
        return None
    scaled = cells.select("frequency", (F.col("monetary_value") / s["mean"]).alias("m"), "n")
    point, value, done = maximise(summed(packed(scaled, s["cells"]), spend_likelihood, s["n"]), np.log([2.0, 2.0, 1.0]))
    p, q, v = np.exp(point).tolist()
    return Fit("spend", {"p": p, "q": q, "v": v * s["mean"]}, value, int(s["n"]), done)


def clv_fit(t: Tables) -> DataFrame:                                                 # C-18
    """A row for each parameter of both models."""
    fits = [f for f in (fit_purchases(clv_rfm(t)), fit_spend(clv_repeat_buyers(t))) if f]
    return t.spark.createDataFrame([(f.model, k, v, f.log_likelihood, f.customers, f.iterations) for f in fits for k, v in f.values.items()],
                                   "model string, parameter string, value double, log_likelihood double, customers bigint, iterations int")


def hypergeometric(a: Column, b: Column, c: Column, z: Column, terms: int = TERMS) -> tuple[Column, Column]:
    """(2F1(a, b; c; z) for 0 <= z < 1, a bound of what the terms left out add). Each term is the one before times
    (a + j)(b + j) z / ((c + j)(j + 1)); that ratio moves steadily to z once j is beyond the parameters, so the rest is less
    than a geometric series of the larger of the two; the bound is null where that is 1 or more."""
    ratio = lambda j: (a + j) * (b + j) / ((c + j) * (j + 1)) * z

    def add(s: Column, j: Column) -> Column:
        term = s.term * ratio(j)
        return F.struct(term.alias("term"), (s.total + term).alias("total"))

    steps = F.transform(F.sequence(F.lit(0), F.lit(terms - 1)), lambda j: j.cast("double"))
    out = F.aggregate(steps, F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total")), add)
    worst = F.greatest(F.abs(ratio(F.lit(float(terms)))), z)
    return out.total, F.when(worst < 1.0, F.abs(out.term) * worst / (1.0 - worst))


def _above(fit: Fit) -> float:
    above = fit.values["a"] - 1.0
    return above if abs(above) > 1e-6 else 1e-6              # a = 1 is a removable gap


def death_free_share(fit: Fit, t: Column | float, x: Column, age: Column) -> tuple[Column, Column]:
    """(share, error bound): the part of an expectation over the next t days that the series is needed for; the last purchase has
    no place in it. By Euler's transformation the series has no x above the line, so a few terms do for loyal customers too."""
    r, alpha, b, above = F.lit(fit.values["r"]), F.lit(fit.values["alpha"]), F.lit(fit.values["b"]), F.lit(_above(fit))
    days = F.lit(float(t)) if isinstance(t, (int, float)) else t
    z = days / (alpha + age + days)
    series, left_out = hypergeometric(above + b - r, above, above + b + x, z)
    power = F.pow(F.lit(1.0) - z, above)
    return F.lit(1.0) - power * series, power * left_out


def alive_scale(fit: Fit, x: Column, tx: Column, age: Column) -> Column:
    """What a share is multiplied by for a customer with x repeat purchases, the last at tx, of that age."""
    r, alpha, b, above = F.lit(fit.values["r"]), F.lit(fit.values["alpha"]), F.lit(fit.values["b"]), F.lit(_above(fit))
    dead = F.when(x > 0, (above + F.lit(1.0)) / (b + x - 1.0) * F.pow((alpha + age) / (alpha + tx), r + x)).otherwise(F.lit(0.0))
    return (above + b + x) / above / (F.lit(1.0) + dead)


def expected_purchases(fit: Fit, t: Column | float, x: Column, tx: Column, age: Column) -> tuple[Column, Column]:
    """(expected purchases in the next t days, error bound) of a customer with x repeat purchases, the last at tx, of that age."""
    share, left_out = death_free_share(fit, t, x, age)
    scale = alive_scale(fit, x, tx, age)
    return scale * share, F.abs(scale) * left_out


_CELL = ("frequency", "recency", "T")


def _statistics() -> list[Column]:
    return [F.col(c).cast("double") for c in _CELL]


def clv_expected_purchases(t: Tables, days: float = DAYS, fit: Fit | None = None) -> DataFrame:   # C-19
    """Expected purchases of every customer, worked out once for each cell of equal statistics and joined back."""
    customers = clv_rfm(t)
    fit = fit or fit_purchases(customers)
    if fit is None:
        return customers.select("customer_unique_id", F.lit(0.0).alias("expected_purchases"), F.lit(0.0).alias("error_bound"))
    value, error = expected_purchases(fit, days, *_statistics())
    cells = customers.select(*_CELL).distinct().select(*_CELL, value.alias("expected_purchases"), error.alias("error_bound"))
    return customers.select("customer_unique_id", *_CELL).join(cells, list(_CELL)).select(
        "customer_unique_id", "expected_purchases", "error_bound")


def shares_by_month(fit: Fit, customers: DataFrame, months: int = MONTHS) -> DataFrame:
    """(frequency, T, _ends): the shares of expectations up to the end of each month, from 0 on. They don't depend on the last
    purchase, so the series is worked out once for each count of purchases and age in days, whatever the number of customers."""
    x, _, age = _statistics()
    until = lambda i: death_free_share(fit, i.cast("double") * MONTH_DAYS, x, age)[0]
    cells = dealt(customers.select("frequency", "T").distinct(), "frequency", "T")
    return cut_lineage(cells.select("frequency", "T", F.transform(F.sequence(F.lit(0), F.lit(months)), until).alias("_ends")))


def discounted_value(fit: Fit, spend: Fit, months: int = MONTHS, rate: float = RATE) -> Column:
    """The sum over the months of the purchases expected in each times the expected spend, discounted by month, of a row with the
    statistics and _ends."""
    p, q, v = (F.lit(spend.values[k]) for k in ("p", "q", "v"))
    x, m = F.col("frequency").cast("double"), F.col("monetary_value")
    each = p * (v + x * m) / (p * x + q - 1.0)
    scale = alive_scale(fit, *_statistics())

    def add(s: Column, i: Column) -> Column:
        return s + (F.get(F.col("_ends"), i) - F.get(F.col("_ends"), i - 1)) / F.pow(F.lit(1.0 + rate), i)

    return F.when(p * x + q > 1.0, each) * scale * F.aggregate(F.sequence(F.lit(1), F.lit(months)), F.lit(0.0), add)


def clv_estimate(t: Tables, months: int = MONTHS, rate: float = RATE, fit: Fit | None = None, spend: Fit | None = None) -> DataFrame:   # C-22
    """Discounted value of every repeat buyer over the next months."""
    customers = kept(clv_rfm(t))
    buyers = clv_repeat_buyers(t, customers)
    fit, spend = fit or fit_purchases(customers), spend or fit_spend(buyers)
    if fit is None or spend is None or months < 1:
        return buyers.select("customer_unique_id", F.lit(0.0).alias("clv"))
    ends = buyers.join(shares_by_month(fit, buyers, months), ["frequency", "T"], "left")
    return ends.select("customer_unique_id", discounted_value(fit, spend, months, rate).alias("clv"))


QUERIES = {
    "c18_clv_fit": clv_fit,
    "c19_clv_expected_purchases": clv_expected_purchases,
    "c22_clv_estimate": clv_estimate,
}
