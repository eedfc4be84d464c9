"""Steps of the fitted lifetime value that had to grow no faster than their input: against a customer-by-customer evaluation."""

import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from marketlens.plans import lifetime
from marketlens.sources.tables import SCHEMAS, Tables

FIT = lifetime.Fit("purchases", {"r": 0.6, "alpha": 40.0, "a": 1.3, "b": 2.0}, 0.0, 1, 1)
SPEND = lifetime.Fit("spend", {"p": 3.0, "q": 4.0, "v": 20.0}, 0.0, 1, 1)


def tables(spark):
    """Customers who bought 2 to 4 times, the first time on one of two days, the last time on a day of their own."""
    orders, day = [], dt.datetime(1999, 1, 1)
    for c in range(60):
        for k in range(2 + c % 3):
            at = day + dt.timedelta(days=(c % 2) * 30 + (k * (40 + c) if k else 0))
            orders.append((c * 10 + k, c, "F", 10.0 + c + k, at, "1"))
    t = Tables(spark, "/nowhere")
    rows = {"orders": orders + [(9_000, 1, "F", 5.0, None, "1"), (9_001, None, "F", 5.0, day, "1")], "customer": [(c, "c", 1, 0.0, "x") for c in range(60)],
            "nation": [(1, "n", 1)], "region": [(1, "r")]}
    for name, of in rows.items():
        t._cache[name] = spark.createDataFrame(of, SCHEMAS[name])
    return t


def test_value_takes_the_series_once_for_each_count_and_age(spark):
    t = tables(spark)
    buyers = lifetime.clv_repeat_buyers(t)
    x, tx, age = lifetime._statistics()
    ends = [lifetime.expected_purchases(FIT, float(i * lifetime.MONTH_DAYS), x, tx, age)[0].alias(f"e{i}") for i in range(4)]
    want = {}
    for r in buyers.select("*", *ends).collect():
        each = 3.0 * (20.0 + r["frequency"] * r["monetary_value"]) / (3.0 * r["frequency"] + 3.0)
        want[r["customer_unique_id"]] = each * sum((r[f"e{i}"] - r[f"e{i - 1}"]) / 1.01 ** i for i in (1, 2, 3))
    value = lifetime.clv_estimate(t, months=3, fit=FIT, spend=SPEND)
    got = {r["customer_unique_id"]: r["clv"] for r in value.collect()}
    assert len(want) == 60 and set(got) == set(want) and all(abs(got[c] - want[c]) < 1e-9 * want[c] for c in want)
    assert value._jdf.queryExecution().optimizedPlan().toString().count("aggregate(") == 1      # the months; no series by customer
    pairs = buyers.select("frequency", "T").distinct().count()
    shares = lifetime.shares_by_month(FIT, buyers, 3)
    assert shares.count() == pairs < buyers.select("frequency", "recency", "T").distinct().count()


def test_steps_of_a_fit_read_packed_cells(spark):
    rng = np.random.default_rng(1)
    cells = [(float(x), float(tx), float(tx + age), 1.0) for x, tx, age in zip(rng.integers(0, 5, 500), rng.random(500), rng.random(500), strict=True)]
    df = spark.createDataFrame(cells, "frequency double, tx double, age double, n double").repartition(8)
    packed = lifetime.packed(df, 500)
    assert packed.rdd.getNumPartitions() == 1 and packed.count() < 9
    points = [np.array([0.1, -0.2, 0.3, 0.4]), np.zeros(4)]
    values, slopes = lifetime.summed(packed, lifetime.purchase_likelihood, 500)(points)
    m = np.array(cells)
    for i, point in enumerate(points):
        value, slope = lifetime.purchase_likelihood(point, m[:, :-1])
        assert np.isclose(values[i], value.mean() - lifetime.PENALTY * (point ** 2).sum())
        assert np.allclose(slopes[i], slope.mean(axis=0) - 2 * lifetime.PENALTY * point)
    none = lifetime.packed(df.where(F.col("n") < 0), 0)
    assert none.count() == 0 and lifetime.packed(df, 10 * lifetime.CELLS_A_TASK).rdd.getNumPartitions() == 8
