"""Fitted models and the operators under them, against brute force, hand-computed recursions and planted parameters."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlens.functions import special
from marketlens.operators import trees
from marketlens.operators.running import running_sums
from marketlens.plans import customers, forecasting, lifetime, price_models, sentiment
from marketlens.sources.tables import load_tables

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def t(spark):
    return load_tables(spark, SMALL)


# -- running sums and trees -----------------------------------------------------------------------------------------
def test_running_sums_over_ranges(spark):
    rng = random.Random(1)
    rows = [("hot", i, rng.randint(-5, 5)) for i in range(900)] + [(g, i, 1) for g in "abc" for i in range(rng.randint(1, 9))] + [(None, 1, 7), (None, 2, 3)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, at int, v int")
    out = running_sums(df, ["g"], ["at"], {"upto": "v"}, partitions=7)
    assert out.columns == ["g", "at", "v", "upto"]
    want, sums = {}, {}
    for g, at, v in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        sums[g] = sums.get(g, 0) + v
        want[g, at] = sums[g]
    got = out.collect()
    assert len(got) == len(rows) and {(r["g"], r["at"]): r["upto"] for r in got} == want
    assert running_sums(df.limit(0), ["g"], ["at"], {"upto": "v"}).count() == 0


def plain_split(rows, features):
    """(reduction, feature, threshold) of the best split; None if none has rows on both sides."""
    best = None
    for j, _ in enumerate(features):
        for threshold in sorted({r[j] for r in rows if r[j] is not None}):
            left = [r[-1] for r in rows if r[j] is not None and r[j] <= threshold]
            right = [r[-1] for r in rows if r[j] is None or r[j] > threshold]
            if left and right:
                n = len(rows)
                gain = Fraction(len(left) * len(right), n * n) * (sum(left) / len(left) - sum(right) / len(right)) ** 2
                if best is None or gain > best[0]:
                    best = (gain, j, threshold)
    return best


def plain_tree(rows, features, depth, min_rows, at=1, level=0):
    out = {at: (len(rows), float(sum(r[-1] for r in rows) / len(rows)), None, None)}
    best = plain_split(rows, features) if len(rows) >= min_rows and level <= depth else None
    if best and best[0] > 0:
        _, j, threshold = best
        out[at] = out[at][:2] + (features[j], threshold)
        left = [r for r in rows if r[j] is not None and r[j] <= threshold]
        out |= plain_tree(left, features, depth, min_rows, 2 * at, level + 1)
        out |= plain_tree([r for r in rows if r not in left], features, depth, min_rows, 2 * at + 1, level + 1)
    return out


@pytest.mark.parametrize(("depth", "min_rows"), [(0, 2), (3, 2), (4, 9)])
def test_variance_tree_equals_plain_recursion(spark, depth, min_rows):
    rng = random.Random(depth)
    rows = [(rng.choice([None, 0, 1, 2, 3]), rng.randint(0, 40), i, Fraction(rng.randint(0, 400), 4)) for i in range(120)]
    df = spark.createDataFrame([(a, float(b), i, float(y)) for a, b, i, y in rows] + [(1, 1.0, 5, None)], "a int, b double, c int, y double")
    features = ["a", "b", "c"]
    tree = trees.variance_tree(df, features, "y", depth, min_rows)
    want = plain_tree(rows, features, depth, min_rows)
    assert {i: (n.n, n.feature, n.threshold) for i, n in tree.items()} == {i: (w[0], w[2], w[3]) for i, w in want.items()}
    assert all(abs(tree[i].mean - want[i][1]) < 1e-9 for i in want)
    scored = df.where("y IS NOT NULL").withColumn("p", trees.predict_tree(tree)).agg(F.sum(F.pow(F.col("p") - F.col("y"), 2)).alias("e")).first()["e"]

    def place(r, at=1):
        _, mean, feature, threshold = want[at]
        if feature is None:
            return mean
        v = r[features.index(feature)]
        return place(r, 2 * at + (0 if v is not None and v <= threshold else 1))

    assert abs(scored - sum((place(r) - float(r[-1])) ** 2 for r in rows)) < 1e-6
    assert trees.tree_frame(spark, tree).count() == len(tree)


def test_tree_of_equal_rows_and_none(spark):
    same = spark.createDataFrame([(1.0, 5.0)] * 6, "a double, y double")
    assert {i: (n.n, n.mean, n.feature) for i, n in trees.variance_tree(same, ["a"], "y").items()} == {1: (6, 5.0, None)}
    assert trees.variance_tree(same.limit(0), ["a"], "y") == {}
    nothing = spark.createDataFrame([(None, 1.0), (float("nan"), 2.0)], "a double, y double")
    assert list(trees.variance_tree(nothing, ["a"], "y")) == [1]


# -- demand ---------------------------------------------------------------------------------------------------------
def test_forecast_recursion_by_hand(spark):
    start = spark.createDataFrame([(1, 10.0, 4.0), (2, 0.0, 1.0), (3, 7.0, 2.5)], "product_id bigint, prev_quantity double, level double")

    def stub(rows):                                        # half the month before, the level, and 3 in the first half of the year
        first = F.when(F.col("month_sin") > 0.1, 3.0).otherwise(0.0)
        return rows.withColumn("prediction", F.col("prev_quantity") / 2 + F.col("level") + first)

    got = forecasting.forecast_demand(start, stub, 2005).collect()
    assert len(got) == 36 and {r["order_year"] for r in got} == {2005}
    want = {}
    for product, last, level in [(1, 10.0, 4.0), (2, 0.0, 1.0), (3, 7.0, 2.5)]:
        for month in range(1, 13):
            last = float(np.rint(last / 2 + level + (3.0 if math.sin(2 * math.pi * month / 12) > 0.1 else 0.0)))
            want[product, month] = last
    assert {(r["product_id"], r["order_month"]): r["predicted_quantity"] for r in got} == want


def test_demand_model_is_read_again_alike(t, spark):
    frame = forecasting.training_frame(t)
    assert frame.where("level IS NULL OR prev_quantity IS NULL").count() == 0
    model, tried = forecasting.fit_demand(frame.where(~forecasting.held_out()), {"maxDepth": (1, 2), "maxIter": (2,)}, folds=forecasting.FOLDS)
    assert [s for s, _ in tried] == [{"maxDepth": 1, "maxIter": 2}, {"maxDepth": 2, "maxIter": 2}]
    again = forecasting.load_model(forecasting.save_model(model, spark))
    key = ["product_id", "order_year", "order_month"]
    a, b = (sorted(map(tuple, forecasting.predictor(m)(frame).select(*key, "prediction").collect())) for m in (model, again))
    assert a == b and len(a) == frame.count()
    y = np.array([r["total_quantity"] for r in frame.orderBy(*key).collect()])
    p = np.array([r[-1] for r in a])
    assert abs(forecasting.r_squared(forecasting.predictor(model)(frame)) - (1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())) < 1e-9
    assert forecasting.r_squared(forecasting.predictor(model)(frame.limit(0))) is None


def test_forecast_has_twelve_rows_a_product(t):
    got = forecasting.demand_forecast(t)
    products = forecasting.last_known(t).count()
    per = got.groupBy("product_id").agg(F.count("*").alias("n"), F.count_distinct("order_month").alias("m"), F.min("order_month").alias("lo"))
    assert per.count() == products and per.where("n <> 12 OR m <> 12 OR lo <> 1").count() == 0
    assert got.where("predicted_quantity IS NULL OR predicted_quantity <> rint(predicted_quantity)").count() == 0


# -- prices ---------------------------------------------------------------------------------------------------------
def test_errors_and_scenarios(spark):
    df = spark.createDataFrame([("a", 10.0, 8.0), ("a", -4.0, -5.0), ("b", None, 1.0), ("b", 2.0, None), ("a", 0.5, 0.5)], "g string, y double, p double")
    assert [tuple(r) for r in price_models.regression_errors(df, "y", "p").collect()] == [(3, 1.0, (0.2 + 0.25) / 3)]
    assert {r["g"]: r["n"] for r in price_models.regression_errors(df, "y", "p", "g").collect()} == {"a": 3}
    axes = {"own_demand": [1, 2], "own_avg_item_discount_rate": [0.5, 1.0, 1.0], "z": ["p", "q"]}
    grid = price_models.scenario_grid(spark, axes, 5)
    rows = [tuple(r) for r in grid.orderBy("scenario").collect()]
    assert rows == [(i * 6 + j * 2 + k, d, r, z) for i, d in enumerate(axes["own_demand"]) for j, r in enumerate(axes["own_avg_item_discount_rate"])
                    for k, z in enumerate(axes["z"])]
    best = price_models.best_scenario(grid, F.lit(3.0)).collect()
    assert [(r["scenario"], r["predicted_revenue"]) for r in best] == [(8, 6.0)]          # the first of four equal ones
    assert price_models.best_scenario(grid, F.lit(None).cast("double")).count() == 0
    drawn = price_models.sampled_scenarios(spark, axes, 500)
    a, b = (sorted(map(tuple, x.collect())) for x in (drawn, price_models.sampled_scenarios(spark, axes, 500).repartition(3)))
    assert a == b and {r[1] for r in a} == {1, 2} and 150 < sum(r[3] == "p" for r in a) < 350


def test_price_tree_report(t):
    got = {r["features"]: r for r in price_models.price_tree_report(t).collect()}
    assert set(got) == {"own", "own and market"} and all(r["n"] > 0 and r["mae"] > 0 and 1 <= r["depth"] <= 4 for r in got.values())
    rows = price_models.price_scenarios(t).collect()
    assert [r["scenario"] for r in sorted(rows, key=lambda r: r["scenario"])] == list(range(price_models.SAMPLE))
    assert all(r["predicted_price"] is not None for r in rows)
    assert price_models.max_revenue_by_tree(t).count() == 1


# -- lifetime value -------------------------------------------------------------------------------------------------
def test_gamma_functions():
    x = np.concatenate([np.linspace(1e-3, 30, 400), [1e3, 1e6]])
    assert np.allclose(special.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-13, atol=1e-13)
    h = 1e-5
    slope = [(math.lgamma(v * (1 + h)) - math.lgamma(v * (1 - h))) / (2 * h * v) for v in x[:-1]]
    assert np.allclose(special.digamma(x[:-1]), slope, rtol=1e-6, atol=1e-6)
    assert np.allclose(special.digamma(x + 1) - special.digamma(x), 1 / x, rtol=1e-9)


@pytest.mark.parametrize(("likelihood", "cells", "point"), [
    (lifetime.purchase_likelihood, [[0, 0, 3.0], [1, 1.5, 2.0], [7, 4.0, 4.0], [40, 2.0, 9.0]], [0.3, -0.5, 0.2, 0.9]),
    (lifetime.spend_likelihood, [[1, 2.0], [3, 0.4], [25, 1.1]], [1.0, 0.8, -0.3])])
def test_gradients(likelihood, cells, point):
    cells, point, h = np.array(cells, float), np.array(point), 1e-6
    value, slope = likelihood(point, cells)
    for i in range(len(point)):
        step = np.eye(len(point))[i] * h
        up, down = (likelihood(point + s, cells)[0] for s in (step, -step))
        assert np.allclose(slope[:, i], (up - down) / (2 * h), rtol=1e-5, atol=1e-6)


def simulated_customers(n, r, alpha, a, b, seed):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(n):
        rate, drop, age = rng.gamma(r, 1 / alpha), rng.beta(a, b), rng.uniform(100, 400)
        at, x, last = 0.0, 0, 0.0
        while True:
            at += rng.exponential(1 / rate)
            if at > age:
                break
            x, last = x + 1, at
            if rng.random() < drop:
                break
        out.append((x, last, age))
    return out


def test_planted_parameters_come_back(spark):
    truth = {"r": 0.8, "alpha": 30.0, "a": 0.9, "b": 2.5}
    rows = simulated_customers(6_000, **truth, seed=5)
    fit = lifetime.fit_purchases(spark.createDataFrame([(int(x), float(tx), float(age)) for x, tx, age in rows], "frequency int, recency double, T double"))
    assert fit.customers == 6_000 and fit.iterations < lifetime.ITERATIONS
    assert all(abs(math.log(fit.values[k] / v)) < 0.25 for k, v in truth.items()), fit.values
    rng, spend = np.random.default_rng(6), {"p": 6.0, "q": 4.0, "v": 15.0}
    buyers = []
    for _ in range(5_000):
        x, nu = int(rng.integers(1, 9)), rng.gamma(spend["q"], 1 / spend["v"])
        buyers.append((x, float(rng.gamma(spend["p"] * x, 1 / (nu * x)))))
    got = lifetime.fit_spend(spark.createDataFrame(buyers, "frequency int, monetary_value double"))
    assert all(abs(math.log(got.values[k] / v)) < 0.25 for k, v in spend.items()), got.values
    assert lifetime.fit_purchases(spark.createDataFrame([], "frequency int, recency double, T double")) is None
    assert lifetime.fit_spend(spark.createDataFrame([], "frequency int, monetary_value double")) is None


def plain_expectation(r, alpha, a, b, t, x, tx, age):
    """The published form, its series summed term by term with many more terms and no transformation."""
    z = t / (alpha + age + t)
    term = total = 1.0
    for j in range(200_000):
        term *= (r + x + j) * (b + x + j) / ((a + b + x - 1 + j) * (j + 1)) * z
        total += term
        if abs(term) < 1e-17 * abs(total):
            break
    top = (a + b + x - 1) / (a - 1) * (1 - ((alpha + age) / (alpha + age + t)) ** (r + x) * total)
    return top / (1 + (a / (b + x - 1) * ((alpha + age) / (alpha + tx)) ** (r + x) if x else 0))


def test_expected_purchases_equal_the_plain_series(spark):
    cases = [(0, 0.0, 30.0), (0, 0.0, 900.0), (1, 5.0, 400.0), (3, 390.0, 400.0), (12, 100.0, 800.0), (60, 799.0, 800.0)]
    df = spark.createDataFrame([(i, float(x), tx, age) for i, (x, tx, age) in enumerate(cases)], "i int, x double, tx double, age double")
    for values in ({"r": 0.24, "alpha": 31.0, "a": 0.79, "b": 2.43}, {"r": 2.5, "alpha": 200.0, "a": 1.8, "b": 0.6}):
        fit = lifetime.Fit("purchases", values, 0.0, 1, 1)
        for days in (30, 365):
            value, error = lifetime.expected_purchases(fit, days, F.col("x"), F.col("tx"), F.col("age"))
            for row in df.select("i", value.alias("v"), error.alias("e")).collect():
                want = plain_expectation(**values, t=days, x=cases[row["i"]][0], tx=cases[row["i"]][1], age=cases[row["i"]][2])
                assert abs(row["v"] - want) < 1e-8 * max(1, abs(want)) and row["e"] < 1e-8


def test_series_bound_holds(spark):
    def truth(a, b, c, z):
        term = total = Fraction(1)
        for j in range(1_500):
            term = Fraction(float(term * (a + j) * (b + j) / ((c + j) * (j + 1)) * z))
            total += term
        return float(total)

    for a, b, c, z in [(0.5, -0.2, 1.5, 0.5), (0.5, 0.3, 2.0, 0.98), (-1.2, 0.8, 3.0, 0.9)]:
        total, left = lifetime.hypergeometric(F.lit(a), F.lit(b), F.lit(c), F.lit(z), terms=40)
        row = spark.range(1).select(total.alias("v"), left.alias("e")).first()
        assert abs(row["v"] - truth(Fraction(a), Fraction(b), Fraction(c), Fraction(z))) <= row["e"] + 1e-12


def test_value_grows_with_months_and_falls_with_the_rate(t):
    fit = lifetime.fit_purchases(lifetime.clv_rfm(t))
    spend = lifetime.fit_spend(lifetime.clv_repeat_buyers(t))
    read = lambda **kw: {r["customer_unique_id"]: r["clv"] for r in lifetime.clv_estimate(t, fit=fit, spend=spend, **kw).collect()}
    six, twelve, dear = read(months=6), read(months=12), read(months=12, rate=0.1)
    assert len(six) == len(twelve) == lifetime.clv_repeat_buyers(t).count()
    assert all(0 <= six[c] <= twelve[c] and dear[c] <= twelve[c] for c in six) and sum(twelve.values()) > sum(six.values()) > 0
    bought = lifetime.clv_expected_purchases(t, fit=fit).collect()
    assert len(bought) == lifetime.clv_rfm(t).count() and all(0 <= r["expected_purchases"] < 365 and r["error_bound"] < 1e-6 for r in bought)


def test_elbow_falls(t):
    rows = customers.kmeans_elbow(t, max_k=5).collect()
    by = {}
    for r in rows:
        by.setdefault(r["feature"], []).append((r["k"], r["cost"]))
    assert set(by) == {"recency", "frequency", "monetary_value"}
    for costs in by.values():
        costs.sort()
        assert [k for k, _ in costs] == [1, 2, 3, 4, 5] and all(a >= b >= 0 for (_, a), (_, b) in zip(costs, costs[1:]))


# -- reviews --------------------------------------------------------------------------------------------------------
def test_stems(spark, monkeypatch):
    monkeypatch.setattr(sentiment, "PIECE", 3)
    rows = [(1, "en", ["cats", "running", "as", "nationalization", "cats", "x", "dogs"]), (2, "de", ["zeitungen", "cats"]), (3, "xx", ["cats"]),
            (4, None, ["cats"]), (5, "en", []), (6, "en", None), (7, "fr", ["nations"] * 10)]
    df = spark.createDataFrame(rows, "id int, lang string, toks array<string>")
    words = df.select("lang", F.explode("toks").alias("token"))
    book = sentiment.stem_dictionary(words)
    assert {(r["lang"], r["token"]): r["stem"] for r in book.collect()} == {
        ("en", "cats"): "cat", ("en", "running"): "runn", ("en", "nationalization"): "national", ("en", "dogs"): "dog",
        ("de", "zeitungen"): "zeit", ("de", "cats"): "cat", ("fr", "nations"): "nation"}
    got = {r["id"]: r["stems"] for r in sentiment.stem_tokens(df, book, "id").collect()}
    assert got == {1: ["cat", "runn", "as", "national", "cat", "x", "dog"], 2: ["zeit", "cat"], 3: ["cats"], 4: ["cats"], 5: [], 6: [], 7: ["nation"] * 10}


def test_area_under_curve(spark):
    rng = random.Random(3)
    for n in (2, 60):
        rows = [(float(rng.random() < 0.4), rng.randint(0, 12) / 4) for _ in range(n)]
        pos, neg = ([s for y, s in rows if y == v] for v in (1.0, 0.0))
        want = sum((p > q) + (p == q) / 2 for p in pos for q in neg) / (len(pos) * len(neg)) if pos and neg else None
        got = sentiment.area_under_curve(spark.createDataFrame(rows, "label double, s double"), "s").first()["auc"]
        assert got == want or abs(got - want) < 1e-12


def test_naive_bayes_equals_numpy(spark):
    rng = np.random.default_rng(2)
    words, n = ["a", "b", "c", "d"], 60
    x = rng.random((n, 4)) * (rng.random((n, 4)) < 0.6)
    x[:, 3] = 0                                             # a word that no review has
    y = (rng.random(n) < 0.4).astype(float)
    features = spark.createDataFrame([(i, w, float(x[i, j])) for i in range(n) for j, w in enumerate(words) if x[i, j]], "review_id int, term string, tfidf double")
    train = spark.createDataFrame([(i, float(y[i])) for i in range(40)], "review_id int, label double")
    fit = sentiment.fit_bayes(features, train, spark.createDataFrame([(w,) for w in words], "term string"))
    got = {r["review_id"]: r for r in sentiment.score_bayes(features, spark.range(n).select(F.col("id").cast("int").alias("review_id")), fit).collect()}
    own, of = x[:40], y[:40]
    odds = np.zeros(n)
    for label, side in ((1, 1), (0, -1)):
        m, v = own[of == label].mean(axis=0), own[of == label].var(axis=0) + sentiment.SMOOTHING * own.var(axis=0).max()
        odds += side * (np.log((of == label).mean()) - ((x - m) ** 2 / v / 2 + np.log(v) / 2).sum(axis=1))
    assert len(got) == n and all(abs(got[i]["log_odds"] - odds[i]) < 1e-7 and got[i]["prediction"] == (odds[i] > 0) for i in range(n))


def test_draws():
    drawn = sentiment.draw_settings(20)
    assert len(drawn) == 20 and len({tuple(s.items()) for s in drawn}) == 20 and drawn == sentiment.draw_settings(20)
    assert len(sentiment.draw_settings(1_000)) == 80


def test_both_classifiers_find_bad_reviews(spark):
    """Labels of quality can be learned from the texts: both classes are predicted, and the ranking is good."""
    big = load_tables(spark, "/root/testdata/sf0.01")
    for report in (sentiment.evaluate_bayes(big), sentiment.evaluate_classifier(big)):
        r = report.first()
        assert r["tp"] + r["fp"] > 0 and r["tn"] + r["fn"] > 0 and r["auc"] > 0.9, r
