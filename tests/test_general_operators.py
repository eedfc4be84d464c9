"""Generic operators: exactness against brute force and properties."""

import math
import random

import pytest

from pyspark.sql import functions as F

from marketlens.operators import aggregates as A
from marketlens.operators import frame as FR
from marketlens.operators import joins as J
from marketlens.operators import windows as W


def _ratio(a, b):
    import difflib  # noqa: F401
    # Levenshtein distance by dynamic programming
    m, n = len(a), len(b)
    d = list(range(n + 1))
    for i in range(1, m + 1):
        prev, d[0] = d[0], i
        for j in range(1, n + 1):
            cur = d[j]
            d[j] = min(d[j] + 1, d[j - 1] + 1, prev + (a[i - 1] != b[j - 1]))
            prev = cur
    mx = max(m, n)
    return 100 if mx == 0 else int((1 - d[n] / mx) * 100 + 0.5)


@pytest.mark.parametrize("min_score", [0, 20, 50, 67, 85, 100])
def test_fuzzy_pairs_at_every_threshold(spark, min_score):
    """Short, long and empty names over a small alphabet, in two blocks; all pairs scored by hand."""
    rng = random.Random(min_score)
    name = lambda: "".join(rng.choice("abé ") for _ in range(rng.choice([0, 1, 2, 4, 7, 7, 8, 130, 140])))
    q, c = ([(rng.choice("xy"), name()) for _ in range(70)] + [("x", None)] for _ in range(2))
    q += [(b, n[:-1] + "z") for b, n in c if n and len(n) > 3][:20]

    def score(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        m = max(len(a), len(b))
        return 100 if m == 0 else math.floor((1 - row[-1] / m) * 100 + 0.5)

    want = set()
    for b, x in {r for r in q if r[1] is not None}:
        best = sorted((-score(x, y), y) for y in {y for k, y in c if k == b and y is not None})
        want |= {(b, x, y, -s) for s, y in [p for p in best if -p[0] >= min_score][:3]}
    df = lambda rows, n: spark.createDataFrame(rows, f"block string, {n} string")
    got = J.fuzzy_top_k(df(q, "name"), "name", df(c, "other"), "other", k=3, min_score=min_score, block=["block"]).collect()
    assert {(r["block"], r["name"], r["candidate"], r["score"]) for r in got} == want and len(got) == len(want)


def test_fuzzy_top_k_matches_brute_force(spark):
    qs = ["brasil", "argentna", "chle", "peru", "x"]
    cs = ["brazil", "argentina", "chile", "peru", "paraguay", "uruguay", "bolivia"]
    q = spark.createDataFrame([(v,) for v in qs], "name string")
    c = spark.createDataFrame([(v,) for v in cs], "cand string")
    got = {(r["name"], r["candidate"], r["score"]) for r in J.fuzzy_top_k(q, "name", c, "cand", k=2).collect()}
    want = set()
    for a in qs:
        sc = sorted(((_ratio(a, b), b) for b in cs if _ratio(a, b) >= 50), key=lambda x: (-x[0], x[1]))[:2]
        want |= {(a, b, s) for s, b in sc}
    assert got == want


def test_add_row_index_is_dense_and_ordered(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("v")).repartition(7)
    out = FR.add_row_index(df, [F.col("v")]).orderBy("row_index").collect()
    assert [r["row_index"] for r in out] == list(range(1, 1001))
    assert [r["v"] for r in out] == list(range(1000))


def test_mode_ties_are_stable(spark):
    df = spark.createDataFrame([(1, 2.0), (1, 1.0), (1, 2.0), (1, 1.0), (2, 5.0)], "k int, v double")
    out = {r["k"]: r["v"] for r in A.mode_per_key(df, ["k"], ["v"]).collect()}
    assert out == {1: 1.0, 2: 5.0}


def test_interval_sum_both_ends_inclusive(spark):
    import datetime as dt
    ev = spark.createDataFrame([(dt.date(2020, 1, 1), 1.0), (dt.date(2020, 1, 3), 2.0), (dt.date(2020, 1, 5), 4.0)],
                               "d date, v double")
    rg = spark.createDataFrame([(1, dt.date(2020, 1, 1), dt.date(2020, 1, 3)), (2, dt.date(2020, 1, 6), dt.date(2020, 1, 7))],
                               "id int, s date, e date")
    out = {r["id"]: r["period_sales"] for r in J.interval_sum(ev, "d", "v", rg, "s", "e", "id").collect()}
    assert out == {1: 3.0, 2: 0.0}


def test_previous_month_total_uses_calendar(spark):
    import datetime as dt
    m = spark.createDataFrame([(1, dt.date(2020, 1, 1), 5.0), (1, dt.date(2020, 3, 1), 7.0)], "p int, m date, v double")
    out = {r["m"]: r["prev_month"] for r in W.previous_month_total(m, ["p"], "m", "v").collect()}
    assert out == {dt.date(2020, 1, 1): 0.0, dt.date(2020, 3, 1): 0.0}


def test_histogram_counts_all_rows(spark):
    df = spark.range(101).select((F.col("id") / 100.0).alias("x"))
    h = A.histogram(df, "x", 10).collect()
    assert sum(r["count"] for r in h) == 101 and len(h) == 10


def test_equal_width_bin_of_equal_values_is_the_middle_one(spark):
    from marketlens.functions.numeric import equal_width_bin
    row = spark.range(1).select(*[equal_width_bin(F.lit(3.0), F.lit(3.0), F.lit(3.0), b).alias(f"b{b}") for b in (4, 5, 20)]).first()
    assert tuple(row) == (1, 2, 9)


def test_fuzzy_threshold_counts_rounded_scores_and_has_no_length_cap(spark):
    q = spark.createDataFrame([("a" * 399,)], "name string")
    c = spark.createDataFrame([("a" * 199,), ("a" * 198,), ("b",)], "cand string")
    assert {len(r["candidate"]) for r in J.fuzzy_top_k(q, "name", c, "cand", k=9, min_score=50).collect()} == {
        n for n in (199, 198) if round(100 * n / 399) >= 50}
    assert J.fuzzy_top_k(q, "name", c, "cand", k=9, min_score=0).count() == 3
