"""Churn, RFM segments and lifetime value (C-01 .. C-22).

Customers are keyed by ``customer_unique_id`` (the person) unless stated.
Global scalars (last order date, max delivery days) are one-row aggregates
joined back by broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.functions import dates as X
from marketlens.functions import numeric as N
from marketlens.functions.numeric import money_sum
from marketlens.sources import standins as V
from marketlens.sources.tables import Tables

# RFM tier thresholds and segment bounds of the dashboard job.
RECENCY_TIERS = ([155, 279, 431], [3, 2, 1, 0])
FREQUENCY_TIERS = ([1, 4, 11], [0, 1, 2, 3])
MONETARY_TIERS = ([199.49, 584.42, 1570.79], [0, 1, 2, 3])
SEGMENTS = ([2, 5], ["Low Value", "Mid Value", "High Value"])
# Bins of the churn dashboard.
DELIVERY_DAY_LABELS = ["0-5", "5-10", "10-15", "15-20", "20-25", "25+"]
DELAY_LABELS = ["Earlier than 1 day", "On time (Within 1 day of expected date)", "2-5 days late",
                "5-10 days late", "10-15 days late", "15+ days late"]
DISCOUNT_EDGES, DISCOUNT_LABELS = [0, 0.10, 0.20, 0.30], ["0-10%", "10-20%", "20-30%"]


# C-01 ---------------------------------------------------------------------
def label_churn(t: Tables, months: int = 6) -> DataFrame:
    """customers + churned: 1 when the person's last purchase is before
    (global last purchase date - months, SQLite month rule), 0 otherwise,
    null without any order."""
    c = V.customers(t)
    o = V.orders_basic(t)
    last = (o.join(c.select("customer_id", "customer_unique_id"), "customer_id")
            .groupBy("customer_unique_id").agg(F.max("order_purchase_timestamp").alias("_last")))
    cutoff = o.agg(X.add_months_overflow(F.max("order_purchase_timestamp"), -months).alias("_cut"))
    flag = (last.crossJoin(F.broadcast(cutoff))
            .select("customer_unique_id",
                    F.when(F.col("_last") < F.col("_cut").cast("timestamp_ntz"), 1).otherwise(0)
                    .cast("int").alias("churned")))
    return c.join(flag, "customer_unique_id", "left")


def _orders_churn(t: Tables) -> DataFrame:
    c = label_churn(t).select("customer_id", "customer_unique_id", "churned", "customer_state")
    return V.orders(t).join(c, "customer_id")


# C-02 ---------------------------------------------------------------------
def overall_churn(t: Tables) -> DataFrame:
    c = label_churn(t)
    g = c.groupBy("churned").agg(F.count_distinct("customer_unique_id").alias("customers"))
    tot = g.agg(F.sum("customers").alias("_t"))
    return g.crossJoin(F.broadcast(tot)).select(
        "churned", "customers", (F.col("customers") * F.lit(100.0) / F.col("_t")).alias("share"))


# C-03 ---------------------------------------------------------------------
def churn_by_order_count(t: Tables) -> DataFrame:
    per = _orders_churn(t).groupBy("customer_unique_id").agg(
        F.count("order_id").alias("order_count"), F.max("churned").alias("churned"))
    g = per.groupBy("order_count").agg(F.count(F.lit(1)).alias("customers"),
                                       (F.avg("churned") * F.lit(100.0)).alias("churn_rate"))
    r = g.agg(F.corr(F.col("order_count").cast("double"), "churn_rate").alias("pearson_r"))
    return g.crossJoin(F.broadcast(r))


# C-04 ---------------------------------------------------------------------
def churn_by_review_score(t: Tables) -> DataFrame:
    j = _orders_churn(t).join(V.reviews(t).select("order_id", "review_score"), "order_id")
    g = j.groupBy("review_score").agg(
        F.count_distinct(F.when(F.col("churned") == 0, F.col("customer_unique_id"))).alias("not_churned"),
        F.count_distinct(F.when(F.col("churned") == 1, F.col("customer_unique_id"))).alias("churned"))
    return g.withColumn("churn_rate", F.try_divide(F.col("churned") * F.lit(100.0),
                                                   F.col("churned") + F.col("not_churned")))


# C-05 ---------------------------------------------------------------------
def churn_by_discount_bin(t: Tables) -> DataFrame:
    j = _orders_churn(t).join(V.order_items(t).select("order_id", "discount_rate"), "order_id")
    b = N.cut(F.col("discount_rate"), DISCOUNT_EDGES, DISCOUNT_LABELS, right=False)
    return (j.withColumn("discount_rate_bin", b).where(F.col("discount_rate_bin").isNotNull())
            .groupBy("discount_rate_bin").agg((F.avg("churned") * F.lit(100.0)).alias("churned_percentage")))


# C-06 ---------------------------------------------------------------------
def churn_by_category(t: Tables) -> DataFrame:
    cat = V.category_translation(t)
    j = (_orders_churn(t).select("order_id", "churned")
         .join(V.order_items(t).select("order_id", "product_id"), "order_id")
         .join(V.products(t).select("product_id", "product_category_name"), "product_id")
         .join(cat, "product_category_name"))
    return j.groupBy(F.col("broad_category").alias("broader_category_english")).agg(
        (F.avg("churned") * F.lit(100.0)).alias("churn_rate"))


# C-07 ---------------------------------------------------------------------
def churn_by_state(t: Tables) -> DataFrame:
    c = label_churn(t)
    g = c.groupBy("customer_state").agg(
        F.count_distinct(F.when(F.col("churned") == 0, F.col("customer_unique_id"))).alias("not_churned"),
        F.count_distinct(F.when(F.col("churned") == 1, F.col("customer_unique_id"))).alias("churned"))
    return g.withColumn("churn_rate", F.try_divide(F.col("churned") * F.lit(100.0),
                                                   F.col("churned") + F.col("not_churned")))


# C-08 / C-09 ----------------------------------------------------------------
def _delivery_frame(t: Tables) -> DataFrame:
    o = _orders_churn(t)
    return o.select(
        "order_id", "churned",
        X.elapsed_days("order_purchase_timestamp", "order_delivered_customer_date").alias("delivery_days"),
        X.elapsed_days("order_estimated_delivery_date", "order_delivered_customer_date").alias("delivery_diff_days"))


def churn_by_delivery_days(t: Tables) -> DataFrame:
    d = _delivery_frame(t)
    mx = d.agg((F.max("delivery_days") + 1).alias("_top"))
    x = d.crossJoin(F.broadcast(mx))
    edges = [0, 5, 10, 15, 20, 25]
    expr = None
    for (a, b), lab in zip(zip(edges[:-1], edges[1:]), DELIVERY_DAY_LABELS[:-1]):
        cond = (F.col("delivery_days") > a) & (F.col("delivery_days") <= b)
        expr = F.when(cond, lab) if expr is None else expr.when(cond, lab)
    expr = expr.when((F.col("delivery_days") > 25) & (F.col("delivery_days") <= F.col("_top")),
                     DELIVERY_DAY_LABELS[-1])
    return (x.withColumn("delivery_days_range", expr).where(F.col("delivery_days_range").isNotNull())
            .groupBy("delivery_days_range").agg((F.avg("churned") * F.lit(100.0)).alias("churn_rate")))


def churn_by_delivery_delay(t: Tables) -> DataFrame:
    d = _delivery_frame(t)
    mm = d.agg((F.min("delivery_diff_days") - 1).alias("_lo"), (F.max("delivery_diff_days") + 1).alias("_hi"))
    x = d.crossJoin(F.broadcast(mm))
    v = F.col("delivery_diff_days")
    expr = (F.when((v > F.col("_lo")) & (v <= -1), DELAY_LABELS[0])
            .when((v > -1) & (v <= 1), DELAY_LABELS[1])
            .when((v > 1) & (v <= 5), DELAY_LABELS[2])
            .when((v > 5) & (v <= 10), DELAY_LABELS[3])
            .when((v > 10) & (v <= 15), DELAY_LABELS[4])
            .when((v > 15) & (v <= F.col("_hi")), DELAY_LABELS[5]))
    return (x.withColumn("delivery_diff_range", expr).where(F.col("delivery_diff_range").isNotNull())
            .groupBy("delivery_diff_range").agg((F.avg("churned") * F.lit(100.0)).alias("churn_rate")))


# C-10 ---------------------------------------------------------------------
def churn_dates(t: Tables, months: int = 6, key: str = "customer_id") -> DataFrame:
    """Customers per churn date = last purchase + months (SQLite month rule),
    keeping those with no order in (last, last + months]. The range anti-join
    has an equi part on the customer key (D-06 kept: it never matches)."""
    from marketlens.operators.joins import anti_join_range
    o = V.orders_basic(t)
    if key == "customer_unique_id":
        o = o.join(V.customers(t).select("customer_id", "customer_unique_id"), "customer_id")
    last = o.groupBy(key).agg(F.max("order_purchase_timestamp").alias("last_purchase_date"))
    last = last.withColumn("churn_date", X.add_months_overflow("last_purchase_date", months))
    kept = anti_join_range(last, o, [key], "last_purchase_date", "order_purchase_timestamp",
                           F.col("last_purchase_date"), F.col("churn_date").cast("timestamp_ntz"))
    return kept.groupBy("churn_date").agg(F.count(key).alias("churned_customers"))


# C-11 .. C-16 ---------------------------------------------------------------
def rfm(t: Tables) -> DataFrame:
    """Recency (floor days to max delivery + 1 day), Frequency (payment rows
    with a delivery date), Monetary (sum of payments) per person, after
    dropping rows with any null."""
    j = (V.orders(t).join(V.payments(t), "order_id")
         .join(V.customers(t).select("customer_id", "customer_unique_id"), "customer_id")).dropna()
    latest = j.agg((F.max("order_delivered_customer_date") + F.expr("INTERVAL 1 DAY")).alias("_latest"))
    g = j.groupBy("customer_unique_id").agg(
        F.max("order_delivered_customer_date").alias("_recent"),
        F.count("order_delivered_customer_date").alias("frequency"),
        money_sum("payment_value").alias("monetary_value"))
    return g.crossJoin(F.broadcast(latest)).select(
        "customer_unique_id", X.elapsed_days("_recent", "_latest").alias("recency"),
        "frequency", "monetary_value")


def rfm_tiers(t: Tables, recency=RECENCY_TIERS, frequency=FREQUENCY_TIERS,
              monetary=MONETARY_TIERS) -> DataFrame:
    r = rfm(t)
    r = r.withColumns({
        "recency_cluster": N.tier("recency", *recency).cast("bigint"),
        "freq_cluster": N.tier("frequency", *frequency).cast("bigint"),
        "money_cluster": N.tier("monetary_value", *monetary).cast("bigint")})
    return r.withColumn("customer_score", F.col("recency_cluster") + F.col("freq_cluster") + F.col("money_cluster"))


def customer_segment(t: Tables) -> DataFrame:
    r = rfm_tiers(t)
    return r.withColumn("customer_segment", N.tier("customer_score", *SEGMENTS))


def scale_rfm(t: Tables) -> DataFrame:
    r = rfm(t)
    cols = ["recency", "frequency", "monetary_value"]
    stats = r.agg(*[F.avg(c).alias(f"_m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"_s_{c}") for c in cols])
    x = r.crossJoin(F.broadcast(stats))
    return x.select("customer_unique_id", *[
        F.try_divide(F.col(c) - F.col(f"_m_{c}"), F.col(f"_s_{c}")).alias(f"{c}_scaled") for c in cols])


def kmeans_elbow(t: Tables, max_k: int = 10, features: Sequence[str] = ("recency", "frequency", "monetary_value"),
                 seed: int = 1) -> DataFrame:                                         # C-15
    """k-means cost for k = 1..max_k, one feature at a time (D-07). Equal values are one weighted row, so a fit's passes
    are over distinct values; k = 1 is the total squared deviation (MLlib needs k >= 2). A k whose random start ends
    worse than fewer clusters keeps their cost, which splitting one of them can't raise."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler
    from marketlens.session import cut_lineage
    r = cut_lineage(scale_rfm(t).select(*[f"{f}_scaled" for f in features]))
    rows = []
    for f in features:
        value = F.col(f"{f}_scaled").alias("value")
        cells = r.select(value).where("value IS NOT NULL").groupBy("value").agg(F.count(F.lit(1)).cast("double").alias("n"))
        data = cut_lineage(VectorAssembler(inputCols=["value"], outputCol="features").transform(cells))
        s = data.agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("value")).alias("s"), F.count(F.lit(1)).alias("cells")).first()
        if not s["cells"]:
            continue
        cost = data.agg(F.sum(F.col("n") * F.pow(F.col("value") - F.lit(s["s"] / s["n"]), 2)).alias("c")).first()["c"]
        rows.append((f, 1, float(cost)))
        for k in range(2, max_k + 1):
            if k >= s["cells"]:
                cost = 0.0                                    # a cluster for each value
            else:
                model = KMeans(k=k, seed=seed, featuresCol="features", weightCol="n", initSteps=3).fit(data)
                cost = min(cost, float(model.summary.trainingCost))
            rows.append((f, k, float(cost)))
    return t.spark.createDataFrame(rows, "feature string, k bigint, cost double")


def segment_summary(t: Tables) -> DataFrame:
    r = rfm_tiers(t)
    return r.groupBy("customer_score").agg(F.avg("recency").alias("avg_recency"),
                                           F.avg("frequency").alias("avg_frequency"),
                                           F.avg("monetary_value").alias("avg_monetary_value"))


# C-17 ---------------------------------------------------------------------
def clv_rfm(t: Tables) -> DataFrame:
    """Transaction summary per person with daily periods: frequency = repeat
    purchase days, recency = first to last purchase day, T = first purchase
    day to the last day of the data, monetary_value = mean value of the repeat
    days (0 without repeats)."""
    j = (V.orders_basic(t).join(V.payments(t), "order_id")
         .join(V.customers(t).select("customer_id", "customer_unique_id"), "customer_id"))
    days = j.groupBy("customer_unique_id", F.to_date("order_purchase_timestamp").alias("day")).agg(
        money_sum("payment_value").alias("value"))
    end = days.agg(F.max("day").alias("_end"))
    g = days.groupBy("customer_unique_id").agg(
        F.count(F.lit(1)).alias("_n"), F.min("day").alias("_first"), F.max("day").alias("_last"),
        money_sum("value").alias("_sum"), F.min_by("value", "day").alias("_first_value"))
    g = g.crossJoin(F.broadcast(end))
    freq = (F.col("_n") - 1).cast("bigint")
    return g.select(
        "customer_unique_id",
        freq.alias("frequency"),
        F.datediff("_last", "_first").cast("double").alias("recency"),
        F.datediff("_end", "_first").cast("double").alias("T"),
        F.when(freq > 0, (F.col("_sum") - F.col("_first_value")) / freq).otherwise(F.lit(0.0)).alias("monetary_value"))


# C-20 / C-21 ------------------------------------------------------------------
# Gamma-gamma spend model parameters (p, q, v) used when none are fitted.
GAMMA_GAMMA = {"p": 6.25, "q": 3.74, "v": 15.44}


def clv_repeat_buyers(t: Tables, customers: DataFrame | None = None) -> DataFrame:
    """Those of ``clv_rfm``, or of ``customers`` where that is at hand, with repeat purchases."""
    r = clv_rfm(t) if customers is None else customers
    return r.where((F.col("frequency") > 0) & (F.col("monetary_value") > 0))


def clv_expected_spend(t: Tables, params: dict | None = None) -> DataFrame:
    """Gamma-gamma conditional expected mean spend per repeat buyer:
    (p (v + x m)) / (p x + q - 1)."""
    p = params or GAMMA_GAMMA
    r = clv_repeat_buyers(t)
    x, m = F.col("frequency").cast("double"), F.col("monetary_value")
    return r.select("customer_unique_id", "frequency", "monetary_value",
                    (F.lit(p["p"]) * (F.lit(p["v"]) + x * m) / (F.lit(p["p"]) * x + F.lit(p["q"] - 1.0)))
                    .alias("expected_spend"))


QUERIES = {
    "c01_label_churn": label_churn,
    "c02_overall_churn": overall_churn,
    "c03_churn_by_order_count": churn_by_order_count,
    "c04_churn_by_review_score": churn_by_review_score,
    "c05_churn_by_discount_bin": churn_by_discount_bin,
    "c06_churn_by_category": churn_by_category,
    "c07_churn_by_state": churn_by_state,
    "c08_churn_by_delivery_days": churn_by_delivery_days,
    "c09_churn_by_delivery_delay": churn_by_delivery_delay,
    "c10_churn_dates": churn_dates,
    "c11_rfm": rfm,
    "c12_rfm_tiers": rfm_tiers,
    "c13_customer_segment": customer_segment,
    "c14_scale_rfm": scale_rfm,
    "c15_kmeans_elbow": kmeans_elbow,
    "c16_segment_summary": segment_summary,
    "c17_clv_rfm": clv_rfm,
    "c20_clv_repeat_buyers": clv_repeat_buyers,
    "c21_clv_expected_spend": clv_expected_spend,
}
