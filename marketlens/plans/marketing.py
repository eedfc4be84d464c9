"""Marketing and discounts (M-01 .. M-08).

Campaign rows are few, daily sales many: the sales are reduced to one row per
day before the interval join, and each campaign is exploded to its days so
the join is an equi-join on the day (J-09).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.functions.numeric import round_half_even

from marketlens.functions.numeric import money_sum
from marketlens.operators.aggregates import histogram
from marketlens.sources import standins as V
from marketlens.sources.tables import Tables

# Channel renames, ROI caps (percent) by (channel, type), daily budget.
CHANNEL_RENAMES = {"influencer": "affiliate", "media": "email"}
ROI_CAPS = {("affiliate", "Flash Sales"): 100, ("affiliate", "Seasonal Sales"): 130,
            ("affiliate", "Bundle Offers (BOGO)"): 40, ("affiliate", "Referral Programs"): 30}
DAILY_BUDGET = 20


def daily_sales(t: Tables) -> DataFrame:
    p = V.payments(t).join(V.orders_basic(t), "order_id")
    return p.groupBy(F.to_date("order_purchase_timestamp").alias("ymd")).agg(
        money_sum("payment_value").alias("purchase_value"))


def campaign_end_dates(t: Tables) -> DataFrame:                                     # M-05
    """end = start + duration days (duration given per campaign)."""
    m = V.marketing(t).withColumn("duration", F.datediff("end_date", "start_date").cast("bigint"))
    return m.select("id", "start_date", "duration",
                    F.date_add("start_date", F.col("duration").cast("int")).alias("end_date"))


def rename_channels(t: Tables) -> DataFrame:                                        # M-06
    m = V.marketing(t)
    mp = F.create_map(*[x for k, v in CHANNEL_RENAMES.items() for x in (F.lit(k), F.lit(v))])
    return m.withColumn("channel", F.coalesce(mp[F.col("channel")], F.col("channel")))


def campaign_sales(t: Tables) -> DataFrame:                                         # M-01
    """Total purchase value of the days inside each campaign, both ends in."""
    m = rename_channels(t).withColumn("duration", F.datediff("end_date", "start_date").cast("bigint"))
    d = daily_sales(t)
    days = m.select("id", F.explode(F.sequence("start_date", "end_date")).alias("ymd"))
    s = days.join(d, "ymd", "left").groupBy("id").agg(
        F.coalesce(F.sum("purchase_value"), F.lit(0.0)).alias("total_purchase_value"))
    return m.join(s, "id", "left")


def attribute_revenue(t: Tables) -> DataFrame:                                      # M-02
    c = campaign_sales(t)
    tot = c.agg(F.sum("campaign_revenue").alias("_tot"))
    c = c.crossJoin(F.broadcast(tot))
    w = F.col("campaign_revenue") / F.col("_tot")
    return c.withColumn("revenue_weight", w).withColumn(
        "new_campaign_revenue", round_half_even(w * F.col("total_purchase_value"), 2)).drop("_tot")


def estimate_budget(t: Tables) -> DataFrame:                                        # M-03
    c = attribute_revenue(t)
    ratio = F.try_divide(F.col("campaign_budget"), F.col("campaign_revenue"))
    zero = (F.col("campaign_revenue") == 0) | (F.col("new_campaign_revenue") == 0)
    return c.withColumn("budget_to_revenue_ratio", ratio).withColumn(
        "new_campaign_budget",
        round_half_even(F.when(zero, F.col("duration") * F.lit(float(DAILY_BUDGET)))
                 .otherwise(F.col("new_campaign_revenue") * ratio), 2))


def cap_roi(t: Tables, caps: dict = ROI_CAPS) -> DataFrame:                         # M-04
    """ROI% and the budget adjusted to the (channel, type) cap. D-08 kept: a
    capped pair under its cap gets budget = new revenue."""
    c = estimate_budget(t)
    cap_df = F.broadcast(t.spark.createDataFrame(
        [(ch, ty, float(v)) for (ch, ty), v in caps.items()], "channel string, campaign_type string, cap double"))
    c = c.join(cap_df, ["channel", "campaign_type"], "left")
    roi = F.try_divide((F.col("new_campaign_revenue") - F.col("new_campaign_budget")) * F.lit(100.0),
                       F.col("new_campaign_budget"))
    adj = (F.when(F.col("cap").isNull(), F.col("new_campaign_budget"))
           .when((F.col("current_roi") > F.col("cap")) & (F.col("new_campaign_revenue") != 0),
                 F.col("new_campaign_revenue") / (F.lit(1.0) + F.col("cap") / F.lit(100.0)))
           .otherwise(F.col("new_campaign_revenue")))
    return c.withColumn("current_roi", roi).withColumn("adjusted_budget", adj)


def discount_columns(t: Tables) -> DataFrame:                                       # M-07
    """discount_rate rounded to 2 (SQL ROUND), price before discount =
    ROUND(after / (1 - rate), 2); a rate of 1 gives null, not an error."""
    i = V.order_items(t)
    rate = F.round("discount_rate", 2)
    return i.select("order_id", "order_item_id", "product_id", "price_after_discount",
                    rate.alias("discount_rate"),
                    F.round(F.try_divide(F.col("price_after_discount"), F.lit(1.0) - rate), 2)
                    .alias("price_before_discount"))


def valid_discount_ranges(t: Tables, bins: int = 80) -> DataFrame:                  # M-08
    """Non-empty equal-width ranges of the observed discount rates."""
    h = histogram(V.order_items(t), "discount_rate", bins)
    return h.where(F.col("count") > 0)


def in_valid_ranges(df: DataFrame, col: str, ranges: DataFrame) -> DataFrame:
    """Rows of ``df`` whose value lies in one of the ranges (ranges: <= bins rows, broadcast)."""
    r = F.broadcast(ranges.select("lower", "upper"))
    return df.join(r, (F.col(col) >= F.col("lower")) & (F.col(col) <= F.col("upper")), "left_semi")


QUERIES = {
    "m01_campaign_sales": campaign_sales,
    "m02_attribute_revenue": attribute_revenue,
    "m03_estimate_budget": estimate_budget,
    "m04_cap_roi": cap_roi,
    "m07_discount_columns": discount_columns,
    "m08_valid_discount_ranges": valid_discount_ranges,
}
