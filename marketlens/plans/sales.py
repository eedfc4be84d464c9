"""Sales, customer and payment reports (Q-01 .. Q-22).

Each report takes the ``Tables`` accessor and returns a lazy DataFrame. The
cutoff ``until`` follows the reference's text comparison: the whole day of
``until`` is excluded (``ts < DATE until``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.functions import dates as X
from marketlens.functions.numeric import money_sum
from marketlens.sources import standins as V
from marketlens.sources.tables import Tables

DEFAULT_UNTIL = "2001-06-01"


def _items_with_category(t: Tables) -> DataFrame:
    """items x products x translation (translation is a fixed-size broadcast map)."""
    cat = V.category_translation(t)
    return (V.order_items(t).join(V.products(t).select("product_id", "product_category_name"), "product_id")
            .join(cat, "product_category_name")
            .withColumnRenamed("product_category_name_english", "product_category"))


def customers_by_zip(t: Tables, raw: bool = False) -> DataFrame:                     # Q-01
    """Customers per zip with one coordinate pair per zip (zips de-duplicated first,
    D-03); ``raw`` keeps the reference's fan-out over geolocation rows."""
    geo = V.geolocation(t)
    if not raw:
        geo = geo.groupBy("geolocation_zip_code_prefix").agg(
            F.min(F.struct("geolocation_lat", "geolocation_lng")).alias("_g")).select(
            "geolocation_zip_code_prefix", F.col("_g.geolocation_lat").alias("geolocation_lat"),
            F.col("_g.geolocation_lng").alias("geolocation_lng"))
    c = V.customers(t)
    j = c.join(geo, c.customer_zip_code_prefix == geo.geolocation_zip_code_prefix)
    return j.groupBy(F.col("customer_zip_code_prefix").alias("zip_code_prefix")).agg(
        F.count("customer_id").alias("customer_count"),
        F.min("geolocation_lat").alias("latitude"),
        F.min("geolocation_lng").alias("longitude"))


def top_cities(t: Tables, n: int = 10) -> DataFrame:                                 # Q-02
    c = V.customers(t).groupBy("customer_city").agg(F.count("customer_id").alias("customer_count"))
    return c.orderBy(F.desc("customer_count"), F.asc("customer_city")).limit(n)


def city_growth(t: Tables, top: int = 10, until: str = DEFAULT_UNTIL) -> DataFrame:  # Q-03
    c = V.customers(t)
    top_c = top_cities(t, top).select("customer_city")
    o = V.orders_basic(t).where(X.before("order_purchase_timestamp", until))
    j = c.join(o, "customer_id").join(F.broadcast(top_c), "customer_city")  # top-n: n rows
    return j.groupBy("customer_city", X.month_key("order_purchase_timestamp").alias("month_year")).agg(
        F.count("customer_id").alias("customer_count"))


def new_customers_by_month(t: Tables) -> DataFrame:                                  # Q-04
    """Customers by month of their first order (D-01: counts customer_id)."""
    first = V.orders_basic(t).groupBy("customer_id").agg(
        F.min("order_purchase_timestamp").alias("first_order_date"))
    return first.groupBy(X.month_key("first_order_date").alias("month_year")).agg(
        F.count("customer_id").alias("new_customers"))


def orders_per_day(t: Tables, until: str = DEFAULT_UNTIL) -> DataFrame:              # Q-05
    o = V.orders_basic(t).where(X.before("order_purchase_timestamp", until))
    return o.groupBy(X.day_of("order_purchase_timestamp").alias("day")).agg(
        F.count_distinct("order_id").alias("order_count"))


def orders_by_weekday_hour(t: Tables, ts_col: str = "ts") -> DataFrame:             # Q-06
    """7 x 24 table of counts, Sunday first. Purchase times come from ``events``
    (order dates are all midnight in the driver data)."""
    e = t.events.select(X.weekday_sun0(ts_col).alias("day_of_week_int"),
                        F.hour(ts_col).alias("hour"))
    cols = [F.count_if(F.col("hour") == h).cast("bigint").alias(f"hour_{h:02d}") for h in range(24)]
    g = e.groupBy("day_of_week_int").agg(*cols)
    names = F.element_at(F.array(*[F.lit(d) for d in X.WEEKDAY_ABBR_SUN_FIRST]),
                         (F.col("day_of_week_int") + 1).cast("int"))
    return g.select(names.alias("day_of_week_name"), "day_of_week_int", *[f"hour_{h:02d}" for h in range(24)])


def _month_labels(ts: str):
    return [X.month_abbr(ts).alias("month_name"), X.month_of(ts).alias("month_int"),
            X.year_of(ts).alias("year")]


def monthly_orders_revenue(t: Tables, until: str = DEFAULT_UNTIL) -> DataFrame:     # Q-07
    o = V.orders_basic(t).where(X.before("order_purchase_timestamp", until))
    j = o.join(V.payments(t), "order_id")
    ts = "order_purchase_timestamp"
    g = j.groupBy(X.year_of(ts).alias("year"), X.month_of(ts).alias("month_int")).agg(
        F.count("order_id").alias("order_count"), money_sum("payment_value").alias("total_revenue"))
    name = F.element_at(F.array(*[F.lit(m) for m in X.MONTH_ABBR]), F.col("month_int").cast("int"))
    return g.select(name.alias("month_name"), "month_int", "year", "order_count", "total_revenue",
                    F.concat_ws(" ", name, F.col("year").cast("string")).alias("month_year"))


def monthly_avg_freight(t: Tables) -> DataFrame:                                    # Q-08
    j = V.orders_basic(t).join(V.order_items(t), "order_id")
    return j.groupBy(X.month_key("order_purchase_timestamp").alias("month_year")).agg(
        F.avg("freight_value").alias("avg_freight_value"))


def _state_base(t: Tables) -> DataFrame:
    o = V.orders_basic(t).select("order_id", "customer_id")
    c = V.customers(t).select("customer_id", "customer_state")
    return o.join(c, "customer_id")


def _by_state(t: Tables, item_col: str, out: str, dedup: bool) -> DataFrame:
    """Mean of an item column and payment revenue per state.

    Default: the reference's items x payments join, where each payment is
    counted once per item of its order (D-04). ``dedup``: revenue summed once
    per order (orders that have items), the item mean over items alone; both
    aggregated per state before the final join, so no fan-out is shuffled.
    """
    items = V.order_items(t).select("order_id", item_col)
    pay = V.payments(t).select("order_id", "payment_value")
    base = _state_base(t)
    if not dedup:
        j = items.join(pay, "order_id").join(base, "order_id")
        return j.groupBy("customer_state").agg(F.avg(item_col).alias(out),
                                                money_sum("payment_value").alias("total_revenue"))
    mean = items.join(base, "order_id").groupBy("customer_state").agg(F.avg(item_col).alias(out))
    rev = (pay.join(items.select("order_id"), "order_id", "left_semi").join(base, "order_id")
           .groupBy("customer_state").agg(money_sum("payment_value").alias("total_revenue")))
    return mean.join(rev, "customer_state")


def price_revenue_by_state(t: Tables, dedup: bool = False) -> DataFrame:            # Q-09
    return _by_state(t, "price_after_discount", "avg_item_price", dedup)


def freight_revenue_by_state(t: Tables, dedup: bool = False) -> DataFrame:          # Q-10
    return _by_state(t, "freight_value", "avg_freight_value", dedup)


def payment_mix_by_month(t: Tables, until: str = DEFAULT_UNTIL) -> DataFrame:       # Q-11
    o = V.orders_basic(t).where(X.before("order_purchase_timestamp", until))
    j = V.payments(t).join(o, "order_id")
    return j.groupBy(X.month_key("order_purchase_timestamp").alias("month_year"), "payment_type").agg(
        F.count("payment_type").alias("payment_type_count"))


def payment_mix(t: Tables) -> DataFrame:                                            # Q-12
    j = V.payments(t).join(V.orders_basic(t).select("order_id"), "order_id")
    return j.groupBy("payment_type").agg(F.count("payment_type").alias("payment_type_count"))


def cancelled_by_month(t: Tables, until: str = DEFAULT_UNTIL) -> DataFrame:         # Q-13
    o = V.orders_basic(t).where((F.col("order_status") == "canceled")
                                & X.before("order_purchase_timestamp", until))
    ts = "order_purchase_timestamp"
    g = o.groupBy(X.year_of(ts).alias("year"), X.month_of(ts).alias("month_int")).agg(
        F.count("order_id").alias("cancelled_order_count"))
    name = F.element_at(F.array(*[F.lit(m) for m in X.MONTH_ABBR]), F.col("month_int").cast("int"))
    return g.select(name.alias("month_name"), "month_int", "year", "cancelled_order_count",
                    F.concat_ws(" ", name, F.col("year").cast("string")).alias("month_year"))


def customer_places(t: Tables) -> DataFrame:                                        # Q-14
    return V.customers(t).select("customer_unique_id", "customer_city", "customer_state")


def orders_payments(t: Tables) -> DataFrame:                                        # Q-15
    o = V.orders(t)
    return (o.join(V.payments(t), "order_id")
            .join(V.customers(t).select("customer_id", "customer_unique_id"), "customer_id"))


def top_categories_by_revenue(t: Tables, n: int = 5) -> DataFrame:                 # Q-16
    g = _items_with_category(t).groupBy("product_category").agg(
        money_sum("price_after_discount", 4).alias("revenue"))
    return g.orderBy(F.desc("revenue"), F.asc("product_category")).limit(n)


def top_categories_by_items(t: Tables, n: int = 5) -> DataFrame:                   # Q-17
    g = _items_with_category(t).groupBy("product_category").agg(F.count("order_id").alias("order_count"))
    return g.orderBy(F.desc("order_count"), F.asc("product_category")).limit(n)


DEFAULT_TREND_CATEGORIES = ("economy_goods", "promo_items", "small_items")


def category_revenue_trend(t: Tables, categories: Sequence[str] = DEFAULT_TREND_CATEGORIES,
                           until: str = DEFAULT_UNTIL) -> DataFrame:               # Q-18
    """Monthly revenue and item rows of chosen categories (D-05: item_count)."""
    o = V.orders_basic(t).where(X.before("order_purchase_timestamp", until))
    j = (_items_with_category(t).where(F.col("product_category").isin(*categories))
         .join(o.select("order_id", "order_purchase_timestamp"), "order_id"))
    ts = "order_purchase_timestamp"
    g = j.groupBy(X.year_of(ts).alias("year"), X.month_of(ts).alias("month_int"), "product_category").agg(
        money_sum("price_after_discount", 4).alias("revenue"), F.count("order_id").alias("item_count"))
    name = F.element_at(F.array(*[F.lit(m) for m in X.MONTH_ABBR]), F.col("month_int").cast("int"))
    return g.select("product_category", "revenue", name.alias("month_name"), "month_int", "year",
                    "item_count", F.concat_ws(" ", name, F.col("year").cast("string")).alias("month_year"))


def category_price_volume(t: Tables) -> DataFrame:                                 # Q-19
    return _items_with_category(t).groupBy("product_category").agg(
        F.count("order_id").alias("order_count"), F.avg("price_after_discount").alias("avg_price"))


def undelivered_by_category(t: Tables) -> DataFrame:                               # Q-20
    o = V.orders_basic(t).where(F.col("order_status") != "delivered").select("order_id", "order_status")
    j = _items_with_category(t).join(o, "order_id")
    return j.groupBy("product_category").agg(F.count("order_status").alias("undelivered_orders_count"))


def daily_revenue_customers(t: Tables) -> DataFrame:                               # Q-21
    o = V.orders(t).where(F.col("order_status") == "delivered")
    j = o.join(V.payments(t), "order_id")
    d = "order_delivered_customer_date"
    return j.groupBy(X.day_of(d).alias("delivered_date"), X.month_key(d).alias("month")).agg(
        F.count_distinct("customer_id").alias("daily_unique_customers"),
        money_sum("payment_value").alias("daily_total_revenue"))


def daily_sales(t: Tables) -> DataFrame:                                          # Q-22
    j = V.payments(t).join(V.orders_basic(t), "order_id")
    return j.groupBy(X.day_of("order_purchase_timestamp").alias("ymd")).agg(
        money_sum("payment_value").alias("purchase_value"))


QUERIES = {
    "q01_customers_by_zip": customers_by_zip,
    "q02_top_cities": top_cities,
    "q03_city_growth": city_growth,
    "q04_new_customers_by_month": new_customers_by_month,
    "q05_orders_per_day": orders_per_day,
    "q06_orders_by_weekday_hour": orders_by_weekday_hour,
    "q07_monthly_orders_revenue": monthly_orders_revenue,
    "q08_monthly_avg_freight": monthly_avg_freight,
    "q09_price_revenue_by_state": price_revenue_by_state,
    "q09b_price_revenue_by_state_dedup": lambda t: price_revenue_by_state(t, dedup=True),
    "q10_freight_revenue_by_state": freight_revenue_by_state,
    "q11_payment_mix_by_month": payment_mix_by_month,
    "q12_payment_mix": payment_mix,
    "q13_cancelled_by_month": cancelled_by_month,
    "q14_customer_places": customer_places,
    "q15_orders_payments": orders_payments,
    "q16_top_categories_by_revenue": top_categories_by_revenue,
    "q17_top_categories_by_items": top_categories_by_items,
    "q18_category_revenue_trend": category_revenue_trend,
    "q19_category_price_volume": category_price_volume,
    "q20_undelivered_by_category": undelivered_by_category,
    "q21_daily_revenue_customers": daily_revenue_customers,
    "q22_daily_sales": daily_sales,
}
