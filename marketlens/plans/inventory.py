"""Demand and inventory (I-01 .. I-13).

Demand is aggregated per product-month; EOQ and reorder points are Column
expressions. Windows run over a product's days or months, which the calendar
bounds, whatever the data volume. The demand model is in ``forecasting``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.functions.numeric import round_half_even
from pyspark.sql import Window

from marketlens.functions import dates as X
from marketlens.plans import supply as B
from marketlens.sources import standins as V
from marketlens.sources.tables import Tables

FORECAST_YEAR = 2000
HOLDING_BEFORE = "1997-01-01"


def monthly_demand(t: Tables, year: int = FORECAST_YEAR, first_month: str | None = None) -> DataFrame:  # I-01
    """Units per product-month from Dec of year-2 (or ``first_month``) to Dec of year-1."""
    start = first_month or f"{year - 2}-12-01"
    end = f"{year - 1}-12-31"
    o = V.order_data(t, "product_id", "order_date", "order_item_quantity").where(F.to_date("order_date").between(F.to_date(F.lit(start)), F.to_date(F.lit(end))))
    return o.groupBy("product_id", F.year("order_date").cast("bigint").alias("order_year"),
                     F.month("order_date").cast("bigint").alias("order_month")).agg(
        F.sum("order_item_quantity").alias("total_quantity"))


def demand_features(t: Tables, year: int = FORECAST_YEAR) -> DataFrame:             # I-02
    """Previous month's quantity per product (first rows dropped), cyclic month."""
    m = monthly_demand(t, year)
    w = Window.partitionBy("product_id").orderBy("order_year", "order_month")
    f = m.withColumn("prev_quantity", F.lag("total_quantity", 1).over(w)).where(F.col("prev_quantity").isNotNull())
    return f.withColumns({"month_sin": X.month_sin("order_month"), "month_cos": X.month_cos("order_month")})


def forecast_frame(t: Tables, year: int = FORECAST_YEAR) -> DataFrame:              # I-04
    """12 rows per product for the target year; month 1 carries the last known quantity."""
    m = monthly_demand(t, year)
    last = m.groupBy("product_id").agg(
        F.max_by("total_quantity", F.struct("order_year", "order_month")).alias("last_quantity"))
    f = last.select("product_id", "last_quantity", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("m"))
    return f.select("product_id", F.lit(year).cast("bigint").alias("order_year"),
                    F.col("m").cast("bigint").alias("order_month"),
                    F.when(F.col("m") == 1, F.col("last_quantity")).alias("prev_quantity"),
                    X.month_sin("m").alias("month_sin"), X.month_cos("m").alias("month_cos"))


def annual_demand(t: Tables, forecast: DataFrame | None = None, year: int = FORECAST_YEAR) -> DataFrame:  # I-06
    """Predicted quantity summed per product. Without a fitted forecast the
    naive one is used: the units of the training year."""
    if forecast is None:
        forecast = monthly_demand(t, year).where(F.col("order_year") == year - 1).withColumnRenamed(
            "total_quantity", "predicted_quantity")
    return forecast.groupBy("product_id").agg(F.sum("predicted_quantity").alias("predicted_quantity"))


def eoq_rop(t: Tables, demand: DataFrame | None = None) -> DataFrame:              # I-07
    """EOQ = round(sqrt(2 D cost / (storage x 365))), weekly = round(D / 52),
    ROP = round(weekly x lead time), numpy half-even rounding."""
    d = demand if demand is not None else annual_demand(t)
    p = V.product_info(t).select("product_id", "product_name", "manufacturing_cost", "daily_storage_cost",
                                 "manufacturing_time")
    j = d.join(p, "product_id", "left")
    eoq = round_half_even(F.sqrt(F.try_divide(F.lit(2.0) * F.col("predicted_quantity") * F.col("manufacturing_cost"),
                                       F.col("daily_storage_cost") * F.lit(365.0))), 0)
    weekly = round_half_even(F.col("predicted_quantity") / F.lit(52.0), 0)
    return j.withColumns({"economic_order_quantity": eoq, "forecasted_avg_weekly_demand": weekly}).withColumn(
        "reorder_point", round_half_even(F.col("forecasted_avg_weekly_demand") * F.col("manufacturing_time"), 0))


def starting_stock(t: Tables, year: int = FORECAST_YEAR) -> DataFrame:             # I-08
    s = B.stock_ledger(t).where(F.col("date") == F.to_date(F.lit(f"{year}-01-01")))
    known = V.product_info(t).select("product_id")
    return s.join(known, "product_id", "left_semi").select("product_id", "current_stock")


def understocked(t: Tables, year: int = FORECAST_YEAR) -> DataFrame:               # I-09
    e = eoq_rop(t)
    s = starting_stock(t, year)
    j = e.join(s, "product_id", "left").fillna({"current_stock": 0.0})
    return j.withColumn("understocked", (F.col("current_stock") < F.col("reorder_point")).cast("int"))


def _part_rows(t: Tables) -> DataFrame:
    """(product_id, parts): the product's rows as (each: storage and manufacturing cost, upto: their sums up to the row); one
    row unless an id comes more than once. Rows with a price are first."""
    p = V.product_info(t).select("product_id", "daily_storage_cost", "manufacturing_cost").where(F.col("product_id").isNotNull())
    rows = p.groupBy("product_id").agg(F.sort_array(F.collect_list(F.struct(
        F.col("manufacturing_cost").isNull().alias("_n"), F.col("daily_storage_cost").isNull().alias("_s"),
        F.col("daily_storage_cost").alias("store"), F.col("manufacturing_cost").alias("make")))).alias("_r"))
    upto = lambda c, i: F.aggregate(
        F.slice("_r", 1, i + 1), F.lit(None).cast("double"), lambda s, x: F.coalesce(s + x[c], s, x[c]))
    return rows.select("product_id", F.transform("_r", lambda x, i: F.struct(
        i.alias("at"), x["store"].alias("store"), x["make"].alias("make"), upto("store", i).alias("store_upto"), upto("make", i).alias("make_upto"))).alias("parts"))


def holding_cost_actual(t: Tables, before: str = HOLDING_BEFORE) -> DataFrame:     # I-10
    """Implied orders and costs of the existing restocking, from the ledger:
    yesterday's stock (today's on a product's first day), expected = yesterday
    - sold, an order when today's stock is above expected; running totals.

    Windows run over the ledger's spans of equal stock (a row for each product-day with sales). What a span adds up to any of its
    days follows from its two stocks, so days are written out last. A product of several rows in the product table has a row
    for each on every day, the later ones with the same day's stock as yesterday's."""
    end = F.to_date(F.lit(before))
    s = B.ledger_spans(t).where((F.col("from") < end) & F.col("product_id").isNotNull())
    s = s.withColumns({"early": F.datediff("date", "from"), "late": F.datediff("until", "date") + 1,
                       "cur0": F.greatest("opening", F.lit(0.0)), "cur1": F.greatest("after", F.lit(0.0))})
    w = Window.partitionBy("product_id").orderBy("date")
    over = lambda current, yesterday, sold: F.greatest(current - (yesterday - sold), F.lit(0.0))
    none = F.lit(0.0)
    s = s.withColumn("_y", F.lag("cur1").over(w))
    s = s.withColumns({"open_order": F.when(F.col("early") > 0, over(F.col("cur0"), F.coalesce("_y", "cur0"), none)).otherwise(none),
                       "sale_order": over(F.col("cur1"), F.when(F.col("early") > 0, F.col("cur0")).otherwise(F.coalesce("_y", "cur1")), F.col("sold")),
                       "again_order": over(F.col("cur1"), F.col("cur1"), F.col("sold"))})
    earlier = w.rowsBetween(Window.unboundedPreceding, -1)
    held = F.col("early") * F.col("cur0") + F.col("late") * F.col("cur1")
    upto = lambda x: F.coalesce(F.sum(x).over(earlier), none)
    s = s.withColumns({"_first": upto(F.col("open_order") + F.col("sale_order")), "_again": upto("again_order"), "_held": upto(held)})
    j = s.join(_part_rows(t), "product_id")
    j = j.select("*", F.explode(F.sequence("from", F.least("until", F.date_sub(end, 1)))).alias("day"))
    j = j.select("*", F.explode("parts").alias("part"))
    early, sale = F.col("day") < F.col("date"), F.col("day") == F.col("date")
    first, all_ = F.col("parts")[0], F.element_at("parts", -1)
    current = F.when(early, F.col("cur0")).otherwise(F.col("cur1"))
    ordered = F.when(early, F.when((F.col("day") == F.col("from")) & (F.col("part.at") == 0), F.col("open_order")).otherwise(none)).when(
        sale, F.when(F.col("part.at") == 0, F.col("sale_order")).otherwise(F.col("again_order"))).otherwise(none)
    of_first = F.col("_first") + F.col("open_order") + F.when(early, none).otherwise(F.col("sale_order"))
    # what the rows after the first add: on earlier sale days all of them, on this one those up to this row
    rest = lambda x: x["make_upto"] - first["make_upto"]
    again = F.col("_again") * rest(all_) + F.when(early, none).when(sale, F.col("again_order") * rest(F.col("part"))).otherwise(
        F.col("again_order") * rest(all_))
    days = F.when(early, F.datediff("day", "from")).otherwise(F.datediff("day", "date"))
    held_before = F.col("_held") + F.when(early, none).otherwise(F.col("early") * F.col("cur0")) + days * current
    return j.select("product_id", F.col("day").alias("date"), current.alias("current_stock"), F.when(sale, F.col("sold")).otherwise(none).alias("total_sold"),
                    ordered.alias("order_quantity"), (F.col("part.make") * ordered).alias("manufacturing_cost_day"),
                    (current * F.col("part.store")).alias("holding_cost"),
                    (of_first * first["make_upto"] + again).alias("total_manufacturing_cost"),
                    (held_before * all_["store_upto"] + current * F.col("part.store_upto")).alias("total_holding_cost"))


def monthly_units_by_product(t: Tables, before: str = HOLDING_BEFORE) -> DataFrame:  # I-13
    o = V.order_data(t, "product_id", "order_date", "order_item_quantity").where(F.col("order_date") < F.to_timestamp(F.lit(before)))
    return o.groupBy("product_id", F.year("order_date").cast("bigint").alias("order_year"),
                     F.month("order_date").cast("bigint").alias("order_month")).agg(
        F.sum("order_item_quantity").alias("total_quantity"))


QUERIES = {
    "i01_monthly_demand": monthly_demand,
    "i02_demand_features": demand_features,
    "i04_forecast_frame": forecast_frame,
    "i06_annual_demand": annual_demand,
    "i07_eoq_rop": eoq_rop,
    "i08_starting_stock": starting_stock,
    "i09_understocked": understocked,
    "i10_holding_cost_actual": holding_cost_actual,
    "i13_monthly_units_by_product": monthly_units_by_product,
}
