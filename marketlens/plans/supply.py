"""Supply-chain preparation (B-01 .. B-08).

The daily stock ledger (B-03) is set-based: windows over the days with sales give
spans of equal stock, whose days are written out at the end (no window holds more
rows than a product has days with sales, whatever the data size).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlens.functions.numeric import round_half_even
from marketlens.functions import text as TX
from marketlens.functions.numeric import money_sum
from marketlens.operators.aggregates import mode_per_key
from marketlens.session import checkpoint_dir, dealt
from marketlens.sources import standins as V
from marketlens.sources.tables import Tables, export_bundle

CLEAN_CUTOFF = "2001-01-01"
PRICE_CUTOFF = "2000-01-01"
# Ledger inputs by rule (the reference draws them at random): the stock at the
# start of a month is INITIAL_FACTOR x that month's units, the restock
# RESTOCK_FACTOR x the previous calendar month's units, both rounded up.
INITIAL_FACTOR = 1.5
RESTOCK_FACTOR = 1.1
STORAGE_RATE = 0.02
# Order-price rules: first keyword found in the product name gives the
# wholesale discount; names with no rule get no price and are dropped.
ORDER_PRICE_RULES = [("widget", 0.6), ("plate", 0.4), ("ring", 0.5), ("bolt", 0.3), ("gear", 0.5),
                     ("rod", 0.4), ("anvil", 0.3)]


def clean_orders(t: Tables, cutoff: str = CLEAN_CUTOFF) -> DataFrame:                 # B-01
    """Order rows before the cutoff with date parts, a late flag and the delay."""
    o = V.order_data(t).where(F.col("order_date") < F.to_timestamp(F.lit(cutoff)))
    return o.select(
        "order_id", "order_item_id", "product_id", "product_name", "category_name", "warehouse_id",
        "order_country", "order_region", "order_state", "order_city", "order_date", "shipping_mode",
        "order_item_quantity", "sales", "order_item_total", "profit",
        F.year("order_date").cast("bigint").alias("order_year"),
        F.month("order_date").cast("bigint").alias("order_month"),
        F.dayofmonth("order_date").cast("bigint").alias("order_day"),
        F.trunc(F.to_date("order_date"), "MM").alias("order_year_month"),
        (F.col("delivery_status") == "Late delivery").cast("int").alias("late_flag"),
        (F.col("days_for_shipping_real") - F.col("days_for_shipment_scheduled")).alias("delay_days"))


def warehouse_location(t: Tables) -> DataFrame:                                      # B-02
    """Each order row gets its warehouse's most frequent coordinate pair."""
    g = V.geolocation(t).select(F.col("geolocation_city").alias("order_country"),
                                F.col("geolocation_lat").alias("lat"), F.col("geolocation_lng").alias("lng"))
    rows = V.order_data(t, "order_id", "order_item_id", "warehouse_id", "order_country").join(
        g, "order_country")
    mode = mode_per_key(rows, ["warehouse_id"], ["lat", "lng"]).withColumnsRenamed(
        {"lat": "warehouse_lat", "lng": "warehouse_lng"})
    return rows.join(mode, "warehouse_id", "left")


def daily_units(t: Tables) -> DataFrame:
    return V.order_data(t, "product_id", "order_date", "order_item_quantity").groupBy("product_id", F.to_date("order_date").alias("date")).agg(
        F.sum("order_item_quantity").alias("sold"))


def ledger_spans(t: Tables, initial_factor: float = INITIAL_FACTOR, restock_factor: float = RESTOCK_FACTOR,
                 subtract_first_day: bool = False) -> DataFrame:
    """The ledger before its days are written out: a row for each product-day with sales. It stands for the days from ``from``
    (its month's first day, for the first sale of the month) to ``until``, the day before the next sale or the month's last:
    stock ``opening`` before the sale's ``date``, ``after`` from then on; ``sold`` on that date alone.

    Daily units are dealt by product and sorted once, by month and date; no window holds more than the days with sales."""
    d = dealt(daily_units(t).where(F.col("date").isNotNull()), "product_id")
    d = d.select("product_id", F.trunc("date", "MM").alias("month"), "date", "sold")
    number = F.year("month") * 12 + F.month("month")
    d = d.withColumns({"_m": number, "taken": F.coalesce("sold", F.lit(0.0)) if subtract_first_day else F.when(
        F.col("date") == F.col("month"), F.lit(0.0)).otherwise(F.coalesce("sold", F.lit(0.0)))})
    days = Window.partitionBy("product_id", "_m").orderBy("date")
    months = Window.partitionBy("product_id").orderBy("_m")
    d = d.withColumns({"previous": F.lag("date").over(days), "next": F.lead("date").over(days),
                       "gone": F.sum("taken").over(days.rowsBetween(Window.unboundedPreceding, 0))})
    d = d.withColumns({"month_units": F.sum("sold").over(months.rangeBetween(0, 0)), "month_before": F.sum("sold").over(months.rangeBetween(-1, -1))})
    opening = (F.ceil(F.col("month_units") * F.lit(initial_factor)).cast("double")
               + F.ceil(F.coalesce("month_before", F.lit(0.0)) * F.lit(restock_factor)).cast("double"))
    return d.select("product_id", F.when(F.col("previous").isNull(), F.col("month")).otherwise(F.col("date")).alias("from"), "date",
                    F.coalesce(F.date_sub("next", 1), F.last_day("month")).alias("until"), opening.alias("opening"),
                    (opening - F.col("gone")).alias("after"), F.coalesce("sold", F.lit(0.0)).alias("sold"))


def stock_ledger(t: Tables, initial_factor: float = INITIAL_FACTOR, restock_factor: float = RESTOCK_FACTOR,
                 subtract_first_day: bool = False) -> DataFrame:                   # B-03
    """Daily stock per product-month with sales: day 1 = initial + restock,
    later days minus the units sold (D-10: day-1 sales are not taken off unless
    ``subtract_first_day``); stock floored at 0 on output only.

    The orders are read and joined once; what is sorted are the days with sales, which ``ledger_spans`` turns into spans of
    equal stock. The days of a span are written out last, and no shuffle, sort or window follows."""
    s = ledger_spans(t, initial_factor, restock_factor, subtract_first_day)
    j = s.select("product_id", "opening", "after", "sold", F.col("date").alias("_sale"), F.explode(F.sequence("from", "until")).alias("date"))
    raw = F.when(F.col("date") < F.col("_sale"), F.col("opening")).otherwise(F.col("after"))
    return j.select("product_id", "date", raw.alias("raw_stock"), F.greatest(raw, F.lit(0.0)).alias("current_stock"),
                    F.when(F.col("date") == F.col("_sale"), F.col("sold")).otherwise(F.lit(0.0)).alias("total_sold"))


def negative_stock_check(t: Tables) -> DataFrame:                                   # B-04
    """Ledger rows whose running stock went below zero before the floor."""
    return stock_ledger(t).where(F.col("raw_stock") < 0)


def product_price(t: Tables, cutoff: str = PRICE_CUTOFF) -> DataFrame:              # B-05
    o = V.order_data(t, "product_id", "order_date", "sales", "order_item_quantity").where(F.col("order_date") < F.to_timestamp(F.lit(cutoff)))
    return o.groupBy("product_id").agg(
        F.try_divide(money_sum("sales"), F.sum("order_item_quantity")).alias("price"))


def product_costs(t: Tables, rules=ORDER_PRICE_RULES) -> DataFrame:                 # B-06
    p = V.product_info(t)
    disc = TX.first_keyword_rule("product_name", rules)
    return (p.select("product_id", "product_name", "weight_kg", "price",
                     (F.col("weight_kg") * F.lit(STORAGE_RATE)).alias("daily_storage_cost"),
                     round_half_even(F.col("price") * (F.lit(1.0) - disc), 2).alias("manufacturing_cost"))
            .dropna(subset=["manufacturing_cost"]))


def monthly_stock(t: Tables) -> DataFrame:                                          # B-07
    """Stock at the start of each product-month (earliest date, D-11) and units sold."""
    s = stock_ledger(t)
    return s.groupBy("product_id", F.year("date").cast("bigint").alias("year"),
                     F.month("date").cast("bigint").alias("month")).agg(
        F.min_by("current_stock", "date").alias("stock_at_start_of_month"),
        F.sum("total_sold").alias("total_sold"))


def supply_dashboard(t: Tables) -> dict[str, DataFrame]:                            # B-08
    """The supply-chain sheets as lazy frames; write them with ``export_bundle``."""
    from marketlens.plans import inventory as inv
    return {"orders": clean_orders(t), "stock": stock_ledger(t), "monthly_stock": monthly_stock(t),
            "products": product_costs(t), "forecast": inv.annual_demand(t), "reorder": inv.understocked(t)}


def written_dashboard(t: Tables) -> DataFrame:
    """The bundle written beside the cluster's checkpoints and read again: rows and columns of every sheet."""
    base = f"{checkpoint_dir(t.spark).rstrip('/')}/supply-dashboard-{uuid.uuid4().hex}"
    sheets = supply_dashboard(t)
    export_bundle(sheets, base)
    out = None
    for name in sheets:
        back = t.spark.read.parquet(f"{base}/{name}")
        rows = back.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("sheet"), "rows", F.lit(len(back.columns)).alias("columns"))
        out = rows if out is None else out.unionByName(rows)
    return out


QUERIES = {
    "b01_clean_orders": clean_orders,
    "b02_warehouse_location": warehouse_location,
    "b03_stock_ledger": stock_ledger,
    "b04_negative_stock_check": negative_stock_check,
    "b05_product_price": product_price,
    "b06_product_costs": product_costs,
    "b07_monthly_stock": monthly_stock,
    "b08_supply_dashboard": written_dashboard,
}
