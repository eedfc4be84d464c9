"""Marketplace tables expressed over the driver tables (FIXTURES.md section 3).

Each builder is a pure DataFrame program over ``Tables``; the DuckDB oracle
defines the same views in SQL (``oracle/views.py``). Only fixed-size frames
(nation: 25 rows, region: 5, inline maps) are broadcast by hint; everything
whose size grows with the data is left to the planner, whose broadcast
threshold is checked against measured sizes by AQE at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.sources.tables import Tables

# Fixed values of the stand-ins ------------------------------------------------
ORDER_STATUS = {"F": "delivered", "O": "shipped", "P": "canceled"}
SHIP_MODES = ["Standard Class", "Second Class", "First Class", "Same Day"]  # by l_linenumber % 4
ESTIMATE_DAYS = 30
# p_type -> (English category name, broad category)
CATEGORY_TRANSLATION = [
    ("ECONOMY", "economy_goods", "Home & Living"),
    ("LARGE", "large_items", "Furniture & Decor"),
    ("MEDIUM", "medium_items", "Electronics & Tech"),
    ("PROMO", "promo_items", "Fashion & Accessories"),
    ("SMALL", "small_items", "Health & Beauty"),
    ("STANDARD", "standard_goods", "Sports & Leisure"),
]


def _dim_nation(t: Tables) -> DataFrame:
    """nation x region, 25 rows by definition of the schema: safe to broadcast."""
    return F.broadcast(t.nation.join(F.broadcast(t.region),
                                     F.col("n_regionkey") == F.col("r_regionkey")))


def customers(t: Tables) -> DataFrame:
    n = _dim_nation(t)
    return (t.customer.join(n, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(F.col("c_custkey").alias("customer_id"),
                    F.col("c_custkey").alias("customer_unique_id"),
                    F.col("c_nationkey").cast("bigint").alias("customer_zip_code_prefix"),
                    F.col("n_name").alias("customer_city"),
                    F.col("r_name").alias("customer_state")))


def geolocation(t: Tables) -> DataFrame:
    n = _dim_nation(t)
    return n.select(F.col("n_nationkey").cast("bigint").alias("geolocation_zip_code_prefix"),
                    (F.lit(-30.0) + F.col("n_nationkey") * F.lit(0.75)).alias("geolocation_lat"),
                    (F.lit(-60.0) + F.col("n_nationkey") * F.lit(0.5)).alias("geolocation_lng"),
                    F.col("n_name").alias("geolocation_city"),
                    F.col("r_name").alias("geolocation_state"))


def status_name(code) -> "F.Column":
    c = F.col(code) if isinstance(code, str) else code
    return (F.when(c == "F", ORDER_STATUS["F"]).when(c == "O", ORDER_STATUS["O"])
            .otherwise(ORDER_STATUS["P"]))


def orders(t: Tables) -> DataFrame:
    """Orders with delivery = last ship date of the order's items (delivered only)."""
    last_ship = (t.lineitem.groupBy("l_orderkey")
                 .agg(F.max("l_shipdate").alias("last_ship")))
    o = t.orders.join(last_ship, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return o.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        status_name("o_orderstatus").alias("order_status"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
        (F.col("o_orderdate") + F.expr("INTERVAL 6 HOURS")).alias("order_approved_at"),
        F.when(F.col("o_orderstatus") == "F", F.col("last_ship")).alias("order_delivered_customer_date"),
        (F.col("o_orderdate") + F.expr(f"INTERVAL {ESTIMATE_DAYS} DAYS")).alias("order_estimated_delivery_date"),
    )


def orders_basic(t: Tables) -> DataFrame:
    """Orders without the delivery column (no lineitem scan) for queries that do not need it."""
    return t.orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        status_name("o_orderstatus").alias("order_status"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
    )


def item_total(price, discount) -> "F.Column":
    """An order item's price after its discount."""
    return F.col(price) * (F.lit(1.0) - F.col(discount))


def order_items(t: Tables) -> DataFrame:
    li = t.lineitem
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").cast("bigint").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        item_total("l_extendedprice", "l_discount").alias("price_after_discount"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("freight_value"),
        F.col("l_discount").alias("discount_rate"),
        F.col("l_extendedprice").alias("price_before_discount"),
    )


def payments(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.lit(1).cast("bigint").alias("payment_sequential"),
        F.col("o_orderpriority").alias("payment_type"),
        (F.lit(1) + F.col("o_orderkey") % 3).cast("bigint").alias("payment_installments"),
        F.col("o_totalprice").alias("payment_value"),
    )


def category_translation(t: Tables) -> DataFrame:
    return F.broadcast(t.spark.createDataFrame(
        CATEGORY_TRANSLATION,
        "product_category_name string, product_category_name_english string, broad_category string"))


def products(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_type").alias("product_category_name"),
        F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("product_brand"),
        (F.col("p_size") * F.lit(100.0)).alias("product_weight_g"),
        F.col("p_retailprice").alias("product_price"),
    )


def sellers(t: Tables) -> DataFrame:
    n = _dim_nation(t)
    return (t.supplier.join(n, F.col("s_nationkey") == F.col("n_nationkey"))
            .select(F.col("s_suppkey").alias("seller_id"),
                    F.col("s_nationkey").cast("bigint").alias("seller_zip_code_prefix"),
                    F.col("n_name").alias("seller_city"), F.col("r_name").alias("seller_state")))


def reviews(t: Tables, documents: DataFrame | None = None) -> DataFrame:
    """documents (+labels) as reviews; creation and answer times from two events rows, those of twice the id and the next. All
    joins are by the document's id, so that texts are dealt and sorted once; ``documents`` are the table's, dealt by that id."""
    ev = t.events.select("event_id", "ts")
    d = t.documents if documents is None else documents
    half, odd = F.shiftright("event_id", 1), F.col("event_id").bitwiseAND(F.lit(1)) == 1
    e1 = ev.where(~odd).select(half.alias("doc_id"), F.col("ts").alias("ts1"))
    e2 = ev.where(odd).select(half.alias("doc_id"), F.col("ts").alias("ts2"))
    r = (d.join(t.labels, "doc_id", "left")
         .join(e1, "doc_id", "left")
         .join(e2, "doc_id", "left"))
    return r.select(
        F.col("doc_id").alias("review_id"),
        F.col("doc_id").alias("order_id"),
        (F.lit(1) + F.col("doc_id") % 5).cast("bigint").alias("review_score"),
        F.when(F.col("doc_id") % 3 != 0, F.col("source")).alias("review_comment_title"),
        F.col("text").alias("review_comment_message"),
        F.least("ts1", "ts2").alias("review_creation_date"),
        F.greatest("ts1", "ts2").alias("review_answer_timestamp"),
        F.col("lang"), F.col("source"), F.col("quality"), F.col("toxic"),
    )


#: Columns of order_data that the lines and their orders don't have, and the tables that do.
_FROM_OTHERS = {"product_name": "part", "category_name": "part", "profit": "part", "product_price": "part",
                "warehouse_country": "warehouse", "order_country": "place", "order_region": "place", "order_city": "place",
                "order_state": "customer"}


def order_data(t: Tables, *columns: str) -> DataFrame:
    """The supply-chain order table: one row per order item with product, warehouse,
    customer place, shipping days and money columns. With ``columns`` only those are
    made, and only the tables that they come from are joined; foreign keys are taken
    to be whole, so that a join left out drops no row."""
    need = {_FROM_OTHERS[c] for c in columns if c in _FROM_OTHERS} if columns else {"part", "warehouse", "place", "customer"}
    n = _dim_nation(t)
    j = t.lineitem.join(t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus"), F.col("l_orderkey") == F.col("o_orderkey"))
    if "part" in need:
        j = j.join(t.part.select("p_partkey", "p_name", "p_type", "p_retailprice"), F.col("l_partkey") == F.col("p_partkey"))
    if "warehouse" in need:
        wn = n.select(F.col("n_nationkey").alias("w_nationkey"), F.col("n_name").alias("warehouse_country"))
        j = j.join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey")).join(
            wn, F.col("s_nationkey") == F.col("w_nationkey"))
    if need & {"place", "customer"}:
        j = j.join(t.customer.select("c_custkey", "c_nationkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
    if "place" in need:
        cn = n.select(F.col("n_nationkey").alias("cn_nationkey"), F.col("n_name").alias("order_country"), F.col("r_name").alias("order_region"))
        j = j.join(cn, F.col("c_nationkey") == F.col("cn_nationkey"))
    real = F.datediff(F.col("l_shipdate"), F.col("o_orderdate")).cast("bigint")
    sched = F.col("l_linenumber").cast("bigint")
    total = item_total("l_extendedprice", "l_discount")
    made = {
        "order_id": F.col("l_orderkey"),
        "order_item_id": F.col("l_linenumber").cast("bigint"),
        "product_id": F.col("l_partkey"),
        "product_name": F.col("p_name"),
        "category_name": F.col("p_type"),
        "customer_id": F.col("o_custkey"),
        "warehouse_id": F.col("l_suppkey"),
        "warehouse_country": F.col("warehouse_country"),
        "order_country": F.col("order_country"),
        "order_region": F.col("order_region"),
        "order_state": F.col("c_mktsegment"),
        "order_city": F.concat_ws(" ", F.col("order_country"), F.col("c_mktsegment")),
        "order_date": F.col("o_orderdate"),
        "shipping_date": F.col("l_shipdate"),
        "days_for_shipping_real": real,
        "days_for_shipment_scheduled": sched,
        "shipping_mode": F.element_at(F.array(*[F.lit(m) for m in SHIP_MODES]), (F.col("l_linenumber") % 4 + 1).cast("int")),
        "delivery_status": F.when(real > sched, "Late delivery").when(real == sched, "Shipping on time").otherwise("Advance shipping"),
        "order_status": status_name("o_orderstatus"),
        "order_item_quantity": F.col("l_quantity"),
        "sales": F.col("l_extendedprice"),
        "discount_rate": F.col("l_discount"),
        "order_item_total": total,
        "profit": total - F.col("p_retailprice") * F.col("l_quantity") * F.lit(0.5),
        "product_price": F.col("p_retailprice"),
    }
    return j.select(*[made[c].alias(c) for c in columns or made])


def product_info(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_size").cast("double").alias("weight_kg"),
        (F.col("p_size") * F.lit(0.02)).alias("daily_storage_cost"),
        (F.lit(3) + F.col("p_partkey") % 8).cast("bigint").alias("manufacturing_time"),
        (F.col("p_retailprice") / F.lit(2.0)).alias("manufacturing_cost"),
        F.col("p_retailprice").alias("price"),
    )


# Ten campaigns over the order years; two overlap, one earns nothing.
CAMPAIGNS = [
    (1, "1995-03-01", "1995-03-31", "Flash Sales", "social media", 12000.0, 50000.0, 200000, 4000),
    (2, "1995-11-15", "1995-12-31", "Seasonal Sales", "influencer", 30000.0, 140000.0, 500000, 12000),
    (3, "1996-06-01", "1996-06-20", "Referral Programs", "email", 5000.0, 0.0, 60000, 900),
    (4, "1997-02-01", "1997-03-15", "Flash Sales", "media", 20000.0, 75000.0, 300000, 5200),
    (5, "1997-03-01", "1997-04-10", "Bundle Offers (BOGO)", "search", 18000.0, 90000.0, 250000, 7000),
    (6, "1998-09-10", "1998-10-10", "Seasonal Sales", "social media", 25000.0, 110000.0, 420000, 9100),
    (7, "1999-05-01", "1999-05-31", "Referral Programs", "email", 7000.0, 33000.0, 80000, 2500),
    (8, "2000-01-05", "2000-02-05", "Bundle Offers (BOGO)", "influencer", 15000.0, 64000.0, 190000, 4300),
    (9, "2000-11-20", "2000-12-31", "Seasonal Sales", "search", 40000.0, 210000.0, 650000, 15000),
    (10, "2001-04-01", "2001-05-15", "Flash Sales", "media", 22000.0, 81000.0, 330000, 6100),
]


def marketing(t: Tables) -> DataFrame:
    df = t.spark.createDataFrame(
        CAMPAIGNS,
        "id bigint, start_date string, end_date string, campaign_type string, channel string, "
        "campaign_budget double, campaign_revenue double, impressions bigint, clicks bigint")
    return F.broadcast(df.withColumn("start_date", F.to_date("start_date"))
                       .withColumn("end_date", F.to_date("end_date")))


def world_cities(t: Tables) -> DataFrame:
    """A reference city list derived from nation by rule: accented, lower-cased
    and hyphenated spellings, plus each region as an admin name."""
    n = _dim_nation(t)
    k = F.col("n_nationkey")
    country = (F.when(k % 3 == 0, F.regexp_replace("n_name", "NATION", "Nàtion"))
               .when(k % 3 == 1, F.lower("n_name"))
               .otherwise(F.regexp_replace("n_name", "_", "-")))
    return n.select(
        F.concat(F.lit("City "), k.cast("string")).alias("city_ascii"),
        country.alias("country"),
        F.initcap("r_name").alias("admin_name"),
        (F.lit(-30.0) + k * F.lit(0.75)).alias("lat"),
        (F.lit(-60.0) + k * F.lit(0.5)).alias("lng"),
    )
