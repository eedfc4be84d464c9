"""Order fulfilment (O-01 .. O-15).

Metrics over a year of history are grouped aggregates; the candidate
deliveries are the orders of the last days, scored with min-max scaling
(one-row aggregates broadcast back). Routing works on the selected
deliveries only: ``select_deliveries`` bounds them to n_vehicles x capacity
(minus a buffer), which also bounds the pairwise distance table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from marketlens.functions import text as TX
from marketlens.functions.numeric import haversine_km
from marketlens.operators.joins import fuzzy_best_in_block, fuzzy_top_k
from marketlens.session import cut_lineage
from marketlens.sources import standins as V
from marketlens.sources.tables import Tables

PLAN_DATE = "2000-06-30"
HISTORY_DAYS = 365
RECENT_DAYS = 2
# Priority weights of the delivery plan.
WEIGHTS = {"late_delivery_probability": 0.5, "days_till_scheduled_delivery": 0.4,
           "avg_shipping_time": 0.3, "order_profit": 0.1}
N_VEHICLES, CAPACITY = 4, 10
WAREHOUSE_NODE = 0


def history_metrics(t: Tables, date: str = PLAN_DATE) -> DataFrame:
    """Late share and mean shipping days of each product and mode over the year before the date, in one aggregate."""
    d = F.to_date(F.lit(date))
    lines = V.order_data(t, "product_id", "shipping_mode", "order_date", "delivery_status", "days_for_shipping_real")
    return lines.where(F.to_date("order_date").between(F.date_sub(d, HISTORY_DAYS), d)).groupBy("product_id", "shipping_mode").agg(
        F.avg((F.col("delivery_status") == "Late delivery").cast("double")).alias("late_delivery_probability"),
        F.avg("days_for_shipping_real").alias("avg_shipping_time"))


def late_probability(t: Tables, date: str = PLAN_DATE) -> DataFrame:                  # O-01
    return history_metrics(t, date).drop("avg_shipping_time")


def avg_shipping_time(t: Tables, date: str = PLAN_DATE) -> DataFrame:                 # O-02
    return history_metrics(t, date).drop("late_delivery_probability")


def delivery_deadlines(t: Tables, date: str = PLAN_DATE) -> DataFrame:                # O-03
    """Orders of the last days with both metrics; the ship time defaults to the
    scheduled days; days until the scheduled delivery date."""
    d = F.to_date(F.lit(date))
    o = V.order_data(t).where(F.to_date("order_date").between(F.date_sub(d, RECENT_DAYS), d))
    j = o.join(history_metrics(t, date), ["product_id", "shipping_mode"], "left")
    j = j.withColumn("avg_shipping_time", F.coalesce(F.col("avg_shipping_time"),
                                                     F.col("days_for_shipment_scheduled").cast("double")))
    due = F.date_add(F.to_date("order_date"), F.col("days_for_shipment_scheduled").cast("int"))
    return j.select("order_id", "order_item_id", "product_id", "shipping_mode", "order_date", "warehouse_id",
                    "order_country", "order_region", "order_state", "order_city",
                    F.col("profit").alias("order_profit"), "late_delivery_probability", "avg_shipping_time",
                    due.alias("scheduled_delivery_date"),
                    F.datediff(due, d).cast("bigint").alias("days_till_scheduled_delivery"))


def priority_score(t: Tables, date: str = PLAN_DATE, weights: dict | None = None) -> DataFrame:  # O-04
    """Weighted sum of late probability, inverted days-till-due, inverted ship
    time and profit, each min-max scaled over the warehouse's candidates. A product with no
    late history scores null and sorts last (D-16)."""
    w = dict(WEIGHTS, **(weights or {}))
    d = cut_lineage(delivery_deadlines(t, date))              # the orders of a few days, used twice
    mm = d.groupBy("warehouse_id").agg(*[f(c).alias(f"_{n}_{c}") for c in ["days_till_scheduled_delivery", "avg_shipping_time", "order_profit"]
                 for n, f in (("lo", F.min), ("hi", F.max))])
    x = d.join(mm, "warehouse_id")

    def inv(c):
        return F.try_divide(F.col(f"_hi_{c}") - F.col(c), F.col(f"_hi_{c}") - F.col(f"_lo_{c}"))

    prof = F.try_divide(F.col("order_profit") - F.col("_lo_order_profit"),
                        F.col("_hi_order_profit") - F.col("_lo_order_profit"))
    score = (F.col("late_delivery_probability") * w["late_delivery_probability"]
             + inv("days_till_scheduled_delivery") * w["days_till_scheduled_delivery"]
             + inv("avg_shipping_time") * w["avg_shipping_time"] + prof * w["order_profit"])
    return x.withColumn("priority_score", score).drop(*[c for c in x.columns if c.startswith("_")])


def select_deliveries(t: Tables, n_vehicles: int = N_VEHICLES, capacity: int = CAPACITY,
                      date: str = PLAN_DATE) -> DataFrame:                            # O-05
    """Each warehouse's top n x cap - int(0.1 x n x cap) by score (nulls last; ties by order, item)."""
    total = n_vehicles * capacity
    w = Window.partitionBy("warehouse_id").orderBy(F.desc_nulls_last("priority_score"), "order_id", "order_item_id", "product_id",
                                                   "order_profit")
    s = priority_score(t, date)
    return s.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= total - int(0.1 * total)).drop("_rank")


def attach_coordinates(t: Tables, frame: DataFrame | None = None) -> DataFrame:        # O-09
    g = V.geolocation(t).select(F.col("geolocation_city").alias("order_country"),
                                F.col("geolocation_lat").alias("latitude"), F.col("geolocation_lng").alias("longitude"))
    f = frame if frame is not None else select_deliveries(t)
    return f.join(g, "order_country", "left")


def _assign(t: Tables, order, n_vehicles: int, capacity: int) -> DataFrame:
    s = attach_coordinates(t)
    w = Window.partitionBy("warehouse_id").orderBy(*order)  # at most n x cap rows each
    s = s.withColumn("row_index", (F.row_number().over(w) - 1).cast("bigint"))
    v = F.floor(F.col("row_index") / F.lit(capacity)).cast("bigint")
    s = s.withColumn("vehicle", F.when(v < n_vehicles, v))
    wv = Window.partitionBy("warehouse_id", "vehicle").orderBy("row_index")
    return s.withColumn("stop", F.row_number().over(wv).cast("bigint"))


def assign_fifo(t: Tables, n_vehicles: int = N_VEHICLES, capacity: int = CAPACITY) -> DataFrame:  # O-11
    return _assign(t, [F.col("order_date"), F.col("order_id"), F.col("order_item_id"), F.col("product_id"),
                       F.col("order_profit")], n_vehicles, capacity)


def assign_by_region(t: Tables, n_vehicles: int = N_VEHICLES, capacity: int = CAPACITY) -> DataFrame:  # O-12
    return _assign(t, [F.col("order_region"), F.col("order_state"), F.col("order_city"), F.col("order_id"),
                       F.col("order_item_id"), F.col("product_id"), F.col("order_profit")], n_vehicles, capacity)


def _depots(t: Tables) -> DataFrame:
    """Each warehouse at its country's coordinates."""
    sup = t.supplier.select(F.col("s_suppkey").alias("warehouse_id"), F.col("s_nationkey").cast("bigint").alias("_nation"))
    g = V.geolocation(t).select(F.col("geolocation_zip_code_prefix").cast("bigint").alias("_nation"),
                                F.col("geolocation_lat").alias("latitude"), F.col("geolocation_lng").alias("longitude"))
    return sup.join(g, "_nation").drop("_nation")


def distance_matrix(t: Tables) -> DataFrame:                                          # O-10
    """Symmetric km table of each warehouse over node 0 = warehouse and nodes 1.. = its selected
    deliveries in FIFO order (both directions, diagonal 0)."""
    a = assign_fifo(t).select("warehouse_id", (F.col("row_index") + 1).alias("node"), "latitude", "longitude")
    depots = _depots(t).join(a.select("warehouse_id").distinct(), "warehouse_id", "left_semi")
    nodes = a.unionByName(depots.withColumn("node", F.lit(WAREHOUSE_NODE).cast("bigint")))
    i = nodes.select("warehouse_id", F.col("node").alias("i"), F.col("latitude").alias("lat_i"), F.col("longitude").alias("lng_i"))
    j = nodes.select("warehouse_id", F.col("node").alias("j"), F.col("latitude").alias("lat_j"), F.col("longitude").alias("lng_j"))
    return i.join(j, "warehouse_id").select("warehouse_id", "i", "j", haversine_km("lat_i", "lng_i", "lat_j", "lng_j").alias("km"))


def route_distance(t: Tables, by_region: bool = False, include_depot: bool = True) -> DataFrame:  # O-13
    """Km per warehouse and vehicle from the stop order: stop-to-stop legs, plus the legs from and
    back to the depot when ``include_depot`` (D-15); the row of warehouse and vehicle -1 is the total."""
    a = assign_by_region(t) if by_region else assign_fifo(t)
    a = a.where(F.col("vehicle").isNotNull())
    w = Window.partitionBy("warehouse_id", "vehicle").orderBy("stop")
    legs = a.withColumn("plat", F.lag("latitude").over(w)).withColumn("plng", F.lag("longitude").over(w))
    legs = legs.withColumn("leg", F.coalesce(haversine_km("plat", "plng", "latitude", "longitude"), F.lit(0.0)))
    per = legs.groupBy("warehouse_id", "vehicle").agg(F.sum("leg").alias("km"),
                                                      F.min_by(F.struct("latitude", "longitude"), "stop").alias("_first"),
                                                      F.max_by(F.struct("latitude", "longitude"), "stop").alias("_last"),
                                                      F.count(F.lit(1)).alias("n_stops"))
    if include_depot:
        out = haversine_km("latitude", "longitude", "_first.latitude", "_first.longitude")
        back = haversine_km("_last.latitude", "_last.longitude", "latitude", "longitude")
        per = per.join(_depots(t), "warehouse_id").withColumn("km", F.col("km") + out + back)
    per = per.select("warehouse_id", "vehicle", "n_stops", "km")
    total = per.agg(F.coalesce(F.sum("n_stops"), F.lit(0)).alias("n_stops"), F.coalesce(F.sum("km"), F.lit(0.0)).alias("km")).select(
        F.lit(-1).cast(per.schema["warehouse_id"].dataType).alias("warehouse_id"), F.lit(-1).cast("bigint").alias("vehicle"), "n_stops", "km")
    return per.unionByName(total)


# O-06 / O-07 / O-08 -----------------------------------------------------------
def country_candidates(t: Tables, k: int = 5, min_score: int = 50) -> DataFrame:    # O-06
    """Order countries missing from the city list (after name cleaning), with the
    k best list countries by similarity score."""
    orders = V.order_data(t, "order_country").select(TX.clean_name("order_country").alias("country")).distinct()
    world = V.world_cities(t).select(TX.clean_name("country").alias("country")).distinct()
    missing = orders.join(world, "country", "left_anti")
    return fuzzy_top_k(missing, "country", world, "country", k=k, min_score=min_score)


def map_locations(t: Tables, min_score: int = 50) -> DataFrame:                      # O-07
    """Each order place: best list country, then the best admin name (state)
    inside that country."""
    places = V.order_data(t, "order_country", "order_region").select(TX.clean_name("order_country").alias("country"),
                                    TX.clean_name("order_region").alias("state")).distinct()
    world = V.world_cities(t).select(TX.clean_name("country").alias("world_country"),
                                     TX.clean_name("admin_name").alias("world_state")).distinct()
    c = fuzzy_top_k(places.select("country"), "country", world.select(F.col("world_country").alias("c")), "c",
                    k=1, min_score=min_score).select("country", F.col("candidate").alias("matched_country"))
    p = places.join(c, "country", "left")
    ws = world.select(F.col("world_country").alias("matched_country"), F.col("world_state").alias("ws"))
    return fuzzy_best_in_block(p, "state", ws, "ws", ["matched_country"], min_score, out="matched_state")


def locate_cities(t: Tables) -> DataFrame:                                           # O-08
    """Coordinates of each order place from the matched list country."""
    m = map_locations(t)
    w = V.world_cities(t).select(TX.clean_name("country").alias("matched_country"), "lat", "lng")
    w = w.groupBy("matched_country").agg(F.min_by(F.struct("lat", "lng"), "lat").alias("_c"))
    return m.join(w, "matched_country", "left").select(
        "country", "state", "matched_country", "matched_state",
        F.col("_c.lat").alias("latitude"), F.col("_c.lng").alias("longitude"))


QUERIES = {
    "o01_late_probability": late_probability,
    "o02_avg_shipping_time": avg_shipping_time,
    "o03_delivery_deadlines": delivery_deadlines,
    "o04_priority_score": priority_score,
    "o05_select_deliveries": select_deliveries,
    "o06_country_candidates": country_candidates,
    "o07_map_locations": map_locations,
    "o08_locate_cities": locate_cities,
    "o09_attach_coordinates": attach_coordinates,
    "o10_distance_matrix": distance_matrix,
    "o11_assign_fifo": assign_fifo,
    "o12_assign_by_region": assign_by_region,
    "o13_route_distance": route_distance,
}
