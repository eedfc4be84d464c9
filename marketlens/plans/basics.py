"""The general operators (S, F, J, A, W, T, X) over the driver tables, one query for each. Every query reads whole tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.functions import dates as D
from marketlens.functions import numeric as N
from marketlens.functions import params as P
from marketlens.functions import text as X
from marketlens.operators import aggregates as A
from marketlens.operators import frame as FR
from marketlens.operators import joins as J
from marketlens.operators import ordering as O
from marketlens.operators import windows as W
from marketlens.session import checkpoint_dir
from marketlens.sources import standins as V
from marketlens.sources import tables as S
from marketlens.sources.tables import Tables


def _folder(t: Tables, name: str) -> str:
    return f"{checkpoint_dir(t.spark).rstrip('/')}/tables-{uuid.uuid4().hex}/{name}"


def _monthly_lines(t: Tables) -> DataFrame:
    """Quantity of each line number and month."""
    return t.lineitem.groupBy("l_linenumber", D.month_start("l_shipdate").alias("month")).agg(F.sum("l_quantity").alias("qty"))


# Sources and sinks --------------------------------------------------------
def s02_priorities_above(t: Tables) -> DataFrame:
    return S.read_query(t.spark, "SELECT o_orderpriority, count(*) AS n FROM big_orders WHERE o_totalprice >= :floor GROUP BY 1",
                        {"big_orders": t.orders}, floor=100_000)


def s03_suppliers_from_csv(t: Tables) -> DataFrame:
    path = _folder(t, "supplier")
    S.write_csv(t.supplier, path)
    return S.read_csv(t.spark, path, t.supplier.schema)


def s04_daily_orders_built_once(t: Tables) -> DataFrame:
    path = _folder(t, "daily")
    build = lambda: t.orders.groupBy(D.day_of("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    S.load_or_build(t.spark, path, build)
    return S.load_or_build(t.spark, path, build)


def s05_customers_by_segment(t: Tables) -> DataFrame:
    path = _folder(t, "customer")
    S.write_table(t.customer, path, ["c_mktsegment"])
    return t.spark.read.parquet(path)


def s06_customers_as_csv(t: Tables) -> DataFrame:
    path = _folder(t, "customer")
    S.write_csv(t.customer, path, sep=";")
    return S.read_csv(t.spark, path, t.customer.schema, sep=";")


def s07_bundle_of_names(t: Tables) -> DataFrame:
    paths = S.export_bundle({"customer": t.customer.select(F.col("c_name").alias("name")),
                             "supplier": t.supplier.select(F.col("s_name").alias("name"))}, _folder(t, "bundle"))
    return O.union_all([t.spark.read.parquet(p).withColumn("sheet", F.lit(k)) for k, p in paths.items()])


def s09_evolved_customers(t: Tables) -> DataFrame:
    return S.evolve_table(t.customer, add={"note": S.null_typed("string")}, rename={"c_mktsegment": "segment"}, drop=["c_nationkey"],
                          update={"c_acctbal": N.clamp_low("c_acctbal")})


# Frames -------------------------------------------------------------------
def f01_part_columns(t: Tables) -> DataFrame:
    return FR.select_columns(t.part, ["p_partkey", "p_retailprice", "p_name"])


def f02_renamed_parts(t: Tables) -> DataFrame:
    return FR.rename_columns(t.part, {"p_partkey": "product_id", "p_name": "product_name"})


def f03_parts_without_size(t: Tables) -> DataFrame:
    return FR.drop_columns(t.part, ["p_size", "p_brand"])


def f04_large_lines(t: Tables) -> DataFrame:
    return FR.filter_rows(t.lineitem, (F.col("l_quantity") >= 30) & (F.col("l_returnflag") == "R"))


def f05_orders_of_1997(t: Tables) -> DataFrame:
    return FR.between_window(t.orders, "o_orderdate", "1997-01-01", "1997-12-31")


def f06_known_customers(t: Tables) -> DataFrame:
    return FR.keep_known(t.customer, t.orders.select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


def f08_filled_delivery(t: Tables) -> DataFrame:
    return FR.fill_nulls(V.orders(t), from_columns={"order_delivered_customer_date": "order_estimated_delivery_date"})


def f09_parsed_dates(t: Tables) -> DataFrame:
    text = F.when(F.col("o_orderstatus") == "P", "no date").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    d = FR.parse_dates(t.orders.select("o_orderkey", text.alias("day")), ["day"], "yyyy-MM-dd")
    return d.withColumn("day", F.to_date("day"))


def f10_replaced_flags(t: Tables) -> DataFrame:
    return FR.replace_values(t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag"), "l_returnflag", {"R": "returned", "A": "accepted"})


def f11_mapped_status(t: Tables) -> DataFrame:
    return FR.map_values(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderstatus", {"F": "done", "O": "open"}, "status")


def f12_rule_then_map(t: Tables) -> DataFrame:
    rule = X.first_keyword_rule("p_name", [("ring", "jewel"), ("widget", "N/A")])
    return t.part.select("p_partkey", FR.map_with_fallback(rule, F.col("p_type"), {"ECONOMY": "low", "PROMO": "offer"}).alias("label"))


def f13_trimmed_names(t: Tables) -> DataFrame:
    return FR.trim_columns(t.customer.select("c_custkey", F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("c_name")), ["c_name"])


def f15_ranked_customers(t: Tables) -> DataFrame:
    return FR.add_row_index(t.customer.select("c_custkey", "c_acctbal"), [F.desc("c_acctbal"), F.asc("c_custkey")])


def f16_largest_orders(t: Tables) -> DataFrame:
    return FR.preview(t.orders, 10, [F.desc("o_totalprice"), F.asc("o_orderkey")])


# Joins --------------------------------------------------------------------
def j01_orders_with_segment(t: Tables) -> DataFrame:
    return J.inner_join(t.orders, t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_mktsegment", "o_totalprice")


def j02_customers_and_orders(t: Tables) -> DataFrame:
    return J.left_join(t.customer, t.orders, F.col("o_custkey") == F.col("c_custkey")).select("c_custkey", "o_orderkey").fillna({"o_orderkey": -1})


def j03_star(t: Tables) -> DataFrame:
    j = J.star_join(t.lineitem, [(t.orders, F.col("l_orderkey") == F.col("o_orderkey")), (t.part, F.col("l_partkey") == F.col("p_partkey")),
                                 (t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))])
    return j.groupBy("p_type", "o_orderpriority", "s_nationkey").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("qty"))


def j04_no_order_within_half_a_year(t: Tables) -> DataFrame:
    day = F.col("o_orderdate")
    left = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return J.anti_join_range(left, t.orders, ["o_custkey"], "o_orderdate", "o_orderdate", day, day + F.expr("INTERVAL 180 DAYS"))


def j05_only_returned_pairs(t: Tables) -> DataFrame:
    keys = ["l_partkey", "l_suppkey"]
    pairs = lambda flag: t.lineitem.where(F.col("l_returnflag") == flag).select(*keys)
    return J.anti_join_keys(pairs("R").distinct(), pairs("A"), keys, null_safe=True)


def j06_returned_parts(t: Tables) -> DataFrame:
    back = t.lineitem.where("l_returnflag = 'R'").select(F.col("l_partkey").alias("p_partkey"))
    return J.semi_join(t.part, back, ["p_partkey"]).select("p_partkey", "p_name")


def j07_days_before_last_order(t: Tables) -> DataFrame:
    last = t.orders.agg(F.max("o_orderdate").alias("last"))
    return J.with_global(t.orders, last).select("o_orderkey", F.datediff("last", "o_orderdate").cast("bigint").alias("days"))


def j08_last_order_of_customer(t: Tables) -> DataFrame:
    last = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderdate").alias("last_order"))
    return J.correlated_update(t.customer.select("c_custkey", F.lit(None).alias("last_order")), last, "c_custkey", "last_order")


def j09_units_of_each_period(t: Tables) -> DataFrame:
    start = D.month_start("o_orderdate")
    periods = t.orders.select(F.date_format("o_orderdate", "yyyy-MM").alias("period"), start.alias("start"),
                              F.add_months(start, 1).alias("end")).distinct()
    return J.interval_sum(t.lineitem, "l_shipdate", "l_quantity", periods, "start", "end", "period", "units")


def j10_similar_part_names(t: Tables) -> DataFrame:
    return J.fuzzy_top_k(t.part, "p_name", t.part.select(F.col("p_name").alias("other")), "other", k=5, min_score=50) \
        .select("p_name", "candidate", "score", F.col("rank").cast("bigint").alias("rank"))


def j11_best_name_in_brand(t: Tables) -> DataFrame:
    """Every part name written without its vowels, and the name of the same brand that it is most like."""
    asked = t.part.select("p_brand", F.regexp_replace("p_name", "[aeiou]", "").alias("p_name")).distinct()
    return J.fuzzy_best_in_block(asked, "p_name", t.part.select("p_brand", F.col("p_name").alias("other")), "other", ["p_brand"]) \
        .fillna({"match_score": 0})


def j12_parts_bought_together(t: Tables) -> DataFrame:
    p = J.pairwise_within(t.lineitem, ["l_orderkey"], "l_linenumber", ["l_partkey"])
    return p.groupBy("i", "j").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("l_partkey_i") == F.col("l_partkey_j")).alias("same_part"))


def j13_price_grid(t: Tables) -> DataFrame:
    grid = J.parameter_grid(t.spark, {"discount": (0.0, 0.3, 0.1), "factor": (1.0, 2.0, 0.5)})
    return t.part.crossJoin(F.broadcast(grid)).select("p_partkey", "discount", "factor", (
        F.col("p_retailprice") * F.col("factor") * (F.lit(1.0) - F.col("discount"))).alias("price"))


def j14_customer_nation(t: Tables) -> DataFrame:
    c = t.customer.select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    return J.lookup(c, t.nation.select("n_nationkey", "n_name"), "n_nationkey")


# Aggregates ---------------------------------------------------------------
def a01_lines_by_flag(t: Tables) -> DataFrame:
    q = F.col("l_quantity")
    return A.group_agg(t.lineitem, ["l_returnflag", "l_linestatus"], {"n": F.count(F.lit(1)), "qty": F.sum(q), "avg_qty": F.avg(q),
                                                                     "least": F.min("l_extendedprice"), "most": F.max("l_extendedprice")})


def a02_customers_by_priority(t: Tables) -> DataFrame:
    return A.count_distinct(t.orders, "o_custkey", ["o_orderpriority"])


def a03_flag_status_counts(t: Tables) -> DataFrame:
    return A.conditional_count_pivot(t.lineitem, "l_returnflag", "l_linestatus", ["F", "O"], prefix="n_")


def a05_return_rate(t: Tables) -> DataFrame:
    return A.flag_rate(t.lineitem.withColumn("back", F.col("l_returnflag") == "R"), ["l_linenumber"], "back")


def a06_status_shares(t: Tables) -> DataFrame:
    n = A.conditional_count_pivot(t.orders, "o_orderpriority", "o_orderstatus", ["F", "O", "P"], prefix="n_")
    return A.row_share(n, ["n_F", "n_O", "n_P"])


def a07_weighted_line_number(t: Tables) -> DataFrame:
    return A.weighted_mean(t.lineitem.withColumn("v", F.col("l_linenumber") * F.col("l_quantity")), ["l_returnflag"], "v", "l_quantity")


def a08_last_priority(t: Tables) -> DataFrame:
    return A.last_by_time(t.orders, ["o_custkey"], "o_orderpriority", F.struct("o_orderdate", "o_orderkey"))


def a09_usual_priority(t: Tables) -> DataFrame:
    return A.mode_per_key(t.orders, ["o_custkey"], ["o_orderpriority"])


def a10_first_priority(t: Tables) -> DataFrame:
    return A.first_non_null_two_sources(t.orders.where("o_orderstatus = 'P'"), t.orders, "o_custkey", ["o_orderpriority"], "o_orderkey")


def a11_priority_counts(t: Tables) -> DataFrame:
    return A.value_counts(t.orders, "o_orderpriority")


def a12_orders_of_customer(t: Tables) -> DataFrame:
    ids = A.collect_per_key(t.orders, ["o_custkey"], "o_orderkey")
    return ids.select("o_custkey", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))


def a13_quantity_price_r(t: Tables) -> DataFrame:
    return A.pearson_r(t.lineitem, "l_quantity", "l_extendedprice")


def a14_monthly_trend(t: Tables) -> DataFrame:
    return A.linear_trend(_monthly_lines(t), ["l_linenumber"], "qty", "month")


def a16_customer_profile(t: Tables) -> DataFrame:
    return A.profile(t.customer, ["c_custkey", "c_nationkey", "c_mktsegment"])


def a20_quantity_scalars(t: Tables) -> DataFrame:
    return A.global_scalars(t.lineitem, "l_quantity")


def a21_flag_means_and_overall(t: Tables) -> DataFrame:
    g = t.lineitem.groupBy("l_returnflag").agg(N.round_half_even(F.avg("l_quantity"), 2).alias("qty"))
    return A.with_overall_row(g, "l_returnflag", "qty")


def a22_priority_report(t: Tables) -> DataFrame:
    return A.group_agg(t.orders, ["o_orderpriority"], {"orders": F.count(F.lit(1)), "buyers": F.count_distinct("o_custkey"),
                                                      "last_order": F.max("o_orderdate")})


def a23_any_priority(t: Tables) -> DataFrame:
    return A.any_value_by(t.orders, ["o_custkey"], ["o_orderpriority", "o_orderstatus"], "o_orderkey")


# Windows ------------------------------------------------------------------
def w01_first_total_of_month(t: Tables) -> DataFrame:
    o = t.orders.withColumn("_t", F.struct("o_orderdate", "o_orderkey"))
    return W.first_in_period(o, ["o_custkey"], D.month_start("o_orderdate"), "o_totalprice", "_t")


def w02_previous_total(t: Tables) -> DataFrame:
    return W.lag_per_key(t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"), ["o_custkey"], ["o_orderdate", "o_orderkey"],
                         "o_totalprice")


def w03_monthly_change(t: Tables) -> DataFrame:
    return W.pct_change(_monthly_lines(t), ["l_linenumber"], ["month"], "qty")


def w04_previous_or_own_quantity(t: Tables) -> DataFrame:
    return W.previous_or_self(_monthly_lines(t), ["l_linenumber"], ["month"], "qty")


def w05_running_quantity(t: Tables) -> DataFrame:
    return W.running_total(_monthly_lines(t), ["l_linenumber"], ["month"], "qty")


def w06_quantity_of_month_before(t: Tables) -> DataFrame:
    return W.previous_month_total(_monthly_lines(t), ["l_linenumber"], "month", "qty")


def w07_scaled_balance(t: Tables) -> DataFrame:
    return W.min_max_scaled(t.customer.select("c_custkey", "c_acctbal"), "c_acctbal", "scaled", invert=True)


def w08_price_bins(t: Tables) -> DataFrame:
    return W.equal_width_bins(t.part.select("p_partkey", "p_type", "p_retailprice"), ["p_type"], "p_retailprice", 20, few_groups=True)


def w09_segments_by_balance(t: Tables) -> DataFrame:
    return W.relabel_by_mean(t.customer.select("c_custkey", "c_mktsegment", "c_acctbal"), "c_mktsegment", "c_acctbal")


def w10_customers_on_vehicles(t: Tables) -> DataFrame:
    return W.assign_vehicles(t.customer.select("c_custkey", "c_nationkey"), [F.asc("c_custkey")], 3, 5, ["c_nationkey"]).fillna({"vehicle": -1})


# Ordering and sets --------------------------------------------------------
def t01_top_parts(t: Tables) -> DataFrame:
    return O.top_n(t.lineitem.groupBy("l_partkey").agg(F.sum("l_quantity").alias("qty")), 10, [F.desc("qty"), F.asc("l_partkey")])


def t02_sorted_suppliers(t: Tables) -> DataFrame:
    return O.sort_mixed(t.supplier, [F.asc("s_nationkey"), F.desc("s_acctbal"), F.asc("s_suppkey")])


def t03_head_with_buffer(t: Tables) -> DataFrame:
    return O.head_with_buffer(t.orders, 6, 6, [F.desc("o_totalprice"), F.asc("o_orderkey")])


def t04_largest_order(t: Tables) -> DataFrame:
    return O.argmax_row(t.orders, "o_totalprice", ["o_orderkey"])


def t05_series_of_top_parts(t: Tables) -> DataFrame:
    return O.top_keys_series(t.lineitem, "l_partkey", 5, [D.month_start("l_shipdate").alias("month")],
                             [F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("qty")])


def t06_all_names(t: Tables) -> DataFrame:
    return O.union_all([t.customer.select(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")),
                        t.supplier.select(F.col("s_name").alias("name"))])


def t08_brands_and_types(t: Tables) -> DataFrame:
    return O.distinct_values(t.part, ["p_brand", "p_type"])


# Expressions --------------------------------------------------------------
def x01_date_parts(t: Tables) -> DataFrame:
    ts = "ts"
    return t.events.select("event_id", D.month_key(ts).alias("month_key"), D.day_of(ts).alias("day"), D.hour_of(ts).alias("hour"),
                           D.year_of(ts).alias("year"), D.month_of(ts).alias("month"), D.month_start(ts).alias("month_start"))


def x02_date_names(t: Tables) -> DataFrame:
    d = "o_orderdate"
    return t.orders.select("o_orderkey", D.month_abbr(d).alias("abbr"), D.month_name(d).alias("name"), D.month_year_label(d).alias("label"),
                           D.weekday_sun0(d).alias("weekday"), D.weekday_abbr(d).alias("weekday_name"))


def x03_month_numbers(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", D.month_number(D.month_name("o_orderdate")).alias("month"), D.month_number("o_orderpriority").isNull().alias("no_month"))


def x04_elapsed(t: Tables) -> DataFrame:
    a, b = "order_approved_at", "order_delivered_customer_date"
    return V.orders(t).select("order_id", D.elapsed_days(a, b).cast("double").alias("days"), D.elapsed_hours(a, b).alias("hours"))


def x05_moved_dates(t: Tables) -> DataFrame:
    d = "o_orderdate"
    return t.orders.select("o_orderkey", D.add_days(d, 45).alias("later"), D.add_months_overflow(d, -6).alias("half_year_before"),
                           D.before(d, "1998-01-01").alias("early"))


def x06_month_year_keys(t: Tables) -> DataFrame:
    return t.orders.groupBy(D.mm_yyyy("o_orderdate").alias("key")).agg(F.count(F.lit(1)).alias("n"))


def x07_seasons(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", D.season_of_day("o_orderdate").alias("by_day"), D.season_of_month(D.month_name("o_orderdate")).alias("by_month"))


def x08_cyclic_months(t: Tables) -> DataFrame:
    m = t.orders.select("o_orderkey", F.month("o_orderdate").alias("m")).withColumns({"sin": D.month_sin("m"), "cos": D.month_cos("m")})
    return m.select("o_orderkey", "sin", "cos", D.month_from_cyclic("sin", "cos").alias("month"))


def x09_quantity_classes(t: Tables) -> DataFrame:
    e = [0, 10, 20, 40]
    return t.lineitem.groupBy(N.cut("l_quantity", e).alias("right"), N.cut("l_quantity", e, right=False).alias("left")).agg(F.count(F.lit(1)).alias("n"))


def x10_balance_tiers(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", N.tier("c_acctbal", [0.0, 5000.0], ["low", "middle", "high"]).alias("tier"))


def x11_distance_to_warehouse(t: Tables) -> DataFrame:
    lat, lon = (lambda k: F.lit(-30.0) + k * F.lit(0.75)), (lambda k: F.lit(-60.0) + k * F.lit(0.5))
    j = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    c, s = F.col("c_nationkey"), F.col("o_orderkey") % 25
    return j.select("o_orderkey", N.haversine_km(lat(c), lon(c), lat(s), lon(s)).alias("km"))


def x12_rounded(t: Tables) -> DataFrame:
    v = F.col("o_totalprice") / F.lit(7.0)
    return t.orders.select("o_orderkey", N.round_half_even(v, 2).alias("even"), N.round_half_away(v, 2).alias("away"))


def x13_safe_arithmetic(t: Tables) -> DataFrame:
    d = (F.col("p_size") % 5).cast("double")
    return t.part.select("p_partkey", N.safe_div("p_retailprice", d).alias("ratio"), N.div_or_zero("p_retailprice", d).alias("ratio_or_zero"),
                         N.clamp_low(F.col("p_retailprice") - 1000.0).alias("above"))


def x14_clean_texts(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.md5(X.strip_accents("text").cast("binary")).alias("plain"), X.clean_name("source").alias("source"))


def x15_regex_steps(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", X.regex_steps("p_name", [("[aeiou]+", "*"), (" +", "_"), (r"\*$", "")]).alias("name"))


def x16_keyword_rules(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", X.first_keyword_rule("p_name", [("SMALL", 1), ("ring", 2), ("red", 3)]).cast("bigint").alias("rule")).fillna({"rule": 0})


def x17_title_and_message(t: Tables) -> DataFrame:
    title = F.when(F.col("doc_id") % 3 != 0, F.col("source"))
    return t.documents.select("doc_id", F.md5(X.concat_title_message(title, "text").cast("binary")).alias("joined"))


def x18_name_numbers(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", X.extract_number("c_name", "Customer#").alias("number"), X.strip_prefix("c_name", "Customer#").alias("rest"))


def x19_token_counts(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.size(X.tokens("text")).cast("bigint").alias("n_tokens"))


def x20_event_parameters(t: Tables) -> DataFrame:
    return t.events.select("event_id", P.json_map("props", "bigint")["k"].alias("k"))


def x21_calendar_spine(t: Tables) -> DataFrame:
    m = t.orders.select(D.month_start("o_orderdate").alias("month")).distinct()
    days = m.select("month", F.explode(D.days_of_month("month")).alias("day"))
    per_day = t.orders.groupBy(D.day_of("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return J.left_join(days, per_day, "day").fillna({"n": 0})


QUERIES = {k: v for k, v in list(globals().items()) if k[0] in "sfjawtx" and k[1:3].isdigit() and callable(v)}
