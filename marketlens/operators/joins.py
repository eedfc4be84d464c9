"""Joins (J-01 .. J-14).

Equi-joins are left to the planner: sort-merge or shuffle-hash for large
sides, broadcast when AQE measures a side under the threshold. Explicit
broadcast hints are only given to frames whose size is bounded by
construction (one-row aggregates, fixed lookup tables, per-key top-k).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def inner_join(left: DataFrame, right: DataFrame, on) -> DataFrame:              # J-01
    return left.join(right, on, "inner")


def left_join(left: DataFrame, right: DataFrame, on) -> DataFrame:               # J-02
    return left.join(right, on, "left")


def star_join(fact: DataFrame, dims: Sequence[tuple[DataFrame, object]]) -> DataFrame:  # J-03
    out = fact
    for dim, on in dims:
        out = out.join(dim, on, "inner")
    return out


def anti_join_range(left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str,
                    right_ts: str, lo: Column, hi: Column) -> DataFrame:           # J-04
    """Rows of ``left`` with no ``right`` row on the same keys whose time lies in
    (left_ts + lo, left_ts + hi]. The equi part keeps it a hash/sort-merge anti join."""
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], F.col(right_ts).alias("_r_ts"))
    cond = None
    for k in keys:
        e = left[k] == r[f"_r_{k}"]
        cond = e if cond is None else cond & e
    cond = cond & (r["_r_ts"] > lo) & (r["_r_ts"] <= hi)
    return left.join(r, cond, "left_anti")


def anti_join_keys(left: DataFrame, right: DataFrame, keys: Sequence[str],
                   null_safe: bool = False) -> DataFrame:                          # J-05
    if not null_safe:
        return left.join(right.select(*keys).distinct(), list(keys), "left_anti")
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys]).distinct()
    cond = None
    for k in keys:
        e = left[k].eqNullSafe(r[f"_r_{k}"])
        cond = e if cond is None else cond & e
    return left.join(r, cond, "left_anti")


def semi_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:  # J-06
    return left.join(right.select(*keys), list(keys), "left_semi")


def with_global(df: DataFrame, one_row: DataFrame) -> DataFrame:                    # J-07
    """Cross join with a one-row aggregate (size 1 by construction: broadcast)."""
    return df.crossJoin(F.broadcast(one_row))


def correlated_update(target: DataFrame, source_agg: DataFrame, key: str,
                      col: str) -> DataFrame:                                      # J-08
    """SET col = (scalar subquery per key): aggregate + left join; no match -> null."""
    return target.drop(col).join(source_agg.select(key, col), key, "left")


def interval_sum(events: DataFrame, day_col: str, value_col: str, ranges: DataFrame,
                 start: str, end: str, range_key: str, out: str = "period_sales") -> DataFrame:  # J-09
    """Sum of ``value_col`` of ``events`` whose day lies in each [start, end] range.

    The events are first reduced to one row per day (map-side partial
    aggregation), then each range is exploded to its days and equi-joined on
    the day: a hash join, not a nested loop. Ranges with no sales get 0.
    """
    daily = events.groupBy(F.to_date(F.col(day_col)).alias("_day")).agg(F.sum(value_col).alias("_v"))
    days = ranges.select(range_key, F.explode(F.sequence(F.col(start), F.col(end))).alias("_day"))
    s = days.join(daily, "_day", "left").groupBy(range_key).agg(
        F.coalesce(F.sum("_v"), F.lit(0.0)).alias(out))
    return ranges.join(s, range_key, "left")


def fuzzy_ratio(a: Column, b: Column) -> Column:
    """Levenshtein similarity in 0..100: round(100 * (1 - d / max_len))."""
    d = F.levenshtein(a, b)
    m = F.greatest(F.length(a), F.length(b))
    return F.when(m == 0, F.lit(100)).otherwise(
        F.round((F.lit(1.0) - d / m) * 100).cast("bigint"))


def _bigrams(text: Column) -> Column:
    """The pairs of neighbouring characters of a text with a mark before and after it, equal ones numbered: length + 1 of them."""
    padded = F.concat(F.lit("\x01"), text, F.lit("\x01"))
    grams = F.transform(F.sequence(F.lit(1), F.length(text) + 1), lambda i: F.substring(padded, i, F.lit(2)))
    return F.transform(grams, lambda g, i: F.concat(F.size(F.filter(F.slice(grams, 1, i + 1), lambda x: x == g)).cast("string"), g))


def _shared_gram_pairs(q: DataFrame, c: DataFrame, block: Sequence[str], common) -> DataFrame:
    """(block, _q, _c) of the pairs that share one of their rarest bigrams; ``common`` gives how many bigrams two texts must
    share that can be alike, by the length of one. Of a text's n bigrams any n - common + 1 hold one that both have."""
    each = lambda df, name: df.select(*block, F.col(name), F.explode(_bigrams(F.col(name))).alias("_g"))
    qg, cg = each(q, "_q"), each(c, "_c")
    often = qg.select(*block, "_g").unionByName(cg.select(*block, "_g")).groupBy(*block, "_g").agg(F.count(F.lit(1)).alias("_n"))

    def rarest(grams: DataFrame, name: str) -> DataFrame:
        w = Window.partitionBy(*block, name).orderBy("_n", "_g")               # the bigrams of one text
        n = F.length(name)
        return grams.join(often, [*block, "_g"]).withColumn("_k", F.row_number().over(w)).where(
            F.col("_k") <= n + 2 - F.greatest(common(n), F.lit(1))).select(*block, name, "_g")

    return rarest(qg, "_q").join(rarest(cg, "_c"), [*block, "_g"]).select(*block, "_q", "_c").distinct()


def fuzzy_top_k(queries: DataFrame, q_col: str, candidates: DataFrame, c_col: str,
                k: int = 5, min_score: int = 50, block: Sequence[str] = ()) -> DataFrame:  # J-10
    """Best k candidates with score >= min_score per query value.

    No cross product. A score >= s (a rounded value, so s - 0.5 before rounding) allows
    d = (1 - s / 100) * m edits for the longer length m. Each edit spoils two of the m + 1
    padded bigrams, so the texts share at least m + 1 - 2 d of them, and pairs come from an
    equi-join on (block, bigram) over each text's rarest ones. Where that number is below
    one (long texts at a low score) an equi-join on the lengths that can reach each other
    takes over. Both are exact: no pair that can reach the threshold is skipped.
    """
    q = queries.select(*block, F.col(q_col).alias("_q")).where("_q IS NOT NULL").distinct()
    c = candidates.select(*block, F.col(c_col).alias("_c")).where("_c IS NOT NULL").distinct()
    need = (min_score - 0.5) / 100.0 - 1e-9
    slope = 2.0 * need - 1.0
    longest = F.greatest(F.length("_q"), F.length("_c"))
    near = F.least(F.length("_q"), F.length("_c")) >= F.lit(need) * longest
    common = lambda m: F.ceil(m * F.lit(slope) + F.lit(1.0 - 1e-9)).cast("int")
    pairs = None
    if need > 0:
        worst = common if slope >= 0 else lambda n: common(n / F.lit(need))     # the partner that allows most edits
        pairs = _shared_gram_pairs(q, c, block, worst).where(near & (common(longest) >= 1))
    if slope < 0:
        lq, lc = (df.select(*block, F.length(x).alias(n)).distinct() for df, x, n in ((q, "_q", "_lq"), (c, "_c", "_len")))
        both = lq.join(lc, list(block)) if block else lq.crossJoin(lc)          # lengths only
        m = F.greatest("_lq", "_len")
        reach = both.where((F.least("_lq", "_len") >= F.lit(need) * m) & ((common(m) < 1) if need > 0 else F.lit(True)))
        by_length = q.withColumn("_lq", F.length("_q")).join(reach, [*block, "_lq"]).join(
            c.withColumn("_len", F.length("_c")), [*block, "_len"]).select(*block, "_q", "_c")
        pairs = by_length if pairs is None else pairs.unionByName(by_length)
    scored = pairs.withColumn("score", fuzzy_ratio(F.col("_q"), F.col("_c"))).where(
        F.col("score") >= min_score)
    w = Window.partitionBy(*block, "_q").orderBy(F.desc("score"), F.asc("_c"))
    return (scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .withColumnRenamed("_q", q_col).withColumnRenamed("_c", "candidate"))


def fuzzy_best_in_block(queries: DataFrame, q_col: str, candidates: DataFrame, c_col: str,
                        block: Sequence[str], min_score: int = 50,
                        out: str = "match") -> DataFrame:                         # J-11
    """Best candidate inside the same block (e.g. country); ties by name."""
    best = fuzzy_top_k(queries, q_col, candidates, c_col, k=1, min_score=min_score, block=block)
    best = best.select(*block, q_col, F.col("candidate").alias(out), F.col("score").alias(f"{out}_score"))
    return queries.join(best, [*block, q_col], "left")


def pairwise_within(df: DataFrame, block: Sequence[str], node: str,
                    cols: Sequence[str]) -> DataFrame:                            # J-12
    """All ordered pairs of nodes inside each block (i, j both directions, i == j
    included). Blocks must be bounded upstream (select_deliveries caps them)."""
    a = df.select(*block, F.col(node).alias("i"), *[F.col(c).alias(f"{c}_i") for c in cols])
    b = df.select(*block, F.col(node).alias("j"), *[F.col(c).alias(f"{c}_j") for c in cols])
    return a.join(b, list(block), "inner")


def parameter_grid(spark, ranges: dict[str, tuple[float, float, float]]) -> DataFrame:  # J-13
    """Cartesian product of value ranges (start, stop inclusive, step)."""
    out = None
    for name, (lo, hi, step) in ranges.items():
        n = int(round((hi - lo) / step)) + 1
        f = spark.range(n).select((F.lit(lo) + F.col("id") * F.lit(step)).alias(name))
        out = f if out is None else out.crossJoin(f)
    return out


def lookup(df: DataFrame, table: DataFrame, key: str) -> DataFrame:               # J-14
    return df.join(table, key, "left")
