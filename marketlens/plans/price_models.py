"""Price trees, their errors, and scenarios (P-11 .. P-15).

Trees come in two kinds: MLlib's (P-11, binned splits, categories by index) and the exact variance split (P-12). The
scenario grid is never held: each task numbers its scenarios, decodes their values from the number, scores them and
keeps the best, so 4 million scenarios cost one partial aggregate.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.operators import trees as TR
from marketlens.plans import pricing as P
from marketlens.session import checkpoint_dir, cut_lineage
from marketlens.sources.tables import Tables

TEST_ONE_IN, SEED, DEPTH = 5, 42, 4
#: Features of an order item that its price is split by.
ITEM_FEATURES = ("item_discount", "discount_rate", "quantity", "price_before_discount", "price_bins")
OWN = ("price_bins", "own_avg_item_discount", "own_avg_item_discount_rate", "own_demand")
MARKET = ("market_product_demand", "market_price_before_discount", "market_avg_discount_rate")
CATEGORIES = ("product_category", "seasonality", "price_elasticity")
#: Least absolute price that an error is divided by.
LEAST_PRICE = 2.0 ** -52


# P-12 ---------------------------------------------------------------------
def item_splits(t: Tables) -> DataFrame:
    """The best split of the order items' final price by each feature, and which feature's is the best of all."""
    rows = P._own_rows(t).select(*ITEM_FEATURES, "final_price", F.lit(1).alias("_node"))
    best = TR.best_splits(TR.split_candidates(rows, ITEM_FEATURES, "final_price", "_node"), "feature")
    best = cut_lineage(best)                                  # a row for each feature
    top = best.agg(F.max_by("feature", F.struct("reduction", -F.col("feature"))).alias("_top"))
    names = F.array(*[F.lit(f) for f in ITEM_FEATURES])
    return best.crossJoin(F.broadcast(top)).select(
        names[F.col("feature")].alias("feature"), "threshold", "reduction", "n_left", "mean_left", "n_right", "mean_right",
        (F.col("feature") == F.col("_top")).alias("chosen"))


def item_tree(t: Tables) -> DataFrame:
    """The nodes of the tree of the order items' final price."""
    return TR.tree_frame(t.spark, TR.variance_tree(P._own_rows(t), ITEM_FEATURES, "final_price", DEPTH))


# P-13 ---------------------------------------------------------------------
def regression_errors(scored: DataFrame, label: str, prediction: str, *by: str) -> DataFrame:
    """Rows, mean absolute error and mean absolute error as a share of the label, of the rows with both values."""
    e = F.abs(F.col(label) - F.col(prediction))
    both = scored.where(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    return both.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.avg(e).alias("mae"),
                                 F.avg(e / F.greatest(F.abs(F.col(label)), F.lit(LEAST_PRICE))).alias("mape"))


def market_price_errors(t: Tables) -> DataFrame:
    """How far the market's price is from the own price of the same category, month and bin, for each category."""
    return regression_errors(P.merge_market(t).where("market_price_before_discount > 0"), "own_price_before", "market_price_before_discount",
                             "product_category")


# P-11 ---------------------------------------------------------------------
def split_by_hash(df: DataFrame, *keys: str) -> tuple[DataFrame, DataFrame]:
    """(train, test): four fifths and one fifth by a hash of the keys."""
    test = F.pmod(F.xxhash64(*keys, F.lit(SEED)), F.lit(TEST_ONE_IN)) == 0
    return df.where(~test), df.where(test)


def fit_price_tree(train: DataFrame, numbers: Sequence[str], categories: Sequence[str], label: str = "final_price", depth: int = DEPTH):
    """MLlib pipeline: categories by index (unknown ones apart), one vector, a regression tree; written and read again."""
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.feature import StringIndexer, VectorAssembler
    from pyspark.ml.regression import DecisionTreeRegressor
    codes = [f"{c}_code" for c in categories]
    stages = [StringIndexer(inputCols=list(categories), outputCols=codes, handleInvalid="keep", stringOrderType="alphabetAsc")] if categories else []
    stages += [VectorAssembler(inputCols=[*numbers, *codes], outputCol="features", handleInvalid="keep"),
               DecisionTreeRegressor(labelCol=label, maxDepth=depth, seed=SEED, maxBins=64)]
    path = f"{checkpoint_dir(train.sparkSession).rstrip('/')}/price-tree-{uuid.uuid4().hex}"
    Pipeline(stages=stages).fit(train).write().save(path)
    return PipelineModel.load(path)


def price_tree_report(t: Tables) -> DataFrame:
    """Errors on the held-out fifth of trees of the own features and of own and market features."""
    rows = cut_lineage(P.merge_market(t))
    train, test = split_by_hash(rows, "order_date", "product_category", "price_bins")
    out = None
    for name, numbers in (("own", OWN), ("own and market", OWN + MARKET)):
        model = fit_price_tree(train, numbers, CATEGORIES)
        found = regression_errors(model.transform(test), "final_price", "prediction").select(
            F.lit(name).alias("features"), F.lit(model.stages[-1].depth).alias("depth"), F.lit(model.stages[-1].numNodes).alias("nodes"), "n", "mae", "mape")
        out = found if out is None else out.unionByName(found)
    return out


# Scenarios ----------------------------------------------------------------
def scenario_grid(spark: SparkSession, axes: Mapping[str, Sequence], partitions: int | None = None) -> DataFrame:
    """Every combination of the axes' values, numbered in the order of nested loops (the last axis turns fastest)."""
    total = math.prod(len(v) for v in axes.values())
    return _decoded(spark.range(0, total, 1, partitions) if partitions else spark.range(total), "scenario", axes)


def _values(values: Sequence) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _decoded(numbers: DataFrame, name: str, axes: Mapping[str, Sequence]) -> DataFrame:
    stride, cols = 1, {}
    for axis, values in reversed(list(axes.items())):
        cols[axis] = F.get(_values(values), F.pmod(F.call_function("div", F.col("id"), F.lit(stride)), F.lit(len(values))).cast("int"))
        stride *= len(values)
    return numbers.select(F.col("id").alias(name), *[cols[a].alias(a) for a in axes])


def sampled_scenarios(spark: SparkSession, axes: Mapping[str, Sequence], n: int, seed: int = SEED) -> DataFrame:
    """n scenarios, each axis's value drawn by a hash of the seed, the scenario's number and the axis."""
    return spark.range(n).select(F.col("id").alias("scenario"), *[
        F.get(_values(v), F.pmod(F.xxhash64(F.lit(seed), F.col("id"), F.lit(a)), F.lit(len(v))).cast("int")).alias(a) for a, v in axes.items()])


def best_scenario(grid: DataFrame, price: Column) -> DataFrame:
    """The scenario of the largest price x demand x discount rate; of equal ones the first."""
    scored = grid.withColumn("predicted_price", price)
    scored = scored.withColumn("predicted_revenue", F.col("predicted_price") * F.col("own_demand") * F.col("own_avg_item_discount_rate"))
    return scored.where("predicted_revenue IS NOT NULL").agg(
        F.max_by(F.struct(*scored.columns), F.struct("predicted_revenue", -F.col("scenario"))).alias("_b")).where("_b IS NOT NULL").select("_b.*")


# The ranges of the scenarios.
PRODUCT_AXES = {
    "own_avg_item_discount": [5 + i * 0.5 for i in range(20)],
    "own_avg_item_discount_rate": [i / 100.0 for i in range(2, 10)],
    "own_demand": list(range(100, 1000, 100)),
    "ped": [float(i) for i in range(-20, 20, 5)],
    "market_demand": list(range(100, 1000, 100)),
    "market_avg_discount_rate": [i / 100.0 for i in range(2, 10)],
    "season_code": list(range(5)),
}
CATEGORY_AXES = {
    "price_bins": list(range(20)),
    "own_avg_item_discount": [float(i) for i in range(0, 2000, 100)],
    "own_avg_item_discount_rate": [i / 100.0 for i in range(2, 10)],
    "own_demand": [float(i) for i in range(100, 1000, 100)],
    "market_product_demand": list(range(100, 1000, 100)),
    "market_price_before_discount": [float(i) for i in range(10, 800, 50)],
    "market_avg_discount_rate": [i / 100.0 for i in range(2, 10)],
    "product_category": sorted(P.CATEGORY_ELASTICITY),
    "seasonality": P.SEASON_LEVELS,
    "price_elasticity": P.ELASTICITY_LEVELS,
}
SAMPLE = 10


def price_scenarios(t: Tables, sample: int = SAMPLE) -> DataFrame:                   # P-14
    """Sampled scenarios with the price that the tree of own and market features predicts."""
    train, _ = split_by_hash(cut_lineage(P.merge_market(t)), "order_date", "product_category", "price_bins")
    model = fit_price_tree(train, OWN + MARKET, CATEGORIES)
    scored = model.transform(sampled_scenarios(t.spark, CATEGORY_AXES, sample))
    return scored.select("scenario", *CATEGORY_AXES, F.col("prediction").alias("predicted_price"))


def max_revenue_by_rule(t: Tables) -> DataFrame:                                     # P-15
    """The best scenario at the product's mean unit price, lowered by the scenario's rate and its discount, and raised by a
    hundredth for each season code; the mean, of all its order rows, is one row."""
    o = P.V.order_data(t, "product_name", "sales", "order_item_quantity").where(F.col("product_name") == P.SINGLE_PRODUCT)
    unit = F.try_divide("sales", "order_item_quantity")
    base = F.broadcast(o.agg(F.round(F.avg(unit), 2).alias("base")))
    price = (F.col("base") * (F.lit(1.0) - F.col("own_avg_item_discount_rate")) - F.col("own_avg_item_discount")) * (
        F.lit(1.0) + F.col("season_code") / F.lit(100.0))
    return best_scenario(scenario_grid(t.spark, PRODUCT_AXES).crossJoin(base), price).drop("base")


def max_revenue_by_tree(t: Tables) -> DataFrame:                                     # P-15
    """The best scenario at the price that the exact tree of the product's months and the market's predicts."""
    names = {"avg_unit_discount": "own_avg_item_discount", "avg_discount_rate": "own_avg_item_discount_rate", "demand": "own_demand"}
    rows = P.merge_product_market(t).withColumnsRenamed(names)
    tree = TR.variance_tree(rows, list(PRODUCT_AXES), "avg_unit_price", DEPTH)
    price = TR.predict_tree(tree) if tree else F.lit(None).cast("double")
    return best_scenario(scenario_grid(t.spark, PRODUCT_AXES), price)


QUERIES = {
    "p11_fit_price_tree": price_tree_report,
    "p12_variance_split": item_splits,
    "p12_variance_tree": item_tree,
    "p13_regression_errors": market_price_errors,
    "p14_price_scenarios": price_scenarios,
    "p15_max_revenue_scenario": max_revenue_by_rule,
    "p15_max_revenue_tree": max_revenue_by_tree,
}
