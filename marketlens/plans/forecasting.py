"""Demand model and 12-month forecast (I-03, I-05).

A product enters the model by its level, the mean of its earlier months, and not by a column for each product, so
that the feature vector doesn't grow with the catalogue. Training, folds and scores are MLlib's; folds and the held-out
month depend on the rows alone, not on how they are partitioned.

The forecast is a recursion: a month's rounded prediction is the next month's previous quantity. It needs nothing of
other products, so a product's twelve months are steps over one row, without a join or a shuffle between them; the
lineage is cut every few steps.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlens.functions import dates as X
from marketlens.plans.inventory import FORECAST_YEAR, annual_demand, demand_features, eoq_rop, monthly_demand
from marketlens.session import checkpoint_dir, cut_lineage
from marketlens.sources.tables import Tables

FEATURES = ("prev_quantity", "level", "month_sin", "month_cos")
#: Settings tried by the registered query; any of MLlib's parameters may be given.
GRID = {"maxDepth": (2, 3), "maxIter": (10,), "stepSize": (0.2,)}
FOLDS, SEED = 5, 42
#: Months between two cuts of the lineage.
CUT_MONTHS = 4


def training_frame(t: Tables, year: int = FORECAST_YEAR) -> DataFrame:
    """I-02's rows with the level (mean of the product's earlier months) and the fold; at most 13 months a product."""
    m = monthly_demand(t, year)
    earlier = Window.partitionBy("product_id").orderBy("order_year", "order_month").rowsBetween(Window.unboundedPreceding, -1)
    level = m.select("product_id", "order_year", "order_month", F.avg("total_quantity").over(earlier).alias("level"))
    keys = ["product_id", "order_year", "order_month"]
    fold = F.pmod(F.xxhash64(*keys), F.lit(FOLDS)).cast("int")
    return demand_features(t, year).join(level, keys).withColumn("fold", fold)


def held_out(year: int = FORECAST_YEAR):
    """The last month of the training year."""
    return (F.col("order_year") == year - 1) & (F.col("order_month") == 12)


def _assembled(df: DataFrame) -> DataFrame:
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features", handleInvalid="keep").transform(df)


def r_squared(scored: DataFrame, label: str = "total_quantity", prediction: str = "prediction") -> float | None:
    """1 - squared errors over squared deviations; None without rows or without variance."""
    y, e = F.col(label), F.col(label) - F.col(prediction)
    s = scored.agg(F.sum(e * e).alias("e"), (F.var_pop(y) * F.count(y)).alias("d")).first()
    return 1.0 - s["e"] / s["d"] if s["d"] else None


def fit_demand(train: DataFrame, grid: Mapping[str, Sequence] | None = None, folds: int = FOLDS):
    """(gradient-boosted trees of the best setting by R2 over the folds, [(setting, mean R2)]); without a grid MLlib's
    own setting, fitted once. ``train`` has FEATURES, total_quantity and fold."""
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.regression import GBTRegressor
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
    rows = cut_lineage(_assembled(train).select("features", "total_quantity", "fold"))
    model = GBTRegressor(labelCol="total_quantity", seed=SEED)
    if not grid:
        return model.setMaxIter(10).setMaxDepth(3).fit(rows), []
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(getattr(model, name), list(values))
    settings = builder.build()
    best = CrossValidator(estimator=model, estimatorParamMaps=settings, evaluator=RegressionEvaluator(labelCol="total_quantity", metricName="r2"),
                          numFolds=folds, foldCol="fold", parallelism=2).fit(rows)
    return best.bestModel, [({p.name: v for p, v in s.items()}, r2) for s, r2 in zip(settings, best.avgMetrics, strict=True)]


def save_model(model, spark) -> str:
    """Writes the model beside the cluster's checkpoints; its path."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/demand-model-{uuid.uuid4().hex}"
    model.write().save(path)
    return path


def load_model(path: str):
    from pyspark.ml.regression import GBTRegressionModel
    return GBTRegressionModel.load(path)


def predictor(model) -> Callable[[DataFrame], DataFrame]:
    """A function that adds the prediction of rows with FEATURES."""
    return lambda rows: model.transform(_assembled(rows)).drop("features")


def fit_report(t: Tables, year: int = FORECAST_YEAR, grid: Mapping[str, Sequence] = GRID) -> DataFrame:          # I-03
    """A row for each setting: mean R2 over the folds, whether it was chosen, and the R2 of the chosen model, written and
    read again, on its training months and on the held-out month."""
    frame = cut_lineage(training_frame(t, year))
    train = frame.where(~held_out(year))
    model, tried = fit_demand(train, grid)
    score = predictor(load_model(save_model(model, t.spark)))
    inside, outside = r_squared(score(train)), r_squared(score(frame.where(held_out(year))))
    best = max(range(len(tried)), key=lambda i: tried[i][1])
    rows = [(i, *(float(s[k]) for k in grid), float(r2), i == best, inside if i == best else None, outside if i == best else None)
            for i, (s, r2) in enumerate(tried)]
    names = ", ".join(f"{k} double" for k in grid)
    return t.spark.createDataFrame(rows, f"setting int, {names}, cv_r2 double, chosen boolean, train_r2 double, held_out_r2 double")


def last_known(t: Tables, year: int = FORECAST_YEAR) -> DataFrame:
    """(product_id, prev_quantity, level): where a product's recursion starts."""
    m = monthly_demand(t, year)
    return m.groupBy("product_id").agg(F.max_by("total_quantity", F.struct("order_year", "order_month")).cast("double").alias("prev_quantity"),
                                       F.avg("total_quantity").alias("level"))


def forecast_demand(start: DataFrame, predict: Callable[[DataFrame], DataFrame], year: int = FORECAST_YEAR) -> DataFrame:   # I-05
    """(product_id, order_year, order_month, predicted_quantity): twelve rows for each product. ``predict`` adds a column
    ``prediction`` to rows with FEATURES; predictions are rounded half to even."""
    rows = start.select("product_id", "prev_quantity", "level", F.lit(None).cast("array<double>").alias("done"))
    rows = rows.withColumn("done", F.array().cast("array<double>"))
    for month in range(1, 13):
        m = F.lit(month)
        rows = predict(rows.withColumns({"month_sin": X.month_sin(m), "month_cos": X.month_cos(m)}))
        rows = rows.withColumn("next", F.rint("prediction") + F.lit(0.0))
        rows = rows.select("product_id", F.col("next").alias("prev_quantity"), "level", F.concat("done", F.array("next")).alias("done"))
        if month % CUT_MONTHS == 0:
            rows = cut_lineage(rows)
    return rows.select("product_id", F.posexplode("done").alias("m", "predicted_quantity")).select(
        "product_id", F.lit(year).cast("bigint").alias("order_year"), (F.col("m") + 1).cast("bigint").alias("order_month"), "predicted_quantity")


def demand_forecast(t: Tables, year: int = FORECAST_YEAR) -> DataFrame:
    """The year's forecast by a model of all training months."""
    model, _ = fit_demand(training_frame(t, year))
    return forecast_demand(last_known(t, year), predictor(model), year)


def forecast_eoq_rop(t: Tables, year: int = FORECAST_YEAR) -> DataFrame:
    """I-06 and I-07 over the forecast."""
    return eoq_rop(t, annual_demand(t, demand_forecast(t, year), year))


QUERIES = {
    "i03_fit_demand": fit_report,
    "i05_forecast_demand": demand_forecast,
    "i07_forecast_eoq_rop": forecast_eoq_rop,
}
