"""Registry of the named queries: one per operator id of SURVEY section 2.

Every entry reads the driver tables of a scale-factor folder and returns a
lazy DataFrame. ``finalize`` rounds double columns to 6 decimals (and turns
-0.0 into 0.0) so results compare across engines whose float sums differ in
the last bits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlens.plans import (basics, customers, forecasting, fulfilment, generic, inventory, lifetime, marketing,
                              price_models, pricing, reviews, sales, sentiment, supply)
from marketlens.sources.tables import load_tables

PLAN_MODULES = [sales, customers, lifetime, marketing, reviews, sentiment, supply, inventory, forecasting, pricing, price_models,
                fulfilment, generic, basics]


def finalize(df: DataFrame, digits: int = 6) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append((F.round(F.col(f.name), digits) + F.lit(0.0)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def all_plans() -> dict[str, Callable]:
    out: dict[str, Callable] = {}
    for m in PLAN_MODULES:
        out.update(m.QUERIES)
    return out


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return finalize(fn(load_tables(spark, sf_dir)))
        run.__name__ = getattr(fn, "__name__", "query")
        return run
    return {name: bind(fn) for name, fn in all_plans().items()}
