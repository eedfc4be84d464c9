"""Sources and sinks (S-01 .. S-09).

Every read declares its schema; nothing is inferred. Writers are plain
DataFrameWriter calls: on a cluster the target is a shared path or a catalog
table, never a machine-local folder.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

L, I, D, S = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType()
TS = T.TimestampNTZType()


def _schema(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Declared schemas of the driver tables (parquet physical types).
SCHEMAS: dict[str, T.StructType] = {
    "region": _schema(("r_regionkey", I), ("r_name", S)),
    "nation": _schema(("n_nationkey", I), ("n_name", S), ("n_regionkey", I)),
    "customer": _schema(("c_custkey", L), ("c_name", S), ("c_nationkey", I),
                        ("c_acctbal", D), ("c_mktsegment", S)),
    "supplier": _schema(("s_suppkey", L), ("s_name", S), ("s_nationkey", I), ("s_acctbal", D)),
    "part": _schema(("p_partkey", L), ("p_name", S), ("p_brand", S), ("p_type", S),
                    ("p_size", I), ("p_retailprice", D)),
    "orders": _schema(("o_orderkey", L), ("o_custkey", L), ("o_orderstatus", S),
                      ("o_totalprice", D), ("o_orderdate", TS), ("o_orderpriority", S)),
    "lineitem": _schema(("l_orderkey", L), ("l_partkey", L), ("l_suppkey", L),
                        ("l_linenumber", I), ("l_quantity", D), ("l_extendedprice", D),
                        ("l_discount", D), ("l_tax", D), ("l_returnflag", S),
                        ("l_linestatus", S), ("l_shipdate", TS)),
    "events": _schema(("event_id", L), ("ts", TS), ("user_id", L), ("event_type", S),
                      ("value", D), ("props", S)),
    "documents": _schema(("doc_id", L), ("text", S), ("lang", S), ("source", S), ("n_chars", L)),
    "labels": _schema(("doc_id", L), ("quality", I), ("toxic", I)),
    "embeddings": _schema(("vec_id", L), ("embedding", T.ArrayType(T.FloatType())), ("label", I)),
    "pages": _schema(("page_id", L), ("url", S), ("html", S)),
    "benchmark": _schema(("item_id", L), ("text", S)),
    "conversations": _schema(("conv_id", L), ("turn", L), ("role", S), ("text", S)),
}

TABLE_NAMES = tuple(SCHEMAS)


# S-01 ---------------------------------------------------------------------
def read_table(spark: SparkSession, base: str, name: str,
               schema: T.StructType | None = None) -> DataFrame:
    """Whole-table load of a named parquet table with a declared schema."""
    schema = schema or SCHEMAS.get(name)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(f"{base.rstrip('/')}/{name}.parquet")


class Tables:
    """Lazy accessor: ``t.orders`` reads ``orders.parquet`` once per instance."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in SCHEMAS:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = read_table(self.spark, self.base, name)
        return self._cache[name]

    def register_views(self, names: Iterable[str] = TABLE_NAMES) -> None:
        for n in names:
            getattr(self, n).createOrReplaceTempView(n)


def load_tables(spark: SparkSession, base: str) -> Tables:
    return Tables(spark, base)


# S-02 ---------------------------------------------------------------------
def read_query(spark: SparkSession, sql: str, views: dict[str, DataFrame] | None = None,
               **params) -> DataFrame:
    """Parameterised SQL over temp views; values are bound, never spliced."""
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)
    return spark.sql(sql, args=params or None)


# S-03 ---------------------------------------------------------------------
def read_csv(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",") -> DataFrame:
    """Header CSV with an explicit schema (no inference pass over the data)."""
    return (spark.read.schema(schema).option("header", True).option("sep", sep)
            .option("mode", "PERMISSIVE").csv(path))


def _path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(jpath))


# S-04 ---------------------------------------------------------------------
def load_or_build(spark: SparkSession, path: str, builder: Callable[[], DataFrame]) -> DataFrame:
    """Use the materialised parquet at ``path`` if present, else build and write it."""
    if not _path_exists(spark, path):
        builder().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


# S-05 ---------------------------------------------------------------------
def write_table(df: DataFrame, target: str, partition_by: list[str] | None = None,
                as_table: bool = False) -> None:
    """Replace a table: catalog table when ``as_table``, else a parquet path."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if as_table:
        w.saveAsTable(target)
    else:
        w.parquet(target)


# S-06 ---------------------------------------------------------------------
def write_csv(df: DataFrame, path: str, single_file: bool = False, sep: str = ",") -> None:
    """Result as header CSV. ``single_file`` only for report-sized results."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)


# S-07 ---------------------------------------------------------------------
def export_bundle(frames: dict[str, DataFrame], base: str, fmt: str = "parquet") -> dict[str, str]:
    """Write many named result frames, one folder each; frames stay lazy until here."""
    paths = {}
    for name, df in frames.items():
        p = f"{base.rstrip('/')}/{name}"
        if fmt == "csv":
            write_csv(df, p)
        else:
            df.write.mode("overwrite").parquet(p)
        paths[name] = p
    return paths


# S-08 ---------------------------------------------------------------------
def missing_keys(new: DataFrame, known: DataFrame | None, cols: list[str],
                 null_safe: bool = False) -> DataFrame:
    """Distinct key tuples of ``new`` not yet in ``known`` (all of them if no table)."""
    keys = new.select(*cols).distinct()
    if known is None:
        return keys
    k = known.select(*cols).distinct()
    if not null_safe:
        return keys.join(k, cols, "left_anti")
    cond = None
    for c in cols:
        e = keys[c].eqNullSafe(k[c])
        cond = e if cond is None else cond & e
    return keys.join(k, cond, "left_anti")


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


# S-09 ---------------------------------------------------------------------
def evolve_table(df: DataFrame, add: dict[str, Column] | None = None,
                 rename: dict[str, str] | None = None, drop: list[str] | None = None,
                 update: dict[str, Column] | None = None) -> DataFrame:
    """Schema evolution as a new table version: ADD, RENAME, DROP, UPDATE of a column."""
    out = df
    if add:
        out = out.withColumns({k: v for k, v in add.items()})
    if rename:
        out = out.withColumnsRenamed(rename)
    if drop:
        out = out.drop(*drop)
    if update:
        out = out.withColumns(update)
    return out


def null_typed(dtype: str) -> Column:
    return F.lit(None).cast(dtype)
