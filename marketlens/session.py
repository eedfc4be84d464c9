"""Session helpers.

The library never builds its own cluster settings beyond what tests need:
on a cluster the session is given, and shared folders (checkpoints, written
tables) come from the session's own configuration.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# Settings that matter for every operator here: AQE re-plans joins and
# coalesces shuffle partitions at run time, skew-join splits hot keys, and
# the session time zone is pinned so timestamp_ntz arithmetic is stable.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "marketlens", extra: dict | None = None) -> SparkSession:
    """Return the active session or build a local one (tests, bench)."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts.

    Read from ``spark.checkpoint.dir`` as the cluster sets it. Only when it is
    unset in a local session (tests) a scratch folder is made and registered;
    on a cluster a machine's own folder would not do, so that is an error.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="marketlens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", current)
    spark.sparkContext.setCheckpointDir(current)
    return current


def dealt(df, *keys: str):
    """``df`` dealt by ``keys`` into as many parts as the session has shuffle partitions. A given number isn't merged again by
    size, so that work heavy for its bytes (regular expressions, windows) is spread over all cores, whatever files it came from."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def block_labels(spark: SparkSession) -> list[int]:
    """A number for each shuffle partition, such that ``dealt`` by these numbers gives each a partition of its own (by chance
    one may share; only the sizes of parts depend on it)."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    label = F.col("id").cast("int")
    own = spark.range(24 * n).groupBy(F.pmod(F.hash(label), F.lit(n)).alias("part")).agg(F.min(label).alias("label")).collect()
    found = {r["part"]: r["label"] for r in own}
    return [found.get(i, -1 - i) for i in range(n)]


def cut_lineage(df):
    """Reliable checkpoint into the shared checkpoint folder (never local)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def kept(df, codec: str | None = None):
    """``df`` written once as parquet into the shared checkpoint folder and read from there: for joins of large tables that are
    read several times, by a few columns at a time (a checkpoint writes and reads whole rows, uncompressed). ``codec`` is the
    session's unless given."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/kept-{uuid.uuid4().hex}"
    write = df.write.option("compression", codec) if codec else df.write
    write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
