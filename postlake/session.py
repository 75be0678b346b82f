"""Spark session set-up.

Only runtime SQL settings are fixed here.  Masters, catalogs, object-store
endpoints and credentials come from the caller or from ``spark-submit``.
"""

from __future__ import annotations

import logging
import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)

SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when it costs one more exchange further up.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # A stored table bucketed by some of the join keys is joined where it lies.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # The JVM never compiles a method of more than 8000 bytes of bytecode.  The
    # long CASE chains here would run interpreted; above this limit Spark uses
    # its other code generator, which splits expressions into small methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Pages are large: bound a batch handed to Python by bytes, not by rows alone.
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
    # One of a few per key: rows are cut in each task before the exchange, up to this many.
    "spark.sql.optimizer.windowGroupLimitThreshold": "10000",
    # Landing directories are month=06: keep the leading zero.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to a session made elsewhere."""
    for name, value in SQL_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def get_session(
    app_name: str,
    *,
    master: str | None = None,
    conf: Mapping[str, str] | None = None,
) -> SparkSession:
    """Build or fetch the session; ``conf`` carries catalogs and credentials."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**SQL_SETTINGS, **(conf or {})}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def staging_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local master,
    where driver and executors share one disk, may fall back to a temporary one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="postlake-")
        log.warning("spark.checkpoint.dir is unset; intermediate tables go to %s", root)
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def store(df: DataFrame, name: str, *partitions: str) -> str:
    """Write the rows to a new path in the staging folder.

    They are left there; the folder is scratch space with an expiry rule.
    """
    path = f"{staging_root(df.sparkSession)}/batches/{name}-{uuid.uuid4().hex}"
    df.write.partitionBy(*partitions).option("compression", "zstd").parquet(path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write the rows to the staging folder and read them back."""
    return df.sparkSession.read.schema(df.schema).parquet(store(df, name))
