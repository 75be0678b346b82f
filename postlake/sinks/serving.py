"""Gold copy in a serving database (SNK-4, SNK-5, SNK-6).

Rows are written to a side table by the executors; the driver only sends the
renames that put it in place, as one transaction.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from postlake.sinks.keyed import KEY_PARTITION
from postlake.sources.tables import read_table

log = logging.getLogger(__name__)

# --- Fixed values: published tables, in order ---------------------------------
PUBLISHED = (
    "dim_company",
    "dim_location",
    "dim_job_category",
    "dim_skill",
    "dim_level",
    "fact_job_postings",
    "bridge_job_skills",
)


def write_side_table(
    df: DataFrame,
    table: str,
    url: str,
    properties: Mapping[str, str],
    *,
    connections: int = 16,
    batch: int = 10_000,
) -> str:
    """SNK-4: overwrite ``<table>_temp`` over a bounded number of connections."""
    side = f"{table}_temp"
    (
        df.write.mode("overwrite")
        .option("numPartitions", connections)
        .option("batchsize", batch)
        .jdbc(url, side, properties=dict(properties))
    )
    return side


def swap_statements(table: str) -> Sequence[str]:
    """Live table aside, side table live, old one dropped."""
    old, side = f"{table}_old", f"{table}_temp"
    return (
        f"DROP TABLE IF EXISTS {old}",
        f"ALTER TABLE IF EXISTS {table} RENAME TO {old}",
        f"ALTER TABLE {side} RENAME TO {table}",
        f"DROP TABLE IF EXISTS {old}",
    )


def open_connection(spark: SparkSession, url: str, properties: Mapping[str, str]):
    """A java.sql.Connection of the driver JVM."""
    jvm = spark.sparkContext._gateway.jvm
    info = jvm.java.util.Properties()
    for name, value in properties.items():
        info.setProperty(name, value)
    return jvm.java.sql.DriverManager.getConnection(url, info)


def swap_in(connect: Callable[[], object], table: str) -> None:
    """SNK-5: all renames or none; the connection is closed either way."""
    connection = connect()
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        for sql in swap_statements(table):
            statement.execute(sql)
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()


def publish_table(
    spark: SparkSession, source: str, table: str, url: str, properties: Mapping[str, str]
) -> bool:
    df = read_table(spark, source)
    if df is None:
        return False
    write_side_table(df.drop(KEY_PARTITION), table, url, properties)
    swap_in(lambda: open_connection(spark, url, properties), table)
    return True


def publish_all(
    spark: SparkSession,
    url: str,
    properties: Mapping[str, str],
    *,
    namespace: str = "gold",
    publish: Callable[..., bool] = publish_table,
) -> list[str]:
    """SNK-6: table by table in fixed order; the first failure ends the run."""
    done = []
    for table in PUBLISHED:
        log.info("publishing %s", table)
        if publish(spark, f"{namespace}.{table}", table, url, properties):
            done.append(table)
    return done
