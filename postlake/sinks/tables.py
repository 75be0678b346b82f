"""Lake tables as outputs (SNK-1, SNK-3, SNK-8, SNK-9, UPS-5).

Two kinds of catalog are served with Spark's own commands:

* one with row-level operations (a V2 table format): native MERGE;
* plain Spark tables: keyed tables that rewrite the parts a batch touches (``keyed``); a
  table without a key is written whole as a new version next to the old one, and a view
  of the table's name is switched to it (``publish_version``).
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from postlake.functions import terms
from postlake.operators.filters import DAY_PARTITION, has_rows
from postlake.operators.upsert import new_rows, require_unique
from postlake.sinks import keyed

NAMESPACES = ("sandbox", "bronze", "silver", "gold")


def create_namespaces(
    spark: SparkSession, root: str | None = None, catalog: str | None = None, prefix: str = ""
):
    """SNK-9: idempotent."""
    for name in (prefix + namespace for namespace in NAMESPACES):
        full = f"{catalog}.{name}" if catalog else name
        place = f" LOCATION '{root.rstrip('/')}/{name}'" if root else ""
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {full}{place}")


def append_or_create(
    df: DataFrame,
    table: str,
    ts: str | None = None,
    *,
    row_level: bool = False,
    replace: bool = False,
) -> None:
    """SNK-1: append, or create partitioned by day of ``ts``.

    A V2 table format hides the partitioning; a plain table gets a day column.
    ``replace`` overwrites the days that the rows fall in, and no others.
    """
    exists = df.sparkSession.catalog.tableExists(table)
    if row_level:
        writer = df.writeTo(table)
        if exists and replace:
            writer.overwritePartitions()
        elif exists:
            writer.append()
        else:
            (writer.partitionedBy(F.partitioning.days(ts)) if ts else writer).create()
        return
    writer = df
    if ts:
        writer = df.withColumn(DAY_PARTITION, F.to_date(F.col(ts)))
    if exists and replace and ts:
        stored = df.sparkSession.table(table).columns
        by_day = writer.select(*stored).write.option("partitionOverwriteMode", "dynamic")
        by_day.insertInto(table, overwrite=True)
        return
    parts = [DAY_PARTITION] if ts else []
    writer.write.mode("append").format("parquet").partitionBy(*parts).saveAsTable(table)


def rejects(df: DataFrame) -> DataFrame:
    """Rejected rows with the reason and the time of the failure."""
    return df.withColumns(
        {"error_reason": F.lit(terms.REJECT_REASON), "failed_at": F.current_timestamp()}
    )


def write_rejects(
    df: DataFrame,
    table: str,
    ts: str | None = None,
    *,
    row_level: bool = False,
    replace: bool = False,
) -> None:
    """SNK-3: append rejected rows, or ``replace`` those of the same days of ``ts``."""
    append_or_create(rejects(df), table, ts, row_level=row_level, replace=replace)


def clear_day(spark: SparkSession, table: str, day: dt.date, *, row_level: bool = False) -> None:
    """Drop the rows of one day of a table partitioned by day."""
    if row_level:
        spark.sql(f"DELETE FROM {table} WHERE to_date(ingested_at) = DATE '{day.isoformat()}'")
    else:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({DAY_PARTITION} = '{day.isoformat()}')")


def write_quarantine(df: DataFrame, path: str, *, replace: bool = False) -> int:
    """SNK-2: unparsable lines as JSON; how many there were.

    ``replace`` also clears what an earlier attempt left where there are none now."""
    if not replace and not has_rows(df):
        return 0
    counts = Observation()
    mode = "overwrite" if replace else "append"
    df.observe(counts, F.count(F.lit(1)).alias("rows")).write.mode(mode).json(path)
    return counts.get["rows"]


# --- versions -----------------------------------------------------------------


def _versions(spark: SparkSession, table: str) -> list[str]:
    database, _, name = table.rpartition(".")
    listed = spark.catalog.listTables(database or None, f"{name}__v*")
    return sorted(t.name for t in listed)


def publish_version(
    df: DataFrame,
    table: str,
    *,
    bucket_by: str | None = None,
    buckets: int | None = None,
    hashed: bool = False,
    keep: int = 2,
) -> str:
    """Write ``df`` as the next version of ``table`` and switch the view to it.

    ``bucket_by`` stores the rows hashed by key into ``buckets`` files: the
    next upsert and joins on that key then read the table without an exchange.
    Rows that leave an exchange on that key are ``hashed`` already; with as
    many buckets as shuffle partitions every bucket sits in one task, and the
    write needs no exchange of its own.
    """
    spark = df.sparkSession
    version = f"{table}__v{time.time_ns()}"
    writer = df.write
    if bucket_by:
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
        count = buckets or partitions
        if not hashed or count != partitions:
            writer = df.repartition(count, bucket_by).write
        writer = writer.bucketBy(count, bucket_by).sortBy(bucket_by)
    writer.format("parquet").saveAsTable(version)
    spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM {version}")
    database = table.rpartition(".")[0]
    for old in _versions(spark, table)[:-keep]:
        spark.sql(f"DROP TABLE IF EXISTS {database + '.' if database else ''}{old}")
    return version


def native_merge(
    source: DataFrame,
    table: str,
    key: str,
    *,
    set_null: bool = False,
    guard: Sequence[str] = (),
    keep: Sequence[str] = (),
    insert_only: bool = False,
) -> None:
    """The same four upsert variants as one row-level MERGE, where the catalog has it."""
    old, new = f"{table}.", "s."
    merge = source.alias("s").mergeInto(table, F.expr(f"{old}{key} = {new}{key}"))
    if not insert_only:
        watched = [c for c in guard if c in source.columns]
        differs = " OR ".join(f"NOT ({old}{c} <=> {new}{c})" for c in watched)
        matched = merge.whenMatched(F.expr(differs)) if differs else merge.whenMatched()
        value = "{new}{c}" if set_null else "coalesce({new}{c}, {old}{c})"
        merge = matched.update(
            {
                c: F.expr(value.format(old=old, new=new, c=c))
                for c in source.columns
                if c != key and c not in keep
            }
        )
    merge.whenNotMatched().insertAll().merge()


def upsert_table(
    source: DataFrame,
    table: str,
    key: str,
    *,
    row_level: bool = False,
    partition_ts: str | None = None,
    buckets: int | None = None,
    feed_ts: str | None = None,
    **rule,
) -> None:
    """Upsert into a table, creating it on the first run (UPS-5).

    ``feed_ts``: see ``keyed.upsert_keyed``; a table format with MERGE prunes by its own statistics.
    """
    if not row_level:
        keyed.upsert_keyed(source, table, key, parts=buckets, feed_ts=feed_ts, **rule)
    elif source.sparkSession.catalog.tableExists(table):
        native_merge(source, table, key, **rule)
    else:
        append_or_create(require_unique(source, key), table, partition_ts, row_level=True)


def append_new(
    source: DataFrame,
    table: str,
    key: str,
    *,
    by: str | None = None,
    buckets: int | None = None,
    row_level: bool = False,
) -> None:
    """Insert-only upsert (UPS-4): known rows are never rewritten, new ones are appended.

    ``by`` lays a plain table out by another column, next to a table keyed by it.
    """
    if by and not row_level:
        keyed.append_keyed(source, table, key, by, parts=buckets)
        return
    spark = source.sparkSession
    source = require_unique(source, key)
    if spark.catalog.tableExists(table):
        if row_level:
            native_merge(source, table, key, insert_only=True)
            return
        source = new_rows(spark.table(table), source, key)
    append_or_create(source, table, row_level=row_level)


# --- retention ------------------------------------------------------------------


def expired_days(days: Iterable[str], as_of: dt.date, keep_days: int) -> list[str]:
    oldest = (as_of - dt.timedelta(days=keep_days)).isoformat()
    return sorted(day for day in days if day < oldest)


def drop_expired(spark: SparkSession, table: str, as_of: dt.date, keep_days: int = 30) -> list[str]:
    """SNK-8 on a day-partitioned table: whole partitions go, no row is rewritten."""
    shown = (dict(part.split("=", 1) for part in r[0].split("/")) for r in spark.sql(f"SHOW PARTITIONS {table}").collect())
    gone = expired_days({part[DAY_PARTITION] for part in shown}, as_of, keep_days)
    if gone:
        parts = ", ".join(f"PARTITION ({DAY_PARTITION} = '{day}')" for day in gone)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {parts}")
    return gone
