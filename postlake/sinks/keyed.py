"""Keyed tables on a plain catalog: a batch rewrites only the parts it touches (UPS-1 to UPS-5).

A row lies in the partition ``key_part`` = hash of its key modulo the number of parts, which is
the number of buckets as well: every partition holds one bucket.  So the parts a batch touches
are a list of whole numbers, the target is read with a partition filter on them, a join on the key
needs no exchange of the stored side, and a dynamic partition overwrite leaves all other files
as they are.  Tables laid out by the same column and number of parts join without any exchange.

An overwrite of partitions removes files before it moves the new ones in.  The new rows are
therefore written to the staging folder first, and the table's property ``postlake.pending``
names them until they are in place; the next upsert finishes what a lost driver left.
"""

from __future__ import annotations

import logging
import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.operators.upsert import new_rows, require_unique, upsert
from postlake.session import store, stored

log = logging.getLogger(__name__)

KEY_PARTITION = "key_part"
CHANGE_DAY = "change_date"
PENDING = "postlake.pending"
_CHANGED = "_row_changed"
FILE_ROWS = 1 << 20
"""Rows that one task sorts, in memory, when a table is created."""


def key_part(key: str, parts: int) -> Column:
    """The bucket that Spark puts the key into."""
    return F.pmod(F.hash(key), F.lit(parts))


def parts_of(spark: SparkSession, table: str) -> int:
    """Number of parts of a keyed table."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Num Buckets'").collect()
    if not rows:
        raise ValueError(f"{table} is not a keyed table")
    return int(rows[0].data_type)


def _laid_out(rows: DataFrame, by: str, parts: int, size: int = 0) -> DataFrame:
    """Each task gets rows of one part; ``size`` rows or fewer make more tasks where parts are large."""
    tasks = parts * max(1, math.ceil(size / (parts * FILE_ROWS)))
    return rows.withColumn(KEY_PARTITION, key_part(by, parts)).repartition(tasks, by)


def create(rows: DataFrame, table: str, by: str, parts: int, size: int = 0) -> None:
    """``size``: number of rows, where it is known."""
    writer = _laid_out(rows, by, parts, size).write.format("parquet").partitionBy(KEY_PARTITION)
    writer.option("compression", "zstd").bucketBy(parts, by).sortBy(by).saveAsTable(table)


def touched(batch: DataFrame, by: str, parts: int) -> list[int]:
    """The parts that rows of a batch fall in: at most ``parts`` numbers."""
    return sorted(r[0] for r in batch.select(key_part(by, parts)).distinct().collect())


def parts_slice(spark: SparkSession, table: str, wanted: Sequence[int]) -> DataFrame:
    """Those parts of a table, by a filter that reaches the partitions."""
    return spark.table(table).where(F.col(KEY_PARTITION).isin(list(wanted)))


# --- overwrite with a second chance --------------------------------------------------


def _pending(spark: SparkSession, table: str) -> str | None:
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").where(F.col("key") == PENDING).collect()
    return rows[0].value if rows else None


def _put(spark: SparkSession, table: str, path: str, by: str) -> None:
    columns = spark.table(table).columns
    rows = spark.read.schema(spark.table(table).schema).parquet(path).select(*columns)
    # Stored by a join on the key, a file's rows are of one part: no exchange to gather them.
    into = rows.write.option("partitionOverwriteMode", "dynamic")
    into.insertInto(table, overwrite=True)
    spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ('{PENDING}')")


def settle(spark: SparkSession, table: str, by: str) -> bool:
    """Finish an overwrite that was cut off; whether there was one."""
    path = _pending(spark, table)
    if path is None:
        return False
    log.warning("%s: finishing the overwrite from %s", table, path)
    _put(spark, table, path, by)
    return True


def overwrite_parts(spark: SparkSession, path: str, table: str, by: str) -> None:
    """Replace the parts that the rows stored at ``path`` fall in."""
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{PENDING}' = '{path}')")
    _put(spark, table, path, by)


# --- upserts -----------------------------------------------------------------------------


def changes_of(table: str) -> str:
    return f"{table}_changes"


def _note_changes(changed: DataFrame, table: str, key: str, ts: str) -> None:
    """Append keys to the change feed, under the day of their change.

    Noted before the rows are in place: a key too many is harmless, readers look at ``ts``."""
    rows = changed.select(key, KEY_PARTITION, F.to_date(ts).alias(CHANGE_DAY))
    gathered = rows.hint("rebalance", CHANGE_DAY).write.format("parquet").mode("append")
    gathered.partitionBy(CHANGE_DAY).saveAsTable(changes_of(table))


def upsert_keyed(
    source: DataFrame,
    table: str,
    key: str,
    *,
    parts: int | None = None,
    feed_ts: str | None = None,
    before: Callable[[DataFrame, DataFrame | None], None] | None = None,
    **rule,
) -> list[int]:
    """Upsert into a keyed table, created on the first run; the parts that were rewritten.

    ``feed_ts`` names a column with the time of a row's last change and keeps a change feed.
    ``before`` is called with the changed rows, and with the present rows of the touched parts
    (None on the first run), before they are replaced.
    """
    spark = source.sparkSession
    batch = stored(source, "upsert")
    # Keys alone are exchanged for the check; nothing is changed before it.
    require_unique(batch.select(key), key).write.format("noop").mode("overwrite").save()
    if not spark.catalog.tableExists(table):
        parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
        if feed_ts:
            _note_changes(batch.withColumn(KEY_PARTITION, key_part(key, parts)), table, key, feed_ts)
        if before:
            before(batch, None)
        create(batch, table, key, parts, batch.count())
        return touched(batch, key, parts)
    settle(spark, table, key)
    parts = parts_of(spark, table)
    wanted = touched(batch, key, parts)
    if not wanted:
        return []
    target = parts_slice(spark, table, wanted).drop(KEY_PARTITION)
    merged = upsert(target, batch, key, mark=_CHANGED, **rule)
    merged = merged.withColumn(KEY_PARTITION, key_part(key, parts))
    path = store(merged, "merged")
    if feed_ts:
        _note_changes(spark.read.schema(merged.schema).parquet(path).where(_CHANGED), table, key, feed_ts)
    if before:
        before(spark.read.schema(merged.schema).parquet(path).where(_CHANGED).drop(_CHANGED), target)
    overwrite_parts(spark, path, table, key)
    return wanted


def unknown_rows(source: DataFrame, table: str, key: str, by: str, parts: int, wanted: Sequence[int]) -> DataFrame:
    """Rows of ``source`` whose key the table lacks.  Both lie by ``by``, which the key
    determines: the stored side is neither exchanged nor read beyond the touched parts."""
    dealt = require_unique(source.repartition(parts, by), key, within=(by,))
    return new_rows(parts_slice(source.sparkSession, table, wanted), dealt, key, within=(by,))


def append_keyed(source: DataFrame, table: str, key: str, by: str, *, parts: int | None = None) -> None:
    """Insert-only upsert (UPS-4) into a table laid out by another column than its key."""
    spark = source.sparkSession
    if not spark.catalog.tableExists(table):
        parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
        create(require_unique(source, key), table, by, parts)
        return
    parts = parts_of(spark, table)
    batch = stored(source, "append")
    fresh = unknown_rows(batch, table, key, by, parts, touched(batch, by, parts))
    rows = fresh.withColumn(KEY_PARTITION, key_part(by, parts))
    rows.select(*spark.table(table).columns).write.insertInto(table)
