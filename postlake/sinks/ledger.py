"""Loads of landing files, each exactly once (SNK-1, SNK-2).

A *load* has a name that a retry has as well: the day of a daily run, or the files of a
micro-batch.  Its rows lie in partitions of their own (day and load), which a retry replaces; so
an attempt that was cut off, repeated or run twice leaves the rows once, and another load of
the same day stays as it is.

Which file was taken by which load is kept in a ledger next to the table: a file (path and
time of modification) belongs to the load that recorded it first, and other loads pass over it.
Rows are in place before their files are recorded; a load that is lost in between is
repeated under the same name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from postlake.operators.filters import DAY_PARTITION

LOAD = "load"
FILE, MODIFIED = "_file", "_modified"
_RECORD = "load string, file string, modified timestamp, recorded_at timestamp"


def with_file(rows: DataFrame) -> DataFrame:
    """Rows read from files with the path and time of modification of theirs."""
    return rows.withColumns({FILE: F.col("_metadata.file_path"), MODIFIED: F.col("_metadata.file_modification_time")})


def ledger_of(table: str) -> str:
    return f"{table}_loads"


def load_of_files(files: Iterable[tuple]) -> str:
    """The name of a load by what it reads: a retried micro-batch has the same."""
    listed = "\n".join(sorted(f"{file} {modified}" for file, modified in files))
    return "files-" + hashlib.sha256(listed.encode()).hexdigest()[:24]


def files_in(rows: DataFrame) -> list[tuple]:
    """Files of a batch: as many as the listing of its folder holds in the driver anyway."""
    return [tuple(r) for r in rows.select(FILE, MODIFIED).distinct().collect()]


def not_taken(rows: DataFrame, table: str, load: str) -> DataFrame:
    """Rows of files that no other load has recorded."""
    spark, ledger = rows.sparkSession, ledger_of(table)
    if not spark.catalog.tableExists(ledger):
        return rows
    others = spark.table(ledger).where(F.col("load") != load).select(
        F.col("file").alias(FILE), F.col("modified").alias(MODIFIED)
    )
    return rows.join(others.distinct(), [FILE, MODIFIED], "left_anti")


def record(spark: SparkSession, table: str, load: str, files: Iterable[tuple]) -> None:
    rows = [(load, file, modified) for file, modified in files]
    if rows:
        made = spark.createDataFrame(rows, "load string, file string, modified timestamp")
        stamped = made.withColumn("recorded_at", F.current_timestamp()).coalesce(1)
        stamped.write.format("parquet").mode("append").saveAsTable(ledger_of(table))


def _days_of(spark: SparkSession, table: str, load: str) -> set[str]:
    shown = (dict(p.split("=", 1) for p in r[0].split("/")) for r in spark.sql(f"SHOW PARTITIONS {table}").collect())
    return {part[DAY_PARTITION] for part in shown if part[LOAD] == load}


def put_load(rows: DataFrame, table: str, ts: str, load: str, *, row_level: bool = False) -> None:
    """Make ``rows`` the rows of a load, in the place of what it left before.

    A V2 table format replaces them in one commit.  A plain table replaces the days that
    the rows fall in; days of an earlier attempt that have no rows now are dropped after that."""
    spark = rows.sparkSession
    named = rows.withColumn(LOAD, F.lit(load))
    exists = spark.catalog.tableExists(table)
    if row_level:
        if exists:
            named.writeTo(table).overwrite(F.col(LOAD) == load)
        else:
            named.writeTo(table).partitionedBy(F.partitioning.days(ts), F.col(LOAD)).create()
        return
    dated = named.withColumn(DAY_PARTITION, F.to_date(F.col(ts)))
    seen = Observation()
    # A set, so a task that runs twice does no harm.
    watched = dated.observe(seen, F.collect_set(F.col(DAY_PARTITION).cast("string")).alias("days"))
    if not exists:
        watched.write.format("parquet").partitionBy(DAY_PARTITION, LOAD).saveAsTable(table)
        return
    before = _days_of(spark, table, load)
    into = watched.select(*spark.table(table).columns).write.option("partitionOverwriteMode", "dynamic")
    into.insertInto(table, overwrite=True)
    drop_load(spark, table, load, before - set(seen.get["days"]))


def drop_load(spark: SparkSession, table: str, load: str, days: Iterable[str] | None = None) -> None:
    """Drop the partitions of a load, of some days or of all."""
    days = _days_of(spark, table, load) if days is None else days
    parts = ", ".join(f"PARTITION ({DAY_PARTITION} = '{day}', {LOAD} = '{load}')" for day in sorted(days))
    if parts:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {parts}")


def taken_files() -> Column:
    """The files that rows come from, as an observed metric."""
    return F.collect_set(F.struct(F.col(FILE), F.col(MODIFIED))).alias("files")
