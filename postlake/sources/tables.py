"""Lake tables as inputs (SRC-3, SRC-4, SRC-5)."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.operators.columns import union_by_name
from postlake.operators.filters import day_slice, has_rows
from postlake.sinks.keyed import CHANGE_DAY, KEY_PARTITION, changes_of, parts_slice

log = logging.getLogger(__name__)


def read_table(spark: SparkSession, table: str) -> DataFrame | None:
    """SRC-5: a missing table is reported and skipped."""
    if not spark.catalog.tableExists(table):
        log.warning("table %s does not exist, skipped", table)
        return None
    return spark.table(table)


def read_day(
    spark: SparkSession,
    table: str,
    day: dt.date,
    ts: str = "ingested_at",
    *,
    to_the_second: bool = False,
) -> DataFrame:
    """SRC-3: one day of a table."""
    return day_slice(spark.table(table), day, ts, to_the_second=to_the_second)


def changed_parts(spark: SparkSession, table: str, day: dt.date) -> list[int] | None:
    """The parts of a keyed table in which rows changed on a day, by its change feed; None
    without a feed.  At most as many numbers as the table has parts."""
    feed = changes_of(table)
    if not spark.catalog.tableExists(feed):
        return None
    of_day = spark.table(feed).where(F.col(CHANGE_DAY) == F.lit(day))
    return sorted(r[0] for r in of_day.select(KEY_PARTITION).distinct().collect())


def read_changed_day(
    spark: SparkSession, table: str, day: dt.date, ts: str = "updated_at", *, to_the_second: bool = False
) -> DataFrame:
    """SRC-4 of one keyed table: rows last changed on a day, from the parts the feed names."""
    parts = changed_parts(spark, table, day)
    rows = spark.table(table) if parts is None else parts_slice(spark, table, parts)
    return day_slice(rows, day, ts, to_the_second=to_the_second).drop(KEY_PARTITION)


def read_united_day(
    spark: SparkSession,
    tables: Iterable[str],
    day: dt.date,
    ts: str = "ingested_at",
    *,
    to_the_second: bool = False,
    skip_empty: bool = True,
) -> DataFrame | None:
    """SRC-4: the day's rows of all tables that exist and have any; None if none has.

    Telling whether a table has any may scan it; a caller that stores the
    union anyway turns ``skip_empty`` off and looks at what came out.
    """
    frames = []
    for table in tables:
        frame = read_table(spark, table)
        if frame is None:
            continue
        column = ts if ts in frame.columns else "ingested_at"
        if column == "updated_at":
            frame = read_changed_day(spark, table, day, column, to_the_second=to_the_second)
        else:
            frame = day_slice(frame, day, column, to_the_second=to_the_second).drop(KEY_PARTITION)
        if not skip_empty or has_rows(frame):
            frames.append(frame)
    return union_by_name(frames) if frames else None
