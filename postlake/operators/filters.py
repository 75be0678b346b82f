"""Row filters and splits (FLT-1 to FLT-7, SNK-8)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY_PARTITION = "ingest_date"
REQUIRED = ("job_url", "job_title", "company_name", "source")
CORRUPT = "_corrupt_record"


def day_slice(
    df: DataFrame, day: dt.date, ts: str = "ingested_at", *, to_the_second: bool = False
) -> DataFrame:
    """FLT-1: the rows of one day.

    Half-open, so the last second keeps its fraction; ``to_the_second`` ends
    at 23:59:59 sharp instead.  On a table partitioned by day the partition
    column is filtered too: Spark does not derive that from the timestamp.
    """
    start = dt.datetime(day.year, day.month, day.day)
    kept = F.col(ts) >= _time(start)
    if to_the_second:
        kept &= F.col(ts) <= _time(start + dt.timedelta(hours=23, minutes=59, seconds=59))
    else:
        kept &= F.col(ts) < _time(start + dt.timedelta(days=1))
    if ts == "ingested_at" and DAY_PARTITION in df.columns:
        kept &= F.col(DAY_PARTITION) == F.lit(start.date())
    return df.filter(kept)


def _time(at: dt.datetime) -> Column:
    """A text literal takes the column's own time type, with or without zone, so
    the comparison reaches the file scan without a cast of the column."""
    return F.lit(f"{at:%Y-%m-%d %H:%M:%S}")


def present(name: str) -> str:
    """Neither NULL nor only blanks; never NULL itself, so NOT is its complement."""
    return f"({name} IS NOT NULL AND trim({name}) <> '')"


def all_present(df: DataFrame, names: Iterable[str] = REQUIRED) -> Column:
    checks = [present(name) for name in names if name in df.columns]
    return F.expr(" AND ".join(checks) or "true")


def split_required(
    df: DataFrame, names: Iterable[str] = REQUIRED
) -> tuple[DataFrame, DataFrame]:
    """FLT-3: (complete rows, rows lacking a required field)."""
    complete = all_present(df, names)
    return df.filter(complete), df.filter(~complete)


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """FLT-2: (parsed rows without the corrupt column, unparsable rows).

    Of rows that were parsed whole (``sources.landing.whole_rows``), so both halves agree.
    """
    broken = F.col(CORRUPT).isNotNull()
    return df.filter(~broken).drop(CORRUPT), df.filter(broken)


def named(df: DataFrame, key: str, *, no_blanks: bool = False) -> DataFrame:
    """FLT-4: rows usable as dimension rows."""
    return df.filter(present(key) if no_blanks else f"{key} IS NOT NULL")


def title_like(keyword: str, title: str = "job_title") -> Column:
    """FLT-5: LIKE search; "%" and "_" in the keyword are wildcards."""
    plain = keyword.lower().replace("\\", "\\\\")  # a backslash stands for itself
    return F.lower(F.col(title)).like(f"%{plain}%")


def title_contains(text: str, title: str = "job_title") -> Column:
    """FLT-5 without wildcards."""
    return F.lower(F.col(title)).contains(text.lower())


def salary_inverted() -> Column:
    """FLT-6."""
    return F.col("salary_min") > F.col("salary_max")


def salary_negative() -> Column:
    """FLT-6."""
    return reduce(or_, (F.col(c) < 0 for c in ("salary_min", "salary_max")))


def has_rows(df: DataFrame) -> bool:
    """FLT-7: reads up to the first row only; whole rows, as a JSON source demands."""
    return bool(df.head(1))


def retain(df: DataFrame, ts: str, as_of: dt.date, days: int = 30) -> DataFrame:
    """SNK-8: rows no older than ``days`` on ``as_of``."""
    oldest = dt.datetime(as_of.year, as_of.month, as_of.day) - dt.timedelta(days=days)
    return df.filter(F.col(ts) >= _time(oldest))
