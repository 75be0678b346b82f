"""One row per key, top rows and paging (DST-1, SRT-1 to SRT-4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlake.session import stored

_RANK, _PLACE = "_rank", "_place"


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """DST-1: the first row of each key in the given order.

    Spark turns ``row_number() = 1`` into a group limit on both sides of the
    exchange: every task passes on at most one row per key, so a key holding a
    large part of the table does not end up in one task.
    """
    ranked = df.withColumn(_RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col(_RANK) == 1).drop(_RANK)


def latest_first(df: DataFrame, tie_breaks: Sequence[str] = ()) -> list[Column]:
    """Newest load first; then the given columns, else a hash of the whole row."""
    order = [F.col("ingested_at").desc()] if "ingested_at" in df.columns else []
    if tie_breaks:
        return order + [F.col(c).desc() for c in tie_breaks]
    return order + [F.xxhash64(*sorted(df.columns)).desc()]


def top_per_group(
    df: DataFrame, group: str, order: Sequence[Column], n: int, slices: int = 64
) -> DataFrame:
    """SRT-4: the first ``n`` rows of each group, for few and large groups.

    Groups are cut into slices by row hash and ranked there first; what is
    left for the final ranking of a group is at most ``n * slices`` rows.
    """
    sliced = df.withColumn("_slice", F.pmod(F.xxhash64(*sorted(df.columns)), F.lit(slices)))
    local = Window.partitionBy(group, "_slice").orderBy(*order)
    shortlist = sliced.withColumn(_RANK, F.row_number().over(local)).filter(F.col(_RANK) <= n)
    final = Window.partitionBy(group).orderBy(*order)
    ranked = shortlist.drop("_slice").withColumn(_RANK, F.row_number().over(final))
    return ranked.filter(F.col(_RANK) <= n).drop(_RANK)


def row_numbers(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """Consecutive numbers from 1 over a whole table in the given order, without a window over it.

    Rows are sorted in ranges and written; a row's number is its place in its range and the
    number of rows in the ranges before.  Only the counts of the ranges meet in one task.
    """
    spread = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # The id of a row is its range and, in the lower 33 bits, its place in it.
    placed = stored(spread.withColumn(_PLACE, F.monotonically_increasing_id()), "ranges")
    part = F.shiftright(_PLACE, 33).alias("_range")
    sizes = placed.groupBy(part).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col("_range").alias("_of"), F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    found = placed.join(starts, F.shiftright(_PLACE, 33) == F.col("_of"))
    place = F.col(_PLACE).bitwiseAND(F.lit((1 << 33) - 1))
    return found.withColumn(name, F.col("_start") + place + 1).drop(_PLACE, "_of", "_start")


def numbered(limited: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """SRT-3: rank label.  Only for a list already cut to a top k."""
    return limited.withColumn(name, F.row_number().over(Window.orderBy(*order)))


def paged(limited: DataFrame, order: Sequence[Column], size: int = 5) -> DataFrame:
    """SRT-2: page number and page count of a list already cut to a top k."""
    rows = numbered(limited, order, _RANK)
    total = F.count(F.lit(1)).over(Window.partitionBy())
    return rows.select(
        "*",
        F.ceil(F.col(_RANK) / size).cast("int").alias("page"),
        F.ceil(total / size).cast("int").alias("pages"),
    ).drop(_RANK)


def all_paged(df: DataFrame, order: Sequence[Column], size: int = 5) -> DataFrame:
    """SRT-2 of a list of any length: page numbers by ``row_numbers``."""
    rows = row_numbers(df, order, _RANK)
    total = rows.agg(F.count(F.lit(1)).alias("_total"))
    return rows.join(F.broadcast(total)).select(
        *df.columns,
        F.ceil(F.col(_RANK) / size).cast("int").alias("page"),
        F.ceil(F.col("_total") / size).cast("int").alias("pages"),
    )
