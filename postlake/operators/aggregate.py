"""Counting operators (AGG-1 to AGG-6).

Counts are taken on the foreign key before any join: the partial sums travel,
not the rows, and a key held by a third of the rows costs one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def count_by(df: DataFrame, key: str, name: str = "count") -> DataFrame:
    """AGG-1: rows per key, largest first."""
    counted = df.groupBy(key).agg(F.count(F.lit(1)).alias(name))
    return counted.orderBy(F.col(name).desc(), F.col(key))


def count_by_name(
    facts: DataFrame, dim: DataFrame, key: str, counted: str, label: str, name: str
) -> DataFrame:
    """AGG-2, JOIN-2, JOIN-3: non-NULL ``counted`` per name of an inner-joined dimension."""
    per_key = facts.groupBy(key).agg(F.count(counted).alias("_n"))
    return (
        per_key.join(dim.select(key, label), key)
        .groupBy(label)
        .agg(F.sum("_n").alias(name))
    )


def top(df: DataFrame, by: str, label: str, k: int) -> DataFrame:
    """The k largest, ties by label."""
    return df.orderBy(F.col(by).desc(), F.col(label)).limit(k)


def null_counts(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """AGG-3: row count and NULLs per column, in one pass; ``names`` maps alias to column."""
    nulls = (F.count_if(F.col(c).isNull()).alias(alias) for alias, c in names.items())
    return df.agg(F.count(F.lit(1)).alias("total_rows"), *nulls)


def duplicates(df: DataFrame, key: str, name: str = "duplicate_count") -> DataFrame:
    """AGG-4: keys held by more than one row."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(name)).filter(F.col(name) > 1)


def orphans(
    child: DataFrame, parent: DataFrame, key: str, name: str, *, nulls_count: bool = False
) -> DataFrame:
    """JOIN-4, JOIN-5: rows whose key the parent lacks; a NULL key counts only if asked."""
    rows = child if nulls_count else child.filter(F.col(key).isNotNull())
    per_key = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    lost = per_key.join(parent.select(key), key, "left_anti")
    return lost.agg(F.coalesce(F.sum("_n"), F.lit(0).cast("bigint")).alias(name))


def batch_metrics(rows: DataFrame, key: str, complete: str) -> DataFrame:
    """AGG-5: batch counts in one aggregation on the posting key.

    ``complete`` names a boolean column.  A key is kept once if any of its
    rows is complete; everything else was dropped, as a reject or a repeat.
    """
    per_key = rows.groupBy(key).agg(
        F.count(F.lit(1)).alias("_rows"), F.count_if(F.col(complete)).alias("_complete")
    )
    counted = per_key.agg(
        F.coalesce(F.sum("_rows"), F.lit(0).cast("bigint")).alias("bronze_count"),
        F.count_if(F.col("_complete") > 0).alias("silver_count"),
        F.coalesce(F.sum(F.col("_rows") - F.col("_complete")), F.lit(0).cast("bigint")).alias(
            "rejected_count"
        ),
    )
    dropped = F.col("bronze_count") - F.col("silver_count")
    share = 1 - F.col("silver_count") / F.greatest(F.col("bronze_count"), F.lit(1))
    return counted.select(
        "bronze_count",
        "silver_count",
        dropped.alias("dropped_count"),
        "rejected_count",
        (dropped - F.col("rejected_count")).alias("repeat_count"),
        F.round(share, 4).alias("drop_rate"),
    )


def with_grand_total(counts: DataFrame, count: str, name: str = "total") -> DataFrame:
    """AGG-6: total over already aggregated groups (one row per source)."""
    return counts.withColumn(name, F.sum(count).over(Window.partitionBy()))


def rolled_up(counts: DataFrame, keys: Sequence[str], count: str, level: str = "level") -> DataFrame:
    """AGG-6, DQ-7: counts per group with the subtotals of all leading keys and the grand total.

    ``level`` is the grouping id (0: a group, 1: the last key is summed up, ...): it tells a
    subtotal from a group whose key is NULL.  ``counts`` has one row per group already, so
    what the expansion multiplies is small."""
    return counts.rollup(*keys).agg(F.sum(count).alias(count), F.grouping_id().alias(level))
