"""Column plumbing: conform to a schema, rename, audit columns (PRJ-1 to PRJ-4)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def column_or_null(df: DataFrame, name: str, kind: str = "string") -> Column:
    """The column, or a typed NULL literal that Catalyst folds away."""
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def rename_present(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """PRJ-3: rename the listed columns that exist."""
    return df.withColumnsRenamed({old: new for old, new in names.items() if old in df.columns})


def with_source(df: DataFrame, source: str) -> DataFrame:
    """PRJ-2: the audit column becomes ``source``; without one, a literal does."""
    if "_source_name" in df.columns:
        return df.withColumnRenamed("_source_name", "source")
    return df.withColumn("source", F.lit(source))


def with_audit(df: DataFrame, source: str, ingested_at: Column | None = None) -> DataFrame:
    """PRJ-1: load time (now, unless given) and source name."""
    loaded = F.current_timestamp() if ingested_at is None else ingested_at
    return df.withColumns({"ingested_at": loaded, "_source_name": F.lit(source)})


def conform(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """PRJ-4: exactly the columns named in ``types``, in order, typed NULL where absent."""
    present = set(df.columns)
    return df.selectExpr(
        *(f"`{n}`" if n in present else f"CAST(NULL AS {kind}) AS `{n}`" for n, kind in types.items())
    )


def project_existing(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Ordered projection onto those of ``names`` that exist."""
    return df.select(*(name for name in names if name in df.columns))


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """SET-1: UNION ALL by name; columns one side lacks are NULL there."""
    if not frames:
        raise ValueError("nothing to unite")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def free_names(taken: Sequence[str], *names: str) -> list[str]:
    """Names like these that none of the taken ones equals."""
    longest = max(map(len, taken), default=0)
    return [name.ljust(longest + 1, "_") for name in names]
