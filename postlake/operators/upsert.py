"""Keyed upserts as joins (UPS-1 to UPS-4, JOIN-6).

One function covers the four variants:

=============  ==================================================  ==========
variant        arguments                                           matched row
=============  ==================================================  ==========
Silver         ``guard=..., keep=("source", "ingested_at")``       coalesce if a guard column differs
dimension      ``set_null=True``                                   overwritten, also with NULL
fact           (defaults)                                          coalesce
bridge         ``insert_only=True``                                untouched
=============  ==================================================  ==========
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_OLD, _NEW, _CHANGED, _NTH = "_is_old", "_is_new", "_changed", "_nth"


def require_unique(source: DataFrame, key: str, within: Sequence[str] = ()) -> DataFrame:
    """Fail the query if a key comes twice, as MERGE does.

    The check rides on the hash partitioning by key that the upsert join needs
    anyway, and streams: no group is held in memory.  ``within`` names columns that the
    key determines; rows that lie by them already are not exchanged again.
    """
    nth = F.row_number().over(Window.partitionBy(*within, key).orderBy(key))
    clash = F.raise_error(F.concat(F.lit(f"duplicate {key} in upsert source: "), F.col(key)))
    checked = source.withColumn(_NTH, nth)
    return checked.filter(F.when(F.col(_NTH) == 1, True).otherwise(clash.cast("boolean"))).drop(_NTH)


def new_rows(target: DataFrame, source: DataFrame, key: str, within: Sequence[str] = ()) -> DataFrame:
    """Source rows whose key the target lacks; ``within`` as in ``require_unique``."""
    keys = [*within, key]
    return source.join(target.select(*keys), keys, "left_anti")


def upsert(
    target: DataFrame,
    source: DataFrame,
    key: str,
    *,
    set_null: bool = False,
    guard: Sequence[str] = (),
    keep: Sequence[str] = (),
    insert_only: bool = False,
    mark: str | None = None,
) -> DataFrame:
    """The whole target after the upsert: one full outer join on the key, in which a target
    bucketed by the key needs no exchange.  ``mark`` names a column to say which rows were
    inserted or updated.
    """
    unknown = sorted(set(source.columns) - set(target.columns))
    if unknown:
        raise ValueError(f"columns not in the target: {unknown}")
    source = require_unique(source, key)
    if insert_only:
        fresh = new_rows(target, source, key)
        if mark:
            target, fresh = target.withColumn(mark, F.lit(False)), fresh.withColumn(mark, F.lit(True))
        return target.unionByName(fresh, allowMissingColumns=True)

    old = target.withColumn(_OLD, F.lit(True)).alias("t")
    new = source.withColumn(_NEW, F.lit(True)).alias("s")
    same_key = F.col(f"t.{key}") == F.col(f"s.{key}")
    joined = old.join(new, same_key, "full_outer")
    # Decided once per row, in a projection of its own, not once per column.
    decided = joined.withColumn(_CHANGED, _changed([c for c in guard if c in source.columns]))
    return decided.select(
        *(_merged(c, key, source.columns, set_null, keep).alias(c) for c in target.columns),
        *([(F.col(_OLD).isNull() | F.col(_CHANGED)).alias(mark)] if mark else []),
    )


def _changed(watched: Sequence[str]) -> Column:
    """Whether the row has a match that calls for an update."""
    matched = F.col(_NEW).isNotNull()
    if not watched:
        return matched
    return matched & reduce(or_, (~F.col(f"t.{c}").eqNullSafe(F.col(f"s.{c}")) for c in watched))


def _merged(name: str, key: str, given: Sequence[str], set_null: bool, keep: Sequence[str]) -> Column:
    """Value of one column after the join; see the table at the top."""
    old, new = F.col(f"t.{name}"), F.col(f"s.{name}")
    if name == key:
        return F.coalesce(old, new)
    if name not in given:
        return old
    inserted = F.when(F.col(_OLD).isNull(), new)
    if name in keep:
        return inserted.otherwise(old)
    value = new if set_null else F.coalesce(new, old)
    return inserted.when(F.col(_CHANGED), value).otherwise(old)
