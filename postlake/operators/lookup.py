"""Star lookup (JOIN-1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def star_lookup(
    facts: DataFrame, dims: Sequence[tuple[DataFrame, str, Sequence[str]]], *, few: bool = False
) -> DataFrame:
    """LEFT JOIN of several dimensions, each reduced to key and wanted columns.

    Without ``few`` there is no hint: place and level tables fall under the
    broadcast threshold by themselves, a company table may not.  ``few`` says
    that the facts are a stored list of a bounded number of rows.  A left join
    cannot broadcast its left side, so each dimension is first reduced to the
    keys of that list, which are sent to it: no dimension is exchanged.
    """
    for dim, key, wanted in dims:
        named = dim.select(key, *wanted)
        if few:
            named = named.join(F.broadcast(facts.select(key).distinct()), key, "left_semi")
        facts = facts.join(F.broadcast(named) if few else named, key, "left")
    return facts
