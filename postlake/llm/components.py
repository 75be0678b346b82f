"""Connected components of a link table, by alternating large-star and small-star rounds.

Every round is one exchange over the links that are left and cuts its lineage with a
written table.  Rounds end when a round changes nothing: about the logarithm of the
longest chain.  A hot node is pre-aggregated: only the smallest neighbour of a node is
needed from each task (``min``), and links are made distinct as they are written.

Rows: links of a node with itself and repeated links count for nothing; links must not be null
(nodes without a link are not listed); an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.llm.common import staged, unstaged


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Link the larger (or the smaller and own) neighbours of each node to the least of them."""
    if large:
        both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select("b", "a"))
    else:
        both = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = both.join(least, "u")
    if large:
        made = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        made = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).union(
            least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
    return made.where(F.col("a") != F.col("b")).distinct()


def _mark(links: DataFrame) -> tuple:
    """Of a link set: its size and two order-free hashes; the same set has the same mark."""
    h = F.xxhash64("a", "b")
    other = F.xxhash64("b", "a")
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(h), F.bit_xor(other)).first())


def components(links: DataFrame) -> DataFrame:
    """node, component (its smallest node) of every node that has a link (a, b)."""
    links = staged(links.where(F.col("a") != F.col("b")).select("a", "b").distinct(), "links")
    mark = _mark(links)
    while mark[0]:
        following = staged(_star(_star(links, large=True), large=False), "links")
        before, mark = mark, _mark(following)
        unstaged(links)
        links = following
        if mark == before:
            break
    members = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return members.union(links.select("b", "b")).distinct()
