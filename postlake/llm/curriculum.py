"""Mixing sources to target weights along a time-varying curriculum.

Each source has a target number of words and a weight schedule over training time 0..1:
line pieces through (time, weight) knots.  Its integral, scaled to the target, is the
demand D(t) for the source's words up to time t.  A source's documents stand in an order
drawn by hash; the words before a document, c, put it at the time D⁻¹(c) when the demand
reaches it, and all sources are merged by sorting on that time in ranges.  A source is
read again from its start while its demand is not met; the last document is taken in part.

Running sums are two sums: over the hash buckets of each source (few rows) and within a
bucket, so a source with a third of all rows is summed in as many tasks as it has buckets.
A bucket is the leading bits of the drawn hash, and there are several for each shuffle
partition: their number follows the cluster, and the order does not depend on it.
Collected is one row for each source, at most ``MAX_SOURCES``; what is found for the sources
comes back as a table of as many rows.

Rows: null texts have no words and are never due; a null source is a source of its own,
last in order; rows of one doc_id are ordered by text; an empty table gives no rows.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlake.llm.common import free_names, partitions_of, staged, text_key

WEIGHTS = (5, 2, 1)
SHARE = Fraction(3, 2)
"""Words of the mix as a share of all words."""
REPEATS = 2
MAX_SOURCES = 100_000
#: Schedule of the sources of each weight, repeating like the weights: the heavy sources
#: lead, the light ones come in late.
SCHEDULES = (
    ((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 0.25), (0.25, 1.0), (1.0, 1.5)),
)


def word_count(text: str = "text") -> Column:
    """Words of a text: starts of runs that are not white space."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: list[tuple[str | None, int]], weights: tuple[int, ...] = WEIGHTS) -> dict[str | None, Fraction]:
    """Words due from each source: by weight, at most REPEATS times its size, the excess
    shared again among the others until none is above."""
    order = sorted(sizes, key=lambda s: (s[0] is None, [ord(c) for c in s[0] or ""]))
    weight = {name: weights[i % len(weights)] for i, (name, _) in enumerate(order)}
    most = {name: Fraction(REPEATS * size) for name, size in order}
    left = SHARE * sum(size for _, size in order)
    out: dict[str | None, Fraction] = {}
    while len(out) < len(order):
        free = [name for name, _ in order if name not in out]
        unit = left / sum(weight[n] for n in free)
        above = [n for n in free if unit * weight[n] > most[n]]
        if not above:
            return out | {n: unit * weight[n] for n in free}
        for name in above:
            out[name] = most[name]
            left -= most[name]
    return out


def arrival(share: Column, knots: tuple[tuple[float, float], ...]) -> Column:
    """The time at which the integral of the schedule reaches a share (0..1) of the whole."""
    pieces, total = [], 0.0
    for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False):
        pieces.append((total, t0, t1, w0, w1))
        total += (t1 - t0) * (w0 + w1) / 2
    want = share * total
    out = F.lit(1.0)
    for before, t0, t1, w0, w1 in reversed(pieces):
        slope, more = (w1 - w0) / (t1 - t0), want - before
        # w0 * x + slope * x * x / 2 = more, in the form that also holds for slope 0
        x = 2 * more / (w0 + F.sqrt(F.greatest(F.lit(0.0), F.lit(w0 * w0) + 2 * slope * more)))
        end = before + (t1 - t0) * (w0 + w1) / 2
        out = F.when(want <= end, F.least(F.lit(t1), t0 + x)).otherwise(out)
    return out


def _bucket(spark: SparkSession) -> Column:
    """The leading bits of the drawn hash: at least 64 buckets, and four for each task."""
    bits = max(6, (4 * partitions_of(spark) - 1).bit_length())
    return F.shiftrightunsigned("drawn", 64 - bits)


def plan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: int = 7) -> DataFrame:
    """doc_id, key (of the text), source, size, source_size, target, taken, first_time,
    second_time: when a document is due for the first and second time (null: not due)."""
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), text_key(text).alias("key"),
        F.col(source).alias("source"), word_count(text).alias("size"),
    ).withColumn("drawn", F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("key")))
    # The texts are read once; three steps follow on what was counted.
    spark = docs.sparkSession
    rows = staged(rows.withColumn("bucket", _bucket(spark)), "word-counts")
    sums = rows.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    sizes = [(r.source, r.words) for r in sums.groupBy("source").agg(F.sum("words").alias("words")).limit(MAX_SOURCES + 1).collect()]
    if len(sizes) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    due = targets(sizes)
    order = sorted(due, key=lambda s: (s is None, [ord(c) for c in s or ""]))
    size_of = dict(sizes)
    facts = spark.createDataFrame(
        [(name, size_of[name], float(due[name]), int(due[name]), i % len(SCHEDULES)) for i, name in enumerate(order)],
        "name string, source_size long, target double, words_due long, shape int",
    )
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        F.col("source").alias("s"), F.col("bucket").alias("b"), F.coalesce(F.sum("words").over(before), F.lit(0)).alias("offset")
    ).join(facts, F.col("s").eqNullSafe(F.col("name")))
    within = Window.partitionBy("source", "bucket").orderBy("drawn", "doc_id", "key", "size")
    rows = rows.withColumn("inside", F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, -1)))
    placed = rows.join(offsets, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
    at = F.col("offset") + F.coalesce("inside", F.lit(0))
    rows = placed.select(
        "doc_id", "key", "source", "size", at.alias("at"), "source_size", "target", "words_due", "shape"
    )

    def words(start: Column) -> Column:
        return F.greatest(F.lit(0), F.least(F.col("size"), F.col("words_due") - start))

    def time(start: Column) -> Column:
        share = start / F.col("target")
        out = arrival(share, SCHEDULES[0])
        for i, knots in enumerate(SCHEDULES[1:], 1):
            out = F.when(F.col("shape") == i, arrival(share, knots)).otherwise(out)
        return F.when(words(start) > 0, out)

    again = F.col("at") + F.col("source_size")
    return rows.select(
        "doc_id", "key", "source", "size", "source_size", "target",
        (words(F.col("at")) + words(again)).alias("taken"),
        time(F.col("at")).alias("first_time"), time(again).alias("second_time"),
    )


def mixed_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The documents in training order, with all their columns: each as often as it is due,
    always whole.  Rows are sorted by position in ranges; a file holds one range."""
    parts = partitions_of(docs.sparkSession)
    none, number_of, key, times, nth, time = free_names(docs, "none", "id", "key", "times", "nth", "time")
    keys = [none, number_of, key]
    row = lambda column: {none: column.isNull(), number_of: F.coalesce(column, F.lit(0))}
    due = plan(docs, doc_id, text, source).where("first_time is not null")
    due = due.select(F.col("key").alias(key), "doc_id", F.array_compact(F.array("first_time", "second_time")).alias(times))
    due = due.withColumns(row(F.col("doc_id"))).groupBy(*keys).agg(F.array_sort(F.collect_list(times)).alias(times))
    keyed = docs.withColumns(row(F.col(doc_id).cast("long")) | {key: text_key(text)})
    # Rows that repeat one another share out the times found for them; they are numbered on
    # the join's own partitioning, so the texts are not exchanged again.
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(number_of))
    timed = keyed.join(due, keys).withColumn(nth, place)
    timed = timed.withColumn(time, F.explode(F.get(times, F.col(nth) - 1)))
    ordered = timed.repartitionByRange(parts, time).sortWithinPartitions(time, number_of)
    return ordered.select(*docs.columns)
