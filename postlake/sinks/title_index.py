"""Trigram postings of posting titles, kept up with each upsert (FLT-5 without a scan of the facts).

A row of the index says that since load ``version`` the title of a posting holds a trigram, or
(``holds`` false) that it no longer does; the latest row of a trigram and posting counts.  Loads only
append, so a load costs what it changes.  Rows lie in partitions by a hash of the trigram, sorted by
it within their files: a search reads one trigram's rows.  They carry title and time, so the search is
verified and cut to the newest before a fact is read.  Postings are dealt out before their trigrams
are taken; a slice of them is sorted and written where it is, so no trigram's row is exchanged.

The index is written before the facts are replaced: a load that was cut off leaves entries that its
rerun writes again under a later version.  Until then a hit may be missing that such an entry
displaced, but none is wrong: facts are compared with the keyword once more.  Keywords without three literal characters in a row have no trigram: those scan the facts.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.operators.columns import free_names
from postlake.operators.filters import title_like
from postlake.sinks import keyed

GRAM_PARTITION = "gram_part"
LOADS = "postlake.loads"
PARTS = "postlake.parts"
SLICE_ROWS = 1 << 17
"""Postings whose trigrams one task sorts, in memory, and writes to a file for each partition."""


def grams(title: Column) -> Column:
    """Distinct trigrams of the lower-cased title; none where it is NULL or shorter."""
    text = F.lower(title)
    starts = F.sequence(F.lit(1), F.char_length(text) - 2)
    found = F.array_distinct(F.transform(starts, lambda i: F.substring(text, i, F.lit(3))))
    return F.when(F.char_length(text) >= 3, found).otherwise(F.expr("CAST(array() AS array<string>)"))


def grams_of_keyword(keyword: str) -> list[str]:
    """Trigrams that every title matching the keyword holds; "%" and "_" are wildcards."""
    runs = re.split("[%_]", keyword.lower())
    return sorted({run[i : i + 3] for run in runs for i in range(len(run) - 2)})


@dataclass(frozen=True)
class TitleIndex:
    """The index table of a keyed fact table."""

    table: str
    parts: int = 8
    key: str = "job_id"
    title: str = "job_title"
    ts: str = "ingested_at"

    def ready(self, spark: SparkSession) -> bool:
        """Whether the index was built whole; one whose building was cut off was not."""
        return spark.catalog.tableExists(self.table) and self._property(spark, LOADS) is not None

    def build(self, facts: DataFrame) -> None:
        """The index of all facts, in place of any earlier one."""
        spark = facts.sparkSession
        spark.sql(f"DROP TABLE IF EXISTS {self.table}")
        self._append(self._all_held(facts), 0, self.parts)
        spark.sql(f"ALTER TABLE {self.table} SET TBLPROPERTIES ('{LOADS}' = '0', '{PARTS}' = '{self.parts}')")

    def note(self, changed: DataFrame, old: DataFrame | None = None) -> None:
        """Rows about to be written, and the rows of the same parts they replace (None: no
        facts yet)."""
        spark = changed.sparkSession
        if old is None:
            self.build(changed)
            return
        was, at, known, entry = free_names(changed.columns, "was", "at", "known", "entry")
        before = old.select(
            self.key, F.col(self.title).alias(was), F.col(self.ts).alias(at), F.lit(True).alias(known)
        )
        same = F.col(self.title).eqNullSafe(F.col(was)) & F.col(self.ts).eqNullSafe(F.col(at))
        new = changed.select(self.key, self.title, self.ts).join(before, self.key, "left")
        new = new.where(F.col(known).isNull() | ~same)
        held = grams(F.col(self.title))
        both = F.concat(_said(held, True), _said(F.array_except(grams(F.col(was)), held), False))
        dealt = self._dealt(new.select(self.key, self.title, self.ts, was), changed.count())
        rows = dealt.select(self.key, self.title, self.ts, F.explode(both).alias(entry))
        # The number is taken before rows are written: a rerun writes under a later one.
        version = int(self._property(spark, LOADS)) + 1
        spark.sql(f"ALTER TABLE {self.table} SET TBLPROPERTIES ('{LOADS}' = '{version}')")
        rows = rows.select(f"{entry}.*", self.key, self.title, self.ts)
        self._append(rows, version, int(self._property(spark, PARTS)))

    def newest(self, spark: SparkSession, keyword: str, limit: int) -> DataFrame | None:
        """Keys of the newest ``limit`` postings whose titles match; None if the index cannot tell."""
        wanted = grams_of_keyword(keyword)
        if not wanted:
            return None
        index, parts = spark.table(self.table), int(self._property(spark, PARTS))

        def rows_of(chosen: list[str]) -> DataFrame:
            lies_in = [F.pmod(F.hash(F.lit(gram)), F.lit(parts)) for gram in chosen]
            return index.where(F.col(GRAM_PARTITION).isin(lies_in) & F.col("gram").isin(chosen))

        # One number for each trigram of the keyword, from a scan of that column alone.
        sizes = {r.gram: r["count"] for r in rows_of(wanted).groupBy("gram").count().collect()} if wanted[1:] else {}
        rarest = min(wanted, key=lambda gram: (sizes.get(gram, 0), gram))
        # Titles are compared before rows are exchanged: a flag travels in their place.
        matches = (F.col("holds") & title_like(keyword, self.title)).alias("matches")
        said = F.struct("version", matches, self.ts)
        latest = rows_of([rarest]).groupBy(self.key).agg(F.max(said).alias("_last")).select(self.key, "_last.*")
        found = latest.where("matches")
        return found.orderBy(F.col(self.ts).desc(), F.col(self.key).desc()).limit(limit).select(self.key)

    def narrowed(self, facts: DataFrame, parts: int, keyword: str, limit: int) -> DataFrame:
        """The facts among which the newest matches are: at most ``limit`` rows where the index
        can tell, found by their parts (of ``parts``) and keys; else all."""
        keys = self.newest(facts.sparkSession, keyword, limit)
        if keys is None:
            return facts
        keys = keys.withColumn(keyed.KEY_PARTITION, keyed.key_part(self.key, parts))
        return facts.join(F.broadcast(keys), [keyed.KEY_PARTITION, self.key], "left_semi")

    def _property(self, spark: SparkSession, name: str) -> str | None:
        rows = spark.sql(f"SHOW TBLPROPERTIES {self.table}").where(F.col("key") == name).collect()
        return rows[0].value if rows else None

    def _dealt(self, rows: DataFrame, at_most: int) -> DataFrame:
        """Postings in slices, by key: few rows make one slice, a hot trigram is in many."""
        return rows.repartition(max(1, math.ceil(at_most / SLICE_ROWS)), self.key)

    def _all_held(self, facts: DataFrame) -> DataFrame:
        rows = self._dealt(facts.select(self.key, self.title, self.ts), facts.count())
        held = F.explode(grams(F.col(self.title))).alias("gram")
        return rows.select(held, F.lit(True).alias("holds"), self.key, self.title, self.ts)

    def _append(self, rows: DataFrame, version: int, parts: int) -> None:
        to = _laid(rows, version, parts).write.format("parquet").option("compression", "zstd")
        to.mode("append").partitionBy(GRAM_PARTITION).saveAsTable(self.table)


def _laid(rows: DataFrame, version: int, parts: int) -> DataFrame:
    """Rows as they are written: sorted in their tasks, without an exchange."""
    rows = rows.withColumns(
        {"version": F.lit(version).cast("long"), GRAM_PARTITION: F.pmod(F.hash("gram"), F.lit(parts))}
    )
    return rows.sortWithinPartitions(GRAM_PARTITION, "gram")


def _said(found: Column, holds: bool) -> Column:
    return F.transform(found, lambda gram: F.struct(gram.alias("gram"), F.lit(holds).alias("holds")))


def upsert_indexed(source: DataFrame, table: str, key: str, index: TitleIndex, **rule) -> list[int]:
    """An upsert into a keyed table that keeps the index; facts without one are indexed first."""
    spark = source.sparkSession
    if spark.catalog.tableExists(table):
        keyed.settle(spark, table, key)
        if not index.ready(spark):
            index.build(spark.table(table))
    return keyed.upsert_keyed(source, table, key, before=index.note, **rule)
