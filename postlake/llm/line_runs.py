"""Line dedup over a suffix array of line ids, built by prefix doubling.

Texts are sequences of line ids.  Round k knows, for every place where a run of 2**k lines
begins that also begins elsewhere, the *rank* of that run among all such runs: places of
one rank form the interval of suffixes whose longest common prefix is at least 2**k.  The
next round sorts pairs of ranks, (here, 2**k lines further on), and so doubles the prefix.
A place drops out once its prefix occurs nowhere else or would leave its text; its suffix
is then in its final order.  Rounds end when no place is left: the logarithm of the longest
repeated run, not a parameter.

In an interval the earliest place, by (doc_id, line), is the original and the others are
later copies.  All lines of later copies of at least ``min_lines`` lines are deleted:
overlapping copies join to maximal runs.  Single lines (``min_lines=1``) can be asked for
as well; the default asks for two, so that a line that merely recurs stays.  With
``worded=True`` every later copy of a line that has a word goes too, and lines without one
go in longer runs only.

Every round is DataFrame work: one join of places of a text, one count per pair of ranks
(partly summed in each task, so a line that a third of all texts hold travels once from
each), a range sort of the distinct pairs and a join back, which AQE splits where it is hot.
Rounds are written to the shared folder.

Rows: a null text has no lines and stays null; an empty text is one empty line; rows equal
in doc_id and text are one document and treated alike; a null doc_id comes before all
others; an empty table gives no rows.  Other columns are kept, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlake.llm.common import free_names, staged, text_key

MIN_LINES = 2
_PLACE = ("doc", "key", "line")


def _same_place(left: str, right: str, shift: int) -> Column:
    return (
        F.col(f"{left}.doc").eqNullSafe(F.col(f"{right}.doc"))
        & (F.col(f"{left}.key") == F.col(f"{right}.key"))
        & (F.col(f"{left}.line") + shift == F.col(f"{right}.line"))
    )


def _ranked(places: DataFrame, by: tuple[str, str], *more: str) -> DataFrame:
    """Places whose pair ``by`` occurs at two places or more, with the rank of the pair and
    the first place that holds it (and columns ``more``)."""
    place = F.struct(*_PLACE)
    pairs = places.groupBy(*by).agg(F.min(place).alias("first"), F.max(place).alias("last"))
    repeated = pairs.where(F.col("first") < F.col("last")).select(*by, "first")
    order = repeated.orderBy(*by).withColumn("rank", F.monotonically_increasing_id())
    return places.join(order, list(by)).select(*_PLACE, "rank", "first", *more)


def has_word(line: Column) -> Column:
    return line.rlike(r"[^\x20\x09-\x0D]")


def suffix_rounds(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", worded: bool = False) -> list[DataFrame]:
    """Round k: (doc, key, line, rank, first) of all runs of 2**k lines that repeat; with
    ``worded`` round 0 tells whether the line has a word."""
    more = ("worded",) if worded else ()

    def of_line(x: Column) -> Column:
        ids = (F.xxhash64(x).alias("a"), F.xxhash64(F.lit(1), x).alias("b"))
        return F.struct(*ids, has_word(x).alias("worded")) if worded else F.struct(*ids)

    lines = F.transform(F.split(F.col(text), "\n", -1), of_line)
    rows = docs.where(F.col(text).isNotNull()).select(
        F.col(doc_id).cast("long").alias("doc"), text_key(text).alias("key"), F.posexplode(lines).alias("line", "id")
    )
    rows = rows.select("doc", "key", "line", "id.a", "id.b", *(f"id.{c}" for c in more))
    rounds = [staged(_ranked(rows, ("a", "b"), *more).dropDuplicates(list(_PLACE)), "line-ranks")]
    while not rounds[-1].isEmpty():
        shift = 1 << (len(rounds) - 1)
        here = rounds[-1].select(*_PLACE, F.col("rank").alias("a")).alias("here")
        there = rounds[-1].select(*_PLACE, F.col("rank").alias("b")).alias("there")
        pairs = here.join(there, _same_place("here", "there", shift)).select("here.*", "b")
        rounds.append(staged(_ranked(pairs, ("a", "b")), "line-ranks"))
    return rounds[:-1]


def copied_runs(rounds: list[DataFrame], min_lines: int = MIN_LINES, worded: bool = False) -> DataFrame | None:
    """(doc, key, start, stop, longest): maximal runs of deleted lines of each text, and the
    longest power of two for which so many lines of one run lie together at one earlier place."""
    least = (min_lines - 1).bit_length()
    if 1 << least != min_lines:
        raise ValueError("min_lines is a power of two")
    copies = None
    longer = [*enumerate(rounds)][least:]
    single = [(0, rounds[0].where("worded"))] if worded and least and rounds else []
    for level, places in single + longer:
        later = places.where(F.struct(*_PLACE) != F.col("first")).select(*_PLACE, F.lit(1 << level).alias("lines"))
        copies = later if copies is None else copies.union(later)
    if copies is None:
        return None
    copies = copies.groupBy(*_PLACE).agg(F.max("lines").alias("lines")).withColumn("stop", F.col("line") + F.col("lines"))
    text = Window.partitionBy("doc", "key").orderBy("line")
    reached = F.max("stop").over(text.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(reached.isNull() | (F.col("line") > reached), 1).otherwise(0)
    runs = copies.withColumn("begins", begins).withColumn("run", F.sum("begins").over(text))
    return runs.groupBy("doc", "key", "run").agg(
        F.min("line").alias("start"), F.max("stop").alias("stop"), F.max("lines").alias("longest")
    )


def without_copied_runs(
    docs: DataFrame,
    min_lines: int = MIN_LINES,
    doc_id: str = "doc_id",
    text: str = "text",
    out: str = "line_dedup",
    worded: bool = False,
) -> DataFrame:
    """``docs`` with a struct column ``out`` (in place of any of that name): n_lines, n_removed,
    n_runs, longest_copy and kept (the text without the deleted lines)."""
    lines = F.split(F.col(text), "\n", -1)
    total = F.coalesce(F.size(lines), F.lit(0))
    total = F.when(F.col(text).isNull(), 0).otherwise(total)
    runs = copied_runs(suffix_rounds(docs, doc_id, text, worded), min_lines, worded)
    if runs is None:
        none = F.lit(0)
        parts = F.struct(
            total.alias("n_lines"), none.alias("n_removed"), none.alias("n_runs"), none.alias("longest_copy"),
            F.col(text).alias("kept"),
        )
        return docs.withColumn(out, parts)
    doc, key, gone, longest = free_names(docs, "doc", "key", "gone", "longest")
    per_text = runs.groupBy(F.col("doc").alias(doc), F.col("key").alias(key)).agg(
        F.array_sort(F.collect_list(F.struct("start", "stop"))).alias(gone), F.max("longest").alias(longest)
    )
    same = F.col(doc_id).cast("long").eqNullSafe(F.col(doc)) & (text_key(text) == F.col(key))
    joined = docs.join(per_text, same, "left")
    zero = F.array(F.lit(0))
    kept_from = F.concat(zero, F.col(gone)["stop"])
    kept_to = F.concat(F.col(gone)["start"], F.array(total))
    pieces = F.zip_with(kept_from, kept_to, lambda a, b: F.slice(lines, a + 1, b - a))
    removed = F.aggregate(gone, F.lit(0), lambda n, r: n + r["stop"] - r["start"])
    changed = F.col(gone).isNotNull()
    parts = F.struct(
        total.alias("n_lines"),
        F.when(changed, removed).otherwise(0).alias("n_removed"),
        F.when(changed, F.size(gone)).otherwise(0).alias("n_runs"),
        F.coalesce(longest, F.lit(0)).alias("longest_copy"),
        F.when(changed, F.array_join(F.flatten(pieces), "\n")).otherwise(F.col(text)).alias("kept"),
    )
    return joined.select(*(docs[c] for c in docs.columns if c != out), parts.alias(out))


def oracle(min_lines: int = MIN_LINES) -> str:
    """The same in SQL: window texts of every power of two, up to the lines of a text, compared
    as text."""
    return f"""
    WITH docs AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
    places AS (
      SELECT doc_id, ls, len(ls) AS n, unnest(range(len(ls)))::BIGINT AS i FROM docs),
    sized AS (SELECT *, unnest([1::BIGINT << k FOR k IN range(floor(log2(n))::BIGINT + 1)]) AS w FROM places),
    windows AS (
      SELECT doc_id, i, w, array_to_string(ls[i + 1 : i + w], chr(10)) AS body FROM sized
      WHERE w >= {min_lines} AND i + w <= n),
    ranked AS (
      SELECT doc_id, i, w, row_number() OVER (PARTITION BY w, body ORDER BY doc_id, i) AS place FROM windows),
    later AS (SELECT doc_id, i, w FROM ranked WHERE place > 1),
    gone AS (
      SELECT DISTINCT p.doc_id, p.i FROM places p
      JOIN later l ON l.doc_id = p.doc_id AND p.i >= l.i AND p.i < l.i + {min_lines} AND l.w = {min_lines}),
    starts AS (
      SELECT g.doc_id, count(*) AS n_removed,
        count(*) FILTER (WHERE b.i IS NULL) AS n_runs
      FROM gone g LEFT JOIN gone b ON b.doc_id = g.doc_id AND b.i = g.i - 1 GROUP BY g.doc_id),
    longest AS (SELECT doc_id, max(w) AS longest_copy FROM later GROUP BY doc_id),
    kept AS (
      SELECT p.doc_id, string_agg(p.ls[p.i + 1], chr(10) ORDER BY p.i) AS body FROM places p
      ANTI JOIN gone g ON g.doc_id = p.doc_id AND g.i = p.i GROUP BY p.doc_id)
    SELECT d.doc_id,
      coalesce(len(d.ls), 0)::INTEGER AS n_lines,
      coalesce(s.n_removed, 0)::INTEGER AS n_removed,
      coalesce(s.n_runs, 0)::INTEGER AS n_runs,
      coalesce(l.longest_copy, 0)::INTEGER AS longest_copy,
      sha256(coalesce(k.body, '')) AS kept_sha256
    FROM docs d LEFT JOIN starts s USING (doc_id) LEFT JOIN longest l USING (doc_id) LEFT JOIN kept k USING (doc_id)
    """
