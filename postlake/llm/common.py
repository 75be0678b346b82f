"""Helpers the text operators share.

Words are ``[^\\x20\\x09-\\x0D]+``: exactly what ``bytes.split()`` cuts out of UTF-8.
Texts travel to Python as binary, so nothing is decoded unless characters matter.
"""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextvars import ContextVar
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import postlake
from postlake.session import staging_root, tune

SLICE_BYTES = 1 << 20
"""Python works on about this much text at a time (one longer text stays whole)."""

_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(column: str = "text") -> Column:
    """A text as bytes; null is empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def text_key(column: str = "text") -> Column:
    """Tells rows of one doc_id apart; null and empty differ."""
    return F.when(F.col(column).isNotNull(), F.xxhash64(column)).otherwise(F.lit(0).cast("long"))


_shipped: set[str] = set()


_kept: list[tuple[str, Callable[[], None]]] = []


def kept_by(kind: str, clear: Callable[[], None]) -> None:
    """Say that a worker process keeps something for tasks of a kind that follow each other."""
    _kept.append((kind, clear))


def let_go(kind: str) -> None:
    """A task of this kind begins: what others keep in this worker process goes."""
    for other, clear in _kept:
        if other != kind:
            clear()


def in_python(
    df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str, *, kind: str = ""
) -> DataFrame:
    """``mapInArrow`` with this package at hand on every executor; ``kind`` as in ``kept_by``."""

    def alone(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go(kind)
        yield from run(found)

    context = df.sparkSession.sparkContext
    if context.applicationId not in _shipped:
        package = Path(postlake.__file__).parent
        path = Path(tempfile.mkdtemp(prefix="postlake-code-")) / "postlake.zip"
        with zipfile.ZipFile(path, "w") as archive:
            for file in sorted(package.rglob("*.py")):
                archive.write(file, file.relative_to(package.parent))
        context.addPyFile(str(path))
        _shipped.add(context.applicationId)
    return df.mapInArrow(alone, schema)


_stage: ContextVar[str] = ContextVar("stage", default="")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{staging_root(spark)}/{_stage.get()}{name}-{uuid.uuid4().hex[:12]}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def _deleted(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def unstaged(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more: what came of them is written itself."""
    for table in tables:
        _deleted(table.sparkSession, table.staged_at)


def begin_stage(docs: DataFrame, *, last: bool = False) -> None:
    """Stage tables in a new folder from now on, and delete that of the stage before: its
    output is written, or ``docs`` would still read from there.  The ``last`` stage stages none."""
    spark, old = tune(docs.sparkSession), _stage.get()
    if old and not any(f"/{old}" in file for file in docs.inputFiles()):
        _deleted(spark, f"{staging_root(spark)}/{old.rstrip('/')}")
    _stage.set("" if last else f"stage-{uuid.uuid4().hex[:12]}/")


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Names like the wanted ones that no column of the table has."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = f"{name}_"
        taken.add(name.lower())
        out.append(name)
    return out


def partitions_of(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def range_splits(df: DataFrame, column: str, parts: int) -> list[int]:
    """At most ``parts - 1`` distinct values that cut a whole-number column into even ranges."""
    shares = [i / parts for i in range(1, parts)]
    if not shares:
        return []
    row = df.agg(F.percentile_approx(column, shares, 10 * parts + 1000).alias("cuts")).first()
    return sorted(set(row.cuts or []))


def range_bucket(column: str, splits: list[int]) -> Column:
    """Index of the range a value falls in; null goes to the first."""
    if not splits:
        return F.lit(0)
    cuts = F.array(*[F.lit(v).cast("long") for v in splits])
    below = F.size(F.filter(cuts, lambda cut: cut <= F.col(column)))
    return F.when(F.col(column).isNull(), 0).otherwise(below)


def dealt_by_range(df: DataFrame, parts: int, column: str = "range") -> DataFrame:
    """Range i goes to partition i, so no two ranges meet where another stays empty."""
    return df.repartitionById(parts, F.col(column).cast("int"))


def batches(found: Iterator[pa.RecordBatch], column: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of about ``size`` bytes of text."""
    for batch in found:
        if not batch.num_rows:
            continue
        lengths = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        piece = np.cumsum(lengths) // size
        edges = [0, *(np.flatnonzero(np.diff(piece)) + 1), batch.num_rows]
        for start, end in zip(edges, edges[1:], strict=False):
            yield batch.slice(start, end - start)


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of joined texts: bytes, starts and ends of all words, and the first word of each text
    (with one entry more, the number of words)."""
    joined = np.frombuffer(b"\n".join(texts), dtype=np.uint8)
    inside = np.zeros(len(joined) + 2, dtype=np.int8)
    inside[1:-1] = ~_SPACE[joined]
    step = np.diff(inside)
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    begin = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return joined, starts, ends, np.searchsorted(starts, begin)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread 64 bits over 64 bits, one to one."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 ... base**(n - 1) modulo 2**64; kept up to the length of two slices."""
    if base in _powers and len(_powers[base]) >= n:
        return _powers[base][:n]
    out = np.full(max(n, 1), base & (2**64 - 1), dtype=np.uint64)
    out[0] = 1
    np.cumprod(out, dtype=np.uint64, out=out)
    if n <= 2 * SLICE_BYTES:
        _powers[base] = out
    return out[:n]


def sums_before(values: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values, dtype=np.uint64, out=out[1:])
    return out


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One 64-bit hash of each run values[start:end], equal for equal runs wherever they lie."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    before = sums_before((values.astype(np.uint64) + np.uint64(1)) * powers(_BASE, len(values)))
    raw = (before[ends] - before[starts]) * powers(_BASE_INVERSE, len(values))[starts]
    return mixed(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words, and the first word of each text (and the end)."""
    joined, starts, ends, first = words_of(texts)
    return span_hashes(joined, starts, ends), first
