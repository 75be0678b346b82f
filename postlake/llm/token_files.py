"""Token ids of whole texts in compressed files, and back.

Every text is tokenized once into a staged table.  The ids of all texts together give the
counts for one length-limited canonical Huffman code.  Each document is coded on its own,
documents are dealt out by ranges of doc_id, and a range becomes one Parquet file of
*blocks*: whole documents, about ``BLOCK_TOKENS`` ids, decoded without any other block.
A block carries the bit offset of every ``STEP``-th id of its documents, so the table-driven
decoder walks all offsets of a block side by side.  The code lengths lie beside the blocks.

What is collected: one count per id of the vocabulary, one total per range.

Rows: null and empty texts hold the end id alone; null doc_ids come first; rows of equal
doc_id follow each other by content; an empty table gives files without rows.
Columns other than the id and the text are left out.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.llm.common import batches, dealt_by_range, in_python, partitions_of, range_splits, staged, text_of
from postlake.llm.huffman import Codes, code_lengths
from postlake.llm.spans import encoder
from postlake.session import staging_root

STEP = 512
BLOCK_TOKENS = 1 << 20
_DOC = "doc_id long, n_tokens long, ids binary"
_RUN = "range int, doc_id long, n_tokens long, marks binary, payload binary"
_BLOCK = (
    "range int, block int, start long, doc_ids array<long>, doc_tokens array<long>, "
    "marks binary, payload binary"
)


def id_kind(size: int) -> str:
    """Two bytes for each id of a small vocabulary, else four."""
    return "<u2" if size <= 1 << 16 else "<u4"


def tokenize(docs: DataFrame, tokenizer: str, end_id: int = 0, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens and ids (little-endian, of ``id_bytes`` each), the end id last."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(tokenizer)
        kind = id_kind(tool.size)
        for batch in batches(found):
            ids, counts = tool.encode(batch["text"].to_pylist())
            counts = counts + 1
            ends = np.cumsum(counts)
            whole = np.full(len(ids) + len(counts), end_id, dtype=kind)
            own = np.ones(len(whole), dtype=bool)
            own[ends - 1] = False
            whole[own] = ids
            raw = whole.tobytes()
            edges = (ends * whole.itemsize).tolist()
            runs = [raw[a:b] for a, b in zip([0, *edges], edges, strict=False)]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(counts), pa.array(runs, pa.binary())], ["doc_id", "n_tokens", "ids"]
            )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    return in_python(rows, run, _DOC, kind="encoder")


def id_counts(tokens: DataFrame, kind: str) -> np.ndarray:
    """How often each id occurs in all rows; counted in every task before the exchange."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, dtype=np.int64)
        for batch in batches(found, "ids", 2 << 20):
            ids = np.frombuffer(b"".join(batch["ids"].to_pylist()), dtype=kind)
            more = np.bincount(ids, minlength=len(total))
            more[: len(total)] += total
            total = more
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])

    rows = in_python(tokens.select("ids"), run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max((r.id for r in rows), default=-1) + 1, dtype=np.int64)
    for r in rows:
        counts[r.id] = r.n
    return counts


def _runs(tokens: DataFrame, kind: str, lengths: np.ndarray, splits: list[int]) -> DataFrame:
    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, cuts = Codes(lengths), np.array(splits, dtype=np.int64)
        for batch in batches(found, "ids", 2 << 20):
            ids = np.frombuffer(b"".join(batch["ids"].to_pylist()), dtype=kind)
            counts = batch["n_tokens"].to_numpy()
            payload, begin, marks = codes.encode(ids, counts, STEP)
            marks = marks.astype("<u4").tobytes()
            at = 4 * np.concatenate([[0], np.cumsum(-(-counts // STEP))])
            doc_ids = batch["doc_id"]
            least = np.iinfo(np.int64).min
            place = np.searchsorted(cuts, doc_ids.fill_null(least).to_numpy(), side="right")
            cut = lambda raw, edges: [raw[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(place.astype(np.int32)), doc_ids, batch["n_tokens"],
                    pa.array(cut(marks, at), pa.binary()), pa.array(cut(payload, begin), pa.binary()),
                ],
                ["range", "doc_id", "n_tokens", "marks", "payload"],
            )

    return in_python(tokens, run, _RUN)


def _blocks(runs: DataFrame, starts: dict[int, int]) -> DataFrame:
    """Rows sorted by range and doc_id become blocks of whole documents."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, block, start = None, 0, 0
        docs: list[tuple] = []

        def closed() -> pa.RecordBatch:
            payload = b"".join(d[3] for d in docs)
            marks, before = [], 0
            for d in docs:
                marks.append(np.frombuffer(d[2], dtype="<u4").astype("<u8") + 8 * before)
                before += len(d[3])
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([place], pa.int32()), pa.array([block], pa.int32()), pa.array([start], pa.int64()),
                    pa.array([[d[0] for d in docs]], pa.list_(pa.int64())),
                    pa.array([[d[1] for d in docs]], pa.list_(pa.int64())),
                    pa.array([np.concatenate(marks).astype("<u8").tobytes()], pa.binary()),
                    pa.array([payload], pa.binary()),
                ],
                ["range", "block", "start", "doc_ids", "doc_tokens", "marks", "payload"],
            )

        size = 0
        for batch in found:
            columns = (batch[c].to_pylist() for c in ("range", "doc_id", "n_tokens", "marks", "payload"))
            for here, *doc in zip(*columns, strict=True):
                if docs and (here != place or size >= BLOCK_TOKENS):
                    yield closed()
                    block, start, docs, size = block + 1, start + size, [], 0
                if here != place:
                    place, block, start = here, 0, starts[here]
                docs.append(doc)
                size += doc[1]
        if docs:
            yield closed()

    return in_python(runs, run, _BLOCK)


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0) -> None:
    """Tokenize, code and write all documents below ``path`` in ascending doc_id order."""
    spark = docs.sparkSession
    tokens = staged(tokenize(docs, tokenizer, end_id), "token-ids")
    kind = id_kind(encoder(tokenizer).size)
    lengths = code_lengths(id_counts(tokens, kind))
    coded = [(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)]
    spark.createDataFrame(coded, "id long, bits int").coalesce(1).write.parquet(f"{path}/codes")
    parts = partitions_of(spark)
    splits = range_splits(tokens, "doc_id", parts)
    runs = _runs(tokens, kind, lengths, splits)
    cuts = np.array(splits, dtype=np.int64)

    def totals(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(cuts) + 1, dtype=np.int64)
        for batch in found:
            ids = batch["doc_id"].fill_null(np.iinfo(np.int64).min).to_numpy()
            np.add.at(total, np.searchsorted(cuts, ids, side="right"), batch["n_tokens"].to_numpy())
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["range", "n"])

    per_range = in_python(tokens.select("doc_id", "n_tokens"), totals, "range long, n long")
    size = {r.range: r.n for r in per_range.groupBy("range").agg(F.sum("n").alias("n")).collect()}
    starts, before = {}, 0
    for place in sorted(size):
        starts[place], before = before, before + size[place]
    ordered = dealt_by_range(runs, parts).sortWithinPartitions("range", "doc_id", "n_tokens", "payload")
    blocks = _blocks(ordered, starts)
    blocks.write.option("compression", "none").partitionBy("range").parquet(f"{path}/blocks")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids as little-endian 32 bits."""
    return _read(spark, path, lambda runs: pa.array(runs, pa.binary()), "ids binary")


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and the crc32 of the ids that the files hold."""
    return _read(spark, path, lambda runs: pa.array(map(zlib.crc32, runs), pa.int64()), "ids_crc32 long")


def _read(spark: SparkSession, path: str, made: Callable[[list[bytes]], pa.Array], column: str) -> DataFrame:
    lengths = _stored_lengths(spark, path)

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = Codes(lengths)
        for batch in found:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                counts = np.array(row["doc_tokens"], dtype=np.int64)
                starts, lanes = _lanes(counts)
                ids = codes.decode(row["payload"], np.frombuffer(row["marks"], dtype="<u8"), lanes)
                raw, ends = ids.astype("<u4").tobytes(), np.cumsum(counts)
                runs = [raw[4 * a : 4 * b] for a, b in zip((ends - counts).tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(row["start"] + starts), pa.array(counts), made(runs)],
                    ["doc_id", "start", "n_tokens", column.split()[0]],
                )

    return in_python(_stored_blocks(spark, path), run, f"doc_id long, start long, n_tokens long, {column}")


def _stored_lengths(spark: SparkSession, path: str) -> np.ndarray:
    rows = spark.read.schema("id long, bits int").parquet(f"{path}/codes").collect()
    lengths = np.zeros(max((r.id for r in rows), default=-1) + 1, dtype=np.uint8)
    for r in rows:
        lengths[r.id] = r.bits
    return lengths


def _stored_blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_BLOCK).parquet(f"{path}/blocks").select("start", "doc_ids", "doc_tokens", "marks", "payload")


def _lanes(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids before each document, and how many ids follow each stored bit offset."""
    per_doc = -(-counts // STEP)
    lanes = np.full(int(per_doc.sum()), STEP, dtype=np.int64)
    lanes[np.cumsum(per_doc) - 1] = counts - (per_doc - 1) * STEP
    return np.cumsum(counts) - counts, lanes


def new_path(spark: SparkSession, name: str) -> str:
    return f"{staging_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
