"""Spelling variants: words one edit apart, found by k-d trees over their letter counts.

One inserted or deleted letter changes one count of a word by one; one replaced letter takes one
from a count and adds one to another, an L1 distance of two.  So for each pair of lengths (equal,
or one apart) the partners of a word lie in a small box around its counts.

The vocabulary of a length is cut by a k-d tree into *shards*; its planes are fitted on a sample
of at most ``SAMPLE`` words, so it has at most ``MOST_SHARDS`` leaves, but every word is indexed.
A word lives in one shard and is sent as a query to those whose box is within its reach: a path
may be crossed against the word's own count at most once upwards and once downwards, so it goes
to a few shards and not to all.  In a shard a second tree, of all its words, is searched in the
same way, and the words of its last boxes are compared by the parity of their counts, then
letter by letter.

A word's *form* is its near word of largest count if that is at least twice its own.  Counts grow
along forms, so a chain is no longer than the logarithm of the largest count; roots are found
by joining the forms with themselves until nothing changes.

Rows: null and empty texts have no words; a null doc_id reads as the empty text in the rule that
deletes letters; repeated rows count again; an empty table gives no rows; very long texts and
runs are counted whole; other columns are left out.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.llm.common import batches, in_python, partitions_of, staged, text_of

LETTERS = 26 + 64
"""a-z and U+00C0-U+00FF, each one byte of Latin-1."""
SHARD = 4096
SAMPLE = 1 << 18
MOST_SHARDS = 1 << 14
BUCKET = 16
QUERIES = 4096
_RUN = re.compile(rb"(?:[a-z]+|\xc3[\x80-\xbf])+")
_AT_ONCE = 200_000
_PLACE = np.zeros(256, dtype=np.int64)
_PLACE[0x61:0x7B] = np.arange(26)
_PLACE[0xC0:0x100] = np.arange(26, LETTERS)


# --- words ----------------------------------------------------------------------------


def _slipped(doc: bytes, run: bytes, one_in: int) -> bytes:
    """The run, or the run without a letter if the checksum says so."""
    h = zlib.crc32(doc + run)
    if h % one_in:
        return run
    letters = run.decode()
    at = h % len(letters)
    return (letters[:at] + letters[at + 1 :]).encode()


def vocabulary(
    docs: DataFrame, *, shortest: int = 5, fewest: int = 3, slips: int = 0, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """word and n of the runs of letters of whole texts, A-Z in lower case.

    ``slips`` deletes a letter of one in so many runs, by the checksum of document and run: known
    misspellings to measure by."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def counted() -> pa.RecordBatch:
            words = pa.array(list(counts), pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(list(counts.values()), pa.int64())], ["word", "n"])

        for batch in batches(found):
            for doc, raw in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                name = b":" if doc is None else b"%d:" % doc
                for word, n in Counter(_RUN.findall(raw.lower())).items():
                    if len(word) < shortest:
                        continue
                    if slips:
                        word = _slipped(name, word, slips)
                    if len(word) - word.count(b"\xc3") >= shortest:
                        counts[word] += n
            if len(counts) > _AT_ONCE:
                yield counted()
                counts = Counter()
        yield counted()

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    words = in_python(rows, run, "word string, n long")
    return words.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= fewest)


# --- trees ----------------------------------------------------------------------------


def letter_counts(words: list[bytes]) -> np.ndarray:
    """A row of LETTERS counts for each word in Latin-1."""
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    flat = _PLACE[np.frombuffer(b"".join(words), dtype=np.uint8)]
    row = np.repeat(np.arange(len(words)), lengths)
    counts = np.bincount(row * LETTERS + flat, minlength=len(words) * LETTERS)
    return counts.astype(np.int32).reshape(-1, LETTERS)


class Tree:
    """A k-d tree: ``letter`` and ``most`` (the largest count on the left) of each inner node,
    its children, and -1 - leaf in place of a child that is a leaf."""

    def __init__(self, counts: np.ndarray, leaf_size: int):
        self.letter, self.most, self.children = [], [], []
        self.members: list[np.ndarray] = []
        self.root = self._built(counts, np.arange(len(counts)), leaf_size)

    def _built(self, counts: np.ndarray, rows: np.ndarray, leaf_size: int) -> int:
        cut = self._cut(counts[rows]) if len(rows) > leaf_size else None
        if cut is None:
            self.members.append(rows)
            return -len(self.members)
        node = len(self.letter)
        letter, most = cut
        self.letter.append(letter)
        self.most.append(most)
        self.children.append((0, 0))
        left = counts[rows, letter] <= most
        self.children[node] = (
            self._built(counts, rows[left], leaf_size), self._built(counts, rows[~left], leaf_size)
        )
        return node

    @staticmethod
    def _cut(counts: np.ndarray) -> tuple[int, int] | None:
        """Letter and count that halve the rows best; None if all rows are equal."""
        best, chosen = len(counts), None
        for most in range(int(counts.max())):
            below = (counts <= most).sum(axis=0)
            uneven = np.abs(2 * below - len(counts))
            letter = int(uneven.argmin())
            if uneven[letter] < best:
                best, chosen = uneven[letter], (letter, most)
        return chosen

    def reached(self, counts: np.ndarray, up: int, down: int) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, rows of ``counts``) whose box holds a point that one count more (if ``up``) and
        one less (if ``down``) can lead to.

        A second step in one direction is never within reach, so a plane that was crossed
        needs no memory of by how much."""
        rows = np.arange(len(counts))
        waiting = [(self.root, rows, np.full(len(rows), up, dtype=np.int8), np.full(len(rows), down, dtype=np.int8))]
        while waiting:
            node, rows, ups, downs = waiting.pop()
            if not len(rows):
                continue
            if node < 0:
                yield -1 - node, rows
                continue
            over = counts[rows, self.letter[node]] - self.most[node]
            fewer, more = np.maximum(over, 0), np.maximum(1 - over, 0)
            left, right = self.children[node]
            ok = fewer <= downs
            waiting.append((left, rows[ok], ups[ok], downs[ok] - fewer[ok].astype(np.int8)))
            ok = more <= ups
            waiting.append((right, rows[ok], ups[ok] - more[ok].astype(np.int8), downs[ok]))


def _fitted(words: DataFrame, shard: int) -> dict[int, Tree]:
    """A tree of shards for each length, from a bounded sample by hash."""
    total = words.count()
    sample = words.orderBy(F.xxhash64("word"), "word").limit(SAMPLE).select("word").toArrow()["word"].to_pylist()
    by_length: dict[int, list[bytes]] = {}
    for word in sample:
        by_length.setdefault(len(word), []).append(word.encode("latin-1"))
    leaf = max(shard * len(sample) // max(total, 1), SAMPLE // MOST_SHARDS, 1)
    trees = {length: Tree(letter_counts(found), leaf) for length, found in by_length.items()}
    for tree in trees.values():
        tree.members = []  # only the planes are sent to the tasks
    return trees


def _routed(words: DataFrame, trees: dict[int, Tree]) -> DataFrame:
    """Every word in the shard it lives in (role 0), as a query in those of its own length (1)
    and of the next (2)."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in found:
            for start in range(0, whole.num_rows, QUERIES):
                batch = whole.slice(start, QUERIES)
                raw = [w.encode("latin-1") for w in batch["word"].to_pylist()]
                lengths = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
                for length in np.unique(lengths):
                    rows = np.flatnonzero(lengths == length)
                    counts = letter_counts([raw[i] for i in rows])
                    own, next_ = trees.get(int(length)), trees.get(int(length) + 1)
                    lives = np.zeros(len(rows), dtype=np.int64)
                    parts = []
                    if own:
                        for leaf, at in own.reached(counts, 0, 0):
                            lives[at] = leaf
                        for leaf, at in own.reached(counts, 1, 1):
                            at = at[lives[at] != leaf]
                            parts.append((length, leaf, 1, rows[at]))
                    for leaf in np.unique(lives):
                        parts.append((length, leaf, 0, rows[lives == leaf]))
                    if next_:
                        parts += [(length + 1, leaf, 2, rows[at]) for leaf, at in next_.reached(counts, 1, 0)]
                    else:
                        parts.append((length + 1, 0, 2, rows))
                    sizes = [len(p[3]) for p in parts]
                    take = pa.array(np.concatenate([p[3] for p in parts]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat([int(p[k]) for p in parts], sizes), pa.int32()) for k in range(3)]
                        + [batch["word"].take(take), batch["n"].take(take)],
                        ["length", "shard", "role", "word", "n"],
                    )

    return in_python(words.select("word", "n"), run, "length int, shard int, role int, word string, n long")


# --- near words -----------------------------------------------------------------------


def _parities(words: list[bytes]) -> np.ndarray:
    """A bit for the parity of each letter's count; letters 64 apart share one."""
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    bits = np.uint64(1) << (_PLACE[np.frombuffer(b"".join(words), dtype=np.uint8)] % 64).astype(np.uint64)
    return np.bitwise_xor.reduceat(bits, np.cumsum(lengths) - lengths)


def _one_edit(shorter: np.ndarray, longer: np.ndarray) -> np.ndarray:
    """Rows of letters: whether one replaced or, where widths differ, one inserted letter leads
    from one to the other."""
    width = shorter.shape[1]
    same = shorter == longer[:, :width]
    if width == longer.shape[1]:
        return same.sum(axis=1) == width - 1
    ahead = np.logical_and.accumulate(same, axis=1).sum(axis=1)
    after = np.logical_and.accumulate((shorter == longer[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return ahead + after >= width


def _pairs(members: list[bytes], queries: list[bytes], shorter: bool) -> tuple[np.ndarray, np.ndarray]:
    """(query, member) rows that are one edit apart; all words of a side have one length."""
    tree = Tree(letter_counts(members), BUCKET)
    bits, letters = _parities(members), np.frombuffer(b"".join(members), dtype=np.uint8).reshape(len(members), -1)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for start in range(0, len(queries), QUERIES):
        part = queries[start : start + QUERIES]
        own_bits, own = _parities(part), np.frombuffer(b"".join(part), dtype=np.uint8).reshape(len(part), -1)
        for leaf, rows in tree.reached(letter_counts(part), 1, 0 if shorter else 1):
            held = tree.members[leaf]
            near = np.bitwise_count(own_bits[rows][:, None] ^ bits[held]) <= (1 if shorter else 2)
            q, m = np.nonzero(near)
            q, m = rows[q], held[m]
            ok = _one_edit(own[q], letters[m])
            found.append((q[ok] + start, m[ok]))
    empty = np.zeros(0, dtype=np.int64)
    return tuple(np.concatenate([empty, *(f[k] for f in found)]) for k in (0, 1))


def _searched(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    """Of a shard: a row for each word that lives here or found something here, with its count,
    how many near words it has here and the best of them."""
    table = pa.Table.from_batches(held)
    role, n = table["role"].to_numpy(), table["n"].to_numpy()
    text = table["word"].to_pylist()
    words = [w.encode("latin-1") for w in text]
    rank = np.empty(len(words), dtype=np.int64)
    rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    living = np.flatnonzero(role == 0)
    ours, theirs = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    for asking, shorter in ((np.flatnonzero(role < 2), False), (np.flatnonzero(role == 2), True)):
        if not len(living) or not len(asking):
            continue
        q, m = _pairs([words[i] for i in living], [words[i] for i in asking], shorter)
        ours.append(asking[q])
        theirs.append(living[m])
        if shorter:
            ours.append(living[m])
            theirs.append(asking[q])
    a, b = np.concatenate(ours), np.concatenate(theirs)
    order = np.lexsort((rank[b], -n[b], a))
    a, b = a[order], b[order]
    first = np.ones(len(a), dtype=bool)
    first[1:] = a[1:] != a[:-1]
    near = np.bincount(a, minlength=len(words))
    best = np.full(len(words), -1, dtype=np.int64)
    best[a[first]] = b[first]
    shown = np.flatnonzero((role == 0) | (near > 0))
    has = best[shown] >= 0
    forms = [text[i] if ok else None for i, ok in zip(best[shown].tolist(), has.tolist(), strict=True)]
    return pa.RecordBatch.from_arrays(
        [
            table["word"].take(pa.array(shown)).combine_chunks(), pa.array(n[shown]), pa.array(near[shown], pa.int64()),
            pa.array(np.where(has, n[best[shown]], 0)), pa.array(forms, pa.string()),
        ],
        ["word", "n", "n_near", "form_n", "form"],
    )


def near_words(words: DataFrame, shard: int = SHARD) -> DataFrame:
    """word, n, n_near, form_n and form (the best near word, whatever its count) of ``words``."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        key = None
        for batch in found:
            if not batch.num_rows:
                continue
            length, shards = batch["length"].to_numpy(), batch["shard"].to_numpy()
            cut = np.flatnonzero((np.diff(length) != 0) | (np.diff(shards) != 0)) + 1
            edges = [0, *cut.tolist(), batch.num_rows]
            for start, end in zip(edges, edges[1:], strict=False):
                here = (length[start], shards[start])
                if held and here != key:
                    yield _searched(held)
                    held = []
                key = here
                held.append(batch.slice(start, end - start))
        if held:
            yield _searched(held)

    rows = _routed(words, _fitted(words, shard))
    grouped = rows.repartition("length", "shard").sortWithinPartitions("length", "shard")
    parts = in_python(grouped, run, "word string, n long, n_near long, form_n long, form string")
    best = F.min(F.struct((-F.col("form_n")).alias("of"), F.col("form").alias("form"))).alias("best")
    found = parts.withColumn("form", F.when(F.col("n_near") > 0, F.col("form"))).groupBy("word").agg(
        F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best
    )
    return found.select("word", "n", "n_near", (-F.col("best.of")).alias("form_n"), F.col("best.form").alias("form"))


def rooted(forms: DataFrame) -> DataFrame:
    """``forms`` (word, form) with root, the end of the chain of forms."""
    steps = staged(forms.select("word", F.coalesce("form", "word").alias("root")), "roots")
    while True:
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        following = staged(
            steps.join(onward, "root").select("word", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved")), "roots"
        )
        steps = following.select("word", "root")
        if following.where("moved").isEmpty():
            return forms.join(steps, "word")


def variants(words: DataFrame, *, times: int = 2, shard: int = SHARD) -> DataFrame:
    """word, form, root, n, n_near and form_n of ``words`` (word, n); a form has at least
    ``times`` the count of its word."""
    words = staged(words.repartition(partitions_of(words.sparkSession), "word"), "words")
    near = near_words(words, shard)
    chosen = (F.col("n_near") > 0) & (F.col("form_n") >= times * F.col("n"))
    forms = near.withColumns({"form": F.when(chosen, F.col("form")), "form_n": F.when(chosen, F.col("form_n"))})
    forms = staged(forms, "forms")
    return rooted(forms).select("word", "form", "root", "n", "n_near", "form_n")
