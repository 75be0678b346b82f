"""Token alignment against the two libraries and plain loops over byte ranges."""

import hashlib
from collections import Counter

import sentencepiece
from tokenizers import Tokenizer

from postlake.llm import registry, token_align

A = Tokenizer.from_file(registry.BYTE_BPE)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=registry.PIECE_BPE)
ODD = [
    (1, None), (2, ""), (3, " "), (4, "  a\n\nb "), (5, "x▁y"), (6, "<|endoftext|> </s><s> <unk>"), (7, "日本語 emoji 😀 ok"),
    (8, "a" * 5000), (8, "hello world"), (8, "hello world"), (None, "hello"), (9, "\n"), (10, " x \t y\x00é"), (11, "it's " * 3000),
]


def byte_of():
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


BYTE_OF = byte_of()


def bytes_a(i):
    return bytes(BYTE_OF[c] for c in A.id_to_token(i))


def bytes_b(i):
    piece = B.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if B.is_byte(i) else piece.replace("▁", " ").encode()


def ranges(ids, entry):
    at, out = 0, []
    for i in ids:
        out.append((at, at + len(entry(i)), i))
        at = out[-1][1]
    return out


def both_sides(text):
    a, b = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)
    whole = (" " + text).encode()
    if not text or b"".join(map(bytes_a, a)) != whole or b"".join(map(bytes_b, b)) != whole:
        return [], []
    return ranges(a, bytes_a), ranges(b, bytes_b)


def brute(rows):
    found, count = [], Counter()
    for doc_id, text in rows:
        a, b = both_sides(text or "")
        links = [(x[2], y[2]) for x in a for y in b if x[0] < y[1] and y[0] < x[1]] if len(a) < 3000 else by_bytes(a, b)
        written, ia, ib = [], 0, 0
        for end in sorted({e for _, e, _ in a} & {e for _, e, _ in b}):
            own = [[], []]
            while ia < len(a) and a[ia][1] <= end:
                own[0].append(str(a[ia][2]))
                ia += 1
            while ib < len(b) and b[ib][1] <= end:
                own[1].append(str(b[ib][2]))
                ib += 1
            written.append("|".join(map(",".join, own)))
        count.update(set(links))
        found.append((doc_id, len(a), len(b), len(written), links, ";".join(written)))
    most = {}
    for (i, _), n in count.items():
        most[i] = max(most.get(i, 0), n)
    return [
        (d, n_a, n_b, n_groups, len(links), sum(count[p] == most[p[0]] for p in links), sum(count[p] for p in links),
         hashlib.sha256(text.encode()).hexdigest() if text else "")
        for d, n_a, n_b, n_groups, links, text in found
    ]


def by_bytes(a, b):
    """Pairs of token places that hold a byte together, for long texts."""
    place_a = [k for k, (s, e, _) in enumerate(a) for _ in range(s, e)]
    place_b = [k for k, (s, e, _) in enumerate(b) for _ in range(s, e)]
    return [(a[x][2], b[y][2]) for x, y in sorted(set(zip(place_a, place_b, strict=True)))]


def listed(rows):
    return sorted(tuple(-1 if v is None else v for v in r) for r in rows)


def test_documents(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert listed(registry.QUERIES["op12_token_alignment"](spark, sf_dir).collect()) == listed(brute(rows))


def test_small_slices_and_odd_texts(spark):
    table = spark.createDataFrame(ODD, "doc_id long, text string").repartition(3)
    for size in (1, 10_000, token_align.SLICE):
        found = token_align.aligned(table, registry.BYTE_BPE, registry.PIECE_BPE, slice_bytes=size)
        assert listed(found.collect()) == listed(brute(ODD))


def test_empty_table_and_clashing_names(spark):
    table = spark.createDataFrame(ODD, "slice long, pairs string").selectExpr("*", "1 AS doc_id", "'t' AS text", "2 AS places")
    found = token_align.aligned(table, registry.BYTE_BPE, registry.PIECE_BPE, doc_id="slice", text="pairs")
    assert listed(found.collect()) == listed(brute(ODD))
    assert token_align.aligned(table.limit(0), registry.BYTE_BPE, registry.PIECE_BPE).count() == 0


def test_links_themselves(spark):
    table = spark.createDataFrame([(4, "  a\n\nb "), (7, "日本語 emoji 😀 ok"), (9, None), (9, "x▁y")], "doc_id long, text string")
    found = token_align.links(table, registry.BYTE_BPE, registry.PIECE_BPE).collect()
    want = []
    for doc_id, text in ((4, "  a\n\nb "), (7, "日本語 emoji 😀 ok")):
        a, b = both_sides(text)
        ends = sorted({e for _, e, _ in a} & {e for _, e, _ in b})
        want += [(doc_id, *x, *y, sum(e < x[1] for e in ends)) for x in a for y in b if x[0] < y[1] and y[0] < x[1]]
    assert sorted(map(tuple, found)) == sorted(want)
