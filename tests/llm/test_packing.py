import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from featuremart.llm import bpe, packing
from featuremart.llm.bpe import Encoder
from featuremart.llm.queries import tokenizer_path

ODD_TEXTS = [
    "", " ", "  ", "\n", "a", " a", "a ", "a  b", "a   b\n\n c", "x\ny\nz", "x \n y", "don't we'll I'm",
    "tab\there", "no break　wide", "<|endoftext|>", "a <|endoftext|> b<|endoftext|>", "été 日本語 🙂 12 3",
    "line\r\nother\r\n", "a \x1c b", "end.\n", "\n\nstart", "a b  c", "'s 's", "1  2   3    4",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path())


def test_ids_are_those_of_the_whole_text(spark, tokenizer):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    texts += ODD_TEXTS
    ours = Encoder(tokenizer_path())
    for _ in range(2):  # cold and warm
        for text, ids in zip(texts, ours.encode(texts), strict=True):
            want = tokenizer.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(ids, dtype="<u4").tolist() == want, text
    assert ours.encode([None]) == [b""]


def test_random_white_space(tokenizer):
    rng = np.random.default_rng(3)
    alphabet = list("ab1.,' \n\t é<>|") + ["  ", " \n", "word", "'ll"]
    texts = ["".join(rng.choice(alphabet, int(rng.integers(1, 30)))) for _ in range(3000)]
    for text, ids in zip(texts, Encoder(tokenizer_path()).encode(texts), strict=True):
        assert np.frombuffer(ids, dtype="<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def check(rows, texts, tokenizer, length=2048):
    """All documents are there whole, cut by the rule, and the places are gapless."""
    want = sorted(
        (d is None, d or 0, p, s, n, c)
        for d, t in texts
        for p, s, n, c in brute_pieces(tokenizer, t, length)
    )
    assert sorted((r.doc_id is None, r.doc_id or 0, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for spans in by.values():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at
            at += n
        assert at <= length
    return len(by), -(-sum(r.length for r in rows) // length)


def brute_pieces(tokenizer, text, length):
    ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
    first = len(ids) % length or length
    start, stop, out = 0, min(first, len(ids)), []
    while start < len(ids):
        out.append((len(out), start, stop - start, zlib.crc32(np.array(ids[start:stop], dtype="<u4").tobytes())))
        start, stop = stop, stop + length
    return out


def test_whole_table(spark, tokenizer):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = packing.pack(docs, tokenizer_path()).collect()
    used, least = check(rows, [(r.doc_id, r.text) for r in docs.collect()], tokenizer)
    assert used <= least * 1.01 + 1


def test_edge_rows(spark, tokenizer):
    rows = [(1, None, 5, "x"), (2, "", 5, "x"), (None, "null id", 5, "x"), (3, "word " * 9000, 5, "x")]
    rows += [(7, "same text", 1, "y")] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string, piece long, length string")
    got = packing.pack(docs, tokenizer_path()).collect()
    check(got, [(r[0], r[1]) for r in rows], tokenizer)
    assert packing.pack(docs.limit(0), tokenizer_path()).count() == 0


def test_numbering_in_many_buckets(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "ROWS_PER_BUCKET", 3)
    docs = spark.createDataFrame([(i, f"text {i % 7}") for i in range(200)], "doc_id long, text string")
    check(packing.pack(docs, tokenizer_path()).collect(), [(r.doc_id, r.text) for r in docs.collect()], tokenizer)


def fewest_bins(sizes, length):
    """Exact by search over all placements, for a few pieces."""
    sizes, best = sorted(sizes, reverse=True), [len(sizes)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(bins)
            return
        for j in {b: j for j, b in enumerate(bins)}.values():
            if bins[j] + sizes[i] <= length:
                place(i + 1, bins[:j] + [bins[j] + sizes[i]] + bins[j + 1 :])
        place(i + 1, bins + [sizes[i]])

    place(0, [])
    return best[0]


def test_bin_completion_beats_or_equals_best_fit():
    rng = np.random.default_rng(5)
    exact = 0
    for _ in range(60):
        sizes = rng.integers(1, 60, 10)
        counts = np.bincount(sizes, minlength=101)
        plan = packing.complete_bins(counts, 100)
        got = np.zeros(101, dtype=int)
        for filling, times in plan:
            assert sum(filling) <= 100 and times > 0
            np.add.at(got, list(filling), times)
        assert (got == counts).all()
        used = sum(n for _, n in plan)
        assert used <= sum(n for _, n in packing.best_fit_decreasing(counts, 100))
        exact += used == fewest_bins(sizes.tolist(), 100)
    assert exact >= 58


def test_odd_white_space_is_told_apart():
    pattern = re.compile(r"\s\s|[^\S \n]|^\s|\s\Z")
    rng = np.random.default_rng(4)
    letters = ["a", "b", " ", "\n", "\t", "\r", "\x1c", "\x85", "\xa0", "\u2028", "\u3000", "\u200b"]
    for _ in range(20_000):
        text = "".join(rng.choice(letters, rng.integers(1, 7), p=[0.4, 0.15, 0.15, 0.12, *[0.0225] * 8]))
        assert bpe.odd(text) == bool(pattern.search(text))
