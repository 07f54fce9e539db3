import hashlib
import random
import zlib

import numpy as np
import pytest

from featuremart.llm import periodic
from featuremart.llm.queries import op12_difference_cover_runs


def brute(words):
    """Runs by looking at every period."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if length >= max(6, 4 * q):
                found.setdefault((i, length), q)
            i = max(j, i + 1) if j == i else j + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def runs_of(words):
    return [tuple(r) for r in periodic.block_runs([words])[0].tolist()]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def planted(key, text):
    words = (text or "").encode().split()
    n = len(words)
    h = None if key is None else zlib.crc32(str(key).encode())
    if h is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def expected(key, text):
    words = planted(key, text)
    runs = brute(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    left = b" ".join(w for i, w in enumerate(words) if i not in gone).decode()
    return (
        key, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
        sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(left),
    )


@pytest.mark.parametrize("letters", ["a", "ab", "abc", "abcdefgh"])
def test_runs_are_those_of_brute_force(letters):
    rng = random.Random(letters)
    for n in [0, 1, 5, 6, 7, 8, 12, 30, 120]:
        for _ in range(25):
            words = [rng.choice(letters).encode() for _ in range(n)]
            if n > 8:
                at, p = rng.randrange(n), rng.randint(1, max(1, n // 5))
                words = [w if i < at else words[at + (i - at) % p] for i, w in enumerate(words)]
            assert runs_of(words) == brute(words)


def test_documents_of_a_block_stay_apart():
    rng = random.Random(1)
    docs = [[b"a"] * 5, [b"a"] * 5, [], [b"a"] * 7, [b"a", b"b"] * 9, [b"b", b"a"] * 9]
    docs += [[rng.choice([b"x", b"y"]) for _ in range(rng.randrange(200))] for _ in range(60)]
    got = periodic.block_runs(docs)
    assert [[tuple(r) for r in g.tolist()] for g in got] == [brute(d) for d in docs]


def test_extensions_are_those_of_brute_force():
    rng = np.random.default_rng(2)
    for size, letters in [(1, 1), (5, 1), (20, 2), (300, 1), (300, 2), (900, 3)]:
        words = np.append(rng.integers(0, letters, size), letters)
        if size > 100:
            words[150:250] = words[20:120]
        find = periodic.Extensions(words)
        a, b = rng.integers(0, len(words), (2, 400))
        a, b = a[a != b], b[a != b]
        for i, j, n in zip(a, b, find(a, b), strict=True):
            want = 0
            while max(i, j) + want < len(words) and words[i + want] == words[j + want]:
                want += 1
            assert n == want
    assert len(find.samples) <= 5 * (len(words) // 21 + 1)


def test_cover_synchronises_all_residues():
    for a in range(periodic.MODULUS):
        for b in range(periodic.MODULUS):
            step = periodic.SYNCHRONISE[a, b]
            assert {(a + step) % periodic.MODULUS, (b + step) % periodic.MODULUS} <= set(periodic.COVER.tolist())


def test_edge_rows(spark, documents):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "a a a a a a"), (4, "a a a a a a"), (None, "x y " * 5),
            (7, "one two"), (8, "p q r " * 30_000), (9, "  é z " * 6), *[(i, "w v u " + "a b c " * 9) for i in range(10, 60)]]
    got = sorted(map(tuple, periodic.digests(periodic.with_planted_periods(documents(*rows))).collect()), key=str)
    want = [expected(k, t) for k, t in rows if k != 8]
    long = [r for r in got if r[0] == 8]
    assert len(long) == 1 and long[0][1:5] == (1, 0, 90_000, 3) and long[0][7] == sha("p q r")
    assert [r for r in got if r[0] != 8] == sorted(want, key=str)
    assert periodic.digests(periodic.with_planted_periods(documents(*rows).limit(0))).count() == 0


def test_query_is_brute_force_on_all_documents(spark, table):
    got = {r.doc_id: tuple(r) for r in op12_difference_cover_runs(spark, "/root/testdata/sf0.001").collect()}
    docs = table("documents", "sf0.001").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for row in docs:
        assert got[row.doc_id] == expected(row.doc_id, row.text)
    assert sum(r[1] > 0 for r in got.values()) > 5
