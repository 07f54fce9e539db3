import numpy as np
import xxhash
from pyspark.sql import types as T

from featuremart.llm import simhash
from featuremart.llm.common import components

DOCS = "doc_id long, text string, source string, row string, id long"


def brute_print(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def brute_classes(prints, ids):
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                parent[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [least.get(find(i)) for i in range(len(prints))]


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    prints = [brute_print(r.text) for r in rows]
    want = {
        (r.doc_id, f"{p:016x}", c)
        for r, p, c in zip(rows, prints, brute_classes(prints, [r.doc_id for r in rows]), strict=True)
    }
    assert {tuple(r) for r in simhash.near_duplicates(docs).collect()} == want


def test_edge_rows(spark):
    long = " ".join(f"w{i}" for i in range(50000))
    rows = [
        (3, None, "s", "a", 1), (2, "", None, "b", 2), (5, " \t\n", "s", None, 3),
        (7, "One two", "s", "c", 4), (7, "one TWO", "s", "c", 4), (None, "one two", "s", "c", 4),
        (None, "nobody else", "s", "c", 4), (9, long, "s", "c", 4), (10, long + " x", "s", "c", 4),
        (11, "Été a b c", "s", "c", 4), (12, "été a b c", "s", "c", 4),
    ]
    docs = spark.createDataFrame(rows, DOCS)
    got = sorted(map(repr, map(tuple, simhash.near_duplicates(docs).collect())))
    prints = [brute_print(r[1]) for r in rows]
    classes = brute_classes(prints, [r[0] for r in rows])
    want = sorted(repr((r[0], f"{p:016x}", c)) for r, p, c in zip(rows, prints, classes, strict=True))
    assert got == want
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(map(str, [r.doc_id for r in kept.collect()])) == sorted(
        map(str, {c if c is not None else None for c in classes})
    )
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    assert simhash.one_of_each(docs.limit(0)).count() == 0


def test_links_hold_all_pairs_in_large_cells(spark):
    rng = np.random.default_rng(1)
    seeds = rng.integers(-(2**63), 2**63 - 1, 12)
    prints = set()
    for s in seeds:  # dense neighbourhoods: cells of hundreds of members
        for _ in range(300):
            x = int(s) & (2**64 - 1)
            for b in rng.integers(0, 64, int(rng.integers(0, 7))):
                x ^= 1 << int(b)
            prints.add(x)
    prints = sorted(prints)
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "print long")
    want = brute_classes(prints, signed)
    for cell in (8, 256):
        got = {r.node: r.component for r in components(simhash.print_links(df, cell)).collect()}
        assert [got.get(p, p) for p in signed] == want


def test_pairs_are_discarded_before_they_are_verified():
    rng = np.random.default_rng(3)
    low = rng.integers(0, 2**32, 2000, dtype=np.uint64)  # one cell: the upper half is shared
    near = low[:200] ^ (np.uint64(1) << rng.integers(0, 32, 200, dtype=np.uint64))
    prints = np.unique(np.concatenate([low, near])) | np.uint64(0xABCD1234 << 32)
    links = {frozenset((i, j)) for i in range(len(prints)) for j in np.flatnonzero(
        np.bitwise_count(prints ^ prints[i]) <= 2).tolist() if i < j}
    counts = {}
    signed = prints.view(np.int64)
    at = {int(p): i for i, p in enumerate(signed)}
    found = {frozenset((at[a], at[b])) for a, b in simhash.forest(signed, counts=counts)}
    assert found <= links and len(links) >= 200
    assert len(found) <= counts["verified"] < counts["met"] / 1000
    table = simhash.distances(signed, simhash.SPANNING)
    for i, j in map(sorted, links):  # no link is discarded
        assert simhash.survivors(table, i, np.array([j]), 2).tolist() == [j]


def test_codes_are_a_numbering_of_relative_distances():
    prints = np.random.default_rng(2).integers(-(2**63), 2**63 - 1, 5000)
    table = simhash.distances(prints)
    codes = simhash.nibble_codes(table)
    relative = (table[:, 1:] - table[:, :1]).reshape(-1, 16, 4)
    for n in range(16):
        seen = {}
        for code, rel in zip(codes[:, n], map(tuple, relative[:, n]), strict=True):
            assert seen.setdefault(rel, code) == code
        assert len(set(seen.values())) == len(seen) == 16


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = {r.node: r.component for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}
    empty = spark.createDataFrame([], T.StructType(edges.schema.fields))
    assert components(empty).count() == 0
