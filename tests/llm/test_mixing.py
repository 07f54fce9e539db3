import random
import re
from collections import Counter, defaultdict

import pytest

from featuremart.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_targets_stop_and_share_again():
    # Weights 3, 1, 2, 3 by code point, null last.
    got = mixing.targets({"b": 100, "a": 10, "B": 400, None: 90})
    assert list(got) and got["a"] == 20  # 3, 1, 2, 3 go to B, a, b, None
    assert sum(got.values()) == pytest.approx(1.5 * 600)
    level = {s: t for s, t in got.items() if t < 2 * {"b": 100, "a": 10, "B": 400, None: 90}[s] - 1e-9}
    weight = {"B": 3, "a": 1, "b": 2, None: 3}
    assert len({round(t / weight[s], 6) for s, t in level.items()}) <= 1
    assert mixing.targets({"a": 0, "b": 0}) == {"a": 0.0, "b": 0.0} and mixing.targets({}) == {}


def test_flight_keeps_both_totals():
    draw = random.Random(4)
    for n in (1, 2, 3, 50, 2000):
        sizes = [draw.randrange(0, 900) for _ in range(n)]
        chances = [draw.random() for _ in range(n)]
        after = mixing.flight(sizes, chances, draw)
        assert sum(0 < p < 1 for p in after) <= 2
        assert sum(after) == pytest.approx(sum(chances), abs=1e-5)
        words = sum(s * p for s, p in zip(sizes, chances, strict=True))
        assert sum(s * p for s, p in zip(sizes, after, strict=True)) == pytest.approx(words, abs=1e-3)
        assert set(mixing.landing(sizes, after)) <= {0.0, 1.0}


def test_flight_is_unbiased():
    draw = random.Random(8)
    sizes, chances = [5, 9, 2, 14, 7, 7], [0.3, 0.6, 0.5, 0.2, 0.7, 0.4]
    total = [0.0] * 6
    for _ in range(4000):
        for i, p in enumerate(mixing.flight(sizes, chances, draw)):
            total[i] += p
    assert [t / 4000 for t in total] == pytest.approx(chances, abs=0.04)


@pytest.mark.parametrize("group_rows", [50_000, 20])
def test_whole_table(table, group_rows):
    docs = table("documents")
    rows = mixing.mix(docs, group_rows=group_rows).collect()
    texts = {r.doc_id: (r.text, r.source) for r in docs.collect()}
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        text, source = texts[r.doc_id]
        assert r.size == len(WORD.findall(text)) and 0 <= r.taken <= 2 * r.size
        sizes[source] += r.size
        taken[source] += r.taken
    want = mixing.targets(sizes)
    for r in rows:
        assert r.source_size == sizes[texts[r.doc_id][1]] and r.target == want[texts[r.doc_id][1]]
    for source, target in want.items():
        assert abs(taken[source] - target) < (0.01 if group_rows > 20 else 0.1) * target + 5
    again = mixing.mix(docs.repartition(7), group_rows=group_rows).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, rows))


def test_edge_rows(documents):
    rows = [(1, None, "a"), (2, "", "a"), (None, "x y z", None), (4, "one two", None), (5, "w " * 40000, "b")]
    rows += [(7, "same old text", "a")] * 101
    docs = documents(*rows)
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    assert by[1][0].size == by[2][0].size == by[1][0].taken == 0
    each = [r.taken // 3 for r in by[7]]
    assert max(each) - min(each) <= 1 and abs(3 * sum(each) - by[7][0].target) <= 6
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    times = Counter(r.doc_id for r in out.collect())
    for doc_id, found in by.items():
        assert times[doc_id] == sum(r.taken // r.size for r in found if r.size)
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.mixed(docs.limit(0)).count() == 0
