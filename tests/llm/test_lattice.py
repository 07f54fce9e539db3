import numpy as np
import pytest
from oracle_check import compare, connect

from featuremart.llm import lattice
from featuremart.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, rep long, cell long"


def test_matches_sql(spark):
    duck = connect("/root/testdata/sf0.001")
    assert compare(QUERIES["op1_e8_lattice"](spark, "/root/testdata/sf0.001"), duck, lattice.ORACLE) == []


def brute(rows, cosine=0.98):
    units = []
    for _, v, label, *_ in rows:
        ok = label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)
        x = np.asarray(v, dtype=np.float32).astype(np.float64) if ok else None
        units.append(None if x is None else x / np.linalg.norm(x))
    n = len(rows)
    near = [
        [j for j in range(n) if j != i and units[i] is not None and units[j] is not None
         and rows[i][2] == rows[j][2] and len(units[i]) == len(units[j]) and units[i] @ units[j] >= cosine]
        for i in range(n)
    ]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        least = min(ids) if ids else None
        out.append((rows[i][0], len(near[i]), least, rows[i][0] == least))
    return sorted(out, key=repr)


def clouds(rng, centres, each, dim, spread):
    rows = []
    for c in range(centres):
        x = rng.normal(size=dim)
        x /= np.linalg.norm(x)
        for _ in range(each):
            d = rng.normal(size=dim)
            rows.append((x + spread * rng.random() * d / np.linalg.norm(d)).tolist())
    return rows


@pytest.mark.parametrize("cell_rows, block_rows", [(8192, 2048), (8, 6)])
def test_clouds_and_edge_rows(spark, cell_rows, block_rows):
    rng = np.random.default_rng(4)
    rows = [(i, v, i % 3 // 2, 1, 1) for i, v in enumerate(clouds(rng, 12, 25, 64, 0.3))]
    rows += [(1000 + i, rows[7][1], rows[7][2], 1, 1) for i in range(30)]  # copies
    rows += [(2000, [2.5 * x for x in rows[7][1]], rows[7][2], 1, 1)]
    rows += [
        (3000, None, 0, 1, 1), (3001, [0.0] * 64, 0, 1, 1), (3002, [None] * 64, 0, 1, 1),
        (3003, [float("nan")] * 64, 0, 1, 1), (3004, rows[0][1], None, 1, 1), (3005, [], 0, 1, 1),
        (None, rows[0][1], rows[0][2], 1, 1), (3006, [1.0, 0.1, 0.0], 0, 1, 1), (3007, [1.0, 0.1, 0.01], 0, 1, 1),
        (3, rows[3][1], rows[3][2], 1, 1), (3008, [-float("inf")] * 64, 0, 1, 1),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    got = lattice.vector_components(df, cell_rows_most=cell_rows, block_rows=block_rows)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)
    assert lattice.vector_components(df.limit(0)).count() == 0


def test_decode_is_the_nearest_lattice_point():
    rng = np.random.default_rng(5)
    points = rng.normal(size=(400, 8)) * 3
    near = lattice.decode(points)
    doubled = np.round(2 * near).astype(int)
    assert np.allclose(doubled, 2 * near) and (doubled.sum(axis=1) % 4 == 0).all()
    assert ((doubled % 2 == 0).all(axis=1) | (doubled % 2 == 1).all(axis=1)).all()
    own = ((points - near) ** 2).sum(axis=1)
    assert own.max() <= 1 + 1e-9  # covering radius
    for w in lattice.shells():
        assert (own <= ((points - near - w) ** 2).sum(axis=1) + 1e-9).all()
    assert len(lattice.shells()) == 240 + 2160


def test_probes_name_every_cell_a_ball_touches():
    rng = np.random.default_rng(6)
    points, radius = rng.normal(size=(60, 8)), 0.4
    at, cells = lattice.probes(points, radius)
    known = {(int(i), *np.round(2 * c).astype(int)) for i, c in zip(at, cells, strict=True)}
    for _ in range(200):
        step = rng.normal(size=points.shape)
        step *= radius * rng.random((60, 1)) ** 0.1 / np.linalg.norm(step, axis=1, keepdims=True)
        for i, c in enumerate(lattice.decode(points + step)):
            assert (i, *np.round(2 * c).astype(int)) in known


def test_links_at_the_threshold_always_share_a_cell():
    rng = np.random.default_rng(7)
    x = rng.normal(size=(300, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    away = rng.normal(size=x.shape)
    away -= (away * x).sum(axis=1, keepdims=True) * x
    away /= np.linalg.norm(away, axis=1, keepdims=True)
    y = 0.98 * x + np.sqrt(1 - 0.98**2) * away
    label = np.zeros(600, dtype=np.int64)
    at, keys, bits = lattice.cell_rows(np.concatenate([x, y]), label)
    cells = [set() for _ in range(600)]
    for i, k in zip(at, keys, strict=True):
        cells[i].add(int(k))
    assert all(cells[i] & cells[i + 300] for i in range(300))
    far = np.bitwise_count(bits[:300].view(np.uint64) ^ bits[300:].view(np.uint64)).sum(axis=1)
    assert far.max() <= lattice.SKETCH
