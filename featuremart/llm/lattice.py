"""Near-duplicate vectors by E8 lattice hashing.

A vector is scaled to length one and turned by a random rotation; each eight coordinates of the
result are a projection with a table of its own. There the point is decoded to the nearest point of
the E8 lattice, whose cell it lies in, and the cells near it are probed: all those that a ball of
half the link radius around the point can touch. Vectors that are linked (same label, cosine at least
``cosine``) are at most sqrt(2 - 2 cosine) apart, so in one table at least their distance is no more
than that over the root of the number of tables; the point half way between them then lies in a cell
that both have entered. No link is lost for want of a probe. A cell touched by a ball of radius r
around y, decoded to p, is p + w for a lattice vector w of norm 2 or 4 (covering radius 1) with
<y - p, w> >= |w|^2 / 2 - r |w|, so 2,400 inner products name all candidates.

Rows of a cell carry a sketch of 128 signs of random projections. Rows whose sketches differ in at most
``SKETCH`` bits are tied together by a spanning forest, never as all pairs; at the cosine of a
link 8 bits differ on average, and more than SKETCH in about one of a million pairs. The components
of those ties are groups that hold every link. Only there vectors meet, each pair once, and cosines
are taken in double precision, which gives the number of links of each vector and the true components.

Equal vectors of a label count once with a multiplicity until the end. Cells and groups that are too
large for one task are cut into blocks by a hash, and each pair of blocks is a task's work; so
a third of all rows in one cell costs more tasks, not a larger one.

Edge cases. Vectors that are null, zero or hold a null or non-finite component, and rows with a null
label, link with nothing: n_links 0, component_id their own id. Vectors of different lengths are not
linked. Repeated rows are vectors of their own, linked to each other. Rows with a null id are linked
like others but never name a component, and are not kept unless alone. An empty table gives no
rows. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import combinations, product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featuremart.llm.common import components, staged

COSINE = 0.98
SCALE = 6.0
SKETCH = 24
SEED = 20
SMALL = 16
CELL_ROWS = 8192
BLOCK_ROWS = 2048
BATCH = 50_000


@lru_cache(maxsize=1)
def shells() -> np.ndarray:
    """Lattice vectors of norm 2 (240) and 4 (2,160)."""
    roots = []
    for i, j in combinations(range(8), 2):
        for s, t in product((1, -1), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = s, t
            roots.append(v)
    roots += [np.array(s) for s in product((0.5, -0.5), repeat=8) if (np.array(s) < 0).sum() % 2 == 0]
    roots = np.array(roots)
    sums = np.unique((2 * (roots[:, None] + roots[None])).reshape(-1, 8).astype(int), axis=0)
    return np.concatenate([roots, sums[(sums**2).sum(axis=1) == 16] / 2])


def decode(points: np.ndarray) -> np.ndarray:
    """Nearest E8 lattice point: the better of D8 and D8 shifted by one half."""

    def d8(x):
        near = np.round(x)
        rest = x - near
        odd = np.flatnonzero(near.sum(axis=1).astype(np.int64) % 2)
        worst = np.abs(rest[odd]).argmax(axis=1)
        near[odd, worst] += np.where(rest[odd, worst] >= 0, 1, -1)
        return near

    whole, half = d8(points), d8(points - 0.5) + 0.5
    nearer = ((points - whole) ** 2).sum(axis=1) <= ((points - half) ** 2).sum(axis=1)
    return np.where(nearer[:, None], whole, half)


def probes(points: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """Number of the point and lattice point of every cell within ``radius`` of a point."""
    w = shells()
    norm = np.sqrt((w**2).sum(axis=1))
    own = decode(points)
    at, which = np.nonzero((points - own) @ w.T >= norm**2 / 2 - radius * norm - 1e-9)
    return (
        np.concatenate([np.arange(len(points)), at]), np.concatenate([own, own[at] + w[which]])
    )


@lru_cache(maxsize=8)
def frames(width: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Random rotation, projections of the sketch, and multipliers of the cell keys."""
    rng = np.random.default_rng([seed, width])
    rotation = np.linalg.qr(rng.normal(size=(width, width)))[0]
    odd = rng.integers(0, 2**63, 11, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return rotation, rng.normal(size=(width, 128)), odd


def cell_rows(
    vectors: np.ndarray, labels: np.ndarray, cosine: float = COSINE, scale: float = SCALE,
    seed: int = SEED,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of the vector and key of each cell it enters; sketches (two words) of the vectors."""
    width = -(-vectors.shape[1] // 8) * 8
    unit = np.pad(vectors, ((0, 0), (0, width - vectors.shape[1])))
    unit = unit / np.abs(unit).max(axis=1, keepdims=True)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    rotation, planes, odd = frames(width, seed)
    turned = unit @ rotation * scale
    tables = width // 8
    radius = scale * np.sqrt((2 - 2 * cosine) / tables) / 2 + 1e-6
    numbers, keys = [], []
    for t in range(tables):
        at, cells = probes(turned[:, 8 * t : 8 * t + 8], radius)
        cells = np.round(2 * cells).astype(np.int64).view(np.uint64)
        key = (cells * odd[:8]).sum(axis=1, dtype=np.uint64)
        key += odd[8:9] * np.uint64(t + 1) + odd[9:10] * np.uint64(vectors.shape[1])
        key += odd[10] * labels[at].astype(np.int64).view(np.uint64)
        key ^= key >> np.uint64(31)
        key *= odd[8]
        numbers.append(at)
        keys.append((key ^ (key >> np.uint64(29))).view(np.int64))
    bits = np.packbits(unit @ planes > 0, axis=1).view("<i8")
    return np.concatenate(numbers), np.concatenate(keys), bits


def runs(
    batches: Iterator[pd.DataFrame], keys: list[str], work: Callable[[pd.DataFrame], pd.DataFrame]
) -> Iterator[pd.DataFrame]:
    """``work`` on whole runs of equal keys of a sorted partition, some thousand rows at a time."""
    held: list[pd.DataFrame] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += len(batch)
        if size < BATCH:
            continue
        rows = pd.concat(held, ignore_index=True)
        same = (rows[keys] == rows[keys].iloc[-1]).all(axis=1).to_numpy()
        cut = int(len(rows) - same[::-1].argmin()) if not same.all() else 0
        if cut:
            yield work(rows.iloc[:cut].reset_index(drop=True))
        held, size = [rows.iloc[cut:]], len(rows) - cut
    if size:
        yield work(pd.concat(held, ignore_index=True))


def starts_of(rows: pd.DataFrame, keys: list[str]) -> np.ndarray:
    """Where the runs of equal keys begin, and the end."""
    values = rows[keys].to_numpy()
    new = np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1
    return np.concatenate([[0], new, [len(rows)]])


def tie(rows: pd.DataFrame) -> pd.DataFrame:
    """Links (a, b) that tie together the rows of each cell whose sketches are close."""
    bounds = starts_of(rows, ["cell", "sub"])
    sizes = np.diff(bounds)
    end = np.repeat(bounds[1:], sizes)
    small = np.repeat(sizes <= SMALL, sizes)
    words = rows[["s0", "s1"]].to_numpy(np.int64).view(np.uint64)
    labels, reps = rows["label"].to_numpy(), rows["rep"].to_numpy()
    found = []
    for lag in range(1, min(SMALL, int(sizes.max()))):
        i = np.flatnonzero(small & (np.arange(len(rows)) + lag < end))
        if not len(i):
            break
        far = np.bitwise_count(words[i] ^ words[i + lag]).sum(axis=1)
        i = i[(far <= SKETCH) & (labels[i] == labels[i + lag])]
        found.append(np.stack([reps[i], reps[i + lag]], axis=1))
    for a, b in zip(bounds[:-1][sizes > SMALL], bounds[1:][sizes > SMALL], strict=True):
        left = np.arange(a, b)
        while len(left):
            queue, left = [left[0]], left[1:]
            while queue and len(left):
                at = queue.pop()
                near = np.bitwise_count(words[left] ^ words[at]).sum(axis=1) <= SKETCH
                near &= labels[left] == labels[at]
                new = left[near]
                queue += new.tolist()
                found.append(np.stack([np.full(len(new), reps[at]), reps[new]], axis=1))
                left = left[~near]
    pairs = np.concatenate(found) if found else np.empty((0, 2), dtype=np.int64)
    pairs = np.unique(np.sort(pairs, axis=1), axis=0)
    return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})


def blocked(rows: DataFrame, key: str, unit: str, most: int) -> DataFrame:
    """Rows with ``block``, ``blocks`` and ``sub``: cut each group into blocks and name the pairs.

    A group of at most ``most`` rows is one block. Each row of a larger one comes once for every
    pair of blocks that its own block is part of. Groups of one row are left out.
    """
    count = F.count(F.lit(1)).over(Window.partitionBy(key))
    blocks = F.when(F.col("n_rows") <= most, 1).otherwise(F.ceil(2 * F.col("n_rows") / most)).cast("long")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    return (
        rows.withColumn("n_rows", count)
        .filter("n_rows > 1")
        .withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64(F.lit("block"), unit), F.col("blocks")))
        .withColumn("other", other)
        .withColumn("sub", F.least("block", "other") * F.col("blocks") + F.greatest("block", "other"))
        .drop("n_rows", "other")
        .repartition(key, "sub")
        .sortWithinPartitions(key, "sub")
    )


def _unit(vectors: list) -> np.ndarray:
    x = np.array([np.asarray(v, dtype=np.float64) for v in vectors])
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def verify(rows: pd.DataFrame, cosine: float = COSINE) -> pd.DataFrame:
    """Of each pair of blocks: links (rep, other) of a forest, and counted links (rep, rep, n)."""
    out = []
    bounds = starts_of(rows, ["cluster", "sub"])
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        part = rows.iloc[a:b]
        block, copies = part["block"].to_numpy(), part["copies"].to_numpy(np.int64)
        blocks, sub = int(part["blocks"].iloc[0]), int(part["sub"].iloc[0])
        within = blocks == 1 or sub // blocks == sub % blocks
        labels, reps = part["label"].to_numpy(), part["rep"].to_numpy(np.int64)
        width = np.array([len(v) for v in part["embedding"]])
        links = np.zeros(len(part), dtype=np.int64)
        for w in np.unique(width):
            at = np.flatnonzero(width == w)
            x = _unit(part["embedding"].iloc[at].tolist())
            root = np.arange(len(at))
            for s in range(0, len(at), 512):
                rows_at = at[s : s + 512]
                near = x[s : s + 512] @ x.T >= cosine
                near &= labels[rows_at][:, None] == labels[at][None]
                if not within:
                    near &= block[rows_at][:, None] != block[at][None]
                near[np.arange(len(rows_at)), np.arange(s, s + len(rows_at))] = False
                links[rows_at] += near @ copies[at]
                for i in range(len(rows_at)):  # joins the trees of the row and of its neighbours
                    trees = np.unique(root[near[i]])
                    mine = root[s + i]
                    new = trees[trees != mine]
                    if len(new):
                        out += [(reps[at[s + i]], reps[at[t]], 0) for t in new]
                        root[np.isin(root, new)] = mine
        out += [(r, r, n) for r, n in zip(reps.tolist(), links.tolist(), strict=True) if n]
    return pd.DataFrame(out, columns=["a", "b", "n"])


def usable(embedding: Column, label: Column) -> Column:
    """Whether a vector can be linked at all."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(
        label.isNotNull() & finite & F.exists(embedding, lambda x: x != 0), F.lit(False)
    )


def vector_components(
    vectors: DataFrame, cosine: float = COSINE, scale: float = SCALE,
    cell_rows_most: int = CELL_ROWS, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """vec_id, n_links, component_id and kept of every vector."""
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.col("embedding"), usable(F.col("embedding"), F.col("label")).alias("usable"),
    ).withColumn("rep", F.when(F.col("usable"), F.xxhash64("label", "embedding")))
    reps, _ = staged(
        rows.filter("usable").groupBy("rep").agg(
            F.first("label").alias("label"), F.first("embedding").alias("embedding"),
            F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least"),
        ),
        "vectors",
    )

    def enter(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            width = batch["embedding"].map(len)
            for _, part in batch.groupby(width, sort=True):
                for s in range(0, len(part), 2048):
                    some = part.iloc[s : s + 2048]
                    x = np.array([np.asarray(v, dtype=np.float64) for v in some["embedding"]])
                    label = some["label"].to_numpy(np.int64)
                    at, keys, bits = cell_rows(x, label, cosine, scale)
                    yield pd.DataFrame({
                        "cell": keys, "rep": some["rep"].to_numpy()[at], "label": label[at],
                        "s0": bits[at, 0], "s1": bits[at, 1],
                    })

    cells = reps.select("rep", "label", "embedding").mapInPandas(
        enter, "cell long, rep long, label long, s0 long, s1 long"
    )
    ties = blocked(cells, "cell", "rep", cell_rows_most).mapInPandas(
        lambda batches: runs(batches, ["cell", "sub"], tie), "a long, b long"
    )
    groups = components(ties).withColumnsRenamed({"node": "rep", "component": "cluster"})
    met = blocked(reps.join(groups, "rep"), "cluster", "rep", block_rows)
    checked, _ = staged(
        met.select("cluster", "sub", "block", "blocks", "rep", "label", "copies", "embedding").mapInPandas(
            lambda batches: runs(batches, ["cluster", "sub"], lambda r: verify(r, cosine)),
            "a long, b long, n long",
        ),
        "links",
    )
    roots = components(checked.filter("a <> b").select("a", "b")).withColumnRenamed("node", "rep")
    links = checked.filter("a = b").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("links"))
    named = reps.select("rep", "copies", "least").join(roots, "rep", "left").withColumn(
        "component", F.coalesce("component", "rep")
    )
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(least, "component").join(links, "rep", "left").select(
        "rep", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), "component_id"
    )
    own = F.when(F.col("usable"), F.col("component_id")).otherwise(F.col("vec_id"))
    return rows.select("vec_id", "usable", "rep").join(named, "rep", "left").select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        own.alias("component_id"), F.col("vec_id").eqNullSafe(own).alias("kept"),
    )


ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), reach AS (SELECT a, b FROM l UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id,
       vec_id <= coalesce(m, vec_id) AS kept
FROM embeddings LEFT JOIN (SELECT a, count(*) AS n FROM l GROUP BY a) c ON c.a = vec_id
LEFT JOIN (SELECT a, min(b) AS m FROM reach GROUP BY a) r ON r.a = vec_id
"""
