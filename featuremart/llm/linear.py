"""Linear models over hashed word features, fitted on a bounded sample of rows."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

import numpy as np

BITS = 20
SELECTED = 512
LEAST_ROWS = 4
STEPS = 150
PENALTY = 1e-3
KEPT_WORDS = 300_000
EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»“”‘’…–—¡¿"


def hashed(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "surrogatepass")) & ((1 << BITS) - 1)


def word_features(token: str) -> tuple[int, ...]:
    """Of a lower-case token: the word without punctuation at its ends, and its beginnings."""
    word = token.strip(EDGES)
    if not word:
        return ()
    return (hashed(word), *[hashed(f"^{word[:n]}") for n in (4, 5, 6) if len(word) > n])


def tokens(text: str | None) -> set[str]:
    return set((text or "").lower().split())


class Features:
    """Feature ids of a text. ``wanted`` keeps those of a model only; words are remembered."""

    def __init__(self, of_word: Callable[[str], tuple[int, ...]], wanted: Iterable[int] | None = None):
        self.of_word = of_word
        self.wanted = None if wanted is None else frozenset(wanted)
        self.known: dict[str, tuple[int, ...]] = {}

    def __call__(self, words: Iterable[str]) -> set[int]:
        found: set[int] = set()
        if len(self.known) > KEPT_WORDS:
            self.known.clear()
        for word in words:
            ids = self.known.get(word)
            if ids is None:
                ids = self.of_word(word)
                if self.wanted is not None:
                    ids = tuple(i for i in ids if i in self.wanted)
                self.known[word] = ids
            if ids:
                found.update(ids)
        return found


@dataclass
class Linear:
    """Logistic model: weights by feature id, of dense columns, and a constant."""

    weights: dict[int, float] = field(default_factory=dict)
    dense: list[float] = field(default_factory=list)
    constant: float = 0.0

    def logit(self, ids: Iterable[int], dense: Iterable[float] = ()) -> float:
        total = self.constant + sum(self.weights.get(i, 0.0) for i in ids)
        return total + sum(w * x for w, x in zip(self.dense, dense, strict=True))

    def chance(self, ids: Iterable[int], dense: Iterable[float] = ()) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.logit(ids, dense), -40, 40))))


def select(rows: list[np.ndarray], target: np.ndarray, most: int = SELECTED) -> np.ndarray:
    """Feature ids whose presence tells most about the target (largest score statistic)."""
    n, hits = np.zeros(1 << BITS), np.zeros(1 << BITS)
    for ids, value in zip(rows, target, strict=True):  # ids of a row are different
        n[ids] += 1
        hits[ids] += value
    share = target.mean()
    z = (hits - n * share) / np.sqrt(n * share * (1 - share) + 1e-9)
    z[n < LEAST_ROWS] = 0
    best = np.argsort(-np.abs(z), kind="stable")[:most]
    return np.sort(best[np.abs(z[best]) > 2])


def fit(rows: list[np.ndarray], target: np.ndarray, dense: np.ndarray | None = None) -> Linear:
    """Logistic regression by accelerated gradient steps; ``target`` may hold probabilities.

    Rows are sorted arrays of feature ids. A target of one value gives a constant model.
    """
    target = np.asarray(target, dtype=np.float64)
    n, extra = len(rows), 0 if dense is None else dense.shape[1]
    if not n or target.min() == target.max():
        level = float(np.clip(target.mean() if n else 0.0, 1e-6, 1 - 1e-6))
        return Linear(dense=[0.0] * extra, constant=float(np.log(level / (1 - level))))
    kept = select(rows, target)
    x = np.zeros((n, len(kept) + extra + 1), dtype=np.float32)
    for i, ids in enumerate(rows):
        at = np.searchsorted(kept, ids)
        ok = at < len(kept)
        ok[ok] = kept[at[ok]] == ids[ok]
        x[i, at[ok]] = 1
    if extra:
        x[:, len(kept) : -1] = dense
    x[:, -1] = 1
    w = np.zeros(x.shape[1])
    ahead = w.copy()
    v = np.ones(x.shape[1], dtype=np.float32)
    for _ in range(10):  # largest eigenvalue, for the step
        u = x.T @ (x @ v)
        v = u / (np.linalg.norm(u) + 1e-12)
    step = 1 / (float(np.linalg.norm(x @ v) ** 2) / (4 * n) * 1.1 + PENALTY)
    for k in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(x @ ahead.astype(np.float32), -40, 40)))
        slope = x.T @ (p - target).astype(np.float32) / n + PENALTY * ahead
        slope[-1] -= PENALTY * ahead[-1]
        new = ahead - step * slope
        ahead = new + k / (k + 3) * (new - w)
        w = new
    m = len(kept)
    return Linear(
        {int(i): float(a) for i, a in zip(kept, w[:m], strict=True) if a},
        [float(a) for a in w[m : m + extra]], float(w[-1]),
    )
