"""Alignment of two tokenizers over the same texts: a byte-level BPE (A) and a SentencePiece model (B).

Both cut the bytes of a space and the text. ``pandas.merge_asof``, once for a stretch of documents and
keyed by document, finds for each token's start the token of the other side that covers it; from A to B
and from B to A these are all pairs of tokens that overlap. Pairs that end together are links, and their
ends cut both sides into groups: the least stretches that both sides have tokens for.

How often an id pair is linked is counted over the corpus. Of two tokens that end together, one's bytes
are the end of the other's, so the pairs there can be are known from the vocabularies alone: at most one
for each end of each token's bytes and token with those bytes. They are numbered, a document's links are
staged as numbers of pairs, and the table of counts, which is that long at most whatever the corpus,
reaches every task.

Both sides are encoded by word, as neither has a token that reaches from another character over a single
space or line break, and the ids of words are kept in a bounded store. Documents are worked on in
stretches of about half a million characters; a longer one is a stretch of its own.

Edge cases. A text that is null or empty has no tokens, nor has one whose tokens' bytes are not the space
and the text (one with a U+2581, which B shows as a space); it counts zeros and has an empty digest. Text that
looks like a special token is plain text. Rows with a null id keep it; repeated rows are aligned and counted
each. An empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremart.llm import pieces
from featuremart.llm.bpe import CUT, Encoder, odd
from featuremart.llm.common import blocks, id_or_null, packed, staged

BLOCK = 1 << 19
KEPT_WORDS = 500_000
#: Groups read ``a1,a2|b1;a3|b2,b3``.
ALIGNED = "id long, n_a long, n_b long, n_groups long, n_links long, n_overlaps long, groups string, links binary"


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for.

    Printable Latin-1 letters are themselves; the other bytes in order are the letters from 256 on.
    """
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


class SpacedEncoder(Encoder):
    """Ids of a space and a text, without special tokens."""

    def __init__(self, path: str):
        super().__init__(path)
        self.tokenizer.encode_special_tokens = True
        letters = byte_letters()
        self.bytes = [b""] * len(self.starts)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            if all(c in letters for c in token):
                self.bytes[i] = bytes(letters[c] for c in token)

    def spaced(self, text: str) -> bytes:
        """Ids of one text, encoded by stretches between single spaces."""
        parts = CUT.split(" " + text)
        self._learn(set(), set(parts))
        return b"".join(map(self.plain.__getitem__, parts))

    def learnt(self, words: set[str], first: set[str]) -> tuple[dict[str, bytes], dict[str, bytes]]:
        """Ids of words after a space, and of words that follow no space."""
        self.after_space, self.plain = {}, {}
        self._learn(words, first)
        return self.after_space, self.plain


class Aligner:
    """Both tokenizers of a worker, and the numbers of the pairs that can be linked."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = SpacedEncoder(path_a), pieces.pieces(path_b)
        if not self.b.cuts:
            raise ValueError("the model has pieces that reach over a space")
        self.known: dict[str, tuple[bytes, bytes]] = {}
        self.long: list[str] = []
        self.bytes_a = self.a.bytes
        self.bytes_b = [
            bytes([self.b.byte_id.index(i)]) if self.b.model.is_byte(i)
            else p.replace(pieces.SPACE, " ").encode()
            for i, p in enumerate(self.b.piece[: self.b.size])
        ]
        self.length_a = np.array(list(map(len, self.bytes_a)), dtype=np.int64)
        self.length_b = np.array(list(map(len, self.bytes_b)), dtype=np.int64)
        size_a, size_b = len(self.bytes_a), len(self.bytes_b)
        self.pairs = possible_pairs(self.bytes_a, self.bytes_b)
        names_a, names_b = list(map(str, range(size_a))), list(map(str, range(size_b)))
        #: A token's text in the groups: inside its side of a group, or at the end of it.
        self.names = [n + end for names, ends in ((names_a, ",|"), (names_b, ",;")) for end in ends for n in names]
        self.size_a, self.size_b = size_a, size_b

    def tokens(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of both sides; none for a text whose bytes the tokens do not give back.

        The tokens of A give back any bytes, those of B the normalised text with spaces for their marks.
        """
        words: list[list[str] | None] = []
        for text in texts:
            if not text or self.b.model.normalize(text).replace(pieces.SPACE, " ") != " " + text:
                words.append([])
            elif odd(text):
                words.append(None)
            else:
                first, *lines = text.split("\n")
                keys = first.split(" ")
                for line in lines:
                    keys += ["\n", *("\n" + line).split(" ")]
                words.append(keys)
        self.learn(set().union(*filter(None, words)))
        both: tuple[list, list] = [], []
        for text, keys in zip(texts, words, strict=True):
            if keys is None:
                a = np.frombuffer(self.a.spaced(text), dtype="<u4")
                b = np.array(self.b.ids(text), dtype=np.int64)
            else:
                found = list(map(self.known.__getitem__, keys))
                a = np.frombuffer(b"".join([x for x, _ in found]), dtype="<u4")
                b = np.frombuffer(b"".join([x for _, x in found]), dtype="<i4")
            both[0].append(a.astype(np.int64))
            both[1].append(b.astype(np.int64))
        for word in self.long:
            del self.known[word]
        self.long.clear()
        return both

    def learn(self, words: set[str]) -> None:
        """Ids of words. One that stands after a line break comes with it, and a line break alone is one."""
        new = words.difference(self.known)
        if len(self.known) + len(new) > KEPT_WORDS:
            self.known.clear()
            new = words
        spaced = {w for w in new if w[0] != "\n"}
        broken = {w: w[1:] or w for w in new.difference(spaced)}
        after, plain = self.a.learnt(spaced, set(broken.values()))
        ids, space = self.b.word_ids, pieces.SPACE
        for word in spaced:
            self.known[word] = after[word], array("i", ids(space + word)).tobytes()
        for word, rest in broken.items():
            self.known[word] = plain[rest], array("i", ids(rest)).tobytes()
        self.long.extend(w for w in new if len(w) > pieces.LONGEST_KEPT)

    def align(self, texts: list[str | None]) -> pd.DataFrame:
        """One row per text, as ALIGNED has it but for the id."""
        docs = np.arange(len(texts))
        sides, ends, owners, ids = [], [], [], []
        for found, lengths in zip(self.tokens(texts), (self.length_a, self.length_b), strict=True):
            side = np.concatenate([*found, np.empty(0, dtype=np.int64)])
            # Both sides have the same bytes, so ends count on from document to document alike.
            end = np.cumsum(lengths[side])
            owner = np.repeat(docs, [len(f) for f in found])
            ids.append(side)
            ends.append(end)
            owners.append(owner)
            sides.append(pd.DataFrame({"doc": owner, "at": end - lengths[side], "token": np.arange(len(side))}))
        a, b = overlaps(*sides)
        together = ends[0][a] == ends[1][b]
        shared = np.bincount(owners[0][a], minlength=len(texts))
        a, b = a[together], b[together]
        order = np.argsort(a, kind="stable")
        a, b = a[order], b[order]
        n_links = np.bincount(owners[0][a], minlength=len(texts))
        groups = []
        for side, tokens in zip(ids, (a, b), strict=True):
            cut = np.zeros(len(side), dtype=np.int64)
            cut[tokens] = 1  # the token ends a group
            groups.append(np.cumsum(cut) - cut)
        n_groups = n_links  # one link an end, as no token is empty
        codes = np.searchsorted(self.pairs, ids[0][a] * self.size_b + ids[1][b]).astype("<i4")
        counts = [np.bincount(owner, minlength=len(texts)) for owner in owners]
        text = self.group_texts(ids, groups, counts[0] + counts[1])
        bounds = np.concatenate([[0], np.cumsum(n_links)])
        return pd.DataFrame({
            "n_a": counts[0], "n_b": counts[1], "n_groups": n_groups, "n_links": n_links,
            "n_overlaps": shared, "groups": text,
            "links": [codes[i:j].tobytes() for i, j in zip(bounds, bounds[1:])],
        })

    def group_texts(self, ids: list[np.ndarray], groups: list[np.ndarray], sizes: np.ndarray) -> list[str]:
        """The groups of each document as text."""
        offset, codes = 0, []
        for side, group, size in zip(ids, groups, (self.size_a, self.size_b), strict=True):
            last = np.append(group[1:] != group[:-1], True) if len(group) else np.empty(0, dtype=bool)
            codes.append(offset + side + size * last)
            offset += 2 * size
        order = np.argsort(np.concatenate([2 * groups[0], 2 * groups[1] + 1]), kind="stable")
        parts = list(map(self.names.__getitem__, np.concatenate(codes)[order].tolist()))
        bounds = np.concatenate([[0], np.cumsum(sizes)]).tolist()
        return ["".join(parts[i:j])[:-1] for i, j in zip(bounds, bounds[1:])]


def overlaps(a: pd.DataFrame, b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of tokens that overlap, once each; columns doc, at (its start), token."""
    to_b = pd.merge_asof(a, b.rename(columns={"token": "other"}), on="at", by="doc")
    other = a.rename(columns={"token": "other"}).assign(other_at=a["at"])
    to_a = pd.merge_asof(b, other, on="at", by="doc")
    to_a = to_a[to_a["other_at"] < to_a["at"]]  # those that start together are in the other direction
    left = np.concatenate([to_b["token"].to_numpy(), to_a["other"].to_numpy(np.int64)])
    right = np.concatenate([to_b["other"].to_numpy(np.int64), to_a["token"].to_numpy()])
    return left, right


def possible_pairs(bytes_a: list[bytes], bytes_b: list[bytes]) -> np.ndarray:
    """Sorted numbers a * len(bytes_b) + b of the pairs of which one is an end of the other."""
    found, size = [], len(bytes_b)
    by_bytes: tuple[dict, dict] = {}, {}
    for known, table in zip(by_bytes, (bytes_a, bytes_b), strict=True):
        for i, value in enumerate(table):
            known.setdefault(value, []).append(i)
    for a, value in enumerate(bytes_a):
        for start in range(len(value)):
            found.extend(a * size + b for b in by_bytes[1].get(value[start:], ()))
    for b, value in enumerate(bytes_b):
        for start in range(1, len(value)):
            found.extend(a * size + b for a in by_bytes[0].get(value[start:], ()))
    return np.unique(np.array(found, dtype=np.int64))


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    """The aligner of a worker, kept from task to task."""
    return Aligner(path_a, path_b)


def aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row per document: counts of tokens, groups, links and overlaps, the groups as text, and the
    links in order as 32-bit places in ``possible_pairs``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        use = aligner(path_a, path_b)
        for batch in batches:
            texts = batch["text"].tolist()
            for part in blocks(texts, BLOCK):
                found = use.align(texts[part])
                found.insert(0, "id", batch["id"].iloc[part].to_numpy())
                yield found

    return packed(docs).select("id", F.col("row.text").alias("text")).mapInPandas(run, ALIGNED)


def pair_counts(links: DataFrame, size: int) -> np.ndarray:
    """How often each of ``size`` pairs is linked. At most one row per pair reaches the driver."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = np.zeros(size, dtype=np.int64)
        for batch in batches:
            for codes in batch["links"]:
                np.add.at(seen, np.frombuffer(codes, dtype="<i4"), 1)
        at = np.flatnonzero(seen)
        yield pd.DataFrame({"pair": at, "n": seen[at]})

    found = links.select("links").mapInPandas(count, "pair long, n long")
    table = found.groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(size, dtype=np.int64)
    counts[table.column("pair").to_numpy()] = table.column("n").to_numpy()
    return counts


def digests(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Counts and digest of the groups of every document, and how common its links are."""
    spark = docs.sparkSession
    use = aligner(path_a, path_b)
    rows, _ = staged(aligned(docs, path_a, path_b).select(
        "id", "n_a", "n_b", "n_groups", "n_links", "n_overlaps",
        F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256"), "links",
    ), "aligned")
    counts = pair_counts(rows, len(use.pairs))
    highest = np.zeros(use.size_b, dtype=np.int64)
    np.maximum.at(highest, use.pairs % use.size_b, counts)
    shared = spark.sparkContext.broadcast((counts, counts == highest[use.pairs % use.size_b]))

    @F.pandas_udf("struct<n_best:long,count_sum:long>")
    def common(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        count, best = shared.value
        for links in batches:
            codes = [np.frombuffer(found, dtype="<i4") for found in links]
            yield pd.DataFrame({
                "n_best": [int(best[c].sum()) for c in codes],
                "count_sum": [int(count[c].sum()) for c in codes],
            })

    return rows.withColumn("common", common("links")).select(
        id_or_null().alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "common.n_best", "common.count_sum",
        "groups_sha256", "n_overlaps",
    )
