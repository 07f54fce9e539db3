"""SentencePiece encoding and decoding of whole texts, for BPE models with byte fallback.

Such a model merges neighbouring symbols, best score first and leftmost first among equals, until no
neighbours form a piece. Its result is the one cut of a text into tokens in which every two neighbours
are compatible: merging the text of the two anew gives the same two again. (The first merge across a
border of the cut would be a merge inside its two neighbours as well, where none is.) So a text is
encoded without merging it:

- Aho-Corasick finds the longest piece at a position. It is tried first, then the pieces it begins with.
- A piece is taken if it is compatible with the token before it. Compatibility is found by merging
  the two texts, once per pair of ids, and remembered.
- Where no piece fits, the last token is given up and the next shorter one in its place tried. Tokens up to a
  position are the one encoding of the text up to there, so a position from which there was no way on
  never has one; a bitfield keeps such positions from being tried again.

A character that is no piece stands alone and becomes its UTF-8 bytes. No piece crosses from another
character to a space mark, so a text is cut there and the ids of a word are kept, for a bounded number
of short words. A longer word is searched each time. Where a model has pieces that cross, texts are not cut. Models of other kinds (unigram, without byte fallback, with
pieces of the user's) are refused.

Edge cases. A null text counts as empty; an empty one is the end id alone and decodes to an empty text.
Text that looks like a control piece is plain text. Rows with a null id keep it; repeated rows are encoded
each. An empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremart.llm.common import blocks, id_or_null, packed

SPACE = "\u2581"
NOTHING = -1
NEVER = float("-inf")
KEPT_WORDS = 600_000
KEPT_PAIRS = 500_000
LONGEST_KEPT = 64
WINDOW = 4096
BLOCK = 1 << 21
WORD = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")
CROSSING = re.compile(f"[^{SPACE}]{SPACE}|\n.|.\n", re.DOTALL)


class Pieces:
    """The pieces of a model. Tokens are ids; characters that are no piece get numbers after them."""

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        model, size = self.model, self.model.get_piece_size()
        self.piece = [model.id_to_piece(i) for i in range(size)]
        self.size, self.end_id = size, model.eos_id()
        self.byte_id = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if any(model.is_unused(i) for i in range(size)) or not all(map(model.is_byte, self.byte_id)):
            raise ValueError("the model has unused pieces or no byte fallback")
        kept = [
            i for i in range(size)
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
        ]
        self.score = {self.piece[i]: model.get_score(i) for i in kept}
        self.longest = max(map(len, self.score))
        self.cuts = not any(CROSSING.search(p) for p in self.score)
        self.length, self.shorter = list(map(len, self.piece)), [NOTHING] * size
        #: For each token, whether the tokens tried after it are compatible.
        self.pairs: list[dict[int, bool]] = [{} for _ in range(size)]
        self.n_pairs = 0
        self.start = self._add("")
        known = {self.piece[i]: i for i in kept}
        self.single = {text: i for text, i in known.items() if len(text) == 1}
        self.automaton = ahocorasick.Automaton()
        for text, i in known.items():
            if len(text) > 1:
                self.automaton.add_word(text, (len(text), i))
                starts = (known[text[:n]] for n in range(len(text) - 1, 0, -1) if text[:n] in known)
                self.shorter[i] = next(starts, None) or self.character(text[0])
        self.automaton.make_automaton()
        self.words: dict[str, tuple[int, ...]] = {}
        self.spaced: dict[str, tuple[int, ...]] = {}
        probe = "probing  the model: merges, not likelihoods 123"
        if self.ids(probe) != model.encode(probe):
            raise ValueError("the model does not merge by score")

    def _add(self, text: str) -> int:
        """A token for a text that is no piece."""
        self.piece.append(text)
        self.length.append(len(text))
        self.shorter.append(NOTHING)
        self.pairs.append({})
        return len(self.piece) - 1

    def character(self, char: str) -> int:
        """The token of a single character."""
        token = self.single.get(char)
        if token is None:
            token = self.single[char] = self._add(char)
        return token

    def merged(self, text: str) -> list[str]:
        """The text after all merges."""
        parts, score = list(text), self.score.get
        scores = [score(a + b, NEVER) for a, b in zip(parts, parts[1:])]
        while scores and (best := max(scores)) > NEVER:
            at = scores.index(best)
            parts[at] += parts.pop(at + 1)
            del scores[at]
            if at:
                scores[at - 1] = score(parts[at - 1] + parts[at], NEVER)
            if at < len(scores):
                scores[at] = score(parts[at] + parts[at + 1], NEVER)
        return parts

    def fits(self, before: int, token: int) -> bool:
        """Whether merging ``before`` and ``token`` anew leaves both as they are; remembered."""
        if self.n_pairs >= KEPT_PAIRS:
            for row in self.pairs:
                row.clear()
            self.n_pairs = 0
        self.n_pairs += 1
        parts = [self.piece[before], self.piece[token]] if before != self.start else [self.piece[token]]
        self.pairs[before][token] = self.merged("".join(parts)) == parts
        return self.pairs[before][token]

    def longest_pieces(self, word: str, low: int) -> dict[int, int]:
        """The longest piece of two characters or more at the places of a word, for WINDOW places."""
        text = word[low : low + WINDOW + self.longest] if len(word) > WINDOW else word
        # Matches come by their ends, so the longest one of a place comes last.
        return {low + last + 1 - n: token for last, (n, token) in self.automaton.iter(text)}

    def search(self, word: str) -> list[int]:
        """Tokens of a word of any length, by backtracking."""
        size, pairs, length, shorter = len(word), self.pairs, self.length, self.shorter
        failed, stuck = bytearray(size // 8 + 1), False
        low, longest = 0, self.longest_pieces(word, 0)
        tokens, at, before = [], 0, self.start
        token = longest.get(0) or self.character(word[0])
        while True:
            known = pairs[before]
            while token != NOTHING:
                end = at + length[token]
                if not (stuck and failed[end >> 3] >> (end & 7) & 1):
                    fits = known.get(token)
                    if fits or (fits is None and self.fits(before, token)):
                        break
                token = shorter[token]
            else:
                stuck = True
                failed[at >> 3] |= 1 << (at & 7)
                token = tokens.pop()
                at -= length[token]
                token, before = shorter[token], tokens[-1] if tokens else self.start
                continue
            tokens.append(token)
            if end == size:
                return tokens
            at, before = end, token
            if not low <= at < low + WINDOW:
                low = max(0, at - WINDOW // 2)
                longest = self.longest_pieces(word, low)
            token = longest.get(at) or self.character(word[at])

    def word_ids(self, word: str) -> tuple[int, ...]:
        """Ids of one word of a normalised text."""
        tokens = self.search(word)
        if max(tokens) < self.size:
            return tuple(tokens)
        found = []
        for token in tokens:
            if token < self.size:
                found.append(token)
            else:
                found.extend(self.byte_id[b] for b in self.piece[token].encode())
        return tuple(found)

    def _lookup(self, words: list[str], known: dict[str, tuple[int, ...]], mark: str) -> Iterator[tuple[int, ...]]:
        """Ids of the words, each after ``mark``, from those known; new short words become known."""
        new = set(words).difference(known)
        if len(known) + len(new) > KEPT_WORDS:
            known.clear()
            new = set(words)
        for word in new:
            if len(word) <= LONGEST_KEPT:
                known[word] = self.word_ids(mark + word)
        return (known.get(word) or self.word_ids(mark + word) for word in words) if any(
            len(word) > LONGEST_KEPT for word in new
        ) else map(known.__getitem__, words)

    def ids(self, text: str | None) -> list[int]:
        """Ids of a whole text, without an end id."""
        if not text:
            return []
        normal = self.model.normalize(text)
        if not self.cuts:
            return list(self.word_ids(normal))
        if SPACE + SPACE in normal or "\n" in normal or normal[0] != SPACE:
            return list(chain.from_iterable(self._lookup(WORD.findall(normal), self.words, "")))
        return list(chain.from_iterable(self._lookup(normal[1:].split(SPACE), self.spaced, SPACE)))

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids."""
        return self.model.decode(list(ids))


@lru_cache(maxsize=4)
def pieces(path: str) -> Pieces:
    """The pieces of a worker, kept from task to task."""
    return Pieces(path)


def round_trip(docs: DataFrame, model: str) -> DataFrame:
    """One row per document: doc_id, ``ids`` (with the end id) and ``decoded``, the text they give."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        use = pieces(model)
        for batch in batches:
            for part in blocks(batch["text"].tolist(), BLOCK):
                rows = batch.iloc[part]
                ids = [[*use.ids(text), use.end_id] for text in rows["text"]]
                yield pd.DataFrame({
                    "id": rows["id"], "ids": [np.array(x, dtype=np.int32) for x in ids],
                    "decoded": [use.decode(x) for x in ids],
                })

    return packed(docs).select("id", F.col("row.text").alias("text")).mapInPandas(
        run, "id long, ids array<int>, decoded string"
    ).select(id_or_null().alias("doc_id"), "ids", "decoded")


def digests(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every document."""
    return round_trip(docs, model).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
