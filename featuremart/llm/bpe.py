"""Token ids of whole texts by the ``tokenizers`` library, one call for each different word.

Byte-level BPE works inside pre-tokens, and no pre-token reaches over a single space or line break
that stands between two other characters. So a text is cut there, the library encodes each word
that is new to the worker, and the ids of a text are those of its words in order: the same ids as
those of the whole text, at a fraction of the time. The words kept are bounded in number.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache
from itertools import chain

import numpy as np

CUT = re.compile(r"(?<=\S)(?= \S)")
KEPT_WORDS = 800_000
BLOCK = 4096


def odd(text: str) -> bool:
    """Whether its white space is anything else than single spaces and line breaks between other characters."""
    return " ".join(text.split()) != text.replace("\n", " ")


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.after_space: dict[str, bytes] = {}
        self.plain: dict[str, bytes] = {}
        tokens = self.tokenizer.get_vocab()
        self.starts = np.zeros(max(tokens.values()) + 1, dtype=bool)
        self.starts[[i for t, i in tokens.items() if t.startswith("Ġ")]] = True

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4") for e in found]

    def _learn(self, words: set[str], first: set[str]) -> None:
        if len(self.after_space) + len(self.plain) > KEPT_WORDS:
            self.after_space.clear()
            self.plain.clear()
        new = list(words.difference(self.after_space))
        for i in range(0, len(new), BLOCK):
            block = new[i : i + BLOCK]
            (ids,) = self._ids([" " + " ".join(block)])
            at = np.flatnonzero(self.starts[ids])
            assert len(at) == len(block)
            whole, ends = ids.tobytes(), [*(4 * at[1:]).tolist(), 4 * len(ids)]
            for word, a, b in zip(block, (4 * at).tolist(), ends, strict=True):
                self.after_space[word] = whole[a:b]
        new = list(first.difference(self.plain))
        for i in range(0, len(new), BLOCK):
            block = new[i : i + BLOCK]
            for word, ids in zip(block, self._ids(block), strict=True):
                self.plain[word] = ids.tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers; a null text has none."""
        cut, words, first = [], set(), {"\n"}
        for text in texts:
            if not text:
                cut.append([])
            elif odd(text):
                parts = CUT.split(text)
                first.update(parts)
                cut.append([(parts, [])])
            else:
                lines = []
                for line in text.split("\n"):
                    rest = line.split(" ")
                    head = [rest.pop(0)] if not lines else ["\n", rest.pop(0)]
                    lines.append((head, rest))
                    first.update(head)
                    words.update(rest)
                cut.append(lines)
        self._learn(words, first)
        spaced, plain = self.after_space.__getitem__, self.plain.__getitem__
        return [
            b"".join(chain.from_iterable(chain(map(plain, h), map(spaced, r)) for h, r in lines))
            for lines in cut
        ]


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """The encoder of a worker, kept from task to task."""
    return Encoder(path)


def encode_all(path: str, texts, block: int = 64):
    """Ids (bytes) of the texts of an iterable, a bounded number of texts at a time."""
    texts, use = list(texts), encoder(path)
    for i in range(0, len(texts), block):
        yield from use.encode(texts[i : i + block])
