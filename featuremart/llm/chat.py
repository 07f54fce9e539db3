r"""Chat formatting with a grammar round trip.

A conversation is rendered turn by turn as

    ### Role: text </turn>

and a line break. The grammar is deterministic: a turn is ``### ``, a role up to ``: ``, a text up to
`` </turn>`` and a line break; a backslash makes the character after it plain. Each rendered turn is
parsed again and compared with its source. Where they differ, the conflicting content is escaped and
the turn is rendered again: first as it is, then with backslashes and the starts of control strings
escaped, and at last with every character escaped, which always reads back. As the parse of one turn
ends where its mark ends, the parse of a conversation is that of its turns.

Rendering, parsing and escaping see one turn at a time, in any task. Only then are turns brought
together by conversation, sorted, and read through as a stream: digests are updated turn by turn, so
a conversation may have any number of turns and no group is ever held. The digests of one
conversation are a chain and stay in one task.

Edge cases. A null text counts as empty, so does a null role. Turns are ordered by turn, then role,
then text; null turns come first; repeated rows are turns of their own. Rows with a null conv_id are
one conversation. An empty table gives only the conversations added by the caller. Other columns
are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

HEAD, COLON, TAIL = "### ", ": ", " </turn>\n"
ROLE = re.compile(r"(?:[^\\:]|\\.|:(?! ))*+", re.S)
TEXT = re.compile(r"(?:[^\\# ]|\\.|#(?!## )| (?!</turn>\n))*+", re.S)
ROLE_CONFLICT = re.compile(r"\\|:(?= )")
TEXT_CONFLICT = re.compile(r"\\|#(?=## )| (?=</turn>\n)")
ESCAPED = re.compile(r"\\(.)", re.S)
LOSS_ROLE = "assistant"
CONFLICT = (-7, r"\### Assistant: </turn> ok")


def escape(text: str, level: int, conflict: re.Pattern) -> str:
    """Level 0: as it is, 1: conflicting content escaped, 2: every character escaped."""
    if level == 1:
        return conflict.sub(lambda m: "\\" + m.group(), text)
    return "".join("\\" + c for c in text) if level else text


def parse(rendered: str) -> list[tuple[str, str]] | None:
    """Roles and texts, unescaped; None if the string is not of the grammar."""
    turns, at = [], 0
    while at < len(rendered):
        found = []
        if not rendered.startswith(HEAD, at):
            return None
        at += len(HEAD)
        for pattern, end in ((ROLE, COLON), (TEXT, TAIL)):
            stop = pattern.match(rendered, at).end()
            if not rendered.startswith(end, stop):
                return None
            found.append(ESCAPED.sub(r"\1", rendered[at:stop]))
            at = stop + len(end)
        turns.append((found[0], found[1]))
    return turns


def render(role: str | None, text: str | None) -> tuple[str, int, int]:
    """A rendered turn that reads back as its source, and the span of its (escaped) text."""
    role, text = role or "", text or ""
    for level in (0, 1, 2):
        head = HEAD + escape(role, level, ROLE_CONFLICT) + COLON
        turn = head + escape(text, level, TEXT_CONFLICT) + TAIL
        if parse(turn) == [(role, text)]:
            return turn, len(head), len(turn) - len(TAIL)
    raise AssertionError("a fully escaped turn reads back")


TURN = T.StructType([
    T.StructField("rendered", T.StringType()), T.StructField("text_start", T.LongType()),
    T.StructField("text_end", T.LongType()), T.StructField("chars", T.LongType()),
])


def format_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, rendered turn, its length in characters and the span of its text in it."""

    @F.pandas_udf(TURN)
    def rendered(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for roles, texts in batches:
            out = [render(r, t) for r, t in zip(roles, texts, strict=True)]
            yield pd.DataFrame([(*x, len(x[0])) for x in out], columns=TURN.names)

    return conversations.select("conv_id", "turn", "role", rendered("role", "text").alias("r")).select(
        "conv_id", "turn", "role", "r.*"
    )


def turn_order() -> list[Column]:
    """Turns of a conversation by turn, role and text, the text read from the rendered turn."""
    start, end = F.col("text_start").cast("int"), F.col("text_end").cast("int")
    text = F.regexp_replace(F.substring("rendered", start + 1, end - start), r"(?s)\\(.)", "$1")
    return [F.col("turn"), F.coalesce("role", F.lit("")), text]


def in_loss(role: str) -> Column:
    """Whether the text of a turn is under the loss mask."""
    return F.coalesce(F.col("role") == role, F.lit(False))


def loss_spans(turns: DataFrame, role: str = LOSS_ROLE) -> DataFrame:
    """conv_id, turn, start and end of the (escaped) texts under the loss mask, in the conversation."""
    before = Window.partitionBy("conv_id").orderBy(*turn_order()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    start = F.coalesce(F.sum("chars").over(before), F.lit(0))
    return (
        turns.withColumn("at", start)
        .filter(in_loss(role))
        .select("conv_id", "turn", (F.col("at") + F.col("text_start")).alias("start"),
                (F.col("at") + F.col("text_end")).alias("end"))
    )


def read_back(turns: DataFrame, role: str = LOSS_ROLE) -> DataFrame:
    """Digests of each conversation, from the rendered turns alone.

    Roles and texts are those the parser finds; the loss is what lies in the spans of the mask.
    """

    class Reader:
        def __init__(self):
            self.turns = self.loss = self.chars = 0
            self.all, self.masked = hashlib.sha256(), hashlib.sha256()

        def feed(self, rendered: str, masked: bool, start: int, end: int) -> None:
            self.chars += len(rendered)
            for who, text in parse(rendered):
                self.turns += 1
                self.all.update(f"{who}\n{text}\n".encode("utf-8", "surrogatepass"))
            if masked:
                text = ESCAPED.sub(r"\1", rendered[start:end])
                self.loss += len(text)
                self.masked.update(text.encode("utf-8", "surrogatepass"))

        def row(self, conv_id):
            return (
                conv_id, self.turns, self.all.hexdigest(), self.loss, self.masked.hexdigest(), self.chars
            )

    columns = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, reader, done = None, None, []
        for batch in batches:
            for is_null, conv_id, *turn in zip(
                *(batch[c] for c in ("no_id", "conv_id", "rendered", "masked", "text_start", "text_end")),
                strict=True,
            ):
                key = None if is_null else int(conv_id)
                if reader is None or key != current:
                    if reader is not None:
                        done.append(reader.row(current))
                    current, reader = key, Reader()
                reader.feed(*turn)
            if done:
                yield pd.DataFrame(done, columns=columns).astype({"conv_id": "Int64"})
                done = []
        if reader is not None:
            yield pd.DataFrame([reader.row(current)], columns=columns).astype({"conv_id": "Int64"})

    # One task reads a conversation in order; it streams, whatever the number of turns.
    return (
        turns.select(
            F.col("conv_id").isNull().alias("no_id"),
            F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("conv_id"), "turn", "role",
            "rendered", in_loss(role).alias("masked"), "text_start", "text_end",
        )
        .repartition("no_id", "conv_id")
        .sortWithinPartitions("no_id", "conv_id", *turn_order())
        .select("no_id", "conv_id", "rendered", "masked", "text_start", "text_end")
        .mapInPandas(
            stream,
            "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
            "formatted_chars long",
        )
    )


def with_conflict(conversations: DataFrame) -> DataFrame:
    """The conversations and one whose texts look like the template's own control strings."""
    conv_id, text = CONFLICT
    more = conversations.sparkSession.createDataFrame(
        [(conv_id, 0, "user", text), (conv_id, 1, LOSS_ROLE, text)],
        "conv_id long, turn long, role string, text string",
    )
    return conversations.select("conv_id", "turn", "role", "text").union(more)


def digests(conversations: DataFrame) -> DataFrame:
    return read_back(format_turns(conversations))


ORACLE = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(15 + length(role) + length(text)
           + len(regexp_extract_all(role, '\\')) + len(regexp_extract_all(role, ': '))
           + len(regexp_extract_all(text, '\\')) + len(regexp_extract_all(text, '### '))
           + len(regexp_extract_all(text, ' </turn>\n')))::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
"""
