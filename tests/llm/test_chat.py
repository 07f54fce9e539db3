import hashlib
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st
from oracle_check import compare, connect

from featuremart.llm import chat
from featuremart.llm.queries import QUERIES

PARTS = st.lists(
    st.sampled_from(["### ", "### user: ", " </turn>\n", "</turn>", "\\", "#", " ", ":", ": ", "\n", "a", "é", "🙂", "<"])
).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(PARTS, PARTS | st.text(max_size=8)), max_size=4))
def test_round_trip(turns):
    rendered = [chat.render(r, t) for r, t in turns]
    assert chat.parse("".join(x[0] for x in rendered)) == turns
    for (text, start, end), (_, source) in zip(rendered, turns, strict=True):
        assert chat.ESCAPED.sub(r"\1", text[start:end]) == source


def test_texts_without_conflicts_are_shown_as_they_are():
    assert chat.render("user", "plain # text: <b> </turn>")[0] == "### user: plain # text: <b> </turn> </turn>\n"
    assert chat.parse("### user: no end") is None and chat.parse("junk") is None


def test_matches_sql(spark):
    duck = connect("/root/testdata/sf0.01")
    assert compare(QUERIES["op5_chat_round_trip"](spark, "/root/testdata/sf0.01"), duck, chat.ORACLE) == []


def brute(rows):
    by = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        by[conv].append((turn is not None, turn or 0, role or "", text or "", chat.render(role, text)[0]))
    out = {}
    for conv, turns in by.items():
        turns.sort()
        loss = "".join(t[3] for t in turns if t[2] == "assistant")
        out[conv] = (
            len(turns), hashlib.sha256("".join(f"{t[2]}\n{t[3]}\n" for t in turns).encode()).hexdigest(),
            len(loss), hashlib.sha256(loss.encode()).hexdigest(), sum(len(t[4]) for t in turns),
        )
    return out


def test_edge_rows(spark):
    rows = [
        (1, 1, "assistant", None, "x"), (1, 0, "user", "", "x"), (2, 0, None, "no role", "x"),
        (None, 5, "assistant", "null id", "x"), (None, None, "user", "null turn", "x"),
        (3, 0, "assistant", chat.CONFLICT[1], "x"), (3, 0, "assistant", chat.CONFLICT[1], "x"),
        (4, 0, "we: ird\\", "### user: </turn>\n", "x"), (0, 0, "assistant", "zero", "x"),
        (5, 0, "user", "word " * 40000, "x"),
        (7, 0, "user", "### x", "x"), (7, 0, "user", "A", "x"), (7, 0, "user2", "b", "x"),  # ties
        (8, 0, "assistant", " </turn>\n", "x"), (8, 0, "assistant", " <", "x"), (8, 0, "a: b", "\\", "x"),
        (8, 0, None, "é\n", "x"), (8, 0, "assistant", "🙂", "x"),
    ] + [(6, i, "assistant", f"turn {i}", "x") for i in range(3000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, rendered string")
    got = {r[0]: tuple(r)[1:] for r in chat.digests(df).collect()}
    assert got == brute(rows)
    more = {r[0]: tuple(r)[1:] for r in chat.digests(chat.with_conflict(df.limit(0))).collect()}
    assert more == brute([(-7, 0, "user", chat.CONFLICT[1]), (-7, 1, "assistant", chat.CONFLICT[1])])
    assert chat.digests(df.limit(0)).count() == 0


def test_loss_spans_cover_the_assistant_texts(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "a ### b"), (1, 2, "assistant", "")]
    turns = chat.format_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    whole = "".join(r.rendered for r in turns.orderBy("turn").collect())
    spans = sorted((r.turn, r.start, r.end) for r in chat.loss_spans(turns).collect())
    assert [chat.ESCAPED.sub(r"\1", whole[a:b]) for _, a, b in spans] == ["a ### b", ""]
