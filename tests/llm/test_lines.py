from collections import defaultdict

import corpus_pipeline
from oracle_check import compare, connect

from featuremart.llm import lines
from featuremart.llm.queries import QUERIES

COMMON = "This passage stands in many documents and is to go from all but the first of them."


def kept(docs, **options):
    out = lines.dedup_lines(docs, **options).select("row.doc_id", "kept_text", "n_lines", "n_dropped")
    return sorted((tuple(r) for r in out.collect()), key=repr)


def words(i):
    """A line that no other number gives."""
    return " ".join(f"{c}{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" for c in "abcdefghijklmno")


def test_matches_sql(spark):
    duck = connect("/root/testdata/sf0.001")
    assert compare(QUERIES["op4_line_templates"](spark, "/root/testdata/sf0.001"), duck, lines.ORACLE) == []


def test_recurring_line_stays_in_its_first_document(documents):
    docs = documents(*[(i, f"{words(2 * i)}\n{COMMON}\n{words(2 * i + 1)}") for i in (5, 3, 8, 4)])
    got = {d: (t, n) for d, t, _, n in kept(docs)}
    assert got[3] == (f"{words(6)}\n{COMMON}\n{words(7)}", 0)
    for i in (4, 5, 8):
        assert got[i] == (f"{words(2 * i)}\n{words(2 * i + 1)}", 1)


def test_variable_fields_share_a_template(documents):
    stamped = [(i, f"{words(i)}\nprinted on 2024-0{i + 1}-11 at 10:3{i} page {i} of 9") for i in range(4)]
    near = [(i + 10, f"{words(i + 10)}\n{COMMON.replace('go', f'g{chr(97 + i)}')}") for i in range(4)]
    got = {d: n for d, _, _, n in kept(documents(*stamped, *near))}
    assert [got[i] for i in (0, 1, 2, 3, 10, 11, 12, 13)] == [0, 1, 1, 1, 0, 1, 1, 1]


def test_copies_of_a_document_count_once(documents):
    text = "\n".join(words(i) for i in range(6))
    docs = documents(*[(i, text) for i in range(40)], (50, "something else\n" + words(70)))
    assert all(n == 0 for *_, n in kept(docs))


def test_two_documents_are_not_enough_and_short_lines_stay(documents):
    docs = documents(*[(i, f"{words(i)}\nAll rights.\n{COMMON if i < 2 else words(i + 30)}") for i in range(6)])
    assert all(n == 0 for *_, n in kept(docs))
    assert sum(n for *_, n in kept(docs, min_docs=2)) == 1
    assert sum(n for *_, n in kept(docs, min_tokens=2)) == 5


def test_edge_rows(documents):
    long = "\n".join(words(i) + f" {i}" for i in range(676)) + "\n" + "w " * 50000
    rows = [
        (1, None), (2, ""), (3, "\n\n"), (4, " \t \n"), (5, long), (None, f"{words(60)}\n{COMMON}"),
        (6, f"{words(61)}\n{COMMON}"), (7, f"{words(62)}\n{COMMON}"), (7, f"{words(62)}\n{COMMON}"),
    ]
    docs = documents(*rows)
    got = defaultdict(list)
    for d, text, n_lines, dropped in kept(docs):
        got[d].append((text, n_lines, dropped))
    assert got[1] == [(None, 0, 0)] and got[2] == [("", 0, 0)]
    assert got[3] == [("\n\n", 3, 0)] and got[4] == [(" \t \n", 2, 0)]
    assert got[6] == [(f"{words(61)}\n{COMMON}", 2, 0)]
    assert got[7] == [(words(62), 2, 1)] * 2 and got[None] == [(words(60), 2, 1)]
    assert got[5][0][0] == long
    out = lines.without_lines(docs)
    assert out.columns == docs.columns and out.count() == len(rows)
    assert kept(docs.limit(0)) == []


def test_documents_that_lose_all_lines_go(documents):
    docs = documents(*[(i, f"{words(i)}\n{COMMON}") for i in range(3)], (9, COMMON))
    assert sorted(r.doc_id for r in lines.without_lines(docs).collect()) == [0, 1, 2]


def test_main_path_is_native(documents, plan_of):
    plan = plan_of(lines.dedup_lines(documents((1, "a b c"))))
    assert "Python" not in plan and "Pandas" not in plan and "Cartesian" not in plan


def test_pipeline_drops_a_long_passage_from_the_second_document(spark, documents):
    long = " ".join(words(i) for i in range(100, 104))
    docs = documents(*[(i, f"{words(i)}\n{COMMON}\n{long}") for i in (4, 2)], (9, words(50)))
    got = {r.doc_id: r.text for r in corpus_pipeline.drop_lines(spark, docs, None).collect()}
    assert got == {2: f"{words(2)}\n{COMMON}\n{long}", 4: f"{words(4)}\n{COMMON}", 9: words(50)}


def test_pipeline_tells_documents_apart_by_their_text(spark, documents, plan_of):
    """Logs of one template have one signature; near copies of one text still count once."""
    logs = [(i, f"event {i} at 10:3{i} user {i * 7} took {i * 13} ms on node n{i}") for i in range(5)]
    text = [f"{c}{chr(97 + i)}{chr(97 + k)}" for k in range(5) for i in range(20) for c in "xy"]
    near = [
        (20 + i, "\n".join(" ".join(f"z{i}" if n == 47 + 5 * i else w for n, w in enumerate(text[a : a + 40], a))
                           for a in range(0, 200, 40)))
        for i in range(4)
    ]
    out = corpus_pipeline.drop_lines(spark, documents(*logs, *logs, *near), None)
    plan = plan_of(out)
    assert "Python" not in plan and "Pandas" not in plan and "Cartesian" not in plan
    got = [(r.doc_id, r.text) for r in out.collect()]
    assert sorted(got) == [logs[0]] * 2 + near


def test_texts_are_cut_into_tokens_once(table, plan_of):
    """With ``by_content`` the counts and the drops read the parts of the lines as written, not the texts again."""
    docs = table("documents", "sf0.001")
    assert "<*>" not in plan_of(lines.dedup_lines(docs, long_docs=2, by_content=True))


def test_query_cuts_texts_into_tokens_once(spark, plan_of):
    """The query too reads the parts as written, in both of its passes."""
    assert "<*>" not in plan_of(QUERIES["op4_line_templates"](spark, "/root/testdata/sf0.001"))


def test_odd_white_space_separates_like_a_blank(documents):
    """Texts with single blanks only are cut another way than the rest, into the same tokens."""
    stamp = "printed on 2024-01-11 for {} by mistake"
    odd = ["\t", "  ", "\x0b", "\f ", "\r"]
    docs = [(i, f"{words(i)}\n{stamp.format(i)}\n{COMMON}") for i in (1, 2)]
    docs += [(10 + i, f"{words(10 + i)}\n{stamp.format(i)}\n{COMMON}".replace(" ", s)) for i, s in enumerate(odd)]
    docs += [(20, f"{words(20)}\n {COMMON} \n\n {stamp.format(9)}")]
    got = {d: (t, n) for d, t, _, n in kept(documents(*docs))}
    assert got[1] == (docs[0][1], 0)
    assert got[2] == (words(2), 2) and got[20] == (f"{words(20)}\n", 2)
    assert [got[10 + i] for i in range(5)] == [(words(10 + i).replace(" ", s), 2) for i, s in enumerate(odd)]
