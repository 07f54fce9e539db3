from collections import Counter

import corpus_pipeline
from test_resemblance import brute_first

from featuremart.llm import lines, mixing, packing, toxicity
from featuremart.llm.common import staged
from featuremart.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.001"


def test_stages_work_on_what_is_left(spark, table):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line_dedup", "simhash_dedup", "mixing", "packing"
    ]
    docs = table("documents", "sf0.001")
    labels = table("labels", "sf0.001")
    want = {
        "toxicity": lambda d: {r.doc_id for r in toxicity.toxicity(d, labels).collect() if not r.rejected},
        "line_dedup": lambda d: {
            r.doc_id for r in lines.dedup_lines(d, long_docs=2, by_content=True)
            .selectExpr("row.doc_id", "n_lines", "n_dropped").collect()
            if not r.n_lines or r.n_dropped < r.n_lines
        },
        "simhash_dedup": lambda d: brute_first([(r.doc_id, r.text) for r in d.collect()]),
    }
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out, _ = staged(stage(spark, docs, SF), name)
        assert out.columns == docs.columns
        if name in want:
            assert {r.doc_id for r in out.select("doc_id").collect()} == want[name](docs)
        else:
            times = Counter(r.doc_id for r in out.collect())
            for r in mixing.mix(docs).collect():
                assert times[r.doc_id] == (r.taken // r.size if r.size else 0)
        assert 0 < out.count()
        docs = out
    got = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert Counter(map(tuple, got.select("doc_id", "piece", "ids_crc32").collect())) == Counter(
        map(tuple, packing.pack(docs, tokenizer_path()).select("doc_id", "piece", "ids_crc32").collect())
    )
    assert got.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_stages_take_an_empty_table(spark, table):
    docs = table("documents", "sf0.001").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def after(spark, docs, sf_dir, *names):
    """Documents after the named stages."""
    for name, stage in corpus_pipeline.STAGES:
        if name in names:
            docs, _ = staged(stage(spark, docs, sf_dir), name)
    return docs


def test_near_copies_go_over_both_stages(spark, table):
    """Surplus near duplicates of the source documents (brute force) that both stages leave behind."""
    docs = table("documents", "sf0.01")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    surplus = {d for d, _ in rows} - brute_first(rows)
    left = {r.doc_id for r in after(spark, docs, "/root/testdata/sf0.01", "line_dedup", "simhash_dedup").collect()}
    assert len(surplus) > 50
    assert len(surplus & left) <= 0.1 * len(surplus)


def test_near_copies_that_share_passages_leave_one_document(spark, documents):
    """Neither is a near copy cut down to what it has of its own."""
    passage = ["\n".join(" ".join(f"w{n}{k}{i}" for i in range(60)) for k in "abcdef") for n in range(2)]
    docs = documents(*[(i, f"first line of {i} here\n{passage[0]}\nlast line of {i} here") for i in range(3)])
    kept = after(spark, docs, SF, "line_dedup", "simhash_dedup").collect()
    assert [(r.doc_id, len(r.text.split())) for r in kept] == [(0, 370)]


def test_stages_define_odd_rows(spark, documents):
    docs = documents(
        (1, None), (2, ""), (2, ""), (None, "no id but some words to keep here"), (4, "same text twice in the table"),
        (5, "same text twice in the table"), (6, "w " * 50_000, None, None),
    )
    out = after(spark, docs, SF, "toxicity", "line_dedup", "simhash_dedup")
    assert out.columns == docs.columns
    assert sorted(str(r.doc_id) for r in out.collect()) == ["1", "4", "6", "None"]
    mixed = after(spark, out, SF, "mixing")
    assert mixed.columns == docs.columns
    assert {r.doc_id for r in corpus_pipeline.pack_sequences(spark, mixed, SF).collect()} <= {1, 4, 6, None}
