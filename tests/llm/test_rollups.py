from collections import defaultdict

import pytest
from tokenizers import Tokenizer

from featuremart.llm import rollups
from featuremart.llm.queries import QUERIES, tokenizer_path
from featuremart.operators.scratch import scratch_path


def totals(df):
    return {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in df.collect()}


def recount(rows):
    """From scratch: documents that repeat the text of a smaller id left out, end ids counted."""
    tokenizer = Tokenizer.from_file(tokenizer_path())
    first, out = {}, defaultdict(lambda: [0, 0])
    for r in rows:
        if r.text is not None and r.doc_id is not None:
            first[r.text] = min(first.get(r.text, r.doc_id), r.doc_id)
    for r in rows:
        if r.text is None or r.doc_id is None or first[r.text] == r.doc_id:
            n = len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1
            cell = out[r.source, r.lang, "byte_bpe_50k/1"]
            cell[0] += 1
            cell[1] += n
    return {k: tuple(v) for k, v in out.items()}


def test_whole_table(spark, table):
    assert totals(QUERIES["op7_token_rollups"](spark, "/root/testdata/sf0.01")) == recount(
        table("documents").collect()
    )


def test_edge_rows(spark, documents):
    docs = documents(
        (1, None), (2, ""), (3, "a b"), (3, "a b"), (5, "a b", "t"), (6, "w " * 30000, None, None), (None, "null id")
    )
    path = scratch_path(spark, "rollup")
    got = totals(rollups.corpus_counts(docs, path, tokenizer_path(), "byte_bpe_50k/1"))
    assert got == recount(docs.collect())
    empty = rollups.corpus_counts(docs.limit(0), scratch_path(spark, "rollup"), tokenizer_path(), "v")
    assert empty.count() == 0
    assert rollups.totals(spark, scratch_path(spark, "rollup")).count() == 0


def test_commits_are_idempotent_in_any_order(spark):
    rows = spark.createDataFrame(
        [("s", "en", "v1", 5, 7), ("s", "en", "v1", 2, 2), (None, None, "v1", 1, 4)],
        "source string, lang string, tokenizer string, tokens long, new_tokens long",
    )
    batches = [("in", rollups.inserts(rows)), ("re", rollups.revisions(rows)),
               ("out", rollups.deletes(rows.filter("source is null").withColumn("tokens", rows.new_tokens)))]
    for order in ([0, 1, 2, 0, 1], [2, 1, 1, 0, 2]):
        path = scratch_path(spark, "rollup")
        said = [rollups.commit(path, *batches[i]) for i in order]
        assert sum(said) == 3
        assert totals(rollups.totals(spark, path)) == {("s", "en", "v1"): (2, 9)}


def test_a_batch_without_marker_does_not_count(spark):
    rows = spark.createDataFrame(
        [("s", "en", "v1", 5)], "source string, lang string, tokenizer string, tokens long"
    )
    path = scratch_path(spark, "rollup")
    rollups.commit(path, "one", rollups.inserts(rows))
    broken = rollups.inserts(rows).groupBy(*rollups.KEYS).sum("docs", "tokens").toDF(*rollups.KEYS, "docs", "tokens")
    spark.conf.set("spark.hadoop.mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    broken.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{path}/batch-two")
    if rollups.committed(spark, path) != ["one"]:
        pytest.skip("the writer leaves its marker")
    assert totals(rollups.totals(spark, path)) == {("s", "en", "v1"): (1, 5)}
    assert rollups.commit(path, "two", rollups.inserts(rows))
    assert totals(rollups.totals(spark, path)) == {("s", "en", "v1"): (2, 10)}
