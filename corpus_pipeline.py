"""The corpus pipeline: five stages from raw documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; between stages the rows are written
as Parquet to the shared folder and read again, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from featuremart.llm import lines, mixing, packing, resemblance, toxicity
from featuremart.llm.queries import table, tokenizer_path
from featuremart.operators.scratch import forget, scratch_path, scratch_scope


def drop_toxic(spark, docs, sf_dir):
    """Documents that the classifier chain rejects go."""
    return toxicity.clean(docs, table(spark, sf_dir, "labels"))


def drop_lines(spark, docs, sf_dir):
    """Lines of templates that recur across documents go, but for their first document.

    Passages of over 50 words go from the second document on.
    """
    return lines.without_lines(docs, long_docs=2, by_content=True)


def drop_near_duplicates(spark, docs, sf_dir):
    """One document of each group of near duplicates (five-word shingles, 0.8 or more) stays."""
    return resemblance.one_of_each(docs)


def mix_sources(spark, docs, sf_dir):
    """Each document as often as the mix takes it."""
    return mixing.mixed(docs)


def pack_sequences(spark, docs, sf_dir):
    """Pieces of the documents and their places in sequences."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("simhash_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Toxicity and packing rest on trained models and a tokenizer, which SQL cannot express.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``."""
    docs, read = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        with scratch_scope(spark):  # what a stage writes on its way goes when it is done
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        if read:
            forget(spark, read)
        docs, read = spark.read.schema(out.schema).parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
