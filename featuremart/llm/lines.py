"""Line deduplication by a log-template tree. DataFrame functions only.

Each line goes down a tree of fixed depth: its number of tokens, then its first LEAD tokens. Tokens
with a digit are variable fields and stand as ``<*>``. At a leaf the rest of the line is its
template; a line of SPAN_TOKENS tokens or more also gives three templates in which one third of the
rest is a variable field, so lines that differ only there share one. Templates are keys, so lines
meet by an aggregation and no two lines are compared.

A template recurs if it is in at least ``min_docs`` documents. Copies of one document would make all
its lines recur, so documents are told apart by a signature, the least and the greatest hash of the
tree leaves of their lines: copies, and most near copies, have the same one and count once. So do
different documents whose extreme leaves coincide, which the query's SQL asks for. With ``by_content``
documents are told apart by their text, and near copies (0.8 or more of the five-word shingles, counted
exactly) are found first and are one document throughout: they count once, and as one they are the first
or lose the line, so that they stay near copies. Lines of a recurring template are dropped from all
documents but the first that has it (smallest doc_id); within a document nothing is dropped for being
repeated there. Lines of fewer than ``min_tokens``
tokens are left alone. With ``long_docs`` the whole template of a line of more than LONG_TOKENS tokens
recurs from that many documents on; the query, whose SQL counts all alike, does without.

A busy template sends one row per task and signature to the count. Occurrences meet the recurring
templates in a join, whose hot keys adaptive execution splits; there they are rows of a few numbers.

Edge cases. A null text stays null, an empty one empty, both with n_dropped 0. Rows with a null
doc_id come after all others. Rows with the same doc_id and text are one document; rows that
share a doc_id keep the same lines of a template. An empty table gives no rows.
Other columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featuremart.llm.common import NO_ID, components, packed, staged

MIN_DOCS = 3
MIN_TOKENS = 3
LEAD = 3
SPAN_TOKENS = 12
LONG_TOKENS = 50
SHINGLE = 5
LEAST = 0.8
SKETCH = 32
KEYS = 8
#: Sketches of 32 of a pair at 0.8 fall below this in about one pair of 30,000.
LEAST_SKETCH = 0.5
LAST_ID = 2**63 - 1
#: A token with a digit; the search only starts where a token does.
VARIABLE = r"(?<!\S)[^\s\d]*+\d\S*"
SPACES = " \t\n\r\x0b\f"


def masked_tokens(line: Column, spaces: str = r"\s+") -> Column:
    """Tokens of a line between ASCII spaces, variable fields as ``<*>``."""
    plain = F.btrim(line, F.lit(SPACES))
    fixed = F.when(line.rlike("[0-9]"), F.regexp_replace(plain, VARIABLE, "<*>")).otherwise(plain)
    return F.split(fixed, spaces, -1)


def of_lines(text: Column, of: Callable[[Column], Column]) -> Column:
    """``of`` the tokens of every line, as an array.

    Tokens of a text with single blanks only are cut without a pattern. They are handed on as a
    lambda's argument, which keeps them out of the row.
    """
    def each(spaces: str) -> Column:
        return F.transform(
            F.split(text, "\n", -1),
            lambda line: F.get(F.transform(F.array(masked_tokens(line, spaces)), of), 0),
        )

    odd = reduce(or_, [text.contains(c) for c in ("  ", "\t", "\r", "\x0b", "\f")])
    return F.when(odd, each(r"\s+")).otherwise(each(" "))


def leaf(tokens: Column) -> Column:
    """Place in the tree: number of tokens and the first tokens."""
    return F.concat_ws(" ", F.size(tokens).cast("string"), F.slice(tokens, 1, LEAD))


def signature(leaves: Column) -> Column:
    """Least and greatest digest of the leaves of a document's lines, as one number."""
    return F.xxhash64(F.array_min(leaves), F.array_max(leaves))


def shingles(words: Column) -> Column:
    """Different hashes of the five-word shingles; ``words`` must be a column, as each shingle evaluates it."""
    return F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(words) - SHINGLE + 1, F.lit(1))),
        lambda i: F.xxhash64(F.slice(words, i, SHINGLE)),
    ))


def similarity(a: Column, b: Column, size: int) -> Column:
    """Share of the ``size`` least hashes of two sketches together that both have."""
    both = F.slice(F.array_sort(F.array_union(a, b)), 1, size)
    return F.size(F.array_intersect(F.array_intersect(a, b), both)) / F.size(both)


def text_classes(rows: DataFrame) -> DataFrame:
    """text_hash, signature, first: the class of near copies of each text and its least rank.

    ``rows`` has text_hash, rank and text. A text's sketch is its SKETCH least shingle hashes; texts that
    share one of the KEYS least meet in the least text hash that has it. A pair whose sketches are alike
    is compared by all its shingles, and counts as near from 0.8 on. Pairs are of a text and the first of
    a key, so a large group stays linear; texts of one class share nearly all their keys.
    """
    words = F.split(F.btrim(F.lower("text"), F.lit(SPACES)), r"\s+", -1)

    def sets_of(texts: DataFrame) -> DataFrame:
        return texts.select("text_hash", "rank", F.explode(F.array(words)).alias("words")).select(
            "text_hash", "rank", F.explode(F.array(shingles(F.col("words")))).alias("set")
        )

    marked = sets_of(rows).select("text_hash", "rank", F.slice(F.array_sort("set"), 1, SKETCH).alias("sketch"))
    marked, _ = staged(
        marked.groupBy("text_hash").agg(F.min("rank").alias("rank"), F.first("sketch").alias("sketch")), "sketches"
    )
    met = marked.select("text_hash", F.explode(F.slice("sketch", 1, KEYS)).alias("key"))
    leads = met.groupBy("key").agg(F.min("text_hash").alias("lead"), F.max("text_hash").alias("most"))
    pairs = (
        met.join(leads.filter("lead < most").select("key", "lead"), "key")
        .filter("text_hash <> lead").select("text_hash", "lead").distinct()
    )
    sketches = marked.select("text_hash", "sketch")
    other = sketches.select(F.col("text_hash").alias("lead"), F.col("sketch").alias("other"))
    alike, _ = staged(
        pairs.join(sketches, "text_hash").join(other, "lead")
        .filter(similarity(F.col("sketch"), F.col("other"), SKETCH) >= LEAST_SKETCH)
        .select("text_hash", "lead"),
        "alike",
    )
    needed = alike.select("text_hash").union(alike.select("lead")).distinct()
    needed, _ = staged(needed.join(marked.select("text_hash", "rank"), "text_hash"), "needed")
    # One row of each text, by its least rank; rows alike in both are one.
    whole, _ = staged(
        sets_of(rows.join(needed, ["text_hash", "rank"])).groupBy("text_hash").agg(F.first("set").alias("set")),
        "sets",
    )
    first = whole.select(F.col("text_hash").alias("lead"), F.col("set").alias("lead_set"))
    both = F.size(F.array_intersect("set", "lead_set"))
    links = (
        alike.join(whole, "text_hash").join(first, "lead")
        .filter(both >= LEAST * (F.size("set") + F.size("lead_set") - both) - 1e-9)
        .select(F.col("text_hash").alias("a"), F.col("lead").alias("b"))
    )
    near = components(links).withColumnRenamed("node", "text_hash")
    named = marked.select("text_hash", "rank").join(near, "text_hash", "left").select(
        "text_hash", "rank", F.coalesce("component", "text_hash").alias("signature")
    )
    least = named.groupBy("signature").agg(F.min("rank").alias("first"))
    named, _ = staged(named.join(least, "signature").select("text_hash", "signature", "first"), "classes")
    return named


def parts(tokens: Column) -> Column:
    """A line by its place in the tree and the hashes of the thirds of the rest."""
    rest = F.greatest(F.size(tokens) - LEAD, F.lit(0))
    cuts = [F.lit(0), *[F.floor(rest * i / 3).cast("int") for i in (1, 2)], rest]
    thirds = [
        F.xxhash64(F.slice(tokens, LEAD + 1 + cuts[i], cuts[i + 1] - cuts[i])).alias(f"third{i}")
        for i in range(3)
    ]
    return F.struct(
        F.size(tokens).alias("n"), F.xxhash64(F.slice(tokens, 1, LEAD)).alias("lead"), *thirds
    )


def templates() -> Column:
    """Keys of the templates of a line, from its parts."""

    def key(kind: int, *kept: int) -> Column:
        return F.xxhash64(F.lit(kind), "n", "lead", *[f"third{i}" for i in kept])

    whole = key(0, 0, 1, 2)
    spans = [key(i + 1, *[j for j in range(3) if j != i]) for i in range(3)]
    return F.when(F.col("n") >= SPAN_TOKENS, F.array(whole, *spans)).otherwise(F.array(whole))


def dedup_lines(
    docs: DataFrame, min_docs: int = MIN_DOCS, min_tokens: int = MIN_TOKENS,
    long_docs: int | None = None, by_content: bool = False,
) -> DataFrame:
    """One row per document: its columns as struct ``row``, the text left as ``kept_text``,
    ``n_lines`` and ``n_dropped``."""
    rows = packed(docs)
    lines = F.split(F.col("row.text"), "\n", -1)
    rank = F.when(F.col("id") == NO_ID, LAST_ID).otherwise(F.col("id"))
    full = rows.filter(F.length("row.text") > 0).withColumn("rank", rank)
    # The texts are cut into tokens once: both passes below read the parts of the lines as written.
    # Exploding an array of one keeps the optimizer from repeating its expression in every use.
    def line_parts(tokens: Column) -> Column:
        marks = [] if by_content else [F.md5(leaf(tokens)).alias("leaf")]
        return F.struct(parts(tokens).alias("parts"), *marks)

    tokenized = full.select(
        "id", "text_hash", "rank", F.explode(F.array(of_lines(F.col("row.text"), line_parts))).alias("lists")
    )
    tokenized = tokenized.select(
        "id", "text_hash", "rank",
        *([] if by_content else [signature(F.col("lists.leaf")).alias("signature")]),
        F.col("lists.parts").alias("lists"),
    )
    if by_content:
        # The classes meet the parts of the lines, not the texts.
        named = text_classes(full.select("text_hash", "rank", F.col("row.text").alias("text")))
        tokenized = tokenized.drop("rank").join(named, "text_hash").withColumnRenamed("first", "rank")
    tokenized, _ = staged(tokenized, "parts")
    found = (
        tokenized.select("id", "text_hash", "rank", "signature", F.posexplode("lists").alias("at", "line"))
        .filter(F.col("line.n") >= min_tokens)
        .select("id", "text_hash", "rank", "signature", "at", "line.*")
        .select("id", "text_hash", "rank", "signature", "at", "n", F.posexplode(templates()).alias("kind", "key"))
    )
    is_long = (F.col("kind") == 0) & (F.col("n") > LONG_TOKENS)
    enough = F.lit(min_docs) if long_docs is None else F.max(
        F.when(is_long, long_docs).otherwise(min_docs)
    )
    recurring = (
        found.groupBy("key")
        .agg(F.count_distinct("signature").alias("docs"), F.min("rank").alias("first"), enough.alias("enough"))
        .filter(F.col("docs") >= F.col("enough"))
        .select("key", "first")
    )
    dropped = (
        found.select("id", "text_hash", "rank", "at", "key")
        .join(recurring, "key")
        .filter("rank > first")
        .groupBy("id", "text_hash")
        .agg(F.collect_set("at").alias("gone"))
    )
    gone = F.coalesce("gone", F.array().cast("array<int>"))
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
    text = F.when(F.size(gone) == 0, F.col("row.text")).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")
    )
    return rows.join(dropped, ["id", "text_hash"], "left").select(
        "row", text.alias("kept_text"),
        F.when(F.length("row.text") > 0, F.size(lines)).otherwise(0).cast("long").alias("n_lines"),
        F.size(gone).cast("long").alias("n_dropped"),
    )


def without_lines(docs: DataFrame, **options) -> DataFrame:
    """The documents without the dropped lines; columns of ``docs``.

    Documents that lose all their lines go; those that were empty before stay.
    """
    done = dedup_lines(docs, **options).filter("n_lines = 0 or n_dropped < n_lines")
    columns = [
        F.col("kept_text").alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c)
        for c in docs.columns
    ]
    return done.select(*columns)


#: The same in DuckDB; templates are texts there instead of hashes.
ORACLE = r"""
WITH l AS (
  SELECT rowid_ r, doc_id, text, i - 1 AS pos, lines[i] AS line, len(lines) AS n_lines
  FROM (SELECT row_number() OVER () AS rowid_, doc_id, text, string_split(text, chr(10)) AS lines
        FROM documents WHERE length(text) > 0) d, unnest(range(1, len(lines) + 1)) AS u(i)
), m AS (
  SELECT r, doc_id, pos,
         string_split(regexp_replace(trim(regexp_replace(line, '\s+', ' ', 'g')),
                                     '[^\s\d]*\d\S*', '<*>', 'g'), ' ') AS tok
  FROM l
), f AS (
  SELECT *, len(tok) AS n, array_to_string(tok[1:3], ' ') AS lead,
         min(md5(len(tok)::VARCHAR || ' ' || array_to_string(tok[1:3], ' '))) OVER (PARTITION BY r)
           || max(md5(len(tok)::VARCHAR || ' ' || array_to_string(tok[1:3], ' '))) OVER (PARTITION BY r) AS signature
  FROM m
), t AS (
  SELECT r, doc_id, pos, signature, unnest(CASE WHEN n >= 12 THEN [
      '0 ' || n || ' ' || array_to_string(tok, ' '),
      '1 ' || n || ' ' || lead || '|' || array_to_string(tok[4 + a:], ' '),
      '2 ' || n || ' ' || lead || '|' || array_to_string(tok[4:3 + a], ' ') || '|' || array_to_string(tok[4 + b:], ' '),
      '3 ' || n || ' ' || lead || '|' || array_to_string(tok[4:3 + b], ' ')]
    ELSE ['0 ' || n || ' ' || array_to_string(tok, ' ')] END) AS template
  FROM (SELECT *, ((n - 3) // 3) AS a, ((n - 3) * 2 // 3) AS b FROM f WHERE n >= 3)
), rec AS (
  SELECT template, min(doc_id) AS first FROM t GROUP BY template HAVING count(DISTINCT signature) >= 3
), gone AS (
  SELECT DISTINCT t.r, t.pos FROM t JOIN rec USING (template) WHERE t.doc_id > rec.first
)
SELECT d.doc_id, CASE WHEN k.r IS NULL THEN CASE WHEN length(d.text) > 0 THEN '' ELSE d.text END ELSE k.text END AS text,
       coalesce(c.n_lines, 0)::BIGINT AS n_lines, coalesce(c.n_dropped, 0)::BIGINT AS n_dropped
FROM (SELECT row_number() OVER () AS rowid_, doc_id, text FROM documents WHERE length(text) > 0
      UNION ALL SELECT -row_number() OVER (), doc_id, text FROM documents WHERE text IS NULL OR length(text) = 0) d
LEFT JOIN (SELECT r, string_agg(line, chr(10) ORDER BY pos) AS text FROM l ANTI JOIN gone USING (r, pos) GROUP BY r) k
  ON k.r = d.rowid_
LEFT JOIN (SELECT l.r, any_value(n_lines) AS n_lines, count(g.r) AS n_dropped
           FROM l LEFT JOIN gone g ON g.r = l.r AND g.pos = l.pos GROUP BY l.r) c ON c.r = d.rowid_
"""
