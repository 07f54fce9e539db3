"""Boosted trees from their public JSON dump: nested nodes to the flat node table of ``scoring``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fields of a node in the dump and their types.
FIELDS = {
    "nodeid": "int", "split": "string", "split_condition": "float", "yes": "int", "no": "int",
    "missing": "int", "leaf": "float",
}


def dump_nodes(dump: DataFrame, text: str = "value") -> DataFrame:
    """The node table (tree, node, feature, threshold, yes, no, missing, leaf) of a dump.

    ``dump`` holds one row, whose text is the array of all trees as the library writes it. A tree is
    numbered by its place there. Thresholds and leaves are taken in single precision, as they were
    trained, so models of this table are to be scored with ``single=True``. Missing values go where the
    dump says. Statistics in the dump are passed over. An error are: text that is no JSON, more rows than
    one, a node that is neither leaf nor split, a split by sets or flags instead of a threshold, a split
    without a direction for missing values, and trees of more than 100 levels. An empty array gives no rows.
    """
    only = F.count(F.lit(1)) == 1
    whole = dump.agg(F.when(only, F.first(text)).otherwise(F.raise_error(F.lit("not one dump"))).alias("t"))
    trees = whole.select(
        F.posexplode(F.variant_get(F.parse_json("t"), "$", "array<variant>")).alias("tree", "at")
    )
    below = "try_variant_get(at, '$.children', 'array<variant>')"
    nodes = dump.sparkSession.sql(
        f"""
        WITH RECURSIVE nodes (tree, at) AS (
            SELECT tree, at FROM {{trees}}
            UNION ALL
            SELECT tree, child FROM nodes LATERAL VIEW explode({below}) AS child
        )
        SELECT * FROM nodes
        """,
        trees=trees,
    )
    read = nodes.select(
        "tree", *[F.try_variant_get("at", f"$.{name}", kind).alias(name) for name, kind in FIELDS.items()]
    )
    is_leaf = F.col("leaf").isNotNull() & F.col("split").isNull()
    split = [F.col(name).isNotNull() for name in ("split", "split_condition", "yes", "no", "missing")]
    is_split = F.col("leaf").isNull()
    for known in split:
        is_split = is_split & known
    sound = F.col("nodeid").isNotNull() & (is_leaf | is_split)
    node = F.when(sound, F.col("nodeid")).otherwise(
        F.raise_error(F.concat(F.lit("a node that cannot be read in tree "), "tree")).cast("int")
    )
    return read.select(
        "tree", node.alias("node"), F.col("split").alias("feature"),
        F.col("split_condition").cast("double").alias("threshold"), "yes", "no", "missing",
        F.col("leaf").cast("double").alias("leaf"),
    )


def read_dump(spark: SparkSession, path: str) -> DataFrame:
    """The node table of a dump in a file."""
    return dump_nodes(spark.read.text(path, wholetext=True))
