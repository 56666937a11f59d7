"""The tree as node and edge tables for drawing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmap.functions.text import is_blank
from corpusmap.sources.languages import with_language

# Colour by depth modulo 10, node size, what follows the language in a root label.
PALETTE = ["#FF0000", "#33FF00", "#0066FF", "#FF0099", "#CCFF00", "#00FFFF", "#CC00FF", "#FF9900", "#00FF66", "#3300FF"]
NODE_SIZE = 10
ROOT_SUFFIX = "Wikipedia"


def root_labels(nodes: DataFrame, languages: DataFrame, suffix: str = ROOT_SUFFIX) -> DataFrame:
    """(namespace, node_id, root_label) of the root nodes."""
    roots = nodes.filter(F.col("parent_id").isNull()).select("namespace", "node_id")
    return with_language(roots, languages).select(
        "namespace", "node_id", F.concat_ws(" ", "language", F.lit(suffix)).alias("root_label")
    )


def graph_nodes(
    nodes: DataFrame, languages: DataFrame, label_col: str | None = None, suffix: str = ROOT_SUFFIX
) -> DataFrame:
    """id, label, size and colour of every node.

    Without ``label_col`` the final label counts, then the first; a node without any shows its id.
    """
    if label_col is None:
        label = F.when(~is_blank(F.col("final_label")), F.col("final_label")).otherwise(F.col("first_label"))
    else:
        label = F.col(label_col)
    named = with_language(nodes.select("namespace", "node_id", "parent_id", "depth", label.alias("_label")), languages)
    shown = F.when(F.col("parent_id").isNull(), F.concat_ws(" ", "language", F.lit(suffix))).otherwise(F.col("_label"))
    fallback = F.concat(F.lit("<"), F.col("node_id").cast("string"), F.lit(">"))
    palette = F.array(*[F.lit(c) for c in PALETTE])
    return named.select(
        "namespace", F.col("node_id").alias("id"),
        F.when(is_blank(shown), fallback).otherwise(shown).alias("label"),
        F.lit(NODE_SIZE).alias("size"),
        F.element_at(palette, (F.col("depth") % len(PALETTE) + 1).cast("int")).alias("color"),
    )


def graph_edges(nodes: DataFrame) -> DataFrame:
    return nodes.filter(F.col("parent_id").isNotNull()).select(
        "namespace", F.col("parent_id").alias("source"), F.col("node_id").alias("target")
    )
