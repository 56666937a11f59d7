"""Counts and progress reports. One grouped aggregate per table, never a loop over namespaces."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmap.functions.ranking import take_in_order
from corpusmap.operators.worklists import check_limit, in_namespace


def _set(column: str, name: str) -> Column:
    return F.count(F.col(column)).alias(name)


def chunk_status(chunks: DataFrame) -> DataFrame:
    return chunks.groupBy("namespace").agg(
        F.count(F.lit(1)).alias("total_chunks"),
        _set("downloaded_at", "downloaded_chunks"),
        _set("chunk_extracted_path", "extracted_chunks"),
    )


def page_count(pages: DataFrame) -> DataFrame:
    return pages.groupBy("namespace").agg(_set("page_id", "total_pages"))


def vector_status(vectors: DataFrame) -> DataFrame:
    return vectors.groupBy("namespace").agg(
        _set("embedding_vector", "embedding_count"),
        _set("reduced_vector", "reduced_count"),
        _set("three_d_vector", "three_d_count"),
        _set("cluster_id", "clustered_count"),
        _set("cluster_node_id", "tree_clustered_count"),
    )


def tree_status(nodes: DataFrame) -> DataFrame:
    return nodes.groupBy("namespace").agg(
        F.count(F.lit(1)).alias("tree_nodes"),
        _set("first_label", "first_label_count"),
        _set("final_label", "final_label_count"),
    )


def depth_histogram(nodes: DataFrame) -> DataFrame:
    return (
        nodes.groupBy("namespace", "depth").agg(F.count(F.lit(1)).alias("node_count"))
        .orderBy("namespace", "depth")
    )


def namespaces(chunks: DataFrame) -> DataFrame:
    return chunks.select("namespace").distinct().orderBy("namespace")


def embedding_count(vectors: DataFrame, namespace: str | None = None) -> DataFrame:
    return in_namespace(vectors, namespace).agg(_set("embedding_vector", "embedding_count"))


def clusters_needing_projection(
    vectors: DataFrame,
    namespace: str | None = None,
    limit: int | None = None,
    cluster_col: str = "cluster_node_id",
) -> DataFrame:
    check_limit(limit)
    open_rows = in_namespace(vectors, namespace).filter(
        F.col("three_d_vector").isNull() & F.col(cluster_col).isNotNull()
    )
    sizes = open_rows.groupBy("namespace", F.col(cluster_col).alias("cluster")).agg(
        _set("page_id", "open_pages")
    )
    return take_in_order(sizes, ["namespace", "cluster"], limit)


def max_node_id(nodes: DataFrame) -> DataFrame:
    """Over all namespaces; 0 for an empty table."""
    return nodes.agg(F.coalesce(F.max("node_id"), F.lit(0).cast("long")).alias("max_node_id"))


def chunks_per_namespace(chunks: DataFrame) -> DataFrame:
    return chunks.groupBy("namespace").agg(F.count(F.lit(1)).alias("chunk_count"))


def pages_per_chunk(pages: DataFrame, done: DataFrame | None = None) -> DataFrame:
    """Pages of each chunk; ``done`` narrows it to the chunks of one run."""
    if done is not None:
        pages = pages.join(done.select("namespace", "chunk_name"), ["namespace", "chunk_name"], "left_semi")
    return pages.groupBy("namespace", "chunk_name").agg(F.count(F.lit(1)).alias("page_count"))


def status_report(chunks: DataFrame, pages: DataFrame, vectors: DataFrame, nodes: DataFrame) -> DataFrame:
    """Everything about each namespace known to the chunk table, one row each.

    All four inputs shrink to one row per namespace before they meet, so a namespace that holds a
    third of the pages is one partial count per map task.
    """
    per_depth = nodes.groupBy("namespace", "depth").agg(
        F.count(F.lit(1)).alias("n"), _set("first_label", "first"), _set("final_label", "final")
    )
    trees = per_depth.groupBy("namespace").agg(
        F.sum("n").alias("tree_nodes"), F.sum("first").alias("first_label_count"), F.sum("final").alias("final_label_count"),
        F.array_sort(F.collect_list(F.struct("depth", "n"))).alias("levels"),
    )
    depth_counts = F.array_join(F.transform("levels", lambda x: F.concat_ws(":", x["depth"], x["n"])), ",")
    trees = trees.withColumn("depth_counts", depth_counts).drop("levels")
    parts = [chunk_status(chunks), page_count(pages), vector_status(vectors), trees]
    report = reduce(lambda left, right: left.join(right, "namespace", "left"), parts)
    counts = [name for name, kind in report.dtypes if kind == "bigint"]
    return report.fillna(0, subset=counts).fillna("", subset=["depth_counts"])
