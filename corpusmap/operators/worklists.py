"""What is still to do: chunks to fetch or unpack, pages to embed, nodes to label; plus lookups.

``namespace=None`` means all namespaces. Chunk lists come back ordered, as they are handed out in
that order. Page lists do not: sorting a whole corpus costs a shuffle and no later step needs it;
pass ``ordered=True`` where the order itself is wanted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmap.functions.ranking import SMALL_LIMIT, take_in_order
from corpusmap.functions.text import is_blank
from corpusmap.schemas import CHUNK_KEY, PAGE_KEY
from corpusmap.session import broadcast_if_small, cut_lineage


def in_namespace(df: DataFrame, namespace: str | None) -> DataFrame:
    return df if namespace is None else df.filter(F.col("namespace") == namespace)


def check_limit(limit: int | None, name: str = "limit") -> None:
    if limit is not None and limit < 1:
        raise ValueError(f"{name} must be at least 1, got {limit}")


def page_by_id(pages: DataFrame, namespace: str, page_id: int) -> DataFrame:
    return pages.filter((F.col("namespace") == namespace) & (F.col("page_id") == page_id)).limit(1)


def chunks_to_download(chunks: DataFrame, namespace: str | None = None, limit: int | None = 1) -> DataFrame:
    check_limit(limit)
    todo = in_namespace(chunks, namespace).filter(F.col("downloaded_at").isNull())
    return take_in_order(todo.select("namespace", "chunk_name"), ["namespace", "chunk_name"], limit)


def chunks_to_unpack(chunks: DataFrame, namespace: str | None = None, limit: int | None = None) -> DataFrame:
    check_limit(limit)
    todo = in_namespace(chunks, namespace).filter(
        F.col("chunk_archive_path").isNotNull() & F.col("chunk_extracted_path").isNull()
    )
    return take_in_order(
        todo.select("namespace", "chunk_name", "chunk_archive_path"), ["namespace", "chunk_name"], limit
    )


def without_embedding(pages: DataFrame, vectors: DataFrame) -> DataFrame:
    """Pages that have no vector row, or one whose embedding is NULL.

    An explicit anti join: an outer join tested for NULL on a nullable column stays an outer join.
    """
    embedded = vectors.filter(F.col("embedding_vector").isNotNull()).select(*PAGE_KEY)
    return pages.join(embedded, PAGE_KEY, "left_anti")


def pages_needing_embedding(
    pages: DataFrame,
    vectors: DataFrame,
    namespace: str | None = None,
    chunk_name: str | None = None,
    ordered: bool = False,
) -> DataFrame:
    scope = in_namespace(pages, namespace)
    if chunk_name is not None:
        scope = scope.filter(F.col("chunk_name") == chunk_name)
    todo = without_embedding(
        scope.select("namespace", "chunk_name", "page_id"), in_namespace(vectors, namespace)
    )
    return todo.orderBy("namespace", "page_id") if ordered else todo


def chunks_needing_embedding(pages: DataFrame, vectors: DataFrame, namespace: str | None = None) -> DataFrame:
    todo = pages_needing_embedding(pages, vectors, namespace)
    return todo.select("namespace", "chunk_name").distinct().orderBy("namespace", "chunk_name")


def pages_within_budget(
    pages: DataFrame, vectors: DataFrame, limit: int | None, namespace: str | None = None
) -> DataFrame:
    """The next ``limit`` pages, chunk by chunk; the last chunk may be taken in part.

    Counts per chunk say which chunks fit in whole, so only the chunk the limit falls into is put in
    order.
    """
    check_limit(limit)
    todo = pages_needing_embedding(pages, vectors, namespace)
    if limit is None or limit <= SMALL_LIMIT:
        return take_in_order(todo, ["namespace", "chunk_name", "page_id"], limit)
    # one row per archive, so a single task can add them up
    before = F.sum("_n").over(Window.orderBy(*CHUNK_KEY).rowsBetween(Window.unboundedPreceding, -1))
    chunks = todo.groupBy(*CHUNK_KEY).agg(F.count(F.lit(1)).alias("_n")).withColumn(
        "_before", F.coalesce(before, F.lit(0))
    ).filter(F.col("_before") < limit)
    chunks = cut_lineage(chunks, "budget")
    fits = F.col("_before") + F.col("_n") <= limit
    whole = todo.join(broadcast_if_small(chunks.filter(fits).select(*CHUNK_KEY)), CHUNK_KEY, "left_semi")
    last = chunks.filter(~fits).first()
    if last is None:
        return whole
    cut = pages_needing_embedding(pages, vectors, last["namespace"], last["chunk_name"])
    return whole.unionByName(take_in_order(cut, ["page_id"], limit - last["_before"]))


def vectors_with(vectors: DataFrame, columns: Sequence[str], namespace: str | None = None) -> DataFrame:
    """Rows in which every chosen column is set, reduced to those columns."""
    rows = in_namespace(vectors, namespace).select(*PAGE_KEY, *columns)
    return rows.dropna(subset=list(columns)) if columns else rows


def reduced_vectors(vectors: DataFrame, namespace: str | None = None) -> DataFrame:
    return vectors_with(vectors, ["reduced_vector"], namespace)


def reduced_vectors_of_cluster(
    vectors: DataFrame, namespace: str, cluster: int, cluster_col: str = "cluster_node_id"
) -> DataFrame:
    rows = in_namespace(vectors, namespace).filter(F.col(cluster_col) == cluster)
    return rows.select(*PAGE_KEY, "reduced_vector")


def node_parent(nodes: DataFrame, namespace: str, node_id: int) -> DataFrame:
    return _node(nodes, namespace, node_id).select("namespace", "node_id", "parent_id")


def node_first_label(nodes: DataFrame, namespace: str, node_id: int) -> DataFrame:
    return _node(nodes, namespace, node_id).select("namespace", "node_id", "first_label")


def _node(nodes: DataFrame, namespace: str, node_id: int) -> DataFrame:
    return in_namespace(nodes, namespace).filter(F.col("node_id") == node_id)


def nodes_for_labelling(nodes: DataFrame, namespace: str | None = None) -> DataFrame:
    return in_namespace(nodes, namespace).select(
        "namespace", "node_id", "depth", "parent_id", "first_label", "final_label"
    )


def _parents(nodes: DataFrame) -> DataFrame:
    return (
        nodes.filter(F.col("parent_id").isNotNull())
        .select("namespace", F.col("parent_id").alias("node_id"))
        .distinct()
    )


def leaf_nodes(nodes: DataFrame) -> DataFrame:
    return nodes.join(_parents(nodes), ["namespace", "node_id"], "left_anti")


def with_leaf_flag(nodes: DataFrame) -> DataFrame:
    parents = _parents(nodes).withColumn("_has_children", F.lit(True))
    return nodes.join(parents, ["namespace", "node_id"], "left").withColumn(
        "is_leaf", F.col("_has_children").isNull()
    ).drop("_has_children")


MODES = ("refresh", "resume")


def labelling_worklist(nodes: DataFrame, step: int, mode: str, strict_compat: bool = False) -> DataFrame:
    """Nodes one labelling pass has to treat. ``nodes`` carries ``is_leaf``.

    Pass 1 and 2 take leaves: all in refresh, those without the pass's label in resume. Pass 3 takes
    inner nodes below the root without a first label. Pass 4 takes inner nodes below the root
    without a final label; with ``strict_compat`` only those pass 3 took, so the caller must then
    hand in the state from before pass 3.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    if step in (1, 2):
        label = "first_label" if step == 1 else "final_label"
        leaves = nodes.filter(F.col("is_leaf"))
        return leaves if mode == "refresh" else leaves.filter(is_blank(F.col(label)))
    if step in (3, 4):
        label = "final_label" if step == 4 and not strict_compat else "first_label"
        return nodes.filter(~F.col("is_leaf") & F.col("parent_id").isNotNull() & is_blank(F.col(label)))
    raise ValueError(f"step must be 1 to 4, got {step}")
