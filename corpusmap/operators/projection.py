"""Neighbours within a cluster and 3-D coordinates per cluster."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmap.functions.grouped import float_lists, map_small_groups, matrix
from corpusmap.functions.kmeans import unit_rows
from corpusmap.functions.ranking import take_in_order
from corpusmap.operators import layout, pca
from corpusmap.operators.neighbours import BLOCK_ROWS, NEIGHBOURS, cluster_neighbours, pairs_compared
from corpusmap.operators.worklists import check_limit, in_namespace
from corpusmap.session import broadcast_if_small, cut_lineage

# Fixed value: dimensions of the projection.
DIMENSIONS = 3
METHODS = ("pca3", "neighbour")


def top_neighbours(query_ids, query: np.ndarray, ids: np.ndarray, unit: np.ndarray, k: int):
    """For each query row the k nearest other rows: parallel arrays (query id, id, distance).

    Distances are rounded so that equal vectors tie whatever block they are met in; two zero vectors
    are equal too.
    """
    distance = np.maximum(np.round(1.0 - query @ unit.T, 12), 0.0)
    distance[np.ix_(~query.any(1), ~unit.any(1))] = 0.0
    distance[query_ids[:, None] == ids[None, :]] = np.inf
    k = min(k, len(ids))
    order = np.lexsort((np.broadcast_to(ids, distance.shape), distance), axis=1)[:, :k]
    rows = np.repeat(np.arange(len(query_ids)), k)
    cols = order.ravel()
    found = distance[rows, cols]
    keep = np.isfinite(found)
    return query_ids[rows[keep]], ids[cols[keep]], found[keep]


def neighbour_layout(ids: np.ndarray, x: np.ndarray, k: int = NEIGHBOURS) -> np.ndarray:
    """Spectral layout of the k-neighbour graph: the three smoothest directions over its links."""
    n = len(x)
    if n <= DIMENSIONS + 1:
        return _padded(x - x.mean(0))
    unit = unit_rows(x)
    left, right, _ = top_neighbours(ids, unit, ids, unit, min(k, n - 1))
    position = {page: i for i, page in enumerate(ids.tolist())}
    links = np.zeros((n, n))
    links[[position[p] for p in left.tolist()], [position[p] for p in right.tolist()]] = 1.0
    links = np.maximum(links, links.T) + np.eye(n)
    root = 1.0 / np.sqrt(links.sum(1))
    walk = links * root[:, None] * root[None, :]
    trivial = (1.0 / root) / np.linalg.norm(1.0 / root)
    _, axes = np.linalg.eigh(walk - np.outer(trivial, trivial))
    basis = axes[:, ::-1][:, :DIMENSIONS]
    largest = basis[np.abs(basis).argmax(0), np.arange(DIMENSIONS)]
    return basis * np.where(largest < 0, -1.0, 1.0) * np.sqrt(n)


def component_layout(x: np.ndarray) -> np.ndarray:
    """Coordinates on the three leading components, the largest loading of each positive."""
    centred = x - x.mean(0)
    _, _, axes = np.linalg.svd(centred, full_matrices=False)
    axes = axes[:DIMENSIONS]
    largest = axes[np.arange(len(axes)), np.abs(axes).argmax(1)]
    return _padded(centred @ (axes * np.where(largest < 0, -1.0, 1.0)[:, None]).T)


def _padded(x: np.ndarray) -> np.ndarray:
    out = np.zeros((len(x), DIMENSIONS))
    out[:, : min(DIMENSIONS, x.shape[1])] = x[:, :DIMENSIONS]
    return out


def project_clusters(
    vectors: DataFrame,
    method: str = "pca3",
    namespace: str | None = None,
    limit: int | None = None,
    cluster_col: str = "cluster_node_id",
    max_group_docs: int = BLOCK_ROWS,
) -> DataFrame:
    """(namespace, page_id, three_d_vector) for every page with a reduced vector in a cluster that has
    pages without coordinates.

    Clusters of up to ``max_group_docs`` pages are laid out by one task each. Larger ones go through
    the grouped principal components, or for ``neighbour`` through the search by pivots and the spectral layout over
    the edge table; neither needs a cluster in one place.
    """
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}, got {method!r}")
    check_limit(limit)
    keys = ["namespace", "cluster"]
    members = in_namespace(vectors, namespace).select(
        "namespace", "page_id", F.col(cluster_col).alias("cluster"), F.col("reduced_vector").alias("x"),
        F.col("three_d_vector").isNull().alias("_open"),
    ).filter(F.col("cluster").isNotNull())
    sizes = members.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.count_if("_open").alias("_open"))
    wanted = cut_lineage(take_in_order(sizes.filter(F.col("_open") > 0).select(*keys, "n"), keys, limit), "clusters")
    rows = members.filter(F.col("x").isNotNull()).drop("_open")
    small = wanted.filter(F.col("n") <= max_group_docs).select(*keys)
    large = wanted.filter(F.col("n") > max_group_docs).select(*keys)  # at most one row per max_group_docs pages

    def placed_group(group: pa.Table) -> pa.Table:
        x = matrix(group.column("x").combine_chunks())
        if method == "neighbour":
            placed = neighbour_layout(group.column("page_id").to_numpy(), x)
        else:
            placed = component_layout(x)
        return pa.table({
            "namespace": group.column("namespace"), "page_id": group.column("page_id"),
            "three_d_vector": float_lists(placed.astype(np.float32)),
        })

    done = map_small_groups(
        rows.join(broadcast_if_small(small), keys, "left_semi"), keys, ["page_id"], placed_group,
        "namespace string, page_id bigint, three_d_vector array<float>",
    )
    if large.isEmpty():
        return done
    wide = rows.join(broadcast_if_small(large), keys, "left_semi").withColumn("node", F.to_json(F.struct(*keys))).drop("cluster")
    if method == "neighbour":
        near = cut_lineage(cluster_neighbours(wide, ["node"], "x", block_rows=max_group_docs), "neighbours")
        placed = layout.neighbour_coordinates(wide.select("node", "page_id", "x"), near, "x", DIMENSIONS)
        placed = placed.withColumn("namespace", F.get_json_object("node", "$.namespace"))
    else:
        bases = cut_lineage(pca.fit(wide, "node", "x", DIMENSIONS), "bases")
        placed = pca.transform(wide, "node", "x", bases, DIMENSIONS, "three_d_vector")
    return done.unionByName(placed.select("namespace", "page_id", "three_d_vector"))
