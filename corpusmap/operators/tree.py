"""Recursive k-means tree over the reduced vectors of any number of namespaces.

Nodes of one depth are treated together. Nodes with more than ``big_node_docs`` pages are split by
jobs over the whole table, all of a depth in the same scans; every smaller node is handed to one task,
which finishes its whole subtree. So a task never holds more than ``big_node_docs`` vectors, and the
number of jobs depends on the depth of the big nodes, not on their number.

A node's place is its path, ``03.17.``: fixed-width cluster numbers, so that text order is preorder.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmap import schemas
from corpusmap.functions import kmeans
from corpusmap.functions.ranking import first_n_per_group, number_rows
from corpusmap.operators import clustering
from corpusmap.operators.updates import assign_leaves, with_child_counts
from corpusmap.operators.worklists import check_limit, reduced_vectors
from corpusmap.session import broadcast_if_small, cut_lineage

SAMPLE_DOCS = 10
# Vectors one task may hold; lowers big_node_docs where the vectors are wide.
TASK_BYTES = 256 << 20


@dataclass(frozen=True)
class TreeSettings:
    leaf_target: int = 50
    max_k: int = 50
    max_depth: int = 10
    min_silhouette: float = 0.03
    big_node_docs: int = 50_000
    max_iter: int = 50
    seed: int = 42

    def __post_init__(self):
        for name in ("leaf_target", "max_k", "max_depth", "big_node_docs"):
            check_limit(getattr(self, name), name)
        if self.min_silhouette < 0:
            raise ValueError("min_silhouette must not be negative")

    @property
    def digits(self) -> int:
        return len(str(self.max_k - 1))

    def clusters(self, docs: int) -> int:
        return min(self.max_k, math.ceil(docs / self.leaf_target))

    def step(self, cluster: int) -> str:
        return f"{cluster:0{self.digits}d}."


PART_SCHEMA = (
    "namespace string, path string, page_id bigint, depth int, doc_count bigint, "
    "centroid array<float>, sample_doc_ids array<bigint>"
)
PAGES = ["namespace", "page_id", "path"]
NODES = ["namespace", "path", "depth", "doc_count", "centroid", "sample_doc_ids"]


def grow_subtree(pdf: pd.DataFrame, settings: TreeSettings) -> pd.DataFrame:
    """All nodes and page places below one small node, that node included."""
    pdf = pdf.sort_values("page_id")
    namespace, top = pdf["namespace"].iloc[0], pdf["path"].iloc[0]
    page_ids = pdf["page_id"].to_numpy()
    vectors = np.array(pdf["x"].tolist(), np.float64)
    width = settings.digits + 1
    out: list[tuple] = []
    open_nodes = [(top, np.arange(len(page_ids)))]
    while open_nodes:
        path, members = open_nodes.pop()
        depth, x = len(path) // width, vectors[members]
        centres, labels = split(page_ids[members], x, namespace, path, depth, settings)
        sample = page_ids[members[:SAMPLE_DOCS]].tolist() if depth else None
        centroid = None if labels is None else centres.mean(0).astype(np.float32).tolist()
        out.append((namespace, path, None, depth, len(members), centroid, sample))
        if labels is None:
            out.extend((namespace, path, int(p), None, None, None, None) for p in page_ids[members])
        else:
            for cluster in np.unique(labels):
                open_nodes.append((path + settings.step(int(cluster)), members[labels == cluster]))
    frame = pd.DataFrame(out, columns=["namespace", "path", "page_id", "depth", "doc_count", "centroid", "sample_doc_ids"])
    return frame.astype({"page_id": "Int64", "depth": "Int32", "doc_count": "Int64"})


def split(ids: np.ndarray, x: np.ndarray, namespace: str, path: str, depth: int, settings: TreeSettings):
    """(centres, labels) of a node's split, labels None where the node stays a leaf."""
    n, k = len(x), settings.clusters(len(x))
    if n <= settings.leaf_target or depth >= settings.max_depth or k <= 1:
        return None, None
    centres, labels = kmeans.fit(ids, x, k, settings.max_iter, settings.seed, f"{namespace}/{path}")
    filled = len(np.unique(labels))
    if filled < 2:
        return None, None
    if filled < n and kmeans.mean_silhouette(x, labels, len(centres)) < settings.min_silhouette:
        return None, None
    return centres, labels


def node_key() -> Column:
    return F.concat_ws("/", "namespace", "path")


def _split_big_nodes(rows: DataFrame, big: DataFrame, depth: int, settings: TreeSettings):
    """Split all nodes of ``big`` (namespace, path, n). Returns rows placed one level deeper, rows of
    nodes that stay leaves, and the node rows of ``big``."""
    keyed = rows.withColumn("node", node_key())
    sizes = big.select(
        node_key().alias("node"), "n", clustering.split_count(F.col("n"), settings.leaf_target, settings.max_k).alias("k")
    )
    dims = keyed.agg(F.max(F.size("x"))).first()[0]  # namespaces may differ in width
    table_bytes = settings.max_k * dims * 8
    centres = clustering.train(
        keyed, sizes, "node", "x", settings.max_k, dims, settings.max_iter, seed=settings.seed
    )
    placed = clustering.assign(keyed, "node", "x", centres, table_bytes)
    # ranges of (node, cluster, page) keep each child in few tasks and a hot child in many; the next
    # depth's scans then send sums for the nodes of their range only
    placed = cut_lineage(
        placed.repartitionByRange("node", "cluster", "page_id").sortWithinPartitions("node", "cluster"), "placed"
    )
    scores = clustering.cosine_silhouette(placed, "node", "x", "cluster", settings.max_k, dims)
    splits = (F.col("clusters") >= 2) & F.coalesce(F.col("silhouette") >= settings.min_silhouette, F.lit(True))
    # k is bounded, so the mean over a node's centres is one small array expression
    centre_mean = F.transform(
        F.sequence(F.lit(0), F.size(F.col("values")[0]) - 1),
        lambda i: (F.aggregate("values", F.lit(0.0), lambda a, c: a + F.get(c, i)) / F.size("values")).cast("float"),
    )
    verdicts = cut_lineage(
        scores.select("node", splits.alias("splits"))
        .join(centres.select("node", centre_mean.alias("centroid")), "node")
        .join(big.withColumn("node", node_key()), "node"),
        "verdicts",
    )
    judged = placed.join(broadcast_if_small(verdicts.select("node", "splits")), "node")
    step = F.concat(F.lpad(F.col("cluster").cast("string"), settings.digits, "0"), F.lit("."))
    deeper = judged.filter("splits").select("namespace", "page_id", "x", F.concat("path", step).alias("path"))
    leaves = judged.filter("not splits").select(*PAGES)
    samples = first_pages(rows, depth)
    nodes = verdicts.select(
        "namespace", "path", F.lit(depth).alias("depth"), F.col("n").alias("doc_count"),
        F.when(F.col("splits"), F.col("centroid")).alias("centroid"),
    ).join(samples, ["namespace", "path"], "left")
    return deeper, leaves, nodes.select(*NODES)


def first_pages(rows: DataFrame, depth: int) -> DataFrame:
    """The first page ids of each big node; the root has none."""
    first = first_n_per_group(rows.select(*PAGES), ["namespace", "path"], ["page_id"], SAMPLE_DOCS)
    lists = first.groupBy("namespace", "path").agg(F.array_sort(F.collect_list("page_id")).alias("sample_doc_ids"))
    return lists if depth else lists.withColumn("sample_doc_ids", F.lit(None).cast("array<bigint>"))


def build_trees(
    vectors: DataFrame, nodes: DataFrame | None = None, settings: TreeSettings = TreeSettings(),
    namespace: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(cluster_tree rows, page assignments) for every namespace with at least ``max_k`` reduced
    vectors; the others get no tree.

    ``nodes`` is the tree table the new rows will join; numbering goes on after its largest id. Pages
    under a root that stays a leaf are not assigned.
    """
    rows = reduced_vectors(vectors, namespace).select("namespace", "page_id", F.col("reduced_vector").alias("x"))
    roots = cut_lineage(
        rows.groupBy("namespace").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= settings.max_k)
        .withColumn("path", F.lit("")), "roots",
    )
    rows = rows.join(broadcast_if_small(roots.select("namespace")), "namespace", "left_semi").withColumn("path", F.lit(""))
    width = rows.agg(F.max(F.size("x"))).first()[0]
    if width:
        # chooses who does the work, not what comes out: both ways draw and improve the same centres
        settings = replace(settings, big_node_docs=min(settings.big_node_docs, max(1, TASK_BYTES // (8 * width))))
    small: list[DataFrame] = []
    leaf_pages: list[DataFrame] = []
    big_nodes: list[DataFrame] = []
    sizes, depth = roots, 0
    while True:
        big = sizes.filter(F.col("n") > settings.big_node_docs)
        keys = broadcast_if_small(big.select("namespace", "path"))
        small.append(rows.join(keys, ["namespace", "path"], "left_anti"))
        if big.isEmpty():
            break
        rows = rows.join(keys, ["namespace", "path"], "left_semi")
        if depth >= settings.max_depth:
            leaf_pages.append(rows.select(*PAGES))
            big_nodes.append(
                big.select("namespace", "path", F.lit(depth).alias("depth"), F.col("n").alias("doc_count"),
                           F.lit(None).cast(schemas.FLOATS).alias("centroid"))
                .join(first_pages(rows, depth), ["namespace", "path"], "left").select(*NODES)
            )
            break
        rows, leaves, split_nodes = _split_big_nodes(rows, big, depth, settings)
        leaf_pages.append(leaves)
        big_nodes.append(split_nodes)
        sizes = cut_lineage(rows.groupBy("namespace", "path").agg(F.count(F.lit(1)).alias("n")), "sizes")
        depth += 1

    rest = small[0]
    for part in small[1:]:
        rest = rest.unionByName(part)
    grown = cut_lineage(
        rest.groupBy("namespace", "path").applyInPandas(lambda pdf: grow_subtree(pdf, settings), PART_SCHEMA), "subtrees"
    )
    page_paths = grown.filter(F.col("page_id").isNotNull()).select(*PAGES)
    node_rows = grown.filter(F.col("page_id").isNull()).select(*NODES)
    for part in big_nodes:
        node_rows = node_rows.unionByName(part)
    numbered = cut_lineage(_number_nodes(node_rows, nodes, settings), "tree")
    leaves = numbered.filter((F.col("depth") > 0) & (F.col("child_count") == 0)).select(
        "namespace", "path", "doc_count", F.col("node_id").alias("cluster_node_id")
    )
    placed = ["namespace", "page_id", "cluster_node_id"]
    assignments = page_paths.join(leaves, ["namespace", "path"]).select(*placed)
    if leaf_pages:
        # a big leaf may hold most of the pages: too hot for a shuffle key, and there are few of them
        big_ids = broadcast_if_small(leaves.filter(F.col("doc_count") > settings.big_node_docs))
        for part in leaf_pages:
            assignments = assignments.unionByName(part.join(big_ids, ["namespace", "path"]).select(*placed))
    return numbered.select(*schemas.CLUSTER_TREE.fieldNames()), assignments


def _number_nodes(node_rows: DataFrame, existing: DataFrame | None, settings: TreeSettings) -> DataFrame:
    base = 0
    if existing is not None:
        base = existing.agg(F.max("node_id")).first()[0] or 0
    numbered = number_rows(node_rows, ["namespace", "path"], "_no").withColumn("node_id", F.col("_no") + F.lit(base))
    numbered = cut_lineage(numbered.drop("_no"), "nodes")
    width = settings.digits + 1
    parents = numbered.select("namespace", F.col("path").alias("_above"), F.col("node_id").alias("parent_id"))
    above = F.when(F.col("depth") > 0, F.expr(f"substring(path, 1, length(path) - {width})"))
    tree = numbered.withColumn("_above", above).join(parents, ["namespace", "_above"], "left").select(
        "namespace", "node_id", "parent_id", F.col("depth").cast("short").alias("depth"), "centroid",
        F.col("doc_count").cast("int").alias("doc_count"), F.lit(None).cast("array<string>").alias("top_terms"),
        "sample_doc_ids", F.lit(0).alias("child_count"), F.lit(None).cast("string").alias("first_label"),
        F.lit(None).cast("string").alias("final_label"), "path",
    )
    return with_child_counts(tree)


def rebuild(
    vectors: DataFrame, nodes: DataFrame, settings: TreeSettings = TreeSettings(), namespace: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Both tables with the trees of one or all namespaces thrown away and built anew."""
    here = F.lit(True) if namespace is None else F.col("namespace") == namespace
    kept = nodes.filter(~here)
    cleared = vectors.withColumn("cluster_node_id", F.when(~here, F.col("cluster_node_id")))
    tree, assignments = build_trees(cleared, kept, settings, namespace)
    return kept.unionByName(tree, allowMissingColumns=True), assign_leaves(cleared, assignments)
