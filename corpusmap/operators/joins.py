"""Joins between pages, vectors and tree nodes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmap.functions.ranking import first_n_per_group
from corpusmap.functions.text import clip, page_line
from corpusmap.operators.worklists import in_namespace
from corpusmap.schemas import PAGE_KEY

# Fixed value: how many pages of a node its prompt quotes.
PAGES_PER_PROMPT = 100


def pages_of_node(pages: DataFrame, vectors: DataFrame, namespace: str, node_id: int) -> DataFrame:
    members = vectors.filter((F.col("namespace") == namespace) & (F.col("cluster_node_id") == node_id))
    return in_namespace(pages, namespace).join(members.select(*PAGE_KEY), PAGE_KEY)


def node_pages(pages: DataFrame, vectors: DataFrame, namespace: str | None = None) -> DataFrame:
    """Content of every page under its node: one row per page, abstract clipped.

    Kept in long form. A node can hold any number of pages, so a list per node would put an
    unbounded group into one task; what needs a list takes the first n (``node_page_lines``).
    """
    members = in_namespace(vectors, namespace).select(*PAGE_KEY, F.col("cluster_node_id").alias("node_id"))
    content = in_namespace(pages, namespace).select(*PAGE_KEY, "title", clip(F.col("abstract")).alias("abstract"))
    return members.join(content, PAGE_KEY)


def node_page_lines(pages: DataFrame, vectors: DataFrame, n: int = PAGES_PER_PROMPT) -> DataFrame:
    """Per node, the first ``n`` pages by id as one ``; ``-joined text.

    The clipped lines are ranked after the join; the rank's bound cuts each task's rows to n per node
    before the exchange, and the list is built on that same exchange.
    """
    members = vectors.select(*PAGE_KEY, F.col("cluster_node_id").alias("node_id")).filter(
        F.col("node_id").isNotNull()
    )
    content = pages.select(*PAGE_KEY, page_line(F.col("title"), clip(F.col("abstract"))).alias("line"))
    chosen = first_n_per_group(members.join(content, PAGE_KEY), ["namespace", "node_id"], ["page_id"], n)
    lists = chosen.groupBy("namespace", "node_id").agg(
        F.array_sort(F.collect_list(F.struct("page_id", "line"))).alias("lines")
    )
    return lists.select("namespace", "node_id", F.array_join(F.col("lines.line"), "; ").alias("page_lines"))


def children_by_parent(nodes: DataFrame) -> DataFrame:
    """Children of each parent with both labels, in id order; at most max_k of them by construction."""
    return (
        nodes.filter(F.col("parent_id").isNotNull())
        .groupBy("namespace", "parent_id")
        .agg(F.array_sort(F.collect_list(F.struct("node_id", "first_label", "final_label"))).alias("children"))
    )


def join_labels(entries: Column, field: str) -> Column:
    """The non-empty labels of a child list, ``, ``-joined."""
    kept = F.filter(entries, lambda c: c[field].isNotNull() & (c[field] != ""))
    return F.array_join(F.transform(kept, lambda c: c[field]), ", ")


def child_topics(nodes: DataFrame, field: str = "first_label") -> DataFrame:
    return children_by_parent(nodes).select(
        "namespace", F.col("parent_id").alias("node_id"), join_labels(F.col("children"), field).alias("child_topics")
    )


def neighbouring_topics(nodes: DataFrame) -> DataFrame:
    """First labels of each node's siblings and the number of siblings.

    The siblings are gathered once per parent and joined back to its children, so no table of
    sibling pairs is made.
    """
    siblings = children_by_parent(nodes)
    joined = nodes.select("namespace", "node_id", "parent_id").join(siblings, ["namespace", "parent_id"])
    others = F.filter("children", lambda c: c["node_id"] != F.col("node_id"))
    return joined.select(
        "namespace", "node_id",
        join_labels(others, "first_label").alias("neighbouring_topics"),
        F.size(others).alias("sibling_count"),
    )


def neighbouring_first_labels(nodes: DataFrame, namespace: str, node_id: int, parent_id: int) -> DataFrame:
    return in_namespace(nodes, namespace).filter(
        (F.col("parent_id") == parent_id) & (F.col("node_id") != node_id) & F.col("first_label").isNotNull()
    ).select("first_label")
