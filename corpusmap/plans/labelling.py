"""The four labelling passes over the trees of any number of namespaces.

Pass 1 names leaves from their pages, pass 2 again in contrast to their siblings, pass 3 names inner
nodes from their children, deepest first, pass 4 again in contrast. A pass over leaves is one job, a
pass over inner nodes one job per depth. Only labels move between the steps, so the state carried
along is one narrow row per node, written out after each step because a label call must not be
repeated.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmap.functions.ranking import number_rows
from corpusmap.operators import prompts
from corpusmap.operators.graph import ROOT_SUFFIX, root_labels
from corpusmap.operators.joins import node_page_lines
from corpusmap.operators.updates import clear_labels, set_labels
from corpusmap.operators.worklists import (
    MODES, check_limit, in_namespace, labelling_worklist, nodes_for_labelling, with_leaf_flag,
)
from corpusmap.schemas import NODE_KEY
from corpusmap.session import cut_lineage


@dataclass
class LabelRun:
    """The tree with its new labels, how many node-passes each namespace took, failed calls, and prompts
    that every attempt failed on: their labels are NULL, and ``resume`` asks for them again."""

    nodes: DataFrame
    processed: dict[str, int]
    errors: int
    failed: int = 0


def first_nodes(work: DataFrame, order: Sequence, remaining: dict[str, int]) -> DataFrame:
    """Of each namespace the first so many nodes of a worklist."""
    spark = work.sparkSession
    numbered = number_rows(work, ["namespace", *order], "_no")
    starts = numbered.groupBy("namespace").agg(F.min("_no").alias("_first"))
    allowed = spark.createDataFrame(list(remaining.items()), "namespace string, _allowed bigint")
    bounds = starts.join(allowed, "namespace")  # one row per namespace
    return numbered.join(F.broadcast(bounds), "namespace").filter(
        F.col("_no") < F.col("_first") + F.col("_allowed")
    ).drop("_no", "_first", "_allowed")


def label_trees(
    nodes: DataFrame,
    pages: DataFrame,
    vectors: DataFrame,
    languages: DataFrame,
    labeler: prompts.Labeler = prompts.keyword_labeler,
    mode: str = "refresh",
    limit: int | None = None,
    namespace: str | None = None,
    strict_compat: bool = False,
    calls: int | None = None,
    root_suffix: str = ROOT_SUFFIX,
    pause: tuple[float, float] = prompts.PAUSE,
    texts: prompts.Prompts = prompts.DEFAULT,
) -> LabelRun:
    """Label the nodes of one or all namespaces.

    ``refresh`` starts over, ``resume`` does what is missing. ``limit`` caps the node-passes of each
    namespace over all four passes together; the root is labelled only where it was not reached.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    check_limit(limit)
    scope = nodes_for_labelling(clear_labels(nodes, namespace) if mode == "refresh" else nodes, namespace)
    state = cut_lineage(with_leaf_flag(scope), "labels")
    pages, vectors = in_namespace(pages, namespace), in_namespace(vectors, namespace)
    systems = cut_lineage(prompts.system_prompts(state, languages, texts), "systems")
    used = {row["namespace"]: 0 for row in systems.select("namespace").collect()}
    answers: list[DataFrame] = []

    def take(work: DataFrame, order: Sequence) -> tuple[DataFrame, list[int]]:
        """The part of a worklist within the limit, counted, and the depths in it, deepest first."""
        if limit is not None:
            work = first_nodes(work, order, {ns: limit - n for ns, n in used.items()})
        work = cut_lineage(work, "work")
        counts = work.groupBy("namespace", "depth").count().collect()
        for row in counts:
            used[row["namespace"]] += row["count"]
        return work, sorted({row["depth"] for row in counts}, reverse=True)

    def name(asked: DataFrame, column: str) -> None:
        """Get labels for prompts and put them into the state."""
        nonlocal state
        found = cut_lineage(prompts.label_prompts(asked, systems, labeler, calls, pause), "labels")
        answers.append(found.select("errors", "failure"))
        labels = found.select(*NODE_KEY, F.col("label").alias(column))
        state = cut_lineage(set_labels(state, labels, [column]), "labels")

    def page_lines(work: DataFrame) -> DataFrame:
        members = vectors.join(
            work.select("namespace", F.col("node_id").alias("cluster_node_id")), ["namespace", "cluster_node_id"], "left_semi"
        )
        return cut_lineage(node_page_lines(pages, members), "lines")

    open_first, open_final = (labelling_worklist(state, step, mode) for step in (1, 2))
    # without a limit both leaf passes quote the same pages, so their text is gathered once
    lines = page_lines(open_first.unionByName(open_final).distinct()) if limit is None else None
    leaves, _ = take(open_first, ["node_id"])
    name(prompts.leaf_prompts(leaves, page_lines(leaves) if lines is None else lines, texts), "first_label")
    leaves, _ = take(labelling_worklist(state, 2, mode), ["node_id"])
    name(prompts.leaf_contrast_prompts(leaves, state, page_lines(leaves) if lines is None else lines, texts), "final_label")

    def near(depth: int) -> DataFrame:
        """The nodes a prompt at this depth can quote: siblings and children."""
        return state.filter(F.col("depth").isin(depth, depth + 1))

    deepest_first = [F.desc("depth"), "node_id"]
    before_stems = state
    stems, depths = take(labelling_worklist(state, 3, mode), deepest_first)
    for depth in depths:
        name(prompts.stem_prompts(stems.filter(F.col("depth") == depth), near(depth), texts), "first_label")
    if strict_compat:
        chosen = labelling_worklist(before_stems, 4, mode, strict_compat).select(*NODE_KEY)
        again = state.join(chosen, NODE_KEY, "left_semi")
    else:
        again = labelling_worklist(state, 4, mode)
    stems, depths = take(again, deepest_first)
    for depth in depths:
        name(prompts.stem_contrast_prompts(stems.filter(F.col("depth") == depth), near(depth), texts), "final_label")

    finished = [ns for ns, n in used.items() if limit is None or n < limit]
    roots = root_labels(state.filter(F.col("namespace").isin(finished)), languages, root_suffix)
    both = roots.select(*NODE_KEY, F.col("root_label").alias("first_label"), F.col("root_label").alias("final_label"))
    state = cut_lineage(set_labels(state, both, ["first_label", "final_label"]), "labels")
    errors, failed = reduce(DataFrame.unionByName, answers).agg(F.sum("errors"), F.count("failure")).first()
    return LabelRun(set_labels(nodes, state, ["first_label", "final_label"]), used, errors or 0, failed)
