"""Prompt texts for naming nodes, and the call that turns prompts into labels."""

from __future__ import annotations

import random
import re
import time
from collections import Counter
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmap.functions.ranking import first_n_per_group
from corpusmap.functions.text import collapse_whitespace, page_text
from corpusmap.operators.joins import child_topics, neighbouring_topics
from corpusmap.operators.worklists import check_limit
from corpusmap.schemas import NODE_KEY, PAGE_KEY
from corpusmap.session import broadcast_if_small, cut_lineage
from corpusmap.sources.languages import with_language

@dataclass(frozen=True)
class Prompts:
    """Texts sent to a model; ``{content}`` and ``{neighbours}`` are filled in.

    The defaults only say what is given and what is wanted back. A project passes its own.
    """

    system: str = "Topic labels."
    leaf: str = "One label for this group. The pages are: {content}."
    leaf_contrast: str = "One label for this group. The pages are: {content}. Other groups: {neighbours}."
    stem: str = "One label above these. The group topics are: {content}."
    stem_contrast: str = "One label above these. The group topics are: {content}. Other groups: {neighbours}."


DEFAULT = Prompts()
# Fixed value: the sentence that names the language.
LANGUAGE_SENTENCE = "Generated output should only be in {language}."

# Attempts per label, seconds between them, prompt length up to which it is not cut.
ATTEMPTS = 5
PAUSE = (0.025, 0.225)
KEEP_WHOLE = 250

Labeler = Callable[[str, str], str | None]


class ServerError(Exception):
    """A labeler's report of a failure on its server's side; 500 to 599 is tried again."""

    def __init__(self, status_code: int, message: str = ""):
        super().__init__(message or f"server error {status_code}")
        self.status_code = status_code


def filled(template: str, **slots: Column) -> Column:
    """A template with its slots replaced by columns; a NULL fills a slot with nothing."""
    parts = re.split(r"\{(\w+)\}", template)
    return F.concat(*[F.coalesce(slots[x], F.lit("")) if k % 2 else F.lit(x) for k, x in enumerate(parts)])


def system_prompt(language: Column, texts: Prompts = DEFAULT) -> Column:
    return filled(f"{texts.system} {LANGUAGE_SENTENCE}", language=language)


def system_prompts(namespaces: DataFrame, languages: DataFrame, texts: Prompts = DEFAULT) -> DataFrame:
    return with_language(namespaces.select("namespace").distinct(), languages).select(
        "namespace", system_prompt(F.col("language"), texts).alias("system_prompt")
    )


def _prompt(template: str, content: Column, neighbours: Column | None = None) -> Column:
    """The filled template, NULL without content."""
    slots = {"content": content} if neighbours is None else {"content": content, "neighbours": neighbours}
    return F.when(content.isNotNull(), collapse_whitespace(filled(template, **slots)))


def leaf_prompts(work: DataFrame, lines: DataFrame, texts: Prompts = DEFAULT) -> DataFrame:
    """(namespace, node_id, prompt) of leaves, ``lines`` from ``node_page_lines``; a leaf without pages
    gets no prompt."""
    return work.select(*NODE_KEY).join(lines, NODE_KEY, "left").select(
        *NODE_KEY, _prompt(texts.leaf, F.col("page_lines")).alias("prompt")
    )


def leaf_contrast_prompts(work: DataFrame, nodes: DataFrame, lines: DataFrame, texts: Prompts = DEFAULT) -> DataFrame:
    """The same with the siblings' first labels. Nodes without a parent are left out."""
    near = neighbouring_topics(nodes)
    return work.select(*NODE_KEY).join(near, NODE_KEY).join(lines, NODE_KEY, "left").select(
        *NODE_KEY, _prompt(texts.leaf_contrast, F.col("page_lines"), F.col("neighbouring_topics")).alias("prompt")
    )


def stem_prompts(work: DataFrame, nodes: DataFrame, texts: Prompts = DEFAULT) -> DataFrame:
    """(namespace, node_id, prompt) of inner nodes from their children's first labels."""
    below = child_topics(nodes, "first_label")
    return work.select(*NODE_KEY).join(below, NODE_KEY).select(
        *NODE_KEY, _prompt(texts.stem, F.col("child_topics")).alias("prompt")
    )


def stem_contrast_prompts(work: DataFrame, nodes: DataFrame, texts: Prompts = DEFAULT) -> DataFrame:
    """Inner nodes from their children's final and their siblings' first labels.

    A node without siblings has no prompt but ``first_label`` as ``ready_label``.
    """
    below = child_topics(nodes, "final_label")
    near = neighbouring_topics(nodes)
    prompt = _prompt(texts.stem_contrast, F.col("child_topics"), F.col("neighbouring_topics"))
    alone = F.col("sibling_count") == 0
    return (
        work.select(*NODE_KEY, "first_label").join(below, NODE_KEY).join(near, NODE_KEY)
        .select(*NODE_KEY, F.when(~alone, prompt).alias("prompt"), F.when(alone, F.col("first_label")).alias("ready_label"))
    )


def call_labeler(labeler: Labeler, system: str, prompt: str, pause: tuple[float, float] = PAUSE) -> tuple[str | None, int]:
    """(label, failed attempts). Server errors are tried again with half the prompt if it is long."""
    for failed in range(ATTEMPTS):
        try:
            label = labeler(system, prompt)
            return (label.strip() if label else None), failed
        except ServerError as error:
            if not 500 <= error.status_code <= 599 or failed == ATTEMPTS - 1:
                raise
            time.sleep(random.uniform(*pause))
            if len(prompt) > KEEP_WHOLE:
                prompt = prompt[: len(prompt) // 2]
    raise AssertionError("unreachable")


def label_prompts(
    prompts: DataFrame, systems: DataFrame, labeler: Labeler, calls: int | None = None,
    pause: tuple[float, float] = PAUSE, per_task: int = 1,
) -> DataFrame:
    """(namespace, node_id, label, errors, failure); a NULL prompt gives ``ready_label``, if there is that column,
    or a NULL label, without a call.

    ``errors`` counts failed attempts. Where the last attempt met a server error too, the label is NULL and ``failure``
    says why; the other labels of the job stay. Any other error of the labeler ends the job.

    ``systems`` has one row per namespace. ``calls`` caps how many calls are made at a time over all tasks; without it
    every task makes its own. A task has up to ``per_task`` of them in flight on a pool of threads and gives the
    results in the order of its rows, so the labeler must bear being called from several threads if ``per_task`` is
    more than 1. Write the result out before using it twice.
    """
    check_limit(per_task, "per_task")
    check_limit(calls, "calls")
    if calls is not None:
        per_task = min(per_task, calls)
    ready = F.col("ready_label") if "ready_label" in prompts.columns else F.lit(None).cast("string")
    work = prompts.withColumn("ready_label", ready).join(broadcast_if_small(systems), "namespace").select(
        *NODE_KEY, "system_prompt", "prompt", "ready_label"
    )
    if calls is not None:
        work = work.repartition(calls // per_task)

    def label(system: str, prompt: str | None, ready: str | None) -> tuple[str | None, int, str | None]:
        if prompt is None:
            return ready, 0, None
        try:
            return *call_labeler(labeler, system, prompt, pause), None
        except ServerError as error:
            if not 500 <= error.status_code <= 599:
                raise
            return None, ATTEMPTS, str(error)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(per_task) as pool:
            for batch in batches:
                found = list(pool.map(label, batch["system_prompt"], batch["prompt"], batch["ready_label"]))
                yield pd.DataFrame({
                    "namespace": batch["namespace"].to_numpy(), "node_id": batch["node_id"].to_numpy(),
                    "label": [label for label, _, _ in found], "errors": [errors for _, errors, _ in found],
                    "failure": [failure for _, _, failure in found],
                })

    return work.mapInPandas(run, "namespace string, node_id bigint, label string, errors int, failure string")


def keyword_labeler(system: str, prompt: str) -> str | None:
    """Offline stand-in for a model: the most frequent longer words of the quoted content."""
    content = re.split(r" are: | Other groups: ", prompt + " ")[1:2] or [""]
    words = [w.strip(".,;:!?()").lower() for w in content[0].split()]
    ranked = sorted(Counter(w for w in words if len(w) > 3).items(), key=lambda item: (-item[1], item[0]))
    return " ".join(w for w, _ in ranked[:3]).capitalize() or None


def node_top_terms(pages: DataFrame, vectors: DataFrame, n: int = 10) -> DataFrame:
    """(namespace, node_id, term, score, rank): the terms that mark a node's pages, by tf-idf over the
    nodes of its namespace; whole titles and abstracts."""
    members = vectors.select(*PAGE_KEY, F.col("cluster_node_id").alias("node_id")).filter("node_id is not null")
    text = page_text(F.col("title"), F.col("abstract"))
    words = members.join(pages.select(*PAGE_KEY, text.alias("text")), PAGE_KEY).select(
        *NODE_KEY, F.explode(F.split(F.lower("text"), r"[^\p{L}\p{N}]+")).alias("term")
    ).filter(F.col("term") != "")
    counts = cut_lineage(words.groupBy(*NODE_KEY, "term").agg(F.count(F.lit(1)).alias("uses")), "terms")
    spread = counts.groupBy("namespace", "term").agg(F.count(F.lit(1)).alias("nodes_with"))
    nodes = counts.select(*NODE_KEY).distinct()
    totals = cut_lineage(nodes.groupBy("namespace").agg(F.count(F.lit(1)).alias("nodes")), "totals")
    score = F.round(F.col("uses") * F.log((F.col("nodes") + 1) / F.col("nodes_with")), 6)
    scored = counts.join(spread, ["namespace", "term"]).join(broadcast_if_small(totals), "namespace").select(
        *NODE_KEY, "term", score.alias("score")
    )
    return first_n_per_group(scored, NODE_KEY, [F.desc("score"), "term"], n, rank="rank")


def fill_top_terms(nodes: DataFrame, top_terms: DataFrame) -> DataFrame:
    """Nodes with ``top_terms`` as a list, best first."""
    lists = top_terms.groupBy(*NODE_KEY).agg(F.array_sort(F.collect_list(F.struct("rank", "term"))).alias("_t"))
    columns = nodes.columns
    return nodes.drop("top_terms").join(lists, NODE_KEY, "left").withColumn("top_terms", F.col("_t.term")).select(*columns)
