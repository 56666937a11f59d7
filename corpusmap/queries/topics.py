"""Prompts, labels and the four passes (group G)."""

from __future__ import annotations

import hashlib
import re
import threading
import time

from pyspark.sql import functions as F

from corpusmap import fixtures as fx
from corpusmap.fixtures import table, with_views
from corpusmap.functions.text import WHITESPACE, collapse_whitespace
from corpusmap.operators import graph, prompts
from corpusmap.operators.joins import node_page_lines
from corpusmap.operators.worklists import leaf_nodes, with_leaf_flag
from corpusmap.plans.labelling import first_nodes, label_trees
from corpusmap.queries.registry import query

NODE_LABELS = ("namespace", "node_id", "first_label", "final_label")


def squeeze(sql):
    return f"trim(regexp_replace({sql}, '{WHITESPACE}', ' ', 'g'))"


def prompt_sql(template, content, neighbours="''"):
    """A filled prompt template as a SQL expression."""
    parts = re.split(r"\{(\w+)\}", template)
    slots = {"content": content, "neighbours": neighbours}
    return squeeze(" || ".join(f"{slots[x]}" if k % 2 else f"'{x}'" for k, x in enumerate(parts)))


LINES = """
    lines AS (
      SELECT namespace, node_id, string_agg(line, '; ' ORDER BY page_id) AS page_lines FROM (
        SELECT namespace, cluster_node_id AS node_id, page_id,
               title || CASE WHEN abstract IS NOT NULL THEN ': ' || substring(abstract, 1, 500) ELSE '' END AS line,
               row_number() OVER (PARTITION BY namespace, cluster_node_id ORDER BY page_id) AS pos
        FROM page_log JOIN page_vector USING (namespace, page_id))
      WHERE pos <= 100 GROUP BY namespace, node_id)"""


def siblings(labels):
    return f"""
      SELECT n.namespace, n.node_id, coalesce(string_agg(s.first_label, ', ' ORDER BY s.node_id), '') AS near,
             count(s.node_id) AS mates
      FROM {labels} n LEFT JOIN {labels} s
        ON n.namespace = s.namespace AND n.parent_id = s.parent_id AND n.node_id <> s.node_id
      WHERE n.parent_id IS NOT NULL GROUP BY n.namespace, n.node_id"""


def children(labels, column):
    return f"""
      SELECT namespace, parent_id AS node_id, coalesce(string_agg({column}, ', ' ORDER BY node_id), '') AS below
      FROM {labels} WHERE parent_id IS NOT NULL GROUP BY namespace, parent_id"""


PAGES_ONLY = prompt_sql(prompts.DEFAULT.leaf, "page_lines")
PAGES_CONTRAST = prompt_sql(prompts.DEFAULT.leaf_contrast, "page_lines", "near")
TOPICS_ONLY = prompt_sql(prompts.DEFAULT.stem, "below")
TOPICS_CONTRAST = prompt_sql(prompts.DEFAULT.stem_contrast, "below", "near")


@query("g1_system_prompts", with_views("page_log languages", f"""
    SELECT DISTINCT namespace, '{prompts.DEFAULT.system} Generated output should only be in ' || language || '.' AS system_prompt
    FROM page_log JOIN languages USING (namespace)"""))
def g1(spark, sf):
    return prompts.system_prompts(fx.page_log(spark, sf), fx.languages(spark))


@query("g2a_leaf_prompts", with_views("page_log page_vector cluster_tree", f"""
    WITH {LINES} SELECT namespace, node_id, {PAGES_ONLY} AS prompt FROM cluster_tree JOIN lines USING (namespace, node_id)
    WHERE depth = 2"""))
def g2a(spark, sf):
    leaves = leaf_nodes(fx.cluster_tree(spark, sf))
    return prompts.leaf_prompts(leaves, g2_lines(spark, sf))


@query("g2b_leaf_contrast_prompts", with_views("page_log page_vector cluster_tree", f"""
    WITH {LINES}, sib AS ({siblings('cluster_tree')})
    SELECT namespace, node_id, {PAGES_CONTRAST} AS prompt
    FROM cluster_tree JOIN lines USING (namespace, node_id) JOIN sib USING (namespace, node_id) WHERE depth = 2"""))
def g2b(spark, sf):
    nodes = fx.cluster_tree(spark, sf)
    return prompts.leaf_contrast_prompts(leaf_nodes(nodes), nodes, g2_lines(spark, sf))


@query("g2c_stem_prompts", with_views("cluster_tree", f"""
    WITH kids AS ({children('cluster_tree', 'first_label')})
    SELECT namespace, node_id, {TOPICS_ONLY} AS prompt FROM cluster_tree JOIN kids USING (namespace, node_id)"""))
def g2c(spark, sf):
    nodes = fx.cluster_tree(spark, sf)
    return prompts.stem_prompts(nodes, nodes)


@query("g2d_stem_contrast_prompts", with_views("cluster_tree", f"""
    WITH kids AS ({children('cluster_tree', 'final_label')}), sib AS ({siblings('cluster_tree')})
    SELECT namespace, node_id, CASE WHEN mates > 0 THEN {TOPICS_CONTRAST} END AS prompt,
           CASE WHEN mates = 0 THEN first_label END AS ready_label
    FROM cluster_tree JOIN kids USING (namespace, node_id) JOIN sib USING (namespace, node_id)"""))
def g2d(spark, sf):
    nodes = fx.cluster_tree(spark, sf)
    return prompts.stem_contrast_prompts(nodes, nodes)


@query("g2_page_lines", with_views("page_log page_vector", f"WITH {LINES} SELECT * FROM lines"))
def g2_lines(spark, sf):
    return node_page_lines(fx.page_log(spark, sf), fx.page_vector(spark, sf))


@query("g3_collapse_whitespace", f"SELECT doc_id, {squeeze('text')} AS collapsed FROM documents")
def g3(spark, sf):
    return table(spark, sf, "documents").select("doc_id", collapse_whitespace(F.col("text")).alias("collapsed"))


CONTEXT = 4000


def digest_labeler(system, prompt):
    """Stand-in for a model: the prompt's digest, and a server error past CONTEXT characters."""
    if len(prompt) > CONTEXT:
        raise prompts.ServerError(500, "context exceeded")
    return f" {hashlib.md5(prompt.encode()).hexdigest()} "


HALVINGS = f"CASE {' '.join(f'WHEN length(prompt) // {1 << j} <= {CONTEXT} THEN {j}' for j in range(5))} END"


def digest_sql(prompt):
    """``digest_labeler`` with its retries, as SQL over a prompt expression."""
    return f"(SELECT md5(substring(prompt, 1, length(prompt) // (1 << ({HALVINGS})))) FROM (SELECT {prompt} AS prompt))"


@query("g4_label_calls", with_views("page_log page_vector cluster_tree", f"""
    WITH {LINES}, asked AS (SELECT namespace, node_id, {PAGES_ONLY} AS prompt
                            FROM cluster_tree JOIN lines USING (namespace, node_id) WHERE depth = 2)
    SELECT namespace, node_id, md5(substring(prompt, 1, length(prompt) // (1 << ({HALVINGS})))) AS label,
           CAST({HALVINGS} AS INT) AS errors FROM asked"""))
def g4(spark, sf):
    nodes = fx.cluster_tree(spark, sf)
    asked = prompts.leaf_prompts(leaf_nodes(nodes), g2_lines(spark, sf))
    systems = prompts.system_prompts(nodes, fx.languages(spark))
    found = prompts.label_prompts(asked, systems, digest_labeler, calls=8, pause=(0, 0))
    answered = F.when(F.col("failure").isNull(), F.col("errors"))  # NULL: no number of attempts was enough
    return found.select("namespace", "node_id", "label", answered.alias("errors"))


class InFlight:
    """A stand-in for a model that answers with how many of its calls are under way in this worker."""

    def __init__(self):
        self.now = 0

    def __getstate__(self):
        return {"now": 0}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.lock = threading.Lock()

    def __call__(self, system: str, prompt: str) -> str:
        with self.lock:
            self.now += 1
            seen = self.now
        time.sleep(0.002)
        with self.lock:
            self.now -= 1
        return f"{seen} {prompt[-20:]}"


@query("g9_calls_in_flight", with_views("page_log page_vector cluster_tree", f"""
    WITH {LINES}, asked AS (SELECT namespace, node_id, {PAGES_ONLY} AS prompt
                            FROM cluster_tree JOIN lines USING (namespace, node_id) WHERE depth = 2)
    SELECT namespace, node_id, true AS within_bound, trim(right(prompt, 20)) AS asked_last FROM asked"""))
def g9(spark, sf):
    """Six calls at a time over all tasks, three on the threads of each; answers stay with their nodes."""
    nodes = fx.cluster_tree(spark, sf)
    asked = prompts.leaf_prompts(leaf_nodes(nodes), g2_lines(spark, sf))
    systems = prompts.system_prompts(nodes, fx.languages(spark))
    found = prompts.label_prompts(asked, systems, InFlight(), calls=6, per_task=3)
    tasks = found.withColumn("_task", F.spark_partition_id())
    seen = F.split_part("label", F.lit(" "), F.lit(1)).cast("int")
    return tasks.select(
        "namespace", "node_id", (seen.between(1, 3) & (F.col("_task") < 2)).alias("within_bound"),
        F.trim(F.expr("substring(label, instr(label, ' ') + 1)")).alias("asked_last"),
    )


@query("g4b_node_top_terms", with_views("page_log page_vector", r"""
    WITH words AS (SELECT namespace, cluster_node_id AS node_id,
                          unnest(regexp_split_to_array(lower(concat_ws(chr(10), title, abstract)), '[^\p{L}\p{N}]+')) AS term
                   FROM page_log JOIN page_vector USING (namespace, page_id)),
         counts AS (SELECT namespace, node_id, term, count(*) AS uses FROM words WHERE term <> '' GROUP BY ALL),
         spread AS (SELECT namespace, term, count(*) AS nodes_with FROM counts GROUP BY ALL),
         totals AS (SELECT namespace, count(DISTINCT node_id) AS nodes FROM counts GROUP BY ALL),
         scored AS (SELECT namespace, node_id, term, round(uses * ln((nodes + 1) / nodes_with), 6) AS score
                    FROM counts JOIN spread USING (namespace, term) JOIN totals USING (namespace))
    SELECT namespace, node_id, term, score, CAST(row_number() OVER (PARTITION BY namespace, node_id ORDER BY score DESC, term) AS INT) AS rank
    FROM scored QUALIFY rank <= 10"""))
def g4b(spark, sf):
    return prompts.node_top_terms(fx.page_log(spark, sf), fx.page_vector(spark, sf))


FOUR_PASSES = f"""
    {LINES}, languages_used AS (SELECT namespace, language FROM languages),
    one AS (SELECT t.namespace, t.node_id, t.parent_id, t.depth,
                   CASE WHEN depth = 2 THEN {digest_sql(PAGES_ONLY)} END AS first_label, page_lines
            FROM cluster_tree t LEFT JOIN lines USING (namespace, node_id)),
    sib_one AS ({siblings('one')}),
    two AS (SELECT one.*, CASE WHEN depth = 2 THEN {digest_sql(PAGES_CONTRAST)} END AS final_label
            FROM one LEFT JOIN sib_one USING (namespace, node_id)),
    kids_two AS ({children('two', 'first_label')}),
    three AS (SELECT two.* REPLACE (CASE WHEN depth = 1 THEN {digest_sql(TOPICS_ONLY)} ELSE first_label END AS first_label)
              FROM two LEFT JOIN kids_two USING (namespace, node_id)),
    kids_three AS ({children('three', 'final_label')}), sib_three AS ({siblings('three')}),
    four AS (SELECT three.* REPLACE (CASE WHEN depth = 1 AND mates = 0 THEN first_label
                                          WHEN depth = 1 THEN {digest_sql(TOPICS_CONTRAST)} ELSE final_label END AS final_label)
             FROM three LEFT JOIN kids_three USING (namespace, node_id) LEFT JOIN sib_three USING (namespace, node_id)),
    labelled AS (SELECT namespace, node_id, depth, CASE WHEN depth = 0 THEN language || ' {graph.ROOT_SUFFIX}' ELSE first_label END AS first_label,
                        CASE WHEN depth = 0 THEN language || ' {graph.ROOT_SUFFIX}' ELSE final_label END AS final_label
                 FROM four JOIN languages_used USING (namespace))"""


def run_labels(spark, sf, **options):
    return label_trees(
        fx.cluster_tree(spark, sf), fx.page_log(spark, sf), fx.page_vector(spark, sf), fx.languages(spark),
        digest_labeler, pause=(0, 0), **options,
    )


@query("g5_four_passes", with_views("page_log page_vector cluster_tree languages", f"""
    WITH {FOUR_PASSES} SELECT namespace, node_id, first_label, final_label FROM labelled"""))
def g5(spark, sf):
    return run_labels(spark, sf, mode="refresh").nodes.select(*NODE_LABELS)


@query("g5_limited_passes", with_views("page_log page_vector cluster_tree languages", f"""
    WITH {FOUR_PASSES}, placed_leaves AS (
      SELECT *, row_number() OVER (PARTITION BY namespace ORDER BY node_id) AS pos,
             count(*) OVER (PARTITION BY namespace) AS leaves FROM labelled WHERE depth = 2)
    SELECT t.namespace, t.node_id, CASE WHEN pos <= 8 THEN p.first_label END AS first_label,
           CAST(NULL AS VARCHAR) AS final_label
    FROM cluster_tree t LEFT JOIN placed_leaves p USING (namespace, node_id)"""))
def g5_limit(spark, sf):
    """A limit below every namespace's number of leaves ends the run within pass 1."""
    return run_labels(spark, sf, mode="refresh", limit=8).nodes.select(*NODE_LABELS)


@query("g6_shared_limit", with_views("cluster_tree", """
    SELECT namespace, node_id, depth FROM (
      SELECT *, row_number() OVER (PARTITION BY namespace ORDER BY depth DESC, node_id) AS pos,
             CASE namespace WHEN 'dewiki_namespace_0' THEN 3 WHEN 'enwiki_namespace_0' THEN 17 ELSE 0 END AS allowed
      FROM cluster_tree) WHERE pos <= allowed"""))
def g6(spark, sf):
    work = fx.cluster_tree(spark, sf).select("namespace", "node_id", "depth")
    return first_nodes(work, [F.desc("depth"), "node_id"], {"dewiki_namespace_0": 3, "enwiki_namespace_0": 17})


@query("g7_lone_children", with_views("cluster_tree", """
    SELECT namespace, node_id, first_label AS ready_label FROM cluster_tree t
    WHERE child_count > 0 AND parent_id IS NOT NULL AND first_label IS NOT NULL AND NOT EXISTS (
      SELECT 1 FROM cluster_tree s WHERE s.namespace = t.namespace AND s.parent_id = t.parent_id AND s.node_id <> t.node_id)
    UNION ALL SELECT 'all', count(*), 'inner nodes below a root' FROM cluster_tree WHERE child_count > 0 AND parent_id IS NOT NULL"""))
def g7(spark, sf):
    nodes = with_leaf_flag(fx.cluster_tree(spark, sf))
    asked = prompts.stem_contrast_prompts(nodes.filter("not is_leaf"), nodes)
    lone = asked.filter("ready_label is not null").select("namespace", "node_id", "ready_label")
    return lone.unionByName(asked.agg(
        F.lit("all").alias("namespace"), F.count(F.lit(1)).alias("node_id"), F.lit("inner nodes below a root").alias("ready_label")
    ))


@query("g8_root_labels", with_views("cluster_tree languages", f"""
    SELECT namespace, node_id, language || ' {graph.ROOT_SUFFIX}' AS root_label
    FROM cluster_tree JOIN languages USING (namespace) WHERE parent_id IS NULL"""))
def g8(spark, sf):
    return graph.root_labels(fx.cluster_tree(spark, sf), fx.languages(spark))
