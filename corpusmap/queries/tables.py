"""Status, worklists and joins (groups B, C, D of the inventory)."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmap import fixtures as fx
from corpusmap.fixtures import with_views
from corpusmap.operators import joins, status, worklists
from corpusmap.queries.registry import query
from corpusmap.sources.languages import with_language

EN = "enwiki_namespace_0"


# ---------------------------------------------------------------- D: aggregates
@query("d1_chunk_status", with_views("chunk_log", """
    SELECT namespace, count(*) AS total_chunks, count(downloaded_at) AS downloaded_chunks,
           count(chunk_extracted_path) AS extracted_chunks
    FROM chunk_log GROUP BY namespace"""))
def d1(spark, sf):
    return status.chunk_status(fx.chunk_log(spark, sf))


@query("d2_page_count", with_views("page_log", """
    SELECT namespace, count(page_id) AS total_pages FROM page_log GROUP BY namespace"""))
def d2(spark, sf):
    return status.page_count(fx.page_log(spark, sf))


VECTOR_STATUS = """
    SELECT namespace, count(embedding_vector) AS embedding_count, count(reduced_vector) AS reduced_count,
           count(three_d_vector) AS three_d_count, count(cluster_id) AS clustered_count,
           count(cluster_node_id) AS tree_clustered_count
    FROM page_vector GROUP BY namespace"""


@query("d3_vector_status", with_views("page_vector", VECTOR_STATUS))
def d3(spark, sf):
    return status.vector_status(fx.page_vector(spark, sf))


TREE_STATUS = """
    SELECT namespace, count(*) AS tree_nodes, count(first_label) AS first_label_count,
           count(final_label) AS final_label_count
    FROM cluster_tree GROUP BY namespace"""


@query("d4_tree_status", with_views("cluster_tree", TREE_STATUS))
def d4(spark, sf):
    return status.tree_status(fx.cluster_tree(spark, sf))


@query("d5_depth_histogram", with_views("cluster_tree", """
    SELECT namespace, depth, count(*) AS node_count FROM cluster_tree
    GROUP BY namespace, depth ORDER BY namespace, depth"""))
def d5(spark, sf):
    return status.depth_histogram(fx.cluster_tree(spark, sf))


@query("d6_namespaces", with_views("chunk_log", "SELECT DISTINCT namespace FROM chunk_log ORDER BY namespace"))
def d6(spark, sf):
    return status.namespaces(fx.chunk_log(spark, sf))


@query("d7_embedding_count", with_views("page_vector", f"""
    SELECT count(embedding_vector) AS embedding_count FROM page_vector WHERE namespace = '{EN}'"""))
def d7(spark, sf):
    return status.embedding_count(fx.page_vector(spark, sf), EN)


@query("d8_clusters_needing_projection", with_views("page_vector", """
    SELECT namespace, cluster_id AS cluster, count(page_id) AS open_pages FROM page_vector
    WHERE three_d_vector IS NULL AND cluster_id IS NOT NULL GROUP BY namespace, cluster_id"""))
def d8(spark, sf):
    return status.clusters_needing_projection(fx.page_vector(spark, sf), cluster_col="cluster_id")


@query("d8_first_nodes_needing_projection", with_views("page_vector", f"""
    SELECT namespace, cluster_node_id AS cluster, count(page_id) AS open_pages FROM page_vector
    WHERE three_d_vector IS NULL AND cluster_node_id IS NOT NULL AND namespace = '{EN}'
    GROUP BY namespace, cluster_node_id ORDER BY cluster_node_id LIMIT 7"""))
def d8_limit(spark, sf):
    return status.clusters_needing_projection(fx.page_vector(spark, sf), EN, limit=7)


@query("d9_max_node_id", with_views("cluster_tree", """
    SELECT coalesce(max(node_id), 0) AS max_node_id FROM cluster_tree"""))
def d9(spark, sf):
    return status.max_node_id(fx.cluster_tree(spark, sf))


@query("d10_chunks_per_namespace", with_views("chunk_log", """
    SELECT namespace, count(*) AS chunk_count FROM chunk_log GROUP BY namespace"""))
def d10(spark, sf):
    return status.chunks_per_namespace(fx.chunk_log(spark, sf))


@query("d11_pages_per_unpacked_chunk", with_views("page_log chunk_log", """
    SELECT namespace, chunk_name, count(*) AS page_count FROM page_log
    SEMI JOIN (SELECT * FROM chunk_log WHERE chunk_extracted_path IS NOT NULL) USING (namespace, chunk_name)
    GROUP BY namespace, chunk_name"""))
def d11(spark, sf):
    done = fx.chunk_log(spark, sf).filter(F.col("chunk_extracted_path").isNotNull())
    return status.pages_per_chunk(fx.page_log(spark, sf), done)


@query("d12_status_report", with_views("page_log chunk_log page_vector cluster_tree", f"""
    WITH c AS (SELECT namespace, count(*) AS total_chunks, count(downloaded_at) AS downloaded_chunks,
                      count(chunk_extracted_path) AS extracted_chunks FROM chunk_log GROUP BY namespace),
         p AS (SELECT namespace, count(page_id) AS total_pages FROM page_log GROUP BY namespace),
         v AS ({VECTOR_STATUS}), t AS ({TREE_STATUS}),
         h AS (SELECT namespace, string_agg(CAST(depth AS VARCHAR) || ':' || CAST(n AS VARCHAR), ',' ORDER BY depth) AS depth_counts
               FROM (SELECT namespace, depth, count(*) AS n FROM cluster_tree GROUP BY namespace, depth)
               GROUP BY namespace)
    SELECT namespace, total_chunks, downloaded_chunks, extracted_chunks, coalesce(total_pages, 0) AS total_pages,
           coalesce(embedding_count, 0) AS embedding_count, coalesce(reduced_count, 0) AS reduced_count,
           coalesce(three_d_count, 0) AS three_d_count, coalesce(clustered_count, 0) AS clustered_count,
           coalesce(tree_clustered_count, 0) AS tree_clustered_count, coalesce(tree_nodes, 0) AS tree_nodes,
           coalesce(first_label_count, 0) AS first_label_count, coalesce(final_label_count, 0) AS final_label_count,
           coalesce(depth_counts, '') AS depth_counts
    FROM c LEFT JOIN p USING (namespace) LEFT JOIN v USING (namespace) LEFT JOIN t USING (namespace)
           LEFT JOIN h USING (namespace)"""))
def d12(spark, sf):
    return status.status_report(
        fx.chunk_log(spark, sf), fx.page_log(spark, sf), fx.page_vector(spark, sf), fx.cluster_tree(spark, sf)
    )


# ---------------------------------------------------------------- B: worklists and lookups
@query("b1_page_by_id", with_views("page_log", f"""
    SELECT namespace, page_id, title, chunk_name, url, CAST(extracted_at AS VARCHAR) AS extracted_at, abstract
    FROM page_log WHERE namespace = '{EN}' AND page_id = 1 LIMIT 1"""))
def b1(spark, sf):
    page = worklists.page_by_id(fx.page_log(spark, sf), EN, 1)
    return page.withColumn("extracted_at", F.col("extracted_at").cast("string"))


@query("b2_chunks_to_download", with_views("chunk_log", """
    SELECT namespace, chunk_name FROM chunk_log WHERE downloaded_at IS NULL
    ORDER BY namespace, chunk_name LIMIT 5"""))
def b2(spark, sf):
    return worklists.chunks_to_download(fx.chunk_log(spark, sf), limit=5)


@query("b2_next_chunk_of_namespace", with_views("chunk_log", f"""
    SELECT namespace, chunk_name FROM chunk_log WHERE downloaded_at IS NULL AND namespace = '{EN}'
    ORDER BY chunk_name LIMIT 1"""))
def b2_default(spark, sf):
    return worklists.chunks_to_download(fx.chunk_log(spark, sf), EN)


@query("b3_chunks_to_unpack", with_views("chunk_log", """
    SELECT namespace, chunk_name, chunk_archive_path FROM chunk_log
    WHERE chunk_archive_path IS NOT NULL AND chunk_extracted_path IS NULL"""))
def b3(spark, sf):
    return worklists.chunks_to_unpack(fx.chunk_log(spark, sf))


PENDING = """
    pending AS (SELECT namespace, chunk_name, page_id FROM page_log
                ANTI JOIN (SELECT * FROM page_vector WHERE embedding_vector IS NOT NULL) USING (namespace, page_id))"""


@query("b4_pages_needing_embedding", with_views("page_log page_vector", f"""
    WITH {PENDING} SELECT * FROM pending"""))
def b4(spark, sf):
    return worklists.pages_needing_embedding(fx.page_log(spark, sf), fx.page_vector(spark, sf))


@query("b4_pages_of_chunk_needing_embedding", with_views("page_log page_vector", f"""
    WITH {PENDING} SELECT * FROM pending WHERE chunk_name = '{EN}_chunk_2' ORDER BY page_id"""))
def b4_chunk(spark, sf):
    return worklists.pages_needing_embedding(
        fx.page_log(spark, sf), fx.page_vector(spark, sf), EN, f"{EN}_chunk_2", ordered=True
    )


@query("b5_chunks_needing_embedding", with_views("page_log page_vector", f"""
    WITH {PENDING} SELECT DISTINCT namespace, chunk_name FROM pending"""))
def b5(spark, sf):
    return worklists.chunks_needing_embedding(fx.page_log(spark, sf), fx.page_vector(spark, sf))


@query("b6_pages_within_budget", with_views("page_log page_vector", f"""
    WITH {PENDING} SELECT * FROM pending ORDER BY namespace, chunk_name, page_id LIMIT 123"""))
def b6(spark, sf):
    return worklists.pages_within_budget(fx.page_log(spark, sf), fx.page_vector(spark, sf), 123)


@query("b7_vectors_with_columns", with_views("page_vector", """
    SELECT namespace, page_id, cluster_id, cluster_node_id, round(CAST(reduced_vector[1] AS DOUBLE), 6) AS x
    FROM page_vector WHERE reduced_vector IS NOT NULL AND cluster_id IS NOT NULL AND cluster_node_id IS NOT NULL"""))
def b7(spark, sf):
    rows = worklists.vectors_with(
        fx.page_vector(spark, sf), ["reduced_vector", "cluster_id", "cluster_node_id"]
    )
    return rows.withColumn("x", F.round(F.col("reduced_vector")[0].cast("double"), 6)).drop("reduced_vector")


@query("b8_reduced_vectors", with_views("page_vector", """
    SELECT namespace, page_id, CAST(len(reduced_vector) AS INT) AS dims,
           round(CAST(reduced_vector[8] AS DOUBLE), 6) AS last_value
    FROM page_vector WHERE reduced_vector IS NOT NULL"""))
def b8(spark, sf):
    rows = worklists.reduced_vectors(fx.page_vector(spark, sf))
    return rows.select(
        "namespace", "page_id", F.size("reduced_vector").alias("dims"),
        F.round(F.col("reduced_vector")[7].cast("double"), 6).alias("last_value"),
    )


@query("b9_reduced_vectors_of_cluster", with_views("page_vector", f"""
    SELECT namespace, page_id, round(CAST(reduced_vector[1] AS DOUBLE), 6) AS x FROM page_vector
    WHERE namespace = '{EN}' AND cluster_id = 3"""))
def b9(spark, sf):
    rows = worklists.reduced_vectors_of_cluster(fx.page_vector(spark, sf), EN, 3, "cluster_id")
    return rows.select("namespace", "page_id", F.round(F.col("reduced_vector")[0].cast("double"), 6).alias("x"))


@query("b10_node_parent", with_views("cluster_tree", f"""
    SELECT namespace, node_id, parent_id FROM cluster_tree WHERE namespace = '{EN}' AND node_id = 105"""))
def b10(spark, sf):
    return worklists.node_parent(fx.cluster_tree(spark, sf), EN, 105)


@query("b11_node_first_label", with_views("cluster_tree", f"""
    SELECT namespace, node_id, first_label FROM cluster_tree WHERE namespace = '{EN}' AND node_id = 104"""))
def b11(spark, sf):
    return worklists.node_first_label(fx.cluster_tree(spark, sf), EN, 104)


@query("b12_nodes_for_labelling", with_views("cluster_tree", """
    SELECT namespace, node_id, depth, parent_id, first_label, final_label FROM cluster_tree"""))
def b12(spark, sf):
    return worklists.nodes_for_labelling(fx.cluster_tree(spark, sf))


LEAF_FLAG = """
    flagged AS (SELECT t.*, NOT EXISTS (SELECT 1 FROM cluster_tree c
                WHERE c.namespace = t.namespace AND c.parent_id = t.node_id) AS is_leaf FROM cluster_tree t)"""


@query("b13_leaf_nodes", with_views("cluster_tree", f"""
    WITH {LEAF_FLAG} SELECT namespace, node_id, doc_count FROM flagged WHERE is_leaf"""))
def b13(spark, sf):
    return worklists.leaf_nodes(fx.cluster_tree(spark, sf)).select("namespace", "node_id", "doc_count")


@query("b14_labelling_worklists", with_views("cluster_tree", f"""
    WITH {LEAF_FLAG}
    SELECT 'refresh' AS mode, 1 AS step, namespace, node_id FROM flagged WHERE is_leaf
    UNION ALL SELECT 'refresh', 2, namespace, node_id FROM flagged WHERE is_leaf
    UNION ALL SELECT 'refresh', 3, namespace, node_id FROM flagged
              WHERE NOT is_leaf AND parent_id IS NOT NULL AND coalesce(first_label, '') = ''
    UNION ALL SELECT 'resume', 1, namespace, node_id FROM flagged WHERE is_leaf AND coalesce(first_label, '') = ''
    UNION ALL SELECT 'resume', 2, namespace, node_id FROM flagged WHERE is_leaf AND coalesce(final_label, '') = ''
    UNION ALL SELECT 'resume', 3, namespace, node_id FROM flagged
              WHERE NOT is_leaf AND parent_id IS NOT NULL AND coalesce(first_label, '') = ''
    UNION ALL SELECT 'resume', 4, namespace, node_id FROM flagged
              WHERE NOT is_leaf AND parent_id IS NOT NULL AND coalesce(final_label, '') = ''"""))
def b14(spark, sf):
    nodes = worklists.with_leaf_flag(fx.cluster_tree(spark, sf))
    lists = None
    for mode, steps in (("refresh", (1, 2, 3)), ("resume", (1, 2, 3, 4))):
        for step in steps:
            part = worklists.labelling_worklist(nodes, step, mode).select(
                F.lit(mode).alias("mode"), F.lit(step).alias("step"), "namespace", "node_id"
            )
            lists = part if lists is None else lists.unionByName(part)
    return lists


# ---------------------------------------------------------------- C: joins
@query("c1_pages_of_node", with_views("page_log page_vector", f"""
    SELECT p.namespace, p.page_id, title, chunk_name, url, abstract FROM page_log p JOIN page_vector v
    ON p.namespace = v.namespace AND p.page_id = v.page_id
    WHERE p.namespace = '{EN}' AND v.cluster_node_id = 113"""))
def c1(spark, sf):
    rows = joins.pages_of_node(fx.page_log(spark, sf), fx.page_vector(spark, sf), EN, 113)
    return rows.drop("extracted_at")


@query("c2_node_pages", with_views("page_log page_vector", """
    SELECT namespace, cluster_node_id AS node_id, page_id, title, substring(abstract, 1, 500) AS abstract
    FROM page_log JOIN page_vector USING (namespace, page_id)"""))
def c2(spark, sf):
    return joins.node_pages(fx.page_log(spark, sf), fx.page_vector(spark, sf))


@query("c3_pages_without_vector", with_views("page_log page_vector", """
    SELECT p.namespace, p.page_id, p.title FROM page_log p
    LEFT JOIN page_vector v ON p.namespace = v.namespace AND p.page_id = v.page_id
    WHERE v.embedding_vector IS NULL"""))
def c3(spark, sf):
    pages = fx.page_log(spark, sf).select("namespace", "page_id", "title")
    return worklists.without_embedding(pages, fx.page_vector(spark, sf))


@query("c4_neighbouring_topics", with_views("cluster_tree", """
    SELECT n.namespace, n.node_id,
           coalesce(string_agg(s.first_label, ', ' ORDER BY s.node_id), '') AS neighbouring_topics,
           CAST(count(s.node_id) AS INT) AS sibling_count
    FROM cluster_tree n LEFT JOIN cluster_tree s
      ON n.namespace = s.namespace AND n.parent_id = s.parent_id AND n.node_id <> s.node_id
    WHERE n.parent_id IS NOT NULL GROUP BY n.namespace, n.node_id"""))
def c4(spark, sf):
    return joins.neighbouring_topics(fx.cluster_tree(spark, sf))


@query("c4_neighbours_of_node", with_views("cluster_tree", f"""
    SELECT first_label FROM cluster_tree
    WHERE namespace = '{EN}' AND parent_id = 101 AND node_id <> 104 AND first_label IS NOT NULL"""))
def c4_node(spark, sf):
    return joins.neighbouring_first_labels(fx.cluster_tree(spark, sf), EN, 104, 101)


@query("c5_children_by_parent", with_views("cluster_tree", """
    SELECT namespace, parent_id, string_agg(CAST(node_id AS VARCHAR), ',' ORDER BY node_id) AS children,
           CAST(count(*) AS INT) AS child_count
    FROM cluster_tree WHERE parent_id IS NOT NULL GROUP BY namespace, parent_id"""))
def c5(spark, sf):
    return joins.children_by_parent(fx.cluster_tree(spark, sf)).select(
        "namespace", "parent_id",
        F.array_join(F.col("children.node_id").cast("array<string>"), ",").alias("children"),
        F.size("children").alias("child_count"),
    )


@query("c6_pages_with_language", with_views("page_log languages", """
    SELECT namespace, page_id, language FROM page_log JOIN languages USING (namespace)"""))
def c6(spark, sf):
    pages = fx.page_log(spark, sf).select("namespace", "page_id")
    return with_language(pages, fx.languages(spark))
