"""Table changes (group E). Changes are derived from whole driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmap import fixtures as fx
from corpusmap.fixtures import table, with_views
from corpusmap.operators import updates
from corpusmap.operators.parts import PartedTable
from corpusmap.queries.registry import query
from corpusmap.schemas import PAGE_KEY, PAGE_LOG
from corpusmap.session import new_folder

EN = "enwiki_namespace_0"
AS_OF = "2024-06-01 12:00:00"


def _text(df, *columns):
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def _number(column, position):
    return F.round(F.col(column)[position].cast("double"), 6)


# Web pages and benchmark items arrive as changes to the English pages; ids of both overlap with each
# other (the item is the later one) and with stored pages.
PAGE_CHANGES_SQL = f"""
    changes AS (
      SELECT '{EN}' AS namespace, page_id, url AS title, 'web' AS chunk_name, url,
             html AS abstract, 1 AS seq FROM pages
      UNION ALL
      SELECT '{EN}', item_id, text, 'benchmark', 'item:' || CAST(item_id AS VARCHAR), NULL, 2 FROM benchmark),
    latest AS (SELECT * FROM changes QUALIFY row_number() OVER (PARTITION BY namespace, page_id ORDER BY seq DESC) = 1)"""


def page_changes(spark, sf):
    web = table(spark, sf, "pages").select(
        F.lit(EN).alias("namespace"), "page_id", F.col("url").alias("title"), F.lit("web").alias("chunk_name"),
        "url", F.col("html").alias("abstract"), F.lit(1).alias("seq"),
    )
    items = table(spark, sf, "benchmark").select(
        F.lit(EN).alias("namespace"), F.col("item_id").alias("page_id"), F.col("text").alias("title"),
        F.lit("benchmark").alias("chunk_name"),
        F.concat(F.lit("item:"), F.col("item_id").cast("string")).alias("url"),
        F.lit(None).cast("string").alias("abstract"), F.lit(2).alias("seq"),
    )
    return web.unionByName(items)


E1_SQL = with_views("page_log", f"""
    WITH {PAGE_CHANGES_SQL}
    SELECT namespace, page_id, title, chunk_name, url, CAST(extracted_at AS VARCHAR) AS extracted_at, abstract
    FROM page_log ANTI JOIN latest USING (namespace, page_id)
    UNION ALL
    SELECT namespace, page_id, title, chunk_name, url, '{AS_OF}', abstract FROM latest""")


@query("e1_upsert_pages", E1_SQL)
def e1(spark, sf):
    merged = updates.upsert_pages(fx.page_log(spark, sf), page_changes(spark, sf), F.lit(AS_OF), ["seq"])
    return _text(merged, "extracted_at")


@query("e1_upsert_in_parts", E1_SQL)
def e1_parts(spark, sf):
    """The same into a table in parts, of which the changes rewrite only those they touch."""
    pages = PartedTable(spark, new_folder(spark, "page-parts"), PAGE_LOG, PAGE_KEY, parts=16)
    pages.replace(fx.page_log(spark, sf))
    latest = updates.last_per_key(page_changes(spark, sf), PAGE_KEY, ["seq"])
    pages.upsert(latest.withColumn("extracted_at", F.lit(AS_OF).cast("timestamp")))
    return _text(pages.read(), "extracted_at")



@query("e2_upsert_chunks", with_views("page_log page_vector chunk_log", f"""
    WITH listing AS (SELECT DISTINCT namespace, chunk_name FROM page_log SEMI JOIN page_vector USING (namespace, page_id)
                     UNION SELECT '{EN}', 'chat_' || role FROM conversations)
    SELECT coalesce(c.namespace, l.namespace) AS namespace, coalesce(c.chunk_name, l.chunk_name) AS chunk_name,
           chunk_archive_path, chunk_extracted_path,
           CASE WHEN l.namespace IS NULL THEN CAST(downloaded_at AS VARCHAR) END AS downloaded_at,
           CASE WHEN l.namespace IS NULL THEN CAST(unpacked_at AS VARCHAR) END AS unpacked_at
    FROM chunk_log c FULL JOIN listing l ON c.namespace = l.namespace AND c.chunk_name = l.chunk_name"""))
def e2(spark, sf):
    with_vector = fx.page_log(spark, sf).join(
        fx.page_vector(spark, sf).select("namespace", "page_id"), ["namespace", "page_id"], "left_semi"
    )
    chats = table(spark, sf, "conversations").select(
        F.lit(EN).alias("namespace"), F.concat(F.lit("chat_"), F.col("role")).alias("chunk_name")
    )
    listing = with_vector.select("namespace", "chunk_name").unionByName(chats)
    return _text(updates.upsert_chunks(fx.chunk_log(spark, sf), listing), "downloaded_at", "unpacked_at")


@query("e3_upsert_embeddings", with_views("page_vector", f"""
    WITH changes AS (SELECT '{EN}' AS namespace, vec_id AS page_id, list_reverse(embedding) AS new_vector FROM embeddings)
    SELECT coalesce(v.namespace, c.namespace) AS namespace, coalesce(v.page_id, c.page_id) AS page_id,
           round(CAST(coalesce(new_vector, embedding_vector)[1] AS DOUBLE), 6) AS first_value,
           cluster_node_id, cluster_id
    FROM page_vector v FULL JOIN changes c ON v.namespace = c.namespace AND v.page_id = c.page_id"""))
def e3(spark, sf):
    changes = table(spark, sf, "embeddings").select(
        F.lit(EN).alias("namespace"), F.col("vec_id").alias("page_id"), F.reverse("embedding").alias("embedding_vector")
    )
    merged = updates.upsert_embeddings(fx.page_vector(spark, sf), changes)
    return merged.select(
        "namespace", "page_id", _number("embedding_vector", 0).alias("first_value"), "cluster_node_id", "cluster_id"
    )


@query("e3_repeated_keys", with_views("page_vector", f"""
    WITH changes AS (SELECT '{EN}' AS namespace, vec_id // 2 AS page_id, embedding AS new_vector FROM embeddings
                     QUALIFY row_number() OVER (PARTITION BY vec_id // 2 ORDER BY vec_id DESC) = 1)
    SELECT coalesce(v.namespace, c.namespace) AS namespace, coalesce(v.page_id, c.page_id) AS page_id,
           round(CAST(coalesce(new_vector, embedding_vector)[1] AS DOUBLE), 6) AS first_value
    FROM page_vector v FULL JOIN changes c ON v.namespace = c.namespace AND v.page_id = c.page_id"""))
def e3_repeated(spark, sf):
    """Two embeddings arrive for each page; the later one counts."""
    changes = table(spark, sf, "embeddings").select(
        F.lit(EN).alias("namespace"), F.expr("vec_id div 2").alias("page_id"), F.col("embedding").alias("embedding_vector"), "vec_id"
    )
    merged = updates.upsert_embeddings(fx.page_vector(spark, sf), changes, ["vec_id"])
    return merged.select("namespace", "page_id", _number("embedding_vector", 0).alias("first_value"))


@query("e9_repeated_keys", with_views("page_vector", """
    SELECT v.namespace, v.page_id, coalesce(c.node, v.cluster_node_id) AS cluster_node_id
    FROM page_vector v LEFT JOIN (SELECT lang || 'wiki_namespace_0' AS namespace, doc_id AS page_id, 900 + 2 AS node FROM documents) c
      ON v.namespace = c.namespace AND v.page_id = c.page_id"""))
def e9_repeated(spark, sf):
    vectors = fx.page_vector(spark, sf)
    pages = table(spark, sf, "documents").select(F.concat("lang", F.lit("wiki_namespace_0")).alias("namespace"), F.col("doc_id").alias("page_id"))
    changes = pages.select("*", F.explode(F.expr("array(901L, 902L)")).alias("cluster_node_id"))
    return updates.assign_leaves(vectors, changes).select("namespace", "page_id", "cluster_node_id")


@query("e4_set_reduced_vectors", with_views("page_vector", f"""
    WITH changes AS (SELECT '{EN}' AS namespace, vec_id AS page_id, embedding[9:16] AS new_vector FROM embeddings)
    SELECT v.namespace, v.page_id,
           round(CAST((CASE WHEN c.page_id IS NULL THEN reduced_vector ELSE new_vector END)[1] AS DOUBLE), 6) AS first_value
    FROM page_vector v LEFT JOIN changes c ON v.namespace = c.namespace AND v.page_id = c.page_id"""))
def e4(spark, sf):
    changes = table(spark, sf, "embeddings").select(
        F.lit(EN).alias("namespace"), F.col("vec_id").alias("page_id"), F.slice("embedding", 9, 8).alias("reduced_vector")
    )
    merged = updates.set_reduced_vectors(fx.page_vector(spark, sf), changes)
    return merged.select("namespace", "page_id", _number("reduced_vector", 0).alias("first_value"))


@query("e5_set_three_d_vectors", with_views("page_vector", f"""
    WITH changes AS (SELECT '{EN}' AS namespace, vec_id AS page_id, embedding[62:64] AS new_vector FROM embeddings)
    SELECT v.namespace, v.page_id,
           round(CAST((CASE WHEN c.page_id IS NULL THEN three_d_vector ELSE new_vector END)[3] AS DOUBLE), 6) AS z
    FROM page_vector v LEFT JOIN changes c ON v.namespace = c.namespace AND v.page_id = c.page_id"""))
def e5(spark, sf):
    changes = table(spark, sf, "embeddings").select(
        F.lit(EN).alias("namespace"), F.col("vec_id").alias("page_id"), F.slice("embedding", 62, 3).alias("three_d_vector")
    )
    merged = updates.set_three_d_vectors(fx.page_vector(spark, sf), changes)
    return merged.select("namespace", "page_id", _number("three_d_vector", 2).alias("z"))


@query("e6_insert_nodes", with_views("cluster_tree", """
    SELECT namespace, node_id, parent_id, depth, doc_count, first_label FROM cluster_tree
    UNION ALL
    SELECT lang || 'wiki_copy', min(doc_id) + 1000000, NULL, CAST(0 AS SMALLINT), CAST(count(*) AS INT), NULL
    FROM documents GROUP BY lang"""))
def e6(spark, sf):
    added = table(spark, sf, "documents").groupBy("lang").agg(
        (F.min("doc_id") + 1000000).alias("node_id"), F.count(F.lit(1)).cast("int").alias("doc_count")
    ).select(
        F.concat("lang", F.lit("wiki_copy")).alias("namespace"), "node_id", F.lit(0).cast("short").alias("depth"), "doc_count"
    )
    merged = updates.insert_nodes(fx.cluster_tree(spark, sf), added)
    return merged.select("namespace", "node_id", "parent_id", "depth", "doc_count", "first_label")


@query("e7_child_counts", with_views("cluster_tree", """
    SELECT n.namespace, n.node_id, CAST(count(c.node_id) AS INT) AS child_count
    FROM cluster_tree n LEFT JOIN cluster_tree c ON n.namespace = c.namespace AND c.parent_id = n.node_id
    GROUP BY n.namespace, n.node_id"""))
def e7(spark, sf):
    blank = fx.cluster_tree(spark, sf).withColumn("child_count", F.lit(0))
    return updates.with_child_counts(blank).select("namespace", "node_id", "child_count")


@query("e8_set_labels", with_views("cluster_tree", """
    WITH labels AS (SELECT namespace, node_id, CASE WHEN doc_count > 4 THEN 'label ' || CAST(node_id AS VARCHAR) END AS label
                    FROM cluster_tree WHERE depth = 2)
    SELECT t.namespace, t.node_id, CASE WHEN l.node_id IS NULL THEN first_label ELSE label END AS first_label,
           final_label
    FROM cluster_tree t LEFT JOIN labels l ON t.namespace = l.namespace AND t.node_id = l.node_id"""))
def e8(spark, sf):
    nodes = fx.cluster_tree(spark, sf)
    label = F.concat(F.lit("label "), F.col("node_id").cast("string"))
    labels = nodes.filter("depth = 2").select(
        "namespace", "node_id", F.when(F.col("doc_count") > 4, label).alias("first_label")
    )
    return updates.set_labels(nodes, labels, ["first_label"]).select("namespace", "node_id", "first_label", "final_label")


@query("e9_assign_leaves", with_views("page_vector placed", """
    SELECT v.namespace, v.page_id, coalesce(500 + p.label, v.cluster_node_id) AS cluster_node_id
    FROM page_vector v LEFT JOIN placed p ON v.namespace = p.namespace AND v.page_id = p.page_id
         AND v.cluster_id IS NOT NULL"""))
def e9(spark, sf):
    vectors = fx.page_vector(spark, sf)
    assigned = vectors.filter(F.col("cluster_id").isNotNull()).select(
        "namespace", "page_id", (F.col("cluster_id") + 500).alias("cluster_node_id")
    )
    return updates.assign_leaves(vectors, assigned).select("namespace", "page_id", "cluster_node_id")


@query("e10_delete_tree", with_views("cluster_tree page_vector", f"""
    SELECT 'node' AS kind, namespace, node_id AS id, parent_id AS ref FROM cluster_tree WHERE namespace <> '{EN}'
    UNION ALL
    SELECT 'page', namespace, page_id, CASE WHEN namespace <> '{EN}' THEN cluster_node_id END FROM page_vector"""))
def e10(spark, sf):
    nodes, vectors = updates.delete_tree(fx.cluster_tree(spark, sf), fx.page_vector(spark, sf), EN)
    return nodes.select(F.lit("node").alias("kind"), "namespace", F.col("node_id").alias("id"), F.col("parent_id").alias("ref")).unionByName(
        vectors.select(F.lit("page").alias("kind"), "namespace", F.col("page_id").alias("id"), F.col("cluster_node_id").alias("ref"))
    )


@query("e11_clear_labels", with_views("cluster_tree", f"""
    SELECT namespace, node_id, CASE WHEN namespace <> '{EN}' THEN first_label END AS first_label,
           CASE WHEN namespace <> '{EN}' THEN final_label END AS final_label FROM cluster_tree"""))
def e11(spark, sf):
    return updates.clear_labels(fx.cluster_tree(spark, sf), EN).select("namespace", "node_id", "first_label", "final_label")


@query("e12_mark_downloaded", with_views("chunk_log", f"""
    SELECT namespace, chunk_name,
           CASE WHEN downloaded_at IS NULL THEN 'landed/' || chunk_name ELSE chunk_archive_path END AS chunk_archive_path,
           chunk_extracted_path,
           CASE WHEN downloaded_at IS NULL THEN '{AS_OF}' ELSE CAST(downloaded_at AS VARCHAR) END AS downloaded_at,
           CAST(unpacked_at AS VARCHAR) AS unpacked_at FROM chunk_log"""))
def e12_downloaded(spark, sf):
    chunks = fx.chunk_log(spark, sf)
    done = chunks.filter(F.col("downloaded_at").isNull()).select(
        "namespace", "chunk_name", F.concat(F.lit("landed/"), "chunk_name").alias("chunk_archive_path")
    )
    return _text(updates.mark_downloaded(chunks, done, F.lit(AS_OF)), "downloaded_at", "unpacked_at")


@query("e12_mark_unpacked", with_views("chunk_log", f"""
    SELECT namespace, chunk_name, chunk_archive_path,
           CASE WHEN unpacked_at IS NULL THEN 'parsed/' || chunk_name ELSE chunk_extracted_path END AS chunk_extracted_path,
           CAST(downloaded_at AS VARCHAR) AS downloaded_at,
           CASE WHEN unpacked_at IS NULL THEN '{AS_OF}' ELSE CAST(unpacked_at AS VARCHAR) END AS unpacked_at
    FROM chunk_log"""))
def e12_unpacked(spark, sf):
    chunks = fx.chunk_log(spark, sf)
    done = chunks.filter(F.col("unpacked_at").isNull()).select(
        "namespace", "chunk_name", F.concat(F.lit("parsed/"), "chunk_name").alias("chunk_extracted_path")
    )
    return _text(updates.mark_unpacked(chunks, done, F.lit(AS_OF)), "downloaded_at", "unpacked_at")
