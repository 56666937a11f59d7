"""Embedding, reduction, clustering, the tree and its projection (group F)."""

from __future__ import annotations

import numpy as np
from dataclasses import replace

from pyspark.sql import functions as F

from corpusmap import fixtures as fx
from corpusmap.fixtures import table, with_views
from corpusmap.functions.grouped import slots_to_table
from corpusmap.operators import clustering, embedding, pca, projection, tree
from corpusmap.queries.registry import query
from corpusmap.session import cut_lineage

LETTERS = "abcdefghijklmnopqrstuvwxyz"
CONTEXT = 5000


def count_letters(texts):
    """Stand-in for a model: letter counts, with a context of CONTEXT characters."""
    if any(len(t) > CONTEXT for t in texts):
        raise ValueError("400: the input is too large to process")
    return np.array([[t.count(c) for c in LETTERS] for t in texts], np.float32)


def _weighted(column):
    return F.aggregate(F.transform(column, lambda x, i: x.cast("double") * (i + 1)), F.lit(0.0), lambda a, b: a + b)


_COUNTS = " + ".join(f"{i} * (length(t) - length(replace(t, '{c}', '')))" for i, c in enumerate(LETTERS, 1))


@query("f1_embed_pages", with_views("page_log", f"""
    WITH texts AS (SELECT namespace, page_id, concat_ws(chr(10), title, abstract) AS t FROM page_log),
         cut AS (SELECT namespace, page_id, substring(t, 1, length(t) // (1 << CASE
                     {' '.join(f'WHEN length(t) // {1 << j} <= {CONTEXT} THEN {j}' for j in range(12))} END)) AS t FROM texts)
    SELECT namespace, page_id, CAST({_COUNTS} AS DOUBLE) AS weighted, CAST(NULL AS VARCHAR) AS error FROM cut"""))
def f1(spark, sf):
    rows = embedding.embed_pages(fx.page_log(spark, sf), count_letters)
    return rows.select("namespace", "page_id", _weighted("embedding_vector").alias("weighted"), "error")


@query("f1_hashed_embeddings", with_views("page_log", """
    SELECT namespace, page_id, CAST(2048 AS INT) AS dims, 1.0::DOUBLE AS norm FROM page_log"""))
def f1_hashed(spark, sf):
    rows = embedding.hashed_embeddings(fx.page_log(spark, sf))
    squares = F.aggregate("embedding_vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return rows.select(
        "namespace", "page_id", F.size("embedding_vector").alias("dims"), F.round(F.sqrt(squares), 4).alias("norm")
    )


COVARIANCE = """
    flat AS (SELECT namespace, page_id, unnest(embedding_vector)::DOUBLE AS x,
                    CAST(generate_subscripts(embedding_vector, 1) - 1 AS INT) AS i FROM page_vector)"""


F2B_SQL = with_views("page_vector", f"""
    WITH {COVARIANCE}
    SELECT a.namespace, a.i, b.i AS j, count(*) AS n, round(avg(a.x), 6) AS mean_i,
           round(covar_samp(a.x, b.x), 6) AS covariance
    FROM flat a JOIN flat b ON a.namespace = b.namespace AND a.page_id = b.page_id
    GROUP BY a.namespace, a.i, b.i""")


@query("f2b_covariances", F2B_SQL)
def f2b(spark, sf):
    rows = pca.covariances(fx.page_vector(spark, sf), "namespace", "embedding_vector")
    return rows.withColumns({"mean_i": F.round("mean_i", 6), "covariance": F.round("covariance", 6)})


@query("f2_merged_moments", F2B_SQL)
def f2_merged(spark, sf):
    """The moments of the pages with and without coordinates, gathered one after the other and added up."""
    rows = fx.page_vector(spark, sf)
    done = F.col("three_d_vector").isNotNull()
    stored = cut_lineage(pca.moment_sums(rows.filter(done), "namespace", "embedding_vector"), "moments")
    both = pca.merged_moments(stored, pca.moment_sums(rows.filter(~done), "namespace", "embedding_vector"), "namespace")
    return pca.moment_covariances(both, "namespace").withColumns({"mean_i": F.round("mean_i", 6), "covariance": F.round("covariance", 6)})


@query("f2_pca_invariants", with_views("page_vector", f"""
    WITH {COVARIANCE}, spread AS (SELECT namespace, i, var_samp(x) AS v FROM flat GROUP BY namespace, i),
         total AS (SELECT namespace, round(sum(v), 5) AS total_variance FROM spread GROUP BY namespace)
    SELECT namespace, count(*) AS n, total_variance, true AS centred, true AS uncorrelated, true AS descending,
           true AS matches_explained
    FROM page_vector JOIN total USING (namespace) GROUP BY namespace, total_variance"""))
def f2(spark, sf):
    vectors = fx.page_vector(spark, sf)
    dims = 8
    reduced = pca.reduce_vectors(vectors, target_dim=dims)
    moments = pca.covariances(reduced, "namespace", "reduced_vector")
    own = moments.filter("i = j").groupBy("namespace").agg(
        F.first("n").alias("n"), (F.max(F.abs("mean_i")) < 1e-6).alias("centred"),
        F.array_sort(F.collect_list(F.struct("i", "covariance"))).alias("v"),
    )
    cross = moments.filter("i <> j").groupBy("namespace").agg((F.max(F.abs("covariance")) < 1e-6).alias("uncorrelated"))
    fitted = pca.fit(vectors, "namespace", "embedding_vector", dims).select("namespace", "explained", "total_variance")
    joined = own.join(cross, "namespace").join(fitted, "namespace")
    variance = F.col("v.covariance")
    gaps = F.zip_with(variance, "explained", lambda a, b: F.abs(a - b))
    return joined.select(
        "namespace", "n", F.round("total_variance", 5).alias("total_variance"), "centred", "uncorrelated",
        F.forall(F.sequence(F.lit(0), F.lit(dims - 2)), lambda i: F.get(variance, i) >= F.get(variance, i + 1)).alias("descending"),
        F.forall(gaps, lambda g: g < 1e-5).alias("matches_explained"),
    )


@query("f3_split_counts", with_views("cluster_tree", """
    SELECT namespace, node_id, least(50, CAST(ceil(doc_count / 7.0) AS INT)) AS k FROM cluster_tree"""))
def f3(spark, sf):
    nodes = fx.cluster_tree(spark, sf)
    return nodes.select("namespace", "node_id", clustering.split_count(F.col("doc_count"), 7, 50).alias("k"))


FLAT = """
    flat AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings)"""


@query("f4b_nearest_centre", f"""
    WITH {FLAT}, centres AS (SELECT label AS c, i, avg(x) AS m FROM flat GROUP BY label, i),
         gaps AS (SELECT vec_id, c, sum((x - m) * (x - m)) AS gap FROM flat JOIN centres USING (i) GROUP BY vec_id, c)
    SELECT vec_id AS page_id, CAST(arg_min(c, gap) AS INT) AS cluster FROM gaps GROUP BY vec_id""")
def f4b(spark, sf):
    rows = table(spark, sf, "embeddings").select(
        F.lit("all").alias("node"), F.col("vec_id").alias("page_id"), F.col("embedding").alias("x"), "label"
    )
    dims = 64
    means = F.transform(
        F.array(*[F.avg(F.col("x")[i].cast("double")) for i in range(dims)]), lambda v: v
    )
    per_label = rows.groupBy("node", F.col("label").alias("slot")).agg(F.count(F.lit(1)).alias("n"), means.alias("mean"))
    centres = cut_lineage(slots_to_table(per_label, "node", "mean"), "centres")
    placed = clustering.assign(rows.select("node", "page_id", "x"), "node", "x", centres, 10 * dims * 8)
    return placed.select("page_id", "cluster")


@query("f4_kmeans_split", """
    SELECT count(*) AS n, true AS all_nearest, true AS all_filled, true AS tighter_than_start FROM embeddings""")
def f4(spark, sf):
    """Trains on the whole table and checks that every page sits at its nearest centre."""
    rows = table(spark, sf, "embeddings").select(
        F.lit("all").alias("node"), F.col("vec_id").alias("page_id"), F.col("embedding").alias("x")
    )
    sizes = cut_lineage(rows.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.lit(10).alias("k")), "sizes")
    start = cut_lineage(clustering.starting_centres(rows, sizes, "node", "x", 42), "start")
    centres = clustering.train(rows, sizes, "node", "x", 10, 64)

    def gaps(found, name):
        placed = clustering.assign(rows, "node", "x", found, 10 * 64 * 8).join(F.broadcast(found.select("node", "values")), "node")
        distance = F.transform("values", lambda c: F.aggregate(
            F.zip_with("x", c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda t, g: t + g))
        return placed.withColumn("d", distance).select(
            "node", "page_id", "cluster", F.get("d", F.col("cluster")).alias(name), F.array_min("d").alias("least")
        )

    before = gaps(start, "gap").groupBy("node").agg(F.sum("gap").alias("before"))
    after = gaps(centres, "gap").groupBy("node").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.col("gap") - F.col("least")).alias("excess"),
        F.count_distinct("cluster").alias("clusters"), F.sum("gap").alias("after"),
    )
    return after.join(before, "node").select(
        "n", (F.col("excess") < 1e-9).alias("all_nearest"), (F.col("clusters") == 10).alias("all_filled"),
        (F.col("after") <= F.col("before")).alias("tighter_than_start"),
    )


@query("f5_cosine_silhouette", """
    WITH pairs AS (
      SELECT a.vec_id, a.label, b.label AS other, avg(1 - list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[])) AS d
      FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id GROUP BY a.vec_id, a.label, b.label),
    scores AS (
      SELECT vec_id, min(d) FILTER (label <> other) AS b, coalesce(min(d) FILTER (label = other), 0) AS a,
             count(*) FILTER (label = other) AS mates FROM pairs GROUP BY vec_id)
    SELECT count(*) AS n, (SELECT CAST(count(DISTINCT label) AS INT) FROM embeddings) AS clusters,
           round(avg(CASE WHEN mates = 0 THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM scores""")
def f5(spark, sf):
    rows = table(spark, sf, "embeddings").select(F.lit("all").alias("node"), F.col("embedding").alias("x"), "label")
    scored = clustering.cosine_silhouette(rows, "node", "x", "label", 10, 64)
    return scored.select("n", "clusters", F.round("silhouette", 6).alias("silhouette"))


SETTINGS = tree.TreeSettings(leaf_target=8, max_k=10, max_depth=4, min_silhouette=0.0, big_node_docs=200)


def tree_tables(spark, sf, settings=SETTINGS):
    """Reduced vectors of all embedded pages, the trees over them, and the pages' leaves."""
    vectors = cut_lineage(pca.reduce_vectors(fx.page_vector(spark, sf), 8, strict=False), "reduced")
    nodes, assigned = tree.build_trees(vectors, fx.cluster_tree(spark, sf), settings)
    return vectors, cut_lineage(nodes, "tree"), cut_lineage(assigned, "assigned")


@query("f6_tree_invariants", with_views("page_vector cluster_tree", f"""
    SELECT namespace, count(*) AS root_docs, count(*) AS assigned_pages, count(*) AS leaf_docs,
           CAST(0 AS BIGINT) AS wrong_doc_sums, CAST(0 AS BIGINT) AS wrong_child_counts, CAST(0 AS BIGINT) AS wrong_depths,
           CAST(0 AS BIGINT) AS wrong_order, CAST(0 AS BIGINT) AS small_inner_nodes, CAST(0 AS BIGINT) AS wrong_centroids,
           CAST(0 AS BIGINT) AS misplaced_samples
    FROM page_vector GROUP BY namespace HAVING count(*) >= {SETTINGS.max_k}"""))
def f6(spark, sf):
    """Trees of all namespaces, big nodes split by table-wide jobs, checked for what every tree obeys."""
    _, nodes, assigned = tree_tables(spark, sf)
    key = ["namespace", "node_id"]
    kids = nodes.filter("parent_id is not null").groupBy("namespace", F.col("parent_id").alias("node_id")).agg(
        F.sum("doc_count").alias("docs_below"), F.count(F.lit(1)).alias("kids"), F.min("node_id").alias("first_kid"),
        F.min("depth").alias("kid_depth"), F.max("depth").alias("kid_depth_max"),
    )
    placed = assigned.groupBy("namespace", F.col("cluster_node_id").alias("node_id")).agg(F.count(F.lit(1)).alias("pages"))
    samples = nodes.select(*key, F.explode("sample_doc_ids").alias("page_id")).join(
        nodes.filter("child_count = 0").select(*key), key, "left_semi"
    )
    strays = samples.join(
        assigned.withColumnRenamed("cluster_node_id", "node_id"), ["namespace", "node_id", "page_id"], "left_anti"
    ).groupBy("namespace").agg(F.count(F.lit(1)).alias("misplaced_samples"))
    full = nodes.join(kids, key, "left").join(placed, key, "left")
    inner = F.col("kids").isNotNull()
    leaf_docs = F.when(~inner, F.col("doc_count")).otherwise(0)
    report = full.groupBy("namespace").agg(
        F.sum(F.when(F.col("parent_id").isNull(), F.col("doc_count"))).alias("root_docs"),
        F.sum("pages").alias("assigned_pages"),
        F.sum(leaf_docs).alias("leaf_docs"),
        F.count_if(inner & (F.col("docs_below") != F.col("doc_count")) | ~inner & (F.col("pages") != F.col("doc_count"))).alias("wrong_doc_sums"),
        F.count_if(F.col("child_count") != F.coalesce("kids", F.lit(0))).alias("wrong_child_counts"),
        F.count_if(inner & ((F.col("kid_depth") != F.col("depth") + 1) | (F.col("kid_depth_max") != F.col("depth") + 1))).alias("wrong_depths"),
        F.count_if(inner & (F.col("first_kid") != F.col("node_id") + 1)).alias("wrong_order"),
        F.count_if(inner & (F.col("doc_count") <= SETTINGS.leaf_target)).alias("small_inner_nodes"),
        F.count_if(inner != F.col("centroid").isNotNull()).alias("wrong_centroids"),
    )
    return report.join(strays, "namespace", "left").fillna(0, subset=["misplaced_samples"])


@query("f6_same_tree_either_way", with_views("page_vector", f"""
    SELECT namespace, count(*) AS pages, CAST(0 AS BIGINT) AS nodes_that_differ, CAST(0 AS BIGINT) AS pages_that_differ
    FROM page_vector GROUP BY namespace HAVING count(*) >= {SETTINGS.max_k}"""))
def f6_same(spark, sf):
    """The trees by table-wide jobs and by single tasks have the same nodes and the same pages in them."""
    vectors, *jobs = tree_tables(spark, sf, replace(SETTINGS, big_node_docs=100))
    _, *tasks = tree_tables(spark, sf, replace(SETTINGS, big_node_docs=50_000))
    shape = ["namespace", "node_id", "parent_id", "depth", "doc_count", "child_count"]
    place = ["namespace", "page_id", "cluster_node_id"]

    def differ(k, columns, name):
        a, b = jobs[k].select(*columns), tasks[k].select(*columns)
        return a.exceptAll(b).unionByName(b.exceptAll(a)).groupBy("namespace").agg(F.count(F.lit(1)).alias(name))

    pages = tasks[1].groupBy("namespace").agg(F.count(F.lit(1)).alias("pages"))
    return pages.join(differ(0, shape, "nodes_that_differ"), "namespace", "left").join(
        differ(1, place, "pages_that_differ"), "namespace", "left"
    ).fillna(0)


@query("f6_gated_tree", with_views("page_vector cluster_tree", """
    SELECT namespace, CAST(0 AS SMALLINT) AS depth, CAST(count(*) AS INT) AS doc_count, CAST(0 AS INT) AS child_count,
           (SELECT max(node_id) FROM cluster_tree) + row_number() OVER (ORDER BY namespace) AS node_id
    FROM page_vector GROUP BY namespace HAVING count(*) >= 20"""))
def f6_gated(spark, sf):
    """A silhouette bar no split reaches leaves each namespace with its root alone."""
    settings = tree.TreeSettings(leaf_target=20, max_k=20, min_silhouette=0.95, big_node_docs=100)
    _, nodes, assigned = tree_tables(spark, sf, settings)
    return nodes.select("namespace", "depth", "doc_count", "child_count", "node_id").unionByName(
        assigned.select("namespace", F.lit(0).cast("short").alias("depth"), F.lit(-1).alias("doc_count"),
                        F.lit(-1).alias("child_count"), F.col("page_id").alias("node_id"))
    )


@query("f7_inner_centroids", with_views("page_vector", """
    SELECT namespace, CAST(8 AS INT) AS dims, true AS is_mean_of_children FROM page_vector
    GROUP BY namespace HAVING count(*) >= 10"""))
def f7(spark, sf):
    """In trees of one split the root's centroid is the mean over its leaves of the mean page vector,
    each leaf counting once."""
    settings = tree.TreeSettings(leaf_target=8, max_k=10, max_depth=1, min_silhouette=0.0, max_iter=500)
    vectors, nodes, assigned = tree_tables(spark, sf, settings)
    pages = vectors.select("namespace", "page_id", "reduced_vector").join(assigned, ["namespace", "page_id"])
    means = F.array(*[F.avg(F.col("reduced_vector")[i].cast("double")) for i in range(8)])
    leaves = pages.groupBy("namespace", "cluster_node_id").agg(means.alias("m"))
    overall = leaves.groupBy("namespace").agg(F.array(*[F.avg(F.col("m")[i]) for i in range(8)]).alias("expected"))
    gaps = F.zip_with("centroid", "expected", lambda a, b: F.abs(a - b))
    return nodes.filter("centroid is not null").join(overall, "namespace").select(
        "namespace", F.size("centroid").alias("dims"), F.forall(gaps, lambda g: g < 1e-5).alias("is_mean_of_children")
    )


@query("f8_sample_doc_ids", with_views("page_vector", """
    SELECT namespace, cluster_node_id, page_id, CAST(pos AS INT) AS pos FROM (
      SELECT namespace, cluster_node_id, page_id,
             row_number() OVER (PARTITION BY namespace, cluster_node_id ORDER BY page_id) AS pos FROM page_vector)
    WHERE pos <= 10"""))
def f8(spark, sf):
    """The samples that the tree gives its nodes, here for the stored clusters."""
    rows = fx.page_vector(spark, sf).select("namespace", "page_id", F.col("cluster_node_id").cast("string").alias("path"))
    listed = tree.first_pages(rows, 1).select("namespace", F.col("path").cast("bigint").alias("cluster_node_id"), F.posexplode("sample_doc_ids").alias("pos", "page_id"))
    return listed.withColumn("pos", F.col("pos") + 1)


@query("f9_project_clusters", with_views("page_vector", """
    SELECT namespace, page_id, CAST(3 AS INT) AS dims, true AS finite FROM page_vector
    WHERE reduced_vector IS NOT NULL AND (namespace, cluster_node_id) IN (
      SELECT (namespace, cluster_node_id) FROM page_vector WHERE three_d_vector IS NULL)"""))
def f9(spark, sf):
    return _projected(projection.project_clusters(fx.page_vector(spark, sf), max_group_docs=10))


@query("f9_project_by_neighbours", with_views("page_vector", """
    SELECT namespace, page_id, CAST(3 AS INT) AS dims, true AS finite FROM page_vector
    WHERE reduced_vector IS NOT NULL AND cluster_id IS NOT NULL AND (namespace, cluster_id) IN (
      SELECT (namespace, cluster_id) FROM page_vector WHERE three_d_vector IS NULL)"""))
def f9_neighbour(spark, sf):
    return _projected(projection.project_clusters(fx.page_vector(spark, sf), method="neighbour", cluster_col="cluster_id"))


def _projected(rows):
    finite = F.forall("three_d_vector", lambda v: ~F.isnan(v) & (F.abs(v) < 1e6))
    return rows.select("namespace", "page_id", F.size("three_d_vector").alias("dims"), finite.alias("finite"))


@query("f9b_cluster_neighbours", """
    SELECT label, page_id, neighbour_id, CAST(rank AS INT) AS rank, round(distance, 6) AS distance FROM (
      SELECT a.label, a.vec_id AS page_id, b.vec_id AS neighbour_id,
             1 - list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS distance,
             row_number() OVER (PARTITION BY a.vec_id ORDER BY
               1 - list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), b.vec_id) AS rank
      FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id)
    WHERE rank <= 30""")
def f9b(spark, sf):
    rows = table(spark, sf, "embeddings").select("label", F.col("vec_id").alias("page_id"), F.col("embedding").alias("x"))
    found = projection.cluster_neighbours(rows, ["label"], "x", block_rows=20)
    return found.withColumn("distance", F.round("distance", 6))


@query("f9b_pairs_compared", """
    SELECT label, count(*) AS pages, true AS at_most_all FROM embeddings GROUP BY label""")
def f9b_pairs(spark, sf):
    """How many comparisons the search by pivots makes; these vectors have no close groups, so little is skipped."""
    rows = table(spark, sf, "embeddings").select("label", F.col("vec_id").alias("page_id"), F.col("embedding").alias("x"))
    found = projection.pairs_compared(rows, ["label"], "x", block_rows=20)
    return found.select("label", "pages", (F.col("compared") <= F.col("pages") * (F.col("pages") + 20)).alias("at_most_all"))


@query("f9_neighbour_layout", """
    SELECT label, count(*) AS pages, true AS orthogonal, true AS of_length FROM embeddings GROUP BY label""")
def f9_layout(spark, sf):
    """Clusters laid out by neighbours over the edge table: columns orthogonal, as long as the root of the pages."""
    vectors = table(spark, sf, "embeddings").select(
        F.lit("all").alias("namespace"), F.col("vec_id").alias("page_id"), F.col("label").cast("bigint").alias("cluster_node_id"),
        F.col("embedding").cast("array<float>").alias("reduced_vector"), F.lit(None).cast("array<float>").alias("three_d_vector"),
    )
    placed = projection.project_clusters(vectors, "neighbour", max_group_docs=20)
    v = [F.get("three_d_vector", F.lit(i)).cast("double") for i in range(3)]
    sums = placed.join(vectors.select("page_id", "cluster_node_id"), "page_id").groupBy("cluster_node_id").agg(
        F.count(F.lit(1)).alias("pages"), F.greatest(*[F.abs(F.sum(v[i] * v[j])) for i, j in ((0, 1), (0, 2), (1, 2))]).alias("cross"),
        F.greatest(*[F.abs(F.sum(c * c) - F.count(F.lit(1))) for c in v]).alias("off"),
    )
    near = F.col("pages") * 1e-4
    return sums.select(F.col("cluster_node_id").cast(dict(table(spark, sf, "embeddings").dtypes)["label"]).alias("label"), "pages",
                       (F.col("cross") < near).alias("orthogonal"), (F.col("off") < near).alias("of_length"))
