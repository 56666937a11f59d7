import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmap.functions import grouped, kmeans
from corpusmap.operators import clustering, embedding, layout, neighbours, pca, projection, tree
from corpusmap.session import cut_lineage

SCHEMA = "namespace string, page_id bigint, reduced_vector array<float>"


def blobs(n, d=6, centres=8, seed=0, spread=0.15):
    rng = np.random.default_rng(seed)
    points = rng.standard_normal((centres, d)) * 3
    return (points[rng.integers(centres, size=n)] + spread * rng.standard_normal((n, d))).astype(np.float32)


def frame(spark, x, namespace="n", column="reduced_vector", start=0):
    rows = [(namespace, start + i, v.tolist()) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, SCHEMA.replace("reduced_vector", column))


# ------------------------------------------------------------ embedding
def test_embedding_halves_and_reports(spark):
    def embedder(texts):
        if any("bad" in t for t in texts):
            raise RuntimeError("model is down")
        if any(len(t) > 10 for t in texts):
            raise RuntimeError("error 500: input is too large to process")
        return [[float(len(t)), 1.0] for t in texts]

    rows = [("n", 1, "short", None), ("n", 2, "x" * 35, None), ("n", 3, "bad", "y"), ("n", 4, "ab", "cd")]
    pages = spark.createDataFrame(rows, "namespace string, page_id bigint, title string, abstract string").coalesce(1)
    got = {r["page_id"]: r for r in embedding.embed_pages(pages, embedder).collect()}
    assert got[1]["embedding_vector"] == [5.0, 1.0]
    assert got[2]["embedding_vector"] == [8.0, 1.0]
    assert got[3]["embedding_vector"] is None and got[3]["error"] == "model is down"
    assert got[4]["embedding_vector"] == [5.0, 1.0]

    def hopeless(texts):
        raise RuntimeError(embedding.TOO_LARGE)

    assert embedding.embed_one("abc", hopeless) == (None, "nothing left of the text after halving")


# ------------------------------------------------------------ PCA
@pytest.mark.parametrize("batch_size", [150, 10_000])
def test_pca_of_the_stored_width(spark, batch_size):
    x = np.random.default_rng(1).random((150, 2048), np.float32)
    reduced = pca.reduce_vectors(frame(spark, x, column="embedding_vector"), 100, batch_size).collect()
    assert len(reduced) == 150 and all(len(r["reduced_vector"]) == 100 for r in reduced)


@pytest.mark.parametrize("batch_size", [50, 10])
def test_pca_refuses_a_batch_below_the_target(spark, batch_size):
    with pytest.raises(ValueError, match="batch_size"):
        pca.reduce_vectors(frame(spark, blobs(20), column="embedding_vector"), 100, batch_size)


def test_pca_against_numpy_in_skewed_groups(spark):
    big, small, tiny = blobs(900, 10, seed=1), blobs(60, 10, seed=2), blobs(3, 10, seed=3)
    df = frame(spark, big, "big", "embedding_vector").unionByName(
        frame(spark, small, "small", "embedding_vector")
    ).unionByName(frame(spark, tiny, "tiny", "embedding_vector")).repartition(11)
    got = pca.reduce_vectors(df, 4, strict=False).collect()
    assert {r["namespace"] for r in got} == {"big", "small"}
    for name, x in (("big", big), ("small", small)):
        mine = np.array([r["reduced_vector"] for r in sorted(got, key=lambda r: r["page_id"]) if r["namespace"] == name])
        centred = x.astype(np.float64) - x.mean(0, dtype=np.float64)
        _, _, axes = np.linalg.svd(centred, full_matrices=False)
        assert np.allclose(np.abs(mine), np.abs(centred @ axes[:4].T), atol=1e-4)
    with pytest.raises(ValueError, match="tiny"):
        pca.reduce_vectors(df, 4)
    with pytest.raises(Exception, match="cannot reduce 10 dimensions"):
        pca.reduce_vectors(df, 20, strict=False).collect()


def test_moments_of_two_parts_are_those_of_the_whole(spark):
    x = np.random.default_rng(3).random((400, 12), np.float32) + 5
    whole = frame(spark, x, column="embedding_vector").repartition(5)
    early, late = (pca.moment_sums(whole.filter(c), "namespace", "embedding_vector") for c in ("page_id < 250", "page_id >= 250"))
    one = pca.fit(whole, "namespace", "embedding_vector", 4).first()
    two = pca.fit_moments(pca.merged_moments(early, late, "namespace"), "namespace", 4).first()
    assert one["n"] == two["n"] == 400
    assert np.allclose(one["values"], two["values"], atol=1e-9) and np.allclose(one["explained"], two["explained"], atol=1e-9)


# ------------------------------------------------------------ silhouette, k-means
def brute_silhouette(x, labels):
    unit = kmeans.unit_rows(x.astype(np.float64))
    d = 1 - unit @ unit.T
    np.fill_diagonal(d, 0)
    scores = []
    for i, own in enumerate(labels):
        mates = labels == own
        if mates.sum() == 1:
            scores.append(0.0)
            continue
        a = d[i, mates].sum() / (mates.sum() - 1)
        b = min(d[i, labels == c].mean() for c in set(labels.tolist()) - {own})
        scores.append((b - a) / max(a, b))
    return float(np.mean(scores))


def test_silhouette_against_its_definition(spark):
    x = blobs(120, spread=1.0)
    x[5] = 0.0
    labels = np.random.default_rng(0).integers(0, 4, 120)
    labels[7] = 5
    expected = brute_silhouette(x, labels)
    assert kmeans.mean_silhouette(x.astype(np.float64), labels, 6) == pytest.approx(expected, abs=1e-12)
    rows = [("g", v.tolist(), int(c)) for v, c in zip(x, labels)] + [("one", [1.0] * 6, 0), ("one", [2.0] * 6, 0)]
    df = spark.createDataFrame(rows, "g string, x array<float>, c int").repartition(5)
    got = {r["g"]: r for r in clustering.cosine_silhouette(df, "g", "x", "c", 6, 6).collect()}
    assert got["g"]["silhouette"] == pytest.approx(expected, abs=1e-9) and got["g"]["clusters"] == 5
    assert got["one"]["silhouette"] is None


@pytest.mark.parametrize("part_rows", [4096, 7])
def test_tables_beyond_the_broadcast_bound_go_to_the_rows(spark, monkeypatch, part_rows):
    monkeypatch.setattr(grouped, "ROUND_BYTES", 2000)
    monkeypatch.setattr(grouped, "PART_ROWS", part_rows)
    monkeypatch.setattr(grouped, "_scan", None)  # nothing is broadcast
    df = spark.createDataFrame([(f"g{i % 20}", i, [float(i), 1.0]) for i in range(400)], "g string, page_id int, x array<float>")
    centres = spark.createDataFrame([(f"g{i}", [[0.0, 0.0], [200.0, 0.0]]) for i in range(19)], "g string, values array<array<double>>")
    got = clustering.assign(df, "g", "x", centres, 400).collect()
    assert len(got) == 380
    assert all(r["cluster"] == int(r["page_id"] > 100) for r in got if r["page_id"] != 100)


# ------------------------------------------------------------ tree
def check_tree(nodes, assigned, docs, settings):
    """What every tree obeys; returns the leaves' sizes."""
    by_id = {r["node_id"]: r for r in nodes}
    kids = {}
    for r in nodes:
        if r["parent_id"] is not None:
            kids.setdefault(r["parent_id"], []).append(r)
            assert r["depth"] == by_id[r["parent_id"]]["depth"] + 1
    pages = {}
    for r in assigned:
        pages.setdefault(r["cluster_node_id"], set()).add(r["page_id"])
    assert sum(len(p) for p in pages.values()) in (docs, 0)
    for r in nodes:
        below = sorted(kids.get(r["node_id"], []), key=lambda c: c["node_id"])
        assert r["child_count"] == len(below) <= settings.max_k
        assert r["depth"] <= settings.max_depth
        if below:
            assert r["doc_count"] == sum(c["doc_count"] for c in below) > settings.leaf_target
            assert below[0]["node_id"] == r["node_id"] + 1 and len(r["centroid"]) == 6
        else:
            assert r["centroid"] is None
            if r["parent_id"] is not None:
                assert len(pages[r["node_id"]]) == r["doc_count"]
                assert r["sample_doc_ids"] == sorted(pages[r["node_id"]])[:10]
        assert (r["sample_doc_ids"] is None) == (r["parent_id"] is None)
    return [r["doc_count"] for r in nodes if r["child_count"] == 0]


@pytest.mark.parametrize("big_node_docs", [10_000, 60])
def test_tree_in_one_task_and_by_jobs(spark, big_node_docs):
    settings = tree.TreeSettings(leaf_target=12, max_k=6, max_depth=5, min_silhouette=0.0, big_node_docs=big_node_docs)
    nodes, assigned = tree.build_trees(frame(spark, blobs(700)).repartition(9), settings=settings)
    sizes = check_tree(nodes.collect(), assigned.collect(), 700, settings)
    assert len(sizes) > 10 and sum(sizes) == 700


def test_tree_does_not_depend_on_who_splits_its_nodes(spark):
    df, results = frame(spark, blobs(600)), []
    for big_node_docs in (10_000, 200, 40):
        settings = tree.TreeSettings(leaf_target=15, max_k=5, min_silhouette=0.0, big_node_docs=big_node_docs)
        nodes, assigned = tree.build_trees(df, settings=settings)
        results.append((
            sorted((r["node_id"], r["parent_id"], r["doc_count"]) for r in nodes.collect()),
            sorted((r["page_id"], r["cluster_node_id"]) for r in assigned.collect()),
        ))
    assert results[0] == results[1] == results[2]


def test_tree_does_not_depend_on_the_partitioning(spark):
    settings = tree.TreeSettings(leaf_target=15, max_k=5, min_silhouette=0.0, big_node_docs=150)
    df = frame(spark, blobs(400))
    results = []
    for parts in (2, 7):
        _, assigned = tree.build_trees(df.repartition(parts), settings=settings)
        results.append(sorted((r["page_id"], r["cluster_node_id"]) for r in assigned.collect()))
    assert results[0] == results[1]


@pytest.mark.parametrize("big_node_docs", [10_000, 50])
def test_copies_of_one_vector_end_in_one_leaf(spark, big_node_docs):
    x = blobs(300)
    x[::3] = x[0]
    settings = tree.TreeSettings(leaf_target=10, max_k=4, max_depth=6, min_silhouette=0.0, big_node_docs=big_node_docs)
    nodes, assigned = tree.build_trees(frame(spark, x), settings=settings)
    placed = {r["page_id"]: r["cluster_node_id"] for r in assigned.collect()}
    assert len(placed) == 300 and len({placed[i] for i in range(0, 300, 3)}) == 1
    check_tree(nodes.collect(), assigned.collect(), 300, settings)


@pytest.mark.parametrize("big_node_docs", [10_000, 50])
def test_depth_and_silhouette_bars(spark, big_node_docs):
    df = frame(spark, blobs(200))
    shallow = tree.TreeSettings(leaf_target=5, max_k=4, max_depth=1, min_silhouette=0.0, big_node_docs=big_node_docs)
    nodes, assigned = tree.build_trees(df, settings=shallow)
    assert {r["depth"] for r in nodes.collect()} == {0, 1}
    check_tree(nodes.collect(), assigned.collect(), 200, shallow)
    barred = tree.TreeSettings(leaf_target=5, max_k=4, min_silhouette=1.0, big_node_docs=big_node_docs)
    nodes, assigned = tree.build_trees(df, settings=barred)
    assert [(r["depth"], r["doc_count"], r["child_count"]) for r in nodes.collect()] == [(0, 200, 0)]
    assert assigned.isEmpty()


def test_small_namespaces_have_no_tree_and_ids_go_on(spark):
    df = frame(spark, blobs(60), "b").unionByName(frame(spark, blobs(9), "tiny")).unionByName(frame(spark, blobs(80, seed=4), "a"))
    settings = tree.TreeSettings(leaf_target=10, max_k=10, min_silhouette=0.0)
    before = spark.createDataFrame([("old", 41)], "namespace string, node_id bigint")
    nodes, _ = tree.build_trees(df, before, settings)
    got = sorted((r["node_id"], r["namespace"], r["depth"]) for r in nodes.collect())
    assert got[0] == (42, "a", 0) and {g[1] for g in got} == {"a", "b"}
    assert [g[0] for g in got] == list(range(42, 42 + len(got)))
    assert [g[1] for g in got] == sorted(g[1] for g in got)


def test_rebuild_leaves_no_orphans(spark):
    vectors = frame(spark, blobs(120)).withColumn("cluster_node_id", F.lit(5).cast("bigint"))
    nodes = spark.createDataFrame([("n", 5, None), ("other", 9, None)], "namespace string, node_id bigint, parent_id bigint")
    settings = tree.TreeSettings(leaf_target=10, max_k=5, min_silhouette=0.0)
    tree_rows, placed = tree.rebuild(vectors, nodes, settings, "n")
    ids = {r["node_id"] for r in tree_rows.filter("namespace = 'n'").collect()}
    assert 5 not in ids and {r["cluster_node_id"] for r in placed.collect()} <= ids
    barred, unplaced = tree.rebuild(vectors, nodes, tree.TreeSettings(max_k=5, leaf_target=5, min_silhouette=1.0), "n")
    assert unplaced.filter("cluster_node_id is not null").isEmpty() and barred.count() == 2


@pytest.mark.parametrize("bad", [
    {"leaf_target": 0}, {"max_k": 0}, {"max_depth": 0}, {"min_silhouette": -0.1},
])
def test_settings(bad):
    with pytest.raises(ValueError):
        tree.TreeSettings(**bad)


# ------------------------------------------------------------ projection
@pytest.mark.parametrize("block_rows", [1000, 40])
def test_neighbours_against_brute_force(spark, block_rows):
    x = blobs(150, spread=1.0)
    x[100:] = x[100]  # a third of the cluster are copies
    x[20:40] = 0.0
    rows = [("n", i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "g string, page_id bigint, x array<float>").repartition(6)
    got = projection.cluster_neighbours(df, ["g"], "x", k=7, block_rows=block_rows).collect()
    unit = kmeans.unit_rows(x.astype(np.float64))
    d = np.abs(np.round(1 - unit @ unit.T, 12))
    d[20:40, 20:40] = 0.0
    np.fill_diagonal(d, np.inf)
    for i in range(150):
        mine = sorted((r["rank"], r["neighbour_id"], r["distance"]) for r in got if r["page_id"] == i)
        nearest = np.lexsort((np.arange(150), d[i]))[:7]
        assert [m[0] for m in mine] == list(range(1, 8))
        assert [m[1] for m in mine] == nearest.tolist()
        assert np.allclose([m[2] for m in mine], d[i, nearest], atol=1e-9)
    assert all(r["page_id"] != r["neighbour_id"] for r in got)


@pytest.mark.parametrize("method", projection.METHODS)
def test_projection_covers_every_page(spark, method):
    x = blobs(260)
    cluster = np.where(np.arange(260) % 3 == 0, 0, np.arange(260) % 40 + 1)
    rows = [("n", i, v.tolist(), int(c), None) for i, (v, c) in enumerate(zip(x, cluster))]
    df = spark.createDataFrame(
        rows, "namespace string, page_id bigint, reduced_vector array<float>, cluster_node_id bigint, three_d_vector array<float>"
    )
    got = {r["page_id"]: r["three_d_vector"] for r in projection.project_clusters(df, method, max_group_docs=50).collect()}
    assert set(got) == set(range(260)) and all(len(v) == 3 and np.isfinite(v).all() for v in got.values())
    with pytest.raises(ValueError):
        projection.project_clusters(df, "umap")


def test_large_and_small_clusters_project_alike(spark):
    rows = [("n", i, v.tolist(), 1, None) for i, v in enumerate(blobs(90))]
    df = spark.createDataFrame(
        rows, "namespace string, page_id bigint, reduced_vector array<float>, cluster_node_id bigint, three_d_vector array<float>"
    )
    one_task = sorted(map(tuple, projection.project_clusters(df, max_group_docs=100).collect()))
    by_scan = sorted(map(tuple, projection.project_clusters(df, max_group_docs=10).collect()))
    assert np.allclose([r[2] for r in one_task], [r[2] for r in by_scan], atol=1e-4)


def test_large_clusters_are_laid_out_by_neighbours_as_small_ones_are(spark):
    x = np.concatenate([blobs(300, centres=5, spread=1.2), blobs(200, centres=4, seed=3, spread=1.2)])
    rows = [("n" if i < 300 else "m", i, v.tolist(), 1, None) for i, v in enumerate(x)]
    df = spark.createDataFrame(
        rows, "namespace string, page_id bigint, reduced_vector array<float>, cluster_node_id bigint, three_d_vector array<float>"
    )
    one_task = {r.page_id: r.three_d_vector for r in projection.project_clusters(df, "neighbour").collect()}
    spread = {r.page_id: r.three_d_vector for r in projection.project_clusters(df, "neighbour", max_group_docs=60).collect()}
    assert set(one_task) == set(spread) == set(range(500))
    for ids in (range(300), range(300, 500)):
        a, b = np.array([one_task[i] for i in ids]), np.array([spread[i] for i in ids])
        assert np.abs(a - b * np.sign((a * b).sum(0))).max() < 1e-3
        assert np.allclose(b.T @ b / len(b), np.eye(3), atol=1e-4)


def test_layouts_in_a_task_and_over_the_edge_table_agree(spark, monkeypatch):
    x = blobs(220, centres=4, spread=1.2)
    df = spark.createDataFrame([("n", i, v.tolist()) for i, v in enumerate(x)], "node string, page_id bigint, x array<float>")
    near = cut_lineage(neighbours.cluster_neighbours(df, ["node"], "x", k=12, block_rows=60), "near")
    seen = []
    whole = layout.spectral_columns
    monkeypatch.setattr(layout, "spectral_columns", lambda *given: seen.append(1) or whole(*given))
    placed = []
    for most in (220, 219):  # the second is beyond what a task may hold
        monkeypatch.setattr(layout, "TASK_PAGES", most)
        rows = layout.neighbour_coordinates(df, near, "x", 3).collect()
        placed.append(np.array([v for _, v in sorted((r.page_id, r.three_d_vector) for r in rows)]))
        assert len(seen) == len(placed) - 1
    assert np.abs(placed[0] - placed[1]).max() < 1e-3


def test_search_by_pivots_compares_few_pairs(spark):
    x = blobs(4000, 8, centres=40, spread=0.05)
    rows = [("n", i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "g string, page_id bigint, x array<float>").repartition(6)
    got = neighbours.pairs_compared(df, ["g"], "x", k=10, block_rows=100).collect()
    assert [r.pages for r in got] == [4000] and got[0].compared < 4000 * 4000 / 5
    found = {(r.page_id, r["rank"]): r.neighbour_id for r in neighbours.cluster_neighbours(df, ["g"], "x", 10, 100).filter("page_id < 40").collect()}
    unit = kmeans.unit_rows(x.astype(np.float64))
    for i in range(40):
        gap = np.round(1 - unit[i] @ unit.T, 12)
        gap[i] = np.inf
        assert [found[i, k] for k in range(1, 11)] == np.lexsort((np.arange(4000), gap))[:10].tolist()


def test_blocks_grow_with_their_cluster(spark):
    """Of small blocks a cluster has a bounded number, so that a page is not sent to one block for every few pages."""
    rows = [("n", i, v.tolist()) for i, v in enumerate(blobs(3000, 8, spread=1.0))]
    df = spark.createDataFrame(rows, "node string, page_id bigint, x array<float>")
    placed, _, made, _ = neighbours._blocks(df, "x", 20)
    assert made.count() <= 2 * neighbours.BLOCKS and placed.count() == 3000
    assert made.agg(F.sum("n")).first()[0] == 3000


def test_interleaved_groups_are_ranged_first(spark, monkeypatch):
    """Many small groups in every task, and one with a third of the rows: sums must still be right."""
    x = blobs(1200, 5, seed=9)
    rows = [("hot" if i % 3 == 0 else f"g{i % 40}", i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "namespace string, page_id bigint, x array<float>").repartition(8)
    for held in (pca.HELD_BYTES, 500):
        monkeypatch.setattr(pca, "HELD_BYTES", held)
        got = {(r["namespace"], r["i"], r["j"]): r for r in pca.covariances(df, "namespace", "x").collect()}
        for name in ("hot", "g1"):
            mine = np.array([r[2] for r in rows if r[0] == name])
            expected = np.cov(mine.T)
            assert got[name, 0, 0]["n"] == len(mine)
            assert np.allclose([[got[name, i, j]["covariance"] for j in range(5)] for i in range(5)], expected, atol=1e-5)


@pytest.mark.parametrize("big_node_docs", [10_000, 100])
def test_nodes_with_more_rows_than_their_batches(spark, monkeypatch, big_node_docs):
    """Centres come from the drawn rows and one pass over all; who does the work does not matter."""
    monkeypatch.setattr(kmeans, "BATCH_DOCS", 40)
    monkeypatch.setattr(kmeans, "BATCHES", 3)
    x = blobs(600)
    settings = tree.TreeSettings(leaf_target=30, max_k=5, min_silhouette=0.0, big_node_docs=big_node_docs)
    nodes, assigned = tree.build_trees(frame(spark, x), settings=settings)
    check_tree(nodes.collect(), assigned.collect(), 600, settings)
    ids = np.arange(600)
    centres, labels = kmeans.fit(ids, x.astype(np.float64), 5, 50, 42, "n/")
    rows = frame(spark, x).withColumn("node", F.lit("n/"))
    sizes = spark.createDataFrame([("n/", 600, 5)], "node string, n bigint, k int")
    got = np.array(clustering.train(rows, sizes, "node", "reduced_vector", 5, 6).first()["values"])
    assert np.array_equal(got, centres)
    assert len(kmeans.batch_rows(ids, 42, "n/")) == 120


def test_training_keeps_the_centre_of_an_emptied_cluster(spark, monkeypatch):
    """A start centre no row is nearest to stays where it is."""
    start = [[0.0, 0.0], [10.0, 10.0], [500.0, 500.0]]
    monkeypatch.setattr(clustering, "starting_centres", lambda *a, **k: spark.createDataFrame(
        [("g", start)], "node string, values array<array<double>>"))
    rows = spark.createDataFrame(
        [("g", i, [float(i % 2 * 10 + 1), float(i % 2 * 10)]) for i in range(40)], "node string, page_id bigint, x array<float>"
    )
    sizes = spark.createDataFrame([("g", 40, 3)], "node string, n bigint, k int")
    got = clustering.train(rows, sizes, "node", "x", 3, 2).first()["values"]
    assert got == [[1.0, 0.0], [11.0, 10.0], [500.0, 500.0]]


@pytest.mark.parametrize("big_node_docs", [10_000, 30])
def test_namespaces_may_differ_in_width(spark, big_node_docs):
    df = frame(spark, blobs(90, 6), "a").unionByName(frame(spark, blobs(90, 4), "b"))
    settings = tree.TreeSettings(leaf_target=15, max_k=5, max_depth=2, min_silhouette=0.0, big_node_docs=big_node_docs)
    nodes, assigned = tree.build_trees(df, settings=settings)
    widths = {(r["namespace"], len(r["centroid"])) for r in nodes.collect() if r["centroid"]}
    assert widths == {("a", 6), ("b", 4)} and assigned.count() == 180


def test_a_large_leaf_target_beats_the_task_bound(spark):
    settings = tree.TreeSettings(leaf_target=100, max_k=5, min_silhouette=0.0, big_node_docs=20)
    nodes, assigned = tree.build_trees(frame(spark, blobs(90)), settings=settings)
    assert nodes.count() == 1 and assigned.isEmpty()


def test_reduce_table_fills_the_column(spark):
    x = blobs(50)
    rows = [("n", i, v.tolist() if i < 40 else None, None) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "namespace string, page_id bigint, embedding_vector array<float>, reduced_vector array<float>")
    filled = pca.reduce_table(df, target_dim=3)
    assert filled.filter("size(reduced_vector) = 3").count() == 40 and filled.count() == 50


def test_wide_vectors_lower_the_task_bound(spark, monkeypatch):
    monkeypatch.setattr(tree, "TASK_BYTES", 60 * 6 * 8)
    sizes = []
    grow = tree._split_big_nodes
    monkeypatch.setattr(tree, "_split_big_nodes", lambda rows, big, *a: sizes.extend(r["n"] for r in big.collect()) or grow(rows, big, *a))
    settings = tree.TreeSettings(leaf_target=12, max_k=6, max_depth=5, min_silhouette=0.0)
    nodes, assigned = tree.build_trees(frame(spark, blobs(200)), settings=settings)
    check_tree(nodes.collect(), assigned.collect(), 200, settings)
    assert sizes and min(sizes) > 60
