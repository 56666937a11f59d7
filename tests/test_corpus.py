"""The whole way from archives to a labelled tree on a small corpus."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmap import fixtures as fx
from corpusmap.operators import pca
from corpusmap.operators.tree import TreeSettings
from corpusmap.plans.corpus import Corpus
from corpusmap.queries.sources import page_lines
from corpusmap.queries.streams import pack_archives

AS_OF = "2024-06-01 00:00:00"


def letters(texts):
    return np.array([[t.lower().count(c) + 0.01 * i for i, c in enumerate("abcdefghijklmnopqrst")] for t in texts])


@pytest.fixture(scope="module")
def corpus(spark, sf_dir, tmp_path_factory):
    root = tmp_path_factory.mktemp("corpus")
    corpus = Corpus(spark, str(root / "tables"), fx.languages(spark))
    pack_archives(page_lines(spark, sf_dir), str(root / "landed"))
    found = sorted((p.parent.name, p.name[: -len(".tar.gz")], str(p)) for p in (root / "landed").rglob("*.tar.gz"))
    landed = spark.createDataFrame(found, "namespace string, chunk_name string, chunk_archive_path string")
    for namespace in {ns for ns, _, _ in found}:
        listing = landed.filter(F.col("namespace") == namespace).select(F.col("chunk_name").alias("identifier"))
        corpus.refresh(listing, namespace)
    corpus.landed(landed, AS_OF)
    return corpus


def test_steps(corpus, spark, sf_dir):
    expected = fx.page_log(spark, sf_dir)
    first = corpus.unpack(AS_OF, limit=1)
    assert first.count() == 1
    corpus.unpack(AS_OF)
    assert corpus.unpack(AS_OF).count() == 0
    columns = ["namespace", "page_id", "title", "url", "abstract"]
    assert corpus.table("page_log").select(columns).exceptAll(expected.select(columns)).isEmpty()
    total = expected.count()
    assert corpus.table("page_log").count() == total

    assert corpus.embed(letters, limit=30).isEmpty()
    assert corpus.table("page_vector").count() == 30
    corpus.embed(letters)
    assert corpus.table("page_vector").filter("embedding_vector is not null").count() == total

    with pytest.raises(ValueError):
        corpus.reduce(target_dim=100, batch_size=50)
    corpus.reduce(target_dim=6)
    # counts of letters have no clear groups; with this seed the root of every namespace is split
    settings = TreeSettings(leaf_target=10, max_k=5, min_silhouette=0.0, big_node_docs=40, seed=7)
    made = corpus.recursive_cluster(settings)
    nodes = corpus.table("cluster_tree")
    assert made == nodes.count() > 4
    again = corpus.recursive_cluster(settings)
    assert again == made
    assert corpus.table("page_vector").filter("cluster_node_id is null").count() == 0

    corpus.project()
    assert corpus.table("page_vector").filter("three_d_vector is null").isEmpty()
    corpus.top_terms()
    run = corpus.topics("refresh")
    labelled = corpus.table("cluster_tree")
    assert labelled.filter("final_label is null or first_label is null").isEmpty()
    assert labelled.filter("child_count = 0 and top_terms is null").isEmpty()
    inner = labelled.filter("parent_id is not null").count()
    leaves = labelled.filter("child_count = 0").count()
    assert sum(run.processed.values()) == 2 * inner and leaves < inner + 4
    assert sum(corpus.topics("resume").processed.values()) == 0

    report = {r["namespace"]: r for r in corpus.status().collect()}
    assert sum(r["total_pages"] for r in report.values()) == total
    assert sum(r["tree_clustered_count"] for r in report.values()) == total
    assert all(r["downloaded_chunks"] == r["extracted_chunks"] == r["total_chunks"] for r in report.values())


def test_limited_labels_resume(corpus):
    first = corpus.topics("refresh", limit=3)
    assert set(first.processed.values()) == {3}
    nodes = corpus.table("cluster_tree")
    assert nodes.filter("parent_id is null and first_label is not null").isEmpty()
    rest = corpus.topics("resume")
    assert all(n > 0 for n in rest.processed.values())
    assert corpus.table("cluster_tree").filter("final_label is null").isEmpty()


def test_changes_lie_over_the_base_and_fold_in(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("corpusmap.plans.corpus.MAX_CHANGES", 3)
    corpus = Corpus(spark, str(tmp_path), fx.languages(spark))
    schema = "namespace string, page_id bigint, cluster_node_id bigint"

    def rows():
        return sorted((r["page_id"], r["cluster_node_id"]) for r in corpus.table("cluster_node_id").collect())

    assert rows() == []
    for step in range(6):
        corpus.change("cluster_node_id", spark.createDataFrame([("n", step, step), ("n", 99, step)], schema))
        assert rows() == [(i, i) for i in range(step + 1)] + [(99, step)]
    base, changes = corpus._folders("cluster_node_id")
    assert base >= 1 and len(changes) <= 3
    (tmp_path / "cluster_node_id" / "v50").mkdir()  # a step that did not finish
    (tmp_path / "cluster_node_id" / f"v{base}-40").mkdir()
    assert rows() == [(i, i) for i in range(6)] + [(99, 5)]


def test_components_follow_new_embeddings_without_reading_the_old(spark, tmp_path, monkeypatch):
    corpus = Corpus(spark, str(tmp_path), fx.languages(spark))
    x = np.random.default_rng(2).random((300, 7))
    schema = "namespace string, page_id bigint, embedding_vector array<float>"

    def add(a, b):
        corpus.change("embedding_vector", spark.createDataFrame([("n", i, x[i].tolist()) for i in range(a, b)], schema))

    def basis():
        return np.array(corpus.table("pca_basis").first()["values"])

    def placed():
        return {r.page_id: np.array(r.reduced_vector) for r in corpus.table("reduced_vector").collect()}

    add(0, 200)
    corpus.reduce(target_dim=3)
    first, before = basis(), placed()
    add(200, 260)
    corpus.reduce(target_dim=3, only_new=True)
    assert np.array_equal(basis(), first) and len(placed()) == 260
    assert all(np.array_equal(before[i], placed()[i]) for i in range(200))
    read = []
    gather = pca.moment_sums
    monkeypatch.setattr(pca, "moment_sums", lambda rows, *a: read.append(sorted(r.page_id for r in rows.select("page_id").collect())) or gather(rows, *a))
    assert corpus.update_moments() == 60 and corpus.update_moments() == 0
    assert read == [list(range(200, 260)), []]
    corpus.compact("embedding_vector")
    add(260, 300)
    corpus.reduce(target_dim=3)
    assert read[2:] == [list(range(260, 300))]
    whole = pca.fit(corpus.table("embedding_vector"), "namespace", "embedding_vector", 3).first()
    assert np.allclose(basis(), whole["values"], atol=1e-9) and len(placed()) == 300
