import pytest
from pyspark.sql import functions as F

from corpusmap import fixtures as fx
from corpusmap.operators import updates, worklists
from corpusmap.schemas import CHUNK_LOG, NODE_KEY, PAGE_KEY

AS_OF = "2024-06-01 00:00:00"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_upsert_twice_is_upsert_once(spark, sf_dir):
    pages = fx.page_log(spark, sf_dir)
    changes = pages.withColumn("title", F.upper("title")).withColumn("seq", F.lit(1))
    once = updates.upsert_pages(pages, changes, AS_OF, ["seq"])
    twice = updates.upsert_pages(once, changes, AS_OF, ["seq"])
    assert rows(once) == rows(twice)
    assert once.count() == pages.count()


def test_hot_key_keeps_its_last_row(spark):
    changes = spark.range(9000).select(
        F.lit("n").alias("namespace"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 100).alias("page_id"),
        F.col("id").cast("string").alias("title"), F.col("id").alias("seq"),
    )
    last = updates.last_per_key(changes, PAGE_KEY, ["seq"])
    assert last.count() == 6001
    assert last.filter("page_id = 7").first()["title"] == "8997"


def test_small_changes_do_not_shuffle_the_table(spark, tmp_path):
    spark.range(20000).select(F.lit("n").alias("namespace"), F.col("id").alias("page_id"), F.lit("x").alias("title")).write.parquet(str(tmp_path / "t"))
    spark.range(5).select(F.lit("n").alias("namespace"), F.col("id").alias("page_id"), F.lit("y").alias("title")).write.parquet(str(tmp_path / "c"))
    table, changes = spark.read.parquet(str(tmp_path / "t")), spark.read.parquet(str(tmp_path / "c"))
    for df in (updates.replace_rows(table, changes, PAGE_KEY), updates.update_columns(table, changes, PAGE_KEY, ["title"])):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in text and "hashpartitioning" not in text
        assert df.filter("title = 'y'").count() == 5 and df.count() == 20000


def test_chunk_upsert_keeps_or_resets_paths(spark):
    chunks = spark.createDataFrame(
        [("n", "a", "path", "out", None, None), ("n", "b", None, None, None, None)], CHUNK_LOG
    ).withColumn("downloaded_at", F.lit(AS_OF).cast("timestamp"))
    listing = spark.createDataFrame([("n", "a"), ("n", "a"), ("n", "c")], "namespace string, chunk_name string")
    kept = {r["chunk_name"]: r for r in updates.upsert_chunks(chunks, listing).collect()}
    assert set(kept) == {"a", "b", "c"}
    assert kept["a"]["chunk_archive_path"] == "path" and kept["a"]["downloaded_at"] is None
    assert kept["b"]["downloaded_at"] is not None
    reset = {r["chunk_name"]: r for r in updates.upsert_chunks(chunks, listing, reset_paths=True).collect()}
    assert reset["a"]["chunk_archive_path"] is None and reset["a"]["chunk_extracted_path"] is None


def test_null_label_overwrites(spark, sf_dir):
    nodes = fx.cluster_tree(spark, sf_dir)
    labels = nodes.select(*NODE_KEY, F.lit(None).cast("string").alias("first_label"))
    assert updates.set_labels(nodes, labels, ["first_label"]).filter("first_label is not null").isEmpty()


@pytest.mark.parametrize("call", [
    lambda df: worklists.chunks_to_download(df, limit=0),
    lambda df: worklists.chunks_to_unpack(df, limit=-1),
    lambda df: worklists.labelling_worklist(df, 1, "again"),
    lambda df: worklists.labelling_worklist(df, 5, "resume"),
])
def test_arguments(spark, sf_dir, call):
    with pytest.raises(ValueError):
        call(fx.chunk_log(spark, sf_dir))


def test_several_changes_of_one_key_leave_one_row(spark):
    keyed = "namespace string, page_id bigint"
    table = spark.createDataFrame([("n", 1, [1.0])], f"{keyed}, embedding_vector array<float>")
    changes = spark.createDataFrame(
        [("n", 1, [2.0], 1), ("n", 1, [3.0], 2), ("n", 2, [9.0], 1), ("n", 2, [4.0], 5)], f"{keyed}, embedding_vector array<float>, seq int"
    )
    got = sorted(map(tuple, updates.upsert_embeddings(table, changes, ["seq"]).collect()))
    assert got == [("n", 1, [3.0]), ("n", 2, [4.0])]
    assert updates.upsert_embeddings(table, changes.drop("seq")).count() == 2


def test_a_node_is_inserted_once(spark):
    keyed = "namespace string, node_id bigint, depth smallint"
    nodes = spark.createDataFrame([("n", 1, 0)], keyed)
    assert updates.insert_nodes(nodes, spark.createDataFrame([("n", 2, 1), ("m", 1, 0)], keyed)).count() == 3
    for bad in ([("n", 1, 5)], [("n", 3, 1), ("n", 3, 2)]):
        with pytest.raises(Exception, match="node is there already"):
            updates.insert_nodes(nodes, spark.createDataFrame(bad, keyed)).count()
