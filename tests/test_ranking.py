from pyspark.sql import functions as F

from corpusmap.functions import ranking
from corpusmap.functions.ranking import first_n_per_group, number_rows, take_in_order
from corpusmap.operators import worklists


def skewed(spark, n=3000):
    """A third of the rows under one key."""
    return spark.range(n).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 97).alias("k"), "id")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_n_per_group_cuts_before_the_shuffle(spark):
    first = first_n_per_group(skewed(spark), ["k"], ["id"], 10, rank="pos")
    text = plan(first)
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text
    hot = [r["id"] for r in first.filter("k = 0").orderBy("pos").collect()]
    assert hot == [0, 3, 6, 9, 12, 15, 18, 21, 24, 27]


def test_number_rows_is_a_total_order(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x")).repartition(13)
    numbered = number_rows(df, [F.desc("x")])
    assert numbered.filter(F.col("row_no") + F.col("x") != 1000).isEmpty()
    assert numbered.count() == 1000


def test_take_in_order_beyond_the_small_limit(spark, monkeypatch):
    monkeypatch.setattr(ranking, "SMALL_LIMIT", 10)
    df = skewed(spark).repartition(7)
    taken = {r["id"] for r in take_in_order(df, ["k", "id"], 500).collect()}
    assert taken == {r["id"] for r in df.orderBy("k", "id").limit(500).collect()}
    assert take_in_order(df, ["id"], None) is df


def test_budget_by_chunk_counts(spark):
    pages = skewed(spark).select(
        F.lit("n").alias("namespace"), F.concat(F.lit("c"), F.col("k")).alias("chunk_name"), F.col("id").alias("page_id")
    )
    vectors = pages.filter("page_id % 10 = 1").select("namespace", "page_id", F.lit(True).alias("embedding_vector"))
    left = pages.filter("page_id % 10 <> 1").orderBy("namespace", "chunk_name", "page_id")
    for limit in (1001, 1500, 2699, 2700, 5000):
        taken = worklists.pages_within_budget(pages.repartition(5), vectors, limit)
        assert {tuple(r) for r in taken.select(*left.columns).collect()} == {tuple(r) for r in left.limit(limit).collect()}
