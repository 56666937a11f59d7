from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusmap.functions.text import clip, collapse_whitespace, page_line, page_text

SPACES = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0       　"
TEXT = st.text(st.one_of(st.sampled_from(SPACES), st.characters(codec="utf-8", exclude_characters="\x00")), max_size=40)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(TEXT, min_size=30, max_size=60))
def test_collapse_equals_split_and_join(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    for row in df.select("t", collapse_whitespace(F.col("t")).alias("c")).collect():
        assert row["c"] == " ".join(row["t"].split())


def test_page_texts(spark):
    df = spark.createDataFrame([("A", "b" * 600), ("A", None), ("A", ""), (None, "x")], "t string, a string")
    rows = df.select(
        page_line(F.col("t"), clip(F.col("a"))).alias("line"), page_text(F.col("t"), F.col("a")).alias("text")
    ).collect()
    assert [r["line"] for r in rows] == ["A: " + "b" * 500, "A", "A", ": x"]
    assert [r["text"] for r in rows] == ["A\n" + "b" * 600, "A", "A\n", "x"]
