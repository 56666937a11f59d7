"""The pipeline against plain versions of its stages."""

import re
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

import brute
import corpus_pipeline
from corpusmap.llm import queries

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def without_shared_lines(rows, least=10):
    sites = defaultdict(set)
    for _, text, _, source in rows:
        for line in text.split("\n"):
            sites[line.strip(" \t\r")].add(source)
    shared = {line for line, seen in sites.items() if line and len(seen) >= least}
    return [
        (i, "\n".join(x for x in text.split("\n") if x.strip(" \t\r") not in shared), lang, source)
        for i, text, lang, source in rows
    ]


def holds(text, item, least=13):
    """Whether a text has a stretch of an item, by comparing all their places."""
    words, wanted = ([w for w in re.split(r"[\W_]+", t.lower()) if w] for t in (text, item))
    places = defaultdict(list)
    for k, w in enumerate(words):
        places[w].append(k)
    diagonals = defaultdict(list)
    for k, w in enumerate(wanted):
        for p in places[w]:
            diagonals[p - k].append(k)
    for equal in diagonals.values():
        start = 0
        for k in range(1, len(equal) + 1):
            if k == len(equal) or equal[k] - equal[k - 1] > 4:
                n, span = k - start, equal[k - 1] - equal[start] + 1
                start = k
                if n >= least and n >= 0.8 * span or len(wanted) < least and n >= 0.8 * len(wanted):
                    return True
    return False


def test_run_is_its_stages_in_plain(spark):
    from tokenizers import Tokenizer

    rows = duckdb.sql(f"SELECT doc_id, text, lang, source FROM '{SF_DIR}/documents.parquet'").fetchall()
    items = [t for (t,) in duckdb.sql(f"SELECT text FROM '{SF_DIR}/benchmark.parquet'").fetchall()]
    rows = [r for r in rows if r[1] and re.search(r"[^\W\d_]", r[1])]
    rows = without_shared_lines(rows)
    parts = brute.components([(i, t) for i, t, _, _ in rows], width=5)
    rows = [r for r in rows if parts[r[0]][1] == r[0]]
    rows = [r for r in rows if not any(holds(r[1], item) for item in items)]
    library = Tokenizer.from_file(queries.tokenizer_path("word_bpe_49k.json"))
    expected = {i: library.encode(t, add_special_tokens=False).ids for i, t, _, _ in rows}
    assert {r.doc_id: r.ids for r in corpus_pipeline.run(spark, SF_DIR).collect()} == expected


@pytest.mark.parametrize("place", range(len(corpus_pipeline.STAGES)))
def test_stages_take_awkward_and_empty_tables(spark, place):
    name, stage = corpus_pipeline.STAGES[place]
    rows = [
        (1, "Ein ganz gewöhnlicher Satz über das Wetter.", "de", "a", 1), (1, "Ein ganz gewöhnlicher Satz über das Wetter.", "de", "a", 1),
        (2, None, "en", "a", None), (3, "", None, None, 0), (None, "A sentence without a number.", "en", "b", 2),
        (4, " \n\n ", "en", "b", 3), (5, "x " * 50_000, "en", "c", 4),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("label", F.lit(1))
    found = stage(spark, df, SF_DIR)
    kept = sorted((r.doc_id for r in found.collect()), key=repr)
    if place < len(corpus_pipeline.STAGES) - 1:
        assert found.columns == COLUMNS
    expected = {"language_id": [1, 1, 5, None], "near_dedup": [1, 2, 3, 4, 5, None]}.get(name, [1, 1, 2, 3, 4, 5, None])
    assert kept == sorted(expected, key=repr)
    assert stage(spark, df.limit(0), SF_DIR).collect() == []


def test_stage_names_are_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontamination", "bpe"]


def test_stages_called_one_by_one_keep_no_models(spark, tmp_path):
    """Each stage lets go of what earlier ones sent to the workers, run after run."""
    from corpusmap.llm import shared

    for turn in range(2):
        docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
        for name, stage in corpus_pipeline.STAGES:
            stage(spark, docs, SF_DIR).write.parquet(f"{tmp_path}/{turn}-{name}")
            docs = spark.read.parquet(f"{tmp_path}/{turn}-{name}")
            assert len(shared._sent) <= 1
    assert docs.count() > 0
