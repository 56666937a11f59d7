"""From raw documents to token ids: language, boilerplate lines, near copies, test passages, encoding."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmap.llm import bpe, decontamination, language, line_dedup, near_dedup
from corpusmap.llm.queries import documents, tokenizer_path
from corpusmap.llm.shared import take_back
from corpusmap.session import arrow_batches, broadcast_if_small, cut_lineage, drop_folder, new_folder, scratch

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# Below this a text is as likely in the other languages together as in its own.
MIN_SCORE = 0.5
# A text goes if the best language's statistics make it longer than its bytes, and by more than what a key or a rare
# name in a short text costs.
MOST_BITS, SPARE_BITS = 8, 256
# Of a batch of rows that goes to Python.
BATCH_BYTES = 4 << 20
# No SQL expresses language models, near copies or byte-pair encoding.
ORACLE_SQL = None


# Every stage but the last returns COLUMNS; further columns of its input are not carried on, whatever their names.
# Repeated rows are rows of their own, except to near_copies; an empty table gives none.


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a language known from the labels; those without letters, without a clear language or such that no
    learned language makes them shorter (foreign scripts, noise) go.

    A null or empty text has no letters. Rows without a language are judged by the others' labels; without any label, no
    row stays. Of languages that fit a text equally well the first by name counts. Rows with null ids are judged too.
    """
    model = language.train(docs)
    found = language.predict(docs, model, carry=COLUMNS[1:])
    known = (F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= MIN_SCORE)
    excess = (F.col("bits_per_byte") - MOST_BITS) * F.octet_length("text")
    return found.filter(known & (excess <= SPARE_BITS)).select(*COLUMNS)


def line_cleaning(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that many sources share; ``n_chars`` follows the text.

    A null text stays null, as does its ``n_chars``; a null source is no source, though its rows lose such lines too.
    """
    cleaned = line_dedup.dedup_lines(docs.select(*COLUMNS))
    return cleaned.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id; rows that share an id are told
    apart by their texts, and of rows alike in both one stays."""
    text = F.xxhash64("text")
    # null ids come last, as they do in near_duplicates
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), text.alias("text"))
    found = near_dedup.near_duplicates(docs.select(key.alias("key"), "text"), width=5, least=80, id_col="key").filter("kept")
    found = found.groupBy(F.col("key.id").alias("_kept"), F.col("key.text").alias("_kept_text")).agg(F.count(F.lit(1)).alias("n"))
    found = cut_lineage(found, "kept-ids")
    same = F.col("doc_id").eqNullSafe(F.col("_kept")) & (text == F.col("_kept_text"))
    once = docs.join(broadcast_if_small(found.filter("n = 1").drop("n"), 1_000_000), same, "left_semi")
    again = docs.join(broadcast_if_small(found.filter("n > 1").drop("n")), same, "left_semi").dropDuplicates(["doc_id", "text"])
    return once.unionByName(again).select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark, each row judged by its own text; null and empty texts stay."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.drop_contaminated(docs, items).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document; a null or empty text has none."""
    encoded = bpe.encode(docs, tokenizer_path("word_bpe_49k.json"))
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def on_clean_ground(stage: Stage) -> Stage:
    """``stage``, begun when what earlier work has left is let go of, also where the stages are called one by one:
    models sent to the workers by earlier stages would else stay with the driver and the executors."""

    @functools.wraps(stage)
    def begin(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        take_back(spark)
        return stage(spark, docs, sf_dir)

    return begin


STAGES: list[tuple[str, Stage]] = [
    ("language_id", on_clean_ground(language_id)),
    ("line_dedup", on_clean_ground(line_cleaning)),
    ("near_dedup", on_clean_ground(near_copies)),
    ("decontamination", on_clean_ground(decontaminate)),
    ("bpe", on_clean_ground(encode)),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again before the next stage.

    What a stage wrote on its way, and its input, are removed once its result is there.
    """
    docs, before = documents(spark, sf_dir), None
    with arrow_batches(spark, BATCH_BYTES):
        for name, stage in STAGES:
            folder = new_folder(spark, f"pipeline-{name}")
            with scratch(spark):
                result = stage(spark, docs, sf_dir)
                result.write.parquet(folder)
            docs = spark.read.schema(result.schema).parquet(folder)
            if before:
                drop_folder(spark, before)
            before = folder
    take_back(spark)
    return docs
