"""Embeddings of pages: a pluggable batch function, and a built-in one that needs no model."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.feature import HashingTF, Normalizer, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmap.functions.text import page_text

# Fixed value: what an embedder's error says when a text does not fit its context.
TOO_LARGE = "input is too large to process"

Embedder = Callable[[Sequence[str]], np.ndarray]


def embed_one(text: str, embedder: Embedder) -> tuple[np.ndarray | None, str | None]:
    """(vector, None) or (None, reason). A text that is too large is halved until it fits."""
    while True:
        try:
            return np.asarray(embedder([text])[0], np.float32), None
        except Exception as error:
            if TOO_LARGE not in str(error):
                return None, str(error) or type(error).__name__
            text = text[: len(text) // 2]
            if not text:
                return None, "nothing left of the text after halving"


def embed_texts(texts: Sequence[str], embedder: Embedder, batch_rows: int) -> Iterator[tuple]:
    """One call per ``batch_rows`` texts; a batch that fails is repeated text by text."""
    for start in range(0, len(texts), batch_rows):
        part = list(texts[start : start + batch_rows])
        try:
            vectors = [(np.asarray(v, np.float32), None) for v in embedder(part)]
            if len(vectors) != len(part):
                raise ValueError(f"embedder gave {len(vectors)} vectors for {len(part)} texts")
        except Exception:
            vectors = [embed_one(text, embedder) for text in part]
        yield from vectors


def embed_pages(pages: DataFrame, embedder: Embedder, batch_rows: int = 100, calls: int | None = None) -> DataFrame:
    """(namespace, page_id, embedding_vector, error) for each page; a failed page has only ``error``.

    ``calls`` caps how many tasks call the embedder at a time. Write the result out before using it
    twice, or the calls are made again.
    """
    texts = pages.select("namespace", "page_id", page_text(F.col("title"), F.col("abstract")).alias("text"))
    if calls is not None:
        texts = texts.repartition(calls)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            results = list(embed_texts(batch["text"].tolist(), embedder, batch_rows))
            yield pd.DataFrame({
                "namespace": batch["namespace"].to_numpy(),
                "page_id": batch["page_id"].to_numpy(),
                "embedding_vector": [v for v, _ in results],
                "error": [e for _, e in results],
            })

    return texts.mapInPandas(run, "namespace string, page_id bigint, embedding_vector array<float>, error string")


def hashed_embeddings(pages: DataFrame, dims: int = 2048) -> DataFrame:
    """Unit-length hashed word counts: deterministic, offline, all in the JVM."""
    texts = pages.select("namespace", "page_id", page_text(F.col("title"), F.col("abstract")).alias("text"))
    words = Tokenizer(inputCol="text", outputCol="words").transform(texts)
    counts = HashingTF(numFeatures=dims, inputCol="words", outputCol="counts").transform(words)
    unit = Normalizer(inputCol="counts", outputCol="unit").transform(counts)
    return unit.select("namespace", "page_id", vector_to_array("unit", "float32").alias("embedding_vector"))
