"""Vectors in and out of their stored forms, and the columnar copy of the tables."""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmap.schemas import FLOATS


@F.arrow_udf(FLOATS)
def floats_from_blob(blobs: pa.Array) -> pa.Array:
    """Little-endian float32 bytes to a float list; the batch's bytes are reinterpreted, not looped."""
    if len(blobs) == 0:
        return pa.array([], pa.list_(pa.float32()))
    wide = blobs.cast(pa.large_binary()) if not pa.types.is_large_binary(blobs.type) else blobs
    _, offset_buffer, data = wide.buffers()
    offsets = np.frombuffer(offset_buffer, "<i8")[wide.offset : wide.offset + len(wide) + 1]
    if ((offsets - offsets[0]) % 4).any():
        raise ValueError("a vector blob is not a whole number of float32 values")
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.empty(0, np.uint8)
    values = pa.array(np.frombuffer(raw.tobytes(), "<f4"), pa.float32())
    starts = pa.array((offsets - offsets[0]) // 4, pa.int32())
    return pa.ListArray.from_arrays(starts, values, mask=wide.is_null())


@F.arrow_udf(T.BinaryType())
def blob_from_floats(vectors: pa.Array) -> pa.Array:
    """A float list to little-endian float32 bytes."""
    lengths = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    offsets = np.concatenate([[0], np.cumsum(lengths) * 4]).astype("<i4")
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype("<f4")
    set_bits = pa.array(vectors.is_valid()).buffers()[1] if vectors.null_count else None
    return pa.Array.from_buffers(
        pa.binary(), len(vectors), [set_bits, pa.py_buffer(offsets.tobytes()), pa.py_buffer(values.tobytes())]
    )


def vector_from_text(text: Column) -> Column:
    """JSON list of three numbers to a float list; anything else is an error, NULL and '' are NULL."""
    values = F.from_json(text, "array<double>")
    good = values.isNotNull() & (F.size(values) == 3) & F.forall(values, lambda x: x.isNotNull())
    wrong = F.raise_error(F.concat(F.lit("not a 3-d vector: "), text)).cast("array<float>")
    return F.when(text.isNull() | (text == ""), F.lit(None).cast("array<float>")).when(
        good, values.cast("array<float>")
    ).otherwise(wrong)


def finite_or_zero(value: Column) -> Column:
    """NaN and infinities become 0, as does a missing number."""
    limit = F.lit(float("inf"))
    usable = value.isNotNull() & ~F.isnan(value) & (F.abs(value) < limit)
    return F.when(usable, value.cast("double")).otherwise(F.lit(0.0))


def text_from_vector(vector: Column) -> Column:
    return F.when(vector.isNotNull(), F.to_json(F.transform(vector, finite_or_zero)))


def columnar_vectors(stored: DataFrame) -> DataFrame:
    """Blob columns to float lists and 3-d text to a float list; other columns as they are."""
    changed = {
        c: floats_from_blob(F.col(c)) for c in ("embedding_vector", "reduced_vector", "centroid") if c in stored.columns
    }
    if "three_d_vector" in stored.columns:
        changed["three_d_vector"] = vector_from_text(F.col("three_d_vector"))
    return stored.withColumns(changed)


def columnar_tree(stored: DataFrame) -> DataFrame:
    """Tree rows with the centroid as a float list and the JSON text lists as lists."""
    return stored.withColumns({
        "centroid": floats_from_blob("centroid"),
        "top_terms": F.from_json("top_terms", "array<string>"),
        "sample_doc_ids": F.from_json("sample_doc_ids", "array<bigint>"),
    })


def convert(stored: Mapping[str, DataFrame], target: str) -> None:
    """The four stored tables as columnar Parquet tables under ``target``."""
    keys = {"chunk_log": "chunk_name", "page_log": "page_id", "page_vector": "page_id", "cluster_tree": "node_id"}
    decode = {"page_vector": columnar_vectors, "cluster_tree": columnar_tree}
    for name, df in stored.items():
        write_table(decode[name](df) if name in decode else df, f"{target}/{name}", keys[name])


def write_table(df: DataFrame, path: str, key: str) -> None:
    """Parquet partitioned by namespace, each folder cut into files by key range.

    Ranging on (namespace, key) spreads a namespace that holds a third of the rows over many tasks
    and keeps the number of files near the number of tasks.
    """
    df.repartitionByRange("namespace", key).sortWithinPartitions("namespace", key).write.partitionBy(
        "namespace"
    ).parquet(path)


def save_bucketed(df: DataFrame, name: str, buckets: int, key: tuple[str, ...] = ("namespace", "page_id")) -> None:
    """A catalogue table bucketed and sorted by the page key: joins of pages and vectors on it need no
    shuffle. Use the same number of buckets for all of them."""
    df.repartition(buckets, *key).write.bucketBy(buckets, *key).sortBy(*key).mode("overwrite").saveAsTable(name)
