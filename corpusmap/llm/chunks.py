"""Chunks of rows that look up their hashed keys in buckets, with packed keys in between.

A chunk is a set of rows picked by a hash of their id and text, small enough for one task. It sends every
distinct key once to the bucket of that key, in one packed row per bucket; a bucket sees all chunks that
have a key and answers those it concerns. So a key that a third of all rows hold costs one entry
per chunk, and the shuffle moves a few bytes per key instead of a row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK_BYTES = 8 << 20
U64 = np.uint64


def pack(values: np.ndarray, rising: bool = False) -> bytes:
    """Whole numbers below 2^64 as byte planes, highest bytes that are all zero left out.

    ``rising`` numbers are kept as differences. Planes let the shuffle's compression work.
    """
    values = values.astype(U64)
    if rising and len(values):
        values = np.diff(values, prepend=U64(0))
    top = int(values.max()) if len(values) else 0
    planes = (top.bit_length() + 7) // 8
    rows = np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8).T[:planes]
    return len(values).to_bytes(8, "little") + bytes([planes]) + np.ascontiguousarray(rows).tobytes()


def unpack(data: bytes, rising: bool = False) -> np.ndarray:
    n, planes = int.from_bytes(data[:8], "little"), data[8]
    rows = np.zeros((n, 8), np.uint8)
    rows[:, :planes] = np.frombuffer(data, np.uint8, n * planes, 9).reshape(planes, n).T
    values = rows.reshape(-1).view(U64)
    with np.errstate(over="ignore"):
        return np.cumsum(values, dtype=U64) if rising else values


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def chunk_count(docs: DataFrame, text_col: str) -> int:
    """Enough chunks to keep them below CHUNK_BYTES on average and all shuffle partitions at work."""
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    return max(2 * partitions(docs), total // CHUNK_BYTES + 1)


def chunk_of(chunks: int, *cols: str | Column) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(chunks)).cast("int")


def bucket_bounds(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins among sorted 64-bit keys; buckets are ranges of their upper half."""
    edges = (np.arange(buckets + 1, dtype=np.float64) * (2.0**32 / buckets)).astype(U64)
    edges[-1] = U64(1) << U64(32)
    return np.searchsorted(keys >> U64(32), edges)


def by_bucket(chunk: int, buckets: int, keys: np.ndarray, *columns: tuple[np.ndarray, bool]) -> pa.RecordBatch:
    """Rows (bucket, chunk, packed columns) of a chunk's sorted keys; ``columns`` are (values, rising)."""
    bounds = bucket_bounds(keys, buckets)
    filled = np.flatnonzero(np.diff(bounds))
    packed = [
        pa.array([pack(values[bounds[b] : bounds[b + 1]], rising) for b in filled], pa.binary()) for values, rising in columns
    ]
    return pa.RecordBatch.from_arrays(
        [pa.array(filled.astype(np.int32)), pa.array(np.full(len(filled), chunk, np.int32)), *packed],
        names=["bucket", "chunk", *(f"p{k}" for k in range(len(columns)))],
    )


def gather(table: pa.Table, rising: tuple[bool, ...]) -> tuple[np.ndarray, list[np.ndarray]]:
    """(chunk of each entry, unpacked columns) of all packed rows in a table."""
    columns = []
    counts: list[int] = []
    for k, up in enumerate(rising):
        parts = [unpack(x, up) for x in table.column(f"p{k}").to_pylist()]
        counts = [len(x) for x in parts]
        columns.append(np.concatenate([np.empty(0, U64), *parts]))
    return np.repeat(table.column("chunk").to_numpy().astype(np.int64), np.array(counts, np.int64)), columns


def answers(chunks: np.ndarray, *columns: tuple[np.ndarray, bool]) -> Iterator[pa.RecordBatch]:
    """One row (chunk, packed columns) per chunk of entries that are sorted by chunk."""
    cuts = np.flatnonzero(np.diff(chunks, prepend=-1))
    ends = np.append(cuts[1:], len(chunks))
    if len(cuts):
        packed = [pa.array([pack(v[a:b], up) for a, b in zip(cuts, ends)], pa.binary()) for v, up in columns]
        yield pa.RecordBatch.from_arrays(
            [pa.array(chunks[cuts].astype(np.int32)), *packed], names=["chunk", *(f"p{k}" for k in range(len(columns)))]
        )


def planes(n: int) -> str:
    return ", ".join(f"p{k} binary" for k in range(n))


def ask(asked: DataFrame, answer: Callable[[pa.Table], Iterator[pa.RecordBatch]], columns: int) -> DataFrame:
    """Bring the rows of each bucket together and let ``answer`` make rows (chunk, packed columns)."""

    def run(table: pa.Table) -> pa.Table:
        schema = pa.schema([("chunk", pa.int32()), *((f"p{k}", pa.binary()) for k in range(columns))])
        return pa.Table.from_batches(list(answer(table)), schema)

    return asked.groupBy("bucket").applyInArrow(run, f"chunk int, {planes(columns)}")
