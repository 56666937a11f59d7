"""Scans that hand every task a small table per group, and sums kept per group."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from corpusmap.session import broadcast_if_small, cut_lineage

# Largest group tables broadcast to the executors; more of them go to the rows by a shuffle.
ROUND_BYTES = 64 << 20
# Rows of one group that meet its table in one task then.
PART_ROWS = 4096

Batches = Iterator[pa.RecordBatch]


def matrix(column: pa.Array, dtype=np.float64) -> np.ndarray:
    """A list column of equal lengths as rows of a matrix."""
    if len(column) == 0:
        return np.empty((0, 0), dtype)
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1).astype(dtype, copy=False)


def float_lists(rows: np.ndarray, kind=pa.float32()) -> pa.Array:
    """The inverse of ``matrix``."""
    n, width = rows.shape
    offsets = pa.array(np.arange(0, (n + 1) * width, width) if width else np.zeros(n + 1), pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(rows.ravel(), kind))


def by_group(batch: pa.RecordBatch, key: str) -> Iterator[tuple[str, pa.RecordBatch]]:
    """Rows of one batch by key; no copy where the batch holds a single key."""
    codes = batch.column(key).dictionary_encode()
    index = codes.indices.to_numpy(zero_copy_only=False)
    names = codes.dictionary.to_pylist()
    if len(names) == 1:
        yield names[0], batch
        return
    order = np.argsort(index, kind="stable")
    bounds = np.searchsorted(index[order], np.arange(len(names) + 1))
    for code, name in enumerate(names):
        yield name, batch.take(pa.array(order[bounds[code] : bounds[code + 1]]))


def scan_with_tables(
    df: DataFrame,
    key: str,
    tables: DataFrame,
    table_bytes: int,
    work: Callable[[Batches, dict[str, np.ndarray]], Batches],
    schema: str,
) -> DataFrame:
    """Run ``work`` over the rows of ``df`` with the matrix of each row's group at hand.

    ``tables`` (key, values: list of equal lists) has one row per group of about ``table_bytes``. Up to
    ROUND_BYTES in total they are broadcast and the rows stay where they are. Beyond that the tables go to
    the rows: both are shuffled by group, large groups in parts of PART_ROWS rows, so neither the driver nor
    a task holds more than one part and one table. Rows of unknown groups are left out. ``df`` is best read
    from a stored table: parts go by the rows' places in its scan.
    """
    most = max(1, ROUND_BYTES // max(table_bytes, 1))
    first = tables.select(key, "values").limit(most + 1).collect()
    if len(first) <= most:
        return _scan(df, key, first, work, schema)
    counts = df.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / PART_ROWS).alias("_parts")).filter("_parts > 1")
    several = broadcast_if_small(cut_lineage(counts, "parts"))  # at most one row per PART_ROWS rows
    parts = F.coalesce("_parts", F.lit(1))
    # Row numbers of a scan, so that copies of one vector are dealt out too.
    numbered = df.withColumn("_row", F.monotonically_increasing_id())
    rows = numbered.join(several, key, "left").withColumn("_part", F.pmod("_row", parts)).drop("_row", "_parts")
    held = tables.select(key, "values").join(several, key, "left").withColumn(
        "_part", F.explode(F.sequence(F.lit(0).cast("long"), parts.cast("long") - 1))
    ).drop("_parts")
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(group: pa.Table, table: pa.Table) -> pa.Table:
        if not len(group) or not len(table):
            return arrow.empty_table()
        name = table.column(key)[0].as_py()
        matrices = {name: np.array(table.column("values")[0].as_py(), np.float64)}
        batches = group.drop_columns(["_part"]).combine_chunks().to_batches()
        found = [b for b in work(iter(batches), matrices) if b.num_rows]
        return pa.Table.from_batches(found).select(arrow.names) if found else arrow.empty_table()

    return rows.groupBy(key, "_part").cogroup(held.groupBy(key, "_part")).applyInArrow(run, schema)


def _scan(df: DataFrame, key: str, rows: list, work, schema: str) -> DataFrame:
    held = {row[key]: np.array(row["values"], np.float64) for row in rows}
    shared = df.sparkSession.sparkContext.broadcast(held)

    def run(batches: Batches) -> Batches:
        yield from work(batches, shared.value)

    return df.mapInArrow(run, schema)


SUM_SCHEMA = "{key} string, slot int, n bigint, total array<double>"


def sum_rows(key: str, name: str, counts: np.ndarray, totals: np.ndarray) -> pa.RecordBatch:
    """Per-task sums of one group as rows, one for each slot."""
    slots = len(counts)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([name] * slots, pa.string()),
            pa.array(np.arange(slots), pa.int32()),
            pa.array(counts.astype(np.int64)),
            float_lists(totals, pa.float64()),
        ],
        names=[key, "slot", "n", "total"],
    )


def add_up(partial: DataFrame, key: str) -> DataFrame:
    """Per-task sums to totals per (group, slot); element-wise, with map-side combine."""
    vector = array_to_vector("total")
    return partial.groupBy(key, "slot").agg(
        F.sum("n").alias("n"), vector_to_array(Summarizer.sum(vector)).alias("total")
    )


def slots_to_table(totals: DataFrame, key: str, value: str = "total") -> DataFrame:
    """Slot rows of each group as one list of lists, in slot order."""
    listed = totals.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("slot", "n", value))).alias("_s"))
    return listed.select(key, F.col(f"_s.{value}").alias("values"), F.col("_s.n").alias("counts"))


def map_small_groups(
    df: DataFrame, keys: list[str], order: list[str], work: Callable[[pa.Table], pa.Table], schema: str
) -> DataFrame:
    """Run ``work`` on every group's rows, for many groups of bounded size.

    The rows are brought together and sorted by key, and each task cuts its stream where the key
    changes. It holds one batch and one open group; unlike a grouped map it pays per batch, not per
    group, for getting rows to Python.
    """
    arranged = df.repartition(*keys).sortWithinPartitions(*keys, *order)

    def run(batches: Batches) -> Batches:
        open_rows: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            if open_rows is not None:
                rows = pa.concat_tables([open_rows, rows])
            rows = rows.combine_chunks()
            changed = np.zeros(max(len(rows) - 1, 0), bool)
            for name in keys:
                codes = rows.column(name).combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
                changed |= codes[1:] != codes[:-1]
            bounds = [0, *(np.flatnonzero(changed) + 1).tolist()]
            done = [work(rows.slice(a, b - a)) for a, b in zip(bounds, bounds[1:])]
            if done:
                yield from pa.concat_tables(done).combine_chunks().to_batches()
            open_rows = rows.slice(bounds[-1])
        if open_rows is not None and len(open_rows):
            yield from work(open_rows).combine_chunks().to_batches()

    return arranged.mapInArrow(run, schema)
