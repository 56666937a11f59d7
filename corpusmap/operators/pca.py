"""Principal components for many groups at once.

One pass adds up counts, sums and outer products per group inside each task (a matrix product per
Arrow batch); the partial sums are merged by row of the matrix, so no task and not the driver ever
holds more than one group's d x d matrix.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmap.functions.grouped import (
    SUM_SCHEMA, add_up, by_group, float_lists, matrix, scan_with_tables, sum_rows,
)
from corpusmap.operators.updates import set_reduced_vectors
from corpusmap.operators.worklists import check_limit, vectors_with
from corpusmap.session import cut_lineage

# What a task may hold in sums before it sends them off.
HELD_BYTES = 256 << 20


def moment_sums(df: DataFrame, key: str, vector: str) -> DataFrame:
    """Per group: slot 0 holds the vector sum, slot i + 1 row i of the sum of outer products.

    Each scan task sends d + 1 rows per group it meets; they are combined before and after the shuffle. Where
    the tasks would meet so many groups that this outgrows the vectors or a task's memory, the vectors
    are first ranged by group, which splits hot groups and gathers small ones.
    """
    work = df.select(key, vector)
    dims = (work.select(F.size(vector)).first() or [0])[0]
    met = work.groupBy(key, F.spark_partition_id().alias("_task")).agg(F.count(F.lit(1)).alias("_n"))
    per_task = met.groupBy("_task").agg(F.count(F.lit(1)).alias("_groups"), F.sum("_n").alias("_n"))
    seen = per_task.agg(F.sum("_groups").alias("pairs"), F.max("_groups").alias("most"), F.sum("_n").alias("rows")).first()
    if seen["rows"] and (seen["pairs"] * dims > seen["rows"] or seen["most"] * dims * dims * 8 > HELD_BYTES):
        work = work.repartitionByRange(key, F.xxhash64(vector)).sortWithinPartitions(key)

    def run(batches):
        held: dict[str, list] = {}
        for batch in batches:
            for name, rows in by_group(batch, key):
                x = matrix(rows.column(vector))
                if name not in held:
                    if held and (len(held) + 1) * x.shape[1] ** 2 * 8 > HELD_BYTES:
                        yield from (_moment_rows(key, g, *held[g]) for g in held)
                        held.clear()
                    held[name] = [0, np.zeros(x.shape[1]), np.zeros((x.shape[1], x.shape[1]))]
                sums = held[name]
                sums[0] += len(x)
                sums[1] += x.sum(0)
                sums[2] += x.T @ x
        yield from (_moment_rows(key, g, *held[g]) for g in held)

    return add_up(work.mapInArrow(run, SUM_SCHEMA.format(key=key)), key)


def _moment_rows(key, name, n, total, outer) -> pa.RecordBatch:
    return sum_rows(key, name, np.full(len(outer) + 1, n), np.vstack([total, outer]))


def _mean_and_covariance(pdf: pd.DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    pdf = pdf.sort_values("slot")
    n = int(pdf["n"].iloc[0])
    sums = np.array(pdf["total"].tolist())
    mean = sums[0] / n
    covariance = (sums[1:] - n * np.outer(mean, mean)) / max(n - 1, 1)
    return n, mean, (covariance + covariance.T) / 2


def covariances(df: DataFrame, key: str, vector: str) -> DataFrame:
    """``moment_covariances`` of the vectors in ``df``."""
    return moment_covariances(moment_sums(df, key, vector), key)


def moment_covariances(moments: DataFrame, key: str) -> DataFrame:
    """(key, i, j, n, mean_i, covariance) of every pair of components, in long form."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        n, mean, cov = _mean_and_covariance(pdf)
        d = len(mean)
        return pd.DataFrame({
            key: pdf[key].iloc[0], "i": np.repeat(np.arange(d), d), "j": np.tile(np.arange(d), d), "n": n,
            "mean_i": np.repeat(mean, d), "covariance": cov.ravel(),
        })

    return moments.groupBy(key).applyInPandas(
        run, f"{key} string, i int, j int, n bigint, mean_i double, covariance double"
    )


def merged_moments(moments: DataFrame, more: DataFrame, key: str) -> DataFrame:
    """The moments of two sets of rows together; neither set is read again."""
    columns = [key, "slot", "n", "total"]
    return add_up(moments.select(*columns).unionByName(more.select(*columns)), key)


def fit(df: DataFrame, key: str, vector: str, target_dim: int) -> DataFrame:
    """``fit_moments`` of the vectors in ``df``."""
    return fit_moments(moment_sums(df, key, vector), key, target_dim)


def fit_moments(moments: DataFrame, key: str, target_dim: int) -> DataFrame:
    """Mean and leading components of each group: (key, n, values, explained, total_variance).

    ``values`` lists the mean first, then the components by falling variance. The largest loading of
    each is positive. Groups with fewer rows than ``target_dim`` have no components and are left out.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        n, mean, cov = _mean_and_covariance(pdf)
        if n < target_dim:
            return pd.DataFrame()
        if target_dim > len(mean):
            raise ValueError(f"cannot reduce {len(mean)} dimensions to {target_dim}")
        variances, axes = np.linalg.eigh(cov)
        axes = axes.T[::-1][:target_dim]
        largest = axes[np.arange(target_dim), np.abs(axes).argmax(1)]
        axes = axes * np.where(largest < 0, -1.0, 1.0)[:, None]
        return pd.DataFrame({
            key: [pdf[key].iloc[0]], "n": [n], "values": [np.vstack([mean, axes]).tolist()],
            "explained": [variances[::-1][:target_dim].tolist()], "total_variance": [float(np.trace(cov))],
        })

    return moments.groupBy(key).applyInPandas(
        run, f"{key} string, n bigint, values array<array<double>>, explained array<double>, total_variance double"
    )


def transform(df: DataFrame, key: str, vector: str, bases: DataFrame, target_dim: int, out: str) -> DataFrame:
    """Rows with ``vector`` replaced by its float32 coordinates ``out`` on the group's components.

    ``bases`` must be written out; it is read once to count and once to broadcast.
    """
    others = [c for c in df.columns if c != vector]
    kinds = dict(df.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in others), f"`{out}` array<float>"])

    def run(batches, tables):
        for batch in batches:
            for name, rows in by_group(batch, key):
                if name not in tables:
                    continue
                basis = tables[name]
                reduced = (matrix(rows.column(vector)) - basis[0]) @ basis[1:].T
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(c) for c in others), float_lists(reduced.astype(np.float32))], names=[*others, out]
                )

    width = bases.select(F.max(F.size(F.col("values")[0]))).first()[0] or 0
    return scan_with_tables(df, key, bases, (target_dim + 1) * width * 8, run, schema)


def check_target(target_dim: int, batch_size: int) -> None:
    check_limit(target_dim, "target_dim")
    if target_dim > batch_size:
        raise ValueError("batch_size must be at least target_dim")


def reduce_vectors(
    vectors: DataFrame,
    target_dim: int = 100,
    batch_size: int = 10_000,
    namespace: str | None = None,
    strict: bool = True,
) -> DataFrame:
    """(namespace, page_id, reduced_vector) for every page with an embedding, fitted per namespace.

    ``strict`` refuses a namespace with fewer embeddings than ``target_dim``; otherwise it is left
    out. ``batch_size`` only keeps its old check: the pass is not batched.
    """
    check_target(target_dim, batch_size)
    rows = vectors_with(vectors, ["embedding_vector"], namespace)
    bases = cut_lineage(fit(rows, "namespace", "embedding_vector", target_dim), "pca")
    if strict:
        counts = rows.groupBy("namespace").agg(F.count(F.lit(1)).alias("n"))  # one row per namespace
        small = [r["namespace"] for r in counts.filter(F.col("n") < target_dim).collect()]
        if small or (namespace is not None and bases.isEmpty()):
            raise ValueError(f"fewer than {target_dim} embeddings in {small or [namespace]}")
    return transform(rows, "namespace", "embedding_vector", bases, target_dim, "reduced_vector")


def reduce_table(vectors: DataFrame, **options) -> DataFrame:
    """The vector table with its reduced vectors filled in."""
    return set_reduced_vectors(vectors, reduce_vectors(vectors, **options))
