"""Splitting many nodes at once: k, centres, assignment, silhouette."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmap.functions import kmeans
from corpusmap.functions.grouped import (
    SUM_SCHEMA, add_up, by_group, float_lists, matrix, scan_with_tables, slots_to_table, sum_rows,
)
from corpusmap.functions.kmeans import nearest, silhouettes, slot_sums, unit_rows
from corpusmap.session import broadcast_if_small, cut_lineage


def split_count(docs: Column, leaf_target: int, max_k: int) -> Column:
    """How many clusters a node of ``docs`` pages is split into; 1 or less means a leaf."""
    return F.least(F.lit(max_k), F.ceil(docs / F.lit(leaf_target)).cast("int"))


def _drawn(rows: DataFrame, sizes: DataFrame, key: str, vector: str, seed: int) -> DataFrame:
    """(key, page_id, vector) of the rows that the batches of each node in ``sizes`` (key, n, k) are cut from.

    A row's draw comes from a hash of its id, so one scan finds them, at most a bounded number of each node.
    """
    bounded = broadcast_if_small(sizes.select(key, "n"))

    def run(batches):
        for batch in batches:
            out = []
            for name, part in by_group(batch, key):
                bound = kmeans.batch_bound(part.column("n")[0].as_py())
                near = kmeans.draws(part.column("page_id").to_numpy(), seed, name, kmeans.BATCH_TURN) <= bound
                out.append(part.filter(pa.array(near)) if not near.all() else part)
            yield from (part.select([key, "page_id", vector]) for part in out if part.num_rows)

    found = rows.select(key, "page_id", vector).join(bounded, key)
    kinds = dict(rows.dtypes)
    return found.mapInArrow(run, f"`{key}` {kinds[key]}, page_id bigint, `{vector}` {kinds[vector]}")


def _sorted_rows(group: pa.Table, vector: str) -> tuple[np.ndarray, np.ndarray]:
    ids = group.column("page_id").to_numpy()
    order = np.argsort(ids)
    return ids[order], matrix(group.column(vector).combine_chunks())[order]


def _centre_rows(key: str, names: list[str], centres: list[np.ndarray]) -> pa.Table:
    values = pa.array([c.tolist() for c in centres], pa.list_(pa.list_(pa.float64())))
    return pa.table([pa.array(names, pa.string()), values], names=[key, "values"])


def starting_centres(rows: DataFrame, sizes: DataFrame, key: str, vector: str, seed: int) -> DataFrame:
    """(key, values): first centres of each node in ``sizes`` (key, n, k), chosen in one task from its drawn rows,
    see ``kmeans.starting_centres``."""
    drawn = _drawn(rows, sizes, key, vector, seed).join(broadcast_if_small(sizes.select(key, "k")), key)

    def run(group: pa.Table) -> pa.Table:
        name, k = group.column(key)[0].as_py(), group.column("k")[0].as_py()
        ids, x = _sorted_rows(group, vector)
        some = np.sort(kmeans.batch_rows(ids, seed, name))
        return _centre_rows(key, [name], [kmeans.starting_centres(ids[some], x[some], k, seed, name)])

    return drawn.groupBy(key).applyInArrow(run, f"`{key}` string, values array<array<double>>")


def _slot_sum_scan(rows: DataFrame, key: str, vector: str, centres: DataFrame, table_bytes: int) -> DataFrame:
    """Counts and vector sums of the rows nearest to each centre."""

    def run(batches, tables):
        held: dict[str, list] = {}
        for batch in batches:
            for name, part in by_group(batch, key):
                if name in tables:
                    x = matrix(part.column(vector))
                    counts, sums = slot_sums(x, nearest(x, tables[name]), len(tables[name]))
                    if name in held:
                        held[name][0] += counts
                        held[name][1] += sums
                    else:
                        held[name] = [counts, sums]
        yield from (sum_rows(key, name, *held[name]) for name in held)

    partial = scan_with_tables(rows.select(key, vector), key, centres, table_bytes, run, SUM_SCHEMA.format(key=key))
    return add_up(partial, key)


def train(
    rows: DataFrame, sizes: DataFrame, key: str, vector: str, max_k: int, dims: int, max_iter: int = 50, seed: int = 42,
) -> DataFrame:
    """Centres (key, values) of all nodes in ``sizes``, as ``kmeans.fit`` finds them for the rows of one node.

    Mini-batch k-means: one scan draws BATCHES batches of BATCH_DOCS rows of each node by a hash of their ids. A task per
    node chooses first centres among them, lets every batch move them at falling rates, and goes on until they rest on
    the drawn rows (``max_iter`` rounds at most). Where a node has more rows than that, a second scan makes each centre the
    mean of all rows nearest to it. A task holds the drawn rows of one node, whatever the node's size.
    """
    drawn = cut_lineage(_drawn(rows, sizes, key, vector, seed), "drawn")
    start = starting_centres(drawn, sizes, key, vector, seed)

    def run(group: pa.Table, first: pa.Table) -> pa.Table:
        if not len(group) or not len(first):
            return _centre_rows(key, [], [])
        name = group.column(key)[0].as_py()
        ids, x = _sorted_rows(group, vector)
        some = np.sort(kmeans.batch_rows(ids, seed, name))
        centres = np.array(first.column("values")[0].as_py(), np.float64)
        return _centre_rows(key, [name], [kmeans.trained(ids[some], x[some], centres, max_iter, seed, name)])

    found = drawn.groupBy(key).cogroup(start.groupBy(key)).applyInArrow(run, f"`{key}` string, values array<array<double>>")
    centres = cut_lineage(found, "centres")
    large = sizes.filter(F.col("n") > kmeans.BATCH_DOCS * kmeans.BATCHES).select(key)
    if large.isEmpty():
        return centres
    large = broadcast_if_small(large)
    few = centres.join(large, key, "left_semi")
    sums = slots_to_table(_slot_sum_scan(rows.join(large, key, "left_semi"), key, vector, few, max_k * dims * 8), key)

    def settle(batches):
        for batch in batches:
            names, old, totals, counts = (batch.column(c).to_pylist() for c in (key, "values", "totals", "counts"))
            moved = [kmeans.settled(np.array(n), np.array(t, np.float64), np.array(o, np.float64)) for o, t, n in zip(old, totals, counts)]
            yield from _centre_rows(key, names, moved).to_batches()

    moved = few.join(sums.withColumnRenamed("values", "totals"), key).mapInArrow(settle, f"`{key}` string, values array<array<double>>")
    return cut_lineage(centres.join(large, key, "left_anti").unionByName(moved), "centres")


def assign(
    rows: DataFrame, key: str, vector: str, centres: DataFrame, table_bytes: int, label: str = "cluster"
) -> DataFrame:
    """``rows`` with the index of the nearest centre of their group."""
    columns, kinds = rows.columns, dict(rows.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in columns), f"`{label}` int"])

    def run(batches, tables):
        for batch in batches:
            for name, part in by_group(batch, key):
                if name in tables:
                    found = nearest(matrix(part.column(vector)), tables[name])
                    yield pa.RecordBatch.from_arrays(
                        [*(part.column(c) for c in columns), pa.array(found, pa.int32())], names=[*columns, label]
                    )

    return scan_with_tables(rows, key, centres, table_bytes, run, schema)


def cosine_silhouette(
    rows: DataFrame, key: str, vector: str, label: str, max_k: int, dims: int
) -> DataFrame:
    """(key, n, clusters, silhouette): the exact mean cosine silhouette of each group's labelling.

    Two scans: unit-vector sums per (group, cluster), then every row against its group's sums. Labels
    are 0 .. max_k - 1. The score is NULL where it is not defined: fewer than two clusters, or as
    many clusters as rows.
    """
    work = rows.select(key, vector, F.col(label).cast("int").alias("_label"))

    def sums(batches):
        held: dict[str, list] = {}
        for batch in batches:
            for name, part in by_group(batch, key):
                unit = unit_rows(matrix(part.column(vector)))
                counts, totals = slot_sums(unit, part.column("_label").to_numpy(), max_k)
                if name in held:
                    held[name][0] += counts
                    held[name][1] += totals
                else:
                    held[name] = [counts, totals]
        yield from (sum_rows(key, name, *held[name]) for name in held)

    totals = add_up(work.mapInArrow(sums, SUM_SCHEMA.format(key=key)), key)
    # the count travels as one more component of each cluster's sum
    packed = totals.withColumn("packed", F.concat(F.array(F.col("n").cast("double")), F.col("total")))
    tables = cut_lineage(slots_to_table(packed, key, "packed"), "silhouette")

    def scores(batches, held):
        totals_by_key: dict[str, list] = {}
        for batch in batches:
            for name, part in by_group(batch, key):
                unit = unit_rows(matrix(part.column(vector)))
                table = held[name]
                score = silhouettes(unit, part.column("_label").to_numpy(), table[:, 0], table[:, 1:])
                entry = totals_by_key.setdefault(name, [0, 0.0])
                entry[0] += len(unit)
                entry[1] += score.sum()
        names = list(totals_by_key)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(names, pa.string()),
                pa.array([totals_by_key[g][0] for g in names], pa.int64()),
                pa.array([totals_by_key[g][1] for g in names], pa.float64()),
            ],
            names=[key, "n", "score"],
        )

    partial = scan_with_tables(
        work, key, tables, max_k * (dims + 1) * 8, scores, f"{key} string, n bigint, score double"
    )
    clusters = tables.select(key, F.size(F.filter("counts", lambda n: n > 0)).alias("clusters"))
    scored = partial.groupBy(key).agg(F.sum("n").alias("n"), F.sum("score").alias("_score")).join(clusters, key)
    defined = (F.col("clusters") >= 2) & (F.col("clusters") < F.col("n"))
    return scored.select(
        key, "n", "clusters", F.when(defined, F.col("_score") / F.col("n")).alias("silhouette")
    )
