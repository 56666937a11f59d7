"""Spectral layout of neighbour graphs.

The layout is given by the leading eigenvectors of the degree-scaled link matrix S, the trivial one aside. They are found
by block iteration with conjugate directions: every round applies S once to a few columns, a join of the edges with the
columns and a sum per page, and picks the best combination of the present columns X, their residuals R and the last
directions P. What that takes of all pages of a cluster are sums of products of a dozen columns; the combination is
worked out from them alone, cluster by cluster.

A graph of up to TASK_PAGES pages goes through the same rounds within one task, from the lists of its neighbours. Those of
larger ones, which no task holds, are jobs over the edge table; nothing that grows with the pages is broadcast.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmap.functions.grouped import SUM_SCHEMA, add_up, by_group, float_lists, matrix, scan_with_tables, slots_to_table, sum_rows
from corpusmap.session import broadcast_if_small, cut_lineage

WIDTH = 6  # columns carried; those beyond the wanted ones speed up the others
TOLERANCE = 1e-7  # length of a wanted column's residual at rest
ROUNDS = 200
NOISE = 0.1
TASK_PAGES = 100_000  # with 30 neighbours each about 250 MB of a task
TASK_LINKS = 40  # neighbours of a page up to which that holds
LINKS_AT_ONCE = 1 << 19


def links(neighbours: DataFrame) -> DataFrame:
    """(node, a, b) both ways, once each, from (node, page_id, neighbour_id); ranged by page for the sums per page."""
    one = neighbours.select("node", F.col("page_id").alias("a"), F.col("neighbour_id").alias("b"))
    both = one.unionByName(one.select("node", F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    return cut_lineage(both.repartitionByRange("node", "a").sortWithinPartitions("node", "a"), "links")


def _column_sums(values: Column, width: int) -> list[Column]:
    return [F.sum(F.get(values, F.lit(i))).alias(f"s{i}") for i in range(width)]


def _applied(rows: DataFrame, edges: DataFrame, column: str) -> DataFrame:
    """``rows`` (node, page_id, root, ..) with ``out``: S times the column block; ``root`` is the root of the degree, of
    which a link to itself is part."""
    scaled = rows.select("node", F.col("page_id").alias("b"), F.transform(column, lambda v: v / F.col("root")).alias("_v"))
    # merged, as a broadcast would go through the driver in every round
    pushed = edges.join(scaled.hint("merge"), ["node", "b"]).groupBy("node", F.col("a").alias("page_id")).agg(*_column_sums(F.col("_v"), WIDTH))
    around = F.array(*[F.coalesce(f"s{i}", F.lit(0.0)) for i in range(WIDTH)])
    joined = rows.join(pushed.hint("merge"), ["node", "page_id"], "left")
    out = F.zip_with(around, column, lambda s, own: (s + own / F.col("root")) / F.col("root"))
    return joined.select(*rows.columns, out.alias("out"))


def products(z: np.ndarray, az: np.ndarray, t: np.ndarray) -> np.ndarray:
    """What a round needs to know of all pages, see ``combination``."""
    return np.vstack([z.T @ z, z.T @ az, az.T @ az, t @ z, t @ az, np.full(z.shape[1], t @ t)])


def turned(z: np.ndarray, az: np.ndarray, t: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, ...]:
    """The next columns (x, p, ax, ap, r) of some pages."""
    size = 3 * WIDTH
    take, way, theta, t_x, t_ax = table[:size], table[size : 2 * size], table[2 * size], table[2 * size + 1], table[2 * size + 2]
    x, ax = z @ take - t[:, None] * t_x, az @ take - t[:, None] * t_ax
    return x, z @ way, ax, az @ way, ax - x * theta


def columns_of_graph(ids: np.ndarray, near: pa.ListArray, start: np.ndarray) -> np.ndarray:
    """``spectral_columns`` of one graph, the rows of ``near`` being the neighbours of ``ids``."""
    n = len(ids)
    order = np.argsort(ids)
    offsets = near.offsets.to_numpy()
    theirs = near.values.to_numpy()[offsets[0] : offsets[-1]]
    a = np.repeat(np.arange(n), np.diff(offsets))
    b = order[np.searchsorted(ids, theirs, sorter=order)]
    own = np.arange(n) * (n + 1)
    code = np.unique(np.concatenate([a * n + b, b * n + a, own]))  # a link to itself is part of each page
    b = code % n
    first = np.searchsorted(code, np.arange(n + 1) * n)
    root = np.sqrt(np.diff(first))
    cuts = [0]
    while cuts[-1] < n:
        cuts.append(max(int(np.searchsorted(first, first[cuts[-1]] + LINKS_AT_ONCE, "right")) - 1, cuts[-1] + 1))

    def applied(v: np.ndarray) -> np.ndarray:
        out = np.empty_like(v)
        for k in range(v.shape[1]):
            scaled = v[:, k] / root
            for low, high in zip(cuts, cuts[1:]):
                out[low:high, k] = np.add.reduceat(scaled[b[first[low] : first[high]]], first[low:high] - first[low])
        return out / root[:, None]

    r = np.array(start, np.float64)
    x, p, ax, ap = (np.zeros_like(r) for _ in range(4))
    for _ in range(ROUNDS):
        z, az = np.hstack([x, r, p]), np.hstack([ax, applied(r), ap])
        table, rest = combination(products(z, az, root))
        x, p, ax, ap, r = turned(z, az, root, table)
        if rest <= TOLERANCE:
            break
    return x


def task_columns(rows: DataFrame, neighbours: DataFrame, start: str) -> DataFrame:
    """(node, page_id, x) like ``spectral_columns``, each graph in one task."""
    lists = neighbours.groupBy("node", "page_id").agg(F.collect_list("neighbour_id").alias("near"))
    lists = rows.select("node", "page_id", start).join(lists, ["node", "page_id"], "left")
    lists = lists.withColumn("near", F.coalesce("near", F.array().cast("array<bigint>")))

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("page_id").combine_chunks()
        ids = group.column("page_id").to_numpy()
        near, first = (group.column(c).combine_chunks() for c in ("near", start))
        found = columns_of_graph(ids, near, matrix(first))
        return pa.table({"node": group.column("node"), "page_id": group.column("page_id"), "x": float_lists(found, pa.float64())})

    return lists.groupBy("node").applyInArrow(run, "node string, page_id bigint, x array<double>")


def combination(sums: np.ndarray) -> tuple[np.ndarray, float]:
    """The table of a cluster's next round and its largest wanted residual, from its sums of products.

    Z has the columns X, R and P, AZ the same after S. The rows of ``sums`` are Z'Z, Z'AZ, AZ'AZ, t'Z, t'AZ and t't, t the
    trivial vector. The table has the weights of Z in the next X and P, the eigenvalues, and what of t is left in X and AX.
    """
    size = 3 * WIDTH
    gram, cross, square = sums[:size], sums[size : 2 * size], sums[2 * size : 3 * size]
    t_z, t_az, t_t = sums[3 * size], sums[3 * size + 1], sums[3 * size + 2, 0]
    # t leaves every column: Z - t (t'Z) / t't
    gram = gram - np.outer(t_z, t_z) / t_t
    cross = cross - np.outer(t_z, t_az) / t_t
    square = square - np.outer(t_az, t_az) / t_t
    length = np.sqrt(np.maximum(np.diag(gram), 0))
    used = length > 1e-150
    scale = np.where(used, 1 / np.where(used, length, 1), 0)
    gram, mixed = gram * np.outer(scale, scale), (cross + cross.T) / 2 * np.outer(scale, scale)
    weight, axes = np.linalg.eigh((gram + gram.T) / 2)
    good = weight > 1e-10 * weight.max()
    base = axes[:, good] / np.sqrt(weight[good])
    values, vectors = np.linalg.eigh(base.T @ mixed @ base)
    values, vectors = values[::-1][:WIDTH], vectors[:, ::-1][:, :WIDTH]
    take = np.zeros((size, WIDTH))
    take[:, : len(values)] = scale[:, None] * (base @ vectors)
    theta = np.zeros(WIDTH)
    theta[: len(values)] = values
    turn = take.copy()
    turn[:WIDTH] = 0
    left = np.einsum("ij,ik,kj->j", take, square, take) - 2 * theta * np.einsum("ij,ik,kj->j", take, (cross + cross.T) / 2, take) + theta**2
    left = np.sqrt(np.maximum(left, 0))
    rows = np.vstack([take, turn, theta, t_z @ take / t_t, t_az @ take / t_t])
    return rows, float(left[:3].max())


def spectral_columns(rows: DataFrame, edges: DataFrame, start: str) -> DataFrame:
    """(node, page_id, x): the leading eigenvectors of each node's graph, ``WIDTH`` columns by falling eigenvalue, of
    which the first three are at rest. ``rows`` (node, page_id, ``start``: first columns, array of WIDTH doubles)."""
    degree = edges.groupBy("node", F.col("a").alias("page_id")).agg(F.count(F.lit(1)).alias("n"))
    none = F.array_repeat(F.lit(0.0), WIDTH)
    root = F.sqrt(F.coalesce("n", F.lit(0)) + 1.0)
    state = rows.join(degree, ["node", "page_id"], "left").select(
        "node", "page_id", root.alias("root"), *[(F.col(start) if c == "r" else none).alias(c) for c in ("x", "p", "ax", "ap", "r")]
    )
    # the first round has its columns in R, so that one way of applying S serves all rounds
    state = cut_lineage(_applied(state, edges, "r").withColumnRenamed("out", "ar"), "columns")
    table_rows = 6 * WIDTH + 3

    def summed(batches):
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, part in by_group(batch, "node"):
                z = np.hstack([matrix(part.column(c)) for c in ("x", "r", "p")])
                az = np.hstack([matrix(part.column(c)) for c in ("ax", "ar", "ap")])
                t = part.column("root").to_numpy()
                own = products(z, az, t)
                held[name] = held[name] + own if name in held else own
        yield from (sum_rows("node", name, np.ones(len(own)), own) for name, own in held.items())

    def solve(batches):
        for batch in batches:
            names, sums = batch.column("node").to_pylist(), batch.column("values").to_pylist()
            found = [combination(np.array(s)) for s in sums]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names), pa.array([f[0].tolist() for f in found], pa.list_(pa.list_(pa.float64()))), pa.array([f[1] for f in found])],
                names=["node", "values", "rest"],
            )

    def turn(batches, tables):
        for batch in batches:
            for name, part in by_group(batch, "node"):
                z = np.hstack([matrix(part.column(c)) for c in ("x", "r", "p")])
                az = np.hstack([matrix(part.column(c)) for c in ("ax", "ar", "ap")])
                lists = [float_lists(v, pa.float64()) for v in turned(z, az, part.column("root").to_numpy(), tables[name])]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("node", "page_id", "root")), *lists], names=["node", "page_id", "root", "x", "p", "ax", "ap", "r"])

    wide = "array<double>"
    schema = f"node string, page_id bigint, root double, x {wide}, p {wide}, ax {wide}, ap {wide}, r {wide}"
    for _ in range(ROUNDS):
        sums = slots_to_table(add_up(state.mapInArrow(summed, SUM_SCHEMA.format(key="node")), "node"), "node").select("node", "values")
        tables = cut_lineage(sums.mapInArrow(solve, "node string, values array<array<double>>, rest double"), "combinations")
        moved = scan_with_tables(state, "node", tables, table_rows * WIDTH * 8, turn, schema)
        if (tables.select(F.max("rest")).first()[0] or 0.0) <= TOLERANCE:
            break
        state = cut_lineage(_applied(moved, edges, "r").withColumnRenamed("out", "ar"), "columns")
    return cut_lineage(moved.select("node", "page_id", "x"), "layout")


def noise(seed: int) -> Column:
    """A number about 0 for each page and column, from its id."""
    one = F.xxhash64("page_id", F.lit(seed)) / F.lit(float(1 << 63))
    return one.cast("double")


def neighbour_coordinates(rows: DataFrame, neighbours: DataFrame, guess: str, dimensions: int) -> DataFrame:
    """(node, page_id, three_d_vector): spectral layout of each node's neighbour graph.

    The columns are centred against the trivial vector, orthogonal, as long as the root of the node's pages, and the entry
    of each that is largest in size is positive. ``guess`` holds first coordinates (array), such as principal components.
    """
    scale = rows.groupBy("node").agg(*[F.stddev_pop(F.get(F.col(guess), F.lit(i))).alias(f"d{i}") for i in range(dimensions)], F.count(F.lit(1)).alias("n"))
    scale = cut_lineage(scale, "spread")
    first = []
    for i in range(WIDTH):
        known = F.coalesce(F.get(F.col(guess), F.lit(i)).cast("double") / F.nullif(F.col(f"d{i}"), F.lit(0.0)), F.lit(0.0)) if i < dimensions else F.lit(0.0)
        first.append(known + noise(i) * (NOISE if i < dimensions else 1.0))
    begun = rows.join(broadcast_if_small(scale), "node").select("node", "page_id", F.array(*first).alias("_first"))
    most = neighbours.groupBy("node", "page_id").agg(F.count(F.lit(1)).alias("k")).groupBy("node").agg(F.max("k").alias("k"))
    held = F.col("n") * F.greatest(F.col("k"), F.lit(TASK_LINKS)) <= TASK_PAGES * TASK_LINKS
    sized = cut_lineage(scale.join(most, "node", "left").select("node", F.coalesce(held, F.col("n") <= TASK_PAGES).alias("held")), "sized")
    wide = broadcast_if_small(sized.filter("NOT held").select("node"))
    found = task_columns(begun.join(wide, "node", "left_anti"), neighbours.join(wide, "node", "left_anti"), "_first")
    if not wide.isEmpty():
        spread = spectral_columns(begun.join(wide, "node", "left_semi"), links(neighbours.join(wide, "node", "left_semi")), "_first")
        found = found.unionByName(spread)
    found = cut_lineage(found, "columns")
    columns = [F.get(F.col("x"), F.lit(i)) for i in range(dimensions)]
    signs = found.groupBy("node").agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.max_by(F.signum(c), F.struct(F.abs(c), -F.col("page_id"))) for c in columns]).alias("signs"),
        F.array(*[F.sqrt(F.sum(c * c)) for c in columns]).alias("sizes"),
    )
    joined = found.join(broadcast_if_small(cut_lineage(signs, "signs")), "node")
    out = [F.coalesce(c * F.get("signs", F.lit(i)) * F.sqrt("n") / F.nullif(F.get("sizes", F.lit(i)), F.lit(0.0)), F.lit(0.0)).cast("float") for i, c in enumerate(columns)]
    return joined.select("node", "page_id", F.array(*out).alias("three_d_vector"))
