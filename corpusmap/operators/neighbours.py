"""The nearest pages within a cluster, exact, by pivots and ball bounds.

Vectors are taken as points on the unit sphere, where cosine distance is half the squared distance. A large cluster is
cut into cells around pivots and each cell into shells by distance to its pivot. Every block first searches itself; what
its pages have found by then, and how far the other blocks lie at least, tells which blocks can still hold a nearer page.
Only those are sent there, nearest first, and stream past the pages that ask, which keep their best k. Blocks grow with
their cluster up to a fixed size and travel packed, so that where nothing can be skipped a page is sent once for each of a
few dozen blocks, or for each BLOCK_ROWS pages of a very large cluster.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmap.functions.grouped import by_group, map_small_groups, matrix, scan_with_tables
from corpusmap.functions.kmeans import unit_rows
from corpusmap.functions.ranking import first_n_per_group
from corpusmap.session import arrow_batches, broadcast_if_small, cut_lineage

# Fixed value: neighbours per page.
NEIGHBOURS = 30
BLOCK_ROWS = 2000
MAX_PIVOTS = 512
FINE = 2048  # distances to a pivot are counted in steps of 1 / FINE
SLACK = 1e-5  # rounding of a distance of nearly equal points
GRAIN = 1e-11  # more than a distance is rounded by
COLUMNS = 2048  # offers compared at a time
BLOCKS = 32  # a cluster has about so many blocks until they are of BLOCK_ROWS pages
BATCH_BYTES = 16 << 20
FAR = np.iinfo(np.int64).max
BLOCK = ["node", "pivot", "shell", "part"]
ROW = "node string, pivot int, shell int, part int, page_id bigint"
STATE = "ids array<bigint>, gaps array<double>, compared bigint"


def points(x: np.ndarray) -> np.ndarray:
    """Unit vectors with one more coordinate, in which all zero vectors lie: at distance 1 from every other one."""
    unit = unit_rows(x.astype(np.float64))
    return np.column_stack([unit, ~unit.any(1)])


def rounded(minus_cosine: np.ndarray) -> np.ndarray:
    """Cosine distances, rounded so that equal vectors tie whatever block they are met in."""
    return np.maximum(np.round(1.0 + minus_cosine, 12), 0.0)


def lengths_between(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2.0 - 2.0 * (a @ b.T), 0.0))


class Asking:
    """The pages of a block with the best k found so far."""

    def __init__(self, ids: np.ndarray, at: np.ndarray, k: int):
        self.ids, self.at, self.k = ids, at, k
        self.best = np.full((len(ids), k), FAR)
        self.gaps = np.full((len(ids), k), np.inf)
        self.compared = np.zeros(len(ids), np.int64)

    def offer(self, ids: np.ndarray, at: np.ndarray) -> None:
        """Let offered pages pass; pages that the ball around them is too far from are not compared."""
        for a in range(0, len(ids), COLUMNS):
            part, there = ids[a : a + COLUMNS], at[a : a + COLUMNS]
            middle = there.mean(0)
            radius = np.sqrt(((there - middle) ** 2).sum(1).max())
            away = np.sqrt(((self.at - middle) ** 2).sum(1)) - radius
            near = np.flatnonzero(away <= np.sqrt(2 * self.gaps[:, -1]) + SLACK)
            if not len(near):
                continue
            self.compared[near] += len(part)
            alike = self.at[near] @ there.T
            most = self.gaps[near, -1]
            short = np.flatnonzero(np.isinf(most))
            if len(short) and len(part) > self.k:  # the page itself may be among its first k + 1
                most[short] = rounded(np.partition(-alike[short], self.k, axis=1)[:, self.k])
            row, column = np.nonzero(alike >= (1.0 - most - GRAIN)[:, None])
            gap = rounded(-alike[row, column])
            kept = (gap <= most[row]) & (self.ids[near[row]] != part[column])
            row, column, gap = row[kept], column[kept], gap[kept]
            if not len(row):
                continue
            touched = np.unique(row)
            held = near[touched]
            rows = np.concatenate([np.repeat(touched, self.k), row])
            found = np.concatenate([self.gaps[held].ravel(), gap])
            pages = np.concatenate([self.best[held].ravel(), part[column]])
            order = np.lexsort((pages, found, rows))
            rows = rows[order]
            first = np.flatnonzero(np.diff(rows, prepend=-1))
            rank = np.arange(len(rows)) - np.repeat(first, np.diff(np.append(first, len(rows))))
            keep = order[rank < self.k]
            self.gaps[held] = found[keep].reshape(-1, self.k)
            self.best[held] = pages[keep].reshape(-1, self.k)

    def columns(self) -> list[pa.Array]:
        known = np.isfinite(self.gaps)
        offsets = pa.array(np.concatenate([[0], np.cumsum(known.sum(1))]).astype(np.int32))
        return [
            pa.ListArray.from_arrays(offsets, pa.array(self.best[known])), pa.ListArray.from_arrays(offsets, pa.array(self.gaps[known])),
            pa.array(self.compared),
        ]

    def restore(self, ids: list, gaps: list, compared: np.ndarray) -> None:
        for i, (pages, found) in enumerate(zip(ids, gaps)):
            self.best[i, : len(pages)], self.gaps[i, : len(pages)] = pages, found
        self.compared = compared.copy()


def _blocks(rows: DataFrame, vector: str, block_rows: int) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """(rows with their block, pivots per cluster, blocks of large clusters, vector width)."""
    sizes = cut_lineage(rows.groupBy("node").agg(F.count(F.lit(1)).alias("n")), "sizes")
    block = F.greatest(F.lit(block_rows), F.least(F.ceil(F.col("n") / BLOCKS), F.lit(BLOCK_ROWS))).cast("int")
    pivots = F.least(F.ceil(F.col("n") / F.col("block")), F.lit(MAX_PIVOTS)).cast("int")
    large = sizes.filter(F.col("n") > block_rows).withColumn("block", block).select("node", "block", pivots.alias("pivots"))
    large = broadcast_if_small(large)
    one = rows.join(large.select("node"), "node", "left_anti").select(
        *[(F.lit(0) if c in BLOCK else F.col(c)).alias(c) for c in ("node", "pivot", "shell", "part", "page_id", vector) if c != "node"], "node"
    )
    several = rows.join(large, "node")
    order = [F.xxhash64("page_id"), "page_id"]
    first = first_n_per_group(several, ["node"], order, MAX_PIVOTS, rank="rank").filter(F.col("rank") <= F.col("pivots"))
    listed = first.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("rank", vector))).alias("_p"))
    tables = cut_lineage(listed.select("node", F.transform(f"_p.{vector}", lambda v: v.cast("array<double>")).alias("values")), "pivots")
    width = tables.select(F.max(F.size(F.col("values")[0]))).first()[0] or 0
    kind = dict(rows.dtypes)[vector]

    def place(batches, held):
        for batch in batches:
            for name, part in by_group(batch, "node"):
                gap = lengths_between(points(matrix(part.column(vector))), points(held[name]))
                own = gap.argmin(1)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("node", "page_id", vector)), pa.array(own, pa.int32()), pa.array(gap[np.arange(len(own)), own])],
                    names=["node", "page_id", vector, "pivot", "gap"],
                )

    schema = f"node string, page_id bigint, `{vector}` {kind}, pivot int, gap double"
    placed = cut_lineage(scan_with_tables(several.select("node", "page_id", vector), "node", tables, MAX_PIVOTS * width * 8, place, schema), "cells")
    step = F.floor(F.col("gap") * FINE).cast("int")
    cell = Window.partitionBy("node", "pivot")  # at most a row for each step of a cell
    counts = placed.groupBy("node", "pivot", step.alias("step")).agg(F.count(F.lit(1)).alias("n"), F.min("gap").alias("lo"), F.max("gap").alias("hi"))
    before = F.sum("n").over(cell.orderBy("step")) - F.col("n")
    total = F.sum("n").over(cell)
    shells = F.greatest(F.floor(total / F.col("block")), F.lit(1))
    steps = counts.join(large.select("node", "block"), "node").select("*", F.floor(before * shells / total).cast("int").alias("shell"))
    blocks = cut_lineage(steps.groupBy("node", "pivot", "shell").agg(
        F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("step").alias("step"),
        F.ceil(F.sum("n") / (2 * F.first("block"))).cast("int").alias("parts"),
    ), "blocks")
    cells = blocks.groupBy("node", "pivot").agg(F.array_sort(F.collect_list(F.struct("step", "shell", "parts"))).alias("_shells"))
    dealt = placed.withColumn("step", step).join(broadcast_if_small(cut_lineage(cells, "shells")), ["node", "pivot"])
    own = F.element_at(F.filter("_shells", lambda s: s["step"] <= F.col("step")), -1)
    part = F.pmod(F.xxhash64("page_id"), F.col("_own.parts")).cast("int")
    dealt = dealt.withColumn("_own", own).select("node", "page_id", vector, "pivot", F.col("_own.shell").alias("shell"), part.alias("part"))
    return cut_lineage(one.unionByName(dealt), "placed"), tables, blocks, width


def _needs(found: DataFrame, tables: DataFrame, blocks: DataFrame, vector: str, width: int, k: int) -> DataFrame:
    """(block, to_pivot, to_shell, bound): the blocks that may hold one of the k nearest of some page of a block."""
    listed = blocks.groupBy("node").agg(F.flatten(F.array_sort(F.collect_list(
        F.array(F.col("pivot").cast("double"), F.col("shell").cast("double"), "lo", "hi", F.col("n").cast("double"))))).alias("blocks"))
    line = max(width, 2)
    filled = F.concat("blocks", F.array_repeat(F.lit(0.0), F.pmod(-F.size("blocks"), F.lit(line)).cast("int")))
    lines = F.transform(F.sequence(F.lit(0), (F.size(filled) / line).cast("int") - 1), lambda i: F.slice(filled, i * line + 1, line))
    wide = F.transform("values", lambda v: F.concat(v, F.array_repeat(F.lit(0.0), line - width)) if line > width else v)
    head = F.array(F.concat(F.array(F.size("values").cast("double"), F.size("blocks").cast("double")), F.array_repeat(F.lit(0.0), line - 2)))
    packed = cut_lineage(tables.join(listed, "node").select("node", F.concat(head, wide, lines).alias("values")), "bounds")
    size = packed.select(F.max(F.size("values"))).first()[0] or 0

    def run(batches, held):
        for batch in batches:
            for name, rows in by_group(batch, "node"):
                if name not in held:
                    continue
                table = held[name]
                n_pivots, n_numbers = int(table[0, 0]), int(table[0, 1])
                pivots = points(table[1 : 1 + n_pivots, :width])
                block = table[1 + n_pivots :].ravel()[:n_numbers].reshape(-1, 5)
                lo, hi, at = block[:, 2], block[:, 3], block[:, 0].astype(int)
                away = lengths_between(points(matrix(rows.column(vector))), pivots)
                reach = np.sqrt(2 * rows.column("reach").to_numpy())
                full = block[:, 4] > k
                for a in range(0, len(block), COLUMNS):
                    some = slice(a, a + COLUMNS)
                    most = np.where(full[some], away[:, at[some]] + hi[some], np.inf)
                    reach = np.minimum(reach, most.min(1))
                codes = np.column_stack([rows.column(c).to_numpy() for c in ("pivot", "shell", "part")])
                own, which = np.unique(codes, axis=0, return_inverse=True)
                order = np.argsort(which.ravel(), kind="stable")
                first = np.searchsorted(which.ravel()[order], np.arange(len(own)))
                out = []
                for a in range(0, len(block), COLUMNS):
                    some = slice(a, a + COLUMNS)
                    near = away[:, at[some]]
                    least = np.maximum(np.maximum(near - hi[some], lo[some] - near), 0.0)
                    may = least <= reach[:, None] + SLACK
                    bound = np.minimum.reduceat(np.where(may, least, np.inf)[order], first)
                    asker, offered = np.nonzero(np.isfinite(bound))
                    out.append((own[asker], block[some][offered, :2], bound[asker, offered]))
                asking, offered, bound = (np.concatenate(c) for c in zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(bound), pa.string()), *(pa.array(asking[:, i], pa.int32()) for i in range(3)),
                     *(pa.array(offered[:, i], pa.int32()) for i in range(2)), pa.array(bound)],
                    names=[*BLOCK, "to_pivot", "to_shell", "bound"],
                )

    reach = F.when(F.size("gaps") == k, F.get("gaps", F.lit(k - 1))).otherwise(F.lit(2.0))
    rows = found.select(*BLOCK, vector, reach.alias("reach"))
    schema = "node string, pivot int, shell int, part int, to_pivot int, to_shell int, bound double"
    needs = scan_with_tables(rows, "node", packed, size * line * 8, run, schema)
    return needs.groupBy(*BLOCK, "to_pivot", "to_shell").agg(F.min("bound").alias("bound"))


def neighbour_search(rows: DataFrame, vector: str, k: int = NEIGHBOURS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(node, page_id, ids, gaps, compared): the k nearest other pages of the same node by cosine distance, ties by id,
    and how many pages each was compared with. Ids are unique within a node.

    A node of up to ``block_rows`` pages is one block. Of a larger one, whose blocks have that many pages or more, up to
    twice BLOCK_ROWS, a task holds the pages of one block that ask and a batch of offers; no candidates are shuffled. How
    much is skipped depends on how the vectors cluster: at worst every block is sent to every other one.
    """
    kind = dict(rows.dtypes)[vector]
    number = np.dtype(np.float64 if kind == "array<double>" else np.float32)
    placed, tables, blocks, width = _blocks(rows.select("node", "page_id", vector), vector, block_rows)
    names = [*BLOCK, "page_id", vector, "ids", "gaps", "compared"]

    def within(group: pa.Table) -> pa.Table:
        ids, at = group.column("page_id").to_numpy(), points(matrix(group.column(vector).combine_chunks()))
        asking = Asking(ids, at, k)
        asking.offer(ids, at)
        return pa.table([*(group.column(c) for c in names[:6]), *asking.columns()], names=names)

    schema = f"{ROW}, `{vector}` {kind}, {STATE}"
    found = cut_lineage(map_small_groups(placed.select(*names[:6]), BLOCK, ["page_id"], within, schema), "within")
    done = found.join(broadcast_if_small(tables.select("node")), "node", "left_anti").select("node", "page_id", "ids", "gaps", "compared")
    if blocks.isEmpty():
        return done
    open_ = found.join(broadcast_if_small(tables.select("node")), "node", "left_semi")
    needs = cut_lineage(_needs(open_, tables, blocks, vector, width, k), "needs")

    def pack(group: pa.Table) -> pa.Table:
        x = matrix(group.column(vector).combine_chunks(), number)
        most = max(1, BATCH_BYTES // (8 * max(x.nbytes // len(x), 1)))  # pages of a pack
        cuts = range(0, len(x), most)
        ids = group.column("page_id").to_numpy()
        same = {c: pa.array([group.column(c)[0].as_py()] * len(cuts), pa.string() if c == "node" else pa.int32()) for c in BLOCK}
        return pa.table({
            **same, "first": pa.array([ids[a] for a in cuts], pa.int64()),
            "their_ids": pa.array([ids[a : a + most].tobytes() for a in cuts], pa.binary()),
            "their_x": pa.array([x[a : a + most].tobytes() for a in cuts], pa.binary()),
        })

    theirs = "first bigint, their_ids binary, their_x binary"
    large = placed.select(*names[:6]).join(broadcast_if_small(tables.select("node")), "node", "left_semi")
    packs = map_small_groups(large, BLOCK, ["page_id"], pack, f"node string, pivot int, shell int, part int, {theirs}")
    packs = packs.withColumnsRenamed({"pivot": "to_pivot", "shell": "to_shell", "part": "own_part"})
    offers = cut_lineage(packs, "packs").join(needs, ["node", "to_pivot", "to_shell"]).filter(  # a block's own part has been searched
        ~((F.col("to_pivot") == F.col("pivot")) & (F.col("to_shell") == F.col("shell")) & (F.col("own_part") == F.col("part")))
    )
    asked = open_.select(*names, F.lit(-1.0).alias("bound"), F.lit(False).alias("offered"))
    offers = offers.select(*BLOCK, F.col("first").alias("page_id"), "their_ids", "their_x", "bound", F.lit(True).alias("offered"))
    both = asked.unionByName(offers, allowMissingColumns=True)
    arranged = both.repartition(*BLOCK).sortWithinPartitions(*BLOCK, "offered", "bound", "page_id")

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key, asks = None, None, []

        def start() -> Asking:
            rows = pa.Table.from_batches(asks).combine_chunks()
            asking = Asking(rows.column("page_id").to_numpy(), points(matrix(rows.column(vector).combine_chunks())), k)
            asking.restore(rows.column("ids").to_pylist(), rows.column("gaps").to_pylist(), rows.column("compared").to_numpy())
            asks.clear()
            return asking

        def finished(asking: Asking) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([key[0]] * len(asking.ids), pa.string()), pa.array(asking.ids), *asking.columns()], names=["node", "page_id", "ids", "gaps", "compared"]
            )

        for batch in batches:
            codes = np.column_stack([
                batch.column("node").dictionary_encode().indices.to_numpy(), *(batch.column(c).to_numpy() for c in BLOCK[1:]),
                batch.column("offered").to_numpy(zero_copy_only=False),
            ])
            cuts = [0, *(np.flatnonzero((codes[1:] != codes[:-1]).any(1)) + 1).tolist(), len(codes)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                here = tuple(part.column(c)[0].as_py() for c in BLOCK)
                if here != key:
                    if asks:
                        held = start()
                    if held is not None:
                        yield finished(held)
                    held, key = None, here
                if not part.column("offered")[0].as_py():
                    asks.append(part)
                    continue
                if asks:
                    held = start()
                for ids, x in zip(part.column("their_ids"), part.column("their_x")):
                    ids = np.frombuffer(ids.as_buffer(), np.int64)
                    held.offer(ids, points(np.frombuffer(x.as_buffer(), number).reshape(len(ids), -1)))
        if asks:
            held = start()
        if held is not None:
            yield finished(held)

    with arrow_batches(rows.sparkSession, BATCH_BYTES):
        searched = cut_lineage(arranged.mapInArrow(stream, f"node string, page_id bigint, {STATE}"), "searched")
    return done.unionByName(searched)


def _keyed(rows: DataFrame, keys: list[str], vector: str, k: int) -> tuple[DataFrame, DataFrame]:
    """(rows to search, all rows) with ``node`` for the keys. Of the copies of one vector only the first k + 1 are
    searched: no later one can be among the k nearest of any page, and its own neighbours are the first k copies."""
    rows = rows.select(F.to_json(F.struct(*keys)).alias("node"), "page_id", vector)
    return cut_lineage(first_n_per_group(rows, ["node", vector], ["page_id"], k + 1, rank="_copy"), "searched"), rows


def _key_schema(rows: DataFrame, keys: list[str]) -> str:
    return ", ".join(f"`{c}` {dict(rows.dtypes)[c]}" for c in keys)


def cluster_neighbours(
    rows: DataFrame, keys: list[str], vector: str, k: int = NEIGHBOURS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """(keys, page_id, neighbour_id, distance, rank): the k nearest pages of the same cluster by cosine distance, exact,
    ties by id; see ``neighbour_search`` for how large clusters are searched."""
    schema = _key_schema(rows, keys)
    searched, rows = _keyed(rows, keys, vector, k)
    found = neighbour_search(searched, vector, k, block_rows)
    pairs = found.select("node", "page_id", F.posexplode(F.arrays_zip("ids", "gaps")).alias("_rank", "_n"))
    pairs = pairs.select("node", "page_id", F.col("_n.ids").alias("neighbour_id"), F.col("_n.gaps").alias("distance"), (F.col("_rank") + 1).alias("rank"))
    many = searched.groupBy("node", vector).agg(
        F.array_sort(F.collect_list(F.struct(F.col("_copy").alias("rank"), F.col("page_id").alias("neighbour_id")))).alias("_copies")
    ).filter(F.size("_copies") > k).withColumn("_copies", F.slice("_copies", 1, k))
    later = rows.select("node", "page_id", vector).join(searched.select("node", "page_id"), ["node", "page_id"], "left_anti")
    copies = later.join(broadcast_if_small(cut_lineage(many, "copies")), ["node", vector]).select("node", "page_id", F.inline("_copies"))
    both = pairs.unionByName(copies.withColumn("distance", F.lit(0.0)).select(*pairs.columns))
    return both.withColumn("_key", F.from_json("node", schema)).select("_key.*", "page_id", "neighbour_id", "distance", "rank")


def pairs_compared(rows: DataFrame, keys: list[str], vector: str, k: int = NEIGHBOURS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(keys, pages, compared): searched pages of each cluster and how often two of them were compared."""
    searched, _ = _keyed(rows, keys, vector, k)
    found = neighbour_search(searched, vector, k, block_rows).groupBy("node").agg(F.count(F.lit(1)).alias("pages"), F.sum("compared").alias("compared"))
    return found.withColumn("_key", F.from_json("node", _key_schema(rows, keys))).select("_key.*", "pages", "compared")
