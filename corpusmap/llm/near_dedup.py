"""Near-duplicate texts by MinHash signatures, joined under a Hamming distance, and confirmed on full sets."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmap.llm import chunks as C
from corpusmap.llm import words as W
from corpusmap.llm.shared import give_back, tidy
from corpusmap.session import broadcast_if_small, cut_lineage

U64 = np.uint64
NODES_PER_CHUNK = 1 << 15
# Every two chunks exchange packed rows, so chunks of fewer nodes than this cost more than they spread.
LEAST_NODES_PER_CHUNK = 1 << 8
# Rows of one key that are compared by one task; the rows of a larger key are dealt out in blocks.
BLOCK_ROWS = 2000
# Shingles that are compared by one task with the sets that visit them; a label with more is heavy.
BLOCK_SHINGLES = 1 << 17
VISITING_SHINGLES = 1 << 22
PAIRS_HELD = 1 << 20
KEY_BITS = 48
# Share of the pairs at the least similarity that may differ too much to be confirmed.
MISSED = 5e-8


@dataclass(frozen=True)
class Signature:
    """``parts`` chunks of ``size`` MinHash values of 8 bits.

    Two signatures that differ in at most parts * (errors + 1) - 1 values have, by pigeonhole, a chunk that
    differs in at most ``errors`` = 1 value. Every chunk is looked up once with each of its values left out,
    which finds all such pairs. At a similarity of 0.8, of 96 values 19.2 differ on average, with a
    deviation of 3.9: all pairs up to 31 differences, three deviations more, are sure to share a key, and
    others do unless every chunk differs twice (4 in 10^8 at 0.8). Pairs that share a key are confirmed unless
    they differ in more than ``tolerance`` values (42 at 0.8, exceeded in 4 in 10^8 pairs).
    """

    parts: int = 16
    size: int = 6
    errors: int = 1

    @property
    def values(self) -> int:
        return self.parts * self.size

    @property
    def distance(self) -> int:
        return self.parts * (self.errors + 1) - 1

    def tolerance(self, least: int) -> int:
        """Differences that pairs with ``least`` percent in common exceed in at most MISSED of all cases."""
        differ = max(0.0, 1 - least / 100)
        chance = [math.comb(self.values, k) * differ**k * (1 - differ) ** (self.values - k) for k in range(self.values + 1)]
        return next(d for d in range(self.values + 1) if sum(chance[d + 1 :]) <= MISSED)


def shingle_sets(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): the distinct shingles of each text of a column, ascending, one text after another.

    A text of fewer words than ``width`` has one shingle, all its words; one without words has none.
    """
    words, first = W.hashed_words(column, lower=True)
    counts = np.diff(first)
    text_of = np.repeat(np.arange(len(counts)), counts)
    places = np.flatnonzero(W.whole_windows(first, width, len(words)))
    hashes, owner = [W.window_hashes(words, width)[places]], [text_of[places]]
    for n in range(1, width):
        short = np.flatnonzero(counts == n)
        if len(short):
            hashes.append(W.mix(W.window_hashes(words, n)[first[short]] + U64(n)))
            owner.append(short)
    found, text = np.concatenate(hashes), np.concatenate(owner)
    order = np.lexsort((found, text))
    found, text = found[order], text[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (text[1:] != text[:-1])
    found, text = found[new], text[new]
    return found, np.searchsorted(text, np.arange(len(counts) + 1))


def sign(hashes: np.ndarray, bounds: np.ndarray, signature: Signature) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each set that isn't empty, and its signature as a row of bytes."""
    starts = bounds[:-1][np.diff(bounds) > 0]
    if not len(starts):
        return np.empty(0, U64), np.empty((0, signature.values), np.uint8)
    with np.errstate(over="ignore"):
        one = np.add.reduceat(W.mix(hashes), starts)
        low = (hashes >> U64(32)).astype(np.uint32)
        salts = W.mix(np.arange(1, 2 * signature.values + 1, dtype=U64)).astype(np.uint32)
        rows = np.empty((len(starts), signature.values), np.uint8)
        for k in range(signature.values):
            least = np.minimum.reduceat((low ^ salts[2 * k]) * (salts[2 * k + 1] | np.uint32(1)), starts)
            rows[:, k] = (least * np.uint32(0x9E3779B1)) >> np.uint32(24)
    return one, rows


def byte_rows(rows: np.ndarray) -> pa.Array:
    n, width = rows.shape
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), n, [None, pa.py_buffer(np.ascontiguousarray(rows))]).cast(pa.binary())


def rows_of_bytes(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width)


def keys_of(rows: np.ndarray, signature: Signature) -> np.ndarray:
    """Keys of every signature: each chunk with each of its values left out; (signature, chunk * size + value)."""
    cut = rows.reshape(len(rows), signature.parts, signature.size).astype(U64)
    shift = (np.arange(signature.size, dtype=U64) * U64(8))[None, None, :]
    whole = (cut << shift).sum(2, dtype=U64)
    out = np.empty((len(rows), signature.parts, signature.size), U64)
    for k in range(signature.size):
        number = (np.arange(signature.parts) * signature.size + k + 1).astype(U64)
        left = whole - (cut[:, :, k] << U64(8 * k))
        out[:, :, k] = W.mix(W.mix(left) + number[None, :]) >> U64(64 - KEY_BITS)
    return out.reshape(len(rows), -1)


def signed_texts(docs: DataFrame, width: int, signature: Signature, id_col: str, text_col: str) -> DataFrame:
    """(id, n_shingles, node, sig) of every row; the hash of a set names its node, both are null for an empty set."""
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(text_col, F.lit("")).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in W.pieces(batches, "_text"):
            hashes, bounds = shingle_sets(piece.column("_text"), width)
            sizes = np.diff(bounds)
            one, sigs = sign(hashes, bounds, signature)
            place = np.where(sizes > 0, np.cumsum(sizes > 0) - 1, -1)
            take = pa.array(place, mask=place < 0)
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("_id"), pa.array(sizes.astype(np.int64)), pa.array(one.view(np.int64)).take(take),
                    byte_rows(sigs).take(take),
                ],
                names=["_id", "n_shingles", "node", "sig"],
            )

    return rows.mapInArrow(tidy(run), f"_id {dict(rows.dtypes)['_id']}, n_shingles bigint, node bigint, sig binary")


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy().astype(np.int64).view(U64)


def _entries(table: pa.Table, signature: Signature) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, row, number of the key in its row) of all keys of a chunk's rows, sorted by key."""
    keys = keys_of(rows_of_bytes(table.column("sig"), signature.values), signature).reshape(-1)
    order = np.argsort(keys, kind="stable")
    return keys[order], order // signature.values, order % signature.values


def first_common_key(same: np.ndarray, signature: Signature) -> np.ndarray:
    """Number of the first key that two signatures have in common, given which of their values are equal;
    the pairs have one."""
    parts = same.reshape(len(same), signature.parts, signature.size)
    equal = parts.sum(2)
    part = (equal >= signature.size - signature.errors).argmax(1)
    rows = np.arange(len(same))
    # a chunk without a difference has all its keys in common, one with a difference that which leaves it out
    place = np.where(equal[rows, part] == signature.size, 0, parts[rows, part].argmin(1))
    return part * signature.size + place


def _starts(values: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.empty(0, np.int64)


def star_pairs(nodes: DataFrame, signature: Signature, chunks: int, centres: int = 4) -> DataFrame:
    """(a, b): each node with the smallest nodes of its keys, the ``centres`` it shares most keys with, and
    (a, null) for a node that shares keys, which marks it.

    Linear in the nodes, whatever the size of a key's group; what it leaves open, ``mixed_labels`` completes.
    """

    def publish(table: pa.Table) -> pa.Table:
        keys, rows, _ = _entries(table, signature)
        new = _starts(keys)
        least = np.minimum.reduceat(_column(table, "node")[rows], new)
        multi = np.diff(np.append(new, len(keys))) > 1
        entry = (keys[new] << U64(1)) | multi.astype(U64)
        chunk = table.column("chunk")[0].as_py()
        return pa.Table.from_batches([C.by_bucket(chunk, chunks, keys[new] << U64(64 - KEY_BITS), (entry, True), (least, False))])

    def answer(table: pa.Table) -> Iterator[pa.RecordBatch]:
        chunk, (entry, least) = C.gather(table, (True, False))
        order = np.argsort(entry, kind="stable")
        chunk, entry, least = chunk[order], entry[order], least[order]
        keys = entry >> U64(1)
        new = _starts(keys)
        if len(new):
            runs = np.diff(np.append(new, len(keys)))
            multi = np.bitwise_or.reduceat(entry & U64(1), new) > 0
            tell = np.repeat((runs > 1) | multi, runs)
            least = np.repeat(np.minimum.reduceat(least, new), runs)
            chunk, keys, least = chunk[tell], keys[tell], least[tell]
            order = np.lexsort((keys, chunk))
            yield from C.answers(chunk[order], (keys[order], True), (least[order], False))

    def pair(table: pa.Table, told: pa.Table) -> pa.Table:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        if not len(table) or not len(told):
            return schema.empty_table()
        keys, rows, _ = _entries(table, signature)
        shared, least = C.gather(told, (True, False))[1]
        order = np.argsort(shared)
        shared, least = shared[order], least[order]
        at = np.minimum(np.searchsorted(shared, keys), len(shared) - 1)
        hit = shared[at] == keys
        nodes_here = _column(table, "node")
        a, b = nodes_here[rows[hit]], least[at[hit]]
        marked = np.unique(a)
        a, b = a[a != b], b[a != b]
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        new = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))) if len(a) else np.empty(0, int)
        counts = np.diff(np.append(new, len(a)))
        a, b = a[new], b[new]
        order = np.lexsort((b, -counts, a))
        a, b = a[order], b[order]
        own = _starts(a)
        rank = np.arange(len(a)) - np.repeat(own, np.diff(np.append(own, len(a))))
        a, b = a[rank < centres], b[rank < centres]
        give_back()
        return pa.table({
            "a": pa.array(np.concatenate([a, marked]).view(np.int64)),
            "b": pa.concat_arrays([pa.array(b.view(np.int64)), pa.nulls(len(marked), pa.int64())]),
        })

    by_chunk = nodes.select(C.chunk_of(chunks, "node").alias("chunk"), "node", "sig").groupBy("chunk")
    told = C.ask(by_chunk.applyInArrow(publish, f"bucket int, chunk int, {C.planes(2)}"), answer, 2)
    return by_chunk.cogroup(told.groupBy("chunk")).applyInArrow(pair, "a bigint, b bigint")


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One pair (smallest, other) for each value but the smallest of every set that the pairs connect."""
    names, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = place[: len(a)], place[len(a) :]
    label = np.arange(len(names))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        for at in (x, y, label[x], label[y]):
            np.minimum.at(new, at, low)
        new = new[new]
        if (new == label).all():
            moved = label != np.arange(len(names))
            return names[label[moved]], names[moved]
        label = new


def mixed_labels(nodes: DataFrame, signature: Signature, chunks: int, least: int) -> DataFrame:
    """(a, b, star): labels with nodes that have a common key, at most ``tolerance`` differences, and sizes that
    allow ``least`` percent.

    ``nodes`` has node, label, n_shingles and sig, and heavy where some labels are. Keys whose nodes all have one label are told apart first
    and need no comparison. Rows of a key beyond BLOCK_ROWS are dealt out by blocks, each two of which meet in
    a task of their own. A pair with a heavy label is reported as it is, once by a task. Of the pairs of other labels a task
    reports a star for each set that they connect, so that the rows are no more than the labels compared, however many of
    them are close to one another.
    """

    tolerance = signature.tolerance(least)

    def publish(table: pa.Table) -> pa.Table:
        keys, rows, _ = _entries(table, signature)
        labels = _column(table, "label")[rows]
        new = _starts(keys)
        low, high = np.minimum.reduceat(labels, new), np.maximum.reduceat(labels, new)
        counts = np.diff(np.append(new, len(keys))).astype(U64)
        chunk = table.column("chunk")[0].as_py()
        return pa.Table.from_batches([C.by_bucket(
            chunk, chunks, keys[new] << U64(64 - KEY_BITS), (keys[new], True), (low, False), (high ^ low, False), (counts, False)
        )])

    def answer(table: pa.Table) -> Iterator[pa.RecordBatch]:
        chunk, (keys, low, high, counts) = C.gather(table, (True, False, False, False))
        high = high ^ low
        order = np.argsort(keys, kind="stable")
        chunk, keys, low, high, counts = (x[order] for x in (chunk, keys, low, high, counts))
        new = _starts(keys)
        if len(new):
            runs = np.diff(np.append(new, len(keys)))
            mixed = np.repeat(np.minimum.reduceat(low, new) != np.maximum.reduceat(high, new), runs)
            total = np.repeat(np.add.reduceat(counts, new), runs)
            chunk, keys, total = chunk[mixed], keys[mixed], total[mixed]
            order = np.lexsort((keys, chunk))
            yield from C.answers(chunk[order], (keys[order], True), (total[order], False))

    def deal(table: pa.Table, told: pa.Table) -> pa.Table:
        """Rows (bucket, packed cell, number of the key and side, label, size, signature) of the mixed keys."""
        schema = pa.schema([("bucket", pa.int32()), ("chunk", pa.int32()), *((f"p{k}", pa.binary()) for k in range(4)), ("sigs", pa.binary())])
        if not len(table) or not len(told):
            return schema.empty_table()
        keys, rows, number = _entries(table, signature)
        shared, total = C.gather(told, (True, False))[1]
        order = np.argsort(shared)
        shared, total = shared[order], total[order]
        at = np.minimum(np.searchsorted(shared, keys), len(shared) - 1)
        hit = shared[at] == keys
        keys, rows, number, total = keys[hit], rows[hit], number[hit], total[at[hit]].astype(np.int64)
        nodes_here, labels, sizes = (_column(table, c) for c in ("node", "label", "n_shingles"))
        heavy = _column(table, "heavy")
        sigs = rows_of_bytes(table.column("sig"), signature.values)
        blocks = -(-total // BLOCK_ROWS)
        entry = np.repeat(np.arange(len(keys)), blocks)
        other = np.arange(len(entry)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        own = (W.mix(nodes_here[rows[entry]]) % blocks[entry].astype(U64)).astype(np.int64)
        low, high = np.minimum(own, other), np.maximum(own, other)
        cell = W.mix(W.mix(keys[entry]) + (low * blocks[entry] + high).astype(U64))
        # 0: all rows of the cell are compared; 1 and 2: the rows of one block with those of the other.
        side = np.where(low == high, 0, np.where(own == low, 1, 2))
        side = (number[entry] * 8 + side).astype(U64) + heavy[rows[entry]] * U64(4)
        order = np.argsort(cell)
        cell, side, rows = cell[order], side[order], rows[entry][order]
        bounds = C.bucket_bounds(cell, chunks)
        chunk = table.column("chunk")[0].as_py()
        batch = C.by_bucket(
            chunk, chunks, cell, (cell, True), (side, False), (labels[rows], False), (sizes[rows], False)
        )
        filled = np.flatnonzero(np.diff(bounds))
        packed = [sigs[rows[bounds[b] : bounds[b + 1]]].tobytes() for b in filled]
        return pa.Table.from_arrays([*batch.columns, pa.array(packed, pa.binary())], schema=schema)

    def compare(table: pa.Table) -> pa.Table:
        _, (cell, side, label, size) = C.gather(table, (True, False, False, False))
        sigs = rows_of_bytes(table.column("sigs"), signature.values)
        order = np.lexsort((size, cell))
        cell, side, label, size = (x[order] for x in (cell, side, label, size))
        size, number, heavy, side = size.astype(np.int64), (side >> U64(3)).astype(np.int64), (side & U64(4)) > 0, side & U64(3)
        nothing = np.empty((2, 0), np.int64)
        direct, light = [nothing], [nothing]
        left = np.arange(len(cell))
        step = 1
        while True:  # each row with the one ``step`` places on, while that is in its cell and small enough
            left = left[left + step < len(cell)]
            left = left[(cell[left] == cell[left + step]) & (100 * size[left] >= least * size[left + step])]
            if not len(left):
                break
            a, b = left, left + step
            fits = (label[a] != label[b]) & ((side[a] == 0) | (side[a] != side[b]))
            a, b = a[fits], b[fits]
            same = sigs[order[a]] == sigs[order[b]]
            near = same.sum(1) >= signature.values - tolerance
            near &= first_common_key(same, signature) == number[a]  # a pair counts at one of its keys
            a, b = a[near], b[near]
            pairs = np.sort(label[np.array([a, b])].view(np.int64).reshape(2, -1), axis=0)
            one_heavy = heavy[a] | heavy[b]
            direct.append(np.unique(pairs[:, one_heavy], axis=1))
            light.append(pairs[:, ~one_heavy])
            if sum(x.shape[1] for x in light) > PAIRS_HELD:
                light = [np.array(forest(*np.concatenate(light, axis=1)))]
            step += 1
        pairs = np.unique(np.concatenate(direct, axis=1), axis=1)
        stars = np.array(forest(*np.concatenate(light, axis=1)), np.int64).reshape(2, -1)
        found = np.concatenate([pairs, stars], axis=1)
        give_back()
        return pa.table({"a": pa.array(found[0]), "b": pa.array(found[1]), "star": pa.array(np.arange(found.shape[1]) >= pairs.shape[1])})

    heavy = F.col("heavy") if "heavy" in nodes.columns else F.lit(False)
    cols = [C.chunk_of(chunks, "node").alias("chunk"), "node", "label", "n_shingles", heavy.cast("long").alias("heavy"), "sig"]
    by_chunk = nodes.select(*cols).groupBy("chunk")
    told = C.ask(by_chunk.applyInArrow(publish, f"bucket int, chunk int, {C.planes(4)}"), answer, 2)
    dealt = by_chunk.cogroup(told.groupBy("chunk")).applyInArrow(deal, f"bucket int, chunk int, {C.planes(4)}, sigs binary")
    return dealt.groupBy("bucket").applyInArrow(compare, "a bigint, b bigint, star boolean").distinct()


def full_sets(docs: DataFrame, wanted: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """(node, set): the packed full sets of the ``wanted`` (node, rep); one row per node."""
    reps = broadcast_if_small(wanted.select(F.col("rep").alias("_rep")).distinct())
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(text_col, F.lit("")).alias("_text"))
    rows = rows.join(reps, F.col("_id").eqNullSafe(F.col("_rep")), "left_semi").select("_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in W.pieces(batches, "_text"):
            hashes, bounds = shingle_sets(piece.column("_text"), width)
            filled = np.flatnonzero(np.diff(bounds))
            with np.errstate(over="ignore"):
                one = np.add.reduceat(W.mix(hashes), bounds[filled]) if len(filled) else np.empty(0, U64)
            sets = [C.pack(hashes[bounds[k] : bounds[k + 1]], True) for k in filled]
            yield pa.RecordBatch.from_arrays([pa.array(one.view(np.int64)), pa.array(sets, pa.binary())], names=["node", "set"])

    sets = rows.mapInArrow(tidy(run), "node bigint, set binary")
    # Rows of one id may differ in text, and those alike have one node.
    nodes = broadcast_if_small(wanted.select("node").distinct())
    return sets.join(nodes, "node", "left_semi").groupBy("node").agg(F.first("set").alias("set"))


def confirm(pairs: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """The pairs (a, b) whose full sets have a similarity of at least ``least`` percent."""
    one = sets.select(F.col("node").alias("a"), F.col("set").alias("set_a"))
    two = sets.select(F.col("node").alias("b"), F.col("set").alias("set_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist()):
                x, y = C.unpack(x, True), C.unpack(y, True)
                if 100 * min(len(x), len(y)) < least * max(len(x), len(y)):
                    good.append(False)
                    continue
                both = np.sort(np.concatenate([x, y]), kind="stable")
                same = int((both[1:] == both[:-1]).sum())
                good.append(100 * same >= least * (len(x) + len(y) - same))
            yield batch.filter(pa.array(good, pa.bool_())).select(["a", "b"])

    joined = pairs.join(one, "a").join(two, "b").select("a", "b", "set_a", "set_b")
    return joined.mapInArrow(tidy(run), "a bigint, b bigint")


def linked_labels(pairs: DataFrame, named: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """The pairs of labels (a, b) of which some nodes' full sets have ``least`` percent in common; the larger label of
    each is heavy.

    The nodes of the larger label stay in blocks of bounded size; every node of the smaller label visits the blocks. So no
    pair of nodes becomes a row. Where the visitors of a block outgrow a task they come in parts, each with the block.
    """
    totals = named.groupBy("label").agg(F.sum("n_shingles").alias("total"))
    one = totals.select(F.col("label").alias("a"), F.col("total").alias("total_a"))
    two = totals.select(F.col("label").alias("b"), F.col("total").alias("total_b"))
    sized = pairs.join(one, "a").join(two, "b")
    first = F.col("total_a") >= F.col("total_b")
    sized = sized.select(
        F.when(first, F.col("a")).otherwise(F.col("b")).alias("big"), F.when(first, F.col("b")).otherwise(F.col("a")).alias("label"),
        F.ceil(F.greatest("total_a", "total_b") / BLOCK_SHINGLES).alias("blocks"), F.least("total_a", "total_b").alias("visiting"),
    )
    sized = cut_lineage(sized, "sized")
    parts = sized.groupBy("big").agg(F.ceil(F.sum("visiting") / VISITING_SHINGLES).alias("parts"))
    sized = sized.join(broadcast_if_small(cut_lineage(parts, "parts")), "big")  # at most a row for each heavy label
    held = named.select("node", "label").join(sets, "node")
    asking = held.select("node", "label", "set").join(sized, "label").select(
        "big", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.pmod(F.xxhash64("node"), F.col("parts")).alias("part"),
        F.col("label").alias("small"), F.col("set").alias("visitor"),
    )
    there = held.join(sized.select(F.col("big").alias("label"), "blocks", "parts").distinct(), "label").select(
        F.col("label").alias("big"), F.pmod(F.xxhash64("node"), F.col("blocks")).alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("set").alias("member"),
    )
    cells = 16 * C.partitions(pairs)

    def compare(asked: pa.Table, blocks: pa.Table) -> pa.Table:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        members: dict[tuple, list] = {}
        for *key, packed in zip(*(blocks.column(c).to_pylist() for c in ("big", "block", "part", "member"))):
            members.setdefault(tuple(key), []).append(packed)
        visits: dict[tuple, dict] = {}
        for *key, small, packed in zip(*(asked.column(c).to_pylist() for c in ("big", "block", "part", "small", "visitor"))):
            visits.setdefault(tuple(key), {}).setdefault(small, []).append(packed)
        found = []
        for key, labels in visits.items():
            if key not in members:
                continue
            index = _index([C.unpack(x, True) for x in members[key]])
            for small, packs in labels.items():
                if any(len(_meets(C.unpack(x, True), *index, least)) for x in packs):
                    found.append((key[0], small))
        return pa.table([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], schema=schema)

    def cell(df: DataFrame) -> DataFrame:
        return df.select(C.chunk_of(cells, "big", "block", "part").alias("cell"), *df.columns)

    met = cell(asking).groupBy("cell").cogroup(cell(there).groupBy("cell")).applyInArrow(compare, "a bigint, b bigint")
    return met.distinct()


def linked_families(stars: DataFrame, named: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """Pairs of labels (a, b) that connect the same labels as all pairs of nodes with ``least`` percent in common do,
    among the labels that ``stars`` (a, b) connects.

    A family, the labels that stars connect, is dealt by node into blocks of bounded size, and each two blocks meet in a
    task, which looks every set up in an index of the others' shingles. A set is sent once for each block of its family.
    """
    families = connect(stars).select(F.col("node").alias("label"), F.col("label").alias("family"))
    held = named.join(families, "label").select("family", "label", "node", "n_shingles")
    blocks = held.groupBy("family").agg(F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES).alias("blocks"))
    held = held.join(blocks, "family").join(sets, "node").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")))
    met = held.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).select(
        "family", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "label", "set"
    )
    cells = 16 * C.partitions(stars)
    met = met.withColumn("cell", C.chunk_of(cells, "family", "low", "high"))

    def compare(table: pa.Table) -> pa.Table:
        groups: dict[tuple, list] = {}
        for *key, own, label, packed in zip(*(table.column(c).to_pylist() for c in ("family", "low", "high", "own", "label", "set"))):
            groups.setdefault(tuple(key), []).append((own, label, packed))
        out = [np.empty((2, 0), np.int64)]
        for (_, low, high), rows in groups.items():
            here = [(label, C.unpack(x, True)) for own, label, x in rows if own == high]
            asking = here if low == high else [(label, C.unpack(x, True)) for own, label, x in rows if own == low]
            if not here or not asking:
                continue
            labels = np.array([label for label, _ in here], np.int64)
            index = _index([x for _, x in here])
            pairs = out[:1]
            for label, mine in asking:
                near = np.unique(labels[_meets(mine, *index, least)])
                near = near[near != label]
                if len(near):
                    pairs.append(np.array([np.full(len(near), label), near]))
                if sum(x.shape[1] for x in pairs) > PAIRS_HELD:
                    pairs = [np.array(forest(*np.concatenate(pairs, axis=1)))]
            out.append(np.array(forest(*np.concatenate(pairs, axis=1)), np.int64).reshape(2, -1))
        found = np.concatenate(out, axis=1)
        return pa.table({"a": pa.array(found[0]), "b": pa.array(found[1])})

    return met.groupBy("cell").applyInArrow(compare, "a bigint, b bigint").distinct()


def _index(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, owners, sizes): the hashes of all sets in order, the set each is of, and the sets' sizes."""
    sizes = np.array([len(x) for x in sets])
    hashes = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    order = np.argsort(hashes, kind="stable")
    return hashes[order], owner[order], sizes


def _meets(mine: np.ndarray, hashes: np.ndarray, owner: np.ndarray, sizes: np.ndarray, least: int) -> np.ndarray:
    """The indexed sets that have ``least`` percent in common with a set."""
    low, high = np.searchsorted(hashes, mine, "left"), np.searchsorted(hashes, mine, "right")
    runs = high - low
    places = np.arange(runs.sum()) + np.repeat(low - (np.cumsum(runs) - runs), runs)
    same = np.bincount(owner[places], minlength=len(sizes))
    return np.flatnonzero(100 * same >= least * (len(mine) + sizes - same))


def connect(links: DataFrame) -> DataFrame:
    """(node, label) of the nodes in ``links`` (a, b): the smallest node that can be reached.

    Every round takes the smallest label around a node and then that label's own label, so paths halve; the
    tables are written after each round.
    """
    edges = cut_lineage(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label"))
    labels = cut_lineage(labels, "labels")
    while True:
        around = edges.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("m"))
        lower = labels.join(around.withColumnRenamed("a", "node"), "node").select("node", "label", F.least("label", "m").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("far"))
        moved = lower.join(jump, "next").select("node", F.col("label").alias("old"), F.least("next", "far").alias("label"))
        moved = cut_lineage(moved, "labels")
        labels = moved.select("node", "label")
        if moved.filter("old <> label").isEmpty():
            return labels


def chunk_number(nodes: int, partitions: int) -> int:
    """Chunks for all partitions to work on, as long as the chunks are not too small; more where they would be too large."""
    return max(min(2 * partitions, nodes // LEAST_NODES_PER_CHUNK + 1), nodes // NODES_PER_CHUNK + 1)


def near_duplicates(
    docs: DataFrame, width: int = 5, least: int = 80, id_col: str = "doc_id", text_col: str = "text",
    signature: Signature = Signature(),
) -> DataFrame:
    """id, n_shingles, component_id (smallest id that can be reached) and kept (id = component_id).

    Texts are linked if 100 * shingles in common >= ``least`` * shingles of either. Texts with equal sets
    are one node; nodes that share a key of their signatures are candidates, and all candidates are confirmed
    on their full sets unless they are connected already: first each node with the smallest nodes of its keys, then all that
    still have different labels, block against block, so that no pair of nodes or labels becomes a row.

    A-Z count as lower case, words are runs of anything but ASCII white space. A null text or one without
    words has an empty set and is a component of its own. A null id comes after all others: a component
    of null ids only has a null component_id, and such rows are kept. Repeated rows keep their rows; rows
    of one id are told apart by their sets. An empty table gives no rows; other columns are ignored. A set
    is known by a hash of 64 bits.
    """
    signed = cut_lineage(signed_texts(docs, width, signature, id_col, text_col), "signed")
    nodes = signed.filter("node IS NOT NULL").groupBy("node").agg(
        F.min("_id").alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig")
    )
    every = nodes = cut_lineage(nodes, "nodes")
    chunks = chunk_number(nodes.count(), C.partitions(docs))

    stars = cut_lineage(star_pairs(nodes, signature, chunks), "stars")
    active = broadcast_if_small(stars.filter("b IS NULL").select(F.col("a").alias("node")))
    nodes = cut_lineage(nodes.join(active, "node", "left_semi"), "active")  # the others share no key
    sets = cut_lineage(full_sets(docs, nodes.select("node", "rep"), width, id_col, text_col), "sets")

    tried = stars.filter("b IS NOT NULL")
    links = cut_lineage(confirm(tried, sets, least), "confirmed")
    labels = connect(links)
    named = nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    heavy = named.groupBy("label").agg(F.sum("n_shingles").alias("_total")).filter(F.col("_total") > BLOCK_SHINGLES)
    heavy = broadcast_if_small(cut_lineage(heavy.select("label", F.lit(True).alias("heavy")), "heavy"))
    named = cut_lineage(named.join(heavy, "label", "left").na.fill(False, ["heavy"]), "named")
    met = cut_lineage(mixed_labels(named, signature, chunks, least), "mixed")
    narrow = named.select("node", "label", "n_shingles")
    ways = ((linked_labels, met.filter("NOT star")), (linked_families, met.filter("star")))
    found = [cut_lineage(way(rows.select("a", "b"), narrow, sets, least), "linked") for way, rows in ways if not rows.isEmpty()]
    more = found[0].unionByName(found[-1]) if found else links.limit(0)
    if not more.isEmpty():
        merged = connect(more).select(F.col("node").alias("label"), F.col("label").alias("to"))
        labels = named.join(broadcast_if_small(merged), "label", "left").select("node", F.coalesce("to", "label").alias("label"))

    # The smallest id of a component, by way of its nodes' smallest ids.
    named = every.select("node", "rep").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    smallest = named.groupBy("label").agg(F.min("rep").alias("component_id"))
    named = named.select("node", "label").join(smallest, "label").select("node", "component_id")
    rows = signed.join(broadcast_if_small(cut_lineage(named, "components")), "node", "left")
    component = F.coalesce("component_id", "_id")
    return rows.select(
        F.col("_id").alias(id_col), "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("_id")).alias("kept")
    )
