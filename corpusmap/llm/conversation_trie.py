"""The prefix trie of conversations by peeling off last turns.

A conversation is the chain of the hashes of its prefixes, 128 bits a turn, so that equal prefixes are equal bytes and
sorting by chain puts every subtree in one run of rows. Ranges of that order are peeled side by side: from the greatest
depth down, conversations that end at a depth join what survived from below, rows with one prefix become a node with
its totals, and the nodes, their last turn stripped, go on to the next depth. A prefix that reaches over the border of
a range is not finished there; what the range knows of it is a row of the next, much smaller round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmap.session import broadcast_if_small, cut_lineage

HASH = 16  # bytes of a prefix hash
ROOT = bytes(HASH)  # key of the root
FEW_TURNS, MANY_TURNS = 1 << 14, 1 << 21  # turns a range should have at least, and may have at most, about
SHRINK = 32  # ranges of a round that become one in the next
IDS_PER_PACK = 8192

NODE = "key binary, parent_key binary, depth int, conv_id bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint"
RECORD = "chain binary, sizes binary, n bigint, conv bigint, kids bigint, leaves bigint, saved bigint"


def conversations_of(turns: DataFrame) -> DataFrame:
    """(base, conv_id, turns): each conversation's turns in order, two hashes and the bytes of the text for each.

    Turns go by number, null first; turns of one number by the hashes of role and text, so that repeated rows stay in
    any fixed order. Null roles and texts count as empty. Rows without a conv_id belong to no conversation and are
    left out. A conversation is in one task with 32 bytes a turn; its texts are not. Conversations of one ``base``
    (the multiple of 5 below) are together.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.filter(F.col("conv_id").isNotNull()).select(
        (F.col("conv_id") - F.col("conv_id") % 5).alias("base"), "conv_id", F.col("turn").cast("long").alias("turn"),
        F.xxhash64(role, text).alias("one"), F.xxhash64(F.lit(13), text, role).alias("two"), F.octet_length(text).cast("long").alias("size"),
    )
    listed = F.array_sort(F.collect_list(F.struct(F.coalesce("turn", F.lit(-(1 << 63))).alias("turn"), F.col("turn").isNotNull().alias("numbered"), "one", "two", "size")))
    return rows.repartition("base").groupBy("base", "conv_id").agg(listed.alias("turns"))


def branched(conversations: DataFrame, most: int = 9) -> DataFrame:
    """(conv_id, turns): the first h turns of the conversation ``base``, then the own turns behind the first h, with
    h the checksum of the id modulo ``most``. An absent base gives no turns, a short one all it has."""
    base = F.when(F.col("conv_id") == F.col("base"), F.slice("turns", 1, most - 1))
    head = F.max(base).over(Window.partitionBy("base"))
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    none = F.slice("turns", 1, 0)
    own = F.slice("turns", F.col("_h") + 1, F.size("turns"))
    rows = conversations.select("conv_id", "turns", F.coalesce(head, none).alias("_head"), taken.alias("_h"))
    return rows.select("conv_id", F.concat(F.slice("_head", F.lit(1), F.col("_h")), own).alias("turns"))


def chains(conversations: DataFrame) -> DataFrame:
    """(conv_id, chain, sizes): the hashes of all prefixes and the text bytes of the turns, as packed bytes."""
    turns = F.transform("turns", lambda t: F.struct(t["one"].alias("one"), t["two"].alias("two"), t["size"].alias("size")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("turns")
            flat = lists.flatten()
            one, two, size = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(3))
            texts = np.stack([one, two], 1).astype("<i8").tobytes()
            offsets = (lists.offsets.to_numpy() - lists.offsets[0].as_py()).tolist()
            out = []
            for a, b in zip(offsets, offsets[1:]):
                held, chain = ROOT, []
                for i in range(a, b):
                    held = hashlib.blake2b(held + texts[HASH * i : HASH * (i + 1)], digest_size=HASH).digest()
                    chain.append(held)
                out.append(b"".join(chain))
            sizes = size.astype("<i8").tobytes()
            packed = [sizes[8 * a : 8 * b] for a, b in zip(offsets, offsets[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), pa.array(out, pa.binary()), pa.array(packed, pa.binary())], names=["conv_id", "chain", "sizes"])

    return conversations.select("conv_id", turns.alias("turns")).mapInArrow(run, "conv_id bigint, chain binary, sizes binary")


class Peeled:
    """Nodes and unfinished rows of one range, gathered depth by depth."""

    def __init__(self, rows: pa.Table, last: bool):
        self.last = last
        self.chain = _bytes(rows.column("chain")).reshape(-1, HASH)
        self.keys = self.chain.view("<u8").reshape(-1, 2)
        self.sizes = _bytes(rows.column("sizes")).view("<i8")
        lengths = np.array([len(c) // HASH for c in rows.column("chain").to_pylist()], np.int64)
        self.lengths, self.starts = lengths, np.cumsum(lengths) - lengths
        self.state = {c: rows.column(c).to_numpy() for c in ("n", "conv", "kids", "leaves", "saved")}
        self.nodes: list[list] = []
        self.records: list[list] = []

    def _at(self, rows: np.ndarray, depth: int) -> np.ndarray:
        """Keys of the prefixes of ``depth`` turns."""
        return self.keys[self.starts[rows] + depth - 1] if depth else np.zeros((len(rows), 2), np.uint64)

    def run(self) -> None:
        by_length = np.argsort(self.lengths, kind="stable")
        bounds = np.searchsorted(self.lengths[by_length], np.arange(self.lengths.max() + 2))
        alive = np.empty(0, np.int64)  # a row below each node that survived
        live = {c: np.empty(0, np.int64) for c in self.state}
        for depth in range(int(self.lengths.max()), -1, -1):
            ended = by_length[bounds[depth] : bounds[depth + 1]]
            row = np.concatenate([alive, ended])
            if not len(row):
                continue
            state = {c: np.concatenate([live[c], self.state[c][ended]]) for c in self.state}
            order = np.argsort(row, kind="stable")
            key = self._at(row[order], depth)
            new = np.ones(len(row), bool)
            new[1:] = (key[1:] != key[:-1]).any(1)
            first = np.flatnonzero(new)
            group = np.empty(len(row), np.int64)
            group[order] = np.cumsum(new) - 1
            merged = {c: (np.minimum if c == "conv" else np.add).reduceat(v[order], first) for c, v in state.items()}
            rows, key = row[order[first]], key[first]
            whole = np.ones(len(first), bool)
            if not self.last:
                for end in (0, len(self.lengths) - 1):
                    if self.lengths[end] >= depth:
                        whole &= (key != self._at(np.array([end]), depth)).any(1)
            self._emit(alive, live, depth + 1, group[: len(alive)], merged["conv"], whole)
            own = self.sizes[self.starts[rows] + depth - 1] if depth else np.zeros(len(rows), np.int64)
            open_ = ~whole
            if open_.any():
                self.records.append([rows[open_], depth, {c: v[open_] for c, v in merged.items()}])
            alive = rows[whole]
            live = {c: v[whole] for c, v in merged.items()}
            live["own_kids"] = live["kids"]
            live["leaves"] = np.where(live["kids"] == 0, 1, live["leaves"])
            live["saved"] = live["saved"] + (live["n"] - 1) * own[whole]
            live["kids"] = np.ones(len(alive), np.int64)  # a child of the node above
        self._emit(alive, live, 0, None, None, None)

    def _emit(self, rows, live, depth, group, conv, whole) -> None:
        """The nodes of ``depth``, now that the nodes above are known."""
        if not len(rows):
            return
        parent = np.zeros(len(rows), np.int64) if group is None else conv[group]
        known = np.zeros(len(rows), bool) if group is None else whole[group]
        above = max(depth - 1, 0)
        self.nodes.append([self._at(rows, depth), self._at(rows, above), depth, live["conv"], parent, known, live["n"], live["own_kids"], live["leaves"], live["saved"]])

    def tables(self) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in f"{NODE}, {RECORD}".split(", ")]
        kinds = {"binary": pa.binary(), "int": pa.int32(), "bigint": pa.int64()}
        types = [kinds[c.split()[1]] for c in f"{NODE}, {RECORD}".split(", ")]
        for keys, parents, depth, conv, parent, known, n, kids, leaves, saved in self.nodes:
            found = [_keys(keys), _keys(parents) if depth else pa.nulls(len(conv), pa.binary()), pa.array(np.full(len(conv), depth, np.int32)),
                     pa.array(conv), pa.array(parent, mask=~known), pa.array(n), pa.array(kids), pa.array(leaves), pa.array(saved)]
            yield pa.RecordBatch.from_arrays([*found, *(pa.nulls(len(conv), t) for t in types[len(found):])], names=names)
        for rows, depth, state in self.records:
            spans = [(s, s + depth) for s in self.starts[rows].tolist()]
            found = [pa.array([self.chain[a:b].tobytes() for a, b in spans], pa.binary()), pa.array([self.sizes[a:b].tobytes() for a, b in spans], pa.binary()),
                     *(pa.array(state[c]) for c in ("n", "conv", "kids", "leaves", "saved"))]
            yield pa.RecordBatch.from_arrays([*(pa.nulls(len(spans), t) for t in types[: -len(found)]), *found], names=names)


def _bytes(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8)


def _keys(keys: np.ndarray) -> pa.Array:
    data = np.ascontiguousarray(keys).astype("<u8").tobytes()
    offsets = np.arange(len(keys) + 1, dtype=np.int32) * HASH
    return pa.Array.from_buffers(pa.binary(), len(keys), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _peel(records: DataFrame, ranges: int) -> DataFrame:
    """One round: nodes finished within a range, and rows of the next round (those with a chain)."""
    last = ranges == 1
    arranged = records.repartition(1) if last else records.repartitionByRange(ranges, "chain")
    schema = pa.schema([("chain", pa.binary()), ("sizes", pa.binary()), *((c, pa.int64()) for c in ("n", "conv", "kids", "leaves", "saved"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]  # a range has a bounded number of turns
        if held:
            peeled = Peeled(pa.Table.from_batches(held).select(schema.names), last)
            held.clear()
            peeled.run()
            yield from peeled.tables()

    return arranged.sortWithinPartitions("chain").mapInArrow(run, f"{NODE}, {RECORD}")


def prefix_trie(chained: DataFrame) -> DataFrame:
    """The nodes of the trie over (conv_id, chain, sizes), columns as in NODE.

    ``conv_id`` is a node's smallest member; the parent columns are null for the root. Equal conversations are
    counted before anything is sorted. No conversation, no node; the root alone if none has a turn.
    """
    records = cut_lineage(chained.groupBy("chain", "sizes").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv")).select(
        "chain", "sizes", "n", "conv", *[F.lit(0).cast("long").alias(c) for c in ("kids", "leaves", "saved")]
    ), "sequences")
    finished: list[DataFrame] = []
    least = 1 << 62
    while True:
        turns = records.agg(F.sum(F.length("chain") / HASH + 1)).first()[0] or 0
        cores = 2 * records.sparkSession.sparkContext.defaultParallelism
        ranges = int(max(min(turns // FEW_TURNS, cores), -(-turns // MANY_TURNS), 1))
        ranges = min(ranges, least)
        least = max(1, ranges // SHRINK)
        done = cut_lineage(_peel(records, ranges), "peeled")
        finished.append(done.filter(F.col("key").isNotNull()).select(*[c.split()[0] for c in NODE.split(", ")]))
        if ranges == 1:
            break
        records = done.filter(F.col("key").isNull()).select(*[c.split()[0] for c in RECORD.split(", ")])
    if len(finished) == 1:
        return finished[0]
    later = finished[1]  # prefixes over the borders of ranges: a few for each range
    for part in finished[2:]:
        later = later.unionByName(part)
    found = finished[0].unionByName(later)
    waiting = F.col("parent_conv_id").isNull() & (F.col("depth") > 0)
    above = later.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_above"))
    named = found.filter(waiting).drop("parent_conv_id").join(broadcast_if_small(above), "parent_key").withColumnRenamed("_above", "parent_conv_id")
    return found.filter(~waiting).unionByName(named)


def end_digests(chained: DataFrame) -> DataFrame:
    """(key, ends_sha256): of each prefix that is a whole conversation, the hash of the ids of those conversations,
    in decimal, ascending, comma-joined.

    Ids are sorted in ranges of (prefix, id), so that a prefix with many of them is spread over tasks, and packed by
    thousands; only the packs of a prefix, in order, run through one hash, which holds one of them at a time.
    """
    size = F.length("chain")
    key = F.when(size == 0, F.lit(ROOT)).otherwise(F.expr(f"substring(chain, length(chain) - {HASH - 1}, {HASH})"))
    rows = chained.select(key.alias("key"), "conv_id")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, ids = batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()
            out: list[tuple] = []
            at = 0
            for i in range(1, len(ids) + 1):
                if i == len(ids) or keys[i] != keys[at] or i - at == IDS_PER_PACK:
                    out.append((keys[at], ids[at], ",".join(map(str, ids[at:i]))))
                    at = i
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.binary(), pa.int64(), pa.string()))], names=["key", "first", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, running = None, None
        for batch in batches:
            out: list[tuple] = []
            for key, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
                if key == held:
                    running.update(b"," + ids.encode())
                    continue
                if held is not None:
                    out.append((held, running.hexdigest()))
                held, running = key, hashlib.sha256(ids.encode())
            yield _digests(out)
        if held is not None:
            yield _digests([(held, running.hexdigest())])

    packed = rows.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id").mapInArrow(pack, "key binary, first bigint, ids string")
    return packed.repartition("key").sortWithinPartitions("key", "first").mapInArrow(digest, "key binary, ends_sha256 string")


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())], names=["key", "ends_sha256"])


def conversation_trie(turns: DataFrame, rebuild: bool = True) -> DataFrame:
    """The prefix trie of ``turns`` (conv_id, turn, role, text) with the ids that end at every node.

    Columns as in NODE and ``ends_sha256``; with ``rebuild`` each conversation begins with turns of another one
    (``branched``). An empty table gives no nodes; further columns are not read. ``saved_tokens`` counts bytes of
    text that need not be read again when prefixes are shared.
    """
    grouped = conversations_of(turns)
    chained = cut_lineage(chains(branched(grouped) if rebuild else grouped), "chains")
    nodes = prefix_trie(chained)
    nothing: Column = F.lit(hashlib.sha256(b"").hexdigest())
    return nodes.join(end_digests(chained), "key", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", nothing))
