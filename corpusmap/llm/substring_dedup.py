"""Exact repeats of word sequences across documents, found by fixed blocks as anchors."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmap.llm import chunks as C
from corpusmap.llm import words as W

WINDOW = 50
NO_ID = np.iinfo(np.int64).max
U64 = np.uint64
# Bits of a block's hash that are looked up. A false match only makes its surroundings go through the
# comparison of whole windows, which takes 96 bits.
ANCHOR_BITS = 50
SECOND_BITS = 32


class Texts:
    """The words of a chunk's rows, with the hashes of their windows."""

    def __init__(self, table: pa.Table, window: int):
        self.table = table.combine_chunks()
        self.window, self.block = window, (window + 1) // 2
        self.words, self.first = W.hashed_words(self.table.column("_text"))
        ids = self.table.column("_id").cast(pa.int64()).combine_chunks()
        self.ids = ids.fill_null(NO_ID).to_numpy(zero_copy_only=False)
        counts = np.diff(self.first)
        self.word_id = np.repeat(self.ids, counts)
        self.place = np.arange(len(self.words)) - np.repeat(self.first[:-1], counts)

    def blocks(self) -> tuple[np.ndarray, np.ndarray]:
        """(places, hashes) of all windows of a block's width."""
        places = np.flatnonzero(W.whole_windows(self.first, self.block, len(self.words)))
        return places, W.window_hashes(self.words, self.block)[places] >> U64(64 - ANCHOR_BITS)

    def whole(self) -> np.ndarray:
        return np.flatnonzero(W.whole_windows(self.first, self.window, len(self.words)))

    def windows(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of the whole windows at ``places``."""
        one = W.window_hashes(self.words, self.window, W.WINDOW_BASES[0])[places]
        two = W.window_hashes(self.words, self.window, W.WINDOW_BASES[1])[places] >> U64(64 - SECOND_BITS)
        return one, two


def run_starts(*columns: np.ndarray) -> np.ndarray:
    """Where a new combination of values begins in sorted columns."""
    if not len(columns[0]):
        return np.empty(0, np.int64)
    new = np.zeros(len(columns[0]), bool)
    new[0] = True
    for values in columns:
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def _anchors(texts: Texts, chunk: int, buckets: int) -> pa.RecordBatch:
    """Every distinct block hash of a chunk, marked if it begins at a multiple of the block's width (it is
    in the index) and if it occurs more than once."""
    places, keys = texts.blocks()
    aligned = texts.place[places] % texts.block == 0
    order = np.argsort(keys)
    keys, aligned = keys[order], aligned[order]
    new = run_starts(keys)
    counts = np.diff(np.append(new, len(keys)))
    indexed = np.logical_or.reduceat(aligned, new) if len(new) else np.empty(0, bool)
    entry = (keys[new] << U64(2)) | (indexed.astype(U64) << U64(1)) | (counts > 1).astype(U64)
    return C.by_bucket(chunk, buckets, keys[new] << U64(64 - ANCHOR_BITS), (entry, True))


def _shared_blocks(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """The block hashes of a bucket that are in the index and occur twice, for each chunk that has them."""
    chunk, (entry,) = C.gather(table, (True,))
    order = np.argsort(entry)
    entry, chunk = entry[order], chunk[order]
    keys = entry >> U64(2)
    new = run_starts(keys)
    if len(new):
        bits = np.bitwise_or.reduceat(entry & U64(3), new)
        runs = np.diff(np.append(new, len(keys)))
        good = np.repeat(((bits & U64(2)) > 0) & ((runs > 1) | ((bits & U64(1)) > 0)), runs)
        keys, chunk = keys[good], chunk[good]
        order = np.lexsort((keys, chunk))
        yield from C.answers(chunk[order], (keys[order], True))


def _candidates(texts: Texts, chunk: int, buckets: int, shared: np.ndarray) -> pa.RecordBatch:
    """Whole windows that contain a shared block: two hashes, the least id that has them here, and whether
    another id here has them too."""
    places, keys = texts.blocks()
    hit = np.zeros(len(texts.words) + 1, np.int64)
    if len(shared):
        at = np.minimum(np.searchsorted(shared, keys), len(shared) - 1)
        hit[places[shared[at] == keys] + 1] = 1
    before = np.cumsum(hit)
    whole = texts.whole()
    last = whole + texts.window - texts.block + 1  # past the last place where a block begins inside
    whole = whole[before[last] > before[whole]]
    one, two = texts.windows(whole)
    ids = texts.word_id[whole]
    order = np.lexsort((ids, two, one))
    one, two, ids = one[order], two[order], ids[order]
    new = run_starts(one, two)
    end = np.append(new[1:], len(one))
    more = ids[end - 1] > ids[new] if len(new) else np.empty(0, bool)
    return C.by_bucket(
        chunk, buckets, one[new], (one[new], True), ((two[new] << U64(1)) | more.astype(U64), False),
        (ids[new].astype(U64) ^ U64(1 << 63), False),
    )


def _first_ids(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """For every chunk the windows that an id smaller than one of its own has, with the smallest id."""
    chunk, (one, two, ids) = C.gather(table, (True, False, False))
    more, two = (two & U64(1)) > 0, two >> U64(1)
    order = np.lexsort((ids, two, one))
    chunk, one, two, ids, more = (x[order] for x in (chunk, one, two, ids, more))
    new = run_starts(one, two)
    least = np.repeat(ids[new], np.diff(np.append(new, len(one))))
    tell = more | (least < ids)
    chunk, one, two, least = (x[tell] for x in (chunk, one, two, least))
    order = np.lexsort((two, one, chunk))
    yield from C.answers(chunk[order], (one[order], True), (two[order], False), (least[order], False))


def _covered(texts: Texts, one: np.ndarray, two: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Whether each word lies in a window that a smaller id has."""
    whole = texts.whole()
    covers = np.zeros(len(texts.words) + 1, np.int64)
    if len(one) and len(whole):
        order = np.lexsort((two, one))
        one, two, least = one[order], two[order], least[order]
        mine, other = texts.windows(whole)
        ids = texts.word_id[whole].astype(U64) ^ U64(1 << 63)
        at = np.searchsorted(one, mine)
        found = np.zeros(len(whole), bool)
        for k in range(int(np.diff(np.append(run_starts(one), len(one))).max())):  # nearly always once
            place = np.minimum(at + k, len(one) - 1)
            found |= (one[place] == mine) & (two[place] == other) & (least[place] < ids)
        covers += np.bincount(whole[found], minlength=len(covers))
        covers -= np.bincount(whole[found] + texts.window, minlength=len(covers))
    return np.cumsum(covers)[:-1] > 0


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """What is left of every text without the word sequences that documents of smaller ids have.

    Words are runs of anything but ASCII white space. Of each text, all words go that lie in a run of
    ``window`` words which also stands in a text with a smaller id; runs are judged on the input. The index
    holds the hashes of non-overlapping blocks of half a window from every text, so each window contains
    one; every place of every text is looked up in it. Windows around a shared block are then compared as a
    whole, which extends hits to maximal repeats: adjacent confirmed windows join to one span.

    Returns id, n_words, n_removed, ``kept`` (text: the kept words joined by one blank) and ``repeats``
    (array of (start, end) in words, end exclusive). A null text has no words. A null id comes after all
    others; rows of one id do not remove from each other. Texts below ``window`` words stay as they are.
    An empty table gives no rows; other columns are ignored, whatever their names. Ids are whole numbers.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(text_col, F.lit("")).alias("_text"))
    n = C.chunk_count(rows, "_text")
    buckets = n
    rows = rows.select(C.chunk_of(n, "_id", "_text").alias("chunk"), "_id", "_text")

    def chunk_number(table: pa.Table) -> int:
        return table.column("chunk")[0].as_py()

    def anchors(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches([_anchors(Texts(table, window), chunk_number(table), buckets)])

    def candidates(table: pa.Table, told: pa.Table) -> pa.Table:
        schema = pa.schema([("bucket", pa.int32()), ("chunk", pa.int32()), *((f"p{k}", pa.binary()) for k in range(3))])
        if not len(table) or not len(told):
            return schema.empty_table()
        shared = np.sort(C.gather(told, (True,))[1][0])
        return pa.Table.from_batches([_candidates(Texts(table, window), chunk_number(table), buckets, shared)], schema)

    id_type = dict(rows.dtypes)["_id"]

    def kept(table: pa.Table, told: pa.Table) -> pa.Table:
        texts = Texts(table, window)
        gone = _covered(texts, *C.gather(told, (True, False, False))[1])
        out_text, out_spans, removed = [], [], []
        for k, text in enumerate(texts.table.column("_text").to_pylist()):
            a, b = texts.first[k], texts.first[k + 1]
            words = text.encode().split()
            mask = gone[a:b]
            removed.append(int(mask.sum()))
            spans = []
            if removed[-1]:
                words = [w for w, g in zip(words, mask.tolist()) if not g]
                step = np.diff(mask.astype(np.int8), prepend=0, append=0)
                spans = [
                    {"start": s, "end": e} for s, e in zip(np.flatnonzero(step > 0).tolist(), np.flatnonzero(step < 0).tolist())
                ]
            out_text.append(b" ".join(words).decode())
            out_spans.append(spans)
        spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.table({
            "_id": texts.table.column("_id"), "n_words": pa.array(np.diff(texts.first).astype(np.int64)),
            "n_removed": pa.array(removed, pa.int64()), "kept": pa.array(out_text, pa.string()),
            "repeats": pa.array(out_spans, spans_type),
        })

    by_chunk = rows.groupBy("chunk")
    asked = by_chunk.applyInArrow(anchors, f"bucket int, chunk int, {C.planes(1)}")
    shared = C.ask(asked, _shared_blocks, 1)
    asked = by_chunk.cogroup(shared.groupBy("chunk")).applyInArrow(candidates, f"bucket int, chunk int, {C.planes(3)}")
    firsts = C.ask(asked, _first_ids, 3)
    out = by_chunk.cogroup(firsts.groupBy("chunk")).applyInArrow(
        kept, f"_id {id_type}, n_words bigint, n_removed bigint, kept string, repeats array<struct<start:bigint,end:bigint>>"
    )
    return out.withColumnRenamed("_id", id_col)
