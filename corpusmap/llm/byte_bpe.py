"""Byte-level byte-pair encoding on padded numpy matrices, and decoding.

Texts are split by the vocabulary's pattern; the distinct splits of a piece of the table are sorted into buckets by
length and every bucket is one padded matrix of ids, a row for each split. In every round each row merges its leftmost
pair of least rank. A merge shortens every row by one, so the matrix loses a column a round, and rows without a
pair to merge leave it.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmap.llm import words as W
from corpusmap.llm.shared import share, tidy

NONE = np.int32(2**31 - 1)  # rank of a pair that no merge makes
EMPTY = np.uint64(2**64 - 1)
PIECE = 2 << 20  # bytes of text worked on at a time
STRETCH = 1 << 20  # characters of a long text split at a time
CELLS = 1 << 20  # cells of a matrix
LONG = 2048  # bytes of a split from which on its pairs wait in a heap, as a row's work is its length squared
SPREAD = np.uint64(0x9E3779B97F4A7C15)
KEPT = ("size", "names", "text", "bounds", "slots", "found", "bits", "pattern", "newer", "quick")
# Letters, digits and white space up to U+00FF.
LETTERS, DIGITS, SPACES = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼-¾", "\t-\r \x85\xa0"


class Unknown(ValueError):
    """An id that the vocabulary lacks."""


def newer_characters() -> dict[str, str]:
    """Letters and digits that ``regex`` knows and tiktoken does not, as parts of a character class by property."""
    ranks = {bytes([b]): b for b in range(256)}
    every = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
    out = {}
    for kind in (r"\p{L}", r"\p{N}"):
        known = tiktoken.Encoding("one", pat_str=kind, mergeable_ranks=ranks, special_tokens={})
        held = set(bytes(known.encode_ordinary(every)).decode())
        more = sorted(ord(c) for c in regex.findall(kind, every) if c not in held)
        ends = np.flatnonzero(np.diff(np.array(more + [1 << 30])) > 1)
        starts = np.concatenate([[0], ends[:-1] + 1])
        out[kind] = "".join(f"{chr(more[a])}-{chr(more[b])}" for a, b in zip(starts, ends)) if more else ""
    return out


def narrow(pattern: str) -> str | None:
    """The pattern with its properties written out for texts of Latin-1 characters; None if it uses others."""
    for old, new in ((r"[^\s\p{L}\p{N}]", f"[^{SPACES}{LETTERS}{DIGITS}]"), (r"\p{L}", f"[{LETTERS}]"), (r"\p{N}", f"[{DIGITS}]"),
                     (r"\s", f"[{SPACES}]"), (r"\S", f"[^{SPACES}]")):
        pattern = pattern.replace(old, new)
    return None if r"\p" in pattern else pattern


class ByteBpe:
    """A vocabulary of byte strings with ranks; a rank is the string's id, and pairs are merged by rank."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            names = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, file)}
        self.names = names
        self.size = max(names.values()) + 1
        by_id = [b""] * self.size
        for word, rank in names.items():
            by_id[rank] = word
        self.bounds = np.cumsum([0, *map(len, by_id)])
        self.text = np.frombuffer(b"".join(by_id), np.uint8)
        pairs = {}
        for word, rank in names.items():
            for cut in range(1, len(word)):
                left, right = names.get(word[:cut]), names.get(word[cut:])
                if left is not None and right is not None:
                    pairs[left * self.size + right] = rank
        self._hash(np.fromiter(pairs.keys(), np.uint64, len(pairs)), np.fromiter(pairs.values(), np.int32, len(pairs)))
        self.pattern, self.quick = pattern, narrow(pattern)
        self.newer = "".join(newer_characters().values())
        self.ready()

    def ready(self) -> None:
        """What a worker sets up for itself."""
        self.first = np.array([self.names[bytes([b])] for b in range(256)], np.int32)
        self.split_any = regex.compile(self.pattern).findall
        self.split_narrow = re.compile(self.quick).findall if self.quick else None
        self.strange = regex.compile(f"[{self.newer}]") if self.newer else None
        self.border = regex.compile(r"(?<=\S)\s")

    def __getstate__(self):
        return {k: self.__dict__[k] for k in KEPT}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.ready()

    def _hash(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Pairs in a table with open addressing, a quarter full at most; a key without a place there is no pair."""
        self.bits = max(4, int(len(keys) * 4).bit_length())
        self.slots = np.full(1 << self.bits, EMPTY)
        self.found = np.full(1 << self.bits, NONE)
        place = self._places(keys)
        while len(keys):
            free = self.slots[place] == EMPTY
            self.slots[place[free]] = keys[free]  # of several keys for one slot the last stays
            here = self.slots[place] == keys
            self.found[place[here]] = values[here]
            keys, values = keys[~here], values[~here]
            place = (place[~here] + 1) & ((1 << self.bits) - 1)

    def _places(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys * SPREAD) >> np.uint64(64 - self.bits)).astype(np.int64)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, NONE without a merge or beside padding (-1)."""
        keys = (left.astype(np.int64) * self.size + right).astype(np.uint64)
        place = self._places(keys)
        held = self.slots[place]
        hit = held == keys
        out = np.where(hit, self.found[place], NONE)
        more = np.flatnonzero(~hit & (held != EMPTY))
        place = place[more]
        while len(more):
            place = (place + 1) & ((1 << self.bits) - 1)
            held = self.slots[place]
            hit = held == keys[more]
            out[more[hit]] = self.found[place[hit]]
            on = ~hit & (held != EMPTY)
            more, place = more[on], place[on]
        out[(left < 0) | (right < 0)] = NONE
        return out

    def splits(self, text: str) -> list[str]:
        """The matches of the pattern. Characters that tiktoken takes neither for letters nor for digits are split
        as other signs are."""
        if self.split_narrow:
            try:
                text.encode("latin-1")
                return self.split_narrow(text)
            except UnicodeEncodeError:
                pass
        if self.strange is None or not self.strange.search(text):
            return self.split_any(text)
        shown, out, at = self.strange.sub("\x01", text), [], 0
        for part in self.split_any(shown):
            out.append(text[at : at + len(part)])
            at += len(part)
        return out

    def stretches(self, text: str) -> Iterator[str]:
        """A long text in parts; a split never goes on over white space behind another character."""
        at = 0
        while len(text) - at > STRETCH:
            found = self.border.search(text, at + STRETCH)
            if found is None:
                break
            yield text[at : found.start()]
            at = found.start()
        yield text[at:]

    def encode_splits(self, splits: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all splits one after the other, how many each has)."""
        lengths = np.fromiter(map(len, splits), np.int64, len(splits))
        starts = np.cumsum(lengths) - lengths
        symbols = self.first[np.frombuffer(b"".join(splits), np.uint8)]
        whole = np.fromiter(map(self.names.get, splits, repeat(-1)), np.int32, len(splits))
        sizes = np.ones(len(splits), np.int64)
        done: list[tuple[np.ndarray, np.ndarray]] = []  # (splits, ids) of matrix rows, those of one length together
        for i in np.flatnonzero((whole < 0) & (lengths >= LONG)).tolist():
            done.append((np.array([i]), self.merge_long(symbols[starts[i] : starts[i] + lengths[i]])[None, :]))
        bucket = np.where((whole < 0) & (lengths < LONG), np.frexp(lengths - 1)[1], -1)  # 2 ** bucket bytes at most
        for bits in np.unique(bucket[bucket >= 0]).tolist():
            members, step = np.flatnonzero(bucket == bits), max(1, CELLS >> bits)
            for a in range(0, len(members), step):
                here = members[a : a + step]
                here = here[np.argsort(lengths[here], kind="stable")]
                n = lengths[here]
                matrix = np.full((len(here), int(n[-1])), np.int32(-1))
                matrix[np.arange(matrix.shape[1]) < n[:, None]] = symbols[spans(starts[here], n)]
                done.extend((here[rows], ids) for rows, ids in self.merge_rows(matrix, n))
        for rows, ids in done:
            sizes[rows] = ids.shape[1]
        places = np.cumsum(sizes) - sizes
        flat = np.empty(int(sizes.sum()), np.int32)
        flat[places] = whole
        for rows, ids in done:
            flat[places[rows][:, None] + np.arange(ids.shape[1])] = ids
        return flat, sizes

    def merge_rows(self, matrix: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(places, ids) of finished rows of a padded matrix, those of one length at a time."""
        width = matrix.shape[1]
        rows = np.arange(len(matrix))
        ranks = self.pair_ranks(matrix[:, :-1].ravel(), matrix[:, 1:].ravel()).reshape(len(rows), width - 1)
        while len(rows):
            here = np.arange(len(rows))
            if width > 1:
                at = ranks.argmin(1)
                least = ranks[here, at]
                rest = least == NONE
            else:
                rest = np.ones(len(rows), bool)
            if rest.any():
                for n in np.unique(lengths[rest]).tolist():
                    ended = rest & (lengths == n)
                    yield rows[ended], matrix[ended, :n]
                if rest.all():
                    return
                go = ~rest
                rows, lengths, matrix, ranks, at, least = rows[go], lengths[go], matrix[go], ranks[go], at[go], least[go]
                here = here[: len(rows)]
            matrix[here, at] = least
            stay = np.ones(matrix.shape, bool)
            stay[here, at + 1] = False
            width -= 1
            lengths = lengths - 1
            matrix = matrix[stay].reshape(len(rows), width)
            if width == 1:
                continue
            stay = np.ones(ranks.shape, bool)
            stay[here, at] = False
            ranks = ranks[stay].reshape(len(rows), width - 1)
            for pairs in (at, at - 1):  # the merged token with its right and its left neighbour
                there = (pairs >= 0) & (pairs < width - 1)
                r, left = here[there], pairs[there]
                ranks[r, left] = self.pair_ranks(matrix[r, left], matrix[r, left + 1])

    def merge_long(self, symbols: np.ndarray) -> np.ndarray:
        """Ids of one long split: the same merges in the same order, with the pairs in a heap by rank and place."""
        ids, n = symbols.tolist(), len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        ranks = self.pair_ranks(symbols[:-1], symbols[1:])
        waiting = [(r, i) for i, r in enumerate(ranks.tolist()) if r != NONE]
        heapq.heapify(waiting)
        lookup = self._rank_of
        current = ranks.tolist() + [int(NONE)]
        while waiting:
            rank, i = heapq.heappop(waiting)
            if current[i] != rank:
                continue
            gone = after[i]
            ids[i], current[gone] = rank, -1
            after[i] = after[gone]
            if after[gone] < n:
                before[after[gone]] = i
            for a in (before[i], i):
                if a >= 0:
                    b = after[a]
                    current[a] = found = lookup(ids[a], ids[b]) if b < n else int(NONE)
                    if found != NONE:
                        heapq.heappush(waiting, (found, a))
        out, i = [], 0
        while i < n:
            out.append(ids[i])
            i = after[i]
        return np.array(out, np.int32)

    def _rank_of(self, left: int, right: int) -> int:
        key = left * self.size + right
        at = ((key * int(SPREAD)) & (2**64 - 1)) >> (64 - self.bits)
        while True:
            held = int(self.slots[at])
            if held == key:
                return int(self.found[at])
            if held == int(EMPTY):
                return int(NONE)
            at = (at + 1) & ((1 << self.bits) - 1)

    def encode_batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, offsets of the texts)."""
        parts, counts = [], np.zeros(len(texts) + 1, np.int64)
        held, sizes = [], []

        def flush():
            if not held:
                return
            flat = list(chain.from_iterable(held))
            number = {word: i for i, word in enumerate(dict.fromkeys(flat))}
            order = np.fromiter(map(number.__getitem__, flat), np.int64, len(flat))
            ids, n = self.encode_splits([word.encode() for word in number])
            starts = np.cumsum(n) - n
            parts.append(ids[spans(starts[order], n[order])])
            ends = np.concatenate([[0], np.cumsum(n[order])])
            at = 0
            for words, text in zip(held, sizes):
                counts[text + 1] += ends[at + len(words)] - ends[at]
                at += len(words)
            held.clear()
            sizes.clear()

        waiting = 0
        for i, text in enumerate(texts):
            for stretch in self.stretches(text):
                held.append(self.splits(stretch))
                sizes.append(i)
                waiting += len(stretch)
                if waiting > 2 * STRETCH:
                    flush()
                    waiting = 0
        flush()
        return np.concatenate([np.empty(0, np.int32), *parts]), np.cumsum(counts)

    def decode_batch(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all texts one after the other, offsets of the texts)."""
        if len(ids) and (ids.min() < 0 or ids.max() >= self.size):
            raise Unknown(f"ids must lie between 0 and {self.size - 1}")
        sizes = (self.bounds[1:] - self.bounds[:-1])[ids]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        return self.text[spans(self.bounds[ids], sizes)], ends[offsets]


def spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places start, start + 1, .. of every span, one span after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(total)


def _binary(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data).tobytes())]
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, buffers)


def _id_lists(ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids, pa.int32()))


def load(spark: SparkSession, path: str, pattern: str):
    """The vocabulary in ``path``, read once on the driver and sent to the workers; a few MB whatever the data."""
    return share(spark, ByteBpe(path, pattern))


def _over_texts(docs: DataFrame, path: str, pattern: str, id_col: str, text_col: str, columns: str, build) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(text_col, F.lit("")).alias("_text"))
    shared = load(docs.sparkSession, path, pattern)
    names = ["_id", *(c.split()[0] for c in columns.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared()
        for piece in W.pieces(batches, "_text", PIECE):
            ids, offsets = model.encode_batch(piece.column("_text").to_pylist())
            yield pa.RecordBatch.from_arrays([piece.column("_id"), *build(model, ids, offsets)], names=names)

    return rows.mapInArrow(tidy(run), f"_id {dict(rows.dtypes)['_id']}, {columns}").withColumnRenamed("_id", id_col)


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and ``ids`` (array of int) of every row's whole text, without a shuffle.

    A null or empty text has no ids. There are no special tokens: their strings are ordinary text. Repeated rows and
    null ids keep their rows, an empty table gives none; other columns are ignored, whatever their names. Ties of
    rank within a split are merged from the left.
    """
    return _over_texts(docs, path, pattern, id_col, text_col, "ids array<int>", lambda model, ids, offsets: [_id_lists(ids, offsets)])


def encode_and_decode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ``n_tokens``, ``packed`` (ids as little-endian unsigned 32-bit integers, as token files hold them) and
    ``decoded`` (the bytes that the ids decode to) in one pass; rows as in ``encode``."""

    def build(model: ByteBpe, ids: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
        return [pa.array(np.diff(offsets)), _binary(ids.astype("<u4").view(np.uint8), offsets * 4), _binary(*model.decode_batch(ids, offsets))]

    return _over_texts(docs, path, pattern, id_col, text_col, "n_tokens bigint, packed binary, decoded binary", build)


def decode(encoded: DataFrame, path: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """id and ``decoded`` (bytes) of rows of ``ids``; null ids decode to nothing, unknown ids fail."""
    rows = encoded.select(F.col(id_col).alias("_id"), F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    shared = load(encoded.sparkSession, path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared()
        for batch in batches:
            lists = batch.column("ids")
            offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            data, ends = model.decode_batch(lists.flatten().to_numpy(zero_copy_only=False), offsets)
            yield pa.RecordBatch.from_arrays([batch.column("_id"), _binary(data, ends)], names=["_id", "decoded"])

    return rows.mapInArrow(tidy(run), f"_id {dict(rows.dtypes)['_id']}, decoded binary").withColumnRenamed("_id", id_col)
