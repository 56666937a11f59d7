"""Language identification by prediction by partial matching over bytes."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmap.functions.ranking import first_n_per_group
from corpusmap.llm import words as W
from corpusmap.llm.shared import share, tidy
from corpusmap.session import broadcast_if_small, cut_lineage

ORDER = 3
UNKNOWN = "und"
# The classifier learns from at most TRAIN_ROWS whole texts of each language, chosen by a hash of their ids; of
# languages, contexts and bytes it learns all there are.
TRAIN_ROWS = 1000
PIECE = 1 << 20
SPREAD = np.uint64(0x9E3779B97F4A7C15)
EMPTY = np.uint32(2**32 - 1)


class Table:
    """Places of 32-bit keys by open addressing, at most half full; the last key is kept apart, as it marks free slots."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(2 * len(keys)).bit_length())
        self.slots = np.full(1 << self.bits, EMPTY)
        self.place = np.full(1 << self.bits, -1, np.int32)
        self.last = int(np.flatnonzero(keys == EMPTY)[0]) if (keys == EMPTY).any() else -1
        number = np.flatnonzero(keys != EMPTY).astype(np.int32)
        keys = keys[number]
        at = self._start(keys)
        while len(keys):
            free = self.slots[at] == EMPTY
            self.slots[at[free]] = keys[free]  # of several keys for one slot the last stays
            here = self.slots[at] == keys
            self.place[at[here]] = number[here]
            keys, number, at = keys[~here], number[~here], self._next(at[~here])

    def _start(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys.astype(np.uint64) * SPREAD) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _next(self, at: np.ndarray) -> np.ndarray:
        return (at + 1) & ((1 << self.bits) - 1)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key among those the table was made of, -1 if it is none."""
        out = np.full(len(keys), -1, np.int64)
        out[keys == EMPTY] = self.last
        open_ = np.flatnonzero(keys != EMPTY)
        at = self._start(keys[open_])
        while len(open_):
            held = self.slots[at]
            hit = held == keys[open_]
            out[open_[hit]] = self.place[at[hit]]
            more = ~hit & (held != EMPTY)
            open_, at = open_[more], self._next(at[more])
        return out


class Tree:
    """One language's contexts of up to ORDER bytes, kept sparse.

    A context with n symbols, d of them distinct, gives a symbol seen c times c / (n + d) and escapes to the next
    shorter context with d / (n + d), where what the longer context has seen is left out; past the empty context all
    bytes left are alike. n and d of a shorter context then depend on the longer one alone, so that two numbers a context
    are enough: the logarithm of n + d below it, and the bits of the escape from there.
    """

    def __init__(self, codes: np.ndarray, counts: np.ndarray):
        """``codes``: ORDER bytes of context and the byte that follows, each once."""
        self.pairs, self.logs, self.contexts, self.own, self.below = [], [], [], [], []
        held = None
        for order in range(ORDER, -1, -1):
            keys = codes & np.uint32((1 << (8 * order + 8)) - 1) if order < ORDER else codes
            keys, place = np.unique(keys, return_inverse=True)
            n = np.bincount(place.ravel(), counts, len(keys))
            names, of = np.unique(keys >> np.uint32(8), return_inverse=True)
            of = of.ravel()
            total, distinct = np.bincount(of, n, len(names)), np.bincount(of, minlength=len(names))
            table = Table(keys)
            if held is not None:  # what is left of these contexts below each context one byte longer
                longer_keys, longer_names, longer_of, longer_distinct = held
                suffix = longer_keys & np.uint32((1 << (8 * order + 8)) - 1)
                seen = np.bincount(longer_of, n[table.find(suffix)], len(longer_names))
                shorter = np.searchsorted(names, longer_names & np.uint32((1 << (8 * order)) - 1))
                left, left_distinct = total[shorter] - seen, distinct[shorter] - longer_distinct
                self.below.append(np.array([self._log(left + left_distinct), self._escape(left, left_distinct)], np.float32))
            self.pairs.append(table)
            self.logs.append(np.log2(n).astype(np.float32))
            self.contexts.append(Table(names))
            self.own.append(np.array([self._log(total + distinct), self._escape(total, distinct)], np.float32))
            held = keys, names, of, distinct
        self.rest = np.log2(max(256 - int(distinct[0]), 1))

    @staticmethod
    def _log(n: np.ndarray) -> np.ndarray:
        return np.log2(np.maximum(n, 1))

    @staticmethod
    def _escape(total: np.ndarray, distinct: np.ndarray) -> np.ndarray:
        return np.where(total > 0, np.log2(np.maximum(total + distinct, 1)) - np.log2(np.maximum(distinct, 1)), 0.0)

    def code_lengths(self, codes: np.ndarray) -> np.ndarray:
        """Bits of the last byte of each code after the bytes before it."""
        out = np.zeros(len(codes))
        open_ = np.arange(len(codes))
        longer = np.full(len(codes), -1, np.int64)  # place of the context one byte longer, -1 if it was never seen
        for level, order in enumerate(range(ORDER, -1, -1)):
            keys = codes[open_] & np.uint32((1 << (8 * order + 8)) - 1) if order < ORDER else codes[open_]
            place = self.contexts[level].find(keys >> np.uint32(8))
            known = place >= 0
            fresh = known & (longer < 0)
            log, escape = np.zeros(len(open_)), np.zeros(len(open_))
            log[fresh], escape[fresh] = self.own[level][:, place[fresh]]
            if level:
                deep = longer >= 0
                log[deep], escape[deep] = self.below[level - 1][:, longer[deep]]
            pair = self.pairs[level].find(keys)
            hit = pair >= 0
            out[open_[hit]] += log[hit] - self.logs[level][pair[hit]]
            out[open_[~hit]] += escape[~hit]
            open_, longer = open_[~hit], place[~hit]
            if not len(open_):
                return out
        out[open_] += self.rest
        return out


@dataclass
class Model:
    """The trees of all learned languages."""

    languages: list[str]
    trees: list[Tree]

    def code_lengths(self, column: pa.Array) -> np.ndarray:
        """Bits that each text takes under each language; an empty text takes none."""
        data, offsets = W.text_bytes(column)
        out = np.zeros((len(column), len(self.languages)))
        filled = np.flatnonzero(np.diff(offsets) > 0)
        if len(filled):
            codes, place = np.unique(codes_of(data, offsets), return_inverse=True)
            for k, tree in enumerate(self.trees):
                out[filled, k] = np.add.reduceat(tree.code_lengths(codes)[place.ravel()], offsets[filled])
        return out


def codes_of(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The ORDER bytes before each byte, and itself, as one number; zeros stand before a text's start."""
    code = np.zeros(len(data), np.uint32)
    starts = offsets[:-1]
    for back in range(ORDER, -1, -1):
        shifted = np.zeros(len(data), np.uint32)
        shifted[back:] = data[: len(data) - back]
        for k in range(back):
            places = starts + k
            shifted[places[places < offsets[1:]]] = 0
        code = (code << np.uint32(8)) | shifted
    return code


def predictions(counts: list[np.ndarray], sizes: np.ndarray) -> np.ndarray:
    """Probability of each symbol given its counts after the longest context first, then after shorter ones.

    A context with n symbols, d of them distinct, gives a symbol seen c times c / (n + d) and escapes
    to the next shorter context with d / (n + d); what a longer context has seen is left out there.
    Past the shortest one all symbols left are alike; ``sizes`` has the bytes of each class.
    """
    rows, n = counts[0].shape
    out = np.zeros((rows, n))
    left = np.ones((rows, n), bool)
    weight = np.ones((rows, 1))
    for seen in counts:
        seen = np.where(left, seen, 0)
        total, distinct = seen.sum(1, keepdims=True), (seen > 0).sum(1, keepdims=True)
        below = np.maximum(total + distinct, 1)
        out += weight * seen / below
        weight = np.where(total > 0, weight * distinct / below, weight)
        left &= seen == 0
    rest = (left * sizes).sum(1, keepdims=True)
    out += np.where(left, weight * sizes / np.maximum(rest, 1), 0)
    return np.maximum(out, 1e-300) / sizes


def sample(rows: DataFrame, train_rows: int) -> DataFrame:
    """(lang, text) of at most ``train_rows`` rows of each language."""
    sizes = broadcast_if_small(cut_lineage(rows.groupBy("lang").count(), "language-sizes"))
    # A language's ids are thinned out by their hash to about twice what is wanted before they are ranked,
    # so that ranking the commonest one is no more work than any other.
    place = F.pmod(F.xxhash64("_id"), F.lit(1 << 31)) / float(1 << 31)
    known = rows.select("lang", "_id").join(sizes, "lang").filter(place * F.col("count") <= 2 * train_rows)
    picked = first_n_per_group(
        known.select("lang", "_id"), ["lang"], [F.xxhash64("_id"), F.col("_id")], train_rows
    ).select("lang", "_id").distinct()
    # Narrow rows, at most train_rows a language. Rows with equal ids come along.
    picked = broadcast_if_small(cut_lineage(picked, "language-ids"), 1_000_000)
    return rows.join(picked, ["lang", "_id"], "left_semi").select("lang", "text")


def _counted(texts: DataFrame) -> DataFrame:
    """(lang, code, n): how often each byte follows each ORDER bytes in each language's texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in W.pieces(batches, "text", PIECE):
            data, offsets = W.text_bytes(piece.column("text"))
            langs = piece.column("lang").dictionary_encode()
            keys = np.repeat(langs.indices.to_numpy().astype(np.uint64), np.diff(offsets)) << np.uint64(32) | codes_of(data, offsets)
            keys, n = np.unique(keys, return_counts=True)
            names = langs.dictionary.take(pa.array((keys >> np.uint64(32)).astype(np.int64)))
            codes = (keys & np.uint64(2**32 - 1)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([names, pa.array(codes), pa.array(n.astype(np.int64))], names=["lang", "code", "n"])

    return texts.mapInArrow(tidy(run), "lang string, code bigint, n bigint").groupBy("lang", "code").agg(F.sum("n").alias("n"))


def train(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", train_rows: int = TRAIN_ROWS,
) -> Model | None:
    """Fit on labelled rows; rows without text or language are left out, no rows give no model.

    Counting is distributed, and a task builds the tree of one language from the distinct codes of its sample, which are
    no more than the sample's bytes. The driver gets the finished trees, a few MB a language.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    rows = rows.filter("text IS NOT NULL AND lang IS NOT NULL AND text <> ''")
    texts = cut_lineage(sample(rows, train_rows), "language-sample")

    def build(counted: pa.Table) -> pa.Table:
        order = np.argsort(counted.column("code").to_numpy())
        codes = counted.column("code").to_numpy()[order].astype(np.uint32)
        tree = Tree(codes, counted.column("n").to_numpy()[order].astype(np.float64))
        return pa.table({"lang": counted.column("lang")[:1].cast(pa.string()), "tree": pa.array([cloudpickle.dumps(tree)], pa.binary())})

    built = _counted(texts).groupBy("lang").applyInArrow(build, "lang string, tree binary").collect()
    if not built:
        return None
    built.sort(key=lambda row: row["lang"])
    return Model([row["lang"] for row in built], [pickle.loads(row["tree"]) for row in built])


def predict(
    docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()
) -> DataFrame:
    """id, ``lang_pred``, ``score`` and ``bits_per_byte`` of every row's whole text, without a shuffle, and
    the columns in ``carry`` as they are.

    The language is the one whose statistics give the text the shortest code, of equal ones the first by
    name; the score is its probability against the others. A text that is null or without any letter,
    and every text when nothing was learned, is "und" with score 0. Repeated rows and null ids keep
    their rows, an empty table gives none; other columns are ignored, whatever their names.
    """
    rows = docs.select(
        F.col(id_col).alias("_id"), F.coalesce(text_col, F.lit("")).alias("_text"),
        F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("_letter"),
        *[F.col(c).alias(f"_carry{k}") for k, c in enumerate(carry)],
    )
    kinds = dict(rows.dtypes)
    carried = [f"_carry{k}" for k in range(len(carry))]
    shared = share(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared()
        for piece in W.pieces(batches, "_text", PIECE):
            n = piece.num_rows
            told = piece.column("_letter").to_numpy(zero_copy_only=False)
            names, score, rate = np.full(n, UNKNOWN, object), np.zeros(n), np.zeros(n)
            if held is not None:
                bits = held.code_lengths(piece.column("_text"))
                best = bits.argmin(1)
                least = bits[np.arange(n), best]
                score = np.where(told, 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(1), 0.0)
                names = np.where(told, np.array(held.languages, object)[best], UNKNOWN)
                rate = least / np.maximum(np.diff(W.text_bytes(piece.column("_text"))[1]), 1)
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("_id"), pa.array(names.tolist(), pa.string()), pa.array(score), pa.array(rate),
                    *(piece.column(c) for c in carried),
                ],
                names=["_id", "lang_pred", "score", "bits_per_byte", *carried],
            )

    schema = f"_id {kinds['_id']}, lang_pred string, score double, bits_per_byte double"
    found = rows.mapInArrow(tidy(run), ", ".join([schema, *(f"{c} {kinds[c]}" for c in carried)]))
    return found.withColumnsRenamed({"_id": id_col, **dict(zip(carried, carry))})


def held_out(id_col: str = "doc_id", folds: int = 4, fold: int = 2) -> Column:
    """Whether a row's id, as text, falls into the fold kept from training; a null id does not."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold, F.lit(False))
