"""How far the sources of a language differ in their terms.

The counts of a language are a matrix, a row for each source and a column for each kept term, cut into cells of
bounded size. A cell is a quadtree: quadrants without a count are not stored. All pairs of rows go down the tree
together; a quadrant without counts on either side has one price for all its columns, the gap of the two smoothed
zeros, and only leaves with counts on one side at least are compared value by value.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmap.functions.ranking import first_n_per_group
from corpusmap.llm import words as W
from corpusmap.session import broadcast_if_small, cut_lineage

SCALE_STEPS = 3  # shares are in parts of 1000 ** SCALE_STEPS
SMOOTH = 5
HELD_TERMS = 200_000  # (group, term) counts a task gathers before it sends them
STRETCH = 1 << 20  # bytes of a long text taken apart at a time
ROW_BLOCK = 128  # sources of a block of rows
CELL_ENTRIES = 1 << 17  # counts of a cell, about
LEAF = 3  # a leaf is 2 ** LEAF rows and columns
STATES = 1 << 15  # pairs of quadrants that are opened at a time

LOWER = bytes(b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _stretches(text: bytes) -> Iterator[bytes]:
    """A text of terms and blanks in parts that cut no term."""
    at = 0
    while len(text) - at > STRETCH:
        end = text.find(b" ", at + STRETCH)
        if end < 0:
            break
        yield text[at:end]
        at = end
    yield text[at:]


def term_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(lang, source, term, n, docs) added up per task: occurrences, and rows that hold the term.

    A term is a run of ASCII letters and characters beyond ASCII; A-Z count as a-z. Whole texts are read, a task holds
    HELD_TERMS counts and one stretch of a text.
    """
    rows = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")], F.coalesce(text_col, F.lit("")).alias("_text"))
    names = ["lang", "source", "term", "n", "docs"]

    def send(held: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            if n:
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(n), pa.string()), pa.array([source] * len(n), pa.string()),
                    pa.array(list(n), pa.binary()).cast(pa.string()), pa.array(list(n.values()), pa.int64()),
                    pa.array(list(map(docs.__getitem__, n)), pa.int64()),
                ], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        for piece in W.pieces(batches, "_text"):
            texts = piece.column("_text").cast(pa.binary()).to_pylist()
            for lang, source, text in zip(piece.column("lang").to_pylist(), piece.column("source").to_pylist(), texts):
                n, docs = held.setdefault((lang, source), (Counter(), Counter()))
                seen: set[bytes] = set()
                for part in _stretches(text.translate(LOWER)):
                    terms = part.split()
                    n.update(terms)
                    seen.update(terms)
                docs.update(seen)
            if sum(len(n) for n, _ in held.values()) > HELD_TERMS:
                yield from send(held)
                held.clear()
        yield from send(held)

    return rows.mapInArrow(run, "lang string, source string, term string, n bigint, docs bigint")


def share(count: Column, total: Column) -> Column:
    """1 + floor(1000^3 * count / total) by long division, exact while 1000 * total is a long."""
    rest, found = count, F.lit(0).cast("long")
    for step in range(SCALE_STEPS):
        grown = rest * F.lit(1000)
        rest = grown % total
        found = found * F.lit(1000) + F.call_function("div", grown - rest, total)
    return found + 1


class Quadtree:
    """Row by row sums of |difference| over all columns of a cell."""

    def __init__(self, rows: np.ndarray, columns: np.ndarray, values: np.ndarray, zeros: np.ndarray, n_columns: int):
        self.zeros, self.n_columns = zeros, n_columns
        side = 1 << LEAF
        self.height = max(0, int(max(len(zeros), n_columns, 1) - 1).bit_length() - LEAF)
        code = self._code(rows >> LEAF, columns >> LEAF)
        leaves, place = np.unique(code, return_inverse=True)
        self.levels = [leaves]
        for _ in range(self.height):
            self.levels.append(np.unique(self.levels[-1] >> 2))
        self.levels.reverse()  # root first
        self.blocks = -(-len(zeros) // side)
        padded = np.zeros(self.blocks * side, np.int64)
        padded[: len(zeros)] = zeros
        self.default = padded.reshape(self.blocks, side)
        self.leaf_row, self.leaf_column = self._uncode(leaves)
        self.leaf = np.repeat(self.default[self.leaf_row][:, :, None], side, 2)
        self.leaf[place, rows & (side - 1), columns & (side - 1)] = values

    @staticmethod
    def _spread(x: np.ndarray) -> np.ndarray:
        x = x.astype(np.uint64)
        for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
            x = (x | (x << np.uint64(shift))) & np.uint64(mask)
        return x.astype(np.int64)

    def _code(self, row: np.ndarray, column: np.ndarray) -> np.ndarray:
        return (self._spread(row) << 1) | self._spread(column)

    @staticmethod
    def _uncode(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        row, column = np.zeros_like(code), np.zeros_like(code)
        for bit in range(32):
            column |= ((code >> (2 * bit)) & 1) << bit
            row |= ((code >> (2 * bit + 1)) & 1) << bit
        return row, column

    def _find(self, level: int, row: np.ndarray, column: np.ndarray) -> np.ndarray:
        """Places of quadrants among the stored ones of a level, -1 without counts."""
        codes, code = self.levels[level], self._code(row, column)
        if not len(codes):
            return np.full(len(code), -1)
        place = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
        return np.where(codes[place] == code, place, -1)

    def distances(self) -> np.ndarray:
        """Sum over all columns of |value - value| for every pair of rows, both halves."""
        side, n = 1 << LEAF, len(self.zeros)
        total = np.zeros((self.blocks, self.blocks, side, side), np.int64)
        empty = [np.zeros((1 << level, 1 << level) if (1 << level) <= self.blocks else (self.blocks, self.blocks), np.int64) for level in range(self.height + 1)]
        start = np.zeros(1, np.int64)
        waiting = [(0, start, start, start)]
        while waiting:
            level, a, b, c = waiting.pop()
            if len(a) > STATES:
                half = len(a) // 2
                waiting += [(level, a[:half], b[:half], c[:half]), (level, a[half:], b[half:], c[half:])]
                continue
            size = side << (self.height - level)  # rows and columns of a quadrant
            left, right = self._find(level, a, c), self._find(level, b, c)
            bare = (left < 0) & (right < 0)
            if bare.any():
                width = np.clip(self.n_columns - c[bare] * size, 0, size)
                np.add.at(empty[level], (a[bare], b[bare]), width)
            a, b, c, left, right = a[~bare], b[~bare], c[~bare], left[~bare], right[~bare]
            if level == self.height:
                for k in range(0, len(a), 2048):
                    part = slice(k, k + 2048)
                    self._add(total, a[part], b[part], c[part], left[part], right[part])
                continue
            corner = np.arange(8)
            x, y, z = ((2 * v[:, None] + (corner >> k) % 2).ravel() for v, k in ((a, 0), (b, 1), (c, 2)))
            real = (x <= y) & (y * (size // 2) < n) & (z * (size // 2) < self.n_columns)
            if real.any():
                waiting.append((level + 1, x[real], y[real], z[real]))
        out = total.transpose(0, 2, 1, 3).reshape(self.blocks * side, -1)[:n, :n]
        bare_columns = np.zeros((n, n), np.int64)
        for level, widths in enumerate(empty):
            if widths.any():
                block = np.arange(n) // (side << (self.height - level))
                bare_columns += widths[np.ix_(block, block)]
        out = out + bare_columns * np.abs(self.zeros[:, None] - self.zeros[None, :])
        return np.triu(out, 1) + np.triu(out, 1).T

    def _add(self, total, a, b, c, left, right) -> None:
        side = 1 << LEAF
        inside = (c[:, None] * side + np.arange(side)) < self.n_columns

        def block(rows: np.ndarray, place: np.ndarray) -> np.ndarray:
            if not len(self.leaf):
                return np.repeat(self.default[rows][:, :, None], side, 2)
            return np.where((place >= 0)[:, None, None], self.leaf[place], self.default[rows][:, :, None])

        # values beside the cell's last column are 0 on both sides
        one, other = (np.where(inside[:, None, :], block(*x), 0) for x in ((a, left), (b, right)))
        gap = np.abs(one[:, :, None, :] - other[:, None, :, :]).sum(3)
        pair = a * self.blocks + b
        order = np.argsort(pair, kind="stable")
        first = np.flatnonzero(np.diff(pair[order], prepend=-1))
        total[a[order[first]], b[order[first]]] += np.add.reduceat(gap[order], first)


def divergence(docs: DataFrame, min_docs: int = 30, top_terms: int = 50, text_col: str = "text") -> DataFrame:
    """(lang, source, part, item, value, rank) for every (lang, source) that occurs.

    A language keeps the terms that ``min_docs`` of its rows hold. Each source, and the language as a whole, gives a
    kept term the share 1 + floor(10^9 (count + 5) / (N + 5 V)). Part ``pair``: every other source of the language with the
    sum of |share - share| over all kept terms, 0 without any. Part ``term``: the ``top_terms`` terms whose share here
    exceeds the language's by most. Ranks go from 1 by falling value, ties by item in byte order.

    A null text, lang or source counts as empty, so does a lang of that name; every row is a document, repeated ones
    too. An empty table gives no rows; further columns are not read. Pairs of sources are the result asked for: their
    number is the square of a language's sources, and no more than that many rows a cell are made.
    """
    pairs = Window.partitionBy("lang", "term")
    counted = term_counts(docs, text_col).repartition("lang", "term").groupBy("lang", "term", "source").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs")
    )
    kept = counted.select(
        "lang", "term", "source", "n", F.sum("docs").over(pairs).alias("docs"), F.sum("n").over(pairs).alias("lang_n"),
        (F.col("source") == F.min("source").over(pairs)).alias("first"),
    ).filter(F.col("docs") >= min_docs).drop("docs")
    kept = cut_lineage(kept, "kept-terms")
    groups = _groups(docs, kept)
    held = broadcast_if_small(groups.select("lang", "source", "number", "total", "lang_total", "blocks", "stripes"), 1_000_000)
    shares = kept.join(held, ["lang", "source"]).withColumn("p", share(F.col("n") + SMOOTH, F.col("total")))
    return _pair_rows(shares, groups).unionByName(_term_rows(shares, top_terms))


def _groups(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """One row for each group: its number in its language, denominators, smoothed zero, blocks and stripes."""
    sizes = kept.groupBy("lang", "source").agg(F.sum("n").alias("n"), F.sum(F.col("first").cast("long")).alias("terms"), F.count(F.lit(1)).alias("entries"))
    langs = sizes.groupBy("lang").agg(F.sum("n").alias("lang_n"), F.sum("terms").alias("terms"), F.sum("entries").alias("entries"))
    there = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    sources = F.count(F.lit(1)).over(Window.partitionBy("lang"))
    rows = there.select("*", number.alias("number"), sources.alias("sources"))
    rows = rows.join(sizes.drop("terms", "entries"), ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0)
    blocks = F.ceil(F.col("sources") / ROW_BLOCK).cast("int")
    smooth = F.lit(SMOOTH).cast("long") * F.col("terms")
    return cut_lineage(rows.select(
        "lang", "source", "number", "terms", F.greatest(F.col("n") + smooth, F.lit(1)).alias("total"),
        F.greatest(F.col("lang_n") + smooth, F.lit(1)).alias("lang_total"), blocks.alias("blocks"),
        F.greatest(F.ceil(2 * F.col("entries") / (F.greatest(blocks, F.lit(2)) * CELL_ENTRIES)), F.lit(1)).cast("int").alias("stripes"),
    ).withColumn("zero", share(F.lit(SMOOTH).cast("long"), F.col("total"))), "groups")


def _term_rows(shares: DataFrame, top_terms: int) -> DataFrame:
    over = shares.select("lang", "source", F.col("term").alias("item"), (F.col("p") - share(F.col("lang_n") + SMOOTH, F.col("lang_total"))).alias("value"))
    top = first_n_per_group(over.filter("value > 0"), ["lang", "source"], [F.desc("value"), "item"], top_terms, rank="rank")
    return top.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")


def _pair_rows(shares: DataFrame, groups: DataFrame) -> DataFrame:
    def cells(rows: DataFrame, *columns: str) -> DataFrame:
        """Every row in the cells that pair its block of sources with another one."""
        own = F.floor(F.col("number") / ROW_BLOCK).cast("int")
        opened = rows.withColumn("_own", own).withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        upper, lower = F.least("_own", "_other"), F.greatest("_own", "_other")
        # aliases, as both sides of the cogroup come from one table
        return opened.select(F.col("lang").alias("lang"), upper.alias("upper"), lower.alias("lower"), *[F.col(c).alias(c) for c in columns])

    stripe = F.pmod(F.xxhash64("term"), F.col("stripes")).cast("int")
    entries = cells(shares.withColumn("stripe", stripe), "stripe", "number", "term", "p")
    zeros = cells(groups.withColumn("stripe", F.explode(F.sequence(F.lit(0), F.col("stripes") - 1))), "stripe", "number", "zero")
    cell = ["lang", "upper", "lower", "stripe"]
    schema = "lang string, a int, b int, gap bigint, columns bigint"
    empty = pa.schema([("lang", pa.string()), ("a", pa.int32()), ("b", pa.int32()), ("gap", pa.int64()), ("columns", pa.int64())]).empty_table()

    def compare(entry: pa.Table, zero: pa.Table) -> pa.Table:
        numbers = zero.column("number").to_numpy()
        order = np.argsort(numbers)
        numbers = numbers[order]
        if len(numbers) < 2:
            return empty
        terms = entry.column("term").combine_chunks().dictionary_encode()
        if isinstance(terms, pa.ChunkedArray):
            terms = terms.combine_chunks()
        n_columns = len(terms.dictionary)
        rows = np.searchsorted(numbers, entry.column("number").to_numpy())
        tree = Quadtree(rows, terms.indices.to_numpy().astype(np.int64), entry.column("p").to_numpy(), zero.column("zero").to_numpy()[order], n_columns)
        a, b = np.triu_indices(len(numbers), 1)
        upper, lower = zero.column("upper")[0].as_py(), zero.column("lower")[0].as_py()
        if upper != lower:  # pairs within a block belong to the block's own cell
            across = (numbers[a] // ROW_BLOCK) != (numbers[b] // ROW_BLOCK)
            a, b = a[across], b[across]
        gaps = tree.distances()[a, b]
        return pa.table({
            "lang": pa.array([zero.column("lang")[0].as_py()] * len(a), pa.string()), "a": pa.array(numbers[a], pa.int32()),
            "b": pa.array(numbers[b], pa.int32()), "gap": pa.array(gaps, pa.int64()), "columns": pa.array(np.full(len(a), n_columns), pa.int64()),
        })

    found = entries.groupBy(*cell).cogroup(zeros.groupBy(*cell)).applyInArrow(compare, schema)
    sums = found.groupBy("lang", "a", "b").agg(F.sum("gap").alias("gap"), F.sum("columns").alias("columns"))
    names = groups.select("lang", "number", "source", "zero", "terms")
    for side in ("a", "b"):
        known = names if side == "a" else names.drop("terms")
        known = known.withColumnsRenamed({"number": side, "source": f"source_{side}", "zero": f"zero_{side}"})
        sums = sums.join(broadcast_if_small(known, 1_000_000), ["lang", side])
    # terms that no cell of the pair holds have the smoothed zero on both sides
    value = F.col("gap") + (F.col("terms") - F.col("columns")) * F.abs(F.col("zero_a") - F.col("zero_b"))
    ways = F.explode(F.array(*[F.struct(F.col(f"source_{x}").alias("source"), F.col(f"source_{y}").alias("item")) for x, y in ("ab", "ba")]))
    both = sums.select("lang", value.alias("value"), ways.alias("_way")).select("lang", "_way.*", "value")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return both.select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank.alias("rank"))
