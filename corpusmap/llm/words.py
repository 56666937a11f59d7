"""Words of whole texts as numpy arrays: bounds, hashes and hashes of word windows.

Everything works on the bytes of a record batch at once; there is no loop over documents or words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Texts worked on at a time; one longer text is a piece of its own.
PIECE_BYTES = 1 << 20

BASE = 0x9E3779B97F4A7C15 | 1
WINDOW_BASES = (0xD1342543DE82EF95, 0xA0761D6478BD642F)

IN_WORD = np.ones(256, bool)
IN_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False


def pieces(batches: Iterator[pa.RecordBatch], text: str, size: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in slices of about ``size`` bytes of text each."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(lengths.astype(np.int64)) // size
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end) of every word and the place of each text's first word among them, total last."""
    inside = IN_WORD[data]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    before = np.empty(len(data), bool)
    before[:1] = False
    before[1:] = inside[:-1]
    before[edges] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(len(data), bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    after[edges - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit of 64-bit words over all others."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return values ^ (values >> np.uint64(31))


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^0.. and base^-0.. modulo 2^64, at least ``n`` of each; an odd base has an inverse."""
    found = _powers.get(base)
    if found is None or len(found[0]) < n:
        size = max(n, 1 << 16)
        pair = []
        for b in (base, pow(base, -1, 1 << 64)):
            row = np.full(size, b, np.uint64)
            row[0] = 1
            with np.errstate(over="ignore"):
                pair.append(np.multiply.accumulate(row))
        found = _powers[base] = (pair[0], pair[1])
    return found


def _sums(values: np.ndarray, base: int) -> np.ndarray:
    up = powers(base, len(values) + 1)[0]
    out = np.zeros(len(values) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(values * up[: len(values)], out=out[1:])
    return out


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word."""
    sums = _sums(data.astype(np.uint64) + np.uint64(1), BASE)
    down = powers(BASE, len(data) + 1)[1]
    with np.errstate(over="ignore"):
        return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def window_hashes(hashes: np.ndarray, width: int, base: int = WINDOW_BASES[0]) -> np.ndarray:
    """Hash of each run of ``width`` words, text bounds aside; shorter input gives none."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    sums = _sums(hashes, base)
    with np.errstate(over="ignore"):
        return mix((sums[width:] - sums[:n]) * powers(base, n)[1][:n])


def whole_windows(first: np.ndarray, width: int, total: int) -> np.ndarray:
    """Whether the window that starts at each word ends within its text."""
    n = max(total - width + 1, 0)
    left = np.repeat(first[1:], np.diff(first)) - np.arange(total)
    return (left >= width)[:n]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, all other bytes as they are."""
    upper = (data >= 65) & (data <= 90)
    return np.where(upper, data | np.uint8(32), data)


def hashed_words(column: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, place of each text's first word) of a column, piece by piece."""
    batch = pa.RecordBatch.from_arrays([column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column], ["t"])
    parts, counts = [np.empty(0, np.uint64)], [np.zeros(1, np.int64)]
    for piece in pieces(iter([batch]), "t"):
        data, offsets = text_bytes(piece.column(0))
        starts, ends, first = word_bounds(data, offsets)
        parts.append(word_hashes(lower_ascii(data) if lower else data, starts, ends))
        counts.append(np.diff(first))
    return np.concatenate(parts), np.cumsum(np.concatenate(counts))
