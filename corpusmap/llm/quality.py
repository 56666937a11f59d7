"""Quality rules as a bitmask ledger: measure once, then decide by versioned policies on the bits."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmap.llm import words as W

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_letters", "n_marks",
)

IS_SYMBOL = np.zeros(256, bool)
IS_SYMBOL[list(b"#*$%&|<>")] = True
IS_UPPER = np.zeros(256, bool)
IS_UPPER[65:91] = True
IS_LOWER = np.zeros(256, bool)
IS_LOWER[97:123] = True
IS_MARK = np.zeros(256, bool)  # ASCII that is neither letter, digit nor white space
IS_MARK[33:127] = True
IS_MARK[48:58] = IS_MARK[65:91] = IS_MARK[97:123] = False
STARTS_CHAR = (np.arange(256) & 0xC0) != 0x80


@dataclass(frozen=True)
class Rule:
    """One bit of the ledger; ``fails`` is SQL over the measurements."""

    bit: int
    name: str
    fails: str


@dataclass(frozen=True)
class Policy:
    """A version's rules; a row is kept when none of them failed."""

    name: str
    version: int
    rules: tuple[str, ...]


# Bits are never given another meaning: a changed rule takes a new bit, so that stored ledgers stay
# readable and a new policy version needs no look at any text.
RULES = (
    Rule(0, "too_short", "n_words < 50"),
    Rule(1, "repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "symbols", "10 * n_symbols > 3 * n_words"),
    Rule(3, "repeated_lines", "2 * n_dup_lines > n_lines"),
    Rule(4, "shouting", "2 * n_upper > n_letters AND n_letters > 0"),
    Rule(5, "word_length", "word_chars < 2 * n_words OR word_chars > 20 * n_words"),
    Rule(6, "marks", "10 * n_marks > 3 * word_chars"),
)
BASE = Policy("base", 1, ("too_short", "repeated_words"))
DEFAULT = Policy("default", 1, tuple(rule.name for rule in RULES))


def _sums(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Whether each key occurs twice or more."""
    order = np.argsort(keys)
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(len(keys), bool)
    twice[:-1] |= same
    twice[1:] |= same
    out = np.empty(len(keys), bool)
    out[order] = twice
    return out


def measure_texts(column: pa.Array) -> dict[str, np.ndarray]:
    """The measurements of every text of a column."""
    data, offsets = W.text_bytes(column)
    n = len(column)
    starts, ends, first = W.word_bounds(data, offsets)
    counts = np.diff(first)
    inside = W.IN_WORD[data]
    salt = W.mix(np.arange(1, n + 1, dtype=np.uint64))  # keeps the texts of a piece apart

    hashes = W.word_hashes(data, starts, ends)
    covered = np.zeros(len(hashes), bool)
    windows = W.window_hashes(hashes, 3)
    places = np.flatnonzero(W.whole_windows(first, 3, len(hashes)))
    if len(places):
        text_of = np.repeat(np.arange(n), counts)
        found = places[_repeated(windows[places] ^ salt[text_of[places]])]
        for k in range(3):
            covered[found + k] = True

    breaks = np.flatnonzero(data == 10)
    line_starts = np.unique(np.concatenate([offsets[:-1][np.diff(offsets) > 0], breaks + 1]))
    line_starts = line_starts[line_starts < len(data)]
    line_ends = np.append(line_starts[1:], len(data))[: len(line_starts)]
    bodies = line_ends - (data[np.maximum(line_ends - 1, 0)] == 10) if len(data) else line_ends
    with_word = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    line_starts, bodies = line_starts[with_word], bodies[with_word]
    line_text = np.searchsorted(offsets, line_starts, side="right") - 1
    n_lines = np.bincount(line_text, minlength=n)
    keys = W.word_hashes(data, line_starts, bodies) ^ salt[line_text]
    distinct = np.bincount(line_text[np.unique(keys, return_index=True)[1]], minlength=n)

    return {
        "n_words": counts, "word_chars": _sums(inside & STARTS_CHAR[data], offsets),
        "n_symbols": _sums(IS_SYMBOL[data], offsets), "n_lines": n_lines, "n_dup_lines": n_lines - distinct,
        "n_repeat_words": _sums(covered, first), "n_upper": _sums(IS_UPPER[data], offsets),
        "n_letters": _sums(IS_UPPER[data] | IS_LOWER[data], offsets), "n_marks": _sums(IS_MARK[data], offsets),
    }


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and the measurements (long) of every row's whole text, in one scan without a shuffle."""
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in W.pieces(batches, "_text"):
            found = measure_texts(piece.column("_text"))
            yield pa.RecordBatch.from_arrays(
                [piece.column("_id"), *(pa.array(found[m].astype(np.int64)) for m in MEASURES)], names=["_id", *MEASURES]
            )

    fields = ", ".join(f"{m} bigint" for m in MEASURES)
    return rows.mapInArrow(run, f"_id {dict(rows.dtypes)['_id']}, {fields}").withColumnRenamed("_id", id_col)


def quality_ledger(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: id, the measurements and ``failed``, the bits of the failed rules.

    Store it; policies and ablations need nothing else. Words are runs of anything but ASCII white
    space. A null or empty text has no words and no lines: it fails ``too_short`` and no other rule of
    RULES. Repeated rows and null ids each keep their row, an empty table gives none; other columns
    are ignored, whatever their names.
    """
    rows = measure(docs, id_col, text_col)
    failed = F.lit(0).cast("long")
    for rule in rules:
        failed = failed.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << rule.bit)).otherwise(F.lit(0)).cast("long"))
    return rows.withColumn("failed", failed)


def policy_mask(policy: Policy, rules: tuple[Rule, ...] = RULES) -> int:
    bits = {rule.name: 1 << rule.bit for rule in rules}
    return sum(bits[name] for name in set(policy.rules))


def passes(policy: Policy, rules: tuple[Rule, ...] = RULES) -> Column:
    """Condition on ``failed``."""
    return F.col("failed").bitwiseAND(F.lit(policy_mask(policy, rules))) == 0


def ablations(ledger: DataFrame, policies: list[Policy], rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """For each policy and rule: rows kept, rows that fail the rule, and rows that only it drops.

    The ledger is first counted by its bits, at most 2^rules rows whatever its size.
    """
    counts = ledger.groupBy("failed").agg(F.count(F.lit(1)).alias("n"))
    grid = F.array(*[
        F.struct(
            F.lit(p.name).alias("policy"), F.lit(p.version).alias("version"), F.lit(r.name).alias("rule"),
            F.lit(policy_mask(p, rules)).cast("long").alias("mask"), F.lit(1 << r.bit).cast("long").alias("bit"),
        )
        for p in policies for r in rules if r.name in p.rules
    ])
    rows = counts.select("failed", "n", F.inline(grid))
    hit = F.col("failed").bitwiseAND(F.col("mask"))
    return rows.groupBy("policy", "version", "rule").agg(
        F.sum(F.when(hit == 0, F.col("n")).otherwise(0)).alias("n_kept"),
        F.sum(F.when(hit.bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(hit == F.col("bit"), F.col("n")).otherwise(0)).alias("n_only_this_rule"),
    )
