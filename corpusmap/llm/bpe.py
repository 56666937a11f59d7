"""Byte-pair encoding by dynamic programming over prefixes, and decoding."""

from __future__ import annotations

import json
import unicodedata
from collections import Counter, deque
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmap.llm import words as W
from corpusmap.llm.shared import share, tidy

NEVER = 1 << 62
FINAL = 256  # added to the last byte of a word, which is a symbol of its own
CACHE = 150_000  # entries of a worker's memory of words and of pairs; it starts anew when full
PIECE = 1 << 20


def byte_characters() -> list[str]:
    """The printable stand-in of every byte in byte-level vocabularies: bytes that print stand for
    themselves, the others take the code points from 256 on."""
    plain = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    rest = iter(range(256, 512))
    return [chr(b if b in plain else next(rest)) for b in range(256)]


FILLED = ("pairs", "known", "special_ids", "split", "space", "marked", "rules")
BYTE_OF = {c: b for b, c in enumerate(byte_characters())}
RARE = "\u0250"  # characters from here on


class WordBpe:
    """A vocabulary with word ends, as an automaton over its tokens.

    Symbols are bytes, the last one of a word marked. Reading a word, the automaton's state is the
    longest suffix read that begins some token, and its chain of shorter states holds every token that
    ends here. A word's encoding is unique, and so is its last token for every prefix: the token whose
    rest has an encoding that ends in a token it can stand next to.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"]
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*self.vocab.values(), *self.special.values()]) + 1
        self.text = [""] * size
        for word, token in (*self.vocab.items(), *self.special.items()):
            self.text[token] = word
        self.pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}")
        self.rules_spec = json.dumps(spec | {"added_tokens": [], "model": {"type": "BPE", "vocab": {}, "merges": []}})
        self.halves: dict[int, tuple[int, int]] = {}
        self.rank: dict[int, int] = {}
        self.joined: dict[tuple[int, int], int] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            a, b, whole = self.vocab[left], self.vocab[right], self.vocab[left + right]
            self.joined[a, b] = rank
            if whole not in self.halves:
                self.halves[whole], self.rank[whole] = (a, b), rank
        self._build()
        self.ready()

    def _build(self) -> None:
        usable = set()
        for token in sorted(self.vocab.values(), key=lambda t: self.rank.get(t, -1)):
            if token not in self.halves:
                usable.add(token)
            else:
                a, b = self.halves[token]
                if a in usable and b in usable and self._meet(a, b, own=(a, b)):
                    usable.add(token)
        step: list[dict[int, int]] = [{}]
        ends: list[tuple[int, int] | None] = [None]  # (token, its symbols) that ends in a state
        for token in usable:
            word = self.text[token]
            final = word.endswith(self.suffix)
            symbols = [BYTE_OF[c] for c in (word[: -len(self.suffix)] if final else word)]
            if not symbols:
                continue
            symbols[-1] += FINAL * final
            at = 0
            for s in symbols:
                if s not in step[at]:
                    step[at][s] = len(step)
                    step.append({})
                    ends.append(None)
                at = step[at][s]
            ends[at] = (token, len(symbols))
        fall = [0] * len(step)
        shorter: list[int] = [0] * len(step)  # next state down the chain that ends a token
        todo = deque(step[0].values())
        while todo:
            at = todo.popleft()
            shorter[at] = fall[at] if ends[fall[at]] else shorter[fall[at]]
            for s, child in step[at].items():
                back = fall[at]
                while back and s not in step[back]:
                    back = fall[back]
                fall[child] = step[back].get(s, 0)
                todo.append(child)
        self.step, self.fall, self.ends, self.shorter = step, fall, ends, shorter

    def ready(self) -> None:
        """What a worker fills for itself."""
        self.pairs: dict[tuple[int, int], bool] = {}
        self.special_ids = {content: (token,) for content, token in self.special.items()}
        self.known: dict[str, tuple[int, ...]] = dict(self.special_ids)
        self.split = regex.compile(self.pattern).findall
        self.rules = None
        self.space = regex.compile(r"\p{White_Space}+")
        self.marked = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in FILLED}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.ready()

    def _meet(self, left: int, right: int, own: tuple[int, int] | None = None) -> bool:
        """Whether merging leaves the border between two tokens alone.

        While ``left`` is built up, its last part grows along its right edge, and the first part of
        ``right`` along its left edge. A merge over the border happens if its rank comes before both
        parts grow further; of two merges of one rank the left one is made first.
        """
        a, a_grows = left, NEVER
        while True:
            b, b_grows = right, NEVER
            while True:
                rank = self.joined.get((a, b))
                if rank is not None and (a, b) != own and rank < a_grows and rank <= b_grows:
                    return False
                if b not in self.halves:
                    break
                b_grows, b = self.rank[b], self.halves[b][0]
            if a not in self.halves:
                return True
            a_grows, a = self.rank[a], self.halves[a][1]

    def encode_words(self, words: list[bytes]) -> list[tuple[int, ...]]:
        """Ids of sorted words of at least one byte each.

        What the words share with their predecessor has been worked out already: state, last token and
        its start are kept for every prefix of the word before.
        """
        step, fall, ends, shorter, pairs = self.step, self.fall, self.ends, self.shorter, self.pairs
        longest = max(map(len, words), default=0) + 1
        states, last, start = [0] * longest, [0] * longest, [0] * longest
        out, before = [], b""
        for word in words:
            n = len(word)
            i = 0
            most = min(len(before), n) - 1  # the last byte of a word is another symbol than one inside
            while i < most and before[i] == word[i]:
                i += 1
            before = word
            while i < n:
                s = word[i]
                at = states[i]
                i += 1
                if i == n:
                    s += FINAL
                while at and s not in step[at]:
                    at = fall[at]
                states[i] = at = step[at].get(s, 0)
                state = at if ends[at] else shorter[at]
                while state:
                    token, size = ends[state]
                    j = i - size
                    if j == 0:
                        break
                    if last[j] >= 0:
                        pair = (last[j], token)
                        fits = pairs.get(pair)
                        if fits is None:
                            if len(pairs) > CACHE:
                                pairs.clear()
                            fits = pairs[pair] = self._meet(*pair)
                        if fits:
                            break
                    state = shorter[state]
                if state:
                    last[i], start[i] = token, j
                else:
                    last[i] = -1
            ids = []
            while i:
                ids.append(last[i])
                i = start[i]
            out.append(tuple(reversed(ids)))
        return out

    def words(self, text: str) -> list[str]:
        """The words of a text in normal form and lower case; special tokens stand for themselves.

        Which of the rarer characters are letters, and what lower case they have, differs between
        Unicode versions; parts with such characters are split by the vocabulary's own rules.
        """
        if "<|" not in text:
            try:
                text.encode("latin-1")
                return self.split(text.lower())
            except UnicodeEncodeError:
                pass
        out: list[str] = []
        for k, part in enumerate(self.marked.split(text) if self.marked else [text]):
            if k % 2:
                out.append(part)
            else:
                for chunk in self.space.split(part):
                    out.extend(self._chunk_words(chunk))
        return out

    def _chunk_words(self, chunk: str) -> list[str]:
        if max(chunk, default="") < RARE:
            return self.split("".join([c.lower() for c in unicodedata.normalize("NFC", chunk)]))
        if self.rules is None:
            from tokenizers import Tokenizer

            self.rules = Tokenizer.from_str(self.rules_spec)
        parts = self.rules.pre_tokenizer.pre_tokenize_str(self.rules.normalizer.normalize_str(chunk))
        return [bytes(map(BYTE_OF.__getitem__, word)).decode() for word, _ in parts]

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of whole texts; words not met before are worked out together."""
        parted = [self.words(text) for text in texts]
        counts = Counter(chain.from_iterable(parted))
        here = {word: self.known[word] for word in counts.keys() & self.known.keys()}
        fresh = sorted(word.encode() for word in counts.keys() - here.keys())
        new = dict(zip([word.decode() for word in fresh], self.encode_words(fresh)))
        here.update(new)
        out = [np.fromiter(chain.from_iterable(map(here.__getitem__, words)), np.int32) for words in parted]
        # most words come once and never again
        self.known.update((word, ids) for word, ids in new.items() if counts[word] > 1)
        if len(self.known) > CACHE:
            self.known = dict(self.special_ids)
        return out

    def decode(self, ids: list[int]) -> str:
        """The tokens' strings joined by blanks, as a vocabulary without a decoder has it."""
        return " ".join(map(self.text.__getitem__, ids))


def _lists(rows: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([len(r) for r in rows], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.empty(0, np.int32), *rows])))


def load(spark: SparkSession, path: str):
    """The vocabulary in ``path``, read once on the driver and sent to the workers.

    Its size is that of the vocabulary file, a few MB, whatever the data.
    """
    return share(spark, WordBpe(path))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and ``ids`` (array of int) of every row's whole text, without a shuffle.

    A null text counts as empty; it and a text of white space have no ids. Strings of special tokens
    in a text become those tokens. Repeated rows and null ids keep their rows, an empty table gives
    none; other columns are ignored, whatever their names.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(text_col, F.lit("")).alias("_text"))
    shared = load(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared()
        for piece in W.pieces(batches, "_text", PIECE):
            ids = model.encode_batch(piece.column("_text").to_pylist())
            yield pa.RecordBatch.from_arrays([piece.column("_id"), _lists(ids)], names=["_id", "ids"])

    return rows.mapInArrow(tidy(run), f"_id {dict(rows.dtypes)['_id']}, ids array<int>").withColumnRenamed("_id", id_col)


def encode_and_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As ``encode``, with ``decoded``, the text that the ids decode to; one pass through Python."""
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(text_col, F.lit("")).alias("_text"))
    shared = load(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared()
        for piece in W.pieces(batches, "_text", PIECE):
            ids = model.encode_batch(piece.column("_text").to_pylist())
            texts = [model.decode(row.tolist()) for row in ids]
            yield pa.RecordBatch.from_arrays(
                [piece.column("_id"), _lists(ids), pa.array(texts, pa.string())], names=["_id", "ids", "decoded"]
            )

    schema = f"_id {dict(rows.dtypes)['_id']}, ids array<int>, decoded string"
    return rows.mapInArrow(tidy(run), schema).withColumnRenamed("_id", id_col)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """id and ``decoded`` of rows of ``ids``; null ids decode to an empty text, unknown ids fail."""
    rows = encoded.select(F.col(id_col).alias("_id"), F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    shared = load(encoded.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared()
        for batch in batches:
            texts = [model.decode(row) for row in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(texts, pa.string())], names=["_id", "decoded"])

    return rows.mapInArrow(tidy(run), f"_id {dict(rows.dtypes)['_id']}, decoded string").withColumnRenamed("_id", id_col)
