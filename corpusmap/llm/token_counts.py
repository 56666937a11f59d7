"""Token totals by source, language and tokenizer version, kept up to date by signed changes."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmap.llm import words as W
from corpusmap.llm.shared import share
from corpusmap.session import drop_folder, exists, list_folder

GROUP = ("source", "lang", "tokenizer")
KINDS = ("insert", "delete", "revise")


class TiktokenCounter:
    """Counts tokens by a file of ranks; the file is read on the driver only."""

    def __init__(self, name: str, path: str, pattern: str):
        self.name, self.pattern = name, pattern
        with open(path, "rb") as file:
            self.ranks = dict(line.split() for line in file if line.strip())
        self.encoding = None

    def __getstate__(self):
        return self.__dict__ | {"encoding": None}

    def __call__(self, texts: list[str]) -> list[int]:
        if self.encoding is None:
            import tiktoken

            ranks = {base64.b64decode(token): int(rank) for token, rank in self.ranks.items()}
            self.encoding = tiktoken.Encoding(self.name, pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})
        return [len(self.encoding.encode_ordinary(t)) for t in texts]


class PieceCounter:
    """Counts tokens by a sentence-piece model; the file is read on the driver only."""

    def __init__(self, name: str, path: str):
        self.name = name
        with open(path, "rb") as file:
            self.proto = file.read()
        self.model = None

    def __getstate__(self):
        return self.__dict__ | {"model": None}

    def __call__(self, texts: list[str]) -> list[int]:
        if self.model is None:
            import sentencepiece

            self.model = sentencepiece.SentencePieceProcessor(model_proto=self.proto)
        return [len(ids) for ids in self.model.encode(texts, num_threads=1)]


def count_tokens(rows: DataFrame, text: str, counter) -> DataFrame:
    """``rows`` with ``text`` replaced by ``n_tokens``; a null text has none. No shuffle.

    ``counter`` maps a list of texts to a list of counts; what it holds is a vocabulary, some MB.
    """
    keep = [c for c in rows.columns if c != text]
    shared = share(rows.sparkSession, counter)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in W.pieces(batches, text):
            held = piece.column(text).to_pylist()
            counts = shared()([t or "" for t in held])
            yield pa.RecordBatch.from_arrays(
                [*(piece.column(c) for c in keep), pa.array(np.array(counts, np.int64))], names=[*keep, "n_tokens"]
            )

    kinds = dict(rows.dtypes)
    return rows.mapInArrow(run, ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "n_tokens bigint"]))


class TokenLedger:
    """Totals that batches of changes are added to.

    ``root`` is a folder on shared storage. A batch leaves two small tables there: the state of the
    documents it changed, and the sums of its signed changes per group, written last; a batch counts
    once the second is complete. Applying a committed batch again changes nothing, and what a broken run
    left of a batch is written anew, so a batch may be retried at any time. Batches are applied in the order
    of their numbers. Every ``fold_after`` batches they are folded into a base, the state of the documents that are there and
    the totals, by the same rule; from then on only the base and later batches are read.
    """

    def __init__(self, spark: SparkSession, root: str, fold_after: int = 32):
        self.spark, self.root, self.fold_after = spark, root.rstrip("/"), fold_after

    def _folder(self, table: str, batch: int) -> str:
        return f"{self.root}/{table}/batch={batch}"

    def is_committed(self, batch: int) -> bool:
        return exists(self.spark, f"{self._folder('deltas', batch)}/_SUCCESS")

    def batches(self) -> list[int]:
        """Numbers of the committed batches."""
        found = [int(name[6:]) for name in list_folder(self.spark, f"{self.root}/deltas") if name.startswith("batch=")]
        return sorted(b for b in found if self.is_committed(b))

    def _read(self, table: str, batches: list[int]) -> DataFrame:
        return self.spark.read.option("basePath", f"{self.root}/{table}").parquet(*(self._folder(table, b) for b in batches))

    def _base_folder(self, upto: int) -> str:
        return f"{self.root}/base/upto={upto}"

    def base(self) -> int | None:
        """The last batch that is folded into the base, None without one."""
        found = [int(name[5:]) for name in list_folder(self.spark, f"{self.root}/base") if name.startswith("upto=")]
        return max((b for b in found if exists(self.spark, f"{self._base_folder(b)}/deltas/_SUCCESS")), default=None)

    def _since(self) -> list[int]:
        base = self.base()
        return [b for b in self.batches() if base is None or b > base]

    def _rows(self, table: str) -> DataFrame | None:
        """All rows of a table: those of the base, with its last batch, and of the batches since."""
        base, since = self.base(), self._since()
        rows = self._read(table, since) if since else None
        if base is not None:
            folded = self.spark.read.parquet(f"{self._base_folder(base)}/{table}").withColumn("batch", F.lit(base))
            rows = folded if rows is None else folded.unionByName(rows)
        return rows

    def fold(self) -> int | None:
        """Fold all batches into a base and remove the states that it replaces; returns its last batch."""
        base, batches = self.base(), self.batches()
        if not batches or batches[-1] == base:
            return base
        upto = batches[-1]
        _latest(self._rows("state")).filter("live").write.mode("overwrite").parquet(f"{self._base_folder(upto)}/state")
        _summed(self._rows("deltas")).write.mode("overwrite").parquet(f"{self._base_folder(upto)}/deltas")
        for batch in batches:  # the small tables of deltas stay, as they tell which batches have been applied
            drop_folder(self.spark, self._folder("state", batch))
        if base is not None:
            drop_folder(self.spark, self._base_folder(base))
        return upto

    def apply(self, batch: int, changes: DataFrame, counter, id_col: str = "doc_id") -> bool:
        """Apply one batch; False if it had been committed before.

        ``changes`` has the id, ``change`` (insert, delete or revise), source, lang and text. Insert and
        revise both set a document to the given row, a delete of an unknown document is nothing. If a batch has
        several changes of one id, one with the largest ``seq`` counts (rows without that column are
        alike), of these one by a fixed order of their values. Null source, language and text are values
        like others, a null text has no tokens; all null ids are one document. An unknown change fails.
        Other columns are ignored, whatever their names. An empty batch is committed like others.
        """
        if self.is_committed(batch):
            return False
        earlier = self.batches()
        if earlier and batch < earlier[-1]:
            raise ValueError(f"batch {batch} comes after batch {earlier[-1]}")
        seq = F.col("seq") if "seq" in changes.columns else F.lit(0)
        rows = changes.select(
            F.col(id_col).alias("_id"), "change", "source", "lang", seq.cast("long").alias("_seq"),
            F.when(F.col("change") != "delete", F.col("text")).alias("_text"),
        ).filter(F.when(F.col("change").isin(*KINDS), True).otherwise(F.raise_error(F.concat(F.lit("unknown change: "), F.coalesce("change", F.lit("null"))))))
        counted = count_tokens(rows, "_text", counter)  # texts end here; what is shuffled is narrow
        new = F.struct("_seq", (F.col("change") != "delete").alias("live"), "n_tokens", "source", "lang")
        state = counted.groupBy("_id").agg(F.max(new).alias("s")).select(
            "_id", "s.live", "s.source", "s.lang", F.lit(counter.name).alias("tokenizer"), "s.n_tokens"
        )
        state.write.mode("overwrite").parquet(self._folder("state", batch))
        state = self.spark.read.parquet(self._folder("state", batch))

        signed = state.filter("live").select(*GROUP, F.lit(1).alias("_sign"), "n_tokens")
        if earlier:
            ids = state.select(F.col("_id").alias("_changed"))
            before = self._rows("state").join(ids, F.col("_id").eqNullSafe(F.col("_changed")), "left_semi")
            last = _latest(before)
            signed = signed.unionByName(last.filter("live").select(*GROUP, F.lit(-1).alias("_sign"), "n_tokens"))
        deltas = signed.groupBy(*GROUP).agg(
            F.sum("_sign").cast("long").alias("n_docs"), F.sum(F.col("_sign") * F.col("n_tokens")).alias("n_tokens")
        )
        deltas.write.mode("overwrite").parquet(self._folder("deltas", batch))
        if len(self._since()) >= self.fold_after:
            self.fold()
        return True

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, n_docs, n_tokens of the groups that have documents."""
        batches = self.batches()
        if not batches:
            return self.spark.createDataFrame([], "source string, lang string, tokenizer string, n_docs bigint, n_tokens bigint")
        return _summed(self._rows("deltas"))


def _latest(states: DataFrame) -> DataFrame:
    """The last state of every document, of several in one batch one by a fixed order."""
    return states.groupBy("_id").agg(F.max(F.struct("batch", "live", "n_tokens", *GROUP)).alias("s")).select("_id", "s.*")


def _summed(deltas: DataFrame) -> DataFrame:
    """Totals of the groups that have documents."""
    summed = deltas.groupBy(*GROUP).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
    return summed.filter("n_docs <> 0")
