"""Tables in parts by key hash, of which a change rewrites only the parts that it touches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmap.operators.updates import replace_rows, update_columns
from corpusmap.session import broadcast_if_small, cut_lineage, exists, scratch

PART = "_part"


class PartedTable:
    """A Parquet table in folders ``_part=n``, n the hash of the key columns modulo ``parts``.

    Every change is worked out for the touched parts alone, written aside, and then takes their place by a dynamic
    partition overwrite; files of other parts stay as they are, and scans of them are pruned away. All changes here
    can be made again with the same result, so a change that was cut off is made again, not repaired. Spark
    moves a part in as a whole, one after the other: readers who need all parts of one change wait for its end.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], parts: int = 64):
        if parts < 1:
            raise ValueError(f"parts must be at least 1, got {parts}")
        self.spark, self.path, self.schema, self.keys, self.parts = spark, path.rstrip("/"), schema, list(keys), parts

    def part(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.parts)).cast("int")

    def _stored(self) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField(PART, T.IntegerType())])
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path)

    def read(self) -> DataFrame:
        return self._stored().drop(PART)

    def touched(self, changes: DataFrame) -> list[int]:
        """Parts that hold a key of ``changes``; at most ``parts`` numbers come to the driver."""
        return sorted(row[0] for row in changes.select(self.part()).distinct().collect())

    def rows_of(self, parts: Sequence[int]) -> DataFrame:
        """The rows of some parts; the other folders are not read."""
        return self._stored().filter(F.col(PART).isin(list(parts))).drop(PART)

    def write(self, rows: DataFrame, parts: Sequence[int]) -> None:
        """Put ``rows`` in the place of all rows of ``parts``. Parts left without a row keep an empty file."""
        kinds = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields]
        aside = cut_lineage(rows.select(*kinds).withColumn(PART, self.part()), "parts")  # the table is read while they are made
        left = set(parts) - {row[0] for row in aside.select(PART).distinct().collect()}
        arranged = aside.repartition(PART, F.pmod(F.xxhash64(*self.keys, F.lit(1)), F.lit(8))).sortWithinPartitions(PART, *self.keys)
        writer = arranged.write.mode("overwrite").partitionBy(PART).option("partitionOverwriteMode", "dynamic")
        writer.parquet(self.path)
        for part in sorted(left):
            self.spark.createDataFrame([], self.schema).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{PART}={part}")

    def replace(self, rows: DataFrame) -> None:
        """A whole new table."""
        with scratch(self.spark):
            self.write(rows, range(self.parts) if exists(self.spark, self.path) else [])

    def upsert(self, changes: DataFrame, newest: Sequence[str] = ()) -> list[int]:
        """Whole rows in, one per key; with ``newest`` only those later than the stored row. Returns the parts rewritten."""
        with scratch(self.spark):
            changes = cut_lineage(changes, "changes")
            parts = self.touched(changes)
            if parts:
                stored = self.rows_of(parts)
                if newest:
                    changes = cut_lineage(self._later(stored, changes, newest), "later")
                    parts = self.touched(changes)
                    stored = self.rows_of(parts)
                if parts:
                    self.write(replace_rows(stored, changes, self.keys), parts)
            return parts

    def _later(self, stored: DataFrame, changes: DataFrame, newest: Sequence[str]) -> DataFrame:
        """The changes that no stored row is later than; of the table only keys and ``newest`` are read."""
        order = F.struct(*[F.col(c) for c in newest])
        keys = broadcast_if_small(changes.select(*self.keys), 1_000_000)
        held = stored.select(*self.keys, order.alias("_held")).join(keys, self.keys, "left_semi")
        joined = changes.join(held, self.keys, "left").filter(F.col("_held").isNull() | (order > F.col("_held")))
        return joined.select(*changes.columns)

    def update(self, changes: DataFrame, columns: Sequence[str]) -> list[int]:
        """Set ``columns`` of existing rows, one row of changes per key; unknown keys are ignored."""
        with scratch(self.spark):
            changes = cut_lineage(changes.select(*self.keys, *columns), "changes")
            parts = self.touched(changes)
            if parts:
                self.write(update_columns(self.rows_of(parts), changes, self.keys, columns), parts)
            return parts

    def delete(self, keys: DataFrame) -> list[int]:
        """The rows of ``keys`` out."""
        with scratch(self.spark):
            keys = cut_lineage(keys.select(*self.keys).distinct(), "keys")
            parts = self.touched(keys)
            if parts:
                self.write(self.rows_of(parts).join(keys, self.keys, "left_anti"), parts)
            return parts
