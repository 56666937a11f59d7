"""Contiguous shards of equal bytes from global prefix sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmap.session import cut_lineage


def shard_by_bytes(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Deal all rows, in the order of their ids, to ``shards`` runs of about equal bytes.

    Rows are ranged by id and every slice reports its total; the totals of the slices before it are a
    slice's offset. A row belongs to the shard in whose stretch of bytes its middle lies, so a shard
    is at most one row off its share.

    Returns id, size (UTF-8 bytes plus 1), text_crc32, law ("bytes"), shard, slot (from 0 in each
    shard, in id order) and grown_shard (null: another number of shards moves the cuts).

    A null text counts as empty. Rows with a null id come first; rows with equal ids are ordered by
    checksum and size, and rows equal in these too are alike. An empty table gives no rows. Other
    columns are ignored, whatever their names.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    order = ["_id", "text_crc32", "size"]
    slices = cut_lineage(rows.orderBy(*order).withColumn("_slice", F.spark_partition_id()), "sharding")

    # One row per slice, that is per shuffle partition of the sort above.
    totals = slices.groupBy("_slice").agg(F.sum("size").alias("_bytes"), F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_slice",
        F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_bytes_before"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
        F.sum("_bytes").over(Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_all"),
    )
    inside = Window.partitionBy("_slice").orderBy(*order)
    placed = (
        slices.withColumn("_row", F.row_number().over(inside) - 1)
        .withColumn("_end", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .join(F.broadcast(offsets), "_slice")
        .withColumn("_row", F.col("_row") + F.col("_rows_before"))
    )
    # Twice the middle, so that it stays a whole number; decimals, as bytes times shards may pass 2^63.
    middle = (2 * (F.col("_bytes_before") + F.col("_end")) - F.col("size")).cast("decimal(28,0)")
    cut = F.floor(middle * F.lit(shards) / (2 * F.col("_all")).cast("decimal(28,0)")).cast("int")
    placed = placed.withColumn("shard", F.least(cut, F.lit(shards - 1)))

    firsts = placed.groupBy("shard").agg(F.min("_row").alias("_first"))  # one row per shard
    return placed.join(F.broadcast(firsts), "shard").select(
        F.col("_id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("_row") - F.col("_first")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
