"""Ordered selection that stays distributed: first n per group, first n overall, row numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmap.session import cut_lineage

# orderBy().limit(n) sends n rows of every task to a single one; past this many rows the numbering
# below is used instead.
SMALL_LIMIT = 1000


def first_n_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], n: int, rank: str | None = None
) -> DataFrame:
    """The first ``n`` rows of every group.

    The literal bound lets Spark cut each map task's output to n rows per group before the shuffle
    (WindowGroupLimit, n <= 1000), so one group holding a third of the table costs its reducer
    n rows per map task, not the group.
    """
    name = rank or "_rank"
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= F.lit(n))
    return ranked if rank else ranked.drop(name)


def number_rows(df: DataFrame, order: Sequence[Column | str], name: str = "row_no") -> DataFrame:
    """Consecutive numbers from 1 in a total order, without a single-task window.

    A range-partitioned sort gives every task a slice of the order; each slice is numbered on its
    own and written out, and the slice sizes (one row per task) give the offsets.
    """
    row_in_task = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    slices = df.orderBy(*order).select(
        "*", F.spark_partition_id().alias("_slice"), row_in_task.alias("_in_slice")
    )
    slices = cut_lineage(slices, "numbered")
    sizes = slices.groupBy("_slice").agg(F.count(F.lit(1)).alias("_size"))
    before = F.coalesce(
        F.sum("_size").over(Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0),
    )
    offsets = sizes.select("_slice", before.alias("_before"))  # one row per shuffle partition
    return (
        slices.join(F.broadcast(offsets), "_slice")
        .withColumn(name, F.col("_before") + F.col("_in_slice") + 1)
        .drop("_slice", "_in_slice", "_before")
    )


def take_in_order(df: DataFrame, order: Sequence[Column | str], n: int | None) -> DataFrame:
    """The first ``n`` rows of the whole table; all of it when ``n`` is None."""
    if n is None:
        return df
    if n <= SMALL_LIMIT:
        return df.orderBy(*order).limit(n)
    return number_rows(df, order, "_row_no").filter(F.col("_row_no") <= n).drop("_row_no")
