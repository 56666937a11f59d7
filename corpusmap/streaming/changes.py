"""Article change streams: delivery, replay and the latest state of every article.

The state is a log, not a table that is rewritten with each batch: a micro-batch is reduced to the
newest event per article and written as one folder ``batch_id=n``. Writing the same batch again
replaces its folder, so a restart neither loses nor doubles anything. Readers take the newest event
per key over the log; ``compact`` folds it into a base once in a while, after which only later batches
are read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from corpusmap.functions.checks import json_rows, rejected_json
from corpusmap.operators.parts import PartedTable
from corpusmap.operators.updates import last_per_key

ARTICLE_KEY = ["namespace", "identifier"]
EVENT_ORDER = ["event.datePublished", "event.offset"]


def article_stream(
    spark: SparkSession, path: str, schema: T.StructType, kind: str = "json", files_per_batch: int | None = None, mode: str = "failfast"
) -> DataFrame:
    """Change records as they land in a folder, one JSON line or Parquet row each.

    A line that is no record of ``schema`` stops the stream, or is left to ``rejected_lines`` in mode ``permissive``.
    """
    if kind != "json":
        return _landed(spark, path, kind, files_per_batch, schema)
    return json_rows(_lines(spark, path, files_per_batch), schema, mode).select("_row.*")


def rejected_lines(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    """The stream of lines that ``article_stream`` leaves out."""
    return rejected_json(_lines(spark, path, files_per_batch), schema)


def _landed(spark: SparkSession, path: str, kind: str, files_per_batch: int | None, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.readStream.format(kind)
    if schema is not None:
        reader = reader.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def _lines(spark: SparkSession, path: str, files_per_batch: int | None) -> DataFrame:
    return _landed(spark, path, "text", files_per_batch).select(F.col("value").alias("line")).filter(F.trim("line") != "")


def deliver(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Hand every micro-batch to ``handle(batch, batch_id)`` until the landed files are used up."""
    return (
        stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def newest_events(events: DataFrame, keys: Sequence[str] = ARTICLE_KEY) -> DataFrame:
    """One row per article: its newest event, by publication time, then by offset."""
    columns = events.columns
    ordered = events.withColumn("_published", F.col(EVENT_ORDER[0])).withColumn("_offset", F.col(EVENT_ORDER[1]))
    return last_per_key(ordered, keys, ["_published", "_offset"]).select(*columns)


def log_newest(log: str) -> Callable[[DataFrame, int], None]:
    """A batch handler that adds the newest event per article to the log folder."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        newest_events(batch).write.mode("overwrite").parquet(f"{log}/batch_id={batch_id}")

    return handle


def _logged(spark: SparkSession, log: str, schema: T.StructType, after: int) -> DataFrame:
    """Rows of the batches later than ``after``; only their folders are read."""
    with_batch = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    return spark.read.schema(with_batch).parquet(log).filter(F.col("batch_id") > after)


def latest_state(
    spark: SparkSession, log: str, schema: T.StructType, base: DataFrame | None = None, after: int = -1
) -> DataFrame:
    """Newest event of every article: the batches later than ``after`` on top of ``base``."""
    rows = _logged(spark, log, schema, after).select(*schema.fieldNames())
    return newest_events(rows if base is None else base.unionByName(rows))


def compact(
    spark: SparkSession, log: str, schema: T.StructType, target: str, base: DataFrame | None = None, after: int = -1
) -> tuple[DataFrame, int]:
    """Write the latest state as a new base, in ranges of the key. Returns it and the last batch in it,
    which later reads pass as ``after``."""
    last = _logged(spark, log, schema, after).agg(F.max("batch_id")).first()[0]
    last = after if last is None else last
    state = newest_events(_upto(_logged(spark, log, schema, after), last, schema, base))
    state.repartitionByRange(*ARTICLE_KEY).sortWithinPartitions(*ARTICLE_KEY).write.parquet(target)
    return spark.read.schema(schema).parquet(target), last


def _upto(rows: DataFrame, last: int, schema: T.StructType, base: DataFrame | None) -> DataFrame:
    # batches may go on arriving while the base is written
    rows = rows.filter(F.col("batch_id") <= last).select(*schema.fieldNames())
    return rows if base is None else base.unionByName(rows)


def upsert_into(table: PartedTable) -> Callable[[DataFrame, int], None]:
    """A batch handler that lays the newest event of every article over ``table``, unless it holds a newer one. A batch
    that comes again changes nothing."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        table.upsert(newest_events(batch, table.keys), newest=EVENT_ORDER)

    return handle


def upsert_stream(stream: DataFrame, table: PartedTable, checkpoint: str, memory: str = "1 hour") -> StreamingQuery:
    """Keep ``table`` at the newest event of every article until the landed files are used up.

    Events come through once each: the state store keeps the id of every event until the watermark, ``memory`` behind the
    last arrival, has passed it. The watermark goes by arrival, as one by publication would drop events that come late;
    it bounds the state only. A copy that arrives after that changes nothing, as the table holds the same event or a newer
    one by then. Events without an id are told apart by partition and offset.
    """
    event = F.col("event")
    known = F.coalesce(event["identifier"], F.concat_ws("/", event["partition"], event["offset"]))
    arrived = stream.select("*", F.current_timestamp().alias("_arrived"), known.alias("_event"))
    once = arrived.withWatermark("_arrived", memory).dropDuplicatesWithinWatermark(["_event"]).drop("_arrived", "_event")
    return deliver(once, upsert_into(table), checkpoint)
