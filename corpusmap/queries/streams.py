"""Change streams and replay (group H), and the archive scans that need files (A1)."""

from __future__ import annotations

import datetime
import io
import tarfile

import pandas as pd
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import functions as F

from corpusmap import fixtures as fx
from corpusmap.fixtures import with_views
from corpusmap.operators import selection
from corpusmap.operators.parts import PartedTable
from corpusmap.queries.registry import query
from corpusmap.queries.sources import page_lines
from corpusmap.session import new_folder
from corpusmap.sources import archives, articles, hourly
from corpusmap.streaming import changes


def pack_archives(lines, folder):
    """Write page lines as ``folder/{namespace}/part-*.tar.gz``, one per Arrow batch and namespace, each
    with a page member followed by a member that counts its lines."""

    def run(batches):
        for number, batch in enumerate(batches):
            for namespace, rows in batch.groupby("namespace"):
                files, local = pafs.FileSystem.from_uri(folder) if "://" in folder else (pafs.LocalFileSystem(), folder)
                files.create_dir(f"{local}/{namespace}")
                packed = io.BytesIO()
                with tarfile.open(fileobj=packed, mode="w:gz") as tar:
                    counted = f'{{"count": {len(rows)}}}\n'
                    for name, text in (("pages.ndjson", "\n".join(rows["line"]) + "\n"), ("count.ndjson", counted)):
                        data = text.encode()
                        info = tarfile.TarInfo(name)
                        info.size = len(data)
                        tar.addfile(info, io.BytesIO(data))
                path = f"{local}/{namespace}/part-{TaskContext.get().partitionId()}-{number}.tar.gz"
                with files.open_output_stream(path, compression=None) as out:
                    out.write(packed.getvalue())
                yield pd.DataFrame({"archives": [1]})

    return lines.select("namespace", "line").mapInPandas(run, "archives int").agg(F.sum("archives")).first()[0]


def _folder(spark, label):
    folder = new_folder(spark, label)
    return folder[len("file:"):] if folder.startswith("file:/") and "://" not in folder else folder


@query("a1_archive_scan", with_views("page_log", """
    SELECT namespace, page_id, title, url, abstract FROM page_log"""))
def a1(spark, sf):
    folder = _folder(spark, "archives")
    pack_archives(page_lines(spark, sf), folder)
    pages = articles.pages_from_lines(archives.read_archives(spark, folder))
    return pages.select("namespace", "page_id", "title", "url", "abstract")


@query("a1_archives_of_a_namespace", with_views("page_log", """
    SELECT namespace, page_id, title FROM page_log WHERE namespace IN ('enwiki_namespace_0', 'frwiki_namespace_0')"""))
def a1_some(spark, sf):
    """Only the archives of two namespaces are opened."""
    folder = _folder(spark, "archives")
    pack_archives(page_lines(spark, sf), folder)
    lines = archives.read_archives(spark, folder, namespaces={"enwiki_namespace_0", "frwiki_namespace_0"})
    return articles.pages_from_lines(lines).select("namespace", "page_id", "title")


@query("a1b_all_members_scan", with_views("page_log", """
    SELECT namespace, 'pages.ndjson' AS member, count(*) AS lines FROM page_log GROUP BY namespace
    UNION ALL SELECT namespace, 'count.ndjson', count(*) FROM page_log GROUP BY namespace"""))
def a1b(spark, sf):
    """Lines per member; a count member stands for as many lines as it says."""
    folder = _folder(spark, "archives")
    pack_archives(page_lines(spark, sf), folder)
    lines = archives.read_archives(spark, folder, members="all")
    weight = F.coalesce(F.get_json_object("line", "$.count").cast("bigint"), F.lit(1))
    weight = F.when(F.col("member") == "count.ndjson", weight).otherwise(F.lit(1))
    return lines.groupBy("namespace", "member").agg(F.sum(weight).cast("bigint").alias("lines"))


EVENT_COLUMNS = ("namespace", "identifier", "name", "abstract")


def event_files(spark, sf, kind):
    """The change records as landed files, in a few files per run."""
    folder = new_folder(spark, "landed")
    rows = fx.article_events(spark, sf)
    writer = rows.repartition(4, F.col("event.offset")).write
    writer.json(folder) if kind == "json" else writer.parquet(folder)
    return folder, rows.schema


@query("h1_change_stream", """
    SELECT user_id % 4 AS part, event_type, count(*) AS records, min(event_id) AS first_offset, max(event_id) AS last_offset
    FROM events GROUP BY 1, 2""")
def h1(spark, sf):
    """Every record delivered once, over several micro-batches, and counted by partition and type."""
    folder, schema = event_files(spark, sf, "json")
    out = new_folder(spark, "delivered")

    def handle(batch, batch_id):
        batch.select("event.*").write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    stream = changes.article_stream(spark, folder, schema, "json", files_per_batch=2)
    changes.deliver(stream, handle, new_folder(spark, "offsets")).awaitTermination()
    rows = spark.read.schema(schema["event"].dataType).parquet(out)
    return rows.groupBy(F.col("partition").alias("part"), F.col("eventType").alias("event_type")).agg(
        F.count(F.lit(1)).alias("records"), F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset")
    )


def land_hours(rows, folder):
    """Write change records as ``folder/YYYY-MM-DD/HH/part-*.ndjson`` by their time of publication."""

    def run(batches):
        for number, batch in enumerate(batches):
            for hour, lines in batch.groupby("hour"):
                files, local = pafs.FileSystem.from_uri(folder) if "://" in folder else (pafs.LocalFileSystem(), folder)
                files.create_dir(f"{local}/{hour}")
                with files.open_output_stream(f"{local}/{hour}/part-{TaskContext.get().partitionId()}-{number}.ndjson") as out:
                    out.write(("\n".join(lines["line"]) + "\n").encode())
                yield pd.DataFrame({"files": [1]})

    hour = F.date_format("event.datePublished", "yyyy-MM-dd/HH")
    lines = rows.select(hour.alias("hour"), F.to_json(F.struct(*rows.columns)).alias("line")).repartition("hour").sortWithinPartitions("hour")
    return lines.mapInPandas(run, "files int").agg(F.sum("files")).first()[0]


@query("h1_hourly_changes", """
    SELECT user_id % 4 AS part, event_type, count(*) AS records, min(event_id) AS first_offset, max(event_id) AS last_offset
    FROM events WHERE ts >= TIMESTAMP '2024-01-03 00:00:00' AND (user_id % 4 <> 2 OR event_id >= 3000) GROUP BY 1, 2""")
def h1_hourly(spark, sf):
    """Hourly folders as a stream from a first hour on, one partition from an offset on; every line once."""
    folder, out = _folder(spark, "hours"), new_folder(spark, "delivered")
    rows = fx.article_events(spark, sf)
    land_hours(rows, folder)

    def handle(batch, batch_id):
        batch.select("event.*").write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    stream = hourly.hourly_changes(spark, folder, rows.schema, since="2024-01-03/00", offsets={2: 3000})
    changes.deliver(stream, handle, new_folder(spark, "offsets")).awaitTermination()
    delivered = spark.read.schema(rows.schema["event"].dataType).parquet(out)
    return delivered.groupBy(F.col("partition").alias("part"), F.col("eventType").alias("event_type")).agg(
        F.count(F.lit(1)).alias("records"), F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset")
    )


@query("h2_replay", """
    SELECT user_id AS identifier, event_id AS "offset", event_type FROM events
    WHERE user_id % 4 IN (0, 2, 3) AND ts >= TIMESTAMP '2024-01-03 00:00:00'
      AND (user_id % 4 <> 2 OR event_id >= 3000) AND (user_id % 4 <> 3 OR ts >= TIMESTAMP '2024-01-20 12:00:00')""")
def h2(spark, sf):
    utc = datetime.timezone.utc
    rows = selection.replay(
        fx.article_events(spark, sf), since=datetime.datetime(2024, 1, 3, tzinfo=utc), parts=[0, 2, 3],
        offsets={2: 3000}, since_per_partition={3: datetime.datetime(2024, 1, 20, 12, tzinfo=utc)},
    )
    return rows.select("identifier", F.col("event.offset").alias("offset"), F.col("event.eventType").alias("event_type"))


LATEST = """
    SELECT namespace, identifier, name, abstract, off AS "offset" FROM article_events
    QUALIFY row_number() OVER (PARTITION BY namespace, identifier ORDER BY date_published DESC, off DESC) = 1"""


@query("h3_latest_state", with_views("article_events", LATEST))
def h3(spark, sf):
    """The stream folded into one row per article, then folded once more into a base."""
    folder, schema = event_files(spark, sf, "parquet")
    log = new_folder(spark, "log")
    stream = changes.article_stream(spark, folder, schema, "parquet", files_per_batch=1)
    changes.deliver(stream, changes.log_newest(log), new_folder(spark, "offsets")).awaitTermination()
    state, _ = changes.compact(spark, log, schema, new_folder(spark, "base"))
    return state.select(*EVENT_COLUMNS, F.col("event.offset").alias("offset"))


@query("h3_newest_events", with_views("article_events", LATEST))
def h3_batch(spark, sf):
    rows = changes.newest_events(fx.article_events(spark, sf))
    return rows.select(*EVENT_COLUMNS, F.col("event.offset").alias("offset"))


@query("h3_upserted_state", with_views("article_events", LATEST))
def h3_upserted(spark, sf):
    """The stream, each event once, laid over a table in parts batch by batch."""
    folder, schema = event_files(spark, sf, "parquet")
    table = PartedTable(spark, new_folder(spark, "articles"), schema, changes.ARTICLE_KEY, parts=8)
    stream = changes.article_stream(spark, folder, schema, "parquet", files_per_batch=2)
    changes.upsert_stream(stream, table, new_folder(spark, "offsets")).awaitTermination()
    return table.read().select(*EVENT_COLUMNS, F.col("event.offset").alias("offset"))
