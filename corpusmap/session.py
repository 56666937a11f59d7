"""Session set-up and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def local_session(app: str = "corpusmap", cpus: int | None = None) -> SparkSession:
    """Session for tests and benchmarks; a cluster brings its own."""
    cpus = cpus or os.cpu_count() or 4
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("CORPUSMAP_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; on a cluster a missing
    setting is an error, because a machine-local folder is lost with its machine.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage")
            folder = tempfile.mkdtemp(prefix="corpusmap-")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) as Spark itself sees them."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def list_folder(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, none if it is missing."""
    files, path = hadoop_path(spark, folder)
    return [entry.getPath().getName() for entry in files.listStatus(path)] if files.exists(path) else []


def exists(spark: SparkSession, path: str) -> bool:
    files, found = hadoop_path(spark, path)
    return files.exists(found)


_folders: list[str] = []


def new_folder(spark: SparkSession, label: str) -> str:
    folder = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _folders.append(folder)
    return folder


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove the folders made inside the block at its end; frames read from them end with it too."""
    before = len(_folders)
    try:
        yield
    finally:
        made = _folders[before:]
        del _folders[before:]
        for folder in made:
            drop_folder(spark, folder)


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Remove a folder made by ``new_folder``; frames read from it end with it."""
    files, path = hadoop_path(spark, folder)
    files.delete(path, True)


@contextmanager
def arrow_batches(spark: SparkSession, size: int) -> Iterator[None]:
    """Batches of at most ``size`` bytes to Python for what runs inside the block, as rows may be long."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = spark.conf.get(name, None)
    spark.conf.set(name, str(size))
    try:
        yield
    finally:
        spark.conf.unset(name) if held is None else spark.conf.set(name, held)


def cut_lineage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Parquet instead of ``checkpoint()`` files, so that later steps still read only the columns they
    use; like them it survives the loss of any executor.
    """
    spark = df.sparkSession
    folder = new_folder(spark, label)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def _held_bytes(field: T.StructField) -> Column:
    """About what one value of a column takes in memory."""
    column, kind = F.col(f"`{field.name}`"), field.dataType
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)) + 16
    if isinstance(kind, T.ArrayType) and not isinstance(kind.elementType, (T.StringType, T.BinaryType, T.ArrayType, T.StructType, T.MapType)):
        return F.coalesce(F.size(column), F.lit(0)) * 8 + 16
    if isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0)) + 16
    return F.lit(16)


def broadcast_if_small(df: DataFrame, max_rows: int = 200_000, max_bytes: int = 64 << 20) -> DataFrame:
    """Broadcast hint behind a count of rows and bytes; beyond either the planner is left to shuffle.

    Call it on narrow key tables that are already written out: the count scans them once.
    """
    width = sum((_held_bytes(field) for field in df.schema.fields), F.lit(0))
    found = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("rows"), F.sum(width).alias("bytes")).first()
    return F.broadcast(df) if found["rows"] <= max_rows and (found["bytes"] or 0) <= max_bytes else df
