"""Scan of ``*.tar.gz`` chunks of newline JSON, one task per archive, nothing unpacked to disk.

gzip cannot be split, so the archive is the unit of work; lines stream through the task in Arrow
batches and are never held whole.
"""

from __future__ import annotations

import re
import tarfile
from collections.abc import Collection, Iterator, Sequence

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from corpusmap.session import hadoop_path

BATCH_LINES = 4096
BATCH_BYTES = 16 << 20
COLUMNS = "namespace string, chunk_name string, archive string, member string, line_no bigint, line string"


class ArchiveError(ValueError):
    """An archive is empty or does not start with a regular file."""


class ArchivePartition(InputPartition):
    def __init__(self, path: str):
        self.path = path


def place_of(path: str) -> dict[str, str | None]:
    """The columns that an archive's path gives: ``.../{namespace}/{chunk_name}.tar.gz``."""
    archive = re.sub("^file:/+", "/", path)
    parts = archive.split("/")
    return {"namespace": parts[-2] if len(parts) > 1 else None, "chunk_name": parts[-1].removesuffix(".tar.gz"), "archive": archive}


def list_archives(spark: SparkSession, path: str) -> list[str]:
    """Archive paths for a file, a folder or a pattern, as the session's file systems see them: one listing,
    recursive for a folder."""
    files, found = hadoop_path(spark, path)
    matches = files.globStatus(found)
    if not matches:
        raise FileNotFoundError(f"no such archive: {path}")
    out: list[str] = []
    for match in matches:
        if not match.isDirectory():
            out.append(match.getPath().toString())
            continue
        below = files.listFiles(match.getPath(), True)
        while below.hasNext():
            name = below.next().getPath().toString()
            if name.endswith(".tar.gz"):
                out.append(name)
    return sorted(out)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme of the file system it is on."""
    files, found = hadoop_path(spark, path)
    return files.makeQualified(found).toString()


def open_filesystem(path: str):
    if "://" in path:
        return pafs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    return pafs.LocalFileSystem(), path.removeprefix("file:")


class ArchiveReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.members = options.get("members", "first")
        if self.members not in ("first", "all"):
            raise ValueError(f"option members must be first or all, got {self.members!r}")

    def partitions(self):
        return [ArchivePartition(p) for p in self.path.split("\n") if p]

    def read(self, partition) -> Iterator[pa.RecordBatch]:
        if partition is None:  # no archive is left
            return
        files, local = open_filesystem(partition.path)
        with files.open_input_stream(local, compression=None) as raw, tarfile.open(fileobj=raw, mode="r|gz") as tar:
            seen = 0
            for member in tar:
                seen += 1
                if member.isfile():
                    yield from _line_batches(partition.path, member.name, tar.extractfile(member))
                elif self.members == "first":
                    raise ArchiveError(f"first member of {partition.path} is not a regular file")
                if self.members == "first":
                    break
            if not seen and self.members == "first":
                raise ArchiveError(f"{partition.path} is empty")


def _line_batches(archive: str, member: str, lines) -> Iterator[pa.RecordBatch]:
    numbers: list[int] = []
    texts: list[str] = []
    size = 0
    for number, line in enumerate(lines, start=1):
        numbers.append(number)
        texts.append(line.decode("utf-8").rstrip("\r\n"))
        size += len(line)
        if len(texts) == BATCH_LINES or size >= BATCH_BYTES:
            yield _batch(archive, member, numbers, texts)
            numbers, texts, size = [], [], 0
    if texts:
        yield _batch(archive, member, numbers, texts)


def _batch(archive: str, member: str, numbers: list[int], texts: list[str]) -> pa.RecordBatch:
    n, place = len(texts), place_of(archive)
    return pa.RecordBatch.from_arrays(
        [*(pa.array([value] * n, pa.string()) for value in place.values()), pa.array([member] * n), pa.array(numbers, pa.int64()), pa.array(texts, pa.string())],
        names=[*place, "member", "line_no", "line"],
    )


class ChunkArchiveSource(DataSource):
    """``spark.read.format("chunk_archive").option("members", "first" | "all").load(paths)``, one archive per
    line; ``read_archives`` finds them."""

    @classmethod
    def name(cls):
        return "chunk_archive"

    def schema(self):
        return COLUMNS

    def reader(self, schema):
        return ArchiveReader(self.options)


def read_archives(
    spark: SparkSession, path: str | Sequence[str], members: str = "first", namespaces: Collection[str] | None = None,
    chunks: Collection[str] | None = None,
) -> DataFrame:
    """Lines of the archives; namespace and chunk name come from ``.../{namespace}/{chunk}.tar.gz``.

    ``path`` is a file, folder or pattern, or a list of archives, which is taken as it is. Paths without a
    scheme are on the cluster's default file system. Only archives of the given namespaces and chunks are opened. That is
    an argument and no pushed filter, as scans of one Python source share what was pushed to any of them.
    """
    spark.dataSource.register(ChunkArchiveSource)
    paths = list_archives(spark, path) if isinstance(path, str) else [qualified(spark, p) for p in path]
    wanted = [
        p for p in paths
        if (namespaces is None or place_of(p)["namespace"] in namespaces) and (chunks is None or place_of(p)["chunk_name"] in chunks)
    ]
    return spark.read.format("chunk_archive").option("members", members).load("\n".join(wanted))
