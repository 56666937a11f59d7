"""Change records in hourly folders as a stream: ``root/YYYY-MM-DD/HH/*.ndjson``.

An hour is closed once a later one has begun; until then its files may grow. The place of the stream is the last hour it
has seen and the bytes of whole lines read of each of that hour's files, so every line comes once, whenever a query stops
and starts again. Tasks are ranges of one file.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from corpusmap.functions.checks import json_rows
from corpusmap.sources.archives import BATCH_BYTES, BATCH_LINES, open_filesystem, qualified

COLUMNS = "hour string, file string, at bigint, line string"
HOUR = re.compile(r"\d{4}-\d{2}-\d{2}/\d{2}")
SPLIT = 128 << 20  # bytes of a file read by one task
TAIL = 64 << 10  # bytes read at a time in search of the last line's end


class FileRange(InputPartition):
    def __init__(self, hour: str, path: str, begin: int, end: int):
        self.hour, self.path, self.begin, self.end = hour, path, begin, end


class HourlyReader(DataSourceStreamReader):
    """Options: ``path``, ``since`` (first hour, ``YYYY-MM-DD/HH``), ``offsets`` (JSON: partition to the first event offset
    wanted of it; partitions not named come whole)."""

    def __init__(self, options):
        self.path = options["path"]
        self.since = options.get("since", "")
        if self.since and not HOUR.fullmatch(self.since):
            raise ValueError(f"option since must be an hour as YYYY-MM-DD/HH, got {self.since!r}")
        self.offsets = {int(k): int(v) for k, v in json.loads(options.get("offsets", "{}")).items()}

    def _hours(self) -> dict[str, list[pafs.FileInfo]]:
        files, root = open_filesystem(self.path)
        found: dict[str, list] = {}
        for entry in files.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True)):
            hour = "/".join(entry.path.split("/")[-3:-1])
            if entry.type == pafs.FileType.File and entry.path.endswith(".ndjson") and HOUR.fullmatch(hour) and hour >= self.since:
                found.setdefault(hour, []).append(entry)
        return found

    def _whole_lines(self, entry: pafs.FileInfo) -> int:
        """Bytes of a file up to its last line end."""
        files, _ = open_filesystem(self.path)
        with files.open_input_file(entry.path) as raw:
            end = entry.size
            while end > 0:
                begin = max(0, end - TAIL)
                raw.seek(begin)
                found = raw.read(end - begin).rfind(b"\n")
                if found >= 0:
                    return begin + found + 1
                end = begin
        return 0

    def initialOffset(self) -> dict:
        return {"hour": "", "read": {}}

    def latestOffset(self) -> dict:
        hours = self._hours()
        if not hours:
            return self.initialOffset()
        last = max(hours)
        return {"hour": last, "read": {e.path.split("/")[-1]: self._whole_lines(e) for e in hours[last]}}

    def partitions(self, start: dict, end: dict) -> list[FileRange]:
        out = []
        for hour, entries in sorted(self._hours().items()):
            if not start["hour"] <= hour <= end["hour"]:
                continue
            for entry in sorted(entries, key=lambda e: e.path):
                name = entry.path.split("/")[-1]
                begin = start["read"].get(name, 0) if hour == start["hour"] else 0
                stop = end["read"].get(name, 0) if hour == end["hour"] else entry.size
                out += [FileRange(hour, entry.path, a, min(a + SPLIT, stop)) for a in range(begin, stop, SPLIT)]
        return out

    def read(self, partition: FileRange) -> Iterator[pa.RecordBatch]:
        files, _ = open_filesystem(self.path)
        rows: list[tuple[int, str]] = []
        held = 0
        with files.open_input_file(partition.path) as raw:
            at = partition.begin
            # a line belongs to the range it begins in
            if at:
                raw.seek(at - 1)
                at += len(_rest_of_line(raw)) - 1
            else:
                raw.seek(0)
            for line in _lines(raw):
                if at >= partition.end:
                    break
                text = line.decode("utf-8").rstrip("\r\n")
                if text.strip() and self._wanted(text):
                    rows.append((at, text))
                    held += len(line)
                at += len(line)
                if len(rows) == BATCH_LINES or held >= BATCH_BYTES:
                    yield self._batch(partition, rows)
                    rows, held = [], 0
        if rows:
            yield self._batch(partition, rows)

    def _wanted(self, line: str) -> bool:
        if not self.offsets:
            return True
        try:
            event = json.loads(line).get("event") or {}
            least = self.offsets.get(event.get("partition"))
            return least is None or event.get("offset") is None or event["offset"] >= least
        except (ValueError, AttributeError):
            return True  # what is no record is for the parser to tell

    @staticmethod
    def _batch(partition: FileRange, rows: list[tuple[int, str]]) -> pa.RecordBatch:
        n = len(rows)
        return pa.RecordBatch.from_arrays(
            [pa.array([partition.hour] * n), pa.array([partition.path] * n), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string())],
            names=["hour", "file", "at", "line"],
        )

    def commit(self, end: dict) -> None:
        pass


def _lines(raw) -> Iterator[bytes]:
    rest = b""
    while block := raw.read(1 << 20):
        parts = (rest + block).split(b"\n")
        rest = parts.pop()
        for part in parts:
            yield part + b"\n"
    if rest:
        yield rest


def _rest_of_line(raw) -> bytes:
    """The bytes up to and with the next line end; the file is left behind them."""
    begin = raw.tell()
    out = b""
    while block := raw.read(TAIL):
        found = block.find(b"\n")
        if found >= 0:
            out += block[: found + 1]
            break
        out += block
    raw.seek(begin + len(out))
    return out


class HourlySource(DataSource):
    """``spark.readStream.format("hourly_changes")`` with the options of ``HourlyReader``."""

    @classmethod
    def name(cls):
        return "hourly_changes"

    def schema(self):
        return COLUMNS

    def streamReader(self, schema):
        return HourlyReader(self.options)


def hourly_changes(
    spark: SparkSession, root: str, schema: T.StructType | None = None, since: str = "", offsets: dict[int, int] | None = None,
    mode: str = "failfast",
) -> DataFrame:
    """The change records under ``root`` from the hour ``since`` on, by ``schema``; its lines with their places without one.

    ``offsets`` gives the first event offset wanted of a partition, others come whole. A line that is no record stops the
    stream, or is left out in mode ``permissive``.
    """
    spark.dataSource.register(HourlySource)
    reader = spark.readStream.format("hourly_changes").option("path", qualified(spark, root)).option("since", since)
    lines = reader.option("offsets", json.dumps(offsets or {})).load()
    return lines if schema is None else json_rows(lines.select("line"), schema, mode).select("_row.*")
