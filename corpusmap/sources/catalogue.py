"""Landed catalogue listings: codes, languages, projects, namespaces, snapshots, chunks, batches."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmap.functions.checks import json_rows, rejected_json
from corpusmap.operators.updates import upsert_chunks
from corpusmap.schemas import CATALOGUE


def _schema(kind: str):
    if kind not in CATALOGUE:
        raise ValueError(f"kind must be one of {sorted(CATALOGUE)}, got {kind!r}")
    return CATALOGUE[kind]


def read_catalogue(spark: SparkSession, kind: str, path: str, mode: str = "failfast") -> DataFrame:
    """A listing as a table; partition folders such as ``dt=/hour=`` become columns.

    A line that is no entry of the listing stops the job, or is left to ``rejected_catalogue`` over
    ``catalogue_lines`` in mode ``permissive``.
    """
    return parse_catalogue(catalogue_lines(spark, path), kind, mode)


def catalogue_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of a listing's files; empty ones are left out, as a file's last line end makes one."""
    return spark.read.text(path).withColumnRenamed("value", "line").filter(F.trim("line") != "")


def parse_catalogue(lines: DataFrame, kind: str, mode: str = "failfast") -> DataFrame:
    """A listing from a ``line`` column; modes as for articles."""
    kept = [c for c in lines.columns if c != "line"]
    return json_rows(lines, _schema(kind), mode).select(*kept, "_row.*")


def rejected_catalogue(lines: DataFrame, kind: str) -> DataFrame:
    return rejected_json(lines, _schema(kind))


def by_identifier(listing: DataFrame, identifier: str | int) -> DataFrame:
    return listing.filter(F.col("identifier") == identifier)


def batch_prefix(time: Column) -> Column:
    return F.concat(F.lit("batches/"), F.date_format(time, "yyyy-MM-dd"), F.lit("/"), F.date_format(time, "HH"))


def batches_of_hour(batches: DataFrame, time: datetime.datetime) -> DataFrame:
    """Batches of one hour; on a table partitioned by ``dt`` and ``hour`` only that folder is read."""
    return batches.filter((F.col("dt") == f"{time:%Y-%m-%d}") & (F.col("hour") == f"{time:%H}"))


def read_batches_of_hour(spark: SparkSession, root: str, time: datetime.datetime, mode: str = "failfast") -> DataFrame:
    """The listing that landed under ``root/batches/YYYY-MM-DD/HH``."""
    return read_catalogue(spark, "batches", f"{root}/batches/{time:%Y-%m-%d}/{time:%H}", mode)


def register_chunks(
    chunks: DataFrame, listing: DataFrame, namespace: str | Column, language: str | None = None
) -> DataFrame:
    """Chunk table with the listed chunks registered; entries without an identifier are left out."""
    if language is not None:
        listing = listing.filter(F.col("in_language.identifier") == language)
    named = listing.filter(F.col("identifier").isNotNull() & (F.col("identifier") != ""))
    owner = F.lit(namespace) if isinstance(namespace, str) else namespace
    return upsert_chunks(chunks, named.select(owner.alias("namespace"), F.col("identifier").alias("chunk_name")))
