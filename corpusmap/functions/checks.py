"""Checks that stop a job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def must(df: DataFrame, condition: Column, message: Column) -> DataFrame:
    """``df``; a job that meets a row without ``condition`` fails with ``message``.

    The check is a filter, so it runs whichever columns are read later, also for a count. A message that
    is NULL reads as empty.
    """
    failed = F.raise_error(F.coalesce(message, F.lit(""))).cast("boolean")
    return df.filter(F.when(F.coalesce(condition, F.lit(False)), F.lit(True)).otherwise(failed))


MODES = ("failfast", "permissive")
BROKEN = "_broken"


def json_rows(lines: DataFrame, schema: T.StructType, mode: str = "failfast") -> DataFrame:
    """``lines`` with ``line`` replaced by ``_row``, its members by ``schema``.

    A line that is no JSON object of the schema stops the job in mode ``failfast``; ``permissive`` leaves it
    to ``rejected_json``.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    parsed = parsed_json(lines, schema)
    whole = F.col("_row").isNotNull() & F.col(f"_row.{BROKEN}").isNull()
    message = F.concat(F.lit("not a JSON object of the expected shape: "), F.substring(F.coalesce("line", F.lit("")), 1, 100))
    good = must(parsed, whole, message) if mode == "failfast" else parsed.filter(whole)
    return good.withColumn("_row", F.col("_row").dropFields(BROKEN)).drop("line")


def rejected_json(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """The lines that ``json_rows`` leaves out."""
    parsed = parsed_json(lines, schema)
    return parsed.filter(F.col("_row").isNull() | F.col(f"_row.{BROKEN}").isNotNull()).drop("_row")


def parsed_json(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """``lines`` with ``_row``, the members of ``line`` by ``schema``; its member BROKEN holds a line that does not fit."""
    with_broken = T.StructType([*schema.fields, T.StructField(BROKEN, T.StringType())])
    row = F.from_json("line", with_broken, {"columnNameOfCorruptRecord": BROKEN})
    # through a generator, as the optimizer would put a copy of the parser wherever a member is read
    return lines.select("*", F.explode(F.array(row)).alias("_row"))
