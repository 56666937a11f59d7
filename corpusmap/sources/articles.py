"""Page lines and full nested articles, read from and written to JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmap.functions.checks import BROKEN, json_rows, must, parsed_json, rejected_json
from corpusmap.schemas import ARTICLE, PAGE_LINE

# Fixed value: how article dates are written.
DATE_FORMAT = "yyyy-MM-dd'T'HH:mm:ssX"
ARTICLE_DATES = ["date_created", "date_modified", "date_previously_modified"]


def parse_page_lines(lines: DataFrame) -> DataFrame:
    """Page columns for each line, with ``error`` set where a line is no page.

    The id is ``identifier``, or ``id`` where that is missing. All other input columns stay.
    """
    page = F.col("_row")
    page_id = F.coalesce(page["identifier"], page["id"])
    broken = page.isNull() | page[BROKEN].isNotNull()
    return parsed_json(lines, PAGE_LINE).select(
        *lines.columns,
        page_id.alias("page_id"),
        page["name"].alias("title"),
        page["url"].alias("url"),
        page["abstract"].alias("abstract"),
        F.when(broken, F.lit("not a JSON object of the expected shape"))
        .when(page_id.isNull(), F.lit("no page id")).alias("error"),
    )


def pages_from_lines(lines: DataFrame, mode: str = "failfast") -> DataFrame:
    """Pages of chunk lines. ``failfast`` stops at a bad line, ``permissive`` leaves it out here and
    to ``rejected_lines``."""
    parsed = parse_page_lines(lines)
    columns = ["namespace", "page_id", "title", "chunk_name", "url", "abstract", "line_no"]
    if mode == "permissive":
        return parsed.filter(F.col("error").isNull()).select(*columns)
    if mode != "failfast":
        raise ValueError(f"mode must be failfast or permissive, got {mode!r}")
    message = F.concat(F.col("error"), F.lit(": "), F.substring("line", 1, 100))
    return must(parsed, F.col("error").isNull(), message).select(*columns)


def rejected_lines(lines: DataFrame) -> DataFrame:
    parsed = parse_page_lines(lines)
    return parsed.filter(F.col("error").isNotNull()).select("namespace", "chunk_name", "line_no", "line", "error")


def _with_text_dates(schema: T.StructType) -> T.StructType:
    return T.StructType([
        T.StructField(f.name, T.StringType() if f.name in ARTICLE_DATES else f.dataType, True) for f in schema.fields
    ])


def _normalise(articles: DataFrame) -> DataFrame:
    """Missing lists become empty lists; article dates must match their one format."""
    columns: list[Column] = []
    for field in ARTICLE.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.ArrayType):
            column = F.coalesce(column, F.array().cast(field.dataType))
        elif field.name in ARTICLE_DATES:
            column = F.to_timestamp(F.nullif(column, F.lit("")), DATE_FORMAT)
        columns.append(column.alias(field.name))
    extra = [c for c in articles.columns if c not in ARTICLE.fieldNames()]
    return articles.select(*extra, *columns)


def read_articles(spark: SparkSession, path: str, mode: str = "failfast") -> DataFrame:
    """Full nested articles from newline JSON files."""
    return parse_articles(spark.read.text(path).select(F.col("value").alias("line")), mode)


def parse_articles(lines: DataFrame, mode: str = "failfast") -> DataFrame:
    """The same from a ``line`` column. ``failfast`` stops at a broken line, ``permissive`` leaves it to
    ``rejected_articles``."""
    kept = [c for c in lines.columns if c != "line"]
    return _normalise(json_rows(lines, _with_text_dates(ARTICLE), mode).select(*kept, "_row.*"))


def rejected_articles(lines: DataFrame) -> DataFrame:
    return rejected_json(lines, _with_text_dates(ARTICLE))


def article_lines(articles: DataFrame) -> DataFrame:
    """One JSON line per article, members in schema order, missing values written as null."""
    members = [c for c in ARTICLE.fieldNames() if c in articles.columns]
    options = {"timestampFormat": DATE_FORMAT, "ignoreNullFields": "false"}
    return articles.select(F.to_json(F.struct(*members), options).alias("line"))


def write_articles(articles: DataFrame, path: str) -> None:
    article_lines(articles).write.option("compression", "gzip").text(path)
