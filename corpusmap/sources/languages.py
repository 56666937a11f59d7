"""Language table: which language a namespace is written in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmap.functions.checks import must
from corpusmap.session import broadcast_if_small, exists

# Language name, ISO 639-1 code, namespace.
LANGUAGES = [
    ("Chinese", "zh", "zhwiki_namespace_0"),
    ("English", "en", "enwiki_namespace_0"),
    ("French", "fr", "frwiki_namespace_0"),
    ("Spanish", "es", "eswiki_namespace_0"),
    ("Portuguese", "pt", "ptwiki_namespace_0"),
    ("German", "de", "dewiki_namespace_0"),
    ("Italian", "it", "itwiki_namespace_0"),
    ("Russian", "ru", "ruwiki_namespace_0"),
    ("Japanese", "ja", "jawiki_namespace_0"),
    ("Korean", "ko", "kowiki_namespace_0"),
    ("Vietnamese", "vi", "viwiki_namespace_0"),
    ("Thai", "th", "thwiki_namespace_0"),
    ("Arabic", "ar", "arwiki_namespace_0"),
    ("Egyptian Arabic", "arz", "arzwiki_namespace_0"),
]

# The header names a language file must carry.
HEADER = {"language": "Language", "iso_code": "ISO 639-1 Code", "namespace": "Namespace"}


class LanguageDataError(Exception):
    """The language file does not hold what it must."""


def read_language_csv(spark: SparkSession, path: str) -> DataFrame:
    """Load and check a language file; raises on a wrong header, an empty field or no rows."""
    if not exists(spark, path):
        raise FileNotFoundError(f"language file not found: {path}")
    raw = spark.read.csv(path, header=True, enforceSchema=False)
    missing = [name for name in HEADER.values() if name not in raw.columns]
    if missing:
        raise LanguageDataError(f"header lacks {missing}, has {raw.columns}")
    # One small file is one partition, so this id follows the line order.
    raw = raw.select(
        *[F.col(f"`{source}`").alias(name) for name, source in HEADER.items()],
        F.monotonically_increasing_id().alias("line_no"),
    )
    checks = raw.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(_has_empty_field()).alias("bad"),
    ).first()
    if checks["rows"] == 0:
        raise LanguageDataError("the language file holds no rows")
    if checks["bad"]:
        raise LanguageDataError(f"{checks['bad']} rows have an empty field")
    return last_row_per_language(raw)


def _has_empty_field():
    empty = F.lit(False)
    for name in HEADER:
        empty = empty | (F.trim(F.coalesce(F.col(name), F.lit(""))) == "")
    return empty


def last_row_per_language(raw: DataFrame) -> DataFrame:
    """Strip the fields; of rows that name the same language the last line counts."""
    trimmed = raw.select(*[F.trim(F.col(name)).alias(name) for name in HEADER], "line_no")
    return trimmed.groupBy("language").agg(
        F.max_by("iso_code", "line_no").alias("iso_code"),
        F.max_by("namespace", "line_no").alias("namespace"),
        F.min("line_no").alias("line_no"),
    )


def namespace_index(languages: DataFrame) -> DataFrame:
    """One row per namespace; of languages that share one, the last in the file counts, or by name
    where the table has no line numbers."""
    order = "line_no" if "line_no" in languages.columns else "language"
    return languages.groupBy("namespace").agg(F.max_by("language", order).alias("language"))


def with_language(df: DataFrame, languages: DataFrame, strict: bool = True) -> DataFrame:
    """Add ``language`` by namespace; ``strict`` fails on a namespace that is not listed.

    The language table has one row per language edition, a few hundred, so it is broadcast after a
    count; a join by shuffle would put a whole namespace into one task.
    """
    joined = df.join(broadcast_if_small(namespace_index(languages)), "namespace", "left")
    if not strict:
        return joined
    return must(joined, F.col("language").isNotNull(), F.concat(F.lit("no language for namespace "), F.col("namespace")))
