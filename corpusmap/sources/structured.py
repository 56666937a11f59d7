"""Structured contents flattened to rows: parts, links, citations, table cells, references.

Parts nest in parts and cells nest tables, which Spark schemas cannot say, so the recursive members
stay VARIANT. Each level is an array expression over the level above and the levels are exploded once
at the end: one scan, no shuffle, memory bounded by one article.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmap.functions.checks import json_rows
from corpusmap.schemas import CITATION, IMAGE, LINK, REFERENCE, STRUCTURED_CONTENT

VARIANTS = "array<variant>"
# Levels looked for at first; twice as many while there are rows on the last one.
FIRST_DEPTH = 4


def parse_contents(lines: DataFrame, keys: list[str]) -> DataFrame:
    """``line`` as VARIANT in ``content``, next to the key columns."""
    return lines.select(*keys, F.parse_json("line").alias("content"))


def parse_structured(lines: DataFrame, mode: str = "failfast") -> DataFrame:
    """Typed members of structured contents from ``line``; parts and tables stay VARIANT, missing lists
    are empty. Modes as for articles."""
    rows = json_rows(lines.select("line"), STRUCTURED_CONTENT, mode).select("_row.*")
    return rows.select(*[
        F.coalesce(F.col(f.name), F.array().cast(f.dataType)).alias(f.name) if isinstance(f.dataType, T.ArrayType)
        else F.col(f.name)
        for f in STRUCTURED_CONTENT.fields
    ])


def structured_lines(rows: DataFrame) -> DataFrame:
    """One JSON line per row of ``parse_structured``."""
    return rows.select(F.to_json(F.struct(*STRUCTURED_CONTENT.fieldNames()), {"ignoreNullFields": "false"}).alias("line"))


def _list(value: Column, path: str) -> Column:
    return F.coalesce(F.try_variant_get(value, path, VARIANTS), F.array().cast(VARIANTS))


def _text(value: Column, path: str) -> Column:
    return F.try_variant_get(value, path, "string")


def _indexed(items: Column, above: Column | None) -> Column:
    """Array of structs (path, part): the position of each item appended to the path above it."""

    def entry(item: Column, position: Column) -> Column:
        here = position.cast("string")
        path = here if above is None else F.concat(above, F.lit("."), here)
        return F.struct(path.alias("path"), item.alias("part"))

    return F.transform(items, entry)


def _all_levels(build, column: str) -> tuple[DataFrame, int]:
    """``build(depth)`` with enough levels for its last one, ``column`` plus the depth, to be empty everywhere.

    How deep the data nest is found by one aggregate over the last level for each depth tried.
    """
    depth = FIRST_DEPTH
    while True:
        levels = build(depth)
        deepest = levels.agg(F.max(F.size(f"{column}_{depth}"))).first()[0] or 0
        if deepest <= 0:
            return levels, depth
        depth *= 2


def _part_levels(contents: DataFrame, keys: list[str], depth: int) -> DataFrame:
    levels = contents.select(*keys, F.explode(F.array(
        F.struct(F.lit("infobox").alias("section"), _list(F.col("content"), "$.infoboxes").alias("roots")),
        F.struct(F.lit("article_section").alias("section"), _list(F.col("content"), "$.articleSections").alias("roots")),
    )).alias("_s")).select(*keys, "_s.section", _indexed(F.col("_s.roots"), None).alias("_level_0"))
    for level in range(1, depth + 1):
        below = F.flatten(F.transform(
            F.col(f"_level_{level - 1}"), lambda e: _indexed(_list(e["part"], "$.hasParts"), e["path"])
        ))
        levels = levels.withColumn(f"_level_{level}", below)
    return levels


def flatten_parts(contents: DataFrame, keys: list[str]) -> DataFrame:
    """Every part of infoboxes and article sections at every depth, one row each.

    ``path`` numbers the part within its parents from 0, as in ``2.0.1``. The data say how deep parts nest.
    """
    levels, depth = _all_levels(lambda d: _part_levels(contents, keys, d), "_level")
    every = F.concat(*[F.col(f"_level_{d}") for d in range(depth)])
    rows = levels.select(*keys, "section", F.explode(every).alias("_e"))
    part = F.col("_e.part")
    return rows.select(
        *keys, "section", F.col("_e.path").alias("path"),
        (F.size(F.split("_e.path", r"\.")) - 1).alias("depth"),
        _text(part, "$.name").alias("name"),
        _text(part, "$.type").alias("type"),
        _text(part, "$.value").alias("value"),
        F.coalesce(F.try_variant_get(part, "$.values", "array<string>"), F.array().cast("array<string>")).alias("part_values"),
        part.alias("part"),
    )


def _member_rows(parts: DataFrame, keys: list[str], member: str, kind: str) -> DataFrame:
    """Rows of a part's list member, numbered within the part."""
    items = F.try_variant_get(F.col("part"), f"$.{member}", f"array<{kind}>")
    return parts.select(*keys, "section", "path", F.posexplode(items).alias("position", "item")).select(
        *keys, "section", "path", "position", "item.*"
    )


def part_links(parts: DataFrame, keys: list[str]) -> DataFrame:
    return _member_rows(parts, keys, "links", LINK.simpleString())


def part_images(parts: DataFrame, keys: list[str]) -> DataFrame:
    return _member_rows(parts, keys, "images", IMAGE.simpleString())


def part_citations(parts: DataFrame, keys: list[str]) -> DataFrame:
    return _member_rows(parts, keys, "citations", CITATION.simpleString())


def _table_cells(table: Column, path: Column) -> Column:
    """Cells of one table as structs (table_path, table_id, region, row, col, value, nested)."""

    def cells(region: str) -> Column:
        def row_cells(row: Column, row_no: Column) -> Column:
            return F.transform(
                F.coalesce(row.cast(VARIANTS), F.array().cast(VARIANTS)),
                lambda cell, col_no: F.struct(
                    path.alias("table_path"), _text(table, "$.identifier").alias("table_id"),
                    F.lit(region).alias("region"), row_no.alias("row"), col_no.alias("col"),
                    _text(cell, "$.value").alias("value"),
                    F.try_variant_get(cell, "$.nested_table", "variant").alias("nested"),
                ),
            )

        return F.flatten(F.transform(_list(table, f"$.{region}"), row_cells))

    return F.concat(cells("headers"), cells("rows"), cells("footers"))


def _table_levels(contents: DataFrame, keys: list[str], depth: int) -> DataFrame:
    tables = _list(F.col("content"), "$.tables")
    first = F.flatten(F.transform(tables, lambda t, i: _table_cells(t, i.cast("string"))))
    levels = contents.select(*keys, first.alias("_cells_0"))

    def nested_path(cell: Column) -> Column:
        return F.concat(
            cell["table_path"], F.lit("/"), cell["region"], F.lit("."), cell["row"].cast("string"), F.lit("."),
            cell["col"].cast("string"),
        )

    for level in range(1, depth + 1):
        holders = F.filter(F.col(f"_cells_{level - 1}"), lambda c: c["nested"].isNotNull())
        inner = F.flatten(F.transform(holders, lambda c: _table_cells(c["nested"], nested_path(c))))
        levels = levels.withColumn(f"_cells_{level}", inner)
    return levels


def flatten_tables(contents: DataFrame, keys: list[str]) -> DataFrame:
    """Every cell of every table, tables nested in cells included at any depth.

    ``table_path`` is the table's position; a table inside a cell appends ``/region.row.col``.
    """
    levels, depth = _all_levels(lambda d: _table_levels(contents, keys, d), "_cells")
    every = F.concat(*[F.col(f"_cells_{d}") for d in range(depth)])
    rows = levels.select(*keys, F.explode(every).alias("c"))
    return rows.select(
        *keys, "c.table_path", "c.table_id", "c.region", "c.row", "c.col", "c.value",
    )


def table_rows(contents: DataFrame, keys: list[str]) -> DataFrame:
    """One row per table of the top level, with or without cells: position, id and confidence score."""
    tables = _list(F.col("content"), "$.tables")
    return contents.select(*keys, F.posexplode(tables).alias("position", "_t")).select(
        *keys, "position", _text(F.col("_t"), "$.identifier").alias("table_id"),
        F.try_variant_get(F.col("_t"), "$.confidence_score", "double").alias("confidence_score"),
    )


def references(contents: DataFrame, keys: list[str]) -> DataFrame:
    """One row per reference; missing text members read as empty strings."""
    items = F.try_variant_get(F.col("content"), "$.references", f"array<{REFERENCE.simpleString()}>")
    rows = contents.select(*keys, F.posexplode(items).alias("position", "ref"))
    blank = F.lit("")
    return rows.select(
        *keys, "position",
        F.coalesce("ref.identifier", blank).alias("identifier"),
        F.coalesce("ref.group", blank).alias("group"),
        F.coalesce("ref.type", blank).alias("type"),
        F.coalesce(F.col("ref.metadata"), F.create_map().cast("map<string,string>")).alias("metadata"),
        F.coalesce("ref.text.value", blank).alias("text"),
        F.coalesce("ref.source.value", blank).alias("source"),
    )


def reference_links(contents: DataFrame, keys: list[str]) -> DataFrame:
    """Links inside references: the reference's position, whether they stand in its text or its source, and
    their own position."""
    items = contents.select(*keys, F.posexplode(_list(F.col("content"), "$.references")).alias("position", "_r"))
    places = [
        items.select(*keys, "position", F.lit(place).alias("place"),
                     F.posexplode(F.try_variant_get(F.col("_r"), f"$.{place}.links", f"array<{LINK.simpleString()}>")).alias("link_no", "_l"))
        for place in ("text", "source")
    ]
    return places[0].unionByName(places[1]).select(*keys, "position", "place", "link_no", "_l.*")


def reference_metadata(refs: DataFrame, keys: list[str]) -> DataFrame:
    return refs.select(*keys, "position", F.explode("metadata").alias("key", "value"))
