"""Scans, sources and sinks (group A) and article selection (B15).

JSON lines are derived from the driver's tables in Spark, then parsed by the operator under test; the
oracles state the expected rows straight from the tables.
"""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from corpusmap import fixtures as fx
from corpusmap.fixtures import table, with_views
from corpusmap.operators import graph, selection
from corpusmap.queries.registry import query
from corpusmap.session import new_folder
from corpusmap.sources import articles, catalogue, columnar, languages, structured

EN = "enwiki_namespace_0"


def page_lines(spark, sf):
    """One line per page: even documents carry ``identifier``, odd ones only ``id``."""
    pages = fx.page_log(spark, sf)
    odd = F.col("page_id") % 2 == 1
    line = F.to_json(F.struct(
        F.when(~odd, F.col("page_id")).alias("identifier"), F.when(odd, F.col("page_id")).alias("id"),
        F.col("title").alias("name"), "url", "abstract",
    ))
    return pages.select("namespace", "chunk_name", F.col("page_id").alias("line_no"), line.alias("line"))


def chat_lines(spark, sf):
    """Lines that are no pages: chat turns, some as broken JSON."""
    chats = table(spark, sf, "conversations")
    whole = F.to_json(F.struct(F.col("role").alias("name"), F.col("text").alias("abstract")))
    line = F.when(F.col("turn") % 2 == 0, whole).otherwise(F.concat(F.lit("{"), F.col("role")))
    return chats.select(
        F.lit(EN).alias("namespace"), F.lit("chats").alias("chunk_name"),
        (F.col("conv_id") * 1000 + F.col("turn")).alias("line_no"), line.alias("line"),
    )


@query("a2_page_parse", with_views("page_log", """
    SELECT namespace, page_id, title, chunk_name, url, abstract, page_id AS line_no FROM page_log"""))
def a2(spark, sf):
    return articles.pages_from_lines(page_lines(spark, sf))


@query("a2_page_parse_permissive", with_views("page_log", f"""
    SELECT 'page' AS kind, namespace, chunk_name, page_id AS line_no, '' AS error FROM page_log
    UNION ALL
    SELECT 'rejected', '{EN}', 'chats', conv_id * 1000 + turn,
           CASE WHEN turn % 2 = 0 THEN 'no page id' ELSE 'not a JSON object of the expected shape' END
    FROM conversations"""))
def a2_permissive(spark, sf):
    lines = page_lines(spark, sf).unionByName(chat_lines(spark, sf))
    columns = ["kind", "namespace", "chunk_name", "line_no", "error"]
    good = articles.pages_from_lines(lines, "permissive").withColumns({"kind": F.lit("page"), "error": F.lit("")})
    bad = articles.rejected_lines(lines).withColumn("kind", F.lit("rejected"))
    return good.select(*columns).unionByName(bad.select(*columns))


def article_lines(spark, sf):
    """Nested article JSON made from the documents; absent members are left out of the text."""
    docs = table(spark, sf, "documents")
    has_scores = F.col("n_chars") % 3 == 0
    lists = F.col("n_chars") % 2 == 0
    named = F.struct(F.col("source").alias("name"), F.concat(F.lit("https://c/"), F.col("source")).alias("url"))
    line = F.to_json(F.struct(
        F.col("text").alias("name"),
        F.when(F.col("n_chars") > 500, F.col("lang")).alias("abstract"),
        F.col("doc_id").alias("identifier"),
        F.date_format(F.timestamp_seconds(F.lit(1704067200) + F.col("n_chars")), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date_modified"),
        F.when(lists, F.array(named, named)).alias("categories"),
        F.struct(F.col("lang").alias("identifier"), F.upper("lang").alias("name")).alias("in_language"),
        F.when(has_scores, F.struct(
            F.col("doc_id").alias("identifier"),
            F.struct(F.struct(
                (F.col("n_chars") > 1000).alias("prediction"),
                F.struct((F.col("n_chars") / 65536).alias("true")).alias("probability"),
            ).alias("revert_risk")).alias("scores"),
            F.struct(F.col("source").alias("name"), F.col("n_chars").alias("editCount")).alias("editor"),
        )).alias("version"),
        F.struct(F.lit("update").alias("eventType"), (F.col("doc_id") % 4).alias("partition")).alias("event"),
    ))
    return docs.select(line.alias("line"))


ARTICLE_SQL = """
    SELECT doc_id AS identifier, text AS name, CASE WHEN n_chars > 500 THEN lang END AS abstract,
           CAST(make_timestamp(1704067200000000 + n_chars * 1000000) AS VARCHAR) AS date_modified,
           CAST(CASE WHEN n_chars % 2 = 0 THEN 2 ELSE 0 END AS INT) AS category_count, CAST(0 AS INT) AS template_count,
           CASE WHEN n_chars % 2 = 0 THEN source END AS category, lang AS language,
           CASE WHEN n_chars % 3 = 0 THEN n_chars > 1000 END AS risky,
           CASE WHEN n_chars % 3 = 0 THEN round(n_chars / 65536.0, 6) END AS risk,
           CASE WHEN n_chars % 3 = 0 THEN n_chars END AS edit_count, doc_id % 4 AS part
    FROM documents"""


def article_columns(rows):
    return rows.select(
        "identifier", "name", "abstract", F.col("date_modified").cast("string").alias("date_modified"),
        F.size("categories").alias("category_count"), F.size("templates").alias("template_count"),
        F.get("categories", F.lit(0))["name"].alias("category"), F.col("in_language.identifier").alias("language"),
        F.col("version.scores.revert_risk.prediction").alias("risky"),
        F.round("version.scores.revert_risk.probability.true", 6).alias("risk"),
        F.col("version.editor.editCount").alias("edit_count"), F.col("event.partition").alias("part"),
    )


@query("a3_article_scan", ARTICLE_SQL)
def a3(spark, sf):
    return article_columns(articles.parse_articles(article_lines(spark, sf)))


@query("a3_article_files", ARTICLE_SQL)
def a3_files(spark, sf):
    folder = new_folder(spark, "articles")
    article_lines(spark, sf).write.text(folder)
    return article_columns(articles.read_articles(spark, folder))


@query("a3b_article_write", """
    SELECT CAST(doc_id AS VARCHAR) AS identifier, text AS name,
           strftime(make_timestamp(1704067200000000 + n_chars * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS date_modified,
           CASE WHEN n_chars % 2 = 0 THEN source END AS second_category,
           CASE WHEN n_chars % 2 = 0 THEN 'list' ELSE '[]' END AS categories, '[]' AS templates,
           CASE WHEN n_chars % 3 = 0 THEN CAST(n_chars AS VARCHAR) END AS edit_count
    FROM documents""")
def a3b(spark, sf):
    written = articles.article_lines(articles.parse_articles(article_lines(spark, sf)))

    def member(path):
        return F.get_json_object("line", path)

    return written.select(
        member("$.identifier").alias("identifier"), member("$.name").alias("name"),
        member("$.date_modified").alias("date_modified"),
        member("$.categories[1].name").alias("second_category"),
        F.when(member("$.categories") == "[]", F.lit("[]")).otherwise(F.lit("list")).alias("categories"),
        member("$.templates").alias("templates"), member("$.version.editor.editCount").alias("edit_count"),
    )


# ---------------------------------------------------------------- A4: structured contents
def structured_lines(spark, sf):
    """Sections are lines, their parts are sentences, those parts' parts are clauses; one table with a
    nested one; one reference with a map."""
    # the table is one small file, its structured form about twenty times as large
    docs = table(spark, sf, "documents").repartition(spark.sparkContext.defaultParallelism)

    def part(kind, value, children):
        link = F.struct(F.col("source").alias("url"), value.alias("text"))
        cite = F.struct(F.lit(kind).alias("identifier"), F.col("lang").alias("group"))
        return F.struct(
            F.lit(kind).alias("name"), F.lit(kind).alias("type"), value.alias("value"), F.array(F.col("lang")).alias("values"),
            F.array(link).alias("links"), F.array(cite).alias("citations"), children.alias("hasParts"),
        )

    def clauses(sentence):
        return F.transform(F.split(sentence, ", "), lambda c: part("clause", c, F.array()))

    def sentences(line):
        return F.transform(F.split(line, r"\. "), lambda s: part("sentence", s, clauses(s)))

    def cell(value, nested=None):
        return F.struct(value.alias("value"), (nested if nested is not None else F.lit(None).cast("string")).alias("nested_table"))

    inner = F.struct(F.array(F.array(cell(F.col("source")))).alias("rows"))
    grid = F.struct(
        F.lit("t").alias("identifier"),
        F.array(F.array(cell(F.lit("field")), cell(F.lit("content")))).alias("headers"),
        F.array(
            F.array(F.struct(F.lit("lang").alias("value"), F.lit(None).cast("struct<rows:array<array<struct<value:string,nested_table:string>>>>").alias("nested_table")),
                    F.struct(F.col("lang").alias("value"), inner.alias("nested_table"))),
        ).alias("rows"),
    )
    reference = F.struct(
        F.concat(F.lit("r"), F.col("doc_id").cast("string")).alias("identifier"),
        F.create_map(F.lit("lang"), F.col("lang"), F.lit("source"), F.col("source")).alias("metadata"),
        F.struct(F.col("source").alias("value")).alias("text"),
    )
    line = F.to_json(F.struct(
        F.col("doc_id").alias("identifier"), F.col("text").alias("name"), F.lit("2024-01-02T03:04:05Z").alias("dateModified"),
        F.struct(F.col("lang").alias("identifier")).alias("inLanguage"),
        F.struct(F.struct(F.col("n_chars").alias("editCount")).alias("editor")).alias("version"),
        F.array(part("infobox", F.col("source"), F.array())).alias("infoboxes"),
        F.transform(F.split("text", "\n"), lambda x: part("line", x, sentences(x))).alias("articleSections"),
        F.array(grid).alias("tables"), F.array(reference).alias("references"),
    ))
    return docs.select(F.col("doc_id").alias("page_id"), line.alias("line"))


def contents(spark, sf):
    return structured.parse_contents(structured_lines(spark, sf), ["page_id"])


PARTS_SQL = r"""
    lines AS (SELECT doc_id, source, lang, unnest(string_split(text, chr(10))) AS line,
                     generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents),
    sentences AS (SELECT doc_id, source, lang, i, unnest(string_split(line, '. ')) AS sentence,
                         generate_subscripts(string_split(line, '. '), 1) - 1 AS j FROM lines),
    clauses AS (SELECT doc_id, source, lang, i, j, unnest(string_split(sentence, ', ')) AS clause,
                       generate_subscripts(string_split(sentence, ', '), 1) - 1 AS k FROM sentences),
    parts AS (
      SELECT doc_id AS page_id, 'infobox' AS section, '0' AS path, 0 AS depth, 'infobox' AS type, source AS value, source, lang FROM documents
      UNION ALL SELECT doc_id, 'article_section', CAST(i AS VARCHAR), 0, 'line', line, source, lang FROM lines
      UNION ALL SELECT doc_id, 'article_section', i || '.' || j, 1, 'sentence', sentence, source, lang FROM sentences
      UNION ALL SELECT doc_id, 'article_section', i || '.' || j || '.' || k, 2, 'clause', clause, source, lang FROM clauses)"""


@query("a4_structured_parts", f"WITH {PARTS_SQL} SELECT page_id, section, path, depth, type AS name, type, value, lang AS first_of_values FROM parts")
def a4_parts(spark, sf):
    rows = structured.flatten_parts(contents(spark, sf), ["page_id"])
    return rows.select("page_id", "section", "path", "depth", "name", "type", "value", F.col("part_values")[0].alias("first_of_values"))


@query("a4_structured_links", f"WITH {PARTS_SQL} SELECT page_id, section, path, CAST(0 AS INT) AS position, source AS url, value AS text FROM parts")
def a4_links(spark, sf):
    parts = structured.flatten_parts(contents(spark, sf), ["page_id"])
    return structured.part_links(parts, ["page_id"]).drop("images")


@query("a4_structured_citations", f'WITH {PARTS_SQL} SELECT page_id, section, path, CAST(0 AS INT) AS position, type AS identifier, lang AS "group" FROM parts')
def a4_citations(spark, sf):
    parts = structured.flatten_parts(contents(spark, sf), ["page_id"])
    return structured.part_citations(parts, ["page_id"]).drop("text")


@query("a4_structured_table_cells", """
    SELECT doc_id AS page_id, '0' AS table_path, 't' AS table_id, 'headers' AS region, 0 AS row, 0 AS col, 'field' AS value FROM documents
    UNION ALL SELECT doc_id, '0', 't', 'headers', 0, 1, 'content' FROM documents
    UNION ALL SELECT doc_id, '0', 't', 'rows', 0, 0, 'lang' FROM documents
    UNION ALL SELECT doc_id, '0', 't', 'rows', 0, 1, lang FROM documents
    UNION ALL SELECT doc_id, '0/rows.0.1', NULL, 'rows', 0, 0, source FROM documents""")
def a4_cells(spark, sf):
    return structured.flatten_tables(contents(spark, sf), ["page_id"])


@query("a4_table_rows", """
    SELECT doc_id AS page_id, 0 AS position, 't' AS table_id, CAST(n_chars % 100 AS DOUBLE) / 100 AS confidence_score FROM documents
    UNION ALL SELECT doc_id, 1, 'no cells', NULL FROM documents""")
def a4_table_rows(spark, sf):
    line = F.format_string(
        '{"tables": [{"identifier": "t", "confidence_score": %s, "rows": [[{"value": "x"}]]}, {"identifier": "no cells"}]}',
        ((F.col("n_chars") % 100) / 100).cast("string"),
    )
    lines = table(spark, sf, "documents").select(F.col("doc_id").alias("page_id"), line.alias("line"))
    return structured.table_rows(structured.parse_contents(lines, ["page_id"]), ["page_id"])


NESTED = "doc_id % 12"


@query("a4_deep_parts", f"""
    SELECT doc_id AS page_id, '0' || repeat('.0', CAST(level AS INT)) AS path, CAST(level AS INT) AS depth,
           CASE WHEN level = {NESTED} THEN lang END AS value
    FROM (SELECT doc_id, lang, unnest(range(0, {NESTED} + 1)) AS level FROM documents)""")
def a4_deep_parts(spark, sf):
    """Parts nested up to twelve deep."""
    n = F.expr(f"int({NESTED})")
    line = F.concat(
        F.lit('{"infoboxes":['), F.repeat(F.lit('{"hasParts":['), n), F.to_json(F.struct(F.col("lang").alias("value"))),
        F.repeat(F.lit("]}"), n), F.lit("]}"),
    )
    lines = table(spark, sf, "documents").select(F.col("doc_id").alias("page_id"), line.alias("line"))
    parts = structured.flatten_parts(structured.parse_contents(lines, ["page_id"]), ["page_id"])
    return parts.select("page_id", "path", "depth", "value")


@query("a4_deep_tables", """
    SELECT doc_id AS page_id, '0' || repeat('/rows.0.0', CAST(level AS INT)) AS table_path, lang AS value
    FROM (SELECT doc_id, lang, unnest(range(0, doc_id % 7 + 1)) AS level FROM documents)""")
def a4_deep_tables(spark, sf):
    """Tables nested up to seven deep."""
    n = F.expr("int(doc_id % 7)")
    cell = F.concat(F.lit('{"rows":[[{"value":"'), "lang", F.lit('"'))
    line = F.concat(
        F.lit('{"tables":['), F.repeat(F.concat(cell, F.lit(',"nested_table":')), n), cell, F.lit("}]]}"),
        F.repeat(F.lit("}]]}"), n), F.lit("]}"),
    )
    lines = table(spark, sf, "documents").select(F.col("doc_id").alias("page_id"), line.alias("line"))
    cells = structured.flatten_tables(structured.parse_contents(lines, ["page_id"]), ["page_id"])
    return cells.select("page_id", "table_path", "value")


@query("a4_reference_links", """
    SELECT doc_id AS page_id, 0 AS position, 'text' AS place, 0 AS link_no, source AS url, lang AS text FROM documents
    UNION ALL SELECT doc_id, 0, 'text', 1, 'u', NULL FROM documents
    UNION ALL SELECT doc_id, 0, 'source', 0, lang, NULL FROM documents""")
def a4_reference_links(spark, sf):
    def link(url, text=None):
        return F.struct(url.alias("url"), (F.lit(None).cast("string") if text is None else text).alias("text"))

    text = F.struct(F.array(link(F.col("source"), F.col("lang")), link(F.lit("u"))).alias("links"))
    source = F.struct(F.array(link(F.col("lang"))).alias("links"))
    line = F.to_json(F.struct(F.array(F.struct(text.alias("text"), source.alias("source"))).alias("references")))
    lines = table(spark, sf, "documents").select(F.col("doc_id").alias("page_id"), line.alias("line"))
    return structured.reference_links(structured.parse_contents(lines, ["page_id"]), ["page_id"]).drop("images")


@query("a4_structured_scan", """
    SELECT doc_id AS identifier, text AS name, lang AS language, n_chars AS edit_count, CAST(1 AS INT) AS infoboxes,
           CAST(len(string_split(text, chr(10))) AS INT) AS sections, CAST(1 AS INT) AS tables, CAST(0 AS INT) AS entities,
           'r' || CAST(doc_id AS VARCHAR) AS reference, source AS reference_source, '2024-01-02 03:04:05' AS modified
    FROM documents""")
def a4_scan(spark, sf):
    """Scalar and list members of structured contents, read, written and read again."""
    keyed = structured_lines(spark, sf)
    once = structured.parse_structured(keyed.select("line"))
    rows = structured.parse_structured(structured.structured_lines(once))
    return rows.select(
        "identifier", "name", F.col("inLanguage.identifier").alias("language"), F.col("version.editor.editCount").alias("edit_count"),
        F.size("infoboxes").alias("infoboxes"), F.size("articleSections").alias("sections"), F.size("tables").alias("tables"),
        F.size("additionalEntities").alias("entities"), F.col("references")[0]["identifier"].alias("reference"),
        F.col("references")[0]["metadata"]["source"].alias("reference_source"),
        F.col("dateModified").cast("string").alias("modified"),
    )


@query("a4_structured_references", """
    SELECT doc_id AS page_id, 0 AS position, 'r' || CAST(doc_id AS VARCHAR) AS identifier, '' AS "group", source AS text,
           '' AS source, 'lang' AS key, lang AS value FROM documents
    UNION ALL SELECT doc_id, 0, 'r' || CAST(doc_id AS VARCHAR), '', source, '', 'source', source FROM documents""")
def a4_references(spark, sf):
    refs = structured.references(contents(spark, sf), ["page_id"])
    pairs = structured.reference_metadata(refs, ["page_id"])
    return refs.drop("metadata", "type").join(pairs, ["page_id", "position"])


# ---------------------------------------------------------------- A5 to A11
@query("a5_language_table", """
    SELECT language, max(iso_code) AS iso_code, arg_max(namespace, src) AS namespace, min(src) AS line_no
    FROM (SELECT upper(lang) AS language, lang AS iso_code, lang || '_' || source AS namespace,
                 CAST(substring(source, 4) AS INT) AS src FROM documents) GROUP BY language""")
def a5(spark, sf):
    raw = table(spark, sf, "documents").select(
        F.concat(F.lit(" "), F.upper("lang"), F.lit("  ")).alias("language"), F.col("lang").alias("iso_code"),
        F.concat("lang", F.lit("_"), "source", F.lit(" ")).alias("namespace"),
        F.substr("source", F.lit(4)).cast("int").alias("line_no"),
    )
    return languages.last_row_per_language(raw)


def chunk_listing_lines(spark, sf):
    """Chunk listing made from the documents; every fifth entry lacks its identifier."""
    chunks = table(spark, sf, "documents").groupBy("lang", "source").agg(F.sum("n_chars").alias("chars"))
    src = F.substr("source", F.lit(4)).cast("int")
    line = F.to_json(F.struct(
        F.when(src % 5 != 0, F.concat("lang", F.lit("_part_"), src.cast("string"))).alias("identifier"),
        F.col("source").alias("version"),
        F.struct(F.col("lang").alias("identifier")).alias("in_language"),
        F.struct(F.col("chars").cast("double").alias("value"), F.lit("B").alias("unit_text")).alias("size"),
    ))
    return chunks.select(line.alias("line"))


LISTING_SQL = """
    listing AS (SELECT lang, source, CAST(sum(n_chars) AS DOUBLE) AS size,
                       CASE WHEN CAST(substring(source, 4) AS INT) % 5 <> 0 THEN lang || '_part_' || substring(source, 4) END AS identifier
                FROM documents GROUP BY lang, source)"""


@query("a6_register_chunks", with_views("chunk_log", f"""
    WITH {LISTING_SQL}
    SELECT namespace, chunk_name, chunk_archive_path, CAST(downloaded_at AS VARCHAR) AS downloaded_at FROM chunk_log
    UNION ALL SELECT '{EN}', identifier, NULL, NULL FROM listing WHERE identifier IS NOT NULL AND lang = 'en'"""))
def a6(spark, sf):
    listing = catalogue.parse_catalogue(chunk_listing_lines(spark, sf), "chunks")
    merged = catalogue.register_chunks(fx.chunk_log(spark, sf), listing, EN, language="en")
    return merged.select("namespace", "chunk_name", "chunk_archive_path", F.col("downloaded_at").cast("string").alias("downloaded_at"))


def _listing_columns(rows):
    return rows.select("identifier", "version", F.col("in_language.identifier").alias("language"), F.col("size.value").alias("size"))


@query("a10_catalogue_list", f"WITH {LISTING_SQL} SELECT identifier, source AS version, lang AS language, size FROM listing")
def a10(spark, sf):
    return _listing_columns(catalogue.parse_catalogue(chunk_listing_lines(spark, sf), "chunks"))


@query("a10_catalogue_by_identifier", f"""
    WITH {LISTING_SQL} SELECT identifier, source AS version, lang AS language, size FROM listing WHERE identifier = 'en_part_3'""")
def a10_one(spark, sf):
    listing = catalogue.parse_catalogue(chunk_listing_lines(spark, sf), "chunks")
    return _listing_columns(catalogue.by_identifier(listing, "en_part_3"))


def hourly_batches(spark, sf):
    time = F.col("ts").cast("timestamp")
    hours = table(spark, sf, "events").groupBy(
        F.date_format(time, "yyyy-MM-dd").alias("dt"), F.date_format(time, "HH").alias("hour")
    ).agg(F.count(F.lit(1)).alias("events"), F.min(time).alias("first_time"))
    return hours


@query("a11_batch_prefixes", """
    SELECT strftime(ts, 'batches/%Y-%m-%d/%H') AS prefix, count(*) AS events FROM events GROUP BY 1""")
def a11(spark, sf):
    return hourly_batches(spark, sf).select(catalogue.batch_prefix(F.col("first_time")).alias("prefix"), "events")


@query("a11_batches_of_hour", """
    SELECT strftime(ts, '%Y-%m-%d') AS dt, strftime(ts, '%H') AS hour, count(*) AS events FROM events
    WHERE strftime(ts, '%Y-%m-%d/%H') = '2024-01-05/07' GROUP BY 1, 2""")
def a11_hour(spark, sf):
    folder = new_folder(spark, "batches")
    hourly_batches(spark, sf).drop("first_time").write.partitionBy("dt", "hour").parquet(folder)
    stored = spark.read.schema("events bigint, dt string, hour string").parquet(folder)
    return catalogue.batches_of_hour(stored, datetime.datetime(2024, 1, 5, 7, 30)).select("dt", "hour", "events")


@query("a7_columnar_conversion", with_views("page_vector", """
    SELECT namespace, page_id, CAST(len(embedding_vector) AS INT) AS dims,
           round(list_sum([CAST(x AS DOUBLE) * i FOR x, i IN embedding_vector]), 6) AS weighted,
           CAST(len(reduced_vector) AS INT) AS reduced_dims, round(CAST(three_d_vector[2] AS DOUBLE), 6) AS y
    FROM page_vector"""))
def a7(spark, sf):
    vectors = fx.page_vector(spark, sf)
    stored = vectors.withColumns({
        "embedding_vector": columnar.blob_from_floats("embedding_vector"),
        "reduced_vector": columnar.blob_from_floats("reduced_vector"),
        "three_d_vector": columnar.text_from_vector(F.col("three_d_vector")),
    })
    loaded = columnar.columnar_vectors(stored)
    weighted = F.aggregate(
        F.transform("embedding_vector", lambda x, i: x.cast("double") * (i + 1)), F.lit(0.0), lambda a, b: a + b
    )
    return loaded.select(
        "namespace", "page_id", F.size("embedding_vector").alias("dims"), F.round(weighted, 6).alias("weighted"),
        F.when(F.col("reduced_vector").isNotNull(), F.size("reduced_vector")).alias("reduced_dims"),
        F.round(F.col("three_d_vector")[1].cast("double"), 6).alias("y"),
    )


@query("a7_columnar_tree", with_views("cluster_tree placed", """
    SELECT namespace, node_id, parent_id, depth, doc_count, first_label,
           CASE WHEN depth = 2 THEN CAST(doc_count AS DOUBLE) END AS first_value, depth = 1 AS has_terms,
           CASE WHEN depth = 1 THEN 'term ' || CAST(node_id AS VARCHAR) END AS term,
           CASE WHEN depth = 2 THEN (SELECT min(page_id) FROM placed p WHERE p.namespace = t.namespace
                                     AND p.base + 12 + p.label * 4 + p.slot = t.node_id) END AS first_sample
    FROM cluster_tree t"""))
def a7_tree(spark, sf):
    """Nodes in stored form, centroid as bytes and lists as JSON text, to columns."""
    pages = fx.page_vector(spark, sf).groupBy("namespace", F.col("cluster_node_id").alias("node_id")).agg(
        F.min("page_id").alias("first_page")
    )
    nodes = fx.cluster_tree(spark, sf).drop("centroid", "top_terms", "sample_doc_ids").join(pages, ["namespace", "node_id"], "left")
    centroid = F.when(F.col("depth") == 2, F.array(F.col("doc_count").cast("float"), F.lit(1.5).cast("float")))
    term = F.concat(F.lit("term "), F.col("node_id").cast("string"))
    stored = nodes.withColumns({
        "centroid": columnar.blob_from_floats(centroid),
        "top_terms": F.when(F.col("depth") == 1, F.to_json(F.array(term, F.lit("other")))),
        "sample_doc_ids": F.when(F.col("depth") == 2, F.to_json(F.array("first_page"))),
    })
    loaded = columnar.columnar_tree(stored)
    return loaded.select(
        "namespace", "node_id", "parent_id", "depth", "doc_count", "first_label",
        F.col("centroid")[0].cast("double").alias("first_value"), F.coalesce(F.size("top_terms") == 2, F.lit(False)).alias("has_terms"),
        F.col("top_terms")[0].alias("term"), F.col("sample_doc_ids")[0].alias("first_sample"),
    )


@query("a8_three_d_text", """
    SELECT event_id, round(CAST(CAST(value AS FLOAT) AS DOUBLE), 6) AS x, 0.0::DOUBLE AS y,
           CASE WHEN user_id % 2 = 0 THEN 0.0 ELSE round(CAST(CAST(value / 4 AS FLOAT) AS DOUBLE), 6) END AS z
    FROM events WHERE event_type <> 'error'
    UNION ALL SELECT event_id, NULL, NULL, NULL FROM events WHERE event_type = 'error'""")
def a8(spark, sf):
    events = table(spark, sf, "events")
    third = F.when(F.col("user_id") % 2 == 0, F.lit(float("inf"))).otherwise(F.col("value") / 4)
    vector = F.when(F.col("event_type") != "error", F.array("value", F.lit(float("nan")), third).cast("array<float>"))
    text = events.select("event_id", columnar.text_from_vector(vector).alias("text"))
    back = text.select("event_id", columnar.vector_from_text(F.col("text")).alias("v"))
    return back.select("event_id", *[F.round(F.col("v")[i].cast("double"), 6).alias(c) for i, c in enumerate("xyz")])


COLOURS = "[" + ", ".join(f"'{c}'" for c in graph.PALETTE) + "]"


@query("a9_graph_nodes", with_views("cluster_tree languages", f"""
    SELECT namespace, node_id AS id,
           CASE WHEN parent_id IS NULL THEN language || ' {graph.ROOT_SUFFIX}'
                ELSE coalesce(nullif(final_label, ''), nullif(first_label, ''), '<' || CAST(node_id AS VARCHAR) || '>') END AS label,
           CAST({graph.NODE_SIZE} AS INT) AS size, ({COLOURS})[depth % 10 + 1] AS color
    FROM cluster_tree JOIN languages USING (namespace)"""))
def a9_nodes(spark, sf):
    return graph.graph_nodes(fx.cluster_tree(spark, sf), fx.languages(spark))


@query("a9_graph_edges", with_views("cluster_tree", """
    SELECT namespace, parent_id AS source, node_id AS target FROM cluster_tree WHERE parent_id IS NOT NULL"""))
def a9_edges(spark, sf):
    return graph.graph_edges(fx.cluster_tree(spark, sf))


# ---------------------------------------------------------------- B15
@query("b15_article_selection", """
    SELECT doc_id AS identifier, lang AS in_language_identifier,
           CASE WHEN n_chars % 3 = 0 THEN n_chars END AS version_editor_editCount
    FROM documents WHERE lang = 'fr' AND n_chars >= 400""")
def b15(spark, sf):
    return selection.select_articles(
        articles.parse_articles(article_lines(spark, sf)),
        fields=["identifier", "in_language.identifier", "version.editor.editCount"],
        filters={"in_language.identifier": "fr"},
        since=datetime.datetime.fromtimestamp(1704067200 + 400, datetime.timezone.utc),
    )
