"""Views over the driver's parquet tables that carry the corpus schemas (FIXTURES.md section 3).

Each view exists twice: as a DataFrame, and as a DuckDB common table expression in ``VIEWS_SQL`` for
the oracles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmap import schemas
from corpusmap.functions.ranking import first_n_per_group
from corpusmap.sources.languages import LANGUAGES

FIXED_TIME = "2024-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ns(lang: Column) -> Column:
    return F.concat(lang, F.lit("wiki_namespace_0"))


def _ns_index(lang: Column) -> Column:
    return F.when(lang == "de", 0).when(lang == "en", 1).when(lang == "es", 2).otherwise(3)


def _fixed_time() -> Column:
    return F.lit(FIXED_TIME).cast("timestamp")


def page_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    first_line = F.split_part(F.col("text"), F.lit("\n"), F.lit(1))
    rest = F.substr(F.col("text"), F.length(first_line) + 2)
    return docs.select(
        _ns(F.col("lang")).alias("namespace"),
        F.col("doc_id").alias("page_id"),
        first_line.alias("title"),
        F.concat(_ns(F.col("lang")), F.lit("_chunk_"), F.substr("source", F.lit(4))).alias("chunk_name"),
        F.concat(F.lit("https://"), F.col("lang"), F.lit(".example.org/"), F.col("doc_id").cast("string")).alias("url"),
        _fixed_time().alias("extracted_at"),
        F.nullif(rest, F.lit("")).alias("abstract"),
    )


def chunk_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    src = F.substr("source", F.lit(4)).cast("int")
    chunks = docs.select(_ns(F.col("lang")).alias("namespace"), src.alias("src")).distinct()
    name = F.concat("namespace", F.lit("_chunk_"), F.col("src").cast("string"))
    state = F.col("src") % 3
    return chunks.select(
        "namespace",
        name.alias("chunk_name"),
        F.when(state >= 1, F.concat(F.lit("downloaded/"), name, F.lit(".tar.gz"))).alias("chunk_archive_path"),
        F.when(state == 2, F.concat(F.lit("extracted/"), name, F.lit(".ndjson"))).alias("chunk_extracted_path"),
        F.when(state >= 1, _fixed_time()).alias("downloaded_at"),
        F.when(state == 2, _fixed_time()).alias("unpacked_at"),
    )


def page_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    emb = table(spark, sf_dir, "embeddings")
    vec_id, label = F.col("vec_id"), F.col("label")
    base = _ns_index(F.col("lang")) * 100
    return emb.join(docs, emb["vec_id"] == docs["doc_id"]).select(
        _ns(F.col("lang")).alias("namespace"),
        vec_id.alias("page_id"),
        F.col("embedding").alias("embedding_vector"),
        F.when(vec_id % 5 != 0, F.slice("embedding", 1, 8)).alias("reduced_vector"),
        F.when(vec_id % 7 != 0, label.cast("long")).alias("cluster_id"),
        (base + 12 + label * 4 + vec_id % 4).cast("long").alias("cluster_node_id"),
        F.when(vec_id % 2 == 0, F.slice("embedding", 1, 3)).alias("three_d_vector"),
    )


def cluster_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    emb = table(spark, sf_dir, "embeddings").select("vec_id", "label")
    placed = emb.join(docs, emb["vec_id"] == docs["doc_id"]).select(
        _ns(F.col("lang")).alias("namespace"),
        (_ns_index(F.col("lang")) * 100).cast("long").alias("base"),
        F.col("label").cast("long").alias("label"),
        (F.col("vec_id") % 4).alias("slot"),
    )
    leaves = placed.groupBy("namespace", "base", "label", "slot").agg(F.count(F.lit(1)).alias("n"))
    rows = leaves.select(
        "namespace", "n",
        F.explode(F.array(
            F.struct((F.col("base") + 1).alias("node_id"), F.lit(None).cast("long").alias("parent_id"),
                     F.lit(0).alias("depth"), (F.col("base") + 2 + F.col("label")).alias("child")),
            F.struct((F.col("base") + 2 + F.col("label")).alias("node_id"), (F.col("base") + 1).alias("parent_id"),
                     F.lit(1).alias("depth"), (F.col("base") + 12 + F.col("label") * 4 + F.col("slot")).alias("child")),
            F.struct((F.col("base") + 12 + F.col("label") * 4 + F.col("slot")).alias("node_id"),
                     (F.col("base") + 2 + F.col("label")).alias("parent_id"),
                     F.lit(2).alias("depth"), F.lit(None).cast("long").alias("child")),
        )).alias("node"),
    ).select("namespace", "n", "node.*")
    nodes = rows.groupBy("namespace", "node_id", "parent_id", "depth").agg(
        F.sum("n").cast("int").alias("doc_count"),
        F.count_distinct("child").cast("int").alias("child_count"),
    )
    node_text = F.col("node_id").cast("string")
    return nodes.select(
        "namespace", "node_id", "parent_id", F.col("depth").cast("short").alias("depth"),
        F.lit(None).cast(schemas.FLOATS).alias("centroid"),
        "doc_count",
        F.lit(None).cast("array<string>").alias("top_terms"),
        F.lit(None).cast("array<bigint>").alias("sample_doc_ids"),
        "child_count",
        F.when(F.col("node_id") % 3 != 0, F.concat(F.lit("topic "), node_text)).alias("first_label"),
        F.when(F.col("node_id") % 4 == 0, F.concat(F.lit("final "), node_text)).alias("final_label"),
    )


def article_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_article_events(table(spark, sf_dir, "events"))


def as_article_events(events: DataFrame) -> DataFrame:
    """Article change records from the ``events`` table; works on a stream too."""
    published = F.col("ts").cast("timestamp")
    return events.select(
        F.lit("enwiki_namespace_0").alias("namespace"),
        F.col("user_id").alias("identifier"),
        F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("name"),
        F.col("props").alias("abstract"),
        F.struct(
            F.col("event_id").cast("string").alias("identifier"),
            F.col("event_type").alias("eventType"),
            published.alias("dateCreated"),
            published.alias("datePublished"),
            (F.col("user_id") % 4).alias("partition"),
            F.col("event_id").alias("offset"),
        ).alias("event"),
    )


def languages(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LANGUAGES, "language string, iso_code string, namespace string")


def sample_docs(vectors: DataFrame) -> DataFrame:
    return first_n_per_group(
        vectors.select("namespace", "cluster_node_id", "page_id"),
        ["namespace", "cluster_node_id"], ["page_id"], 10, rank="pos",
    )


_NS = "(lang || 'wiki_namespace_0')"
_NSI = "(CASE lang WHEN 'de' THEN 0 WHEN 'en' THEN 1 WHEN 'es' THEN 2 ELSE 3 END)"
_FIRST = "split_part(text, chr(10), 1)"

VIEWS_SQL = {
    "page_log": f"""
        SELECT {_NS} AS namespace, doc_id AS page_id, {_FIRST} AS title,
               {_NS} || '_chunk_' || substring(source, 4) AS chunk_name,
               'https://' || lang || '.example.org/' || CAST(doc_id AS VARCHAR) AS url,
               TIMESTAMP '{FIXED_TIME}' AS extracted_at,
               nullif(substring(text, CAST(length({_FIRST}) + 2 AS BIGINT)), '') AS abstract
        FROM documents""",
    "chunk_log": f"""
        SELECT namespace, chunk_name,
               CASE WHEN src % 3 >= 1 THEN 'downloaded/' || chunk_name || '.tar.gz' END AS chunk_archive_path,
               CASE WHEN src % 3 = 2 THEN 'extracted/' || chunk_name || '.ndjson' END AS chunk_extracted_path,
               CASE WHEN src % 3 >= 1 THEN TIMESTAMP '{FIXED_TIME}' END AS downloaded_at,
               CASE WHEN src % 3 = 2 THEN TIMESTAMP '{FIXED_TIME}' END AS unpacked_at
        FROM (SELECT DISTINCT {_NS} AS namespace, CAST(substring(source, 4) AS INT) AS src,
                     {_NS} || '_chunk_' || substring(source, 4) AS chunk_name FROM documents)""",
    "page_vector": f"""
        SELECT {_NS} AS namespace, vec_id AS page_id, embedding AS embedding_vector,
               CASE WHEN vec_id % 5 <> 0 THEN embedding[1:8] END AS reduced_vector,
               CASE WHEN vec_id % 7 <> 0 THEN CAST(label AS BIGINT) END AS cluster_id,
               CAST(100 * {_NSI} + 12 + label * 4 + vec_id % 4 AS BIGINT) AS cluster_node_id,
               CASE WHEN vec_id % 2 = 0 THEN embedding[1:3] END AS three_d_vector
        FROM embeddings JOIN documents ON vec_id = doc_id""",
    "placed": f"""
        SELECT {_NS} AS namespace, CAST(100 * {_NSI} AS BIGINT) AS base, CAST(label AS BIGINT) AS label,
               vec_id % 4 AS slot, vec_id AS page_id
        FROM embeddings JOIN documents ON vec_id = doc_id""",
    "tree_rows": """
        SELECT namespace, base + 1 AS node_id, CAST(NULL AS BIGINT) AS parent_id, 0 AS depth,
               base + 2 + label AS child FROM placed
        UNION ALL
        SELECT namespace, base + 2 + label, base + 1, 1, base + 12 + label * 4 + slot FROM placed
        UNION ALL
        SELECT namespace, base + 12 + label * 4 + slot, base + 2 + label, 2, NULL FROM placed""",
    "cluster_tree": """
        SELECT namespace, node_id, parent_id, CAST(depth AS SMALLINT) AS depth,
               CAST(count(*) AS INT) AS doc_count, CAST(count(DISTINCT child) AS INT) AS child_count,
               CASE WHEN node_id % 3 <> 0 THEN 'topic ' || CAST(node_id AS VARCHAR) END AS first_label,
               CASE WHEN node_id % 4 = 0 THEN 'final ' || CAST(node_id AS VARCHAR) END AS final_label
        FROM tree_rows GROUP BY namespace, node_id, parent_id, depth""",
    "article_events": """
        SELECT 'enwiki_namespace_0' AS namespace, user_id AS identifier,
               'user ' || CAST(user_id AS VARCHAR) AS name, props AS abstract, event_id, event_type,
               ts AS date_published, user_id % 4 AS part, event_id AS off
        FROM events""",
    "languages": "SELECT * FROM (VALUES " + ", ".join(
        f"('{name}', '{code}', '{ns}')" for name, code, ns in LANGUAGES
    ) + ") AS t(language, iso_code, namespace)",
}

_NEEDS = {"tree_rows": ["placed"], "cluster_tree": ["placed", "tree_rows"]}


def with_views(names: str, body: str) -> str:
    """Prefix ``body`` with the views it names (blank separated)."""
    wanted: list[str] = []
    for name in names.split():
        for item in [*_NEEDS.get(name, []), name]:
            if item not in wanted:
                wanted.append(item)
    ctes = ",\n".join(f"{name} AS ({VIEWS_SQL[name]})" for name in wanted)
    joiner = "," if body.lstrip().upper().startswith("WITH ") else "\n"
    body = body.lstrip()[5:] if joiner == "," else body
    return f"WITH {ctes}{joiner} {body}"
