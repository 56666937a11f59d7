"""Registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmap.llm import (
    bpe, byte_bpe, conversation_trie, decontamination, language, line_dedup, near_dedup, quality, secret_scan, sharding, source_divergence,
    substring_dedup, token_counts,
)
from corpusmap.session import broadcast_if_small, cut_lineage, new_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(run):
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return run

    return add


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def sha256_of_ids(ids: Column) -> Column:
    return F.sha2(F.array_join(ids.cast("array<string>"), " "), 256)


@query("op1_substrings")
def substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.remove_repeats(documents(spark, sf_dir))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op2_quality_rules", """
    WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    worded AS (
        SELECT doc_id, text,
               list_filter(string_split_regex(text, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words,
               list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines
        FROM texts
    ),
    placed AS (
        SELECT doc_id, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM worded
    ),
    windows AS (
        SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w, w2, w3) AS n
        FROM (
            SELECT doc_id, i, w, lead(w) OVER d AS w2, lead(w, 2) OVER d AS w3
            FROM placed WINDOW d AS (PARTITION BY doc_id ORDER BY i)
        ) WHERE w3 IS NOT NULL
    ),
    repeated AS (
        SELECT doc_id, count(DISTINCT p) AS n
        FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM windows WHERE n >= 2) GROUP BY doc_id
    ),
    measured AS (
        SELECT w.doc_id, len(words)::BIGINT AS n_words,
               length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
               length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
               len(lines)::BIGINT AS n_lines,
               (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
               coalesce(r.n, 0)::BIGINT AS n_repeat_words,
               length(regexp_replace(text, '[^A-Z]', '', 'g'))::BIGINT AS n_upper,
               length(regexp_replace(text, '[^A-Za-z]', '', 'g'))::BIGINT AS n_letters,
               length(regexp_replace(text, '[^!-/:-@\\[-`{-~]', '', 'g'))::BIGINT AS n_marks
        FROM worded w LEFT JOIN repeated r USING (doc_id)
    ),
    ledger AS (
        SELECT *, ((n_words < 50)::BIGINT + 2 * (100 * n_repeat_words > 50 * n_words)::BIGINT
            + 4 * (10 * n_symbols > 3 * n_words)::BIGINT + 8 * (2 * n_dup_lines > n_lines)::BIGINT
            + 16 * (2 * n_upper > n_letters AND n_letters > 0)::BIGINT
            + 32 * (word_chars < 2 * n_words OR word_chars > 20 * n_words)::BIGINT
            + 64 * (10 * n_marks > 3 * word_chars)::BIGINT)::BIGINT AS failed
        FROM measured
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
           failed & 3 <> 0 AS base_failed, failed = 0 AS kept, failed
    FROM ledger
""")
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = quality.quality_ledger(documents(spark, sf_dir))
    return ledger.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~quality.passes(quality.BASE)).alias("base_failed"), quality.passes(quality.DEFAULT).alias("kept"), "failed",
    )


@query("op3_bpe")
def bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bpe.encode_and_decode(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"))
    return rows.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), sha256_of_ids(F.col("ids")).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op8_shards")
def shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(documents(spark, sf_dir), 16)


@query("op10_language")
def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = language.predict(docs, language.train(docs.filter(~language.held_out())))
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score", "bits_per_byte")


@query("op4_secrets")
def secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_secrets(documents(spark, sf_dir))
    base = F.filter("spans", lambda s: s["number"] < len(secret_scan.BASE))

    def count(kind: secret_scan.Kind) -> Column:
        number = secret_scan.KINDS.index(kind)
        return F.size(F.filter("spans", lambda s: s["number"] == number)).cast("long")

    return found.select(
        "doc_id", count(secret_scan.ASSIGN).alias("n_assign"), count(secret_scan.ACCESS).alias("n_access"),
        count(secret_scan.HEX).alias("n_hex"), F.sha2(secret_scan.span_text(base), 256).alias("base_sha256"),
        secret_scan.span_text(F.col("spans")).alias("spans"), "n_copied", "n_live", "most_owners",
    )


@query("op5_near_duplicates")
def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, sf_dir), width=2, least=80)


@query("op6_decontamination")
def decontaminated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_passages(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@query("op7_lines", """
    WITH lines AS (
        SELECT doc_id, source, i, line, trim(line, ' ' || chr(9) || chr(13)) AS body
        FROM (
            SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
                   generate_subscripts(string_split(text, chr(10)), 1) AS i
            FROM documents WHERE text IS NOT NULL
        )
    ),
    spread AS (SELECT body FROM lines WHERE body <> '' GROUP BY body HAVING count(DISTINCT source) >= 10),
    marked AS (SELECT l.*, s.body IS NOT NULL AS gone FROM lines l LEFT JOIN spread s ON l.body = s.body),
    joined AS (
        SELECT doc_id, count(*) FILTER (WHERE body <> '') AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
               coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '') AS text
        FROM marked GROUP BY doc_id
    )
    SELECT d.doc_id, coalesce(j.n_lines, 0) AS n_lines, coalesce(j.n_removed, 0) AS n_removed, j.text
    FROM documents d LEFT JOIN joined j USING (doc_id)
""")
def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(documents(spark, sf_dir)).select("doc_id", "n_lines", "n_removed", "text")


@query("op9_token_totals")
def token_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents come in; those labelled toxic go, with a retry of that batch; those labelled poor are
    counted anew by another tokenizer."""
    import public_tokenizers

    docs = documents(spark, sf_dir).select("doc_id", "source", "lang", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    bytes_bpe = token_counts.TiktokenCounter("byte_bpe_50k", tokenizer_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    pieces = token_counts.PieceCounter("piece_bpe_32k", tokenizer_path("piece_bpe_32k.model"))
    toxic = labels.filter("toxic = 1").select("doc_id").distinct()
    poor = labels.filter("quality = 0").select("doc_id").distinct().join(toxic, "doc_id", "left_anti")
    nothing = F.lit(None).cast("string")
    gone = toxic.select("doc_id", F.lit("delete").alias("change"), *[nothing.alias(c) for c in ("source", "lang", "text")])

    ledger = token_counts.TokenLedger(spark, new_folder(spark, "token-ledger"))
    ledger.apply(1, docs.withColumn("change", F.lit("insert")), bytes_bpe)
    ledger.apply(2, gone, bytes_bpe)
    ledger.apply(2, gone, bytes_bpe)
    poor = broadcast_if_small(cut_lineage(poor, "poor"), 1_000_000)  # texts stay where they are while the ids are few
    ledger.apply(3, docs.join(poor, "doc_id", "left_semi").withColumn("change", F.lit("revise")), pieces)
    return ledger.totals()


@query("op11_byte_bpe")
def byte_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    rows = byte_bpe.encode_and_decode(documents(spark, sf_dir), tokenizer_path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return rows.select("doc_id", "n_tokens", F.sha2("packed", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op12_source_divergence", """
    WITH docs AS (
        SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
        FROM documents
    ),
    occ AS (SELECT id, lang, source, unnest(regexp_extract_all(text, '[a-z\\x{80}-\\x{10FFFF}]+')) AS term FROM docs),
    kept AS (SELECT lang, term FROM occ GROUP BY lang, term HAVING count(DISTINCT id) >= 30),
    found AS (SELECT lang, source, term, count(*) AS n FROM occ SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
    sources AS (SELECT DISTINCT lang, source FROM docs),
    counts AS (
        SELECT s.lang, s.source, k.term, coalesce(f.n, 0) AS n
        FROM sources s JOIN kept k USING (lang) LEFT JOIN found f USING (lang, source, term)
    ),
    shares AS (
        SELECT *, (1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER g + 5 * count(*) OVER g))::BIGINT AS p
        FROM counts WINDOW g AS (PARTITION BY lang, source)
    ),
    langs AS (SELECT lang, term, sum(n) AS n FROM counts GROUP BY lang, term),
    lang_shares AS (
        SELECT *, (1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER g + 5 * count(*) OVER g))::BIGINT AS q
        FROM langs WINDOW g AS (PARTITION BY lang)
    ),
    pairs AS (
        SELECT a.lang, a.source, b.source AS item,
               coalesce((SELECT sum(abs(x.p - y.p)) FROM shares x JOIN shares y USING (lang, term)
                         WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0)::BIGINT AS value
        FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
    ),
    terms AS (
        SELECT s.lang, s.source, s.term AS item, s.p - l.q AS value
        FROM shares s JOIN lang_shares l USING (lang, term) WHERE s.n > 0 AND s.p > l.q
    ),
    ranked AS (
        SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
        UNION ALL
        SELECT * FROM (
            SELECT lang, source, 'term' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM terms
        ) WHERE rank <= 50
    )
    SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM ranked
""")
def divergence_of_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.divergence(documents(spark, sf_dir), min_docs=30, top_terms=50)


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/conversations.parquet")


@query("op13_conversation_trie", """
    WITH turns AS (
        SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i
        FROM conversations WHERE conv_id IS NOT NULL
    ),
    ids AS (
        SELECT conv_id, conv_id - conv_id % 5 AS base,
               xor(4294967295, list_reduce(
                   list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
                   lambda a, b: list_reduce(list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                       lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))
               )) % 9 AS h
        FROM (SELECT DISTINCT conv_id FROM turns)
    ),
    rebuilt AS (
        SELECT d.conv_id, 0 AS part, t.i, t.role, t.text FROM ids d JOIN turns t ON t.conv_id = d.base AND t.i <= d.h
        UNION ALL
        SELECT d.conv_id, 1, t.i, t.role, t.text FROM ids d JOIN turns t ON t.conv_id = d.conv_id AND t.i > d.h
    ),
    prefixes AS (
        SELECT conv_id, row_number() OVER w AS depth, strlen(text) AS bytes,
               string_agg(sha256(strlen(role) || ':' || role || text), ',') OVER w AS key
        FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY part, i)
        UNION ALL
        SELECT conv_id, 0, 0, '' FROM ids
    ),
    nodes AS (
        SELECT key, min(conv_id) AS conv_id, any_value(depth) AS depth, count(*) AS n, any_value(bytes) AS bytes,
               CASE WHEN any_value(depth) > 0 THEN left(key, greatest(length(key) - 65, 0)) END AS above
        FROM prefixes GROUP BY key
    ),
    kids AS (SELECT above AS key, count(*) AS n FROM nodes WHERE above IS NOT NULL GROUP BY above),
    below AS (
        SELECT p.key, sum((n.n - 1) * n.bytes) AS saved, count(*) FILTER (WHERE k.n IS NULL) AS leaves
        FROM nodes n JOIN prefixes p ON p.conv_id = n.conv_id AND p.depth <= n.depth LEFT JOIN kids k ON k.key = n.key
        GROUP BY p.key
    ),
    ends AS (
        SELECT key, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
        FROM (SELECT *, max(depth) OVER (PARTITION BY conv_id) AS most FROM prefixes) WHERE depth = most GROUP BY key
    )
    SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n AS n_convs, coalesce(k.n, 0) AS n_children, b.leaves AS n_leaves,
           b.saved::BIGINT AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
    FROM nodes n LEFT JOIN nodes p ON p.key = n.above LEFT JOIN kids k ON k.key = n.key JOIN below b ON b.key = n.key
    LEFT JOIN ends e ON e.key = n.key
""")
def trie_of_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.conversation_trie(conversations(spark, sf_dir)).select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )
