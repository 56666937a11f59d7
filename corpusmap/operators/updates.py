"""Table changes as pure functions: (table, changes) -> new table.

Parquet tables have no MERGE, so each function returns the table after the change and the caller
writes it as a new version. Replacing and inserting are written as anti and left joins with the
changes on the right: when the changes are small, Catalyst broadcasts them and the table is not
shuffled at all; when they are large, it falls back to a sort-merge join on the key.
"""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmap import schemas
from corpusmap.functions.checks import must
from corpusmap.schemas import CHUNK_KEY, NODE_KEY, PAGE_KEY


Time = Column | datetime.datetime | str


def _timestamp(as_of: Time) -> Column:
    return (as_of if isinstance(as_of, Column) else F.lit(as_of)).cast("timestamp")


def last_per_key(changes: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Of several rows for one key the last in ``order`` counts.

    An aggregate with map-side combine, so a key with a third of all rows is one row per map task.
    """
    values = [c for c in changes.columns if c not in keys]
    picked = changes.groupBy(*keys).agg(F.max_by(F.struct(*values), F.struct(*order)).alias("_last"))
    return picked.select(*keys, "_last.*")


def one_per_key(changes: DataFrame, keys: Sequence[str], columns: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """(keys, columns) with one row per key: of several the last in ``order``, of equal ones that with
    the largest values."""
    last = F.max_by(F.struct(*columns), F.struct(*order, *columns))
    return changes.groupBy(*keys).agg(last.alias("_last")).select(*keys, "_last.*")


def replace_rows(table: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Upsert of whole rows: changed keys out, all changes in. ``changes`` has one row per key."""
    kept = table.join(changes.select(*keys), list(keys), "left_anti")
    return kept.unionByName(changes.select(*[c for c in table.columns if c in changes.columns]), allowMissingColumns=True)


def update_columns(
    table: DataFrame, changes: DataFrame, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Set ``columns`` of existing rows; keys the table lacks are ignored, NULLs do overwrite."""
    new = changes.select(*keys, F.struct(*columns).alias("_new"))
    joined = table.join(new, list(keys), "left")
    return joined.select(*[
        F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) if c in columns
        else F.col(c)
        for c in table.columns
    ])


def insert_missing(table: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the rows of ``changes`` whose key the table lacks.

    The keys already present are found with a semi join first, so that the anti join's right side
    is never larger than the changes.
    """
    present = table.select(*keys).join(changes.select(*keys), list(keys), "left_semi").distinct()
    added = changes.join(present, list(keys), "left_anti")
    return table.unionByName(added, allowMissingColumns=True)


def upsert_columns(
    table: DataFrame, changes: DataFrame, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Update ``columns`` where the key exists, insert a row where it does not."""
    narrow = changes.select(*keys, *columns)
    return insert_missing(update_columns(table, narrow, keys, columns), narrow, keys)


def upsert_pages(pages: DataFrame, changes: DataFrame, as_of: Time, order: Sequence[str]) -> DataFrame:
    """New and changed pages in, stamped ``as_of``; ``order`` says which of two duplicates is later."""
    latest = last_per_key(changes, PAGE_KEY, order)
    return replace_rows(pages, latest.withColumn("extracted_at", _timestamp(as_of)), PAGE_KEY)


def upsert_chunks(chunks: DataFrame, listing: DataFrame, reset_paths: bool = False) -> DataFrame:
    """Register chunks; one already known loses its two times but, by default, not its paths."""
    reset = ["downloaded_at", "unpacked_at"]
    if reset_paths:
        reset += ["chunk_archive_path", "chunk_extracted_path"]
    kinds = {f.name: f.dataType for f in schemas.CHUNK_LOG.fields}
    changes = listing.select(*CHUNK_KEY).distinct().select(
        *CHUNK_KEY, *[F.lit(None).cast(kinds[c]).alias(c) for c in reset]
    )
    return upsert_columns(chunks, changes, CHUNK_KEY, reset)


def _set(
    table: DataFrame, changes: DataFrame, keys: Sequence[str], columns: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """``update_columns`` where a key may come several times."""
    return update_columns(table, one_per_key(changes, keys, columns, order), keys, columns)


# Of changes with one key the last in ``order`` counts, see ``one_per_key``.


def upsert_embeddings(vectors: DataFrame, embeddings: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    columns = ["embedding_vector"]
    return upsert_columns(vectors, one_per_key(embeddings, PAGE_KEY, columns, order), PAGE_KEY, columns)


def set_reduced_vectors(vectors: DataFrame, reduced: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    return _set(vectors, reduced, PAGE_KEY, ["reduced_vector"], order)


def set_three_d_vectors(vectors: DataFrame, projected: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    return _set(vectors, projected, PAGE_KEY, ["three_d_vector"], order)


def insert_nodes(nodes: DataFrame, added: DataFrame) -> DataFrame:
    """The tree with more nodes; a key that is there already, or twice among the new ones, fails."""
    counts = added.groupBy(*NODE_KEY).agg(F.count(F.lit(1)).alias("_times"))
    known = nodes.select(*NODE_KEY).join(counts.select(*NODE_KEY), NODE_KEY, "left_semi").distinct()
    known = known.withColumn("_known", F.lit(1))
    keyed = added.join(counts, NODE_KEY).join(known, NODE_KEY, "left")
    message = F.concat_ws(" ", F.lit("node is there already:"), *NODE_KEY)
    fresh = must(keyed, (F.col("_times") == 1) & F.col("_known").isNull(), message).select(*added.columns)
    return nodes.unionByName(fresh, allowMissingColumns=True)


def with_child_counts(nodes: DataFrame) -> DataFrame:
    counts = (
        nodes.filter(F.col("parent_id").isNotNull())
        .groupBy("namespace", F.col("parent_id").alias("node_id"))
        .agg(F.count(F.lit(1)).cast("int").alias("_children"))
    )
    return (
        nodes.join(counts, NODE_KEY, "left")
        .withColumn("child_count", F.coalesce("_children", F.lit(0)))
        .select(*nodes.columns)
    )


def set_labels(nodes: DataFrame, labels: DataFrame, columns: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    return _set(nodes, labels, NODE_KEY, columns, order)


def assign_leaves(vectors: DataFrame, assignments: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    return _set(vectors, assignments, PAGE_KEY, ["cluster_node_id"], order)


def delete_tree(nodes: DataFrame, vectors: DataFrame, namespace: str) -> tuple[DataFrame, DataFrame]:
    """Nodes and vectors without the tree of one namespace."""
    here = F.col("namespace") == namespace
    kept = nodes.filter(~here)
    cleared = vectors.withColumn("cluster_node_id", F.when(~here, F.col("cluster_node_id")))
    return kept, cleared


def clear_labels(nodes: DataFrame, namespace: str | None = None) -> DataFrame:
    kept = F.lit(False) if namespace is None else F.col("namespace") != namespace
    return nodes.withColumns({c: F.when(kept, F.col(c)) for c in ("first_label", "final_label")})


def _mark(chunks: DataFrame, done: DataFrame, path: str, values: Mapping[str, Column]) -> DataFrame:
    changes = done.select(*CHUNK_KEY, path).withColumns(dict(values))
    return _set(chunks, changes, CHUNK_KEY, [path, *values], ())


def mark_downloaded(chunks: DataFrame, done: DataFrame, as_of: Time) -> DataFrame:
    return _mark(chunks, done, "chunk_archive_path", {"downloaded_at": _timestamp(as_of)})


def mark_unpacked(chunks: DataFrame, done: DataFrame, as_of: Time) -> DataFrame:
    return _mark(chunks, done, "chunk_extracted_path", {"unpacked_at": _timestamp(as_of)})
