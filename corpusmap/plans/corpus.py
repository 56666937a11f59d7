"""The working steps from landed archives to a labelled tree, over Parquet tables.

The vector table of the operators is kept as four narrow tables, one per column a step fills: a step
that adds 3-D coordinates must not read or rewrite every embedding. Whether a page has a vector is
then whether it has a row, which a scan of the keys answers.

A table is a base folder plus the changes since. A step that touches some rows adds a change folder;
reading lays the changes over the base with anti joins on the changed keys, which are broadcast while
they are small, so the base is not shuffled. ``compact`` folds the changes in. A folder counts once
its ``_SUCCESS`` is written, so a step that fails leaves nothing behind and can be run again.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmap import schemas
from corpusmap.operators import embedding, pca, projection, status, tree, updates, worklists
from corpusmap.operators.prompts import Labeler, fill_top_terms, keyword_labeler, node_top_terms
from corpusmap.plans.labelling import LabelRun, label_trees
from corpusmap.schemas import CHUNK_KEY, NODE_KEY, PAGE_KEY
from corpusmap.session import cut_lineage, exists, list_folder, scratch
from corpusmap.sources import archives, articles, catalogue


def _vector_part(column: str) -> T.StructType:
    return T.StructType([f for f in schemas.PAGE_VECTOR.fields if f.name in (*PAGE_KEY, column)])


# name -> (schema, key)
TABLES = {
    "chunk_log": (schemas.CHUNK_LOG, CHUNK_KEY),
    "page_log": (schemas.PAGE_LOG, PAGE_KEY),
    "cluster_tree": (schemas.CLUSTER_TREE, NODE_KEY),
    "embedding_vector": (_vector_part("embedding_vector"), PAGE_KEY),
    "reduced_vector": (_vector_part("reduced_vector"), PAGE_KEY),
    "cluster_node_id": (_vector_part("cluster_node_id"), PAGE_KEY),
    "three_d_vector": (_vector_part("three_d_vector"), PAGE_KEY),
    # sums over the embeddings in changes up to ``upto`` of base ``base``
    "pca_moments": (schemas.struct(namespace=schemas.S, slot=T.IntegerType(), n=schemas.L, total=T.ArrayType(schemas.D), base=schemas.L, upto=schemas.L), ["namespace", "slot"]),
    "pca_basis": (schemas.struct(namespace=schemas.S, n=schemas.L, values=T.ArrayType(T.ArrayType(schemas.D)), explained=T.ArrayType(schemas.D), total_variance=schemas.D), ["namespace"]),
    "embedding_error": (schemas.struct(namespace=schemas.S, page_id=schemas.L, error=schemas.S), PAGE_KEY),
}
VECTOR_PARTS = ["embedding_vector", "reduced_vector", "cluster_node_id", "three_d_vector"]
# Tables whose changes never repeat a key, so that reading is a plain union.
DISJOINT = {"embedding_vector"}
MAX_CHANGES = 16


class Corpus:
    def __init__(self, spark: SparkSession, root: str, languages: DataFrame):
        self.spark = spark
        self.root = root.rstrip("/")
        self.languages = languages

    # ------------------------------------------------------------ tables
    def _folders(self, name: str) -> tuple[int, list[int]]:
        """Number of the newest base (0: none) and the changes made to it, in order."""
        folder = f"{self.root}/{name}"
        found = [re.fullmatch(r"v(\d+)(?:-(\d+))?", entry) for entry in list_folder(self.spark, folder)]
        done = [(int(m[1]), int(m[2] or 0)) for m in found if m and exists(self.spark, f"{folder}/{m[0]}/_SUCCESS")]
        base = max((b for b, change in done if change == 0), default=0)
        return base, sorted(change for b, change in done if b == base and change)

    def _read(self, name: str, folder: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name][0]).parquet(f"{self.root}/{name}/{folder}")

    def table(self, name: str) -> DataFrame:
        """The current rows of a table; ``page_vector`` joins its four parts."""
        if name == "page_vector":
            return self._page_vector()
        schema, key = TABLES[name]
        base, changes = self._folders(name)
        rows = self._read(name, f"v{base}") if base else self.spark.createDataFrame([], schema)
        if name in DISJOINT and changes:
            added = self._read(name, "{" + ",".join(f"v{base}-{c}" for c in changes) + "}")
            return rows.unionByName(added)
        for change in changes:
            rows = updates.replace_rows(rows, self._read(name, f"v{base}-{change}"), key)
        return rows

    def _write(self, name: str, df: DataFrame, folder: str) -> None:
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in TABLES[name][0].fields]
        df.select(*columns).write.mode("overwrite").parquet(f"{self.root}/{name}/{folder}")

    def replace(self, name: str, df: DataFrame) -> None:
        self._write(name, df, f"v{self._folders(name)[0] + 1}")

    def change(self, name: str, df: DataFrame) -> None:
        """Add rows that replace those of the same key; ``df`` has one row per key."""
        base, changes = self._folders(name)
        self._write(name, df, f"v{base}-{(changes or [0])[-1] + 1}")
        if len(changes) + 1 > MAX_CHANGES:
            self.compact(name)

    def compact(self, name: str) -> None:
        seen = self._folders(name)
        self.replace(name, self.table(name))
        if name == "embedding_vector":
            self._moments_after_compaction(seen)

    def _keys(self, name: str) -> DataFrame:
        """Keys that have a vector part, the part itself stood in for by a flag."""
        return self.table(name).select(*PAGE_KEY, F.lit(True).alias(name))

    def _page_vector(self) -> DataFrame:
        rows = self.table(VECTOR_PARTS[0])
        for part in VECTOR_PARTS[1:]:
            rows = rows.join(self.table(part), PAGE_KEY, "left")
        return rows.withColumn("cluster_id", F.lit(None).cast("bigint")).select(*schemas.PAGE_VECTOR.fieldNames())

    # ------------------------------------------------------------ steps
    def refresh(self, listing: DataFrame, namespace: str, language: str | None = None) -> None:
        """Register the chunks of a catalogue listing."""
        self.replace("chunk_log", catalogue.register_chunks(self.table("chunk_log"), listing, namespace, language))

    def landed(self, done: DataFrame, as_of: updates.Time) -> None:
        """Note archives that have been fetched: (namespace, chunk_name, chunk_archive_path)."""
        self.replace("chunk_log", updates.mark_downloaded(self.table("chunk_log"), done, as_of))

    def unpack(
        self, as_of: updates.Time, namespace: str | None = None, limit: int | None = None, mode: str = "failfast"
    ) -> DataFrame:
        """Read the next archives into the page table; returns the pages read from each chunk.

        Archives must lie under ``.../{namespace}/{chunk_name}.tar.gz``. Lines that are no pages stop the
        step, or are left out in mode ``permissive``.
        """
        chunks = self.table("chunk_log")
        with scratch(self.spark):
            todo = cut_lineage(worklists.chunks_to_unpack(chunks, namespace, limit), "unpack")
            paths = [row["chunk_archive_path"] for row in todo.select("chunk_archive_path").collect()]
            counts = []
            if paths:
                lines = archives.read_archives(self.spark, paths)
                found = articles.pages_from_lines(lines, mode)
                empty = self.table("page_log").limit(0)
                newest = cut_lineage(updates.upsert_pages(empty, found, as_of, ["chunk_name", "line_no"]), "pages")
                self.change("page_log", newest)
                done = todo.withColumn("chunk_extracted_path", F.col("chunk_archive_path"))
                self.replace("chunk_log", updates.mark_unpacked(chunks, done, as_of))
                counts = status.pages_per_chunk(newest, todo).collect()  # one row per archive
        return self.spark.createDataFrame(counts, "namespace string, chunk_name string, page_count bigint")

    def embed(
        self, embedder: embedding.Embedder | None = None, namespace: str | None = None, chunk_name: str | None = None,
        limit: int | None = None, dims: int = 2048, calls: int | None = None,
    ) -> DataFrame:
        """Embed pages that lack it, at most ``limit``; returns the pages that failed."""
        pages = self.table("page_log")
        scope = pages if chunk_name is None else pages.filter(F.col("chunk_name") == chunk_name)
        with scratch(self.spark):
            todo = worklists.pages_within_budget(scope, self._keys("embedding_vector"), limit, namespace)
            if limit is not None:
                todo = cut_lineage(todo, "todo")
            texts = pages.join(todo.select(*PAGE_KEY), PAGE_KEY, "left_semi")
            if embedder is None:
                made = embedding.hashed_embeddings(texts, dims).withColumn("error", F.lit(None).cast("string"))
            else:
                made = embedding.embed_pages(texts, embedder, calls=calls)
            made = cut_lineage(made, "embeddings")
            self.change("embedding_vector", made.filter(F.col("error").isNull()))
            # what is known of pages outside this step stays
            others = self.table("embedding_error").join(made.select(*PAGE_KEY), PAGE_KEY, "left_anti")
            failed = made.filter(F.col("error").isNotNull()).select(*PAGE_KEY, "error")
            self.replace("embedding_error", others.unionByName(failed))
        return self.table("embedding_error")

    # ------------------------------------------------------------ principal components
    def _new_embeddings(self) -> tuple[DataFrame | None, tuple[int, int]]:
        """(embeddings that the stored moments lack, None if all have to be gathered, (base, last change)).

        Embeddings are only ever added, as change folders, so what is new since a fit are the folders since.
        """
        base, changes = self._folders("embedding_vector")
        at = (base, (changes or [0])[-1])
        seen = self.table("pca_moments").select("base", "upto").first()
        if seen is None or seen["base"] != base:
            return None, at
        fresh = [c for c in changes if c > seen["upto"]]
        if not fresh:
            return self.spark.createDataFrame([], TABLES["embedding_vector"][0]), at
        return self._read("embedding_vector", "{" + ",".join(f"v{base}-{c}" for c in fresh) + "}"), at

    def _moments_after_compaction(self, seen: tuple[int, list[int]]) -> None:
        """Folding the changes into a new base changes no row: moments that were up to date still are."""
        moments = self.table("pca_moments")
        held = moments.select("base", "upto").first()
        if held is not None and (held["base"], held["upto"]) == (seen[0], (seen[1] or [0])[-1]):
            base, _ = self._folders("embedding_vector")
            self.replace("pca_moments", moments.withColumn("base", F.lit(base)).withColumn("upto", F.lit(0)))

    def update_moments(self) -> int:
        """Add the embeddings made since the last call to the stored moments; returns how many there were. Only their
        folders are read, unless there are no moments yet."""
        new, (base, upto) = self._new_embeddings()
        with scratch(self.spark):
            rows = self.table("embedding_vector") if new is None else new
            more = cut_lineage(pca.moment_sums(rows.filter(F.col("embedding_vector").isNotNull()), "namespace", "embedding_vector"), "moments")
            added = more.filter("slot = 0").agg(F.sum("n")).first()[0] or 0
            if added or new is None:
                both = more if new is None else pca.merged_moments(self.table("pca_moments"), more, "namespace")
                self.replace("pca_moments", both.withColumn("base", F.lit(base)).withColumn("upto", F.lit(upto)))
        return added

    def reduce(
        self, target_dim: int = 100, batch_size: int = 10_000, namespace: str | None = None, only_new: bool = False
    ) -> None:
        """Reduced vectors of all embedded pages, by components fitted to all of them.

        The fit comes from the stored moments, to which only new embeddings are added. ``only_new`` keeps the components of
        the last fit and places only pages without a reduced vector, so that the others stay where they are.
        """
        pca.check_target(target_dim, batch_size)
        with scratch(self.spark):
            rows = worklists.vectors_with(self.table("embedding_vector"), ["embedding_vector"], namespace)
            if only_new:
                bases = self.table("pca_basis")
                rows = rows.join(self.table("reduced_vector").select(*PAGE_KEY), PAGE_KEY, "left_anti")
            else:
                self.update_moments()
                bases = cut_lineage(pca.fit_moments(self.table("pca_moments"), "namespace", target_dim), "bases")
                if namespace is not None:
                    bases = bases.filter(F.col("namespace") == namespace)
                    if bases.isEmpty():
                        raise ValueError(f"fewer than {target_dim} embeddings in {namespace}")
                self.change("pca_basis", bases)
            self.change("reduced_vector", pca.transform(rows, "namespace", "embedding_vector", bases, target_dim, "reduced_vector"))

    def recursive_cluster(self, settings: tree.TreeSettings = tree.TreeSettings(), namespace: str | None = None) -> int:
        """Throw the trees away and build them anew; returns the number of nodes made."""
        here = F.lit(True) if namespace is None else F.col("namespace") == namespace
        reduced = self.table("reduced_vector")
        kept = self.table("cluster_tree").filter(~here)
        with scratch(self.spark):
            nodes, assignments = tree.build_trees(reduced, kept, settings, namespace)
            # pages that are under no leaf any more must lose their old one
            placed = reduced.filter(here).select(*PAGE_KEY).join(assignments, PAGE_KEY, "left")
            self.change("cluster_node_id", placed)
            self.replace("cluster_tree", kept.unionByName(nodes, allowMissingColumns=True))
        return worklists.in_namespace(self.table("cluster_tree"), namespace).count()

    def project(self, method: str = "pca3", namespace: str | None = None, limit: int | None = None) -> None:
        """Lay out clusters that have pages without coordinates."""
        vectors = self.table("reduced_vector").join(self.table("cluster_node_id"), PAGE_KEY).join(
            self._keys("three_d_vector"), PAGE_KEY, "left"
        )
        with scratch(self.spark):
            self.change("three_d_vector", projection.project_clusters(vectors, method, namespace, limit))

    def topics(
        self, mode: str, labeler: Labeler = keyword_labeler, limit: int | None = None, namespace: str | None = None,
        **options,
    ) -> LabelRun:
        with scratch(self.spark):
            run = label_trees(
                self.table("cluster_tree"), self.table("page_log"), self.table("cluster_node_id"), self.languages,
                labeler, mode, limit, namespace, **options
            )
            self.replace("cluster_tree", run.nodes)
        run.nodes = self.table("cluster_tree")
        return run

    def top_terms(self, n: int = 10) -> None:
        with scratch(self.spark):
            terms = node_top_terms(self.table("page_log"), self.table("cluster_node_id"), n)
            self.replace("cluster_tree", fill_top_terms(self.table("cluster_tree"), terms))

    def status(self) -> DataFrame:
        """The status report; of the vector parts only keys are read."""
        parts = [self._keys(p) for p in VECTOR_PARTS if p != "cluster_node_id"]
        present = self.table("cluster_node_id").withColumn("cluster_id", F.lit(None).cast("bigint"))
        for part in parts:
            present = present.unionByName(part, allowMissingColumns=True)
        return status.status_report(
            self.table("chunk_log"), self.table("page_log"), present, self.table("cluster_tree")
        )
