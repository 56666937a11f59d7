"""Removal of boilerplate lines that are spread over many sites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmap.session import broadcast_if_small, cut_lineage

MIN_SITES = 10
SKETCH_LG = 12
# Half-width of the band around the threshold in which sites are counted exactly: six standard errors
# of a sketch (1.04 / sqrt(2^SKETCH_LG)).
BAND = 6 * 1.04 / 2 ** (SKETCH_LG / 2)


def line_bodies(text: Column) -> Column:
    """Lines without white space around them."""
    return F.transform(F.split(text, "\n", -1), lambda line: F.btrim(line, F.lit(" \t\r")))


def line_table(docs: DataFrame, id_col: str, text_col: str, site_col: str) -> DataFrame:
    """(id, text key, line number, line hash, site) of every line that isn't blank."""
    rows = docs.select(
        F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_key"), F.col(site_col).alias("site"),
        F.posexplode(line_bodies(F.col(text_col))).alias("line_no", "line"),
    )
    return rows.filter("line <> ''").select("_id", "_key", "line_no", F.xxhash64("line").alias("line"), "site")


def spread_lines(lines: DataFrame, min_sites: int = MIN_SITES, sketch_lg: int = SKETCH_LG, band: float = BAND) -> DataFrame:
    """Hashes (``line``) of the lines that ``min_sites`` distinct sites or more have.

    Every line hash gets a HyperLogLog sketch of its sites; sketches are merged before and after the
    shuffle, so a line that is everywhere costs one sketch per task. Away from the threshold the estimate
    decides. Within the band the distinct sites are counted, from (line, site) pairs that are combined
    before their shuffle.
    """
    sketched = lines.groupBy("line").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", sketch_lg)).alias("about"))
    likely = cut_lineage(sketched.filter(F.col("about") >= F.floor(F.lit(min_sites * (1 - band)))), "line-sites")
    sure = F.col("about") > F.ceil(F.lit(min_sites * (1 + band)))
    near = broadcast_if_small(likely.filter(~sure).select("line"))
    pairs = lines.filter(F.col("site").isNotNull()).join(near, "line", "left_semi").select("line", "site").distinct()
    counted = pairs.groupBy("line").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_sites)
    return likely.filter(sure).select("line").unionByName(counted.select("line"))


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source", min_sites: int = MIN_SITES
) -> DataFrame:
    """All columns of ``docs``, the text without boilerplate lines, and ``n_lines`` and ``n_removed``.

    Lines part at line feeds and are compared without blanks, tabs and carriage returns around them. A
    line is boilerplate if ``min_sites`` distinct sites have it, whatever its length; every copy of it
    goes, what is left is joined by line feeds. Blank lines stay and are not counted. A null text stays
    null; a null site counts as none, though its rows lose boilerplate too. Repeated rows and rows with
    null ids each keep their row, an empty table gives none. Other columns pass through unchanged;
    ``n_lines`` and ``n_removed`` of the input would be replaced.
    """
    lines = cut_lineage(line_table(docs, id_col, text_col, site_col), "lines")
    spread = broadcast_if_small(cut_lineage(spread_lines(lines, min_sites), "spread-lines"))
    flagged = lines.join(spread, "line", "left_semi").select("_id", "_key", "line_no").distinct()
    drops = flagged.groupBy("_id", "_key").agg(F.collect_list("line_no").alias("_drops"))  # of one text
    drops = broadcast_if_small(cut_lineage(drops, "line-drops"))

    there = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(id_col).alias("_id2"),
        F.col(text_col).alias("_text"), F.xxhash64(text_col).alias("_key2"),
    )
    joined = there.join(drops, F.col("_id2").eqNullSafe(F.col("_id")) & (F.col("_key2") == F.col("_key")), "left")
    kept = F.filter(F.split("_text", "\n", -1), lambda line, place: ~F.array_contains(F.col("_drops"), place))
    text = F.when(F.col("_drops").isNotNull(), F.array_join(kept, "\n")).otherwise(F.col("_text"))
    bodies = F.filter(line_bodies(F.col("_text")), lambda line: line != "")
    return joined.select(
        *[
            (text if c == text_col else F.col("_row").getField(c)).alias(c)
            for c in docs.columns if c not in ("n_lines", "n_removed")
        ],
        F.coalesce(F.size(bodies), F.lit(0)).cast("long").alias("n_lines"),
        F.when(F.col("_drops").isNull(), 0).otherwise(F.size("_drops")).cast("long").alias("n_removed"),
    )
