"""Secret scan with corpus-wide ownership counts of every candidate value."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmap.session import cut_lineage


@dataclass(frozen=True)
class Kind:
    """A pattern, the group that holds the value, and the least length of the value."""

    name: str
    pattern: str
    group: int = 0
    least: int = 0


# Runs of too few characters are no matches of `access` and `hex`, which is the same as dropping them
# after matching: each match takes its whole run. A too short value of `assign` still takes its text.
ASSIGN = Kind(
    "assign",
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    group=2, least=6,
)
ACCESS = Kind("access", r"AKIA[A-Z0-9]{16,}")
HEX = Kind("hex", r"[0-9a-f]{24,}")
PRIVATE_KEY = Kind("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----")
SIGNED = Kind("signed", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")
PREFIXED = Kind("prefixed", r"(?:gh[pousr]_|xox[abprs]-|sk_live_|AIza)[A-Za-z0-9_-]{16,}")
BASE = (ASSIGN, ACCESS, HEX)
KINDS = (*BASE, PRIVATE_KEY, SIGNED, PREFIXED)

# A value seen under this many owners is an example that has been copied around.
COPIED_OWNERS = 3
# Matches whose places are summed up together.
BLOCK = 64
# A live-looking value has at least this many different characters.
LIVE_CHARACTERS = 8


def _parts(text: Column, kind: Kind) -> Column:
    """Of each match of one kind, leftmost first, without overlaps: characters before it since the last one, its own, its
    value; one entry more with the characters behind the last. None without a match."""
    pattern = F.lit(kind.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    values = F.regexp_extract_all(text, pattern, F.lit(kind.group)) if kind.group else found
    between = F.split(text, kind.pattern, -1)  # one part more than there are matches
    parts = F.arrays_zip(
        F.transform(between, F.length).alias("gap"), F.transform(found, F.length).alias("whole"), values.alias("value")
    )
    return F.when(text.rlike(kind.pattern), parts).otherwise(F.array().cast("array<struct<gap:int,whole:int,value:string>>"))


def _spans(parts: Column, kind: Kind, number: int) -> Column:
    """Spans of one kind; positions in code points, end exclusive.

    Positions are sums of the lengths before, first over blocks of BLOCK matches and then within each block, so that the
    work follows the number of matches. ``parts`` must be a column, as it is read again for every block.
    """
    none = F.array().cast("array<struct<start:int,number:int,end:int,value:string>>")
    blocks = F.sequence(F.lit(0), F.greatest(F.floor((F.size(parts) - 1) / BLOCK), F.lit(0)).cast("int"))

    def members(block: Column) -> Column:
        return F.slice(parts, block * BLOCK + 1, F.lit(BLOCK))

    def length(block: Column) -> Column:
        return F.aggregate(members(block), F.lit(0), lambda total, p: total + p["gap"] + F.coalesce(p["whole"], F.lit(0)))

    def add(done: Column, size: Column) -> Column:
        return F.struct((done["at"] + size).alias("at"), F.array_append(done["starts"], done["at"]).alias("starts"))

    nowhere = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
    starts = F.aggregate(F.transform(blocks, length), nowhere, add, lambda done: done["starts"])

    def step(done: Column, part: Column) -> Column:
        start = done["at"] + part["gap"]
        end = start + part["whole"]
        span = F.struct(start.alias("start"), F.lit(number).alias("number"), end.alias("end"), part["value"].alias("value"))
        return F.struct(F.coalesce(end, start).alias("at"), F.when(
            F.length(part["value"]) >= kind.least, F.array_append(done["spans"], span)
        ).otherwise(done["spans"]).alias("spans"))

    def walked(block: Column, at: Column) -> Column:
        return F.aggregate(members(block), F.struct(at.alias("at"), none.alias("spans")), step, lambda done: done["spans"])

    return F.flatten(F.zip_with(blocks, starts, walked))


def find_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", kinds: tuple[Kind, ...] = KINDS
) -> DataFrame:
    """id, owner, ``text_key`` and ``spans`` (start, number of the kind, end, value) of every row.

    Spans are ordered by start, then kind. A null text counts as empty and has none.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("_id"), F.col(owner_col).alias("_owner"), text.alias("_text"))
    matched = rows.select(
        "_id", "_owner", F.xxhash64("_text").alias("text_key"), *[_parts(F.col("_text"), kind).alias(f"_parts{k}") for k, kind in enumerate(kinds)]
    )
    found = F.array_sort(F.concat(*[_spans(F.col(f"_parts{k}"), kind, k) for k, kind in enumerate(kinds)]))
    return matched.select("_id", "_owner", "text_key", found.alias("spans"))


def ownership(candidates: DataFrame) -> DataFrame:
    """Repositories and owners of each candidate hash: (hash, n_repos, n_owners).

    ``candidates`` has (hash, repo, owner). A repository belongs to an owner. Counting goes from
    (hash, owner, repo) to (hash, owner) to hash, each step combined before its shuffle, so a value that
    a third of all rows hold is counted in parts; nulls count as a repository or owner like others.
    """
    repos = candidates.select("hash", "owner", "repo").distinct()
    owners = repos.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("n"))
    return owners.groupBy("hash").agg(F.sum("n").alias("n_repos"), F.count(F.lit(1)).alias("n_owners"))


def scan_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
    kinds: tuple[Kind, ...] = KINDS, copied_owners: int = COPIED_OWNERS, live_characters: int = LIVE_CHARACTERS,
) -> DataFrame:
    """Spans of every row's whole text, and what the corpus says of their values.

    Each document counts as a repository, ``owner_col`` names its owner. A value found under at least
    ``copied_owners`` owners is a copied example; of the others, those with ``live_characters`` different
    characters are specific to their owners and look live.

    Returns id, ``spans`` (start, number of the kind in ``kinds``, end, value), ``n_copied``,
    ``n_live`` and ``most_owners`` (of any value in the text, 0 without). A null or empty text has no
    spans. Repeated rows and null ids keep their rows, an empty table gives none; other columns are
    ignored, whatever their names.
    """
    rows = cut_lineage(find_secrets(docs, id_col, text_col, owner_col, kinds), "secrets")
    one = rows.filter(F.size("spans") > 0).select("_id", "_owner", "text_key", F.inline("spans"))
    one = one.select(
        "_id", "text_key", "start", "number", F.col("_owner").alias("owner"), F.col("_id").alias("repo"),
        F.md5(F.col("value").cast("binary")).alias("hash"),
        (F.size(F.array_distinct(F.split("value", ""))) >= live_characters).alias("looks_live"),
    ).distinct()  # rows that are alike in id and text have the same spans
    judged = one.join(ownership(one), "hash")
    copied = F.col("n_owners") >= copied_owners
    by_row = judged.groupBy("_id", "text_key").agg(
        F.count_if(copied).alias("n_copied"), F.count_if(~copied & F.col("looks_live")).alias("n_live"),
        F.max("n_owners").alias("most_owners"),
    ).select(F.col("_id").alias("_id2"), F.col("text_key").alias("_key2"), "n_copied", "n_live", "most_owners")
    counts = ("n_copied", "n_live", "most_owners")
    # Owners may differ between rows of one id and text; distinct above keeps such rows apart, and the
    # counts of spans are per owner then.
    joined = rows.join(by_row, F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("text_key") == F.col("_key2")), "left")
    return joined.select(
        F.col("_id").alias(id_col), "spans", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in counts]
    )


def span_text(spans: Column, kinds: tuple[Kind, ...] = KINDS) -> Column:
    """``kind:start:end`` of the spans, joined by commas."""
    names = F.array(*[F.lit(k.name) for k in kinds])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", names[s["number"]], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
