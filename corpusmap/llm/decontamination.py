"""Passages of test items in training texts, found by spaced seeds: masks of words that are compared and words that are
ignored. A family of masks is taken that no passage allowed by the bounds escapes, whatever words were replaced."""

from __future__ import annotations

import functools
import itertools
import os
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmap.session import broadcast_if_small, cut_lineage

# Items of fewer words are not looked for, see ``unsought_items``.
LEAST_ITEM = 6
# Families of masks, 1 for a word that is compared and 0 for one that is ignored, from the most selective on. The last two
# are for items of a few words.
FAMILIES = (
    ("110111", "111101"), ("110111", "111011", "111101"), ("11011", "11101"), ("11011", "11101", "10111"), ("1101", "1011"), ("1101",),
    ("101",), ("11",), ("1",),
)
# A passage counts with this many equal words and this share of equal words in its stretch; an item
# that is shorter counts when this share of its words is there.
LEAST_WORDS = 13
LEAST_SHARE = 0.8
# Places without an equal word that end a stretch.
GAP = 4


def normal_words(text: Column) -> Column:
    """Words of letters and digits in lower case."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def word_hashes(text: Column) -> Column:
    return F.transform(normal_words(text), lambda w: F.xxhash64(w))


def _ends_hit(equal: str, masks: tuple[str, ...]) -> bool:
    """Whether some mask's compared places are all equal at the end of a row of 1 (equal) and 0 (replaced)."""
    return any(len(equal) >= len(m) and all(e == "1" for e, x in zip(equal[-len(m) :], m) if x == "1") for m in masks)


@functools.lru_cache
def hits_all(masks: tuple[str, ...], n_words: int | None, least_words: int, least_share: float) -> bool:
    """Whether no passage escapes the masks: of an item of ``n_words``, every way to keep ``least_share`` of its words; for
    None, stretches of any length with ``least_words`` equal words that are ``least_share`` of it.

    For the latter, of all rows of equal and replaced words without a hit, told apart by their last places and their
    equal words up to ``least_words``, the one is followed in which equal words outweigh the others most.
    """
    share = Fraction(least_share).limit_denominator(1000)
    if n_words is not None:
        rows = ("".join(r) for r in itertools.product("10", repeat=n_words))
        return all(any(_ends_hit(r[: k + 1], masks) for k in range(n_words)) for r in rows if r.count("1") >= share * n_words)
    gain, loss = share.denominator - share.numerator, share.numerator
    kept = max(map(len, masks)) - 1
    best = {("", 0): 0}
    open_ = dict(best)
    while open_:
        further: dict[tuple[str, int], int] = {}
        for (end, equal), weight in open_.items():
            for word in "10":
                row = end + word
                if _ends_hit(row, masks):
                    continue
                to = (row[len(row) - min(kept, len(row)) :], min(least_words, equal + (word == "1")))
                now = weight + (gain if word == "1" else -loss)
                if to[1] == least_words and now >= 0:
                    return False
                if to not in best or now > best[to]:
                    best[to] = further[to] = now
        open_ = further
    return True


@functools.lru_cache
def family(n_words: int | None, least_words: int, least_share: float) -> int:
    """Place in FAMILIES of the first family that no passage of such an item escapes."""
    return next(k for k, masks in enumerate(FAMILIES) if hits_all(masks, n_words, least_words, least_share))


def word_windows(rows: DataFrame, keys: list[str], hashes: str, width: int) -> DataFrame:
    """One row per place of ``hashes``: keys, ``at``, and ``w0``... the ``width`` hashes from there on, null
    past the end."""
    shifted = [F.slice(hashes, k + 1, F.size(hashes)).alias(f"w{k}") for k in range(width)]
    return rows.select(*keys, F.posexplode(F.arrays_zip(*shifted)).alias("at", "w")).select(*keys, "at", "w.*")


def seed_key(mask: str) -> Column:
    """Hash of the words of a window that a mask compares, with the mask; null if the text ends before."""
    held = [f"w{k}" for k, bit in enumerate(mask) if bit == "1"]
    return F.when(F.col(f"w{len(mask) - 1}").isNotNull(), F.xxhash64(F.lit(mask), *held))


def unsought_items(items: DataFrame, item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(item, n_words) of the items that are too short to be looked for."""
    counted = items.select(F.col(item_col), F.coalesce(F.size(normal_words(F.col(item_text_col))), F.lit(0)).alias("n_words"))
    return counted.filter(F.col("n_words") < LEAST_ITEM)


def best_part(places: Column, least_words: int, least_share: float) -> Column:
    """(n_equal, n_places, item_place) of the part of a stretch with the most equal words that counts, of
    equal ones the shortest and then the first; null if none does. ``places`` are its equal places, ascending."""

    def ending(place: Column, k: Column) -> Column:
        def counts(first: Column) -> Column:
            n = k - first + 1
            return (n >= least_words) & (n >= least_share * (place - F.get(places, first) + 1))

        first = F.array_min(F.filter(F.sequence(F.lit(0), k), counts))
        start = F.get(places, first)
        return F.when(first.isNotNull(), F.struct((k - first + 1).alias("n"), (start - place - 1).alias("less"), (-start).alias("back")))

    best = F.array_max(F.transform(places, ending))
    return F.when(best.isNotNull(), stretch_row(best["n"], -best["less"], -best["back"]))


def stretch_row(n_equal: Column, n_places: Column, item_place: Column) -> Column:
    parts = {"n_equal": n_equal, "n_places": n_places, "item_place": item_place}
    return F.struct(*[part.cast("long").alias(name) for name, part in parts.items()])


def stretches_found(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
    least_words: int = LEAST_WORDS, least_share: float = LEAST_SHARE,
) -> DataFrame:
    """All stretches that count, as find_passages says, with the id and the hash of the text they are in."""
    tests = items.select(F.col(item_col).alias("_item"), word_hashes(F.col(item_text_col)).alias("_wanted")).distinct()
    tests = tests.withColumn("_n", F.size("_wanted")).filter(F.col("_n") >= LEAST_ITEM)
    chosen = F.lit(family(None, least_words, least_share))
    for n in range(LEAST_ITEM, least_words):
        chosen = F.when(F.col("_n") == n, family(n, least_words, least_share)).otherwise(chosen)
    tests = cut_lineage(tests.withColumn("_test", F.xxhash64("_item", "_wanted")).withColumn("_family", chosen), "tests")
    used = sorted(row["_family"] for row in tests.select("_family").distinct().collect()) or [0]  # at most len(FAMILIES)
    masks = sorted({mask for k in used for mask in FAMILIES[k]})
    span = max(map(len, masks))
    windows = word_windows(tests, ["_test", "_family"], "_wanted", span)
    own = [F.when(F.col("_family").isin([k for k in used if mask in FAMILIES[k]]), seed_key(mask)) for mask in masks]
    seeds = windows.select("_test", F.col("at").alias("_at"), F.explode(F.array_compact(F.array(*own))).alias("_seed"))
    seeds = broadcast_if_small(cut_lineage(seeds, "test-seeds"))

    texts = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_text"), word_hashes(F.col(text_col)).alias("_words"))
    places = word_windows(texts, ["_id", "_text"], "_words", span)
    # the words that all masks compare first; one lookup of them stands before the masks
    held = os.path.commonprefix([mask.split("0")[0] for mask in masks])
    first = F.xxhash64(*[f"w{k}" for k in range(len(held))])
    begins = broadcast_if_small(cut_lineage(windows.select(first.alias("_first")).distinct(), "test-begins"))
    places = places.withColumn("_first", first).join(begins, "_first", "left_semi")
    hits = places.select("_id", "_text", "at", F.explode(F.array(*map(seed_key, masks))).alias("_seed")).join(seeds, "_seed")
    hits = hits.select(F.col("_id").alias("_hit"), F.col("_text").alias("_hit_text"), "_test", (F.col("at") - F.col("_at")).alias("_diagonal"))
    hits = broadcast_if_small(cut_lineage(hits.distinct(), "seed-hits"))

    lines = texts.join(hits, F.col("_id").eqNullSafe(F.col("_hit")) & (F.col("_text") == F.col("_hit_text")))
    from_doc, from_item = F.greatest("_diagonal", F.lit(0)), F.greatest(-F.col("_diagonal"), F.lit(0))
    # Only the words beside the item's go on.
    lines = lines.join(broadcast_if_small(tests.select("_test", "_n")), "_test").select(
        "_id", "_text", "_test", "_diagonal", from_item.alias("_from"), F.slice("_words", from_doc + 1, F.col("_n") - from_item).alias("_beside")
    )
    lines = lines.distinct().join(broadcast_if_small(tests), "_test")
    wanted = F.slice("_wanted", F.col("_from") + 1, F.size("_beside"))
    same = F.zip_with("_beside", wanted, lambda x, y: x == y)
    is_short = F.col("_n") < least_words
    lines = lines.withColumn("_same", same).withColumn("_total", F.size(F.filter("_same", lambda x: x)))
    lines = lines.filter(F.when(is_short, F.col("_total") >= least_share * F.col("_n")).otherwise(F.col("_total") >= least_words))
    met = lines.select("_id", "_text", "_test", "_item", "_n", "_diagonal", "_from", F.posexplode("_same").alias("_k", "_equal")).filter("_equal")
    met = met.withColumn("_place", F.col("_from") + F.col("_k"))

    line = Window.partitionBy("_id", "_text", "_test", "_diagonal").orderBy("_place")  # as long as the item at most
    parted = met.withColumn("_new", (F.col("_place") - F.lag("_place", 1, -1 - GAP).over(line) > GAP).cast("int"))
    parted = parted.withColumn("_stretch", F.sum("_new").over(line))
    stretches = parted.groupBy("_id", "_text", "_test", "_item", "_n", "_diagonal", "_stretch").agg(F.sort_array(F.collect_list("_place")).alias("_places"))
    n_equal, start = F.size("_places"), F.get("_places", F.lit(0))
    n_places = F.element_at("_places", -1) - start + 1
    whole = stretch_row(n_equal, n_places, start)
    part = (
        F.when(is_short, F.when(n_equal >= least_share * F.col("_n"), whole))
        .when((n_equal >= least_words) & (n_equal >= least_share * n_places), whole)
        .when(n_equal >= least_words, best_part(F.col("_places"), least_words, least_share))
    )
    found = stretches.withColumn("_part", part).filter("_part IS NOT NULL").select("_id", "_text", "_item", "_n", "_diagonal", "_part.*")
    return found.withColumn("n_item_words", F.col("_n").cast("long")).withColumn("doc_place", F.col("_diagonal") + F.col("item_place"))


def find_passages(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
    least_words: int = LEAST_WORDS, least_share: float = LEAST_SHARE,
) -> DataFrame:
    """Pairs of a document and a test item of which it holds a passage, substitutions allowed.

    Fixed masks ignore the words at some of their places (FAMILIES); each item takes the most selective family that no
    passage of it escapes (``hits_all`` tries all of them): at the given bounds two masks of five compared words, for
    some items of fewer than 13 words masks of three or four. At every place of every text the compared words are hashed
    and looked up among those of the items. A hit names a diagonal (document place minus item place), on which all words of the item are
    compared with the document's; equal places are joined into stretches, which a gap of more than GAP places ends. A stretch
    counts if some part of it has ``least_words`` equal words and ``least_share`` of that part's places are
    equal; for an item of fewer words, if ``least_share`` of the item's words are in it.

    Returns, for each pair, its best stretch or part: id, item id, n_equal, n_places, n_item_words, doc_place,
    item_place (in words from 0). Item seeds and hits are broadcast only while they are few
    (broadcast_if_small); beyond that the lookups are ordinary joins. Null and empty texts match nothing, nor
    do items of fewer than six words, which ``unsought_items`` lists; of rows with one id each is compared by itself, and the best counts,
    of null ids too; repeated items and equal items each get their pairs. Empty tables give no rows; other
    columns are ignored.
    """
    found = stretches_found(docs, items, id_col, text_col, item_col, item_text_col, least_words, least_share)
    best = F.max_by(
        F.struct("n_equal", "n_places", "n_item_words", "doc_place", "item_place"),
        F.struct("n_equal", -F.col("n_places"), -F.col("doc_place"), -F.col("item_place")),
    )
    return found.groupBy("_id", "_item").agg(best.alias("b")).select(F.col("_id").alias(id_col), F.col("_item").alias(item_col), "b.*")


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose own text holds no passage of an item, whatever other rows share their id;
    columns as they are."""
    found = stretches_found(docs, items, id_col, text_col, **options).select(F.col("_id").alias("_held"), F.col("_text").alias("_held_text"))
    found = broadcast_if_small(cut_lineage(found.distinct(), "contaminated"))
    held = docs[id_col].eqNullSafe(found["_held"]) & (F.xxhash64(docs[text_col]) == found["_held_text"])
    return docs.join(found, held, "left_anti")
