"""Passages with substituted words, against a comparison of all places."""

import itertools
import random

import corpus_pipeline
from corpusmap.llm import decontamination
from test_pipeline import holds

ITEM_WORDS = (14, 15, 16, 20, 25, 37, 50, 57)


def found_and_expected(spark, docs, items):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    tests = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontamination.find_passages(df, tests).collect()}
    return found, {(i, k) for i, text in docs for k, item in items if holds(text, item)}


def item_text(n):
    return " ".join(f"i{n}w{k}" for k in range(n))


def replaced(n, places, before=3):
    return " ".join(["before"] * before + ["other" if k in places else f"i{n}w{k}" for k in range(n)] + ["after"] * 2)


def test_equal_words_beside_hits_count(spark):
    """One word of 14 and two of 15 replaced at every place; more at random places."""
    docs = [replaced(14, {k}) for k in range(14)] + [replaced(15, {j, k}) for k in range(15) for j in range(k)]
    chance = random.Random(3)
    for n in ITEM_WORDS:
        docs += [replaced(n, set(chance.sample(range(n), max(1, n // 5))), chance.randrange(4)) for _ in range(40)]
    items = [(n, item_text(n)) for n in ITEM_WORDS]
    found, expected = found_and_expected(spark, list(enumerate(docs)), items)
    assert len(expected) > 300 and found == expected


def test_chance_words_beside_a_passage_do_not_dilute_it(spark):
    words = [f"q{k}" for k in range(40)]
    text = ["z"] * 40
    for k in [2, 6, *range(10, 23), 26, 30, 34]:
        text[k] = words[k]
    df = spark.createDataFrame([(1, " ".join(text))], "doc_id long, text string")
    items = spark.createDataFrame([(7, " ".join(words))], "item_id long, text string")
    # Words 10 to 22 are equal; with the words 6 and 26 it is 15 of 21.
    assert [(r.n_equal, r.n_places, r.item_place) for r in decontamination.find_passages(df, items).collect()] == [(14, 17, 6)]


def test_every_pattern_of_short_items_and_every_period_of_long_ones(spark):
    docs = [
        replaced(n, set(places)) for n in range(6, 13) for most in range(n // 5 + 2) for places in itertools.combinations(range(n), most)
    ]
    short = len(docs)
    docs += [replaced(n, set(range(at, n, period))) for n in ITEM_WORDS for period in range(2, 15) for at in range(period)]
    items = [(n, item_text(n)) for n in (*range(6, 13), *ITEM_WORDS)]
    found, expected = found_and_expected(spark, list(enumerate(docs)), items)
    assert found == expected
    assert {n for i, n in expected if i < short} == set(range(6, 13))
    assert all(any(x[1] == n for x in expected if "other" in docs[x[0]]) for n in (37, 50, 57))


def hit(masks, pattern):
    return any(all(e == "1" for e, m in zip(pattern[k:], mask) if m == "1") for mask in masks for k in range(len(pattern) - len(mask) + 1))


def test_no_passage_escapes_its_masks():
    """Every pattern of equal and unequal words that counts is hit by the chosen family."""
    for least, share in ((13, 0.8), (5, 0.6), (6, 0.75), (4, 0.5), (7, 0.9), (5, 1.0)):
        chosen = {n: decontamination.FAMILIES[decontamination.family(n, least, share)] for n in (None, *range(1, least))}
        for n in range(1, 18):
            for pattern in itertools.product("10", repeat=n):
                pattern = "".join(pattern)
                equal = pattern.count("1")
                if n < least and equal >= share * n:
                    assert hit(chosen[n], pattern)
                if equal >= least and equal >= share * n:
                    assert hit(chosen[None], pattern)
    assert decontamination.family(None, 13, 0.8) == 0
    assert all("0" in mask for n in (None, *range(6, 13)) for mask in decontamination.FAMILIES[decontamination.family(n, 13, 0.8)])


def test_a_family_that_misses_a_pattern_is_not_taken():
    """What ``hits_all`` says of all lengths, against all patterns of up to 20 places."""
    for masks in (("11011",), ("110111", "111011"), ("111111",), ("110111", "111101"), ("1101111", "1111101")):
        missed = any(
            not hit(masks, pattern) for n in range(13, 21) for pattern in map("".join, itertools.product("10", repeat=n))
            if pattern[0] == pattern[-1] == "1" and pattern.count("1") >= max(13, 0.8 * n)
        )
        assert decontamination.hits_all(masks, None, 13, 0.8) == (not missed)


def test_a_common_phrase_is_no_hit(spark):
    """Texts and items that share four words, and nothing else, do not meet."""
    docs = [(i, f"d{i}a d{i}b which of the following d{i}c d{i}d") for i in range(300)]
    items = [(k, f"i{k}a i{k}b i{k}c which of the following i{k}d " + " ".join(f"i{k}w{j}" for j in range(10))) for k in range(100)]
    found, expected = found_and_expected(spark, docs, items)
    assert found == expected == set()
    rows = spark.createDataFrame([(1, "a b c"), (2, None), (3, "a b c d e f")], "item_id long, text string")
    assert sorted(map(tuple, decontamination.unsought_items(rows).collect())) == [(1, 3), (2, 0)]


def test_rows_that_share_an_id_are_judged_by_their_own_texts(spark, sf_dir):
    passage = spark.read.parquet(f"{sf_dir}/benchmark.parquet").first()["text"]
    clean = ["one clean text about rivers and lakes", "another clean text about hills and woods", None]
    rows = [(i, t, "en", "a", 1) for i in (None, 5) for t in (*clean, clean[0], f"before {passage} after")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")

    def texts(frame):
        return sorted(((r.doc_id, r.text) for r in frame.collect()), key=repr)

    expected = [(i, t) for i in (None, 5) for t in (*clean, clean[0])]
    assert texts(corpus_pipeline.decontaminate(spark, df, sf_dir)) == sorted(expected, key=repr)
    # of the copies the row with an id stays; rows without a word are no copies
    expected = [(None, None), (5, clean[0]), (5, clean[1]), (5, None), (5, f"before {passage} after")]
    assert texts(corpus_pipeline.near_copies(spark, df, sf_dir)) == sorted(expected, key=repr)
    alone = df.filter("doc_id IS NULL")
    expected = [(None, t) for t in (*clean, f"before {passage} after")]
    assert texts(corpus_pipeline.near_copies(spark, alone, sf_dir)) == sorted(expected, key=repr)
