"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

import random

import pytest
from pyspark.sql import functions as F

import brute
from corpusmap.llm import (
    bpe, decontamination, language, line_dedup, near_dedup, quality, queries, secret_scan, sharding, substring_dedup,
    token_counts,
)

PATH = queries.tokenizer_path("word_bpe_49k.json")
LONG = " ".join(f"w{k * 7919 % 1009}" for k in range(30000))
RUN = " ".join(f"r{k}" for k in range(60))
ROWS = [
    (1, "The first text of all.\nshared line here", "en", "a", 1),
    (2, None, "en", "a", None),
    (3, "", None, "b", 0),
    (4, " \t\n\r ", "de", None, 4),
    (5, RUN + " tail", "en", "b", 5),
    (6, "head " + RUN, None, "c", 6),
    (6, "head " + RUN, None, "c", 6),
    (7, "une ligne simple\nshared line here", "fr", "c", 7),
    (None, "no id " + RUN, "en", "d", 8),
    (8, LONG, "en", "d", 9),
    (9, LONG + " end", "en", None, 9),
    (10, "Ünï çødé 中文字 😀 token = \"abcdef123456\"", "de", "e", 3),
    (11, "1234 5678 !!", "en", "e", 3),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ("_id", "_text", "chunk", "bucket", "node", "label", "line", "hash", "n_words", "failed", "size", "shard", "at", "w0", "spans", "ids", "n_lines")


def table(spark, rows, clashes=True):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumns({c: F.lit("clash") for c in CLASHES}) if clashes else df


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, ROWS).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return table(spark, [])


def by_id(df):
    return sorted((r.asDict() for r in df.collect()), key=repr)


def test_substrings(docs, nothing):
    found = substring_dedup.remove_repeats(docs).collect()
    expected = brute.repeats([(r[0], r[1]) for r in ROWS])
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in found), key=repr) == sorted(expected, key=repr)
    spans = {r.doc_id: [tuple(s) for s in r.repeats] for r in found}
    assert spans[6] == [(1, 61)] and spans[9] == [(0, 30000)] and spans[5] == []
    assert substring_dedup.remove_repeats(nothing).collect() == []


def test_substrings_of_other_widths(spark):
    random.seed(3)
    rows = [(k, " ".join(random.choice("ab") for _ in range(random.randint(0, 30)))) for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for window in (1, 2, 7):
        found = {r.doc_id: (r.n_removed, r.kept) for r in substring_dedup.remove_repeats(df, window).collect()}
        assert found == {i: (n, kept) for i, _, n, kept in brute.repeats(rows, window)}


def test_quality(docs, nothing):
    rows = by_id(quality.quality_ledger(docs))
    assert len(rows) == len(ROWS)
    by = {r["doc_id"]: r for r in rows}
    assert by[2]["n_words"] == by[3]["n_words"] == by[4]["n_words"] == 0 and by[2]["failed"] == 1
    assert by[8]["n_words"] == 30000 and by[8]["failed"] & 3 == 2
    assert quality.quality_ledger(nothing).collect() == []


def test_ablations_count_by_bits(docs):
    ledger = quality.quality_ledger(docs).cache()
    rows = ledger.collect()
    for r in quality.ablations(ledger, [quality.BASE, quality.DEFAULT]).collect():
        policy = quality.BASE if r.policy == "base" else quality.DEFAULT
        mask = quality.policy_mask(policy)
        bit = next(1 << x.bit for x in quality.RULES if x.name == r.rule)
        assert r.n_kept == sum(x.failed & mask == 0 for x in rows)
        assert r.n_failed == sum(x.failed & bit > 0 for x in rows)
        assert r.n_only_this_rule == sum(x.failed & mask == bit for x in rows)


def test_bpe(docs, nothing):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(PATH)
    found = sorted(((r.doc_id, r.ids, r.decoded) for r in bpe.encode_and_decode(docs, PATH).collect()), key=repr)
    ids = [library.encode(r[1] or "", add_special_tokens=False).ids for r in ROWS]
    assert found == sorted(((r[0], i, library.decode(i, skip_special_tokens=False)) for r, i in zip(ROWS, ids)), key=repr)
    again = {(r.doc_id, r.decoded) for r in bpe.decode(bpe.encode(docs, PATH), PATH).collect()}
    assert again == {(i, text) for i, _, text in found}
    assert bpe.encode(nothing, PATH).collect() == []


def test_secrets(docs, nothing):
    rows = by_id(secret_scan.scan_secrets(docs))
    assert len(rows) == len(ROWS)
    found = {r["doc_id"]: r for r in rows if r["spans"]}
    assert set(found) == {10}
    (span,) = found[10]["spans"]
    text = ROWS[11][1]
    assert text[span.start : span.end] == 'token = "abcdef123456' and span.value == "abcdef123456"
    assert found[10]["n_live"] == 1 and found[10]["most_owners"] == 1
    assert secret_scan.scan_secrets(nothing).collect() == []


def test_near_duplicates(docs, nothing):
    rows = by_id(near_dedup.near_duplicates(docs, width=2))
    assert len(rows) == len(ROWS)
    own = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in rows}
    assert own[2] == (0, 2, True) and own[3] == (0, 3, True) and own[8][1] == own[9][1] == 8
    assert own[5][1] == own[6][1] == own[None][1] == 5 and not own[None][2]
    assert near_dedup.near_duplicates(nothing).collect() == []


def test_passages(spark, docs, nothing):
    items = spark.createDataFrame([(1, RUN), (1, RUN), (2, None), (3, ""), (4, "too short")], "item_id long, text string")
    found = {r.doc_id: (r.item_id, r.n_equal, r.doc_place) for r in decontamination.find_passages(docs, items).collect()}
    assert found == {5: (1, 60, 0), 6: (1, 60, 1), None: (1, 60, 2)}
    left = decontamination.drop_contaminated(docs, items)
    assert left.columns == docs.columns and left.count() == len(ROWS) - 4
    assert decontamination.find_passages(nothing, items).collect() == []
    assert decontamination.find_passages(docs, items.limit(0)).collect() == []


def test_lines(docs, nothing):
    found = line_dedup.dedup_lines(docs, min_sites=2)
    assert set(found.columns) == set(docs.columns) | {"n_removed"}
    by = {r.doc_id: r for r in found.collect()}
    assert by[1].text == "The first text of all." and by[1].n_removed == 1 and by[1]["chunk"] == "clash"
    assert by[2].text is None and by[2].n_lines == 0 and by[3].text == "" and by[4].text == " \t\n\r "
    assert found.count() == len(ROWS)
    assert line_dedup.dedup_lines(nothing).collect() == []


def test_shards(docs, nothing):
    rows = sharding.shard_by_bytes(docs, 4).collect()
    assert len(rows) == len(ROWS) and {r.law for r in rows} == {"bytes"}
    total = sum(r["size"] for r in rows)
    biggest = max(r["size"] for r in rows)
    for k in range(4):
        own = [r for r in rows if r.shard == k]
        assert sorted(r.slot for r in own) == list(range(len(own)))
        assert abs(sum(r["size"] for r in own) - total / 4) <= biggest
    order = [r.doc_id for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
    assert order[0] is None and order[1:] == sorted(order[1:])
    assert sharding.shard_by_bytes(nothing, 4).collect() == []


def test_languages(spark, docs, nothing):
    model = language.train(docs)
    assert model.languages == ["de", "en", "fr"]
    by = {r.doc_id: r for r in language.predict(docs, model, carry=("source",)).collect()}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (2, 3, 4, 11))
    assert by[8].lang_pred == "en" and by[7].lang_pred == "fr" and by[7].source == "c"
    assert all(0 <= r.score <= 1 for r in by.values())
    assert language.train(nothing) is None
    assert {r.lang_pred for r in language.predict(docs, None).collect()} == {"und"}
    assert language.predict(nothing, model).collect() == []


def test_code_lengths_are_those_of_a_distribution():
    import numpy as np

    counts = [np.array([[3.0, 0, 1, 0]]), np.array([[3.0, 2, 1, 0]]), np.array([[0.0, 0, 0, 0]])]
    chance = language.predictions(counts, np.array([1.0, 1, 1, 1]))
    # 3/6 and 1/6 of the longest context; 2/6 escape to the next, which has 2/3 for its one new symbol.
    assert np.allclose(chance, [[3 / 6, 2 / 6 * 2 / 3, 1 / 6, 2 / 6 * 1 / 3]])
    assert np.isclose(chance.sum(), 1)


def test_token_ledger(spark, docs, tmp_path):
    class Words:
        name = "words"

        def __call__(self, texts):
            return [len(t.split()) for t in texts]

    class Chars:
        name = "chars"

        def __call__(self, texts):
            return [len(t) for t in texts]

    ledger = token_counts.TokenLedger(spark, f"file://{tmp_path}/ledger")
    assert ledger.totals().collect() == []
    schema = "doc_id long, change string, source string, lang string, text string, seq long"
    change = lambda rows: spark.createDataFrame(rows, schema)
    first = change([
        (1, "insert", "a", "en", "x y z", 1), (1, "insert", "a", "en", "x y", 2), (2, "insert", "a", None, None, 1),
        (3, "insert", "b", "de", "u v w", 1), (None, "insert", "b", "de", "q", 1), (9, "delete", None, None, None, 1),
    ])
    assert ledger.apply(1, first, Words()) and not ledger.apply(1, first, Words())
    get = lambda: {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in ledger.totals().collect()}
    assert get() == {("a", "en", "words"): (1, 2), ("a", None, "words"): (1, 0), ("b", "de", "words"): (2, 4)}
    second = change([(1, "revise", "a", "en", "abcd", 1), (3, "delete", None, None, None, 1), (None, "revise", "c", "de", "q r", 1)])
    assert ledger.apply(2, second, Chars()) and not ledger.apply(2, second, Chars())
    assert get() == {("a", None, "words"): (1, 0), ("a", "en", "chars"): (1, 4), ("c", "de", "chars"): (1, 3)}
    assert ledger.apply(3, change([]), Words())
    with pytest.raises(ValueError):
        ledger.apply(0, second, Words())
    with pytest.raises(Exception, match="unknown change"):
        ledger.apply(4, change([(1, "upsert", "a", "en", "x", 1)]), Words())
    assert not ledger.is_committed(4) and ledger.apply(4, change([(1, "delete", None, None, None, 1)]), Words())
    assert get() == {("a", None, "words"): (1, 0), ("c", "de", "chars"): (1, 3)}
