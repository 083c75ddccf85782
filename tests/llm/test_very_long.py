"""Texts of 5 MB through every operator on texts."""

import random
import zlib

import pytest

from docspark.llm import langid, licenses, packing, phrases, quality, simhash, suffixes

SIZE = 5_000_000


@pytest.fixture(scope="module")
def docs(spark):
    draw = random.Random(11)
    words = ["".join(draw.choices("abcdefghijklmnoprstu", k=draw.randrange(3, 9))) for _ in range(4_000)]
    one = "\n".join(" ".join(draw.choices(words, k=12)) for _ in range(SIZE // 78))
    rows = [(1, one, "en", "s"), (2, one, "en", "s"), (3, "x" * SIZE, "en", "s"), (4, "a short text of some words", "en", "s"), (5, " ".join(draw.choices(words, k=300)), "de", "s")]
    assert len(one.encode()) > SIZE * 0.9
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), one


def test_removal(docs):
    df, one = docs
    got = {r["doc_id"]: r for r in phrases.phrase_counts(df).collect()}
    assert {i: r["n_words"] for i, r in got.items()} == {1: len(one.split()), 2: len(one.split()), 3: 1, 4: 6, 5: 300}
    assert got[2]["n_removed"] == got[2]["n_words"] and not any(got[i]["n_removed"] for i in (1, 3, 4, 5))
    got = {r["doc_id"]: r for r in suffixes.byte_counts(df).collect()}
    assert (got[2]["n_removed"], got[2]["n_spans"]) == (len(one), 1) and (got[3]["n_removed"], got[3]["n_spans"]) == (SIZE - 1, 1)
    assert got[1]["n_bytes"] == len(one) and got[1]["n_removed"] == 0


def test_fingerprints(docs):
    df, one = docs
    groups = {r["doc"]: r for r in simhash.near_groups(df).collect()}
    assert groups[1]["fp"] == groups[2]["fp"] == simhash.signed(simhash.fingerprint(one)) and groups[2]["best"]["doc"] == 1 and groups[3]["best"]["doc"] == 3
    assert {r["doc_id"] for r in simhash.keep_one(df).collect()} == {1, 3, 4, 5}


def test_packing(docs):
    df, one = docs
    tokens = packing.Tokens(packing.vocabulary())
    got = packing.pack(df, packing.vocabulary()).collect()
    for i, text in ((1, one), (2, one), (3, "x" * SIZE)):
        own = sorted((r for r in got if r["doc_id"] == i), key=lambda r: r["piece"])
        ids = tokens.encode(text) + (1).to_bytes(4, "little")
        assert [r["start"] for r in own] == [packing.CAPACITY * k for k in range(len(own))] and sum(r["length"] for r in own) == len(ids) // 4
        assert own[-1]["ids_crc32"] == zlib.crc32(ids[4 * own[-1]["start"] :])


def test_quality_and_language(docs):
    df, one = docs
    got = {r["doc_id"]: r for r in quality.assess(df).collect()}
    assert {i: tuple(r[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) for i, r in got.items()} == {i: quality.base_counts(t) for i, t in ((r["doc_id"], r["text"]) for r in df.collect())}
    assert all(r["log_ppl"] is not None for r in got.values())
    said = {r["doc_id"]: r for r in langid.identify(df).collect()}
    assert set(said) == {1, 2, 3, 4, 5} and (said[1]["lang_pred"], said[1]["score"]) == (said[2]["lang_pred"], said[2]["score"]) and said[1]["lang_pred"] in ("en", "de")


def test_licenses(docs, spark):
    df, one = docs
    notice = next(iter(licenses.TEMPLATES.values()))
    held = spark.createDataFrame([(1, f"{one}\n{notice}"), (2, one[:1_000])], "doc_id long, text string")
    assert {r["doc_id"] for r in licenses.scan(held).collect()} == {1}
