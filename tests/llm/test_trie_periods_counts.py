"""Prefix trie, periodic runs and token counts against plain versions."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from docspark.llm import counts, periods, trie

CONVERSATIONS = "conv_id long, turn long, role string, text string"
DOCUMENTS = "doc_id long, text string, lang string"


def written(df, path, name):
    df.write.parquet(f"{path}/{name}.parquet")
    return str(path)


# Prefix trie


def plain_trie(rows):
    """Nodes of the rebuilt conversations, by dictionaries of whole prefixes."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256("".join(hashlib.sha256(x.encode()).hexdigest() for x in (role, text)).encode()).digest()
            own.setdefault(conv, []).append((turn is not None, turn or 0, role, digest, text))
    own = {c: [(x[2], x[4]) for x in sorted(t)] for c, t in own.items()}
    built = {}
    for c, t in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = own.get(c - int(np.fmod(c, 5)), [])[:h] + t[h:]
    members, children = {}, {}
    for c, t in built.items():
        for d in range(len(t) + 1):
            members.setdefault(tuple(t[:d]), []).append(c)
    for k in members:
        if k:
            children.setdefault(k[:-1], []).append(k)
    below, out = {}, []
    for k in sorted(members, key=len, reverse=True):
        under = [below[x] for x in children.get(k, [])]
        saved = (len(members[k]) - 1) * len(k[-1][1].encode()) if k else 0
        below[k] = (sum(x[0] for x in under) or 1, saved + sum(x[1] for x in under))
        ends = ",".join(str(c) for c in sorted(members[k]) if len(built[c]) == len(k))
        out.append((min(members[k]), len(k), min(members[k[:-1]]) if k else None, len(members[k]), len(under), *below[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def trie_of(spark, rows, path, schema=CONVERSATIONS):
    where = written(spark.createDataFrame(rows, schema), path, "conversations")
    return trie.op11_prefix_trie(spark, where)


@pytest.mark.parametrize("seed", range(3))
def test_trie_of_shared_prefixes(spark, tmp_path, seed):
    draw, rows = random.Random(seed), []
    for conv in draw.sample(range(-40, 400), 120):
        turns = [(draw.choice(["user", "assistant", None]), draw.choice(["a", "b", "é", None])) for _ in range(draw.randrange(1, 14))]
        rows += [(conv, None if draw.random() < 0.03 else i, role, text) for i, (role, text) in enumerate(turns)]
    draw.shuffle(rows)
    got = trie_of(spark, rows, tmp_path)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == plain_trie(rows)


def test_trie_nulls_ties_repeats_and_long(spark, tmp_path):
    rows = [(1, None, None, None), (1, 0, "user", "x"), (1, 0, "user", "y"), (1, 0, "user", "x"), (None, 0, "user", "lost"), (7, 3, "", "")]
    rows += [(10, i, "user", f"{i // 2}") for i in range(2_000)] + [(15, i, "user", f"{i // 2}") for i in range(1_500)]  # growing prefixes of one another
    rows += [(c, 0, "user", "hello") for c in range(100, 600)]  # many copies
    rows += [(20, 0, "user", "long" * 1_300_000)]
    assert sorted(map(tuple, trie_of(spark, rows, tmp_path).collect()), key=str) == plain_trie(rows)


def test_trie_work_grows_with_the_turns(spark):
    """Conversations that each repeat the last one and add a turn: every node is another path, none meets all its ancestors twice."""
    rows = [(c, t, "user", str(t)) for c in range(60) for t in range(c + 1)]
    df = spark.createDataFrame(rows, CONVERSATIONS)
    nodes = {(r.conv_id, r.depth): r for r in trie.prefix_trie(trie.turns(df), trie.ids(df)).collect()}
    assert len(nodes) == 61 and nodes[0, 0].n_convs == 60 and nodes[0, 1].n_convs == 60 and nodes[59, 60].n_leaves == 1
    assert nodes[30, 31].parent_conv_id == 29 and nodes[30, 31].n_children == 1


def test_trie_empty_and_clashing(spark, tmp_path):
    assert trie_of(spark, [], tmp_path / "a").count() == 0
    rows = [(1, 0, "user", "x", 5, b"q"), (2, 0, "user", "x", 6, b"r")]
    got = trie_of(spark, rows, tmp_path / "b", CONVERSATIONS + ", depth int, digest binary")
    assert sorted(map(tuple, got.collect()), key=str) == plain_trie([r[:4] for r in rows])


def test_ends_of_one_node_in_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK", 50)
    rows = spark.range(1_000).selectExpr("id AS conv_id", "unhex('00') AS digest", "true AS ends").union(spark.range(5).selectExpr("-id AS conv_id", "unhex('01') AS digest", "true AS ends"))
    got = {bytes(r.digest): r.ends_sha256 for r in trie.ends(rows).collect()}
    assert got == {b"\0": hashlib.sha256(",".join(map(str, range(1_000))).encode()).hexdigest(), b"\1": hashlib.sha256(b"-4,-3,-2,-1,0").hexdigest()}


# Periodic runs


def plain_runs(w):
    n, out = len(w), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                out.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in out.items())


def plain_document(doc_id, text):
    w = (text or "").encode().split()
    n, h = len(w), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if n and h % 10 == 0:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        w = [w[i if i < a else a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    s, length, q = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    lines, left = "".join(f"{a},{b},{c}\n" for a, b, c in runs), b" ".join(x for i, x in enumerate(w) if i not in gone)
    return (doc_id, len(runs), s, length, q, 1000 * length // q if q else None, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(left).hexdigest())


block = st.tuples(st.lists(st.sampled_from([b"a", b"b", b"c"]), min_size=1, max_size=7), st.integers(1, 7))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(block, max_size=5), max_size=6))
def test_runs_of_several_texts(texts):
    words = [[w for b, n in t for w in b * n] for t in texts]
    assert [[tuple(r) for r in own.tolist()] for own in periods.runs(words)] == [plain_runs(w) for w in words]


def test_runs_of_whole_documents(spark, tmp_path):
    draw = random.Random(5)
    texts = [" ".join(w for _ in range(draw.randrange(6)) for w in [draw.choice("abcdé") for _ in range(draw.randrange(1, 9))] * draw.randrange(1, 8)) for _ in range(300)]
    texts += ["", None, " \x0b a\tb \n", "a\xa0b a\xa0b", "x " * 6, "x " * 5, " ".join("ab" * 9)]
    rows = [(i, t, "en") for i, t in enumerate(texts)] + [(3, texts[3], "en"), (None, "a b " * 9, None), (-20, "a b c " * 3, "en")]
    rows += [(i, "w " * 30, "en") for i in range(1_000, 1_080)]
    got = periods.op12_periodic_runs(spark, written(spark.createDataFrame(rows, DOCUMENTS), tmp_path, "documents"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted((plain_document(r[0], r[1]) for r in rows), key=str)
    assert any(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in rows)


def test_runs_of_a_text_of_5_mb(spark):
    distinct = " ".join(f"w{i}" for i in range(300_000))
    text = distinct + " " + "u v w " * 500_000 + "end"
    row = periods.periodic_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert len(text) > 5_000_000 and [tuple(r) for r in row.runs] == [(300_000, 1_500_000, 3)] and row.collapsed == f"{distinct} u v w end"


def test_runs_empty_and_clashing(spark):
    df = spark.createDataFrame([], DOCUMENTS)
    assert periods.periodic_runs(df).count() == 0 and periods.periodic_runs(periods.planted(df)).count() == 0
    df = spark.createDataFrame([(5, "a b a b a b a b", 1, 2, "x")], "doc_id long, text string, n int, h int, RUNS string")
    assert [tuple(r) for r in periods.periodic_runs(df).first().runs] == [(0, 8, 2)] and periods.planted(df).columns == ["doc_id", "text"]


# Token counts


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(counts.vocabulary())


def whole(tokenizer, text):
    return len(tokenizer.encode(text or "", add_special_tokens=False).ids)


ODD = ["", None, " ", "a", "don't you'll <|endoftext|>x<|endoftext|>", "é ñ   x", "中文，日本語です。한국어!", "🙂🙂  \n\n x", "\r\n\t tab", "a" * 3_000, "x" * 2_000 + ". y", "<|endof text|>", "1234,567.89;", "é. á b"]


def test_counts_of_documents(spark, tokenizer, tmp_path):
    rows = [(i, t, "en") for i, t in enumerate(ODD)] + [(None, "no id", "en"), (2, " ", "en"), (99, "word " * 1_024, "en"), (98, " word" * 1_025, "en")]
    got = counts.op13_token_counts(spark, written(spark.createDataFrame(rows, DOCUMENTS), tmp_path, "documents"))
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    want = [(i, len((t or "").encode()), whole(tokenizer, t), whole(tokenizer, t) > 1_024) for i, t, _ in rows]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.sampled_from([t for t in ODD if t]), st.text(max_size=12)), max_size=12), st.integers(1, 40))
def test_counts_of_parts_add_up(tokenizer, pieces, size):
    text = "".join(pieces)
    held = list(counts.parts(text, size))
    assert "".join(held) == text and sum(whole(tokenizer, p) for p in held) == whole(tokenizer, text)


def test_counts_of_5_mb(spark, tokenizer):
    prose, signs = "Some words, and more. 中文，文字。\n" * 180_000, "★" * 1_700_000  # the latter has no safe place
    got = counts.token_counts(spark.createDataFrame([(1, prose), (2, signs)], "doc_id long, text string"), counts.vocabulary()).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in got} == {i: (len(t.encode()), whole(tokenizer, t)) for i, t in ((1, prose), (2, signs))}
    assert max(map(len, counts.parts(prose))) < counts.PART_CHARS + 100


def test_counts_empty_and_clashing(spark):
    assert counts.token_counts(spark.createDataFrame([], DOCUMENTS), counts.vocabulary()).count() == 0
    df = spark.createDataFrame([(1, "a b", 9, "x")], "doc_id long, text string, n_tokens int, N_BYTES string")
    assert tuple(counts.token_counts(df, counts.vocabulary(), limit=1).first()) == (1, 3, 2, True)
