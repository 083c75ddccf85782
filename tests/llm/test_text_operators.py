"""Operators on documents against plain versions, with nulls, empty and long texts, ties, repeated rows, an empty table and clashing columns."""

import functools
import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from docspark.llm import graph, langid, licenses, mixing, packing, phrases, quality, repeats, simhash, suffixes

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def corpus(seed=1, n=60):
    r = random.Random(seed)
    words = WORDS + [a + b for a in WORDS[:12] for b in WORDS[:12]]
    passage = " ".join(r.choice(words) for _ in range(60))
    rows = []
    for i in range(n):
        text = " ".join(r.choice(words) + (".\n" if r.random() < 0.1 else "") for _ in range(r.randint(5, 120)))
        if i % 5 == 0:
            text += " " + passage
        if i % 7 == 0 and rows:
            text = rows[r.randrange(len(rows))][1] or text
        if i % 11 == 0 and rows and rows[-1][1]:
            ws = rows[-1][1].split(" ")
            ws[len(ws) // 2] = "changed"
            text = " ".join(ws)
        rows.append((i * 3, text, ["en", "fr", None][i % 3], f"src{i % 4}", len(text)))
    rows += [(901, None, "en", None, None), (902, "", None, "src1", 0), (903, " \n\t ", "en", "src1", 4), (904, "日本語 のテキスト ßé \x00 #|# " * 3, "xx", "src9", 1), (905, "word " * 3000, "en", "src0", 1), (906, passage + " end", "en", "src0", 1)]
    rows += [rows[3], (None, rows[4][1], "fr", "src2", 1)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def clashing(docs):
    names = ["doc", "row", "known", "hash", "fp", "best", "held_out", "piece", "rank", "part", "copies", "w", "h", "start", "_doc", "_row", "_places", "_leaf_n", "_leaf_domain", "_leaf_last", "_TEXT", "_fold", "model", "log_ppl", "kept", "base_failed", "n_words", "_model", "node", "root"]
    from pyspark.sql import functions as F

    return docs.select("*", *[F.lit("x").alias(n) for n in names])


def same(frame, other):
    assert sorted(map(str, frame.collect())) == sorted(map(str, other.collect()))


def order_key(row):
    return (row[0] is None, row[0] or 0)


def unit_truth(rows, size, split, within):
    """Which units of each row a window of an earlier place covers."""
    first = {}
    cut = [split(r[1]) for r in rows]
    for k, r in enumerate(rows):
        for i in range(len(cut[k]) - size + 1):
            place = (order_key(r), i)
            key = tuple(cut[k][i : i + size])
            first[key] = min(first.get(key, place), place)
    out = []
    for k, r in enumerate(rows):
        gone = [False] * len(cut[k])
        for i in range(len(cut[k]) - size + 1):
            at = first[tuple(cut[k][i : i + size])]
            if at[0] < order_key(r) or (within and at < (order_key(r), i)):
                gone[i : i + size] = [True] * size
        out.append((cut[k], gone))
    return out


def plain_phrases(rows):
    """Rows after removal of repeated 13-word windows; rows that lose all their words go."""
    out = []
    for r, (units, gone) in zip(rows, unit_truth(rows, 13, phrases.split, False), strict=True):
        kept = b" ".join(u for u, g in zip(units, gone, strict=True) if not g).decode()
        if not any(gone) or kept:
            out.append((r[0], kept if any(gone) else r[1], *r[2:]))
    return out


def test_phrases(docs, none):
    rows = [tuple(r) for r in docs.collect()]
    want = Counter()
    for r, (units, gone) in zip(rows, unit_truth(rows, 13, phrases.split, False), strict=True):
        kept = [u for u, g in zip(units, gone, strict=True) if not g]
        want[r[0], len(units), len(units) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()] += 1
    got = phrases.phrase_counts(docs)
    assert Counter(map(tuple, got.collect())) == want
    assert sum(k[2] for k in want) > 500
    same(phrases.phrase_counts(clashing(docs)), got)
    for hot in (1, 5):  # windows of widely met anchors on their own
        same(phrases.phrase_counts(docs, hot), got)
    assert phrases.phrase_counts(none).count() == 0
    left = phrases.remove_phrases(docs)
    assert left.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in left.collect()}[903] == " \n\t "
    assert Counter((r["doc_id"], r["text"]) for r in left.collect()) == Counter((r[0], r[1]) for r in plain_phrases(rows))
    wide = phrases.remove_phrases(clashing(docs))
    assert wide.columns == clashing(docs).columns
    same(wide.select(*docs.columns), left)
    assert phrases.remove_phrases(none).count() == 0


def test_suffixes(docs, none):
    rows = [tuple(r) for r in docs.collect()]
    unique = sorted(set(rows), key=lambda r: (order_key(r), xxhash.xxh64_intdigest((r[1] or "").encode(), 42)))
    truth = {}
    for r, (units, gone) in zip(unique, unit_truth(unique, 100, lambda t: (t or "").encode(), True), strict=True):
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        truth[r[0]] = (len(units), sum(gone), runs, hashlib.sha256(bytes(u for u, g in zip(units, gone, strict=True) if not g)).hexdigest())
    got = suffixes.byte_counts(docs)
    assert len(got.collect()) == len(rows)
    for r in got.collect():
        assert tuple(r)[1:] == truth[r["doc_id"]], r
    same(suffixes.byte_counts(clashing(docs)), got)
    for hot in (1, 5):
        same(suffixes.byte_counts(docs, hot), got)
    assert suffixes.byte_counts(none).count() == 0


@pytest.mark.parametrize("letters", [2, 3, 20])
def test_two_stage_order(letters):
    r = random.Random(letters)
    for _ in range(60):
        data = b"".join(bytes(r.randrange(2, 2 + letters) for _ in range(r.randint(1, 60))) + b"\0" for _ in range(r.randint(1, 8)))
        order = suffixes.suffix_order(np.frombuffer(data, np.uint8), 100)
        keys = [data[i : data.index(b"\0", i)] for i in order]
        assert sorted(order.tolist()) == list(range(len(data))) and keys == sorted(keys)


@pytest.mark.parametrize("size", [1, 2, 3, 1000])
def test_recurring_rows_in_any_batches(size):
    import pyarrow as pa

    rows = [(1, 10, 0, 1), (2, 11, 0, 1), (2, 12, 0, 1), (2, 13, 1, 3), (3, 14, 2, 0), (3, 15, 2, 0), (4, 16, 1, 2), (5, 17, 0, 1)]
    rows += [(6, i, 0, 1) for i in range(20, 30)] + [(7, i, 2, 0) for i in range(30, 40)] + [(7, 40, 0, 1), (8, 50, 0, 1)]
    table = pa.table([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int8(), pa.int64()), strict=True)], names=["hash", "doc", "flag", "n"])
    got = [r for b in repeats._recurring(table.to_batches(max_chunksize=size)) for r in b.to_pylist()]
    assert sorted(r["doc"] for r in got) == sorted({r[1] for r in rows} - {10, 17, 40, 50})
    counts = Counter()
    for r in got:
        counts[r["hash"]] = max(counts[r["hash"]], r["n"])
    assert (counts[2], counts[4], counts[6]) == (5, 2, 10)


def test_known_places_are_not_held():
    """Rows whose windows are known to repeat go on at once, however many there are."""
    import pyarrow as pa

    types = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.binary())
    names = ["hash", "doc", "row", "starts", "windows", "segment"]
    sent = []

    def batches(n):
        for k in range(0, n, 10_000):
            sent.append(k)
            columns = [[0] * 10_000, range(k, k + 10_000), [1] * 10_000, [[3, 9]] * 10_000, [5] * 10_000, [None] * 10_000]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    low = tracemalloc_peak(lambda: sum(b.num_rows for b in repeats._located(phrases.WORDS)(batches(20_000))))
    high = tracemalloc_peak(lambda: sum(b.num_rows for b in repeats._located(phrases.WORDS)(batches(1_000_000))))
    assert high[0] == 2_000_000 and high[1] < 1.5 * low[1] + 1_000_000
    first = next(iter(repeats._located(phrases.WORDS)(batches(1_000_000))))
    assert first.to_pylist()[1] == {"doc": 0, "row": 1, "start": 9, "windows": 5} and sent[-1] == 0


def tracemalloc_peak(run):
    import tracemalloc

    tracemalloc.start()
    try:
        return run(), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_texts_without_ids_share_no_key(spark):
    """Rows without an id count as one last document, but their anchors are not gathered under one key."""
    r = random.Random(4)
    passage = " ".join(r.choice(WORDS) for _ in range(30))
    rows = [(5, "a " + passage)] + [(None, f"{passage} {i} " + " ".join(r.choice(WORDS) for _ in range(20))) for i in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = Counter()
    for row, (units, gone) in zip(rows, unit_truth(rows, 13, phrases.split, False), strict=True):
        want[row[0], len(units), sum(gone)] += 1
    assert Counter(tuple(x)[:3] for x in phrases.phrase_counts(frame).collect()) == want
    assert frame.select(repeats.document().alias("d")).distinct().count() == len(rows)


def test_scratch_needs_a_shared_folder_on_clusters(spark, monkeypatch):
    from docspark.llm import common

    class Cluster:
        class conf:
            get = staticmethod(lambda key, default: None)

        class sparkContext:
            master = "spark://somewhere:7077"

    with pytest.raises(RuntimeError):
        common.scratch(Cluster)


def test_equal_windows_share_an_anchor():
    r = np.random.default_rng(3)
    values = r.integers(0, 4, 400).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    both = np.concatenate([values[50:90], values])
    h, text, first, number = repeats.anchors(both, np.array([40, 400]), 13, 6)
    of = {}
    for v, t, a, n in zip(h, text, first, number, strict=True):
        of.update({(t, a + i): v for i in range(n)})
    assert len(of) == 28 + 388 and all(of[0, i] == of[1, 50 + i] for i in range(28))


def test_fingerprints():
    for text in ("", None, "One", "a b", "The quick Brown fox, jumps é É", "x " * 50):
        words = text.encode().lower().split() if text else []
        grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        assert simhash.fingerprint(text) == want


@pytest.mark.parametrize("file_pairs", [48, 1])
def test_links(spark, file_pairs):
    r = random.Random(5)
    marks = {r.getrandbits(64) for _ in range(40)}
    for m in list(marks)[:12]:
        for _ in range(6):
            m ^= 1 << r.randrange(64)
            if r.random() < 0.7:
                m ^= 1 << r.randrange(64)
            marks.add(m)
    marks = sorted(simhash.signed(m) for m in marks)
    parent = {m: m for m in marks}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(marks):
        for b in marks[i + 1 :]:
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2:
                parent[max(top(a), top(b))] = min(top(a), top(b))
    found = graph.components(simhash.links(spark.createDataFrame([(m, 0, m) for m in marks], "node long, seed int, fp long"), file_pairs)).collect()
    want = {m: top(m) for m in marks if sum(top(x) == top(m) for x in marks) > 1}
    assert {r["node"]: r["root"] for r in found} == want and len(want) > 60


def test_chain_components(spark):
    n = 70
    links = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(200, 201), (300, 300)], "a long, b long")
    got = {r["node"]: r["root"] for r in graph.components(links).collect()}
    assert got == {**{i: 0 for i in range(n + 1)}, 200: 200, 201: 200}
    assert graph.components(links.where("a < 0")).count() == 0


def text_hash(text):
    """Spark's xxhash64 of a text; of null, the seed."""
    return 42 if text is None else simhash.signed(xxhash.xxh64_intdigest(text.encode(), 42))


def grouped(keys, linked):
    """The least member of each member's component."""
    parent = {k: k for k in keys}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if linked(a, b):
                x, y = top(a), top(b)
                parent[max(x, y)] = min(x, y)
    return {k: top(k) for k in keys}


def plain_keep_one(rows, seeds=simhash.SEEDS):
    """Rows that stay: word fingerprints of all pairs are compared, bit by bit in Python numbers."""
    mask = (1 << 64) - 1

    def prints(text):
        words = {"".join(c for c in w if c == "_" or c.isalnum()) for w in (text or "").lower().split()} - {""}
        out = []
        for seed in range(1, seeds + 1):
            total = [0] * 64
            for w in words:
                x = xxhash.xxh3_64_intdigest(w.encode()) + seed * 0x9E3779B97F4A7C15 & mask
                x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & mask
                x = (x ^ x >> 27) * 0x94D049BB133111EB & mask
                x ^= x >> 31
                for b in range(64):
                    total[b] += x >> b & 1
            out.append(sum(1 << b for b in range(64) if 2 * total[b] > len(words)))
        return tuple(out) if words else ()

    of = {}
    for r in rows:
        of.setdefault((order_key(r), text_hash(r[1])), []).append(r)
    fps = {k: prints(v[0][1]) for k, v in of.items()}
    tops = grouped(sorted(of), lambda a, b: fps[a] == fps[b] or any((x ^ y).bit_count() <= 2 for x, y in zip(fps[a], fps[b], strict=False)))
    return [of[k][0] for k in of if tops[k] == k]


def test_op4(spark, docs, none, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = docs.collect()
    prints = {}
    for r in rows:
        words = (r[1] or "").encode().lower().split()
        grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        prints[r[0], r[1]] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    marks = sorted(set(prints.values()))
    tops = grouped(marks, lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for (doc_id, _), fp in prints.items():
        if doc_id is not None:
            least[tops[fp]] = min(least.get(tops[fp], doc_id), doc_id)
    got = Counter(tuple(r)[:3] for r in simhash.op4_simhash(spark, str(tmp_path)).collect())
    assert got == Counter((r[0], f"{prints[r[0], r[1]]:016x}", least[tops[prints[r[0], r[1]]]]) for r in rows)
    assert simhash.near_groups(none).count() == 0


SCRIPTS = {"Latin": ([chr(0x61 + i) for i in range(26)], " "), "Cyrillic": ([chr(0x430 + i) for i in range(32)], " "), "Chinese": ([chr(0x4E00 + i) for i in range(2_500)], ""), "Thai": ([chr(0xE01 + i) for i in range(46)], "")}


@pytest.mark.parametrize("name", list(SCRIPTS))
def test_near_copies_of_any_script_are_found(name):
    draw, (letters, gap) = random.Random(7), SCRIPTS[name]
    units = ["".join(draw.choices(letters, k=draw.randrange(3, 9))) for _ in range(2_000)] if gap else letters
    weights = [1 / (i + 10) for i in range(len(units))]
    shingles = lambda u: {tuple(u[i : i + 5]) for i in range(len(u) - 4)}
    near = lambda a, b: any((x ^ y).bit_count() <= simhash.MAX_BITS for x, y in zip(*(simhash.word_fingerprints(gap.join(u), simhash.SEEDS) for u in (a, b)), strict=True))
    hits, false = [], 0
    for size in (80, 300, 1_200):
        for _ in range(40):
            one = draw.choices(units, weights, k=size)
            other = list(one)
            for _ in range(max(1, size * draw.randrange(1, 4) // 200)):
                other[draw.randrange(size)] = draw.choice(units)
            if len(shingles(one) & shingles(other)) >= 0.8 * len(shingles(one) | shingles(other)):
                hits.append(near(one, other))
            false += near(one, draw.choices(units, weights, k=size))
    assert len(hits) > 80 and sum(hits) >= 0.9 * len(hits) and not false


def test_texts_of_signs_are_not_one_group(spark):
    texts = ["★ ☃ ☂ → ←", "∑ ∏ ∫ √", "🙂 🙃", "★ ☃ ☂ → ←", " ", "", None, "!!! ???", "你好", "您早"]
    kept = {r["doc_id"] for r in simhash.keep_one(spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], SCHEMA)).collect()}
    assert kept == {0, 1, 2, 4, 7, 8, 9}


def test_keep_one(docs, none):
    rows = [tuple(r) for r in docs.collect()]
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert Counter((r[0], r[1]) for r in kept.collect()) == Counter((r[0], r[1]) for r in plain_keep_one(rows))
    wide = simhash.keep_one(clashing(docs))
    assert wide.columns == clashing(docs).columns
    same(wide.select(*docs.columns), kept)
    assert simhash.keep_one(none).count() == 0
    assert simhash.keep_one(docs, simhash.near_groups).count() == len({(r["best"]["doc"], r["best"]["row"]) for r in simhash.near_groups(docs).collect()})


def test_near_copies_are_found(spark):
    """Of texts with four fifths of an original's five-word shingles, nine tenths go; other texts stay."""
    r = random.Random(8)
    vocabulary = ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 9))) for _ in range(3_000)]
    shingles = lambda ws: {tuple(ws[i : i + 5]) for i in range(len(ws) - 4)}
    rows, near = [], set()
    for i in range(150):
        ws = [vocabulary[int(3_000 * r.random() ** 2)] for _ in range(r.randint(150, 900))]
        copy = [r.choice(vocabulary) if r.random() < 0.015 else w for w in ws]
        rows += [(2 * i, " ".join(ws), "en", "s", 1), (2 * i + 1, " ".join(copy), "en", "s", 1)]
        a, b = shingles(ws), shingles(copy)
        if len(a & b) >= 0.8 * len(a | b):
            near.add(2 * i + 1)
    kept = {x["doc_id"] for x in simhash.keep_one(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert set(range(0, 300, 2)) <= kept and len(near) > 80
    assert len(near - kept) >= 0.9 * len(near)


def test_packing(docs, none):
    path = packing.vocabulary()
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    rows = packing.pack(docs, path, capacity=128).collect()
    ids = {r[0]: [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 1] for r in docs.collect()}
    for doc_id, want in ids.items():
        mine = sorted({(r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows if r["doc_id"] == doc_id})
        assert mine == [(k, a, len(want[a : a + 128]), zlib.crc32(np.array(want[a : a + 128], "<u4").tobytes())) for k, a in enumerate(range(0, len(want), 128))]
    places = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for found in places.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= 128
    assert len(rows) == sum(-(-len(ids[r[0]]) // 128) for r in docs.collect())
    assert len(places) <= 1.1 * sum(r["length"] for r in rows) / 128 + 2
    assert packing.pack(none, path).count() == 0
    same(packing.pack(clashing(docs), path, 128).select("doc_id", "piece", "length", "ids_crc32"), packing.pack(docs, path, 128).select("doc_id", "piece", "length", "ids_crc32"))


@pytest.mark.parametrize("seed", range(6))
def test_plan_fills_every_slot(seed):
    r = random.Random(seed)
    histogram = Counter(r.choice([1, 2, 3, 50, r.randint(1, 100), 100]) for _ in range(r.randint(1, 900)))
    used, ranks = {}, Counter()
    for length, rank, n, first, offset in packing.plan(dict(histogram), 100):
        for i in range(n):
            used.setdefault(first + i, []).append((offset, length))
        assert rank == ranks[length]
        ranks[length] += n
    assert ranks == histogram
    assert sorted(used) == list(range(len(used)))
    for found in used.values():
        assert sum(n for _, n in found) <= 100 and all(a == sum(n for b, n in found if b < a) for a, _ in found)
    assert len(used) <= 1.25 * sum(k * v for k, v in histogram.items()) / 100 + 1


def test_tokens_like_the_tokenizer():
    tokens = packing.Tokens(packing.vocabulary(), most=40)
    for text in ("Don't we'll 12,5 x²½ naïve CAFÉ Straße «q» µ", "İstanbul ŉ Ǆ", "<|endoftext|> <|ENDOFTEXT|> a", "日本 text nb\x85x", "a\x1cb", "", None, " ".join(WORDS) * 9):
        want = np.array(tokens.tokenizer.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()
        assert tokens.encode(text) == want


def test_tokens_of_every_letter():
    tokens = packing.Tokens(packing.vocabulary())
    r = random.Random(3)
    texts = [text for cp in range(1, 0x250) for c in [chr(cp)] for text in (f"{c}li Bak{c} bo{c}ki", f"a {c} b", f"1{c}2{c}{c}x's{c}")]
    texts += ["".join(chr(r.randrange(1, 0x250)) if r.random() < 0.5 else r.choice("abc ’'slt9 \n") for _ in range(r.randint(1, 40))) for _ in range(2_000)]
    assert [t for t in texts if tokens.encode(t) != tokens.direct(t)] == []


def plain_base(text):
    words = (text or "").encode().split()
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    hit = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i : i + 8])] > 1:
            hit |= set(range(i, i + 8))
    n = len(words)
    return (n, len("".join(w.decode() for w in words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit), n < 20 or 100 * len(hit) > 30 * n)


def plain_model(texts):
    """Interpolated modified Kneser-Ney over code points, by dictionaries: probability of a gram's last sign after the others."""
    grams = {4: Counter(("^^^" + t)[i : i + 4] for t in texts for i in range(len(t)))}
    for n in (3, 2, 1):
        grams[n] = Counter(g[1:] for g in grams[n + 1])
    off, heads = {}, {n: {} for n in grams}
    for n, g in grams.items():
        c = Counter(g.values())
        y = c[1] / (c[1] + 2 * c[2]) if c[1] else 0
        off[n] = [0.0] + [min(max(k - (k + 1) * y * c[k + 1] / c[k] if c[k] else 0.5 * k, 0.05 * k), 0.95 * k) for k in (1, 2, 3)]
        for gram, v in g.items():
            head = heads[n].setdefault(gram[:-1], [0, 0.0])
            head[0] += v
            head[1] += off[n][min(v, 3)]

    @functools.cache
    def p(gram):
        n = len(gram)
        if n == 0:
            return 1 / (len(grams[1]) + 1) if grams[1] else 1 / quality.START
        low = p(gram[1:])
        if gram[:-1] not in heads[n]:
            return low
        total, free = heads[n][gram[:-1]]
        v = grams[n].get(gram, 0)
        return (v - off[n][min(v, 3)]) / total + free / total * low

    return p


def plain_quality(rows, reach=quality.REACH):
    """kept, log perplexity a character and a word with their bands, of each row."""
    group = lambda r: (r[2] is None, r[2] or "")
    fold = lambda t: xxhash.xxh64_intdigest((t or "").encode(), 42) & 1
    models = {(g, f): plain_model([r[1] for r in rows if r[1] and group(r) == g and fold(r[1]) == f]) for g in {group(r) for r in rows} for f in (0, 1)}
    figures = []
    for r in rows:
        t = r[1] or ""
        p = models[group(r), 1 - fold(r[1])]
        costs = [-math.log(p(("^^^" + t)[i : i + 4])) for i in range(len(t))]
        white = lambda i: i < 0 or t[i] in " \t\n\x0b\x0c\r"  # noqa: E731, B023
        n = max(1, len(t) // 64)
        parts = [(k * len(t) // n, (k + 1) * len(t) // n) for k in range(n)]
        signs = sorted(sum(costs[a:b]) / max(1, b - a) for a, b in parts)
        per_word = sorted(sum(costs[a:b]) / max(1, sum(white(i - 1) and not white(i) for i in range(a, b))) for a, b in parts)
        figures.append((signs[(n - 1) // 2] if t else None, per_word[(n - 1) // 2] if t.encode().split() else None))
    bands = {}
    for g in {group(r) for r in rows}:
        for k in (0, 1):
            mine = [(f[k], len(r[1])) for r, f in zip(rows, figures, strict=True) if group(r) == g and f[k] is not None]
            if not mine:
                continue
            quartile = lambda xs, q: sorted(xs)[max(0, math.ceil(q * len(xs)) - 1)]
            bins = {}
            for v, n in mine:
                bins.setdefault(n.bit_length(), []).append((v, n))
            points = [(sum(n for _, n in b), len(b) / sum(n for _, n in b), (quartile([v for v, _ in b], 0.75) - quartile([v for v, _ in b], 0.25)) ** 2) for b in bins.values()]
            w = sum(x[0] for x in points)
            x, y = sum(a * b for a, b, _ in points) / w, sum(a * c for a, _, c in points) / w
            spread = sum(a * (b - x) ** 2 for a, b, _ in points)
            beta = max(0.0, sum(a * (b - x) * (c - y) for a, b, c in points) / spread) if spread > 0 else 0.0
            bands[g, k] = (quartile([v for v, _ in mine], 0.25), quartile([v for v, _ in mine], 0.75), max(0.0, y - beta * x), beta)
    out = []
    for r, f in zip(rows, figures, strict=True):
        kept, shown = not plain_base(r[1])[-1], []
        for k in (0, 1):
            if (group(r), k) in bands:
                q1, q3, alpha, beta = bands[group(r), k]
                slack = reach * (alpha + beta / max(1, len(r[1] or ""))) ** 0.5
                shown += [f[k], q1 - slack, q3 + slack]
                kept = kept and (f[k] is None or q1 - slack <= f[k] <= q3 + slack)
            else:
                shown += [f[k], None, None]
        out.append((kept, *shown))
    return out


def test_quality(docs, none):
    rows = [tuple(r) for r in docs.collect()]
    got = quality.assess(docs)
    found = got.collect()
    assert len(found) == len(rows)
    base = Counter((r[0], *plain_base(r[1])) for r in rows)
    assert Counter(tuple(r)[:7] for r in found) == base
    by_id = {r["doc_id"]: tuple(r)[7:] for r in found}
    for r, want in zip(rows, plain_quality(rows), strict=True):
        mine = by_id[r[0]]
        assert mine[0] == want[0] and all(a is b if b is None else abs(a - b) < 1e-4 for a, b in zip(mine[1:], want[1:], strict=True)), (r, mine, want)
    kept = quality.keep_good(docs)
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(r["doc_id"] for r in found if r["kept"])
    same(quality.assess(clashing(docs)), got)
    wide = quality.keep_good(clashing(docs))
    assert wide.columns == clashing(docs).columns
    same(wide.select(*docs.columns), kept)
    assert quality.assess(none).count() == 0 and quality.keep_good(none).count() == 0


def test_repeated_windows_of_one_hash(monkeypatch):
    text = " ".join(random.Random(1).choice("abc") for _ in range(60))
    want = quality.base_counts(text)
    assert want == plain_base(text)
    monkeypatch.setattr(quality, "rolling", lambda values, n: np.zeros(len(values) - n + 1, np.uint64))
    assert quality.base_counts(text) == want


def test_scrambled_texts_go(spark):
    """Texts whose letters are dealt anew are rejected in every script, and the others stay."""
    r = random.Random(5)
    words = {
        "en": "water stone road wind sun river tree bird town sea snow fire".split(), "ru": "вода камень дорога ветер солнце река дерево птица город море снег огонь".split(),
        "zh": "天气 河流 石头 山路 太阳 月亮 飞鸟 城市 大海 雪花 火焰 春风".split(),
    }
    rows, bad = [], set()
    for lang, own in words.items():
        for i in range(90):
            text = " ".join(r.choice(own) for _ in range(60))
            if i % 30 == 7:
                letters = [c for c in text if c != " "]
                r.shuffle(letters)
                text = "".join(c if c == " " else letters.pop() for c in text)
                bad.add(len(rows))
            rows.append((len(rows), text, lang, "s", 1))
    got = {x["doc_id"]: x for x in quality.assess(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}
    assert not any(got[i]["kept"] for i in bad)
    assert sum(x["kept"] for x in got.values()) >= 0.95 * (len(rows) - len(bad))


def test_grams_of_a_large_alphabet():
    text = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x13000)])) + "end"
    a, b, n = quality._merged(quality.point_grams([text, "end"]))
    padded = [(quality.START,) * 3 + tuple(map(ord, t)) for t in (text, "end")]
    want = Counter(t[i : i + 4] for t in padded for i in range(len(t) - 3))
    assert {(x >> 21, x & 0x1FFFFF, y >> 21, y & 0x1FFFFF): k for x, y, k in zip(a.tolist(), b.tolist(), n.tolist())} == want


def test_bands_reject_planted_junk(spark):
    """Bar-separated fragments and words with signs at their end go, clean documents of every length stay."""
    r = random.Random(6)
    sf = "/root/testdata/sf0.01"
    real = spark.read.parquet(f"{sf}/documents.parquet").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("lang = 'en' AND quality = 1 AND length(text) > 300").select("doc_id", "text").dropDuplicates(["doc_id"]).orderBy("doc_id").collect()
    clean = [(x["doc_id"], x["text"], "en", "s", 1) for x in real]
    junk = []
    for i, x in enumerate(real[:12]):
        ws = x["text"].split()[:150]
        text = "".join(w[r.randrange(len(w)) :] + (" | " if r.random() < 0.3 else " ") for w in ws) if i % 2 else " ".join(w + r.choice(["", "", "%%%", "###", "&&&"]) for w in ws)
        junk.append((-1 - i, text, "en", "s", 1))
    got = [x for x in quality.assess(spark.createDataFrame(clean + junk, SCHEMA).repartition(3)).collect() if not x["base_failed"]]
    bad = [x["kept"] for x in got if x["doc_id"] < 0]
    good = [x["kept"] for x in got if x["doc_id"] >= 0]
    assert len(bad) >= 10 and len(good) > 100
    assert sum(bad) <= 0.25 * len(bad) and sum(good) >= 0.97 * len(good)


def test_every_language_has_its_band(spark):
    """What one language's documents get doesn't depend on how many languages there are; null is no language's group."""
    r = random.Random(7)
    few = [(i, " ".join(r.choice(WORDS) for _ in range(r.randint(25, 60))), lang, "s", 1) for i, lang in enumerate(["ka", "", None] * 5)]
    many = [(100 + i, " ".join(r.choice(WORDS[i % 7 :: 2]) for _ in range(30)), f"l{i % 20}", "s", 1) for i in range(140)]
    figures = lambda rows: {x["doc_id"]: tuple(x) for x in quality.assess(spark.createDataFrame(rows, SCHEMA).repartition(2)).collect() if x["doc_id"] < 100}
    alone = {}
    for lang in ("ka", "", None):
        alone |= figures([x for x in few if x[2] == lang])
    assert figures(few + many) == alone


def test_languages(spark, none):
    r = random.Random(2)
    vocab = {"en": "the of and with from this that then house stone".split(), "de": "der die und nicht schön straße über stein haus auch".split(), "fr": "le où et après été maison pierre avec nous vous".split()}
    rows = [(i, " ".join(r.choice(vocab[lang]) for _ in range(r.randint(5, 60))), lang) for i in range(400) for lang in [r.choice(list(vocab))]]
    odd = [(1000, None, "en"), (1001, "", None), (1002, "12 34 !", "de"), (1003, rows[0][1], None), (None, rows[1][1], "fr"), rows[2]]
    frame = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string")
    got = langid.identify(frame).collect()
    assert len(got) == len(rows) + len(odd)
    by = {x["doc_id"]: x for x in got}
    held = [x for x in rows if by[x[0]]["held_out"]]
    assert all(by[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, *_ in rows) and len(held) > 40
    assert sum(by[i]["lang_pred"] == lang for i, _, lang in held) >= 0.98 * len(held)
    assert all(0 <= x["score"] <= 1 for x in got)
    assert [by[i]["lang_pred"] for i in (1000, 1001, 1002)] == ["und"] * 3 and by[1003]["lang_pred"] == by[0]["lang_pred"]
    same(langid.identify(clashing(frame)), langid.identify(frame))
    assert langid.identify(none).count() == 0
    unlearned = langid.identify(spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")).first()
    assert unlearned["lang_pred"] == "und"


def spectrum(text):
    """N-grams of 1 to 3 small letters, other characters as one blank."""
    s = "".join(c if c.isalpha() else " " for c in text.lower())
    s = " ".join((" " + s + " ").split(" "))
    while "  " in s:
        s = s.replace("  ", " ")
    s = s if s.startswith(" ") else " " + s
    s = s if s.endswith(" ") else s + " "
    return {s[i : i + n] for n in (1, 2, 3) for i in range(len(s) - n + 1)}


def test_languages_like_dense_ridge(spark):
    """Predictions equal a dense kernel ridge regression on the same learning texts and landmarks, with sets of n-grams."""
    r = random.Random(12)
    vocab = {"en": "the of and with from this house".split(), "ru": "вода и камень на дорога ветер".split(), "el": "νερό και πέτρα στον δρόμο".split(), "fr": "le où et après maison pierre".split()}
    rows = [(i, " ".join(r.choice(vocab[lang]) for _ in range(r.randint(3, 12))), lang) for i in range(160) for lang in [r.choice(list(vocab))]]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {x["doc_id"]: x for x in langid.identify(frame).collect()}
    seen = langid.Presence()
    learnt = sorted({(lang, t) for i, t, lang in rows if zlib.crc32(str(i).encode()) % 5}, key=lambda x: (x[0], len(seen.of(x[1])), seen.of(x[1]).tobytes()))
    learnt = [learnt[i] for i in np.random.default_rng(42).permutation(len(learnt))]
    langs, sets = [x[0] for x in learnt], [spectrum(x[1]) for x in learnt]
    marks = [sets[i] for i in langid.landmarks_of(langs, 256)]
    kernel = lambda a, b: len(a & b) / math.sqrt(len(a) * len(b))
    values, vectors = np.linalg.eigh(np.array([[kernel(a, b) for b in marks] for a in marks]))
    good = values > 1e-6 * values.max()
    whiten = vectors[:, good] / np.sqrt(values[good])
    features = np.array([[kernel(a, b) for b in marks] for a in sets]) @ whiten
    labels = sorted(set(langs))
    targets = np.array([[float(x == name) for name in labels] for x in langs])
    weights = np.linalg.solve(features.T @ features + langid.RIDGE * len(langs) * np.eye(features.shape[1]), features.T @ targets)
    for i, text, _ in rows:
        scores = np.array([kernel(spectrum(text), b) for b in marks]) @ whiten @ weights
        best = int(scores.argmax())
        assert abs(got[i]["score"] - min(1, max(0, scores[best]))) < 2e-2
        assert got[i]["lang_pred"] == labels[best] or np.sort(scores)[-1] - np.sort(scores)[-2] < 1e-2


def test_many_languages_and_copies(spark):
    """300 languages are all learnt; copies of one text don't raise what reaches the driver."""
    r = random.Random(3)
    own = {f"l{k:03d}": ["".join(chr(0x3400 + 20 * k + r.randrange(20)) for _ in range(3)) for _ in range(8)] for k in range(300)}
    rows = [(1000 * k + i, " ".join(r.choice(ws) for _ in range(12)), name) for k, (name, ws) in enumerate(own.items()) for i in range(8)]
    copies = spark.range(100_000).selectExpr("id + 10000000 AS doc_id", "'copied text of one language' AS text", "'l000' AS lang")
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").unionByName(copies)
    labels, vocabulary, matrix = langid.train(frame)
    assert labels == sorted(own) and matrix.shape == (len(vocabulary), 300)
    few = frame.where("doc_id < 10000000")
    got = {x["doc_id"]: x["lang_pred"] for x in langid.identify(few).collect()}
    assert sum(got[i] == lang for i, _, lang in rows) >= 0.95 * len(rows)


def test_sample_bounds_what_is_learnt(spark, monkeypatch):
    taken = []
    fit = langid.fit
    monkeypatch.setattr(langid, "fit", lambda langs, grams: taken.append(langs) or fit(langs, grams))
    frame = spark.range(5_000).selectExpr("id AS doc_id", "concat('text ', CASE WHEN id % 3 = 0 THEN 0 ELSE id END, ' of words') AS text", "CASE WHEN id % 3 = 0 THEN 'a' ELSE concat('b', id % 2) END AS lang")
    langid.train(frame, 90)
    counts = Counter(taken[0])
    assert counts == {"a": 1, "b0": 30, "b1": 30}


def test_kernel_is_presence_overlap():
    seen = langid.Presence()
    a, b = seen.of("Der Hund, der bellt"), seen.of("der Hund bellt nicht")

    def grams(text):
        s = " " + "".join(c if c.isalpha() else " " for c in text.lower()) + " "
        s = " ".join(s.split(" ")).replace("  ", " ")
        return {s[i : i + n] for n in (1, 2, 3) for i in range(len(s) - n + 1)}

    assert len(set(a) & set(b)) == len(grams("Der Hund, der bellt") & grams("der Hund bellt nicht"))
    assert len(a) == len(set(a)) == len(grams("Der Hund, der bellt"))


def test_licenses(spark, none):
    r = random.Random(4)
    filler = lambda n: " ".join(r.choice(WORDS) for _ in range(n))
    rows = []
    for i, (_, text) in enumerate(licenses.TEMPLATES.items()):
        rows += [(10 * i, f"{filler(i * 7)} {text} {filler(30)}"), (10 * i + 1, f"{filler(50)}\n{text.upper()}"), (10 * i + 2, text), (10 * i + 3, f"{text} {filler(3)} {text}")]
        ws = text.split()
        ws[-1] = "zzz"
        rows.append((10 * i + 4, f"{filler(20)} {' '.join(ws)} {filler(20)}"))
    rows += [(500, filler(500)), (501, None), (502, ""), (503, "one two"), rows[0], (None, licenses.TEMPLATES["MIT"])]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    want = set()
    for doc_id, text in rows:
        sh = licenses.shingles(licenses.words(text))
        for name, template in licenses.TEMPLATES.items():
            parts = licenses.shingles(licenses.words(template))
            m = len(parts)
            span, step = m + (m + 1) // 2, max(1, (m + 1) // 2)
            best = max((len(set(parts) & set(sh[k : k + span])) / len(set(parts)) for k in range(0, max(1, len(sh)), step)), default=0)
            if best >= 0.8:
                want.add((doc_id, name, round(best, 6)))
    got = licenses.scan(frame)
    assert {(x["doc_id"], x["template"], x["containment"]) for x in got.collect()} == want and len(want) > 40
    same(licenses.scan(clashing(frame)), got)
    assert licenses.scan(none).count() == 0
    with pytest.raises(ValueError):
        licenses.scan(frame, {"x": "too short"})


def plain_share(budget, children):
    """Water-filling with whole tokens: children name -> (cap, weight)."""
    given, open_ = {}, dict(children)
    while open_:
        total = sum(w for _, w in open_.values())
        full = {n: c for n, (c, w) in open_.items() if budget * w >= c * total}
        if not full:
            return given | {n: budget * w // total for n, (c, w) in open_.items()}
        n = min(full, key=lambda n: (open_[n][0] * 10**6 // open_[n][1], n))
        given[n] = full[n]
        budget -= full[n]
        del open_[n]
    return given


def plain_budgets(rows, percent, epochs):
    """Tokens and budget of each leaf of rows (doc_id, text, lang, source, ...)."""
    domain = lambda s: "" if not s else {**dict.fromkeys("01234", "web"), **dict.fromkeys("567", "books")}.get(s[-1], "code")
    leaf = lambda r: (domain(r[3]), r[2] or "", r[3] or "")
    tokens = Counter()
    for r in rows:
        tokens[leaf(r)] += len((r[1] or "").encode().split())
    cap = {k: v * epochs for k, v in tokens.items()}
    of = lambda keys: sum(v for k, v in cap.items() if k[: len(keys)] == keys)
    top = plain_share(sum(tokens.values()) * percent // 100, {d: (of((d,)), mixing.DOMAIN_WEIGHTS.get(d, 1)) for d in {k[0] for k in cap}})
    out = {}
    for d, budget in top.items():
        middle = plain_share(budget, {lang: (of((d, lang)), mixing.LANGUAGE_WEIGHTS.get(lang, 1)) for lang in {k[1] for k in cap if k[0] == d}})
        for lang, b in middle.items():
            for s, g in plain_share(b, {k[2]: (cap[k], 1) for k in cap if k[:2] == (d, lang)}).items():
                out[d, lang, s] = g
    return leaf, tokens, out


def plain_take(rows, percent):
    """Rows of one seeded epoch that fit their leaf's budget."""
    leaf, tokens, budget = plain_budgets(rows, percent, 1)
    out = []
    for k, b in budget.items():
        whole = int(tokens[k] == 0 or b // tokens[k])
        size = lambda r: len((r[1] or "").encode().split())
        mine = sorted((r for r in rows if leaf(r) == k), key=lambda r: (hashlib.md5(f"42-{whole}-{'' if r[0] is None else r[0]}".encode()).hexdigest(), size(r)))
        so_far = 0
        for r in mine:
            so_far += size(r)
            if whole or so_far <= b:
                out.append(r)
    return out


def test_pipeline_like_plain_stages(spark):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    from docspark.llm.common import _written

    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    before = len(rows)
    rows = [r for r, q in zip(rows, plain_quality(rows), strict=True) if q[0]]
    rows = plain_keep_one(rows)
    rows = plain_phrases(rows)
    rows = plain_take(rows, corpus_pipeline.MIX_PERCENT)
    assert 0 < len(rows) < before
    tokens = packing.Tokens(packing.vocabulary())
    want = Counter()
    for r in rows:
        ids = np.append(np.frombuffer(tokens.direct(r[1] or ""), "<u4"), np.uint32(1))
        for k in range(0, len(ids), 4096):
            want[r[0], k // 4096, zlib.crc32(ids[k : k + 4096].astype("<u4").tobytes())] += 1
    held = len(_written)
    packed = corpus_pipeline.run(spark, sf)
    found = packed.collect()
    assert Counter((r["doc_id"], r["piece"], r["ids_crc32"]) for r in found) == want
    assert len(_written) == held + 1  # the result alone
    places = {}
    for r in found:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 4096


@pytest.mark.parametrize("percent,epochs", [(60, 2), (30, 1), (150, 2), (100, 1)])
def test_mixing(docs, none, percent, epochs):
    rows = docs.collect()
    leaf, tokens, want = plain_budgets(rows, percent, epochs)
    got = mixing.mix(docs, share_percent=percent, max_epochs=epochs).collect()
    assert len(got) == len(rows)
    assert {(r["domain"], r["lang"], r["source"]): r["leaf_budget"] for r in got} == want
    for k, budget in want.items():
        mine = sorted((r for r in got if (r["domain"], r["lang"], r["source"]) == k), key=lambda r: (r["order_key"], r["n_tokens"]))
        if tokens[k]:
            whole, rest = divmod(budget, tokens[k])
            so_far = 0
            for r in mine:
                so_far += r["n_tokens"]
                assert r["epochs"] == whole and r["copies"] == whole + (whole < epochs and so_far <= rest)
                assert r["order_key"] == hashlib.md5(f"42-{whole}-{'' if r['doc_id'] is None else r['doc_id']}".encode()).hexdigest()
    if epochs == 1:
        taken = mixing.take(docs, share_percent=percent)
        assert taken.columns == docs.columns
        assert Counter(r["doc_id"] for r in taken.collect()) == Counter(r["doc_id"] for r in got if r["copies"])
        wide = mixing.take(clashing(docs), share_percent=percent)
        assert wide.columns == clashing(docs).columns
        same(wide.select(*docs.columns), taken)
    assert mixing.mix(none).count() == 0 and mixing.take(none).count() == 0


def test_sql_agrees(spark, docs):
    import duckdb

    con = duckdb.connect()
    r = random.Random(9)
    texts = [(i, f"{' '.join(r.choice(WORDS) for _ in range(r.randrange(30)))} {text} {' '.join(r.choice(WORDS) for _ in range(r.randrange(30)))}") for i, text in enumerate(list(licenses.TEMPLATES.values()) * 3)]
    licensed = spark.createDataFrame(texts + [(900, None), (901, "")], "doc_id long, text string")
    for frame, run, sql in ((licensed, licenses.scan, licenses.op2_sql()), (docs.select("doc_id", "text"), phrases.phrase_counts, phrases.OP3_SQL)):
        con.register("documents", frame.toPandas().astype({"doc_id": "Int64"}))
        want = con.execute(sql).fetchall()
        assert Counter(map(str, map(tuple, run(frame).collect()))) == Counter(map(str, want)) and len(want) > 20
