"""Top-k, chat formatting and the pipeline against plain versions."""

import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from docspark.llm import chat, topk

VECTORS = "vec_id long, embedding array<float>, label int"


def vectors(seed=1, n=240, dim=16):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, dim)) * r.uniform(0.1, 2, (n, 1))
    x[50:60] = x[50]
    rows = [(i, [float(v) for v in np.float32(row)], 0) for i, row in enumerate(x)]
    return rows + [(1000, None, 1), (1001, [None] * dim, 1), (1002, [float("nan")] * dim, 1), (1003, [float("inf")] * dim, 1), (None, rows[0][1], 1), rows[5], (1050, [], 1), (1100, rows[3][1][:4], 1)]


def plain_top(rows, k):
    v = {}
    for i, e, _ in rows:
        if i is not None and e is not None and all(x is not None and np.isfinite(x) for x in e):
            v[i] = [int(np.floor(256 * float(x))) for x in e]
    out = set()
    for q in v:
        if q % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(v[q], v[c], strict=False)), c) for c in v if c != q)[:k]
            out |= {(q, n + 1, c, -s) for n, (s, c) in enumerate(best)}
    return out


@pytest.mark.parametrize("options", [{}, {"block_rows": 40, "group_queries": 2, "sub_block": 8, "leading": 3}, {"k": 400}])
def test_top_k(spark, options):
    rows = vectors()
    got = topk.top_k(spark.createDataFrame(rows, VECTORS).repartition(3), F.expr("vec_id % 50 = 0"), **options)
    assert {tuple(r) for r in got.collect()} == plain_top(rows, options.get("k", 5))


def test_top_k_edges(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert topk.top_k(empty, F.expr("vec_id % 50 = 0")).count() == 0
    one = spark.createDataFrame([(0, [1.0], 0)], VECTORS)
    assert topk.top_k(one, F.expr("vec_id % 50 = 0")).count() == 0
    clash = spark.createDataFrame(vectors(), VECTORS).select("*", *[F.lit(1).alias(n) for n in ("v", "g", "block", "step", "side", "norm2", "rank")])
    assert {tuple(r) for r in topk.top_k(clash, F.expr("vec_id % 50 = 0")).collect()} == plain_top(vectors(), 5)


def test_bounds_spare_most_scores():
    """With lengths that spread, most pairs never get an exact score, and thresholds carried over spare more."""
    r = np.random.default_rng(4)
    v = np.floor(r.normal(size=(4_000, 32)) * r.pareto(2, size=(4_000, 1)) * 64)
    ids, q = np.arange(4_000), v[::50]
    length = np.sqrt(np.einsum("ij,ij->i", v, v))
    order = np.argsort(-length, kind="stable")
    rotation = np.linalg.svd(v[:500])[2].T
    rotated = v[order] @ rotation
    rest = np.sqrt(np.maximum((rotated[:, 12:] ** 2).sum(1), 0))
    block = lambda a, b: (ids[order[a:b]], v[order[a:b]], length[order[a:b]], rotated[a:b, :12], rest[a:b], rotation)
    every, alone, carried = [], [], []
    at, _, scores = topk.best_in_block(ids[::50], q, np.full(80, -np.inf), block(0, 4_000), 5, 64, every)
    exact = q @ v.T
    exact[np.arange(80), ids[::50]] = -np.inf
    assert all(sorted(scores[at == i]) == sorted(np.sort(exact[i])[-5:]) for i in range(80))
    assert sum(every) < 0.25 * exact.size
    at, _, scores = topk.best_in_block(ids[::50], q, np.full(80, -np.inf), block(0, 400), 5, 64)
    least = np.array([scores[at == i].min() for i in range(80)], np.float64)
    topk.best_in_block(ids[::50], q, np.full(80, -np.inf), block(400, 4_000), 5, 64, alone)
    topk.best_in_block(ids[::50], q, least, block(400, 4_000), 5, 64, carried)
    assert sum(carried) < 0.2 * sum(alone)


def shown(role, text):
    return f"<|{role or ''}|>\n{text or ''}<|end|>\n"


TURNS = "conv_id long, turn long, role string, text string"
TALKS = [
    (0, 0, "user", "hi"), (0, 1, "assistant", "yes"), (0, 2, "user", "more"), (1, 0, "user", "hi"), (1, 1, "assistant", "no"),
    (2, 0, "user", "same"), (3, 0, "user", "same"), (4, 0, "user", None), (6, 0, None, "x"), (7, 0, "user", "x"), (7, None, "user", "late"), (7, 5, "assistant", "a"), (None, 0, "user", "lost"), (0, 0, "user", "hi"), (9, 1, "user", "b"), (9, 1, "assistant", "a"), (8, 1, "assistant", "a"),
]


def test_chat(spark):
    got = {r["pair_id"]: r for r in chat.preference_pairs(spark.createDataFrame(TALKS, TURNS)).collect()}
    assert set(got) == {0, 1, 2, 3, 4}
    assert got[0]["prompt"] == shown("user", "hi") and got[0]["prompt_turns"] == 1
    assert got[0]["chosen"] == shown("assistant", "yes") + shown("user", "more") and got[0]["rejected"] == shown("assistant", "no")
    assert got[0]["chosen_mask"] == f"1:{len(shown('assistant', 'yes'))},0:{len(shown('user', 'more'))}"
    assert (got[1]["prompt"], got[1]["chosen"], got[1]["rejected"]) == (shown("user", "same"), "", "")
    assert got[2]["rejected"] is None and got[2]["prompt"] == ""
    assert got[3]["rejected"].endswith(shown("user", "late"))
    assert got[4]["rejected"] == shown("assistant", "a") + shown("user", "b")
    assert chat.preference_pairs(spark.createDataFrame([], TURNS)).count() == 0


def test_chat_like_sql(spark):
    r = random.Random(1)
    rows = TALKS + [(i, t, r.choice(["user", "assistant"]), r.choice("abc")) for i in range(20, 90) for t in range(r.randint(1, 4))]
    frame = spark.createDataFrame(rows, TURNS)
    con = duckdb.connect()
    con.register("conversations", frame.toPandas().astype({"conv_id": "Int64", "turn": "Int64"}))
    want = con.execute(chat.OP6_SQL).fetchall()
    got = chat.preference_pairs(frame).select("pair_id", "prompt", "prompt_turns", "chosen", "chosen_mask", "rejected", "rejected_mask").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_chat_clashing_and_long(spark):
    long = [(100, t, "user" if t % 2 == 0 else "assistant", "turn %d " % t * 400) for t in range(300)] + [(101, t, "user" if t % 2 == 0 else "assistant", "turn %d " % t * 400) for t in range(299)]
    frame = spark.createDataFrame(TALKS + long, TURNS)
    clash = frame.select("*", *[F.lit("x").alias(n) for n in ("pair_id", "side", "m", "body", "mask", "c", "r", "apart", "prompt")])
    got = {x["pair_id"]: x for x in chat.preference_pairs(clash).collect()}
    assert got == {x["pair_id"]: x for x in chat.preference_pairs(frame).collect()}
    assert got[50]["prompt_turns"] == 299 and got[50]["rejected"] == "" and got[50]["chosen"] == shown("assistant", "turn 299 " * 400)
