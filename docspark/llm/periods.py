"""Runs of words that repeat with a period, by Karp-Miller-Rosenberg naming.

Names of level k are equal for two places of a document if and only if the 2**k words from
there on are equal: level 0 numbers a document's words, each further level numbers pairs of
names of the level below. Only names that occur twice are numbered again, so natural prose
needs few levels and periodic texts log2 of their length. The longest common extension of
two places, forwards or backwards, steps through the levels from the highest down.

A run with period q and 4q words or more covers the places g, g+q, g+2q of the grid 0, q, 2q,
... with equal blocks of 2**k <= q words at each. Such grid places are the candidates; of
neighbouring ones the first is extended both ways. No hash stands for a block and no suffix
is sorted. Once no block of 2**k words occurs twice, no run has a period of 2**k or more and
the search ends. Texts of one task are searched together in groups of about 2,000,000
characters, longest first, so that large periods meet only texts that can hold them.

A text is one row's work: its words and log2(words) arrays of whole numbers must fit in a
task (5 MB of text: about 100 MB). Null and empty texts have no words and no runs. Each input
row is judged by itself, repeated rows and null ids included; an empty table gives no rows.
Columns other than doc_id and text, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SQL_NUMBERS, sql_crc32, table, text_groups

LEAST, TIMES = 6, 4  # a run has at least LEAST words and TIMES periods
FOUND = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def naming(texts: list[list[bytes]]) -> tuple[list[np.ndarray], np.ndarray]:
    """Names by level over all texts in turn, each followed by one place that equals no other, and where each text begins.

    Equal names occur only within one text. A name that occurs once is negative.
    """
    at = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=at[1:])
    single = -1 - np.arange(at[-1], dtype=np.int64)
    names, used = single.copy(), 0
    for start, words in zip(at.tolist(), texts, strict=False):
        number: dict[bytes, int] = {}
        names[start : start + len(words)] = [number.setdefault(w, len(number) + used) for w in words]
        used += len(number)
    levels, step = [], 1
    inside = np.flatnonzero(names >= 0)
    once = np.bincount(names[inside], minlength=1)[names[inside]] == 1
    names[inside[once]] = single[inside[once]]
    while (names >= 0).any():
        levels.append(names.astype(np.int32) if len(names) < 1 << 31 else names)
        places = np.flatnonzero((names[:-step] >= 0) & (names[step:] >= 0)) if step < len(names) else np.empty(0, np.int64)
        _, own, count = np.unique(names[places] * len(names) + names[places + step], return_inverse=True, return_counts=True)
        again = count[own] > 1
        names = single.copy()
        names[places[again]] = own[again]
        step *= 2
    return levels, at


def common(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray, back: bool = False) -> np.ndarray:
    """Number of equal words from places a and b on, or before them."""
    n, total = len(levels[0]), np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        size = 1 << k  # fits once at most: no two blocks above the highest level are equal
        x, y = (a - total - size, b - total - size) if back else (a + total, b + total)
        inside = (x >= 0) & (y >= 0) if back else (x < n) & (y < n)
        same = np.zeros(len(a), bool)
        same[inside] = levels[k][x[inside]] == levels[k][y[inside]]
        total += same * size
    return total


def candidates(levels: list[np.ndarray], at: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    """(grid places, period): the first place of the grid in each stretch that may be a run, by ascending period."""
    sizes = np.diff(at) - 1
    for q in range(1, int(sizes[0]) // TIMES + 1 if len(sizes) else 0):
        k = q.bit_length() - 1
        if k >= len(levels):
            break
        end = int(at[np.searchsorted(-sizes, -max(TIMES * q, LEAST), side="right")])
        if end <= 2 * q:
            continue
        names, size = levels[k][:end], 1 << k
        grid = np.flatnonzero(names[: end - 2 * q : q] == names[q : end - q : q]) * q
        grid = grid[names[grid + 2 * q] == names[grid]]
        before = grid >= q  # the period before may belong to the same run, and is then the candidate
        before[before] = (names[grid[before] - q] == names[grid[before]]) & (names[grid[before] - size] == names[grid[before] + q - size])
        if not before.all():
            yield grid[~before], q


def extended(levels: list[np.ndarray], held: list[tuple[np.ndarray, int]]) -> np.ndarray:
    """The runs (start, length, period) around candidates, over all texts in turn."""
    grid, q = np.concatenate([g for g, _ in held]), np.concatenate([np.full(len(g), q) for g, q in held])
    start = grid - common(levels, grid, grid + q, back=True)
    length = grid + q + common(levels, grid, grid + q) - start
    return np.stack([start, length, q], axis=1)[length >= np.maximum(LEAST, TIMES * q)]


def runs(texts: list[list[bytes]]) -> list[np.ndarray]:
    """For each text its runs as rows (start, length, period), by start, then period."""
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    levels, at = naming([texts[i] for i in order])
    found, held, total = [np.empty((0, 3), np.int64)], [], 0
    for places, q in candidates(levels, at):
        held.append((places, q))
        total += len(places)
        if total >= 1 << 16:
            found.append(extended(levels, held))
            held, total = [], 0
    if held:
        found.append(extended(levels, held))
    every = np.concatenate(found)
    _, first = np.unique(every[:, :2], axis=0, return_index=True)  # equal stretches: the smallest period comes first
    every = every[np.sort(first)]
    every = every[np.lexsort((every[:, 2], every[:, 0]))]
    text = np.searchsorted(at, every[:, 0], side="right") - 1
    every[:, 0] -= at[text]
    cuts = np.searchsorted(text, np.arange(len(texts) + 1))
    out: list[np.ndarray] = [every[:0]] * len(texts)
    for i, own in enumerate(order):
        out[own] = every[cuts[i] : cuts[i + 1]]
    return out


def kept(n: int, own: np.ndarray) -> np.ndarray:
    """Which of n words stay: not those that a run holds after its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, own[:, 0] + own[:, 2], 1)
    np.add.at(change, own[:, 0] + own[:, 1], -1)
    return np.cumsum(change[:n]) == 0


def _search(batches):
    triple = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    for ids, texts in text_groups(batches, ["doc_id", "text"]):
        words = [(t or "").encode().split() for t in texts]  # splits at the white space of the contract
        found = runs(words)
        texts = [b" ".join(w if not len(r) else compress(w, kept(len(w), r).tolist())) for w, r in zip(words, found, strict=True)]
        flat = np.concatenate(found) if found else np.empty((0, 3), np.int64)
        lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, found)]), pa.int32()), pa.StructArray.from_arrays([pa.array(flat[:, c]) for c in range(3)], fields=list(triple)))
        yield pa.record_batch([pa.array(ids, pa.int64()), pa.array([len(w) for w in words], pa.int64()), lists, pa.array(texts, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, runs (by start, then period), collapsed (each run's first period and all words outside runs) for docs (doc_id, text)."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(_search, FOUND)


def planted(docs: DataFrame) -> DataFrame:
    """docs with a period in the texts of the ids whose CRC-32 is divisible by ten, as op12's contract says. A null id has no such number and its text stays."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.crc32(F.col("doc_id").cast("long").cast("string")).alias("h"))
    own = own.withColumn("words", F.expr(r"CASE WHEN h % 10 = 0 THEN regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0) END"))
    own = own.select("doc_id", "text", "words", F.expr("h div 10").alias("g"), F.expr("nullif(size(words), 0)").alias("n"))
    own = own.select("*", F.expr("CAST(g % n AS INT)").alias("a"))
    own = own.select("*", F.expr("CAST(1 + (n - a) div (3 + g % 8) AS INT)").alias("p"))
    periodic = "concat_ws(' ', slice(words, 1, a), slice(flatten(array_repeat(slice(words, a + 1, p), CAST((n - a) div p AS INT) + 1)), 1, n - a))"
    return own.select("doc_id", F.expr(f"CASE WHEN n > 0 THEN {periodic} ELSE text END").alias("text"))


def op12_periodic_runs(spark, sf_dir: str) -> DataFrame:
    found = periodic_runs(planted(table(spark, sf_dir, "documents")))
    best = F.expr("array_max(transform(runs, r -> struct(r.length AS length, -r.start AS start, -r.period AS period)))")
    lines = F.expr(r"array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    out = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    longest = [(-F.col("best.start")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"), F.expr("1000 * best.length div -best.period").alias("exponent_milli")]
    return out.select("doc_id", "n_runs", *longest, "runs_sha256", "collapsed_sha256")


#: Equal words q apart, by document and q, gathered into stretches.
OP12_SQL = rf"""
WITH {SQL_NUMBERS},
raw AS (SELECT row_number() OVER () AS rid, doc_id, CAST(doc_id AS VARCHAR) AS name, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
hashed AS (SELECT rid, doc_id, w, CAST(len(w) AS BIGINT) AS n, {sql_crc32("name")} AS h FROM raw, numbers),
cuts AS (SELECT *, CASE WHEN n > 0 AND h % 10 = 0 THEN (h // 10) % n END AS a, (h // 10) % 8 AS k FROM hashed),
built AS (
  SELECT rid, doc_id, n, CASE WHEN a IS NULL THEN w ELSE list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + k)) END]) END AS w
  FROM cuts),
word AS (SELECT rid, n, unnest(range(n)) AS i, unnest(w) AS w FROM built),
pair AS (SELECT x.rid, y.i - x.i AS q, x.i FROM word x JOIN word y ON x.rid = y.rid AND x.w = y.w AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
stretch AS (
  SELECT rid, q, min(i) AS start, count(*) + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS island FROM pair)
  GROUP BY rid, q, island HAVING count(*) + q >= greatest(6, 4 * q)),
run AS (SELECT rid, start, length, min(q) AS period FROM stretch GROUP BY rid, start, length),
lines AS (
  SELECT rid, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS text,
    first(struct_pack(s := start, l := length, p := period) ORDER BY length DESC, start, period) AS best
  FROM run GROUP BY rid),
gone AS (SELECT DISTINCT rid, unnest(range(start + period, start + length)) AS i FROM run),
stay AS (SELECT w.rid, string_agg(w.w, ' ' ORDER BY w.i) AS text FROM word w ANTI JOIN gone g ON g.rid = w.rid AND g.i = w.i GROUP BY w.rid)
SELECT b.doc_id, coalesce(l.n_runs, 0) AS n_runs, l.best.s AS start, l.best.l AS length, l.best.p AS period, 1000 * l.best.l // l.best.p AS exponent_milli,
  sha256(coalesce(l.text, '')) AS runs_sha256, sha256(coalesce(s.text, '')) AS collapsed_sha256
FROM built b LEFT JOIN lines l USING (rid) LEFT JOIN stay s USING (rid)
"""
