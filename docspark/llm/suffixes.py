"""Suffix-array dedup of 100-byte strings by two-stage suffix sorting.

A byte of a text (UTF-8) is removed if a 100-byte string over it also starts earlier: in a
document with a smaller id, or earlier in the same document; strings are judged on the input.
repeats.py brings together the segments of all documents that can hold a repeated string.
Within a task, equal segments collapse to their first; of anchor values that keep several
different segments, the segments are laid end to end and their suffixes are sorted in two
stages: suffixes smaller than their successor are sorted directly, the others are placed by
scanning the buckets of first bytes in order. Adjacent common prefixes of 100 or more then
group the places of equal strings, and all but the earliest of a group repeat.

(An anchor value with one different segment has no further repeat: a string has one place
relative to its anchor, so two places of one segment never hold the same string.)

Null texts are empty; matches never cross documents. Rows with a null id count as later than
all others; rows that share an id are ordered by the hash of their text, and rows equal in
both are one. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table
from .repeats import HOT, Kind, covered, with_places

WINDOW, GRAM = 100, 32
UNITS = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)


def _byte_values():
    def values(texts):
        data = [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
        lengths = np.fromiter(map(len, data), np.int64, len(data))
        return UNITS[np.frombuffer(b"".join(data), np.uint8)], lengths, lambda t, a, b: data[t][a:b]

    return values


def _words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one big-endian number."""
    out = np.zeros(len(data), np.uint64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    for k in range(8):
        out = (out << np.uint64(8)) | padded[k : k + len(data)]
    return out


def _sort_directly(data: np.ndarray, eight: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Positions in the order of their first `depth` bytes, eight (_words_at) at a time, ties alone going on."""
    if not len(at):
        return at
    at = at[np.argsort(eight[at], kind="stable")]
    key, own, tied = eight[at], np.zeros(len(at), np.int32), np.arange(len(at), dtype=np.int32)
    for k in range(8, depth + 8, 8):
        own = np.cumsum(np.concatenate([[True], (own[1:] != own[:-1]) | (key[1:] != key[:-1])]), dtype=np.int32)
        again = np.bincount(own)[own] > 1
        tied, own = tied[again], own[again]
        if k >= depth or not len(tied):
            break
        where = at[tied] + k
        key = np.where(where < len(data), eight[np.minimum(where, len(data) - 1)], np.uint64(0))
        order = np.lexsort((key, own))
        at[tied] = at[tied][order]
        key = key[order]
    return at


def suffix_order(data: np.ndarray, depth: int, eight: np.ndarray | None = None) -> np.ndarray:
    """Suffixes of data (bytes above 0, strings ended by 0) in the order of their first `depth` bytes, 0 ending a string.

    Two stages. Ties beyond `depth` bytes or beyond a string's end are in any order.
    """
    n = len(data)
    ahead = np.empty(n, np.int16)
    ahead[:-1] = data[1:]
    ahead[-1:] = -1
    change = np.flatnonzero(data != ahead).astype(np.int32)  # the last of each run of equal bytes
    smaller = np.repeat(data[change] < ahead[change], np.diff(change, prepend=np.int32(-1)))  # than the successor
    del ahead, change
    direct = _sort_directly(data, _words_at(data) if eight is None else eight, np.flatnonzero(smaller & (data > 0)).astype(np.int32), depth)
    sizes = np.bincount(data, minlength=257)
    direct_at = np.concatenate([[0], np.cumsum(np.bincount(data[direct], minlength=257))])
    waiting: list[list[np.ndarray]] = [[] for _ in range(257)]
    out = []
    for c in range(256):
        if not sizes[c]:
            continue
        if c == 0:
            parts = [np.flatnonzero(data == 0).astype(np.int32)]
        else:
            parts = waiting[c]
            waiting[c] = []
            new = np.concatenate(parts) if parts else np.empty(0, np.int32)
            while len(new):  # runs of c
                new = new[new > 0] - 1
                new = new[(data[new] == c) & ~smaller[new]]
                if len(new):
                    parts.append(new)
            parts.append(direct[direct_at[c] : direct_at[c + 1]])
        bucket = np.concatenate(parts)
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        first = data[before]
        before, first = before[first > c], first[first > c]
        order = np.argsort(first, kind="stable")
        first = first[order]
        edges = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]])) if len(first) else []
        for part, d in zip(np.split(before[order], edges[1:]) if len(first) else [], first[edges] if len(first) else [], strict=True):
            waiting[d].append(part)
    return np.concatenate(out) if out else np.empty(0, np.int32)


def equal_groups(eight: np.ndarray, order: np.ndarray, usable: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Usable suffixes in order and their group numbers; suffixes with a common prefix of `depth` bytes share one. eight: _words_at."""
    order = order[usable[order]]
    same = np.ones(max(len(order) - 1, 0), bool)
    a, b = order[:-1], order[1:]
    for k in [*range(0, depth - 7, 8), depth - 8]:
        live = np.flatnonzero(same)
        same[live] = eight[a[live] + k] == eight[b[live] + k]
    return order, np.cumsum(np.concatenate([[0], ~same]), dtype=np.int32) if len(order) else np.empty(0, np.int64)


def locate(rows) -> list[tuple[int, int, int]]:
    """(row, first window, windows) of windows that start earlier elsewhere. rows: hash, doc, row, starts (one), windows, segment, by hash, doc, row and start."""
    out, first, several = [], {}, {}
    for k, r in enumerate(rows):
        seen = first.setdefault((r[0], r[5]), k)
        if seen == k:
            several.setdefault(r[0], []).append(k)
        elif rows[seen][1:4] != r[1:4]:
            out.append((k, 0, r[4]))
    kept = [k for ks in several.values() if len(ks) > 1 for k in ks]
    if not kept:
        return out
    data = np.frombuffer(b"".join(rows[k][5] + b"\xff" for k in kept), np.uint8) + np.uint8(1)  # UTF-8 has no 255
    lengths = np.array([len(rows[k][5]) + 1 for k in kept], np.int32)
    starts = np.cumsum(lengths, dtype=np.int32) - lengths
    windows = np.array([rows[k][4] for k in kept], np.int32)
    text = np.repeat(np.arange(len(kept), dtype=np.int32), lengths)
    usable = np.arange(len(data), dtype=np.int32) - starts[text] < windows[text]
    eight = _words_at(data)
    order, group = equal_groups(eight, suffix_order(data, WINDOW, eight), usable, WINDOW)
    del eight, usable
    # kept is in the order of documents and starts within an anchor value, and equal strings share the value
    by_place = np.lexsort((order, group))
    order, group = order[by_place], group[by_place]
    later = np.concatenate([[False], group[1:] == group[:-1]])
    places = np.sort(order[later])
    if len(places):
        edge = np.flatnonzero(np.concatenate([[True], (np.diff(places) > 1) | (np.diff(text[places]) > 0)]))
        for a, b in zip(edge, [*edge[1:], len(places)], strict=True):
            t = text[places[a]]
            out.append((kept[t], int(places[a] - starts[t]), int(b - a)))
    return out


BYTES = Kind(WINDOW, GRAM, True, _byte_values, locate, 4_000_000)


def cut_bytes(text: str | None, places) -> tuple[bytes, int, int, int]:
    """Remaining bytes, bytes before, bytes removed, maximal removed runs."""
    data = text.encode("utf-8", "surrogatepass") if text else b""
    if not places:
        return data, len(data), 0, 0
    gone = covered(places, WINDOW, len(data))
    runs = int(gone[0]) + int(np.count_nonzero(gone[1:] & ~gone[:-1]))
    return np.frombuffer(data, np.uint8)[~gone].tobytes(), len(data), int(np.count_nonzero(gone)), runs


def _digest(batches):
    for batch in batches:
        rows = []
        for doc_id, text, places in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
            kept, n, removed, runs = cut_bytes(text.as_py(), places)
            rows.append((doc_id, n, removed, runs, hashlib.sha256(kept).hexdigest()))
        if rows:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def byte_counts(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256: one row per row of docs (doc_id, text)."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return with_places(own, BYTES, hot)[0].mapInArrow(_digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op8_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return byte_counts(table(spark, sf_dir, "documents"))


#: Windows as 200 hexadecimal digits, named by their MD5; 4 to 23 seconds at sf0.01.
OP8_SQL = """
WITH docs AS (
  SELECT row_number() OVER () AS r, CAST(doc_id AS BIGINT) AS doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents
), windows AS (
  SELECT r, coalesce(doc_id, 9223372036854775807)::HUGEINT * 4294967296 + p AS place, p, md5_number(substr(x, 2 * p + 1, 200)) AS k
  FROM (SELECT *, unnest(range(len(x) // 2 - 99)) AS p FROM docs WHERE len(x) >= 200)
), later AS (
  SELECT r, p FROM (SELECT r, p, place, min(place) OVER (PARTITION BY k) AS first FROM windows) WHERE first < place
), spans AS (
  SELECT r, min(p) AS a, max(p) + 100 AS b
  FROM (SELECT r, p, sum(CASE WHEN p > before + 100 THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY p) AS island
        FROM (SELECT r, p, lag(p, 1, p) OVER (PARTITION BY r ORDER BY p) AS before FROM later))
  GROUP BY r, island
), pieces AS (
  SELECT d.r, s.a AS place, substr(x, 2 * coalesce(lag(s.b) OVER w, 0) + 1, 2 * (s.a - coalesce(lag(s.b) OVER w, 0))) AS part FROM spans s JOIN docs d ON d.r = s.r WINDOW w AS (PARTITION BY d.r ORDER BY s.a)
  UNION ALL SELECT d.r, len(x), substr(x, 2 * m.b + 1) FROM docs d JOIN (SELECT r, max(b) AS b FROM spans GROUP BY r) m ON m.r = d.r
), kept AS (
  SELECT r, string_agg(part, '' ORDER BY place) AS x FROM pieces GROUP BY r
), gone AS (
  SELECT r, sum(b - a) AS n, count(*) AS spans FROM spans GROUP BY r
)
SELECT d.doc_id, len(d.x) // 2 AS n_bytes, CAST(coalesce(g.n, 0) AS BIGINT) AS n_removed, coalesce(g.spans, 0) AS n_spans, sha256(unhex(coalesce(k.x, d.x))) AS kept_sha256
FROM docs d LEFT JOIN gone g ON g.r = d.r LEFT JOIN kept k ON k.r = d.r
"""
