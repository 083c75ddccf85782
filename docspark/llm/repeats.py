"""Shared plan for finding every repeated window of fixed length in a corpus.

A window is `size` consecutive units (words or bytes) of one document. Each window is filed
under the smallest hash of its runs of `gram` units, its anchor; neighbouring windows mostly
share one, and equal windows always have equal anchors. So only anchors are compared first:

1. every text is cut into anchors; an anchor value met twice can hold repeated windows;
2. texts that have such values are read again: the windows of one anchor form a segment
   (their text is cut out), and segments of one anchor value meet in one task, sorted, where
   `locate` finds the windows that occur earlier;
3. the places found are joined with the texts, which are cut in one pass.

Hot values: a task first compares what it has read itself. Anchor values it has met twice are
known to recur, so only one row for each goes to the common exchange, the others are dealt
out evenly; of equal segments only the first goes on, the places of the others are already
known. A common passage so costs a row per task and anchor, not one per document.
Short phrases that very many documents share in different surroundings would still gather
segments of different text under one anchor. Anchors met in more than `hot` documents
therefore file each window on its own, under the hash of the whole window: then only equal
windows meet, and no task gets more than `hot` different segments of one anchor.

Step results are written to the shared folder, so a lost executor costs one step at most.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, drop, fresh, release, rolling, text_groups

HELD = 600_000  # anchors a task compares at a time
ROW_BYTES = 400  # what a held row takes beside its text
SEGMENT_BYTES = 48_000_000  # segments a task compares at a time
OUT_ROWS = 20_000
HOT = 20_000  # documents of an anchor that one task takes
NULL_DOC = 1 << 62  # documents without an id have keys from here on; all of them count as one, the last


def document():
    """The id as a long below NULL_DOC. Null ids get a key for each text, so that no key gathers them all."""
    own = F.xxhash64(F.col("text").cast("string")).bitwiseAND(F.lit((1 << 61) - 1)) + F.lit(NULL_DOC)
    return F.coalesce(F.col("doc_id").cast("long"), own)


@dataclass(frozen=True)
class Kind:
    """What a unit is. values: texts -> (64-bit value per unit, units per text, text cutter)."""

    size: int
    gram: int
    within: bool  # earlier starts of the same document count too
    values: Callable
    locate: Callable  # sorted segment rows of whole anchor values -> (row numbers, first window, windows)
    shard: int  # bytes of segment rows located at a time


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    step = 1
    while 2 * step <= width:
        x = np.minimum(x[:-step], x[step:])
        step *= 2
    rest = width - step
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def anchors(values: np.ndarray, lengths: np.ndarray, size: int, gram: int):
    """Anchor value, text number, first window (in its text) and number of windows, in text order."""
    ends = np.cumsum(lengths)
    starts = ends - lengths
    none = np.empty(0, np.int64)
    if len(values) < size:
        return np.empty(0, np.uint64), none, none, none
    hashes = rolling(values, gram)
    with np.errstate(over="ignore"):
        keys = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
    at = (sliding_min(keys, size - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    inside = np.zeros(len(values) + 1, np.int8)
    whole = lengths >= size
    np.add.at(inside, starts[whole], 1)
    np.add.at(inside, ends[whole] - size + 1, -1)
    window = np.flatnonzero(np.cumsum(inside[: len(at)], dtype=np.int8))
    if not len(window):
        return np.empty(0, np.uint64), none, none, none
    mine = at[window]
    first = np.flatnonzero(np.concatenate([[True], mine[1:] != mine[:-1]]))
    number = np.diff(np.concatenate([first, [len(window)]]))
    text = np.searchsorted(ends, window[first], side="right")
    return hashes[mine[first]], text, window[first] - starts[text], number


def _seen(kind: Kind):
    """hash, doc, flag (0 the task's only sighting, 1 its first of several, 2 a further one) and n: documents of the hash, with the first."""

    def rows(held) -> Iterator[pa.RecordBatch]:
        value, doc = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((doc, value))
        value, doc = value[order], doc[order]
        new = np.concatenate([[True], value[1:] != value[:-1]])
        other = np.concatenate([[True], (doc[1:] != doc[:-1]) | new[1:]])
        group = np.cumsum(new) - 1
        several = np.bincount(group, other.astype(np.int64)) > 1  # rows without an id count as several documents here, which only adds candidates
        if kind.within:
            several |= np.bincount(group) > 1
        flag = np.where(new, several[group].astype(np.int8), np.int8(2))
        n = np.where(new, np.bincount(group, other.astype(np.int64)).astype(np.int64)[group], 0)
        value, doc, flag, n = value[other].view(np.int64), doc[other], flag[other], n[other]
        for k in range(0, len(value), 100_000):
            yield pa.record_batch([pa.array(x[k : k + 100_000]) for x in (value, doc, flag, n)], names=["hash", "doc", "flag", "n"])

    def run(batches):
        held, n = [], 0
        values = kind.values()
        for docs, texts in text_groups(batches, ["doc", "text"]):
            units, lengths, _ = values(texts)
            value, text, _, _ = anchors(units, lengths, kind.size, kind.gram)
            if len(value):
                held.append((value, np.asarray(docs, np.int64)[text]))
                n += len(value)
            if n >= HELD:
                yield from rows(held)
                held, n = [], 0
        if held:
            yield from rows(held)

    return run


def _recurring(batches):
    """hash, doc, n of rows sorted by hash whose hash is met again or flagged. One row of each has n, the number of its documents.

    Further sightings go on at once. Of the others the last hash of a batch waits for the
    next one; if it has several rows, all but one go on.
    """
    keep = None
    for batch in batches:
        rows = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
        further = rows[2] == 2
        if further.any():
            yield _pairs(rows[0][further], rows[1][further], rows[3][further])
            rows = [x[~further] for x in rows]
        if keep is not None:
            rows = [np.concatenate(x) for x in zip(keep, rows, strict=True)]
        value, doc, flag, n = rows
        if not len(value):
            continue
        edge = int(np.searchsorted(value, value[-1]))  # rows of the last hash
        yield from _hits(*(x[:edge] for x in rows))
        keep = [x[edge : edge + 1] for x in rows]
        if len(value) - edge > 1:
            yield _pairs(value[edge + 1 :], doc[edge + 1 :], np.zeros(len(value) - edge - 1, np.int64))
            keep[2:] = np.ones(1, flag.dtype), np.array([n[edge:].sum()], np.int64)
    if keep is not None:
        yield from _hits(*keep)


def _hits(value, doc, flag, n):
    if not len(value):
        return
    new = np.concatenate([[True], value[1:] != value[:-1]])
    group = np.cumsum(new) - 1
    again = (np.bincount(group) > 1) | (np.bincount(group, flag.astype(np.int64)) > 0)
    hit = again[group]
    if hit.any():
        total = np.bincount(group, n).astype(np.int64)
        yield _pairs(value[hit], doc[hit], np.where(new, total[group], 0)[hit])


def _pairs(value, doc, n):
    return pa.record_batch([pa.array(value), pa.array(doc), pa.array(n.astype(np.int64))], names=["hash", "doc", "n"])


SEGMENT = "hash long, doc long, row long, starts array<long>, windows int, segment binary"


def _segments(kind: Kind):
    """Segments of recurring anchors, one row for all places of one in a document.

    Of equal segments in this task's hands only the first document's goes on with its text;
    the places of the others are already known to repeat and go on without one.
    """

    def rows(held: list) -> Iterator[pa.RecordBatch]:
        held.sort(key=lambda r: r[1:4])
        first: dict = {}
        known: dict = {}
        out = []
        for value, doc, row, start, windows, segment in held:
            seen = first.get((value, segment))
            if seen is None:
                first[value, segment] = new = (value, doc, row, [start], windows, segment)
                out.append(new)
            elif kind.within or min(seen[1], NULL_DOC) != min(doc, NULL_DOC):
                if seen[1:3] != (doc, row) or seen[3][0] != start:
                    known.setdefault((doc, row, windows), []).append(start)
            elif seen[1:3] == (doc, row):
                seen[3].append(start)
            else:
                out.append((value, doc, row, [start], windows, segment))
        out += [(0, doc, row, starts, windows, None) for (doc, row, windows), starts in known.items()]
        for k in range(0, len(out), OUT_ROWS):
            columns = list(zip(*out[k : k + OUT_ROWS], strict=True))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.binary())
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["hash", "doc", "row", "starts", "windows", "segment"])

    def run(batches):
        held, n = [], 0
        values = kind.values()
        for docs, texts, row, known, hot in text_groups(batches, ["doc", "text", "row", "known", "hot"]):
            units, lengths, cutter = values(texts)
            value, text, first, number = anchors(units, lengths, kind.size, kind.gram)
            if not len(value):
                continue
            recur = np.unique(np.concatenate([np.asarray(k, np.int64) for k in known if k]))
            signed = value.view(np.int64)
            at = np.minimum(np.searchsorted(recur, signed), len(recur) - 1)
            hit = recur[at] == signed
            alone = set().union(*filter(None, hot))
            for h, t, a, w in zip(signed[hit].tolist(), text[hit].tolist(), first[hit].tolist(), number[hit].tolist(), strict=True):
                if h in alone:
                    for i in range(a, a + w):
                        segment = cutter(t, i, i + kind.size)
                        held.append((xxhash.xxh3_64_intdigest(segment) - (1 << 63), docs[t], row[t], i, 1, segment))
                        n += len(segment) + ROW_BYTES
                    continue
                segment = cutter(t, a, a + w + kind.size - 1)
                held.append((h, docs[t], row[t], a, w, segment))
                n += len(segment) + ROW_BYTES
            if n >= SEGMENT_BYTES:
                yield from rows(held)
                held, n = [], 0
        if held:
            yield from rows(held)

    return run


def _known(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Places of rows whose windows are known to repeat, one row a start."""
    starts = batch.column(3)
    of = pc.list_parent_indices(starts)
    windows = batch.column(4).cast(pa.int64())
    return pa.record_batch([batch.column(1).take(of), batch.column(2).take(of), pc.list_flatten(starts), windows.take(of)], names=PLACES)


PLACES = ["doc", "row", "start", "windows"]


def _located(kind: Kind):
    """doc, row, start, windows of repeated windows; rows come sorted by hash, doc, row, starts.

    Rows without a segment need no comparison and go on at once. The others are held until
    kind.shard bytes of whole anchor values are there.
    """

    def close(held):
        rows = [r for part in held for r in part]
        found = [(rows[i][1], rows[i][2], s + a, n) for i, a, n in kind.locate([(h, min(doc, NULL_DOC), *rest) for h, doc, *rest in rows]) for s in rows[i][3]]
        for k in range(0, len(found), OUT_ROWS):
            yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*found[k : k + OUT_ROWS], strict=True)], names=PLACES)

    def run(batches):
        held, n, last = [], 0, None
        for batch in batches:
            for k in range(0, batch.num_rows, 2_000):
                part = batch.slice(k, 2_000)
                known = pc.is_null(part.column(5))
                if part.column(5).null_count:
                    yield _known(part.filter(known))
                    part = part.filter(pc.invert(known))
                rows = list(zip(*(c.to_pylist() for c in part.columns), strict=True))
                while rows:
                    if n >= kind.shard:  # a shard ends where its last anchor value ends
                        edge = next((i for i, r in enumerate(rows) if r[0] != last), len(rows))
                        held.append(rows[:edge])
                        rows = rows[edge:]
                        if rows:
                            yield from close(held)
                            held, n = [], 0
                        continue
                    held.append(rows)
                    n += sum(len(r[5]) + ROW_BYTES for r in rows)
                    last, rows = rows[-1][0], []
        if held:
            yield from close(held)

    return run


def repeated(docs: DataFrame, kind: Kind, hot: int = HOT) -> DataFrame:
    """doc, row, places (array of start, windows): the windows of docs (doc_id, text) that occur earlier."""
    spark = docs.sparkSession
    own = docs.where("text IS NOT NULL").select(document().alias("doc"), F.col("text").cast("string").alias("text"))

    def spread(flag):
        return F.when(flag, F.xxhash64("doc", "hash")).otherwise(F.col("hash"))

    def recurring():
        seen = own.mapInArrow(_seen(kind), "hash long, doc long, flag byte, n long")
        met = seen.repartition(spread(F.col("flag") == 2)).sortWithinPartitions("hash")
        return cut(met.mapInArrow(_recurring, "hash long, doc long, n long"))

    known = recurring()
    release(spark)

    def places():
        widely = known.where(F.col("n") > hot).select("hash", F.col("hash").alias("hot")).distinct()
        marked = known.join(widely, "hash", "left") if widely.limit(1).count() else known.withColumn("hot", F.lit(None).cast("long"))
        by_doc = marked.groupBy("doc").agg(F.collect_list("hash").alias("known"), F.collect_set("hot").alias("hot"))  # at most the anchors of one text
        texts = own.select("doc", "text", F.xxhash64("text").alias("row")).join(by_doc, "doc")
        parts = texts.mapInArrow(_segments(kind), SEGMENT)
        met = parts.repartition(F.when(F.col("segment").isNull(), F.xxhash64("doc", "windows")).otherwise(F.col("hash"))).sortWithinPartitions("hash", "doc", "row", "starts")
        return cut(met.mapInArrow(_located(kind), "doc long, row long, start long, windows long"))

    found = places()
    drop(known)
    release(spark)
    return found.groupBy("doc", "row").agg(F.collect_list(F.struct("start", "windows")).alias("places"))


def covered(places, size: int, n: int) -> np.ndarray:
    """Which of a text's n units lie in a window of the places."""
    step = np.zeros(n + 1, np.int64)
    for p in places or ():
        step[p["start"]] += 1
        step[p["start"] + p["windows"] + size - 1] -= 1
    return np.cumsum(step[:-1]) > 0


def with_places(docs: DataFrame, kind: Kind, hot: int = HOT) -> tuple[DataFrame, str]:
    """docs with a column of their places, and its name. Rows of one id and text share them."""
    found = repeated(docs, kind, hot)
    doc, row, places = fresh(docs, "_doc", "_row", "_places")
    keyed = docs.withColumn(doc, document()).withColumn(row, F.xxhash64(F.col("text").cast("string")))
    return keyed.join(found.withColumnsRenamed({"doc": doc, "row": row, "places": places}), [doc, row], "left").drop(doc, row), places
