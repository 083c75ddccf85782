"""Best-fit packing by a plan over the histogram of lengths.

Each text is tokenized whole, ends with id END, and is cut into pieces only where it is
longer than a sequence. Counts of each piece length (at most CAPACITY of them, whatever the
data) go to the driver, which runs best-fit decreasing over counts: whole runs of equal bins
take a length at once. The plan is a list of slot ranges (length, first rank, number, first
sequence, offset). Pieces are ranked within their length and join their slots on (length,
rank). Ranks come from counts by (length, bucket) and a rank inside the bucket, so that a
length with a third of all pieces is not ranked by one task.

Null and empty texts have only the END id. Each input row is packed, repeated ids included
(their equal pieces are interchangeable). An empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from array import array

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, table

CAPACITY, END, VOCABULARY = 4096, 1, "word_bpe_49k.json"
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: The letters and numbers below U+0250, and the vocabulary's own rule for splitting a lower-cased text.
LETTERS, NUMBERS = "a-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾"
SPLIT = rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^\s{LETTERS}{NUMBERS}]+"

#: Tab to carriage return, and the visible characters below U+0250 whose lower-case form stays below it: the letters of SPLIT are then those of the vocabulary's rule.
PLAIN = "".join(map(re.escape, [*"\t\n\x0b\x0c\r", *(chr(p) for p in range(0x20, 0x250) if p != 0xAD and not 0x7F <= p < 0xA1 and max(map(ord, chr(p).lower())) < 0x250)]))
#: The vocabulary shows a byte that is no visible Latin-1 character as the next free character from U+0100 on.
BYTE_SIGNS = {b: 256 + i for i, b in enumerate(b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b))}


class Tokens(dict):
    """Part of a lower-cased Latin text -> its ids as little-endian unsigned 32-bit bytes.

    The vocabulary drops white space and splits before merging, so a text's ids are those of
    its parts in turn. Parts not met before go to the merge model alone. Texts with
    characters beyond PLAIN (other scripts, capitals whose small letter lies beyond, unusual
    white space) or the mark of a special token are encoded by the tokenizer as they stand.
    Memory is bounded by clearing.
    """

    def __init__(self, path: str, most: int = 700_000):
        super().__init__()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.most = most
        self.split, self.plain = re.compile(SPLIT).findall, re.compile(f"[{PLAIN}]*").fullmatch

    def direct(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def learn(self, parts: list[str]) -> None:
        merge = self.tokenizer.model.tokenize
        for part in parts:
            shown = part if part.isascii() else part.encode().decode("latin-1").translate(BYTE_SIGNS)
            self[part] = array("I", [x.id for x in merge(shown)]).tobytes()

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if "<|" in text or not self.plain(text):
            return self.direct(text)
        parts = self.split(text.lower())
        try:
            return b"".join(map(self.__getitem__, parts))
        except KeyError:
            every = set(parts)
            if len(self) + len(every) > self.most:
                self.clear()
            self.learn([p for p in every if p not in self])
            return b"".join(map(self.__getitem__, parts))


def _pieces(path: str, capacity: int):
    def run(batches):
        tokens, end = Tokens(path), array("I", [END]).tobytes()
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = tokens.encode(text.as_py()) + end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((doc_id, k, at // 4, len(part) // 4, zlib.crc32(part)))
            if rows:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, slots, first sequence, offset) of best-fit decreasing over counts."""
    open_: dict[int, list[tuple[int, int]]] = {}  # room left -> runs of sequences (first, number)
    rooms = sequences = 0  # rooms: bit r is set if there are sequences with room r
    out = []

    def put(room: int, first: int, n: int) -> None:
        nonlocal rooms
        if n and room:
            open_.setdefault(room, []).append((first, n))
            rooms |= 1 << room

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            fit = rooms >> length
            if fit:  # the tightest room that is large enough
                room = length + (fit & -fit).bit_length() - 1
                first, n = open_[room].pop()
                if not open_[room]:
                    rooms ^= 1 << room
            else:
                room, first, n = capacity, sequences, -(-left // (capacity // length))
                sequences += n
            each = min(room // length, left)
            full = min(n, left // each)
            for k in range(each):
                out.append((length, rank, full, first, capacity - room + k * length))
                rank += full
            left -= each * full
            put(room - each * length, first, full)
            if room == capacity and full < n:  # the last new sequence gets what is left
                for k in range(left):
                    out.append((length, rank + k, 1, first + full, k * length))
                put(room - left * length, first + full, 1)
                left = 0
            else:
                put(room, first + full, n - full)
    return out


def ranked(pieces: DataFrame, per_bucket: int = 50_000) -> tuple[DataFrame, dict[int, int]]:
    """pieces with rank (from 0, without gaps) within their length, and the histogram of lengths."""
    histogram = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}  # at most CAPACITY rows
    buckets = 16 + max(histogram.values(), default=0) // per_bucket
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    before = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = before.select("length", "bucket", (F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n")).alias("before"))
    own = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32", "start")) - 1
    return dealt.withColumn("own", own).join(before, ["length", "bucket"]).withColumn("rank", F.col("before") + F.col("own")).drop("bucket", "own", "before"), histogram


def slots(spark, ranges: list[tuple], chunk: int = 1_000) -> DataFrame:
    """length, rank, sequence_id, offset: one row for each planned slot, made in chunks by all tasks."""
    planned = spark.createDataFrame(ranges, "length long, rank long, n long, sequence_id long, offset long")
    parts = planned.withColumn("part", F.explode(F.expr(f"sequence(0L, (n - 1) div {chunk})")))
    parts = parts.repartition("length", "sequence_id", "part")
    steps = parts.withColumn("i", F.explode(F.expr(f"sequence(part * {chunk}, least((part + 1) * {chunk}, n) - 1)")))
    return steps.select("length", (F.col("rank") + F.col("i")).alias("rank"), (F.col("sequence_id") + F.col("i")).alias("sequence_id"), "offset")


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for docs (doc_id, text)."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = cut(own.mapInArrow(_pieces(tokenizer_path, capacity), PIECES))
    placed, histogram = ranked(pieces)
    return placed.join(slots(docs.sparkSession, plan(histogram, capacity)), ["length", "rank"]).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def op9_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), vocabulary())
