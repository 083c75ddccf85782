"""SimHash near-duplicates: 64-bit fingerprints, pigeonhole blocks, Hamming check, components.

A fingerprint has four blocks of 16 bits. Two that differ in at most two bits agree on at
least two blocks, so each different fingerprint is filed under its six pairs of blocks (32
equal bits), and fingerprints that share a file are compared. Copies collapse to one
fingerprint before that. A file of up to FILE_PAIRS fingerprints compares its pairs; a
larger one meets in the middle instead: each member is filed again under itself and under
each one-bit change outside the shared bits. Two members differ in at most two bits exactly
if they share one of these values, so linking all members of a value to its smallest member
keeps every link, adds none, and stays linear in the file's size.

Two bits of 64 hold few texts that share four fifths of their shingles: such texts differ in
about 15 % of the bits. keep_one(), the filter of a corpus, so takes word_groups(): the same
files and checks over SEEDS seeded fingerprints of the different words, which a changed word
moves far less than shingles; texts are linked if they differ in two bits or fewer under any
seed. Of the sf0.1 documents whose sets of five-word shingles have a Jaccard similarity of 0.8 or
more to an earlier one's, this finds 0.94; of those at 0.6 or more, 0.64.

Words of keep_one() are without their punctuation, so copies that differ in it are found. A run of
a script written without spaces counts as its letters and the pairs of neighbouring ones, under twice
as many seeds, and a text of signs alone as its signs.

Null and empty texts have fingerprint 0, linked like any other; for word_groups() all null, empty and
blank texts are one group. Texts of fewer words than a
shingle have one shingle, the whole sequence. Each input row gives one output row; rows with
a null id keep it and count as the largest id (a component of such rows alone has a null
component_id). Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NO_ID, cut, fresh, ordering_id, table, word_hashes
from .graph import components

SHINGLE, MAX_BITS, FILE_PAIRS, SEEDS = 3, 2, 48, 8
NO_SIGNS = re.compile(r"[^\w\s]+").sub
#: Runs of letters of scripts that are written without spaces between words: Thai, Lao, Myanmar, Khmer, kana, Chinese characters.
UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]+")
BLOCKS = 4
MASKS = [sum(0xFFFF << (16 * b) for b in pair) for pair in combinations(range(BLOCKS), BLOCKS - MAX_BITS)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The SimHash of a text as an unsigned integer."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    joined, n = b" ".join(words), len(words)
    ends = [e + i for i, e in enumerate(accumulate(map(len, words)))]
    digest = xxhash.xxh64_intdigest
    if n < shingle:
        hashes = [digest(joined, 42)]
    else:
        starts = [0] + [e + 1 for e in ends[: n - shingle]]
        hashes = [digest(joined[s:e], 42) for s, e in zip(starts, ends[shingle - 1 :], strict=True)]
    total = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 65_536):
        rows = np.array(hashes[k : k + 65_536], "<u8").view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(rows, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > len(hashes), bitorder="little").tobytes(), "little")


def different_words(text: str | None) -> list[str]:
    """The different small-letter words of a text without their punctuation, sorted; of runs of a script without spaces the letters and the pairs of neighbouring ones; of a text of signs alone the signs as they stand."""
    low = text.lower() if text else ""
    words = set(NO_SIGNS("", low).split())
    if not low.isascii() and UNSPACED.search(low):
        runs = UNSPACED.findall(NO_SIGNS("", low))
        words = set(UNSPACED.sub(" ", NO_SIGNS("", low)).split()) | {r[i : i + n] for r in runs for n in (1, 2) for i in range(len(r) + 1 - n)}
    return sorted(words or set(low.split()))


def word_fingerprints(text: str | None, seeds: int) -> list[int]:
    """One SimHash of the different words for each seed; none for a text without words."""
    words = different_words(text)
    if not words:
        return []
    hashes = word_hashes([w.encode("utf-8", "surrogatepass") for w in words])
    total = np.zeros((seeds, 64), np.int64)
    with np.errstate(over="ignore"):
        for k in range(0, len(hashes), 16_384):
            x = hashes[k : k + 16_384, None] + np.arange(1, seeds + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):  # a seeded mixing of 64 bits
                x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
            x ^= x >> np.uint64(31)
            bits = np.unpackbits(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), seeds, 8), axis=2, bitorder="little")
            total += bits.sum(0, dtype=np.int64)
    return np.packbits(2 * total > len(words), axis=1, bitorder="little").view("<u8")[:, 0].tolist()


def _marked(prints: Callable):
    def run(batches):
        for batch in batches:
            values = [[signed(x) for x in prints(t.as_py())] for t in batch.column(2)]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(values, pa.list_(pa.int64()))], names=["doc", "row", "fps"])

    return run


def links(marks: DataFrame, file_pairs: int = FILE_PAIRS) -> DataFrame:
    """a, b: node numbers of marks (node, seed, fp) whose fingerprints of one seed differ in at most two bits; large files give stars that connect the same.

    Marks are different in (seed, fp).
    """
    filed = marks.select(
        "node", "fp", F.explode(F.array(*[F.struct((F.col("seed") * len(MASKS) + i).alias("file"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("part")) for i, m in enumerate(MASKS)])).alias("k")
    ).select("node", "fp", "k.file", "k.part")
    sizes = filed.groupBy("file", "part").agg(F.count("*").alias("n")).where("n > 1")
    held = cut(filed.join(sizes, ["file", "part"]))
    few = held.where(F.col("n") <= file_pairs)
    left, right = few.select("file", "part", F.col("node").alias("a"), F.col("fp").alias("x")), few.select("file", "part", F.col("node").alias("b"), F.col("fp").alias("y"))
    close = F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) <= MAX_BITS
    pairs = left.join(right, ["file", "part"]).where((F.col("x") < F.col("y")) & close).select("a", "b")

    flips = F.array(*[
        F.array(F.lit(0).cast("long"), *[F.lit(signed(1 << bit)) for bit in range(64) if not m >> bit & 1]) for m in MASKS
    ])
    spread = held.where(F.col("n") > file_pairs).select("file", "node", "fp", F.explode(F.element_at(flips, (F.col("file") % len(MASKS) + 1).cast("int"))).alias("flip"))
    spread = spread.select("file", "node", F.col("fp").bitwiseXOR(F.col("flip")).alias("middle"))
    least = spread.groupBy("file", "middle").agg(F.min("node").alias("b"), F.count("*").alias("n")).where("n > 1")
    stars = spread.join(least, ["file", "middle"]).where("node <> b").select(F.col("node").alias("a"), "b")
    return pairs.union(stars).distinct()


def _rooted(nodes: DataFrame, found: DataFrame, node: str) -> DataFrame:
    """nodes (node, best) with the least best of their component."""
    named = nodes.join(components(found).withColumnRenamed("node", node), node, "left").withColumn("root", F.coalesce("root", node))
    best = named.groupBy("root").agg(F.min("best").alias("best"))
    return named.select(node, "root").join(best, "root").select(node, "best")


def near_groups(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc, row, fp, best for each row of docs: its ordering id, the hash of its text, its fingerprint, and the least (doc, row) of its component."""
    own = docs.select(ordering_id().alias("doc"), F.xxhash64("text").alias("row"), F.col("text").cast("string").alias("text"))
    marked = cut(own.mapInArrow(_marked(lambda t: [fingerprint(t, shingle)]), "doc long, row long, fps array<long>").select("doc", "row", F.col("fps")[0].alias("fp")))
    marks = cut(marked.groupBy("fp").agg(F.min(F.struct("doc", "row")).alias("best")))
    return marked.join(_rooted(marks, links(marks.select(F.col("fp").alias("node"), F.lit(0).alias("seed"), "fp")), "fp"), "fp")


def word_groups(docs: DataFrame, seeds: int = SEEDS) -> DataFrame:
    """doc, row, best as near_groups(), linked by word fingerprints of any seed. Texts of the same words are one node; texts without words are linked to each other alone."""
    own = docs.select(ordering_id().alias("doc"), F.xxhash64("text").alias("row"), F.col("text").cast("string").alias("text"))
    marked = cut(own.mapInArrow(_marked(lambda t: word_fingerprints(t, seeds)), "doc long, row long, fps array<long>").select("doc", "row", F.xxhash64("fps").alias("node"), "fps"))
    nodes = cut(marked.groupBy("node").agg(F.min(F.struct("doc", "row")).alias("best"), F.first("fps").alias("fps")))
    marks = nodes.select("node", F.posexplode("fps").alias("seed", "fp"))
    one = cut(marks.groupBy("seed", "fp").agg(F.min("node").alias("node")))  # nodes alike in one seed are linked to the least of them
    alike = marks.join(one.withColumnRenamed("node", "to"), ["seed", "fp"]).where("node <> to").select(F.col("node").alias("a"), F.col("to").alias("b"))
    found = links(one).union(alike).distinct()
    return marked.drop("fps").join(_rooted(nodes.select("node", "best"), found, "node"), "node").select("doc", "row", "best")


def keep_one(docs: DataFrame, groups: Callable[[DataFrame], DataFrame] = word_groups) -> DataFrame:
    """The rows of docs without near-duplicates: of each component the one with the least id (then hash of the text) stays."""
    found = groups(docs)
    winners = cut(found.where((F.col("doc") == F.col("best.doc")) & (F.col("row") == F.col("best.row"))).groupBy("doc", "row").agg(F.count("*").alias("n")))
    doc, row = fresh(docs, "_doc", "_row")
    keyed = docs.withColumn(doc, ordering_id()).withColumn(row, F.xxhash64("text"))
    left = keyed.join(winners.select(F.col("doc").alias(doc), F.col("row").alias(row)), [doc, row], "left_semi")
    if winners.where("n > 1").limit(1).count():  # rows alike in id and text are one document
        left = left.dropDuplicates([doc, row])
    return left.select(*[F.col(f"`{c}`") for c in docs.columns])


def op4_simhash(spark, sf_dir: str) -> DataFrame:
    groups = near_groups(table(spark, sf_dir, "documents"))
    real = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return groups.select(real("doc").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), real("best.doc").alias("component_id"))
