"""Prefix trie of conversations: one node for each different sequence of first turns.

Each turn has a SHA-256 of its role and text, and each prefix of a conversation the SHA-256
of the prefix before it and its last turn, so equal digests are equal sequences of turns.
Every conversation is exploded into its prefixes (root first); rows of one (depth, digest)
are one node. Only digests, numbers and ids move between tasks, never texts.

A node is known by its smallest member and its depth. The nodes with one smallest member are
the last stretch of that conversation, a path; so for sums over subtrees a path, not each of
its nodes, is exploded to its ancestors, one row for each other path it hangs from (with the
depth of the lowest node there). These rows are no more than the turns, however long a
conversation, where nodes times ancestors would grow with the square of its length. Within
a path sums run from its end to its top.

A third of all conversations may share a node: counts and sums are gathered before they are
shuffled, prefixes meet their node in a join that Spark may split, and the ids that end in a
node are sorted in ranges over all tasks, joined to texts of CHUNK bytes there and hashed from
these in a stream. A conversation's prefixes are chained in a stream as well, so a task
holds one digest, however many turns follow.

Turns are taken by turn number, null first; of equal numbers the role, then the turn's
digest decide. A null role or text is empty. Rows without a conv_id belong to no conversation.
Repeated rows are turns of their own. A conversation without turns is a member of the root
alone; an empty table has no nodes. Columns other than these four, whatever their names, are
not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SQL_NUMBERS, cut, sql_crc32, table

ROOT = hashlib.sha256(b"").digest()
CHUNK = 1 << 20
HEAD, MOST = 5, 9  # op11's contract: conversations share the head of each fifth one, of fewer than nine turns


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, position (from 1), step (SHA-256 of role and text), n_bytes (UTF-8 of the text) for conversations (conv_id, turn, role, text)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    own = conversations.filter(F.col("conv_id").isNotNull())
    step = F.unhex(F.sha2(F.concat(F.sha2(role, 256), F.sha2(text, 256)), 256))
    own = own.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), role.alias("role"), step.alias("step"), F.octet_length(text).cast("long").alias("n_bytes"))
    position = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "step"))
    return own.select("conv_id", position.alias("position"), "step", "n_bytes")


def ids(conversations: DataFrame) -> DataFrame:
    return conversations.filter(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id")).distinct()


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Prefix rows of turns that come sorted by conversation and position, position 0 (no turn) first."""
    held = None  # the last row, whose `ends` the next one decides
    for batch in batches:
        out = []
        for conv, position, step, n_bytes in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if not position:
                depth, digest = 0, ROOT
            else:
                depth, digest = depth + 1, hashlib.sha256(digest + step).digest()
            if held:
                out.append((*held, not depth))
            held = (conv, depth, digest, n_bytes)
        yield _prefix_batch(out)
    if held:
        yield _prefix_batch([(*held, True)])


PREFIXES = "conv_id long, depth int, digest binary, n_bytes long, ends boolean"


def _prefix_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.bool_())
    return pa.record_batch([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True) if rows else [()] * 5, kinds, strict=True)], names=["conv_id", "depth", "digest", "n_bytes", "ends"])


def prefixes(steps: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row for each prefix of each conversation (conv_id), the empty one included; steps as turns() gives them."""
    starts = conversations.select("conv_id", F.lit(0).alias("position"), F.lit(None).cast("binary").alias("step"), F.lit(0).cast("long").alias("n_bytes"))
    every = starts.unionByName(steps.select("conv_id", "position", "step", "n_bytes"))
    return every.repartition("conv_id").sortWithinPartitions("conv_id", "position").mapInArrow(_chain, PREFIXES)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(digest, first id, ids joined by commas) of sorted (digest, id), in texts of about CHUNK bytes."""
    digest, first, parts, size = None, None, [], 0

    def made():
        return pa.record_batch([pa.array([digest], pa.binary()), pa.array([first], pa.int64()), pa.array([",".join(parts)], pa.large_string()).cast(pa.string())], names=["digest", "first", "ids"])

    for batch in batches:
        for own, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if parts and (own != digest or size >= CHUNK):
                yield made()
                parts, size = [], 0
            if not parts:
                digest, first = own, conv
            parts.append(str(conv))
            size += len(parts[-1]) + 1
    if parts:
        yield made()


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(digest, SHA-256 of its chunks joined by commas) of chunks sorted by digest and first id."""
    digest, running = None, None
    for batch in batches:
        out = []
        for own, text in zip(*(c.to_pylist() for c in batch.select(["digest", "ids"]).columns), strict=True):
            if own == digest:
                running.update(b"," + text.encode())
                continue
            if running:
                out.append((digest, running.hexdigest()))
            digest, running = own, hashlib.sha256(text.encode())
        yield _hash_batch(out)
    if running:
        yield _hash_batch([(digest, running.hexdigest())])


def _hash_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())], names=["digest", "ends_sha256"])


def ends(rows: DataFrame) -> DataFrame:
    """digest, ends_sha256: hash of the ids, ascending, of the conversations that end in a node."""
    own = rows.filter("ends").select("digest", "conv_id").repartitionByRange("digest", "conv_id").sortWithinPartitions("digest", "conv_id")
    chunks = own.mapInArrow(_chunks, "digest binary, first long, ids string")
    return chunks.repartition("digest").sortWithinPartitions("digest", "first").mapInArrow(_hashes, "digest binary, ends_sha256 string")


def prefix_trie(steps: DataFrame, conversations: DataFrame) -> DataFrame:
    """The nodes of the trie of turns (conv_id, position, step, n_bytes) over conversations (conv_id, all different).

    conv_id (smallest member), depth, digest, parent_conv_id, n_convs, n_children, n_leaves
    and saved_tokens (bytes of last texts that members after the first repeat, over the
    subtree), ends_sha256.
    """
    rows = cut(prefixes(steps, conversations))
    nodes = cut(rows.groupBy("depth", "digest").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("n_bytes").alias("n_bytes")))

    met = rows.select("depth", "digest", "conv_id").join(nodes.select("depth", "digest", F.col("conv_id").alias("path")), ["depth", "digest"])
    stretches = cut(met.groupBy("conv_id", "path").agg(F.min("depth").alias("top"), F.max("depth").alias("low")))
    paths = stretches.filter("conv_id = path").select("conv_id", "top")
    above = cut(stretches.filter("conv_id != path").select("conv_id", "path", "low").join(paths, "conv_id").select("conv_id", "path", F.col("low").alias("depth"), "top", (F.col("low") == F.col("top") - 1).alias("direct")))

    hung = above.filter("direct").groupBy(F.col("path").alias("conv_id"), "depth").agg(F.count("*").alias("hung"))
    parents = above.filter("direct").select("conv_id", F.col("top").alias("depth"), F.col("path").alias("parent"))
    path = Window.partitionBy("conv_id").orderBy(F.desc("depth"))
    next_ = F.lag("depth").over(path)
    known = nodes.join(hung, ["conv_id", "depth"], "left").join(parents, ["conv_id", "depth"], "left")
    known = known.withColumn("n_children", F.coalesce("hung", F.lit(0)) + F.when(next_.isNull(), 0).otherwise(1))
    known = cut(known.withColumns({"leaf": F.when(F.col("n_children") == 0, 1).otherwise(0), "saved": (F.col("n_convs") - 1) * F.col("n_bytes")}))

    totals = known.groupBy("conv_id").agg(F.sum("leaf").alias("leaves"), F.sum("saved").alias("saves"))
    below = above.join(totals, "conv_id").groupBy(F.col("path").alias("conv_id"), "depth").agg(F.sum("leaves").alias("leaves"), F.sum("saves").alias("saves"))
    to_end = path.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = known.join(below, ["conv_id", "depth"], "left").select(
        "conv_id", "depth", "digest", "parent", "n_convs", "n_children",
        F.sum(F.col("leaf") + F.coalesce("leaves", F.lit(0))).over(to_end).alias("n_leaves"),
        F.sum(F.col("saved") + F.coalesce("saves", F.lit(0))).over(to_end).alias("saved_tokens"),
    )
    out = summed.join(ends(rows), "digest", "left")
    parent = F.when(F.col("depth") == 0, None).otherwise(F.coalesce("parent", "conv_id"))
    return out.select("conv_id", F.col("depth").cast("long").alias("depth"), "digest", parent.alias("parent_conv_id"), "n_convs", F.col("n_children").cast("long").alias("n_children"), "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(ROOT.hex())).alias("ends_sha256"))


def rebuilt(steps: DataFrame, conversations: DataFrame) -> DataFrame:
    """turns() of conversations that begin with the head of another one, as op11's contract says."""
    head = F.crc32(F.col("conv_id").cast("string")) % MOST
    heads = steps.filter((F.col("conv_id") % HEAD == 0) & (F.col("position") < MOST)).withColumnRenamed("conv_id", "head")
    lent = conversations.select("conv_id", (F.col("conv_id") - F.col("conv_id") % HEAD).alias("head"), head.alias("h")).join(heads, "head").filter("position <= h")
    return lent.select("conv_id", "position", "step", "n_bytes").unionByName(steps.filter(F.col("position") > head))


def op11_prefix_trie(spark, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    steps, every = cut(turns(conversations)), ids(conversations)
    return prefix_trie(rebuilt(steps, every), every).drop("digest")


#: Prefixes are named by their turns' hashes, joined.
OP11_SQL = f"""
WITH {SQL_NUMBERS},
every AS (SELECT conv_id, CAST(conv_id AS VARCHAR) AS name FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)),
heads AS (
  SELECT conv_id, conv_id - conv_id % 5 AS head,
    {sql_crc32("name")} % 9 AS h
  FROM every, numbers),
own AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos,
    sha256(sha256(coalesce(role, '')) || sha256(coalesce(text, ''))) AS step, strlen(coalesce(text, '')) AS n
  FROM conversations WHERE conv_id IS NOT NULL),
built AS (
  SELECT h.conv_id, o.pos, o.step, o.n FROM heads h JOIN own o ON o.conv_id = h.head AND o.pos <= h.h
  UNION ALL SELECT h.conv_id, o.pos, o.step, o.n FROM heads h JOIN own o ON o.conv_id = h.conv_id AND o.pos > h.h),
chain AS (
  SELECT conv_id, row_number() OVER w AS depth, string_agg(step, '') OVER w AS key, n FROM built
  WINDOW w AS (PARTITION BY conv_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
  UNION ALL SELECT conv_id, 0, '', 0 FROM every),
last AS (SELECT conv_id, max(depth) AS depth FROM chain GROUP BY conv_id),
node AS (
  SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(n) AS saved,
    CASE WHEN depth > 0 THEN left(key, 64 * (depth - 1)) END AS parent FROM chain GROUP BY key, depth),
children AS (SELECT parent AS key, count(*) AS n FROM node WHERE depth > 0 GROUP BY parent),
one AS (SELECT n.key, n.depth, n.saved, CASE WHEN c.n IS NULL THEN 1 ELSE 0 END AS leaf FROM node n LEFT JOIN children c USING (key)),
sums AS (
  SELECT left(o.key, CAST(64 * d.depth AS BIGINT)) AS key, sum(o.saved) AS saved, sum(o.leaf) AS leaves
  FROM one o JOIN (SELECT DISTINCT depth FROM chain) d ON d.depth <= o.depth GROUP BY 1),
done AS (
  SELECT c.key, sha256(string_agg(CAST(c.conv_id AS VARCHAR), ',' ORDER BY c.conv_id)) AS ends
  FROM chain c JOIN last l ON l.conv_id = c.conv_id AND l.depth = c.depth GROUP BY c.key)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children,
  CAST(s.leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, coalesce(d.ends, sha256('')) AS ends_sha256
FROM node n LEFT JOIN node p ON p.key = n.parent LEFT JOIN children c ON c.key = n.key JOIN sums s ON s.key = n.key LEFT JOIN done d ON d.key = n.key
"""
