"""Exact top-k inner products: norm-sorted blocks, rotated partial sums, residual bounds.

Components are quantised to floor(256 x); scores are integer inner products. Vectors are
taken by descending length, in up to four rounds (STEPS, those of a block's size at least); in each, ranges of like length form blocks.
Each round first stores the queries with the score their k-th best has so far and the
length a vector must have to reach it, sorted by that length. A task holds one block of
candidates at a time and reads from the store only the queries that the block's longest vector can
still serve, a group at a time; candidates are moved once and queries by reading. Inside a block, sub-blocks
follow in descending length. A query leaves when |query| times the length of the next
sub-block cannot reach its k-th best score, carried over from the rounds before. For the
others, the inner product over the first LEADING rotated dimensions plus the Cauchy-Schwarz
bound of the rest, |residual of query| times |residual of vector|, decides which vectors get
their exact score. The rotation comes from the singular vectors of SAMPLE vectors at most; any
orthogonal one gives the same result, so the sample touches speed alone. Bounds carry a slack
for rounding; scores are exact while sums stay under 2**53.

Vectors that are null or hold a null or non-finite component take no part, nor do rows with a
null id. Vectors of different dimension compare over the dimensions both have. Repeated rows
(same id, same vector) count once. Fewer than k candidates: all are returned. Ties go to the
smaller vec_id. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset
import pyarrow.fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, drop, table

K, LEADING, SUB_BLOCK, BLOCK_ROWS, GROUP_QUERIES, SAMPLE = 5, 24, 512, 32_768, 2_048, 4_096
STEPS = (1 / 64, 1 / 16, 1 / 4)  # shares of the vectors, the longest first, after which thresholds are renewed
MOST_PARTS = 20_000  # partitions of a round; beyond it, tasks take several blocks
FOUND = "query_id long, vec_id long, score long"


def quantised(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id, v (array of whole doubles), norm2: one row per usable vector."""
    ok = F.col(embedding).isNotNull() & F.col(vec_id).isNotNull() & ~F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    v = F.transform(embedding, lambda x: F.floor(x.cast("double") * 256).cast("double"))
    own = vectors.where(ok).select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v")).distinct()
    return own.withColumn("norm2", F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))


def _matrix(column, dim: int) -> np.ndarray:
    """Lists of numbers as rows, shorter ones filled with zeros, from the flat values."""
    sizes, flat = pc.list_value_length(column).to_numpy(zero_copy_only=False), column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == dim).all():
        return flat.reshape(len(sizes), dim)
    out = np.zeros((len(sizes), dim))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def best_in_block(q_ids, q, least, block, k: int, sub_block: int, seen: list | None = None):
    """For each query its k best rows of a block among those that reach `least`: arrays query index, candidate id, score.

    block: ids, vectors, lengths (descending), rotated leading parts, lengths of the rests, and the rotation.
    seen: a list that gets the number of exact scores.
    """
    c_ids, c, length, leading, rest, rotation = block
    part_of = leading.shape[1]
    qr = q @ rotation
    q_rest = np.sqrt(np.maximum(np.einsum("ij,ij->i", qr[:, part_of:], qr[:, part_of:]), 0))
    q_length = np.sqrt(np.einsum("ij,ij->i", q, q))
    scores = np.repeat(least[:, None], k, 1)  # places without an id stand for a score that must be reached
    ids = np.full((len(q), k), NO_VECTOR)
    live = np.arange(len(q))
    for at in range(0, len(c), sub_block):
        part = slice(at, min(at + sub_block, len(c)))
        slack = 1e-9 * (1 + q_length * length[at])
        live = live[(q_length * length[at] + slack)[live] >= scores[live, -1]]
        if not len(live):
            break
        bound = qr[live, :part_of] @ leading[part].T + np.outer(q_rest[live], rest[part])
        may = bound + slack[live, None] >= scores[live, -1, None]
        may &= c_ids[None, part] != q_ids[live, None]
        rows = np.flatnonzero(may.any(1))
        if not len(rows):
            continue
        columns = np.flatnonzero(may[rows].any(0))
        if seen is not None:
            seen.append(len(rows) * len(columns))
        exact = q[live[rows]] @ c[part][columns].T
        may = may[np.ix_(rows, columns)] & (exact >= scores[live[rows], -1, None])
        exact = np.where(may, exact, -np.inf)
        both = np.concatenate([scores[live[rows]], exact], 1)
        both_ids = np.concatenate([ids[live[rows]], np.where(may, c_ids[part][columns], NO_VECTOR)], 1)
        best = np.lexsort((both_ids, -both), axis=1)[:, :k]
        scores[live[rows]] = np.take_along_axis(both, best, 1)
        ids[live[rows]] = np.take_along_axis(both_ids, best, 1)
    hit = ids != NO_VECTOR
    return np.nonzero(hit)[0], ids[hit], scores[hit].astype(np.int64)


NO_VECTOR = np.iinfo(np.int64).max


def _search(files: list[str], rotation: np.ndarray, dim: int, k: int, leading: int, sub_block: int, block_rows: int, group_queries: int):
    """Found rows of a task's candidates (vec_id, v), which come by descending length, block by block.

    For each block the stored queries that can still reach its greatest length are read in groups.
    """

    def block(ids, v):
        length = np.sqrt(np.einsum("ij,ij->i", v, v))
        order = np.argsort(-length, kind="stable")
        ids, v, length = ids[order], v[order], length[order]
        rotated = v @ rotation
        rest = np.sqrt(np.maximum(np.einsum("ij,ij->i", rotated[:, leading:], rotated[:, leading:]), 0))
        return ids, v, length, np.ascontiguousarray(rotated[:, :leading]), rest, rotation

    def found(held):
        own = block(np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held]))
        longest = float(own[2][0]) * (1 + 1e-9) + 1e-9
        for file in files:
            system, path = pyarrow.fs.FileSystem.from_uri(file)
            stored = pyarrow.dataset.dataset(path, filesystem=system, format="parquet")
            for batch in stored.to_batches(filter=pyarrow.dataset.field("need") <= longest, columns=["query_id", "v", "least"], batch_size=group_queries):
                if batch.num_rows:
                    ids = batch.column(0).to_numpy()
                    at, vec, scores = best_in_block(ids, _matrix(batch.column(1), dim), batch.column(2).to_numpy(), own, k, sub_block)
                    if len(at):
                        yield pa.record_batch([pa.array(ids[at]), pa.array(vec), pa.array(scores)], names=["query_id", "vec_id", "score"])

    def run(batches):
        held, n = [], 0
        for batch in batches:
            for k_ in range(0, batch.num_rows, block_rows):
                part = batch.slice(k_, block_rows)
                if n and n + part.num_rows > block_rows:
                    yield from found(held)
                    held, n = [], 0
                held.append((part.column(0).to_numpy(), _matrix(part.column(1), dim)))
                n += part.num_rows
        if held:
            yield from found(held)

    return run


def _stored_queries(queries: DataFrame, best: DataFrame | None, k: int, files: int) -> DataFrame:
    """Queries with the score a candidate must reach (least) and the length it must have for that (need), sorted by need."""
    if best is None:
        known = queries.withColumn("least", F.lit(float("-inf")))
    else:
        least = best.where(F.col("rank") == k).select("query_id", F.col("score").cast("double").alias("least"))
        known = queries.join(least, "query_id", "left").withColumn("least", F.coalesce("least", F.lit(float("-inf"))))
    # |q| |c| >= least must hold; a least score of 0 or below is in reach of any length
    need = F.when(F.col("least") <= 0, 0.0).when(F.col("norm") > 0, F.col("least") / F.col("norm")).otherwise(float("inf"))
    return cut(known.withColumn("need", need).select("query_id", "v", "norm", "least", "need").repartitionByRange(files, "need").sortWithinPartitions("need"))


def top_k(vectors: DataFrame, is_query, k: int = K, leading: int = LEADING, sub_block: int = SUB_BLOCK, block_rows: int = BLOCK_ROWS, group_queries: int = GROUP_QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score for the rows of vectors (vec_id, embedding) where is_query holds."""
    spark = vectors.sparkSession
    own = cut(quantised(vectors))
    n, n_queries, dim = own.agg(F.count("*"), F.count(F.when(is_query, 1)), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    share = min(1.0, SAMPLE / max(n, 1))
    seen = own.where(F.pmod(F.xxhash64("vec_id"), F.lit(1_000_000)) < F.lit(int(1_000_000 * share) + 1)).select("v").limit(SAMPLE).toArrow()
    sample = _matrix(seen["v"].combine_chunks(), dim) if dim else np.zeros((0, 0))
    rotation = np.linalg.svd(sample, full_matrices=True)[2].T if len(sample) and dim else np.eye(dim)
    steps = [x for x in STEPS if n * x >= block_rows]  # a round that fills no block would renew no thresholds worth its cost
    edges = own.agg(F.percentile_approx("norm2", [1 - x for x in steps], 10_000)).first()[0] if steps else []
    edges = [float("inf"), *sorted(set(edges), reverse=True), float("-inf")]
    queries = own.where(is_query).select(F.col("vec_id").alias("query_id"), "v", F.sqrt("norm2").alias("norm"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = None
    parallel = spark.sparkContext.defaultParallelism
    for high, low, part in zip(edges[:-1], edges[1:], [*steps, 1.0], strict=False):
        stored = _stored_queries(queries, best, k, max(1, -(-n_queries // 65_536)))
        files = [r[0] for r in stored.select(F.input_file_name()).distinct().collect()]  # one name for 65,536 queries
        some = own.where((F.col("norm2") < high if high < float("inf") else F.lit(True)) & (F.col("norm2") >= low)).select("vec_id", "v", "norm2")
        # ranges of like length, about a block each; their number follows the vectors, not the queries
        rows = int(n * part) + 1
        parts = max(1, min(-(-rows // block_rows), MOST_PARTS), min(parallel, -(-rows // 1_024)))
        dealt = some.repartitionByRange(parts, F.desc("norm2"), F.xxhash64("vec_id")).sortWithinPartitions(F.desc("norm2"))
        found = dealt.select("vec_id", "v").mapInArrow(_search(files, rotation, dim, k, leading, sub_block, block_rows, group_queries), FOUND)
        if best is not None:
            found = found.unionByName(best.select("query_id", "vec_id", "score"))
        new = cut(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))
        drop(stored, *([] if best is None else [best]))
        best = new
    drop(own)
    return best


def op5_exact_top_k(spark, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.expr("vec_id % 50 = 0"))


OP5_SQL = """
WITH ok AS (
  SELECT DISTINCT CAST(vec_id AS BIGINT) AS vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: coalesce(p[1] * p[2], 0))) AS BIGINT) AS score
  FROM ok q JOIN ok c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
