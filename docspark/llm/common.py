"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import gc
import tempfile
import time
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NO_ID = (1 << 63) - 1  # a null identifier orders after every other one
WHITE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_written: list[tuple[SparkSession, str]] = []  # folders made by cut() and not yet deleted


def scratch(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir. Only a session of one machine may do without that setting."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="docspark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/docspark-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and read it back, which ends its lineage.

    The written files survive lost executors; the shuffle files behind them may go. What is
    not dropped before goes when the program ends.
    """
    spark, path = df.sparkSession, scratch(df.sparkSession)
    _written.append((spark, path))
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._docspark_path = path
    return out


def _delete(folders: list[tuple[SparkSession, str]]) -> None:
    for spark, path in folders:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jvm.org.apache.hadoop.conf.Configuration() if spark._jsc.sc().isStopped() else spark._jsc.hadoopConfiguration()).delete(where, True)
    gone = {path for _, path in folders}
    _written[:] = [x for x in _written if x[1] not in gone]


def drop(*tables: DataFrame) -> None:
    """Delete tables made by cut() that no later step reads."""
    _delete([(t.sparkSession, t._docspark_path) for t in tables])


def settled(make: Callable[[], DataFrame]) -> DataFrame:
    """The DataFrame that make() returns, written by cut(); tables that its steps had written go."""
    before = {path for _, path in _written}
    out = cut(make())
    _delete([x for x in _written if x[1] not in before and x[1] != out._docspark_path])
    return out


@atexit.register
def _clear() -> None:
    try:
        _delete(list(_written))
    except Exception:  # noqa: BLE001  the Java side is gone, and nothing can be deleted any more
        _written.clear()


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like these that df does not have, in any case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffle files of finished steps.

    The first collection frees the references that Python's objects held, the second the
    shuffles behind them.
    """
    for _ in range(2):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.5)


def word_hashes(words: list[bytes]) -> np.ndarray:
    """XXH3 of each word. Hashing anew is cheaper than looking up words in a large table."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def rolling(values: np.ndarray, n: int) -> np.ndarray:
    """64-bit hash of each run of n values, by doubling; empty if there are fewer."""
    if len(values) < n:
        return np.empty(0, np.uint64)
    base, mask = 0x9E3779B97F4A7C15, (1 << 64) - 1
    out, have, power = None, 0, np.asarray(values, np.uint64)
    bit, at = 1, 0
    with np.errstate(over="ignore"):
        while True:  # power: hash of runs of length bit
            if n & bit:
                m = len(values) - n + 1
                part = power[at : at + m]
                out = part.copy() if out is None else out * np.uint64(pow(base, bit, 1 << 64)) + part
                at += bit
                have += bit
            if have == n:
                break
            power = power[:-bit] * np.uint64(pow(base, bit, 1 << 64) & mask) + power[bit:]
            bit *= 2
        out ^= out >> np.uint64(31)
        out *= np.uint64(0xBF58476D1CE4E5B9)
        out ^= out >> np.uint64(29)
    return out


def text_groups(batches, columns: list[str], text: str = "text", limit: int = 2_000_000):
    """Lists of column values for consecutive rows of about `limit` characters; a longer text stands alone."""
    for batch in batches:
        own = batch.select(columns)
        at = own.schema.get_field_index(text)
        lengths = pc.utf8_length(own.column(at)).fill_null(0).to_numpy(zero_copy_only=False)
        start = total = 0
        for i, n in enumerate(lengths.tolist()):
            if total and total + n > limit:
                yield [c.to_pylist() for c in own.slice(start, i - start).columns]
                start, total = i, 0
            total += n
        if start < len(lengths):
            yield [c.to_pylist() for c in own.slice(start).columns]


def ordering_id(column: str = "doc_id"):
    """The id as a long; null ids come last."""
    return F.coalesce(F.col(column).cast("long"), F.lit(NO_ID))


_STEP = "CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END"
#: DuckDB: a common table expression with the CRC-32 (reflected, 0xEDB88320) of each byte value as list t.
SQL_NUMBERS = f"numbers AS (SELECT list_transform(range(256), lambda b: list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, i: {_STEP})) AS t)"


def sql_crc32(name: str) -> str:
    """DuckDB: CRC-32 of an ASCII text column, where `numbers` is in scope."""
    letters = f"list_transform(range(1, length({name}) + 1), lambda i: CAST(ascii(substr({name}, i, 1)) AS BIGINT))"
    return f"xor(list_reduce(list_concat([4294967295], {letters}), lambda a, b: xor(a // 256, t[1 + xor(a % 256, b)])), 4294967295)"
