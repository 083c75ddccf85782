"""Tables by key as a log of whole commits, in Parquet; a later commit of a key replaces the earlier one.

A commit is a folder of the root, named by its ordinal, with one Parquet folder for each
table it wrote. It is written under a hidden name, table after table, and renamed when all
are complete: readers see a commit whole or not at all, and a writer that is killed leaves
the state as it was and a hidden folder, which clean() removes. The ordinal is claimed by
creating a file that must not exist, after the data are written, so two writers never share
one and the order is that in which commits were completed.

A commit may carry the name of a writer and a number of its own, such as a stream and its
batch id. A number that the writer has already committed, or a smaller one, is not written
again, so a repeated batch changes nothing.

The folder must be on a file system that renames a folder in one step (HDFS, local disks).
The driver lists commits, not files; compact() keeps them few.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import file_system

NAME = re.compile(r"(\d{12})-([^-]+)-(\d+)")
WHOLE, WRITERS = "compacted", "_writers"


def commits(spark: SparkSession, root: str) -> list[tuple[int, str, int, str]]:
    """(ordinal, writer, number, path) of the commits that count, oldest first: the newest compacted one and those after it."""
    fs, at = file_system(spark, root)
    names = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
    found = sorted((int(m[1]), m[2], int(m[3]), f"{root.rstrip('/')}/{m[0]}") for m in map(NAME.fullmatch, names) if m)
    start = max((c[0] for c in found if c[1] == WHOLE), default=-1)
    return [c for c in found if c[0] > start or c[:2] == (start, WHOLE)]


def _claimed(spark: SparkSession, root: str) -> int:
    """A new ordinal, greater than all before."""
    fs, at = file_system(spark, f"{root.rstrip('/')}/_claims")
    taken = [int(s.getPath().getName()) for s in fs.listStatus(at)] if fs.exists(at) else []
    ordinal = max(taken, default=-1) + 1
    while True:
        try:
            fs.create(file_system(spark, f"{root.rstrip('/')}/_claims/{ordinal:012d}")[1], False).close()
            return ordinal
        except Exception as e:  # noqa: BLE001
            if "exist" not in str(e).lower():
                raise
            ordinal += 1


def last_number(spark: SparkSession, root: str, writer: str) -> int:
    """The greatest number that a writer has committed, -1 without any."""
    own, kept = [-1], commits(spark, root)
    for _, name, number, path in kept:
        if name == writer:
            own.append(number)
        elif name == WHOLE:
            own += [r["number"] for r in spark.read.parquet(f"{path}/{WRITERS}").where(F.col("writer") == writer).collect()]  # one row a writer
    return max(own)


def commit(spark: SparkSession, root: str, tables: dict[str, DataFrame], writer: str = "", number: int = 0) -> int | None:
    """Write rows of several tables, in their order, as one commit. Its ordinal, or None if the writer had committed this number."""
    if not re.fullmatch(r"[A-Za-z0-9_.]*", writer) or writer == WHOLE:
        raise ValueError(f"not a writer's name: {writer}")
    if writer and number <= last_number(spark, root, writer):
        return None
    hidden = f"{root.rstrip('/')}/.{uuid.uuid4().hex}"
    for name, rows in tables.items():
        rows.write.parquet(f"{hidden}/{name}")
    ordinal = _claimed(spark, root)
    _show(spark, hidden, f"{root.rstrip('/')}/{ordinal:012d}-{writer or uuid.uuid4().hex}-{number}")
    return ordinal


def _show(spark: SparkSession, hidden: str, path: str) -> None:
    fs, at = file_system(spark, hidden)
    if not fs.rename(at, file_system(spark, path)[1]):
        raise OSError(f"could not rename {hidden} to {path}")


def history(spark: SparkSession, root: str, table: str) -> DataFrame | None:
    """All rows of a table with `commit`, their ordinal; None if no commit holds the table."""
    fs, _ = file_system(spark, root)
    paths = [f"{c[3]}/{table}" for c in commits(spark, root)]
    paths = [p for p in paths if fs.exists(file_system(spark, p)[1])]
    if not paths:
        return None
    return spark.read.option("mergeSchema", "true").parquet(*paths).withColumn("commit", F.regexp_extract("_metadata.file_path", r"/(\d{12})-[^/]+/[^/]+/[^/]+$", 1).cast("long"))


def newest(spark: SparkSession, root: str, table: str, key: list[str], order: list[str] | None = None) -> DataFrame | None:
    """The row of each key that was written last; of several in one commit the one greatest by `order`, then by its hash."""
    rows = history(spark, root, table)
    if rows is None:
        return None
    rest = [c for c in rows.columns if c not in (*key, "commit")]
    last = rows.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct("commit", *(order or []), F.xxhash64(*rest))).alias("_row"))
    return last.select(*key, *[F.col("_row")[c].alias(c) for c in rest]).select(*[c for c in rows.columns if c != "commit"])


def compact(spark: SparkSession, root: str, tables: dict[str, tuple[list[str], list[str]]]) -> int | None:
    """One commit in place of all up to now, of tables name -> (key, order). What the compaction before had replaced is deleted; what this one replaces stays for those who read it."""
    kept = commits(spark, root)
    if len(kept) < 2:
        return None
    last, hidden = kept[-1][0], f"{root.rstrip('/')}/.{uuid.uuid4().hex}"
    for name, (key, order) in tables.items():
        rows = newest(spark, root, name, key, order)
        if rows is not None:
            rows.write.parquet(f"{hidden}/{name}")
    numbers: dict[str, int] = {}
    for _, writer, number, path in kept:
        for w, n in [(r["writer"], r["number"]) for r in spark.read.parquet(f"{path}/{WRITERS}").collect()] if writer == WHOLE else [(writer, number)]:
            numbers[w] = max(n, numbers.get(w, -1))
    spark.createDataFrame(list(numbers.items()), "writer string, number long").coalesce(1).write.parquet(f"{hidden}/{WRITERS}")
    fs, at = file_system(spark, root)
    for status in fs.listStatus(at):
        m = NAME.fullmatch(status.getPath().getName())
        if m and int(m[1]) <= kept[0][0] and status.getPath().getName() != kept[0][3].rsplit("/", 1)[-1]:
            fs.delete(status.getPath(), True)
    _show(spark, hidden, f"{root.rstrip('/')}/{last:012d}-{WHOLE}-0")
    return last


def clean(spark: SparkSession, root: str, older_than_s: float = 86_400.0, now_ms: Callable[[], int] | None = None) -> int:
    """Delete the hidden folders of writers that were killed. Returns how many there were."""
    fs, at = file_system(spark, root)
    now = now_ms() if now_ms else spark._jvm.java.lang.System.currentTimeMillis()
    left = [s.getPath() for s in (fs.listStatus(at) if fs.exists(at) else []) if re.fullmatch(r"\.[0-9a-f]{32}", s.getPath().getName()) and now - s.getModificationTime() >= 1000 * older_than_s]
    for path in left:
        fs.delete(path, True)
    return len(left)
