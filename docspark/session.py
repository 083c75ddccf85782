"""Session settings the library expects, and the folder that all executors share."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(name: str = "docspark", **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; sizes and master are the cluster's business."""
    builder = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").config("spark.sql.adaptive.skewJoin.enabled", "true").config("spark.sql.execution.arrow.pyspark.enabled", "true")
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


_made: list[tuple[SparkSession, str]] = []


def shared_folder(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir, deleted when the program ends. Only a session of one machine may do without that setting."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="docspark-")
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/docspark-{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


def compiled(spark: SparkSession) -> None:
    """Steps whose generated code is one method of over 8,000 bytes run as several small ones, unless the session says otherwise: the JVM compiles no longer method."""
    key = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, "8000")


def parts(spark: SparkSession) -> int:
    """Tasks that keep all cores busy."""
    return max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def spread(df: DataFrame) -> DataFrame:
    """df's rows dealt to all cores. A small file is one task otherwise, however much work its rows are."""
    return df.repartition(parts(df.sparkSession))


def written(df: DataFrame) -> DataFrame:
    """df written to a shared folder and read back: computed once, and safe from lost executors."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path, for listing and renaming on the driver."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _removed(path: str) -> None:
    """Delete a local folder entry by entry; millions of objects are never listed at once."""
    if not os.path.isdir(path):
        return
    with os.scandir(path) as entries:
        for e in entries:
            if e.is_dir(follow_symlinks=False):
                _removed(e.path)
            else:
                os.unlink(e.path)
    os.rmdir(path)


@atexit.register
def _clear() -> None:
    for spark, path in _made:
        try:
            _removed(path.removeprefix("file://").removeprefix("file:"))
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jvm.org.apache.hadoop.conf.Configuration()).delete(at, True)
        except Exception:  # noqa: BLE001  the Java side is gone, and nothing can be deleted any more
            return
