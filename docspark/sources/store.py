"""Objects by key: whole texts and records, each overwritten by a later write of its key.

Tasks write through the file system that the root's address names, in a hidden folder of the
job first, and rename, so an object is either the old one or the new one and a repeated task
does no harm. The hidden folder goes when the job ends; one that a killed job left goes with
a later job. A failed object is a row with an error, never a failed job.
"""

from __future__ import annotations

import time
import uuid

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import keyed
from ..session import parts, written
from . import files

WRITTEN = "key string, bytes long, error string"
PARTS, STALE_S = ".parts", 86_400


def _put(root: str, job: str):
    def run(batches):
        system, base = files.system(root)
        own, made = f"{base}/{PARTS}/{job}/{uuid.uuid4().hex}", set()  # a task's own folder: tasks do not wait for each other there

        def one(path: str, body: bytes) -> None:
            for folder in (path.rsplit("/", 1)[0], own):
                if folder not in made:
                    system.create_dir(folder, recursive=True)
                    made.add(folder)
            with system.open_output_stream(f"{own}/part") as f:
                f.write(body)
            system.move(f"{own}/part", path)

        for batch in batches:
            out = []
            for key, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    try:
                        one(f"{base}/{key}", body or b"")
                    except FileNotFoundError:  # a folder went in the meantime
                        made.clear()
                        one(f"{base}/{key}", body or b"")
                    out.append((key, len(body or b""), ""))
                except Exception as e:  # noqa: BLE001
                    out.append((key, 0, f"{type(e).__name__}: {e}"))
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.string(), pa.int64(), pa.string()), strict=True)], names=["key", "bytes", "error"])

    return run


def _swept(root: str, job: str) -> None:
    """Delete the job's hidden folder, and those that jobs killed long ago left."""
    try:
        system, base = files.system(root)
        own = f"{base}/{PARTS}"
        for info in system.get_file_info(pyarrow.fs.FileSelector(own, allow_not_found=True)):
            if info.base_name == job or info.mtime and time.time() - info.mtime.timestamp() > STALE_S:
                system.delete_dir(info.path)
        if not system.get_file_info(pyarrow.fs.FileSelector(own, allow_not_found=True)):
            system.delete_dir(own)
    except (OSError, ValueError):  # the root cannot be written, which each row already says
        return


def put(df: DataFrame, root: str, key: Column, body: Column, order: list[Column] | None = None) -> DataFrame:
    """Write one object a row, a text in UTF-8 as it stands. Of several rows of a key the last by `order` stays; without an order, or where it ties, the last body in order. Returns the rows that failed (key, bytes, error), which are kept in a table, however many."""
    named = df.select(key.alias("key"), body.cast("binary").alias("body"), F.struct(*[c.alias(f"_{i}") for i, c in enumerate(order or [F.lit(0)])]).alias("place"))
    dealt = named.repartition(parts(df.sparkSession), "key")  # a fixed number: objects are small rows and much work
    last, job = dealt.groupBy("key").agg(F.max_by("body", F.struct("place", "body")).alias("body")), uuid.uuid4().hex
    try:
        return written(last.mapInArrow(_put(root, job), WRITTEN).where("error <> ''"))
    finally:
        _swept(root, job)


def put_analyses(df: DataFrame, root: str, order: list[Column] | None = None) -> DataFrame:
    """key, md as `<key>.md`."""
    return put(df, root, keyed.analysis_key(F.col("key")), F.col("md"), order)


def put_disagreements(df: DataFrame, root: str, order: list[Column] | None = None) -> DataFrame:
    """Rows with a key, each as one JSON object under `disagreements/`; nulls are written."""
    return put(df, root, keyed.disagreement_key(F.col("key")), F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}), order)


def flush_telemetry(spark: SparkSession, staged: str, root: str) -> DataFrame:
    """Copy staged telemetry files to the store under `telemetry/`, by name. Repeating it changes nothing; failures are returned, never raised."""
    try:
        return put(files.contents(spark, staged), root, F.concat(F.lit("telemetry/"), F.col("key")), F.col("content"))
    except Exception as e:  # noqa: BLE001  telemetry must not end the program it watches
        return spark.createDataFrame([(staged, 0, f"{type(e).__name__}: {e}")], WRITTEN)
