"""Object store, key files, telemetry, prompts and golden pairs as DataFrames.

Objects are listed and read by tasks, so the driver holds no list of them. Roots that only
Spark's file systems can open, and paths that are no folder, are read by Spark's own reader.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from datetime import date

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.keyed import placed
from ..session import file_system, spread

TELEMETRY = "timestamp string, source_key string, doc_type string, agent string, provider string, model string, cost_usd double, latency_ms double, retry_count int, success boolean, prompt_version string, extractor_version string"
IMAGES = r"(?i)\.(jpe?g|png|pdf)$"
CONTENT_TYPES = {"pdf": "application/pdf", "png": "image/png", "jpg": "image/jpeg", "jpeg": "image/jpeg"}


#: Names a batch, and bytes of texts a batch, that a task holds at once.
NAMES, BYTES = 10_000, 16_000_000


def system(root: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system that a root's address names, and the path in it."""
    found, path = pyarrow.fs.FileSystem.from_uri(root if "://" in root or root.startswith("file:") else f"file://{root}")
    return found, path.rstrip("/")


def _folder(root: str) -> bool:
    """Whether tasks can list and read the root."""
    try:
        found, path = system(root)
        return found.get_file_info(path).type == pyarrow.fs.FileType.Directory
    except (OSError, ValueError, pa.ArrowException):
        return False


def _names(root: str, suffix: str) -> Iterator[str]:
    """Keys of all objects, hidden ones left out. Local folders are read entry by entry; of other stores a folder's entries are held."""
    found, base = system(root)
    local, waiting = isinstance(found, pyarrow.fs.LocalFileSystem), [""]
    while waiting:
        within = waiting.pop()
        for name, folder in (((e.name, e.is_dir()) for e in os.scandir(f"{base}/{within}")) if local else ((i.base_name, i.type == pyarrow.fs.FileType.Directory) for i in found.get_file_info(pyarrow.fs.FileSelector(f"{base}/{within}".rstrip("/"))))):
            if name.startswith((".", "_")):
                continue
            if folder:
                waiting.append(f"{within}{name}/")
            elif name.endswith(suffix):
                yield within + name


def listed(spark: SparkSession, root: str, suffix: str = "") -> DataFrame:
    """Keys of the objects of a folder. One task walks it, and the keys are dealt to all cores."""
    def run(batches):
        for batch in batches:
            held = []
            for name in _names(batch.column(0)[0].as_py(), suffix) if batch.num_rows else ():
                held.append(name)
                if len(held) == NAMES:
                    yield pa.record_batch([pa.array(held, pa.string())], names=["key"])
                    held = []
            if held:
                yield pa.record_batch([pa.array(held, pa.string())], names=["key"])

    return spread(spark.range(0, 1, 1, 1).select(F.lit(root).alias("root")).mapInArrow(run, "key string"))


def _sizes(root: str):
    def run(batches):
        found, base = system(root)
        for batch in batches:
            if isinstance(found, pyarrow.fs.LocalFileSystem):
                sizes = [os.stat(f"{base}/{k}").st_size for k in batch.column(0).to_pylist()]
            else:
                sizes = [i.size for i in found.get_file_info([f"{base}/{k}" for k in batch.column(0).to_pylist()])]
            yield pa.record_batch([batch.column(0), pa.array(sizes, pa.int64())], names=["key", "size"])

    return run


def _bodies(root: str):
    def run(batches):
        found, base = system(root)
        local = isinstance(found, pyarrow.fs.LocalFileSystem)
        for batch in batches:
            keys, bodies, n = [], [], 0
            for key in batch.column(0).to_pylist():
                with open(f"{base}/{key}", "rb") if local else found.open_input_stream(f"{base}/{key}") as f:
                    body = f.read()
                keys.append(key)
                bodies.append(body)
                n += len(body)
                if n > BYTES:
                    yield pa.record_batch([pa.array(keys, pa.string()), pa.array(bodies, pa.binary())], names=["key", "content"])
                    keys, bodies, n = [], [], 0
            yield pa.record_batch([pa.array(keys, pa.string()), pa.array(bodies, pa.binary())], names=["key", "content"])

    return run


def _relative(path, root: str):
    return F.regexp_replace(path, "^.*?" + root.rstrip("/").rsplit("/", 1)[-1] + "/", "")


def _by_spark(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """key, uri, size, content_type of all objects; contents are not read."""
    if _folder(root):
        found, base = system(root)
        at = f"file:{base}/" if isinstance(found, pyarrow.fs.LocalFileSystem) else root.rstrip("/") + "/"
        files = listed(spark, root).mapInArrow(_sizes(root), "key string, size long").select("key", F.concat(F.lit(at), "key").alias("uri"), "size")
    else:
        files = _by_spark(spark, root).select(_relative("path", root).alias("key"), F.col("path").alias("uri"), F.col("length").alias("size"))
    suffix = F.lower(F.regexp_extract("uri", r"\.([^./]+)$", 1))
    kinds = F.create_map(*[F.lit(x) for kv in CONTENT_TYPES.items() for x in kv])
    return files.select("key", "uri", "size", F.coalesce(F.try_element_at(kinds, suffix), F.lit("application/octet-stream")).alias("content_type"))


def contents(spark: SparkSession, root: str, suffix: str = "") -> DataFrame:
    """key and content of each file."""
    if _folder(root):
        return listed(spark, root, suffix).mapInArrow(_bodies(root), "key string, content binary")
    return _by_spark(spark, root).select(_relative("path", root).alias("key"), "content").where(F.endswith("key", F.lit(suffix)))


def texts(spark: SparkSession, root: str, suffix: str = ".md") -> DataFrame:
    """key and whole text of each file."""
    return contents(spark, root, suffix).select("key", F.col("content").cast("string").alias("md"))


def keys_file(spark: SparkSession, path: str) -> DataFrame:
    """Keys of a list, one a line; blank lines and lines that begin with # are left out."""
    return keys_of(spark.read.text(path))


def numbered_keys(spark: SparkSession, path: str) -> DataFrame:
    """keys_file() with `ordinal`, the key's place among the keys of the list, whatever the number of tasks that read it."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_line"))
    key = F.regexp_replace("value", r"(?U)^\s+|\s+\z", "")
    return placed(lines.select(key.alias("key"), "_file", "_block", "_line").where("key <> '' AND NOT startswith(key, '#')"), ["_file", "_block", "_line"]).select("ordinal", "key")


def keys_of(lines: DataFrame, column: str = "value") -> DataFrame:
    key = F.regexp_replace(column, r"(?U)^\s+|\s+\z", "")
    return lines.select(key.alias("key")).where("key <> '' AND NOT startswith(key, '#')")


def write_records(df: DataFrame, path: str) -> None:
    """key, md, written_at as Parquet. A key's later write replaces the earlier one for read_records()."""
    df.select("key", "md", "written_at").write.mode("append").parquet(path)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The newest record of each key; of writes of one time the last text in order."""
    from ..operators.keyed import upsert

    return upsert(spark.read.schema("key string, md string, written_at timestamp").parquet(path), ["key"], [F.col("written_at"), F.col("md")])


def append_telemetry(df: DataFrame, path: str) -> None:
    """One folder for each UTC day; null fields are written."""
    day = F.to_date(F.substring("timestamp", 1, 10))
    df.withColumn("event_date", day).write.mode("append").partitionBy("event_date").option("ignoreNullFields", "false").json(path)


def read_telemetry(spark: SparkSession, path: str) -> DataFrame:
    """Well-formed lines; blank and malformed ones are left out."""
    return telemetry_of(spark.read.text(path))


def telemetry_days(spark: SparkSession, path: str) -> list[str]:
    """Days with telemetry, newest first, from the folders' names alone."""
    fs, at = file_system(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
    return sorted((n.removeprefix("event_date=") for n in names if re.fullmatch(r"event_date=\d{4}-\d{2}-\d{2}", n)), reverse=True)


def newest_telemetry(spark: SparkSession, path: str, days: int = 7) -> DataFrame:
    """read_telemetry() of the newest days; other days' files are neither listed nor read."""
    found = telemetry_days(spark, path)[:days]
    if not found:
        return telemetry_of(spark.createDataFrame([], "value string, event_date date"))
    lines = spark.read.option("basePath", path).text([f"{path.rstrip('/')}/event_date={d}" for d in found])
    return telemetry_of(lines.where(F.col("event_date").isin([date.fromisoformat(d) for d in found])))


def telemetry_of(lines: DataFrame) -> DataFrame:
    """The well-formed records of lines (value), with the lines' other columns."""
    day = [c for c in lines.columns if c != "value"]
    parsed = lines.select(*day, F.from_json("value", TELEMETRY + ", _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("r"), "value")
    return parsed.where("trim(value) <> '' AND r._bad IS NULL").select("r.*", *day).drop("_bad")


def malformed(lines: DataFrame, column: str = "line") -> DataFrame:
    """Lines of JSON text that are blank or do not parse to the telemetry schema."""
    parsed = F.from_json(column, TELEMETRY + ", _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    return lines.where(parsed["_bad"].isNotNull() | (F.trim(column) == ""))


def golden_pairs(files: DataFrame, path: str = "path") -> DataFrame:
    """doc_type, stem, image, expected: `<image>.expected.md`, else `<stem>.expected.md`; null where there is none."""
    named = files.select(F.col(path).alias("path"), F.regexp_extract(path, r"([^/]+)/[^/]+$", 1).alias("doc_type"), F.regexp_extract(path, r"([^/]+)$", 1).alias("name"))
    images = named.where(F.col("name").rlike(IMAGES)).select("doc_type", F.col("path").alias("image"), "name", F.regexp_replace("name", r"\.[^.]+$", "").alias("stem"))
    expected = named.where(F.col("name").endswith(".expected.md")).select("doc_type", F.col("path").alias("expected"), F.regexp_replace("name", r"\.expected\.md$", "").alias("of"))
    by_name = expected.select("doc_type", F.col("of").alias("name"), F.col("expected").alias("e1"))
    by_stem = expected.select("doc_type", F.col("of").alias("stem"), F.col("expected").alias("e2"))
    return images.join(by_name, ["doc_type", "name"], "left").join(by_stem, ["doc_type", "stem"], "left").select("doc_type", "stem", "image", F.coalesce("e1", "e2").alias("expected"))


def canonical_pairs(files: DataFrame, path: str = "path") -> DataFrame:
    """id, image, expected of the images that have an `<id>.expected.md` beside them; the others are left out."""
    pairs = golden_pairs(files, path)
    return pairs.where(F.regexp_replace("expected", r"\.expected\.md$", "") == F.regexp_replace("image", r"\.[^.]+$", "")).select(F.col("stem").alias("id"), "image", "expected")


def newest(rows: DataFrame, name: str) -> DataFrame:
    """The row with the greatest name."""
    rest = [c for c in rows.columns]
    return rows.agg(F.max_by(F.struct(*rest), name).alias("r")).where("r IS NOT NULL").select("r.*")


def prompts(files: DataFrame, md: str = "md") -> DataFrame:
    """key, agent, version, last_modified, body, body_sha256, ok: ok is false where a required key is missing or blank."""
    from ..operators.records import split_prompt

    head, body = split_prompt(F.col(md))
    value = lambda k: F.coalesce(F.nullif(F.regexp_extract(head, rf"(?m)^{k}:[ \t]*['\"]?(.*?)['\"]?[ \t]*$", 1), F.lit("")), F.lit(""))
    out = files.select("key", value("agent").alias("agent"), value("version").alias("version"), value("last_modified").alias("last_modified"), body.alias("body"), F.sha2(body, 256).alias("body_sha256"))
    return out.withColumn("ok", (F.col("agent") != "") & (F.col("version") != "") & (F.col("last_modified") != "") & F.col("body").isNotNull())


def first_seen(rows: DataFrame, key: str, order: str) -> DataFrame:
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(order))).where("_n = 1").drop("_n")
