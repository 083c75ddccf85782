"""Key-based incremental operators: skip, overlay, upsert, ordinals, dispatch, baselines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written


def analysis_key(key: Column) -> Column:
    return F.concat(key, F.lit(".md"))


def disagreement_key(key: Column) -> Column:
    return F.concat(F.lit("disagreements/"), key, F.lit(".json"))


def correction_key(key: Column) -> Column:
    return F.concat(F.lit("corrections/"), key, F.lit(".md"))


def is_pdf(content_type: Column, key: Column) -> Column:
    return F.lower(F.coalesce(content_type, F.lit(""))).startswith("application/pdf") | F.lower(key).endswith(".pdf")


def pdf_mode(doc_type: Column) -> Column:
    return F.when(doc_type == "BankStatement", "all_pages").otherwise("page1")


def status(skipped: Column) -> Column:
    return F.when(skipped, "skipped").otherwise("extracted")


def pending(keys: DataFrame, done: DataFrame, key: str = "key") -> DataFrame:
    """Keys without an analysis."""
    return keys.join(done.select(key), key, "left_anti")


def skipped(keys: DataFrame, done: DataFrame, key: str = "key") -> DataFrame:
    return keys.join(done.select(key), key, "left_semi")


def overlay(keys: DataFrame, corrections: DataFrame, canonical: DataFrame, key: str = "key", value: str = "md") -> DataFrame:
    """key, value, origin: the correction, else the canonical record, else a `missing` row."""
    out = keys.select(key).join(corrections.select(key, F.col(value).alias("_c")), key, "left").join(canonical.select(key, F.col(value).alias("_k")), key, "left")
    origin = F.when(F.col("_c").isNotNull(), "correction").when(F.col("_k").isNotNull(), "canonical").otherwise("missing")
    return out.select(key, F.coalesce("_c", "_k").alias(value), origin.alias("origin"))


def upsert(rows: DataFrame, key: list[str], newest: list[Column]) -> DataFrame:
    """The last row written for each key. A maximum of structs, so copies of a hot key are merged before the shuffle."""
    rest = [c for c in rows.columns if c not in key]
    best = rows.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*newest)).alias("_row"))
    return best.select(*key, *[F.col("_row")[c].alias(c) for c in rest]).select(*rows.columns)


def ordinals(rows: DataFrame, key: list[str], order: list[Column], name: str = "ordinal") -> DataFrame:
    """Position of each row within its key, from 0."""
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*key).orderBy(*order)) - 1)


def placed(rows: DataFrame, order: list[str], name: str = "ordinal") -> DataFrame:
    """Place of each row in the whole of rows by the order columns, from 0 without gaps; rows alike in those stand by their other columns' hash.

    The places are the same however rows are partitioned, and are computed once: rows are
    sorted in ranges and written, ranges are counted, and each row adds the rows before its
    range to its place in it.
    """
    rest = [f.name for f in rows.schema if f.name not in order and not f.dataType.simpleString().startswith("map")]
    sorted_ = rows.withColumn("_tie", F.xxhash64(*rest) if rest else F.lit(0)).repartitionByRange(*order, "_tie").sortWithinPartitions(*order, "_tie").drop("_tie")
    own = F.monotonically_increasing_id() % (1 << 33)  # the place within a task
    kept = written(sorted_.select("*", F.spark_partition_id().alias("_range"), own.alias("_own")))
    counts = kept.groupBy("_range").agg(F.count("*").alias("_n"))  # one row a task
    before = counts.select("_range", (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).alias("_before"))
    return kept.join(F.broadcast(before), "_range").select(*[c for c in rows.columns if c != name], (F.col("_before") + F.col("_own")).alias(name))


def bucketed(rows: DataFrame, name: str, key: str = "key", buckets: int = 64, path: str | None = None) -> DataFrame:
    """rows saved as table `name`, bucketed and sorted by key. Two tables with as many buckets join and skip on that key without moving a row."""
    writer = rows.write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return rows.sparkSession.table(name)


def newest_groups(rows: DataFrame, group: str, n: int) -> DataFrame:
    """Rows of the n newest values of a column; the values are found from their distinct list."""
    newest = rows.select(group).distinct().orderBy(F.desc(group)).limit(n)
    return rows.join(newest, group, "left_semi")


def dispatch(rows: DataFrame, registry: DataFrame, column: str = "doc_type") -> DataFrame:
    """Rows with their registry entry; `registered` is false, and the entry null, for types the registry lacks."""
    return rows.join(registry.withColumn("registered", F.lit(True)), column, "left").withColumn("registered", F.coalesce("registered", F.lit(False)))


def resolve(agents: DataFrame, layers: list[DataFrame], fallback: Column, column: str = "model") -> DataFrame:
    """agent, column, used_fallback. layers (agent, column) in order of precedence; empty values defer to the next."""
    out = agents.select("agent")
    names = []
    for i, layer in enumerate(layers):
        names.append(f"_{i}")
        out = out.join(layer.select("agent", F.nullif(F.col(column), F.lit("")).alias(names[-1])), "agent", "left")
    found = F.coalesce(*names)
    return out.select("agent", F.coalesce(found, fallback).alias(column), found.isNull().alias("used_fallback"))


def env_key(field: str, agent: str, prefix: str = "DOCSPARK") -> str:
    return f"{prefix}_{field}_{agent}".upper()


def baseline_diff(now: DataFrame, before: DataFrame, key: str = "name") -> DataFrame:
    """key, change: new, removed, version, body or same. Both sides: key, version, body_sha256."""
    a, b = now.select(key, F.col("version").alias("v1"), F.col("body_sha256").alias("h1")), before.select(key, F.col("version").alias("v0"), F.col("body_sha256").alias("h0"))
    change = F.when(F.col("h0").isNull(), "new").when(F.col("h1").isNull(), "removed").when(F.col("v0") != F.col("v1"), "version").when(F.col("h0") != F.col("h1"), "body").otherwise("same")
    return a.join(b, key, "full_outer").select(key, change.alias("change"))


def autofill(df: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Defaults where a column is null or empty; what the caller set stays."""
    return df.withColumns({n: F.when(F.coalesce(F.col(n), F.lit("")) == "", d).otherwise(F.col(n)) for n, d in defaults.items()})
