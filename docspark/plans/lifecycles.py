"""Extract, repair and evaluate as one plan each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..operators import evaluate, extract, gates, keyed, legacy, receipts, records
from ..streaming import limited

#: The receipt fields that canonical fixtures pin.
CANONICAL = ["receipt_debit_account_name", "receipt_debit_account_number", "receipt_credit_account_name", "receipt_credit_account_number"]


def extract_new(keys: DataFrame, done: DataFrame, call: Callable = extract.rule_extractor, config: DataFrame | None = None, version: str = evaluate.VERSION, timestamp: str | None = None, rate: float | None = None, **options) -> DataFrame:
    """A row for each key of keys (key, doc_type, text): skipped where an analysis exists, else the extractor's result. `ordinal` is the key's own, else its place among all keys.

    With config (doc_type, provider, model, prompt_version), records hold their provenance. With
    a rate, at most so many calls a second are made, by `concurrency` lanes that wait in state.
    """
    if "ordinal" not in keys.columns:
        keys = keyed.placed(keys, ["key"])
    if rate is None:
        results = extract.extract(keyed.pending(keys, done), call, **options)
    else:
        results = limited.extract_limited(keyed.pending(keys, done), call, rate, options.pop("concurrency", 10), **options).select("ordinal", "key", "doc_type", "fields", "status", "error", "attempts")
    if config is not None:
        results = extract.with_provenance(results, config, version, timestamp or evaluate.utc_now())
    old = keyed.skipped(keys, done).select("ordinal", "key", "doc_type", F.lit(None).cast("map<string,string>").alias("fields"), F.lit("skipped").alias("status"), F.lit("").alias("error"), F.array().cast(f"array<{extract.ATTEMPT}>").alias("attempts"))
    return results.unionByName(old)


def draft(texts: DataFrame, doc_type: str, column: str = "text", keep: list[str] | None = None) -> DataFrame:
    """keep columns, md and error of legacy texts (column) of one type: the rendered record, checked by reading it again; error tells what did not come back."""
    keep = keep or ["path"]
    names = [f.name for f in schemas.schema(doc_type) if f.dataType.typeName() == "string"]
    mapped = legacy.map_legacy(texts, doc_type, column, keep)
    drawn = records.render(mapped, doc_type).select(*keep, "md", F.struct(*names).alias("_want"))
    both = records.typed(records.parse(drawn), doc_type, [*keep, "md", "_want"])
    differs = F.filter(F.array(*[F.when(~F.col(n).eqNullSafe(F.col("_want")[n]), n) for n in names]), lambda x: x.isNotNull())
    return both.select(*keep, "md", F.when(F.col("error") != "", F.col("error")).when(F.size(differs) > 0, F.concat(F.lit("not read back: "), F.array_join(differs, ", "))).otherwise("").alias("error"))


def verify(results: DataFrame, keys: DataFrame, call: Callable, **options) -> DataFrame:
    """Second extraction of the types that are verified: key, audits (field -> verdict) and overall, from results (key, doc_type, fields, status) and keys (key, doc_type, text)."""
    mine = results.where((F.col("status") == "passed") & F.col("doc_type").isin(schemas.VERIFIED)).select("key", F.col("fields").alias("first"))
    second = extract.extract(keys.join(mine.select("key"), "key", "left_semi"), call, **options).select("key", F.col("fields").alias("second"))
    both = mine.join(second, "key")
    names = F.filter(F.map_keys("first"), lambda n: ~n.isin([*schemas.PROVENANCE, "doc_type"]))
    audits = F.map_from_entries(F.transform(names, lambda n: F.struct(n.alias("key"), gates.verdict(F.try_element_at(F.col("first"), n), F.try_element_at(F.col("second"), n)).alias("value"))))
    return both.select("key", audits.alias("audits")).withColumn("overall", gates.overall(F.col("audits")))


def verify_canonical(pairs: DataFrame, texts: DataFrame, actual: DataFrame, fields: list[str] = CANONICAL) -> DataFrame:
    """id, field, expected, actual of every pinned field that differs, and (id, '', error) rows for fixtures that cannot be read.

    pairs: id, image, expected; texts: path, md of the expected files; actual: id and the fields as they were extracted.
    """
    read = records.parse(pairs.join(texts.select(F.col("path").alias("expected"), "md"), "expected", "left"))
    bad = read.where("error <> '' AND md IS NOT NULL AND fields IS NULL OR error = 'no frontmatter' OR error = 'no yaml' OR error = 'no mapping'")
    value = lambda c, f: F.coalesce(F.try_element_at(c, F.lit(f)), F.lit(""))
    good = read.join(bad.select("id"), "id", "left_anti").select("id", F.explode(F.map_from_entries(F.array(*[F.struct(F.lit(f).alias("key"), value(F.col("fields"), f).alias("value")) for f in fields]))).alias("field", "expected"))
    long = actual.select("id", F.explode(F.map_from_entries(F.array(*[F.struct(F.lit(f).alias("key"), F.coalesce(F.col(f), F.lit("")).alias("value")) for f in fields]))).alias("field", "actual"))
    compared = good.join(long, ["id", "field"], "left").withColumn("actual", F.coalesce("actual", F.lit(""))).where("expected <> actual").select("id", "field", "expected", "actual")
    return compared.unionByName(bad.select("id", F.lit("").alias("field"), F.col("error").alias("expected"), F.lit("").alias("actual")))


def repair_receipts(store: DataFrame) -> DataFrame:
    """key, md, layout, changed of store (key, md): receipt fields are read from the whole text again and merged into the frontmatter; the body keeps its bytes. Unmatched texts stay as they are, with layout `none`."""
    head, body = records.split_lines(F.col("md"))
    parsed = records.with_head(receipts.parse_either(store, "md"), head)
    names = receipts.FIELDS
    flat = parsed.select("key", "md", "_head", "layout", *names, *[F.try_element_at(F.col("_fields"), F.lit(n)).alias("old_" + n) for n in names], "_fields")
    merged = receipts.merge_filled(flat, names)
    new = F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.array(*[F.col("merged_" + n) for n in names]))
    kept = F.map_filter("_fields", lambda k, v: ~k.isin(names))
    fixable = (F.col("layout") != "none") & F.col("_head").isNotNull()
    drawn = records.with_yaml(merged, F.when(fixable, F.map_concat(kept, new)), "_yaml")
    rendered = F.concat(F.lit("---\n"), F.col("_yaml"), F.lit("---\n"), body)
    return drawn.select("key", F.when(fixable, rendered).otherwise(F.col("md")).alias("md"), "layout", "changed")


def evaluate_run(expected: DataFrame, actual: DataFrame, keys: list[str], floors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Comparison rows and the fields below their floor."""
    results = evaluate.compare(expected, actual, keys)
    return results, gates.breaches(evaluate.by_field(results), floors)
