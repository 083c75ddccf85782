"""Command line: extract, repair, eval, gate. Exit codes: 0 well, 1 a gate failed, 2 wrong use."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import functions as F

from . import schemas
from .operators import classify, evaluate, extract, gates, legacy, records
from .plans import lifecycles
from .session import session
from .sources import config, files, store


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="docspark")
    sub = top.add_subparsers(dest="command", required=True)
    p = sub.add_parser("extract", help="extract texts that have no analysis yet")
    which = p.add_mutually_exclusive_group(required=True)
    which.add_argument("--key")
    which.add_argument("--keys-file")
    p.add_argument("--source", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--concurrency", type=int, default=10)
    p.add_argument("--rate", type=float, help="calls a second that the service allows; rows then wait for their turn in state")
    p.add_argument("--dry-run", action="store_true")
    p.add_argument("--verbose", action="store_true", help="show the plan first")
    p.add_argument("--show-image", action="store_true", help="show the addresses of the sources")
    p.add_argument("--disagreements", help="store that gets a record of each failed key")
    p = sub.add_parser("repair", help="read receipt fields again from stored records")
    p.add_argument("--store", required=True)
    p.add_argument("--out", required=True)
    p = sub.add_parser("eval", help="scorecard of expected against extracted records")
    p.add_argument("--expected", required=True)
    p.add_argument("--actual", required=True)
    p.add_argument("--doc-type")
    p.add_argument("--jurisdiction")
    p.add_argument("--thresholds")
    p.add_argument("--out")
    p = sub.add_parser("verify-canonical", help="compare the four pinned receipt fields with the expected ones")
    p.add_argument("--fixtures", required=True)
    p.add_argument("--mocked", action="store_true", help="take the expected fields as extracted")
    p.add_argument("--actual", help="folder of extracted records, named like the expected ones")
    p = sub.add_parser("drafts", help="records drafted from legacy texts, each read back before it is written")
    p.add_argument("--legacy", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--doc-type", choices=schemas.DOC_TYPES, required=True)
    p.add_argument("--per-type", type=int, default=3)
    p = sub.add_parser("cost", help="median cost of the newest seven days")
    p.add_argument("--telemetry", required=True)
    p.add_argument("--ceiling", type=float, default=gates.MEDIAN_CEILING)
    return top


def _extract(spark, args) -> int:
    keys = files.numbered_keys(spark, args.keys_file) if args.keys_file else spark.createDataFrame([(0, args.key)], "ordinal long, key string")
    keys = keys.groupBy("key").agg(F.min("ordinal").alias("ordinal"))
    texts = files.texts(spark, args.source, "").join(keys, "key").withColumnRenamed("md", "text")
    typed = classify.classify(texts)
    if args.show_image:
        for r in files.manifest(spark, args.source).join(keys, "key", "left_semi").select("uri").orderBy("uri").collect():  # the keys of one run
            print(r["uri"])
    try:
        done = spark.read.parquet(args.out).select("key")
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        done = keys.where("false")
    agents = [(t, *(config.resolve(schemas.slug(t))[k] for k in ("provider", "model")), f"{schemas.slug(t)}@{evaluate.VERSION}") for t in schemas.DOC_TYPES]
    dimension = spark.createDataFrame(agents, "doc_type string, provider string, model string, prompt_version string")
    results = lifecycles.extract_new(typed, done, extract.by_registry, dimension, rate=args.rate, concurrency=args.concurrency)
    if args.verbose:
        results.explain("formatted")
    if args.dry_run:
        results.orderBy("ordinal").show(truncate=False)
        return 0
    new = results.where("status <> 'skipped'").persist()
    try:
        if args.disagreements:  # before the records, so that a failed key is never taken for a finished one
            store.put_disagreements(extract.failures(new, evaluate.VERSION, evaluate.utc_now()), args.disagreements)
        new.write.mode("append").parquet(args.out)
    finally:
        new.unpersist()
    return 0


def _canonical(spark, args) -> int:
    found = files.manifest(spark, args.fixtures).select(F.col("key"), F.concat(F.lit("/f/"), F.col("key")).alias("path"))
    pairs = files.canonical_pairs(found)
    n = pairs.count()
    if not n:
        print("no canonical fixtures yet")
        return 0
    if not args.mocked and not args.actual:
        print("no extracted records are named, so nothing is compared; --mocked checks the fixtures alone")
        return 0
    texts = files.texts(spark, args.fixtures).withColumn("path", F.concat(F.lit("/f/"), F.col("key")))
    from_ = texts.withColumn("id", F.regexp_replace("key", r"^.*/|\.expected\.md$", "")) if args.mocked else files.texts(spark, args.actual).withColumn("id", F.regexp_replace("key", r"^.*/|(\.expected)?\.md$", ""))
    parsed = records.parse(from_)
    actual = parsed.select("id", *[F.try_element_at("fields", F.lit(f)).alias(f) for f in lifecycles.CANONICAL])
    failed = lifecycles.verify_canonical(pairs, texts, actual).orderBy("id", "field").collect()  # the fixtures are few
    for r in failed:
        print(f"{r['id']}.{r['field']}: expected {r['expected']!r}, extracted {r['actual']!r}" if r["field"] else f"{r['id']}: {r['expected']}")
    print(f"{n} pairs compared, {len(failed)} differences")
    return int(bool(failed))


def _drafts(spark, args) -> int:
    texts = drafts(spark, args.legacy, args.per_type).where(F.col("slug") == schemas.slug(args.doc_type))
    made = lifecycles.draft(texts, args.doc_type).persist()
    bad = made.where("error <> ''").orderBy("path").collect()  # per_type at most
    for r in bad:
        print(f"{r['path']}: {r['error']}")
    store.put(made.where("error = ''"), args.out, F.concat(F.lit(schemas.slug(args.doc_type) + "/"), F.regexp_replace("path", r"\.md$", ""), F.lit(".expected.md")), F.col("md"))
    made.unpersist()
    return int(bool(bad))


def _long(spark, path: str, doc_type: str | None, value: str):
    parsed = records.parse(files.texts(spark, path)).where("error = ''")
    if doc_type:
        parsed = parsed.where(F.col("doc_type") == doc_type)
    rows = parsed.select("key", F.coalesce("doc_type", F.lit("")).alias("agent"), F.try_element_at("fields", F.lit("jurisdiction")).alias("jurisdiction"), F.explode("fields").alias("field", value))
    return rows.where(~F.col("field").isin(evaluate.PROVENANCE))


def _eval(spark, args) -> int:
    want, got = _long(spark, args.expected, args.doc_type, "expected"), _long(spark, args.actual, args.doc_type, "actual")
    want = evaluate.selected(want, args.jurisdiction)
    keys = want.select("key", "agent", "jurisdiction").distinct()
    both = want.select("key", "field", "expected").join(got.select("key", "field", "actual").join(keys.select("key"), "key", "left_semi"), ["key", "field"], "full_outer").join(keys, "key")
    results = both.na.fill("", ["expected", "actual", "jurisdiction"]).where("expected <> '' OR actual <> ''").withColumn("matched", F.col("expected") == F.col("actual"))
    card = evaluate.scorecard_json(results).collect()
    text = evaluate.pretty(card[0]["scorecard"])
    breach = json.loads(text)["cost_breach"]
    if args.out:
        with open(args.out, "w", encoding="utf-8") as f:
            f.write(text + "\n")
    else:
        print(text)
    if not args.thresholds:
        return int(breach)
    floors, default = config.thresholds(spark, args.thresholds)
    below = gates.breach_lines(gates.breaches(evaluate.by_field(results), floors, default)).orderBy("line").collect()
    for r in below:
        print(r["line"])
    return int(bool(below) or breach)


def _cost(spark, args) -> int:
    got = gates.median_gate(files.newest_telemetry(spark, args.telemetry), ceiling=args.ceiling).first()
    print("no successful records, nothing to check" if got["median_usd"] is None else f"median ${got['median_usd']:.4f}, limit ${args.ceiling:.2f}, {got['records']} records over {got['days']} days")
    return int(not got["passed"])


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = session()
    if args.command == "extract":
        return _extract(spark, args)
    if args.command == "repair":
        lifecycles.repair_receipts(files.texts(spark, args.store)).write.mode("overwrite").parquet(args.out)
        return 0
    return {"eval": _eval, "cost": _cost, "verify-canonical": _canonical, "drafts": _drafts}[args.command](spark, args)


def drafts(spark, root: str, per_type: int = 3):
    """path, slug, nth, text of the first legacy texts of each type, read as far as the type label needs."""
    return legacy.first_per_type(files.texts(spark, root).withColumnsRenamed({"key": "path", "md": "text"}), per_type)


if __name__ == "__main__":
    sys.exit(main())
