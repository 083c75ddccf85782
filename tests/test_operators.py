"""Keyed operators, evaluation, gates, boundary, sources and streams."""

import json
import os
import re

import pytest
from pyspark.sql import functions as F

from docspark.operators import evaluate, extract, gates, keyed
from docspark.plans import lifecycles
from docspark.sources import files, store
from docspark.streaming import ingest

ROWS = [
    ("Passport", "dob", "a", "a", True, "AU"), ("Passport", "dob", "b", "c", False, "CN"), ("Passport", "no", "1", "1", True, "AU"), ("Passport", "no", "2", "2", True, "CN"),
    ("PaymentReceipt", "amount", "1", "1", True, "AU"), ("PaymentReceipt", "amount", "2", "2", True, "CN"), ("PaymentReceipt", "time", "x", "y", False, "AU"), ("PaymentReceipt", "time", "x", "z", False, "CN"),
]


def results(spark):
    rows = [(i, *r, 0.001) for i, r in enumerate(ROWS)]
    return spark.createDataFrame(rows, "doc_key int, agent string, field string, expected string, actual string, matched boolean, jurisdiction string, cost_usd double")


def test_scorecard(spark):
    got = {r["agent"]: r for r in evaluate.by_agent(results(spark)).collect()}
    assert (got["Passport"]["precision"], got["Passport"]["recall"], got["Passport"]["field_coverage"], got["Passport"]["examples"]) == (0.75, 0.75, 1.0, 4)
    assert (got["PaymentReceipt"]["precision"], got["PaymentReceipt"]["field_coverage"]) == (0.5, 0.5)
    rate = {(r["agent"], r["field"]): r["match_rate"] for r in evaluate.by_field(results(spark)).collect()}
    assert rate["Passport", "dob"] == 0.5
    place = {(r["jurisdiction"], r["agent"]): r["precision"] for r in evaluate.by_jurisdiction(results(spark)).collect()}
    assert place["AU", "Passport"] == 1.0 and place["CN", "PaymentReceipt"] == 0.5
    total = evaluate.totals(results(spark)).first()
    assert total["examples"] == 8 and abs(total["total_cost_usd"] - 0.008) < 1e-12
    card = json.loads(evaluate.scorecard_json(results(spark)).first()["scorecard"])
    assert card["per_agent"]["Passport"]["examples"] == 4 and card["per_field"]["Passport"]["dob"]["match_rate"] == 0.5
    one = evaluate.in_one_pass(results(spark))
    assert {r["level"]: r["count"] for r in one.groupBy("level").count().collect()} == {"agent": 2, "field": 4, "jurisdiction": 4, "total": 1}


def test_thresholds(spark):
    rates = evaluate.by_field(results(spark))
    floors = gates.floor_table(spark, {"Passport": {"no": 1.0}})
    assert {(r["agent"], r["field"]) for r in gates.breaches(rates, floors, 0.6).collect()} == {("Passport", "dob"), ("PaymentReceipt", "time")}


@pytest.mark.parametrize("costs,records,passed", [([(d, 0.025, True) for d in range(1, 8)], 7, True), ([(d, 0.05, True) for d in range(1, 8)], 7, False), ([(d, 0.02, True) for d in range(2, 9)] + [(1, 0.5, True)], 7, True), ([(1, 0.02, True)] * 5 + [(1, 1.0, False)] * 20, 5, True), ([], 0, True)])
def test_median_gate(spark, costs, records, passed):
    frame = spark.createDataFrame([(f"2026-01-{d:02d}", c, ok) for d, c, ok in costs], "event_date string, cost_usd double, success boolean")
    got = gates.median_gate(frame).first()
    assert (got["records"], got["passed"]) == (records, passed)


@pytest.mark.parametrize("audits,want", [({}, "pass"), ({"a": "agree"}, "pass"), ({"a": "disagree", "b": "abstain"}, "fail"), ({"a": "agree", "b": "abstain"}, "uncertain")])
def test_verdicts(spark, audits, want):
    frame = spark.createDataFrame([(audits,)], "m map<string,string>")
    assert frame.select(gates.overall(F.col("m"))).first()[0] == want


def test_overlay_and_upsert(spark):
    keys = spark.createDataFrame([("a",), ("b",), ("c",)], "key string")
    fixed, canon = spark.createDataFrame([("a", "A1")], "key string, md string"), spark.createDataFrame([("a", "A0"), ("b", "B0")], "key string, md string")
    assert {r["key"]: (r["md"], r["origin"]) for r in keyed.overlay(keys, fixed, canon).collect()} == {"a": ("A1", "correction"), "b": ("B0", "canonical"), "c": (None, "missing")}
    log = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "key string, ts int, v string")
    assert {(r["key"], r["v"]) for r in keyed.upsert(log, ["key"], [F.col("ts")]).collect()} == {("a", "y"), ("b", "z")}


def test_attempts():
    calls = []

    def flaky(row, tier):
        calls.append(tier)
        if len(calls) < 3:
            raise extract.RateLimited
        return {"a": "1"}

    waits = []
    fields, status, _, made = extract.attempt(flaky, {}, "t", {}, "x", sleep=waits.append)
    assert (fields, status, len(made)) == ({"a": "1"}, "passed", 3) and 1 <= waits[0] <= 2 and 2 <= waits[1] <= 3

    def invalid(row, tier):
        if tier != "big":
            raise extract.Invalid("no")
        return {}

    assert [a["tier"] for a in extract.attempt(invalid, {}, "small", {"small": "big"}, "x")[3]] == ["small", "big"]
    assert extract.attempt(invalid, {}, "small", {}, "x")[1] == "failed"
    assert extract.attempt(lambda r, t: 1 / 0, {}, "t", {}, "x")[1] == "provider_unavailable"
    with pytest.raises(ValueError):
        extract.attempt(invalid, {}, "t", {}, "x", tries=0)


def test_extract_new(spark):
    def call(row, tier):
        if row["key"] == "c":
            raise extract.RateLimited
        return extract.rule_extractor(row, tier)

    keys = spark.createDataFrame([("a", "Other", "Notes: n"), ("b", "Other", ""), ("c", "Other", "")], "key string, doc_type string, text string")
    done = spark.createDataFrame([("b",)], "key string")
    got = {r["key"]: r for r in lifecycles.extract_new(keys, done, call, base=0.0).collect()}
    assert {k: r["status"] for k, r in got.items()} == {"a": "passed", "b": "skipped", "c": "rate_limited"}
    assert got["a"]["fields"] == {"notes": "n"} and len(got["c"]["attempts"]) == 3


def test_repair(spark):
    pytest.importorskip("yaml")
    md = "---\ndoc_type: PaymentReceipt\nreceipt_amount: '1'\n---\n\n金额: 25.00\n付款人: 王\n  tail "
    store = spark.createDataFrame([("k", md), ("n", "---\na: b\n---\nnothing")], "key string, md string")
    got = {r["key"]: r for r in lifecycles.repair_receipts(store).collect()}
    assert got["k"]["md"].endswith("---\n\n金额: 25.00\n付款人: 王\n  tail ") and "receipt_amount: '25.00'" in got["k"]["md"]
    assert got["k"]["changed"] == ["receipt_amount", "receipt_debit_account_name"]
    assert got["n"]["layout"] == "none" and got["n"]["md"] == "---\na: b\n---\nnothing"


def test_sources(spark, tmp_path):
    root = tmp_path / "store"
    (root / "d").mkdir(parents=True)
    (root / "d" / "x.pdf").write_bytes(b"p1\fp2")
    (root / "y.md").write_text("---\na: b\n---\nbody\n")
    rows = {r["key"]: r for r in files.manifest(spark, str(root)).collect()}
    assert rows["d/x.pdf"]["content_type"] == "application/pdf" and rows["d/x.pdf"]["size"] == 5
    assert files.texts(spark, str(root)).first()["md"].endswith("body\n")
    pages = extract.pages(files.contents(spark, str(root)).where("key LIKE '%pdf'").withColumn("mode", F.lit("all_pages")))
    assert [(r["page_no"], bytes(r["png"])) for r in pages.orderBy("page_no").collect()] == [(0, b"p1"), (1, b"p2")]
    keys = tmp_path / "keys.txt"
    keys.write_text("a\n\n # no\n b \n")
    assert [r["key"] for r in files.keys_file(spark, str(keys)).collect()] == ["a", "b"]
    line = {"timestamp": "2026-01-02T00:00:00Z", "source_key": "k", "cost_usd": 0.1, "success": True}
    files.append_telemetry(spark.createDataFrame([("2026-01-02T00:00:00Z", "k", 0.1, True, None)], "timestamp string, source_key string, cost_usd double, success boolean, model string"), str(tmp_path / "t"))
    with open(tmp_path / "t" / "event_date=2026-01-02" / "bad.json", "w") as f:
        f.write("{broken\n\n" + json.dumps(line) + "\n")
    assert files.read_telemetry(spark, str(tmp_path / "t")).count() == 2
    prompt = spark.createDataFrame([("p", "---\nagent: a\nversion: '1'\nlast_modified: x\n---\n\nBody"), ("q", "---\nagent:\nversion: 1\n---\nB")], "key string, md string")
    assert [(r["ok"], r["body"]) for r in files.prompts(prompt).orderBy("key").collect()] == [(True, "Body"), (False, "B")]


def test_streams(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.createDataFrame([("a", "2026-01-01 10:00:00", True, 0.1), ("a", "2026-01-01 11:00:00", True, 0.1), ("b", "2026-01-02 10:00:00", False, 0.2)], "key string, t string, success boolean, cost_usd double").withColumn("ts", F.to_timestamp("t")).write.parquet(src)
    schema = spark.read.parquet(src).schema
    q = ingest.once_per_key(spark.readStream.schema(schema).parquet(src)).writeStream.format("memory").queryName("once").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert {r["key"] for r in spark.sql("SELECT key FROM once").collect()} == {"a", "b"} and spark.table("once").count() == 2
    q = ingest.daily(spark.readStream.schema(schema).parquet(src)).writeStream.format("memory").queryName("daily").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert {str(r["day"]): r["records"] for r in spark.table("daily").collect()} == {"2026-01-01": 2, "2026-01-02": 1}
    order = []
    audited = spark.readStream.schema(schema).parquet(src).withColumn("overall", F.when(F.col("success"), "pass").otherwise("fail"))
    ingest.ordered_sinks(audited, lambda d: order.append(("disagreements", d.count())), lambda d: order.append(("records", d.count())), str(tmp_path / "c")).awaitTermination(60)
    assert order == [("disagreements", 1), ("records", 3)]


def test_store_overwrites_by_key(spark, tmp_path):
    root = str(tmp_path / "store")
    first = spark.createDataFrame([("a/x", "旧"), ("b", "B")], "key string, md string")
    assert store.put_analyses(first, root).isEmpty()
    for _ in range(2):  # a repeated write changes nothing
        assert store.put_analyses(spark.createDataFrame([("a/x", "新文\n")], "key string, md string"), root).isEmpty()
    assert (tmp_path / "store" / "a" / "x.md").read_bytes() == "新文\n".encode() and (tmp_path / "store" / "b.md").read_text() == "B"
    rows = spark.createDataFrame([("k", None, "rate_limited"), ("l", "p", "fail")], "key string, primary string, status string")
    assert store.put_disagreements(rows, root).isEmpty()
    assert json.loads((tmp_path / "store" / "disagreements" / "k.json").read_text()) == {"key": "k", "primary": None, "status": "rate_limited"}
    assert sorted(f.name for f in (tmp_path / "store").rglob("*") if f.is_file()) == ["b.md", "k.json", "l.json", "x.md"]
    blocked = tmp_path / "file"
    blocked.write_text("")
    assert {r["key"] for r in store.put_analyses(first, str(blocked)).collect()} == {"a/x.md", "b.md"}
    (tmp_path / "store" / "b.md").unlink()
    (tmp_path / "store" / "b.md").mkdir()  # one object cannot be written: the other is, and nothing is left behind
    (tmp_path / "store" / "b.md" / "x").write_text("")
    many = spark.createDataFrame([("a/x", "zz", 1), ("a/x", "a", 2), ("b", "B", 1)], "key string, md string, n int")
    assert [r["key"] for r in store.put_analyses(many, root, [F.col("n")]).collect()] == ["b.md"]
    assert (tmp_path / "store" / "a" / "x.md").read_text() == "a" and not (tmp_path / "store" / ".parts").exists()


def test_flush_is_repeatable_and_never_raises(spark, tmp_path):
    (tmp_path / "staged").mkdir()
    (tmp_path / "staged" / "2026-01-01.jsonl").write_text('{"a": 1}\n')
    for _ in range(2):
        assert store.flush_telemetry(spark, str(tmp_path / "staged"), str(tmp_path / "out")).isEmpty()
    assert [f.read_text() for f in (tmp_path / "out" / "telemetry").iterdir()] == ['{"a": 1}\n']
    assert store.flush_telemetry(spark, str(tmp_path / "nowhere"), str(tmp_path / "out")).count() == 1


def test_records_of_a_key(spark, tmp_path):
    path = str(tmp_path / "records")
    at = lambda rows: spark.createDataFrame(rows, "key string, md string, t string").select("key", "md", F.to_timestamp("t").alias("written_at"))
    files.write_records(at([("a", "1", "2026-01-01"), ("b", "1", "2026-01-01")]), path)
    for _ in range(2):
        files.write_records(at([("a", "2", "2026-01-02")]), path)
    assert {(r["key"], r["md"]) for r in files.read_records(spark, path).collect()} == {("a", "2"), ("b", "1")} and files.read_records(spark, path).count() == 2


def test_order_cost_and_provenance(spark):
    rows = [(i, f"k{i}", "Visa", "Visa Class: B") for i in range(40)]
    keys = spark.createDataFrame(rows, "ordinal long, key string, doc_type string, text string").repartition(5)
    call = lambda row, tier: extract.Answer(extract.by_registry(row, tier), "svc", "", 0.5)
    for concurrency in (1, 50):
        got = extract.extract(keys, call, concurrency=concurrency).orderBy("ordinal").collect()
        assert [r["key"] for r in got] == [r[1] for r in rows] and got[3]["attempts"][0]["cost_usd"] == 0.5
    assert keys.rdd.getNumPartitions() == extract.extract(keys, call, concurrency=50).rdd.getNumPartitions()
    config = spark.createDataFrame([("Visa", "file", "m-1", "visa@1")], "doc_type string, provider string, model string, prompt_version string")
    fields = extract.with_provenance(extract.extract(keys, call), config, "9", "now").first()["fields"]
    assert (fields["extraction_provider"], fields["extraction_model"], fields["prompt_version"], fields["extractor_version"], fields["visa_class"]) == ("svc", "m-1", "visa@1", "9", "B")


def test_strict_pairs(spark):
    keys = spark.createDataFrame([(0, "a"), (1, "b")], "ordinal int, key string")
    good = spark.createDataFrame([(1, "b", 2), (0, "a", 1)], "ordinal int, key string, n int")
    assert {(r["key"], r["result"]["n"]) for r in evaluate.paired(keys, good).collect()} == {("a", 1), ("b", 2)}
    for bad in ([(0, "a", 1)], [(0, "a", 1), (1, "c", 1)], [(0, "a", 1), (1, "b", 1), (2, "c", 1)]):
        with pytest.raises(Exception, match="do not correspond"):
            evaluate.paired(keys, spark.createDataFrame(bad, "ordinal int, key string, n int")).collect()


def test_whole_scorecard(spark):
    card = json.loads(evaluate.pretty(evaluate.scorecard_json(results(spark), ceiling=0.001, timestamp="t").first()["scorecard"]))
    assert card["total_examples"] == 8 and abs(card["total_cost_usd"] - 0.008) < 1e-12 and card["cost_breach"] is True
    assert (card["extractor_version"], card["run_timestamp"]) == (evaluate.VERSION, "t") and list(card["per_agent"]) == ["Passport", "PaymentReceipt"]
    empty = json.loads(evaluate.scorecard_json(results(spark).where("false")).first()["scorecard"])
    assert empty["total_examples"] == 0 and empty["cost_breach"] is False and empty["per_agent"] == {}
    assert re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", evaluate.utc_now())


def test_nothing_else_imports_llm():
    root = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docspark")
    for folder, _, names in os.walk(root):
        if not folder.startswith(os.path.join(root, "llm")):
            for name in names:
                if name.endswith(".py"):
                    assert not re.search(r"\bllm\b", open(os.path.join(folder, name)).read())


def test_objects_are_listed_and_read_by_tasks(spark, tmp_path):
    """The driver holds no list of files: the plans name none, however many there are."""
    root = tmp_path / "many"
    rows = spark.range(2_500).selectExpr("concat('a b/', id % 3, '/k', id) AS key", "concat('t', id) AS md")
    assert store.put_analyses(rows, str(root)).count() == 0
    (root / "_hidden").mkdir()
    (root / "_hidden" / "x.md").write_text("x")
    (root / ".y.md").write_text("y")
    (root / "z.pdf").write_bytes(b"\xff\x00")
    for root_ in (str(root), f"file://{root}", f"{root}/"):
        frames = [files.manifest(spark, root_), files.texts(spark, root_), files.contents(spark, root_)]
        assert [f.inputFiles() for f in frames] == [[], [], []]
        assert [f.count() for f in frames] == [2_501, 2_500, 2_501]
    texts = {r["key"]: r["md"] for r in files.texts(spark, str(root)).collect()}
    assert texts == {f"a b/{i % 3}/k{i}.md": f"t{i}" for i in range(2_500)}
    found = {r["key"]: r for r in files.manifest(spark, str(root)).collect()}
    assert found["z.pdf"]["size"] == 2 and found["z.pdf"]["content_type"] == "application/pdf" and found["z.pdf"]["uri"] == f"file:{root}/z.pdf"
    assert bytes(files.contents(spark, str(root)).where("key = 'z.pdf'").first()["content"]) == b"\xff\x00"
