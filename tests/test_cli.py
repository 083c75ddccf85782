"""Command line, configuration and classification."""

import json

import pytest

from docspark import cli, schemas
from docspark.operators import classify, extract
from docspark.sources import config

yaml = pytest.importorskip("yaml")


def record(path, **fields):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("---\n" + yaml.safe_dump(fields, allow_unicode=True) + "---\n\n")


def test_eval_and_gate(spark, tmp_path):
    for i in range(4):
        record(tmp_path / "want" / f"{i}.md", doc_type="Visa", jurisdiction="NZ", visa_class="A", valid_to="2030", extraction_model="x")
        record(tmp_path / "got" / f"{i}.md", doc_type="Visa", jurisdiction="NZ", visa_class="A" if i else "B", valid_to="2030", extraction_model="y")
    limits = tmp_path / "limits.yaml"
    limits.write_text("_default: 0.9\nVisa:\n  visa_class: 0.7\n")
    args = ["eval", "--expected", str(tmp_path / "want"), "--actual", str(tmp_path / "got"), "--thresholds", str(limits), "--out", str(tmp_path / "card.json")]
    assert cli.main(args) == 0
    card = json.loads((tmp_path / "card.json").read_text())
    assert card["per_field"]["Visa"]["visa_class"]["match_rate"] == 0.75 and "extraction_model" not in card["per_field"]["Visa"]
    limits.write_text("Visa:\n  visa_class: 0.8\n")
    assert cli.main([*args, "--jurisdiction", "NZ", "--doc-type", "Visa"]) == 1
    with pytest.raises(FileNotFoundError):
        config.thresholds(spark, tmp_path / "none.yaml")
    with pytest.raises(SystemExit) as wrong:
        cli.main(["extract"])
    assert wrong.value.code == 2


def test_extract_repair_cost(spark, tmp_path, capsys):
    source = tmp_path / "source"
    source.mkdir()
    (source / "a.txt").write_text("Passport\nP<NZLDOE\nPassport Number: E1")
    (source / "b.txt").write_text("nothing")
    keys = tmp_path / "keys"
    keys.write_text("a.txt\n# b.txt\nb.txt\n")
    out = str(tmp_path / "out")
    for _ in range(2):
        assert cli.main(["extract", "--keys-file", str(keys), "--source", str(source), "--out", out, "--concurrency", "2"]) == 0
    rows = {r["key"]: r for r in spark.read.parquet(out).collect()}
    assert spark.read.parquet(out).count() == 2 and rows["a.txt"]["fields"]["passport_number"] == "E1" and rows["b.txt"]["doc_type"] == "Other"
    (tmp_path / "store").mkdir()
    (tmp_path / "store" / "r.md").write_text("---\ndoc_type: PaymentReceipt\n---\n\n金额: 7\n")
    assert cli.main(["repair", "--store", str(tmp_path / "store"), "--out", str(tmp_path / "fixed")]) == 0
    assert spark.read.parquet(str(tmp_path / "fixed")).first()["layout"] == "cn"
    day = tmp_path / "t" / "event_date=2026-01-01"
    day.mkdir(parents=True)
    (day / "x.json").write_text(json.dumps({"timestamp": "2026-01-01T00:00:00Z", "cost_usd": 0.05, "success": True}) + "\nbroken\n")
    assert cli.main(["cost", "--telemetry", str(tmp_path / "t")]) == 1
    assert cli.main(["cost", "--telemetry", str(tmp_path / "t"), "--ceiling", "0.05"]) == 0
    assert [r["slug"] for r in cli.drafts(spark, str(source)).collect()] == []


def test_verify_canonical(spark, tmp_path, capsys):
    fixtures, actual = tmp_path / "fixtures", tmp_path / "actual"
    assert cli.main(["verify-canonical", "--fixtures", str(tmp_path), "--mocked"]) == 0
    for i in range(2):
        record(fixtures / f"r{i}.expected.md", receipt_debit_account_name="A", receipt_credit_account_number=None)
        (fixtures / f"r{i}.png").write_bytes(b"x")
        record(actual / f"r{i}.md", receipt_debit_account_name="A" if i else "B")
    (fixtures / "lone.png").write_bytes(b"x")
    args = ["verify-canonical", "--fixtures", str(fixtures)]
    assert cli.main(args) == 0 and cli.main([*args, "--mocked"]) == 0
    assert cli.main([*args, "--actual", str(actual)]) == 1
    assert "r0.receipt_debit_account_name: expected 'A', extracted 'B'" in capsys.readouterr().out
    (fixtures / "r1.expected.md").write_text("no fences")
    assert cli.main([*args, "--mocked"]) == 1 and "r1: no frontmatter" in capsys.readouterr().out


def test_drafts(spark, tmp_path):
    legacy = tmp_path / "legacy"
    legacy.mkdir()
    (legacy / "a.md").write_text("**Model:** `m`\nDOCUMENT_TYPE: Passport\nFIELDS:\n- Full Name: Ann 王\n- Passport Number: E1\nQUALITY: ok\n")
    assert cli.main(["drafts", "--legacy", str(legacy), "--out", str(tmp_path / "out"), "--doc-type", "Passport"]) == 0
    text = (tmp_path / "out" / "passport" / "a.expected.md").read_text()
    assert "passport_number: E1" in text and "王" in text


def test_failed_keys_are_recorded(spark, tmp_path, monkeypatch):
    source = tmp_path / "source"
    source.mkdir()
    (source / "a.txt").write_text("Passport\nP<NZLDOE\nPassport Number: E1")

    def refuse(row, tier):
        raise extract.RateLimited

    monkeypatch.setattr(extract, "by_registry", refuse)
    monkeypatch.setattr(extract.time, "sleep", lambda s: None)
    lines = cli.main(["extract", "--key", "a.txt", "--source", str(source), "--out", str(tmp_path / "out"), "--disagreements", str(tmp_path / "store"), "--show-image"])
    assert lines == 0
    assert json.loads((tmp_path / "store" / "disagreements" / "a.txt.json").read_text())["status"] in ("rate_limited", "provider_unavailable")


def test_provider_documented():
    assert config.undocumented(["Open AI", "anthropic", "other"], ["OpenAI terms", "Anthropic — terms of use"]) == ["other"]
    with pytest.raises(ValueError):
        config.prompt_parts("no head")
    assert config.prompt_parts("---\nversion: a --- b\n ---\n\nbody\n---\n") == ("version: a --- b", "body\n---\n")


def test_config(tmp_path):
    path = tmp_path / "agents.yaml"
    path.write_text("visa: {model: m-yaml}\nbad: 3\n")
    assert config.resolve("visa", None, path, {}) == {"provider": "anthropic", "model": "m-yaml", "fallback": "provider"}
    assert config.resolve("visa", {"model": "m-cli"}, path, {"DOCSPARK_MODEL_VISA": "m-env"})["model"] == "m-cli"
    assert config.resolve("visa", None, path, {"DOCSPARK_MODEL_VISA": "m-env"})["model"] == "m-env"
    assert config.resolve("passport", None, path, {})["model"] == config.SONNET and config.resolve("other", None, path, {})["model"] == config.HAIKU
    with pytest.raises(ValueError):
        config.resolve("bad", None, path, {})
    assert config.overrides(None, "") is None and config.overrides("p", None) == {"provider": "p"}
    base = json.loads(config.prompt_baseline({"b": "---\nversion: 2\n---\nx", "a": "---\nversion: 1\n---\n\ny"}))
    assert list(base) == ["a", "b"] and base["b"]["version"] == "2"
    assert set(config.schema_snapshots()) == {schemas.slug(t) for t in schemas.DOC_TYPES}


def test_registry_covers_types():
    calls = extract.registry()
    assert list(calls) == schemas.DOC_TYPES
    assert calls["Visa"]({"text": "- Visa Type: B1\nHost Country: US"}, "t") == {"doc_type": "Visa", "jurisdiction": "US", "visa_class": "B1", "host_country": "US"}


@pytest.mark.parametrize("text,want", [("P<NZLDOE passport", "Passport"), ("passport", "Other"), (None, "Other"), ("", "Other"), ("Statement period; closing balance; utility bill; amount due", "BankStatement"), ("applicant, i declare that; beneficial owner; ubo", "Other")])
def test_classifier(spark, text, want):
    assert classify.classify(spark.createDataFrame([(text,)], "text string")).first()["doc_type"] == want
