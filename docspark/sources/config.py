"""Small YAML dimensions read on the driver, and baselines written back."""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from .. import schemas
from ..operators import keyed

SONNET, HAIKU = "claude-sonnet-4-6-20260101", "claude-haiku-4-5-20251001"
PRECISE = ["passport", "driver_licence", "national_id", "visa"]


def load_yaml(path: str | Path, required: bool) -> dict:
    """A mapping; a missing file is an error if required, else empty."""
    import yaml

    if not Path(path).exists():
        if required:
            raise FileNotFoundError(path)
        return {}
    data = yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}
    if not isinstance(data, dict):
        raise ValueError(f"{path}: the top level must be a mapping")
    return data


def thresholds(spark: SparkSession, path: str | Path) -> tuple[DataFrame, float]:
    """agent, field, floor and the default (0 where the file has none)."""
    data = load_yaml(path, required=True)
    rows = [(a, f, float(v)) for a, fields in data.items() if isinstance(fields, Mapping) for f, v in fields.items()]
    return spark.createDataFrame(rows, "agent string, field string, floor double"), float(data.get("_default", 0.0))


def overrides(provider: str | None, model: str | None) -> dict[str, str] | None:
    given = {k: v for k, v in (("provider", provider), ("model", model)) if v}
    return given or None


def default_model(agent: str) -> str:
    return SONNET if agent in PRECISE else HAIKU


def resolve(agent: str, cli: Mapping[str, str] | None = None, path: str | Path = "agents.yaml", env: Mapping[str, str] | None = None) -> dict[str, str]:
    """provider and model of an agent: command line, environment, file, fallback; `fallback` names the fields that fell through."""
    entry = load_yaml(path, required=False).get(agent) or {}
    if not isinstance(entry, Mapping):
        raise ValueError(f"{agent}: the entry must be a mapping")
    env, out, fell = os.environ if env is None else env, {}, []
    for field, fallback in (("provider", "anthropic"), ("model", default_model(agent))):
        found = (cli or {}).get(field) or env.get(keyed.env_key(field, agent)) or entry.get(field)
        if not found:
            fell.append(field)
        out[field] = found or fallback
    return {**out, "fallback": ",".join(fell)}


def prompt_parts(text: str) -> tuple[str, str]:
    """Head and body between lines that strip to `---`; the body loses its leading line feeds."""
    lines = text.split("\n")
    ends = [i for i, line in enumerate(lines) if line.strip() == "---"]
    if not ends or ends[0] != 0 or len(ends) < 2:
        raise ValueError("a prompt needs frontmatter between two lines of ---")
    return "\n".join(lines[1 : ends[1]]), "\n".join(lines[ends[1] + 1 :]).lstrip("\n")


def undocumented(providers: list[str], headings: list[str]) -> list[str]:
    """Providers that no heading names by one or several whole words in a row; letter case, spaces and signs do not count."""
    words = lambda x: "".join(c if c.isalnum() else " " for c in x.lower()).split()
    known = {"".join(w[i:j]) for w in map(words, headings) for i in range(len(w)) for j in range(i + 1, len(w) + 1)}
    return sorted(p for p in providers if "".join(words(p)) not in known)


def prompt_baseline(prompts: Mapping[str, str]) -> str:
    """JSON of name -> version and body hash, keys sorted. prompts: name -> text with frontmatter."""
    import yaml

    out = {}
    for name, text in prompts.items():
        head, body = prompt_parts(text)
        out[name] = {"version": str(yaml.safe_load(head).get("version", "")), "body_sha256": hashlib.sha256(body.encode()).hexdigest()}
    return json.dumps(out, indent=2, sort_keys=True) + "\n"


def schema_snapshots() -> dict[str, str]:
    """Canonical YAML of every type's columns, in order."""
    import yaml

    return {schemas.slug(t): yaml.safe_dump({"doc_type": t, "columns": [{"name": f.name, "type": f.dataType.simpleString(), "nullable": f.nullable} for f in schemas.schema(t)]}, sort_keys=False, allow_unicode=True) for t in schemas.DOC_TYPES}
