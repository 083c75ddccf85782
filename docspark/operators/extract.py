"""Extractor boundary: where a model sat, any function from rows to records can be plugged in.

Rows reach the extractor Arrow-batched. Retries happen inside the batch function (in
streaming.limited they wait in state instead, and no task sleeps), and every failure becomes
a row: tasks never fail for a document, so Spark's task retry does not pay for a call twice. Filters on keys and types belong before the boundary; Catalyst does not
move them across it.
"""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import pdf
from .keyed import placed

ATTEMPT = "struct<tier:string,success:boolean,latency_ms:double,agent:string,provider:string,model:string,cost_usd:double>"
RESULT = f"ordinal long, key string, doc_type string, fields map<string,string>, status string, error string, attempts array<{ATTEMPT}>"


class Answer(dict):
    """Fields, with what the service said about the call that gave them."""

    def __init__(self, fields: dict[str, str], provider: str = "", model: str = "", cost_usd: float = 0.0):
        super().__init__(fields)
        self.said = {"provider": provider, "model": model, "cost_usd": cost_usd}


class RateLimited(Exception):
    """The service asked to come back later."""


class Invalid(Exception):
    """The answer broke the record's schema."""


NOTHING_SAID = {"provider": "", "model": "", "cost_usd": 0.0}


def step(call: Callable, row: dict, tier: str, n: int, made: list[dict], above: dict[str, str], agent: str, tries: int = 3) -> tuple[tuple[dict, str, str] | None, tuple[str, int, bool]]:
    """One call for a row, after n turned-away ones at this tier; it is added to made.

    (fields, status, error) if that settles the row, else None; and the tier and number of
    turned-away calls to go on with, and whether to wait before.
    """
    began = time.monotonic()
    log = lambda ok, said=NOTHING_SAID: made.append({"tier": tier, "success": ok, "latency_ms": 1000 * (time.monotonic() - began), "agent": agent, **said})
    try:
        fields = call(row, tier)
        log(True, getattr(fields, "said", NOTHING_SAID))
        return (dict(fields), "passed", ""), (tier, n, False)
    except RateLimited:
        log(False)
        return ({}, "rate_limited", "rate limited") if n + 1 == tries else None, (tier, n + 1, True)
    except Invalid as e:
        log(False)
        higher = above.get(tier)
        settled = higher is None or any(a["tier"] == higher for a in made)
        return ({}, "failed", f"invalid: {e}") if settled else None, (higher or tier, 0, False)
    except Exception as e:
        log(False)
        return ({}, "provider_unavailable", f"{type(e).__name__}: {e}"), (tier, n, False)


def wait(n: int, base: float, rng: random.Random) -> float:
    """Seconds before the call that follows the n-th turned-away one: doubling, with jitter."""
    return base * 2 ** (n - 1) + rng.random() * base


def attempt(call: Callable, row: dict, tier: str, above: dict[str, str], agent: str, tries: int = 3, base: float = 1.0, sleep: Callable = time.sleep, seed: int = 0):
    """fields, status, error, attempts of one row: rate limits are waited out, an invalid answer is asked for once more one tier up."""
    if tries < 1:
        raise ValueError("tries must be positive")
    made, rng, n = [], random.Random(seed), 0
    while True:
        settled, (tier, n, turned_away) = step(call, row, tier, n, made, above, agent, tries)
        if settled:
            return (*settled, made)
        if turned_away:
            sleep(wait(n, base, rng))


def extract(rows: DataFrame, call: Callable, tier: str = "rules", above: dict[str, str] | None = None, concurrency: int = 10, tries: int = 3, base: float = 1.0) -> DataFrame:
    """One result row for each row of rows (key, doc_type, text). `ordinal` is the input's place: its own column of that name, else the key's place among all keys.

    concurrency bounds the calls under way, not the partitions: each of the cluster's cores
    gets its share as threads, and where there are more cores than calls, partitions are merged.
    """
    if concurrency < 1:
        raise ValueError("concurrency must be positive")
    above, cores = above or {}, rows.sparkSession.sparkContext.defaultParallelism
    threads = max(1, concurrency // cores)

    def one(row: dict) -> tuple:
        fields, status, error, made = attempt(call, row, tier, above, row["doc_type"], tries, base)
        return row["ordinal"], row["key"], row["doc_type"], fields, status, error, made

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(threads) as pool:
            for frame in frames:
                out = list((pool.map if threads > 1 else map)(one, frame.to_dict("records")))
                yield pd.DataFrame(out, columns=["ordinal", "key", "doc_type", "fields", "status", "error", "attempts"])

    if "ordinal" not in rows.columns:
        rows = placed(rows.select("key", "doc_type", "text"), ["key"])
    some = rows.select(F.col("ordinal").cast("long").alias("ordinal"), "key", "doc_type", "text")
    return (some.coalesce(concurrency) if concurrency < cores else some).mapInPandas(run, RESULT)


def with_provenance(results: DataFrame, config: DataFrame, version: str, timestamp: str) -> DataFrame:
    """results whose fields hold provider, model, prompt version, extractor version and time; what a field says already stays.

    config: doc_type, provider, model, prompt_version, one row a type. The last attempt's own words come before config.
    """
    named = results.join(F.broadcast(config), "doc_type", "left")  # one row a type
    last = F.try_element_at("attempts", F.lit(-1))
    own = {
        "extractor_version": F.lit(version), "extraction_provider": F.coalesce(F.nullif(last["provider"], F.lit("")), F.col("provider")), "extraction_model": F.coalesce(F.nullif(last["model"], F.lit("")), F.col("model")),
        "extraction_timestamp": F.lit(timestamp), "prompt_version": F.col("prompt_version"),
    }
    filled = F.map_filter("fields", lambda k, v: F.coalesce(v, F.lit("")) != "")
    made = F.map_from_entries(F.filter(F.array(*[F.struct(F.lit(k).alias("key"), F.coalesce(v, F.lit("")).alias("value")) for k, v in own.items()]), lambda e: ~F.map_contains_key(filled, e["key"])))
    return named.withColumn("fields", F.when(F.col("status") == "passed", F.map_concat(made, F.map_filter("fields", lambda k, v: ~F.map_contains_key(made, k)))).otherwise(F.col("fields"))).select(*results.columns)


def failures(results: DataFrame, version: str, timestamp: str) -> DataFrame:
    """The disagreement records of keys that could not be extracted: no primary, no verifier, the status tells why."""
    none = F.lit(None).cast("string")
    return results.where(F.col("status").isin(FAILED)).select("key", F.col("key").alias("source_key"), none.alias("primary"), none.alias("verifier"), "status", F.lit(version).alias("extractor_version"), F.lit(timestamp).alias("timestamp"))


#: Statuses of a key without a record.
FAILED = ["rate_limited", "provider_unavailable", "failed"]


def run_response(response) -> dict:
    """raw_text, provider, model, cost_usd and latency_ms of a service's response (messages, model_provider, model, metrics (cost, duration in seconds)); '' and 0 where it says nothing."""
    number = lambda c: F.coalesce(c.cast("double"), F.lit(0.0))
    said = lambda c: F.coalesce(c, F.lit(""))
    return {"raw_text": last_message(response["messages"]), "provider": said(response["model_provider"]), "model": said(response["model"]), "cost_usd": number(response["metrics"]["cost"]), "latency_ms": number(response["metrics"]["duration"]) * 1000}


def rule_extractor(row: dict, tier: str) -> dict[str, str]:
    """The default extractor: `label: value` lines of the text, labels in snake case."""
    out = {}
    for line in (row["text"] or "").split("\n"):
        label, colon, value = line.partition(":")
        if colon and value.strip():
            out.setdefault(label.strip(" -*").lower().replace(" ", "_"), value.strip())
    return out


def attempt_rows(results: DataFrame) -> DataFrame:
    """Telemetry: one row per attempt, with its number as retry_count."""
    return results.select("key", "doc_type", F.posexplode("attempts").alias("retry_count", "a")).select("key", "doc_type", "retry_count", "a.*")


def last_messages(rows: DataFrame, key: str, turn: str, role: str = "role", content: str = "text") -> DataFrame:
    """key, said: the content of the last assistant message that has any, '' without one; nothing but that message is held."""
    said = (F.col(role) == "assistant") & (F.coalesce(F.col(content), F.lit("")) != "")
    return rows.groupBy(key).agg(F.coalesce(F.max_by(F.when(said, F.col(content)), F.when(said, F.col(turn))), F.lit("")).alias("said"))


def last_message(messages) -> object:
    """Content of the last assistant message that has any, of an array of (role, content)."""
    said = F.filter(messages, lambda m: (m["role"] == "assistant") & (F.coalesce(m["content"], F.lit("")) != ""))
    return F.coalesce(F.try_element_at(said, F.lit(-1))["content"], F.lit(""))


def pages(documents: DataFrame, renderer: Callable | None = None) -> DataFrame:
    """key, page_no, png, error for documents (key, content, mode): page1 or all_pages. renderer: bytes -> list of images.

    Without one, a PDF gives the contents of its pages by its page tree, and any other text
    what lies between form feeds. A document that cannot be read is one row with an error.
    """
    def split(content: bytes) -> list[bytes]:
        if b"%PDF-" in content[:1024]:
            return [text for _, _, text in pdf.File(content).pages()]
        found = [p for p in content.split(b"\f") if p]
        if not found:
            raise ValueError("no pages")
        return found

    make = renderer or split

    def run(frames):
        for frame in frames:
            out = []
            for key, content, mode in zip(frame["key"], frame["content"], frame["mode"], strict=True):
                try:
                    images = make(bytes(content or b""))
                    out += [(key, i, p, "") for i, p in enumerate(images[:1] if mode == "page1" else images)]
                except Exception as e:
                    out.append((key, -1, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["key", "page_no", "png", "error"])

    return documents.select("key", "content", "mode").mapInPandas(run, "key string, page_no int, png binary, error string")


def page_tree(documents: DataFrame) -> DataFrame:
    """key, page_no, object, ranges (start, length of its contents in the file), error for PDF documents (key, content, mode): one row a page, so that later steps fetch single pages."""
    def run(frames):
        for frame in frames:
            out = []
            for key, content, mode in zip(frame["key"], frame["content"], frame["mode"], strict=True):
                try:
                    found = pdf.File(bytes(content or b"")).pages()
                    out += [(key, i, number, [{"start": s, "length": n} for s, n in ranges], "") for i, (number, ranges, _) in enumerate(found[:1] if mode == "page1" else found)]
                except Exception as e:
                    out.append((key, -1, None, [], f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["key", "page_no", "object", "ranges", "error"])

    return documents.select("key", "content", "mode").mapInPandas(run, "key string, page_no int, object long, ranges array<struct<start:long,length:long>>, error string")


def specialist(doc_type: str) -> Callable:
    """A rule-based extractor of one type: its mapper's labels, read from `label: value` lines."""
    from .legacy import mapping

    wanted = [(name, [x.lower() for x in labels]) for name, _, _, labels in mapping(doc_type)]

    def call(row: dict, tier: str) -> dict[str, str]:
        found: dict[str, str] = {}
        for line in (row["text"] or "").split("\n"):
            label, colon, value = line.partition(":")
            if colon and value.strip():
                found.setdefault(label.strip(" -*").lower(), value.strip())
        out = {name: next((found[x] for x in labels if x in found), "") for name, labels in wanted}
        return {"doc_type": doc_type, **{k: v for k, v in out.items() if v}}

    return call


@cache
def registry() -> dict[str, Callable]:
    """doc_type -> extractor, for all fifteen types."""
    from ..schemas import DOC_TYPES

    return {t: specialist(t) for t in DOC_TYPES}


def by_registry(row: dict, tier: str) -> dict[str, str]:
    """The registry's extractor for the row's type; an unknown type is an invalid answer."""
    calls = registry()
    if row["doc_type"] not in calls:
        raise Invalid(f"no extractor for {row['doc_type']}")
    return calls[row["doc_type"]](row, tier)
