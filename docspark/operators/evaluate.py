"""Field-level evaluation: records to long form, comparison, scorecards."""

from __future__ import annotations

import json
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import PROVENANCE
from . import gates

KEYS, VERSION = ["doc_key", "agent", "jurisdiction"], "0.1.0"


def long_form(records: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """keys, field, value for every field that is not provenance; null is ''."""
    fields = [c for c in records.columns if c not in keys and c not in PROVENANCE]
    text = records.select(*keys, *[F.coalesce(F.col(f).cast("string"), F.lit("")).alias(f) for f in fields])
    return text.unpivot(keys, fields, "field", value)


def compare(expected: DataFrame, actual: DataFrame, keys: list[str], match: Column | None = None) -> DataFrame:
    """keys, field, expected, actual, matched: a row wherever either side has text.

    Records are joined whole, one row a key, and only then cut into fields, so a key's fields
    cross the exchange once.
    """
    sides, names = [], []
    for frame, side in ((expected, "_e"), (actual, "_a")):
        fields = [c for c in frame.columns if c not in keys and c not in PROVENANCE]
        names += [f for f in fields if f not in names]
        sides.append(frame.select(*keys, F.struct(*[F.coalesce(F.col(f).cast("string"), F.lit("")).alias(f) for f in fields]).alias(side)))
    both = sides[0].join(sides[1], keys, "full_outer")
    value = lambda side, frame, f: F.coalesce(F.col(side)[f], F.lit("")) if f in frame.columns else F.lit("")
    fields = F.array(*[F.struct(F.lit(f).alias("field"), value("_e", expected, f).alias("expected"), value("_a", actual, f).alias("actual")) for f in names])
    filled = both.select(*keys, F.explode(F.filter(fields, lambda x: (x["expected"] != "") | (x["actual"] != ""))).alias("f")).select(*keys, "f.field", "f.expected", "f.actual")
    return filled.withColumn("matched", match if match is not None else F.col("expected") == F.col("actual"))


def paired(keys: DataFrame, results: DataFrame, ordinal: str = "ordinal", key: str = "key") -> DataFrame:
    """keys with the results of the same ordinal. The two must correspond one to one: a row that the other side lacks, or another key there, is an error."""
    right = results.select(F.col(ordinal), F.col(key).alias("_key"), F.struct(*[c for c in results.columns if c != ordinal]).alias("result"))
    both = keys.join(right, ordinal, "full_outer")
    broken = F.col(key).isNull() | F.col("_key").isNull() | (F.col(key) != F.col("_key"))
    same = F.when(broken, F.raise_error(F.concat(F.lit("keys and results do not correspond at "), F.col(ordinal).cast("string")))).otherwise(F.col(key))
    return both.withColumn(key, same).drop("_key")


def selected(rows: DataFrame, jurisdiction: str | None = None, agent: str | None = None) -> DataFrame:
    """Rows of one jurisdiction and one type, where they are named."""
    for column, value in (("jurisdiction", jurisdiction), ("agent", agent)):
        rows = rows.where(F.col(column) == value) if value else rows
    return rows


def ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0)).cast("double")


def _metrics() -> list[Column]:
    hit = F.count_if("matched")
    return [
        ratio(hit, F.count_if(F.col("actual") != "")).alias("precision"), ratio(hit, F.count_if(F.col("expected") != "")).alias("recall"),
        ratio(F.count_distinct(F.when(F.col("matched"), F.col("field"))), F.count_distinct("field")).alias("field_coverage"), F.count("*").alias("examples"),
    ]


def by_agent(results: DataFrame) -> DataFrame:
    return results.groupBy("agent").agg(*_metrics())


def by_jurisdiction(results: DataFrame) -> DataFrame:
    return results.groupBy("jurisdiction", "agent").agg(*_metrics())


def by_field(results: DataFrame) -> DataFrame:
    return results.groupBy("agent", "field").agg(ratio(F.count_if("matched"), F.count("*")).alias("match_rate"), F.count("*").alias("examples"))


STATE = ["n_matched", "n_actual", "n_expected", "examples"]


def partial(results: DataFrame) -> DataFrame:
    """State of a run's scorecard: counts by agent, jurisdiction and field. As many rows as the registries have such triples, whatever the run's size."""
    counts = [F.count_if("matched"), F.count_if(F.col("actual") != ""), F.count_if(F.col("expected") != ""), F.count("*")]
    return results.groupBy("agent", "jurisdiction", "field").agg(*[c.alias(n) for c, n in zip(counts, STATE, strict=True)])


def merged(states: DataFrame) -> DataFrame:
    """One state of the rows of several."""
    return states.groupBy("agent", "jurisdiction", "field").agg(*[F.sum(n).alias(n) for n in STATE])


def of_states(states: DataFrame, by: list[str]) -> DataFrame:
    """The figures of by_agent() or by_jurisdiction() from states of any number of runs: a field counts as covered once any of them matched it."""
    fields = states.groupBy(*by, "field").agg(*[F.sum(n).alias(n) for n in STATE])
    hit = F.sum("n_matched")
    return fields.groupBy(*by).agg(
        ratio(hit, F.sum("n_actual")).alias("precision"), ratio(hit, F.sum("n_expected")).alias("recall"),
        ratio(F.count_if(F.col("n_matched") > 0), F.count("*")).alias("field_coverage"), F.sum("examples").alias("examples"),
    )


def fields_of_states(states: DataFrame) -> DataFrame:
    """The figures of by_field() from states."""
    return states.groupBy("agent", "field").agg(ratio(F.sum("n_matched"), F.sum("examples")).alias("match_rate"), F.sum("examples").alias("examples"))


def in_one_pass(results: DataFrame) -> DataFrame:
    """Agent, field, jurisdiction and total figures from one scan: a row per grouping set, `level` names it."""
    sets = [["agent"], ["agent", "field"], ["agent", "jurisdiction"], []]
    out = results.groupingSets([[F.col(c) for c in s] for s in sets], F.col("agent"), F.col("field"), F.col("jurisdiction"))
    level = F.expr("CASE grouping_id() WHEN 3 THEN 'agent' WHEN 1 THEN 'field' WHEN 2 THEN 'jurisdiction' ELSE 'total' END")
    return out.agg(F.count_if("matched").alias("n_matched"), F.count_if(F.col("actual") != "").alias("n_actual"), F.count_if(F.col("expected") != "").alias("n_expected"), F.count("*").alias("examples"), level.alias("level"))


def totals(results: DataFrame, doc_key: str = "doc_key") -> DataFrame:
    """Examples, cost summed over compared rows, and cost summed once per document."""
    per_doc = results.groupBy(doc_key).agg(F.sum("cost_usd").alias("s"), F.max("cost_usd").alias("m"), F.count("*").alias("n"))
    return per_doc.agg(F.sum("n").alias("examples"), F.sum("s").alias("total_cost_usd"), F.sum("m").alias("distinct_doc_cost_usd"))


def scorecard(results: DataFrame, version: str = VERSION, timestamp: str | None = None, ceiling: float | None = None, doc_key: str | None = None) -> DataFrame:
    """One row: maps per_agent, per_field and per_jurisdiction, total_examples, total_cost_usd, cost_breach, extractor_version and run_timestamp. Sizes are those of the registries.

    Cost is summed over rows, or once for each doc_key where one is named. Without a cost_usd column it is 0.
    """
    if "cost_usd" not in results.columns:
        results = results.withColumn("cost_usd", F.lit(0.0))
    metrics = F.struct("precision", "recall", "field_coverage", "examples")
    by_name = lambda x, y: F.when(x["name"] < y["name"], -1).when(x["name"] > y["name"], 1).otherwise(0)
    entries = lambda c, name: F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(name).alias("name"), c)), by_name))
    agents = by_agent(results).agg(entries(metrics.alias("m"), "agent").alias("per_agent"))
    fields = by_field(results).groupBy("agent").agg(entries(F.struct("match_rate", "examples").alias("m"), "field").alias("m")).agg(entries(F.col("m"), "agent").alias("per_field"))
    places = by_jurisdiction(results).groupBy("jurisdiction").agg(entries(metrics.alias("m"), "agent").alias("m")).agg(entries(F.col("m"), "jurisdiction").alias("per_jurisdiction"))
    if doc_key is None:
        cost = results.agg(F.count("*").alias("total_examples"), F.coalesce(F.sum("cost_usd"), F.lit(0.0)).alias("total_cost_usd"))
    else:
        cost = totals(results, doc_key).select(F.coalesce("examples", F.lit(0)).alias("total_examples"), F.coalesce("distinct_doc_cost_usd", F.lit(0.0)).alias("total_cost_usd"))
    whole = agents.crossJoin(fields).crossJoin(places).crossJoin(cost)  # one row each
    return whole.withColumns({"cost_breach": gates.run_breach(F.col("total_cost_usd"), gates.RUN_CEILING if ceiling is None else ceiling), "extractor_version": F.lit(version), "run_timestamp": F.lit(timestamp or utc_now())})


def scorecard_json(results: DataFrame, **options) -> DataFrame:
    """One row, `scorecard`: the scorecard as compact JSON, letters as they are."""
    return scorecard(results, **options).select(F.to_json(F.struct("*")).alias("scorecard"))


def pretty(text: str) -> str:
    """JSON with two blanks of indentation, letters as they are."""
    return json.dumps(json.loads(text), indent=2, ensure_ascii=False)


def utc_now() -> str:
    """The time in UTC, to the second, as ISO text; made outside plans, so that a plan gives the same result again."""
    return datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
