"""Queries that write in between: commits, streams, telemetry folders, bucketed tables.

They work on rows of the driver's tables and write to the shared folder alone.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import evaluate, extract, gates, keyed, selection
from ..session import shared_folder
from ..sources import files, store, versions
from ..streaming import ingest, limited
from . import inputs

WRITES = [
    "SELECT c_custkey AS k, concat('first text of ', c_name) AS md, CAST(0 AS BIGINT) AS n FROM {customer}",
    "SELECT o_custkey AS k, concat('b', CAST(o_orderkey AS STRING)) AS md, o_orderkey AS n FROM {orders}",
    "SELECT c_custkey AS k, 'a' AS md, CAST(0 AS BIGINT) AS n FROM {customer} WHERE c_custkey % 3 = 0",
]


def store_last_writer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three writes of overlapping keys, the last with the least text; a compaction in between, and a repeated batch that must not count."""
    root, (first, second, third) = shared_folder(spark), (inputs.run(spark, sf_dir, w) for w in WRITES)
    versions.commit(spark, root, {"texts": first})
    versions.commit(spark, root, {"texts": second})
    versions.compact(spark, root, {"texts": (["k"], ["n"])})
    versions.commit(spark, root, {"texts": third}, "stream", 0)
    versions.commit(spark, root, {"texts": first}, "stream", 0)
    return versions.newest(spark, root, "texts", ["k"], ["n"]).select("k", "md")


_WRITES = " UNION ALL ".join(f"SELECT {i} AS c, * FROM ({inputs.duck(w)})" for i, w in enumerate(WRITES))
STORE_SQL = f"SELECT k, md FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY c DESC, n DESC) AS nth FROM ({_WRITES})) WHERE nth = 1"

AUDITED = "SELECT o_orderkey AS k, o_totalprice AS price, CASE WHEN o_orderkey % 4 = 0 THEN 'fail' WHEN o_orderkey % 4 = 1 THEN 'uncertain' ELSE 'pass' END AS overall FROM {orders}"


def paired_sinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of audited orders into two tables, run and run again; each table's rows by verdict."""
    source, root, checkpoint = (shared_folder(spark) for _ in range(3))
    inputs.run(spark, sf_dir, AUDITED).repartition(3).write.parquet(source)
    schema = spark.read.parquet(source).schema
    for _ in range(2):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        ingest.paired_sinks(stream, root, checkpoint, "audits").awaitTermination()
    tables = [versions.history(spark, root, t).groupBy("overall").agg(F.count("*").alias("n"), F.count_distinct("k").alias("keys")).select(F.lit(t).alias("sink"), "*") for t in ("disagreements", "records")]
    return tables[0].unionByName(tables[1])


_AUDITED = f"({inputs.duck(AUDITED)})"
PAIRED_SQL = f"SELECT 'disagreements' AS sink, overall, count(*) AS n, count(DISTINCT k) AS keys FROM {_AUDITED} WHERE overall = 'fail' GROUP BY overall UNION ALL SELECT 'records', overall, count(*), count(DISTINCT k) FROM {_AUDITED} GROUP BY overall"


def telemetry_newest_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as telemetry files, one folder a day; records and cost of the seven newest, which alone are read."""
    path = shared_folder(spark)
    events = inputs.run(spark, sf_dir, inputs.TELEMETRY)
    files.append_telemetry(events.select(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"), F.col("source_key").cast("string").alias("source_key"), "agent", "success", "cost_usd"), path)
    kept = gates.successes(files.newest_telemetry(spark, path, 7))
    return kept.groupBy(F.col("event_date").cast("string").alias("event_day")).agg(F.count("*").alias("records"), F.round(F.sum("cost_usd"), 4).alias("cost_usd"))


_EVENTS = f"({inputs.duck(inputs.TELEMETRY)})"
DAYS_SQL = f"SELECT CAST(event_date AS STRING) AS event_day, count(*) AS records, round(sum(cost_usd), 4) AS cost_usd FROM {_EVENTS} WHERE success AND cost_usd IS NOT NULL AND event_date IN (SELECT DISTINCT event_date FROM {_EVENTS} ORDER BY event_date DESC LIMIT 7) GROUP BY 1"

RUNS = 10


def scorecard_of_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten runs of an evaluation, each stored as its state alone; agents' figures over all runs."""
    root = shared_folder(spark)
    compared = evaluate.compare(inputs.run(spark, sf_dir, inputs.RECORD), inputs.run(spark, sf_dir, inputs.READ), evaluate.KEYS)
    for n in range(RUNS):
        versions.commit(spark, root, {"states": evaluate.partial(compared.where(F.col("doc_key") % RUNS == n))}, "evaluation", n)
    return evaluate.of_states(versions.history(spark, root, "states"), ["agent"])


_FIELDS = ["name_latin", "doc_number", "nationality", "expiry_date"]
_LONG = " UNION ALL ".join(f"SELECT e.agent, '{f}' AS field, coalesce(e.{f}, '') AS expected, coalesce(a.{f}, '') AS actual FROM ({inputs.duck(inputs.RECORD)}) e JOIN ({inputs.duck(inputs.READ)}) a USING (doc_key)" for f in _FIELDS)
STATES_SQL = f"""SELECT agent, CAST(count(*) FILTER (expected = actual) AS DOUBLE) / count(*) FILTER (actual <> '') AS precision, CAST(count(*) FILTER (expected = actual) AS DOUBLE) / count(*) FILTER (expected <> '') AS recall,
  CAST(count(DISTINCT CASE WHEN expected = actual THEN field END) AS DOUBLE) / count(DISTINCT field) AS field_coverage, count(*) AS examples
FROM ({_LONG}) WHERE expected <> '' OR actual <> '' GROUP BY agent"""


def head_skip_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders without a line that was returned, from two tables bucketed alike."""
    names = [f"docspark_{uuid.uuid4().hex}" for _ in range(2)]
    keys = keyed.bucketed(inputs.run(spark, sf_dir, "SELECT o_orderkey AS key, o_orderpriority AS priority FROM {orders}"), names[0], buckets=16, path=shared_folder(spark))
    done = keyed.bucketed(inputs.run(spark, sf_dir, "SELECT l_orderkey AS key FROM {lineitem} WHERE l_returnflag = 'R'"), names[1], buckets=16, path=shared_folder(spark))
    return keyed.pending(keys, done)


BUCKETED_SQL = "SELECT o_orderkey AS key, o_orderpriority AS priority FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')"


def global_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every order by date and key."""
    return keyed.placed(inputs.run(spark, sf_dir, "SELECT o_orderkey, o_orderdate FROM {orders}"), ["o_orderdate", "o_orderkey"])


ORDINAL_SQL = "SELECT o_orderkey, o_orderdate, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS ordinal FROM orders"
FRACTIONS = [0.0, 0.25, 0.5, 0.9, 0.999, 1.0]


def exact_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact percentiles of all line prices by selection, a thousand values held at the end."""
    lines = inputs.run(spark, sf_dir, "SELECT l_extendedprice AS price FROM {lineitem}")
    return spark.createDataFrame([(f, selection.exact_percentile(lines, "price", f, 1_000)) for f in FRACTIONS], "fraction double, price double")


PERCENTILES_SQL = " UNION ALL ".join(f"SELECT CAST({f} AS DOUBLE) AS fraction, quantile_cont(CAST(l_extendedprice AS DOUBLE), {f}) AS price FROM lineitem" for f in FRACTIONS)


def _service(row: dict, tier: str) -> dict:
    """Stands for a model: some keys are always turned away, some need the higher tier."""
    n = int(row["key"])
    if n % 10 == 9:
        raise extract.RateLimited
    if n % 7 == 1 and tier == "rules" or n % 49 == 8:
        raise extract.Invalid("name")
    return {"name": row["text"]}


def rate_limited_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer through a service under a rate limit; rows wait for their turn in state."""
    rows = inputs.run(spark, sf_dir, "SELECT c_custkey AS ordinal, CAST(c_custkey AS STRING) AS key, 'Other' AS doc_type, c_name AS text FROM {customer}")
    out = limited.extract_limited(rows, _service, rate=100_000.0, lanes=8, above={"rules": "large"}, base=0.05)
    return out.select("key", "status", F.size("attempts").alias("attempts"), F.array_join(F.transform("attempts", lambda a: a["tier"]), ",").alias("tiers"), F.coalesce(F.col("fields")["name"], F.lit("")).alias("name"))


LIMITED_SQL = """SELECT CAST(c_custkey AS VARCHAR) AS key, status, CASE status WHEN 'rate_limited' THEN 3 ELSE 1 + CAST(higher AS INTEGER) END AS attempts,
  CASE WHEN status = 'rate_limited' THEN 'rules,rules,rules' WHEN higher THEN 'rules,large' ELSE 'rules' END AS tiers, CASE WHEN status = 'passed' THEN c_name ELSE '' END AS name
FROM (SELECT *, CASE WHEN c_custkey % 10 = 9 THEN 'rate_limited' WHEN c_custkey % 49 = 8 THEN 'failed' ELSE 'passed' END AS status, c_custkey % 7 = 1 AS higher FROM customer)"""

OBJECTS = "SELECT concat('c/', CAST(c_custkey AS STRING)) AS key, concat(c_name, chr(10), CASE WHEN c_custkey % 2 = 0 THEN '名' ELSE '' END) AS md, c_custkey AS n FROM {customer}"


def object_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer as an object, written twice, the second time with a shorter text; sizes, kinds and texts as they are read back."""
    root, rows = shared_folder(spark), inputs.run(spark, sf_dir, OBJECTS)
    failed = store.put_analyses(rows, root)
    failed = failed.unionByName(store.put_analyses(rows.where("n % 3 = 0").withColumn("md", F.lit("a")), root))
    both = files.manifest(spark, root).join(files.texts(spark, root), "key").select("key", F.col("size").cast("long").alias("size"), "content_type", F.md5("md").alias("text_md5"))
    return both.join(failed.select("key"), "key", "left_anti")


OBJECTS_SQL = f"SELECT key || '.md' AS key, strlen(md) AS size, 'application/octet-stream' AS content_type, md5(md) AS text_md5 FROM (SELECT key, CASE WHEN n % 3 = 0 THEN 'a' ELSE md END AS md FROM ({inputs.duck(OBJECTS)}))"
DISAGREED = "SELECT concat('k', CAST(o_orderkey AS STRING)) AS key, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS primary, CAST(o_custkey AS STRING) AS verifier, 'fail' AS status FROM {orders} WHERE o_orderkey % 4 = 0"


def disagreement_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Disagreements as one JSON object each, read back."""
    root = shared_folder(spark)
    store.put_disagreements(inputs.run(spark, sf_dir, DISAGREED), root)
    back = files.texts(spark, root, ".json").select(F.col("key").alias("path"), F.from_json("md", "key string, primary string, verifier string, status string").alias("r"))
    return back.select("path", "r.*")


DISAGREED_SQL = f"SELECT 'disagreements/' || key || '.json' AS path, * FROM ({inputs.duck(DISAGREED)})"


def telemetry_flushed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged telemetry copied to the store twice; records of each day as they are read there."""
    staged, root = shared_folder(spark), shared_folder(spark)
    events = inputs.run(spark, sf_dir, inputs.TELEMETRY)
    files.append_telemetry(events.select(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"), F.col("source_key").cast("string").alias("source_key"), "success", "cost_usd"), staged)
    for _ in range(2):
        store.flush_telemetry(spark, staged, root)
    return files.read_telemetry(spark, f"{root}/telemetry").groupBy(F.col("event_date").cast("string").alias("event_day")).agg(F.count("*").alias("records"), F.count_if("success").alias("successes"))


FLUSHED_SQL = f"SELECT CAST(event_date AS STRING) AS event_day, count(*) AS records, count(*) FILTER (success) AS successes FROM ({inputs.duck(inputs.TELEMETRY)}) GROUP BY 1"
PROMPTS = f"""SELECT CAST(p_partkey AS STRING) AS key, concat('---', chr(10), {inputs.case('p_partkey', ["concat('agent: ', p_brand, chr(10))", "concat('agent:', chr(10))", "''"])}, 'version: ', CAST(p_size AS STRING), chr(10),
  {inputs.case('p_partkey', ["concat('last_modified: 2026-01-01', chr(10))"] * 4 + ["''"])}, '---', chr(10), chr(10), p_name, chr(10), '---', chr(10), 'tail') AS md FROM {{part}}"""


def prompt_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts with their required keys, some missing or blank."""
    return files.prompts(inputs.run(spark, sf_dir, PROMPTS))


PROMPTS_SQL = """SELECT CAST(p_partkey AS STRING) AS key, CASE WHEN p_partkey % 3 = 0 THEN p_brand ELSE '' END AS agent, CAST(p_size AS STRING) AS version, CASE WHEN p_partkey % 5 < 4 THEN '2026-01-01' ELSE '' END AS last_modified,
  p_name || chr(10) || '---' || chr(10) || 'tail' AS body, sha256(p_name || chr(10) || '---' || chr(10) || 'tail') AS body_sha256, p_partkey % 3 = 0 AND p_partkey % 5 < 4 AS ok FROM part"""

QUERIES = {
    "object_store": (object_store, OBJECTS_SQL),
    "disagreement_objects": (disagreement_objects, DISAGREED_SQL),
    "telemetry_flushed": (telemetry_flushed, FLUSHED_SQL),
    "prompt_load": (prompt_load, PROMPTS_SQL),
    "store_last_writer": (store_last_writer, STORE_SQL),
    "paired_sinks": (paired_sinks, PAIRED_SQL),
    "telemetry_newest_days": (telemetry_newest_days, DAYS_SQL),
    "scorecard_of_runs": (scorecard_of_runs, STATES_SQL),
    "head_skip_bucketed": (head_skip_bucketed, BUCKETED_SQL),
    "global_ordinal": (global_ordinal, ORDINAL_SQL),
    "exact_percentiles": (exact_percentiles, PERCENTILES_SQL),
    "rate_limited_calls": (rate_limited_calls, LIMITED_SQL),
}
