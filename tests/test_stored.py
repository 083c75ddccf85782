"""Versioned store, paired sinks, calls under a rate limit, selection, places, buckets, pruned days, scorecard states."""

import bisect
import json
import os
import random
import statistics
import subprocess
import sys
import time
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from docspark.operators import evaluate, extract, keyed, selection
from docspark.plans import lifecycles
from docspark.sources import files, versions
from docspark.streaming import ingest, limited

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def texts(spark, *rows):
    return spark.createDataFrame(list(rows), "key string, md string, n int")


def state(spark, root, table="t"):
    found = versions.newest(spark, root, table, ["key"], ["n"])
    return None if found is None else {r["key"]: r["md"] for r in found.collect()}


def test_later_write_wins(spark, tmp_path):
    root = str(tmp_path / "s")
    assert versions.commits(spark, root) == [] and state(spark, root) is None
    assert versions.commit(spark, root, {"t": texts(spark, ("a", "zzz", 0), ("b", "b", 0))}) == 0
    assert versions.commit(spark, root, {"t": texts(spark, ("a", "aaa", 0))}) == 1  # the lesser text is the later one
    assert versions.commit(spark, root, {"t": texts(spark, ("c", "zz", 1), ("c", "aa", 2))}) == 2  # of one commit the greater order
    assert state(spark, root) == {"a": "aaa", "b": "b", "c": "aa"}
    assert versions.history(spark, root, "other") is None


def test_writer_that_is_killed_leaves_the_old_state(spark, tmp_path):
    root = str(tmp_path / "s")
    versions.commit(spark, root, {"t": texts(spark, ("a", "1", 0))})
    boom = texts(spark, ("a", "2", 0)).withColumn("md", F.raise_error(F.lit("killed")).cast("string"))
    with pytest.raises(Exception, match="killed"):
        versions.commit(spark, root, {"t": texts(spark, ("a", "2", 0)), "u": boom})
    assert state(spark, root) == {"a": "1"} and versions.history(spark, root, "u") is None
    assert versions.clean(spark, root) == 0 and versions.clean(spark, root, older_than_s=0) == 1  # what is young may still be written
    assert not [n for n in os.listdir(root) if n.startswith(".")]
    versions.commit(spark, root, {"t": texts(spark, ("a", "3", 0))})
    assert state(spark, root) == {"a": "3"}


def test_compaction_keeps_state_order_and_numbers(spark, tmp_path):
    root, tables = str(tmp_path / "s"), {"t": (["key"], ["n"]), "u": (["key"], ["n"])}
    assert versions.compact(spark, root, tables) is None
    for i in range(3):
        versions.commit(spark, root, {"t": texts(spark, ("a", f"{9 - i}", 0), (f"k{i}", "x", 0))}, "w", i)
    before = state(spark, root)
    reader = versions.newest(spark, root, "t", ["key"], ["n"])
    assert versions.compact(spark, root, tables) == 2 and state(spark, root) == before
    assert {r["key"]: r["md"] for r in reader.collect()} == before  # a reader from before still reads
    assert versions.commit(spark, root, {"t": texts(spark, ("a", "late", 0))}, "w", 2) is None  # its number was committed
    assert versions.commit(spark, root, {"t": texts(spark, ("a", "0", 0))}, "w", 3) == 3
    assert versions.commit(spark, root, {"u": texts(spark, ("z", "u", 0))}) == 4
    assert versions.compact(spark, root, tables) == 4
    assert state(spark, root) == before | {"a": "0"} and state(spark, root, "u") == {"z": "u"}
    assert sorted(n.split("-")[1] for n in os.listdir(root) if versions.NAME.fullmatch(n))[:1] != [] and versions.last_number(spark, root, "w") == 3
    assert len(versions.commits(spark, root)) == 1


def test_writers_at_once(spark, tmp_path):
    root = str(tmp_path / "s")
    with ThreadPoolExecutor(4) as pool:
        ordinals = list(pool.map(lambda i: versions.commit(spark, root, {"t": texts(spark, ("a", str(i), 0))}), range(6)))
    assert sorted(ordinals) == list(range(6)) and state(spark, root) == {"a": str(ordinals.index(5))}
    with pytest.raises(ValueError):
        versions.commit(spark, root, {}, "no-name")


def test_stream_cut_off_between_its_sinks(spark, tmp_path):
    source, root, checkpoint = (str(tmp_path / x) for x in ("in", "store", "checkpoint"))
    spark.range(40).selectExpr("id AS k", "IF(id % 4 = 0, 'fail', 'pass') AS overall").repartition(4).write.parquet(source)
    stream = lambda: spark.readStream.schema("k long, overall string").option("maxFilesPerTrigger", 1).parquet(source)
    cut = []

    def tables(batch):
        made = ingest.verdict_tables(batch)
        if versions.commits(spark, root) and not cut:  # the second batch: its first table is written, the second one fails
            cut.append(1)
            made["records"] = batch.withColumn("overall", F.raise_error(F.lit("killed")).cast("string"))
        return made

    query = ingest.paired_sinks(stream(), root, checkpoint, "audits", tables)
    with pytest.raises(Exception, match="killed"):
        query.awaitTermination()
    assert cut and len(versions.commits(spark, root)) == 1
    ingest.paired_sinks(stream(), root, checkpoint, "audits", tables).awaitTermination()
    rows = {t: sorted(r["k"] for r in versions.history(spark, root, t).collect()) for t in ("disagreements", "records")}
    assert rows == {"disagreements": list(range(0, 40, 4)), "records": list(range(40))}
    # a batch that was committed, but whose end the stream did not note, is not written again
    last = max(int(n) for n in os.listdir(os.path.join(checkpoint, "commits")) if n.isdigit())
    os.remove(os.path.join(checkpoint, "commits", str(last)))
    for crc in [n for n in os.listdir(os.path.join(checkpoint, "commits")) if n == f".{last}.crc"]:
        os.remove(os.path.join(checkpoint, "commits", crc))
    ingest.paired_sinks(stream(), root, checkpoint, "audits", tables).awaitTermination()
    assert versions.history(spark, root, "records").count() == 40


def test_calls_stay_within_the_rate(spark, tmp_path):
    folder, rate = str(tmp_path), 150.0

    def call(row, tier):
        n = int(row["key"])
        with open(f"{folder}/log", "a") as f:
            f.write(f"{time.time()}\n")
        if n % 10 == 0:
            raise extract.RateLimited
        if n % 3 == 0 and not os.path.exists(f"{folder}/{n}"):
            open(f"{folder}/{n}", "w").close()
            raise extract.RateLimited
        if n % 7 == 1 and tier == "rules":
            raise extract.Invalid("more")
        if n % 11 == 5:
            raise OSError("down")
        return extract.Answer({"n": str(n)}, "svc", "m", 0.5)

    rows = spark.createDataFrame([(i, str(i), "Visa", "t") for i in range(1_000)], "ordinal long, key string, doc_type string, text string")
    got = {r["ordinal"]: r for r in limited.extract_limited(rows, call, rate, lanes=4, above={"rules": "big"}, base=0.2, timeout_s=120).collect()}
    assert len(got) == 1_000

    def want(n):
        if n % 10 == 0:
            return "rate_limited", [("rules", False)] * 3
        turned = [("rules", False)] * (n % 3 == 0)
        raised = [("rules", False)] * (n % 7 == 1)
        last = [("big" if raised else "rules", n % 11 != 5)]
        return ("passed" if n % 11 != 5 else "provider_unavailable"), turned + raised + last

    for n, r in got.items():
        assert (r["status"], [(a["tier"], a["success"]) for a in r["attempts"]]) == want(n), n
    assert got[2]["fields"] == {"n": "2"} and got[2]["attempts"][0]["cost_usd"] == 0.5
    at = sorted(float(x) for x in open(f"{folder}/log"))
    assert len(at) == sum(len(want(n)[1]) for n in range(1_000))
    for seconds in (2, 4):  # a window holds its share, what was saved up, and what a batch calls late
        assert max(bisect.bisect(at, t + seconds) - i for i, t in enumerate(at)) <= rate * (seconds + 1) + rate


def test_no_rows_and_bad_limits(spark):
    none = spark.createDataFrame([], "ordinal long, key string, doc_type string, text string")
    assert limited.extract_limited(none, extract.rule_extractor, 10.0, lanes=2).count() == 0
    with pytest.raises(ValueError):
        limited.answers(none, extract.rule_extractor, 0.0)


@pytest.mark.parametrize("fraction", [0.0, 0.25, 0.5, 0.99, 1.0])
def test_percentile_by_selection(spark, fraction):
    draw = random.Random(3)
    for values in ([1.0], [2.0, 1.0], [5.0] * 3_000 + [7.0] * 3_000, [draw.expovariate(1) ** 9 for _ in range(5_000)], [-0.5, 1e300, -1e300] * 50 + list(range(2_000))):
        df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
        exact = df.agg(F.percentile("v", fraction)).first()[0]
        assert selection.exact_percentile(df, "v", fraction, hold=100) == pytest.approx(exact, rel=1e-12)
    assert selection.exact_percentile(spark.createDataFrame([], "v double"), "v") is None


def test_median_of_many_different_costs(spark):
    df = spark.range(2_000_001).selectExpr("CAST(pmod(xxhash64(id), 1000003) * 1000003 + id AS DOUBLE) AS v")
    assert selection.exact_percentile(df, "v", hold=10_000) == df.agg(F.percentile("v", 0.5)).first()[0]
    assert selection.exact_percentile(spark.createDataFrame([(float(x),) for x in (3, 1, 2, 10)], "v double"), "v") == statistics.median([3, 1, 2, 10])


def test_places_do_not_depend_on_partitions(spark, tmp_path):
    rows = [(random.Random(i).randrange(50), f"k{i}") for i in range(3_000)]
    results = []
    for n in (1, 4, 16):
        placed = keyed.placed(spark.createDataFrame(rows, "day int, key string").repartition(n, "key"), ["day"])
        results.append(sorted((r["ordinal"], r["key"], r["day"]) for r in placed.collect()))
    assert results[0] == results[1] == results[2] and [r[0] for r in results[0]] == list(range(3_000)) and [r[2] for r in results[0]] == sorted(r[0] for r in rows)
    path = tmp_path / "keys.txt"
    path.write_text("\n".join(f"key-{random.Random(i).randrange(10**6)}-{i}" if i % 5 else "# note" for i in range(20_000)))
    want = [x for x in path.read_text().split("\n") if not x.startswith("#")]
    for size in ("20000", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            assert [r["key"] for r in sorted(files.numbered_keys(spark, str(path)).collect())] == want
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_buckets_move_no_rows(spark, tmp_path):
    keys = keyed.bucketed(spark.range(1_000).selectExpr("id AS key", "id * 2 AS v"), "test_keys", buckets=8, path=str(tmp_path / "a"))
    done = keyed.bucketed(spark.range(0, 1_000, 3).selectExpr("id AS key"), "test_done", buckets=8, path=str(tmp_path / "b"))
    spark.range(1, 1_000, 3).selectExpr("id AS key").write.insertInto("test_done")  # later analyses
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = keyed.pending(keys, spark.table("test_done"))
        assert sorted(r["key"] for r in left.collect()) == list(range(2, 1_000, 3)) and done.count() == 667
        assert "Exchange" not in left._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE test_keys")
        spark.sql("DROP TABLE test_done")


def test_newest_days_alone_are_read(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(f"2026-01-{d:02d}T00:00:00Z", str(d), 0.1 * d, True) for d in range(1, 31)]
    files.append_telemetry(spark.createDataFrame(rows, "timestamp string, source_key string, cost_usd double, success boolean"), path)
    got = files.newest_telemetry(spark, path)
    assert sorted(r["source_key"] for r in got.collect()) == [str(d) for d in range(24, 31)]
    assert {f.rsplit("/", 2)[-2] for f in got.inputFiles()} == {f"event_date=2026-01-{d}" for d in range(24, 31)}
    assert "PartitionFilters: [event_date" in got._jdf.queryExecution().executedPlan().toString()
    assert files.newest_telemetry(spark, str(tmp_path / "none")).count() == 0


def test_states_of_runs_merge(spark):
    draw = random.Random(2)
    rows = [(i, draw.choice("AB"), draw.choice(["NZ", "CN"]), draw.choice(["f", "g", "h"]), draw.choice(["", "1", "2"]), draw.choice(["", "1", "2"])) for i in range(2_000)]
    df = spark.createDataFrame(rows, "doc_key int, agent string, jurisdiction string, field string, expected string, actual string").withColumn("matched", F.col("expected") == F.col("actual"))
    states = None
    for n in range(10):
        part = evaluate.partial(df.where(F.col("doc_key") % 10 == n))
        states = part if states is None else states.unionByName(part)
    order = lambda d: sorted(map(str, d.collect()))
    for kept in (states, evaluate.merged(states)):
        assert order(evaluate.of_states(kept, ["agent"])) == order(evaluate.by_agent(df))
        assert order(evaluate.of_states(kept, ["jurisdiction", "agent"])) == order(evaluate.by_jurisdiction(df))
        assert order(evaluate.fields_of_states(kept)) == order(evaluate.by_field(df))
    assert evaluate.merged(states).count() <= 12


def test_entry_works_without_what_the_training_part_needs():
    code = "import sys, json; sys.modules['ahocorasick'] = None; import __spark_entry__ as e; q = e.queries(); print(json.dumps([len(q), any(n.startswith('op') for n in q), len(set(e.oracle_sql()) - set(q))]))"
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=ROOT, check=True)
    n, any_op, extra = json.loads(out.stdout.strip().splitlines()[-1])
    assert n >= 118 and not any_op and not extra


def test_extraction_under_a_rate(spark):
    keys = spark.createDataFrame([(i, f"k{i}", "Visa", "Visa Class: B") for i in range(40)], "ordinal long, key string, doc_type string, text string")
    done = spark.createDataFrame([("k3",)], "key string")
    plain = lifecycles.extract_new(keys, done, extract.by_registry)
    slow = lifecycles.extract_new(keys, done, extract.by_registry, rate=500.0, concurrency=2)
    shown = lambda d: sorted((r["ordinal"], r["key"], r["status"], str(r["fields"]), len(r["attempts"])) for r in d.collect())
    assert shown(slow) == shown(plain) and slow.where("status = 'skipped'").count() == 1


def test_rows_with_tokens_never_enter_state():
    """Only what has to wait costs state: here the rows turned away, and those beyond the tokens."""
    class Value:
        held = None
        get = lambda self: self.held

        def update(self, v):
            self.held = v

    class Map(dict):
        puts = 0
        getValue, removeKey = dict.__getitem__, dict.__delitem__

        def updateValue(self, k, v):
            self.puts += 1
            self[k] = v

    class Handle:
        timers = []
        listTimers = lambda self: list(self.timers)
        deleteTimer = lambda self, t: self.timers.remove(t)
        registerTimer = lambda self, t: self.timers.append(t)

    class Clock:
        now = 1_000
        getCurrentProcessingTimeInMs = lambda self: self.now

    def call(row, tier):
        if row["ordinal"] == 3 and not seen.get(3):
            seen[3] = True
            raise extract.RateLimited
        if row["ordinal"] == 4 and tier == "rules":
            raise extract.Invalid("more")
        return {}

    seen, lane, clock = {}, limited.Lane(call, "rules", {"rules": "big"}, 100.0, 100.0, 3, 0.05), Clock()
    lane.handle, lane.bucket, lane.waiting = Handle(), Value(), Map()
    rows = [{"ordinal": i, "key": str(i), "doc_type": "Visa", "text": ""} for i in range(120)]
    first = list(lane.handleInputRows((0,), iter(rows), clock))
    assert len(first) == 98 and lane.waiting.puts == 22 and len(Handle.timers) == 1  # 100 calls: one turned away, one asked twice
    clock.now = 2_000
    rest = list(lane.handleExpiredTimer((0,), clock, None))
    assert sorted(r["ordinal"] for r in first + rest) == list(range(120)) and not lane.waiting and not Handle.timers


class Value:
    held = None
    get = lambda self: self.held

    def update(self, v):
        self.held = v


class Waiting(dict):
    """Stands for a lane's map state, each put of which takes a millisecond."""

    puts = 0
    getValue, removeKey = dict.__getitem__, dict.__delitem__

    def updateValue(self, k, v):
        time.sleep(0.001)
        self.puts += 1
        self[k] = v


class Timers(list):
    listTimers, deleteTimer, registerTimer = list.copy, list.remove, list.append


class Clock(int):
    getCurrentProcessingTimeInMs = int.__int__


def lane_of(call, rate, burst, base=0.02):
    lane = limited.Lane(call, "rules", {"rules": "big"}, rate, burst, 3, base)
    lane.handle, lane.bucket, lane.waiting = Timers(), Value(), Waiting()
    return lane


def some_rows(n):
    return iter([{"ordinal": i, "key": str(i), "doc_type": "Visa", "text": ""} for i in range(n)])


def test_tokens_that_come_in_during_a_batch_are_spent_in_it():
    lane = lane_of(lambda row, tier: time.sleep(0.002) or {}, 1_000.0, 200.0)
    assert len(list(lane.handleInputRows((0,), some_rows(400), Clock(1_000)))) == 400 and lane.waiting.puts == 0 and not lane.handle


@pytest.mark.parametrize("hold", [limited.HELD, 0])
def test_rows_turned_away_are_asked_again_in_the_batch(monkeypatch, hold):
    monkeypatch.setattr(limited, "HELD", hold)
    seen = set()

    def call(row, tier):
        time.sleep(0.002)
        if row["ordinal"] < 10 and row["ordinal"] not in seen:
            seen.add(row["ordinal"])
            raise extract.RateLimited
        return {}

    lane = lane_of(call, 1_000.0, 200.0)
    out = list(lane.handleInputRows((0,), some_rows(100), Clock(1_000)))
    assert lane.waiting.puts == (0 if hold else 10) and len(out) == 100 - lane.waiting.puts
    assert bool(lane.handle) == bool(lane.waiting)
    out += list(lane.handleExpiredTimer((0,), Clock(5_000), None)) if lane.waiting else []
    assert sorted((r["ordinal"], len(json.loads(r["attempts"]))) for r in out) == [(i, 2 if i < 10 else 1) for i in range(100)] and not lane.waiting


def test_a_lane_stays_within_its_rate_and_wakes_until_all_is_settled(monkeypatch):
    """Each batch spends what was saved up and what came in since at most, and what waits always has a timer."""
    monkeypatch.setattr(limited, "SPAN", 300)
    at, turned = [], {}

    def call(row, tier):
        at.append(time.monotonic())
        turned[row["ordinal"]] = turned.get(row["ordinal"], 0) + 1
        if row["ordinal"] % 5 == 0 and turned[row["ordinal"]] < 3 or row["ordinal"] % 25 == 0:
            raise extract.RateLimited
        if row["ordinal"] % 7 == 1 and tier == "rules":
            raise extract.Invalid("more")
        return {}

    lane, now, out = lane_of(call, 200.0, 20.0), 1_000, []
    began = time.monotonic()
    out += list(lane.handleInputRows((0,), some_rows(300), Clock(now)))
    batches, most = 1, lambda n, passed: n <= 20 + 200 * passed + 1
    assert all(most(i + 1, t - began) for i, t in enumerate(at)) and len(at) > 20
    while lane.waiting:
        assert len(lane.handle) == 1 and lane.handle[0] > now
        now, calls, began = max(lane.handle[0], lane.bucket.held[1]), len(at), time.monotonic()
        out += list(lane.handleExpiredTimer((0,), Clock(now), None))
        assert all(most(i + 1, t - began) for i, t in enumerate(at[calls:]))
        batches += 1
    assert not lane.handle and sorted(r["ordinal"] for r in out) == list(range(300)) and batches < 1_000
    for r in out:
        n = r["ordinal"]
        assert r["status"] == ("rate_limited" if n % 25 == 0 else "passed") and len(json.loads(r["attempts"])) == (3 if n % 5 == 0 else 1) + (n % 7 == 1 and n % 25 != 0), n


@pytest.mark.parametrize("lanes", [1, 4, 8, 10, 60])
def test_each_lane_has_a_partition_of_its_own(spark, lanes):
    found = spark.createDataFrame([(n,) for n in limited.numbers(spark, lanes)], "lane int")
    assert sorted(r["p"] for r in found.select(F.expr(f"pmod(hash(lane), {lanes})").alias("p")).collect()) == list(range(lanes))
    rows = found.repartition(lanes, "lane").withColumn("p", F.spark_partition_id()).collect()
    assert len({r["p"] for r in rows}) == lanes
