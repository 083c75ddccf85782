"""Calls under a rate limit, without tasks that sleep: rows wait in state for their turn.

Rows are dealt to lanes, one for each call that may be under way. A lane holds its waiting
rows in a map by the time they are due, and a token bucket with its share of the allowed
rate, so all lanes together stay within the rate wherever their tasks run. A lane calls for
the rows that are due while it has tokens, those that come in while it works included; a row
that is turned away is due again when its delay has passed. What is not due or has no token
by the end of a batch is put in state, where each row costs far more than a call's own
overhead, and a timer wakes the lane for what comes first. Attempts, escalation and results
are those of operators.extract.

Where a batch is cut off, Spark runs it again from the state before: a call may be made
twice then, but each row has one result in a sink that keeps batches apart, such as files or
the versioned store.
"""

from __future__ import annotations

import heapq
import json
import math
import random
import time
from collections.abc import Callable, Iterator
from urllib.parse import unquote

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators import extract
from ..session import shared_folder

WAITING = "ordinal long, key string, doc_type string, text string, tier string, n int, made string"
RESULT = "ordinal long, key string, doc_type string, fields string, status string, error string, attempts string, lane int"
#: Fewest rows of a file that a trigger reads.
PER_FILE = 10_000
#: Milliseconds of a batch whose tokens may be spent in it. What was called in it is called again where it is cut off.
SPAN = 10_000
#: Milliseconds after which a lane counts the tokens that came in since.
STEP = 100
#: Characters of rows turned away (and 1,000 for each row) that a lane holds in memory within a batch; more of them wait in state.
HELD = 16 << 20
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Lane(StatefulProcessor):
    """Calls of one lane: at most `burst` at once and `rate` a second on end."""

    def __init__(self, call: Callable, tier: str, above: dict[str, str], rate: float, burst: float, tries: int, base: float):
        self.call, self.tier, self.above, self.rate, self.burst, self.tries, self.base = call, tier, above, rate, burst, tries, base

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.bucket = handle.getValueState("bucket", "tokens double, at long, arrivals long")
        self.waiting = handle.getMapState("waiting", "at long, arrival long", WAITING)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        now = timerValues.getCurrentProcessingTimeInMs()
        tokens, at, arrivals = self.bucket.get() or (self.burst, now, 0)
        self.bucket.update((tokens, at, arrivals))
        yield from self.served(key[0], now, rows)  # what waits comes first

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self.served(key[0], timerValues.getCurrentProcessingTimeInMs())

    def served(self, lane: int, now: int, rows: Iterator[Row] = ()) -> Iterator[Row]:
        """Results of the rows that are due and then of new ones, as far as the tokens go. Only what has to wait beyond this batch is put in state.

        Tokens come in while the batch works, and a row that was turned away is asked for again in it if its delay passes by then.
        """
        tokens, at, arrivals = self.bucket.get()
        start, began = max(now, at), time.monotonic()
        tokens, at = min(self.burst, tokens + (start - at) * self.rate / 1000), start
        n = int(tokens)
        due = heapq.nsmallest(n + 1, self.waiting.keys())
        left = due.pop() if len(due) > n else None  # one more tells when to wake
        held, size = [], 0

        def clock() -> int:
            """Now, no later than SPAN after the start. Its tokens are counted."""
            nonlocal tokens, at
            to = start + min(SPAN, int(1000 * (time.monotonic() - began)))
            if to - at >= STEP:
                tokens, at = min(self.burst, tokens + (to - at) * self.rate / 1000), to
            return to

        def put(place, value):
            nonlocal left
            self.waiting.updateValue(place, value)
            left = min(left or place, place)

        def called(place, ordinal, key, doc_type, text, tier, n, attempts):
            """The result row, or none if the row goes on waiting: an answer that is asked for one tier up is asked for at once while there are tokens."""
            nonlocal tokens, size
            while tokens >= 1:
                tokens -= 1
                settled, (tier, n, turned_away) = extract.step(self.call, {"ordinal": ordinal, "key": key, "doc_type": doc_type, "text": text}, tier, n, attempts, self.above, doc_type, self.tries)
                if settled:
                    fields, status, error = settled
                    return Row(ordinal=ordinal, key=key, doc_type=doc_type, fields=json.dumps(fields), status=status, error=error, attempts=json.dumps(attempts), lane=lane)
                if turned_away:
                    place = clock() + math.ceil(1000 * extract.wait(n, self.base, random.Random(place[1]))), place[1]
                    if size < HELD:
                        size += 1_000 + len(text or "")
                        heapq.heappush(held, (place, (ordinal, key, doc_type, text, tier, n, attempts)))
                        return None
                    break
            put(place, (ordinal, key, doc_type, text, tier, n, json.dumps(attempts)))
            return None

        def again() -> Iterator[Row]:
            """Results of the rows held that are due by now."""
            nonlocal size
            while held and held[0][0][0] <= clock() and tokens >= 1:
                place, value = heapq.heappop(held)
                size -= 1_000 + len(value[3] or "")
                result = called(place, *value)
                if result:
                    yield result

        for place in due:
            if place[0] > clock() or tokens < 1:
                left = min(left or place, place)
                continue
            *row, made = self.waiting.getValue(place)
            self.waiting.removeKey(place)
            result = called(place, *row, json.loads(made))
            if result:
                yield result
            yield from again()
        for row in rows:
            result = called((clock(), arrivals), row["ordinal"], row["key"], row["doc_type"], row["text"], self.tier, 0, [])
            arrivals += 1
            if result:
                yield result
            yield from again()
        for place, (*row, attempts) in held:
            put(place, (*row, json.dumps(attempts)))
        now = clock()
        self.bucket.update((tokens, at, arrivals))
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        if left:
            token = at + max(1, math.ceil((1 - tokens) * 1000 / self.rate))
            self.handle.registerTimer(max(left[0], token if tokens < 1 else now + 1))


def numbers(spark: SparkSession, lanes: int) -> list[int]:
    """A number for each lane, such that a shuffle into as many partitions gives each a partition of its own. The numbers from 0 on share some, and their lanes would wait for each other."""
    found = spark.range(0, 50 * lanes, 1, 1).groupBy(F.pmod(F.hash(F.col("id").cast("int")), F.lit(lanes)).alias("p")).agg(F.min("id").alias("id")).collect()
    return sorted(r["id"] for r in found) if len(found) == lanes else list(range(lanes))


def answers(stream: DataFrame, call: Callable, rate: float, lanes: int = 10, tier: str = "rules", above: dict[str, str] | None = None, burst: float | None = None, tries: int = 3, base: float = 1.0) -> DataFrame:
    """A result row for each row of a stream (ordinal, key, doc_type, text), by at most `rate` calls a second.

    burst (all lanes together, a second's calls unless given, one a lane at least) is what an
    idle time may save up; it should cover the time between two batches. State needs the
    RocksDB provider. What a trigger may read should be bounded by the source, so that rows
    wait there and not in state.
    """
    if rate <= 0 or lanes < 1 or tries < 1:
        raise ValueError("rate, lanes and tries must be positive")
    place = F.pmod(F.xxhash64("key"), F.lit(lanes)).cast("int")
    dealt = stream.select(F.col("ordinal").cast("long").alias("ordinal"), "key", "doc_type", "text", F.get(F.lit(numbers(stream.sparkSession, lanes)), place).alias("lane"))
    lane = Lane(call, tier, above or {}, rate / lanes, max(1.0, (burst or rate) / lanes), tries, base)
    out = dealt.groupBy("lane").transformWithState(lane, RESULT, "Append", "ProcessingTime")
    kinds = dict(f.split(" ", 1) for f in ("fields map<string,string>", f"attempts array<{extract.ATTEMPT}>"))
    return out.select(*[F.from_json(c, kinds[c]).alias(c) if c in kinds else F.col(c) for c in out.columns if c != "lane"])


def extract_limited(rows: DataFrame, call: Callable, rate: float, lanes: int = 10, trigger: str = "500 milliseconds", timeout_s: float | None = None, **options) -> DataFrame:
    """Results of all rows (ordinal, key, doc_type, text), like operators.extract.extract but by at most `rate` calls a second. Runs a stream over them until each row is settled."""
    spark = rows.sparkSession
    source, sink, checkpoint = (shared_folder(spark) for _ in range(3))
    some = rows.select("ordinal", "key", "doc_type", "text")
    # files of a trigger's worth of calls, read one by one: later rows wait in them and not in state
    some.write.option("maxRecordsPerFile", max(PER_FILE, math.ceil(options.get("burst") or rate))).parquet(source)
    total, schema = spark.read.parquet(source).count(), "ordinal long, key string, doc_type string, fields map<string,string>, status string, error string, attempts array<" + extract.ATTEMPT + ">"
    wanted = {"spark.sql.streaming.stateStore.providerClass": ROCKS, "spark.sql.shuffle.partitions": str(lanes)}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        stream = spark.readStream.schema(spark.read.parquet(source).schema).option("maxFilesPerTrigger", 1).parquet(source)
        query = answers(stream, call, rate, lanes, **options).writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).trigger(processingTime=trigger).start()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    began, seen, done, counted = time.monotonic(), -1, 0, set()
    try:
        while done < total:
            if query.exception():
                raise query.exception()
            if timeout_s is not None and time.monotonic() - began > timeout_s:
                raise TimeoutError(f"{total - done} of {total} rows are not settled")
            last = query.lastProgress
            if last and last["batchId"] != seen:
                seen = last["batchId"]
                new = set(spark.read.schema(schema).parquet(sink).inputFiles()) - counted
                done += spark.read.schema(schema).parquet(*map(unquote, new)).count() if new else 0
                counted |= new
            time.sleep(0.1)
    finally:
        query.stop()
    return spark.read.schema(schema).parquet(sink) if total else spark.createDataFrame([], schema)
