"""Structured Streaming around the batch operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import versions


def once_per_key(stream: DataFrame, key: str = "key", time: str = "ts", lateness: str = "1 day") -> DataFrame:
    """Each key once within the watermark."""
    return stream.withWatermark(time, lateness).dropDuplicatesWithinWatermark([key])


def daily(stream: DataFrame, time: str = "ts", lateness: str = "1 hour") -> DataFrame:
    """Records, successes and cost of each UTC day."""
    days = stream.withWatermark(time, lateness).groupBy(F.window(time, "1 day"))
    return days.agg(F.count("*").alias("records"), F.count_if("success").alias("successes"), F.sum("cost_usd").alias("cost_usd")).select(F.to_date("window.start").alias("day"), "records", "successes", "cost_usd")


def ordered_sinks(stream: DataFrame, write_disagreements: Callable, write_records: Callable, checkpoint: str):
    """A started query that writes each batch's disagreements before its records, through writers of the caller's own. They are called again for a batch that was cut off; see paired_sinks for sinks that hold each row once."""
    def both(batch: DataFrame, _: int) -> None:
        batch.persist()
        try:
            write_disagreements(batch.where("overall = 'fail'"))
            write_records(batch)
        finally:
            batch.unpersist()

    return stream.writeStream.foreachBatch(both).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def verdict_tables(batch: DataFrame) -> dict[str, DataFrame]:
    """The failed records as disagreements, written first, and all records."""
    return {"disagreements": batch.where("overall = 'fail'"), "records": batch}


def paired_sinks(stream: DataFrame, root: str, checkpoint: str, writer: str, tables: Callable[[DataFrame], dict[str, DataFrame]] = verdict_tables):
    """A started query that writes what tables() makes of each batch, in order, as one commit of the versioned store at root.

    The commit carries the batch id under the writer's name. A batch cut off between two
    tables shows in neither and is written whole when the stream starts again; a batch that
    had been committed is left out, so each row is in all its tables once.
    """
    def commit(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            versions.commit(batch.sparkSession, root, tables(batch), writer, number)
        finally:
            batch.unpersist()

    return stream.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
