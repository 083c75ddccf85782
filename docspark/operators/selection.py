"""Exact order statistics without sorting or gathering all values.

A sketch of all values brackets the wanted rank, exact counts of what lies below and inside
the bracket confirm it, and the next pass looks inside alone: each pass leaves about a
thousandth of the different values. When few enough are left, they are counted by value and
read off by one task, `hold` values at most (and the sketch's error of about a twentieth).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 10_000


def exact_percentile(df: DataFrame, column: str, fraction: float = 0.5, hold: int = 100_000) -> float | None:
    """The percentile of a numeric column, between two neighbours if need be; nulls do not count; None without values."""
    values = df.select(F.col(column).cast("double").alias("v")).where("v IS NOT NULL")
    first = values.agg(F.count("*").alias("n"), F.approx_count_distinct("v").alias("d")).first()
    if not first["n"]:
        return None
    place = fraction * (first["n"] - 1)
    low, high = math.floor(place), math.ceil(place)
    below, inside, different, margin = 0, first["n"], first["d"], 2 / ACCURACY
    while different > hold:
        wanted = [max(0.0, (low - below) / inside - margin), min(1.0, (high + 1 - below) / inside + margin)]
        a, b = values.agg(F.percentile_approx("v", wanted, ACCURACY)).first()[0]
        held = F.col("v").between(a, b)
        now = values.agg(F.count_if(F.col("v") < a).alias("less"), F.count_if(held).alias("n"), F.approx_count_distinct(F.when(held, F.col("v"))).alias("d")).first()
        if below + now["less"] > low or below + now["less"] + now["n"] <= high:  # the sketch missed
            margin *= 4
            continue
        values, below, inside, different = values.where(held), below + now["less"], now["n"], now["d"]
    counted = values.groupBy("v").agg(F.count("*").alias("n"))
    upto = counted.select("v", (F.sum("n").over(Window.orderBy("v")) + below).alias("upto"))
    found = upto.agg(F.min(F.when(F.col("upto") > low, F.col("v"))).alias("low"), F.min(F.when(F.col("upto") > high, F.col("v"))).alias("high")).first()
    if low == high or found["low"] == found["high"]:
        return found["low"]
    return (high - place) * found["low"] + (place - low) * found["high"]
