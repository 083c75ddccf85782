"""Gates and telemetry: thresholds, costs, verdicts, disagreements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .keyed import newest_groups
from .selection import exact_percentile

SLACK = 1e-9
MEDIAN_CEILING, RUN_CEILING = 0.03, 15.0
#: Floors by agent and field; anything else has the default.
DEFAULT_FLOOR = 0.90
FLOORS = {
    "Passport": {"name_latin": 0.98, "doc_number": 0.98, "expiry_date": 0.98},
    "PaymentReceipt": {"receipt_debit_account_number": 0.95, "receipt_credit_account_number": 0.95, "receipt_amount": 0.95, "receipt_time": 0.95},
    "DriverLicence": {"name_latin": 0.95, "doc_number": 0.95},
    "NationalID": {"id_card_number": 0.95, "name_latin": 0.95},
    "Visa": {"visa_class": 0.95, "valid_to": 0.95},
}


def floor_table(spark, floors: dict | None = None) -> DataFrame:
    rows = [(a, f, v) for a, fs in (floors or FLOORS).items() for f, v in fs.items()]
    return spark.createDataFrame(rows, "agent string, field string, floor double")


def with_floor(rates: DataFrame, floors: DataFrame, default: float = DEFAULT_FLOOR) -> DataFrame:
    """rates (agent, field, match_rate) with the floor of the field, else the default."""
    return rates.join(floors, ["agent", "field"], "left").withColumn("floor", F.coalesce("floor", F.lit(default)))


def breaches(rates: DataFrame, floors: DataFrame, default: float = DEFAULT_FLOOR) -> DataFrame:
    return with_floor(rates, floors, default).where(F.col("match_rate") + SLACK < F.col("floor"))


def breach_lines(below: DataFrame) -> DataFrame:
    """line: what each breach says, by agent and field."""
    return below.select(F.format_string("%s.%s: %.4f < %.4f", "agent", "field", "match_rate", "floor").alias("line"))


def canonical_four(results: DataFrame, fields: list[str]) -> DataFrame:
    """doc_key, passed: all of the pinned fields match exactly."""
    return results.where(F.col("field").isin(fields)).groupBy("doc_key").agg(F.bool_and("matched").alias("passed"), F.count("*").alias("compared"))


def successes(events: DataFrame) -> DataFrame:
    return events.where("success AND cost_usd IS NOT NULL")


def median_gate(events: DataFrame, days: int = 7, ceiling: float = MEDIAN_CEILING) -> DataFrame:
    """median_usd, records, days, passed over the successful records of the newest days.

    The median is exact and found by selection, so no task holds all costs.
    """
    kept = successes(newest_groups(events, "event_date", days))
    median = exact_percentile(kept, "cost_usd")
    out = kept.agg(F.lit(median).cast("double").alias("median_usd"), F.count("*").alias("records"), F.count_distinct("event_date").alias("days"))
    return out.withColumn("passed", F.col("median_usd").isNull() | (F.col("median_usd") <= ceiling))


def cost_per_document(attempts: DataFrame) -> DataFrame:
    return attempts.groupBy("source_key").agg(F.sum("cost_usd").alias("cost_usd"), F.count("*").alias("attempts"), F.count_if(~F.col("success")).alias("failures"))


def run_breach(total: Column, ceiling: float = RUN_CEILING) -> Column:
    return total > ceiling


def overall(audits: Column) -> Column:
    """Verdict of a map field -> agree, disagree or abstain: any disagree fails, else any abstain is uncertain, else pass."""
    values = F.map_values(audits)
    return F.when(F.exists(values, lambda v: v == "disagree"), "fail").when(F.exists(values, lambda v: v == "abstain"), "uncertain").otherwise("pass")


def overall_rows(audits: DataFrame, key: list[str]) -> DataFrame:
    """The same over rows (key, verdict)."""
    verdict = F.when(F.bool_or(F.col("verdict") == "disagree"), "fail").when(F.bool_or(F.col("verdict") == "abstain"), "uncertain").otherwise("pass")
    return audits.groupBy(*key).agg(verdict.alias("overall"), F.count("*").alias("fields"))


def override_overall(claimed: DataFrame, audits: str = "audits", column: str = "overall") -> DataFrame:
    """claimed with its overall verdict replaced by the one its audits give; `overridden` where they differ."""
    own = overall(F.col(audits))
    return claimed.withColumn("overridden", ~F.col(column).eqNullSafe(own)).withColumn(column, own)


def verdict(first: Column, second: Column) -> Column:
    """Verifier's word on a field from a second extraction: abstains where it has nothing."""
    return F.when(F.coalesce(second, F.lit("")) == "", "abstain").when(F.coalesce(first, F.lit("")) == second, "agree").otherwise("disagree")


def disagreements(audited: DataFrame) -> DataFrame:
    """Audited records that failed; uncertain ones are not written."""
    return audited.where("overall = 'fail'")
