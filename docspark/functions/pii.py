"""Privacy tripwire over serialised lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Patterns and field names that telemetry must never hold.
PATTERNS = {
    "cjk": "[一-鿿]",
    "mask": r"\*{2,}",
    "nz_account": r"\d{2}-\d{4}-\d{7}-\d{2}",
    "ssn": r"\d{3}-\d{2}-\d{4}",
    "cn_id": r"\d{18}",
    "dob": r"\d{4}-\d{2}-\d{2}(?!T)",
    "mrz": "P<[A-Z]{3}",
}
FIELDS = ["name_latin", "name_cjk", "dob", "id_card_number", "passport_number", "mrz_line_1", "mrz_line_2", "receipt_debit_account_name", "receipt_debit_account_number", "receipt_credit_account_name", "receipt_credit_account_number", "receipt_counterparty_name", "receipt_counterparty_account", "place_of_birth"]


def hits(line: Column) -> Column:
    """Names of the patterns and fields found in a line."""
    found = [F.when(line.rlike(p), name) for name, p in PATTERNS.items()]
    found += [F.when(F.contains(line, F.lit(f'"{name}"')), "field:" + name) for name in FIELDS]
    return F.filter(F.array(*found), lambda x: x.isNotNull())
