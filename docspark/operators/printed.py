"""Rules on what a document prints: which of several printed values counts, and what is only flagged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codes
from ..functions.dates import checked
from ..functions.text import clean_name, strip
from . import receipts

#: English labels of the two sides of a receipt, which count where no Chinese label is printed.
ENGLISH = {"receipt_debit_account_name": ["payer", "payer name", "from name"], "receipt_credit_account_name": ["payee", "payee name", "to name", "beneficiary"]}
#: Kinds of issuer of a proof of address, the most trusted first.
ISSUERS = ["government", "utility", "bank", "other"]
OWNER_SHARE, FRESH_MONTHS = 25.0, 3


def sides(df: DataFrame, body: str = "body") -> DataFrame:
    """df with both account names: the Chinese label's value, else the English label's, else ''. A missing side stays ''."""
    made = receipts.once(df, _pairs=receipts.pairs(F.col(body)), _lines=F.transform(F.split(body, "\n"), lambda x: F.struct(F.lower(strip(F.regexp_replace(F.substring_index(x, ":", 1), r"^[\s*-]+|[\s*]+$", ""))).alias("label"), F.when(F.contains(x, F.lit(":")), F.substring(x, F.locate(":", x) + 1, F.length(x))).alias("value"))))
    chinese = receipts.cn_receipt(F.col("_pairs"))
    english = lambda labels: F.get(F.filter("_lines", lambda p: p["label"].isin(labels) & (strip(p["value"]) != "")), F.lit(0))["value"]
    return made.select(*df.columns, *[F.coalesce(F.nullif(chinese[n], F.lit("")), strip(clean_name(english(labels))), F.lit("")).alias(n) for n, labels in ENGLISH.items()])


def earliest(pages: DataFrame, key: str, page: str, value: str, is_header: Column) -> DataFrame:
    """key, value of the earliest page where is_header holds."""
    return pages.where(is_header).groupBy(key).agg(F.min_by(value, page).alias(value))


def authority(name: Column, title: Column) -> Column:
    """`Name, Title`; either alone where the other is missing or blank."""
    filled = lambda c: F.nullif(strip(c), F.lit(""))
    return F.concat_ws(", ", filled(name), filled(title))


def share(c: Column) -> Column:
    """The first number of a printed share, `25.5 %` or `25 percent`; null without one."""
    return F.regexp_extract(c, r"(\d+(?:\.\d+)?)", 1).try_cast("double")


def major_owners(owners: DataFrame, printed: str, least: float = OWNER_SHARE) -> DataFrame:
    """Owners of `least` percent or more, with `percent`. Extraction keeps all owners; this filter is for its users."""
    return owners.withColumn("percent", share(F.col(printed))).where(F.col("percent") >= least)


def best_issuer(rows: DataFrame, key: str, issuer: str) -> DataFrame:
    """key, issuer: the most trusted kind; kinds that are not listed come last."""
    rank = F.array_position(F.array(*[F.lit(x) for x in ISSUERS]), F.lower(F.col(issuer)))
    return rows.groupBy(key).agg(F.min_by(issuer, F.when(rank > 0, rank).otherwise(len(ISSUERS) + 1)).alias(issuer))


def fresh(date: Column, as_of: Column, months: int = FRESH_MONTHS) -> Column:
    """The document is at most `months` old on the day as_of; null without a date."""
    return checked(date) >= F.add_months(as_of.cast("date"), -months)


def residence(residential: Column, postal: Column, notes: Column) -> tuple[Column, Column]:
    """Applicant's address and notes: the residential address, else the postal one; a postal address that is not used goes to the notes."""
    home, post, note = (F.coalesce(strip(c), F.lit("")) for c in (residential, postal, notes))
    unused = F.when((home != "") & (post != "") & (post != home), F.concat(F.lit("Postal: "), post))
    return F.when(home != "", home).otherwise(post), F.concat_ws("; ", F.nullif(note, F.lit("")), unused)


def printed_name(printed: Column, signature: Column) -> Column:
    """The printed name, else the one read from the signature."""
    return F.coalesce(F.nullif(strip(printed), F.lit("")), strip(signature), F.lit(""))


def identity_mismatch(number: Column, dob: Column, sex: Column) -> Column:
    """Names, sorted, of the printed fields that an 18-character identity number contradicts, and `check` where its own digit is wrong. Printed values are never changed."""
    inside = codes.cn_id_fields(number)
    differs = lambda c, own: (F.coalesce(c, F.lit("")) != "") & (c != own)
    found = [F.when(~inside["check_ok"], "check"), F.when(differs(dob, inside["dob"]), "dob"), F.when(differs(sex, inside["sex"]), "sex")]
    return F.when(codes.id_shape(F.upper(number)) == "CN", F.filter(F.array(*found), lambda x: x.isNotNull())).otherwise(F.array().cast("array<string>"))
