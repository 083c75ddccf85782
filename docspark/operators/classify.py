"""Rule-based classification of a text into one of the fifteen types and a jurisdiction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codes

#: Cues of each type, as patterns on lower-cased text. A type scores one for each cue found.
CUES = {
    "Passport": ["p<[a-z]{3}", r"\bpassport\b", "护照"],
    "DriverLicence": ["driver.?licen[cs]e", "机动车驾驶证", r"class [0-9ab]\b"],
    "NationalID": ["居民身份证", "身分證", "identity card", r"\bnric\b"],
    "Visa": [r"\bvisa\b", "entries allowed|number of entries", "valid from"],
    "PaymentReceipt": ["付款|payer", "收款|payee", "金额|amount"],
    "BankStatement": ["statement period", "opening balance", "closing balance"],
    "BankAccountConfirmation": ["confirm.{0,40}account", "branch manager", "to whom it may concern"],
    "PEP_Declaration": ["politically exposed|are you a pep", "relationship to pep|pep role", "declarant"],
    "VerificationReport": ["verification (report|outcome|result)", "trulioo|onfido|jumio", "subject"],
    "ApplicationForm": ["application (form|date|type)", "applicant", "i declare that"],
    "CompanyExtract": ["companies office|companies house|工商|营业执照", "registration number|company number", "directors|shareholders"],
    "EntityOwnership": ["beneficial owner", "ownership percentage|% owned", r"\bubo\b"],
    "ProofOfAddress": ["utility bill|rates notice|户口本", "service address|residential address", "bill date|amount due"],
    "TaxResidency": [r"\bfatca\b|\bcrs\b|w-8ben|w-9", "tax residen", r"\btin\b|tax identification"],
}
#: Where both of a pair fit equally, the first is the more specific.
PREFER = [("BankStatement", "ProofOfAddress"), ("Passport", "NationalID")]
#: Registries and currencies that tell the jurisdiction.
PLACES = [("companies office", "NZ"), ("companies house", "GB"), ("工商", "CN"), (r"\bnzd\b", "NZ"), (r"\bcny\b", "CN"), (r"\busd\b", "US")]
LEAST = 2


def scores(text: Column) -> dict[str, Column]:
    low = F.lower(F.coalesce(text, F.lit("")))
    return {t: sum((F.when(low.rlike("(?d)" + c), 1).otherwise(0) for c in cues), F.lit(0)) for t, cues in CUES.items()}


def classify(df: DataFrame, column: str = "text") -> DataFrame:
    """df with doc_type, jurisdiction and doc_subtype. The type with most cues wins if it has LEAST of them; a tie that no preference settles is Other."""
    scored = df.select("*", *[c.alias("_s_" + t) for t, c in scores(F.col(column)).items()])
    value = {t: F.col("_s_" + t) for t in CUES}
    for first, second in PREFER:
        value[second] = F.when(value[first] == value[second], value[second] - 0.5).otherwise(value[second].cast("double"))
    value = {t: c.cast("double") for t, c in value.items()}
    best = F.greatest(*value.values())
    winners = F.filter(F.array(*[F.when(c == best, t) for t, c in value.items()]), lambda x: x.isNotNull())
    doc_type = F.when((best >= LEAST) & (F.size(winners) == 1), winners[0]).otherwise("Other")
    low = F.lower(F.coalesce(F.col(column), F.lit("")))
    mrz = F.regexp_extract(column, "P<([A-Z]{3})", 1)
    place = F.when(mrz != "", codes.country2(mrz))
    for pattern, code in PLACES:
        place = place.when(low.rlike(pattern), code)
    return scored.select(*df.columns, doc_type.alias("doc_type"), place.otherwise("OTHER").alias("jurisdiction"), F.lit("").alias("doc_subtype"))
