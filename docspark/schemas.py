"""The fifteen record types: closed schemas whose column order is part of the contract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Field names, in order. [] marks an array of strings, {} an array of owners.
BASE = "extractor_version extraction_provider extraction_model extraction_timestamp prompt_version doc_type doc_subtype jurisdiction name_latin name_cjk"
_ID = "doc_number dob issue_date expiry_date place_of_birth sex"
_BANK = "bank_name account_holder_name account_number account_type currency"
OWN = {
    "Passport": f"{_ID} passport_number nationality mrz_line_1 mrz_line_2",
    "DriverLicence": f"{_ID} licence_class licence_endorsements licence_restrictions address",
    "NationalID": f"{_ID} nationality id_card_number issuing_authority address",
    "Visa": f"{_ID} visa_class issuing_country host_country valid_from valid_to entries_allowed",
    "PaymentReceipt": "receipt_amount receipt_currency receipt_time receipt_debit_account_name receipt_debit_account_number receipt_debit_bank_name receipt_credit_account_name receipt_credit_account_number receipt_credit_bank_name receipt_reference receipt_payment_app receipt_counterparty_name receipt_counterparty_account",
    "PEP_Declaration": "is_pep pep_role pep_jurisdiction pep_relationship declaration_date declarant_name",
    "VerificationReport": "verifier_name verification_date verification_method subject_name subject_id_type subject_id_number verification_outcome",
    "ApplicationForm": "application_date applicant_name applicant_dob application_type applicant_address applicant_occupation",
    "BankStatement": f"{_BANK} statement_period_start statement_period_end statement_date closing_balance",
    "BankAccountConfirmation": f"{_BANK} confirmation_date confirmation_authority",
    "CompanyExtract": "company_name registration_number incorporation_date registered_address directors[] shareholders[]",
    "EntityOwnership": "entity_name ultimate_beneficial_owners{}",
    "ProofOfAddress": "holder_name address document_date issuer document_type",
    "TaxResidency": "holder_name tax_jurisdiction tin residency_status effective_from",
    "Other": "description extracted_text notes",
}
DOC_TYPES = list(OWN)
VERIFIED = ["Passport", "DriverLicence", "NationalID", "Visa", "PaymentReceipt"]
PROVENANCE = ["extractor_version", "extraction_provider", "extraction_model", "extraction_timestamp", "prompt_version"]
STATUSES = ["passed", "failed", "rate_limited", "provider_unavailable"]
VERDICTS, OVERALL = ["agree", "disagree", "abstain"], ["pass", "fail", "uncertain"]
OWNER = T.StructType([T.StructField(n, T.StringType()) for n in ("name", "dob", "ownership_percentage")])


def slug(doc_type: str) -> str:
    """passport, driver_licence, pep_declaration: the agent's name of a type."""
    out = "".join("_" + c.lower() if c.isupper() and i and not doc_type[i - 1].isupper() and doc_type[i - 1] != "_" else c.lower() for i, c in enumerate(doc_type))
    return {"national_id": "national_id"}.get(out, out)


def schema(doc_type: str) -> T.StructType:
    """The columns of a type; those all types share for a type that is not known."""
    fields = []
    for name in f"{BASE} {OWN.get(doc_type, '')}".split():
        kind = T.ArrayType(T.StringType(), False) if name.endswith("[]") else T.ArrayType(OWNER) if name.endswith("{}") else T.StringType()
        fields.append(T.StructField(name.rstrip("[]{}"), kind, not isinstance(kind, T.StringType)))
    return T.StructType(fields)


def closed(columns: dict[str, Column], doc_type: str) -> list[Column]:
    """Columns of a type in order: strings stripped and never null, lists null where not extracted."""
    from .functions.text import strip

    out = []
    for f in schema(doc_type):
        c = columns.get(f.name)
        if isinstance(f.dataType, T.StringType):
            out.append(F.coalesce(strip(c), F.lit("")).alias(f.name) if c is not None else F.lit("").alias(f.name))
        else:
            out.append((c if c is not None else F.lit(None)).cast(f.dataType).alias(f.name))
    return out


def unknown_fields(parsed: Column, doc_type: str) -> Column:
    """Keys of a parsed map that the type does not have."""
    return F.array_except(F.map_keys(parsed), F.array(*[F.lit(f.name) for f in schema(doc_type)]))


def metadata(spark) -> DataFrame:
    """doc_type, agent, n_columns, verified, input_text: the dimension that a type's documents are dispatched by. The first column follows DOC_TYPES."""
    rows = [(t, slug(t), len(schema(t)), t in VERIFIED, "Extract the fields of this " + slug(t).replace("_", " ") + ".") for t in DOC_TYPES]
    return spark.createDataFrame(rows, "doc_type string, agent string, n_columns int, verified boolean, input_text string")


def not_in(c: Column, allowed: list[str], name: str) -> Column:
    """'' for one of the allowed values, else an error text that names the field and the value."""
    return F.when(c.isin(allowed), "").otherwise(F.concat(F.lit(f"{name}: "), F.coalesce(c, F.lit("null"))))


def coverage(registered: DataFrame, column: str = "doc_type") -> DataFrame:
    """doc_type, side for every type that only one of the registry and the closed list has."""
    known = registered.sparkSession.createDataFrame([(t,) for t in DOC_TYPES], "doc_type string")
    mine = registered.select(F.col(column).alias("doc_type")).distinct()
    return known.join(mine, "doc_type", "left_anti").withColumn("side", F.lit("unregistered")).unionByName(mine.join(known, "doc_type", "left_anti").withColumn("side", F.lit("unknown")))
