"""Queries over printed values, provenance, pairing, canonical fixtures and the boundary's rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas
from ..functions import codes, dates
from ..functions import text as tx
from ..operators import classify, evaluate, extract, gates, keyed, printed, records
from ..plans import lifecycles
from ..sources import files
from . import duck, inputs
from .catalog import _AUDIT, _BOTH, _METRICS, _RESULTS, _ROLL, _compared, legacy_source, query, query2
from .inputs import case, text


def words(*values: str) -> list[str]:
    return [f"'{v}'" for v in values]


# Which printed value counts
query(
    "applicant_address", f"SELECT c_custkey AS k, {case('c_custkey', ['c_name', chr(39) * 2, 'concat(c_name, ' + chr(39) + '  ' + chr(39) + ')'])} AS home, {case('c_custkey', ['c_mktsegment', 'c_mktsegment', 'CAST(NULL AS STRING)', 'c_name', chr(39) * 2])} AS post, {case('c_custkey', [chr(39) * 2, chr(39) + 'seen' + chr(39)])} AS notes, {case('c_custkey', ['c_name', chr(39) * 2, 'CAST(NULL AS STRING)'])} AS printed, c_mktsegment AS signed FROM {{customer}}",
    lambda d: d.select("k", *[c.alias(n) for n, c in zip(("address", "all_notes"), printed.residence(F.col("home"), F.col("post"), F.col("notes")), strict=True)], printed.printed_name(F.col("printed"), F.col("signed")).alias("name")),
    "SELECT k, CASE WHEN trim(home) <> '' THEN trim(home) ELSE coalesce(trim(post), '') END AS address, concat_ws('; ', nullif(notes, ''), CASE WHEN trim(home) <> '' AND coalesce(post, '') <> '' AND post <> trim(home) THEN 'Postal: ' || post END) AS all_notes, coalesce(nullif(printed, ''), signed) AS name FROM @src",
)
_ID = f"SELECT o_orderkey AS k, concat('110101', '19', lpad({text('o_orderkey % 90 + 10')}, 2, '0'), '0', {text('o_orderkey % 9 + 1')}, '15', lpad({text('o_orderkey % 1000')}, 3, '0'), {case('o_orderkey', words(*'0123456789X'))}) AS id, {case('o_orderkey', ['concat(' + chr(39) + '19' + chr(39) + ', lpad(' + text('o_orderkey % 90 + 10') + ', 2, ' + chr(39) + '0' + chr(39) + '), ' + chr(39) + '-0' + chr(39) + ', ' + text('o_orderkey % 9 + 1') + ', ' + chr(39) + '-15' + chr(39) + ')', chr(39) + '1990-01-01' + chr(39), chr(39) * 2])} AS dob, {case('o_orderkey', words('M', 'F', ''))} AS sex FROM {{orders}}"
_WEIGHTS = [7, 9, 10, 5, 8, 4, 2, 1, 6, 3, 7, 9, 10, 5, 8, 4, 2]
query(
    "identity_mismatch", _ID, lambda d: d.select("k", F.array_join(printed.identity_mismatch(F.col("id"), F.col("dob"), F.col("sex")), ",").alias("flags")),
    "SELECT k, concat_ws(',', CASE WHEN '10X98765432'[(" + " + ".join(f"CAST(id[{i + 1}] AS INT) * {w}" for i, w in enumerate(_WEIGHTS)) + ") % 11 + 1] <> id[18] THEN 'check' END, CASE WHEN dob <> '' AND dob <> id[7:10] || '-' || id[11:12] || '-' || id[13:14] THEN 'dob' END, CASE WHEN sex <> '' AND sex <> CASE WHEN CAST(id[17] AS INT) % 2 = 1 THEN 'M' ELSE 'F' END THEN 'sex' END) AS flags FROM @src",
)
query(
    "label_priority", f"SELECT o_orderkey AS k, concat({case('o_orderkey', ['concat(' + chr(39) + 'Payer: ' + chr(39) + ', o_orderpriority, chr(10))', chr(39) * 2])}, {case('o_orderkey', ['concat(' + chr(39) + '付款人: ' + chr(39) + ', o_clerk, chr(10))', chr(39) * 2, chr(39) * 2])}, {case('o_orderkey', ['concat(' + chr(39) + '- **Payee**: [' + chr(39) + ', o_clerk, ' + chr(39) + ']' + chr(39) + ')', 'concat(' + chr(39) + '收款人: ' + chr(39) + ', o_orderpriority)', chr(39) + 'nobody' + chr(39)])}) AS body FROM (SELECT o_orderkey, o_orderpriority, concat('Clerk ', {text('o_custkey')}) AS o_clerk FROM {{orders}}) o",
    lambda d: printed.sides(d).select("k", F.col("receipt_debit_account_name").alias("debit"), F.col("receipt_credit_account_name").alias("credit")),
    "SELECT k, coalesce(nullif(trim(regexp_extract(body, '付款人: ([^\n]+)', 1)), ''), nullif(trim(regexp_extract(body, '(?m)^Payer: ([^\n]+)', 1)), ''), '') AS debit, coalesce(nullif(trim(regexp_extract(body, '收款人: ([^\n]+)', 1)), ''), nullif(regexp_extract(body, '\\*\\*Payee\\*\\*: \\[([^\n\\]]+)', 1), ''), '') AS credit FROM @src",
)
query("authority_join", f"SELECT o_orderkey AS k, {case('o_orderkey', ['o_orderpriority', chr(39) + ' ' + chr(39), 'CAST(NULL AS STRING)'])} AS n, {case('o_orderkey', words('Manager', '') + ['CAST(NULL AS STRING)', 'o_orderpriority'])} AS t FROM {{orders}}", lambda d: d.select("k", printed.authority(F.col("n"), F.col("t")).alias("authority")), "SELECT k, concat_ws(', ', nullif(trim(n), ''), nullif(trim(t), '')) AS authority FROM @src")
query("ubo_threshold", f"SELECT c_custkey AS k, c_name AS owner, concat({text('c_custkey % 60')}, {case('c_custkey', words('%', '.5 %', ' percent'))}) AS pct FROM {{customer}} UNION ALL SELECT -c_custkey AS k, c_name AS owner, 'all of it' AS pct FROM {{customer}}", lambda d: printed.major_owners(d, "pct").select("k", "owner", "percent"), "SELECT k, owner, CAST(nullif(regexp_extract(pct, '([0-9.]+)', 1), '') AS DOUBLE) AS percent FROM @src WHERE CAST(nullif(regexp_extract(pct, '([0-9.]+)', 1), '') AS DOUBLE) >= 25")
query("poa_freshness", f"SELECT o_orderkey AS k, {case('o_orderkey', ['CAST(CAST(o_orderdate AS DATE) AS STRING)'] * 4 + [chr(39) + '1998-02-31' + chr(39)])} AS document_date, CAST('1998-08-02' AS DATE) AS as_of FROM {{orders}}", lambda d: d.select("k", printed.fresh(F.col("document_date"), F.col("as_of")).alias("fresh")), "SELECT k, try_cast(document_date AS DATE) >= DATE '1998-05-02' AS fresh FROM @src")
query("issuer_priority", f"SELECT o_custkey AS k, {case('o_orderkey', words('Bank', 'utility', 'other', 'government', 'bank', 'shop', 'other'))} AS issuer FROM {{orders}}", lambda d: printed.best_issuer(d, "k", "issuer").select("k", F.lower("issuer").alias("issuer")), "SELECT k, lower(arg_min(issuer, CASE lower(issuer) WHEN 'government' THEN 1 WHEN 'utility' THEN 2 WHEN 'bank' THEN 3 WHEN 'other' THEN 4 ELSE 5 END)) AS issuer FROM @src GROUP BY k")
query("earliest_page", "SELECT conv_id AS k, turn AS page_no, role AS header FROM {conversations}", lambda d: printed.earliest(d, "k", "page_no", "header", F.col("header") != "system"), "SELECT k, arg_min(header, page_no) AS header FROM @src WHERE header <> 'system' GROUP BY k")
query(
    "receipt_time_norm", f"SELECT o_orderkey AS k, concat({case('o_orderkey', words('', ' '))}, CAST(CAST(o_orderdate AS DATE) AS STRING), {case('o_orderkey', ['concat(' + chr(39) + ' 1' + chr(39) + ', ' + text('o_orderkey % 10') + ', ' + chr(39) + ':05:0' + chr(39) + ', ' + text('o_custkey % 10') + ')', 'concat(' + chr(39) + ' 0' + chr(39) + ', ' + text('o_orderkey % 10') + ', ' + chr(39) + ':30' + chr(39) + ')', chr(39) * 2, chr(39) + ' soon' + chr(39)])}) AS s, concat(replace(CAST(CAST(o_orderdate AS DATE) AS STRING), '-', '.'), '-2030.01.02') AS r FROM {{orders}}",
    lambda d: d.select("k", dates.receipt_time(F.col("s")).alias("t"), dates.validity_range(F.col("r"))[0].alias("valid_from"), dates.validity_range(F.col("r"))[1].alias("valid_to")),
    "SELECT k, strftime(coalesce(try_strptime(trim(s), '%Y-%m-%d %H:%M:%S'), try_strptime(trim(s), '%Y-%m-%d %H:%M'), try_strptime(trim(s), '%Y-%m-%d')), '%Y-%m-%dT%H:%M:%SZ') AS t, replace(r[1:10], '.', '-') AS valid_from, replace(r[12:], '.', '-') AS valid_to FROM @src",
)
query("null_to_empty", f"SELECT doc_id AS k, {case('doc_id', ['lang', 'CAST(NULL AS STRING)', chr(39) * 2])} AS v FROM {{documents}}", lambda d: d.select("k", tx.none_to_empty(F.col("v")).alias("v")), "SELECT k, coalesce(v, '') AS v FROM @src")
query("backoff_delay", f"SELECT event_id AS k, CAST(event_id % 5 AS INT) AS attempt, CAST(event_id % 7 AS DOUBLE) / 7 AS jitter, {case('event_id', ['CAST(1 AS DOUBLE)', 'CAST(0.5 AS DOUBLE)'])} AS base FROM {{events}}", lambda d: d.select("k", F.round(codes.backoff(F.col("base"), F.col("attempt"), F.col("jitter")), 6).alias("delay")), "SELECT k, round(base * pow(2, attempt) + jitter * base, 6) AS delay FROM @src")

# Cues: two fragments by turns, scored anew in SQL
_FRAGMENTS = ["P<NZLDOE", "passport", "driver licence", "class 2 ", "identity card", "居民身份证", "visa", "entries allowed", "payer", "payee amount", "statement period", "opening balance", "we confirm the account", "branch manager", "are you a pep", "declarant", "verification report", "onfido", "application form", "applicant", "companies office", "directors", "beneficial owner", "ubo", "utility bill", "bill date", "fatca", "tin", "NZD", "Companies House USD"]
_CUES = {
    "Passport": ["p<[a-z]{3}", r"\bpassport\b", "护照"], "DriverLicence": ["driver.?licen[cs]e", "机动车驾驶证", r"class [0-9ab]\b"], "NationalID": ["居民身份证", "身分證", "identity card", r"\bnric\b"],
    "Visa": [r"\bvisa\b", "entries allowed|number of entries", "valid from"], "PaymentReceipt": ["付款|payer", "收款|payee", "金额|amount"], "BankStatement": ["statement period", "opening balance", "closing balance"],
    "BankAccountConfirmation": ["confirm.{0,40}account", "branch manager", "to whom it may concern"], "PEP_Declaration": ["politically exposed|are you a pep", "relationship to pep|pep role", "declarant"],
    "VerificationReport": ["verification (report|outcome|result)", "trulioo|onfido|jumio", "subject"], "ApplicationForm": ["application (form|date|type)", "applicant", "i declare that"],
    "CompanyExtract": ["companies office|companies house|工商|营业执照", "registration number|company number", "directors|shareholders"], "EntityOwnership": ["beneficial owner", "ownership percentage|% owned", r"\bubo\b"],
    "ProofOfAddress": ["utility bill|rates notice|户口本", "service address|residential address", "bill date|amount due"], "TaxResidency": [r"\bfatca\b|\bcrs\b|w-8ben|w-9", "tax residen", r"\btin\b|tax identification"],
}
_SCORE = ", ".join(f"({' + '.join(f'CAST(regexp_matches(low, {duck.quoted(c)}) AS INT)' for c in cues)}) AS \"{t}\"" for t, cues in _CUES.items())
_BEST = "greatest(" + ", ".join(f'"{t}"' for t in _CUES) + ")"
_WINNERS = "list_filter([" + ", ".join(f"CASE WHEN \"{t}\" = best AND NOT ({chr(34) + 'BankStatement' + chr(34) + ' = best' if t == 'ProofOfAddress' else chr(34) + 'Passport' + chr(34) + ' = best' if t == 'NationalID' else 'false'}) THEN '{t}' END" for t in _CUES) + "], lambda x: x IS NOT NULL)"
query(
    "classifier_cues", f"SELECT o_orderkey AS k, concat({case('o_orderkey', words(*_FRAGMENTS))}, chr(10), {case('o_custkey', words(*_FRAGMENTS))}, chr(10), {case('o_orderkey + o_custkey', words(*_FRAGMENTS))}) AS text FROM {{orders}}",
    lambda d: classify.classify(d).drop("text"),
    f"SELECT k, CASE WHEN best >= 2 AND len(w) = 1 THEN w[1] ELSE 'Other' END AS doc_type, CASE WHEN contains(text, 'P<NZL') THEN 'NZ' WHEN contains(low, 'companies office') THEN 'NZ' WHEN contains(low, 'companies house') THEN 'GB' WHEN regexp_matches(low, '\\bnzd\\b') THEN 'NZ' WHEN regexp_matches(low, '\\busd\\b') THEN 'US' ELSE 'OTHER' END AS jurisdiction, '' AS doc_subtype FROM (SELECT *, {_WINNERS} AS w FROM (SELECT *, {_BEST} AS best FROM (SELECT k, text, low, {_SCORE} FROM (SELECT *, lower(text) AS low FROM @src))))",
)

# Keys, types and enums
query("correction_keys", "SELECT page_id AS k, url FROM {pages}", lambda d: d.select("k", keyed.correction_key(F.col("url")).alias("correction"), keyed.analysis_key(F.col("url")).alias("canonical")), "SELECT k, 'corrections/' || url || '.md' AS correction, url || '.md' AS canonical FROM @src")
_TYPES = f"SELECT event_id AS k, {case('event_id', words(*schemas.DOC_TYPES, 'Unheard', 'passport'))} AS doc_type, {case('event_id', words('agree', 'disagree', 'abstain', 'maybe'))} AS verdict, {case('event_id', words('passed', 'failed', 'rate_limited', 'provider_unavailable', 'done'))} AS status FROM {{events}}"
query(
    "enum_membership", _TYPES, lambda d: d.select("k", F.concat_ws("; ", *[F.nullif(schemas.not_in(F.col(c), a, c), F.lit("")) for c, a in (("doc_type", schemas.DOC_TYPES), ("verdict", schemas.VERDICTS), ("status", schemas.STATUSES))]).alias("error")),
    "SELECT k, concat_ws('; ', CASE WHEN doc_type NOT IN ('Passport', 'DriverLicence', 'NationalID', 'Visa', 'PEP_Declaration', 'VerificationReport', 'ApplicationForm', 'BankStatement', 'BankAccountConfirmation', 'CompanyExtract', 'EntityOwnership', 'ProofOfAddress', 'TaxResidency', 'PaymentReceipt', 'Other') THEN 'doc_type: ' || doc_type END, CASE WHEN verdict NOT IN ('agree', 'disagree', 'abstain') THEN 'verdict: ' || verdict END, CASE WHEN status NOT IN ('passed', 'failed', 'rate_limited', 'provider_unavailable') THEN 'status: ' || status END) AS error FROM @src",
)
query(
    "metadata_dispatch", _TYPES, lambda d: keyed.dispatch(d.select("k", "doc_type"), schemas.metadata(d.sparkSession)).select("k", F.coalesce("agent", F.lit("")).alias("agent"), F.coalesce("n_columns", F.lit(len(schemas.schema("Unheard")))).alias("n_columns"), F.coalesce("verified", F.lit(False)).alias("verified")),
    "SELECT k, coalesce(agent, '') AS agent, coalesce(n, 10) AS n_columns, doc_type IN ('Passport', 'DriverLicence', 'NationalID', 'Visa', 'PaymentReceipt') AS verified FROM @src LEFT JOIN (VALUES ('Passport', 'passport', 20), ('DriverLicence', 'driver_licence', 20), ('NationalID', 'national_id', 20), ('Visa', 'visa', 22), ('PaymentReceipt', 'payment_receipt', 23), ('PEP_Declaration', 'pep_declaration', 16), ('VerificationReport', 'verification_report', 17), ('ApplicationForm', 'application_form', 16), ('BankStatement', 'bank_statement', 19), ('BankAccountConfirmation', 'bank_account_confirmation', 17), ('CompanyExtract', 'company_extract', 16), ('EntityOwnership', 'entity_ownership', 12), ('ProofOfAddress', 'proof_of_address', 15), ('TaxResidency', 'tax_residency', 15), ('Other', 'other', 13)) m(t, agent, n) ON t = doc_type",
)
query("override_overall", _AUDIT, lambda d: gates.override_overall(d.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("field", "verdict"))).alias("audits")).withColumn("overall", F.when(F.col("doc_id") % 2 == 0, "pass").otherwise("fail"))).drop("audits"), f"SELECT doc_id, {_ROLL} AS overall, CASE WHEN doc_id % 2 = 0 THEN 'pass' ELSE 'fail' END <> {_ROLL} AS overridden FROM @src GROUP BY doc_id")

# Evaluation
query2(
    "scorecard_whole", _BOTH,
    lambda want, got: evaluate.scorecard(_compared(want, got), version="9", timestamp="2026-01-01T00:00:00Z", ceiling=20.0, doc_key="doc_key").select("total_examples", F.round("total_cost_usd", 6).alias("total_cost_usd"), "cost_breach", "extractor_version", "run_timestamp", F.explode("per_agent").alias("agent", "m")).select("*", "m.*").drop("m"),
    f"SELECT agent, {_METRICS}, (SELECT count(*) FROM {_RESULTS}) AS total_examples, (SELECT round(count(DISTINCT doc_key) * 0.0125, 6)::DOUBLE FROM {_RESULTS}) AS total_cost_usd, (SELECT count(DISTINCT doc_key) * 0.0125 > 20 FROM {_RESULTS}) AS cost_breach, '9' AS extractor_version, '2026-01-01T00:00:00Z' AS run_timestamp FROM {_RESULTS} GROUP BY agent",
)
query("strict_pairs", "SELECT doc_id AS ordinal, concat('k', CAST(doc_id AS STRING)) AS key, lang, n_chars FROM {documents}", lambda d: evaluate.paired(d.groupBy("ordinal", "key").agg(F.min("lang").alias("lang")), d.groupBy("ordinal", "key").agg(F.max("n_chars").alias("n"))).select("ordinal", "key", "lang", "result.n"), "SELECT ordinal, key, min(lang) AS lang, max(n_chars) AS n FROM @src GROUP BY ALL")

# Boundary
_CALLS = f"SELECT doc_id AS ordinal, concat('k', {text('doc_id')}) AS key, {case('doc_id', words('Visa', 'Passport', 'Other', 'Unheard'))} AS doc_type, concat('Visa Class: ', lang, chr(10), 'Passport Number: E', {text('doc_id')}, chr(10), 'Description: ', source) AS text FROM {{documents}}"


def _limited(row: dict, tier: str) -> dict[str, str]:
    """The registry's extractor, but every fifth row is turned away for good."""
    if row["ordinal"] % 5 == 0:
        raise extract.RateLimited
    return extract.Answer(extract.by_registry(row, tier), "local", "rules-" + tier, 0.001)


_STATUS = "CASE WHEN ordinal % 5 = 0 THEN 'rate_limited' WHEN doc_type = 'Unheard' THEN 'failed' ELSE 'passed' END"
query("batch_order", _CALLS, lambda d: extract.extract(d, _limited, base=0.0).select("ordinal", "key", "status", F.size("attempts").alias("attempts"), F.round(F.aggregate("attempts", F.lit(0.0), lambda a, x: a + x["cost_usd"]), 6).alias("cost_usd")), f"SELECT ordinal, key, {_STATUS} AS status, CASE WHEN ordinal % 5 = 0 THEN 3 ELSE 1 END AS attempts, CASE WHEN {_STATUS} = 'passed' THEN 0.001 ELSE 0 END::DOUBLE AS cost_usd FROM @src")
query("failure_disagreements", _CALLS, lambda d: extract.failures(extract.extract(d, _limited, base=0.0), "0.1.0", "2026-01-01T00:00:00Z").select("source_key", "primary", "status", "extractor_version", keyed.disagreement_key(F.col("key")).alias("path")), f"SELECT key AS source_key, CAST(NULL AS STRING) AS primary, {_STATUS} AS status, '0.1.0' AS extractor_version, 'disagreements/' || key || '.json' AS path FROM @src WHERE {_STATUS} <> 'passed'")
query("attempt_telemetry", _CALLS, lambda d: extract.attempt_rows(extract.extract(d, _limited, base=0.0)).select("key", "retry_count", "success", "agent", "provider", "model", "cost_usd"), "SELECT key, CAST(n AS INTEGER) AS retry_count, ordinal % 5 <> 0 AND doc_type <> 'Unheard' AS success, doc_type AS agent, CASE WHEN ordinal % 5 <> 0 AND doc_type <> 'Unheard' THEN 'local' ELSE '' END AS provider, CASE WHEN ordinal % 5 <> 0 AND doc_type <> 'Unheard' THEN 'rules-rules' ELSE '' END AS model, CASE WHEN ordinal % 5 <> 0 AND doc_type <> 'Unheard' THEN 0.001 ELSE 0 END::DOUBLE AS cost_usd FROM @src, unnest(CASE WHEN ordinal % 5 = 0 THEN [0, 1, 2] ELSE [0] END) AS u(n)")
_CONFIG = "SELECT 'Visa' AS doc_type, 'p-file' AS provider, 'm-file' AS model, 'visa@2' AS prompt_version UNION ALL SELECT 'Passport', 'p-file', 'm-pass', 'passport@1'"
query2(
    "pipeline_provenance", {"calls": _CALLS, "config": _CONFIG},
    lambda calls, config: extract.with_provenance(extract.extract(calls, lambda row, tier: extract.Answer({**extract.by_registry(row, tier), **({"prompt_version": "own"} if row["ordinal"] % 3 == 0 else {})}, "local" if row["ordinal"] % 2 else "")), config, "0.1.0", "2026-01-01T00:00:00Z").where("status = 'passed'").select("key", *[F.try_element_at("fields", F.lit(n)).alias(n) for n in ("extraction_provider", "extraction_model", "prompt_version", "extractor_version", "extraction_timestamp")]),
    "SELECT key, CASE WHEN ordinal % 2 <> 0 THEN 'local' ELSE coalesce(provider, '') END AS extraction_provider, coalesce(model, '') AS extraction_model, CASE WHEN ordinal % 3 = 0 THEN 'own' ELSE coalesce(prompt_version, '') END AS prompt_version, '0.1.0' AS extractor_version, '2026-01-01T00:00:00Z' AS extraction_timestamp FROM @calls LEFT JOIN @config ON config.doc_type = calls.doc_type WHERE calls.doc_type <> 'Unheard'",
)
query(
    "run_response", f"SELECT conv_id, turn, role, text, {case('conv_id', ['CAST(0.25 AS DOUBLE)', 'CAST(NULL AS DOUBLE)'])} AS cost, {case('conv_id', words('svc') + ['CAST(NULL AS STRING)', chr(39) * 2])} AS provider FROM {{conversations}}",
    lambda d: d.groupBy("conv_id").agg(F.struct(F.sort_array(F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))).alias("messages"), F.first("provider").alias("model_provider"), F.lit("m").alias("model"), F.struct(F.first("cost").alias("cost"), F.first("cost").alias("duration")).alias("metrics")).alias("r")).select("conv_id", *[(F.md5(c) if n == "raw_text" else c).alias(n) for n, c in extract.run_response(F.col("r")).items()]),
    "SELECT conv_id, md5(coalesce(arg_max(text, turn) FILTER (WHERE role = 'assistant' AND text <> ''), '')) AS raw_text, coalesce(first(provider), '') AS provider, 'm' AS model, coalesce(first(cost), 0) AS cost_usd, coalesce(first(cost), 0) * 1000 AS latency_ms FROM @src GROUP BY conv_id",
)
query("last_message", "SELECT conv_id, turn, role, text FROM {conversations}", lambda d: extract.last_messages(d, "conv_id", "turn").select("conv_id", F.md5("said").alias("said")), "SELECT conv_id, md5(coalesce(arg_max(text, turn) FILTER (WHERE role = 'assistant' AND text <> ''), '')) AS said FROM @src GROUP BY conv_id")
query2("skip_or_extract", {"keys": _CALLS, "done": "SELECT concat('k', CAST(doc_id AS STRING)) AS key FROM {labels}"}, lambda keys, done: lifecycles.extract_new(keys, done.distinct(), _limited, base=0.0).select("ordinal", "key", "status"), f"SELECT ordinal, key, CASE WHEN key IN (SELECT key FROM @done) THEN 'skipped' ELSE {_STATUS} END AS status FROM @keys")
query(
    "verifier_stage", _CALLS,
    lambda d: lifecycles.verify(extract.extract(d, extract.by_registry), d, lambda row, tier: {} if row["ordinal"] % 7 == 0 else {**extract.by_registry(row, tier), **({"visa_class": "other"} if row["ordinal"] % 3 == 0 else {})}).select("key", "overall", F.size("audits").alias("fields")),
    "SELECT key, CASE WHEN ordinal % 7 = 0 THEN 'uncertain' WHEN doc_type = 'Visa' AND ordinal % 3 = 0 THEN 'fail' ELSE 'pass' END AS overall, CASE doc_type WHEN 'Passport' THEN 2 ELSE 1 END AS fields FROM @src WHERE doc_type IN ('Visa', 'Passport')",
)

# Canonical fixtures and drafts
_FIXTURES = f"SELECT concat('canon/p', {text('page_id')}, {case('page_id', words('.png', '.expected.md', '.pdf'))}) AS path FROM {{pages}} UNION ALL SELECT concat('canon/p', {text('page_id')}, {case('page_id', words('.expected.md', '.jpg', '.txt', '.PNG.expected.md'))}) AS path FROM {{pages}}"
query("canonical_pairs", _FIXTURES, lambda d: files.canonical_pairs(d), "SELECT regexp_extract(i.path, '([^/]+)\\.[a-z]+$', 1) AS id, i.path AS image, e.path AS expected FROM @src i JOIN (SELECT path FROM @src) e ON e.path = regexp_replace(i.path, '\\.[a-z]+$', '') || '.expected.md' WHERE regexp_matches(i.path, '\\.(png|pdf|jpg)$')".replace("@src i", "(SELECT path FROM @src) i"))
_CANON = f"SELECT c_custkey AS n, c_name AS payer, {text('c_custkey * 7')} AS number, {case('c_custkey', words('same', 'other', 'none', 'broken'))} AS kind FROM {{customer}}"


def _canonical(d):
    """Expected files and extracted fields of each row: alike, one number changed, a field left out, or no frontmatter."""
    md = F.when(F.col("kind") == "broken", "no fences").otherwise(F.concat(F.lit("---\ndoc_type: PaymentReceipt\nreceipt_debit_account_name: '"), "payer", F.lit("'\nreceipt_debit_account_number: '"), "number", F.lit("'\nreceipt_credit_account_name:\n---\n")))
    some = d.select(F.concat(F.lit("x"), F.col("n").cast("string")).alias("id"), "*").withColumn("path", F.concat(F.lit("c/"), "id", F.lit(".expected.md")))
    pairs = some.select("id", F.concat(F.lit("c/"), "id", F.lit(".png")).alias("image"), F.col("path").alias("expected"))
    name, number, payee, account = lifecycles.CANONICAL
    actual = some.select("id", F.when(F.col("kind") != "none", F.col("payer")).alias(name), F.when(F.col("kind") == "other", F.concat("number", F.lit("0"))).otherwise(F.col("number")).alias(number), F.lit(None).cast("string").alias(payee), F.lit("").alias(account))
    return lifecycles.verify_canonical(pairs, some.select("path", md.alias("md")), actual)


query("canonical_verify", _CANON, _canonical, "SELECT 'x' || n AS id, CASE kind WHEN 'other' THEN 'receipt_debit_account_number' WHEN 'none' THEN 'receipt_debit_account_name' ELSE '' END AS field, CASE kind WHEN 'other' THEN number WHEN 'none' THEN payer ELSE 'no frontmatter' END AS expected, CASE kind WHEN 'other' THEN number || '0' ELSE '' END AS actual FROM @src WHERE kind <> 'same'")
query("draft_round_trip", legacy_source("Passport"), lambda d: records.parse(lifecycles.draft(d, "Passport", keep=["k"]).withColumnRenamed("error", "draft_error")).select("k", "draft_error", "doc_type", F.size("fields").alias("n")), "SELECT k, '' AS draft_error, 'Passport' AS doc_type, 20 AS n FROM @src", "customer")
query(
    "telemetry_scan", f"SELECT event_id, {case('event_id', ['concat(' + chr(39) + '{{\"source_key\":\"k' + chr(39) + ', ' + text('event_id') + ', ' + chr(39) + '\",\"cost_usd\":0.5,\"success\":true}}' + chr(39) + ')', chr(39) + ' ' + chr(39), 'concat(' + chr(39) + '{{' + chr(39) + ', event_type)'])} AS value FROM {{events}}",
    lambda d: files.telemetry_of(d).select("event_id", "source_key", "cost_usd", "success"), "SELECT event_id, 'k' || event_id AS source_key, 0.5::DOUBLE AS cost_usd, true AS success FROM @src WHERE event_id % 3 = 0",
)
query("record_latest", "SELECT user_id, event_id, event_type FROM {events}", lambda d: keyed.upsert(d.select(F.col("user_id").cast("string").alias("key"), F.col("event_type").alias("md"), F.timestamp_seconds("event_id").alias("written_at")), ["key"], [F.col("written_at"), F.col("md")]).select("key", "md"), "SELECT CAST(user_id AS STRING) AS key, arg_max(event_type, event_id) AS md FROM @src GROUP BY user_id")
_STORED = f"SELECT c_custkey AS k, concat('---', chr(10), 'doc_type: PaymentReceipt', chr(10), 'receipt_amount: ', chr(39), {case('c_custkey', ['c_mktsegment', text('c_custkey')])}, chr(39), chr(10), '---', chr(10), chr(10), {case('c_custkey', ['concat(' + chr(39) + '金额: ' + chr(39) + ', ' + text('c_custkey') + ', chr(10), ' + chr(39) + '备注: ' + chr(39) + ', c_name)', 'concat(' + chr(39) + '金额: ' + chr(39) + ', ' + text('c_custkey') + ')', chr(39) + 'nothing' + chr(39)])}) AS md FROM {{customer}}"
query("receipt_repair_store", _STORED, lambda d: records.with_head(lifecycles.repair_receipts(d.withColumnRenamed("k", "key")), records.split_lines(F.col("md"))[0]).select(F.col("key").alias("k"), "layout", F.array_join("changed", ",").alias("changed"), F.when(F.col("layout") == "none", F.lit("")).otherwise(F.try_element_at("_fields", F.lit("receipt_amount"))).alias("amount")), "SELECT k, CASE WHEN k % 3 = 2 THEN 'none' ELSE 'cn' END AS layout, CASE WHEN k % 3 = 2 THEN '' ELSE concat_ws(',', CASE WHEN k % 2 = 0 THEN 'receipt_amount' END, CASE WHEN k % 3 = 0 THEN 'receipt_reference' END) END AS changed, CASE WHEN k % 3 = 2 THEN '' ELSE CAST(k AS STRING) END AS amount FROM @src", "customer")
