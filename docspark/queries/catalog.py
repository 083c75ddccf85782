"""Every operator as a query: name -> (Spark callable, DuckDB SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import codes, dates, match, pii
from ..functions import text as tx
from ..operators import evaluate, extract, gates, keyed, legacy, receipts, records
from ..sources import files
from . import duck, inputs, stored
from .inputs import case, text

CATALOG: dict[str, tuple[Callable, str | None]] = {}


def query(name: str, source: str, plan: Callable[[DataFrame], DataFrame], sql: str | None, dealt: str = "") -> None:
    """Register a query over one input. In sql, @src is the input. The rows of table `dealt` go to all cores first, for plans that are much work a row."""
    CATALOG[name] = (lambda spark, sf_dir: plan(inputs.run(spark, sf_dir, source, dealt)), sql.replace("@src", f"({inputs.duck(source)}) src") if sql else None)


def query2(name: str, sources: dict[str, str], plan: Callable[..., DataFrame], sql: str | None) -> None:
    """Register a query over several inputs, given by name; in sql they are @name."""
    def run(spark, sf_dir):
        return plan(**{k: inputs.run(spark, sf_dir, s) for k, s in sources.items()})

    for k, s in sources.items():
        sql = sql and sql.replace("@" + k, f"({inputs.duck(s)}) {k}")
    CATALOG[name] = (run, sql)


# Receipts
query("nz_receipt_parse", inputs.NZ, lambda d: receipts.parse_nz(d).drop("body"), f"SELECT * FROM {duck.NZ_ROWS}")
query(
    "nz_receipt_totals", inputs.NZ,
    lambda d: receipts.parse_nz(d).groupBy("receipt_debit_account_name", "receipt_currency").agg(F.sum(F.expr("try_cast(receipt_amount AS decimal(18,2))")).cast("double").alias("amount"), F.count("*").alias("n"), F.count_distinct("receipt_credit_account_number").alias("payees")),
    f"SELECT receipt_debit_account_name, receipt_currency, CAST(sum(CAST(receipt_amount AS DECIMAL(18,2))) AS DOUBLE) AS amount, count(*) AS n, count(DISTINCT receipt_credit_account_number) AS payees FROM {duck.NZ_ROWS} GROUP BY ALL",
)
query("cn_receipt_parse", inputs.CN, lambda d: receipts.parse_cn(d).drop("body"), f"SELECT * FROM {duck.CN_ROWS}")
query(
    "cn_label_first_match", inputs.CN,
    lambda d: receipts.parse_cn(d).select("k", F.col("receipt_reference").alias("reference"), F.col("receipt_time").alias("time")),
    f"SELECT k, receipt_reference AS reference, receipt_time AS time FROM {duck.CN_ROWS}",
)
query("receipt_fallback_route", inputs.MIXED, lambda d: receipts.parse_either(d).drop("body"), f"SELECT * FROM {duck.MIXED_ROWS}")
_OLD = ["receipt_amount", "receipt_currency", "receipt_reference"]
_OLD_SAYS = {"receipt_amount": case("k", ["''", text("k % 5000") + " || '.00'"]), "receipt_currency": "'CNY'", "receipt_reference": case("k", ["''", "'kept'", "CAST(NULL AS STRING)"])}
query(
    "receipt_repair_merge", f"SELECT k, body, {', '.join(f'{v} AS old_{n}' for n, v in _OLD_SAYS.items())} FROM ({inputs.MIXED}) m",
    lambda d: receipts.merge_filled(receipts.parse_either(d), _OLD).select("k", "layout", *["merged_" + f for f in _OLD], F.array_join("changed", ",").alias("changed")),
    "SELECT k, layout, " + ", ".join(f"coalesce(nullif({f}, ''), old_{f}, '') AS merged_{f}" for f in _OLD)
    + ", array_to_string(list_filter([" + ", ".join(f"CASE WHEN {f} <> '' AND {f} <> coalesce(old_{f}, '') THEN '{f}' END" for f in _OLD) + "], lambda x: x IS NOT NULL), ',') AS changed "
    + f"FROM (SELECT *, {', '.join(f'{v} AS old_{n}' for n, v in _OLD_SAYS.items())} FROM {duck.MIXED_ROWS})",
)

# Records
query(
    "frontmatter_split", inputs.FRONT,
    lambda d: d.select("k", *[c.alias(n) for n, c in zip(("head", "body"), records.split_lines(F.col("md")), strict=True)], records.split_anywhere(F.col("md"))[2].alias("rest")),
    r"SELECT k, CASE WHEN ok THEN regexp_extract(md, '(?s)^---\n(.*?\n)---\n', 1) END AS head, CASE WHEN ok THEN regexp_extract(md, '(?s)^---\n.*?\n---\n(.*)$', 1) END AS body, CASE WHEN len(string_split(md, '---')) >= 3 THEN array_to_string(string_split(md, '---')[3:], '---') END AS rest FROM (SELECT *, regexp_matches(md, '(?s)^---\n.*?\n---\n') AS ok FROM @src)",
)
query(
    "frontmatter_parse", inputs.FRONT,
    lambda d: records.parse(d).select("k", "doc_type", F.try_element_at("fields", F.lit("name_latin")).alias("name_latin"), F.try_element_at("fields", F.lit("jurisdiction")).alias("jurisdiction"), F.try_element_at("fields", F.lit("receipt_reference")).alias("receipt_reference"), "error"),
    "SELECT k, CASE WHEN ok THEN 'PaymentReceipt' END AS doc_type, "
    + ", ".join(rf"""CASE WHEN ok THEN regexp_extract(md, '(?m)^{f}: "?(.*?)"?$', 1) END AS {f}""" for f in ("name_latin", "jurisdiction", "receipt_reference"))
    + ", CASE WHEN ok THEN '' ELSE 'no frontmatter' END AS error FROM (SELECT *, len(string_split(md, '---')) >= 3 AS ok FROM @src)",
)
query(
    "prompt_fence", inputs.FRONT,
    lambda d: d.select("k", *[c.alias(n) for n, c in zip(("head", "body"), records.split_prompt(F.col("md")), strict=True)]).select("k", F.coalesce(F.length("head"), F.lit(-1)).alias("head_length"), "body"),
    r"SELECT k, CASE WHEN ok THEN length(regexp_extract(md, '(?s)^---\n(.*?)\n---(?:\n|$)', 1)) ELSE -1 END AS head_length, CASE WHEN ok THEN regexp_replace(regexp_extract(md, '(?s)^---\n.*?\n---(?:\n|$)(.*)$', 1), '^\n+', '') END AS body FROM (SELECT *, regexp_matches(md, '(?s)^---\n.*?\n---(?:\n|$)') AS ok FROM @src)",
)
query(
    "record_round_trip", inputs.RECORD,
    lambda d: records.typed(records.parse(records.render(d.select("doc_key", *schemas.closed({"doc_type": F.lit("Passport"), "name_latin": F.col("name_latin"), "jurisdiction": F.col("jurisdiction"), "doc_number": F.col("doc_number"), "nationality": F.col("nationality"), "expiry_date": F.col("expiry_date")}, "Passport")), "Passport").select("doc_key", "md")), "Passport", ["doc_key"]).select("doc_key", "name_latin", "jurisdiction", "doc_number", "nationality", "expiry_date", "error"),
    "SELECT doc_key, name_latin, jurisdiction, doc_number, nationality, expiry_date, '' AS error FROM @src", "customer",
)
query(
    "provenance_autofill", inputs.RECORD,
    lambda d: keyed.autofill(d.select("doc_key", F.col("expiry_date").alias("extraction_timestamp"), F.when(F.col("agent") == "Visa", F.lit("9.9")).alias("extractor_version")), {"extraction_timestamp": F.lit("2026-01-01T00:00:00Z"), "extractor_version": F.lit("0.1.0")}),
    "SELECT doc_key, coalesce(nullif(expiry_date, ''), '2026-01-01T00:00:00Z') AS extraction_timestamp, CASE WHEN agent = 'Visa' THEN '9.9' ELSE '0.1.0' END AS extractor_version FROM @src",
)

# Legacy analyses
_VALUES = {
    "text": lambda i: f"concat('V{i}-', {text('c_custkey')}, ' ', c_mktsegment)",
    "date": lambda i: case(f"c_custkey + {i}", ["'2017-02-13'", f"concat({text('c_custkey % 28 + 1')}, ' JUN 1999')", "'5/July/2001'", f"concat('7/', {text('c_custkey % 12 + 1')}, '/2020')", "'31-12-1999 x'", "'unknown'", "'9 Foo 2001'"]),
    "country": lambda i: case(f"c_custkey + {i}", ["n_name", "'New Zealand'", "'China (PRC)'", "'nz'", "'British'", "'AUS'", "'U.K.'", "'us'"]),
    "latin": lambda i: "concat(upper(c_mktsegment), ', Given/Middle  Name (孙嘉', '蔚)')",
    "sex": lambda i: case("c_custkey", ["'Female'", "'M'", "'男'", "'F / 女'", "'male'", "'x'", "'not f'"]),
    "place": lambda i: case("c_custkey", ["'Auckland (NZ)'", "'Xi an'"]),
    "pep": lambda i: case("c_custkey", ["'Yes'", "'No'", "'Not a pep'", "'TRUE'", "'unclear'", "'?'"]),
    "list": lambda i: case("c_custkey", ["'Ann; Bob, Cy and Dee'", "'Anderson'", "' ; Sandy and, '"]),
    "head": lambda i: f"concat(repeat('ab', 300), {text('c_custkey')})",
}


def legacy_source(doc_type: str) -> str:
    """A text with the labels of a mapper, one label of each list by turns, some fields left out."""
    parts, seen = [f"'**Model:** `m-1`', chr(10), {case('c_custkey', [chr(39) + '**Analyzed:** 2026-03-01 10:20' + chr(39), chr(39) + 'no date' + chr(39)])}, chr(10), 'DOCUMENT_TYPE: {doc_type}', chr(10), {case('c_custkey', [chr(39) + 'FIELDS:' + chr(39), chr(39) + '**FIELDS:**' + chr(39)])}, chr(10)"], []
    for _, rule, _, labels in legacy.mapping(doc_type):
        if labels in seen:
            continue
        i = len(seen)
        seen.append(labels)
        line = f"concat({case('c_custkey', [chr(39) + '- ' + chr(39), chr(39) + '* **' + chr(39)])}, {case(f'c_custkey + {i}', [chr(39) + x + chr(39) for x in labels])}, {case('c_custkey', [chr(39) + ': ' + chr(39), chr(39) + '**: ' + chr(39)])}, {_VALUES[rule](i)}, chr(10))"
        parts.append(f"CASE WHEN (c_custkey + {i}) % 7 = 0 THEN '' ELSE {line} END")
    parts.append(f"'QUALITY: good', chr(10), '- {legacy.mapping(doc_type)[1][3][0]}: after the end', chr(10)")
    return f"SELECT c_custkey AS k, concat({', '.join(parts)}) AS text FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey"


def legacy_sql(doc_type: str) -> str:
    made = {"extractor_version": "'0.1.0'", "extraction_provider": "'anthropic'", "extraction_model": "'m-1'", "extraction_timestamp": "CASE WHEN contains(text, 'Analyzed') THEN '2026-03-01T10:20:00Z' ELSE '2026-03-21T19:00:00Z' END", "doc_type": f"'{doc_type}'", "prompt_version": f"'{schemas.slug(doc_type)}@{'0.1.0' if doc_type == 'PaymentReceipt' else '1.0.0'}'"}
    inner = []
    for i, (name, rule, default, labels) in enumerate(legacy.mapping(doc_type)):
        inner.append(f"{duck.grab(labels)} AS g{i}")
        value = duck.RULES[rule](f"g{i}")
        made[name] = f"coalesce(nullif({value}, ''), '{default}')" if default else value if rule == "list" else f"trim(coalesce({value}, ''))"
    names = [f.name for f in schemas.schema(doc_type)]
    if doc_type == "EntityOwnership":
        names = names[:-1] + ["owner_name", "owner_dob", "owner_share"]
        for a, b in (("owner_dob", "ubo_dob"), ("owner_share", "ubo_share"), ("owner_name", "ubo_name")):
            made[a] = f"CASE WHEN {made['ubo_name']} <> '' THEN {made[b]} END"
    block = r"regexp_extract(text, '(?s)FIELDS:(?:\*\*)?\n(.*?)\nQUALITY', 1) AS block"
    return f"SELECT k, {', '.join(f'{made.get(n, chr(39) * 2)} AS {n}' for n in names)} FROM (SELECT k, text, {', '.join(inner)} FROM (SELECT *, {block} FROM @src))"


def _legacy_plan(doc_type: str):
    def flat(f):
        if f.dataType.typeName() == "string":
            return [F.col(f.name)]
        if f.name.startswith("ultimate"):
            owner = F.get(F.col(f.name), F.lit(0))
            return [owner["name"].alias("owner_name"), owner["dob"].alias("owner_dob"), owner["ownership_percentage"].alias("owner_share")]
        return [F.array_join(f.name, "|").alias(f.name)]

    return lambda d: legacy.map_legacy(d, doc_type, keep=["k"]).select("k", *[c for f in schemas.schema(doc_type) for c in flat(f)])


for _t in schemas.DOC_TYPES:
    query(f"legacy_map_{schemas.slug(_t)}", legacy_source(_t), _legacy_plan(_t), legacy_sql(_t), "customer")
query(
    "legacy_fields_block", legacy_source("Passport"),
    lambda d: legacy.with_fields(d).select("k", F.explode("fields").alias("f")).select("k", "f.label", "f.value"),
    r"SELECT k, lower(trim(regexp_extract(line, '^[-*]\s*(?:\*\*)?([^:*]+?)(?:\*\*)?:', 1))) AS label, trim(regexp_extract(line, '^[-*]\s*(?:\*\*)?[^:*]+?(?:\*\*)?:\s*(.+?)\s*$', 1)) AS value FROM (SELECT k, unnest(string_split(regexp_extract(text, '(?s)FIELDS:(?:\*\*)?\n(.*?)\nQUALITY', 1), chr(10))) AS line FROM @src) WHERE regexp_matches(line, '^[-*]\s*(?:\*\*)?[^:*]+?(?:\*\*)?:\s*(.+?)\s*$')", "customer",
)
query("doc_type_rules", inputs.TYPES, lambda d: d.select("k", legacy.detect_type().alias("slug")), f"SELECT k, {duck.detect()} AS slug FROM @src")
query("doc_type_counts", inputs.TYPES, lambda d: d.groupBy(legacy.detect_type().alias("slug")).agg(F.count("*").alias("n")), f"SELECT {duck.detect()} AS slug, count(*) AS n FROM @src GROUP BY 1")
query("first_n_per_type", inputs.TYPES, lambda d: legacy.first_per_type(d, 5, order="k").select("k", "slug", "nth"), f"SELECT k, slug, CAST(nth AS INTEGER) AS nth FROM (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY k) AS nth FROM (SELECT k, {duck.detect('text[:1500]')} AS slug FROM @src) WHERE slug IS NOT NULL) WHERE nth <= 5")

# Scalar rules
query("date_best_effort", f"SELECT o_orderkey AS k, {_VALUES['date'](0).replace('c_custkey', 'o_orderkey')} AS s FROM {{orders}}", lambda d: d.select("k", dates.best_effort(F.col("s")).alias("d"), dates.checked(dates.best_effort(F.col("s"))).cast("string").alias("checked")), f"SELECT k, {duck.best_effort('s')} AS d, CAST(try_strptime({duck.best_effort('s')}, '%Y-%m-%d')::DATE AS STRING) AS checked FROM @src")
query(
    "date_by_jurisdiction", f"SELECT o_orderkey AS k, {case('o_orderkey', [chr(39) + 'US' + chr(39), chr(39) + 'NZ' + chr(39)])} AS j, {case('o_orderkey', ['concat(' + chr(39) + '0' + chr(39) + ', ' + text('o_orderkey % 9 + 1') + ', ' + chr(39) + '/12/2020' + chr(39) + ')', chr(39) + '2020年05月09日' + chr(39), chr(39) + '2021-03-04' + chr(39), chr(39) + '09 Mar 2020' + chr(39), chr(39) + '31/02/2020' + chr(39)])} AS s FROM {{orders}}",
    lambda d: d.select("k", dates.by_jurisdiction(F.col("s"), F.col("j")).alias("d")),
    "SELECT k, strftime(coalesce(try_strptime(s, '%Y-%m-%d'), CASE WHEN j = 'US' THEN try_strptime(s, '%m/%d/%Y') ELSE try_strptime(s, '%d/%m/%Y') END, try_strptime(s, '%Y年%m月%d日'), try_strptime(s, '%d %b %Y')), '%Y-%m-%d') AS d FROM @src",
)
query("country_norm", f"SELECT c_custkey AS k, {_VALUES['country'](0)} AS s FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey", lambda d: d.select("k", codes.country3(F.col("s")).alias("c3"), codes.country2(F.col("s")).alias("c2")), f"SELECT k, c3, coalesce(CASE c3 {' '.join(f'WHEN {chr(39)}{a}{chr(39)} THEN {chr(39)}{b}{chr(39)}' for a, b in codes.ALPHA2.items())} END, CASE WHEN length(c3) = 2 THEN c3 END, 'OTHER') AS c2 FROM (SELECT k, {duck.country3('s')} AS c3 FROM @src)")
query("sex_norm", f"SELECT c_custkey AS k, {_VALUES['sex'](0)} AS s FROM {{customer}}", lambda d: d.select("k", tx.normalise_sex(F.col("s")).alias("sex")), f"SELECT k, {duck.sex('s')} AS sex FROM @src")
query("name_split", f"SELECT c_custkey AS k, {_VALUES['latin'](0)} AS s FROM {{customer}}", lambda d: d.select("k", tx.latin_part(F.col("s")).alias("latin"), tx.cjk_part(F.col("s")).alias("cjk")), f"SELECT k, {duck.latin('s')} AS latin, {duck.cjk('s')} AS cjk FROM @src")
query(
    "currency_norm", f"SELECT o_orderkey AS k, {case('o_orderkey', [chr(39) + x + chr(39) for x in ('$', '¥', 'nzd', '€', '$', '£')])} AS s, {case('o_orderkey', [chr(39) + x + chr(39) for x in ('NZ', 'AU', 'HK', 'FR')])} AS j FROM {{orders}}",
    lambda d: d.select("k", codes.currency(F.col("s"), F.col("j")).alias("ccy")),
    "SELECT k, CASE s WHEN '¥' THEN 'CNY' WHEN '£' THEN 'GBP' WHEN '€' THEN 'EUR' WHEN '$' THEN CASE j WHEN 'NZ' THEN 'NZD' WHEN 'AU' THEN 'AUD' WHEN 'HK' THEN 'HKD' WHEN 'SG' THEN 'SGD' ELSE 'USD' END ELSE upper(s) END AS ccy FROM @src",
)
_MRZ = f"SELECT c_custkey AS k, concat('E', lpad({text('c_custkey')}, 7, '0'), '<', '4', 'NZL', lpad({text('c_custkey % 100')}, 2, '0'), '0704', '1', {case('c_custkey', [chr(39) + 'M' + chr(39), chr(39) + 'F' + chr(39), chr(39) + '<' + chr(39)])}, '3112310', '<<<<<<<<<<<<<<02') AS line, concat('P', '<NZL', upper(c_mktsegment), '<<ANN<LEE<<<<') AS top FROM {{customer}}"
query(
    "mrz_decode", _MRZ,
    lambda d: d.select("k", *[c.alias(n) for n, c in codes.mrz_fields(F.col("line")).items()], dates.short_year(F.substring("line", 14, 2), 2026, True).alias("birth_year"), dates.short_year(F.substring("line", 22, 2), 2026, False).alias("expiry_year"), tx.surname_first(F.substring("top", 6, 39)).alias("name")),
    "SELECT k, replace(line[1:9], '<', '') AS number, replace(line[11:13], '<', '') AS nationality, line[14:19] AS dob, replace(line[21:21], '<', '') AS sex, line[22:27] AS expiry, CAST(CASE WHEN CAST(line[14:15] AS INT) <= 26 THEN 2000 ELSE 1900 END + CAST(line[14:15] AS INT) AS INT) AS birth_year, CAST(CASE WHEN CAST(line[22:23] AS INT) <= 46 THEN 2000 ELSE 1900 END + CAST(line[22:23] AS INT) AS INT) AS expiry_year, replace(string_split(regexp_replace(top[6:], '<+$', ''), '<<')[1], '<', ' ') || ', ' || replace(string_split(regexp_replace(top[6:], '<+$', ''), '<<')[2], '<', ' ') AS name FROM @src",
)
_CNID = f"SELECT o_orderkey AS k, concat('110101', '19', lpad({text('o_orderkey % 90 + 10')}, 2, '0'), '0', {text('o_orderkey % 9 + 1')}, '15', lpad({text('o_orderkey % 1000')}, 3, '0'), {case('o_orderkey', [chr(39) + x + chr(39) for x in '0123456789Xx'])}) AS id FROM {{orders}}"
_DIGITS = " + ".join(f"CAST(id[{i + 1}] AS INT) * {w}" for i, w in enumerate(codes.CN_WEIGHTS))
query("cn_id_decode", _CNID, lambda d: d.select("k", *[c.alias(n) for n, c in codes.cn_id_fields(F.col("id")).items()]), f"SELECT k, id[7:10] || '-' || id[11:12] || '-' || id[13:14] AS dob, CASE WHEN CAST(id[17] AS INT) % 2 = 1 THEN 'M' ELSE 'F' END AS sex, '{codes.CN_SIGNS}'[({_DIGITS}) % 11 + 1] = upper(id[18]) AS check_ok FROM @src")
_SHAPES = ["11010119900101123X", "A123456(7)", "S1234567D", "A123456789", "123-45-6789", "12-345-678", "plain"]
query(
    "code_norms", f"SELECT p_partkey AS k, {case('p_partkey', [chr(39) + x + chr(39) for x in _SHAPES])} AS id, {case('p_partkey', [chr(39) + x + chr(39) for x in ('00m', 'MULT', 'Two')])} AS e, {case('p_partkey', [chr(39) + x + chr(39) for x in ('Verified', 'Partial match', 'FAILED', 'other')])} AS o, {case('p_partkey', [chr(39) + x + chr(39) for x in ('Self', 'spouse', 'business partner', 'none')])} AS r, {case('p_partkey', [chr(39) + x + chr(39) for x in ('NZ', 'AU')])} AS j, {case('p_partkey', [chr(39) + x + chr(39) for x in ('1', 'Class 2', '6')])} AS lc FROM {{part}}",
    lambda d: d.select("k", codes.id_shape(F.col("id")).alias("id_shape"), codes.tin_shape(F.col("id")).alias("tin_shape"), codes.entries(F.col("e")).alias("entries"), codes.outcome(F.col("o")).alias("outcome"), codes.relationship(F.col("r")).alias("relationship"), codes.licence_class(F.col("lc"), F.col("j")).alias("licence_class"), codes.boxes(F.col("k") % 2 == 0, F.col("k") % 3 == 0).alias("boxes")),
    r"SELECT k, CASE WHEN regexp_full_match(id, '\d{17}[\dX]') THEN 'CN' WHEN regexp_full_match(id, '[A-Z]{1,2}\d{6}\([0-9A]\)') THEN 'HK' WHEN regexp_full_match(id, '[STFGM]\d{7}[A-Z]') THEN 'SG' WHEN regexp_full_match(id, '[A-Z][12]\d{8}') THEN 'TW' ELSE '' END AS id_shape, CASE WHEN regexp_full_match(id, '\d{3}-\d{2}-\d{4}') THEN 'US' WHEN regexp_full_match(id, '\d{2,3}-\d{3}-\d{3}') THEN 'NZ' WHEN regexp_full_match(id, '\d{17}[\dX]') THEN 'CN' WHEN regexp_full_match(id, '\d{10}') THEN 'GB' ELSE '' END AS tin_shape, CASE WHEN upper(e) IN ('00M', 'MULT') THEN 'multiple' ELSE e END AS entries, CASE o WHEN 'Verified' THEN 'verified' WHEN 'Partial match' THEN 'partial' WHEN 'FAILED' THEN 'failed' ELSE '' END AS outcome, CASE r WHEN 'Self' THEN 'self' WHEN 'spouse' THEN 'family' WHEN 'business partner' THEN 'close_associate' ELSE '' END AS relationship, CASE WHEN j = 'NZ' AND NOT starts_with(lc, 'Class') THEN 'Class ' || lc ELSE lc END AS licence_class, CASE WHEN k % 2 = 0 AND k % 3 <> 0 THEN 'yes' WHEN k % 3 = 0 AND k % 2 <> 0 THEN 'no' ELSE 'unknown' END AS boxes FROM @src",
)

# Matchers
_PAIR = f"SELECT doc_id, text AS a, {case('doc_id', ['text', 'lower(text)', 'concat(text, ' + chr(39) + ' ' + chr(39) + ')'])} AS b, {case('doc_id', [chr(39) + 'CN' + chr(39), chr(39) + 'NZ' + chr(39)])} AS j FROM {{documents}}"
query("match_exact", _PAIR, lambda d: d.select("doc_id", match.exact(F.col("a"), F.col("b")).alias("same")), "SELECT doc_id, a = b AS same FROM @src")
query("match_star_collapse", f"SELECT doc_id, text AS a, replace(text, '***', '**** **') AS b, {case('doc_id', [chr(39) + 'CN' + chr(39), chr(39) + 'NZ' + chr(39)])} AS j FROM {{documents}}", lambda d: d.select("doc_id", match.with_jurisdiction(F.col("a"), F.col("b"), F.col("j")).alias("same"), F.md5(tx.collapse_stars(F.col("b"))).alias("h")), r"SELECT doc_id, CASE WHEN j = 'CN' THEN regexp_replace(a, '\*+(?:\s+\*+)*', '*', 'g') = regexp_replace(b, '\*+(?:\s+\*+)*', '*', 'g') ELSE a = b END AS same, md5(regexp_replace(b, '\*+(?:\s+\*+)*', '*', 'g')) AS h FROM @src")
query("match_normalised", _PAIR, lambda d: d.select("doc_id", match.normalised(F.col("a"), F.col("b")).alias("same")), "SELECT doc_id, lower(strip_accents(rtrim(a))) = lower(strip_accents(rtrim(b))) AS same FROM @src")

# Keys
_DOCS, _LABELS = "SELECT doc_id AS key, source, text AS md FROM {documents}", "SELECT doc_id AS key, concat('quality ', CAST(quality AS STRING)) AS md FROM {labels}"
query2("head_skip_anti", {"keys": _DOCS, "done": _LABELS}, lambda keys, done: keyed.pending(keys, done).select("key", keyed.analysis_key(F.col("key").cast("string")).alias("analysis_key")), "SELECT key, CAST(key AS STRING) || '.md' AS analysis_key FROM @keys WHERE NOT EXISTS (SELECT 1 FROM @done WHERE done.key = keys.key)")
query2("head_skip_semi", {"keys": _DOCS, "done": _LABELS}, lambda keys, done: keyed.skipped(keys, done).select("key", keyed.status(F.lit(True)).alias("status")), "SELECT key, 'skipped' AS status FROM @keys WHERE EXISTS (SELECT 1 FROM @done WHERE done.key = keys.key)")
_CANON = "SELECT doc_id AS key, md5(text) AS md FROM {documents} WHERE lang = 'en'"
query2("corrections_overlay", {"keys": _DOCS, "fixed": _LABELS, "canon": _CANON}, lambda keys, fixed, canon: keyed.overlay(keys, fixed, canon), "SELECT keys.key AS key, coalesce(fixed.md, canon.md) AS md, CASE WHEN fixed.md IS NOT NULL THEN 'correction' WHEN canon.md IS NOT NULL THEN 'canonical' ELSE 'missing' END AS origin FROM @keys LEFT JOIN @fixed ON fixed.key = keys.key LEFT JOIN @canon ON canon.key = keys.key")
_TYPED = f"SELECT event_id, {case('event_id', [chr(39) + t + chr(39) for t in [*schemas.DOC_TYPES, 'Unheard']])} AS doc_type FROM {{events}}"
_REGISTRY = " UNION ALL ".join(f"SELECT '{t}' AS doc_type, '{schemas.slug(t)}' AS agent, {len(schemas.schema(t))} AS n_columns, {'true' if t in schemas.VERIFIED else 'false'} AS verified" for t in schemas.DOC_TYPES)
query2("dispatch_join", {"rows": _TYPED, "registry": _REGISTRY}, lambda rows, registry: keyed.dispatch(rows, registry).withColumn("n_columns", F.coalesce("n_columns", F.lit(0))), "SELECT rows.doc_type AS doc_type, event_id, agent, coalesce(n_columns, 0) AS n_columns, verified, registry.doc_type IS NOT NULL AS registered FROM @rows LEFT JOIN @registry ON registry.doc_type = rows.doc_type")
query2("registry_coverage", {"registry": _REGISTRY + " UNION ALL SELECT 'Extra', 'extra', 0, false"}, lambda registry: schemas.coverage(registry.where("doc_type <> 'Visa'")), "SELECT 'Visa' AS doc_type, 'unregistered' AS side UNION ALL SELECT 'Extra', 'unknown'")
_LAYERS = {"agents": "SELECT DISTINCT event_type AS agent FROM {events}", "cli": "SELECT 'click' AS agent, 'm-cli' AS model", "env": "SELECT 'click' AS agent, 'm-env' AS model UNION ALL SELECT 'view', 'm-env' UNION ALL SELECT 'error', ''", "yaml": "SELECT 'view' AS agent, 'm-yaml' AS model UNION ALL SELECT 'error', 'm-yaml' UNION ALL SELECT 'signup', ''"}
query2("config_precedence", _LAYERS, lambda agents, cli, env, yaml: keyed.resolve(agents, [cli, env, yaml], F.when(F.col("agent").isin("passport", "signup"), "m-large").otherwise("m-small")), "SELECT agents.agent AS agent, coalesce(nullif(cli.model, ''), nullif(env.model, ''), nullif(yaml.model, ''), CASE WHEN agents.agent IN ('passport', 'signup') THEN 'm-large' ELSE 'm-small' END) AS model, coalesce(nullif(cli.model, ''), nullif(env.model, ''), nullif(yaml.model, '')) IS NULL AS used_fallback FROM @agents LEFT JOIN @cli ON cli.agent = agents.agent LEFT JOIN @env ON env.agent = agents.agent LEFT JOIN @yaml ON yaml.agent = agents.agent")
query("upsert_last_writer", "SELECT user_id, event_type, event_id, value FROM {events}", lambda d: keyed.upsert(d, ["user_id", "event_type"], [F.col("event_id")]), "SELECT user_id, event_type, max(event_id) AS event_id, arg_max(value, event_id) AS value FROM @src GROUP BY ALL")
query("attempt_ordinals", "SELECT user_id, event_id, ts FROM {events}", lambda d: keyed.ordinals(d, ["user_id"], [F.col("ts"), F.col("event_id")]).select("user_id", "event_id", "ordinal"), "SELECT user_id, event_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS INTEGER) AS ordinal FROM @src")
query("newest_run", "SELECT o_orderkey, o_custkey, CAST(CAST(o_orderdate AS DATE) AS STRING) AS day, o_orderpriority FROM {orders}", lambda d: files.newest(d.withColumn("name", F.concat_ws("-", "day", F.lpad(F.col("o_orderkey").cast("string"), 12, "0"))), "name"), "SELECT *, day || '-' || lpad(CAST(o_orderkey AS STRING), 12, '0') AS name FROM @src ORDER BY day DESC, o_orderkey DESC LIMIT 1")
_NOW = f"SELECT doc_id AS name, {case('doc_id', [chr(39) + '1.0' + chr(39), chr(39) + '1.1' + chr(39)])} AS version, text AS body FROM {{documents}}"
_BEFORE = f"SELECT {case('doc_id', ['doc_id + 1000000000'] + ['doc_id'] * 4)} AS name, '1.0' AS version, {case('doc_id', ['concat(text, ' + chr(39) + 'x' + chr(39) + ')', 'text', 'text'])} AS body FROM {{documents}}"
_HASHED = lambda d: d.select("name", "version", F.sha2("body", 256).alias("body_sha256"))
query2("baseline_hash_diff", {"now": _NOW, "old": _BEFORE}, lambda now, old: keyed.baseline_diff(_HASHED(now), _HASHED(old)), "SELECT coalesce(a.name, b.name) AS name, CASE WHEN b.h IS NULL THEN 'new' WHEN a.h IS NULL THEN 'removed' WHEN a.version <> b.version THEN 'version' WHEN a.h <> b.h THEN 'body' ELSE 'same' END AS change FROM (SELECT name, version, sha256(body) AS h FROM @now) a FULL JOIN (SELECT name, version, sha256(body) AS h FROM @old) b ON a.name = b.name")
query("keys_file_filter", f"SELECT page_id, {case('page_id', ['concat(' + chr(39) + '  ' + chr(39) + ', url, ' + chr(39) + ' ' + chr(39) + ')', chr(39) + '   ' + chr(39), 'concat(' + chr(39) + ' # ' + chr(39) + ', url)', 'url'])} AS value FROM {{pages}}", lambda d: files.keys_of(d), "SELECT trim(value) AS key FROM @src WHERE trim(value) <> '' AND NOT starts_with(trim(value), '#')")
query(
    "pdf_route", f"SELECT page_id, {case('page_id', ['url', 'concat(url, ' + chr(39) + '.PDF' + chr(39) + ')'])} AS key, {case('page_id', [chr(39) + 'Application/PDF; x' + chr(39), chr(39) + 'image/png' + chr(39), 'CAST(NULL AS STRING)'])} AS ct, {case('page_id', [chr(39) + t + chr(39) for t in ('BankStatement', 'Visa')])} AS t FROM {{pages}}",
    lambda d: d.select("page_id", keyed.is_pdf(F.col("ct"), F.col("key")).alias("pdf"), keyed.pdf_mode(F.col("t")).alias("mode")),
    "SELECT page_id, starts_with(lower(coalesce(ct, '')), 'application/pdf') OR ends_with(lower(key), '.pdf') AS pdf, CASE WHEN t = 'BankStatement' THEN 'all_pages' ELSE 'page1' END AS mode FROM @src",
)
_MODELS = [("anthropic", "claude-haiku-4-5-20251001"), ("anthropic", "claude-sonnet-4-6-20260101"), ("openai", "gpt-4o-mini-2024"), ("openai", "gpt-4o"), ("openai", "o9"), ("nobody", "x-1")]
_TIERS = f"SELECT event_id AS k, {case('event_id', [chr(39) + p + chr(39) for p, _ in _MODELS])} AS p, {case('event_id', [chr(39) + m + chr(39) for _, m in _MODELS])} AS m FROM {{events}}"
_TIER_SQL = "CASE WHEN p = 'anthropic' AND contains(m, 'sonnet') THEN 'anthropic-sonnet' WHEN p = 'anthropic' AND contains(m, 'haiku') THEN 'anthropic-haiku' WHEN p = 'openai' AND contains(m, 'gpt-4o-mini') THEN 'openai-gpt-4o-mini' WHEN p = 'openai' AND contains(m, 'gpt-4o') THEN 'openai-gpt-4o' ELSE p || '-' || m END"
query("tier_derive", _TIERS, lambda d: d.select("k", codes.tier(F.col("p"), F.col("m")).alias("tier")), f"SELECT k, {_TIER_SQL} AS tier FROM @src")
query("escalate_tier", _TIERS, lambda d: d.select("k", codes.tier(F.col("p"), F.col("m")).alias("t")).select("k", codes.escalated(F.col("t")).alias("next"), codes.split_tier(F.col("t"))[0].alias("provider"), codes.split_tier(F.col("t"))[1].alias("model"), codes.backoff(F.lit(1.0), F.lit(2), F.lit(0.5)).alias("delay")), f"SELECT k, CASE t WHEN 'anthropic-haiku' THEN 'anthropic-sonnet' WHEN 'openai-gpt-4o-mini' THEN 'openai-gpt-4o' END AS next, t[:strpos(t, '-') - 1] AS provider, t[strpos(t, '-') + 1:] AS model, CAST(4.5 AS DOUBLE) AS delay FROM (SELECT k, {_TIER_SQL} AS t FROM @src)")

# Evaluation
_KEYS = ["doc_key", "agent", "jurisdiction"]
_FIELDS = ["name_latin", "doc_number", "nationality", "expiry_date"]
_LONG = lambda rel: " UNION ALL ".join(f"SELECT doc_key, agent, jurisdiction, '{f}' AS field, coalesce({f}, '') AS v FROM @{rel}" for f in _FIELDS)
_RESULTS = f"(SELECT doc_key, agent, jurisdiction, field, e.v AS expected, a.v AS actual, e.v = a.v AS matched, 0.0125::DOUBLE AS cost_usd FROM ({_LONG('want')}) e FULL JOIN ({_LONG('got')}) a USING (doc_key, agent, jurisdiction, field) WHERE e.v <> '' OR a.v <> '')"
_BOTH = {"want": inputs.RECORD, "got": inputs.READ}
_HIT, _METRICS = "count(*) FILTER (WHERE matched)", "coalesce(count(*) FILTER (WHERE matched) / nullif(count(*) FILTER (WHERE actual <> ''), 0), 0)::DOUBLE AS precision, coalesce(count(*) FILTER (WHERE matched) / nullif(count(*) FILTER (WHERE expected <> ''), 0), 0)::DOUBLE AS recall, count(DISTINCT field) FILTER (WHERE matched) / count(DISTINCT field) AS field_coverage, count(*) AS examples"


def _compared(want, got):
    return evaluate.compare(want, got, _KEYS).withColumn("cost_usd", F.lit(0.0125))


query2("field_compare_long", _BOTH, lambda want, got: _compared(want, got).drop("cost_usd"), f"SELECT * EXCLUDE (cost_usd) FROM {_RESULTS}")
query2("scorecard_agent", _BOTH, lambda want, got: evaluate.by_agent(_compared(want, got)), f"SELECT agent, {_METRICS} FROM {_RESULTS} GROUP BY agent")
query2("scorecard_field", _BOTH, lambda want, got: evaluate.by_field(_compared(want, got)), f"SELECT agent, field, {_HIT} / count(*) AS match_rate, count(*) AS examples FROM {_RESULTS} GROUP BY ALL")
query2("scorecard_jurisdiction", _BOTH, lambda want, got: evaluate.by_jurisdiction(_compared(want, got)), f"SELECT jurisdiction, agent, {_METRICS} FROM {_RESULTS} GROUP BY jurisdiction, agent")
query2("scorecard_grouping_sets", _BOTH, lambda want, got: evaluate.in_one_pass(_compared(want, got)), f"SELECT agent, field, jurisdiction, {_HIT} AS n_matched, count(*) FILTER (WHERE actual <> '') AS n_actual, count(*) FILTER (WHERE expected <> '') AS n_expected, count(*) AS examples, CASE GROUPING(agent, field, jurisdiction) WHEN 3 THEN 'agent' WHEN 1 THEN 'field' WHEN 2 THEN 'jurisdiction' ELSE 'total' END AS level FROM {_RESULTS} GROUP BY GROUPING SETS ((agent), (agent, field), (agent, jurisdiction), ())")
query2("scorecard_totals", _BOTH, lambda want, got: evaluate.totals(_compared(want, got)).select("examples", F.round("total_cost_usd", 6).alias("total_cost_usd"), F.round("distinct_doc_cost_usd", 6).alias("distinct_doc_cost_usd"), gates.run_breach(F.col("total_cost_usd")).alias("cost_breach")), f"SELECT count(*) AS examples, round(sum(cost_usd), 6) AS total_cost_usd, round(count(DISTINCT doc_key) * 0.0125, 6)::DOUBLE AS distinct_doc_cost_usd, sum(cost_usd) > 15 AS cost_breach FROM {_RESULTS}")
_FLOORS = "SELECT 'Passport' AS agent, unnest(['name_latin', 'doc_number', 'expiry_date']) AS field, 0.98::DOUBLE AS floor UNION ALL SELECT 'PaymentReceipt', unnest(['receipt_debit_account_number', 'receipt_credit_account_number', 'receipt_amount', 'receipt_time']), 0.95 UNION ALL SELECT 'DriverLicence', unnest(['name_latin', 'doc_number']), 0.95 UNION ALL SELECT 'NationalID', unnest(['id_card_number', 'name_latin']), 0.95 UNION ALL SELECT 'Visa', unnest(['visa_class', 'valid_to']), 0.95"
query2("breach_lines", _BOTH, lambda want, got: gates.breach_lines(gates.breaches(evaluate.by_field(_compared(want, got)), gates.floor_table(want.sparkSession))), f"SELECT agent || '.' || field || printf(': %.4f < %.4f', match_rate, floor) AS line FROM (SELECT r.*, coalesce(f.floor, 0.9)::DOUBLE AS floor FROM (SELECT agent, field, {_HIT} / count(*) AS match_rate FROM {_RESULTS} GROUP BY ALL) r LEFT JOIN ({_FLOORS}) f USING (agent, field)) WHERE match_rate + 1e-9 < floor")
query2("eval_selected", _BOTH, lambda want, got: evaluate.by_agent(_compared(evaluate.selected(want, "CN", "Passport"), evaluate.selected(got, "CN", "Passport"))), f"SELECT agent, {_METRICS} FROM {_RESULTS} WHERE jurisdiction = 'CN' AND agent = 'Passport' GROUP BY agent")
_RATES = f"(SELECT agent, field, {_HIT} / count(*) AS match_rate, count(*) AS examples FROM {_RESULTS} GROUP BY ALL)"
query2("threshold_lookup", _BOTH, lambda want, got: gates.with_floor(evaluate.by_field(_compared(want, got)), gates.floor_table(want.sparkSession)), f"SELECT r.*, coalesce(f.floor, 0.9)::DOUBLE AS floor FROM {_RATES} r LEFT JOIN ({_FLOORS}) f USING (agent, field)")
query2("threshold_breaches", _BOTH, lambda want, got: gates.breaches(evaluate.by_field(_compared(want, got)), gates.floor_table(want.sparkSession)), f"SELECT * FROM (SELECT r.*, coalesce(f.floor, 0.9)::DOUBLE AS floor FROM {_RATES} r LEFT JOIN ({_FLOORS}) f USING (agent, field)) WHERE match_rate + 1e-9 < floor")
query2("canonical_four_gate", _BOTH, lambda want, got: gates.canonical_four(_compared(want, got), _FIELDS), f"SELECT doc_key, bool_and(matched) AS passed, count(*) AS compared FROM {_RESULTS} GROUP BY doc_key")

# Telemetry
query("success_only_costs", inputs.TELEMETRY, lambda d: gates.successes(d).groupBy("agent").agg(F.count("*").alias("n"), F.round(F.sum("cost_usd"), 6).alias("cost_usd")), "SELECT agent, count(*) AS n, round(sum(cost_usd), 6) AS cost_usd FROM @src WHERE success AND cost_usd IS NOT NULL GROUP BY agent")
query("cost_median_7d", inputs.TELEMETRY, lambda d: gates.median_gate(d).select(F.round("median_usd", 9).alias("median_usd"), "records", "days", "passed"), "SELECT round(median(cost_usd), 9) AS median_usd, count(*) AS records, count(DISTINCT event_date) AS days, median(cost_usd) IS NULL OR median(cost_usd) <= 0.03 AS passed FROM (SELECT *, dense_rank() OVER (ORDER BY event_date DESC) AS r FROM @src) WHERE r <= 7 AND success AND cost_usd IS NOT NULL")
query("cost_per_day", inputs.TELEMETRY, lambda d: d.groupBy(F.col("event_date").cast("string").alias("event_day")).agg(F.count("*").alias("n"), F.count_if("success").alias("successes"), F.round(F.sum("cost_usd"), 6).alias("cost_usd")), "SELECT CAST(event_date AS STRING) AS event_day, count(*) AS n, count(*) FILTER (WHERE success) AS successes, round(sum(cost_usd), 6) AS cost_usd FROM @src GROUP BY 1")
query("cost_per_doc", inputs.TELEMETRY, lambda d: gates.cost_per_document(d).withColumn("cost_usd", F.round("cost_usd", 6)), "SELECT source_key, round(sum(cost_usd), 6) AS cost_usd, count(*) AS attempts, count(*) FILTER (WHERE NOT success) AS failures FROM @src GROUP BY 1")
query(
    "telemetry_roundtrip", f"SELECT event_id, {case('event_id', ['props', chr(39) + ' ' + chr(39), 'concat(' + chr(39) + '{{' + chr(39) + ', event_type)'])} AS line FROM {{events}}",
    lambda d: files.malformed(d).select("event_id"), "SELECT event_id FROM @src WHERE event_id % 3 <> 0",
)
query("pii_tripwire", "SELECT conv_id AS k, turn, text AS line FROM {conversations} UNION ALL SELECT doc_id AS k, -1 AS turn, concat(text, ' 123-45-6789 2020-01-02 x**') AS line FROM {documents} UNION ALL SELECT c_custkey AS k, -2 AS turn, concat('P', '<NZL ', c_name, ' 2020-01-02T00 \"dob\"') AS line FROM {customer}", lambda d: d.select("k", "turn", F.array_join(pii.hits(F.col("line")), ",").alias("hits")), r"""SELECT k, turn, array_to_string(list_filter([""" + ", ".join(rf"CASE WHEN regexp_matches(line, '{p.replace('(?!T)', '(?:[^T]|$)')}') THEN '{n}' END" for n, p in pii.PATTERNS.items()) + ", " + ", ".join(f"""CASE WHEN contains(line, '"{f}"') THEN 'field:{f}' END""" for f in pii.FIELDS) + """], lambda x: x IS NOT NULL), ',') AS hits FROM @src""")
_AUDIT = f"SELECT l.doc_id AS doc_id, f.field AS field, {case('l.doc_id + f.n', [chr(39) + v + chr(39) for v in ('agree', 'agree', 'agree', 'agree', 'abstain', 'agree', 'disagree', 'agree', 'agree', 'agree', 'agree')])} AS verdict FROM {{labels}} l CROSS JOIN (SELECT 'a' AS field, 1 AS n UNION ALL SELECT 'b', 2 UNION ALL SELECT 'c', 5) f"
_ROLL = "CASE WHEN bool_or(verdict = 'disagree') THEN 'fail' WHEN bool_or(verdict = 'abstain') THEN 'uncertain' ELSE 'pass' END"
query("verdict_rollup", _AUDIT, lambda d: d.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("field", "verdict"))).alias("m")).select("doc_id", gates.overall(F.col("m")).alias("overall")), f"SELECT doc_id, {_ROLL} AS overall FROM @src GROUP BY doc_id")
query("verdict_fail_only", _AUDIT, lambda d: gates.disagreements(gates.overall_rows(d, ["doc_id"])).select("doc_id", keyed.disagreement_key(F.col("doc_id").cast("string")).alias("path"), "fields"), f"SELECT doc_id, 'disagreements/' || doc_id || '.json' AS path, count(*) AS fields FROM @src GROUP BY doc_id HAVING {_ROLL} = 'fail'")
query2("verifier_compare", _BOTH, lambda want, got: evaluate.long_form(want, _KEYS, "a").join(evaluate.long_form(got, _KEYS, "b"), [*_KEYS, "field"]).select("doc_key", "field", gates.verdict(F.col("a"), F.col("b")).alias("verdict")), f"SELECT doc_key, field, CASE WHEN a.v = '' THEN 'abstain' WHEN e.v = a.v THEN 'agree' ELSE 'disagree' END AS verdict FROM ({_LONG('want')}) e JOIN ({_LONG('got')}) a USING (doc_key, agent, jurisdiction, field)")


# Boundary
_GOLDEN = f"SELECT concat('golden/', {case('page_id', [chr(39) + 'passport' + chr(39), chr(39) + 'visa' + chr(39)])}, '/p', {text('page_id')}, {case('page_id', [chr(39) + x + chr(39) for x in ('.png', '.pdf', '.jpeg')])}) AS path FROM {{pages}} UNION ALL SELECT concat('golden/', {case('page_id', [chr(39) + 'passport' + chr(39), chr(39) + 'visa' + chr(39)])}, '/p', {text('page_id')}, {case('page_id', [chr(39) + x + chr(39) for x in ('.png.expected.md', '.expected.md', '.txt', '.expected.md')])}) AS path FROM {{pages}}"
query("golden_pairs", _GOLDEN, lambda d: files.golden_pairs(d), "SELECT i.t AS doc_type, i.stem AS stem, i.path AS image, coalesce(a.path, b.path) AS expected FROM (SELECT path, string_split(path, '/')[2] AS t, regexp_extract(path, '([^/]+)\\.[a-z]+$', 1) AS stem FROM @src WHERE regexp_matches(path, '\\.(png|pdf|jpe?g)$')) i LEFT JOIN (SELECT path FROM @src) a ON a.path = i.path || '.expected.md' LEFT JOIN (SELECT path FROM @src) b ON b.path = regexp_replace(i.path, '\\.[a-z]+$', '') || '.expected.md'".replace("\\\\", "\\"))
_EXTRACT = f"SELECT {text('doc_id')} AS key, 'Other' AS doc_type, concat('Description: ', source, chr(10), 'Notes: ', lang) AS text FROM {{documents}}"
query("batch_extract_rows", _EXTRACT, lambda d: extract.extract(d, extract.rule_extractor).select("key", "status", F.try_element_at("fields", F.lit("description")).alias("description"), F.try_element_at("fields", F.lit("notes")).alias("notes"), F.size("attempts").alias("attempts")), "SELECT key, 'passed' AS status, split_part(text, chr(10), 1)[14:] AS description, split_part(text, chr(10), 2)[8:] AS notes, 1 AS attempts FROM @src")
query("page_split", f"SELECT {text('page_id')} AS key, concat(url, chr(12), 'second', chr(12), 'third') AS content, {case('page_id', [chr(39) + 'page1' + chr(39), chr(39) + 'all_pages' + chr(39)])} AS mode FROM {{pages}}", lambda d: extract.pages(d.withColumn("content", F.encode("content", "utf-8"))).select("key", "page_no", F.decode("png", "utf-8").alias("page")), "SELECT key, CAST(i - 1 AS INTEGER) AS page_no, string_split(content, chr(12))[i] AS page FROM @src, unnest(CASE WHEN mode = 'page1' THEN [1] ELSE [1, 2, 3] END) AS u(i)")
query("registry_extract", f"SELECT {text('c_custkey')} AS key, {case('c_custkey', [chr(39) + t + chr(39) for t in ('Passport', 'BankStatement', 'Unheard')])} AS doc_type, concat('- Full Name: ', c_name, chr(10), 'Account Number: 12-3', chr(10), '**Passport Number: E', {text('c_custkey')}) AS text FROM {{customer}}", lambda d: extract.extract(d, extract.by_registry).select("key", "status", F.coalesce(F.try_element_at("fields", F.lit("passport_number")), F.lit("")).alias("passport_number"), F.coalesce(F.try_element_at("fields", F.lit("account_number")), F.lit("")).alias("account_number")), "SELECT key, CASE WHEN doc_type = 'Unheard' THEN 'failed' ELSE 'passed' END AS status, CASE WHEN doc_type = 'Passport' THEN 'E' || key ELSE '' END AS passport_number, CASE WHEN doc_type = 'BankStatement' THEN '12-3' ELSE '' END AS account_number FROM @src")

from . import rules  # noqa: E402, F401  registers its queries

CATALOG.update(stored.QUERIES)
