"""Inputs made inside a query from the driver's tables, by SQL that Spark and DuckDB both run.

`{orders}` and the like name tables. Nothing here leaves rows of a table out.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession

from ..session import compiled, spread

MONTH = "CASE month(o_orderdate) " + " ".join(f"WHEN {i + 1} THEN '{m}'" for i, m in enumerate("January February March April May June July August September October November December".split())) + " END"


def tables_of(sql: str) -> list[str]:
    return sorted({name for _, name, _, _ in string.Formatter().parse(sql) if name})


def run(spark: SparkSession, sf_dir: str, sql: str, dealt: str = "") -> DataFrame:
    """The rows of sql. The rows of table `dealt` go to all cores first, as tables, before texts are made of them."""
    compiled(spark)
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables_of(sql)}
    return spark.sql(sql, **{t: spread(df) if t == dealt else df for t, df in tables.items()})


def duck(sql: str) -> str:
    return sql.format(**{t: t for t in tables_of(sql)})


def case(key: str, values: list[str]) -> str:
    """values (SQL) by key modulo their number."""
    return f"CASE ({key}) % {len(values)} " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values)) + " END"


def text(key: str) -> str:
    return f"CAST({key} AS STRING)"


NZ = f"""SELECT o_orderkey AS k, concat('Bank transfer ', {case('o_orderkey', ["'of NZD '", "'of usd '", "'of AUD '", "'OF GBP '", "'for '"])},
  {text('o_orderkey % 90 + 1')}, ',', lpad({text('o_orderkey % 1000')}, 3, '0'), '.', lpad({text('o_orderkey % 100')}, 2, '0'),
  ' sent to account ', c_name, ' (account number 12-', lpad({text('c_custkey')}, 8, '0'), '-00) from account ', {case('o_orderkey', [chr(39) + q + chr(39) for q in ('"', '“', '‘“')])}, c_mktsegment, ' & Co', {case('o_orderkey', [chr(39) + q + chr(39) for q in ('"', '”', '” ')])}, ' (account number 06-', lpad({text('o_orderkey')}, 9, '0'), ')',
  {case('o_orderkey', ["' on Tuesday, '", "' on '", "' on Friday, '"])}, {text('day(o_orderdate)')}, ' ', {case('o_orderkey', [MONTH] * 6 + [f"substring({MONTH}, 1, 3)"])}, ' ', {text('year(o_orderdate)')}) AS body
FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey"""

CN = f"""SELECT o_orderkey AS k, concat('# receipt', chr(10), {case('o_orderkey', ["'付款人: '", "'**付款户名**: '", "'- 付款人姓名：'", "'汇款人 : '"])}, {case('o_orderkey', ["c_name", "concat('[', c_name, ']')", "concat('（', c_name, '）')", "concat('**', c_name, '**  ')", "concat(c_name, '   ')"])}, chr(10),
  {case('o_orderkey', ["'付款卡号: '", "'付款账号：'", "'付款账户号码: '"])}, '6217 **** **** ', lpad({text('o_orderkey % 10000')}, 4, '0'), {case('o_orderkey', ["''", "'  '"])}, chr(10),
  {case('o_orderkey', ["'付款方银行: 中国银行'", "'付款行: ICBC (NZ)'", "'no bank'"])}, chr(10), '收款人: ', s_name, chr(10), '收款账号: **** ', {text('s_suppkey')}, chr(10), '收款银行：', '[BOC]', chr(10),
  {case('o_orderkey', ["'金额: '", "'付款金额: '"])}, {text('o_orderkey % 5000')}, '.00', chr(10), '币种: CNY', chr(10), {case('o_orderkey', ["'交易时间: 2025-07-01 10:00:00'", "'时间:'"])}, chr(10), '备注: ', o_orderpriority, chr(10), '用途: later', chr(10), '付款工具: (WeChat)') AS body
FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey JOIN {{supplier}} ON s_suppkey = o_orderkey % (SELECT count(*) FROM {{supplier}}) + (SELECT min(s_suppkey) FROM {{supplier}})"""

MIXED = f"SELECT a.k, {case('a.k', ['a.body', 'b.body', chr(39) + 'nothing to see' + chr(39)])} AS body FROM ({NZ}) a JOIN ({CN}) b ON a.k = b.k"

FRONT = f"""SELECT c_custkey AS k, concat('---', chr(10), 'doc_type: PaymentReceipt', chr(10), 'name_latin: "', c_name, '"', chr(10), 'jurisdiction: ', n_name, chr(10), 'receipt_reference: "', {text('c_custkey')}, '"', chr(10), {case('c_custkey', ["concat('---', chr(10))", "concat('---', chr(10), chr(10), 'Body of ', c_mktsegment, chr(10), '---', chr(10), 'tail')", "'no end'"])}) AS md
FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey"""

TYPE_LABELS = ["KYC Verification summary", "TT receipt", "Account opening form", "Trust Deed", "Certificate of Incorporation", "FATCA self-certification", "Third party letter", "Letter from the bank: bank letter", "Bank Statement (AU)", "PEP check", "Utility Bill", "Driver Licence", "身份证", "Visa", "Passport", "中国护照", "Advisal", "Old passport", "Picture"]
TYPES = f"""SELECT p_partkey AS k, concat('# Analysis', chr(10), {case('p_partkey', ["'DOCUMENT_TYPE: '", "'**DOCUMENT_TYPE:** '", "'TYPE: '", "'**DOCUMENT_TYPE**: '"])}, {case('p_partkey', [f"'{x}'" for x in TYPE_LABELS])}, chr(10), p_name) AS text FROM {{part}}"""

RECORD = f"""SELECT c_custkey AS doc_key, {case('c_custkey', ["'Passport'", "'Visa'", "'Other'"])} AS agent, {case('c_custkey', ["'NZ'", "'CN'", "'AU'", "'US'"])} AS jurisdiction, c_name AS name_latin, c_mktsegment AS doc_number, {text('c_nationkey')} AS nationality, {case('c_custkey', ["''"] + [text('CAST(c_acctbal AS DECIMAL(12,2))')] * 4)} AS expiry_date FROM {{customer}}"""
READ = f"""SELECT c_custkey AS doc_key, {case('c_custkey', ["'Passport'", "'Visa'", "'Other'"])} AS agent, {case('c_custkey', ["'NZ'", "'CN'", "'AU'", "'US'"])} AS jurisdiction, {case('c_custkey', ['c_name'] * 6 + ['lower(c_name)'])} AS name_latin, {case('c_custkey', ['c_mktsegment'] * 4 + ["''"])} AS doc_number, {case('c_custkey', [text('c_nationkey')] * 8 + [text('c_nationkey + 1')])} AS nationality, {case('c_custkey', ["''"] * 2 + [text('CAST(c_acctbal AS DECIMAL(12,2))')])} AS expiry_date FROM {{customer}}"""

TELEMETRY = "SELECT event_id, CAST(ts AS DATE) AS event_date, ts, user_id AS source_key, event_type AS agent, event_type <> 'error' AS success, value / 1000 AS cost_usd FROM {events}"
