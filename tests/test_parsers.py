"""Receipt, legacy, record and scalar rules on stated vectors and against Python's own regular expressions."""

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docspark import schemas
from docspark.functions import codes, dates, match, pii
from docspark.functions import text as tx
from docspark.operators import legacy, receipts, records


def one(spark, column, **values):
    names = list(values)
    frame = spark.createDataFrame([tuple(values.values())], ", ".join(f"{n} {'string' if not isinstance(v, bool) else 'boolean'}" for n, v in values.items()))
    assert names
    return frame.select(column.alias("x")).first()["x"]


def cn(spark, body):
    return receipts.parse_cn(spark.createDataFrame([(body,)], "body string")).first().asDict()


@pytest.mark.parametrize("value", ["[张三]", "(张三)", "（张三）", "张三   ", "**张三**"])
def test_cn_name_is_cleaned(spark, value):
    assert cn(spark, f"付款人: {value}")["receipt_debit_account_name"] == "张三"


def test_cn_labels(spark):
    assert cn(spark, "付款卡号: 6217 **** **** 0083")["receipt_debit_account_number"] == "6217 **** **** 0083"
    assert cn(spark, "付款账号: **** **** **** 0083")["receipt_debit_account_number"] == "**** **** **** 0083"
    both = cn(spark, "付款方银行: X\n付款方: Y")
    assert (both["receipt_debit_bank_name"], both["receipt_debit_account_name"]) == ("X", "Y")
    assert cn(spark, "备注: a\n用途: b")["receipt_reference"] == "a"
    assert cn(spark, "- **收款人**：王 大 明")["receipt_credit_account_name"] == "王 大 明"
    assert cn(spark, "付款人:\n付款卡号: 62")["receipt_debit_account_name"] == "付款卡号: 62"
    assert all(v == "" for k, v in cn(spark, "").items() if k != "body")


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from(["付款人", "付款人姓名", ":", "：", " ", "\n", "\r", "*", "(", "（", "a", "张", "　", "金额", "12", "\t", "\x85"]), max_size=14).map("".join))
def test_cn_pattern_like_python(spark, body):
    got = cn(spark, body)
    for name in ("receipt_debit_account_name", "receipt_amount"):
        kind, labels = receipts.LABELS[name]
        names = "|".join(sorted(labels, key=len, reverse=True))  # each field on its own, by a search for its labels
        m = re.search(rf"(?m)(?:^|[\s*(\[（])(?:{names})[\s*]*[:：]\s*([^\n]+)", body)
        value = m.group(1) if m else ""
        if kind == "name":
            value = re.sub(r"[\*\s\]\)）]+\Z", "", re.sub(r"^[\*\s\[\(（]+", "", value))
        assert got[name] == value.strip()


NZ = 'Bank transfer of NZD 1,234.50 sent to account Bob Lee (account number 12-3456-7) from account "Ann" (account number 01-22) on Tuesday, 1 July 2025'


def nz(spark, body):
    return receipts.parse_nz(spark.createDataFrame([(body,)], "body string")).first().asDict()


def test_nz(spark):
    got = nz(spark, NZ)
    assert got["error"] == "" and got["receipt_amount"] == "1234.50" and got["receipt_time"] == "2025-07-01T00:00:00Z"
    assert (got["receipt_debit_account_name"], got["receipt_credit_account_number"]) == ("Ann", "12-3456-7")
    assert nz(spark, NZ.replace('"Ann"', "“Ann”"))["receipt_debit_account_name"] == "Ann"
    assert nz(spark, NZ.replace("NZD", "usd"))["receipt_currency"] == "USD"
    assert nz(spark, NZ.replace("NZD", "CNY"))["error"] == "amount"
    assert nz(spark, NZ.replace("from", "by"))["error"] == "accounts"
    assert nz(spark, NZ.replace("July", "Jul"))["error"] == "calendar"
    assert nz(spark, NZ.replace("1 July", "31 February"))["error"] == "calendar"
    assert nz(spark, NZ.split(" on ")[0])["error"] == "date"
    twice = nz(spark, NZ.replace(" on Tues", " from account Zed (account number 9-9) on Tues"))
    assert twice["receipt_debit_account_name"] == "Zed"


BODY = "Bank transfer of {money} sent to account {to} (account number 12-3456-7890123-00) from account {sender} (account number 98-7654-3210987-99) on {day}"


@pytest.mark.parametrize("money,amount,ccy", [("NZD 15,000.00", "15000.00", "NZD"), ("gbp 99", "99", "GBP"), ("EUR 1,2.50.", "12.50", "EUR"), ("AUD 7.5", "7", "AUD"), ("USD 7.125", "7", "USD"), ("USD 15,000,", "15000", "USD"), ("AUD 1,234abc", "1", "AUD"), ("CNY 5 of NZD\n 6.00", "6.00", "NZD"), ("NZD\xa08.00)", "8.00", "NZD")])
def test_nz_amounts(spark, money, amount, ccy):
    got = nz(spark, BODY.format(money=money, to="A", sender="B", day="Friday, 5 December 2025"))
    assert (got["receipt_amount"], got["receipt_currency"], got["error"]) == (amount, ccy, "")


@pytest.mark.parametrize("money", ["NZD", "NZD x", "NZDX 5", "NZ 5", "NZD 12abc", "NZD ,"])
def test_nz_no_amount(spark, money):
    assert nz(spark, BODY.format(money=money, to="A", sender="B", day="5 December 2025"))["error"] == "amount"


@pytest.mark.parametrize("to,sender,want", [("Acme  Ltd-1", "“Free Up-00”", ("Acme  Ltd-1", "Free Up-00")), ("Bank of China on Main", "'B'\n", ("Bank of China on Main", "B")), ("\n A", "x from account y", ("A", "x from account y")), ("A (NZ)", "B", ("A (NZ)", "B"))])
def test_nz_names(spark, to, sender, want):
    got = nz(spark, BODY.format(money="NZD 5", to=to, sender=sender, day="Friday, 5 December 2025"))
    assert (got["receipt_credit_account_name"], got["receipt_debit_account_name"]) == want
    assert (got["receipt_credit_account_number"], got["receipt_debit_account_number"]) == ("12-3456-7890123-00", "98-7654-3210987-99")


@pytest.mark.parametrize("day,time", [("1 July 2025.", "2025-07-01T00:00:00Z"), ("Tuesday,  01 July\n2025", "2025-07-01T00:00:00Z"), ("time on Monday, 2 June 2025", "2025-06-02T00:00:00Z")])
def test_nz_days(spark, day, time):
    assert nz(spark, BODY.format(money="NZD 5", to="A", sender="B", day=day))["receipt_time"] == time


@pytest.mark.parametrize("day", ["July 2025", "1 July 20256", "1 Ju1y 2025", "123 July 2025", "Mon 1 July 2025"])
def test_nz_no_day(spark, day):
    assert nz(spark, BODY.format(money="NZD 5", to="A", sender="B", day=day))["error"] == "date"


def test_fallback_and_merge(spark):
    frame = spark.createDataFrame([("a", "金额: 5"), ("b", NZ), ("c", "none"), ("d", None)], "k string, body string")
    got = {r["k"]: r for r in receipts.parse_either(frame).collect()}
    assert [got[k]["layout"] for k in "abcd"] == ["cn", "nz", "none", "none"]
    assert got["b"]["receipt_debit_bank_name"] == ""
    pair = spark.createDataFrame([("", "x", "1", "2", "3", None)], "p string, old_p string, q string, old_q string, r string, old_r string")
    row = receipts.merge_filled(pair, ["p", "q", "r"]).first()
    assert (row["merged_p"], row["merged_q"], row["merged_r"], row["changed"]) == ("x", "1", "3", ["q", "r"])


def test_receipts_are_read_by_steps_that_are_compiled(spark):
    """Exploding one element interprets all that it holds; a method above 8,000 bytes is never compiled to machine code."""
    plan = receipts.parse_either(spark.range(3).selectExpr("id AS k", "concat('金额: ', id) AS body"))._jdf.queryExecution()
    assert "Generate" not in plan.executedPlan().toString()
    stages = plan.debug().codegenToSeq()
    assert all(stages.apply(i)._3().maxMethodCodeSize() < 8000 for i in range(stages.size()))


@pytest.mark.parametrize("text,amount", [("of NZD 5", "5"), ("-OF NZD 5", "5"), ("of of NZD 5", "5"), ("of\u3000nzd 5", "5"), ("xof NZD 5", None), ("_of NZD 5", None), ("éof NZD 5", None), ("ofNZD 5", None)])
def test_of_is_a_word(spark, text, amount):
    assert nz(spark, text + ' from account A (account number 1) to account B (account number 2) on 1 July 2025')["receipt_amount"] == amount


@pytest.mark.parametrize("text,amount", [("金额: 5", "5"), ("x\n金额:5", "5"), ("(金额*：\n5", "5"), ("x金额: 5", ""), (":金额: 5", ""), ("币种: 金额: 5", "5"), ("金额 5", "")])
def test_label_begins_after_a_space_or_bracket(spark, text, amount):
    assert cn(spark, text)["receipt_amount"] == amount


LEGACY = "**Model:** `m`\n**Analyzed:** 2026-01-02 03:04\nDOCUMENT_TYPE: Passport\n**FIELDS:**\n- Full Name: SUN, JIAWEI (孙嘉蔚)\n- **Nationality**: Chinese\n- nationality: KIWI\n- Date of Birth: 30 JUN 1999\n- Sex: 女\n- Place of Birth: Xi an (CN)\nRAW_TEXT:\n- Passport Number: no"


def test_legacy_passport(spark):
    row = legacy.map_legacy(spark.createDataFrame([(LEGACY,), (None,)], "text string"), "Passport").collect()
    got = row[0]
    assert list(got.asDict()) == [f.name for f in schemas.schema("Passport")] and len(got) == 20
    assert (got["name_latin"], got["name_cjk"], got["nationality"], got["dob"], got["sex"], got["place_of_birth"], got["passport_number"]) == ("SUN JIAWEI", "孙嘉蔚", "CHN", "1999-06-30", "F", "XI AN", "")
    assert got["extraction_timestamp"] == "2026-01-02T03:04:00Z"
    assert row[1]["name_latin"] == "" and row[1]["doc_type"] == "Passport"


@pytest.mark.parametrize("text,fields", [
    ("FIELDS\r\n- A: 1\r\n\r\n* **B **:\u30002 \x85-c:d: e", [("a", "1"), ("b", "2"), ("c", "d: e")]),
    ("fıelds:**\n- A: 1\n  **quality**: x\n- B: 2", [("a", "1")]),
    ("***FIELDS\n- A: 1", []), ("FIELDS::\n- A: 1", []), ("FIELDS:\n---\n- A: 1", []),
    ("FIELDS:\n- ** **: x\n- : x\n- ***a: x\n- a*b: x\n- A:\u00a0\n-- b: x\nNOTES\n- B: y", [("", "x"), ("- b", "x"), ("b", "y")]),
    (None, []), ("", []),
])
def test_fields_block(spark, text, fields):
    df = spark.createDataFrame([(text,)], "text string")
    assert [tuple(f) for f in legacy.with_fields(df).first()["fields"]] == fields


def test_lists_are_null_or_full(spark):
    texts = spark.createDataFrame([("FIELDS:\n- Directors: A; B and C, ",), ("FIELDS:\n- Name: X",)], "text string")
    got = legacy.map_legacy(texts, "CompanyExtract").collect()
    assert got[0]["directors"] == ["A", "B", "C"] and got[1]["directors"] is None
    owner = legacy.map_legacy(spark.createDataFrame([("FIELDS:\n- UBO Name: Z\n- Percentage: 30%",)], "text string"), "EntityOwnership").first()
    assert owner["ultimate_beneficial_owners"][0].asDict() == {"name": "Z", "dob": "", "ownership_percentage": "30%"}


@pytest.mark.parametrize("label,slug", [("Third party letter", "tax_residency"), ("Self certification of tax", "tax_residency"), ("self-certification", "pep_declaration"), ("Old passport", "other"), ("PASSPORT NZ", "passport"), ("advisal", "other"), ("VISA", "visa")])
def test_type_rules(spark, label, slug):
    assert one(spark, legacy.detect_type("t"), t=f"x\nDOCUMENT_TYPE: {label}\ny") == slug


def test_column_counts():
    counts = {t: len(schemas.schema(t)) for t in schemas.DOC_TYPES}
    assert counts == {"Passport": 20, "DriverLicence": 20, "NationalID": 20, "Visa": 22, "PaymentReceipt": 23, "BankStatement": 19, "BankAccountConfirmation": 17, "PEP_Declaration": 16, "VerificationReport": 17, "ApplicationForm": 16, "CompanyExtract": 16, "EntityOwnership": 12, "ProofOfAddress": 15, "TaxResidency": 15, "Other": 13}
    assert [schemas.slug(t) for t in ("NationalID", "PEP_Declaration", "BankAccountConfirmation")] == ["national_id", "pep_declaration", "bank_account_confirmation"]


@pytest.mark.parametrize("given,want", [("2017-02-13T1", "2017-02-13"), ("30 Jun 1999", "1999-06-30"), ("5/July/2001", "2001-07-05"), ("99/99/2020", "2020-99-99"), ("31-12-1999", "1999-12-31"), ("9 Foo 2001", ""), ("", ""), ("x", "")])
def test_best_effort_dates(spark, given, want):
    assert one(spark, dates.best_effort(F.col("s")), s=given) == want


def test_codes(spark):
    assert one(spark, codes.country3(F.col("s")), s=" new zealand ") == "NZL"
    assert one(spark, codes.country3(F.col("s")), s="Narnia") == "NARNIA"
    assert one(spark, codes.currency(F.col("s"), F.col("j")), s="$", j="NZ") == "NZD"
    assert one(spark, codes.tier(F.col("p"), F.col("m")), p="openai", m="gpt-4o-mini-x") == "openai-gpt-4o-mini"
    assert one(spark, codes.escalated(F.col("t")), t="anthropic-sonnet") is None
    assert one(spark, codes.split_tier(F.col("t"))[1], t="plain") == "plain"
    assert one(spark, codes.cn_id_fields(F.col("t"))["check_ok"], t="11010519491231002X") is True


def test_matchers(spark):
    assert one(spark, match.exact(F.col("a"), F.col("b")), a="E1", b="e1") is False
    assert one(spark, match.normalised(F.col("a"), F.col("b")), a="MUÑOZ ", b="muñoz") is True
    assert one(spark, match.normalised(F.col("a"), F.col("b")), a="ß", b="ss") is False
    for j, want in (("CN", True), ("AU", False)):
        assert one(spark, match.with_jurisdiction(F.col("a"), F.col("b"), F.col("j")), a="6217 **** **** 1234", b="6217 ******** 1234", j=j) is want


def test_tripwire(spark):
    assert one(spark, F.array_join(pii.hits(F.col("s")), ","), s='{"ts":"2025-07-01T00:00:00Z"}') == ""
    assert one(spark, F.array_join(pii.hits(F.col("s")), ","), s='{"dob":"2025-07-01"} **') == "mask,dob,field:dob"


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.characters(codec="utf-8", exclude_characters="-\x85  ", exclude_categories=("Cc", "Cs")), max_size=12), min_size=3, max_size=3))
def test_records_round_trip(spark, values):
    pytest.importorskip("yaml")
    a, b, c = values
    frame = spark.createDataFrame([(a, b, c)], "name_latin string, tin string, holder_name string")
    closed = frame.select(*schemas.closed({"doc_type": F.lit("TaxResidency"), "name_latin": F.col("name_latin"), "tin": F.col("tin"), "holder_name": F.col("holder_name")}, "TaxResidency"))
    back = records.typed(records.parse(records.render(closed, "TaxResidency").select("md")), "TaxResidency", []).first()
    want = closed.first()
    assert {k: v for k, v in back.asDict().items() if k != "error"} == want.asDict() and back["error"] == ""


def test_record_errors(spark):
    pytest.importorskip("yaml")
    mds = ["---\ndoc_type: Visa\nextra: x\n---\n", "---\ndob: 2025-01-01\n---\n", "no", "---\n- a\n---\n", "---\n---\n"]
    got = records.parse(spark.createDataFrame([(m,) for m in mds], "md string"))
    assert [r["error"] for r in got.collect()] == ["", "dob: no text", "no frontmatter", "no mapping", ""]
    assert records.typed(got, "Visa", []).first()["error"] == "unknown: extra"


def test_folding_every_character(spark):
    import unicodedata

    points = [p for p in range(0x20, 0x32000) if not 0xD800 <= p < 0xE000 and unicodedata.category(chr(p)) != "Cn"]  # what the library knows as assigned
    texts = [f"x{chr(p)}Y \u00a0" for p in points]
    got = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", match.folded(F.col("t")).alias("f")).collect()
    want = ["".join(c for c in unicodedata.normalize("NFKD", t.rstrip()) if unicodedata.category(c) != "Mn").lower() for t in texts]
    wrong = [(hex(points[r.i]), r.f, want[r.i]) for r in got if r.f != want[r.i]]
    assert not wrong, wrong[:20]
    assert one(spark, match.normalised(F.col("a"), F.col("b")), a="ΟΔΟΣ ﬁ Å", b="οδος fi a") is True


def test_flat_frontmatter_agrees_with_yaml(spark):
    yaml = pytest.importorskip("yaml")
    import random

    draw = random.Random(4)
    values = ["", " plain", " 'single'", ' "double"', " yes", " No", " null", " ~", " 12", " 1.5", " 2025-01-01", " a: b", " a #c", " 'it''s'", ' "a\\nb"', " [x, y]", " {a: b}", " - x", " |\n  block", " 中文", " '中文：☃'", ' "tab\there"', " e5", " a b  c ", " O'Brien", " \"\"", " ''", " A & B (NZ)", " .5", " truely", " on", " &x y", " *x", " !t x", " 'open", " x\n  y", " 0x1f", " 1:30", " a-b_c.d/e", " 'a' b"]
    keys = ["doc_type", "name_latin", "a-b", "yes", "k1", "_x", "doc type", "1k", "no", "Null", "K"]
    heads = ["\n" + "".join(f"{draw.choice(keys)}:{draw.choice(values)}\n" for _ in range(draw.randrange(0, 4))) + draw.choice(["", "", "\n", "# c\n", "  \n"]) for _ in range(3_000)]
    heads += ["\nk: v\nk: w\n", "\na: b", " \na: b\n", "\r\na: b\r\n"]
    got = records.parse(spark.createDataFrame(list(enumerate("---" + h + "---\nbody" for h in heads)), "i int, md string")).collect()
    n = 0
    for r in got:
        head, fields, lists, error = heads[r.i], {}, {}, ""
        if "---" in head:
            continue
        try:
            data = yaml.safe_load(head) or {}
            if not isinstance(data, dict):
                error = "no mapping"
            else:
                for k, v in data.items():
                    if v is None or isinstance(v, str):
                        fields[str(k)] = v
                    elif isinstance(v, list):
                        lists[str(k)] = [x if isinstance(x, str) else str(x) for x in v]
                    else:
                        error = error or f"{k}: no text"
        except yaml.YAMLError:
            error = "no yaml"
        assert (r.fields, r.lists, r.error) == (fields, lists, error), head
        n += 1
    assert n > 3_000 - 50
    plain = spark.createDataFrame([(h,) for h in heads], "h string").where(records.flat(F.col("h")))
    assert 50 < plain.count() < 2_500  # most of these heads are odd on purpose


def test_plain_records_are_flat(spark):
    rows = [(i, f"---\ndoc_type: PaymentReceipt\nname_latin: \"A B {i}\"\nreceipt_reference: '{i}'\n---\n\nbody") for i in range(50)]
    df = spark.createDataFrame(rows, "k int, md string")
    assert df.where(records.flat(records.split_anywhere(F.col("md"))[1])).count() == 50
    assert {r.fields["receipt_reference"] for r in records.parse(df).collect()} == {str(i) for i in range(50)}


ODD = ["", "Customer#000000007", "a #c", "a#c ", "15", "015", "-12", "+0", "1_000", "12.50", "-.5", "1e3", "1.5e+3", "0.1.0", "1.2.3.4", "2026-03-01", "2026-03-01T10:20:00Z", "2026-3-1 1:20:00", "12:30", "yes", "No", "oN", "NULL", "nUll", "~", "null", "passport@1.0.0", "O'Brien", "'x", "x'", '"q"', "a: b", "a:b", ":a", "- a", "-", "-a", "?", "? a", "[x]", "{x}", "x, y; z", "孙嘉蔚", "孙 #1", "é", "☃ x", "tab\there", "two\nlines", " lead", "trail ", "%a", "@a", "`a", "!a", "&a", "*a", "=", "<<", "a=b", "long " * 30, "x" * 100, "word " * 13 + "end", "---", "...", "\ufeffx", "0x1f", "0o17", "null #"]


def test_rendering_agrees_with_yaml(spark):
    """Each odd text in each of three places, as the YAML writer writes it, and read back."""
    yaml = pytest.importorskip("yaml")
    rows = [tuple(v if i == at else "Plain text" for i in range(3)) for v in ODD for at in range(3)]
    frame = spark.createDataFrame(rows, "name_latin string, tin string, holder_name string")
    closed = frame.select(*schemas.closed({"doc_type": F.lit("TaxResidency"), **{c: F.col(c) for c in frame.columns}}, "TaxResidency"))
    got = records.render(closed, "TaxResidency").collect()
    for r in got:
        record = {k: v for k, v in r.asDict().items() if k != "md"}
        assert r["md"] == "---\n" + yaml.safe_dump(record, allow_unicode=True, sort_keys=False) + "---\n\n"
    maps = [({"a": v, "b-c": "x", "n": None},) for v in ODD] + [({"yes": "x"},), ({"1k": "x"},), ({"a b": "x"},), ({},), (None,)]
    drawn = records.with_yaml(spark.createDataFrame(maps, "m map<string,string>"), F.col("m"), "y").collect()
    assert len(drawn) == len(maps)
    for r in drawn:
        assert r.y == (None if r.m is None else yaml.safe_dump(r.m, allow_unicode=True, sort_keys=False)), r.m
    values = spark.createDataFrame([(f"\nk: {yaml.safe_dump(v, allow_unicode=True).removesuffix(chr(10) + '...' + chr(10)).strip()}\nz: null\n",) for v in ODD if v.strip() == v and len(v) < 60 and chr(10) not in v], "h string")
    for r in records.with_head(values, F.col("h")).collect():
        assert r._error == "" and r._fields == yaml.safe_load(r.h), r.h


def test_common_records_need_no_yaml_code(spark):
    """Records of numbers, versions, dates, names with signs and of Chinese letters are written and read without the YAML library."""
    texts = ["Customer#000000007", "15", "-12.50", "0.1.0", "2026-03-01T10:20:00Z", "2026-03-01", "passport@1.0.0", "孙嘉蔚", "O'Brien, J", "yes", ""]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k int, name_latin string")
    closed = rows.select("k", *schemas.closed({"doc_type": F.lit("Visa"), "name_latin": F.col("name_latin")}, "Visa"))
    fields = F.map_from_arrays(F.array(F.lit("name_latin")), F.array("name_latin"))
    lines = closed.select("k", F.transform(F.map_entries(fields), records._line).alias("lines"))
    assert lines.where(~records._whole(F.col("lines"))).count() == 0
    heads = records.render(closed, "Visa").select(records.split_anywhere(F.col("md"))[1].alias("h"))
    assert heads.where(records.flat(F.col("h"))).count() == len(texts)
