"""Receipt parsers: labelled (CN) and narrative (NZ) bodies, fallback between them, repair in place."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import long_day
from ..functions.text import WHITE, clean_account, clean_name, normalise_amount, strip, strip_quotes

#: Receipt fields, the labels that introduce them, and whether brackets around a value go (name) or it stays as printed (account).
LABELS = {
    "receipt_amount": ("account", ["金额", "付款金额"]),
    "receipt_currency": ("name", ["币种", "货币", "币别"]),
    "receipt_time": ("account", ["时间", "交易时间", "付款时间"]),
    "receipt_debit_account_name": ("name", ["付款人", "付款户名", "付款方", "付款人姓名", "汇款人", "汇款方"]),
    "receipt_debit_account_number": ("account", ["付款卡号", "付款账号", "付款账户", "付款账户号码"]),
    "receipt_debit_bank_name": ("name", ["付款行", "付款银行", "付款方银行", "付款方开户行"]),
    "receipt_credit_account_name": ("name", ["收款人", "收款户名", "收款方", "收款人姓名"]),
    "receipt_credit_account_number": ("account", ["收款卡号", "收款账号", "收款账户", "收款账户号码"]),
    "receipt_credit_bank_name": ("name", ["收款行", "收款银行", "收款方银行", "收款方开户行"]),
    "receipt_reference": ("name", ["用途", "备注", "汇款附言"]),
    "receipt_payment_app": ("name", ["付款工具", "付款渠道"]),
}
FIELDS = list(LABELS)
CURRENCIES = ["NZD", "USD", "AUD", "GBP", "EUR"]


#: One `label: value` pair: a run of Chinese characters at a line start or after white space, an asterisk or an opening bracket, a colon of either width, and the next text in sight up to its line's end, which is only looked at so that one line can hold several pairs. What stands before the run is looked at last, as most characters begin none.
PAIR = r"(?Udm)(?=[一-鿿])(?<=^|[\s*(\[（])([一-鿿]+)[\s*]*[:：](?=\s*([^\n]+))"


def pairs(body: Column) -> Column:
    """All label and value pairs of a labelled body, in order, as two arrays: the place in FIELDS of the field that a label introduces (null: none), and the value. Null where the body has no colon and so no pair."""
    place = F.create_map(*[F.lit(x) for i, n in enumerate(FIELDS) for label in LABELS[n][1] for x in (label, i)])
    found = F.struct(
        F.transform(F.regexp_extract_all(body, F.lit(PAIR), 1), lambda label: F.try_element_at(place, label)).alias("field"),
        F.regexp_extract_all(body, F.lit(PAIR), 2).alias("value"),
    )
    return F.when(F.contains(body, F.lit(":")) | F.contains(body, F.lit("：")), found)


def once(df: DataFrame, **made: Column) -> DataFrame:
    """df with columns that are computed once a row: exploding one element keeps the optimizer from computing them anew for each use."""
    for name, value in made.items():
        df = df.select("*", F.explode(F.array(value)).alias(name))
    return df


def cn_receipt(found: Column) -> dict[str, Column]:
    """The eleven receipt fields of pairs(); '' where a label is missing. The first of a field's labels in the text wins."""
    out = {}
    for i, (name, (kind, _)) in enumerate(LABELS.items()):
        value = F.get(found["value"], F.array_position(found["field"], i) - 1)
        out[name] = F.coalesce(strip(clean_name(value) if kind == "name" else clean_account(value)), F.lit(""))
    return out


DIGITS = "0123456789"


def _cut(c: Column, pattern: str) -> Column:
    """c cut at each match of a pattern. split() compiles its pattern anew for each text, so matches become one sign first, where the text doesn't hold it."""
    return F.when(F.contains(c, F.lit("\x01")), F.split(c, pattern)).otherwise(F.split(F.regexp_replace(c, pattern, "\x01"), "\x01"))


def at_words(body: Column, word: str) -> Column:
    """The body cut at each occurrence of a word and the white space after it. What stands before the word is looked at last, as most characters begin none."""
    return _cut(body, rf"(?U){word}(?<=\b{word})\s+")


def _words(c: Column, n: int) -> Column:
    """The first n words of a text that begins with one; further words are the last entry's."""
    return F.split(c, r"(?U)\s+", n + 1)


def _only(c: Column, letters: str) -> Column:
    """c has letters of this set and no others."""
    return (c != "") & (F.translate(c, letters, "") == "")


def _joins(c: Column) -> Column:
    """c begins with a letter, digit or underscore, so the word before goes on."""
    return c.rlike(r"^[\p{L}\p{N}_]")


def number_word(word: Column) -> Column:
    """Digits of the number that a word begins with, its two decimals kept and its commas dropped; '' if it begins with none.

    A number that runs on into letters ends at its last comma.
    """
    whole, cents = F.substring_index(word, ".", 1), F.substring_index(word, ".", -1)
    rest = F.translate(whole, DIGITS + ",", "")
    lead = F.when(rest == "", whole).otherwise(F.call_function("substring_index", whole, F.substring(rest, 1, 1), F.lit(1)))
    lead = F.when(_joins(rest), F.when(F.contains(lead, F.lit(",")), F.left(lead, F.length(lead) - F.length(F.substring_index(lead, ",", -1)))).otherwise("")).otherwise(lead)
    plain = normalise_amount(lead)
    after = F.substring(word, F.length(whole) + 2, F.length(word))
    pair = F.substring(after, 1, 2)
    decimals = (rest == "") & F.contains(word, F.lit(".")) & _only(pair, DIGITS) & (F.length(pair) == 2) & ~_joins(F.substring(after, 3, 1))
    return F.when(decimals & (plain != ""), F.concat(plain, F.lit("."), pair)).otherwise(plain)


def paid_tails(parts: Column) -> Column:
    """What follows each `of` (parts: the body cut there), where that is a known currency and a number that ends as a word does."""
    known = "|".join(CURRENCIES)
    return F.filter(parts, lambda t, i: (i > 0) & t.rlike(rf"(?U)^(?i:{known})\s+[0-9,]*[0-9](?:\W|$)"))


def at_numbers(body: Column) -> Column:
    """The body cut at the brackets that open an account number."""
    return _cut(body, r"(?iU)\(account\s+number\s+")


def accounts(parts: Column) -> Column:
    """(way, name, number) of each cut of at_numbers(): the number up to the closing bracket; before it in its line, after `from account` or `to account`, the name."""
    n = F.greatest(F.size(parts) - 1, F.lit(0))

    def read(before: Column, after: Column) -> Column:
        marked = F.regexp_replace(F.rtrim(before, F.lit(WHITE)), r"(?iU)(from|to)(?<=\b(?:from|to))\s+account\s+", "\x01$1\x02")
        return F.struct(F.split(F.substring_index(marked, "\n", -1), "\x01").alias("ways"), F.when(F.contains(after, F.lit(")")), F.substring_index(after, ")", 1)).alias("number"))

    def named(x: Column) -> Column:
        first, more = F.get(x["ways"], F.lit(1)), F.slice(x["ways"], 3, F.size(x["ways"]))
        name = F.substring_index(first, "\x02", -1)
        whole = F.when(F.size(x["ways"]) > 2, F.concat(name, F.replace(F.array_join(more, ""), F.lit("\x02"), F.lit(" account ")))).otherwise(name)
        return F.struct(F.lower(F.substring_index(first, "\x02", 1)).alias("way"), whole.alias("name"), x["number"].alias("number"))

    found = F.transform(F.zip_with(F.slice(parts, F.lit(1), n), F.slice(parts, F.lit(2), n), read), named)
    return F.filter(found, lambda x: x["way"].isNotNull() & _only(F.coalesce(x["number"], F.lit("")), DIGITS + "-"))


def first_day(parts: Column) -> Column:
    """[day, month, year] of the first words after an `on` (parts: the body cut there) that are a day, a weekday and its comma being left out."""
    def words(t: Column) -> Column:
        w = _words(t, 4)
        return F.slice(w, F.when(t.rlike(r"(?U)^[A-Za-z]+,(?:\s|\z)"), 2).otherwise(1), 3)

    def is_day(w: Column) -> Column:
        year = F.coalesce(F.get(w, F.lit(2)), F.lit(""))
        return (F.size(w) == 3) & _only(w[0], DIGITS) & (F.length(w[0]) <= 2) & w[1].rlike("^[A-Za-z]+$") & _only(F.left(year, F.lit(4)), DIGITS) & (F.length(year) >= 4) & ~_joins(F.substring(year, 5, 1))

    return F.get(F.filter(F.transform(F.filter(parts, lambda t, i: i > 0), words), is_day), F.lit(0))


def with_pieces(df: DataFrame, body: str) -> DataFrame:
    """df with `_nz_` columns: the first amount's words, the last account of each direction and the first day of a narrative body.

    Each step reads the one before more than once, so the optimizer keeps them apart and computes each once a row.
    """
    cut = df.select("*", at_words(F.col(body), "[oO][fF]").alias("_of"), at_numbers(F.col(body)).alias("_at"), at_words(F.col(body), "on").alias("_on"))
    read = cut.select(*df.columns, F.get(paid_tails(F.col("_of")), F.lit(0)).alias("_nz_paid"), accounts(F.col("_at")).alias("_accounts"), first_day(F.col("_on")).alias("_day"))
    paid, day = F.col("_nz_paid"), F.col("_day")
    last = lambda way: F.try_element_at(F.filter("_accounts", lambda x: x["way"] == way), F.lit(-1)).alias("_nz_" + way)
    number = F.regexp_extract(paid, r"(?U)^\S+\s+(\S+)", 1)
    return read.select(*df.columns, "_nz_paid", last("from"), last("to"), day.alias("_nz_day"), F.upper(F.left(paid, F.lit(3))).alias("_nz_currency"), number_word(number).alias("_nz_amount"), long_day(day[0], day[1], F.left(day[2], F.lit(4))).alias("_nz_time"))


def nz_receipt() -> dict[str, Column]:
    """Seven receipt fields from the columns of with_pieces, and `error`: '' or why the body is no such sentence."""
    paid, frm, to, day, currency, amount, time = (F.col("_nz_" + n) for n in ("paid", "from", "to", "day", "currency", "amount", "time"))
    error = F.when(paid.isNull(), "amount").when(frm.isNull() | to.isNull(), "accounts").when(day.isNull(), "date").when(time.isNull(), "calendar").otherwise("")
    return {
        "receipt_amount": amount, "receipt_currency": currency, "receipt_time": time,
        "receipt_debit_account_name": strip_quotes(frm["name"]), "receipt_debit_account_number": frm["number"],
        "receipt_credit_account_name": strip_quotes(to["name"]), "receipt_credit_account_number": to["number"], "error": error,
    }


def parse_cn(df: DataFrame, body: str = "body") -> DataFrame:
    return df.select("*", pairs(F.col(body)).alias("_pairs")).select(*df.columns, *[c.alias(n) for n, c in cn_receipt(F.col("_pairs")).items()])


def parse_nz(df: DataFrame, body: str = "body") -> DataFrame:
    """df with the narrative fields and `error`; fields are null where there is an error."""
    parsed = nz_receipt()
    ok = parsed["error"] == ""
    return with_pieces(df, body).select(*df.columns, *[(c if n == "error" else F.when(ok, c)).alias(n) for n, c in parsed.items()])


def any_filled(fields: list[Column]) -> Column:
    return reduce(or_, [F.coalesce(x, F.lit("")) != "" for x in fields])


def parse_either(df: DataFrame, body: str = "body") -> DataFrame:
    """df with the receipt fields and layout: cn if any label is found, else nz, else none (an error row with empty fields).

    Only bodies without a filled label are read as narratives.
    """
    labelled = df.select("*", pairs(F.col(body)).alias("_pairs")).select(*df.columns, *[c.alias("_cn_" + n) for n, c in cn_receipt(F.col("_pairs")).items()])
    filled = labelled.withColumn("_cn", any_filled([F.col("_cn_" + n) for n in FIELDS]))
    nz = nz_receipt()
    both = with_pieces(filled.withColumn("_story", F.when(~F.col("_cn"), F.col(body))), "_story")
    laid = both.withColumn("layout", F.when(F.col("_cn"), "cn").when(nz["error"] == "", "nz").otherwise("none"))
    pick = lambda n: F.when(F.col("layout") == "cn", F.col("_cn_" + n)).when(F.col("layout") == "nz", nz[n] if n in nz else F.lit("")).otherwise("")
    return laid.select(*df.columns, "layout", *[pick(n).alias(n) for n in FIELDS])


def merge_filled(df: DataFrame, fields: list[str], existing: str = "old_{}", parsed: str = "{}") -> DataFrame:
    """Parsed values win where they are filled; `changed` names, sorted, the fields that so get another value."""
    new, old = {f: F.coalesce(F.col(parsed.format(f)), F.lit("")) for f in fields}, {f: F.coalesce(F.col(existing.format(f)), F.lit("")) for f in fields}
    changed = F.array_sort(F.filter(F.array(*[F.when((new[f] != "") & (new[f] != old[f]), f) for f in fields]), lambda x: x.isNotNull()))
    return df.select("*", *[F.when(new[f] != "", new[f]).otherwise(old[f]).alias("merged_" + f) for f in fields], changed.alias("changed"))
