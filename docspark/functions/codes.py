"""Codes: countries, currencies, identity numbers, machine-readable zones, models and tiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

#: Substrings that name a country, in order of test, and its code.
COUNTRIES = [("CHN", ["CHN", "CHINA", "CHINESE"]), ("NZL", ["NZL", "NEW ZEALAND", "KIWI"]), ("HKG", ["HKG", "HONG KONG"]), ("USA", ["USA", "UNITED STATES"]), ("GBR", ["GBR", "UNITED KINGDOM", "BRITISH"]), ("AUS", ["AUS", "AUSTRALIA"])]
#: Three-letter to two-letter codes.
ALPHA2 = {"CHN": "CN", "NZL": "NZ", "HKG": "HK", "USA": "US", "GBR": "GB", "AUS": "AU"}
#: Currency signs, and what a dollar sign means by jurisdiction.
SIGNS = {"¥": "CNY", "￥": "CNY", "£": "GBP", "€": "EUR"}
DOLLARS = {"NZ": "NZD", "AU": "AUD", "US": "USD", "HK": "HKD", "SG": "SGD"}
#: Substrings of model ids that name a tier, and the tier above.
TIERS = {"anthropic": ["haiku", "sonnet"], "openai": ["gpt-4o", "gpt-4o-mini"]}
ABOVE = {"anthropic-haiku": "anthropic-sonnet", "openai-gpt-4o-mini": "openai-gpt-4o"}
#: Weights of the check digit of an 18-character identity number, and its signs.
CN_WEIGHTS, CN_SIGNS = [7, 9, 10, 5, 8, 4, 2, 1, 6, 3, 7, 9, 10, 5, 8, 4, 2], "10X98765432"


def _lookup(table: dict[str, str], key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), key)


def country3(c: Column) -> Column:
    v = strip(F.upper(F.coalesce(c, F.lit(""))))
    out = F.when(v == "", "")
    for code, names in COUNTRIES:
        test = F.lit(False)
        for name in names:
            test = test | F.contains(v, F.lit(name))
        out = out.when(test | (v == "NZ") if code == "NZL" else test, code)
    return out.otherwise(v)


def country2(c: Column) -> Column:
    code = country3(c)
    return F.coalesce(_lookup(ALPHA2, code), F.when(F.length(code) == 2, code), F.lit("OTHER"))


def currency(c: Column, jurisdiction: Column) -> Column:
    s = strip(c)
    return F.coalesce(_lookup(SIGNS, s), F.when(s == "$", F.coalesce(_lookup(DOLLARS, jurisdiction), F.lit("USD"))), F.upper(s))


def mrz_fields(line: Column) -> dict[str, Column]:
    """Fields of the second line of a passport's zone."""
    cut = lambda a, n: F.replace(F.substring(line, a, n), F.lit("<"), F.lit(""))
    return {"number": cut(1, 9), "nationality": cut(11, 3), "dob": cut(14, 6), "sex": cut(21, 1), "expiry": cut(22, 6)}


def cn_id_fields(number: Column) -> dict[str, Column]:
    """Date of birth, sex and whether the check digit of an 18-character number holds."""
    digit = lambda i: F.try_to_number(F.substring(number, i, 1), F.lit("9")).cast("int")
    total = sum((digit(i + 1) * w for i, w in enumerate(CN_WEIGHTS)), F.lit(0))
    sign = F.substring(F.lit(CN_SIGNS), total % 11 + 1, F.lit(1))
    day = F.concat_ws("-", F.substring(number, 7, 4), F.substring(number, 11, 2), F.substring(number, 13, 2))
    return {"dob": day, "sex": F.when(digit(17) % 2 == 1, "M").otherwise("F"), "check_ok": sign == F.upper(F.substring(number, 18, 1))}


def id_shape(c: Column) -> Column:
    """CN, HK, SG or TW by the shape of an identity number, else ''."""
    return F.when(c.rlike(r"^\d{17}[\dX]$"), "CN").when(c.rlike(r"^[A-Z]{1,2}\d{6}\([0-9A]\)$"), "HK").when(c.rlike(r"^[STFGM]\d{7}[A-Z]$"), "SG").when(c.rlike(r"^[A-Z][12]\d{8}$"), "TW").otherwise("")


def tin_shape(c: Column) -> Column:
    """Which jurisdiction's tax number a text looks like, else ''. The text itself is never changed."""
    return F.when(c.rlike(r"^\d{3}-\d{2}-\d{4}$"), "US").when(c.rlike(r"^\d{2,3}-\d{3}-\d{3}$"), "NZ").when(c.rlike(r"^\d{17}[\dX]$"), "CN").when(c.rlike(r"^\d{10}$"), "GB").otherwise("")


def entries(c: Column) -> Column:
    s = F.upper(strip(c))
    return F.when(s.isin("00M", "MULT", "MULTIPLE", "M"), "multiple").otherwise(strip(c))


def licence_class(c: Column, jurisdiction: Column) -> Column:
    return F.when((jurisdiction == "NZ") & ~F.lower(c).startswith("class "), F.concat(F.lit("Class "), c)).otherwise(c)


def outcome(c: Column) -> Column:
    low = F.lower(strip(c))
    return F.when(low.rlike("partial|incomplete"), "partial").when(low.rlike("fail|reject|mismatch|not verified"), "failed").when(low.rlike("verified|pass|success|match"), "verified").otherwise("")


def relationship(c: Column) -> Column:
    low = F.lower(strip(c))
    return F.when(low.rlike("self|own"), "self").when(low.rlike("family|spouse|child|parent"), "family").when(low.rlike("associate|partner"), "close_associate").otherwise("")


def boxes(yes: Column, no: Column) -> Column:
    """yes, no or unknown from two tick boxes; both ticked is unknown."""
    return F.when(yes & ~no, "yes").when(no & ~yes, "no").otherwise("unknown")


def tier(provider: Column, model: Column) -> Column:
    out = None
    for name, words in TIERS.items():
        for word in sorted(words, key=len, reverse=True):
            test = (provider == name) & F.contains(model, F.lit(word))
            out = F.when(test, f"{name}-{word}") if out is None else out.when(test, f"{name}-{word}")
    return out.otherwise(F.concat(provider, F.lit("-"), model))


def split_tier(c: Column) -> tuple[Column, Column]:
    """Provider and model of a tier; a tier without both gives '' and itself."""
    at = F.locate("-", c)
    whole = (at > 0) & (at < F.length(c))
    return F.when(whole, F.substring(c, F.lit(1), at - 1)).otherwise(""), F.when(whole, F.substring(c, at + 1, F.length(c))).otherwise(c)


def escalated(c: Column) -> Column:
    return _lookup(ABOVE, c)


def backoff(base: Column, attempt: Column, jitter: Column) -> Column:
    """Seconds before another try; jitter lies between 0 and 1."""
    return base * F.pow(F.lit(2.0), attempt) + jitter * base
