"""String functions of the record parsers.

Patterns carry (?U) so that white space and word characters are Unicode ones, and (?d) where
line ends matter, so that only a line feed ends a line.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


#: White space of Unicode.
SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
#: That, and the four separators that count as such in texts.
WHITE = SPACE + "\x1c\x1d\x1e\x1f"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITE))


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), with value computed once however often it is used."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def clean_name(c: Column) -> Column:
    """Without leading and trailing brackets, asterisks and white space."""
    return F.rtrim(F.ltrim(c, F.lit(SPACE + "*[(（")), F.lit(SPACE + "*])）"))


def clean_account(c: Column) -> Column:
    """Masks and inner spaces stay; trailing white space goes."""
    return F.rtrim(c, F.lit(SPACE))


def strip_quotes(c: Column) -> Column:
    quotes = "\"'“”‘’"
    return strip(F.regexp_replace(strip(c), f"^[{quotes}]+|[{quotes}]+\\z", ""))


def normalise_amount(c: Column) -> Column:
    return F.replace(c, F.lit(","), F.lit(""))


def cjk_part(name: Column) -> Column:
    return F.array_join(F.regexp_extract_all(name, F.lit("([一-鿿]+)"), 1), "")


def latin_part(name: Column) -> Column:
    """Parentheses dropped, commas and slashes as spaces, runs of white space as one."""
    spaced = F.regexp_replace(F.regexp_replace(strip(name), r"\([^)]*\)", ""), "[,/]", " ")
    return strip(F.regexp_replace(spaced, r"(?U)\s+", " "))


def surname_first(name: Column) -> Column:
    """`A<<B<C` of a machine-readable zone as `A, B C`."""
    parts = F.split(F.regexp_replace(name, "<+$", ""), "<<")
    given = F.replace(F.get(parts, F.lit(1)), F.lit("<"), F.lit(" "))
    return F.concat_ws(", ", F.replace(F.get(parts, F.lit(0)), F.lit("<"), F.lit(" ")), given)


def without_parentheses(c: Column) -> Column:
    return strip(F.regexp_replace(c, r"(?U)\s*\([^)]*\)", ""))


def normalise_sex(c: Column) -> Column:
    up = F.concat(F.lit(" "), F.upper(c))
    says = lambda word, letter, sign: F.contains(up, F.lit(word)) | F.contains(up, F.lit(" " + letter)) | F.contains(up, F.lit(sign))
    return F.when(F.coalesce(c, F.lit("")) == "", "").when(says("FEMALE", "F", "女"), "F").when(says("MALE", "M", "男"), "M").otherwise("")


def split_list(c: Column) -> Column:
    """Entries between semicolons, commas and the word `and`; null where the source is empty."""
    parts = F.filter(F.transform(F.split(c, r"(?U)[;,]|\band\b"), strip), lambda x: x != "")
    return F.when(F.coalesce(c, F.lit("")) != "", parts)


def is_pep(c: Column) -> Column:
    low = F.lower(c)
    has = lambda *ws: F.contains(low, F.lit(ws[0])) | F.contains(low, F.lit(ws[-1]))
    return F.when(has("yes", "true"), "yes").when(has("no", "not"), "no").otherwise("")


def none_to_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def collapse_stars(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)\*+(?:\s+\*+)*", "*")
