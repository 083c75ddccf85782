"""Field matchers."""

from __future__ import annotations

import unicodedata
from functools import cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import WHITE, collapse_stars


def exact(a: Column, b: Column) -> Column:
    return a == b


def _bare(text: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", text) if unicodedata.category(c) != "Mn")


@cache
def decomposed() -> tuple[str, str, str]:
    """Characters that decompose to one character or to marks alone, what they become (the marks come last and have nothing), and a pattern of all that become more.

    Sigma is among the latter, as its small form depends on its place.
    """
    single, becomes, marks, ranges = [], [], [], []
    for p in [*range(0x80, 0xD800), *range(0xE000, 0x32000), *range(0xE0100, 0xE01F0)]:
        c = chr(p)
        d = _bare(c)
        if len(d) > 1 or "Σ" in d:
            if ranges and ranges[-1][1] == p - 1:
                ranges[-1][1] = p
            else:
                ranges.append([p, p])
        elif d == "":
            marks.append(c)
        elif d != c:
            single.append(c)
            becomes.append(d)
    return "".join(single + marks), "".join(becomes), "[" + "".join(rf"\\x{{{a:X}}}-\\x{{{b:X}}}".replace("\\\\", "\\") for a, b in ranges) + "]"


@F.pandas_udf(T.StringType())
def _folded_apart(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else _bare(t.rstrip()).lower())


def folded(c: Column) -> Column:
    """Trailing white space, case and marks removed, compatibility forms replaced. Only texts with a character that becomes several go to Python, Arrow-batched."""
    before, after, several = decomposed()
    apart = _folded_apart(F.when(c.rlike(several), c))
    return F.when(c.rlike(several), apart).otherwise(F.lower(F.translate(F.rtrim(c, F.lit(WHITE)), before, after)))


def normalised(a: Column, b: Column) -> Column:
    return folded(a) == folded(b)


def with_jurisdiction(a: Column, b: Column, jurisdiction: Column) -> Column:
    """Masks of any length are alike in CN; everything else is exact."""
    return F.when(jurisdiction == "CN", collapse_stars(a) == collapse_stars(b)).otherwise(a == b)
