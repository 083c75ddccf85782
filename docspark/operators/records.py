"""Frontmatter records: three fence rules, parsing and rendering.

Most frontmatter is flat: lines of `name: text`, the text quoted or beginning with a letter.
Such heads are read and rendered by expressions. YAML has more quoting and typing rules than
built-in functions follow, so other heads and records are Arrow-batched functions; fences,
schemas and everything after are expressions.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas

PARSED = T.StructType([T.StructField("fields", T.MapType(T.StringType(), T.StringType())), T.StructField("lists", T.MapType(T.StringType(), T.ArrayType(T.StringType()))), T.StructField("error", T.StringType())])


def split_anywhere(md: Column) -> tuple[Column, Column, Column]:
    """Text before the first two `---`, between and after them; null where there are fewer or the first part is not blank."""
    parts = F.split(md, "---", 3)
    ok = (F.size(parts) == 3) & (F.regexp_replace(F.get(parts, F.lit(0)), r"(?U)\s+", "") == "")
    return F.when(ok, F.get(parts, F.lit(0))), F.when(ok, F.get(parts, F.lit(1))), F.when(ok, F.get(parts, F.lit(2)))


def split_lines(md: Column) -> tuple[Column, Column]:
    """Frontmatter and body: the text starts with a `---` line, the next line that starts with `---` closes; the body keeps its bytes."""
    at = F.locate("\n---\n", md, 4)
    ok = md.startswith("---\n") & (at > 0)
    return F.when(ok, F.substring(md, F.lit(5), at - 4)), F.when(ok, F.substring(md, at + 5, F.length(md)))


def split_prompt(md: Column) -> tuple[Column, Column]:
    """Frontmatter and body between lines that strip to `---`; the body loses its leading line feeds."""
    whole = r"(?sU)\A[ \t]*---\s*?\n(.*?)(?:^|\n)[ \t]*---[ \t]*(?:\n|\z)(.*)\z"
    ok = md.rlike(whole)
    return F.when(ok, F.regexp_extract(md, whole, 1)), F.when(ok, F.regexp_replace(F.regexp_extract(md, whole, 2), "^\n+", ""))


@F.pandas_udf(PARSED)
def parse_yaml(texts: pd.Series) -> pd.DataFrame:
    """String fields and string lists of a YAML mapping. Other scalars are errors: the types hold text alone."""
    import yaml

    rows = []
    for text in texts:
        fields, lists, error = {}, {}, ""
        try:
            data = yaml.safe_load(text) if text is not None else None
            data = {} if data is None else data
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
        rows.append((fields, lists, error))
    return pd.DataFrame(rows, columns=["fields", "lists", "error"])


@F.pandas_udf(T.StringType())
def render_yaml(records: pd.DataFrame) -> pd.Series:
    """A record as YAML in declaration order; null where `needed` is false."""
    import yaml

    def plain(v):
        if v is None or isinstance(v, (str, dict)):
            return v
        return [dict(x) if isinstance(x, dict) else x for x in v]

    def one(row):
        return yaml.safe_dump({k: plain(v) for k, v in row.items() if k != "needed"}, allow_unicode=True, sort_keys=False) if row["needed"] else None

    return pd.Series([one(r) for r in records.to_dict("records")], dtype="object")


@F.pandas_udf(T.StringType())
def render_map(maps: pd.Series) -> pd.Series:
    """YAML of a string map, in its order."""
    import yaml

    return maps.map(lambda m: None if m is None else yaml.safe_dump(dict(m), allow_unicode=True, sort_keys=False))


#: Words that YAML 1.1 reads as booleans or as nothing.
TYPED = ["yes", "no", "true", "false", "on", "off", "null"]
_TEXT = r"\x20-\x7E\xA0-\u2027\u202A-\uD7FF\uE000-\uFEFE\uFF00-\uFFFD"
_LETTER = r"A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u3400-\u9FFF"
_MARKS = r"./()&+@,;'#-"
#: A text that YAML reads and writes as it stands: it begins with a letter, or is a number of three parts.
_PLAIN = rf"(?:(?![^\n]* #)[{_LETTER}](?:[\w{_LETTER} {_MARKS}]*[\w{_LETTER}{_MARKS}])?|[0-9]+\.[0-9]+\.[0-9]+)"
#: A line of a flat mapping: a name, and nothing, a quoted text without quotes or escapes inside, or a plain one.
_LINE = rf"(?!(?i:{'|'.join(TYPED)}):)[A-Za-z_][\w-]*:(?: +(?:null(?=\n|$)|\"[{_TEXT}&&[^\"\\]]*\"|'[{_TEXT}&&[^']]*'|(?!(?i:{'|'.join(TYPED)})(?:\n|$)){_PLAIN}))?"
FLAT = rf"^\n*(?:{_LINE}\n+)+$"
#: Texts that YAML writes as they stand, and those that it quotes because they read as another type.
WRITTEN = rf"^(?!(?i:{'|'.join(TYPED)})$){_PLAIN}\z"
QUOTED = rf"^(?:[-+]?(?:0|[1-9][0-9]*|[0-9]+\.[0-9]*)|[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}(?:T[0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}Z)?|{'|'.join(f for w in TYPED for f in (w, w.capitalize(), w.upper()))})\z"
NAME = rf"^(?!(?i:{'|'.join(TYPED)})$)[A-Za-z_][\w-]*\z"
WIDTH = 80


def flat(head: Column) -> Column:
    """Whether a head is a flat mapping with each name once, which fields_of() reads."""
    names = F.transform(_lines(head), lambda x: F.substring_index(x, ":", 1))
    return head.rlike(FLAT) & (F.size(F.array_distinct(names)) == F.size(names))


def _lines(head: Column) -> Column:
    return F.filter(F.split(head, "\n"), lambda x: x != "")


def fields_of(head: Column) -> Column:
    """The map of a flat head; null for a name without a value."""
    def read(line: Column) -> Column:
        value = F.ltrim(F.substring(line, F.locate(":", line) + 1, F.length(line)))
        quoted = F.left(value, F.lit(1)).isin("\"", "'")
        return F.struct(F.substring_index(line, ":", 1).alias("key"), F.when(quoted, F.substring(value, F.lit(2), F.length(value) - 2)).when(~value.isin("", "null"), value).alias("value"))

    return F.map_from_entries(F.transform(_lines(head), read))


def with_head(df: DataFrame, head: Column) -> DataFrame:
    """df with `_head`, a frontmatter text, and what it says: `_fields`, `_lists` and `_error`. Only heads that are no flat mapping go to the YAML reader."""
    once = df.select("*", F.explode(F.array(F.struct(head.alias("head"), flat(head).alias("flat")))).alias("_h"))
    simple = F.coalesce(F.col("_h.flat"), F.lit(False))
    read = once.withColumn("_y", parse_yaml(F.when(~simple, F.col("_h.head"))))
    fields, none = F.when(simple, fields_of(F.col("_h.head"))).otherwise(F.col("_y.fields")), F.create_map().cast("map<string,array<string>>")
    return read.select(*df.columns, F.col("_h.head").alias("_head"), fields.alias("_fields"), F.when(simple, none).otherwise(F.col("_y.lists")).alias("_lists"), F.when(simple, "").otherwise(F.col("_y.error")).alias("_error"))


def parse(df: DataFrame, md: str = "md") -> DataFrame:
    """df with fields, lists, doc_type and error ('' if none) of its frontmatter."""
    read = with_head(df, split_anywhere(F.col(md))[1])
    error = F.when(F.col("_head").isNull(), "no frontmatter").otherwise(F.col("_error"))
    return read.select(*[c for c in df.columns if c != "error"], F.col("_fields").alias("fields"), F.col("_lists").alias("lists"), F.try_element_at("_fields", F.lit("doc_type")).alias("doc_type"), error.alias("error"))


def typed(parsed: DataFrame, doc_type: str, keep: list[str]) -> DataFrame:
    """Closed records of one type; `error` names fields the type does not have."""
    rows = parsed.where(F.col("doc_type") == doc_type)
    extra = F.concat(schemas.unknown_fields(F.col("fields"), doc_type), schemas.unknown_fields(F.col("lists"), doc_type))
    columns = {f.name: F.try_element_at(F.col("fields" if f.dataType.typeName() == "string" else "lists"), F.lit(f.name)) for f in schemas.schema(doc_type) if not f.name.startswith("ultimate")}
    return rows.select(*keep, *schemas.closed(columns, doc_type), F.when(F.size(extra) > 0, F.concat(F.lit("unknown: "), F.array_join(F.array_sort(extra), ", "))).otherwise(F.col("error")).alias("error"))


def _line(entry: Column) -> Column:
    """`name: text` as YAML writes it for an entry (key, value); null where only YAML's own writer knows how: escapes, folded lines, other signs."""
    name, value = entry["key"], entry["value"]
    short = ~F.contains(value, F.lit(" ")) | (F.length(name) + F.length(value) + 4 <= WIDTH)
    text = F.when(value.isNull(), "null").when(value == "", "''").when(value.rlike(WRITTEN) & short, value).when(value.rlike(QUOTED), F.concat(F.lit("'"), value, F.lit("'")))
    return F.when(name.rlike(NAME), F.concat(name, F.lit(": "), text, F.lit("\n")))


def _whole(lines: Column) -> Column:
    """Whether each line could be written."""
    return (F.size(lines) > 0) & ~F.exists(lines, lambda x: x.isNull())


def with_yaml(df: DataFrame, fields: Column, name: str) -> DataFrame:
    """df with the YAML of a string map, in its order. Only maps with texts that need more than quotes go to the YAML writer."""
    lines = df.select("*", F.explode(F.array(F.struct(fields.alias("map"), F.transform(F.map_entries(fields), _line).alias("lines")))).alias("_w"))
    whole = F.coalesce(_whole(F.col("_w.lines")), F.lit(False))
    return lines.withColumn("_y", render_map(F.when(~whole, F.col("_w.map")))).select(*[c for c in df.columns if c != name], F.when(whole, F.array_join("_w.lines", "")).otherwise(F.col("_y")).alias(name))


def render(df: DataFrame, doc_type: str, name: str = "md") -> DataFrame:
    """df with the record as `---`, YAML in declaration order, `---` and an empty line. Only records with lists, or texts that need more than quotes, go to the YAML writer."""
    fields = [(f.name, f.dataType.typeName() == "string") for f in schemas.schema(doc_type)]
    entries = F.transform(F.array(*[F.struct(F.lit(n).alias("key"), F.col(n).alias("value")) for n, text in fields if text]), _line)
    rest = [F.when(F.col(n).isNull(), F.lit(f"{n}: null\n")) for n, text in fields if not text]
    place = {n: i for i, n in enumerate([n for n, text in fields if text] + [n for n, text in fields if not text])}
    lines = F.concat(entries, F.array(*rest).cast("array<string>"))
    made = df.select("*", F.explode(F.array(lines)).alias("_w"))
    needed = ~_whole(F.col("_w"))
    made = made.withColumn("_y", render_yaml(F.struct(needed.alias("needed"), *[F.when(needed, F.col(n)).alias(n) for n, _ in fields])))
    yaml = F.when(needed, F.col("_y")).otherwise(F.concat(*[F.get("_w", F.lit(place[n])) for n, _ in fields]))
    return made.select(*[c for c in df.columns if c != name], F.concat(F.lit("---\n"), yaml, F.lit("---\n\n")).alias(name))
