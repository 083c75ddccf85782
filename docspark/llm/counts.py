"""Token counts of whole texts, by batch encoding in an Arrow function that returns lengths only.

The text column alone goes to Python; one number a row comes back. Texts are encoded in
batches of about BATCH_BYTES, so that a batch of long texts holds as much as one of short
texts. A text longer than PART_CHARS is encoded in parts, cut only where the tokenizer's own
rule always ends one word and begins the next: before a space or line feed that follows a
visible character, and between a letter or digit and a sentence mark. The counts of the
parts then add up to that of the text. A stretch without such a place stays one part,
however long. Nothing is truncated, padded or capped, and no table or model grows with the
input.

A null text counts as empty and has no tokens; the mark of a special token inside a text is
that token, as is the library's default. Each input row gives one row, repeated rows and null
ids included; an empty table gives none. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table

VOCABULARY, LIMIT = "byte_bpe_50k.json", 1024
BATCH_BYTES, PART_CHARS = 256 << 10, 64 << 10

#: Letters of scripts whose blocks hold letters alone, digits, and marks that end a word in every version of Unicode. The signs of the special token's mark are not among the latter.
LETTERS = "A-Za-zÀ-ÖØ-öø-ɏА-яぁ-ゖァ-ヺ一-龥가-힣0-9"
MARKS = r".,!?;:)。，！？；：、）"
SAFE = re.compile(rf"(?<=[!-~{LETTERS}{MARKS}])(?=[ \n])|(?<=[{LETTERS}])(?=[{MARKS}])")


def parts(text: str, size: int = PART_CHARS) -> Iterator[str]:
    """The text in parts of at least `size` characters (the last may be shorter), cut at safe places only."""
    start = 0
    while len(text) - start > size:
        place = SAFE.search(text, start + size)
        if place is None:
            break
        yield text[start : place.start()]
        start = place.start()
    yield text[start:]


def batches(texts: pa.Array, most: int = BATCH_BYTES, size: int = PART_CHARS) -> Iterator[tuple[list[int], list[str]]]:
    """(row numbers, parts of texts), each of about `most` bytes or of one part that is larger."""
    rows, held, total = [], [], 0
    for row, n in enumerate(pc.binary_length(texts).fill_null(0).to_pylist()):
        if not n:
            continue
        text = texts[row].as_py()
        for part in parts(text, size) if n > size else (text,):
            own = len(part.encode()) if n > size else n
            if held and total + own > most:
                yield rows, held
                rows, held, total = [], [], 0
            rows.append(row)
            held.append(part)
            total += own
    if held:
        yield rows, held


def lengths(tokenizer, texts: pa.Array, most: int = BATCH_BYTES, size: int = PART_CHARS) -> list[int]:
    """Tokens of each text."""
    out = [0] * len(texts)
    for rows, held in batches(texts, most, size):
        for row, encoded in zip(rows, tokenizer.encode_batch_fast(held, add_special_tokens=False), strict=True):
            out[row] += len(encoded)
    return out


def counter(tokenizer_path: str):
    """Text column -> number of tokens; null for null."""

    @F.arrow_udf("long")
    def n_tokens(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(tokenizer_path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        for texts in arrays:
            yield pa.array(lengths(tokenizer, texts), pa.int64())

    return n_tokens


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit (more than `limit` tokens) for docs (doc_id, text)."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    counted = own.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), counter(tokenizer_path)("text").alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def op13_token_counts(spark, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), vocabulary())
