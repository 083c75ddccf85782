"""A training-corpus pipeline over `documents`: filter, dedup, cut, mix, pack.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and
read again as the next stage's docs. All but the last return the columns of documents; further
columns, whatever their names, are kept as they are. An empty table passes through empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docspark.llm import mixing, packing, phrases, quality, simhash
from docspark.llm.common import drop, settled, table

MIX_PERCENT = 90


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base counts or their language's perplexity bands reject go.

    Null and empty texts have no words and so go. Null languages form one group. Repeated
    rows share one fate.
    """
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays, the one with the smallest id (null ids last; then the least hash of the text).

    All texts without words are one group. Of rows alike in id and text one stays.
    """
    return simhash.keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 13 words and more that a document with a smaller id holds are cut out; documents left empty by that go.

    Null and shorter texts lose nothing. Rows of one id never cut each other. n_chars follows the new text.
    """
    out = phrases.remove_phrases(docs)
    return out.withColumn("n_chars", F.coalesce(F.length("text").cast(out.schema["n_chars"].dataType), "n_chars")) if "n_chars" in out.columns else out


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One seeded epoch of each leaf, up to its share of MIX_PERCENT of all tokens.

    Null languages and sources are leaves of their own; null texts have no tokens. Repeated
    rows are rows of their own that stay or go together.
    """
    return mixing.take(docs, share_percent=MIX_PERCENT)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each packed piece. Null and empty texts have the end id alone; repeated rows are packed each."""
    return packing.pack(docs, packing.vocabulary())


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: Perplexity models, fingerprints and tokens can't be written in SQL; tests compare with a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir. What a stage wrote goes when the next one has read it."""
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        done = settled(lambda now=docs, stage=stage: stage(spark, now, sf_dir))
        if before is not None:
            drop(before)
        docs = before = done
    return docs
