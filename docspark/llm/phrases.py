"""Substring dedup with repeated-phrase automata.

A window is 13 consecutive words `[^\\x20\\x09-\\x0D]+` of one document. Windows that occur in
two documents are confirmed on their words, compiled into Aho-Corasick automata (pyahocorasick),
one for each shard of anchor values, and the segments of all documents that can hold one are
streamed through the automaton of their shard, which gives every occurrence. Where all
segments of an anchor value are alike, the whole segment is the pattern. A word is removed
if a window over it also starts in a document with a smaller id, as the input stands. Words are
single characters in the automata: a shard numbers its own words, so a node is a word.

Segments of texts come from repeats.py, which states how hot passages are kept from one task.
Null texts have no words; empty texts and those of fewer than 13 words lose nothing. Rows with
a null id count as later than all others. Rows that share an id are one document: they never
remove each other's words. Other columns are kept as they are by `remove_phrases`.
"""

from __future__ import annotations

import hashlib
from itertools import groupby

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table, word_hashes
from .repeats import HOT, Kind, covered, with_places

WINDOW, GRAM = 13, 6


def split(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split() if text else []


def _word_values():
    def values(texts):
        words = [split(t) for t in texts]
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        units = np.concatenate([word_hashes(w) for w in words]) if words else np.empty(0, np.uint64)
        return units, lengths, lambda t, a, b: b" ".join(words[t][a:b])

    return values


class _Signs(dict):
    """word -> one character, numbered as met, without the surrogates."""

    def __missing__(self, word):
        n = len(self) + 1
        sign = self[word] = chr(n if n < 0xD800 else n + 0x800)
        return sign


def locate(rows) -> list[tuple[int, int, int]]:
    """(row, first window, windows) of windows that a smaller document has. rows: hash, doc, row, starts, windows, segment, by hash and doc."""
    signs = _Signs()
    automaton = ahocorasick.Automaton()
    streamed: list[tuple[int, dict]] = []  # row numbers and different segments of the anchor values that hold a repeat
    for _, group in groupby(range(len(rows)), lambda k: rows[k][0]):
        numbers = list(group)
        docs: dict[bytes, list[int]] = {}  # segment -> its smallest and largest document
        for k in numbers:
            docs.setdefault(rows[k][5], [rows[k][1], 0])[1] = rows[k][1]
        if rows[numbers[0]][1] == rows[numbers[-1]][1]:
            continue
        lines = {segment: "".join(map(signs.__getitem__, segment.split(b" "))) for segment in docs}
        if len(lines) == 1:  # the whole segment recurs
            (segment, line), = lines.items()
            automaton.add_word(line, (docs[segment][0], len(line)))
        else:
            spans: dict[str, list[int]] = {}
            for segment, line in lines.items():
                low, high = docs[segment]
                for i in range(len(line) - WINDOW + 1):
                    seen = spans.setdefault(line[i : i + WINDOW], [low, high])
                    if seen[1] < high:
                        seen[1] = high
            for window, (low, high) in spans.items():
                if low < high:
                    automaton.add_word(window, (low, WINDOW))
        streamed.append((numbers, lines))
    if not len(automaton):
        return []
    automaton.make_automaton()
    out = []
    for numbers, lines in streamed:
        found = {segment: [(end - n + 1, n - WINDOW + 1, owner) for end, (owner, n) in automaton.iter(line)] for segment, line in lines.items()}
        for k in numbers:
            begin = stop = 0
            for at, n, owner in found[rows[k][5]]:
                if owner < rows[k][1]:
                    if at > stop:
                        if stop > begin:
                            out.append((k, begin, stop - begin))
                        begin = at
                    stop = max(stop, at + n)
            if stop > begin:
                out.append((k, begin, stop - begin))
    return out


WORDS = Kind(WINDOW, GRAM, False, _word_values, locate, 6_000_000)


def _digest(batches):
    for batch in batches:
        rows = []
        for doc_id, text, places in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
            words = split(text.as_py())
            gone = covered(places, WINDOW, len(words))
            kept = [w for w, g in zip(words, gone.tolist(), strict=True) if not g] if places else words
            rows.append((doc_id, len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
        if rows:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)], names=["doc_id", "n_words", "n_removed", "kept_sha256"])


def _rewrite(batches):
    """The places are the last column, which goes."""
    for batch in batches:
        at = batch.schema.get_field_index("text")
        texts, keep = [], []
        for text, places in zip(batch.column(at), batch.columns[-1].to_pylist(), strict=True):
            text = text.as_py()
            if places:
                words = split(text)
                gone = covered(places, WINDOW, len(words)).tolist()
                text = b" ".join(w for w, g in zip(words, gone, strict=True) if not g).decode("utf-8", "surrogatepass")
            texts.append(text)
            keep.append(not places or text != "")
        columns = [pa.array(texts, pa.string()) if i == at else c for i, c in enumerate(batch.columns[:-1])]
        yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1]).filter(pa.array(keep, pa.bool_()))


def phrase_counts(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256: one row per row of docs (doc_id, text)."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return with_places(own, WORDS, hot)[0].mapInArrow(_digest, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def remove_phrases(docs: DataFrame) -> DataFrame:
    """docs with repeated passages cut out of text. A text that loses something has its words joined by one space; a row that loses all its words goes."""
    named, places = with_places(docs, WORDS)
    return named.select(*[F.col(f"`{c}`") for c in docs.columns], places).mapInArrow(_rewrite, docs.schema)


def op3_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return phrase_counts(table(spark, sf_dir, "documents"))


OP3_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, CAST(doc_id AS BIGINT) AS doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), starts AS (
  SELECT r, doc_id, w, unnest(range(1, len(w) - 11)) AS p FROM docs WHERE len(w) >= 13
), windows AS (
  SELECT r, coalesce(doc_id, 9223372036854775807) AS d, p, array_to_string(w[p:p + 12], ' ') AS k FROM starts
), later AS (
  SELECT r, p FROM (SELECT r, p, d, min(d) OVER (PARTITION BY k) AS first FROM windows) WHERE first < d
), gone AS (
  SELECT DISTINCT r, unnest(range(p, p + 13)) AS i FROM later
), words AS (
  SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM docs
), kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n FROM words ANTI JOIN gone USING (r, i) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256 FROM docs LEFT JOIN kept USING (r)
"""
