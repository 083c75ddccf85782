"""Language identification with string kernels.

The kernel of two texts counts the n-grams of 1 to 3 letters that both contain (a blended
spectrum of presences), divided by the root of the product of their own counts. Nystroem
landmarks, LANDMARKS of the learning texts dealt over the languages (one of each at least), turn it into features
K(x, L) K(L, L)^(-1/2); one-versus-rest kernel ridge regression with targets 0 and 1 is
solved on them. Because K(x, L) is a product of presence vectors, a batch of texts is scored
by sparse presence times a (gram, language) matrix that folds in landmarks, whitening and
ridge weights: batches of presence rows (text, gram) times that matrix, on the grams that the
batch has.

N-grams are hashes of small letters' full code points, so scripts and letters stay apart.

The classifier learns from SAMPLE different texts at most (dealt evenly over the languages,
MOST a language, those with the least hash; one text of each where there are more languages),
the documented bound of what reaches the driver. Every language is learnt. The rows it may
learn from have a non-null language and crc32(doc_id as text) mod 5 other than 0. Whole texts
are read both in learning and in prediction; id, source and language are never inputs of a
prediction. The score is the winner's regression value, cut to 0 to 1.

`und` with score 0 is returned for null texts, texts without a letter, and for all texts if
there is nothing to learn from. Ties go to the first language in alphabetical order. A null
id counts as held out false (its crc32 is null) but is not learnt from. Each input row gives
one output row. Other columns are ignored.
"""

from __future__ import annotations

import unicodedata
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import table, text_groups

SAMPLE, MOST, LANDMARKS, RIDGE = 2_000, 1_000, 256, 1e-3
CODE_BITS = 24
LAST_POINT = 0x323FF  # the last plane that holds letters
FACTORS = [np.uint32(x) for x in (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35)]
BATCH, PRODUCT = 64, 2_000_000  # texts, and numbers of the presence matrix, that are multiplied at a time
UND = "und"


@cache
def _points() -> tuple[np.ndarray, np.ndarray]:
    """For each code point its small letter (0 for what is neither letter nor mark), and whether it is a letter."""
    small, letter = np.zeros(LAST_POINT + 2, np.uint32), np.zeros(LAST_POINT + 2, bool)
    for cp in range(LAST_POINT + 1):
        kind = unicodedata.category(chr(cp))[0]
        if kind in "LM":
            small[cp] = ord(chr(cp).lower()[0])
            letter[cp] = kind == "L"
    return small, letter


def symbols(text: str) -> np.ndarray | None:
    """Small letters and marks of a text as code points, runs of other characters as one 0; None without a letter."""
    small, letter = _points()
    points = np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), LAST_POINT + 1)
    if not letter[points].any():
        return None
    out = small[points]
    keep = np.ones(len(out), bool)
    keep[1:] = (out[1:] != 0) | (out[:-1] != 0)
    return out[keep]


def _mixed(x: np.ndarray) -> np.ndarray:
    """CODE_BITS well-mixed bits of 32."""
    x = (x ^ (x >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    x = (x ^ (x >> np.uint32(12))) * np.uint32(0x297A2D39)
    return (x ^ (x >> np.uint32(15))) >> np.uint32(32 - CODE_BITS)


class Presence:
    """Different n-grams of a text as hashes of CODE_BITS bits, without sorting."""

    def __init__(self):
        self.stamp = np.zeros(1 << CODE_BITS, np.int32)

    def of(self, text: str | None) -> np.ndarray | None:
        s = symbols(text) if text else None
        if s is None:
            return None
        s = np.concatenate([[0], s, [0]]).astype(np.uint32) if s[0] or s[-1] else s
        parts = []
        with np.errstate(over="ignore"):
            code = np.zeros(len(s), np.uint32)
            for n, factor in enumerate(FACTORS):
                code = code[: len(s) - n] + (s[n:] + np.uint32(1)) * factor
                mixed = _mixed(code)
                at = np.arange(len(mixed), dtype=np.int32)
                self.stamp[mixed] = at
                parts.append(mixed[self.stamp[mixed] == at])
        return np.unique(np.concatenate(parts)).astype(np.int32)


def _grams(batches):
    seen = Presence()
    for batch in batches:
        got = [seen.of(t.as_py()) for t in batch.column(1)]
        ok = [i for i, g in enumerate(got) if g is not None]
        yield pa.record_batch([batch.column(0).take(pa.array(ok, pa.int64())), pa.array([got[i] for i in ok], pa.list_(pa.int32()))], names=["lang", "grams"])


def landmarks_of(langs: list[str], n: int = LANDMARKS) -> list[int]:
    """Numbers of the texts taken as landmarks: the languages' texts by turns, and each language's first one at least."""
    labels = sorted(set(langs))
    turn = {name: [i for i, x in enumerate(langs) if x == name] for name in labels}
    return [turn[name][k] for k in range(max(map(len, turn.values()))) for name in labels if k < len(turn[name])][: max(n, len(labels))]


def fit(langs: list[str], grams: list[np.ndarray], landmarks: int = LANDMARKS, ridge: float = RIDGE):
    """Labels, sorted gram codes and the (gram, label) matrix of the folded regression."""
    labels, chosen = sorted(set(langs)), landmarks_of(langs, landmarks)
    vocabulary = np.unique(np.concatenate([grams[i] for i in chosen]))

    def presence(which):
        out = np.zeros((len(which), len(vocabulary)), np.float32)
        for row, i in enumerate(which):
            at = np.minimum(np.searchsorted(vocabulary, grams[i]), len(vocabulary) - 1)
            out[row, at[vocabulary[at] == grams[i]]] = 1 / np.sqrt(len(grams[i]))
        return out

    marks = presence(chosen)
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    good = values > 1e-6 * values.max()
    whiten = vectors[:, good] / np.sqrt(values[good])
    features = np.concatenate([presence(range(k, min(k + 256, len(langs)))) @ marks.T for k in range(0, len(langs), 256)]).astype(np.float64) @ whiten
    targets = np.array([[float(x == name) for name in labels] for x in langs])
    weights = np.linalg.solve(features.T @ features + ridge * len(langs) * np.eye(features.shape[1]), features.T @ targets)
    return labels, vocabulary, (marks.T.astype(np.float64) @ (whiten @ weights)).astype(np.float32)


def scored(rows: list[np.ndarray], sizes: list[int], matrix: np.ndarray) -> np.ndarray:
    """Presence of a batch of texts times the matrix: rows are the matrix rows of each text's grams, sizes its numbers of grams."""
    used = np.zeros(len(matrix), bool)
    for r in rows:
        used[r] = True
    columns = np.cumsum(used) - 1
    presence = np.zeros((len(rows), int(used.sum())))
    for out, r, n in zip(presence, rows, sizes, strict=True):
        out[columns[r]] = 1 / np.sqrt(n)
    return presence @ matrix[used].astype(np.float64)


def _predict(shared):
    def run(batches):
        labels, vocabulary, matrix = shared.value
        seen = Presence()
        place = np.full(1 << CODE_BITS, -1, np.int32) if labels else None
        step = max(1, min(BATCH, PRODUCT // max(1, len(vocabulary)))) if labels else 1
        if labels:
            place[vocabulary] = np.arange(len(vocabulary), dtype=np.int32)
        for ids, held, texts in text_groups(batches, ["doc_id", "held_out", "text"]):
            grams = [seen.of(t) if labels else None for t in texts]
            lang, score = [UND] * len(texts), np.zeros(len(texts))
            ok = [i for i, g in enumerate(grams) if g is not None]
            if ok:
                rows = [place[grams[i]] for i in ok]
                rows, sizes = [r[r >= 0] for r in rows], [len(grams[i]) for i in ok]
                values = np.concatenate([scored(rows[k : k + step], sizes[k : k + step], matrix) for k in range(0, len(ok), step)])
                best = values.argmax(1)
                for i, b, v in zip(ok, best, values[np.arange(len(ok)), best], strict=True):
                    lang[i], score[i] = labels[b], min(1.0, max(0.0, v))
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(held, pa.bool_()), pa.array(lang, pa.string()), pa.array(score)], names=["doc_id", "held_out", "lang_pred", "score"])

    return run


def train(docs: DataFrame, sample: int = SAMPLE):
    """Fit on the learning texts of docs (lang, text); what reaches the driver is their n-grams.

    Those are, of each language, the texts with the least hashes: sample divided by the number
    of languages, one at least and MOST at most. Copies of a text are one text.
    """
    known = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text", F.xxhash64("text").alias("draw"))
    n = known.select("lang").distinct().count()
    if not n:
        return [], None, None
    each = min(MOST, max(1, sample // n))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))  # tasks keep `each` rows a language before the exchange
    last = known.select("lang", "draw").distinct().withColumn("place", place).where(F.col("place") <= each).groupBy("lang").agg(F.max("draw").alias("last"))
    drawn = known.join(F.broadcast(last), "lang").where("draw <= last")  # last: one row a language
    got = drawn.groupBy("lang", "draw").agg(F.first("text").alias("text")).select("lang", "text").mapInArrow(_grams, "lang string, grams array<int>").toArrow()
    order = sorted(zip(got["lang"].to_pylist(), (np.sort(x.values.to_numpy()) for x in got["grams"]), strict=True), key=lambda r: (r[0], len(r[1]), r[1].tobytes()))
    spread = np.random.default_rng(42).permutation(len(order))
    langs, grams = [order[i][0] for i in spread], [order[i][1] for i in spread]
    return fit(langs, grams) if langs else ([], None, None)


def identify(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, lang_pred, score for docs (doc_id, text, lang)."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"), held.alias("held_out"))
    shared = docs.sparkSession.sparkContext.broadcast(train(own.where("NOT held_out AND doc_id IS NOT NULL"), sample))
    return own.select("doc_id", "held_out", "text").mapInArrow(_predict(shared), "doc_id long, held_out boolean, lang_pred string, score double")


def op1_language_id(spark, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
