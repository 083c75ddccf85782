"""Quality rules: base counts of each text and bands of n-gram perplexity.

An interpolated modified Kneser-Ney model of 4-grams of code points is estimated for each
language. Texts are dealt into two folds by their hash, each fold has models of its own, and
a text is scored by those of the other fold: no text is judged by a model that learnt it
or a copy of it. Spark counts the 4-grams; lower orders, discounts and back-off weights are
joins and grouped sums, and nothing of a model passes through the driver. A model is stored
as sorted arrays of 64-bit hashes (of n-grams and of contexts) with their log probabilities
and back-off weights, cut into shards in the shared folder. Its size is that of the texts'
different n-grams. A task that scores texts loads the shards of their languages one by one.

A text's log perplexity is the median over its runs of about RUN characters, so a foreign quotation or
a key in a good text moves it little, while signs strewn over the whole text move it fully.
Each language gets its own lower and upper bands of perplexity, a character (log_ppl) and a
word (word_log_ppl), from quartiles over all its documents: a document is rejected where one
of its log perplexities lies further than `reach` interquartile ranges outside the middle half. Short texts vary more, so the range
is the one measured at the document's length: squared ranges of all documents of a language,
by powers of two in length, are fitted by alpha + beta / characters (weighted by documents times
length, as a range's error shrinks with both). Every language has
models and bands of its own, however many there are; null languages form one group.

Null and empty texts have no words: all counts are 0, base_failed is true. Repeated rows are
scored alike; a language whose texts all fall into one fold has no model to judge them, so all
of them get the perplexity of even odds, and their bands keep them. Every input row gives one
output row, repeated ids included; other columns are ignored by assess() and kept as they
are by keep_good(), whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE, cut, drop, fresh, rolling, table, text_groups, word_hashes

ORDER = 4
CONTEXT, UNMET = 8, 15  # CONTEXT added to its length marks the hash of a context, UNMET that of the sign a model has not met
POINT, START = 21, 0x110000  # bits of a code point, and the sign before a text
RUN = 64  # characters
SHARD_ROWS, HELD_BYTES, GROUP = 1_000_000, 48_000_000, 1_000_000  # GROUP: characters taken at a time
SYMBOLS = "#*$%&|<>"
METRICS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean"
REACH = 2.0


def base_counts(text: str | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    if not text:
        return 0, 0, 0, 0, 0, True
    words = text.encode("utf-8", "surrogatepass").split()
    n = len(words)
    lines = [line for line in text.split("\n") if line.strip(WHITE)]
    repeated = 0
    if n >= 9:
        windows = rolling(word_hashes(words), 8)
        order = np.argsort(windows, kind="stable")
        same = windows[order[1:]] == windows[order[:-1]]
        if same.any():
            a, b = order[1:][same], order[:-1][same]
            number = {w: k for k, w in enumerate(set(words))}
            own = np.fromiter(map(number.__getitem__, words), np.int64, n)
            if not all((own[a + k] == own[b + k]).all() for k in range(8)):  # two windows of one hash
                order = np.lexsort([own[k : n - 7 + k] for k in range(8)])
                same = np.logical_and.reduce([own[order[1:] + k] == own[order[:-1] + k] for k in range(8)])
                a, b = order[1:][same], order[:-1][same]
            hit = np.zeros(len(windows), bool)
            hit[a] = hit[b] = True
            step = np.zeros(n + 1, np.int64)
            starts = np.flatnonzero(hit)
            np.add.at(step, starts, 1)
            np.add.at(step, starts + 8, -1)
            repeated = int(np.count_nonzero(np.cumsum(step[:-1])))
    return (n, len(text) - sum(map(text.count, WHITE)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated, n < 20 or 100 * repeated > 30 * n)


def _point_groups(texts: list[str]):
    """Slices of the texts' characters as (code of the 4-gram at each character, alphabet, bits), and the number of characters of each text.

    Codes hold ranks in the slice's alphabet, so four of them fit 64 bits.
    """
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    seq = np.full(len(points) + 3 * len(texts), START, np.uint32)
    at = np.arange(len(points)) + np.repeat(3 * np.arange(1, len(texts) + 1), lengths)
    seq[at] = points

    def ranked(part: np.ndarray, where: np.ndarray):
        present = np.zeros(START + 1, bool)
        present[part] = True
        alphabet = np.flatnonzero(present)
        bits = max(1, int(len(alphabet) - 1).bit_length())
        rank = np.zeros(START + 1, np.uint32 if bits <= 8 else np.uint64)
        rank[alphabet] = np.arange(len(alphabet))
        r = rank[part]
        codes = (r[:-3] << (3 * bits)) | (r[1:-2] << (2 * bits)) | (r[2:-1] << bits) | r[3:]
        return codes[where - 3], alphabet, bits

    def slices():
        step = len(at) if len(at) <= 65_000 or len(np.unique(points)) < 65_000 else 16_000
        for k in range(0, len(at), step):
            first, last = at[k], at[min(k + step, len(at)) - 1]
            yield ranked(seq[first - 3 : last + 1], at[k : k + step] - first + 3)

    return slices(), lengths


def _merged(parts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums of n over equal (a, b)."""
    a, b, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((b, a))
    a, b, n = a[order], b[order], n[order]
    new = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
    return a[new], b[new], np.add.reduceat(n, new)


def point_grams(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The 4-grams of code points, two in each of a and b, with their counts."""
    out = []
    for codes, alphabet, bits in _point_groups(texts)[0]:
        code, n = np.unique(codes, return_counts=True)
        one = [alphabet[(code >> code.dtype.type(k * bits)) & code.dtype.type((1 << bits) - 1)].astype(np.int64) for k in (3, 2, 1, 0)]
        out.append((one[0] << POINT | one[1], one[2] << POINT | one[3], n))
    return out


def _group(lang: str | None) -> str:
    """A name for the language's models that null shares with no language."""
    return "" if lang is None else "=" + lang


def _count(batches):
    """model, a, b, n: the 4-grams of the task's texts. A model is a fold's first letter and the language's name."""
    parts: dict[str, list] = {}
    held = 0

    def rows():
        for model, own in parts.items():
            a, b, n = _merged(own)
            for k in range(0, len(a), 200_000):
                part = slice(k, k + 200_000)
                yield pa.record_batch([pa.array([model] * len(a[part])), pa.array(a[part]), pa.array(b[part]), pa.array(n[part])], names=["model", "a", "b", "n"])
        parts.clear()

    for texts, langs, folds in text_groups(batches, ["text", "lang", "fold"], limit=GROUP):
        by: dict[str, list[str]] = {}
        for text, lang, fold in zip(texts, langs, folds, strict=True):
            if text:
                by.setdefault(fold + _group(lang), []).append(text)
        for model, group in by.items():
            parts.setdefault(model, []).extend(point_grams(group))
        held += sum(len(t) for t in texts if t)
        if held > 4 * GROUP:
            parts = {m: [_merged(own)] for m, own in parts.items()}
            held = 0
            if sum(len(own[0][0]) for own in parts.values()) > 1_500_000:
                yield from rows()
    yield from rows()


def _suffix(order: int) -> tuple[Column, Column]:
    """a and b of a gram's last `order` code points."""
    mask = lambda c, k: F.col(c).bitwiseAND(F.lit((1 << (POINT * k)) - 1)).alias(c)
    return mask("a", max(order - 2, 0)), mask("b", min(order, 2))


def estimate(grams: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Modified Kneser-Ney over counted 4-grams (model, a, b, n).

    model, kind, a, b, log_p: for kind 1 to ORDER the log probability of each n-gram's last sign
    after the others, for kind CONTEXT and up the log back-off weight of each context, for kind
    UNMET the even odds of a sign, 1 in (different signs + 1). Lower orders count different
    left neighbours. Large steps are written, so that plans stay small; the written tables are
    returned too, for their deletion.
    """
    levels = {ORDER: grams}
    for order in range(ORDER - 1, 0, -1):
        levels[order] = levels[order + 1].groupBy("model", *_suffix(order)).agg(F.count(F.lit(1)).alias("n"))
        if order == ORDER - 1:
            levels[order] = cut(levels[order])
    lower, out, written = None, [], [levels[ORDER - 1]]
    for order in range(1, ORDER + 1):
        s = [F.count_if(F.col("n") == k).cast("double").alias(f"s{k}") for k in (1, 2, 3, 4)]
        y = F.when(F.col("s1") > 0, F.col("s1") / (F.col("s1") + 2 * F.col("s2"))).otherwise(0.0)
        off = [F.least(F.greatest(F.when(F.col(f"s{k}") > 0, k - (k + 1) * y * F.col(f"s{k + 1}") / F.col(f"s{k}")).otherwise(0.5 * k), F.lit(0.05 * k)), F.lit(0.95 * k)).alias(f"off{k}") for k in (1, 2, 3)]
        offs = levels[order].groupBy("model").agg(*s, F.count(F.lit(1)).alias("types")).select("model", *off, (1 / (F.col("types") + 1)).alias("even"))
        taken = F.when(F.col("n") == 1, F.col("off1")).when(F.col("n") == 2, F.col("off2")).otherwise(F.col("off3"))
        level = levels[order].withColumn("head", F.shiftrightunsigned("b", POINT)).join(F.broadcast(offs), "model").select("model", "a", "b", "head", "n", taken.alias("taken"), "even")  # offs: two rows a language
        contexts = level.groupBy("model", "a", "head").agg(F.sum("n").alias("many"), F.sum("taken").alias("free"))
        own = level.join(contexts, ["model", "a", "head"]).select("model", "a", "b", ((F.col("n") - F.col("taken")) / F.col("many")).alias("own"), (F.col("free") / F.col("many")).alias("weight"), "even")
        if lower is None:
            out.append(offs.select("model", F.lit(UNMET).alias("kind"), F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"), F.log("even").alias("log_p")))
            lower = own.select("model", "a", "b", (F.col("own") + F.col("weight") * F.col("even")).alias("p"))
        else:
            la, lb = _suffix(order - 1)
            low = lower.select("model", F.col("a").alias("la"), F.col("b").alias("lb"), F.col("p").alias("below"))
            lower = own.select("*", la.alias("la"), lb.alias("lb")).join(low, ["model", "la", "lb"]).select("model", "a", "b", (F.col("own") + F.col("weight") * F.col("below")).alias("p"))
            if order < ORDER:
                lower = cut(lower)
                written.append(lower)
        out += [lower.select("model", F.lit(order).alias("kind"), "a", "b", F.log("p").alias("log_p")), contexts.select("model", F.lit(CONTEXT + order - 1).alias("kind"), "a", F.col("head").alias("b"), F.log(F.col("free") / F.col("many")).alias("log_p"))]
    every = out[0]
    for part in out[1:]:
        every = every.unionByName(part)
    return every, written


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashed(kind, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """64-bit hashes of n-grams or contexts, signed like Spark's longs."""
    with np.errstate(over="ignore"):
        x = _mixed(np.asarray(a, np.int64).view(np.uint64) + np.asarray(kind, np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        return _mixed(x ^ _mixed(np.asarray(b, np.int64).view(np.uint64) + np.uint64(0x632BE59BD9B4E019))).view(np.int64)


def _named(batches):
    for batch in batches:
        model, kind, a, b, log_p = batch.columns
        yield pa.record_batch([model, pa.array(hashed(kind.to_numpy(), a.to_numpy(), b.to_numpy())), log_p.cast(pa.float32())], names=["model", "hash", "log_p"])


def train(texts: DataFrame) -> list:
    """Models of texts (text, lang, fold), written as shards sorted by model and hash.

    Returns each shard's file with its first and last model.
    """
    counted = cut(texts.mapInArrow(_count, "model string, a long, b long, n long").groupBy("model", "a", "b").agg(F.sum("n").alias("n")))
    every, written = estimate(counted)
    found = cut(every.mapInArrow(_named, "model string, hash long, log_p float"))
    drop(counted, *written)
    shards = cut(found.repartitionByRange(max(1, -(-found.count() // SHARD_ROWS)), "model", "hash").sortWithinPartitions("model", "hash"))
    index = shards.groupBy(F.input_file_name().alias("file")).agg(F.min("model"), F.max("model")).orderBy("file").collect()  # one row a shard
    drop(found)
    return [tuple(r) for r in index]


_held: dict = {}


def _shards(index: list, model: str):
    """Sorted hashes and log probabilities from each shard that has some of the model; workers keep what they read up to HELD_BYTES."""
    for file, first, last in index:
        if not first <= model <= last:
            continue
        if (file, model) not in _held:
            system, path = pyarrow.fs.FileSystem.from_uri(file)
            read = pyarrow.parquet.read_table(path, filesystem=system, filters=[("model", "=", model)], columns=["hash", "log_p"])
            if sum(t[0].nbytes + t[1].nbytes for t in _held.values()) + read.nbytes > HELD_BYTES:
                _held.clear()
            _held[file, model] = read["hash"].to_numpy(), read["log_p"].to_numpy()
        yield _held[file, model]


def _values(index: list, model: str, want: np.ndarray) -> np.ndarray:
    """The stored number of each hash, nan where there is none."""
    some, where = np.unique(want, return_inverse=True)
    out = np.full(len(some), np.nan)
    for key, log_p in _shards(index, model):
        if len(key):
            at = np.minimum(np.searchsorted(key, some), len(key) - 1)
            hit = key[at] == some
            out[hit] = log_p[at[hit]]
    return out[where]


def log_probabilities(index: list, model: str, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Natural log of each 4-gram's last sign after the first three, backing off where the model has not counted it."""
    out = _values(index, model, hashed(ORDER, a, b))
    new = np.flatnonzero(np.isnan(out))
    if len(new):
        a, b = a[new], b[new]
        mask = lambda x, k: x & ((1 << (POINT * k)) - 1)
        ends = [(mask(a, max(n - 2, 0)), mask(b, min(n, 2))) for n in range(1, ORDER + 1)]  # of each order
        keys = [hashed(n + 1, *ends[n]) for n in range(ORDER - 1)] + [hashed(CONTEXT + n, x, y >> POINT) for n, (x, y) in enumerate(ends)]
        zero = np.zeros(1, np.int64)
        *found, even = _values(index, model, np.concatenate([*keys, hashed(UNMET, zero, zero)]))
        found = np.array(found).reshape(len(keys), len(new))
        own, weight = found[: ORDER - 1], np.nan_to_num(found[ORDER - 1 :], nan=0.0)  # a context never met leaves all to shorter ones
        value = np.full(len(new), -np.log(START) if np.isnan(even) else even)  # a language without a model: any sign of all
        for n in range(ORDER):
            value += weight[n]
            if n < ORDER - 1:
                value = np.where(np.isnan(own[n]), value, own[n])
        out[new] = value
    return out


def _middle(values: np.ndarray, text: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """The (lower) median of the values of each text's runs."""
    return values[np.lexsort((values, text))][np.cumsum(runs) - runs + (runs - 1) // 2]


def log_perplexities(index: list, model: str, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Negative log probability a character and a word, medians over a text's runs, and the number of characters, of texts that are not empty."""
    slices, lengths = _point_groups(texts)
    grams, places = [], []
    for codes, alphabet, bits in slices:
        want = np.unique(codes)
        one = [alphabet[(want >> want.dtype.type(k * bits)) & want.dtype.type((1 << bits) - 1)].astype(np.int64) for k in (3, 2, 1, 0)]
        grams.append((one[0] << POINT | one[1], one[2] << POINT | one[3]))
        places.append(np.searchsorted(want, codes).astype(np.int32))
    log_p = log_probabilities(index, model, *(np.concatenate(x) for x in zip(*grams, strict=True)))
    ends = np.cumsum([len(a) for a, _ in grams])
    every = np.concatenate([part[at] for part, at in zip(np.split(log_p, ends[:-1]), places, strict=True)])
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    white = (points == 0x20) | ((points >= 9) & (points <= 13))
    starts = np.cumsum(lengths) - lengths
    first = ~white
    first[1:] &= white[:-1]
    first[starts] = ~white[starts]
    runs = np.maximum(1, lengths // RUN)
    text = np.repeat(np.arange(len(texts)), runs)
    own = np.arange(len(text)) - (np.cumsum(runs) - runs)[text]
    begin = starts[text] + own * lengths[text] // runs[text]
    cost = -np.add.reduceat(every, begin)
    words = np.add.reduceat(first.astype(np.int64), begin)
    return _middle(cost / np.diff(begin, append=len(points)), text, runs), _middle(cost / np.maximum(words, 1), text, runs), lengths


FIGURES = f"model string, log_ppl double, word_log_ppl double, n_chars long, {METRICS}"


def _figures(index: list, at: tuple[int, int, int], keep: list[int]):
    """The kept columns of each row, its language's group and its figures. at: places of text, language and fold."""

    def run(batches):
        for batch in batches:
            named = pa.record_batch([batch.column(i) for i in at], names=["text", "lang", "fold"])
            rows: list[list] = [[] for _ in range(10)]
            for texts, langs, folds in text_groups([named], ["text", "lang", "fold"], limit=GROUP):
                groups = np.array([_group(x) for x in langs], dtype=object)
                other = np.array([str(1 - int(f)) + g for f, g in zip(folds, groups, strict=True)], dtype=object)
                a_sign, a_word, size = np.full(len(texts), np.nan), np.full(len(texts), np.nan), np.zeros(len(texts), np.int64)
                for model in sorted(set(other.tolist())):
                    mine = [i for i in np.flatnonzero(other == model) if texts[i]]
                    if mine:
                        a_sign[mine], a_word[mine], size[mine] = log_perplexities(index, model, [texts[i] for i in mine])
                base = list(zip(*map(base_counts, texts), strict=True))
                some = lambda x: [None if np.isnan(v) else v for v in x.tolist()]
                figures = [groups.tolist(), some(a_sign), some(np.where(np.array(base[0]) > 0, a_word, np.nan)), size.tolist(), *map(list, base)]
                for all_, new in zip(rows, figures, strict=True):
                    all_.extend(new)
            types = [pa.string(), pa.float64(), pa.float64(), *[pa.int64()] * 6, pa.bool_()]
            columns = [batch.column(i) for i in keep] + [pa.array(r, t) for r, t in zip(rows, types, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=[f"c{i}" for i in range(len(columns))])

    return run


def _with_figures(docs: DataFrame, keep: list[str]) -> tuple[DataFrame, list[str]]:
    """The kept columns of docs (text, lang) with their figures, written to the shared folder, and the figures' names."""
    folded, folds = fresh(docs, "_text", "_fold")
    named = docs.withColumn(folds, F.pmod(F.xxhash64(F.col("text").cast("string")), F.lit(2)).cast("string"))
    index = train(named.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"), F.col(folds).alias("fold")))
    names = fresh(docs, *[x.split()[0] for x in FIGURES.split(", ")])
    kept = [docs.schema[c] for c in keep]
    schema = type(docs.schema)(kept + [f.__class__(n, f.dataType) for n, f in zip(names, type(docs.schema).fromDDL(FIGURES), strict=True)])
    at = tuple(named.columns.index(c) for c in ("text", "lang", folds))
    return cut(named.mapInArrow(_figures(index, at, [named.columns.index(c) for c in keep]), schema)), names


def bands(figures: DataFrame, column: str) -> DataFrame:
    """model, low, high, alpha, beta of figures (model, column, n_chars): quartiles of the column, and the fit of its squared range by length."""
    quartiles = F.percentile_approx(column, [0.25, 0.75], 20_000)
    some = figures.where(F.col(column).isNotNull())
    bins = some.groupBy("model", F.floor(F.log2("n_chars")).alias("bin")).agg(quartiles.alias("q"), F.count(F.lit(1)).alias("w"), F.sum("n_chars").alias("chars"))
    bins = bins.select("model", F.struct("bin", F.col("chars").cast("double").alias("w"), (F.col("w") / F.col("chars")).alias("x"), F.pow(F.col("q")[1] - F.col("q")[0], F.lit(2.0)).alias("y")).alias("bin"))
    bins = bins.groupBy("model").agg(F.sort_array(F.collect_list("bin")).alias("bins"))  # one item a power of two, summed in order
    total = lambda f: F.aggregate("bins", F.lit(0.0), lambda sum_, e: sum_ + f(e))
    weight = total(lambda e: e["w"])
    mean = bins.select("model", "bins", weight.alias("w"), (total(lambda e: e["w"] * e["x"]) / weight).alias("x"), (total(lambda e: e["w"] * e["y"]) / weight).alias("y"))
    spread = total(lambda e: e["w"] * F.pow(e["x"] - F.col("x"), F.lit(2.0)))
    slope = F.when(spread > 0, F.greatest(F.lit(0.0), total(lambda e: e["w"] * (e["x"] - F.col("x")) * (e["y"] - F.col("y"))) / spread)).otherwise(0.0)
    fit = mean.select("model", "x", "y", slope.alias("beta")).select("model", "beta", F.greatest(F.lit(0.0), F.col("y") - F.col("beta") * F.col("x")).alias("alpha"))
    return some.groupBy("model").agg(quartiles.alias("q")).join(fit, "model").select("model", F.col("q")[0].alias("low"), F.col("q")[1].alias("high"), "alpha", "beta")


def judged(docs: DataFrame, keep: list[str], reach: float = REACH) -> tuple[DataFrame, dict[str, str]]:
    """The kept columns, figures, bands and verdict of each row, and the column names of figures, bands and `kept` (another one where docs has such a column)."""
    rows, names = _with_figures(docs, keep)
    named = dict(zip([x.split()[0] for x in FIGURES.split(", ")], names, strict=True))
    verdict = ~F.col(named["base_failed"])
    for figure in ("log_ppl", "word_log_ppl"):
        m, q1, q3, alpha, beta, low, high = fresh(rows, "_model", "_q1", "_q3", "_alpha", "_beta", figure + "_low", figure + "_high")
        own = bands(rows.select(F.col(named["model"]).alias("model"), F.col(named[figure]).alias(figure), F.col(named["n_chars"]).alias("n_chars")), figure).toDF(m, q1, q3, alpha, beta)
        slack = reach * F.sqrt(F.col(alpha) + F.col(beta) / F.greatest(F.col(named["n_chars"]), F.lit(1)))
        rows = rows.join(F.broadcast(own), F.col(named["model"]) == F.col(m), "left").withColumns({low: F.col(q1) - slack, high: F.col(q3) + slack}).drop(m, q1, q3, alpha, beta)  # one row a language
        verdict = verdict & F.coalesce(F.col(named[figure]).between(F.col(low), F.col(high)), F.lit(True))
        named |= {figure + "_low": low, figure + "_high": high}
    (named["kept"],) = fresh(rows, "kept")
    return rows.withColumn(named["kept"], verdict), named


def assess(docs: DataFrame, reach: float = REACH) -> DataFrame:
    """doc_id, counts, base_failed, kept, then log perplexity a character and a word with their bands, one row per row of docs (doc_id, text, lang)."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    return judged(own, ["doc_id"], reach)[0].select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", *[f + e for f in ("log_ppl", "word_log_ppl") for e in ("", "_low", "_high")])


def keep_good(docs: DataFrame, reach: float = REACH) -> DataFrame:
    """The rows of docs that assess() keeps, with all their columns. They are written with their figures once, so that no text is scored twice or moved between tasks."""
    rows, named = judged(docs, docs.columns, reach)
    return rows.where(F.col(named["kept"])).select(*[F.col(f"`{c}`") for c in docs.columns])


def op10_quality_rules(spark, sf_dir: str) -> DataFrame:
    return assess(table(spark, sf_dir, "documents"))
