"""Toxicity of texts written to hide it.

A noisy channel turns letters into look-alikes, puts signs or spaces between them and
repeats them. Every word is decoded: a character stands for the letters it may have
come from, or for nothing, and the Viterbi path through this lattice under a character
language model (three letters, counted over all documents) and the channel's odds is
the restored word. A word of plain letters without a repeat has only one path and is
left alone. A word without a letter may also be a number. Single letters and
look-alikes in a row (three or more) are one lattice in which words may begin anywhere.
The restored text is scored.

The score is a logistic regression over whole words and beginnings of words: whether a
document has one, and how large its share is. Which ones count is found on labelled
documents that are not held out, a bounded sample of them (``TRAIN_ROWS``); the language
model counts every document. Labels, language, source and ids do not enter a score.

Null and empty texts have no feature and the score of the intercept; without labels
every score is the share 0. Repeated rows are scored alike.
"""

from __future__ import annotations

import math
import re
import unicodedata

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..session import broadcast_if_small, cut_lineage
from .common import Words, held_out, in_batches, query, read

TRAIN_ROWS = 8_000
FEATURES = 600
LEAST_DOCS = 5
_BUCKETS = 1 << 22
_STARTS = (4, 5, 6, 7)

# What a sign may stand for in a word.
LOOK_ALIKES = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e"}
SEPARATORS = frozenset(".-_*~'^,:;/\\ ")
# Log odds of the channel.
_SUBSTITUTE, _DROP_SIGN, _DROP_REPEAT, _DROP_DOUBLE, _SPLIT, _UNLIKELY = -0.7, -0.1, -0.5, -4.0, -2.0, -9.0
# Look-alikes that are punctuation at a word's end; of any other to be an ornament there
# unless written three times; of a word in plain letters to hide a doubled one; of a
# digit to be the one that it is in a number.
PUNCTUATION = frozenset("!|+(")
_ORNAMENT, _PLAIN, _DIGIT = -7.0, -2.0, -math.log(10)

ALPHABET = 1 << 5
_REPEAT = re.compile(r"(.)\1")
# Single characters that join a spaced run, as the bytes of a word.
_SINGLE = np.isin(np.arange(256), list(b"abcdefghijklmnopqrstuvwxyz" + "".join(c for c in LOOK_ALIKES if c.isascii()).encode()))
_LONG_SINGLE = {c.encode() for c in LOOK_ALIKES if not c.isascii()}


def _code(c: str) -> int:
    """1..26 for letters, 27 for any other character, 0 for a word's end."""
    return ord(c) - 96 if "a" <= c <= "z" else 27


def letter_counts(docs: DataFrame) -> DataFrame:
    """(a, b, c, n): three letters in a row over all words of all documents, 0 beyond a
    word's ends. At most ALPHABET^3 rows."""

    def counted(frames):
        total = np.zeros(ALPHABET**3, np.int64)

        def add(frame: pd.DataFrame) -> None:
            found = Words(frame["text"], lower=True)
            starts, first, times = np.unique(found.hashes, return_index=True, return_counts=True)
            if not len(first):
                return
            size = found.ends[first] - found.starts[first]
            # All different words one after another, two ends between them.
            at = np.cumsum(size + 2) - size
            codes = np.zeros(int(size.sum()) + 2 * len(size) + 2, np.int64)
            where = np.repeat(at - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
            origin = np.repeat(found.starts[first] - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
            byte = found.joined[origin]
            codes[where] = np.where((byte >= 97) & (byte <= 122), byte - 96, 27)
            weight = np.zeros(len(codes), np.int64)
            weight[where] = np.repeat(times, size)
            weight[at + size] = times
            k = np.flatnonzero(weight)
            total[:] += np.bincount((codes[k - 2] * ALPHABET + codes[k - 1]) * ALPHABET + codes[k], weight[k], ALPHABET**3).astype(np.int64)

        for frame in frames:
            for at in range(0, len(frame), 1024):
                add(frame.iloc[at : at + 1024])
        used = np.flatnonzero(total)
        yield pd.DataFrame({"a": used // ALPHABET**2, "b": used // ALPHABET % ALPHABET, "c": used % ALPHABET, "n": total[used]})

    return docs.select(F.col("text").cast("string").alias("text")).mapInPandas(counted, "a int, b int, c int, n long").groupBy("a", "b", "c").agg(F.sum("n").alias("n"))


def language_model(docs: DataFrame) -> np.ndarray:
    """Log probability of a letter after two others."""
    count = np.zeros((ALPHABET,) * 3)
    for r in letter_counts(docs).collect():
        count[r["a"], r["b"], r["c"]] = r["n"]
    pairs = count.sum(axis=0)
    single = pairs.sum(axis=0) + 1
    back = (pairs + 5 * single / single.sum()) / (pairs.sum(axis=1, keepdims=True) + 5)
    return np.log((count + 5 * back) / (count.sum(axis=2, keepdims=True) + 5))


def _letter(c: str) -> bool:
    """Whether a character is a letter or a mark on one."""
    return c.isalpha() or not c.isascii() and unicodedata.category(c)[0] == "M"


def _readings(c: str) -> str:
    return c if _letter(c) else LOOK_ALIKES.get(c, c)


def _tripled(text: str) -> list[str]:
    """For each character the readings that it shares with both neighbours, or with the
    two before or behind it: repeats of one letter, whatever signs write it."""
    at = [i for i, c in enumerate(text) if c in LOOK_ALIKES or c not in SEPARATORS]
    out, run = [""] * len(text), {}
    for j, i in enumerate(at):
        run = {x: run.get(x, 0) + 1 for x in _readings(text[i])}
        for x, n in run.items():
            for k in at[j - 2 : j + 1] if n == 3 else at[j : j + 1] if n > 3 else ():
                out[k] += x
    return out


def restore(text: str, model: np.ndarray | list[float], spaced: bool = False) -> str:
    """The likeliest word (words, if ``spaced``) behind the signs of ``text``. A model
    that is flattened to a list is quicker to look up."""
    model = np.ravel(model).tolist() if isinstance(model, np.ndarray) else model
    text = text.lower()
    plain, tripled = all(map(_letter, text)), _tripled(text)
    begin = next((i for i, c in enumerate(text) if _letter(c) or c.isdigit()), len(text))
    end = next((i for i in range(len(text), 0, -1) if _letter(text[i - 1]) or text[i - 1].isdigit()), 0)
    # State: the last two letters. Value: log odds, the last letter and what was read, as
    # (before, letter) pairs. Equal states cannot be told apart later; the better one stays.
    paths = {(0, 0): (0.0, "", None)}
    for i, c in enumerate(text):
        if _letter(c):
            if len(paths) == 1 and not spaced:
                # One path left: its odds no longer matter, but for numbers, without a letter.
                ((a, b), (odds, last, read)), = paths.items()
                if last != c:
                    k = _code(c)
                    paths = {(b, k): (odds + model[(a << 10) + (b << 5) + k], c, (read, c))}
                    continue
            letters = [(c, 0.0)]
        else:
            letters = [(x, _SUBSTITUTE) for x in LOOK_ALIKES.get(c, "")]
            if not letters and c not in SEPARATORS:
                letters = [(c, _UNLIKELY)]
            elif c.isdigit():
                letters.append((c, _UNLIKELY))
        drop = None
        if not c.isalnum() and not _letter(c):
            if c not in LOOK_ALIKES:
                drop = _DROP_SIGN
            elif not begin <= i < end:
                drop = _DROP_SIGN if c in PUNCTUATION or c * 3 in text[max(i - 2, 0) : i + 3] else _ORNAMENT
        may, same = _readings(c), tripled[i]
        after: dict[tuple[int, int], tuple[float, str, tuple | None]] = {}

        def offer(state, odds, last, read):
            if state not in after or odds > after[state][0]:
                after[state] = (odds, last, read)

        for (a, b), (odds, last, read) in paths.items():
            for x, cost in letters:
                k = _code(x)
                offer((b, k), odds + cost + model[(a << 10) + (b << 5) + k], x, (read, x))
                if spaced and b:
                    offer((0, k), odds + cost + _SPLIT + model[(a << 10) + (b << 5)] + model[k], x, ((read, " "), x))
            if drop is not None:
                offer((a, b), odds + drop, last, read)
            if last and last in may:
                offer((a, b), odds + (_DROP_REPEAT if last in same else _DROP_DOUBLE + (_PLAIN if plain else 0)), last, read)
        paths = after
    # Nothing read is no word and has no end.
    best, _, read = max(((odds + (model[(a << 10) + (b << 5)] if read else 0), i, read) for i, ((a, b), (odds, _, read)) in enumerate(paths.items())), default=(0.0, 0, None))
    if end > begin and not any(map(_letter, text)):
        number = text[begin:end]
        codes = [0, 0] + [27 if c.strip() else 0 for c in number] + [0]
        as_it_stands = _DROP_SIGN * (len(text) - len(number)) + _DIGIT * len(number) + sum(model[(a << 10) + (b << 5) + k] for a, b, k in zip(codes, codes[1:], codes[2:]))
        if as_it_stands >= best:
            return " ".join(number) if spaced else number
    out = []
    while read is not None:
        read, x = read
        out.append(x)
    return "".join(out[::-1])


class Reader:
    """Restored words of texts; each hidden word of a task is decoded once."""

    def __init__(self, model: np.ndarray, limit: int = 1 << 18):
        self.model, self.limit, self.known = np.ravel(model).tolist(), limit, {}

    def word(self, raw: bytes) -> str:
        """Lower case, restored, without signs at its ends that stand for no letter."""
        if raw in self.known:
            return self.known[raw]
        text = raw.decode("utf-8", "surrogatepass").lower()
        core = text.strip("\"#%&*<>)[]{}.,;:?~^'`-_/\\")
        if not core.isalpha() or _REPEAT.search(core):
            core = restore(core, self.model)
        if len(self.known) >= self.limit:
            self.known.clear()
        self.known[raw] = core
        return core

    def __call__(self, texts) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Different restored words; which of them stands at each place; where texts begin."""
        found = Words(texts, lower=True)
        raw, which = found.distinct()
        vocabulary = [self.word(w) for w in raw]
        alone = np.array([len(w) == 1 and bool(_SINGLE[w[0]]) or w in _LONG_SINGLE for w in raw], bool)
        single = alone[which] if len(which) else np.zeros(0, bool)
        text_of = np.repeat(np.arange(len(found.begins) - 1), np.diff(found.begins))
        # Runs of single characters inside one text.
        begins = np.flatnonzero(np.diff(np.concatenate([[-1], np.where(single, text_of, -1)])))
        ends = np.append(begins[1:], len(single))
        some = (ends - begins >= 3) & single[begins]
        keep = np.ones(len(which), bool)
        extra, extra_text = [], []
        for a, b in zip(begins[some].tolist(), ends[some].tolist()):
            keep[a:b] = False
            letters = b"".join(raw[i] for i in which[a:b]).decode()
            for word in restore(letters, self.model, spaced=True).split():
                extra.append(len(vocabulary))
                extra_text.append(text_of[a])
                vocabulary.append(word)
        which, text_of = np.concatenate([which[keep], np.array(extra, np.int64)]), np.concatenate([text_of[keep], np.array(extra_text, np.int64)])
        return vocabulary, which, text_of


def grams(word: str) -> list[int]:
    """Hash buckets of the word and of its beginnings."""
    out = [xxhash.xxh3_64_intdigest(word + "$") % _BUCKETS] if word else []
    return out + [xxhash.xxh3_64_intdigest(word[:n]) % _BUCKETS for n in _STARTS if len(word) >= n]


def features(texts, reader: Reader, place: np.ndarray, known: dict[str, list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, occurrences), and the number of words of each text. ``place`` maps
    a bucket to its feature, -1 for none."""
    vocabulary, which, text_of = reader(texts)
    size = np.bincount(text_of, minlength=len(texts))
    own = []
    for w in vocabulary:
        if w not in known:
            if len(known) > 1 << 20:
                known.clear()
            known[w] = sorted({int(place[g]) for g in grams(w) if place[g] >= 0})
        own.append(known[w])
    count = np.fromiter(map(len, own), np.int64, len(own))
    flat = np.fromiter((x for o in own for x in o), np.int64, int(count.sum()))
    some = np.flatnonzero(count[which] > 0) if len(which) else np.zeros(0, np.int64)
    n = count[which[some]]
    begin = (np.cumsum(count) - count)[which[some]]
    at = np.repeat(begin - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
    pairs, times = np.unique(np.repeat(text_of[some], n) * np.int64(1 << 32) + flat[at], return_counts=True)
    return pairs >> 32, pairs & 0xFFFFFFFF, times, size


def _values(times: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The share of a feature, on a scale that tells small shares apart."""
    return np.log1p(1000 * times / np.maximum(size, 1)) / 4


def fit(sample: DataFrame, model) -> tuple[np.ndarray, np.ndarray, float]:
    """Features and weights from ``sample`` (text, toxic), which is bounded: the place of
    each bucket, weights (presence, then share) and the intercept."""
    spark = sample.sparkSession

    def seen(frames):
        """How many documents of either label have a bucket."""
        count, reader = np.zeros((2, _BUCKETS), np.int32), Reader(model.value)
        for frame in frames:
            for at in range(0, len(frame), 256):
                some = frame.iloc[at : at + 256]
                vocabulary, which, text_of = reader(some["text"])
                own = [grams(w) for w in vocabulary]
                pairs = np.unique(text_of * np.int64(1 << 32) + which)
                label = some["toxic"].to_numpy(int)
                by_text: dict[int, set[int]] = {}
                for text, word in zip((pairs >> 32).tolist(), (pairs & 0xFFFFFFFF).tolist()):
                    by_text.setdefault(text, set()).update(own[word])
                for text, buckets in by_text.items():
                    count[label[text], list(buckets)] += 1
        used = np.flatnonzero(count.sum(axis=0))
        yield pd.DataFrame({"bucket": used, "clean": count[0, used], "toxic": count[1, used]})

    total = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = total.get(0, 0), total.get(1, 0)
    place = np.full(_BUCKETS, -1, np.int32)
    if not n0 or not n1:
        return place, np.zeros(2 * FEATURES), -30.0 if not n1 else 30.0
    table = sample.mapInPandas(seen, "bucket int, clean long, toxic long").groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).where(F.col("clean") + F.col("toxic") >= LEAST_DOCS)
    share = (F.col("clean") + F.col("toxic")) / (n0 + n1)
    z = (F.col("toxic") / n1 - F.col("clean") / n0) / F.sqrt(share * (1 - share) + 1e-9)
    chosen = [r["bucket"] for r in table.orderBy(F.desc(F.abs(z)), "bucket").limit(FEATURES).collect()]
    place[chosen] = np.arange(len(chosen))
    shared = spark.sparkContext.broadcast(place)

    def rows(frames):
        reader, known = Reader(model.value), {}

        def some(frame: pd.DataFrame) -> pd.DataFrame:
            text, feature, times, size = features(frame["text"], reader, shared.value, known)
            cut = np.searchsorted(text, np.arange(len(frame) + 1))
            value = _values(times, size[text])
            return pd.DataFrame({"toxic": frame["toxic"].to_numpy(), "f": [feature[a:b] for a, b in zip(cut[:-1], cut[1:])], "x": [value[a:b] for a, b in zip(cut[:-1], cut[1:])]})

        yield from in_batches(some)(frames)

    data = sample.mapInPandas(rows, "toxic int, f array<long>, x array<double>").toPandas()
    x = np.zeros((len(data), 2 * FEATURES), np.float32)
    for i, (f, v) in enumerate(zip(data["f"], data["x"])):
        f = np.asarray(f, np.int64)
        x[i, f] = 1
        x[i, FEATURES + f] = v
    y = data["toxic"].to_numpy(np.float32)
    w, b = np.zeros(x.shape[1], np.float32), float(np.log(n1 / n0))
    first, second, first_b, second_b = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for step in range(1, 301):
        p = 1 / (1 + np.exp(-(x @ w + b)))
        g, gb = x.T @ (p - y) / len(y) + 2e-4 * w, float((p - y).mean())
        first, second = 0.9 * first + 0.1 * g, 0.99 * second + 0.01 * g * g
        first_b, second_b = 0.9 * first_b + 0.1 * gb, 0.99 * second_b + 0.01 * gb * gb
        one, two = 1 - 0.9**step, 1 - 0.99**step
        w -= 0.05 * first / one / (np.sqrt(second / two) + 1e-6)
        b -= 0.05 * first_b / one / (second_b / two + 1e-12) ** 0.5
    return place, w.astype(np.float64), b


def training_sample(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """(text, toxic) of labelled documents not held out, at most ``rows`` labels."""
    ids = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select(F.col("doc_id").alias("labelled"), F.col("toxic").cast("int").alias("toxic"))
    ids = broadcast_if_small(ids.orderBy(F.xxhash64("labelled"), "labelled", "toxic").limit(rows))
    return cut_lineage(docs.select("doc_id", F.col("text").cast("string").alias("text")).join(ids, F.col("doc_id") == F.col("labelled")).select("text", "toxic").orderBy(F.xxhash64("text"), "toxic").limit(rows))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``."""
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(language_model(docs))
    place, w, b = fit(training_sample(docs, labels), model)
    shared = spark.sparkContext.broadcast((place, w, b))

    def scored(frames):
        reader, known = Reader(model.value), {}
        place, w, b = shared.value

        def some(frame: pd.DataFrame) -> pd.DataFrame:
            text, feature, times, size = features(frame["text"], reader, place, known)
            value = w[feature] + w[FEATURES + feature] * _values(times, size[text])
            odds = np.clip(b + np.bincount(text, value, len(frame)), -30, 30)
            p = 1 / (1 + np.exp(-odds))
            return pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "held_out": frame["held_out"], "score": p, "predicted": (p >= 0.5).astype(np.int32)})

        yield from in_batches(some, 1024)(frames)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(docs["doc_id"]).alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInPandas(scored, "doc_id long, held_out boolean, score double, predicted int")


def restored(docs: DataFrame) -> DataFrame:
    """``docs`` with hidden words decoded in a column ``restored`` (words joined by spaces)."""
    model = docs.sparkSession.sparkContext.broadcast(language_model(docs))

    @F.pandas_udf("string")
    def decode(texts: pd.Series) -> pd.Series:
        reader = Reader(model.value)
        out = []
        for t in texts:
            vocabulary, which, _ = reader([t])
            out.append(" ".join(vocabulary[i] for i in which))
        return pd.Series(out)

    return docs.withColumn("restored", decode(F.col("text").cast("string")))


@query("op6_toxicity")
def op6(spark, sf_dir):
    return score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
