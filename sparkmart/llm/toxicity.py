"""Toxicity: noisy-channel restoration of disguised words, then a word score.

* *Language model.*  Character trigrams of the whole corpus (letters a-z, one
  class for other letters, one for word edges), counted in every task and
  summed.
* *Channel.*  A token with signs or digits among letters, with a letter three
  or more times in a row, or a chain of single letters and look-alike signs is
  a lattice: every sign may stand for letters that look like it or for
  nothing, a run may be one or two letters.  Viterbi decoding under the
  language model picks the most probable word.  Chains, and tokens with
  ``.*_-`` between letters, are read a second time with an optional word edge
  at each gap, which splits a spaced-out sentence into words.  Tokens and
  chains have three characters or more, and any length beyond.
* *Score.*  Features of a text are its words (lower-cased letter runs and
  restored words) and their first three to six bytes.  Sparse logistic
  regression (numpy, L1) weighs those that tell the labels apart; the score
  is the logistic function of the weights of the distinct features found.

Fitted on at most ``sample`` labelled rows (by hash of doc_id; the only bounded
input).  Of their features those found in four rows or more are ranked by how well
they tell the labels apart, and at most ``FEATURES`` get a weight.  The language
model and the scores cover all texts, whole.

Edge cases: null and empty texts have no features and get the model's
intercept; null doc_ids are scored like others, and their held_out is false;
repeated rows are scored each; without labelled rows every score is 0; an
empty table gives an empty result; other columns pass through ``screen``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.llm._common import (BASE, BYTE, INVERSE, LOWER, STEP, U, Slice, WHITE, Words, _power, mix, text_slices,
                                   trimmed, words_of)

#: Most labelled rows that the regression is fitted on.
SAMPLE = 20_000
#: Most features that enter the regression, by how well they tell labels apart.
FEATURES = 4_096
PREFIXES = (3, 4, 5, 6)

#: What a sign may stand for (fixed values); "" is a sign that means nothing.
LOOKS_LIKE = {
    "0": ("o",), "1": ("i", "l"), "2": ("z",), "3": ("e",), "4": ("a",), "5": ("s",), "6": ("g", "b"),
    "7": ("t",), "8": ("b",), "9": ("g",), "@": ("a",), "$": ("s",), "!": ("i", ""), "|": ("i", "l", ""),
    "+": ("t", ""), "(": ("c", ""), "*": ("",), "_": ("",), "-": ("",), ".": ("",), "'": ("",), "#": ("",),
}
#: Log probability of each channel event.
SIGN, DROP, SINGLE, DOUBLE, EDGE = -1.0, -2.0, -0.7, -0.7, -0.5
#: Longest token whose readings are cached, and characters between two cuts of
#: what all paths have in common.
CACHED, STRIDE = 64, 32

LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = True
LETTER[128:] = True
CLASSES = 28          # word edge, a-z, any other letter
CLASS = np.zeros(256, np.int64)
CLASS[65:91] = CLASS[97:123] = np.arange(1, 27)
CLASS[128:] = 27
CONTINUES = np.zeros(256, bool)
CONTINUES[128:192] = True


# --------------------------------------------------------- language model

def _trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(CLASSES ** 3, np.int64)
    for batch in batches:
        for s in text_slices(batch.column(0)):
            keep = ~CONTINUES[s.buf]                     # one class per character
            edge = np.zeros(len(s.buf), bool)
            edge[s.start[:-1][s.start[:-1] < len(s.buf)]] = True
            c = CLASS[s.buf][keep]
            at = np.flatnonzero(edge[keep])
            c = np.insert(c, at, 0)                      # texts don't run into each other
            if len(c) > 2:
                total += np.bincount((c[:-2] * CLASSES + c[1:-1]) * CLASSES + c[2:], minlength=len(total))
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["gram", "n"])


def language_model(docs: DataFrame) -> np.ndarray:
    """Log probability of a character class after two others."""
    rows = docs.select("text").mapInArrow(trimmed(_trigrams), "gram long, n long").groupBy("gram").agg(F.sum("n")).collect()
    count = np.full(CLASSES ** 3, 0.1)
    for gram, n in rows:                                 # at most 28 ** 3 of them
        count[gram] += n
    count = count.reshape(CLASSES, CLASSES, CLASSES)
    return np.log(count / count.sum(2, keepdims=True))


def _code(c: str) -> int:
    return ord(c) - 96 if "a" <= c <= "z" else 0 if c == " " else 27


class Chain(str):
    """Single letters and signs that white space kept apart, joined; a space
    stands for a gap wider than the narrowest one."""


def _choices(token: str, edges: bool) -> Iterator[list[tuple[str, float]]]:
    """What each piece of a token may stand for, with log probabilities."""
    if edges and isinstance(token, Chain):
        for m in re.finditer(r"([a-z])\1{2,}|.", token):
            c = m[0][0]
            if c == " ":
                yield [(" ", 0.0), ("", DROP)]
                continue
            if m.start() and token[m.start() - 1] != " ":
                yield [("", 0.0), (" ", EDGE)]
            if len(m[0]) > 2:
                yield [(c, SINGLE), (c * 2, DOUBLE), (f"{c} {c}", DOUBLE + EDGE)]
            elif c.isalpha():
                yield [(c, 0.0)]
            else:
                yield [(x, SIGN if x else DROP) for x in LOOKS_LIKE[c]]
        return
    for m in re.finditer(r"(.)\1*", token.replace(" ", "")):
        c, n = m[1], len(m[0])
        if c.isalpha():
            yield [(c * n, 0.0)] if n < 3 else [(c, SINGLE), (c * 2, DOUBLE)]
        else:
            yield [(x * k, SIGN * k if x else DROP) for x in LOOKS_LIKE.get(c, ("",))
                   for k in ((min(n, 2),) if n < 3 else (1, 2)) if x or k == 1 or n == 2] + (
                       [(" ", DROP + EDGE)] if edges and c in ".*_-" else [])


class Restorer:
    """Viterbi decoder of disguised tokens of any length."""

    def __init__(self, model: np.ndarray):
        self.p = model.tolist()
        self._known = lru_cache(100_000)(self._readings)

    def restore(self, token: str) -> str:
        """The token as one word."""
        return self._decode(token, False)

    def words(self, token: str) -> tuple[str, ...]:
        """The token as one word and, if it has gaps, as several."""
        return (self._known if len(token) <= CACHED else self._readings)(token, isinstance(token, Chain))

    def _readings(self, token: str, chain: bool) -> tuple[str, ...]:
        one = self._decode(token, False)
        if not chain and not re.search(r"\w[.*_-]+\w", token):
            return (one,) if one else ()
        return tuple(x for x in dict.fromkeys([one, *self._decode(token, True).split()]) if x)

    def _decode(self, token: str, edges: bool) -> str:
        # States are the last two classes; each keeps its best path, less what
        # all paths begin with.
        best: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
        done = []
        for i, options in enumerate(_choices(token, edges), 1):
            after: dict[tuple[int, int], tuple[float, str]] = {}
            for (a, b), (score, path) in best.items():
                for out, cost in options:
                    x, y, total = a, b, score + cost
                    for o in out:
                        z = _code(o)
                        total += self.p[x][y][z]
                        x, y = y, z
                    if (x, y) not in after or after[x, y][0] < total:
                        after[x, y] = (total, path + out)
            best = after
            if i % STRIDE == 0:
                same = commonprefix([path for _, path in best.values()])
                done.append(same)
                best = {k: (total, path[len(same):]) for k, (total, path) in best.items()}
        done.append(max((total + self.p[a][b][0], path) for (a, b), (total, path) in best.items())[1])
        return "".join(done)


# ---------------------------------------------------------------- features

def _letter_words(s: Slice) -> Words:
    """Letter runs of each text."""
    n = len(s.buf)
    on = LETTER[s.buf]
    edge = np.zeros(n + 1, bool)
    edge[s.start] = True
    before = np.concatenate([[False], on])
    begin = np.flatnonzero(on & (~before[:-1] | edge[:-1]))
    after = np.concatenate([on[1:], [False]]) if n else on
    end = np.flatnonzero(on & (~after | edge[1:])) + 1
    return Words(begin, end, np.zeros(0, np.uint64), np.searchsorted(begin, s.start))


def _names(buf: np.ndarray, begin: np.ndarray, end: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Features as (which words have it, fingerprints): whole words, prefixes."""
    n = len(buf)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(BYTE[LOWER[buf]] * _power("up", BASE, n), out=total[1:])
    down = _power("down", INVERSE, n + 1)
    every = np.arange(len(begin))
    yield every, mix((total[end] - total[begin]) * down[begin] + STEP[0])
    for k in PREFIXES:
        some = np.flatnonzero(end - begin > k)
        a = begin[some]
        yield some, mix((total[a + k] - total[a]) * down[a] + STEP[k])


SIGNS = np.zeros(256, bool)
SIGNS[[ord(c) for c in "0123456789@$!|+(*_#"]] = True
LINKS = np.zeros(256, bool)
LINKS[[ord(c) for c in ".*_-"]] = True
STOPS = np.zeros(256, bool)
STOPS[[ord(c) for c in ".,;:!?"]] = True
CHAINED = LETTER.copy()
CHAINED[[ord(c) for c in LOOKS_LIKE]] = True
ENDS = np.zeros(256, bool)
ENDS[[ord(c) for c in "@$"]] = True


def disguised(s: Slice) -> list[tuple[int, str]]:
    """(document, token) of the places that look disguised: a sign before a
    letter, one or two of ``@$`` after the last one, a letter three times in a
    row, single letters chained by ``.*_-``; and of chains of single letters
    and ``LOOKS_LIKE`` signs, at least one a letter, between white space."""
    n = len(s.buf)
    if n < 3:
        return []
    low = LOWER[s.buf]
    pad = np.concatenate([[32, 32], low, [32, 32]]).astype(np.uint8)
    on, white = LETTER[pad], WHITE[pad]
    at = lambda x, k: x[2 + k:n + 2 + k]
    odd = SIGNS[low] & at(on, 1)
    odd |= ENDS[low] & at(white, 1) & (at(on, -1) | ENDS[at(pad, -1)] & at(on, -2))
    odd |= on[2:-2] & (low == at(pad, 1)) & (low == at(pad, 2)) & (low < 128)
    odd |= LINKS[low] & at(on, -1) & at(on, 1) & ~at(on, -2) & LINKS[at(pad, 2)]
    w = words_of(s)
    doc = np.searchsorted(s.start, w.begin, "right") - 1
    out = []
    for i in np.unique(np.searchsorted(w.begin, np.flatnonzero(odd), "right") - 1):
        if i >= 0 and w.end[i] - w.begin[i] > 2:
            out.append((int(doc[i]), low[w.begin[i]:w.end[i]].tobytes().decode("utf-8", "replace")))
    one = CHAINED[s.buf[w.begin]] & ((w.end - w.begin == 1) | (w.end - w.begin == 2) & STOPS[s.buf[w.end - 1]])
    one = np.concatenate([[False], one, [False]])
    first, last = np.flatnonzero(~one[:-1] & one[1:]), np.flatnonzero(one[:-1] & ~one[1:])
    letters = np.concatenate([[0], np.cumsum(LETTER[s.buf[w.begin]])])
    some = (last - first > 2) & (letters[last] > letters[first])
    for a, b in zip(first[some], last[some]):
        for k in np.split(np.arange(a, b), np.flatnonzero(np.diff(doc[a:b])) + 1):
            if len(k) > 2 and LETTER[s.buf[w.begin[k]]].any():
                gap = np.diff(w.begin[k])
                chain = np.insert(low[w.begin[k]], np.flatnonzero(gap > gap.min()) + 1, 32)
                out.append((int(doc[k[0]]), Chain(chain.tobytes().decode("ascii"))))
    return out


def _features(s: Slice, restorer: Restorer) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(document, fingerprint) arrays of a slice's features."""
    w = _letter_words(s)
    doc = np.searchsorted(s.start, w.begin, "right") - 1
    for some, name in _names(s.buf, w.begin, w.end):
        yield doc[some], name
    extra, who = [], []
    for j, token in disguised(s):
        for word in restorer.words(token if isinstance(token, Chain) else token.strip(".,;:?\"")):
            extra.append(word.encode())
            who.append(j)
    if extra:
        buf = np.frombuffer(b"".join(extra), np.uint8)
        end = np.cumsum([len(x) for x in extra])
        begin = end - [len(x) for x in extra]
        who = np.array(who)
        for some, name in _names(buf, begin, end):
            yield who[some], name


# ---------------------------------------------------------------- learning

def _counts(model: np.ndarray):
    """Documents of each label that hold a feature, per task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model)
        for batch in batches:
            label = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            for s in text_slices(batch.column(0)):
                here = label[s.rows]
                pairs = [(d, f) for d, f in _features(s, restorer)]
                d, f = np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])
                order = np.lexsort((d, f))
                d, f = d[order], f[order]
                new = np.ones(len(f), bool)
                new[1:] = (f[1:] != f[:-1]) | (d[1:] != d[:-1])
                d, f = d[new], f[new]
                names, at = np.unique(f, return_index=True)
                if len(names):
                    ones = np.add.reduceat(here[d], at)
                    total = np.diff(np.append(at, len(f)))
                    yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(total), pa.array(ones)],
                                                     names=["feature", "n", "toxic"])
    return run


def _found(s: Slice, restorer: Restorer, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, place in ``known``) of a slice."""
    docs, places = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for d, f in _features(s, restorer):
        at = np.minimum(np.searchsorted(known, f), len(known) - 1)
        hit = known[at] == f
        docs.append(d[hit])
        places.append(at[hit])
    return np.unique(np.stack([np.concatenate(docs), np.concatenate(places)]), axis=1)


def _rows(model: np.ndarray, known: np.ndarray):
    """The sample's rows: label and the places of its features."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model)
        for batch in batches:
            label = batch.column(1)
            for s in text_slices(batch.column(0)):
                d, place = _found(s, restorer, known)
                cuts = np.searchsorted(d, np.arange(len(s.start)))
                yield pa.RecordBatch.from_arrays(
                    [label[s.rows], pa.array([place[a:b].tolist() for a, b in zip(cuts, cuts[1:])], pa.list_(pa.int64()))],
                    names=["label", "places"])
    return run


def _regression(label: np.ndarray, rows: list[np.ndarray], width: int, l1: float = 2e-4, steps: int = 400):
    """L1 logistic regression by accelerated proximal gradient steps."""
    who = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    what = np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)
    n = max(1, len(label))
    w, b = np.zeros(width), 0.0
    v, vb, t = w, b, 1.0
    rate = 4.0 / max(1.0, np.bincount(who, minlength=1).max() + 1) * 2
    for _ in range(steps):
        z = np.bincount(who, v[what], minlength=len(rows)) + vb
        g = 1 / (1 + np.exp(-z)) - label
        w2 = v - rate * np.bincount(what, g[who], minlength=width) / n
        w2 = np.sign(w2) * np.maximum(np.abs(w2) - rate * l1, 0)
        b2 = vb - rate * g.mean()
        t2 = (1 + math.sqrt(1 + 4 * t * t)) / 2
        v, vb = w2 + (t - 1) / t2 * (w2 - w), b2 + (t - 1) / t2 * (b2 - b)
        w, b, t = w2, b2, t2
    return w, b


def sample_of(labels: DataFrame, column: str, where, sample: int) -> DataFrame:
    """At most ``sample`` labelled rows by hash of doc_id, small enough to broadcast."""
    return (labels.where(where & F.col(column).isNotNull() & F.col("doc_id").isNotNull())
            .select("doc_id", F.col(column).cast("int").alias("label")).dropDuplicates(["doc_id"])
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))


def remainder(divisor: int):
    """crc32 of doc_id as text, by ``divisor``: names a document's fold."""
    return F.crc32(F.col("doc_id").cast("string")) % divisor


class ToxicityModel:
    """Language model, features and weights; ``score`` adds a column."""

    def __init__(self, model: np.ndarray, known: np.ndarray, weight: np.ndarray, bias: float):
        self.model, self.known, self.weight, self.bias = model, known, weight, bias

    @classmethod
    def fit(cls, docs: DataFrame, labels: DataFrame, where=None, sample: int = SAMPLE) -> ToxicityModel:
        """Learn from ``labels (doc_id, toxic)`` rows that meet ``where``."""
        model = language_model(docs)
        some = F.broadcast(sample_of(labels, "toxic", F.lit(True) if where is None else where, sample))
        train = docs.select("doc_id", "text").join(some, "doc_id").select("text", "label")
        size = train.agg(F.count("*"), F.sum("label")).first()
        n, ones = size[0], size[1] or 0
        if not 0 < ones < n:
            return cls(model, np.zeros(1, np.uint64), np.zeros(1), 50.0 if n and ones == n else -50.0)
        # Log-likelihood ratio of "has the feature" against the label.
        p, q = (F.col("toxic") + 0.5) / (ones + 1.0), (F.col("n") - F.col("toxic") + 0.5) / (n - ones + 1.0)
        gain = ones * p * F.log(p / q) - (n - ones) * q * F.log(p / q)
        counts = train.mapInArrow(trimmed(_counts(model)), "feature long, n long, toxic long").groupBy("feature").agg(
            F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))
        top = counts.where("n >= 4").withColumn("gain", gain).where(p > q).orderBy(
            F.desc("gain"), "feature").limit(FEATURES).select("feature").collect()
        known = np.sort(np.array([r[0] for r in top] or [0], np.int64).view(np.uint64))
        rows = train.mapInArrow(trimmed(_rows(model, known)), "label int, places array<long>").collect()
        label = np.array([r[0] for r in rows], float)
        order = np.lexsort([[len(r[1]) for r in rows], [hash(tuple(r[1])) for r in rows], label])
        w, b = _regression(label[order], [np.array(rows[i][1], np.int64) for i in order], len(known))
        used = np.flatnonzero(w)
        if not len(used):
            used = np.zeros(1, np.int64)
        return cls(model, known[used], w[used], b)

    def score(self, docs: DataFrame) -> DataFrame:
        """``docs`` with the column ``toxicity`` (0 to 1)."""
        model, known, weight, bias = self.model, self.known, self.weight, self.bias

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            restorer = Restorer(model)
            for batch in batches:
                total = np.full(batch.num_rows, bias)
                for s in text_slices(batch.column("text")):
                    d, place = _found(s, restorer, known)
                    total[s.rows] += np.bincount(d, weight[place], minlength=len(s.start) - 1)
                score = 1 / (1 + np.exp(-np.clip(total, -50, 50)))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)],
                                                 names=[*batch.schema.names, "toxicity"])

        return docs.mapInArrow(trimmed(run), T.StructType([*docs.schema.fields, T.StructField("toxicity", T.DoubleType())]))


FOLDS = 5


def fitted(spark, docs: DataFrame, sf_dir: str) -> ToxicityModel:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return ToxicityModel.fit(docs, labels, remainder(FOLDS) != 0)


def op6_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity of every document; labels of fold 0 are held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    scored = fitted(spark, docs, sf_dir).score(docs)
    return scored.select("doc_id", F.coalesce(remainder(FOLDS) == 0, F.lit(False)).alias("held_out"),
                         F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))


def screen(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """The documents that the model doesn't call toxic, all columns kept."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    inner = docs.select("text", F.struct(F.lit(0).alias("none"), *others).alias("row"))         # the text goes once
    return model.score(inner).where("toxicity < 0.5").select(
        *[F.col("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that the model calls toxic go."""
    return screen(docs, fitted(spark, docs, sf_dir))
