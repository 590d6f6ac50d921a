"""Quality classifier: supervised subword embeddings.

A text's features are its words (white-space tokens, case kept) and the
words' character n-grams (three to five bytes, word edges marked), and marks of
words that return within four words, hashed to ``BUCKETS`` rows of an embedding
table.  The average of the rows goes through
a softmax layer; both are trained together by mini-batch stochastic gradient
descent in numpy, on at most ``sample`` labelled rows (by hash of doc_id; the
only bounded input).  Scoring covers every whole text: average and output are
linear, so a feature's part of the logit is one number, and a text's logit is
the mean of its features' numbers.

Edge cases: null and empty texts have no features and score by the output
bias; null doc_ids are scored like others (held_out false); repeated rows are
scored each; with no labelled rows, or labels of one kind, scores are constant;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm._common import (BASE, BYTE, INVERSE, STEP, U, Slice, _power, mix, text_slices, words_of)
from sparkmart.llm.toxicity import remainder, sample_of

#: Most labelled rows that the embeddings are trained on.
SAMPLE = 4_000
BUCKETS = 1 << 17
DIMENSION = 16
GRAMS = (3, 4, 5)
#: Word pairs up to this far apart, hashed by whether they are the same word.
REPEATS = 4
EPOCHS = 6
RATE = 0.4
BATCH = 32


def features(s: Slice) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(document, bucket) arrays: words, then n-grams of each length."""
    n = len(s.buf)
    w = words_of(s, lower=False)
    doc = np.searchsorted(s.start, w.begin, "right") - 1
    shift = U(64 - 17)
    yield doc, (mix(w.name ^ STEP[31]) >> shift).astype(np.int32)
    if not len(w.begin):
        return
    for gap in range(1, REPEATS + 1):                   # "the word of ``gap`` words ago, again"
        p = np.flatnonzero((w.name[gap:] == w.name[:-gap]) & (doc[gap:] == doc[:-gap]))
        yield doc[p], np.full(len(p), int(mix(np.array([STEP[40 + gap]]))[0] >> shift), np.int32)
    # Each word between two marks, so that n-grams know word edges.
    size = w.end - w.begin + 2
    at = np.concatenate([[0], np.cumsum(size)])
    marked = np.full(int(at[-1]), 1, np.uint8)
    inner = np.ones(int(at[-1]), bool)
    inner[at[:-1]] = inner[at[1:] - 1] = False
    letters = np.zeros(n + 1, np.int64)
    letters[w.begin] += 1
    letters[w.end] -= 1
    adjacent = np.cumsum(letters[:-1]) > 0
    marked[inner] = s.buf[adjacent]
    m = len(marked)
    total = np.zeros(m + 1, np.uint64)
    np.cumsum(BYTE[marked] * _power("up", BASE, m), out=total[1:])
    down = _power("down", INVERSE, m + 1)
    left = np.repeat(at[1:], size) - np.arange(m)      # bytes to the word's end
    of = np.repeat(doc, size)
    for k in GRAMS:
        p = np.flatnonzero(left >= k)
        yield of[p], (mix((total[p + k] - total[p]) * down[p] + STEP[31 + k]) >> shift).astype(np.int32)


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sample's rows: label, distinct buckets and their shares."""
    for batch in batches:
        for s in text_slices(batch.column(0)):
            pairs = list(features(s))
            doc = np.concatenate([p[0] for p in pairs])
            bucket = np.concatenate([p[1] for p in pairs])
            key, count = np.unique(doc * BUCKETS + bucket, return_counts=True)
            cuts = np.searchsorted(key, np.arange(len(s.start)) * BUCKETS)
            of = list(zip(cuts, cuts[1:]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(1)[s.rows],
                 pa.array([(key[a:b] % BUCKETS).astype(np.int32).tobytes() for a, b in of], pa.binary()),
                 pa.array([(count[a:b] / max(1, count[a:b].sum())).astype(np.float32).tobytes() for a, b in of], pa.binary())],
                names=["label", "buckets", "shares"])


def train(bags: list[tuple[int, np.ndarray, np.ndarray]], seed: int = 7) -> tuple[np.ndarray, float]:
    """Embeddings and softmax layer by SGD; returns each bucket's part of the
    logit of label 1, and the bias."""
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1 / DIMENSION, 1 / DIMENSION, (BUCKETS, DIMENSION)).astype(np.float32)
    out, bias = np.zeros((DIMENSION, 2), np.float32), np.zeros(2, np.float32)
    steps = max(1, EPOCHS * len(bags) // BATCH)
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(bags))
        for lo in range(0, len(order), BATCH):
            some = [bags[i] for i in order[lo:lo + BATCH]]
            rate = RATE * (1 - step / (steps + 1))
            step += 1
            ids, share = np.concatenate([b[1] for b in some]), np.concatenate([b[2] for b in some])
            who = np.repeat(np.arange(len(some)), [len(b[1]) for b in some])
            label = np.array([b[0] for b in some])
            hidden = np.zeros((len(some), DIMENSION), np.float32)
            rows = table[ids] * share[:, None]
            has = np.array([len(b[1]) > 0 for b in some])
            if len(ids):
                hidden[has] = np.add.reduceat(rows, np.flatnonzero(np.diff(who, prepend=-1)))
            z = hidden @ out + bias
            e = np.exp(z - z.max(1, keepdims=True))
            g = e / e.sum(1, keepdims=True)
            g[np.arange(len(some)), label] -= 1
            back = g @ out.T
            out -= rate * (hidden.T @ g)
            bias -= rate * g.mean(0)
            # Average embeddings give small gradients; rows that many texts share move most.
            change = back[who] * share[:, None] * np.float32(rate * 40)
            distinct, inverse = np.unique(ids, return_inverse=True)
            moved = np.stack([np.bincount(inverse, change[:, d], minlength=len(distinct)) for d in range(DIMENSION)], 1)
            table[distinct] -= moved.astype(np.float32)
    direction = out[:, 1] - out[:, 0]
    return (table @ direction).astype(np.float32), float(bias[1] - bias[0])


class QualityModel:
    def __init__(self, part: np.ndarray, bias: float):
        self.part, self.bias = part, bias

    @classmethod
    def fit(cls, docs: DataFrame, labels: DataFrame, where=None, sample: int = SAMPLE) -> QualityModel:
        """Learn from ``labels (doc_id, quality)`` rows that meet ``where``."""
        some = F.broadcast(sample_of(labels, "quality", F.lit(True) if where is None else where, sample))
        rows = (docs.select("doc_id", "text")
                .join(some, "doc_id").select("text", "label")
                .mapInArrow(_bags, "label int, buckets binary, shares binary").collect())
        bags = sorted((int(r[0]), bytes(r[1]), bytes(r[2])) for r in rows)
        if not bags:
            return cls(np.zeros(BUCKETS, np.float32), 0.0)
        return cls(*train([(y, np.frombuffer(i, np.int32), np.frombuffer(x, np.float32)) for y, i, x in bags]))

    def score(self, docs: DataFrame) -> DataFrame:
        """``doc_id, score`` of every row."""
        part, bias = self.part, self.bias

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for s in text_slices(batch.column(1)):
                    n = len(s.start) - 1
                    total, count = np.zeros(n), np.zeros(n)
                    for doc, bucket in features(s):
                        total += np.bincount(doc, part[bucket], minlength=n)
                        count += np.bincount(doc, minlength=n)
                    z = total / np.maximum(count, 1) + bias
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0)[s.rows], pa.array(1 / (1 + np.exp(-np.clip(z, -50, 50))))], names=["doc_id", "score"])

        return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


FOLDS, HELD_OUT = 4, 2


def op7_quality_classifier(spark, sf_dir: str) -> DataFrame:
    """Quality of every document; labels of fold 2 are held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = QualityModel.fit(docs, labels, remainder(FOLDS) != HELD_OUT)
    return model.score(docs).select(
        "doc_id", F.coalesce(remainder(FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"))
