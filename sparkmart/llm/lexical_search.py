"""Ranked lexical search by bit-sliced Bloom signatures.

Terms are the maximal runs of ASCII letters, digits and characters from U+0080
on, A-Z lower-cased.  With N documents that hold a term, L terms in all, n terms
in a document, df documents with a term and tf its occurrences in one, whole
numbers throughout (``div`` rounds down):

    w = floor(1000 * ln((2N + 2) / (2 df + 1)))
    m = 25 + (75 * n * N) div L
    score = sum over the query's terms, repeats included, of w * (10^9 * tf) div (1000 * tf + 8 * m)

1. *Signatures.*  Documents of a task are collected in blocks of about equal
   numbers of distinct terms.  A block is a bitmap: a row (slice) per hash
   position, a column per document.  A document with tf occurrences of a term
   sets ``HASHES`` positions for the term at level 0, and for each level j with
   2^j <= tf.  The exact df of the queries' terms is counted in the same scan.
2. *Bounds.*  The slices of a term and level, joined by AND, mark every document
   that may hold it 2^j times (and some that don't).  Sums of the marked slices,
   weighted by the query's weights and by what tf < 2^(j+1) can add at the
   document's own m, bound each score from above.
3. *Threshold.*  The documents with the highest bounds are scored on their texts;
   the k-th best exact score is a bar that the result can't fall below.
4. *Rescoring.*  Every document whose bound reaches the bar is scored on its
   text, and the best k are ranked.  Nothing is excluded without that proof.

Queries go in chunks of at most ``QUERY_BYTES`` of text (or one query), the only
data that all tasks get; the documents are scanned anew for each chunk.

Edge cases: a null or empty text, and one without terms, is ranked nowhere and
doesn't count in N; a query without terms, or whose terms no document holds,
returns nothing; texts of any length are split in pieces of ``PIECE`` bytes
between terms, so memory doesn't grow with a text's distinct terms; equal scores
go by doc_id, null last; repeated doc_ids and item_ids are documents and queries
of their own; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.llm._common import mix, stored, workspace

QUERY_BYTES = 1 << 20
PIECE = 1 << 20
#: Documents and bytes of a block at most.
BLOCK, BLOCK_BYTES = 4096, 1 << 20
#: Hash positions of a term; bits per term of a document, at least.
HASHES, BITS = 3, 8
#: For each query k times as many of the highest bounds are scored first.
PROBES = 3

_TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_GAP = re.compile(rb"[^0-9A-Za-z\x80-\xff]")
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
U = np.uint64
_STEP = [U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F), U(0xD6E8FEB86659FD93)]
_LEVEL = 0xA0761D6478BD642F


def term_counts(text: str | None) -> Iterator[Counter]:
    """Occurrences of the terms, by pieces of a text."""
    raw = (text or "").encode()
    at = 0
    while at < len(raw):
        end = len(raw)
        if at + PIECE < end:
            gap = _GAP.search(raw, at + PIECE)
            end = gap.start() if gap else end
        yield Counter(_TERM.findall(raw[at:end].translate(_LOWER)))
        at = end


# --------------------------------------------------------------- signatures

def _keys(terms) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, terms), np.uint64)


def _positions(keys: np.ndarray, level: int, log_bits: int) -> np.ndarray:
    """Slices of terms at a level: one row per term."""
    k = mix(keys + U(_LEVEL * (level + 1) % (1 << 64)))
    return np.stack([((k * s) >> U(64 - log_bits)).astype(np.int64) for s in _STEP[:HASHES]], 1)


class Block:
    """Signatures of documents with about the same number of distinct terms."""

    def __init__(self, log_bits: int):
        self.log_bits = log_bits
        self.size = max(8, min(BLOCK, (BLOCK_BYTES << 3) >> log_bits))
        self.slices = np.zeros((1 << log_bits, -(-self.size // 8)), np.uint8)
        self.ids: list[int | None] = []
        self.n: list[int] = []
        self.top: list[int] = []

    def add(self, doc_id: int | None, n: int, top: int, levels: list[np.ndarray]) -> bool:
        """Add a document; True when the block is full."""
        d = len(self.ids)
        for j, keys in enumerate(levels):
            self.slices[_positions(keys, j, self.log_bits).ravel(), d >> 3] |= np.uint8(1 << (d & 7))
        self.ids.append(doc_id)
        self.n.append(n)
        self.top.append(top)
        return len(self.ids) == self.size

    def row(self) -> dict:
        used = self.slices[:, :-(-len(self.ids) // 8)]
        return {"log_bits": self.log_bits, "ids": self.ids, "n": self.n, "top": self.top, "slices": used.tobytes(), "terms": [], "df": []}


INDEX = "log_bits int, ids array<long>, n array<long>, top array<long>, slices binary, terms array<int>, df array<long>"
_INDEX = pa.schema([("log_bits", pa.int32()), *((c, pa.list_(pa.int64())) for c in ("ids", "n", "top")), ("slices", pa.binary()),
                    ("terms", pa.list_(pa.int32())), ("df", pa.list_(pa.int64()))])


def _index(terms: dict[bytes, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, Block] = {}
        df: Counter = Counter()
        for batch in batches:
            full = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                n, top, levels, held = _document(text.as_py(), terms)
                if not n:
                    continue
                df.update(held)
                log_bits = max(6, (sum(map(len, levels)) * BITS - 1).bit_length())
                if log_bits not in blocks:
                    blocks[log_bits] = Block(log_bits)
                if blocks[log_bits].add(doc_id, n, top, levels):
                    full.append(blocks.pop(log_bits).row())
            if full:
                yield pa.RecordBatch.from_pylist(full, _INDEX)
        for block in blocks.values():
            yield pa.RecordBatch.from_pylist([block.row()], _INDEX)
        if df:
            yield pa.RecordBatch.from_pylist([{"log_bits": 0, "ids": [], "n": [], "top": [], "slices": b"",
                                               "terms": [terms[t] for t in df], "df": list(df.values())}], _INDEX)
    return run


def _document(text: str | None, terms: dict[bytes, int]) -> tuple[int, int, list[np.ndarray], set[bytes]]:
    """A text's number of terms, a bound on the largest tf, the keys of each
    level, and which of ``terms`` it holds.  What occurs 2^j times in a text of
    p pieces does so at least 2^j / p times in one of them."""
    pieces = 1 + len((text or "").encode()) // PIECE
    n = top = 0
    held: set[bytes] = set()
    levels: list[list[np.ndarray]] = []
    for counts in term_counts(text):
        tf, keys = np.fromiter(counts.values(), np.int64, len(counts)), _keys(counts)
        most = int(tf.max(initial=0))
        n, top = n + int(tf.sum()), top + most
        held |= counts.keys() & terms.keys()
        for j in range((most * pieces).bit_length()):
            if j == len(levels):
                levels.append([])
            levels[j].append(keys[tf * pieces >> j > 0] if j else keys)
    return n, top, [np.unique(np.concatenate(x)) if len(x) > 1 else x[0] for x in levels], held


# ------------------------------------------------------------------ queries

class Queries(NamedTuple):
    """A chunk of queries: ids, distinct terms, and per query the places of
    its terms with their repeats (then their weights)."""
    ids: list
    terms: dict[bytes, int]
    places: list[np.ndarray]
    repeats: list[np.ndarray]


def _chunk(items: list[tuple]) -> Queries:
    terms: dict[bytes, int] = {}
    places, repeats = [], []
    for _, text in items:
        counts: Counter = Counter()
        for part in term_counts(text):
            counts.update(part)
        places.append(np.array([terms.setdefault(t, len(terms)) for t in counts], np.int64))
        repeats.append(np.array(list(counts.values()), np.int64))
    return Queries([i for i, _ in items], terms, places, repeats)


def chunks(queries: DataFrame, size: int) -> Iterator[Queries]:
    """Queries ``(item_id, text)`` in chunks of at most ``size`` bytes of text,
    fetched a partition at a time."""
    items, held = [], 0
    for item_id, text in queries.toLocalIterator():
        more = len((text or "").encode())
        if items and held + more > size:
            yield _chunk(items)
            items, held = [], 0
        items.append((item_id, text))
        held += more
    if items:
        yield _chunk(items)


class Corpus(NamedTuple):
    """What scores need of the corpus: N, L and each query term's weight."""
    documents: int
    words: int
    weight: np.ndarray

    def length(self, n: int) -> int:
        return 25 + 75 * n * self.documents // self.words


def _gain(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def bounds(q: Queries, corpus: Corpus, log_bits: int, n: list[int], top: list[int], raw: bytes) -> Iterator[tuple[int, np.ndarray]]:
    """Upper bounds of a block's scores, query by query."""
    docs = len(n)
    slices = np.frombuffer(raw, np.uint8).reshape(1 << log_bits, -1)
    m = np.array([corpus.length(x) for x in n], np.int64)
    top = np.array(top, np.int64)
    keys = _keys(q.terms)
    marked, gains = [], []
    before = np.zeros(docs, np.int64)
    some = np.arange(len(keys))
    for j in range(int(top.max()).bit_length()):
        bits = np.zeros((len(keys), slices.shape[1]), np.uint8)
        bits[some] = marked[-1][some] if marked else 255
        for p in _positions(keys[some], j, log_bits).T:
            bits[some] &= slices[p]
        some = np.flatnonzero(bits.any(1))
        if not len(some):
            break
        now = _gain(np.minimum((2 << j) - 1, top), m)
        gains.append(now - before)
        marked.append(bits)
        before = now
    held = [b.any(1) for b in marked]
    for i, (place, repeat) in enumerate(zip(q.places, q.repeats)):
        bound = np.zeros(docs, np.int64)
        for bits, hit, gain in zip(marked, held, gains):
            use = hit[place]
            if not use.any():
                break
            weight = corpus.weight[place[use]] * repeat[use]
            which = np.unpackbits(bits[place[use]], axis=1, count=docs, bitorder="little")
            bound += (weight.astype(np.float64) @ which).astype(np.int64) * gain        # sums below 2^53
        yield i, bound


def _highest(q: Queries, corpus: Corpus, k: int):
    """The k documents of each block with the highest bounds."""
    def best(item: int, bound: np.ndarray) -> np.ndarray:
        at = np.argsort(-bound, kind="stable")[:k]
        return at[bound[at] > 0]
    return _chosen(q, corpus, best)


def _surviving(q: Queries, corpus: Corpus, bar: dict[int, int]):
    """Documents of each block whose bound reaches the query's bar."""
    return _chosen(q, corpus, lambda item, bound: np.flatnonzero(bound >= bar.get(item, 1)))


def _chosen(q: Queries, corpus: Corpus, choose):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in range(batch.num_rows):
                log_bits, n, top = (batch.column(c)[b].as_py() for c in ("log_bits", "n", "top"))
                items, at, found = [], [], []
                for item, bound in bounds(q, corpus, log_bits, n, top, batch.column("slices")[b].as_buffer()):
                    some = choose(item, bound)
                    items.append(np.full(len(some), item, np.int32))
                    at.append(some)
                    found.append(bound[some])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(items)), batch.column("ids")[b].values.take(pa.array(np.concatenate(at))),
                     pa.array(np.concatenate(found))], names=["item", "doc_id", "bound"])
    return run


BOUND = "item int, doc_id long, bound long"


def _scores(q: Queries, corpus: Corpus):
    """Exact scores of documents ``(doc_id, text, items)`` for their items."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text, items in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                tf = np.zeros(len(q.terms), np.int64)
                n = 0
                for counts in term_counts(text.as_py()):
                    n += counts.total()
                    for t in counts.keys() & q.terms.keys():
                        tf[q.terms[t]] += counts[t]
                if n:
                    part = corpus.weight * _gain(tf, np.int64(corpus.length(n)))
                    scores = [(i, doc_id, int(part[q.places[i]] @ q.repeats[i])) for i in items]
                    out += [s for s in scores if s[2] > 0]
            columns = zip(*out) if out else ([], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int64()))],
                                             names=["item", "doc_id", "score"])
    return run


def _ranked(rows: DataFrame, by: str, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc(by), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _rescored(docs: DataFrame, pairs: DataFrame, q: Queries, corpus: Corpus) -> DataFrame:
    """Exact scores of pairs (item, doc_id): one row per document with its items
    (at most the chunk's) meets the texts."""
    asked = pairs.groupBy("doc_id").agg(F.collect_set("item").alias("items")).withColumnRenamed("doc_id", "asked")
    texts = docs.join(asked, F.col("doc_id").eqNullSafe(F.col("asked"))).select("doc_id", "text", "items")
    return texts.mapInArrow(_scores(q, corpus), "item int, doc_id long, score long")


def _search(docs: DataFrame, q: Queries, k: int, path: str) -> DataFrame:
    spark = docs.sparkSession
    index = stored(docs.mapInArrow(_index(q.terms), INDEX), f"{path}/index")
    total = F.aggregate("n", F.lit(0).cast("long"), lambda a, x: a + x)
    documents, words = index.agg(F.sum(F.size("ids").cast("long")), F.sum(total)).first()
    df = np.zeros(len(q.terms), np.int64)
    counted = index.select(F.explode(F.arrays_zip("terms", "df")).alias("t")).groupBy("t.terms").agg(F.sum("t.df").alias("df"))
    for place, count in counted.collect():                    # at most the chunk's terms
        df[place] = count
    documents = documents or 0
    weight = [math.floor(1000 * math.log((2 * documents + 2) / (2 * x + 1))) for x in df.tolist()]
    corpus = Corpus(documents, words or 1, np.array(weight, np.int64))
    blocks = index.where(F.col("log_bits") > 0)
    first = blocks.mapInArrow(_highest(q, corpus, PROBES * k), BOUND)
    probes = stored(_ranked(first, "bound", PROBES * k).select("item", "doc_id"), f"{path}/probes")
    known = _ranked(_rescored(docs, probes, q, corpus), "score", k)
    bar = dict(known.where(F.col("rank") == k).select("item", "score").collect())          # a number per query
    pairs = stored(blocks.mapInArrow(_surviving(q, corpus, bar), BOUND).select("item", "doc_id"), f"{path}/pairs")
    ranked = _ranked(_rescored(docs, pairs, q, corpus), "score", k)
    names = spark.createDataFrame(pa.table({"item": pa.array(range(len(q.ids)), pa.int32()), "item_id": pa.array(q.ids, pa.int64())}))
    return ranked.join(names, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def search(docs: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """The k best documents of ``docs (doc_id, text)`` for each of ``queries
    (item_id, text)``: ``item_id, rank, doc_id, score``."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    queries = queries.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    path = workspace(spark, "lexical_search")
    parts = [stored(_search(docs, q, k, f"{path}/{no}"), f"{path}/{no}/ranked") for no, q in enumerate(chunks(queries, QUERY_BYTES))]
    if not parts:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.unionAll, parts)


def op12_lexical_search(spark, sf_dir: str) -> DataFrame:
    """The ten best documents for every benchmark item."""
    return search(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


ORACLE = r"""
WITH words AS (
  SELECT row, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS row, * FROM documents)),
asked AS (
  SELECT item, item_id, term, count(*) AS c
  FROM (SELECT item, item_id, unnest(regexp_extract_all(
                 translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM (SELECT row_number() OVER () AS item, * FROM benchmark))
  GROUP BY ALL),
sizes AS (SELECT row, count(*) AS n FROM words GROUP BY row),
corpus AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM sizes),
tf AS (SELECT row, doc_id, term, count(*) AS tf FROM words SEMI JOIN asked USING (term) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, corpus GROUP BY term, docs),
scored AS (
  SELECT item, item_id, row, doc_id,
         CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // total)))) AS BIGINT) AS score
  FROM tf JOIN asked USING (term) JOIN weights USING (term) JOIN sizes USING (row), corpus
  GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10"""
