"""Helpers the training-data operators share: shared work folders, text
slices as numpy arrays, word and n-gram fingerprints, packed exchanges."""

from __future__ import annotations

import ctypes
import gc
import time
import uuid
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.session import checkpoint_root

#: Bytes of text that a task turns into numpy arrays at once.
SLICE_BYTES = 3 << 20
U = np.uint64


# ---------------------------------------------------------------- storage

def workspace(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run, under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends
    there, and a lost executor costs no earlier work."""
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop shuffle files of steps whose results are
    stored: it works on unreachable objects, so collect those now (what the
    first pass frees, the second finds unreachable)."""
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.4)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate rows through Hadoop's file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def text_bytes(docs: DataFrame) -> int:
    """UTF-8 bytes of all texts."""
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


# ---------------------------------------------------- memory of the workers

#: Seconds between two times that a worker gives memory back.
GIVE_BACK_S = 1.0
#: What empties a module's caches, which a worker keeps for that module's next tasks.
FORGET: list[Callable[[], None]] = []
_gave_back = 0.0


def give_back(least: float = 0.0) -> None:
    """Empty the caches and return freed memory to the system, unless this worker did
    so within ``least`` seconds.  Spark keeps Python workers for later tasks, and uses
    them in turn: each would hold what its largest task took, and what other operators
    keep, beside the workers at work."""
    global _gave_back
    if least and time.monotonic() - _gave_back < least:
        return
    for forget in FORGET:
        forget()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # the GNU library's
    if trim is not None:
        trim(0)
    _gave_back = time.monotonic()


def trimmed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run``, for ``mapInArrow``; the worker gives memory back before and after."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        try:
            yield from run(batches)
        finally:
            give_back()
    return task


# ------------------------------------------------------------ text slices

class Slice(NamedTuple):
    """Some documents of a batch: ``rows`` are their places in the batch, and
    document j has the bytes ``buf[start[j]:start[j + 1]]``."""
    rows: slice
    buf: np.ndarray
    start: np.ndarray


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Cut a batch's texts (null counts as empty) into slices of about
    ``limit`` bytes; a longer text is a slice of its own."""
    column = column.cast(pa.large_utf8()) if not pa.types.is_large_string(column.type) else column
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if n == 0:
        return
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + limit, "right")) - 1)
        b = min(b, n)
        yield Slice(slice(a, b), raw[off[a]:off[b]], off[a:b + 1] - off[a])
        a = b


# ----------------------------------------------------------- fingerprints

WHITE = np.zeros(256, bool)
WHITE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_rng = np.random.default_rng(20240611)
BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
STEP = [U(int(x) * 2 + 1) for x in _rng.integers(1 << 61, 1 << 62, 64)]
BASE = 0xD1342543DE82EF95
INVERSE = pow(BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}
FORGET.append(_powers.clear)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (splitmix64)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def _power(kind: str, base: int, n: int) -> np.ndarray:
    have = _powers.get(kind)
    if have is None or len(have) < n:
        out = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
        out[0] = 1
        have = _powers[kind] = np.multiply.accumulate(out)
    return have[:n]


class Words(NamedTuple):
    """Words of a slice: first byte, end, fingerprint, and per document the
    place of its first word (``of[j]:of[j + 1]`` are its words)."""
    begin: np.ndarray
    end: np.ndarray
    name: np.ndarray
    of: np.ndarray


def words_of(s: Slice, lower: bool = True, placed: bool = False) -> Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text with 64-bit fingerprints:
    polynomials modulo 2^64 or, if ``placed``, sums of mixed (byte, place in the
    word), which no pattern in a word makes equal for another one."""
    n = len(s.buf)
    white = WHITE[s.buf]
    breaks = np.empty(n + 1, bool)
    breaks[0] = True
    breaks[1:] = white
    breaks[s.start[:-1][s.start[:-1] < n]] = True
    begin = np.flatnonzero(~white & breaks[:-1])
    after = np.empty(n + 1, bool)
    after[:n] = white
    after[n] = True
    after[s.start[1:]] = True
    end = np.flatnonzero(~white & after[1:]) + 1
    t = BYTE[LOWER[s.buf] if lower else s.buf]
    if placed:
        first = np.concatenate([[0], begin, [n]])
        place = (np.arange(n) - np.repeat(first[:-1], np.diff(first))).astype(np.uint64)
        t = mix(t + place * STEP[62])
    else:
        t = t * _power("up", BASE, n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(t, out=total[1:])
    name = total[end] - total[begin]
    if not placed:
        name *= _power("down", INVERSE, n + 1)[begin]
    name += (end - begin).astype(np.uint64)
    return Words(begin, end, mix(name), np.searchsorted(begin, s.start))


def shingles_of(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of every document's k-word windows (with fewer words: of
    the whole sequence), sorted and distinct, and where each document's begin."""
    count = np.diff(w.of)
    m = len(w.name)
    rows = np.where(count >= k, count - k + 1, (count > 0).astype(np.int64))
    of = np.concatenate([[0], np.cumsum(rows)])
    out = np.empty(int(of[-1]), np.uint64)
    full = np.zeros(max(0, m - k + 1), np.uint64)
    for j in range(k):
        full += w.name[j:m - k + 1 + j] * STEP[j]
    for d in range(len(count)):
        a, c = int(w.of[d]), int(count[d])
        if c >= k:
            out[of[d]:of[d + 1]] = full[a:a + c - k + 1]
        elif c:
            out[of[d]] = np.append(w.name[a:a + c] * np.array(STEP[:c], np.uint64), STEP[63 - c]).sum()
    out = mix(out)
    for d in np.flatnonzero(rows > 1):
        out[of[d]:of[d + 1]].sort()
    keep = np.ones(len(out), bool)
    keep[1:] = out[1:] != out[:-1]
    keep[of[:-1][rows > 0]] = True
    return out[keep], np.concatenate([[0], np.cumsum(keep)])[of]


def binary_list(flat: np.ndarray, of: np.ndarray) -> pa.Array:
    """One binary value per row: ``flat[of[i]:of[i + 1]]``."""
    flat = np.ascontiguousarray(flat)
    offsets = (np.asarray(of, np.int64) * flat.itemsize).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1,
                                 [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(flat.tobytes())]).cast(pa.binary())


# --------------------------------------------------------- packed exchange

def bucketed(key: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the entries by bucket (the key's upper 32 bits, scaled) and
    where each bucket begins."""
    p = ((key >> U(32)) * U(buckets) >> U(32)).astype(np.int32)
    order = np.argsort(p, kind="stable")
    return order, np.searchsorted(p[order], np.arange(buckets + 1))


# ---------------------------------------------------- connected components

def components(edges: DataFrame, path: str) -> DataFrame:
    """Smallest label reachable from every node of ``edges (a, b)``: rows
    ``(node, component)``.

    Alternates the large-star and small-star steps (each a pre-aggregated
    shuffle) until no edge changes; each round is stored in the shared folder.
    """
    spark = edges.sparkSession
    both = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    now = stored(both.distinct(), f"{path}/edges0")
    before, round_ = None, 0
    while True:
        round_ += 1
        ends = now.select("u", "v").unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = ends.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = ends.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u")
                 .select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                                           F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.u", "e.v").where("u <> v").distinct())
        now = stored(small, f"{path}/edges{round_}")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)
