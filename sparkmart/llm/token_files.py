"""Token-id files: concatenated ids, document boundaries in Elias-Fano code.

Documents are range-partitioned by doc_id; every task streams its documents'
ids, each ended by ``end_id``, into one shard and adds two monotone sequences
in Elias-Fano code: where each document begins, and the doc_ids.  A sequence of
n values below u takes about ``2 + log2(u / n)`` bits a value: the low bits as
they are, the high bits in unary.  ``select`` finds value i by a directory of
32-bit counts of ones every 512 bits; there is no table of 64-bit offsets.

Shard layout (little-endian)::

    "EFTOKEN1", u32 bytes per id, u64 documents, u64 documents without doc_id,
    u64 ids, i64 least doc_id, u64 bytes of the first and of the second
    sequence | ids | sequence of boundaries | sequence of doc_ids

A task that is run again writes another file; the manifest, a table that Spark
commits, names the files that count.

Edge cases: a null or empty text is the end id alone; documents without doc_id
come first; repeated doc_ids follow one another, ordered by a hash of their
text; an empty table makes no shard and an empty result; other columns are
ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.llm._common import stored, text_bytes, workspace
from sparkmart.llm._files import file_system, qualified
from sparkmart.llm.bpe import codec, default_vocabulary

MAGIC = b"EFTOKEN1"
HEADER = "<8sIQQQqQQ"
HEADER_BYTES = struct.calcsize(HEADER)
#: Text that makes one shard.
SHARD_BYTES = 16 << 20
#: Bits of the unary part that one directory entry covers.
SPAN = 512


class EliasFano:
    """A monotone sequence of n non-negative integers."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray):
        self.n, self.low_bits, self.low, self.high = n, low_bits, low, high
        ones = np.bitwise_count(np.pad(high, (0, -len(high) % (SPAN // 8))).reshape(-1, SPAN // 8)).sum(1)
        self.before = np.concatenate([[0], np.cumsum(ones)]).astype(np.uint32)

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        n = len(values)
        most = int(values[-1]) + 1 if n else 1
        bits = max(0, (most // max(n, 1)).bit_length() - 1)
        low = np.zeros((n, bits), np.uint8)
        for b in range(bits):
            low[:, b] = values >> np.uint64(b) & np.uint64(1)
        at = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(at[-1]) + 1 if n else 0, np.uint8)
        high[at] = 1
        return cls(n, bits, np.packbits(low.ravel(), bitorder="little"), np.packbits(high, bitorder="little"))

    def to_bytes(self) -> bytes:
        return struct.pack("<QIQQ", self.n, self.low_bits, len(self.low), len(self.high)) + self.low.tobytes() + self.high.tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> EliasFano:
        n, bits, a, b = struct.unpack_from("<QIQQ", raw)
        body = np.frombuffer(raw, np.uint8, offset=struct.calcsize("<QIQQ"))
        return cls(n, bits, body[:a], body[a:a + b])

    def select(self, first: int, last: int) -> np.ndarray:
        """Values ``first`` to ``last - 1``."""
        if first >= last:
            return np.zeros(0, np.int64)
        a = int(np.searchsorted(self.before, first, "right")) - 1
        b = int(np.searchsorted(self.before, last - 1, "right")) - 1
        bits = np.unpackbits(self.high[a * SPAN // 8:(b + 1) * SPAN // 8], bitorder="little")
        skip = first - int(self.before[a])
        at = np.flatnonzero(bits)[skip:skip + last - first] + a * SPAN
        high = at - np.arange(first, last)
        if not self.low_bits:
            return high.astype(np.int64)
        lo, hi = first * self.low_bits, last * self.low_bits
        raw = np.unpackbits(self.low[lo // 8:-(-hi // 8)], bitorder="little")[lo % 8:lo % 8 + hi - lo]
        low = raw.reshape(-1, self.low_bits).astype(np.int64) @ (1 << np.arange(self.low_bits, dtype=np.int64))
        return (high.astype(np.int64) << self.low_bits) + low


MANIFEST = "part int, file string, first long, documents long, ids long, width int"


def _write(path: str, folder: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        c = codec(path)
        width = 2 if max(len(c.bytes), end_id + 1) <= 1 << 16 else 4
        fs, base = file_system(folder)
        out, name, count, total, nameless = None, "", [], 0, 0
        doc_ids: list[np.ndarray] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                name = f"shard-{uuid.uuid4().hex}.tok"
                out = fs.open_output_stream(f"{base}/{name}.ids")
            nameless += batch.column(0).null_count
            doc_ids.append(batch.column(0).drop_null().to_numpy())
            for lo in range(0, batch.num_rows, 256):
                parts = []
                for text in batch.column(1).slice(lo, 256).to_pylist():
                    ids = c.encode(text or "")
                    parts += [ids, np.array([end_id], "<u4")]
                    count.append(len(ids) + 1)
                out.write(np.concatenate(parts).astype(f"<u{width}").tobytes())
        if out is None:
            return
        out.close()
        begin = EliasFano.of(np.concatenate([[0], np.cumsum(count)])).to_bytes()
        ids = np.concatenate(doc_ids)
        least = int(ids[0]) if len(ids) else 0
        names = EliasFano.of(ids - least if len(ids) else ids).to_bytes()
        total = int(sum(count))
        with fs.open_output_stream(f"{base}/{name}") as whole, fs.open_input_stream(f"{base}/{name}.ids") as part:
            whole.write(struct.pack(HEADER, MAGIC, width, len(count), nameless, total, least, len(begin), len(names)))
            while block := part.read(1 << 22):
                whole.write(block)
            whole.write(begin)
            whole.write(names)
        fs.delete_file(f"{base}/{name}.ids")
        yield pa.RecordBatch.from_arrays(
            [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([name]), pa.array([None if nameless else least], pa.int64()),
             pa.array([len(count)], pa.int64()), pa.array([total], pa.int64()), pa.array([width], pa.int32())],
            names=["part", "file", "first", "documents", "ids", "width"])
    return run


def write_tokens(docs: DataFrame, path: str, folder: str, end_id: int = 0) -> DataFrame:
    """Write shards into ``folder``; returns the stored manifest."""
    spark = docs.sparkSession
    folder = qualified(spark, folder)
    fs, base = file_system(folder)
    fs.create_dir(base, recursive=True)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shards = text_bytes(docs) // SHARD_BYTES + 4
    ordered = docs.repartitionByRange(int(shards), "doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    return stored(ordered.mapInArrow(_write(path, folder, end_id), MANIFEST), f"{folder}/manifest")


def _read(folder: str, block: int = 1 << 20):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(folder)
        for batch in batches:
            for name, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()):
                with fs.open_input_file(f"{base}/{name}") as f:
                    magic, width, n, nameless, total, least, size_a, size_b = struct.unpack(HEADER, f.read(HEADER_BYTES))
                    if magic != MAGIC:
                        raise ValueError(f"{name} is not a token file")
                    f.seek(HEADER_BYTES + total * width)
                    begin = EliasFano.from_bytes(f.read(size_a))
                    names = EliasFano.from_bytes(f.read(size_b))
                    for lo in range(0, n, 1024):
                        hi = min(n, lo + 1024)
                        at = begin.select(lo, hi + 1)
                        crc = []
                        f.seek(HEADER_BYTES + int(at[0]) * width)
                        for size in np.diff(at).tolist():
                            sum_, left = 0, size
                            while left:                        # a long document is read block by block
                                some = min(left, block)
                                ids = np.frombuffer(f.read(some * width), f"<u{width}")
                                sum_ = zlib.crc32(ids.astype("<u4").tobytes(), sum_)
                                left -= some
                            crc.append(sum_)
                        who = [None] * max(0, min(hi, nameless) - lo)
                        who += (names.select(max(lo - nameless, 0), max(hi - nameless, 0)) + least).tolist()
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(who, pa.int64()), pa.array(at[:-1] + start), pa.array(np.diff(at)), pa.array(crc, pa.int64())],
                            names=["doc_id", "start", "n_tokens", "ids_crc32"])
    return run


def read_tokens(manifest: DataFrame, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document in the shards."""
    folder = qualified(manifest.sparkSession, folder)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)      # one row per shard
    files = manifest.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))
    shards = max(1, manifest.count())
    return (files.select("file", "start").repartition(int(shards), "file")
            .mapInArrow(_read(folder), "doc_id long, start long, n_tokens long, ids_crc32 long"))


def op9_token_files(spark, sf_dir: str) -> DataFrame:
    """Write all documents' ids and read the files back."""
    folder = workspace(spark, "token_files")
    manifest = write_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), default_vocabulary(), folder)
    return read_tokens(manifest, folder)
