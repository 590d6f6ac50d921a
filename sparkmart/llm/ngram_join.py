"""N-gram Jaccard join: documents whose sets of word n-grams overlap.

The join is the sparse product of the document-by-n-gram incidence matrix
with its transpose, cut into blocks, and exact:

1. *Column blocks.*  Two sets of sizes s and t that reach the similarity
   differ in at most ``(s + t)(100 - p) / (100 + p)`` n-grams.  The n-grams
   are dealt by hash into more blocks than that size-derived bound, and only
   blocks that hold something count: a row with more of them than n-grams may
   differ agrees with every qualifying row in one whole block.  The rare rows
   with fewer also go by single n-grams, those first in fingerprint order (a
   prefix filter).  Cells of the product are formed only where two rows agree
   in a block; rows of one size class, or of neighbouring classes, share a
   dealing.
2. *Discarding.*  Each row also carries a short sketch, the parity of its
   n-grams in each fine block.  Parities that differ bound the differing n-grams
   from below; a cell beyond its bound is discarded before any set is moved.
3. *Accumulation.*  For the cells left, overlap counts are accumulated column
   range by column range; a cell goes as soon as what it has, plus all that
   the remaining ranges could add, falls below its bound.
4. *Hot blocks.*  Rows with equal sets are one row from the start.  Each block
   first links its members to one pivot (a linear number of cells); only
   members that are still in different components are then compared, in
   chunk-by-chunk pieces inside tasks that emit surviving cells alone.

Result: one row per input row, ``doc_id, n_shingles, component_id`` (smallest
doc_id reachable by links, itself included).  Components only: pairs inside one
are not all compared, so neither linked pairs nor a document's number of links
are available.

Edge cases: null or empty texts and texts without words have 0 n-grams and
link with nothing (component_id is their own doc_id); fewer words than ``k``
make one n-gram of the whole sequence; rows with equal doc_id but different
n-grams are linked each on its own, and every row is in the result; a null doc_id joins as a row
whose id is never the smallest, and gets component_id null only if no linked
row has an id; an empty table gives an empty result; other columns are ignored.
The stage drops only rows that link with the row that stays: rows of one doc_id
or of none are told apart by their text, and texts without words all stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm._common import (U, STEP, binary_list, bucketed, components, mix, release, remove,
                                   shingles_of, stored, text_slices, trimmed, words_of, workspace)

#: Members of a block that one task compares with as many others at once.
CHUNK = 512
#: Rows that a task which compares members gets, about.
UNIT_ROWS = 20_000
#: Entries of the block exchange that one task sorts at once.
BUCKET_ENTRIES = 600_000
RANGES = 8


# ------------------------------------------------- size-derived bounds

class Bounds:
    """Size classes and block counts for a similarity of ``percent``."""

    def __init__(self, percent: int):
        self.p = percent
        low = [1]
        while low[-1] < 1 << 40:
            low.append(low[-1] * 100 // percent + 1)
        self.low = np.array(low, np.int64)
        # An eighth and two more than the bound, as some blocks get nothing.
        most = [self.most(2 * (high - 1)) + 1 for high in low[1:]]
        self.blocks = np.array([m + m // 8 + 2 for m in most] + [0], np.int64)

    def most(self, both):
        """Most n-grams in which two sets, of sizes that sum to ``both``, may differ."""
        return both * (100 - self.p) // (100 + self.p)

    def size_class(self, n):
        return np.searchsorted(self.low, n, "right") - 1

    def linkable(self, n):
        """Whether a set of n can link with a different one."""
        return self.most(2 * n + 1) >= 1

    def fine(self, n):
        """Bits of a sketch: a power of two, so sketches fold onto shorter ones."""
        m = 80 // (100 - self.p) * self.blocks[self.size_class(np.maximum(n, 1))] if self.p < 100 else np.ones_like(n)
        return 1 << np.ceil(np.log2(np.maximum(m, 8))).astype(np.int64)


def set_name(sets: np.ndarray, of: np.ndarray) -> np.ndarray:
    """64-bit fingerprint of every set."""
    total = np.concatenate([[U(0)], np.cumsum(mix(sets ^ STEP[7]))])
    return mix((total[of[1:]] - total[of[:-1]]) * STEP[8] + np.diff(of).astype(np.uint64))


def _keys(sets: np.ndarray, of: np.ndarray, b: Bounds) -> tuple[np.ndarray, np.ndarray]:
    """Keys of every set's blocks that hold something (own class and the next),
    and where each set's begin.  A set with no more such blocks than n-grams in
    which it may differ from a set of the class has its prefix as keys too."""
    n = np.diff(of)
    own = b.size_class(np.maximum(n, 1))
    ok = (n > 0) & b.linkable(n)
    content, spot = mix(sets ^ STEP[11]), mix(sets ^ STEP[13]) >> U(32)
    row = np.repeat(np.arange(len(n)), n)
    parts, short = [], np.zeros(len(n), bool)
    for step in (0, 1):
        tag = own + step
        m = np.where(ok, b.blocks[tag], 0)
        begin = np.concatenate([[0], np.cumsum(m)])
        use = ok[row]
        r = row[use]
        at = begin[r] + (spot[use] * m[r].astype(np.uint64) >> U(32)).astype(np.int64)
        total = np.zeros(int(begin[-1]), np.uint64)
        np.add.at(total, at, content[use])
        empty = np.ones(len(total), bool)
        empty[at] = False
        who = np.repeat(np.arange(len(n)), m)
        place = (np.arange(len(total)) - begin[who]).astype(np.uint64)
        key = mix(total + mix(place * STEP[17] + tag[who].astype(np.uint64) * STEP[19]))
        parts.append((who[~empty], key[~empty]))
        other = np.minimum(n * 100 // b.p, b.low[tag + 1] - 1)
        short |= ok & (np.bincount(who[~empty], minlength=len(n)) <= b.most(n + other))
    # Linked sets share ceil(p * n / 100) n-grams at least, so their prefixes meet.
    prefix = np.where(short, n + 1 + -b.p * n // 100, 0)
    first = np.arange(len(sets)) - of[:-1][row] < prefix[row]
    parts.append((row[first], mix(content[first] ^ STEP[29])))
    who = np.concatenate([p[0] for p in parts])
    key = np.concatenate([p[1] for p in parts])
    return key[np.argsort(who, kind="stable")], np.concatenate([[0], np.cumsum(np.bincount(who, minlength=len(n)))])


def _sketches(sets: np.ndarray, of: np.ndarray, b: Bounds) -> tuple[np.ndarray, np.ndarray]:
    n = np.diff(of)
    m = np.where((n > 0) & b.linkable(n), b.fine(n), 0)
    begin = np.concatenate([[0], np.cumsum(m // 8)])
    row = np.repeat(np.arange(len(n)), n)
    use = m[row] > 0
    r = row[use]
    # Low bits of the hash: folding halves of a sketch then halves its blocks.
    bit = (mix(sets[use] ^ STEP[23]) & (m[r] - 1).astype(np.uint64)).astype(np.int64)
    out = np.zeros(int(begin[-1]), np.uint8)
    np.bitwise_xor.at(out, begin[r] + bit // 8, (1 << (bit % 8)).astype(np.uint8))
    return out, begin


def fold(sketch: np.ndarray, m: int) -> np.ndarray:
    """A sketch (last axis) in ``m`` bytes, ``m`` a smaller power of two."""
    while sketch.shape[-1] > m:
        half = sketch.shape[-1] // 2
        sketch = sketch[..., :half] ^ sketch[..., half:]
    return sketch


def differing(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Parities in which sketches differ."""
    return np.bitwise_count(x ^ y).sum(-1, dtype=np.int64)


#: Stands for a null doc_id: nulls come last.
LAST = (1 << 63) - 1
NODES = "doc_id long, content long, n long, node long, sketch binary, keys binary"


#: Bytes of text that become arrays at once (n-grams and keys take some 50 times as
#: much), and rows of keys that are dealt at once.
SLICE = 1 << 20
DEALT = 2048


def _node_rows(k: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = Bounds(percent)
        for batch in batches:
            for s in text_slices(batch.column(2), SLICE):
                sets, of = shingles_of(words_of(s, placed=True), k)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[s.rows], batch.column(1)[s.rows], pa.array(np.diff(of)), pa.array(set_name(sets, of).view(np.int64)),
                     binary_list(*_sketches(sets, of, b)), binary_list(*_keys(sets, of, b))],
                    names=["doc_id", "content", "n", "node", "sketch", "keys"])
    return run


# ------------------------------------------------------- block exchange

ENTRY = np.dtype([("key", "<u4"), ("node", "<u8")])


def _deal(buckets: int):
    """(node, keys) rows to one packed row per bucket and batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(lo, DEALT) for b in batches for lo in range(0, b.num_rows, DEALT)):
            node = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            keys = [np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column(1)]
            if not keys:
                continue
            flat = np.concatenate(keys)
            order, of = bucketed(flat, buckets)
            out = np.empty(len(flat), ENTRY)
            out["key"] = flat.astype(np.uint32)[order]
            out["node"] = np.repeat(node, [len(x) for x in keys])[order]
            used = np.flatnonzero(np.diff(of))
            if len(used):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(used.astype(np.int32)), binary_list(out, np.append(of[used], len(out)))],
                    names=["bucket", "entries"])
    return run


RUNS = "block long, node long, pivot long, size long"


def _runs(table: pa.Table) -> pa.Table:
    """Blocks that different sets agree in: one row per block and set."""
    bucket = table.column("bucket")[0].as_py()
    e = np.concatenate([np.frombuffer(x.as_buffer(), ENTRY) for x in table.column("entries")])
    key = e["key"]
    order = np.argsort(key)
    key, node = key[order], e["node"][order]
    again = np.zeros(len(key) + 1, bool)
    again[1:-1] = key[1:] == key[:-1]
    shared = again[1:] | again[:-1]
    key, node = key[shared], node[shared]
    order = np.lexsort((node, key))
    key, node = key[order], node[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
    key, node = key[new], node[new]
    first = np.ones(len(key), bool)
    first[1:] = key[1:] != key[:-1]
    at = np.flatnonzero(first)
    size = np.diff(np.append(at, len(key)))
    size, pivot = np.repeat(size, size), np.repeat(node[at], size)
    keep = size > 1
    return pa.table({"block": (key[keep].astype(np.int64) | np.int64(bucket) << 32),
                     "node": node[keep].view(np.int64), "pivot": pivot[keep].view(np.int64),
                     "size": size[keep].astype(np.int64)})


# ------------------------------------------------------------ discarding

PAIR = "a long, b long"


def _discard(percent: int):
    """Keep cells whose sizes and sketches leave the similarity possible."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = Bounds(percent)
        for batch in batches:
            na, nb = (batch.column(c).to_numpy() for c in ("na", "nb"))
            keep = np.minimum(na, nb) * 100 >= np.maximum(na, nb) * percent
            most = b.most(na + nb)
            sa, sb = batch.column("sa"), batch.column("sb")
            for i in np.flatnonzero(keep):
                x, y = np.frombuffer(sa[i].as_buffer(), np.uint8), np.frombuffer(sb[i].as_buffer(), np.uint8)
                m = min(len(x), len(y))
                keep[i] = differing(fold(x, m), fold(y, m)) <= most[i]
            yield batch.select(["a", "b"]).filter(pa.array(keep))
    return run


def _pieces(members: DataFrame) -> DataFrame:
    """Members of blocks once for every chunk that they are compared with, and
    the ``unit`` (task) of each: units by the rows that this makes."""
    chunks = members.select("pivot", "node").distinct().groupBy("pivot").agg(
        F.ceil(F.count(F.lit(1)) / CHUNK).alias("chunks"))
    members = members.join(chunks, "pivot")
    units = (members.agg(F.sum("chunks")).first()[0] or 0) // UNIT_ROWS + 16
    return (members.withColumn("chunk", F.pmod(F.xxhash64("node"), "chunks"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
            .select("pivot", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"),
                    "block", "chunk", "node", "component", "n", "sketch")
            .withColumn("unit", F.pmod(F.xxhash64("pivot", "low", "high"), F.lit(units))))


def _cells(percent: int):
    """Cells between members of a block that are in different components.  A
    task holds all blocks that share a pivot, for two chunks of members, so a
    cell that recurs in them goes out once."""
    def run(table: pa.Table) -> pa.Table:
        b = Bounds(percent)
        unit = np.stack([table.column(c).to_numpy() for c in ("pivot", "low", "high", "block")])
        order = np.lexsort(unit[::-1])
        unit = unit[:, order]
        cuts = np.flatnonzero(np.append(True, (unit[:, 1:] != unit[:, :-1]).any(0)))
        node, comp, n, chunk = (table.column(c).to_numpy()[order] for c in ("node", "component", "n", "chunk"))
        sketch = table.column("sketch").combine_chunks()
        cells: set[tuple[int, int]] = set()
        for lo, hi in zip(cuts, np.append(cuts[1:], len(node))):
            rows = np.arange(lo, hi)
            left, right = rows[chunk[rows] == unit[1, lo]], rows[chunk[rows] == unit[2, lo]]
            have = [np.frombuffer(sketch[int(order[i])].as_buffer(), np.uint8) for i in rows]
            m = min(map(len, have))
            short = np.stack([fold(x, m) for x in have])
            for i in left:
                js = right[(right > i) | (unit[1, lo] != unit[2, lo])]
                js = js[(comp[js] != comp[i]) & (np.minimum(n[js], n[i]) * 100 >= np.maximum(n[js], n[i]) * percent)]
                if not len(js):
                    continue
                differ = differing(short[js - lo], short[i - lo])
                for j in js[differ <= b.most(n[js] + n[i])]:
                    x, y = have[i - lo], have[j - lo]
                    f = min(len(x), len(y))
                    if f == m or differing(fold(x, f), fold(y, f)) <= b.most(n[j] + n[i]):
                        cells.add((int(min(node[i], node[j])), int(max(node[i], node[j]))))
        out = sorted(cells)
        return pa.table({"a": pa.array([c[0] for c in out], pa.int64()), "b": pa.array([c[1] for c in out], pa.int64())})
    return run


# ---------------------------------------------------------- accumulation

def _vectors(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in text_slices(batch.column(0), SLICE):
                sets, of = shingles_of(words_of(s, placed=True), k)
                yield pa.RecordBatch.from_arrays([pa.array(set_name(sets, of).view(np.int64)), binary_list(sets, of)],
                                                 names=["node", "grams"])
    return run


def overlap(x: np.ndarray, y: np.ndarray, percent: int) -> int | None:
    """Common n-grams of two sorted sets, accumulated range by range; None as
    soon as the similarity is out of reach."""
    need = -(-percent * (len(x) + len(y)) // (100 + percent))
    edges = (np.arange(1, RANGES, dtype=np.uint64) << U(61)).astype(np.uint64)
    cx, cy = np.append(np.searchsorted(x, edges), len(x)), np.append(np.searchsorted(y, edges), len(y))
    got = px = py = 0
    for ex, ey in zip(cx.tolist(), cy.tolist()):
        got += len(np.intersect1d(x[px:ex], y[py:ey], assume_unique=True))
        px, py = ex, ey
        if got + min(len(x) - px, len(y) - py) < need:
            return None
    return got


def _accumulate(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ga, gb = batch.column("ga"), batch.column("gb")
            keep = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                x, y = np.frombuffer(ga[i].as_buffer(), np.uint64), np.frombuffer(gb[i].as_buffer(), np.uint64)
                both = overlap(x, y, percent)
                keep[i] = both is not None and 100 * both >= percent * (len(x) + len(y) - both)
            yield batch.select(["a", "b"]).filter(pa.array(keep))
    return run


def _place():
    """Columns that tell rows apart: doc_id with nulls last, hash of the text."""
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("place"),
            F.xxhash64(F.col("text").cast("string")).alias("content")]


def _linked(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """A row per input row: ``doc_id, content, n, node`` (fingerprint of its
    set), ``component`` (a node) and ``component_id``; the last two are null
    without n-grams."""
    spark = docs.sparkSession
    path = workspace(spark, "ngram_join")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _place()[1], F.col("text").cast("string").alias("text"))

    nodes = stored(docs.mapInArrow(trimmed(_node_rows(k, percent)), NODES), f"{path}/nodes")
    entries = nodes.agg(F.sum(F.octet_length("keys")) / 8).first()[0] or 0
    buckets = int(max(16, entries // BUCKET_ENTRIES + 1))
    dealt = nodes.where(F.octet_length("keys") > 0).select("node", "keys").mapInArrow(
        trimmed(_deal(buckets)), "bucket int, entries binary")
    runs = stored(dealt.groupBy("bucket").applyInArrow(_runs, RUNS), f"{path}/runs")
    release(spark)
    sets = stored(nodes.where("n > 0").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.min(F.struct(F.coalesce("doc_id", F.lit(LAST)).alias("place"), "content")).alias("at"), F.max("n").alias("n"),
        F.max("sketch").alias("sketch"))
        .join(runs.select("node").distinct().withColumn("shared", F.lit(True)), "node", "left"), f"{path}/sets")
    rows = stored(nodes.select("doc_id", "content", "n", "node"), f"{path}/rows")
    remove(spark, f"{path}/nodes")
    members = sets.where("shared").select("node", "n", "sketch")

    def discard(pairs: DataFrame) -> DataFrame:
        a = members.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
        b = members.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
        return pairs.join(a, "a").join(b, "b").mapInArrow(trimmed(_discard(percent)), PAIR)

    def links_of(pairs: DataFrame, name: str) -> DataFrame:
        ends = pairs.select(F.col("a").alias("node")).unionAll(pairs.select(F.col("b").alias("node"))).distinct()
        some = sets.join(ends, "node", "left_semi").select("at.place", "at.content").distinct()
        grams = stored(docs.select(*_place(), "text").join(some, ["place", "content"], "left_semi").select("text").mapInArrow(
            trimmed(_vectors(k)), "node long, grams binary").dropDuplicates(["node"]), f"{path}/grams_{name}")
        a = grams.select(F.col("node").alias("a"), F.col("grams").alias("ga"))
        b = grams.select(F.col("node").alias("b"), F.col("grams").alias("gb"))
        out = stored(pairs.join(a, "a").join(b, "b").mapInArrow(trimmed(_accumulate(percent)), PAIR), f"{path}/links_{name}")
        remove(spark, f"{path}/grams_{name}")
        return out

    star = runs.where("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    star = links_of(stored(discard(star), f"{path}/star"), "star")
    found = stored(components(star, f"{path}/star_components"), f"{path}/star_found")
    release(spark)

    # Members of one block in different components: compared chunk by chunk.
    known = runs.select("block", "node", "pivot").join(found, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    mixed = known.groupBy("block").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
    open_ = stored(known.join(mixed.select("block"), "block").join(members, "node"), f"{path}/open")
    cells = _pieces(open_).groupBy("unit").applyInArrow(_cells(percent), PAIR).distinct()
    rest = links_of(stored(cells, f"{path}/cells"), "rest")
    remove(spark, f"{path}/open")
    found = components(star.unionAll(rest), f"{path}/components")
    named = sets.select("node", F.col("doc_id").alias("least")).join(found, "node", "left")
    named = named.withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = stored(named.join(least, "component").select("node", "component", "component_id"), f"{path}/named")
    for name in ("runs", "sets"):
        remove(spark, f"{path}/{name}")
    release(spark)
    return rows.join(named, "node", "left")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """Components of documents linked by Jaccard similarity of their ``k``-word
    n-gram sets: 100 * intersection >= ``percent`` * union (0 < percent <= 100)."""
    return _linked(docs, k, percent).select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def op1_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """Links of all documents: 3-word n-grams, similarity 0.9 or more."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), k=3, percent=90)


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one row of each group of near duplicates (5-word
    n-grams, similarity 0.8 or more) stays, the one with the smallest doc_id
    (nulls last, then by fingerprint of n-grams and text)."""
    linked = _linked(docs, 5, 80).where("n > 0").select("component", "node", F.coalesce("doc_id", F.lit(LAST)).alias("place"), "content")
    keep = linked.groupBy("component").agg(F.min(F.struct("place", "node", "content")).alias("first")).select(
        "first.place", "first.content")
    inner = docs.select(*_place(), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    words = F.coalesce(F.col("row.text").cast("string"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    # Rows of one doc_id and text differ in other columns at most: one stays.
    first = inner.where(words).join(keep, ["place", "content"], "left_semi").groupBy("place", "content").agg(
        F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row"))
    return first.select("row.*").unionAll(inner.where(~words).select("row.*"))
