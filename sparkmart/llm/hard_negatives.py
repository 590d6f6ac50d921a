"""Hard-negative mining: exact integer products of anchors and candidates.

Rows are anchors, candidates or both.  An anchor's *positives* are its best other
rows of the same label by inner product; each positive opens a *window* of
scores, and the best rows of other labels inside it are its hard negatives.

1. Vectors are integers.  Candidates and anchors are range-partitioned by length
   and label into blocks of a bounded size; a hot label spans many blocks.
2. A cell is one block of anchors beside one of candidates.  Inside, int64 tiles
   padded with zeros are multiplied by Strassen's recursion: seven products of
   halves instead of eight, and integer additions.  Sums wrap modulo 2^64, so
   every score that fits a 64-bit integer is exact whatever its parts were.
3. A cell keeps per anchor (and window) a heap of its best entries, merged tile
   by tile; heaps of different cells are merged by Spark's windowed top-k, which
   cuts each map task's entries before the shuffle.  Positives need only the
   cells that share a label, negatives the whole grid: the anchors are the
   stated query set, and every candidate meets them in blocks.

Edge cases: rows with a null label, a null vector, a null or non-finite component
or one beyond 64 bits take no part; vectors of different lengths don't meet (an
empty one meets the empty ones, at score 0); equal scores go by vec_id, null
last; repeated vec_ids are rows of their own, each the other's candidate, and a
repeated anchor returns its rows as often; an anchor without positives or without
negatives in a window returns none; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.llm._common import stored, workspace

#: Bytes of 64-bit components in one block of candidates or of anchors.
BLOCK_BYTES = 48 << 20
#: Rows of a tile of anchors and of candidates.
ANCHORS, CANDIDATES = 256, 1024
#: Halves are multiplied outright once a side is no longer than this.
LEAF = 32


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b`` of int64 matrices, modulo 2^64."""
    m, k, n = a.shape[0], a.shape[1], b.shape[1]
    if min(m, k, n) <= LEAF:
        return a @ b
    if m % 2 or k % 2 or n % 2:
        a = np.pad(a, ((0, m % 2), (0, k % 2)))
        b = np.pad(b, ((0, k % 2), (0, n % 2)))
        return strassen(a, b)[:m, :n]
    m, k, n = m // 2, k // 2, n // 2
    a11, a12, a21, a22 = a[:m, :k], a[:m, k:], a[m:, :k], a[m:, k:]
    b11, b12, b21, b22 = b[:k, :n], b[:k, n:], b[k:, :n], b[k:, n:]
    p1 = strassen(a11 + a22, b11 + b22)
    p2 = strassen(a21 + a22, b11)
    p3 = strassen(a11, b12 - b22)
    p4 = strassen(a22, b21 - b11)
    p5 = strassen(a11 + a12, b22)
    p6 = strassen(a21 - a11, b11 + b12)
    p7 = strassen(a12 - a22, b21 + b22)
    out = np.empty((2 * m, 2 * n), np.int64)
    out[:m, :n] = p1 + p4 - p5 + p7
    out[:m, n:] = p3 + p5
    out[m:, :n] = p2 + p4
    out[m:, n:] = p1 - p2 + p3 + p6
    return out


class Heaps(NamedTuple):
    """The best entries of many slots, ordered by slot and best first."""
    slot: np.ndarray
    score: np.ndarray
    vec_id: np.ndarray
    null: np.ndarray

    @classmethod
    def empty(cls) -> Heaps:
        return cls(*(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, bool)))

    def merge(self, other: Heaps, size: int) -> Heaps:
        """Both together, at most ``size`` entries a slot: highest score first,
        then smallest vec_id, null last."""
        x = Heaps(*(np.concatenate(c) for c in zip(self, other)))
        order = np.lexsort((x.vec_id, x.null, ~x.score, x.slot))
        x = Heaps(*(c[order] for c in x))
        first = np.searchsorted(x.slot, x.slot)
        keep = np.arange(len(x.slot)) - first < size
        return Heaps(*(c[keep] for c in x))

    def floor(self, slots: int, size: int) -> np.ndarray:
        """What a score must reach to enter each slot: its last entry's where
        the slot is full."""
        out = np.full(slots, np.iinfo(np.int64).min)
        last = np.flatnonzero(np.arange(len(self.slot)) - np.searchsorted(self.slot, self.slot) == size - 1)
        out[self.slot[last]] = self.score[last]
        return out


class Side(NamedTuple):
    """Rows of one vector length: matrix, label codes, row keys, ids and
    their places in the cell's table."""
    x: np.ndarray
    label: np.ndarray
    row: np.ndarray
    vec_id: np.ndarray
    null: np.ndarray
    at: np.ndarray


def _sides(left: pa.Table, right: pa.Table):
    """Anchors and candidates of equal lengths, label codes shared."""
    both = pa.chunked_array([*left.column("label").chunks, *right.column("label").chunks], pa.string())
    code = both.combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
    parts = []
    for table, label in ((left, code[:left.num_rows]), (right, code[left.num_rows:])):
        dim = table.column("dim").to_numpy()
        row, ids = table.column("row").to_numpy(), table.column("vec_id")
        null = ids.is_null().to_numpy()
        vec_id = ids.fill_null(0).to_numpy()
        sides = {}
        for d in np.unique(dim):
            at = np.flatnonzero(dim == d)
            v = table.column("v").take(pa.array(at)).combine_chunks()
            x = v.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(at), int(d))
            sides[int(d)] = Side(x, label[at], row[at], vec_id[at], null[at], at)
        parts.append(sides)
    for d in parts[0].keys() & parts[1].keys():
        yield parts[0][d], parts[1][d]


def _tiles(n: int, size: int):
    return [slice(i, min(i + size, n)) for i in range(0, n, size)]


def _padded(x: np.ndarray, rows: int) -> np.ndarray:
    return np.pad(x, ((0, rows - len(x)), (0, 0))) if len(x) < rows else x


def _scores(a: Side, c: Side, i: slice, j: slice) -> np.ndarray:
    """Scores of a tile of anchors and one of candidates, without padding."""
    s = strassen(_padded(a.x[i], min(ANCHORS, len(a.x))), _padded(c.x[j], min(CANDIDATES, len(c.x))).T)
    return s[:i.stop - i.start, :j.stop - j.start]


def _found(left: pa.Table, parts: list[tuple[np.ndarray, np.ndarray, Heaps]]) -> pa.Table:
    """One row per heap entry: its anchor, window, score and vec_id."""
    at = np.concatenate([np.zeros(0, np.int64), *[p[0] for p in parts]])
    no = np.concatenate([np.zeros(0, np.int64), *[p[1] for p in parts]])
    h = Heaps(*(np.concatenate(c) for c in zip(Heaps.empty(), *[p[2] for p in parts])))
    return pa.table({"a": left.column("row").take(pa.array(at)), "anchor_id": left.column("vec_id").take(pa.array(at)),
                     "no": pa.array(no, pa.int32()), "score": pa.array(h.score), "vec_id": pa.array(h.vec_id, mask=h.null)})


FOUND = "a long, anchor_id long, no int, score long, vec_id long"


def _best_same(size: int):
    """Cell function: each anchor's best rows of its label."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = []
        for a, c in _sides(left, right):
            for i in _tiles(len(a.x), ANCHORS):
                heaps = Heaps.empty()
                for j in _tiles(len(c.x), CANDIDATES):
                    same = a.label[i][:, None] == c.label[j][None, :]
                    if not same.any():
                        continue
                    s = _scores(a, c, i, j)
                    same &= (a.row[i][:, None] != c.row[j][None, :]) & (s >= heaps.floor(len(s), size)[:, None])
                    p, q = np.nonzero(same)
                    heaps = heaps.merge(Heaps(p, s[p, q], c.vec_id[j][q], c.null[j][q]), size)
                parts.append((a.at[i][heaps.slot], np.zeros(len(heaps.slot), np.int64), heaps))
        return _found(left, parts)
    return run


def bounds(scores: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest integer s with ``low * score <= 100 * s <= high *
    score`` without the products' overflow."""
    q, r = scores // 100, scores % 100
    return q * low + -(-r * low // 100), q * high + r * high // 100


def _best_other(size: int, low: int, high: int):
    """Cell function: each window's best rows of other labels."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = []
        lists = left.column("scores").combine_chunks()
        count = np.diff(lists.offsets.to_numpy())
        width = int(count.max(initial=0))
        opened = np.arange(width)[None, :] < count[:, None]
        score = np.zeros(opened.shape, np.int64)
        score[opened] = lists.flatten().to_numpy()
        least, most = bounds(score, low, high)
        least[~opened], most[~opened] = np.iinfo(np.int64).max, np.iinfo(np.int64).min
        for a, c in _sides(left, right):
            for i in _tiles(len(a.x), ANCHORS):
                heaps = Heaps.empty()
                lo, hi = least[a.at[i]], most[a.at[i]]
                for j in _tiles(len(c.x), CANDIDATES):
                    other = a.label[i][:, None] != c.label[j][None, :]
                    if not other.any():
                        continue
                    s = _scores(a, c, i, j)
                    bar = np.maximum(lo, heaps.floor(lo.size, size).reshape(lo.shape))
                    p, q = np.nonzero(other & (s >= bar.min(1)[:, None]) & (s <= hi.max(1)[:, None]))
                    v = s[p, q]
                    e, w = np.nonzero((v[:, None] >= bar[p]) & (v[:, None] <= hi[p]))
                    heaps = heaps.merge(Heaps(p[e] * width + w, v[e], c.vec_id[j][q[e]], c.null[j][q[e]]), size)
                if width:
                    parts.append((a.at[i][heaps.slot // width], heaps.slot % width, heaps))
        return _found(left, parts)
    return run


def _blocks(rows: DataFrame, least: int, path: str) -> tuple[DataFrame, int]:
    """Rows in blocks of about ``BLOCK_BYTES``, ordered by length and label,
    stored; and the number of blocks.  However many ranges the session makes,
    neighbouring ones share a block."""
    total = rows.agg(F.sum(F.col("dim").cast("long") * 8 + 16)).first()[0] or 0
    n = int(max(least, total // BLOCK_BYTES + 1))
    dealt = stored(rows.repartitionByRange(n, "dim", "label", "row").withColumn("range", F.spark_partition_id()), path)
    ranges = (dealt.agg(F.max("range")).first()[0] or 0) + 1
    n = min(n, ranges)
    return dealt.withColumn("block", F.expr(f"cast(cast(range as bigint) * {n} div {ranges} as int)")).drop("range"), n


def _top(found: DataFrame, size: int) -> DataFrame:
    order = Window.partitionBy("a", "no").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)


def mine(vectors: DataFrame, anchor: Column, positives: int = 5, negatives: int = 5,
         low: int = 80, high: int = 100) -> DataFrame:
    """Hard negatives of ``vectors (vec_id, label, v)`` with integer ``v``.

    ``anchor`` marks the anchors.  Returns ``anchor_id, positive_id, rank,
    negative_id, positive_score, negative_score``: for each anchor and each of
    its first ``positives`` rows of the same label the first ``negatives`` rows
    of other labels whose score lies between ``low`` and ``high`` percent of the
    positive's.
    """
    spark = vectors.sparkSession
    path = workspace(spark, "hard_negatives")
    whole = F.forall("v", lambda x: x.isNotNull())
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), "v",
                          F.coalesce(anchor, F.lit(False)).alias("anchor"))
    rows = rows.where(F.col("label").isNotNull() & F.coalesce(whole, F.lit(False)))
    rows = stored(rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", F.size("v").alias("dim"), "v",
                              "anchor"), f"{path}/rows")
    # Components cross the exchange in the smallest type that holds them all.
    top = F.array_max(F.transform("v", lambda x: F.greatest(x, -1 - x)))
    most = rows.agg(F.max(top)).first()[0] or 0
    kind = "smallint" if most < 1 << 15 else "int" if most < 1 << 31 else "bigint"
    narrow = rows.withColumn("v", F.col("v").cast(f"array<{kind}>"))
    slots = spark.sparkContext.defaultParallelism
    candidates, n = _blocks(narrow.drop("anchor"), slots, f"{path}/candidates")
    anchors, m = _blocks(narrow.where("anchor").drop("anchor"), 1, f"{path}/anchors")
    candidates, anchors = candidates.withColumnRenamed("block", "c_block"), anchors.withColumnRenamed("block", "a_block")
    cell = ["a_block", "c_block"]

    def over(left: DataFrame, right: DataFrame, function) -> DataFrame:
        right = right.select(*[F.col(c).alias(c) for c in right.columns])           # columns of its own, not the anchors'
        left, right = (df.repartition(n * m, *cell) for df in (left, right))
        return left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(function, FOUND)

    # Positives: each anchor goes to the blocks that hold its label and length.
    where = candidates.select("dim", "label", "c_block").distinct()
    left = anchors.join(where, ["dim", "label"])
    cells = stored(left.select(*cell).distinct(), f"{path}/cells")
    found = over(left, candidates.join(cells, "c_block"), _best_same(positives))
    found = stored(_top(found, positives).select("a", "anchor_id", F.col("rank").alias("no"), F.col("vec_id").alias("positive_id"),
                                                 F.col("score").alias("positive_score")), f"{path}/positives")
    # Negatives: every cell of the grid.
    scores = found.groupBy(F.col("a").alias("row")).agg(F.transform(
        F.array_sort(F.collect_list(F.struct("no", "positive_score"))), lambda x: x.positive_score).alias("scores"))
    windows = anchors.join(scores, "row")
    left = windows.withColumn("c_block", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    right = candidates.withColumn("a_block", F.explode(F.sequence(F.lit(0), F.lit(m - 1))))
    best = _top(over(left, right, _best_other(negatives, low, high)), negatives).select(
        "a", (F.col("no") + 1).alias("no"), F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        F.col("score").alias("negative_score"))
    return found.join(best, ["a", "no"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def scaled(column: str, scale: int = 256) -> Column:
    """``floor(scale * x)`` of every component as 64-bit integers; null if a
    component is null, not finite or too large."""
    fits = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * scale) < float(1 << 63)))
    return F.when(fits, F.transform(column, lambda x: F.floor(x.cast("double") * scale)))


def op11_hard_negatives(spark, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector among all embeddings."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.select("vec_id", label.alias("label"), scaled("embedding").alias("v")), F.col("vec_id") % 100 == 0)


ORACLE = """
WITH r AS (
  SELECT vec_id, row_number() OVER () AS row, CASE vec_id % 7 WHEN 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.row AS a, a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_dot_product(a.v, c.v) AS BIGINT) AS score
  FROM r a, r c WHERE a.vec_id % 100 = 0 AND a.row <> c.row),
p AS (
  SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id) AS no FROM s WHERE same QUALIFY no <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.a, p.no ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.a = p.a AND NOT n.same AND 80 * p.score <= 100 * n.score AND n.score <= p.score
QUALIFY rank <= 5"""
