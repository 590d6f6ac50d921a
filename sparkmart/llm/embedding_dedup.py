"""Embedding near-duplicates by iterative quantisation.

1. *Codes.*  Unit vectors are centred, projected on their principal axes and
   rotated so that the signs are balanced bits that lose least: alternating
   sign codes and orthogonal Procrustes fits (ITQ).  Axes and rotation are
   learned on at most ``SAMPLE`` distinct vectors (by hash of the id; the only
   bounded input); every vector is coded and indexed.
2. *Retrieval.*  A code is cut into substrings of ``WIDTH`` bits, one hash table
   each.  A probe visits its own bucket and all at Hamming distance one, so two
   codes that differ in at most ``2 * tables - 1`` bits meet for certain, and
   most that differ in a few more.  This may miss links (see ``linked``).
   The *exact way* misses none.  Vectors with cosine >= c lie within
   B = 2 - 2c (squared), so in one of T substrings they lie within B / T on its
   axes.  Bits that differ there cost both together no more than that in squared
   distances to the axes' zero, so one of the two pays at most B / 2T: it probes
   every set of flips up to that sum.  Substrings are as wide as the number of
   vectors has bits, so buckets stay small as the table grows.
3. *Rerank.*  Pairs that meet are compared by cosine of the original vectors
   in double precision; only those at or above the threshold are links.

Equal vectors of a label are one entry with a count, so copies are never
paired with each other; ``n_links`` adds the counts.

Edge cases: rows with a null label, a null, empty or zero vector, or null or
non-finite components link with nothing and are their own component;
vectors of different lengths link never; repeated vec_ids are rows of their
own and one vector when equal; a null vec_id is never a component's id unless
no other is there; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm._common import components, stored, workspace

SAMPLE = 20_000
BITS = 64
WIDTH = 16
ROUNDS = 50
#: Codes that differ in more bits than this are not reranked.
RADIUS = 16
#: Vectors whose exact probes a task makes at once.
FLIPPED = 64


class Itq:
    """Projection and rotation; ``code`` gives 64-bit codes."""

    def __init__(self, mean: np.ndarray, axes: np.ndarray):
        self.mean, self.axes = mean, axes

    @classmethod
    def fit(cls, x: np.ndarray, seed: int = 5) -> Itq:
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        mean = x.mean(0)
        bits = min(BITS, x.shape[1])
        _, vectors = np.linalg.eigh((x - mean).T @ (x - mean))
        axes = vectors[:, ::-1][:, :bits]
        v = (x - mean) @ axes
        r = np.linalg.qr(np.random.default_rng(seed).normal(size=(bits, bits)))[0]
        for _ in range(ROUNDS):
            b = np.where(v @ r >= 0, 1.0, -1.0)
            left, _, right = np.linalg.svd(b.T @ v)
            r = (left @ right).T
        return cls(mean, axes @ r)

    def project(self, x: np.ndarray) -> np.ndarray:
        return (x / np.linalg.norm(x, axis=1, keepdims=True) - self.mean) @ self.axes

    def code(self, x: np.ndarray) -> np.ndarray:
        bits = (self.project(x) >= 0).astype(np.uint64)
        return (bits << np.arange(bits.shape[1], dtype=np.uint64)).sum(1, dtype=np.uint64).view(np.int64)


def _rows(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _codes(model: dict[int, Itq]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column("size").to_numpy()
            code = np.zeros(batch.num_rows, np.int64)
            for d in np.unique(size):
                some = np.flatnonzero(size == d)
                if int(d) in model:
                    code[some] = model[int(d)].code(_rows(batch.column("v").take(pa.array(some))))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("cid", "label", "size")), pa.array(code)],
                                             names=["cid", "label", "size", "code"])
    return run


def _tables(bits: int, count: int) -> list[tuple[int, int]]:
    """Bit ranges of the substrings for ``count`` vectors, ``bits`` in all."""
    edges = np.linspace(0, bits, max(1, bits // max(8, count.bit_length())) + 1).astype(int)
    return list(zip(edges.tolist(), edges[1:].tolist()))


def _flips(square: np.ndarray, bound: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows and masks of all sets of bits whose squares sum up to the bound at most."""
    row, mask, total = np.arange(len(square)), np.zeros(len(square), np.int64), np.zeros(len(square))
    for i in range(square.shape[1]):
        more = total + square[row, i]
        fits = more <= bound
        row, mask = np.append(row, row[fits]), np.append(mask, mask[fits] | (1 << i))
        total = np.append(total, more[fits])
    return row, mask


MET = "label string, size int, t int, sub long, a long"


def _probes(model: dict[int, Itq], count: int, least: float, flip: bool):
    """Substrings of each vector, by table; with ``flip`` all that the exact way probes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, FLIPPED):
                batch = whole.slice(at, FLIPPED)
                size = batch.column("size").to_numpy()
                for d in np.unique(size):
                    some = np.flatnonzero(size == d)
                    v = model[int(d)].project(_rows(batch.column("v").take(pa.array(some))))
                    tables = _tables(v.shape[1], count)
                    for t, (lo, hi) in enumerate(tables):
                        part = v[:, lo:hi]
                        sub = ((part >= 0).astype(np.int64) << np.arange(hi - lo)).sum(1)
                        # a little above the bound, for rounding
                        row, mask = _flips(part ** 2, (1 - least) / len(tables) + 1e-9) if flip else (np.arange(len(sub)), 0)
                        of = pa.array(some[row])
                        yield pa.RecordBatch.from_arrays(
                            [batch.column("label").take(of), batch.column("size").take(of), pa.array(np.full(len(row), t, np.int32)),
                             pa.array(sub[row] ^ mask), batch.column("cid").take(of)], names=["label", "size", "t", "sub", "a"])
    return run


def _rerank(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column("size").to_numpy()
            keep = np.zeros(batch.num_rows, bool)
            for d in np.unique(size):
                some = np.flatnonzero(size == d)
                x, y = (_rows(batch.column(c).take(pa.array(some))) for c in ("x", "y"))
                cosine = np.einsum("ij,ij->i", x, y) / (np.linalg.norm(x, axis=1) * np.linalg.norm(y, axis=1))
                keep[some] = cosine >= least
            yield batch.select(["a", "b"]).filter(pa.array(keep))
    return run


def linked(vectors: DataFrame, least: float = 0.98, exact: bool | None = None) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of ``vectors (vec_id, embedding, label)``.

    ``exact`` retrieves by the exact way, which costs more probes (some 90 for
    each substring at up to ``BITS`` dimensions, far more beyond); if false,
    pairs whose codes differ in more than ``RADIUS`` bits, or in two bits of
    every substring, are missed.  By default vectors of fewer than ``BITS``
    dimensions, whose codes are too short for that, go the exact way.
    """
    spark = vectors.sparkSession
    path = workspace(spark, "embedding_dedup")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
                          F.col("embedding").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    valid = rows.where(F.col("label").isNotNull() & F.coalesce(finite & F.exists("v", lambda x: x != 0), F.lit(False)))
    classes = stored(valid.groupBy("label", "v").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("many"))
                     .withColumn("size", F.size("v")).withColumn("cid", F.xxhash64("label", "v")), f"{path}/classes")

    sample = classes.orderBy(F.xxhash64(F.lit(3), "cid"), "cid").limit(SAMPLE).select("size", "v").collect()
    by_size: dict[int, list] = {}
    for size, v in sample:
        by_size.setdefault(size, []).append(v)
    model = {size: Itq.fit(np.array(v)) for size, v in by_size.items()}
    codes = stored(classes.select("cid", "label", "size", "v").mapInArrow(
        _codes(model), "cid long, label string, size int, code long"), f"{path}/codes")

    strict = [d for d in model if exact or (exact is None and d < BITS)]
    every = codes
    codes = codes.where(~F.col("size").isin(strict)) if strict else codes

    tables = [(t, t * WIDTH) for t in range(max([1, *[-(-min(BITS, d) // WIDTH) for d in model if d not in strict]]))]
    part = F.explode(F.array(*[F.struct(F.lit(t).alias("t"), F.shiftrightunsigned("code", s).bitwiseAND(
        F.lit((1 << WIDTH) - 1)).alias("sub")) for t, s in tables]))
    index = codes.withColumn("p", part).select("label", "size", "p.t", "p.sub", "cid", "code")
    flips = F.explode(F.array(*[F.lit(m).cast("long") for m in [0, *[1 << i for i in range(WIDTH)]]]))
    probes = index.withColumn("flip", flips).select(
        "label", "size", "t", F.col("sub").bitwiseXOR(F.col("flip")).alias("sub"), F.col("cid").alias("a"),
        F.col("code").alias("code_a"))
    met = probes.join(index.select("label", "size", "t", "sub", F.col("cid").alias("b"), F.col("code").alias("code_b")),
                      ["label", "size", "t", "sub"])
    met = met.where((F.col("a") < F.col("b")) & (F.bit_count(F.col("code_a").bitwiseXOR(F.col("code_b"))) <= RADIUS))
    met = met.select("a", "b")
    if strict:
        long_way = classes.where(F.col("size").isin(strict)).select("cid", "label", "size", "v")
        count = every.count()
        own = long_way.mapInArrow(_probes(model, count, least, False), MET).withColumnRenamed("a", "b")
        flipped = long_way.mapInArrow(_probes(model, count, least, True), MET)
        met = met.unionAll(flipped.join(own, ["label", "size", "t", "sub"]).where("a <> b")
                           .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
    pairs = stored(met.distinct(), f"{path}/pairs")
    x = classes.select(F.col("cid").alias("a"), F.col("v").alias("x"), "size")
    y = classes.select(F.col("cid").alias("b"), F.col("v").alias("y"))
    links = stored(pairs.join(x, "a").join(y, "b").mapInArrow(_rerank(least), "a long, b long"), f"{path}/links")

    many = classes.select("cid", "many", "least")
    both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    partners = both.join(many.select(F.col("cid").alias("b"), "many"), "b").groupBy("a").agg(F.sum("many").alias("others"))
    found = components(links, f"{path}/components")
    named = (many.join(found, many.cid == found.node, "left").withColumn("component", F.coalesce("component", "cid")))
    least_of = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = (named.join(least_of, "component").join(partners.withColumnRenamed("a", "cid"), "cid", "left")
             .select("cid", (F.col("many") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id"))
    named = stored(named, f"{path}/named")
    keyed = rows.withColumn("cid", F.when(
        F.col("label").isNotNull() & F.coalesce(finite & F.exists("v", lambda z: z != 0), F.lit(False)), F.xxhash64("label", "v")))
    out = keyed.select("vec_id", "cid").join(named, "cid", "left").withColumn(
        "component_id", F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id")))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component_id",
                      F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op10_embedding_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Links of all embeddings of equal labels."""
    return linked(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
