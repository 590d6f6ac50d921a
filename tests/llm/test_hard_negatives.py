import random

import numpy as np
import pytest

from pyspark.sql import functions as F
from sparkmart.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("m,k,n", [(1, 1, 1), (33, 65, 40), (256, 64, 1000), (70, 131, 97), (5, 0, 7)])
def test_strassen_is_the_integer_product(m, k, n):
    rng = np.random.default_rng(m + k + n)
    a, b = rng.integers(-1 << 20, 1 << 20, (m, k)), rng.integers(-1 << 20, 1 << 20, (k, n))
    assert (hn.strassen(a, b) == a @ b).all()


def test_strassen_wraps_modulo_two_to_the_64():
    rng = np.random.default_rng(1)
    a, b = (rng.integers(-1 << 62, 1 << 62, s) for s in ((80, 80), (80, 80)))
    want = np.array([[sum(int(x) * int(y) for x, y in zip(r, c)) % (1 << 64) for c in b.T[:5]] for r in a[:5]], dtype=object)
    assert (hn.strassen(a, b)[:5, :5].astype(np.uint64).astype(object) == want).all()


def test_bounds_are_exact():
    scores = np.array([*range(-250, 250), (1 << 62) + 7, -(1 << 62) - 3])
    lo, hi = hn.bounds(scores, 80, 100)
    assert lo.tolist() == [-(-80 * int(s) // 100) for s in scores]
    assert hi.tolist() == scores.tolist()


def test_heaps_merge_in_any_order():
    rng = np.random.default_rng(2)
    parts = [hn.Heaps(rng.integers(0, 5, 30), rng.integers(0, 6, 30), rng.integers(0, 9, 30), rng.random(30) < 0.1) for _ in range(6)]
    results = []
    for order in (range(6), reversed(range(6))):
        h = hn.Heaps.empty()
        for i in order:
            h = h.merge(parts[i], 4)
        results.append([(s, v, None if z else i) for s, v, i, z in zip(*(c.tolist() for c in h))])
    assert results[0] == results[1]
    assert all(sum(x[0] == s for x in results[0]) <= 4 for s in range(5))


def brute(rows, every=100, size=5):
    """(anchor, positive, rank, negative, positive score, negative score) by plain loops."""
    known = []
    for i, v, y in rows:
        if y is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        y = (y + 1) % 10 if i is not None and i % 7 == 0 else y
        known.append((i, [int(np.floor(256 * float(x))) for x in v], y))
    out = []
    best = lambda found: sorted(found, key=lambda e: (-e[0], e[1] is None, e[1]))
    for a, (i, v, y) in enumerate(known):
        if i is None or i % every:
            continue
        score = [(sum(p * q for p, q in zip(v, w)), j, z == y) for b, (j, w, z) in enumerate(known) if b != a and len(w) == len(v)]
        for s, j, _ in best([e for e in score if e[2]])[:size]:
            inside = best([e for e in score if not e[2] and 80 * s <= 100 * e[0] <= 100 * s])[:size]
            out += [(i, j, r + 1, k, s, t) for r, (t, k, _) in enumerate(inside)]
    return out


def vectors():
    rng = random.Random(5)
    rows = [(i, [rng.uniform(-0.6, 1) for _ in range(7)], rng.choice([0, 1, 2, 9])) for i in range(420)]
    rows += [(i, rows[3][1], rng.choice([0, 1])) for i in range(700, 740)]                       # copies: ties by vec_id
    rows += [rows[100], rows[100], rows[9]]                                                      # repeated rows, an anchor's too
    rows += [(900, None, 1), (901, [1.0] * 7, None), (902, [None] + [1.0] * 6, 1), (1000, [float("nan")] * 7, 1),
             (1100, [float("inf")] * 7, 1), (1200, [], 1), (1201, [], 2), (1202, [], 1), (1300, [0.5, 0.25], 1), (1301, [0.5, 0.2], 2),
             (1302, [0.5, 0.3], 1), (None, [0.9] * 7, 1), (None, [0.9] * 7, 2), (2000, [9.0] * 9, 4), (-100, [0.1] * 7, 1)]
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], y) for i, v, y in rows]


def mined(df):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hn.mine(df.select("vec_id", label.alias("label"), hn.scaled("embedding").alias("v")), F.col("vec_id") % 100 == 0)


@pytest.mark.parametrize("tiles", [(256, 1024), (2, 5)])
def test_negatives_equal_brute_force(spark, monkeypatch, tiles):
    rows = vectors()
    if tiles[0] == 2:
        monkeypatch.setattr(hn, "BLOCK_BYTES", 6000)
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(map(tuple, mined(df).collect()), key=repr)
    assert got == sorted(brute(rows), key=repr)


def test_small_tiles_and_extra_columns(spark, tmp_path):
    rows = vectors()
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("row", "v", "dim", "block", "anchor", "a", "no", "score", "rank", "a_block"):
        df = df.withColumn(name, F.lit("x"))
    df.write.parquet(str(tmp_path / "embeddings.parquet"))
    got = hn.op11_hard_negatives(spark, str(tmp_path))
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute(rows), key=repr)


def test_cells_with_small_tiles(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(hn, "ANCHORS", 3)
    monkeypatch.setattr(hn, "CANDIDATES", 4)
    rng = np.random.default_rng(3)
    x = rng.integers(-5, 6, (40, 6))
    label = [str(k) for k in rng.integers(0, 3, 40)]
    table = pa.table({"row": pa.array(range(40)), "vec_id": pa.array([*range(39), None]), "label": label, "dim": pa.array([6] * 40, pa.int32()),
                      "v": pa.array(x.tolist(), pa.list_(pa.int64()))})
    found = hn._best_same(5)(table, table).to_pylist()
    for a in range(40):
        best = sorted(((-int(x[a] @ x[b]), b == 39, b) for b in range(40) if b != a and label[a] == label[b]))[:5]
        assert [(e["score"], e["vec_id"]) for e in found if e["a"] == a] == [(-s, None if z else b) for s, z, b in best]


def test_empty_table(spark):
    assert mined(spark.createDataFrame([], SCHEMA)).count() == 0
