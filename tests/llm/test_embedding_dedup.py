import numpy as np
import pytest

from pyspark.sql import functions as F
from sparkmart.llm import embedding_dedup

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, least=0.98):
    ok = [(i, np.array(v, float), y) for i, v, y in rows
          if y is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    parent = {i: i for i, _, _ in rows}
    links = {i: 0 for i in parent}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in range(len(ok)):
        for b in range(a + 1, len(ok)):
            (i, x, p), (j, y, q) = ok[a], ok[b]
            if p == q and len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= least:
                links[i] += 1
                links[j] += 1
                lo, hi = sorted((root(i), root(j)))
                parent[hi] = lo
    return {i: (links[i], root(i), root(i) == i) for i in parent}


def vectors():
    rng = np.random.default_rng(4)
    rows = []
    for k in range(60):
        base = rng.normal(size=32)
        for c in range(k % 4):
            rows.append((len(rows), (base + rng.normal(size=32) * 0.03 * c).astype(np.float32).tolist(), k % 3))
    rows += [(500 + i, rows[5][1], rows[5][2]) for i in range(20)]
    rows += [(600, [2 * x for x in rows[5][1]], rows[5][2]), (601, rows[5][1], None), (602, None, 1), (603, [], 1), (604, [0.0] * 32, 1),
             (605, [float("nan")] + [1.0] * 31, 1), (606, [None] + [1.0] * 31, 1), (607, [float("inf")] + [1.0] * 31, 1),
             (608, [1.0, 2.0], 1), (609, [1.0, 2.0], 1)]
    return rows


def test_links_equal_brute_force(spark):
    rows = vectors()
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("size", "code", "cid", "v", "least"):
        df = df.withColumn(name, F.lit("x"))
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.linked(df).collect()}
    want = brute(rows)
    assert got.keys() == want.keys()
    found = sum(x[0] for x in got.values())
    assert found >= 0.9 * sum(x[0] for x in want.values())
    assert all(got[i][0] <= want[i][0] for i in got)          # no link below the threshold
    assert got == want


def test_empty_table(spark):
    assert embedding_dedup.linked(spark.createDataFrame([], SCHEMA)).count() == 0


def planted(dims, n=240, seed=9):
    """Pairs of a cosine from 0.98 to 0.99 among unrelated vectors of one label."""
    rng = np.random.default_rng(seed + dims)
    rows = []
    for _ in range(n):
        x, y = rng.normal(size=(2, dims))
        x /= np.linalg.norm(x)
        y -= (y @ x) * x
        y /= np.linalg.norm(y)
        c = rng.uniform(0.9801, 0.99)
        rows += [(len(rows), x.tolist(), 1), (len(rows) + 1, (c * x + np.sqrt(1 - c * c) * y).tolist(), 1)]
    return rows


def links(spark, rows, **how):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.linked(df, **how).collect()}


@pytest.mark.parametrize("dims", [16, 64])
def test_the_exact_way_misses_no_link(spark, dims):
    rows = planted(dims)
    want = brute(rows)
    assert sum(x[0] for x in want.values()) >= len(rows)
    assert links(spark, rows, exact=True) == want


@pytest.mark.parametrize("dims", [16, 64, 384])
def test_recall_by_default(spark, dims):
    rows = planted(dims)
    want, got = brute(rows), links(spark, rows)
    assert all(got[i][0] <= want[i][0] for i in got)
    assert sum(x[0] for x in got.values()) >= 0.9 * sum(x[0] for x in want.values())


def test_flips_are_all_sets_within_the_bound():
    square = np.random.default_rng(2).random((5, 7)) * 0.1
    row, mask = embedding_dedup._flips(square, 0.12)
    want = {(r, m) for r in range(5) for m in range(128) if sum(square[r, i] for i in range(7) if m >> i & 1) <= 0.12}
    assert set(zip(row.tolist(), mask.tolist())) == want and len(row) == len(want)


def test_null_and_repeated_ids(spark):
    v, w = [1.0, 2.0, 0.5], [-1.0, 0.3, 2.0]
    df = spark.createDataFrame([(None, v, 1), (4, v, 1), (4, v, 1), (None, w, 1), (7, w, 2)], SCHEMA)
    got = sorted((tuple(r) for r in embedding_dedup.linked(df).collect()), key=repr)
    assert got == sorted([(None, 2, 4, False), (4, 2, 4, True), (4, 2, 4, True), (None, 0, None, True), (7, 0, 7, True)], key=repr)
