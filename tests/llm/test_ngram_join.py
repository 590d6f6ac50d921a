import numpy as np
import pyarrow as pa
import pytest

from sparkmart.llm import ngram_join
from sparkmart.llm._common import text_slices, words_of
from tests.llm.conftest import links_by_brute_force


def shingles(text, k):
    w = (text or "").encode().lower().split()
    if len(w) < k:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(zip(*[w[j:] for j in range(k)]))


@pytest.mark.parametrize("k,percent", [(3, 90), (5, 80)])
def test_components_equal_brute_force(docs, rows, k, percent):
    got = ngram_join.near_duplicates(docs, k, percent).collect()
    assert len(got) == len(rows)
    sets = {r[0]: shingles(r[1], k) for r in rows if r[0] is not None}
    sets[None] = shingles(rows[-2][1], k)
    want = links_by_brute_force(sets, percent)
    for r in got:
        if r.doc_id is None:
            assert r.n_shingles in (0, len(sets[None]))
            assert r.component_id == (want[None] if r.n_shingles else None)
        else:
            assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), want[r.doc_id])
    assert len({want[k] for k in want}) < len(want)


def test_chunks_of_a_hot_block_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "CHUNK", 4)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(40):
        words = list(base)
        for j in range(i % 4):
            words[(7 * i + 13 * j) % 60] = f"x{i}-{j}"
        rows.append((i, " ".join(words)))
    got = {r.doc_id: r.component_id for r in ngram_join.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string"), 3, 90).collect()}
    assert got == links_by_brute_force({i: shingles(t, 3) for i, t in rows}, 90)


def test_words_of_one_pattern_stay_apart(spark):
    """Thue-Morse words: polynomials modulo 2^64 give both one fingerprint."""
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    other = word.translate(str.maketrans("ab", "ba"))
    rows = [(1, word), (2, other), (3, word.upper()), (4, f"{word} x"), (5, f"x {word}"), (6, f"{other}\t x ")]
    got = {r.doc_id: r.component_id for r in ngram_join.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string"), 3, 90).collect()}
    assert got == {1: 1, 2: 2, 3: 1, 4: 4, 5: 5, 6: 6}


def test_word_names_depend_on_the_word_alone():
    texts = ["one two", " two  one", "", "\u00e9n one\x0btwo", "one", "ONE tw", "o"]
    s, = text_slices(pa.array(texts))
    w = words_of(s, placed=True)
    found = [s.buf[a:b].tobytes().lower() for a, b in zip(w.begin, w.end)]
    assert found == [x for t in texts for x in t.encode().lower().split()]
    assert len(set(w.name.tolist())) == len(set(found)) == len(set(zip(found, w.name.tolist())))


def test_query_over_the_whole_table(spark, tmp_path, docs, rows):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    out = ngram_join.op1_ngram_jaccard_join(spark, str(tmp_path))
    assert out.columns[:3] == ["doc_id", "n_shingles", "component_id"]
    want = links_by_brute_force({r[0]: shingles(r[1], 3) for r in rows if r[0] is not None}, 90)
    assert sorted((r.doc_id, r.component_id) for r in out.where("doc_id is not null").collect()) == sorted(
        (r[0], want[r[0]]) for r in rows if r[0] is not None)


def test_empty_table(no_docs):
    out = ngram_join.near_duplicates(no_docs, 3, 90)
    assert out.columns == ["doc_id", "n_shingles", "component_id"] and out.count() == 0


def test_overlap_stops_only_out_of_reach():
    rng = np.random.default_rng(2)
    for _ in range(200):
        x = np.unique(rng.integers(0, 1 << 63, 50, dtype=np.uint64) * np.uint64(2))
        y = np.union1d(x[rng.random(len(x)) < 0.95], rng.integers(0, 1 << 63, rng.integers(0, 6), dtype=np.uint64))
        both = len(np.intersect1d(x, y))
        got = ngram_join.overlap(x, y, 90)
        assert got == both if 100 * both >= 90 * (len(x) + len(y) - both) else got in (None, both)


def test_stage_keeps_one_of_each_group(spark, docs, rows):
    kept = ngram_join.stage(spark, docs, "")
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    sets = {r[0]: shingles(r[1], 5) for r in rows if r[0] is not None}
    want = links_by_brute_force(sets, 80)
    assert sorted(i for i in ids if i is not None) == sorted(i for i in want if want[i] == i)


def test_stage_tells_rows_without_id_and_of_one_id_apart(spark):
    def text(name, *changed):
        return " ".join(f"{name}{i}" if i not in changed else f"{name}{i}new" for i in range(100))

    rows = [(1, text("a")), (None, text("a", 50)),                  # a copy without id goes
            (None, text("b")), (None, text("c")), (None, text("c", 40)),
            (5, text("d")), (5, text("a", 20)), (5, text("e")),     # a copy and two clean texts under one id
            (7, text("f", 99)), (7, text("f", 99)), (8, text("f")),
            (None, None), (None, ""), (9, " "), (9, "  ")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [tuple(r) for r in ngram_join.stage(spark, df, "").collect()]
    c = [r for r in kept if r in rows[3:5]]
    assert len(c) == 1                                              # one of two linked rows without id
    want = [rows[0], rows[2], *c, rows[5], rows[7], rows[8], *rows[11:]]
    assert sorted(kept, key=repr) == sorted(want, key=repr)


def test_sets_of_rows_without_id_are_linked(spark):
    a = " ".join(f"a{i}" for i in range(100))
    rows = [(None, a), (None, a.replace("a50 ", "x ")), (3, a.replace("a50 ", "x ").replace("a10 ", "y "))]
    got = ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90).collect()
    assert [r.component_id for r in got] == [3, 3, 3]


@pytest.mark.parametrize("percent", [80, 90])
def test_keys_of_linked_sets_meet_and_of_others_do_not(percent):
    rng = np.random.default_rng(7)
    b = ngram_join.Bounds(percent)

    def keys(*sets):
        flat, of = ngram_join._keys(np.concatenate(sets), np.cumsum([0, *map(len, sets)]), b)
        return [set(flat[x:y].tolist()) for x, y in zip(of, of[1:])]

    for _ in range(1500):
        n = int(rng.integers(5, 90))
        x = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        gone, more = rng.integers(0, n // 5 + 2, 2)
        y = np.union1d(x[gone:], rng.integers(0, 1 << 63, more, dtype=np.uint64))
        both = len(np.intersect1d(x, y))
        if 100 * both >= percent * (len(x) + len(y) - both) and len(np.setxor1d(x, y)):
            kx, ky = keys(x, y)
            assert kx & ky
    unrelated = [np.unique(rng.integers(0, 1 << 63, 60, dtype=np.uint64)) for _ in range(300)]
    every = [k for ks in keys(*unrelated) for k in ks]
    assert len(every) == len(set(every))


def test_tasks_get_a_bounded_number_of_rows(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "CHUNK", 16)
    monkeypatch.setattr(ngram_join, "UNIT_ROWS", 200)
    members = spark.range(600).selectExpr("1L as block", "0L as pivot", "id as node", "id as component", "60L as n",
                                          "cast('' as binary) as sketch")
    sizes = [r["count"] for r in ngram_join._pieces(members).groupBy("unit").count().collect()]
    assert sum(sizes) == 600 * 38 and max(sizes) < 800
