import re
from collections import defaultdict

from sparkmart.llm import mixing


def brute_targets(size):
    order = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    total, capped = sum(size.values()), set()
    while True:
        left = total - sum(3 * size[s] for s in capped)
        free = sum(weight[s] for s in size if s not in capped)
        target = {s: 3 * size[s] if s in capped else left * weight[s] / free for s in size}
        over = {s for s in size if s not in capped and target[s] > 3 * size[s]}
        if not over:
            return target
        capped |= over


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0d]+", text or ""))


def test_targets_and_taken_words(docs, rows):
    got = mixing.queued(docs).collect()
    assert len(got) == len(rows)
    size = defaultdict(int)
    for r in rows:
        size[r[3]] += words(r[1])
    target = brute_targets(size)
    by_size = {(size[s], round(target[s], 6)): s for s in size}
    taken, longest = defaultdict(int), defaultdict(int)
    for r in got:
        s = by_size[r.source_size, round(r.target, 6)]
        assert 0 <= r.copies <= 3
        taken[s] += r.copies * r.size
        longest[s] = max(longest[s], r.size)
    assert sum(taken.values()) <= sum(size.values())
    top = max(longest.values())
    assert all(abs(taken[s] - target[s]) <= max(longest[s], top) for s in size)


def test_same_result_again_and_from_other_partitions(docs):
    once = sorted(map(tuple, mixing.queued(docs).collect()), key=repr)
    assert once == sorted(map(tuple, mixing.queued(docs.repartition(5)).collect()), key=repr)


def test_hot_source_over_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 20)
    rows = [(i, "w " * (1 + i % 9), "hot" if i % 3 else f"s{i % 4}") for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    size = defaultdict(int)
    for _, t, s in rows:
        size[s] += words(t)
    target = brute_targets(size)
    source = {i: s for i, _, s in rows}
    taken = defaultdict(int)
    for r in mixing.queued(df).collect():
        taken[source[r.doc_id]] += r.copies * r.size
    assert all(abs(taken[s] - target[s]) <= 20 for s in size)


def test_stage_repeats_rows(spark, docs, no_docs):
    want = defaultdict(int)
    for r in mixing.queued(docs).collect():
        want[r.doc_id] += r.copies
    out = mixing.stage(spark, docs, "")
    assert out.columns == docs.columns
    got = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert got == {k: v for k, v in want.items() if v}
    assert mixing.stage(spark, no_docs, "").count() == 0
