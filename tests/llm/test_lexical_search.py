import math
import random
import re

import numpy as np
import pytest

from pyspark.sql import functions as F
from sparkmart.llm import lexical_search as ls

ITEMS = "item_id long, text string"


def terms(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def brute(rows, items, k=10):
    bags = [(d, terms(t)) for d, t, *_ in rows]
    bags = [(d, b) for d, b in bags if b]
    n_docs, total = len(bags), sum(len(b) for _, b in bags)
    out = []
    for item_id, text in items:
        scored = []
        asked = terms(text)
        weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * sum(t in b for _, b in bags) + 1))) for t in set(asked)}
        for d, bag in bags:
            m = 100 - 75 + (75 * len(bag) * n_docs) // total
            score = sum(weight[t] * ((1000000000 * bag.count(t)) // (1000 * bag.count(t) + 8 * m)) for t in asked)
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(item_id, r + 1, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored)[:k])]
    return out


def items(rows):
    rng = random.Random(8)
    texts = [t for _, t, *_ in rows if t and len(t) > 50]
    made = [" ".join(rng.choice(texts).split(" ")[:rng.choice([1, 3, 20, 60])]) for _ in range(25)]
    made += [None, "", "...", "nowhere", "changed", "one ONE Two", "é 漢字 Ñ", "one " * 50]
    return [(7 * i, t) for i, t in enumerate(made)] + [(0, made[0]), (0, "changed"), (None, "one")]


def tuples(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_ranks_equal_brute_force(spark, docs, rows):
    asked = items(rows)
    queries = spark.createDataFrame(asked, ITEMS).withColumn("doc_id", F.lit("x")).withColumn("score", F.lit("x"))
    got = ls.search(docs.withColumn("item", F.lit("x")).withColumn("score", F.lit("x")), queries)
    assert tuples(got) == sorted(brute(rows, asked), key=repr)


def test_chunks_blocks_and_pieces(spark, docs, rows, monkeypatch):
    """Many query chunks, small blocks, and texts in many pieces."""
    monkeypatch.setattr(ls, "QUERY_BYTES", 4000)
    asked = items(rows)[-14:]
    original = ls._index

    def index(found):
        def run(batches):
            ls.PIECE, ls.BLOCK = 200, 16                       # in the worker process, for this scan
            try:
                yield from original(found)(batches)
            finally:
                ls.PIECE, ls.BLOCK = 1 << 20, 4096
        return run
    monkeypatch.setattr(ls, "_index", index)
    assert tuples(ls.search(docs, spark.createDataFrame(asked, ITEMS))) == sorted(brute(rows, asked), key=repr)


def test_bounds_are_never_below_the_scores(monkeypatch):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choices(words[:rng.randint(1, 60)], k=rng.randint(1, 400))) for _ in range(64)]
    q = ls._chunk([(i, " ".join(rng.choices([*words, "absent"], k=rng.randint(1, 30)))) for i in range(12)])
    for piece in (1 << 20, 64):
        monkeypatch.setattr(ls, "PIECE", piece)
        parts = [ls._document(t, q.terms) for t in texts]
        corpus = ls.Corpus(len(texts), sum(p[0] for p in parts), np.array([100 + 7 * i for i in range(len(q.terms))]))
        block = ls.Block(9)
        for i, (n, top, levels, held) in enumerate(parts):
            assert n == len(terms(texts[i])) and held == {t.encode() for t in terms(texts[i])} & q.terms.keys()
            block.add(i, n, top, levels)
        row = block.row()
        loose = 0
        for i, bound in ls.bounds(q, corpus, 9, row["n"], row["top"], row["slices"]):
            for d, text in enumerate(texts):
                tf = np.array([terms(text).count(t.decode()) for t in q.terms])
                part = corpus.weight * ls._gain(tf, np.int64(corpus.length(row["n"][d])))
                score = int(part[q.places[i]] @ q.repeats[i])
                assert bound[d] >= score
                loose += bound[d] > 2 * score + 1
        assert loose < 12 * 64 // 2 or piece == 64


@pytest.mark.parametrize("size", [1, 10, 1000])
def test_terms_of_pieces(monkeypatch, size):
    monkeypatch.setattr(ls, "PIECE", size)
    text = "Ab  c-d ÉÉ漢 x1y2 " * 40 + "z" * 3000 + "\x00\x7f end"
    got = sum(ls.term_counts(text), ls.Counter())
    assert got == ls.Counter(t.encode() for t in terms(text))
    assert list(ls.term_counts(None)) == [] == list(ls.term_counts(""))


def test_empty_tables(spark, docs, no_docs):
    queries = spark.createDataFrame([(1, "one two")], ITEMS)
    assert ls.search(no_docs, queries).count() == 0
    assert ls.search(docs, queries.limit(0)).count() == 0
