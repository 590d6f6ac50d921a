import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sparkmart.llm import bpe


@pytest.fixture(scope="module")
def c():
    return bpe.Codec(bpe.default_vocabulary())


def library(c, text):
    return c.tok.encode(text, add_special_tokens=False).ids


PARTS = st.sampled_from([" ", "  ", "\n", "\t", "a", "the", "'s", "'t", "12", ".", "!?", "é", "漢", "🙂", "<|endoftext|>", "\x1f",
                         "\xa0", " ", "​", "͸"])


@settings(max_examples=400, deadline=None)
@given(st.lists(PARTS, max_size=14).map("".join) | st.text(max_size=40))
def test_ids_are_the_library_s(text):
    c = bpe.codec(bpe.default_vocabulary())
    assert c.encode(text).tolist() == library(c, text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 50256), max_size=12))
def test_decoding_is_the_library_s(ids):
    c = bpe.codec(bpe.default_vocabulary())
    assert c.decode(ids) == c.tok.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("size", [1, 3, 17, 200])
def test_tree_concatenation_is_exact(c, size):
    rng = random.Random(size)
    for _ in range(8):
        raw = "".join(rng.choice(["a", "b", "th", "ing", "ed", "x", "é"]) for _ in range(1500)).encode()
        assert c.concatenate([c.leaf(x) for x in bpe.leaves(raw, size)]).tolist() == c.leaf(raw).tolist()


def test_unsplit_text(c):
    for text in ["a" * 9000, "the" * 4000 + "!" * 5000 + "7" * 5000, "q" * 6000 + "<|endoftext|>" + "z" * 6000 + " tail"]:
        assert c.encode(text).tolist() == library(c, text)


def test_spark_pieces_and_edge_rows(spark, docs, rows, c, monkeypatch):
    monkeypatch.setattr(bpe, "LONG", 5000)
    monkeypatch.setattr(bpe, "PIECE", 3000)
    extra = [(9000, "word " * 900 + "x" * 14_000 + "<|endoftext|>" + " end" * 900, None, None, 0)]
    df = docs.select("doc_id", "text", "node").unionByName(
        spark.createDataFrame([(i, t, "x") for i, t, *_ in extra], "doc_id long, text string, node string"))
    got = sorted(map(tuple, bpe.digests(df, bpe.default_vocabulary()).collect()), key=repr)
    want = []
    for doc_id, text, *_ in rows + extra:
        ids = library(c, text or "")
        want.append((doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want, key=repr)


def test_empty_table(no_docs):
    assert bpe.digests(no_docs, bpe.default_vocabulary()).count() == 0
