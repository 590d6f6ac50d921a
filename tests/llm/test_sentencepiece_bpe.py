import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sparkmart.llm import sentencepiece_bpe as sp


def m():
    return sp.model(sp.default_vocabulary())


PARTS = st.sampled_from([" ", "  ", "   ", "\n", "\t", "a", "the", "ing", "▁", "▁▁", "<s>", "<0x41>", ".", "..", "é", "漢", "🙂", "\x00", "\xa0",
                         "aaaa", "    ", "ﬁ", "　", "0000", "====", "\r\n", "ation"])


@settings(max_examples=500, deadline=None)
@given(st.lists(PARTS, max_size=16).map("".join) | st.text(max_size=40) | st.text(alphabet="abet ▁\n.", max_size=80))
def test_ids_and_text_are_the_library_s(text):
    ids = m().encode(text).tolist()
    assert ids == m().library.encode(text)
    assert m().decode(ids) == m().library.decode(ids)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 31999), max_size=12))
def test_any_ids_decode_as_in_the_library(ids):
    assert m().decode(ids) == m().library.decode(ids)


def test_unsplit_runs():
    rng = random.Random(2)
    for text in ["a" * 5000, "=" * 3001 + " " * 999 + "-" * 3000, "".join(rng.choice(["ab", "t", "he", "in"]) for _ in range(4000))]:
        assert m().encode(text).tolist() == m().library.encode(text)
        assert m().agrees(text) is True and own(text)[3] is True


def own(*texts):
    found = sp.digested(m(), list(texts))
    return found if len(texts) > 1 else found[0]


@pytest.mark.parametrize("piece", [1, 7, 50])
def test_parts_put_together(monkeypatch, piece):
    monkeypatch.setattr(sp, "PIECE", piece)
    rng = random.Random(piece)
    for _ in range(30):
        text = "".join(rng.choice(["a", "the ", " ", "  b", "▁ c", "\n x", " é", "漢 ", " \t d", "end"]) for _ in range(60))
        want = m().library.encode(text)
        assert m().encode(text).tolist() == want
        assert own(text) == (*digest(text), True) and m().agrees(text) is True


def test_cache_stays_bounded(monkeypatch):
    monkeypatch.setattr(sp, "CACHE_BYTES", 4000)
    small = sp.Model(sp.default_vocabulary())
    text = " ".join(f"w{i}x{i * 7}" for i in range(600)) + " w1x7 w2x14"
    for _ in range(2):
        assert small.encode(text).tolist() == small.library.encode(text)
    assert small.held <= 4000 and len(small.young) + len(small.old) < 80


def test_rows_side_by_side_are_agendas():
    rng = random.Random(6)
    runs = {"".join(rng.choice("▁abcdethingéñ.0") for _ in range(rng.randint(1, 32))) for _ in range(3000)}
    runs |= {"▁" * k for k in range(1, 32)} | {"漢a", "a🙂漢"}
    runs = sorted(runs)
    assert m().side_by_side(runs) == [m().one(r) for r in runs]


def test_a_wrong_encoding_is_seen(monkeypatch):
    wrong = sp.Model(sp.default_vocabulary())
    wrong.rank_of[wrong.id_of["▁the"]] = sp.NONE
    assert [x[3] for x in sp.digested(wrong, ["the end", "a b", ""])] == [False, True, True]


def test_runs_beyond_the_check_are_not_compared(monkeypatch):
    monkeypatch.setattr(sp, "CHECKED", 100)
    assert [x[3] for x in own("a" * 101, "b " * 40, "c")] == [None, True, True]


def digest(text):
    ids = m().library.encode(text)
    return (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(m().library.decode(ids).encode()).hexdigest())


def test_query_over_edge_rows(spark, docs, rows, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = sp.op13_sentencepiece_round_trip(spark, str(tmp_path))
    assert got.columns[:4] == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(((d, *digest(t or ""), True) for d, t, *_ in rows), key=repr)


def test_encode_and_decode_tables(spark, docs, rows):
    back = sp.decoded(sp.encoded(docs, sp.default_vocabulary()), sp.default_vocabulary())
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(((d, t or "") for d, t, *_ in rows), key=repr)


def test_empty_table(no_docs):
    assert sp.digests(no_docs, sp.default_vocabulary()).count() == 0
