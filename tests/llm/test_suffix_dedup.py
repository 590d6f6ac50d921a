import hashlib

import numpy as np
import pyarrow as pa

from sparkmart.llm import suffix_dedup


def brute(rows, length=50):
    """Spans each row loses, by every window of all smaller doc_ids."""
    first = {}
    for doc_id, text in rows:
        raw = (text or "").encode()
        for i in range(len(raw) - length + 1):
            w = raw[i:i + length]
            order = float("inf") if doc_id is None else doc_id
            first[w] = min(first.get(w, float("inf")), order)
    out = []
    for doc_id, text in rows:
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - length + 1):
            if first[raw[i:i + length]] < (float("inf") if doc_id is None else doc_id):
                gone[i:i + length] = True
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()) if len(raw) else 0
        out.append((doc_id, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def digests(docs):
    return [tuple(r) for r in suffix_dedup._with_spans(docs, 50).select("doc_id", "text", "spans").mapInArrow(
        suffix_dedup._digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string").collect()]


def test_cover_reaches_every_difference():
    m = suffix_dedup.MODULUS
    assert {(a - b) % m for a in suffix_dedup.COVER for b in suffix_dedup.COVER} == set(range(m))


def test_equal_to_brute_force(docs, rows):
    want = brute([r[:2] for r in rows])
    assert sorted(digests(docs), key=repr) == sorted(want, key=repr)
    assert any(r[2] and r[2] < r[1] for r in want)


def test_every_alignment_is_found(spark):
    shared = "".join(chr(97 + (i * i + i // 7) % 26) for i in range(50))
    rows = [(0, "0" * 11 + shared + "1" * 5)] + [(i + 1, chr(65 + i) * (i + 3) + shared + chr(65 + i) * 4) for i in range(24)]
    got = {r[0]: r[2] for r in digests(spark.createDataFrame(rows, "doc_id long, text string"))}
    assert got == {0: 0, **{i + 1: 50 for i in range(24)}}


def test_blocks_of_a_long_text(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK", 420)
    rng = np.random.default_rng(1)
    text = "".join(map(chr, rng.integers(97, 123, 3000)))
    rows = [(1, text), (2, text[100:2500]), (3, text[390:450] + "#" + text[800:870])]
    assert sorted(digests(spark.createDataFrame(rows, "doc_id long, text string"))) == sorted(brute(rows))


def test_stage_cuts_text_and_keeps_columns(docs, no_docs):
    out = suffix_dedup.deduplicated(docs)
    assert out.columns == docs.columns
    assert all(r.n_chars == len(r.text) and r.text.strip() for r in out.collect())
    assert suffix_dedup.deduplicated(no_docs).count() == 0


def test_equal_names_of_different_strings_are_no_repeat():
    """Two texts hold strings whose first names clash; a third repeats one."""
    owner, order, name = np.array([11, 12, 13]), np.array([1, 2, 3]), np.full(3, 5, np.uint64)
    check = np.array([70, 71, 70], np.uint64)
    raw = suffix_dedup.pack(owner, np.array([0, 4, 9]), name, order, check)
    table = pa.table({"bucket": pa.array([0], pa.int32()), "entries": pa.array([raw], pa.binary())})
    out = suffix_dedup._repeats(1)(table)
    assert [suffix_dedup.unpack(x.as_buffer())[0].tolist() for x in out.column("entries")] == [[13]]


def test_second_fingerprints_follow_the_bytes():
    buf = np.frombuffer(b"0123456789" * 12, np.uint8)
    at = np.arange(len(buf) - 50)
    got = suffix_dedup.checks(suffix_dedup.sums(buf), at, 50)
    assert len(set(got.tolist())) == 10 and (got[:10] == got[10:20]).all()


def entries(batches, buckets):
    """Entries that are dealt by name, and all others."""
    parts = [(b, len(suffix_dedup.unpack(e.as_buffer())[0])) for x in batches
             for b, e in zip(x.column("bucket").to_pylist(), x.column("entries"))]
    return [sum(n for b, n in parts if (b < buckets) == by_name) for by_name in (True, False)]


def test_hot_names_are_settled_in_the_slice():
    line = "".join(chr(97 + (i * i + i // 7) % 26) for i in range(71))
    texts, ids = [line] * 900 + ["=" * 3000], np.arange(901)
    batch = pa.record_batch({"rid": pa.array(ids), "text": pa.array(texts)})
    by_name, settled = entries(suffix_dedup._sample(1, 4, 50)([batch]), 1)
    assert by_name <= 2 * len(line) and settled > 900 * 9
    batch = pa.record_batch({"rid": pa.array(ids), "order": pa.array(ids), "start": pa.array(np.zeros(901, int)),
                             "bytes": pa.array([x.encode() for x in texts])})
    by_name, settled = np.sum([entries(suffix_dedup._windows(1, 4, share, 50)([batch]), 1)
                               for share in range(suffix_dedup.ROUNDS)], 0)
    assert by_name == 22 + 1 and by_name + settled == 900 * 22 + 2951


def test_hot_and_periodic_texts_equal_brute_force(spark):
    line = "".join(chr(97 + (i * i + i // 7) % 26) for i in range(71)) + "\n"
    rows = [(i, f"{i:05d} " * 3 + line * (1 + i % 3)) for i in range(60)]
    rows += [(100, "=" * 400), (101, "-" + "=" * 300), (101, line * 9), (50, "x" + line * 40), (None, "=" * 90 + line * 20)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert sorted(digests(df), key=repr) == sorted(brute(rows), key=repr)


def test_names_and_sums_need_little_beyond_their_results():
    """A worker holds two arrays as long as its slice at most, whatever it computes on the way."""
    import tracemalloc

    import numpy as np

    from sparkmart.llm import suffix_dedup
    buf = np.random.default_rng(5).integers(0, 256, 1 << 20).astype(np.uint8)
    suffix_dedup.sums(buf[:10])                              # powers are made once
    for made, most in ((lambda: suffix_dedup.whole_names(buf, 50), 2.5), (lambda: suffix_dedup.sums(buf), 1.5)):
        tracemalloc.start()
        out = made()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < most * out.nbytes, peak / out.nbytes


def test_shares_name_every_string_once():
    """The shares of a buffer are all its strings, with their names; positions that are asked for have the same names."""
    buf = np.random.default_rng(7).integers(97, 101, 3 * suffix_dedup.CHUNK + 17).astype(np.uint8)
    at, name = (np.concatenate(x) for x in zip(*[suffix_dedup.share_names(buf, 50, k) for k in range(suffix_dedup.ROUNDS)]))
    order = np.argsort(at)
    assert (at[order] == np.arange(len(buf) - 49)).all() and (name[order] == suffix_dedup.whole_names(buf, 50)).all()
    some = np.flatnonzero(np.random.default_rng(8).random(len(buf) - 26) < 0.2)
    assert (suffix_dedup.names(buf, some) == suffix_dedup.names(buf)[some]).all()
    assert not len(suffix_dedup.share_names(buf[:49], 50, 0)[0])


def test_spans_of_a_group_need_no_python_objects():
    import tracemalloc
    n = 100_000
    pos = np.arange(n) * 60
    raw = [suffix_dedup.pack(np.repeat([3, 8], [n // 4, n - n // 4]), pos),
           suffix_dedup.pack(np.array([8, 8, 9]), np.array([pos[-1] + 50, 7, 1]), np.array([pos[-1], 5, 1], np.uint64))]
    table = pa.table({"bucket": pa.array([0, 0], pa.int32()), "entries": pa.array(raw, pa.binary())})
    tracemalloc.start()
    out = suffix_dedup._spans(50)(table)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150 * n, peak / n
    assert out.column("rid").to_pylist() == [3, 8]
    got = [[(x["start"], x["end"]) for x in r] for r in out.column("spans").to_pylist()]
    want = [(int(p), int(p) + 50) for p in pos]
    assert got == [want[:n // 4], want[n // 4:-1] + [(want[-1][0], want[-1][1] + 50)]]


def test_workers_give_back_what_a_task_took():
    """After a task a worker keeps neither its powers nor another operator's codec, nor the memory of either."""
    import re

    from sparkmart.llm import _common, bpe

    def held():
        return int(re.search(r"\nPss_Anon:\s+(\d+)", open("/proc/self/smaps_rollup").read())[1]) // 1024

    bpe._codecs["some"] = [bytes(1000) for _ in range(60_000)]
    rng, n = np.random.default_rng(11), 400
    texts = pa.array([bytes(rng.integers(97, 123, 30_000).astype(np.uint8)) for _ in range(n)], pa.binary())
    batch = pa.record_batch({"rid": pa.array(range(n)), "order": pa.array(range(n)), "start": pa.array([0] * n), "bytes": texts})
    before = held()
    for _ in suffix_dedup.trimmed(suffix_dedup._windows(8, 4, 0, 50))([batch]):
        most = held()
    assert not bpe._codecs and not _common._powers
    assert held() < before - 40 < most - 80, (before, most, held())


def test_rounds_follow_what_is_suspect():
    """A round names a sixth of the text at most, and no round is spent on less; any number of shares has each string once."""
    assert suffix_dedup.rounds_for(0, 0) == 1 and suffix_dedup.rounds_for(10, 600) == 1
    assert suffix_dedup.rounds_for(29, 100) == 2 and suffix_dedup.rounds_for(100, 100) == suffix_dedup.ROUNDS
    buf = np.random.default_rng(3).integers(97, 101, 5000).astype(np.uint8)
    want = np.sort(suffix_dedup.whole_names(buf, 50))
    for rounds in (1, 2, 5):
        at, name = (np.concatenate(x) for x in zip(*[suffix_dedup.share_names(buf, 50, k, rounds) for k in range(rounds)]))
        assert sorted(at) == [*range(5000 - 49)] and (np.sort(name) == want).all()
