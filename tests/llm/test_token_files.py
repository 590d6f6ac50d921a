import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkmart.llm import bpe, token_files


@pytest.mark.parametrize("n,top", [(0, 1), (1, 1), (1, 10 ** 9), (5, 3), (1000, 10 ** 6), (3000, 50), (2000, 2 ** 40)])
def test_elias_fano_select(n, top):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, top, n))
    code = token_files.EliasFano.from_bytes(token_files.EliasFano.of(values).to_bytes())
    for _ in range(60):
        a, b = sorted(rng.integers(0, n + 1, 2).tolist())
        assert code.select(a, b).tolist() == values[a:b].tolist()
    if n >= 1000:
        assert len(code.to_bytes()) * 8 <= n * (3 + max(0, np.log2(top / n))) + 600


def test_files_hold_all_ids_in_order(docs, rows, scratch, monkeypatch):
    monkeypatch.setattr(token_files, "SHARD_BYTES", 40_000)
    manifest = token_files.write_tokens(docs, bpe.default_vocabulary(), f"{scratch}/t")
    got = token_files.read_tokens(manifest, f"{scratch}/t").collect()
    assert len(got) == len(rows) and manifest.count() > 1
    tok = bpe.codec(bpe.default_vocabulary()).tok
    want = {}
    for doc_id, text, *_ in rows:
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 0]
        want.setdefault(doc_id, set()).add((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert all((r.n_tokens, r.ids_crc32) in want[r.doc_id] for r in got)
    got.sort(key=lambda r: r.start)
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda x: (x is not None, x))


def test_long_document_is_read_in_blocks(spark, scratch, monkeypatch):
    text = "some words " * 3000
    manifest = token_files.write_tokens(spark.createDataFrame([(1, text)], "doc_id long, text string"),
                                        bpe.default_vocabulary(), f"{scratch}/t")
    row = manifest.select("file", F.lit(0).cast("long").alias("start")).mapInArrow(
        token_files._read(token_files.qualified(spark, f"{scratch}/t"), block=100),
        "doc_id long, start long, n_tokens long, ids_crc32 long").collect()[0]
    ids = [*bpe.codec(bpe.default_vocabulary()).encode(text).tolist(), 0]
    assert (row.n_tokens, row.ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))


def test_empty_table(no_docs, scratch):
    manifest = token_files.write_tokens(no_docs, bpe.default_vocabulary(), f"{scratch}/t")
    assert token_files.read_tokens(manifest, f"{scratch}/t").count() == 0
