import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from sparkmart.llm import warc

PAGES = "page_id long, url string, html string"


def rows():
    out = [(i, f"http://h/{i}", f"<p>{'x' * (i % 5)}{i % 11}</p>") for i in range(80)]
    out += [(200, None, None), (201, "http://a b\r\nWARC-Type: evil", ""), (202, "http://é", "é" * 3000), (None, "u", "<p>1</p>"),
            (203, "http://big", "".join(chr(33 + (i * i) % 90) for i in range(300_000))), (5, "http://h/5", "<p>5</p>")]
    return out


def expected(pages, least=0):
    big = {}
    for i, (page_id, _, html) in enumerate(pages):
        raw = (html or "").encode()
        if len(raw) >= least and page_id is not None:
            big[raw] = max(big.get(raw, -1), page_id)
    out = {}
    for page_id, _, html in pages:
        raw = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        first = big.get(raw, page_id) == page_id
        out[page_id] = (len(raw), digest, "response" if first else "revisit", None if first else big[raw])
    return out


@pytest.mark.parametrize("range_bytes", [1 << 22, 700, 61])
def test_round_trip_over_any_ranges(spark, scratch, monkeypatch, range_bytes):
    monkeypatch.setattr(warc, "RANGE_BYTES", range_bytes)
    pages = spark.createDataFrame(rows()[:90 if range_bytes > 100 else 40], PAGES).withColumn("digest", F.lit("x")).withColumn("salt", F.lit(1))
    given = [tuple(r)[:3] for r in pages.collect()]
    manifest = warc.write_archives(pages, f"{scratch}/w")
    got = warc.read_archives(manifest, f"{scratch}/w").collect()
    assert len(got) == len(given)
    want = expected(given)
    html = {page_id: (h or "").encode() for page_id, _, h in given}
    for r in got:
        assert (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) == want[r.page_id]
        assert r.payload is None if r.record_type == "revisit" else bytes(r.payload) == html[r.page_id]


def test_small_payloads_are_always_responses(spark, scratch):
    manifest = warc.write_archives(spark.createDataFrame(rows()[:40], PAGES), f"{scratch}/w", least=9)
    got = {r.page_id: r for r in warc.read_archives(manifest, f"{scratch}/w").collect()}
    want = expected(rows()[:40], least=9)
    assert {i: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for i, r in got.items()} == want


def test_bytes_that_look_like_members_are_not_records():
    import io
    inner = warc.member(b"not a record at all")
    false = b"\x1f\x8b\x08\x00garbage"
    body = [warc.member(warc.record("response", i, "u", warc.sha1_base32(b"p"), b"p", None)) for i in range(3)]
    raw = body[0] + inner + false + body[1] + body[2]
    f = io.BytesIO(raw)
    for step in (1, 7, 50, len(raw)):
        found = [m for a in range(0, len(raw), step) for m in warc.Scan(f, len(raw), 16).members(a, a + step)]
        assert [warc.parse(m)["page_id"] for m in found] == [0, 1, 2]


def test_damaged_members_are_counted(spark, scratch):
    manifest = warc.write_archives(spark.createDataFrame(rows()[:40], PAGES).coalesce(1), f"{scratch}/w")
    assert warc.incomplete(manifest, warc.read_archives(manifest, f"{scratch}/w", payloads=False)).count() == 0
    name, = [r.file for r in manifest.collect()]
    path = f"{scratch}/w/{name}".removeprefix("file:")
    with open(path, "r+b") as f:
        raw = f.read()
        at = raw.index(warc.MAGIC, len(raw) // 2) + 20
        f.seek(at)
        f.write(bytes(x ^ 255 for x in raw[at:at + 8]))
    records = warc.read_archives(manifest, f"{scratch}/w", payloads=False)
    assert [tuple(r) for r in warc.incomplete(manifest, records).collect()] == [(name, 40, 39)]


def test_blocks_of_a_long_member_are_looked_at_once():
    import io
    import time
    raw = warc.member(warc.record("response", 1, "u", "d", b"0123456789abcdef" * (4 << 20), None))
    took = time.perf_counter()
    found, = warc.Scan(io.BytesIO(raw), len(raw), 1 << 10).members(0, 1)
    assert len(found) > 64 << 20 and time.perf_counter() - took < 5


def test_query_over_the_whole_table(spark, tmp_path):
    pages = [r for r in rows() if r[0] != 5 or r[1] is None] + [(5, "http://h/5", "<p>5</p>")]
    spark.createDataFrame(pages, PAGES).write.parquet(f"{tmp_path}/pages.parquet")
    out = warc.op2_warc(spark, str(tmp_path))
    assert out.columns[:5] == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert {r.page_id: tuple(r)[1:5] for r in out.collect()} == expected(pages)


def test_empty_table(spark, scratch):
    manifest = warc.write_archives(spark.createDataFrame([], PAGES), f"{scratch}/w")
    assert warc.read_archives(manifest, f"{scratch}/w").count() == 0
