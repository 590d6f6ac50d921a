"""WARC archives: deduplicating writer and splittable reader.

Writer: one gzip member per record (WARC/1.1).  Of records with equal payloads
of at least ``least`` bytes, the one with the largest page_id is a response
and the others are revisits that refer to it; smaller payloads are always
responses.  Tasks write their own files; the manifest, a table that Spark
commits, names the files that count, so a task that runs again does no harm.

Reader: archives are cut into byte ranges, one task each, without an index.  A
task looks for gzip magic in its range, takes a candidate for a member only if
it decodes and its text begins like a WARC record, and owns the records that
start inside the range; from an owned record it goes on to the next member's
first byte.  A record that crosses the range's end is read to its end.  A member
that doesn't decode is passed over, up to the next one that does; ``incomplete``
compares the records found with the manifest, and the query raises an error if
any file misses one.  A payload that differs from its digest raises one at once.

Edge cases: null and empty payloads are empty; a null url is written as an
empty target; white space and controls in a url are percent-encoded; a null
page_id is written as ``-`` and is never what a revisit refers to, unless no
record of the group has one; repeated page_ids are records of their own, and
among rows with the largest page_id one (by url) is the response; an empty
table makes no archive and an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm._common import stored, workspace
from sparkmart.llm._files import file_system, qualified

#: Byte range that one reading task scans.
RANGE_BYTES = 4 << 20
#: Copies of a hot payload are spread over this many join keys.
SALTS = 64
MAGIC = b"\x1f\x8b\x08"
DATE = "2024-01-01T00:00:00Z"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(kind: str, page_id: int | None, url: str, digest: str, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record, uncompressed."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    name = "-" if page_id is None else page_id
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{name}>", f"WARC-Date: {DATE}",
            f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~')}", f"WARC-Payload-Digest: sha1:{digest}"]
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:page:{'-' if refers_to is None else refers_to}>"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(raw: bytes) -> bytes:
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(raw) + pack.flush()


def _with_digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        html = batch.column(2)
        digest = [sha1_base32(memoryview(x.as_buffer()) if x.is_valid else b"") for x in html]
        size = [len(x.as_buffer()) if x.is_valid else 0 for x in html]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(digest), pa.array(size, pa.int64())],
                                         names=["page_id", "url", "html", "digest", "size"])


MANIFEST = "file string, bytes long, records long"


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(folder)
        out, name, size, n = None, "", 0, 0
        for batch in batches:
            for i in range(batch.num_rows):
                if out is None:
                    name = f"pages-{uuid.uuid4().hex}.warc.gz"
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                page_id, url, html, digest, kind, refers_to = (batch.column(c)[i] for c in (
                    "page_id", "url", "html", "digest", "kind", "refers_to"))
                raw = member(record(kind.as_py(), page_id.as_py(), url.as_py() or "", digest.as_py(),
                                    html.as_buffer().to_pybytes() if html.is_valid else b"", refers_to.as_py()))
                out.write(raw)
                size += len(raw)
                n += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"file": [name], "bytes": [size], "records": [n]})
    return run


def write_archives(pages: DataFrame, folder: str, least: int = 0) -> DataFrame:
    """Write ``pages (page_id, url, html)``; returns the stored manifest."""
    spark = pages.sparkSession
    folder = qualified(spark, folder)
    fs, base = file_system(folder)
    fs.create_dir(base, recursive=True)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html")).mapInArrow(
        _with_digest, "page_id long, url string, html string, digest string, size long")
    # Groups of equal payloads: pre-aggregated, and only groups of two or more joined back.
    big = rows.where(F.col("size") >= least)
    first = F.struct(F.coalesce("page_id", F.lit(-(1 << 63))).alias("order"), F.coalesce("url", F.lit("")).alias("at"), "page_id")
    groups = big.groupBy("digest").agg(F.count(F.lit(1)).alias("many"), F.max(first).alias("first")).where("many > 1")
    groups = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).select(
        "digest", "salt", F.col("first.page_id").alias("to"), F.col("first.at").alias("to_url"))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    both = salted.join(groups, ["digest", "salt"], "left")
    itself = F.col("page_id").eqNullSafe(F.col("to")) & (F.coalesce("url", F.lit("")) == F.col("to_url"))
    plain = F.col("to_url").isNull() | (F.col("size") < least)
    told = both.withColumn("kind", F.when(plain | itself, "response").otherwise("revisit")).withColumn(
        "refers_to", F.when(F.col("kind") == "revisit", F.col("to")))
    return stored(told.mapInArrow(_write(folder), MANIFEST), f"{folder}/manifest")


# ------------------------------------------------------------------ reader

class Scan:
    """Members of an archive from a byte position on."""

    def __init__(self, f, size: int, block: int = 1 << 18):
        self.f, self.size, self.block = f, size, block

    def at(self, pos: int) -> tuple[bytes, int] | None:
        """The whole member that starts at ``pos`` and where it ends; None if
        there's no gzip member there that begins like a WARC record."""
        unpack = zlib.decompressobj(31)
        out, got, known, here, step = [], 0, False, pos, 1 << 12
        try:
            while not unpack.eof:
                self.f.seek(here)
                raw = self.f.read(min(step, self.size - here))
                if not raw:
                    return None
                step = min(2 * step, self.block)
                here += len(raw)
                out.append(unpack.decompress(raw))
                got += len(out[-1])
                if not known and got >= 5:
                    if b"".join(out)[:5] != b"WARC/":
                        return None
                    known = True
        except zlib.error:
            return None
        return (b"".join(out), here - len(unpack.unused_data)) if known else None

    def members(self, start: int, end: int) -> Iterator[bytes]:
        """Members that start in ``[start, end)``."""
        pos = start
        while pos < min(end, self.size):
            found = self.at(pos)
            if found:
                yield found[0]
                pos = found[1]
                continue
            # The next magic at or after pos + 1 whose first byte is in the range.
            pos += 1
            while pos < end:
                self.f.seek(pos)
                raw = self.f.read(min(self.block, self.size - pos, end - pos + len(MAGIC) - 1))
                k = raw.find(MAGIC)
                if k >= 0:
                    pos += k
                    break
                if len(raw) < len(MAGIC):
                    pos = end
                    break
                pos += len(raw) - len(MAGIC) + 1


HEADER = re.compile(rb"^([A-Za-z-]+):[ \t]*(.*?)\r?$", re.M)


def parse(raw: bytes) -> dict:
    """Fields of a record that the result needs."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    field = {k.decode().lower(): v.decode() for k, v in HEADER.findall(head)}
    block = rest[:int(field["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict((k.lower(), v) for k, v in HEADER.findall(http))[b"content-length"])
    digest = field["warc-payload-digest"].removeprefix("sha1:")
    if field["warc-type"] == "response" and (len(payload) != size or sha1_base32(payload) != digest):
        raise ValueError(f"{field['warc-record-id']}: payload and digest differ")
    number = lambda x: int(x[10:-1]) if x[10:-1] != "-" else None
    return {"page_id": number(field["warc-record-id"]), "url": field["warc-target-uri"],
            "payload": payload if field["warc-type"] == "response" else None, "payload_bytes": size, "payload_digest": digest,
            "record_type": field["warc-type"], "refers_to": number(field["warc-refers-to"]) if "warc-refers-to" in field else None}


ROW = pa.schema([("file", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
                 ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])
RECORD = ("file string, page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, "
          "refers_to long")


def _read(folder: str, payloads: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(folder)
        for batch in batches:
            for name, size, start in zip(*(batch.column(c).to_pylist() for c in ("file", "bytes", "start"))):
                rows, held = [], 0
                with fs.open_input_file(f"{base}/{name}") as f:
                    for raw in Scan(f, size).members(start, start + RANGE_BYTES):
                        row = {"file": name} | parse(raw)
                        if not payloads:
                            row["payload"] = None
                        rows.append(row)
                        held += len(row["payload"] or b"") + 200
                        if held > 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, ROW)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, ROW)
    return run


def read_archives(manifest: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """Records of all archives in ``folder`` that the manifest names, with the
    ``file`` they are in; ``incomplete`` tells files whose members are damaged."""
    folder = qualified(manifest.sparkSession, folder)
    ranges = manifest.withColumn("start", F.explode(F.sequence(F.lit(0), F.col("bytes") - 1, F.lit(RANGE_BYTES))))
    n = ranges.count()
    return ranges.select("file", "bytes", "start").repartition(max(1, int(n)), "file", "start").mapInArrow(
        _read(folder, payloads), RECORD)


def incomplete(manifest: DataFrame, records: DataFrame) -> DataFrame:
    """Files that gave other than the manifest's number of records: ``file,
    records, found``."""
    found = records.groupBy("file").agg(F.count(F.lit(1)).alias("found"))
    return manifest.select("file", "records").join(found, "file", "left").withColumn(
        "found", F.coalesce("found", F.lit(0).cast("long"))).where("found <> records")


def op2_warc(spark, sf_dir: str) -> DataFrame:
    """Write every page to archives and read them back."""
    folder = workspace(spark, "warc")
    manifest = write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    records = stored(read_archives(manifest, folder, payloads=False).drop("payload"), f"{qualified(spark, folder)}/records")
    if short := incomplete(manifest, records).head(1):
        raise ValueError(f"{short[0].file}: {short[0].found} records of {short[0].records}")
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: The same as DuckDB SQL; five hexadecimal digits are four of base32.
ORACLE = """
WITH paid AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
named AS (
  SELECT page_id, payload_bytes, list_aggregate(list_transform(range(8), lambda g: list_aggregate(list_transform([15, 10, 5, 0], lambda s:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                  ((CAST('0x' || substr(h, CAST(5 * g + 1 AS INTEGER), 5) AS INTEGER) >> s) & 31) + 1, 1)), 'string_agg', '')),
         'string_agg', '') AS payload_digest
  FROM paid),
told AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM named)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM told"""
