"""SentencePiece encoding and decoding with a public merge-type vocabulary.

A merge-type (BPE) model joins adjacent symbols until no pair is a piece.  The
*agenda* holds every adjacent pair that forms a piece, ordered by the piece's
score, then from left to right; the first entry is merged and its new neighbours
are entered.  An entry is stale, and skipped, once either symbol has grown.
Characters that are no piece become bytes.

No merge can cross two neighbouring characters that no piece holds side by side,
so texts are cut there: into *runs*, which begin with white space, at a line end
or a sign after a word, and long runs further at every such pair.  A run is encoded once and kept in
a cache that is bounded in bytes.  The short runs that a batch has anew go through
their agendas side by side as rows of numpy arrays, one merge of every row at a
time; long ones have a heap each.

Every Arrow batch is checked against the sentencepiece library: the runs that it
encodes anew, ids and decoded text, are compared in one call for about ``PIECE``
characters, and document by document should that fail; ``library_agrees`` tells.

Edge cases: a null or empty text has no ids and decodes to the empty text;
control strings in a text are plain text, as in the library; U+2581 in a text
decodes to a space, as in the library; texts of any length are encoded part by
part, and only a run without a cut is held whole (about 70 bytes a character;
beyond ``CHECKED`` characters it is not compared and ``library_agrees`` is null);
repeated rows and null doc_ids are encoded each; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import string
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of cached runs and ids, about, in each of two generations.
CACHE_BYTES = 40 << 20
#: Longest run, in characters, that is cached and has its agenda in a numpy row.
SHORT = 32
#: Longest run that the library is given, and characters of a text's part.
CHECKED = 1 << 20
PIECE = 1 << 18
SPACE = "▁"
WORD = "[0-9A-Za-zÀ-ÖØ-öø-ɏ]"
#: Rank of pairs that form no piece.
NONE = 1 << 30

#: Where a text can be cut and its parts be encoded as texts of their own: the
#: space goes, as the library puts one before each text.
_CUT = re.compile(r"(?<=[^ ▁]) (?=[^ ▁])")


class Model:
    """Encoder and decoder of one merge-type model file."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2 as pb
        self.library = SentencePieceProcessor(model_file=path)
        proto = pb.ModelProto.FromString(self.library.serialized_model_proto())
        kinds = pb.ModelProto.SentencePiece
        norm, trained = proto.normalizer_spec, proto.trainer_spec
        if (trained.model_type != pb.TrainerSpec.BPE or not trained.byte_fallback or trained.treat_whitespace_as_suffix
                or any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in proto.pieces) or norm.precompiled_charsmap
                or not norm.add_dummy_prefix or norm.remove_extra_whitespaces or not norm.escape_whitespaces):
            raise ValueError("the model must be a merge-type one with byte fallback, without normalisation, user-defined or unused pieces")
        scores = sorted({p.score for p in proto.pieces if p.type == kinds.NORMAL}, reverse=True)
        place = {s: i for i, s in enumerate(scores)}
        self.id_of = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == kinds.NORMAL}
        self.rank = {p.piece: place[p.score] for p in proto.pieces if p.type == kinds.NORMAL}
        self.byte = [0] * 256
        self.raw: list[bytes | None] = []
        for i, p in enumerate(proto.pieces):
            if p.type == kinds.BYTE:
                self.byte[int(p.piece[3:5], 16)] = i
                self.raw.append(bytes([int(p.piece[3:5], 16)]))
            else:
                self.raw.append(p.piece.replace(SPACE, " ").encode() if p.type == kinds.NORMAL else None)
        # Our bytes of each piece (after another one) are the library's text.
        whole = [i for i, x in enumerate(self.raw) if x is not None and (len(x) > 1 or x < b"\x80")]
        if self.library.decode([[whole[-1], i] for i in whole]) != [(self.raw[whole[-1]] + self.raw[i]).decode() for i in whole]:
            raise ValueError("the library decodes pieces otherwise")
        self.decimal = [str(i) for i in range(len(self.raw))]
        self.beside = {p[k:k + 2] for p in self.id_of for k in range(len(p) - 1)}
        if any(x[1] == SPACE != x[0] for x in self.beside):
            raise ValueError("a piece holds white space after other characters: texts can't be cut before it")
        if any("\n" in x for x in self.beside) or "\n" in self.id_of:
            raise ValueError("a piece holds a line end: runs can't be cut there")
        # Signs that no piece holds after a letter or digit start a run there.
        after = {x[1] for x in self.beside if re.match(WORD, x[0])}
        sign = "".join(re.escape(c) for c in string.punctuation if c not in after) or SPACE
        self.runs = re.compile(rf"{SPACE}*[^{SPACE}\n{sign}]++(?<={WORD})(?=[{sign}])|{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n").findall
        self.line = np.array([self.byte[10]], "<u4").tobytes()
        # Tables for runs side by side: the symbol of a character (-1: none) and
        # the piece of two symbols, by one number for both.
        self.char = np.full(sys.maxunicode + 1, -1, np.int32)
        for piece, i in self.id_of.items():
            if len(piece) == 1:
                self.char[ord(piece)] = i
        self.base = len(self.raw) + 2
        pairs = sorted((self.id_of[x[:k]] * self.base + self.id_of[x[k:]], i) for x, i in self.id_of.items()
                       for k in range(1, len(x)) if x[:k] in self.id_of and x[k:] in self.id_of)
        self.pair = np.array([k for k, _ in pairs], np.int64)
        self.joined = np.array([i for _, i in pairs], np.int32)
        self.rank_of = np.full(len(self.raw) + 1, NONE, np.int32)          # the last one is for no piece
        for piece, i in self.id_of.items():
            self.rank_of[i] = self.rank[piece]
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.held = 0

    # ------------------------------------------------------------ encoding

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text, as ``SentencePieceProcessor.encode(text)``."""
        out = []
        for part in parts(text):
            runs = self.runs_of(part)
            out += map(self.ids_of([runs])[0].__getitem__, runs)
        return np.frombuffer(b"".join(out), "<u4")

    def runs_of(self, part: str) -> list[str]:
        """Runs of a part, with the space that goes before it."""
        return self.runs(SPACE + part.replace(" ", SPACE))

    def ids_of(self, lists: list[list[str]]) -> tuple[dict[str, bytes], bool | None]:
        """Ids of all runs in the lists, and whether the library gives those
        that were not cached the same (null: not compared)."""
        known: dict[str, bytes] = {}
        new = []
        for run in set().union(*lists):
            ids = self.young.get(run)
            if ids is None and (ids := self.old.get(run)) is not None:
                self._keep(run, ids)
            if ids is None:
                new.append(run)
            else:
                known[run] = ids
        short = [r for r in new if len(r) <= SHORT]
        found = dict(zip(short, self.side_by_side(short)))
        found.update((r, self.one(r)) for r in new if len(r) > SHORT)
        agrees = self._as_the_library(found)
        for run, ids in found.items():
            if len(run) <= SHORT:
                self._keep(run, ids)
        return known | found, agrees

    def _keep(self, run: str, ids: bytes) -> None:
        self.young[run] = ids
        self.held += 150 + 2 * len(run) + len(ids)
        if self.held > CACHE_BYTES:
            self.old, self.young, self.held = self.young, {}, 0

    def _as_the_library(self, found: dict[str, bytes]) -> bool | None:
        """One call for all runs, each after a line end."""
        runs = [r for r in found if len(r) <= CHECKED]
        if not runs:
            return None if found else True
        text = "".join(["\n" + r for r in runs]).replace(SPACE, " ")
        want = np.frombuffer(b"".join([self.line + found[r] for r in runs]), "<u4").tolist()
        same = self.library.encode(text)[1:] == want and self.library.decode(want) == text
        return None if same and len(runs) < len(found) else same

    def side_by_side(self, runs: list[str]) -> list[bytes]:
        """Ids of short runs: a row of pair ranks each, whose least, leftmost
        entry is merged until none is left."""
        if not runs:
            return []
        flat = self.char[np.frombuffer("".join(runs).encode("utf-32-le"), np.uint32)]
        length = np.fromiter(map(len, runs), np.int64, len(runs))
        start = np.cumsum(length) - length
        out: list[bytes] = [b""] * len(runs)
        whole = np.minimum.reduceat(flat, start) >= 0
        for i in np.flatnonzero(~whole):                       # characters that are bytes
            out[i] = self.one(runs[i])
        for lo, hi in zip([0, 4, 8, 12, 18], [4, 8, 12, 18, SHORT]):
            rows = np.flatnonzero(whole & (length > lo) & (length <= hi))
            for at in range(0, len(rows), 8192):
                self._merge(rows[at:at + 8192], flat, start, length, out)
        return out

    def _merge(self, rows, flat, start, length, out: list[bytes]) -> None:
        n = int(length[rows].max(initial=1))
        column = np.arange(n)
        inside = column < length[rows][:, None]
        symbol = np.full(inside.shape, -1, np.int32)
        symbol[inside] = flat[(start[rows][:, None] + column)[inside]]
        piece = self._piece(symbol[:, :-1], symbol[:, 1:])
        while True:
            rank = self.rank_of[piece]
            i = rank.argmin(1) if n > 1 else np.zeros(len(rows), np.int64)
            each = np.arange(len(rows))
            more = rank[each, i] < NONE if n > 1 else np.zeros(len(rows), bool)
            done = symbol[~more]
            raw, ends = done[done >= 0].astype("<u4").tobytes(), np.cumsum((done >= 0).sum(1)).tolist()
            for row, a, b in zip(rows[~more].tolist(), [0, *ends], ends):
                out[row] = raw[4 * a:4 * b]
            rows, symbol, piece, i = rows[more], symbol[more], piece[more], i[more]
            if not len(rows):
                return
            each = each[:len(rows)]
            symbol[each, i] = piece[each, i]
            column = np.arange(n)
            n -= 1
            symbol = symbol[column != i[:, None] + 1].reshape(len(rows), n)
            piece = piece[column[:-1] != i[:, None]].reshape(len(rows), n - 1)
            for side in (i - 1, i):                             # the pairs that hold the merged symbol
                some = np.flatnonzero((side >= 0) & (side < n - 1))
                at = side[some]
                piece[some, at] = self._piece(symbol[some, at], symbol[some, at + 1])

    def _piece(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The piece of two symbols side by side, -1 for none."""
        key = a.astype(np.int64) * self.base + b
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where((self.pair[at] == key) & (b >= 0), self.joined[at], -1)

    def one(self, run: str) -> bytes:
        """Ids of a run, cut wherever no piece holds two neighbours."""
        out = array("I")
        a = 0
        for b in range(1, len(run) + 1):
            if b == len(run) or run[b - 1:b + 1] not in self.beside:
                for symbol in self.agenda(run[a:b]):
                    x = self.id_of.get(symbol)
                    if x is None:
                        out.extend([self.byte[c] for c in symbol.encode()])
                    else:
                        out.append(x)
                a = b
        return out.tobytes()

    def agenda(self, text: str) -> list[str]:
        """Symbols that remain when every pair that forms a piece is merged,
        best score first, then leftmost."""
        n = len(text)
        if n == 1:
            return [text]
        rank = self.rank
        symbol = list(map(sys.intern, text))
        right, left = array("q", range(1, n + 1)), array("q", range(-1, n - 1))
        # An entry is rank, place of the left symbol and length, in one number.
        entries = []
        for i in range(n - 1):
            r = rank.get(symbol[i] + symbol[i + 1])
            if r is not None:
                entries.append((r << 40 | i) << 16 | 2)
        heapq.heapify(entries)
        while entries:
            e = heapq.heappop(entries)
            i = e >> 16 & 0xFFFFFFFFFF
            j = right[i]
            if not symbol[i] or j >= n or len(symbol[i]) + len(symbol[j]) != e & 0xFFFF:
                continue
            symbol[i] += symbol[j]
            symbol[j] = ""
            k = right[i] = right[j]
            if k < n:
                left[k] = i
                r = rank.get(symbol[i] + symbol[k])
                if r is not None:
                    heapq.heappush(entries, (r << 40 | i) << 16 | len(symbol[i]) + len(symbol[k]))
            h = left[i]
            if h >= 0:
                r = rank.get(symbol[h] + symbol[i])
                if r is not None:
                    heapq.heappush(entries, (r << 40 | h) << 16 | len(symbol[h]) + len(symbol[i]))
        return [s for s in symbol if s]

    # ------------------------------------------------------------ decoding

    def decode(self, ids: list[int]) -> str:
        """As ``SentencePieceProcessor.decode(ids)``: pieces, spaces for their
        signs, without the one before the text.  Ids that no encoding has
        (control ids, broken characters) are left to the library."""
        if not ids:
            return ""
        try:
            raw = b"".join(map(self.raw.__getitem__, ids))
            return raw[1:].decode() if self.raw[ids[0]].startswith(b" ") else self.library.decode(ids)
        except (TypeError, AttributeError, UnicodeDecodeError):
            return self.library.decode(ids)

    def agrees(self, text: str) -> bool | None:
        """Whether ids and decoded text of a whole text are the library's."""
        for part in parts(text):
            if len(part) > CHECKED:
                return None
            ids = self.encode(part).tolist()
            if ids != self.library.encode(part) or self.decode(ids) != self.library.decode(ids):
                return False
        return True


class Digest:
    """Number of ids, digest of the ids in decimal and of the decoded text, fed
    part by part."""

    def __init__(self):
        self.n, self.ids, self.text, self.agrees = 0, hashlib.sha256(), hashlib.sha256(), True

    def add(self, m: Model, raw: bytes, agrees: bool | None) -> None:
        ids = np.frombuffer(raw, "<u4").tolist()
        self.text.update(((" " if self.n else "") + m.decode(ids)).encode())
        self.ids.update(((("," if self.n else "") + ",".join(map(m.decimal.__getitem__, ids))).encode()))
        self.n += len(ids)
        self.agrees = self.agrees if agrees else agrees

    def values(self) -> tuple[int, str, str, bool | None]:
        return self.n, self.ids.hexdigest(), self.text.hexdigest(), self.agrees


def parts(text: str) -> Iterator[str]:
    """A text in parts of about ``PIECE`` characters whose encodings, one after
    the other, are the text's."""
    at = 0
    while at < len(text):
        cut = _CUT.search(text, at + PIECE) if at + PIECE < len(text) else None
        yield text[at:cut.start() if cut else len(text)]
        at = cut.end() if cut else len(text)


_models: dict[str, Model] = {}


def model(path: str) -> Model:
    """The task process's model of a file."""
    if path not in _models:
        _models[path] = Model(path)
    return _models[path]


def digested(m: Model, texts: list[str]) -> list[tuple[int, str, str, bool | None]]:
    """Round trips of texts, together about ``PIECE`` characters at a time."""
    out = [Digest() for _ in texts]
    group: list[tuple[int, str]] = []

    def flush() -> None:
        lists = [m.runs_of(part) for _, part in group]
        known, agrees = m.ids_of(lists)
        for (row, part), runs in zip(group, lists):
            raw = b"".join(map(known.__getitem__, runs))
            out[row].add(m, raw, agrees if agrees else m.agrees(part))
        group.clear()

    held = 0
    for row, text in enumerate(texts):
        for part in parts(text):
            group.append((row, part))
            held += len(part)
            if held >= PIECE:
                flush()
                held = 0
    if group:
        flush()
    return [d.values() for d in out]


def _round_trips(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                n, ids, decoded, agrees = zip(*digested(m, [t.as_py() or "" for t in part.column(1)]))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(ids), pa.array(decoded), pa.array(agrees, pa.bool_())],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "library_agrees"])
    return run


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Round trip of every text: count and digests of ids and decoded text, and
    whether the library gives the same."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_round_trips(path), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, "
                                               "library_agrees boolean")


def _encoded(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                ids = [m.encode(t.as_py() or "").tobytes() for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary())], names=["doc_id", "ids"])
    return run


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids``: ids of every text as little-endian 32-bit integers."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_encoded(path), "doc_id long, ids binary")


def _decoded(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for batch in batches:
            text = [m.decode(np.frombuffer(x.as_buffer(), "<u4").tolist()) if x.is_valid else None for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(text, pa.string())], names=["doc_id", "text"])
    return run


def decoded(rows: DataFrame, path: str) -> DataFrame:
    """``doc_id, text`` of ``rows (doc_id, ids)``."""
    return rows.select("doc_id", "ids").mapInArrow(_decoded(path), "doc_id long, text string")


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def op13_sentencepiece_round_trip(spark, sf_dir: str) -> DataFrame:
    """Encode and decode every document."""
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), default_vocabulary())
