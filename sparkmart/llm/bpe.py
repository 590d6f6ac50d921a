"""BPE encoding and decoding with a public byte-level vocabulary.

Texts are cut where a cut can't change a token: before a space that follows a
character that isn't white space.  Word by word, ids come from the tokenizers
library, with a bounded cache of words in each task.

Long texts (``LONG`` bytes and more) are cut into pieces that are encoded in
parallel and put together again.  *Unsplit* text, a single pre-token of more
than ``UNSPLIT`` bytes, has no safe cut; it goes through tree concatenation:
halves of halves are encoded in parallel, and around each join a window of
2, 4, 8 ... tokens a side is encoded again until its first and last tokens are
those that both sides have there.  A sequence is the encoding of its bytes if
and only if each adjacent pair is the encoding of its own bytes; the agreeing
ends make every pair one that was encoded together, so the join is exact.

Edge cases: a null or empty text has no ids and decodes to the empty text;
special-token strings in a text become that token, as the library does;
repeated rows and null doc_ids are encoded each; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm._common import FORGET

#: Texts of more bytes than this are encoded in parallel pieces.
LONG = 1 << 20
PIECE = 1 << 18
#: Pre-tokens of more bytes than this are concatenated from halves.
UNSPLIT = 1 << 12
#: Bytes that a task's cache holds in each of two generations, about: a word
#: takes ``ENTRY`` bytes besides its letters and ids.
CACHE_BYTES = 88 << 20
ENTRY = 120

#: Below this character the library's Unicode tables and ours agree.
LATIN = "\u0250"


def _pretokens():
    """The byte-level vocabularies' pre-token pattern over characters below
    ``LATIN``, whose letters, numbers and white space are spelled out."""
    kinds = {k: "".join(re.escape(c) for c in map(chr, range(ord(LATIN))) if unicodedata.category(c)[0] == k) for k in "LN"}
    space = r"\t-\r \x85\xa0"
    return re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{kinds['L']}]+| ?[{kinds['N']}]+| ?[^{space}{kinds['L']}{kinds['N']}]+"
                      rf"|[{space}]+(?![^{space}])|[{space}]+").findall


_PRETOKENS = _pretokens()
_SAFE = re.compile(r"(?<=\S)(?= )")
#: White space, in any sense, right before a space: no safe cut there.
_BEFORE_SPACE = [c + " " for c in map(chr, range(0x3001)) if c.isspace()]


def _byte_letters() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the rest
    for code points from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Codec:
    """Encoder and decoder of one vocabulary file of the tokenizers library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.no_padding()
        self.tok.no_truncation()
        size = self.tok.get_vocab_size(with_added_tokens=True)
        letters = _byte_letters()
        self.letter = {b: c for c, b in letters.items()}
        self.special = {t.content: i for i, t in self.tok.get_added_tokens_decoder().items()}
        self.plain = all(re.search(r"[^\w.,]", t) for t in self.special)      # no word can be a special token
        self.bytes = [b""] * size
        for token, i in self.tok.get_vocab(with_added_tokens=True).items():
            known = token not in self.special and all(c in letters for c in token)
            self.bytes[i] = bytes(letters[c] for c in token) if known else token.encode()
        self.split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.letter_of = {b: ord(c) for b, c in self.letter.items()}
        # Encodings of " word" by word, in two generations, and of the rest.
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.others: dict[str, bytes] = {}
        self.held = self.held_others = 0
        self.decimal = [str(i) for i in range(size)]

    # ------------------------------------------------------------ encoding

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text, as ``Tokenizer.encode(text, add_special_tokens=False)``."""
        if not text:
            return np.zeros(0, "<u4")
        if text[0] == " " or any(x in text for x in _BEFORE_SPACE):
            out = [self._known(x) for x in _SAFE.split(text)]
        else:
            first, *rest = text.split(" ")
            out = self._spaced(rest)
            if first:
                out.insert(0, self._known(first))
        return np.frombuffer(b"".join(out), "<u4")

    def _spaced(self, words: list[str]) -> list[bytes]:
        """Ids of each word with a space before it."""
        if self.held > CACHE_BYTES:
            self.old, self.young, self.held = self.young, {}, 0
        young, old = self.young, self.old
        out = list(map(young.get, words))
        if None in out:
            for i, x in enumerate(out):
                if x is None:
                    w = words[i]
                    out[i] = x = young.get(w) or old.get(w) or self._new(" " + w)
                    if len(w) <= UNSPLIT // 4 and w not in young:
                        young[w] = x
                        self.held += ENTRY + len(w) + len(x)
        return out

    def _known(self, piece: str) -> bytes:
        """Ids of a piece between safe cuts, or of one pre-token."""
        if piece[0] == " " and len(piece) > 1:
            return self._spaced([piece[1:]])[0]
        x = self.others.get(piece)
        if x is None:
            x = self._new(piece)
            if self.held_others > CACHE_BYTES // 4:
                self.others.clear()
                self.held_others = 0
            if len(piece) <= UNSPLIT // 4:
                self.others[piece] = x
                self.held_others += ENTRY + len(piece) + len(x)
        return x

    def _new(self, piece: str) -> bytes:
        if len(piece) > UNSPLIT // 4:
            return self._unsplit(piece).tobytes()
        if piece.isascii() or max(piece) < LATIN:
            if self.plain:
                body = piece[1:] if piece[0] == " " else piece
                if body.isalpha():
                    return self._token(piece)
                if len(body) > 1 and body[-1] in ".," and body[:-1].isalpha():
                    return self._known(piece[:-1]) + self._known(piece[-1])
            if not any(t in piece for t in self.special):
                tokens = _PRETOKENS(piece)
                return self._token(piece) if len(tokens) == 1 else b"".join([self._known(t) for t in tokens])
        return array("I", self.tok.encode(piece, add_special_tokens=False).ids).tobytes()

    def _token(self, token: str) -> bytes:
        """Ids of one pre-token."""
        mapped = token.encode().decode("latin-1").translate(self.letter_of)
        return array("I", [t.id for t in self.tok.model.tokenize(mapped)]).tobytes()

    def _unsplit(self, text: str) -> np.ndarray:
        """A stretch without safe cuts, pre-token by pre-token."""
        parts = self.pretokens(text)
        return np.concatenate([np.zeros(0, "<u4"), *[self.concatenate([self.leaf(x) for x in leaves(p)]) if kind else
                                                     np.array(p, "<u4") for kind, p in parts]])

    def pretokens(self, text: str) -> list[tuple[bool, object]]:
        """(True, bytes of a pre-token) or (False, ids of shorter ones)."""
        out: list[tuple[bool, object]] = []
        for part in self.split.split(text) if self.split else [text]:
            if part in self.special:
                out.append((False, [self.special[part]]))
                continue
            for token, _ in self.tok.pre_tokenizer.pre_tokenize_str(part) if part else []:
                if len(token) > UNSPLIT:
                    out.append((True, bytes(_LETTERS[c] for c in token)))
                else:
                    out.append((False, [t.id for t in self.tok.model.tokenize(token)]))
        return out

    def leaf(self, raw: bytes) -> np.ndarray:
        """Ids of bytes taken as one pre-token."""
        return np.array([t.id for t in self.tok.model.tokenize("".join(map(self.letter.__getitem__, raw)))], "<u4")

    def join(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Encoding of the bytes of two encodings of one pre-token's parts."""
        if not len(left) or not len(right):
            return np.concatenate([left, right])
        reach = 2
        while True:
            a, b = min(reach, len(left)), min(reach, len(right))
            window = self.leaf(b"".join(self.bytes[i] for i in [*left[len(left) - a:], *right[:b]]))
            left_agrees = a == len(left) or window[0] == left[len(left) - a]
            right_agrees = b == len(right) or window[-1] == right[b - 1]
            if left_agrees and right_agrees:
                return np.concatenate([left[:len(left) - a], window, right[b:]])
            reach *= 2

    def concatenate(self, parts: list[np.ndarray]) -> np.ndarray:
        """Join neighbours, level by level of the tree."""
        while len(parts) > 1:
            parts = [self.join(*parts[i:i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
        return parts[0]

    # ------------------------------------------------------------ decoding

    def decode(self, ids) -> str:
        """As ``Tokenizer.decode(ids, skip_special_tokens=False)``."""
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")


_LETTERS = _byte_letters()
_codecs: dict[str, Codec] = {}
FORGET.append(_codecs.clear)


def codec(path: str) -> Codec:
    """The task process's codec of a vocabulary file."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def leaves(raw: bytes, size: int = UNSPLIT) -> list[bytes]:
    """Halves of halves, down to at most ``size`` bytes."""
    if len(raw) <= size:
        return [raw]
    half = len(raw) // 2
    return leaves(raw[:half], size) + leaves(raw[half:], size)


def pieces(text: str, c: Codec) -> Iterator[tuple[int, bytes]]:
    """A long text as (tree, bytes) pieces: tree 0 is text to be encoded as it
    is; pieces of one tree > 0 are leaves of one unsplit pre-token."""
    tree, have, size = 0, [], 0
    for word in _SAFE.split(text):
        parts = c.pretokens(word) if len(word) > UNSPLIT // 4 else []
        if any(kind for kind, _ in parts):
            if have:
                yield 0, "".join(have).encode()
                have, size = [], 0
            for kind, part in parts:
                if kind:
                    tree += 1
                    for x in leaves(part, PIECE):
                        yield tree, x
                else:
                    yield -1, np.array(part, "<u4").tobytes()      # ids already
            continue
        have.append(word)
        size += len(word)
        if size >= PIECE:
            yield 0, "".join(have).encode()
            have, size = [], 0
    if have:
        yield 0, "".join(have).encode()


IDS = "doc_id long, ids binary"


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                ids = [c.encode(t or "").tobytes() for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary())], names=["doc_id", "ids"])
    return run


def _cut(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for batch in batches:
            for i in range(batch.num_rows):
                key, doc_id, text = (batch.column(k)[i] for k in range(3))
                rows = [(no, tree, raw) for no, (tree, raw) in enumerate(pieces(text.as_py(), c))]
                for lo in range(0, len(rows), 16):
                    some = rows[lo:lo + 16]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key.as_py()] * len(some), pa.int64()), pa.array([doc_id.as_py()] * len(some), pa.int64()),
                         pa.array([r[0] for r in some], pa.int64()), pa.array([r[1] for r in some], pa.int64()),
                         pa.array([r[2] for r in some], pa.binary())], names=["key", "doc_id", "no", "tree", "raw"])
    return run


def _encode_pieces(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for batch in batches:
            ids = []
            for tree, raw in zip(batch.column("tree").to_pylist(), batch.column("raw").to_pylist()):
                if tree < 0:
                    ids.append(raw)
                elif tree == 0:
                    ids.append(c.encode(raw.decode()).tobytes())
                else:
                    ids.append(c.concatenate([c.leaf(x) for x in leaves(raw)]).tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(ids, pa.binary())],
                                             names=["key", "doc_id", "no", "tree", "ids"])
    return run


def _put_together(path: str):
    def run(table: pa.Table) -> pa.Table:
        c = codec(path)
        rows = sorted(zip(table.column("no").to_pylist(), table.column("tree").to_pylist(), table.column("ids").to_pylist()))
        out: list[np.ndarray] = []
        at = 0
        while at < len(rows):
            end = at + 1
            while rows[at][1] > 0 and end < len(rows) and rows[end][1] == rows[at][1]:
                end += 1
            out.append(c.concatenate([np.frombuffer(r[2], "<u4") for r in rows[at:end]]))
            at = end
        ids = np.concatenate([np.zeros(0, "<u4"), *out]).astype("<u4").tobytes()
        return pa.table({"doc_id": table.column("doc_id").slice(0, 1), "ids": pa.array([ids], pa.binary())})
    return run


def _shapes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``doc_id, text`` of the short and of the long texts."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    return docs.where(size <= LONG), docs.where(size > LONG)


def _encoded_long(long: DataFrame, path: str) -> DataFrame:
    """Long texts: cut, encoded piece by piece in parallel, put together."""
    return (long.select(F.monotonically_increasing_id().alias("key"), "doc_id", "text")
            .mapInArrow(_cut(path), "key long, doc_id long, no long, tree long, raw binary")
            .repartition("key", "no")
            .mapInArrow(_encode_pieces(path), "key long, doc_id long, no long, tree long, ids binary")
            .groupBy("key").applyInArrow(_put_together(path), IDS))


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids``: ids of every text as little-endian 32-bit integers."""
    short, long = _shapes(docs)
    return short.mapInArrow(_encode(path), IDS).unionByName(_encoded_long(long, path))


DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _digest(c: Codec, ids: list[int]) -> tuple[int, str, str]:
    return (len(ids), hashlib.sha256(",".join([c.decimal[i] for i in ids]).encode()).hexdigest(),
            hashlib.sha256(c.decode(ids).encode()).hexdigest())


def _digests(path: str, of_text: bool):
    """Digests of texts, which are encoded here, or of ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                if of_text:
                    rows = [_digest(c, c.encode(t.as_py() or "").tolist()) for t in part.column(1)]
                else:
                    rows = [_digest(c, np.frombuffer(raw.as_buffer(), "<u4").tolist()) for raw in part.column(1)]
                n, ids_sha, text_sha = zip(*rows)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(ids_sha), pa.array(text_sha)],
                                                 names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return run


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Round trip of every text: count and digests of ids and decoded text.
    Short texts are encoded and decoded in one pass of one worker."""
    short, long = _shapes(docs)
    return short.mapInArrow(_digests(path, True), DIGESTS).unionByName(
        _encoded_long(long, path).mapInArrow(_digests(path, False), DIGESTS))


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def op5_bpe_round_trip(spark, sf_dir: str) -> DataFrame:
    """Encode and decode every document."""
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), default_vocabulary())


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage (last): the round trip of every remaining row."""
    return digests(docs, default_vocabulary())
