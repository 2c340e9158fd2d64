"""SentencePiece encoding that keeps source offsets, and decoding.

The library chooses the pieces. This module repeats the library's
normalisation with its alignment: the longest prefix that the compiled
character map (a double-array trie in the model file) knows is replaced, any
other character is copied, and every byte of the result remembers the source
byte it came from. The pieces' lengths in normalised bytes then project each
piece to a span of bytes of the original text.

Defined cases: a null text is encoded as the empty text, which has no ids and
decodes to the empty text; null doc_ids and repeated rows are encoded like any
other row; extra columns of docs are ignored.
"""

from __future__ import annotations

import hashlib
import struct
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import tokens
from .common import small_batches

BLOCK = "▁".encode()  # the visible space of SentencePiece


def _fields(buf: bytes):
    """(number, value) of each field of a protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        n = shift = 0
        while True:
            b = buf[at]
            at += 1
            n |= (b & 127) << shift
            shift += 7
            if b < 128:
                return n

    while at < len(buf):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        elif kind == 2:
            n = varint()
            yield tag >> 3, buf[at : at + n]
            at += n
        else:
            n = 4 if kind == 5 else 8
            yield tag >> 3, buf[at : at + n]
            at += n


@dataclass
class Normaliser:
    """Longest-prefix normalisation with alignment, set up as a model file says."""

    charsmap: bytes = b""
    add_dummy_prefix: bool = True
    remove_extra_whitespaces: bool = True
    escape_whitespaces: bool = True
    space_as_suffix: bool = False
    _units: np.ndarray | None = field(default=None, repr=False)
    _strings: bytes = b""

    def __post_init__(self) -> None:
        if self.charsmap:
            (size,) = struct.unpack_from("<I", self.charsmap)
            self._units = np.frombuffer(self.charsmap, "<u4", size // 4, 4)
            self._strings = self.charsmap[4 + size :]

    def prefix(self, text: bytes, at: int) -> tuple[bytes, int]:
        """What replaces the text's longest known prefix from `at`, and the prefix's length."""
        units, best = self._units, None
        if units is not None:
            node = int(units[0])
            pos = (node >> 10) << ((node & 512) >> 6)
            for n, b in enumerate(text[at:], 1):
                pos ^= b
                if pos >= len(units):
                    break
                node = int(units[pos])
                if node & 0x800000FF != b:
                    break
                pos ^= (node >> 10) << ((node & 512) >> 6)
                if node & 256:
                    best = (int(units[pos]) & 0x7FFFFFFF, n)
        if best is not None:
            start = best[0]
            return self._strings[start : self._strings.index(b"\0", start)], best[1]
        lead = text[at]
        n = 1 if lead < 128 else 2 if lead < 224 else 3 if lead < 240 else 4
        return text[at : at + n], n

    def __call__(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """The normalised bytes, and for each of them and for their end the source byte."""
        if not text:
            return b"", np.zeros(1, np.int64)
        if self._units is None and not self.remove_extra_whitespaces and self.escape_whitespaces and not self.space_as_suffix:
            b = np.frombuffer(text, np.uint8)
            source = np.repeat(np.arange(len(b)), np.where(b == 32, 3, 1))
            out = text.replace(b" ", BLOCK)
            head = 3 * self.add_dummy_prefix
            return (BLOCK + out if head else out), np.concatenate([np.zeros(head, np.int64), source, [len(b)]])
        space = BLOCK if self.escape_whitespaces else b" "
        out, source, at = bytearray(), [], 0
        while self.remove_extra_whitespaces and at < len(text):
            got, n = self.prefix(text, at)
            if got != b" ":
                break
            at += n
        if at == len(text):
            return b"", np.zeros(1, np.int64)

        def put(piece: bytes, of: int) -> None:
            out.extend(piece)
            source.extend([of] * len(piece))

        if self.add_dummy_prefix and not self.space_as_suffix:
            put(space, at)
        after_space = self.remove_extra_whitespaces
        while at < len(text):
            got, n = self.prefix(text, at)
            if after_space:
                got = got.lstrip(b" ")
            if got:
                put(got.replace(b" ", space), at)
                after_space = got.endswith(b" ") and self.remove_extra_whitespaces
            at += n
            if not self.remove_extra_whitespaces:
                after_space = False
        while self.remove_extra_whitespaces and out.endswith(space):
            at = source[len(out) - len(space)]
            del out[-len(space) :], source[-len(space) :]
        if self.add_dummy_prefix and self.space_as_suffix:
            put(space, at)
        return bytes(out), np.array([*source, at])


class Codec:
    """A model file: the library's processor, the normaliser, and the pieces' lengths."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        spec, suffix, lengths, self.single = {}, False, [], []
        for n, value in _fields(model):
            if n == 1:
                piece = dict(_fields(value))
                self.single.append(piece.get(3, 1) == 6)  # a byte piece
                lengths.append(1 if self.single[-1] else len(piece.get(1, b"")))
            elif n == 2:
                suffix = bool(dict(_fields(value)).get(24, 0))
            elif n == 3:
                spec = dict(_fields(value))
        self.lengths, self.single = np.array(lengths), np.array(self.single)
        self.normaliser = Normaliser(spec.get(2, b""), bool(spec.get(3, 1)), bool(spec.get(4, 1)), bool(spec.get(5, 1)), suffix)

    def spans(self, text: str, ids: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """First and last + 1 byte, in the UTF-8 of text, of each piece.

        Of a character that fell back to bytes, the last byte's piece has the
        character's span and those before it are empty.
        """
        normal, source = self.normaliser(text.encode())
        pieces = np.asarray(ids, np.int64)
        ends = np.cumsum(self.lengths[pieces])
        if len(pieces) and ends[-1] != len(normal):
            raise ValueError("the pieces don't make up the normalised text")
        starts = ends - self.lengths[pieces]
        b = np.frombuffer(normal, np.uint8)
        byte = self.single[pieces]
        if byte.any():
            head = np.maximum.accumulate(np.where((b & 0xC0) != 0x80, np.arange(len(b)), 0))
            first = np.where(byte, head[np.minimum(starts, len(b) - 1)], starts)
            inner = byte & (ends < len(b)) & ((b[np.minimum(ends, len(b) - 1)] & 0xC0) == 0x80)
            starts, ends = first, np.where(inner, first, ends)
        return source[starts], source[ends]


@lru_cache(4)
def codec(model: bytes) -> Codec:
    return Codec(model)


def load(path: str) -> bytes:
    """The model file, read on the driver; it travels to the workers with the code."""
    with open(path, "rb") as f:
        return f.read()


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def _encoded(parts, model: bytes):
    """Batches of doc_id and text -> doc_id, ids, starts, ends."""
    own = Codec(model)
    for part in parts:
        for batch in tokens.batches(part, most=1 << 20):
            texts = [t or "" for t in _column(batch, "text").to_pylist()]
            ids = own.processor.encode(texts, num_threads=1)
            at = np.cumsum([0, *map(len, ids)])
            flat = np.fromiter(chain.from_iterable(ids), np.int32, at[-1])
            spans = [own.spans(t, flat[i:j]) for t, i, j in zip(texts, at[:-1], at[1:], strict=True)]
            listed = [pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(x, pa.int32())) for x in (flat, *(np.concatenate([s[k] for s in spans]).astype(np.int32) for k in (0, 1)))]
            yield pa.RecordBatch.from_arrays([_column(batch, "doc_id"), *listed], ["doc_id", "ids", "starts", "ends"])


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All items of a column of lists, and the n + 1 places where lists start (null: empty)."""
    return column.flatten().to_numpy(zero_copy_only=False), np.append(0, np.cumsum(column.value_lengths().fill_null(0).to_numpy()))


def _decoded(parts, model: bytes):
    """Batches with ids -> the same columns, and text."""
    own = Codec(model)
    for part in parts:
        flat, at = _lists(_column(part, "ids"))
        flat = flat.tolist()
        texts = [own.processor.decode(flat[i:j]) for i, j in zip(at[:-1], at[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*part.schema.names, "text"])


def _digested(parts):
    """Batches of encoded and decoded texts -> what digests() returns."""
    names = [str(i) for i in range(1 << 16)]
    name = lambda i: names[i] if i < len(names) else str(i)
    for part in parts:
        (ids, at), (starts, at_starts), (ends, at_ends) = (_lists(_column(part, c)) for c in ("ids", "starts", "ends"))
        if not (np.array_equal(at, at_starts) and np.array_equal(at, at_ends)):
            raise ValueError("the ids and their spans differ in number")
        spans = np.column_stack([starts, ends]).astype("<i4")
        pick = names.__getitem__ if not len(ids) or ids.max() < len(names) else name
        ids = ids.tolist()
        sha = lambda b: hashlib.sha256(b).hexdigest()
        rows = [(sha(",".join(map(pick, ids[i:j])).encode()), sha(spans[i:j].tobytes()), sha(t.as_py().encode())) for i, j, t in zip(at[:-1], at[1:], _column(part, "text"), strict=True)]
        digests = list(zip(*rows, strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([_column(part, "doc_id"), pa.array(np.diff(at)), *(pa.array(d, pa.string()) for d in digests)], ["doc_id", "n_tokens", "ids_sha256", "spans_sha256", "decoded_sha256"])


def encode(docs: DataFrame, model: bytes) -> DataFrame:
    """doc_id, ids, and starts and ends: each piece's span of bytes in the original text."""
    small_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(lambda parts: _encoded(parts, model), "doc_id long, ids array<int>, starts array<int>, ends array<int>")


def decode(encoded: DataFrame, model: bytes) -> DataFrame:
    """doc_id and the text that the library decodes from ids (null ids: empty)."""
    small_batches(encoded.sparkSession)
    return encoded.select("doc_id", "ids").mapInArrow(lambda parts: _decoded(parts, model), "doc_id long, ids array<int>, text string").drop("ids")


def digests(docs: DataFrame, model: bytes) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the ids, of their spans and of the decoded text.

    The steps of encode() and decode() in one pass of each batch: only digests leave
    the worker. A span's bytes are its start and end as little-endian 32-bit numbers.
    """
    small_batches(docs.sparkSession)
    schema = "doc_id long, n_tokens long, ids_sha256 string, spans_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", "text").mapInArrow(lambda parts: _digested(_decoded(_encoded(parts, model), model)), schema)
