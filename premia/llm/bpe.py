"""Byte-level BPE through a sentencepiece model that is serialised from a rank file; no tokenizer is trained.

Every vocabulary entry becomes a piece of characters U+0100 + byte, scored by its negative rank, under identity
normalisation. sentencepiece then merges the best-scored neighbours first, leftmost on ties: the lowest rank first.
Texts are cut into pre-tokens by the vocabulary's pattern; a pre-token that is an entry is that entry. Decoding maps
ids back to their bytes.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame

CACHE_PIECES = 200_000
TEXTS = 100
_MAP = {b: 0x100 + b for b in range(256)}


def read_ranks(path: str) -> list[bytes]:
    """Entries of a rank file in the order of their ranks, which must be 0 to n - 1."""
    with open(path, "rb") as f:
        pairs = sorted((int(rank), base64.b64decode(entry)) for entry, rank in map(bytes.split, f))
    if [r for r, _ in pairs] != list(range(len(pairs))):
        raise ValueError(f"{path}: ranks are not 0 to {len(pairs) - 1}")
    return [entry for _, entry in pairs]


def mapped(entry: bytes) -> str:
    return entry.decode("latin-1").translate(_MAP)


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes(out) + bytes([n])


def _field(number: int, value: int | float | bytes) -> bytes:
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def serialise(entries: list[bytes]) -> bytes:
    """A sentencepiece BPE model whose piece ids are the ranks; the unknown piece, never met, comes last."""
    pieces = [_field(1, mapped(e).encode()) + _field(2, -float(rank)) for rank, e in enumerate(entries)]
    pieces.append(_field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2))
    trainer = _field(3, 2) + _field(4, len(pieces)) + _field(40, len(entries)) + _field(41, -1) + _field(42, -1) + _field(43, -1)
    normaliser = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(_field(1, p) for p in pieces) + _field(2, trainer) + _field(3, normaliser)


class Codec:
    """Encodes and decodes within a task; pre-tokens met before come from a bounded cache."""

    def __init__(self, entries: list[bytes], model: bytes, pattern: str):
        self.entries = entries
        self.whole = {e: i for i, e in enumerate(entries)}
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.cut = regex.compile(pattern).findall
        self.known: dict[str, list[int]] = {}

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Token ids of a few texts, whose new pre-tokens are merged in one call."""
        cut = [self.cut(t) for t in texts]
        if len(self.known) > CACHE_PIECES:
            self.known.clear()
        rest = []
        for piece in set().union(*cut).difference(self.known):
            rank = self.whole.get(piece.encode())
            if rank is None:
                rest.append(piece)
            else:
                self.known[piece] = [rank]
        if rest:
            self.known.update(zip(rest, self.pieces.encode([mapped(p.encode()) for p in rest], num_threads=1)))
        return [np.fromiter(chain.from_iterable(map(self.known.__getitem__, found)), dtype="<u4") for found in cut]

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.entries.__getitem__, ids.tolist()))


def codec_in_tasks(docs: DataFrame, path: str, pattern: str):
    """A function for tasks that returns the codec; the vocabulary, whose size is the file's, travels once per executor."""
    entries = read_ranks(path)
    sent = docs.sparkSession.sparkContext.broadcast((entries, serialise(entries)))
    return lambda: Codec(*sent.value, pattern)


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text: str = "text", ids: bool = True) -> DataFrame:
    """Per row: id, ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` and, if ``ids``, the token ids as an array.

    Whole texts; null counts as empty and has no token. ids_sha256 is over the ids as little-endian unsigned 32-bit
    integers, decoded_sha256 over the bytes that decoding gives, which are the text's. Rows are independent: repeated
    rows and null ids come back as they are; other columns are ignored.
    """
    codec = codec_in_tasks(docs, path, pattern)
    slim = docs.select(docs[id_col], docs[text])
    schema = f"`{id_col}` {slim.schema[id_col].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>" if ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec()
        for b in batches:
            for at in range(0, b.num_rows, TEXTS):
                part = b.slice(at, TEXTS)
                n, sha, back, made = [], [], [], []
                for got in c.encode_all([x or "" for x in part.column(1).to_pylist()]):
                    n.append(len(got))
                    sha.append(hashlib.sha256(got.tobytes()).hexdigest())
                    back.append(hashlib.sha256(c.decode(got)).hexdigest())
                    if ids:
                        made.append(got.astype(np.int32))
                cols = [part.column(0), pa.array(n, pa.int64()), pa.array(sha, pa.string()), pa.array(back, pa.string())]
                names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
                yield pa.RecordBatch.from_arrays(cols + ([pa.array(made, pa.list_(pa.int32()))] if ids else []), names=names + (["ids"] if ids else []))

    return slim.mapInArrow(run, schema)
