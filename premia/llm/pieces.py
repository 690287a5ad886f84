"""SentencePiece BPE by a table over prefixes, without a merge queue over the text.

The encoding of a text is the one sequence of pieces whose neighbours all stay apart: a pair is compatible if encoding the
two pieces' characters gives the two pieces again. (A merge across a boundary would have to come first in some pair of
neighbours, whose own merges run in the same order there as in the text.) So each prefix has exactly one last piece: of
the pieces that an automaton finds ending there, the one that is compatible with the last piece of the prefix before
it. One pass fills the table, one pass backwards recovers the ids. Characters in no piece become bytes.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

SPACE = "▁"
CACHE_RUNS = 250_000
CACHE_CHARS = 64
CACHE_PAIRS = 2_000_000
TEXTS = 100
_UNKNOWN = -1
_NEVER = float("-inf")


@dataclass(frozen=True)
class Vocabulary:
    """Pieces that merges may build, with their ids and scores; ids of the 256 byte pieces; the model itself."""

    pieces: list[str]
    ids: list[int]
    scores: list[float]
    bytes: list[int]
    model: bytes


def read_model(path: str) -> Vocabulary:
    """Vocabulary of a sentencepiece model file: BPE with byte fallback, without user-defined or unused pieces."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    with open(path, "rb") as f:
        data = f.read()
    model = proto.ModelProto()
    model.ParseFromString(data)
    kind, trainer = proto.ModelProto.SentencePiece, model.trainer_spec
    types = {p.type for p in model.pieces}
    if trainer.model_type != proto.TrainerSpec.BPE or not trainer.byte_fallback or types & {kind.USER_DEFINED, kind.UNUSED}:
        raise ValueError(f"{path}: not a plain BPE model with byte fallback")
    normal = [(p.piece, i, p.score) for i, p in enumerate(model.pieces) if p.type == kind.NORMAL]
    named = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kind.BYTE}
    pieces, ids, scores = map(list, zip(*normal))
    return Vocabulary(pieces, ids, scores, [named[f"<0x{b:02X}>"] for b in range(256)], data)


class PrefixTable:
    """Encodes normalised text; what it learns about pairs of pieces and short runs is kept, within bounds."""

    def __init__(self, vocabulary: Vocabulary):
        self.score = dict(zip(vocabulary.pieces, vocabulary.scores))
        known = set().union(*vocabulary.pieces)
        alone = sorted(known.difference(self.score))  # characters that merge but are no piece by themselves
        self.pieces = vocabulary.pieces + alone
        self.ids = vocabulary.ids + [_UNKNOWN] * len(alone)
        self.size = [len(p) for p in self.pieces]
        self.bytes = vocabulary.bytes
        self.ends = ahocorasick.Automaton()
        for number, piece in enumerate(self.pieces):
            self.ends.add_word(piece, number)
        self.ends.make_automaton()
        self.trails: dict[int, tuple | None] = {}
        self.pairs: dict[int, bool] = {}
        self.runs: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.shown = [str(i) for i in range(max(max(vocabulary.ids), max(vocabulary.bytes)) + 1)]
        inside = any(SPACE in p.lstrip(SPACE) for p in self.pieces)
        breaks = "".join(c for c in "\n\r\t" if c not in known)
        word = f"[^{breaks}]+" if inside else f"{SPACE}*[^{SPACE}{breaks}]+|{SPACE}+"
        # no piece reaches over these cuts, so no merge does
        self.cut = re.compile(f"{word}|[{breaks}]+" if breaks else word).findall

    def trail(self, number: int) -> tuple[list[float], list[str], list[str]] | None:
        """Scores of the merges that build a piece, in order, with its first and last part before and after each; None if
        its characters encode to something else."""
        if number not in self.trails:
            parts = list(self.pieces[number])
            scores, firsts, lasts = [], [parts[0]], [parts[-1]]
            while len(parts) > 1:
                best, at = max((self.score.get(a + b, _NEVER), -i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
                if best == _NEVER:
                    break
                parts[-at : 2 - at] = [parts[-at] + parts[1 - at]]
                scores.append(best)
                firsts.append(parts[0])
                lasts.append(parts[-1])
            self.trails[number] = (scores, firsts, lasts) if len(parts) == 1 else None
        return self.trails[number]

    def compatible(self, a: int, b: int) -> bool:
        """Does the text of pieces ``a`` and ``b`` encode to them? Their merges run best score first, leftmost on ties,
        until one of them or a merge across the boundary is next."""
        left, right = self.trail(a), self.trail(b)
        if left is None or right is None:
            return False
        mine, _, lasts = left
        yours, firsts, _ = right
        i = j = 0
        while True:
            own = mine[i] if i < len(mine) else _NEVER
            other = yours[j] if j < len(yours) else _NEVER
            across = self.score.get(lasts[i] + firsts[j], _NEVER)
            if own >= across and own >= other:
                if own == _NEVER:
                    return True
                i += 1
            elif across >= other:
                return False
            else:
                j += 1

    def table(self, text: str) -> list[int]:
        """Number of the last piece of each prefix's encoding, from the empty prefix on; -1 for a character in no piece."""
        last = [_UNKNOWN] * (len(text) + 1)
        pairs, size, count = self.pairs, self.size, len(self.pieces)
        for end, number in self.ends.iter(text):
            end += 1
            if last[end] != _UNKNOWN:  # there is only one
                continue
            key = last[end - size[number]] * count + number
            good = pairs.get(key)
            if good is None:
                before = last[end - size[number]]
                good = pairs[key] = self.trail(number) is not None if before == _UNKNOWN else self.compatible(before, number)
            if good:
                last[end] = number
        return last

    def run(self, text: str) -> tuple[int, ...]:
        """Ids of a text, recovered backwards from its table."""
        last, at, out = self.table(text), len(text), []
        ids, size = self.ids, self.size
        while at:
            number = last[at]
            known = _UNKNOWN if number == _UNKNOWN else ids[number]
            if known == _UNKNOWN:
                out += [self.bytes[b] for b in reversed(text[at - 1].encode())]
                at -= 1
            else:
                out.append(known)
                at -= size[number]
        out.reverse()
        return tuple(out)

    def encode(self, text: str) -> list[int]:
        """Ids of a normalised text; runs met before come from two generations of a bounded cache."""
        if len(self.runs) > CACHE_RUNS:
            self.runs, self.older = {}, self.runs
        if len(self.pairs) > CACHE_PAIRS:
            self.pairs.clear()
        ids, runs, older = [], self.runs, self.older
        for piece in self.cut(text):
            got = runs.get(piece)
            if got is None:
                got = older.get(piece) or self.run(piece)
                if len(piece) <= CACHE_CHARS:
                    runs[piece] = got
            ids += got
        return ids

    def text_of(self, ids: list[int]) -> str:
        """The ids in decimal, comma-joined."""
        return ",".join(map(self.shown.__getitem__, ids))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text", ids: bool = True) -> DataFrame:
    """Per row: id, ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` and, if ``ids``, the piece ids as an array.

    Equal to the sentencepiece library's encoding of whole texts without begin or end ids; null counts as empty and has no
    piece. Texts are normalised by the model's own rules. ids_sha256 is over the decimal ids joined by commas,
    decoded_sha256 over the UTF-8 of what the library's decoder makes of the ids. Rows are independent: repeated rows and
    null ids come back as they are; other columns are ignored; an empty table gives an empty result.
    """
    vocabulary = read_model(path)
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)
    slim = docs.select(docs[id_col], docs[text])
    schema = f"`{id_col}` {slim.schema[id_col].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>" if ids else ""
    names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"] + (["ids"] if ids else [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = sentencepiece.SentencePieceProcessor(model_proto=sent.value.model)
        table = PrefixTable(sent.value)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        for b in batches:
            for at in range(0, b.num_rows, TEXTS):
                part = b.slice(at, TEXTS)
                got = [table.encode(library.normalize(x or "")) for x in part.column(1).to_pylist()]
                cols = [
                    part.column(0), pa.array([len(i) for i in got], pa.int64()), pa.array([sha(table.text_of(i)) for i in got], pa.string()),
                    pa.array([sha(library.decode(i)) for i in got], pa.string()),
                ]
                if ids:
                    cols.append(pa.array([np.array(i, np.int32) for i in got], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return slim.mapInArrow(run, schema)
