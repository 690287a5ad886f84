"""SimHash near-duplicates: Golay-code fuzzy hashing of fingerprint segments, join and verify.

The perfect binary Golay code (23, 12) places every 23-bit word within 3 bits of exactly one codeword. Give a word its
nearest codeword and, if that is 3 bits away, the five codewords 4 bits away: any two words that differ in at most
2 bits then share a codeword. A 64-bit fingerprint is cut into three segments of at most 23 bits. Two fingerprints
that differ in at most 2 bits agree entirely in one segment (three segments, two errors) and differ in at most 2 bits
in the next one, so they share a key made of the exact segment and a codeword index of its successor. Every
fingerprint has 3 to 18 such keys out of 2^34, and no pair is missed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from premia.llm.graph import components
from premia.session import materialize

SEGMENTS = ((0, 22), (22, 21), (43, 21))
MAX_BITS = 2
PAIR_LIMIT = 64
_GENERATOR = 0b101011100011  # of the Golay code as a cyclic code
_CHUNK = 1 << 15


def _syndrome(v: np.ndarray) -> np.ndarray:
    v = v.copy()
    for bit in range(22, 10, -1):
        v ^= np.where(v >> bit & 1, _GENERATOR << (bit - 11), 0)
    return v


def golay_offsets() -> np.ndarray:
    """2048 x 6: by syndrome, what to xor to a word for its nearby codewords; unused places repeat the first."""
    one = [1 << i for i in range(23)]
    words = [0] + one + [a | b for i, a in enumerate(one) for b in one[:i]]
    words += [a | b | c for i, a in enumerate(one) for j, b in enumerate(one[:i]) for c in one[:j]]
    errors = np.array(words, dtype=np.int64)
    table = np.empty((2048, 6), dtype=np.int64)
    table[_syndrome(errors)] = errors[:, None]
    code = np.arange(1 << 12, dtype=np.int64) << 11
    code ^= _syndrome(code)
    seven = code[np.bitwise_count(code) == 7]
    for e in errors[np.bitwise_count(errors) == 3]:
        table[_syndrome(np.array([e]))[0], 1:] = e ^ seven[seven & e == e]
    return table


def fuzzy_keys(prints: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, key) of every key of every fingerprint."""
    prints = prints.astype(np.uint64)
    parts = [(prints >> np.uint64(at) & np.uint64((1 << size) - 1)).astype(np.int64) for at, size in SEGMENTS]
    at, keys = [], []
    for i, exact in enumerate(parts):
        word = parts[(i + 1) % 3]
        near = word[:, None] ^ table[_syndrome(word)]
        fresh = np.ones(near.shape, dtype=bool)
        fresh[:, 1:] = near[:, 1:] != near[:, :1]
        row, col = np.nonzero(fresh)
        at.append(row)
        keys.append(i << 34 | exact[row] << 12 | near[row, col] >> 11)
    return np.concatenate(at), np.concatenate(keys)


def fingerprint(text: bytes | None) -> int:
    """Majority bits of the XXH64 of all word 3-shingles; 0 without a word."""
    words = (text or b"").lower().split()  # for bytes: A-Z only, cut at 09-0D and 20
    if not words:
        return 0
    shingles = map(b" ".join, zip(words, words[1:], words[2:])) if len(words) > 2 else [b" ".join(words)]
    h = np.fromiter((xxhash.xxh64_intdigest(s, 42) for s in shingles), dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(h), _CHUNK):
        ones += np.unpackbits(h[i : i + _CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row ``(<id_col>, print long)`` per row of ``docs``, over whole texts; null text counts as empty."""

    def run(batches):
        for b in batches:
            made = [fingerprint(x.as_py()) for x in b.column(1).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(made, pa.int64())], names=[id_col, "print"])

    slim = docs.select(docs[id_col], docs[text])
    return slim.mapInArrow(run, f"`{id_col}` {slim.schema[id_col].dataType.simpleString()}, print long")


def links(prints: DataFrame, pair_limit: int = PAIR_LIMIT) -> DataFrame:
    """Pairs ``(a, b)`` of distinct fingerprints (column ``print``) whose closure joins all that differ in <= 2 bits.

    Keys of at most ``pair_limit`` fingerprints are joined and verified pair by pair. The fingerprints of denser keys
    meet at their one-bit neighbours instead: two values within one bit of a common point differ in at most 2 bits, and
    every pair at 2 bits has such a point. That costs 65 rows per fingerprint however many share the key.
    """
    table = golay_offsets()

    def run(batches):
        for b in batches:
            values = b.column(0).to_numpy()
            at, keys = fuzzy_keys(values.view(np.uint64), table)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(values[at])], names=["key", "print"])

    keys = prints.mapInArrow(run, "key long, print long")
    sizes = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    met = materialize(keys.join(sizes, "key"))
    few = met.where(F.col("n") <= pair_limit).select("key", "print")
    differ = F.bit_count(F.col("x.print").bitwiseXOR(F.col("y.print")))
    near = (F.col("x.key") == F.col("y.key")) & (F.col("x.print") < F.col("y.print")) & (differ <= MAX_BITS)
    paired = few.alias("x").join(few.alias("y"), near).select(F.col("x.print").alias("a"), F.col("y.print").alias("b"))
    flips = F.array(F.lit(0).cast("long"), *[F.lit(1 << i if i < 63 else -(1 << 63)).cast("long") for i in range(64)])
    dense = met.where(F.col("n") > pair_limit).select("print").distinct()
    points = dense.select("print", F.explode(F.transform(flips, lambda f: F.col("print").bitwiseXOR(f))).alias("point"))
    centre = points.groupBy("point").agg(F.min("print").alias("a"), F.count("*").alias("n")).where("n > 1").select("point", "a")
    starred = points.join(centre, "point").where("a <> print").select("a", F.col("print").alias("b"))
    return paired.unionByName(starred).distinct()


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: its id, ``fingerprint`` (16 hex digits) and ``component_id``.

    Fingerprints link at 2 or fewer differing bits; component_id is the smallest id reachable, the row's own included.
    Null and empty texts have fingerprint zero and link like any other. A row without id is in its component but names
    none (component_id is null if no row of the component has an id). Repeated rows give repeated rows. Other columns
    are ignored. An empty table gives an empty result.
    """
    made = materialize(fingerprints(docs, id_col, text))
    classes = materialize(made.groupBy("print").agg(F.min(id_col).alias("low")))
    found = components(links(classes.select("print")), "a", "b")
    member = classes.join(found.select(F.col("node").alias("print"), "component"), "print", "left").withColumn(
        "component", F.coalesce("component", "print")
    )
    lowest = member.groupBy("component").agg(F.min("low").alias("component_id"))
    named = materialize(member.join(lowest, "component").select("print", "component_id"))
    return made.join(named, "print").select(id_col, F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
