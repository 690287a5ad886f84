"""Deterministic hash buckets: identical on every run, partitioning and engine."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_SPACE = 1 << 32
_MD5_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
_MD5_SINES = [int(abs(x) * HASH_SPACE) for x in np.sin(np.arange(1.0, 65.0))]
_MD5_TURNS = [7, 12, 17, 22] * 4 + [5, 9, 14, 20] * 4 + [4, 11, 16, 23] * 4 + [6, 10, 15, 21] * 4
_AT_ONCE = 60_000


def md5_int(text: Column) -> Column:
    """First 32 bits of md5 as a bigint in [0, 2^32); other SQL engines can repeat it."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def _md5_block(heads: Sequence[bytes], tails: np.ndarray) -> np.ndarray:
    """`md5_ints` of heads of one length and tails of one length (a row of bytes each) that fit one block of 55 bytes."""
    before, size = len(heads[0]), len(heads[0]) + tails.shape[1]
    left = np.frombuffer(b"".join(h.ljust(64, b"\0") for h in heads), "<u4").reshape(-1, 16)
    block = np.zeros((len(tails), 64), np.uint8)
    block[:, before:size] = tails
    block[:, size] = 0x80
    block[:, 56:] = np.frombuffer((8 * size).to_bytes(8, "little"), np.uint8)
    right = block.view("<u4")
    one = (left == left[0]).all(axis=0) & (right == right[0]).all(axis=0)
    words = [int(left[0, i]) + int(right[0, i]) if one[i] else left[:, i, None] + right[:, i] for i in range(16)]
    shape = len(heads), len(tails)
    one = np.full(16, len(heads) * len(tails) == 1) | ((left == left[0]).all(axis=0) & (right == right[0]).all(axis=0))
    words = [int(left[0, i]) + int(right[0, i]) if one[i] else left[:, i, None] + right[:, i] for i in range(16)]
    a, b, c, d = (np.full(shape, x, np.uint32) for x in _MD5_START)
    f = np.empty(shape, np.uint32)
    for i in range(61):  # the last three steps do not reach the first word
        if i < 16:
            np.bitwise_xor(c, d, out=f)
            f &= b
            f ^= d
            word = words[i]
        elif i < 32:
            np.bitwise_xor(b, c, out=f)
            f &= d
            f ^= c
            word = words[(5 * i + 1) % 16]
        elif i < 48:
            np.bitwise_xor(b, c, out=f)
            f ^= d
            word = words[(3 * i + 5) % 16]
        else:
            np.invert(d, out=f)
            f |= b
            f ^= c
            word = words[7 * i % 16]
        a += f
        if isinstance(word, int):
            a += np.uint32((word + _MD5_SINES[i]) % HASH_SPACE)
        else:
            a += word
            a += np.uint32(_MD5_SINES[i])
        np.right_shift(a, np.uint32(32 - _MD5_TURNS[i]), out=f)
        a <<= np.uint32(_MD5_TURNS[i])
        a |= f
        a += b
        a, b, c, d = d, a, b, c
    b += np.uint32(_MD5_START[0])
    return b.byteswap()


def md5_ints(heads: Sequence[bytes], tails: Sequence[bytes]) -> np.ndarray:
    """[head, tail]: `md5_int` of head + tail, for all of both at once. Texts beyond 55 bytes are hashed one by one."""
    out = np.empty((len(heads), len(tails)), np.uint32)

    def by_length(texts: Sequence[bytes]) -> dict[int, list[int]]:
        found: dict[int, list[int]] = {}
        for i, t in enumerate(texts):
            found.setdefault(len(t), []).append(i)
        return found

    for before, rows in by_length(heads).items():
        for after, columns in by_length(tails).items():
            if before + after > 55:
                for r in rows:
                    out[r, columns] = [int.from_bytes(hashlib.md5(heads[r] + tails[c]).digest()[:4], "big") for c in columns]
                continue
            for i in range(0, len(rows), _AT_ONCE):
                some = rows[i : i + _AT_ONCE]
                step = max(1, _AT_ONCE // len(some))
                for j in range(0, len(columns), step):
                    part = columns[j : j + step]
                    texts = np.frombuffer(b"".join(tails[c] for c in part), np.uint8).reshape(len(part), after)
                    made = _md5_block([heads[r] for r in some], texts)
                    if some[-1] - some[0] < len(some) and part[-1] - part[0] < len(part):  # rows and columns on end
                        out[some[0] : some[-1] + 1, part[0] : part[-1] + 1] = made
                    else:
                        out[np.ix_(some, part)] = made
    return out


def md5_ints_of_range(heads: Sequence[bytes], start: int, stop: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first number, [head, number]): `md5_int` of head + decimal number, piece by piece; heads of one length, not many."""
    step = max(1, _AT_ONCE // len(heads))
    while start < stop:
        digits = len(str(start))
        end = min(stop, start + step, 10**digits)
        numbers = np.arange(start, end, dtype=np.uint64)[:, None]
        texts = numbers // 10 ** np.arange(digits - 1, -1, -1, dtype=np.uint64) % np.uint64(10) + np.uint64(48)
        yield start, _md5_block(heads, texts.astype(np.uint8))
        start = end


def hash_int(value: Column, method: str = "crc32") -> Column:
    """Hash of the value's string form as a non-negative bigint below 2^32."""
    text = value.cast("string")
    if method == "crc32":
        return F.crc32(text)
    if method == "md5":
        return md5_int(text)
    if method == "xxhash64":
        return F.xxhash64(text).bitwiseAND(F.lit(HASH_SPACE - 1))
    raise ValueError(f"unknown hash {method!r}")


def percent_bucket(value: Column, method: str = "crc32") -> Column:
    """Stable bucket 0..99 of an id."""
    return F.pmod(hash_int(value, method), F.lit(100)).cast("int")


def split_label(id_col: Column, *, test: float = 0.2, val: float = 0.15, method: str = "crc32") -> Column:
    """'train' / 'val' / 'test' by the id's bucket; ``val=0`` gives the two-way split."""
    bucket = percent_bucket(id_col, method)
    test_from = int(round((1 - test) * 100))
    val_from = int(round((1 - test - val) * 100))
    return (
        F.when(bucket < val_from, F.lit("train"))
        .when(bucket < test_from, F.lit("val"))
        .otherwise(F.lit("test"))
    )


# Poisson(1) distribution function at 0..11, scaled to the 32-bit hash space (fixed values).
def _poisson_cuts() -> list[int]:
    cuts, term, total = [], 0.36787944117144233, 0.0
    for k in range(12):
        total += term
        cuts.append(int(total * HASH_SPACE))
        term /= k + 1
    return cuts


POISSON_CUTS = _poisson_cuts()


def poisson_weight(hash_col: Column) -> Column:
    """Poisson(1) draw from a uniform 32-bit hash, by inverting the distribution function."""
    weight = F.lit(len(POISSON_CUTS))
    for k in reversed(range(len(POISSON_CUTS))):
        weight = F.when(hash_col < POISSON_CUTS[k], F.lit(k)).otherwise(weight)
    return weight
