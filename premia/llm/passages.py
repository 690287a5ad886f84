"""Repeated passages by compact windows.

Under one hash function the subsequences of a text that have their minimum at the same place form a compact window: a
node of the Cartesian tree over the hashes of the text's five-word shingles. Only nodes at least WIDTH shingles wide
matter, and those are the minima of the sliding WIDTH-windows. Windows of two hash functions that overlap in WIDTH
shingles are intersected within the text; their two minima make the key, so that one common phrase is not enough. Keys
met in several documents are joined to their first occurrence, and each candidate is verified on the text around both
places, shingle by shingle and with room for words put in or left out, before it counts. Where one fails, all occurrences
of the key are compared to each other, whether they are like the head or not; if they are many, first within groups of those with
the same at one of several distances from the place, which joins most of what is alike, then block by block all that is still apart.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from premia.llm.graph import components
from premia.session import materialize

SHINGLE = 5
WORDS = 50
WIDTH = WORDS - SHINGLE + 1
PAIRS = ((0, 1), (2, 3))
SIDE = 48
RUN = 7
SHIFT = 3
LEAST = 36
SLOT = 8
PAIR_LIMIT = 64
BLOCK = 1024
AT_ONCE = 64
WIDE = SIDE // 2 + 2
PART = 1 << 18
_SEEDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_hashes(text: bytes | None) -> np.ndarray:
    """64-bit hashes of the five-word shingles of a whole text (words cut at 09-0D and 20, A-Z lower-cased)."""
    words = (text or b"").lower().split()
    if len(words) < SHINGLE:
        return np.empty(0, dtype=np.uint64)
    w = np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))
    n = len(w) - SHINGLE + 1
    h = np.zeros(n, dtype=np.uint64)
    for i in range(SHINGLE):
        h = _mix(h * np.uint64(31) + w[i : i + n])
    return h


def wide_nodes(h: np.ndarray, seed: int, width: int = WIDTH) -> np.ndarray:
    """For each start of a ``width``-window the place of its minimum, leftmost on ties; h has fewer than 2^20 values."""
    key = _mix(h ^ np.uint64(seed)) & ~np.uint64((1 << 20) - 1) | np.arange(len(h), dtype=np.uint64)
    starts = len(key) - width + 1
    blocks = -(-len(key) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(key)] = key
    grid = padded.reshape(blocks, width)
    forward = np.minimum.accumulate(grid, axis=1).ravel()
    backward = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(backward[:starts], forward[width - 1 : width - 1 + starts])
    return (least & np.uint64((1 << 20) - 1)).astype(np.int64)


def _codes(h: np.ndarray) -> np.ndarray:
    """Bytes of the two-bit codes of four shingles from each place, SIDE shingles before the text to SIDE after it."""
    two = np.zeros(len(h) + 2 * SIDE + 3, dtype=np.uint8)
    two[SIDE : SIDE + len(h)] = h >> np.uint64(62)
    return two[:-3] << 6 | two[1:-2] << 4 | two[2:-1] << 2 | two[3:]


def windows(text: bytes | None, bare: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, place, around) of the joint windows of a text; around: two-bit codes of the SIDE shingles before the place
    and the SIDE from it on, then how many of both there are. ``bare``: around is left empty."""
    whole = shingle_hashes(text)
    keys, places = [], []
    for at in range(0, max(1, len(whole) - WIDTH + 1), PART):
        h = whole[at : at + PART + WIDTH - 1]
        if len(h) < WIDTH:
            continue
        low = [wide_nodes(h, s) for s in _SEEDS]
        for number, (f, g) in enumerate(PAIRS):
            new = np.flatnonzero(np.concatenate([[True], (np.diff(low[f]) != 0) | (np.diff(low[g]) != 0)]))
            a, b = low[f][new], low[g][new]
            keys.append(_mix(h[a] * np.uint64(3) + _mix(h[b] + np.uint64(number))))
            places.append(a + at)
    if not keys:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty((0, WIDE), np.uint8)
    place = np.concatenate(places)
    if bare:
        return np.concatenate(keys), place, np.empty((len(place), 0), np.uint8)
    around = np.empty((len(place), WIDE), np.uint8)
    around[:, :-2] = _codes(whole)[place[:, None] + np.arange(0, 2 * SIDE, 4)]
    around[:, -2] = np.minimum(place, SIDE)
    around[:, -1] = np.minimum(len(whole) - place, SIDE)
    return np.concatenate(keys), place, around


def _opened(around: np.ndarray, nothing: int) -> np.ndarray:
    """Codes 0 to 3 of the 2 * SIDE shingles of each row; ``nothing`` outside the text."""
    four = around[:, :-2, None] >> np.array([6, 4, 2, 0], np.uint8) & 3
    at = np.arange(-SIDE, SIDE)
    left, right = around[:, -2:-1].astype(int), around[:, -1:].astype(int)
    return np.where((at >= -left) & (at < right), four.reshape(len(around), -1), np.uint8(nothing))


def _in_runs(same: np.ndarray) -> np.ndarray:
    """True where a row has RUN or more true values on end."""
    wide = same.shape[1] - RUN + 1
    start = same[:, :wide].copy()
    for i in range(1, RUN):
        start &= same[:, i : i + wide]
    out = np.zeros_like(same)
    for i in range(RUN):
        out[:, i : i + wide] |= start
    return out


def agreeing(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For rows around two places: verified, first and last offset of what agrees in a, and the same in b.

    A shingle of a agrees if it stands in a run of RUN codes that b has too, at most SHIFT places off. Verified: LEAST of
    WIDTH shingles on end agree. Shifts are only tried where without them too few agree.
    """
    x, y = _opened(a, 4), _opened(b, 5)
    agrees = _in_runs(x == y)
    moved = np.zeros(agrees.shape, np.int8)

    def windowed(agrees):
        total = np.concatenate([np.zeros((len(agrees), 1), np.int16), np.cumsum(agrees, axis=1, dtype=np.int16)], axis=1)
        return total[:, WIDTH:] - total[:, :-WIDTH] >= LEAST

    again = np.flatnonzero(~windowed(agrees).any(axis=1) & agrees.any(axis=1))
    if len(again):
        part, off, u, v = agrees[again], moved[again], x[again], y[again]
        for shift in sorted({*range(-SHIFT, SHIFT + 1)} - {0}, key=abs):
            other = np.full_like(v, 5)
            other[:, max(0, -shift) : v.shape[1] - max(0, shift)] = v[:, max(0, shift) : v.shape[1] + min(0, shift)]
            new = _in_runs(u == other) & ~part
            off[new] = shift
            part |= new
        agrees[again], moved[again] = part, off
    good = windowed(agrees)
    held = np.zeros_like(agrees)
    for i in range(WIDTH):
        held[:, i : i + good.shape[1]] |= good
    held &= agrees
    first = held.argmax(axis=1)
    last = held.shape[1] - 1 - held[:, ::-1].argmax(axis=1)
    rows = np.arange(len(a))
    return good.any(axis=1), first - SIDE, last - SIDE, first - SIDE + moved[rows, first], last - SIDE + moved[rows, last]


def _packed(around: np.ndarray) -> pa.Array:
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(WIDE), len(around), [None, pa.py_buffer(np.ascontiguousarray(around))]).cast(pa.binary())


def _occurrences(docs: DataFrame, bare: bool) -> DataFrame:
    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                made = [windows(x.as_py(), bare) for x in part.column(1).cast(pa.binary())]
                n = [len(k) for k, _, _ in made]
                if not sum(n):
                    continue
                cols = {"key": pa.array(np.concatenate([k for k, _, _ in made]).view(np.int64)), "doc": pa.array(np.repeat(part.column(0).to_numpy(), n))}
                if not bare:
                    cols |= {"place": pa.array(np.concatenate([p for _, p, _ in made]).astype(np.int32)), "around": _packed(np.concatenate([r for _, _, r in made]))}
                yield pa.RecordBatch.from_pydict(cols)

    return docs.mapInArrow(run, "key long, doc long" + ("" if bare else ", place int, around binary"))


def _compared(pairs: DataFrame) -> DataFrame:
    """(doc, a, b, first_doc, c, d) of the verified ``pairs`` (key, doc, place, around, first_doc, first_place, head); of the
    others key, doc, a, around, and first_doc is null."""

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            raw = lambda i: np.frombuffer(b"".join(x.as_py() for x in b.column(i)), np.uint8).reshape(-1, WIDE)
            good, *ends = agreeing(raw(3), raw(6))
            place, there = b.column(2).to_numpy(), b.column(5).to_numpy()
            a, z, c, d = (base + e + more for base, e, more in zip((place, place, there, there), ends, (0, SHINGLE - 1, 0, SHINGLE - 1)))
            kept = lambda x, mask: pa.array(np.asarray(x, dtype=np.int64), mask=mask)
            around = pa.compute.if_else(pa.array(good), pa.scalar(None, pa.binary()), b.column(3))
            yield pa.RecordBatch.from_arrays([
                kept(b.column(0).to_numpy(), good), b.column(1), kept(np.where(good, a, place), None), kept(z, ~good),
                kept(b.column(4).to_numpy(), ~good), kept(c, ~good), kept(d, ~good), around,
            ], names=["key", "doc", "a", "b", "first_doc", "c", "d", "around"])

    return pairs.select("key", "doc", "place", "around", "first_doc", "first_place", "head").mapInArrow(
        run, "key long, doc long, a long, b long, first_doc long, c long, d long, around binary")


def _classes(candidates: DataFrame, compared: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Occurrences (key, u, doc, place) of the keys with one unlike the head; and their classes of equal ``around``, without
    that of the head: (key, u, around, doc, last, root, n), the first and last document, a number that is negative and
    the same for all classes of a key that are like the head, and the classes of the key."""
    failed = compared.where("first_doc is null").select("key", "around")
    members = materialize(candidates.join(failed.select("key").distinct(), "key").withColumn("u", F.xxhash64("around")))
    here = F.col("doc") == F.col("first_doc")
    rows = members.select("key", "u", "around", "doc", F.when(here, F.col("place")).alias("own"), F.when(here, 0).otherwise(1).alias("other"))
    rows = rows.unionByName(failed.select("key", F.xxhash64("around").alias("u"), F.lit(2).alias("other")), allowMissingColumns=True)
    classes = rows.groupBy("key", "u").agg(F.max("around").alias("around"), F.min("doc").alias("doc"), F.max("doc").alias("last"), F.min("own").alias("own"), F.max("other").alias("other"))
    keys = classes.groupBy("key").agg(F.min("own").alias("head"), (F.count("*") - 1).alias("n"))
    least = F.lit(-(1 << 63)).cast("long")
    root = F.when(F.col("other") == 1, F.xxhash64("key").bitwiseOR(least)).otherwise(F.xxhash64("key", "u").bitwiseAND(F.lit((1 << 63) - 1)))
    rest = classes.join(keys, "key").where("own is null or own <> head").select("key", "u", "around", "doc", "last", root.alias("root"), "n")
    return members.select("key", "u", "doc", "place"), materialize(rest)


def _slots(classes: DataFrame) -> DataFrame:
    """(key, u, root, at): a number for the SLOT shingles at each of several distances from the place, where the text has them."""
    byte = lambda i: F.conv(F.hex(F.substring("around", i, 1)), 16, 10).cast("int")
    inside = lambda i: (F.lit(i * SLOT - SIDE) >= -byte(WIDE - 1)) & (F.lit((i + 1) * SLOT - SIDE) <= byte(WIDE))
    code = lambda i: F.conv(F.hex(F.substring("around", i * SLOT // 4 + 1, SLOT // 4)), 16, 10).cast("int")
    codes = [F.when(inside(i), F.lit(i << 2 * SLOT) + code(i)) for i in range(2 * SIDE // SLOT)]
    return classes.select("key", "u", "root", F.explode(F.array_compact(F.array(*codes))).alias("at"))


def _differing(posts: DataFrame) -> DataFrame:
    """``posts`` whose key and ``at`` have several roots, with their number of rows n, and a first and a last one, h and g."""
    row, order = F.struct("u", "root"), F.struct("root", "u")
    groups = posts.groupBy("key", "at").agg(F.count("*").alias("n"), F.min_by(row, order).alias("h"), F.max_by(row, order).alias("g"))
    return posts.join(groups.where("h.root < g.root"), ["key", "at"])


def _to_heads(met: DataFrame) -> DataFrame:
    """Pairs (key, u, v) of each row and the first and the last one of its group, if of another root."""
    each = met.select("key", "u", "root", F.explode(F.array("h", "g")).alias("head")).where("root <> head.root")
    return each.select("key", F.least("u", "head.u").alias("u"), F.greatest("u", "head.u").alias("v"))


def _within(met: DataFrame) -> DataFrame:
    """Pairs (key, u, v) of different roots within groups."""
    met = met.select("key", "at", "u", "root")
    near = [F.col("x.key") == F.col("y.key"), F.col("x.at") == F.col("y.at"), F.col("x.u") < F.col("y.u"), F.col("x.root") != F.col("y.root")]
    return met.alias("x").join(met.alias("y"), near).select("x.key", "x.u", F.col("y.u").alias("v"))


def _by_two(met: DataFrame, pair_limit: int) -> tuple[DataFrame, DataFrame]:
    """Groups by two distances of the rows of ``met`` (key, at, u, root), if of several roots: the rows (key, at, u, root) of those
    of at most ``pair_limit``, and the pairs (key, u, v) of the rows of larger ones with a first and a last one.

    Rows of one root with the same distances are in the same groups: their list of distances stands for them until the groups are known.
    """
    lists = met.groupBy("key", "u").agg(F.min("root").alias("root"), F.sort_array(F.collect_list("at")).alias("ats"))  # a slot each
    lists = materialize(lists.where(F.size("ats") > 1).withColumn("list", F.xxhash64("root", "ats")))
    alike = lists.groupBy("key", "list").agg(F.first("root").alias("root"), F.first("ats").alias("ats"), F.count("*").alias("n"), F.min("u").alias("lo"), F.max("u").alias("hi"))
    numbered = F.transform("ats", lambda p: F.transform(F.filter("ats", lambda q: q > p), lambda q: F.shiftleft(p.cast("long"), 32) + q))
    posts = materialize(alike.select("key", "list", "root", "n", "lo", "hi", F.explode(F.flatten(numbered)).alias("at")))
    ends = F.min(F.struct("root", F.col("lo").alias("u"))).alias("h"), F.max(F.struct("root", F.col("hi").alias("u"))).alias("g")
    groups = posts.groupBy("key", "at").agg(F.sum("n").alias("n"), *ends).where("h.root < g.root")
    dense = materialize(posts.select("key", "at", "list", "root").join(groups, ["key", "at"]))
    rows = lists.select("key", "list", "u")
    few = dense.where(F.col("n") <= pair_limit).join(rows, ["key", "list"]).select("key", "at", "u", "root")
    each = dense.where(F.col("n") > pair_limit).select("key", "list", "root", F.explode(F.array("h", "g")).alias("head")).where("root <> head.root").distinct()
    heads = each.join(rows, ["key", "list"]).select("key", F.least("u", "head.u").alias("u"), F.greatest("u", "head.u").alias("v"))
    return few, heads


def _alike(pairs: DataFrame) -> DataFrame:
    """(key, u, v, a, b, c, d) of the verified ``pairs`` (key, u, v, x, y): from the places, where what agrees begins and ends in both."""

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            raw = lambda i: np.frombuffer(b"".join(x.as_py() for x in b.column(i)), np.uint8).reshape(-1, WIDE)
            good, *ends = agreeing(raw(3), raw(4))
            cols = [b.column(0), b.column(1), b.column(2), *(pa.array(e.astype(np.int64) + more) for e, more in zip(ends, (0, SHINGLE - 1, 0, SHINGLE - 1)))]
            yield pa.RecordBatch.from_arrays(cols, names=["key", "u", "v", "a", "b", "c", "d"]).filter(pa.array(good))

    return materialize(pairs.select("key", "u", "v", "x", "y").mapInArrow(run, "key long, u long, v long, a long, b long, c long, d long"))


def _moved(planes: np.ndarray, by: int) -> np.ndarray:
    """Bits of 128 places in two words [.., 2], first place highest: place p takes that of p + ``by``."""
    if not by:
        return planes
    k, rest, (a, b) = np.uint64(abs(by)), np.uint64(64 - abs(by)), (planes[..., 0], planes[..., 1])
    return np.stack([a << k | b >> rest, b << k] if by > 0 else [a >> k, b >> k | a << rest], axis=-1)


def _planes(around: np.ndarray) -> np.ndarray:
    """[3, row, 2]: the high bits and the low bits of the codes, and which places lie outside the text."""
    bits = np.unpackbits(around[:, :-2], axis=1)
    at = np.arange(-SIDE, SIDE)
    outside = (at < -around[:, -2:-1].astype(int)) | (at >= around[:, -1:].astype(int))
    places = np.stack([bits[:, ::2], bits[:, 1::2], outside])
    wide = np.concatenate([places, np.ones((*places.shape[:2], 128 - 2 * SIDE), places.dtype)], axis=2)
    return np.packbits(wide, axis=2).view(">u8").astype(np.uint64)


def _may_agree(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """[row of x, row of y]: do LEAST or more codes of the two stand in runs of RUN? All pairs that `agreeing` verifies do."""
    total = np.zeros((x.shape[1], y.shape[1], 2), np.uint64)
    x = np.ascontiguousarray(x.transpose(0, 2, 1))[..., None]
    for by in sorted(range(-SHIFT, SHIFT + 1), key=abs):
        other = _moved(y, by)
        if by:  # what comes in from beyond has no code
            other[2] |= ~_moved(np.full(2, np.iinfo(np.uint64).max), by)
        other = np.ascontiguousarray(other.transpose(0, 2, 1))
        words = []
        for w in (0, 1):
            unlike = x[0, w] ^ other[0, w]
            unlike |= x[1, w] ^ other[1, w]
            unlike |= x[2, w]
            unlike |= other[2, w]
            words.append(np.invert(unlike, out=unlike))
        a, b = words
        for k in (1, 2, 3):  # runs of 2, 4 and 7 from each place on
            more = a << np.uint64(k)
            more |= b >> np.uint64(64 - k)
            a &= more
            b &= b << np.uint64(k)
        at = np.nonzero(a | b)
        runs = np.stack([a[at], b[at]], axis=-1)
        for k in (1, 2, 3):
            runs |= _moved(runs, -k)
        total[at] |= runs
    return np.bitwise_count(total).sum(axis=2) >= LEAST


def _joined(roots: np.ndarray, s: np.ndarray, t: np.ndarray) -> np.ndarray:
    """``roots`` after the roots s and t of pairs were joined."""
    low: dict[int, int] = {}

    def find(r: int) -> int:
        while r in low:
            r = low[r]
        return r

    for a, b in zip(s.tolist(), t.tolist()):
        a, b = sorted((find(a), find(b)))
        if a != b:
            low[b] = a
    return np.array([find(r) for r in roots.tolist()], roots.dtype) if low else roots


def _alike_in_block(t: pa.Table) -> list[pa.RecordBatch]:
    """(key, u, v, a, b, c, d) of verified pairs of the rows (key, u, around, doc, last, root, i, lo, hi) of one or two blocks, until all that are alike are joined."""
    t = t.sort_by("root")
    u, doc, last, root, i = (t.column(c).to_numpy() for c in ("u", "doc", "last", "root", "i"))
    raw = np.frombuffer(b"".join(x.as_py() for x in t.column("around")), np.uint8).reshape(-1, WIDE)
    planes, whole = _planes(raw), t.column("lo")[0] == t.column("hi")[0]
    rows = np.arange(len(u)) if whole else np.flatnonzero(i == t.column("lo")[0].as_py())
    columns = rows if whole else np.flatnonzero(i == t.column("hi")[0].as_py())
    out = []
    for at in range(0, len(rows), AT_ONCE):
        some = rows[at : at + AT_ONCE]
        others = columns[columns >= some[0]] if whole else columns
        same = root[some[0]]
        if (root[some] == same).all():
            others = others[root[others] != same]
        if not len(others):
            continue
        p, q = np.nonzero(_may_agree(planes[:, some], planes[:, others]))
        p, q = some[p], others[q]
        good = (root[p] != root[q]) & (np.minimum(doc[p], doc[q]) < np.maximum(last[p], last[q]))
        if whole:
            good &= p < q
        p, q = p[good], q[good]
        for start in range(0, len(p), 1 << 13):
            x, y = p[start : start + (1 << 13)], q[start : start + (1 << 13)]
            apart = root[x] != root[y]
            x, y = x[apart], y[apart]
            if not len(x):
                continue
            like, *ends = agreeing(raw[x], raw[y])
            x, y = x[like], y[like]
            cols = [np.full(len(x), t.column("key")[0].as_py()), u[x], u[y], *(e[like].astype(np.int64) + more for e, more in zip(ends, (0, SHINGLE - 1, 0, SHINGLE - 1)))]
            out.append(pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["key", "u", "v", "a", "b", "c", "d"]))
            root = _joined(root, root[x], root[y])
    return out


def _alike_in_blocks(classes: DataFrame, block: int) -> DataFrame:
    """(key, u, v, a, b, c, d) of verified pairs that join all alike of ``classes`` with one key and different roots.

    Every class meets every other of its key, ``block`` by ``block`` rows at a time, so a task holds two blocks; work grows with the square of a key's classes.
    """
    sizes = classes.groupBy("key").agg(F.ceil(F.count("*") / block).alias("blocks"), F.min("root").alias("x"), F.max("root").alias("y")).where("x < y")
    placed = classes.select("key", "u", "around", "doc", "last", "root").join(sizes.select("key", "blocks"), "key").withColumn("i", F.expr("pmod(xxhash64(u), blocks)"))
    each = placed.withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).withColumns({"lo": F.least("i", "j"), "hi": F.greatest("i", "j")})

    def run(t: pa.Table) -> pa.Table:
        return pa.Table.from_batches(_alike_in_block(t), pa.schema([(c, pa.int64()) for c in ("key", "u", "v", "a", "b", "c", "d")]))

    rows = each.select("key", "u", "around", "doc", "last", "root", "i", "lo", "hi")
    return materialize(rows.groupBy("key", "lo", "hi").applyInArrow(run, "key long, u long, v long, a long, b long, c long, d long"))


def _unlike_heads(candidates: DataFrame, compared: DataFrame, pair_limit: int) -> DataFrame:
    """(doc, a, b, first_doc, other): links among the occurrences of a key that its head doesn't join.

    All classes of keys of at most ``pair_limit`` are compared. In larger keys those meet first that share SLOT shingles at one
    distance from the place: the first and last of each such group with the others, then all of groups of at most
    ``pair_limit``. The classes of larger groups meet by two distances at once. What these steps leave apart is compared
    class by class, in blocks (`_alike_in_blocks`).
    """
    members, classes = _classes(candidates, compared)
    several = F.expr("least(x.doc, y.doc) < greatest(x.last, y.last)")  # of one document there is nothing to link

    def opened(pairs: DataFrame) -> DataFrame:
        x = classes.select("key", "u", "around", "doc", "last").alias("x")
        y = classes.select("key", F.col("u").alias("v"), "around", "doc", "last").alias("y")
        return pairs.distinct().join(x, ["key", "u"]).join(y, ["key", "v"]).where(several).select("key", "u", "v", F.col("x.around").alias("x"), F.col("y.around").alias("y"))

    few = classes.where(F.col("n") <= pair_limit)
    near = [F.col("x.key") == F.col("y.key"), F.col("x.u") < F.col("y.u"), F.col("x.root") != F.col("y.root"), several]
    pairs = few.alias("x").join(few.alias("y"), near).select("x.key", "x.u", F.col("y.u").alias("v"), F.col("x.around").alias("x"), F.col("y.around").alias("y"))
    copies = classes.where("root >= 0 and doc < last").select("key", "u", F.col("u").alias("v"), F.col("around").alias("x"), F.col("around").alias("y"))
    found = _alike(pairs.unionByName(copies))
    crowded = classes.where(F.col("n") > pair_limit)
    if not crowded.isEmpty():
        met = materialize(_differing(_slots(crowded)))
        first = _alike(opened(_to_heads(met)))
        named = lambda n: classes.select("key", F.col("u").alias(n), F.col("root").alias(f"{n}_root"))

        def rooted(rows: DataFrame, alike: DataFrame) -> DataFrame:
            joined = alike.join(named("u"), ["key", "u"]).join(named("v"), ["key", "v"])
            roots = components(joined.select("u_root", "v_root"), "u_root", "v_root").select(F.col("node").alias("root"), "component")
            return rows.join(roots, "root", "left").withColumn("root", F.coalesce("component", "root")).drop("component")

        met = materialize(_differing(rooted(met.select("key", "at", "u", "root"), first)))
        few, heads = _by_two(met.where(F.col("n") > pair_limit), pair_limit)
        more = _alike(opened(_within(met.where(F.col("n") <= pair_limit)).unionByName(_within(few)).unionByName(heads)))
        rest = _alike_in_blocks(materialize(rooted(crowded, first.unionByName(more))), BLOCK)
        found = found.unionByName(first).unionByName(more).unionByName(rest)
    sides = found.select("key", F.inline(F.array(F.struct("u", "v", "a", "b"), F.struct(F.col("v").alias("u"), F.col("u").alias("v"), F.col("c").alias("a"), F.col("d").alias("b")))))
    ends = sides.distinct().join(members, ["key", "u"]).join(classes.select("key", F.col("u").alias("v"), F.col("doc").alias("first"), "last"), ["key", "v"])
    ends = ends.withColumn("other", F.when(F.col("doc") == F.col("first"), F.col("last")).otherwise(F.col("first"))).where("doc <> other")
    return ends.select("doc", (F.col("place") + F.col("a")).alias("a"), (F.col("place") + F.col("b")).alias("b"), F.least("doc", "other").alias("first_doc"), "other")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text: str = "text", pair_limit: int = PAIR_LIMIT) -> DataFrame:
    """Passages that stand in several documents: id, first_word, last_word (from 0), class_id, first_doc.

    One row per maximal span of a document that was verified against another one: of WIDTH shingles on end near the
    place, at least LEAST agree, which allows for a word replaced, put in or left out. first_doc is the smallest id it was verified against or its
    own; class_id the smallest id of the documents reachable by shared passages. Texts under WORDS words, null and empty
    ones have none. Rows without id are left out; rows of equal id count as one document. Ties take the leftmost place. Other
    columns are ignored; an empty table gives an empty result.

    A passage in a third of all documents costs a row per occurrence: occurrences are compared to the first one of
    their key, not to each other, and a passage has many keys. Where some are unlike the first one, as they share a line with it,
    say, all of the key are compared, those like the first one too; of more than ``pair_limit`` unlike ones first those that have SLOT
    equal shingles at one distance from the place, see `_unlike_heads`.
    """
    slim = docs.select(docs[id_col].cast("long").alias("doc"), docs[text].alias("t")).where("doc is not null")
    met = _occurrences(slim, True).groupBy("key").agg(F.min("doc").alias("first_doc"), F.max("doc").alias("last")).where("first_doc < last").select("key", "first_doc")
    candidates = materialize(_occurrences(slim, False).join(met, "key"))
    heads = candidates.where("doc = first_doc").groupBy("key").agg(F.min("place").alias("first_place"), F.min_by("around", "place").alias("head"))
    compared = materialize(_compared(candidates.where("doc <> first_doc").join(heads, "key")))
    more = _unlike_heads(candidates, compared, pair_limit)
    # a class needs one link per pair of documents, a span its ends: both combined before they travel
    ends = compared.where("first_doc is not null").select(F.inline(F.array(
        F.struct("doc", "a", "b", "first_doc", F.col("first_doc").alias("other")),
        F.struct(F.col("first_doc").alias("doc"), F.col("c").alias("a"), F.col("d").alias("b"), "first_doc", F.col("doc").alias("other"))))).unionByName(more)
    found = materialize(ends.groupBy("doc", "other", "first_doc", F.floor(F.col("a") / 64).alias("near")).agg(F.min("a").alias("a"), F.max("b").alias("b")))
    named = components(found.select("doc", "other"), "doc", "other")
    spans = _merged(found.groupBy("doc", "a", "b").agg(F.min("first_doc").alias("first_doc")))
    return spans.join(named.withColumnRenamed("node", "doc"), "doc").select(
        F.col("doc").alias(id_col), F.col("a").alias("first_word"), F.col("b").alias("last_word"), F.col("component").alias("class_id"), "first_doc"
    )


def _merged(spans: DataFrame) -> DataFrame:
    """Unions of overlapping or touching spans of a document."""
    order = W.partitionBy("doc").orderBy("a", "b")
    reach: Column = F.max("b").over(order.rowsBetween(W.unboundedPreceding, -1))
    opened = spans.withColumn("new", F.coalesce((F.col("a") > reach + 1).cast("int"), F.lit(0)))
    runs = opened.withColumn("run", F.sum("new").over(order.rowsBetween(W.unboundedPreceding, 0)))
    return runs.groupBy("doc", "run").agg(F.min("a").alias("a"), F.max("b").alias("b"), F.min("first_doc").alias("first_doc")).drop("run")
