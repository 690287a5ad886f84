"""Embedding near-duplicates through a pivot-permutation index.

A vector is described by its nearest reference points (pivots). The inverted lists are kept per combination of
``SHARED`` pivots, so a list holds just the vectors that share that many; two vectors whose nearest pivots agree less
are not compared. Within a list cosines are computed in double precision, large lists block by block, and a pair counts
in one list only: that of its smallest shared pivots. Equal vectors are one class first, so copies cost one row.
"""

from __future__ import annotations

import hashlib
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from premia.llm.graph import components
from premia.session import materialize

COSINE = 0.9
PIVOTS = 512
POOL = 8 * PIVOTS
APART = 0.7
NEAR = 8
SHARED = 3
BLOCK = 1024
SHORT = 48
GROUP_ROWS = 40_000


def _stack(raw, kind: str) -> np.ndarray:
    """Unit vectors in double precision, one row each; shorter ones padded with zeros."""
    rows = [np.frombuffer(x, kind) for x in raw]
    out = np.zeros((len(rows), max(map(len, rows), default=0)))
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    out /= np.abs(out).max(axis=1, keepdims=True, initial=0.0) + (out.shape[1] == 0)
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def spread_out(units: np.ndarray, most: int, apart: float = APART) -> np.ndarray:
    """The first at most ``most`` of ``units`` whose cosine to each one taken before is at most ``apart``."""
    free, taken = np.ones(len(units), dtype=bool), []
    while len(taken) < most and free.any():
        taken.append(int(free.argmax()))
        free &= units @ units[taken[-1]] <= apart
        free[taken[-1]] = False
    return units[taken]


def nearest_pivots(units: np.ndarray, pivots: np.ndarray, near: int) -> np.ndarray:
    """The numbers of each vector's ``near`` nearest pivots, ascending."""
    wide = min(units.shape[1], pivots.shape[1])  # beyond it one of the two is zero
    close = units[:, :wide] @ pivots[:, :wide].T
    return np.sort(np.argsort(-close, axis=1, kind="stable")[:, : min(near, len(pivots))], axis=1)


def _owned(near_a: np.ndarray, near_b: np.ndarray, last: np.ndarray, shared: int) -> np.ndarray:
    """Is this list, whose largest pivot is ``last``, the one of the pair's smallest shared pivots?"""
    both = (near_a[:, :, None] == near_b[:, None, :]).any(axis=2) & (near_a <= last[:, None])
    return both.sum(axis=1) == shared


def _short_lists(x, near, rep, n, starts, sizes, last, cosine, shared):
    """Links within lists of few members, all pairs of all lists at once."""
    first, second, top = [], [], []
    for size in np.unique(sizes):
        a, b = np.triu_indices(size, 1)
        at = starts[sizes == size][:, None]
        first.append((at + a).ravel())
        second.append((at + b).ravel())
        top.append(np.repeat(last[sizes == size], len(a)))
    first, second, top = map(np.concatenate, (first, second, top))
    for i in range(0, len(first), 50_000):
        a, b = first[i : i + 50_000], second[i : i + 50_000]
        good = _owned(near[a], near[b], top[i : i + 50_000], shared)
        a, b = a[good], b[good]
        linked = np.einsum("ij,ij->i", x[a], x[b]) >= cosine
        a, b = a[linked], b[linked]
        low = np.minimum(rep[a], rep[b])
        yield pd.DataFrame({"rep": np.concatenate([rep[a], rep[b]]), "n_links": np.concatenate([n[b], n[a]]), "low": np.concatenate([low, low])})


def _long_list(x, near, rep, n, part, crossed, last, cosine, shared) -> pd.DataFrame:
    """Links within a list, or between two blocks of it; each member is tied to the smallest of its local component."""
    held = np.zeros((len(x), last + 1), dtype=np.float32)
    row, col = np.nonzero(near <= last)
    held[row, near[row, col]] = 1
    patterns, of = np.unique(held, axis=0, return_inverse=True)
    owned = patterns @ patterns.T == shared
    used = owned.any(axis=1)[of]  # most members of a dense group share more pivots: another list owns their pairs
    x, rep, n, part, of = x[used], rep[used], n[used], part[used], of[used]
    linked = (x @ x.T >= cosine) & owned[of][:, of]
    if crossed:
        linked &= part[:, None] != part[None, :]
    np.fill_diagonal(linked, False)
    low = rep.copy()
    while len(low):
        seen = np.where(linked, low[None, :], low[:, None]).min(axis=1)
        if (seen >= low).all():
            break
        low = np.minimum(low, seen)
    found = linked.any(axis=1)
    return pd.DataFrame({"rep": rep[found], "n_links": (linked @ n)[found], "low": low[found]})


def list_links(members: pd.DataFrame, kind: str, width: int, cosine: float, shared: int) -> pd.DataFrame:
    """(rep, n_links, low) of the links that the lists of ``members`` own."""
    members = members.sort_values(["key", "one", "two", "rep"], ignore_index=True)
    x = _stack(members["raw"], kind)
    near = np.array(members["pivots"].tolist())
    rep, n, part = (members[c].to_numpy() for c in ("rep", "n", "part"))
    lists = members[["key", "one", "two"]].to_numpy()
    starts = np.flatnonzero(np.r_[True, (lists[1:] != lists[:-1]).any(axis=1)])
    sizes, last = np.diff(np.r_[starts, len(lists)]), lists[starts, 0] % width
    crossed = lists[starts, 1] != lists[starts, 2]
    short = (sizes <= SHORT) & ~crossed
    out = [pd.DataFrame({"rep": rep[:0], "n_links": n[:0], "low": rep[:0]})]
    if short.any():
        out += _short_lists(x, near, rep, n, starts[short], sizes[short], last[short], cosine, shared)
    for s, k, two, top in zip(starts[~short], sizes[~short], crossed[~short], last[~short]):
        at = slice(s, s + k)
        out.append(_long_list(x[at], near[at], rep[at], n[at], part[at], two, int(top), cosine, shared))
    return pd.concat(out, ignore_index=True)


def link_components(vectors: DataFrame, id_col: str = "vec_id", vec: str = "embedding", cosine: float = COSINE,
                    pivots: int = PIVOTS, near: int = NEAR, shared: int = SHARED, block: int = BLOCK,
                    pool: int = POOL, apart: float = APART) -> DataFrame:
    """Per row of ``vectors``: id, n_links, component_id, kept (id = component_id).

    Links: cosine >= ``cosine`` in double precision, found if the two share at least ``shared`` of their ``near``
    nearest pivots, or are equal. Pivots: at most ``pivots`` classes out of the ``pool`` of the smallest hash (the sample
    that the index is fitted on), none closer than cosine ``apart`` to another, so that a group of near copies, however
    large, supplies one or two and its members share the others; every row is indexed. With no more pivots than ``near``
    all rows share them and are one list. Lists above ``block`` members are compared block by block, so no task
    holds more than two blocks of a list and nothing is left out.
    Vectors that are null, empty, zero or hold null or non-finite components link with nothing; of different lengths, the
    shorter counts as padded with zeros. Rows without id link with nothing (component null, kept false). A
    repeated row counts as another vector. Other columns are ignored; an empty table gives an empty result.
    """
    slim = vectors.select(vectors[id_col].cast("long").alias("id"), vectors[vec].alias("v"))
    kind = "<f4" if slim.schema["v"].dataType.elementType.simpleString() == "float" else "<f8"

    def prepare(batches):
        for b in batches:
            raw = []
            for i, v in zip(b.column(0), b.column(1)):
                a = np.array([np.nan if c is None else c for c in v.as_py() or []], dtype=kind) + 0.0
                raw.append(a.astype(kind).tobytes() if i.is_valid and np.isfinite(a).all() and a.any() else None)
            digest = [None if r is None else hashlib.blake2b(r, digest_size=16).digest() for r in raw]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(digest, pa.binary()), pa.array(raw, pa.binary())], names=["id", "digest", "raw"])

    ready = materialize(slim.mapInArrow(prepare, "id long, digest binary, raw binary"))
    classes = materialize(ready.where("digest is not null").groupBy("digest").agg(F.min("id").alias("rep"), F.count("*").alias("n"), F.first("raw").alias("raw")))
    sample = classes.orderBy(F.xxhash64("digest"), "rep").limit(max(pool, pivots)).select("raw").collect()
    points = spread_out(_stack([r["raw"] for r in sample], kind), pivots, apart)
    if len(points) <= near:
        points = points[:shared]
    sent = vectors.sparkSession.sparkContext.broadcast(points)
    shared = max(1, min(shared, len(points)))
    combos = list(combinations(range(min(near, len(points))), shared))
    width = max(2, pivots)

    def describe(batches):
        for b in batches:
            if b.num_rows:
                got = nearest_pivots(_stack([x.as_py() for x in b.column(2)], kind), sent.value, near)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(list(got), pa.list_(pa.int64()))], names=["rep", "n", "raw", "pivots"])

    def post(batches):
        for b in batches:
            if b.num_rows and combos:
                got = np.array(b.column(1).to_pylist())
                keys = np.stack([sum(got[:, c] * width ** (shared - 1 - i) for i, c in enumerate(combo)) for combo in combos], axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(b.column(0).to_numpy(), len(combos)))], names=["key", "rep"])

    indexed = materialize(classes.select("rep", "n", "raw").mapInArrow(describe, "rep long, n long, raw binary, pivots array<long>"))
    lists = indexed.select("rep", "pivots").mapInArrow(post, "key long, rep long")
    sizes = lists.groupBy("key").agg(F.count("*").alias("size")).where("size > 1").select("key", F.ceil(F.col("size") / block).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    placed = lists.join(sizes, "key").select("key", "rep", "blocks", own.alias("part")).select("key", "rep", "part", other.alias("other"))
    placed = materialize(placed.select("key", "rep", "part", F.least("part", "other").alias("one"), F.greatest("part", "other").alias("two")))
    groups = -(-placed.count() // GROUP_ROWS) or 1
    members = placed.join(indexed, "rep").withColumn("home", F.pmod(F.xxhash64("key", "one", "two"), F.lit(groups)))
    compare = lambda group: list_links(group, kind, width, cosine, shared)
    found = materialize(members.groupBy("home").applyInPandas(compare, "rep long, n_links long, low long"))
    named = components(found.select("rep", "low").distinct(), "rep", "low").withColumnRenamed("node", "rep")
    counted = found.groupBy("rep").agg(F.sum("n_links").alias("far"))
    by_class = classes.select("digest", "rep", "n").join(counted, "rep", "left").join(named, "rep", "left").select(
        "digest", (F.col("n") - 1 + F.coalesce("far", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id")
    )
    rows = ready.select("id", "digest").join(by_class, "digest", "left")
    component = F.coalesce("component_id", "id")
    return rows.select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )
