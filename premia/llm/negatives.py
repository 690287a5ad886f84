"""Hard negatives through a multiway hyperplane tree.

A node of the tree has a few split points; a vector goes to the nearest. For every split point and every subtree beside or
under it the node stores the range of distances from the point to the subtree's vectors. A search wants the vectors
whose inner product with the anchor lies in a window, which is an annulus around the anchor: a subtree is left out when,
from one of the split points, its range cannot meet the annulus. The leaves that remain are read in full,
so results are exact. Split points come from a bounded sample, ranges from all rows.

Searches go in two rounds: a few likely leaves give a k-th best score, which narrows the window for the other leaves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from premia.session import materialize

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
WINDOW = (50, 95)  # per cent of the positive's score
SAMPLE = 8_192
FANOUT = 12
LEAF_SAMPLE = 32
PROBES = 3
BLOCK = 2_048
_FAR = np.iinfo(np.int64).max // 200  # no score of exact arithmetic lies beyond
_SLACK = 1e-6


@dataclass
class Node:
    """Split points (rows), and per child its number among nodes (>= 0) or leaves (~number); ranges are filled from the data."""

    points: np.ndarray
    children: list[int]
    low: np.ndarray = field(default=None)  # [child, point]: least distance from the point to the child's vectors
    high: np.ndarray = field(default=None)
    norms: np.ndarray = field(default=None)  # [child, 2]: least and largest squared norm


def unpack(raw) -> np.ndarray:
    """Packed integer vectors as rows; shorter ones padded with zeros."""
    rows = [np.frombuffer(x, "<f8") for x in raw]
    out = np.zeros((len(rows), max(map(len, rows), default=0)))
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows, exact: in double precision while every sum is below 2^53, else in whole numbers, which end
    at +-``_FAR``."""
    wide = min(a.shape[1], b.shape[1])
    a, b = a[:, :wide], b[:, :wide]
    if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(wide, 1) < 2.0**53:
        return np.rint(a @ b.T).astype(np.int64)
    whole = lambda m: np.array([[int(x) for x in r] for r in m], dtype=object).reshape(m.shape)
    return np.clip(whole(a) @ whole(b).T, -_FAR, _FAR).astype(np.int64)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    wide = max(a.shape[1], b.shape[1])
    a, b = (np.pad(m, ((0, 0), (0, wide - m.shape[1]))) for m in (a, b))
    return np.sqrt(np.maximum((a**2).sum(1)[:, None] + (b**2).sum(1)[None, :] - 2 * (a @ b.T), 0))


def plant(sample: np.ndarray, fanout: int = FANOUT, leaf: int = LEAF_SAMPLE) -> list[Node]:
    """Nodes, the root first, over a sample: split points farthest first, until a subtree has at most ``leaf`` of the sample."""
    nodes, leaves = [], 0
    open_sets = [sample]
    while len(nodes) < len(open_sets):
        x = open_sets[len(nodes)]
        taken, apart = [0], distances(x, x[:1])[:, 0]
        while len(taken) < fanout and apart.max(initial=0) > 0:
            taken.append(int(apart.argmax()))
            apart = np.minimum(apart, distances(x, x[taken[-1:]])[:, 0])
        of = distances(x, x[taken]).argmin(axis=1)
        children = []
        for i in range(len(taken)):
            part = x[of == i]
            if len(part) > leaf and len(taken) > 1:
                children.append(len(open_sets))
                open_sets.append(part)
            else:
                children.append(~leaves)
                leaves += 1
        nodes.append(Node(x[taken], children))
    return nodes


def descend(nodes: list[Node], x: np.ndarray):
    """Yields per node reached (node number, rows there, their distances to its points, the child each goes to)."""
    todo = [(0, np.arange(len(x)))]
    while todo:
        number, at = todo.pop()
        node = nodes[number]
        far = distances(x[at], node.points)
        child = far.argmin(axis=1)
        yield number, at, far, child
        for i, below in enumerate(node.children):
            if below >= 0 and (child == i).any():
                todo.append((below, at[child == i]))


def leaf_of(nodes: list[Node], x: np.ndarray) -> np.ndarray:
    out = np.zeros(len(x), dtype=np.int32)
    for number, at, _, child in descend(nodes, x):
        below = np.array(nodes[number].children)[child]
        out[at[below < 0]] = ~below[below < 0]
    return out


def route(nodes: list[Node], q: np.ndarray, least: np.ndarray, most: np.ndarray) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
    """(queries, leaf, distance to the leaf's split point) of the leaves that may hold a score in [least, most].

    With |x|^2 in [a, b], such a vector lies at a distance of sqrt(|q|^2 + a - 2 most) to sqrt(|q|^2 + b - 2 least).
    """
    own = (q**2).sum(axis=1)
    todo = [(0, np.arange(len(q)))]
    while todo:
        number, at = todo.pop()
        node = nodes[number]
        far = distances(q[at], node.points)
        for i, below in enumerate(node.children):
            if node.norms is None or node.norms[i, 0] > node.norms[i, 1]:
                continue  # no row went there
            outer = np.sqrt(np.maximum(own[at] + node.norms[i, 1] - 2.0 * least[at], 0)) * (1 + _SLACK) + _SLACK
            inner = np.sqrt(np.maximum(own[at] + node.norms[i, 0] - 2.0 * most[at], 0)) * (1 - _SLACK) - _SLACK
            meets = (node.low[i] <= (far + outer[:, None]) * (1 + _SLACK)) & (node.high[i] * (1 + _SLACK) >= far - outer[:, None]) & ((far + node.high[i]) * (1 + _SLACK) >= inner[:, None])
            good = meets.all(axis=1)
            if good.any():
                if below >= 0:
                    todo.append((below, at[good]))
                else:
                    yield at[good], ~below, far[good, i]


def _partial_ranges(nodes: list[Node], batches, width: int):
    """(node, child, point, low, high, norm low, norm high) over the rows of a task."""
    found = {}
    for b in batches:
        if not b.num_rows:
            continue
        x = unpack(v.as_py() for v in b.column(0))
        norm = (x**2).sum(axis=1)
        for number, at, far, child in descend(nodes, x):
            for i in np.unique(child):
                f, n = far[child == i], norm[at[child == i]]
                new = np.stack([f.min(0), f.max(0), np.full(f.shape[1], n.min()), np.full(f.shape[1], n.max())])
                old = found.get((number, i))
                if old is not None:
                    new[0::2], new[1::2] = np.minimum(old[0::2], new[0::2]), np.maximum(old[1::2], new[1::2])
                found[number, i] = new
    rows = [(n, int(c), p, *map(float, v[:, p])) for (n, c), v in found.items() for p in range(v.shape[1])]
    cols = list(zip(*rows)) or [()] * 7
    types = [pa.int32()] * 3 + [pa.float64()] * 4
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["node", "child", "point", "a", "b", "c", "d"])


def grow(items: DataFrame, sample: int, fanout: int, leaf: int) -> list[Node]:
    """The tree over ``items`` (digest, raw): planted on the ``sample`` of the smallest digests' hashes, ranges over all rows."""
    drawn = items.select("digest", "raw").distinct().orderBy(F.xxhash64("digest"), "digest").limit(sample).collect()
    nodes = plant(unpack(r["raw"] for r in drawn), fanout, leaf)
    sent = items.sparkSession.sparkContext.broadcast(nodes)
    partial = items.select("raw").mapInArrow(lambda batches: _partial_ranges(sent.value, batches, fanout), "node int, child int, point int, a double, b double, c double, d double")
    ranges = partial.groupBy("node", "child", "point").agg(F.min("a"), F.max("b"), F.min("c"), F.max("d")).collect()  # at most nodes x fanout^2
    for n in nodes:
        k = len(n.children)
        n.low, n.high, n.norms = np.full((k, k), np.inf), np.full((k, k), -np.inf), np.tile([np.inf, -np.inf], (k, 1))
    for number, child, point, a, b, c, d in ranges:
        n = nodes[number]
        n.low[child, point], n.high[child, point], n.norms[child] = a, b, (c, d)
    return nodes


def _best(score: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of each row's k largest allowed scores, earlier columns first on ties."""
    left = np.where(allowed, score, np.iinfo(np.int64).min)
    rows, cols = [], []
    at = np.arange(len(left))
    for _ in range(min(k, left.shape[1])):
        col = left.argmax(axis=1)
        has = left[at, col] > np.iinfo(np.int64).min
        rows.append(at[has])
        cols.append(col[has])
        left[at, col] = np.iinfo(np.int64).min
    return np.concatenate(rows or [at[:0]]), np.concatenate(cols or [at[:0]])


def _scan(asked: pd.DataFrame, rows: pd.DataFrame, same: bool, k: int) -> pd.DataFrame:
    """Per query of a block its first ``k`` rows of the same label, or of others, within its window."""
    empty = pd.DataFrame({"query": np.array([], np.int64), "id": np.array([], np.int64), "score": np.array([], np.int64)})
    if asked.empty or rows.empty:
        return empty
    rows = rows.sort_values("id", ignore_index=True)
    codes, of = np.unique(asked["digest"].to_numpy(), return_index=True)
    score = products(unpack(asked["raw"].iloc[of]), unpack(rows["raw"]))[np.searchsorted(codes, asked["digest"].to_numpy())]
    allowed = (asked["label"].to_numpy()[:, None] == rows["label"].to_numpy()[None, :]) == same
    allowed &= (score >= asked["least"].to_numpy()[:, None]) & (score <= asked["most"].to_numpy()[:, None])
    row, col = _best(score, allowed, k)
    return pd.DataFrame({"query": asked["query"].to_numpy()[row], "id": rows["id"].to_numpy()[col], "score": score[row, col]})


def _first(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def search(queries: DataFrame, items: DataFrame, nodes: list[Node], same: bool, k: int, probes: int = PROBES, block: int = BLOCK) -> DataFrame:
    """(query, id, score, place): for each query the first ``k`` of ``items`` by score, then id.

    ``queries``: (query, digest, raw, label, least, most); ``items``: (id, raw, label, leaf). Rows have the query's label if
    ``same``, else another one, and a score in [least, most]. Leaves are read in blocks of about ``block`` rows and their
    queries in blocks as large, so no task holds a whole leaf.
    """
    spark = queries.sparkSession
    sizes = items.groupBy("leaf").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    shelved = materialize(items.join(F.broadcast(sizes), "leaf").withColumn("part", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")))
    sent = spark.sparkContext.broadcast(nodes)

    def routed(batches, first: bool):
        for b in batches:
            if not b.num_rows:
                continue
            q = unpack(v.as_py() for v in b.column(1))
            least, most = (b.column(i).to_numpy(zero_copy_only=False).astype(float) for i in (2, 3))
            got = list(route(sent.value, q, least, most))
            at = np.concatenate([g[0] for g in got]) if got else np.array([], np.int64)
            leaf = np.concatenate([np.full(len(g[0]), g[1], np.int32) for g in got]) if got else np.array([], np.int32)
            far = np.concatenate([g[2] for g in got]) if got else np.array([], float)
            order = np.lexsort((leaf, far, at))
            at, leaf = at[order], leaf[order]
            nth = np.arange(len(at)) - np.searchsorted(at, at)
            pick = (nth < probes) if first else np.ones(len(at), bool)
            number = b.column(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array(number[at[pick]]), pa.array(leaf[pick], pa.int32())], names=["query", "leaf"])

    def visit(asked: DataFrame, first: bool, seen: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        pairs = asked.select("query", "raw", "least", "most").mapInArrow(lambda bs: routed(bs, first), "query long, leaf int")
        if seen is not None:
            pairs = pairs.join(seen, ["query", "leaf"], "left_anti")
        pairs = materialize(pairs)
        loads = pairs.groupBy("leaf").agg(F.ceil(F.count("*") / block).cast("int").alias("groups"))
        both = sizes.join(loads, "leaf")  # a row per leaf
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        left = pairs.join(F.broadcast(both), "leaf").withColumn("group", F.pmod(F.xxhash64("query"), F.col("groups")).cast("int"))
        left = left.select("query", "leaf", "group", every("blocks").alias("part")).join(asked, "query")
        right = shelved.drop("blocks").join(F.broadcast(loads), "leaf").select("leaf", "part", "id", "raw", "label", every("groups").alias("group"))
        keys = ["leaf", "part", "group"]
        scan = lambda a, r: _scan(a, r, same, k)
        return pairs, left.groupBy(keys).cogroup(right.groupBy(keys)).applyInPandas(scan, "query long, id long, score long")

    seen, found = visit(queries, True, None)
    found = materialize(_first(found, k))
    worst = found.groupBy("query").agg(F.min("score").alias("worst"), F.count("*").alias("n")).where(F.col("n") == k).select("query", "worst")
    narrowed = queries.join(worst, "query", "left").withColumn("least", F.greatest("least", F.coalesce("worst", "least"))).drop("worst")
    _, more = visit(materialize(narrowed), False, seen)
    return materialize(_first(found.drop("place").unionByName(more), k))


def vectors(table: DataFrame, id_col: str, vec: str, label: str) -> DataFrame:
    """(id, label, digest, raw) of the rows that take part: components become floor(256 x), one row per id."""
    slim = table.select(table[id_col].cast("long").alias("id"), table[label].cast("long").alias("label"), table[vec].cast("array<double>").alias("v"))
    slim = slim.where("id is not null and label is not null and v is not null")

    def pack(batches):
        for b in batches:
            raw = []
            for v in b.column(2):
                a = np.array([np.nan if c is None else c for c in v.as_py()], dtype="<f8")
                raw.append(np.floor(SCALE * a).tobytes() if np.isfinite(a).all() else None)
            digest = [None if r is None else hashlib.blake2b(r, digest_size=16).digest() for r in raw]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(digest, pa.binary()), pa.array(raw, pa.binary())], names=["id", "label", "digest", "raw"])

    made = slim.mapInArrow(pack, "id long, label long, digest binary, raw binary").where("digest is not null")
    first = Window.partitionBy("id").orderBy("label", "digest")
    return materialize(made.withColumn("n", F.row_number().over(first)).where("n = 1").drop("n"))


def hard_negatives(table: DataFrame, id_col: str = "vec_id", vec: str = "embedding", label: str = "label", anchor_every: int = 50,
                   positives: int = POSITIVES, negatives: int = NEGATIVES, window: tuple[int, int] = WINDOW, sample: int = SAMPLE,
                   fanout: int = FANOUT, leaf: int = LEAF_SAMPLE, probes: int = PROBES, block: int = BLOCK) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Components become floor(256 x); a score is the integer inner product. Anchors are the rows whose id is divisible by
    ``anchor_every``; an anchor's positives are its first rows of the same label by score, then id. For each, the first
    ``negatives`` rows of another label with a score of ``window`` per cent of the positive's are returned. The tree is
    fitted on ``sample`` vectors; every row is indexed and the result is exact.
    Rows with a null id, label or vector, or with a null or non-finite component take no part; an empty or short vector counts
    as padded with zeros. An id names one vector: of rows with the same id the one of the smallest label, then of the smallest
    digest of the vector, counts. Rows of equal vector and label are one class, of which only the smallest ids can be
    among the first. Scores beyond about 4 * 10^16 in size end there. Other columns are ignored; no anchor, or no row of
    another label in the window, gives no row; an empty table gives an empty result.
    """
    rows = vectors(table, id_col, vec, label)
    low = Window.partitionBy("digest", "label").orderBy("id")
    items = materialize(rows.withColumn("n", F.row_number().over(low)).where(F.col("n") <= max(positives + 1, negatives)).drop("n"))
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if items.isEmpty():
        return table.sparkSession.createDataFrame([], schema)
    nodes = grow(items, sample, fanout, leaf)
    sent = table.sparkSession.sparkContext.broadcast(nodes)

    def shelve(batches):
        for b in batches:
            if b.num_rows:
                at = leaf_of(sent.value, unpack(v.as_py() for v in b.column(2)))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at, pa.int32())], names=["id", "label", "raw", "leaf"])

    shelved = materialize(items.select("id", "label", "raw").mapInArrow(shelve, "id long, label long, raw binary, leaf int"))
    anchors = materialize(rows.where(F.col("id") % anchor_every == 0))
    asked = anchors.groupBy("digest", "label").agg(F.min("id").alias("query"), F.first("raw").alias("raw"))
    asked = materialize(asked.withColumns({"least": F.lit(-_FAR), "most": F.lit(_FAR)}))
    near = search(asked, shelved, nodes, True, positives + 1, probes, block)
    classes = asked.select("digest", "label", "query")
    mine = anchors.select(F.col("id").alias("anchor_id"), "digest", "label").join(classes, ["digest", "label"]).select("anchor_id", "query")
    chosen = mine.join(near.select("query", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "query").where("anchor_id <> positive_id")
    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    chosen = materialize(chosen.withColumn("n", F.row_number().over(order)).where(F.col("n") <= positives).drop("n"))

    # whole scores s with lo p <= 100 s <= hi p
    floor_of = lambda x: f"({x} - pmod({x}, 100)) div 100"
    lo, hi = window
    windows = chosen.select("query", "positive_score").distinct().select(
        F.col("query").alias("class"), "positive_score", F.expr(f"-({floor_of(f'(-positive_score * {lo}L)')})").alias("least"),
        F.expr(floor_of(f"(positive_score * {hi}L)")).alias("most"),
    ).where("least <= most")
    wanted = windows.join(asked.select(F.col("query").alias("class"), "digest", "raw", "label"), "class")
    wanted = materialize(wanted.withColumn("query", F.monotonically_increasing_id()))
    hard = search(wanted.select("query", "digest", "raw", "label", "least", "most"), shelved, nodes, False, negatives, probes, block)
    named = hard.join(wanted.select("query", "class", "positive_score"), "query").select(
        F.col("class").alias("query"), "positive_score", F.col("place").cast("int").alias("rank"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score")
    )
    return chosen.join(named, ["query", "positive_score"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
