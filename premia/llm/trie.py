"""Prefix trie of conversations, by recursion at half depth.

A block is a conversation's turns from one multiple of 2^k to the next; it has a name made of the names of its halves.
From the top, every level holds the distinct pairs (tree, block). Cutting the blocks at half depth gives the pairs
of the next level: the upper halves stay in their tree, the lower halves form forests whose trees are named after the
cut prefix (tree, upper half). All tries of a level are cut together, so there are as many rounds as the longest
conversation has bits, and equal conversations are one row from the first round on. At height one the pairs are the
nodes. Totals go back up the same cuts: regions of half the height are grafted under the tree they were cut from, then
what lies below a region is added from the largest height to the smallest.
"""

from __future__ import annotations

import hashlib
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from premia.session import materialize

REUSE_STEP = 100
REUSE_TURNS = 6
CHUNK_IDS = 20_000
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def _name(*parts: str):
    """The two longs of a 128-bit name; parts that are null leave it as it is."""
    return [F.xxhash64(F.lit(salt), *parts) for salt in (1, 2)]


def placed_turns(conversations: DataFrame, id_col: str, turn: str, role: str, text: str) -> DataFrame:
    """(c, pos, h, l, size): each turn's place from 1 in its conversation, its name and the code points of its text.

    Turns are ranked within ranges of the whole order, then moved on by the earlier ranges of their conversation: a
    conversation that holds any share of the rows is spread over tasks.
    """
    said, who = F.coalesce(conversations[text], F.lit("")), F.coalesce(conversations[role], F.lit(""))
    slim = conversations.where(conversations[id_col].isNotNull()).select(
        conversations[id_col].cast("long").alias("c"), conversations[turn].alias("t"), who.alias("who"), said.alias("said"), F.length(said).alias("size")
    )
    named = slim.select("c", "t", "who", F.xxhash64(F.lit(1), "who", "said").alias("h"), F.xxhash64(F.lit(2), "who", "said").alias("l"), "size")
    order = ["t", "who", "h", "l"]
    ranged = materialize(named.repartitionByRange("c", *order).withColumn("part", F.spark_partition_id()))
    inside = ranged.withColumn("at", F.row_number().over(Window.partitionBy("c", "part").orderBy(*order)))
    counts = ranged.groupBy("c", "part").agg(F.count("*").alias("rows"))
    several = counts.groupBy("c").agg(F.count("*").alias("parts")).where("parts > 1").select("c")
    earlier = Window.partitionBy("c").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    offsets = counts.join(several, "c", "left_semi").select("c", "part", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"))
    return inside.join(offsets, ["c", "part"], "left").select("c", (F.col("at") + F.coalesce("before", F.lit(0))).alias("pos"), "h", "l", "size")


def rebuilt(conversations: DataFrame, id_col: str, turn: str, role: str, text: str, step: int = REUSE_STEP, turns: int = REUSE_TURNS) -> tuple[DataFrame, DataFrame]:
    """Conversations that start as another one: ``(convs, rows)``.

    The first h = crc32(id) % ``turns`` turns of conversation id - id % ``step`` (all if fewer), then the own ones after
    the first h. convs: (c) for every id; rows: (c, q, h, l, size), places q from 0.
    """
    own = materialize(placed_turns(conversations, id_col, turn, role, text))
    taken = F.crc32(F.col("c").cast("string")) % turns
    sized = own.groupBy("c").agg(F.max("pos").alias("n")).select("c", "n", taken.alias("taken"), (F.col("c") - F.col("c") % step).alias("base"))
    based = sized.join(sized.select(F.col("c").alias("base"), F.col("n").alias("base_n")), "base", "left")
    cut = materialize(based.select("c", "base", "taken", F.least("taken", F.coalesce("base_n", F.lit(0))).alias("cut")))
    head = own.where(F.col("pos") < turns).select(F.col("c").alias("base"), "pos", "h", "l", "size")
    lent = cut.where("cut > 0").join(head, "base").where("pos <= cut").select("c", (F.col("pos") - 1).alias("q"), "h", "l", "size")
    kept = own.join(cut.select("c", "taken", "cut"), "c").where("pos > taken").select("c", (F.col("pos") - 1 - F.col("taken") + F.col("cut")).alias("q"), "h", "l", "size")
    return cut.select("c"), materialize(lent.unionByName(kept))


def ends_hashes(ends: DataFrame) -> DataFrame:
    """(end, ends_sha256) of rows (end, c): SHA-256 of the ids of each ``end``, ascending, comma-joined.

    Ids are sorted by range and joined to strings of at most ``CHUNK_IDS``; the strings of one ``end`` then pass
    through one running hash, so no task holds a group.
    """

    def join(batches):
        end, first, ids = None, None, []
        made = []

        def flush():
            if ids:
                made.append((end, first, ",".join(map(str, ids))))
                ids.clear()

        def batch():
            cols = list(zip(*made)) or [(), (), ()]
            made.clear()
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string())], names=["end", "first", "part"])

        for b in batches:
            for e, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if e != end or len(ids) >= CHUNK_IDS:
                    flush()
                    end, first = e, c
                ids.append(c)
            yield batch()
        flush()
        yield batch()

    def hashed(batches):
        rows = ((e, p) for b in batches for e, p in zip(b.column(0).to_pylist(), b.column(2).to_pylist()))
        out = []
        for end, parts in groupby(rows, key=lambda r: r[0]):
            sha, comma = hashlib.sha256(), b""
            for _, part in parts:
                sha.update(comma + part.encode())
                comma = b","
            out.append((end, sha.hexdigest()))
            if len(out) == 10_000:
                yield pa.RecordBatch.from_arrays([pa.array([e for e, _ in out], pa.int64()), pa.array([s for _, s in out])], names=["end", "ends_sha256"])
                out = []
        yield pa.RecordBatch.from_arrays([pa.array([e for e, _ in out], pa.int64()), pa.array([s for _, s in out], pa.string())], names=["end", "ends_sha256"])

    parts = ends.select("end", "c").repartitionByRange("end", "c").sortWithinPartitions("end", "c").mapInArrow(join, "end long, first long, part string")
    return parts.repartition("end").sortWithinPartitions("end", "first").mapInArrow(hashed, "end long, ends_sha256 string")


def _cut_levels(rows: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Whole-conversation blocks (c, bh, bl) and, by level from 1, the halves of each distinct block; u or l is a half, h and l a name."""
    blocks, halves = rows.select("c", "q", F.col("h").alias("bh"), F.col("l").alias("bl")), []
    longest = rows.agg(F.max("q")).first()[0] or 0
    for _ in range(int(longest).bit_length()):
        of = lambda odd, col: F.max(F.when(F.col("q") % 2 == odd, F.col(col)))
        pairs = blocks.groupBy("c", F.shiftright("q", 1).alias("p")).agg(of(0, "bh").alias("uh"), of(0, "bl").alias("ul"), of(1, "bh").alias("lh"), of(1, "bl").alias("ll"))
        bh, bl = _name("uh", "ul", "lh", "ll")
        named = materialize(pairs.select("c", F.col("p").alias("q"), bh.alias("bh"), bl.alias("bl"), "uh", "ul", "lh", "ll"))
        halves.append(named.select("bh", "bl", "uh", "ul", "lh", "ll").distinct())
        blocks = named.select("c", "q", "bh", "bl")
    return blocks.select("c", "bh", "bl"), halves


def _cut(level: DataFrame, halves: DataFrame, half: int) -> DataFrame:
    """The pairs (tree, block) of half the height; ``more``: the block ends at a cut that a lower tree hangs from."""
    split = level.drop("more").join(halves, ["bh", "bl"])
    upper = split.groupBy("th", "tl", "depth", "uh", "ul").agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max(F.when(F.col("lh").isNull(), F.col("end"))).alias("end"), F.max(F.col("lh").isNotNull()).alias("more")
    )
    th, tl = _name("th", "tl", "uh", "ul")
    lower = split.where("lh is not null").select(
        th.alias("th"), tl.alias("tl"), (F.col("depth") + half).alias("depth"), F.col("lh").alias("bh"), F.col("ll").alias("bl"), "n", "low", "end", F.lit(False).alias("more")
    )
    return materialize(upper.withColumnsRenamed({"uh": "bh", "ul": "bl"}).unionByName(lower))


def prefix_trie(conversations: DataFrame, id_col: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                step: int = REUSE_STEP, turns: int = REUSE_TURNS) -> DataFrame:
    """One row per node of the trie of rebuilt conversations (`rebuilt`): conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256.

    Turns are ordered by ``turn`` (null first), ties by role and then by a hash of the text; null role or text counts as
    empty. A node is a distinct sequence of first turns, the root the empty one; its name is (smallest member, depth). A
    repeated row is another turn. Rows without id belong to no conversation and are left out. Other columns are
    ignored; an empty table has no node.
    """
    convs, rows = rebuilt(conversations, id_col, turn, role, text, step, turns)
    tops, halves = _cut_levels(rows)
    height = len(halves)
    groups = tops.groupBy("bh", "bl").agg(F.count("*").alias("n"), F.min("c").alias("low"))
    zero = F.lit(0).cast("long")
    level = materialize(groups.select(zero.alias("th"), zero.alias("tl"), zero.alias("depth"), "bh", "bl", "n", "low", F.col("low").alias("end"), F.lit(False).alias("more")))
    spoken = materialize(tops.join(level.select("bh", "bl", "end"), ["bh", "bl"]).select("end", "c"))
    silent = materialize(convs.join(rows.select("c").distinct(), "c", "left_anti"))
    quiet = F.lit(silent.agg(F.min("c")).first()[0]).cast("long")
    hashes = materialize(ends_hashes(spoken.unionByName(silent.select(quiet.alias("end"), "c"))))
    root = convs.agg(F.count("*").alias("n"), F.min("c").alias("low")).where("n > 0").withColumn("end", quiet)

    levels, trees = {height: level}, []
    for k in range(height, 0, -1):
        half = 1 << (k - 1)
        level = levels[k - 1] = _cut(level, halves[k - 1], half)
        h, l = _name("th", "tl", "bh", "bl")
        trees.append(level.where("more").select(h.alias("h"), l.alias("l"), F.col("th").alias("oh"), F.col("tl").alias("ol"), (F.col("depth") + half).alias("depth"), "low", F.lit(k - 1).alias("v")))
    none = F.lit(None).cast("long")
    known = root.select(zero.alias("h"), zero.alias("l"), none.alias("oh"), none.alias("ol"), zero.alias("depth"), "low", F.lit(height).alias("v"))
    for t in trees:
        known = known.unionByName(t)
    known = materialize(known)

    sizes = rows.select(F.col("h").alias("bh"), F.col("l").alias("bl"), "size").distinct()
    nodes = level.join(sizes, ["bh", "bl"]).select("th", "tl", (F.col("depth") + 1).alias("depth"), "n", "low", "end", ((F.col("n") - 1) * F.col("size")).alias("own"))
    inner = known.select("h", "l", "low", "depth")
    nodes = materialize(nodes.join(inner, ["low", "depth"], "left"))
    leaf = F.col("h").isNull().cast("long")
    under = nodes.groupBy(F.col("th").alias("h"), F.col("tl").alias("l")).agg(F.count("*").alias("children"), F.sum("own").alias("saved"), F.sum(leaf).alias("leaves"))
    region = materialize(known.join(under, ["h", "l"]))
    below = _graft(region.drop("children"), levels, height)
    totals = below.join(region.select("h", "l", "children"), ["h", "l"])

    parents = known.select(F.col("h").alias("th"), F.col("l").alias("tl"), F.col("low").alias("parent"))
    placed = nodes.join(parents, ["th", "tl"]).select("h", "l", "low", "depth", "parent", "n", "own", "end")
    top = root.select(zero.alias("h"), zero.alias("l"), "low", zero.alias("depth"), none.alias("parent"), "n", zero.alias("own"), "end")
    full = placed.unionByName(top).join(totals.select("h", "l", "children", "saved", "leaves"), ["h", "l"], "left").join(hashes, "end", "left")
    return full.select(
        F.col("low").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.coalesce("children", zero).alias("n_children"), F.coalesce("leaves", F.lit(1).cast("long")).alias("n_leaves"),
        (F.col("own") + F.coalesce("saved", zero)).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"),
    )


def _graft(region: DataFrame, levels: dict[int, DataFrame], height: int) -> DataFrame:
    """(h, l, low, depth, saved, leaves): totals of all nodes strictly below each tree's root.

    ``region``: per tree, with the tree it was cut from (oh, ol) and the level of its cut (v), the totals of its root's children.
    """
    done = {}
    for v in range(height):
        done[v] = region.where(F.col("v") == v)
        up = done[v].select(F.col("oh").alias("h"), F.col("ol").alias("l"), *[F.lit(None).cast(region.schema[c].dataType).alias(c) for c in ("oh", "ol", "depth", "low", "v")], "saved", "leaves")
        both = region.where(F.col("v") > v).unionByName(up)
        region = materialize(both.groupBy("h", "l").agg(*[F.max(c).alias(c) for c in ("oh", "ol", "depth", "low", "v")], F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves")))
    columns = ["h", "l", "low", "depth", "saved", "leaves"]
    below = region.select(columns)
    for v in range(height - 1, -1, -1):
        reach = levels[v].where(F.shiftright("depth", v) % 2 == 1).select(F.col("th").alias("h"), F.col("tl").alias("l"), "low", (F.col("depth") + (1 << v)).alias("depth"))
        deeper = reach.join(below.select("low", "depth", "saved", "leaves"), ["low", "depth"]).groupBy("h", "l").agg(F.sum("saved").alias("more_saved"), F.sum("leaves").alias("more_leaves"))
        here = done[v].join(deeper, ["h", "l"], "left")
        added = here.select("h", "l", "low", "depth", *[(F.col(c) + F.coalesce(f"more_{c}", F.lit(0).cast("long"))).alias(c) for c in ("saved", "leaves")])
        below = below.unionByName(materialize(added))
    return below
