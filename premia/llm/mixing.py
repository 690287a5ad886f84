"""Mixing sources to target weights by Pfair scheduling; DataFrame functions only.

A source of weight w is due its j-th block (j = 0, 1, ...) between release floor(j / w) and deadline ceil((j + 1) / w).
Among the released blocks the earliest deadline goes first, one block a slot. With whole-number weights that sum to a
period, the schedule repeats after that many slots, so only one period is ever computed: the slot of any block follows
from its number. Up to every slot each source is less than one block away from its share while it has blocks.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from premia.session import broadcast_checked, materialize

PERIOD = 1000
BLOCK_ROWS = 16
TEMPER = 0.5
BUCKET_DIGITS = 3


def whole_weights(target: dict[str, float], period: int = PERIOD) -> dict[str, int]:
    """Weights in units of 1 / period (largest remainders, ties by name), at least 1 each; the period grows with many sources."""
    if any(not w > 0 for w in target.values()):
        raise ValueError("target weights must be positive")
    spare = max(period, 10 * len(target)) - len(target)
    total = sum(target.values())
    exact = {s: spare * w / total for s, w in target.items()}
    whole = {s: 1 + int(e) for s, e in exact.items()}
    left = spare + len(target) - sum(whole.values())
    for s in sorted(exact, key=lambda s: (int(exact[s]) - exact[s], s))[:left]:
        whole[s] += 1
    return whole


def period_schedule(weights: dict[str, int]) -> list[tuple[str, int, int]]:
    """(source, block, slot) of one period, earliest released deadline first, ties by name."""
    period = sum(weights.values())
    waiting = [(0, s, 0) for s in weights]  # (release, source, block)
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []
    out = []
    for slot in range(period):
        while waiting and waiting[0][0] <= slot:
            _, s, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(j + 1) * period // weights[s]), s, j))
        _, s, j = heapq.heappop(ready)
        out.append((s, j, slot))
        if j + 1 < weights[s]:
            heapq.heappush(waiting, ((j + 1) * period // weights[s], s, j + 1))
    return out


def _sources(docs: DataFrame, source: str) -> Column:
    return F.coalesce(docs[source], F.lit(""))


def place(docs: DataFrame, id_col: str = "doc_id", source: str = "source", weights: dict[str, float] | None = None,
          block_rows: int = BLOCK_ROWS, period: int = PERIOD) -> DataFrame:
    """Every row of ``docs`` as struct ``row`` with its source, ``block``, ``slot``, ``rank`` (within its block) and ``weight``.

    Within a source rows go by md5 of their id (ties by id); ``block_rows`` consecutive ones make a block. ``weights``
    must name every source; without it a source weighs the root of its number of rows, which lifts small sources.
    Reading by (slot, rank) gives the mix; nothing is dropped or repeated, and the slots of a source that has run out
    stay empty. Null and empty sources are one source; rows without id come first within theirs; repeated rows
    take consecutive ranks. Columns of any name may be there. An empty table gives an empty result.

    Row numbers come from counts by (source, hash bucket) and a window within a bucket, so a source may hold any share
    of the rows.
    """
    order = F.md5(F.coalesce(docs[id_col].cast("string"), F.lit("")))
    keyed = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), docs[id_col].alias("id"), _sources(docs, source).alias("source"),
                        F.when(docs[id_col].isNull(), F.lit("")).otherwise(order).alias("h"))
    keyed = keyed.withColumn("bucket", F.substring("h", 1, BUCKET_DIGITS))
    counts = materialize(keyed.groupBy("source", "bucket").agg(F.count("*").alias("n")))
    sizes = {r["source"]: r["n"] for r in counts.groupBy("source").agg(F.sum("n").alias("n")).collect()}
    target = {s: n**TEMPER for s, n in sizes.items()} if weights is None else weights
    if missing := sizes.keys() - target.keys():
        raise ValueError(f"no target weight for {sorted(missing)[:5]}")
    whole = whole_weights(target, period) if target else {}
    spark = docs.sparkSession
    slots = spark.createDataFrame([(s, j, slot, whole[s]) for s, j, slot in period_schedule(whole)], "source string, nth long, at long, weight long")
    before = F.sum("n").over(W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1))
    starts = counts.select("source", "bucket", F.coalesce(before, F.lit(0)).alias("before"))
    per_source = spark.createDataFrame(list(whole.items()), "source string, weight long")
    local = F.row_number().over(W.partitionBy("source", "bucket").orderBy("h", "id"))
    numbered = keyed.withColumn("local", local).join(starts, ["source", "bucket"]).withColumn("number", F.col("before") + F.col("local") - 1)
    numbered = numbered.withColumns({"block": F.floor(F.col("number") / block_rows), "rank": F.col("number") % block_rows})
    numbered = numbered.join(broadcast_checked(per_source), "source").withColumn("nth", F.col("block") % F.col("weight"))
    placed = numbered.join(broadcast_checked(slots.drop("weight")), ["source", "nth"])
    slot = F.floor(F.col("block") / F.col("weight")) * sum(whole.values()) + F.col("at")
    return placed.select("row", "id", "source", "block", slot.alias("slot"), "rank", "weight")


def mix(docs: DataFrame, id_col: str = "doc_id", source: str = "source", weights: dict[str, float] | None = None,
        block_rows: int = BLOCK_ROWS, period: int = PERIOD) -> DataFrame:
    """Per row: id, source, block, slot, rank, weight (of ``period``); see `place`."""
    slim = docs.select(docs[id_col].alias("id"), docs[source].alias("source"))
    return place(slim, "id", "source", weights, block_rows, period).select(
        F.col("id").alias(id_col), F.col("source").alias(source), *[F.col(c).cast("long").alias(c) for c in ("block", "slot", "rank", "weight")]
    )


def interleave(docs: DataFrame, id_col: str = "doc_id", source: str = "source", weights: dict[str, float] | None = None,
               block_rows: int = BLOCK_ROWS, period: int = PERIOD) -> DataFrame:
    """``docs`` in mix order: partitions hold consecutive slots and are sorted, so files read in order give the mix."""
    placed = place(docs, id_col, source, weights, block_rows, period)
    return placed.repartitionByRange(F.col("slot"), F.col("rank")).sortWithinPartitions("slot", "rank").select("row.*")


def period_sql() -> str:
    """The same schedule and places as SQL over documents, for the default weights."""
    return f"""
with recursive d as (
  select doc_id, coalesce(source, '') as source, case when doc_id is null then '' else md5(doc_id::varchar) end as h from documents),
numbered as (select *, row_number() over (partition by source order by h, doc_id nulls first) - 1 as number from d),
sizes as (select source, pow(count(*), {TEMPER}) as w from d group by source),
spare as (select greatest({PERIOD}, 10 * count(*)) - count(*) as spare, count(*) as k, sum(w) as total from sizes),
exact as (select source, spare * w / total as e, spare, k from sizes, spare),
ranked as (select *, row_number() over (order by floor(e) - e, source) as r, spare + k - sum(1 + floor(e)) over () as free from exact),
weights as (select source, (1 + floor(e) + (r <= free)::int)::bigint as weight from ranked),
period as (select sum(weight)::bigint as period from weights),
listed as (select list(source order by source) as names, list(weight order by source) as ws from weights),
run(slot, done, pick) as (
  select -1::bigint, list_transform(names, lambda x: 0::bigint), 0::bigint from listed
  union all
  select slot + 1, list_transform(done, lambda x, i: x + (i = best)::bigint), best from (
    select slot, done, list_aggregate(list_transform(range(1, len(names) + 1), lambda i: case
      when done[i] < ws[i] and floor(done[i] * period / ws[i]) <= slot + 1
      then ceil((done[i] + 1) * period / ws[i])::bigint * 1000000 + i else 9000000000000000 end), 'min') % 1000000 as best
    from run, listed, period where slot + 1 < period) q),
slots as (select names[pick] as source, done[pick] - 1 as nth, slot as at from run, listed where slot >= 0)
select n.doc_id, n.source, (n.number // {BLOCK_ROWS})::bigint as block,
  ((n.number // {BLOCK_ROWS}) // w.weight * p.period + s.at)::bigint as slot,
  (n.number % {BLOCK_ROWS})::bigint as rank, w.weight
from numbered n join weights w using (source) cross join period p
join slots s on s.source = n.source and s.nth = (n.number // {BLOCK_ROWS}) % w.weight
"""
