"""Stupid-backoff scores from n-gram count tables that are partitioned by hash.

Texts become token ids of a public byte-level vocabulary, so the unigram table is bounded by the vocabulary and no word
is unknown. Token ids are kept in blocks of many documents; a block's distinct n-grams, packed by hash bucket with
their counts, are the rows that travel. A bucket sums the counts over all blocks (its part of the count tables) and
answers each block with the sums, in the order of the block's own n-grams; the answers are joined to the block and
summed per document. A frequent n-gram is one entry per block, however many documents hold it. The bucket is that of the
context, and n-grams are sorted: their first tokens repeat in runs, which compression takes out. A context whose tokens
are frequent has several buckets, chosen by the last token, so that no bucket grows with one context.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from premia.llm.bpe import TEXTS, codec_in_tasks
from premia.session import materialize

ALPHA = 0.4
LEAST_COUNT = 2
ORDER = 3
BLOCK_TOKENS = 1 << 20
BUCKET_ENTRIES = 1 << 22
CONTEXT_ENTRIES = 1 << 18
START = 0xFFFF


def _pack(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def _unpack(packed: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), kind)


def token_blocks(docs: DataFrame, path: str, pattern: str, id_col: str, text: str, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(block, ids, sizes, tokens): documents in blocks of about ``block_tokens`` tokens; a longer text is a block of its own."""
    codec = codec_in_tasks(docs, path, pattern)
    slim = docs.select(docs[id_col].alias("id"), docs[text])
    kind = slim.schema["id"].dataType.simpleString()

    def row(ids, made):
        cols = [pa.array([uuid.uuid4().hex]), pa.array([ids], pa.list_(ids[0].type)), pa.array([list(map(len, made))], pa.list_(pa.int64())), pa.array([_pack(np.concatenate(made))], pa.binary())]
        return pa.RecordBatch.from_arrays(cols, names=["block", "ids", "sizes", "tokens"])

    def run(batches):
        c = codec()
        ids, made, held = [], [], 0
        for b in batches:
            for at in range(0, b.num_rows, TEXTS):
                part = b.slice(at, TEXTS)
                ids += part.column(0)
                made += [t.astype("<u2") for t in c.encode_all([x or "" for x in part.column(1).to_pylist()])]
                held += sum(map(len, made[-part.num_rows :]))
                if held >= block_tokens:
                    yield row(ids, made)
                    ids, made, held = [], [], 0
        if ids:
            yield row(ids, made)

    return slim.mapInArrow(run, f"block string, ids array<{kind}>, sizes array<long>, tokens binary")


def _grams(tokens: np.ndarray, sizes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, at): the n-grams that end at the places ``at``; a text starts with one START, which only opens n-grams."""
    inside = np.arange(len(tokens)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    use = np.flatnonzero(inside >= n - 2)
    inside = inside[use]
    key = np.full(len(use), n, dtype=np.uint64)
    for back in range(n - 1, -1, -1):
        key <<= np.uint64(16)
        key |= np.where(inside >= back, tokens[np.maximum(use - back, 0)], START).astype(np.uint64)
    return key, use


def _mixed(keys: np.ndarray) -> np.ndarray:
    return (keys ^ (keys >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(32)


def _context(keys: np.ndarray, n: int) -> np.ndarray:
    """Key of the first n - 1 tokens of n-gram keys."""
    mask = np.uint64((1 << 16 * (n - 1)) - 1)
    return keys >> np.uint64(16) & mask | np.uint64(n - 1) << np.uint64(16 * (n - 1))


def _homes(keys: np.ndarray, n: int, buckets: int, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each of the sorted ``keys``, and their order by (bucket, key).

    A context has at most as many n-grams over all blocks as its rarest token has places: one bucket for each CONTEXT_ENTRIES.
    """
    context = _context(keys, n)
    most = ones[(context & np.uint64(0xFFFF)).astype(np.int64)]
    if n > 2:
        most = np.minimum(most, ones[(context >> np.uint64(16) & np.uint64(0xFFFF)).astype(np.int64)])
    ways = (most // CONTEXT_ENTRIES + 1).astype(np.uint64)
    salt = _mixed(keys & np.uint64(0xFFFF)) % ways
    home = (_mixed(context + (salt << np.uint64(52))) % np.uint64(buckets)).astype(np.uint16 if buckets <= 1 << 16 else np.int64)
    return home, np.argsort(home, kind="stable")


def _packed_counts(counts: np.ndarray) -> bytes:
    """Counts as one byte each; those of 255 and more follow in their order as eight bytes each."""
    wide = counts[counts >= 255].astype("<u8")
    return _pack(np.concatenate([np.minimum(counts, 255).astype(np.uint8), wide.view(np.uint8)]))


def _unpacked_counts(packed: bytes, n: int) -> np.ndarray:
    raw = _unpack(packed, np.uint8)
    out = raw[:n].astype(np.int64)
    out[out == 255] = raw[n:].view("<u8").astype(np.int64) if len(raw) > n else 0
    return out


def backoff_scores(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text: str = "text", order: int = ORDER,
                   alpha: float = ALPHA, least_count: int = LEAST_COUNT, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Per row of ``docs``: id, n_tokens, log_score (natural log of the product of S over its tokens), mean_score (log_score / n_tokens).

    S(w | context) = c(context w) / c(context) for the longest context, up to ``order`` - 1 tokens, whose n-gram was
    counted at least ``least_count`` times, times ``alpha`` for each shortening; the last resort is c(w) / N. Counts are
    over all rows of ``docs``, the scored one included. Null and empty texts have 0 tokens, log_score 0 and no mean.
    Repeated rows count and are scored as often as they occur, null ids too; other columns are ignored; an empty table gives an
    empty result. Orders 2 and 3.
    """
    if order not in (2, 3):
        raise ValueError("order must be 2 or 3")
    blocks = materialize(token_blocks(docs, path, pattern, id_col, text, block_tokens))
    kind = blocks.schema["ids"].dataType.elementType.simpleString()

    def opened(b: pa.RecordBatch | pa.Table, i: int) -> tuple[np.ndarray, np.ndarray]:
        return _unpack(b["tokens"][i].as_py(), "<u2").astype(np.int64), np.array(b["sizes"][i].as_py(), dtype=np.int64)

    def single(batches):
        total, texts = np.zeros(START + 1, dtype=np.int64), 0
        for b in batches:
            for i in range(b.num_rows):
                tokens, sizes = opened(b, i)
                total += np.bincount(tokens, minlength=START + 1)
                texts += int((sizes > 0).sum())
        total[START] = texts
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["token", "n"])

    ones = np.zeros(START + 1, dtype=np.int64)
    for r in blocks.select("sizes", "tokens").mapInArrow(single, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).collect():
        ones[r["token"]] = r["n"]  # at most the vocabulary and START
    n_all = int(ones[:START].sum())
    buckets = max(1, -(-n_all * (order - 1) // BUCKET_ENTRIES))
    sent = docs.sparkSession.sparkContext.broadcast(ones)

    def distinct(batches):
        for b in batches:
            for i in range(b.num_rows):
                tokens, sizes = opened(b, i)
                for n in range(2, order + 1):
                    keys, counts = np.unique(_grams(tokens, sizes, n)[0], return_counts=True)
                    if not len(keys):
                        continue
                    home, by = _homes(keys, n, buckets, sent.value)
                    home, keys, counts = home[by], keys[by], counts[by]
                    cut = np.flatnonzero(np.diff(home)) + 1
                    packed = lambda x: pa.array(map(_pack, np.split(x, cut)), pa.binary())
                    first = home[np.r_[0, cut]].astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(first), pa.array([b["block"][i].as_py()] * len(first)), pa.array([n] * len(first), pa.int32()),
                         packed((keys >> np.uint64(16)).astype("<u4")), packed(keys.astype("<u2")), pa.array(map(_packed_counts, np.split(counts, cut)), pa.binary())],
                        names=["bucket", "block", "n", "context", "last", "counts"])

    def answer(group: pa.Table) -> pa.Table:
        parts = [(np.uint64(n) << np.uint64(48), _unpack(c, "<u4"), _unpack(w, "<u2")) for n, c, w in zip(*(group[x].to_pylist() for x in ("n", "context", "last")))]
        keys = np.concatenate([tag | c.astype(np.uint64) << np.uint64(16) | w for tag, c, w in parts])
        counts = np.concatenate([_unpacked_counts(x, len(c)) for x, (_, c, _) in zip(group["counts"].to_pylist(), parts)])
        every, where = np.unique(keys, return_inverse=True)
        total = np.bincount(where, weights=counts, minlength=len(every)).astype(np.int64)
        total[total < least_count] = 0
        found = np.split(total[where], np.cumsum([len(c) for _, c, _ in parts])[:-1])
        return pa.table({"block": group["block"], "bucket": group["bucket"], "n": group["n"], "size": pa.array([len(f) for f in found], pa.int64()),
                         "counts": pa.array(map(_packed_counts, found), pa.binary())})

    grams = blocks.select("block", "sizes", "tokens").mapInArrow(distinct, "bucket long, block string, n int, context binary, last binary, counts binary")
    answers = grams.groupBy("bucket").applyInArrow(answer, "block string, bucket long, n int, size long, counts binary")

    def score(block: pa.Table, got: pa.Table) -> pa.Table:
        tokens, sizes = opened(block, 0)
        one = sent.value
        logs = np.log(np.maximum(one[tokens], 1)) - np.log(max(n_all, 1)) + (order - 1) * np.log(alpha)
        replies = sorted(zip(got["n"].to_pylist(), got["bucket"].to_pylist(), range(got.num_rows)))
        under = one[np.where(np.arange(len(tokens)) == np.repeat(np.cumsum(sizes) - sizes, sizes), START, tokens[np.arange(len(tokens)) - 1])]
        for n in range(2, order + 1):
            grams_n, at = _grams(tokens, sizes, n)
            keys, where = np.unique(grams_n, return_inverse=True)
            _, by = _homes(keys, n, buckets, one)
            total = np.zeros(len(keys), dtype=np.int64)
            if len(keys):
                total[by] = np.concatenate([_unpacked_counts(got["counts"][i].as_py(), got["size"][i].as_py()) for m, _, i in replies if m == n])
            c = total[where]
            hit = c > 0
            logs[at[hit]] = np.log(c[hit]) - np.log(under[at[hit]]) + (order - n) * np.log(alpha)
            under = np.zeros(len(tokens), dtype=np.int64)  # the next context of a place ends one place before
            under[at[at + 1 < len(tokens)] + 1] = c[at + 1 < len(tokens)]
        # a text's first token has no longer context than START, so shortening costs it less
        first = (np.cumsum(sizes) - sizes)[sizes > 0]
        logs[first] -= (order - 2) * np.log(alpha)
        ends = np.cumsum(sizes)
        summed = np.array([logs[e - s : e].sum() for e, s in zip(ends, sizes)])
        mean = [float(x / s) if s else None for x, s in zip(summed, sizes)]
        return pa.table({id_col: block["ids"].combine_chunks().flatten(), "n_tokens": pa.array(sizes), "log_score": pa.array(summed, pa.float64()), "mean_score": pa.array(mean, pa.float64())})

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(score, f"`{id_col}` {kind}, n_tokens long, log_score double, mean_score double")
