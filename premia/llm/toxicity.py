"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; any document may be unlabelled. With class prior p the risk of a scorer is
p R+(positives) + max(0, R-(unlabelled) - p R-(positives)), so toxic documents among the unlabelled don't count as
clean. The scorer is linear in the presence of hashed words and word beginnings, fitted with numpy on a bounded sample
and applied to whole texts in the tasks.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from premia.session import broadcast_checked, materialize

BITS = 22
PREFIX = 4
POSITIVES = 4_000
UNLABELLED = 16_000
FEATURES = 4_096
LEAST_POSITIVES = 5
LEAST_LIFT = 3.0
LEAST_EVIDENCE = 10.0
THRESHOLD = 0.7
_LETTERS = bytes(c if chr(c).isalnum() or c > 127 else 32 for c in range(256))


def word_ids(text: bytes | None) -> np.ndarray:
    """Hashes of the distinct words of a whole text and of their beginnings.

    Words are runs of ASCII letters, digits and any non-ASCII, A-Z lower-cased; a beginning, which joins the forms of
    an inflected or compound word, is the first PREFIX bytes of a longer one.
    """
    words = set((text or b"").lower().translate(_LETTERS).split())
    words.update([b"^" + w[:PREFIX] for w in words if len(w) > PREFIX])
    return np.fromiter((zlib.crc32(w) >> (32 - BITS) for w in words), dtype=np.int32, count=len(words))


@dataclass
class Scorer:
    ids: np.ndarray  # sorted word hashes
    weights: np.ndarray
    bias: float

    def score(self, words: np.ndarray) -> float:
        at = np.searchsorted(self.ids, words)
        at[at == len(self.ids)] = 0
        hit = self.ids[at] == words if len(self.ids) else np.zeros(len(words), dtype=bool)
        return float(1 / (1 + np.exp(-(self.bias + self.weights[at[hit]].sum()))))


def _chosen(positives: list[np.ndarray], unlabelled: list[np.ndarray]) -> np.ndarray:
    """Words in enough positives and clearly more often there than among the unlabelled; at most FEATURES, most evidence first."""
    width = 1 << BITS
    p = np.bincount(np.concatenate([np.unique(x) for x in positives] or [np.empty(0, int)]).astype(int), minlength=width)
    u = np.bincount(np.concatenate([np.unique(x) for x in unlabelled] or [np.empty(0, int)]).astype(int), minlength=width)
    share_p, share_u = p / max(1, len(positives)), (u + 1) / (len(unlabelled) + 1)
    good = np.flatnonzero((p >= LEAST_POSITIVES) & (share_p >= LEAST_LIFT * share_u))
    evidence = p[good] * np.log(share_p[good] / share_u[good])
    order = np.argsort(-evidence, kind="stable")[:FEATURES]
    return np.sort(good[order[evidence[order] >= LEAST_EVIDENCE]])


def fit(positives: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, rounds: int = 400, rate: float = 0.05, decay: float = 1e-3) -> Scorer:
    """Minimise the non-negative risk (logistic loss) by Adam over all sample rows; word hashes in, scorer out."""
    ids = _chosen(positives, unlabelled)

    def sparse(docs):
        rows = [np.flatnonzero(np.isin(ids, d, assume_unique=False)) for d in docs]
        return np.repeat(np.arange(len(docs)), [len(r) for r in rows]), np.concatenate(rows or [np.empty(0, int)]).astype(int), len(docs)

    sets = [sparse(positives), sparse(unlabelled)]
    w = np.zeros(len(ids) + 1)
    w[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(w), np.zeros_like(w)

    def margin(part):
        row, col, n = part
        return np.bincount(row, weights=w[col], minlength=n) + w[-1]

    def pull(part, g):
        row, col, n = part
        return np.append(np.bincount(col, weights=g[row], minlength=len(ids)), g.sum()) / max(1, n)

    for step in range(1, rounds + 1):
        f_p, f_u = margin(sets[0]), margin(sets[1])
        up, uu = 1 / (1 + np.exp(-f_p)), 1 / (1 + np.exp(-f_u))
        clean = np.logaddexp(0, f_u).mean() - prior * np.logaddexp(0, f_p).mean()
        clean_grad = pull(sets[1], uu) - prior * pull(sets[0], up)
        grad = prior * pull(sets[0], up - 1) + clean_grad if clean >= 0 else -clean_grad
        grad[:-1] += decay * prior * w[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Scorer(ids.astype(np.int32), w[:-1], float(w[-1]))


def held_out(id_col) -> F.Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic",
          positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Scorer | None:
    """Fit on a sample whose expected sizes are ``positives`` and ``unlabelled`` rows (by hash of the id, of the unlabelled
    also of the text); None without positives.

    Labels and texts are read only of rows that have an id outside the held-out third. The class prior is their share of toxic rows. The driver
    sees the word hashes of the sample and nothing else. The sampled ids are few, so no text is shuffled for them.
    """
    known = labels.select(labels[id_col].alias("_id"), labels[label].alias("_y")).where(~held_out(F.col("_id")) & F.col("_y").isNotNull())
    known = known.groupBy("_id").agg(F.max("_y").alias("_y"))
    n, toxic = known.agg(F.count("*"), F.sum((F.col("_y") == 1).cast("long"))).first()
    if not toxic or toxic == n:
        return None
    outside = docs.select(docs[id_col].alias("_id")).where(F.col("_id").isNotNull() & ~held_out(F.col("_id")))
    rows = outside.count()
    lot = lambda c: F.pmod(F.xxhash64(c, F.lit("lot")), F.lit(1 << 30))
    share = lambda most, of: F.lit(int(min(1.0, most / max(1, of)) * (1 << 30)))
    chosen = materialize(known.where((F.col("_y") == 1) & (lot("_id") < share(positives, toxic))).select("_id", F.lit(True).alias("_p")))
    drawn = docs[id_col].isNotNull() & ~held_out(docs[id_col]) & (F.pmod(F.xxhash64(docs[id_col], docs[text], F.lit("lot")), F.lit(1 << 30)) < share(unlabelled, rows))
    slim = docs.select(docs[id_col].alias("_id"), docs[text].alias("_t"), F.coalesce(drawn, F.lit(False)).alias("_u"))
    sampled = slim.join(broadcast_checked(chosen), "_id", "left").withColumn("_p", F.coalesce("_p", F.lit(False)))
    sampled = sampled.where("_p or _u").select("_p", "_u", "_t")

    def hashes(batches):
        for b in batches:
            made = [word_ids(x.as_py()) for x in b.column(2).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(made, pa.list_(pa.int32()))], names=["p", "u", "words"])

    got = sampled.mapInArrow(hashes, "p boolean, u boolean, words array<int>").toArrow()
    words = got["words"].combine_chunks()
    flat, ends = words.flatten().to_numpy(), np.diff(words.offsets.to_numpy())
    each = np.split(flat, np.cumsum(ends)[:-1]) if len(ends) else []
    pick = lambda c: [each[i] for i in np.flatnonzero(got[c].to_numpy(zero_copy_only=False))]
    return fit(pick("p"), pick("u"), toxic / n)


def score(docs: DataFrame, scorer: Scorer | None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: id, held_out, score (0 to 1), predicted (1 at THRESHOLD or above).

    Whole texts; null counts as empty, and an empty text gets the scorer's bias. Without a scorer every score is 0.
    Rows without id are not held out. Rows are independent; other columns are ignored; the result has as many rows.
    """
    slim = docs.select(docs[id_col], held_out(docs[id_col]).alias("held_out"), docs[text])
    sent = docs.sparkSession.sparkContext.broadcast(scorer)  # at most FEATURES weights

    def run(batches):
        s = sent.value
        for b in batches:
            made = np.array([s.score(word_ids(x.as_py())) if s else 0.0 for x in b.column(2).cast(pa.binary())], dtype=float)
            out = [b.column(0), b.column(1), pa.array(made), pa.array((made >= THRESHOLD).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(out, names=[id_col, "held_out", "score", "predicted"])

    return slim.mapInArrow(run, f"`{id_col}` {slim.schema[id_col].dataType.simpleString()}, held_out boolean, score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """`score` by a scorer that `train` fits on the same documents."""
    return score(docs, train(docs, labels, id_col, text, label), id_col, text)
