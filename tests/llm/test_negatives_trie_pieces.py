"""Hard negatives, conversation trie and sentencepiece codec against brute force and the library."""

import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from premia.llm import negatives, pieces, trie

MODEL = public_tokenizers.path("piece_bpe_32k.model")
VECTORS = "vec_id long, embedding array<float>, label int"
TURNS = "conv_id long, turn long, role string, text string"


def brute_negatives(rows, every=50):
    best = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        best.setdefault(i, (label, [math.floor(256 * float(np.float32(x))) for x in v]))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for a, (label, v) in best.items():
        if a % every:
            continue
        scored = sorted(((-dot(v, w), i, other) for i, (other, w) in best.items() if i != a))
        for p, i, _ in [s for s in scored if s[2] == label][:5]:
            fits = [s for s in scored if s[2] != label and 50 * -p <= 100 * -s[0] <= 95 * -p]
            out += [(a, i, k + 1, s[1], -p, -s[0]) for k, s in enumerate(fits[:3])]
    return sorted(out)


def clustered(n, seed, dims=8, scale=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dims))
    made = centres[rng.integers(0, 6, n)] + 0.3 * rng.normal(size=(n, dims))
    return [(i, [float(np.float32(x)) for x in scale * v], int(rng.integers(0, 3))) for i, v in enumerate(made)]


def found_negatives(spark, rows, schema=VECTORS, **more):
    got = negatives.hard_negatives(spark.createDataFrame(rows, schema), anchor_every=10, **more)
    return sorted(tuple(r) for r in got.collect())


def test_negatives_are_those_of_brute_force(spark):
    rows = clustered(400, 1)
    rows += [(1000 + i, rows[3][1], rows[3][2]) for i in range(60)]  # one vector many times
    rows += [(2000, None, 1), (2010, [1.0, None] * 4, 1), (2020, [math.nan] * 8, 1), (2030, rows[5][1], None), (None, rows[5][1], 1), (2040, [0.0] * 8, 1), (2050, [], 1)]
    assert found_negatives(spark, rows, fanout=4, leaf=8, block=32) == brute_negatives(rows, 10)


def test_negatives_of_large_components_are_exact(spark):
    rows = [(i, v, label) for i, v, label in clustered(80, 2, scale=3.0e4)]
    assert found_negatives(spark, rows, leaf=8) == brute_negatives(rows, 10)
    big = [(0, [1e12, 1.0], 0), (1, [1e12, 2.0], 0), (2, [9e11, 1.0], 1)]
    assert negatives.products(np.array([[2.0**40, 1.0]]), np.array([[2.0**14, 1.0]]))[0, 0] == 2**54 + 1
    assert len(found_negatives(spark, big)) == 0  # both scores end at the same bound


def test_negatives_without_partners(spark):
    assert found_negatives(spark, []) == []
    assert found_negatives(spark, [(10, [1.0], 1)]) == []
    assert found_negatives(spark, [(10, [1.0], 1), (11, [1.0], 1)]) == []
    twice = clustered(60, 3)
    assert found_negatives(spark, twice + twice) == brute_negatives(twice, 10)
    frame = spark.createDataFrame(twice, VECTORS).select("*", *[F.lit(1).alias(c) for c in ("id", "raw", "leaf", "query", "digest", "part")])
    assert sorted(tuple(r) for r in negatives.hard_negatives(frame, anchor_every=10).collect()) == brute_negatives(twice, 10)


def test_tree_leaves_out_what_cannot_meet_the_window():
    rng = np.random.default_rng(0)
    centres = 4000 * rng.normal(size=(40, 16))
    x = np.floor(centres[rng.integers(0, 40, 4000)] + 60 * rng.normal(size=(4000, 16)))
    nodes = negatives.plant(x[:800], 8, 16)
    for n in nodes:
        k = len(n.children)
        n.low, n.high, n.norms = np.full((k, k), np.inf), np.full((k, k), -np.inf), np.tile([np.inf, -np.inf], (k, 1))
    for batch in negatives._partial_ranges(nodes, [_arrow(x)], 8):
        for number, child, point, a, b, c, d in zip(*(col.to_pylist() for col in batch.columns)):
            nodes[number].low[child, point], nodes[number].high[child, point], nodes[number].norms[child] = a, b, (c, d)
    leaf = negatives.leaf_of(nodes, x)
    q = x[::100]
    score = negatives.products(q, x)
    top = np.sort(score, axis=1)[:, -20]
    seen = np.zeros((len(q), leaf.max() + 1), bool)
    for at, number, _ in negatives.route(nodes, q, top.astype(float), score.max(axis=1).astype(float)):
        seen[at, number] = True
    wanted = score >= top[:, None]
    assert seen[np.nonzero(wanted)[0], leaf[np.nonzero(wanted)[1]]].all()
    assert seen[:, leaf].mean() < 0.3


def _arrow(x):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array([v.tobytes() for v in x], pa.binary())], names=["raw"])


def brute_trie(rows):
    talks = {}
    for c, turn, role, text in rows:
        if c is not None:
            talks.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    talks = {c: [t[2:] for t in sorted(v, key=lambda t: t[:2])] for c, v in talks.items()}
    nodes = {}
    for c in talks:
        h = zlib.crc32(str(c).encode()) % 6
        path = tuple(talks.get(c - c % 100, [])[:h] + talks[c][h:])
        for d in range(len(path) + 1):
            nodes.setdefault(path[:d], [[], []])[0].append(c)
        nodes[path][1].append(c)
    kids, leaves, saved = ({k: 0 for k in nodes} for _ in range(3))
    for k in nodes:
        if k:
            kids[k[:-1]] += 1
    for k, (members, _) in nodes.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += kids[k] == 0
            saved[k[:d]] += (len(members) - 1) * len(k[-1][1]) if k else 0
    sha = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return sorted(
        (min(m), len(k), min(nodes[k[:-1]][0]) if k else -1, len(m), kids[k], leaves[k], saved[k], sha(e)) for k, (m, e) in nodes.items()
    )


def found_trie(frame):
    return sorted(tuple(-1 if x is None else x for x in r) for r in trie.prefix_trie(frame).collect())


def test_trie_is_that_of_brute_force(spark):
    rng = random.Random(5)
    rows = []
    for c in [100, 101, 102, 105, 106, 107, 110, 200, 203, 250, 307, 311, 312]:
        places = [None, *range(40)] if c in (101, 105) else rng.sample([None, *range(12)], rng.randint(1, 9))
        rows += [(c, t, rng.choice(["u", None, "a"]), rng.choice(["a", "bb", None, "", "é" * 30])) for t in places]
    rows += [(c, t, "u", "same") for c in (400, 401, 402, 403, 404, 405, 406, 407) for t in range(9)]
    rows += [(None, 0, "u", "nobody")]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, TURNS)
    assert found_trie(frame) == brute_trie(rows)
    clash = frame.select("*", *[F.lit("x").alias(c) for c in ("c", "q", "h", "low", "end", "n", "depth")])
    assert found_trie(clash) == brute_trie(rows)


@pytest.mark.parametrize("rows", [[], [(7, 0, "u", "x")], [(107, 0, None, None)], [(None, 0, "u", "x")], [(c, t, "u", "x" * t) for c in (300, 301) for t in (0, 1)]])
def test_small_tries(spark, rows):
    assert found_trie(spark.createDataFrame(rows, TURNS)) == brute_trie(rows)


def test_trie_counts_a_repeated_turn(spark):
    rows = [(100, 0, "u", "x")] * 3
    got = found_trie(spark.createDataFrame(rows, TURNS))
    assert len(got) == 4 and [r[1] for r in got] == [0, 1, 2, 3]


def test_ends_hash_over_several_strings(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK_IDS", 7)
    ends = spark.createDataFrame([(e, c) for e in (1, 2) for c in range(100 * e)], "end long, c long").repartition(5)
    want = {e: hashlib.sha256(",".join(map(str, range(100 * e))).encode()).hexdigest() for e in (1, 2)}
    assert {r["end"]: r["ends_sha256"] for r in trie.ends_hashes(ends).collect()} == want


def awkward_texts():
    rng = random.Random(3)
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    names = [library.id_to_piece(i) for i in range(library.vocab_size())]
    chars = "ab e▁ \n\t\r1.,'éñ你好한😀\x00​ﬁ日本" + "the" * 3
    texts = ["", None, " ", "  ", "▁", "\n", " a  b ", "<s> </s> <unk> <0x0A>", "x" * 5000, "the " * 20_000, "　ﬁ", "\x00"]
    texts += ["".join(rng.choice(chars) for _ in range(rng.randint(0, 30))) for _ in range(500)]
    return texts + ["".join(rng.choice(names) for _ in range(rng.randint(1, 8))) for _ in range(500)]


def test_pieces_are_those_of_the_library(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = awkward_texts()
    frame = spark.createDataFrame(list(enumerate(texts)) + [(None, "a b"), (None, "a b")], "doc_id long, text string").withColumn("ids", F.lit("clash"))
    got = pieces.encode(frame, MODEL).collect()
    assert len(got) == len(texts) + 2
    for r in got:
        text = "a b" if r["doc_id"] is None else texts[r["doc_id"]] or ""
        ids = library.encode(text)
        assert r["ids"] == ids and r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    assert pieces.encode(frame.limit(0), MODEL).collect() == []


def test_pieces_stay_right_when_the_caches_are_small(monkeypatch):
    monkeypatch.setattr(pieces, "CACHE_RUNS", 3)
    monkeypatch.setattr(pieces, "CACHE_PAIRS", 5)
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    table = pieces.PrefixTable(pieces.read_model(MODEL))
    for t in awkward_texts()[12:]:
        assert table.encode(library.normalize(t)) == library.encode(t)


def test_a_prefix_table_holds_the_last_piece_of_each_prefix():
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    table = pieces.PrefixTable(pieces.read_model(MODEL))
    text = "▁unbelievable▁internationalisation"
    last = table.table(text)
    for end in range(1, len(text) + 1):
        assert table.ids[last[end]] == library.encode(text[1:end].replace("▁", " "))[-1] if end > 1 else True
