"""Bootstrap draws: vectorised hashes and draws packed by bucket, against one draw at a time."""

import hashlib
import os
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from premia.functions.hashing import POISSON_CUTS, md5_ints, md5_ints_of_range
from premia.operators import resample


def md5_int(text: bytes) -> int:
    return int.from_bytes(hashlib.md5(text).digest()[:4], "big")


def test_vectorised_md5_is_md5():
    heads = [f"{r}:".encode() for r in (0, 7, 10, 99, 999, 12345)]
    tails = [b"", b"1", "жё".encode(), b"x" * 40, b"y" * 52, b"z" * 53, b"long" * 30]
    assert md5_ints(heads, tails).tolist() == [[md5_int(h + t) for t in tails] for h in heads]
    pieces = list(md5_ints_of_range([b"3:", b"4:"], 95, 1003))
    assert [start for start, _ in pieces] == [95, 100, 1000]
    assert np.concatenate([p for _, p in pieces], axis=1).tolist() == [[md5_int(h + str(j).encode()) for j in range(95, 1003)] for h in (b"3:", b"4:")]


@pytest.mark.parametrize("method, of", [("md5", md5_int), ("crc32", zlib.crc32)])
def test_poisson_weights_one_byte_each(method, of):
    w = resample.poisson_weights(["5", "123", "1000000"], 120, method)
    assert w.dtype == np.uint8
    assert w.tolist() == [[sum(of(f"{r}:{k}".encode()) >= c for c in POISSON_CUTS) for r in range(120)] for k in ("5", "123", "1000000")]


@pytest.mark.parametrize("draws", [1 << 23, 700])
def test_drawn_pieces_hold_every_draw_in_a_row_per_bucket(spark, monkeypatch, draws):
    monkeypatch.setattr(resample, "DRAWS", draws)
    n, replicates = 10_000, 6
    pieces = resample.drawn_pieces(spark, n, replicates, "md5").collect()
    got = np.zeros((replicates, n), int)
    for p in pieces:
        at = p["bucket"] * resample.BUCKET
        if p["dense"]:
            counts = np.frombuffer(p["drawn"], np.uint8)[: n - at]
            got[p["rep"], at : at + len(counts)] += counts
        else:
            np.add.at(got[p["rep"]], np.frombuffer(p["drawn"], np.uint16).astype(int) + at, 1)
    want = [np.bincount([md5_int(f"{r}:{j}".encode()) % n for j in range(n)], minlength=n) for r in range(replicates)]
    assert (got == want).all() and (got.sum(axis=1) == n).all()
    assert len(pieces) <= replicates * 2 * -(-n // draws)


@pytest.mark.parametrize("method", ["md5", "xxhash64"])
def test_few_rows_drawn_more_often_than_a_byte_counts(spark, method):
    p = resample.drawn_pieces(spark, 1, 300, method)
    assert p.count() == 300 and p.where(F.length("drawn") == 2).count() == 300
    rows = resample.DrawnWeights(2)
    frame = pa.RecordBatch.from_pydict({
        "bucket": pa.array([0, 0, 0, 1, 1]), "rep": pa.array([0, 1, None, 1, None], pa.int32()), "dense": pa.array([False, True, None, False, None]),
        "drawn": pa.array([b"\x02\x00" * 300, bytes([0, 0, 9]).ljust(resample.BUCKET, b"\0"), None, b"\x05\x00", None], pa.binary()), "place": pa.array([0, 0, 2, 0, 5]),
    })
    seen = [rows(b.column(0).to_pylist(), 2).tolist() for b in rows.rows(iter([frame.slice(0, 1), frame.slice(1)]))]
    assert seen == [[[300, 9]], [[0, 1]]]


def test_sums_beyond_exact_doubles_stay_whole():
    y = [2**53 + 1, 2**53 + 3]
    b = pa.RecordBatch.from_pydict({"k": pa.array([0, 1]), "y": pa.array(y), "sets": pa.array([["a"], None], pa.list_(pa.string()))})
    cells = list(resample.cell_sums(iter([b]), 1, 0, lambda k, r: np.ones((len(k), r), np.uint8), True))
    assert {r["itemset"]: r["wy"] for c in cells for r in c.to_pylist()} == {None: [sum(y)], "a": [y[0]]}


def test_replicates_drawn_in_groups_are_those_drawn_at_once_and_leave_no_shuffle_files(spark, monkeypatch):
    from premia.operators import stability

    rng = np.random.default_rng(4)
    rows = [(i, str(rng.integers(2)), int(rng.integers(1000)), [x for x in "abc" if rng.random() < 0.5]) for i in range(400)]
    facts = spark.createDataFrame(rows, "k long, s string, y long, items array<string>")
    named = spark.createDataFrame([(x, [x], 100) for x in "abc"], "itemset string, items array<string>, freq long")

    def premiums():
        out = stability.replicate_premiums(facts, lambda b: stability_contained(b, named), id_col="k", value="y", strata=["s"], replicates=23, hash_method="md5", min_strata=1)
        return {(r["rep"], r["itemset"]): r["premium"] for r in out.collect()}

    from premia.operators.premium import contained as stability_contained

    whole = premiums()
    asked, plain = [], resample.drawn_pieces
    monkeypatch.setattr(resample, "drawn_pieces", lambda *a: asked.append(a[2:]) or plain(*a))
    monkeypatch.setattr(resample, "DRAWN_BYTES", 400 * 5)
    monkeypatch.setattr(resample, "REPS_LEAST", 5)
    assert premiums() == whole and len(whole) == 69
    assert asked == [(5, "md5", 0), (5, "md5", 5), (5, "md5", 10), (5, "md5", 15), (3, "md5", 20)]
    assert resample.replicate_groups(1 << 40, 12) == [range(5), range(5, 10), range(10, 12)] and resample.replicate_groups(0, 3) == [range(3)]


def test_shuffle_files_are_removed_when_a_query_ends(spark):
    from premia.session import materialize, shuffles_removed

    def shuffled() -> int:
        disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return sum(f.startswith("shuffle_") for d in disk.localDirsString() for _, _, files in os.walk(d) for f in files)

    before = shuffled()
    with shuffles_removed(spark):
        assert materialize(spark.range(1000).groupBy((F.col("id") % 7).alias("x")).count()).count() == 7
    assert shuffled() == before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"
