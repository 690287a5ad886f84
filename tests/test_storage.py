"""Sinks, resume, vocabulary, streams, helpers."""

import pytest
from pyspark.sql import functions as F

from premia.operators import ingest
from premia import session
from premia.session import broadcast_checked, drop_written, materialize, shared_dir, written
from premia.sources import results
from premia.streaming import arrivals

RESULT = "skill string, model string, pr_auc double"


def test_csv_round_trip_joins_arrays(spark, tmp_path):
    d = spark.createDataFrame([(["b", "a"], 1.5)], "items array<string>, v double")
    results.write_csv(d, str(tmp_path / "c"))
    assert results.read_csv(spark, str(tmp_path / "c"), "items string, v double").first() == ("a + b", 1.5)


def test_append_resume_compact(spark, tmp_path):
    path = str(tmp_path / "r")
    for i, (s, m) in enumerate([("s1", "a"), ("s1", "b"), ("s2", "a"), ("s1", "c"), ("s2", "b"), ("s2", "a")]):
        results.append_results(spark.createDataFrame([(s, float(i), i, m)], "skill string, pr_auc double, seq int, model string"), path)
    stored = spark.read.parquet(path)
    work = spark.createDataFrame([("s1", 2), ("s2", 1), ("s3", 3)], "skill string, rank int")
    assert {r["skill"] for r in results.pending(work, stored, key="skill", variant="model").collect()} == {"s2", "s3"}
    got = [(r["skill"], r["model"], r["seq"]) for r in results.compact(stored, work, key="skill", variant="model", seq="seq").collect()]
    assert got == [("s2", "a", 5), ("s2", "b", 4), ("s1", "a", 0), ("s1", "b", 1), ("s1", "c", 3)]


def test_merge_fills_missing_columns(spark):
    a = spark.createDataFrame([("s", "m", 0.5)], RESULT)
    got = results.merge_results([a, a.drop("pr_auc")]).orderBy("pr_auc").collect()
    assert [r["pr_auc"] for r in got] == [None, 0.5]


def test_vocabulary_is_computed_once_and_reports_size(spark, tmp_path, capsys):
    calls = []

    def compute():
        calls.append(1)
        return spark.createDataFrame([(1, "a", 5)], "rank int, item string, freq int")

    path = str(tmp_path / "v")
    for _ in range(2):
        assert results.vocabulary(spark, path, compute, expected=2).first()["item"] == "a"
    assert calls == [1] and "holds 1 items, 2 asked for" in capsys.readouterr().out


def test_shared_dir_is_the_configured_one(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or shared_dir(spark) == named
    d = materialize(spark.range(10))
    assert d.count() == 10 and "premia-" in d.inputFiles()[0]


def test_written_tables_can_be_dropped(spark, monkeypatch):
    monkeypatch.setattr(session, "_written", {})
    d = materialize(spark.range(3))
    assert d.count() == 3 and drop_written(spark) == 1 and drop_written(spark) == 0
    with pytest.raises(Exception):
        spark.read.parquet(d.inputFiles()[0]).count()
    materialize(spark.range(2))
    late = materialize(spark.range(4))
    assert drop_written(spark, keep=written(spark)[-1:]) == 1 and len(written(spark)) == 1
    assert late.count() == 4 and drop_written(spark) == 1 and not written(spark)


def test_broadcast_only_below_the_checked_size(spark):
    big, small = materialize(spark.range(1000)), materialize(spark.range(5))
    plan = lambda side: big.join(broadcast_checked(side, 100), "id")._jdf.queryExecution().logical().toString()
    assert "broadcast" in plan(small).lower() and "strategy=broadcast" not in plan(big)


def test_new_rows_and_statistics(spark):
    stored = spark.createDataFrame([("1", "x")], "id string, v string")
    arrived = spark.createDataFrame([("1", "y"), ("2", "b"), ("2", "a")], "id string, v string")
    new = ingest.new_rows(arrived, stored, "id", "v")
    assert [tuple(r) for r in new.collect()] == [("2", "a")]
    s = ingest.batch_statistics(arrived, new).first()
    assert (s["rows"], s["attempts"], s["duplicates"], s["bytes"]) == (1, 3, 2, len('{"id":"2","v":"a"}'))
    assert s["efficiency_percent"] == pytest.approx(100 / 3)
    assert {"_search_query", "_area_id", "_collected_at"} <= set(ingest.tagged(new, query="q", area=1).columns)


def files(spark, root, n, rows):
    spark.createDataFrame(rows, "id string, v string, ts timestamp").coalesce(1).write.mode("append").parquet(f"{root}/in")


def test_streams_keep_first_seen_rows_across_runs(spark, tmp_path):
    import datetime as dt

    root = str(tmp_path)
    t = dt.datetime(2026, 1, 1)
    files(spark, root, 0, [("1", "a", t), ("2", "a", t), ("1", "b", t)])
    schema = spark.read.parquet(f"{root}/in").schema
    batches = []

    def run():
        stream = arrivals.read_arrivals(spark, f"{root}/in", schema, max_files=1)
        q = arrivals.start_exact_first_seen(
            stream, f"{root}/exact", f"{root}/state1", "id", "v", on_batch=lambda new, old, i: batches.append((new.count(), old.count())))
        q.awaitTermination()
        soft = arrivals.start_sink(arrivals.first_seen(stream, "id", "ts", "30 days"), f"{root}/soft", f"{root}/state2")
        soft.awaitTermination()
        return arrivals.progress(q)

    assert sum(n for _, n in run()) == 3
    files(spark, root, 1, [("2", "c", t), ("3", "c", t)])
    assert sum(n for _, n in run()) == 2
    exact = {(r["id"], r["v"]) for r in spark.read.parquet(f"{root}/exact").collect()}
    assert exact == {("1", "a"), ("2", "a"), ("3", "c")}
    assert sorted(r["id"] for r in spark.read.parquet(f"{root}/soft").collect()) == ["1", "2", "3"]
    assert batches == [(2, 0), (1, 2)]


def test_provenance_names_the_source_file(spark, tmp_path):
    import datetime as dt

    files(spark, str(tmp_path), 0, [("1", "a", dt.datetime(2026, 1, 1))])
    schema = spark.read.parquet(f"{tmp_path}/in").schema
    stream = arrivals.with_provenance(arrivals.read_arrivals(spark, f"{tmp_path}/in", schema), query="q", area=113)
    arrivals.start_sink(stream, f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
    r = spark.read.parquet(f"{tmp_path}/out").first()
    assert r["_search_query"] == "q" and r["_area_id"] == 113 and r["_source_file"].endswith(".parquet") and r["_collected_at"] is not None


def test_first_seen_state_keeps_rows_whole_and_survives_restarts(spark, tmp_path):
    import datetime as dt
    from decimal import Decimal

    root, schema = str(tmp_path), "id string, n long, ts timestamp, money decimal(12,2), tags array<string>, deep struct<a:double,b:struct<c:binary>>"
    t = dt.datetime(2026, 1, 1, 12, 30, 15, 123456)
    row = lambda i, n: (i, n, t, Decimal("1.10"), ["x", None], (float("nan"), (b"\x00\xff",)))
    reads, news = [], []

    def arrive(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{root}/in")

    def run():
        stream = arrivals.read_arrivals(spark, f"{root}/in", spark.read.parquet(f"{root}/in").schema, max_files=1)
        q = arrivals.start_exact_first_seen(stream, f"{root}/out", f"{root}/state", "id", "n", on_batch=lambda new, old, i: news.append((i, sorted(r["id"] for r in new.collect()))))
        q.awaitTermination()
        reads.extend(n for _, n in arrivals.progress(q) if n)

    arrive([row("a", 2), row("a", 1), row("b", 1)])
    run()
    for k in (3, 4):
        arrive([row("a", 0), row("b", 0), row(f"c{k}", k)])
    run()  # a restart
    got = {r["id"]: r for r in spark.read.parquet(f"{root}/out").collect()}
    assert {i: r["n"] for i, r in got.items()} == {"a": 1, "b": 1, "c3": 3, "c4": 4}
    r = got["a"]
    assert (r["ts"], r["money"], r["tags"]) == (t, Decimal("1.10"), ["x", None]) and r["deep"]["a"] != r["deep"]["a"] and bytes(r["deep"]["b"]["c"]) == b"\x00\xff"
    assert reads == [3, 3, 3]  # a batch reads its own rows, whatever was stored before
    assert sorted(i for _, ids in news for i in ids) == ["a", "b", "c3", "c4"]


def test_a_version_is_made_once(spark, tmp_path):
    from premia.streaming import versions

    root, calls = f"{tmp_path}/models", []

    def work(folder):
        calls.append(folder)
        spark.range(3).write.parquet(f"{folder}/rows")
        return {"calls": len(calls)}

    assert versions.latest(spark, root) is None
    assert versions.once(spark, root, 0, work) == ({"calls": 1}, True)
    assert versions.once(spark, root, 0, work) == ({"calls": 1}, False)
    assert versions.once(spark, root, 11, work) == ({"calls": 2}, True)

    def lost(folder):
        spark.range(3).write.parquet(f"{folder}/rows")
        raise RuntimeError("driver lost")

    with pytest.raises(RuntimeError):
        versions.once(spark, root, 12, lost)
    assert versions.published(spark, root) == [0, 11] and versions.latest(spark, root).endswith("batch=11")

    def outrun(folder):  # another run publishes the batch while this one works
        versions.once(spark, root, 12, work)
        return work(folder)

    assert versions.once(spark, root, 12, outrun) == ({"calls": 3}, False)
    assert spark.read.parquet(f"{root}/batch=12/rows").count() == 3 and len([p for p in (tmp_path / "models").iterdir() if p.name.startswith("_staged")]) == 1
