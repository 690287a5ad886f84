"""Column functions and posting preparation on hand-made rows."""

import datetime as dt
import zlib

import pytest
from pyspark.sql import functions as F

from premia.functions import hashing, items, text
from premia.operators import prep, quality
from premia.sources.postings import (
    CONTRACT,
    POSTING_SCHEMA,
    contract_violations,
    read_postings,
    required_leaves,
    schema_differences,
)

NOW = dt.datetime(2026, 1, 2, 3, 4, 5)


def posting(id, name="Engineer", skills=("Python", "SQL"), salary=(100.0, 200.0, "RUR", False), city="Москва",
            employer="A", description="d", experience="noExperience", work=("REMOTE",)):
    return {
        "id": id, "name": name, "description": description,
        "key_skills": None if skills is None else [{"name": s} for s in skills],
        "area": {"id": "1", "name": city}, "employer": {"id": "1", "name": employer},
        "salary": None if salary is None else dict(zip(("from", "to", "currency", "gross"), salary)),
        "experience": None if experience is None else {"id": experience},
        "work_format": None if work is None else [{"id": w} for w in work],
        "published_at": NOW, "alternate_url": None,
    }


ROWS = [
    posting("01", skills=(), description="empty"),
    posting("02", skills=None, description="none"),
    posting("03", skills=(" Python ", "unknown", "", "Python", "c/c++", "1с: предприятие 8"), description="messy"),
    posting("04", salary=None, description="no salary"),
    posting("05", salary=(None, None, "RUR", None), description="empty salary"),
    posting("06", salary=(100.0, None, "RUR", True), description="floor"),
    posting("07", salary=(None, 100.0, "RUR", None), description="ceiling"),
    posting("08", salary=(100.0, 300.0, "RUR", True), description="gross", city="Казань"),
    posting("09", salary=(100.0, 300.0, "USD", False), description="dollars"),
    posting("10", salary=(100.0, 300.0, "RUR", None), description="unstated tax", experience=None, work=None),
    posting("11", salary=(100.0, 300.0, "RUR", None), description="unstated tax", experience="moreThan6"),
    posting("12", description="shared", employer="B"),
    posting("13", description="shared", employer="C"),
]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(ROWS, POSTING_SCHEMA)


def column(spark, values, expr, kind="string"):
    d = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in d.orderBy("i").select(expr(F.col("v"))).collect()]


def test_seniority_order_and_case_folding(spark):
    titles = ["Senior Python Developer", "International Lead", "Middle QA", "Data Engineer", "старший аналитик", "Старший аналитик"]
    assert column(spark, titles, text.seniority) == ["Senior", "Junior", "Middle", "Unknown", "Senior", "Unknown"]
    assert column(spark, titles[-1:], lambda c: text.seniority(c, unicode_case=True)) == ["Senior"]


def test_tokens_html_and_names(spark):
    assert column(spark, ["Senior Разработчик C++"], text.tokens) == [["senior", "разработчик"]]
    assert column(spark, ["<p>a</p>"], text.strip_html) == [" a "]
    assert column(spark, ["c/c++", "1с: предприятие 8"], text.safe_name) == ["c_c++", "1с_ предприятие 8"]


def test_both_item_clean_ups(spark):
    raw = [[" Python ", "unknown", "", "Python", None, "\tSQL\n"], None, []]
    assert column(spark, raw, items.basket_items, "array<string>") == [["Python", "SQL", "unknown"], [], []]
    got = column(spark, [[" Python ", "unknown", "", "Python"], None], items.label_items, "array<string>")
    assert got == [["python", "python"], []]


def test_pairs_and_joined_names(spark):
    got = column(spark, [["a", "b", "c"], ["a"], []], items.pairs_of, "array<string>")
    assert [[tuple(p) for p in g] for g in got] == [[("a", "b"), ("a", "c"), ("b", "c")], [], []]
    assert column(spark, [["b", "a"]], items.joined, "array<string>") == ["a + b"]
    assert column(spark, ["a + b"], items.split_joined) == [["a", "b"]]


def test_item_column_by_presence_and_type_by_schema(spark):
    d = spark.createDataFrame([([], ["x"])], "skills_translated array<string>, key_skills array<string>")
    assert items.item_column(d) == "skills_translated"
    d = spark.createDataFrame([(1, []), (2, [("x",)])], "i int, key_skills array<struct<name:string>>")
    assert [r[0] for r in d.orderBy("i").select(items.item_names(d, "key_skills")).collect()] == [[], ["x"]]


def test_crc_split_known_values(spark):
    ids = ["abc", "Ёж1"]
    assert column(spark, ids, hashing.hash_int) == [891568578, 1962566958] == [zlib.crc32(i.encode()) for i in ids]
    assert column(spark, ids, hashing.split_label) == ["val", "train"]
    assert column(spark, ids, lambda c: hashing.split_label(c, val=0)) == ["train", "train"]


def test_poisson_weights_have_mean_and_variance_one(spark):
    w = spark.range(200_000).select(hashing.poisson_weight(hashing.hash_int(F.col("id"), "xxhash64")).alias("w"))
    row = w.agg(F.avg("w").alias("m"), F.variance("w").alias("v")).first()
    assert abs(row["m"] - 1) < 0.02 and abs(row["v"] - 1) < 0.03


def test_basic_features(df):
    rows = {r["id"]: r for r in prep.basic_features(df, ["A"]).collect()}
    assert rows["03"]["items"] == ["python", "python", "c/c++", "1с: предприятие 8"] and rows["03"]["items_count"] == 4
    assert rows["02"]["items"] == [] and rows["01"]["items_count"] == 0
    assert rows["08"]["salary_avg"] == 200.0 and rows["06"]["salary_avg"] is None and rows["06"]["has_salary"] == 0
    assert rows["01"]["is_top_employer"] == 1 and rows["12"]["is_top_employer"] == 0
    assert rows["10"]["work_format_remote"] == 0 and rows["11"]["work_format_remote"] == 1


def test_dedupe_keeps_the_lowest_id_and_treats_nulls_as_equal(spark, df):
    kept = {r["id"] for r in prep.dedupe(df).select("id").collect()}
    assert kept == {r["id"] for r in ROWS} - {"11"}
    d = spark.createDataFrame([("2", None, "x"), ("1", None, "x"), ("3", "", "x"), ("4", "x", None)], "id string, a string, b string")
    assert {r["id"] for r in prep.dedupe(d, ["a", "b"]).collect()} == {"1", "3", "4"}


def test_usable_postings_strict_and_floor(df):
    strict = {r["id"]: r for r in prep.usable_postings(df).collect()}
    assert set(strict) == {"03", "08", "10", "12", "13"}
    assert strict["08"]["salary_net"] == pytest.approx(174.0) and strict["10"]["salary_net"] == 200.0
    assert strict["03"]["items"] == ["1с: предприятие 8", "Python", "c/c++", "unknown"]
    assert strict["08"]["city_bucket"] == "Other" and strict["03"]["city_bucket"] == "Москва"
    floor = {r["id"]: r for r in prep.usable_postings(df, require_ceiling=False).collect()}
    assert set(floor) == set(strict) | {"06"}
    assert floor["06"]["salary_net"] == pytest.approx(87.0) and not floor["06"]["has_ceiling"] and floor["08"]["salary_net"] == pytest.approx(87.0)
    assert floor["10"]["experience_bucket"] is None


def test_funnel(df):
    assert prep.funnel(df).first().asDict() == {"total": 13, "deduplicated": 12, "tagged": 10, "usable": 5}


def test_top_n_or_other_counts_nulls_before_removing_them(spark):
    d = spark.createDataFrame([(v,) for v in [None] * 5 + ["a"] * 4 + ["b"] * 3 + ["c"]], "v string")
    got = {r["v"]: r["o"] for r in prep.top_n_or_other(d, "v", 2, "o").distinct().collect()}
    assert got == {None: "Other", "a": "a", "b": "Other", "c": "Other"}


def test_posted_salary(spark):
    d = spark.createDataFrame(
        [(1, 1500.0, 20000.0, True), (2, 1500.0, None, None), (3, None, 1234567.0, False)], "i int, a double, b double, g boolean")
    got = [r[0] for r in d.orderBy("i").select(prep.posted_salary(F.col("a"), F.col("b"), F.col("g"))).collect()]
    assert got == ["1 500-20 000 RUB, before tax", "from 1 500 RUB", "up to 1 234 567 RUB, after tax"]


@pytest.mark.parametrize("sizes", [{"old": 24, "new": 10, "eval": 6}, {"old": 120_000, "new": 3}])
def test_sample_batches_are_disjoint_and_exact(spark, sizes):
    got = prep.sample_batches(spark.range(150_000), "id", sizes).groupBy("batch").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("d")).collect()
    assert {r["batch"]: (r["n"], r["d"]) for r in got} == {k: (v, v) for k, v in sizes.items()}


def test_labels_long_and_wide(spark):
    d = spark.createDataFrame([("1", ["a", "a", "b"]), ("2", ["c"])], "id string, items array<string>")
    wide = prep.item_labels_wide(d, ["a", "c"]).orderBy("id").collect()
    assert [(r["label_0"], r["label_1"]) for r in wide] == [(1, 0), (0, 1)]
    long = prep.item_labels_long(d, spark.createDataFrame([("a",), ("c",)], "item string")).collect()
    assert {(r["id"], r["item"]) for r in long} == {("1", "a"), ("2", "c")}


def test_quality_looks_inside_containers(df):
    missing = {r["field"]: r["missing"] for r in quality.missing_by_field(df, quality.posting_missing()).collect()}
    assert missing == {"id": 0, "name": 0, "employer": 0, "area": 0, "salary": 4, "items": 2}
    assert quality.duplicate_counts(df).first().asDict() == {"rows": 13, "id_duplicates": 0, "content_duplicates": 1}
    score = quality.quality_score(df, quality.posting_missing()).first()["score"]
    assert score == pytest.approx(100 * (0.5 * (1 - 6 / 78) + 0.5 * (1 - 1 / 13)))


def test_contract(spark, df):
    assert required_leaves(CONTRACT) == ["id", "name", "area.name", "employer.name", "published_at"]
    assert all(r["missing"] == 0 for r in contract_violations(df, required_leaves(CONTRACT)).collect())
    assert ("key_skills", "array<string>", "array<struct<name:string>>") in schema_differences(df, CONTRACT)


def test_json_and_parquet_scans(spark, df, tmp_path):
    json_file = tmp_path / "p.json"
    json_file.write_text('[{"id": "1", "name": "a", "salary": {"from": null, "to": 5}}, {"id": "2"}]')
    got = read_postings(spark, str(json_file)).orderBy("id").collect()
    assert [r["id"] for r in got] == ["1", "2"] and got[0]["salary"]["to"] == 5.0 and got[1]["salary"] is None
    df.write.parquet(str(tmp_path / "p.parquet"))
    assert read_postings(spark, str(tmp_path / "p.parquet"), ["id", "area.name"]).columns == ["id", "name"]
