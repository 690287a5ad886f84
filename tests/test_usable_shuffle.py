"""What travels when postings are de-duplicated: a binary digest, and the columns of usable rows only."""

from premia.operators import prep

SCHEMA = (
    "id string, name string, description string, key_skills array<struct<name: string>>, area struct<id: string, name: string>,"
    " employer struct<id: string, name: string>, salary struct<`from`: double, `to`: double, currency: string, gross: boolean>,"
    " experience struct<id: string>"
)


def _posting(id, name, low=1000.0, high=2000.0, items=("a", "b"), employer="e", gross=False):
    skills = None if items is None else [(i,) for i in items]
    return (id, name, "d", skills, ("1", "Москва"), employer and ("1", employer), low and (low, high, "RUR", gross), ("none",))


def _kept(spark, *rows, **options):
    out = prep.usable_postings(spark.createDataFrame(list(rows), SCHEMA).coalesce(1), **options)
    return [(r["id"], r["salary_net"]) for r in out.orderBy("id", "salary_net").collect()]


def test_unusable_rows_travel_as_id_and_digest(spark):
    out = prep.usable_postings(spark.createDataFrame([_posting("1", "n")], SCHEMA))
    assert out.columns == ["id", "items", "salary_net", "has_ceiling", "city_bucket", "experience_bucket"]
    plan = out._jdf.queryExecution().optimizedPlan()
    aggregate = next(x for x in str(plan).split("\n") if "Aggregate [_content" in x)
    assert "salary_net" not in aggregate and "_row" in aggregate
    below = str(plan).split(aggregate, 1)[1]
    assert "unhex(sha2(" in below and "THEN struct(items" in below


def test_lowest_id_decides_even_if_it_is_not_usable(spark):
    rows = [_posting("2", "n"), _posting("1", "n", high=None), _posting("4", "m"), _posting("3", "m", items=None), _posting("5", "k", items=("a", ""))]
    assert _kept(spark, *rows) == []
    assert _kept(spark, *rows, require_ceiling=False) == [("1", 1000.0)]
    assert _kept(spark, *rows, dedup=False) == [("2", 1500.0), ("4", 1500.0)]


def test_null_contents_and_ids_and_repeated_rows(spark):
    rows = [
        _posting("2", None), _posting("1", None), _posting("3", None, employer=None), _posting("4", ""),  # null, null employer and "" differ
        _posting(None, "n"), _posting("5", "n"),  # a null id is the lowest
        _posting("6", "t", gross=True), _posting("6", "t", gross=True), _posting("7", "u", low=None),
    ]
    assert _kept(spark, *rows) == [(None, 1500.0), ("1", 1500.0), ("3", 1500.0), ("4", 1500.0), ("6", 1305.0)]
