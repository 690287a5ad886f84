"""Every registered query with SQL agrees with it on the smallest tables; the rest return rows of a stable schema."""

import subprocess
import sys
from pathlib import Path

import pytest
from oracle import connect, differences

import __spark_entry__ as entry
from premia.plans import registry

SF = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables absent")


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, name):
    assert differences(spark, connect(SF), SF, entry.queries()[name], SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(SQL)))
def test_runs(spark, name):
    out = entry.queries()[name](spark, SF)
    assert out.columns and out.count() > 0


def test_entry(spark):
    assert entry.entry(spark).columns == ["item", "strata_used", "adjusted_premium"]


def test_core_queries_are_listed_without_the_optional_libraries():
    code = "import sys; sys.modules['sentencepiece'] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    root = Path(__file__).resolve().parent.parent
    got = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=root, check=True).stdout.split()
    assert [int(n) for n in got] == [len(registry.all_queries()), sum(sql is not None for _, sql in registry.all_queries().values())]
