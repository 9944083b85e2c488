"""Every registered query against its SQL twin."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as contract
from compare import SAME_TYPE, connect, duck_rows, spark_rows
from tripstats import registry
from tripstats.registry import analyses

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) == set(registry.SQL)
    assert set(registry.QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_same_rows(spark, duck, name):
    columns, rows = spark_rows(contract.queries()[name](spark, SF_DIR))
    duck_columns, expected = duck_rows(duck, contract.oracle_sql()[name])
    assert [c for c, _ in columns] == [c for c, _ in duck_columns]
    for (column, spark_type), (_, duck_type) in zip(columns, duck_columns):
        assert duck_type in SAME_TYPE[spark_type], column
    assert sum(expected.values()) > 0
    assert rows == expected


IN_ORDER = ["sort_desc", "sort_asc", "topk", "job_daily_with_mean", "job_daily_with_mean_all", "job_anomaly_bands", "job_top_boroughs_merged"]


@pytest.mark.parametrize("name", IN_ORDER)
def test_same_order(spark, duck, name):
    """The collected rows come as the ORDER BY of the oracle says; keys break all ties."""
    df = contract.queries()[name](spark, SF_DIR)
    result = duck.execute(contract.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert "ORDER BY" in contract.oracle_sql()[name]
    assert [tuple(r) for r in df.select(*names).collect()] == result.fetchall()


CLEANED = [x for x in sorted(registry.QUERIES) if x.startswith("job_")]


@pytest.mark.parametrize("name", CLEANED)
def test_cleansing_matters(duck, name):
    """Every job has rows to cleanse: its oracle gives other rows without."""
    sql = registry.SQL[name]
    raw = sql
    for clean in (analyses._CLEAN, analyses._CLEAN_COMPAT, "pickup_ts IS NOT NULL AND dropoff_ts IS NOT NULL"):
        raw = raw.replace(clean, "true")
    assert raw != sql
    assert duck_rows(duck, raw)[1] != duck_rows(duck, sql)[1]


def test_corpus_operators_may_be_missing(tmp_path):
    """Without corpus_pipeline and the llm folders everything else still works."""
    root = Path(contract.__file__).parent
    shutil.copytree(root / "tripstats", tmp_path / "tripstats", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    env = {**os.environ, "PYTHONPATH": ""}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert done.stdout.split() == [str(len(registry.QUERIES))] * 2, done.stderr


def test_entry_is_stable(spark):
    df = contract.entry(spark)
    assert df.columns == ["taxi_type", "role", "Borough", "count"]
    assert df.count() > 0
