"""Every registered query against its SQL in DuckDB, and in another partitioning of its input."""

import glob
import importlib
import math
import os

import pytest

from pitpanel.plans import registry

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables are not here")


def plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, float) and value == int(value):
        return int(value)
    text = str(value)
    return text.removesuffix(" 00:00:00") if hasattr(value, "year") else text if hasattr(value, "as_tuple") else value


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted((tuple(plain(r[k]) for k in order) for r in data), key=repr)


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for p in glob.glob(f"{DATA}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = registry.queries()[name](spark, DATA)
    got = rows(df.columns, df.collect())
    done = duck.execute(registry.oracle_sql()[name])
    columns = [d[0] for d in done.description]
    assert sorted(df.columns) == sorted(columns)
    assert got == rows(columns, done.fetchall())


@pytest.mark.parametrize("name", ["prefilter_candidates", "visible_event_versions", "peer_percentiles", "table_fingerprint", "activity_windows"])
def test_result_does_not_depend_on_partitioning(spark, name, tmp_path):
    for p in glob.glob(f"{DATA}/*.parquet"):
        spark.read.parquet(p).repartition(7).write.parquet(f"{tmp_path}/{os.path.basename(p)}")
    query = registry.queries()[name]
    one, other = query(spark, DATA), query(spark, str(tmp_path))
    assert rows(one.columns, one.collect()) == rows(other.columns, other.collect())


def test_queries_without_sql_run(spark):
    for name in sorted(set(registry.queries()) - set(registry.oracle_sql())):
        assert registry.queries()[name](spark, DATA).count() > 0, name


def test_entry_module(spark):
    entry = importlib.import_module("__spark_entry__")
    assert set(registry.queries()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
