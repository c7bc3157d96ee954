"""Every registered query of the library: against its SQL on the smallest tables, and that the registry hangs together."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from flowmart.plans import catalog

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the test tables aren't here")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return c


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return ""
    if isinstance(v, bool):
        return str(v)
    return repr(round(float(v), 5) + 0.0) if isinstance(v, (int, float)) or hasattr(v, "quantize") else str(v)


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_equals_sql(spark, duck, name):
    out = catalog.QUERIES[name](spark, SF)
    got = [tuple(r) for r in out.collect()]
    want = duck.execute(catalog.SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(out.columns)
    assert rows(out.columns, got) == rows(names, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.SQL)))
def test_runs(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0


def test_scalar_functions_of_odd_values(spark, tmp_path):
    """ln(0) is minus infinity and a missing value's sigmoid 0, as in SQL; both were null. Larger tables hold zeros, the smallest doesn't."""
    name, path = "o_scalar_functions", f"{tmp_path}/events.parquet"
    values = "(1, 0.0), (2, 1.0), (3, 1e-300), (4, 560.21), (5, 'inf'::DOUBLE), (6, NULL), (7, -0.0), (8, 'nan'::DOUBLE)"
    with duckdb.connect() as c:
        c.execute(f"COPY (SELECT i::BIGINT AS event_id, TIMESTAMP '2024-01-06 23:59:59' + to_hours(i) AS ts, v::DOUBLE AS value FROM (VALUES {values}) t(i, v)) TO '{path}' (FORMAT parquet)")
        c.execute(f"CREATE VIEW events AS SELECT * FROM '{path}'")
        want = c.execute(catalog.SQL[name])
        names, want = [d[0] for d in want.description], want.fetchall()
    out = catalog.QUERIES[name](spark, str(tmp_path))
    assert rows(out.columns, [tuple(r) for r in out.collect()]) == rows(names, want)
    assert {r.event_id: r.ln for r in out.collect()}[1] == float("-inf")


def test_scalar_functions_below_zero_and_late(spark, tmp_path):
    """ln of a negative value is NaN, which was null; a year of five digits has no sign. NaN and null count as different here."""
    name, path = "o_scalar_functions", f"{tmp_path}/events.parquet"
    values = "(1, '2024-01-06', -1.0), (2, '12024-01-06', 1e-300), (3, '2024-01-06', '-inf'), (4, '0024-01-06', NULL), (5, NULL, 'nan'), (6, '2024-01-06', 0.0), (7, '9999-12-31', -1e-300)"
    with duckdb.connect() as c:
        c.execute(f"COPY (SELECT i::BIGINT AS event_id, t::TIMESTAMP AS ts, v::DOUBLE AS value FROM (VALUES {values}) x(i, t, v)) TO '{path}' (FORMAT parquet)")
        c.execute(f"CREATE VIEW events AS SELECT * FROM '{path}'")
        want = c.execute(catalog.SQL[name] + " ORDER BY event_id").fetchall()
    got = [tuple(r) for r in catalog.QUERIES[name](spark, str(tmp_path)).orderBy("event_id").collect()]
    assert list(map(str, got)) == list(map(str, want))
    assert math.isnan(got[0][4]) and got[1][1] == "12024-01-06"


def test_merged_sketches_shuffle_no_rows(spark, tmp_path):
    """As with sketches that are too large to be broadcast. The estimates are held against the rows where these are; every row went once for each column to that column's task before."""
    spark.range(40).crossJoin(spark.read.parquet(f"{SF}/lineitem.parquet")).drop("id").coalesce(1).write.parquet(f"file://{tmp_path}/lineitem.parquet")
    n, sc = spark.read.parquet(f"file://{tmp_path}/lineitem.parquet").count(), spark.sparkContext
    sc.setJobGroup("merged_sketches", "")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    out = catalog.QUERIES["c16_merged_sketches"](spark, f"file://{tmp_path}").collect()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert sorted((r.column, r.n, r.nulls, r.distinct_near, r.median_near) for r in out) == [("l_extendedprice", n, 0, True, True), ("l_quantity", n, 0, True, True)]
    stages = {i for j in sc.statusTracker().getJobIdsForGroup("merged_sketches") for i in sc.statusTracker().getJobInfo(j).stageIds}
    assert 0 < max(sc._jsc.sc().statusStore().lastStageAttempt(i).shuffleWriteRecords() for i in stages) < n / 4


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_look_ahead(spark):
    audit = catalog.QUERIES["n5_lookahead_audit"](spark, SF).collect()
    assert audit and all(r.compared > 0 and r.different == 0 and r.only_left == 0 and r.only_right == 0 for r in audit)
