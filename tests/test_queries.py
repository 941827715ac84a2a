"""Every census query against its SQL in DuckDB, on the smallest tables, and the plans of some."""

import math
import os

import pytest
from arborlens.plans import surface_queries  # noqa: F401
from arborlens.plans.queries import ORACLE_SQL, QUERIES

duckdb = pytest.importorskip("duckdb")
DATA = os.environ.get("ARBORLENS_TEST_DATA", "/root/testdata/sf0.001")
TABLES = ("customer", "documents", "embeddings", "events", "lineitem", "orders", "pages", "part", "supplier")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else format(value, ".9g")
    if isinstance(value, bool) or value is None:
        return value
    return format(value, ".9g") if isinstance(value, int) else str(value)


def rows(names, values):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(plain(v[i]) for i in order) for v in values), key=str)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_equals_sql(spark, db, name):
    got, want = QUERIES[name](spark, DATA), db.sql(ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, got.collect()) == rows(want.columns, want.fetchall())


def plan(spark, name):
    return QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()


def test_plans(spark):
    latest = plan(spark, "latest_per_key")
    assert latest.count("Exchange") == 1 and latest.count("WindowGroupLimit") == 2
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,100000.0)" in plan(spark, "projection_filter")
    assert plan(spark, "error_codes").count("Exchange") <= 2
    for name in ("near_duplicate_points", "nearest_points", "anti_null_safe", "crop_polygon", "traj_asof"):
        found = plan(spark, name)
        assert "Cartesian" not in found and "NestedLoop" not in found, name
    assert not any("Python" in plan(spark, n) or "Arrow" in plan(spark, n) for n in ("errors_view", "voxel_center", "tile_buffer", "author_inference"))
