"""Every registered query against its SQL in DuckDB, at the smallest scale."""

import os

import duckdb
import pytest

from pelagos.plans import catalog
from tools.oracle import T, norm

SF = os.environ.get("PELAGOS_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in T:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


#: Queries that SQL can't express, or only too slowly on whole tables, and the test of each.
ELSEWHERE = {
    "flagship_strict": "test_semantics.py::test_two_detections_may_share_a_vessel_in_compat_only", "u06_modes_compared": "test_semantics.py::test_two_detections_may_share_a_vessel_in_compat_only", "j22_optimal_assignment": "test_whole.py::test_assignment_of_every_detection",
    "j20_j25_quality_merge": "test_whole.py::test_quality_merge_of_every_detection", "j21_multi_scale_merge": "test_whole.py::test_multi_scale_merge_of_every_detection",
    "j23_a24_point_matching": "test_whole.py::test_matchings_are_the_largest", "a24_scene_metrics": "test_whole.py::test_matching_counts_every_box", "j24_box_matching": "test_whole.py::test_matchings_are_the_largest",
    "r02_water_regions": "test_whole.py::test_regions_of_every_cell",
}


def test_every_query_is_tested():
    left = set(catalog.queries()) - set(catalog.oracle_sql())
    assert left == set(ELSEWHERE)
    for where in ELSEWHERE.values():
        file, name = where.split("::")
        with open(os.path.join(os.path.dirname(__file__), file)) as f:
            assert f"def {name}(" in f.read()


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(name, spark, duck):
    df = catalog.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(norm(v) for v in r) for r in df.select(*cols).collect()), key=str)
    sql = catalog.oracle_sql().get(name)
    if sql is None:
        return
    cur = duck.execute(sql)
    names = [c[0] for c in cur.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert got == sorted((tuple(norm(r[i]) for i in at) for r in cur.fetchall()), key=str)


def test_names_and_oracles():
    assert set(catalog.oracle_sql()) <= set(catalog.queries()) and len(catalog.queries()) > 100
