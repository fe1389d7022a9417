"""Connected components: one task for few edges, rounds for many, the same result."""

import random

import pytest

from pelagos.operators import graph


def brute(edges):
    root = {}
    for a, b in edges:
        if a is None or b is None or a == b:
            continue
        x, y = ({i for i, r in root.items() if r == root[c]} if c in root else {c} for c in (a, b))
        root |= dict.fromkeys(x | y, min(x | y))
    return sorted(root.items())


def got(spark, edges, kind="long"):
    out = graph.connected_components(spark.createDataFrame(edges, f"a {kind}, b {kind}").repartition(3))
    assert [t for _, t in out.dtypes] == [{"long": "bigint"}.get(kind, kind)] * 2
    return sorted(map(tuple, out.collect()))


def some(seed, nodes, n):
    rng = random.Random(seed)
    ids = rng.sample(range(-10 ** 6, 10 ** 6), nodes)
    return [(rng.choice(ids), rng.choice(ids)) for _ in range(n)]


CASES = {
    "none": [], "loops": [(1, 1), (2, 2)], "nulls": [(None, 1), (2, None), (3, 4)],
    "ends": [(-(1 << 63), (1 << 63) - 1), ((1 << 63) - 1, 0), (5, 6), (6, 5), (6, 5)],
    "chain": [(i, i + 1) for i in range(300)], "zigzag": [(i * 37 % 301, (i + 1) * 37 % 301) for i in range(300)],
    "star": [(999, i) for i in range(200)], "two stars": [(999, i) for i in range(99)] + [(998, i) for i in range(98, 200)],
    "sparse": some(1, 300, 140), "dense": some(2, 60, 400),
}


@pytest.mark.parametrize("name", CASES)
def test_against_brute_force(spark, name):
    assert got(spark, CASES[name]) == brute(CASES[name])


@pytest.mark.parametrize("name", ["none", "zigzag", "two stars", "sparse"])
def test_rounds_give_the_same(spark, monkeypatch, name):
    monkeypatch.setattr(graph, "ALONE", -1)
    assert got(spark, CASES[name]) == brute(CASES[name])


def test_types_stay_and_batches_meet(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert got(spark, CASES["zigzag"], "int") == brute(CASES["zigzag"])
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_few_edges_take_few_jobs(spark):
    """The driver keeps the plan of each job: small inputs had ten and more a round."""
    sc = spark.sparkContext
    sc.setJobGroup("components of few edges", "")
    try:
        assert got(spark, CASES["zigzag"]) == brute(CASES["zigzag"])
        assert len(sc.statusTracker().getJobIdsForGroup("components of few edges")) <= 10
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        sc.setLocalProperty("spark.job.description", None)
