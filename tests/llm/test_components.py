from __future__ import annotations

import random

import pytest

from leaseload.llm import components


def plain(edges):
    least = {v: v for e in edges for v in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(least[a], least[b])
            if least[a] != low or least[b] != low:
                least[a] = least[b] = low
                changed = True
    return least


def graphs():
    rng = random.Random(3)
    yield [(n, n + 1) for n in range(300)]
    shuffled = rng.sample(range(-500, 500), 400)
    yield list(zip(shuffled, shuffled[1:]))
    yield [(7, n) for n in range(200)]
    yield [(rng.randrange(400), rng.randrange(400)) for _ in range(260)]
    yield [(5, 5), (-(1 << 63), 3), (3, 5)]


@pytest.mark.parametrize("edges", list(graphs()))
def test_least_reachable(spark, edges):
    order = list(edges)
    random.Random(1).shuffle(order)
    frame = spark.createDataFrame(order, "a bigint, b bigint").repartition(9)
    assert {r.vertex: r.label for r in components.smallest_label(frame).collect()} == plain(edges)


def test_no_links(spark):
    assert components.smallest_label(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_rounds_grow_with_the_logarithm(spark):
    """A shuffled path of 10,000 vertices, and a long descending run beside the least vertex."""
    path = random.Random(4).sample(range(10_000), 10_000)
    run = [(0, 1000), *[(n, n + 1) for n in range(1, 1000)]]
    for edges in (list(zip(path, path[1:])), run):
        rounds: list[int] = []
        frame = spark.createDataFrame(edges, "a bigint, b bigint").repartition(5)
        assert {r.label for r in components.smallest_label(frame, rounds=rounds).collect()} == {0}
        assert len(rounds) <= 20
        assert max(rounds) <= len(edges) + 1
