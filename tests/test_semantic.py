"""Clusters, representatives and the map against plain computations of the same rules."""

import datetime as dt
import hashlib
import math
import random

import numpy as np
import pytest

from pressmonth.operators import clusters, map2d

MARCH, APRIL = dt.date(2024, 3, 1), dt.date(2024, 4, 1)


def by_force(rows, k, steps):
    out = {}
    for month in {m for _, m, _ in rows}:
        own = {i: [math.floor(x * 65536) for x in v] for i, m, v in rows if m == month and v is not None}
        order = sorted(own, key=lambda i: (hashlib.md5(str(i).encode()).hexdigest(), i))
        centres = [own[i] for i in order[:k]]
        near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres))  # noqa: E731,B023
        for step in range(steps + 1):
            place = {i: near(v) for i, v in own.items()}
            if step < steps:
                for n in range(len(centres)):
                    held = [own[i] for i, (_, c) in place.items() if c == n]
                    if held:
                        centres[n] = [sum(column) // len(held) for column in zip(*held)]
        out.update({i: (month, c, gap / 65536**2) for i, (gap, c) in place.items()})
    return out


@pytest.mark.parametrize("steps", [0, 1, 4])
def test_clusters_equal_brute_force(spark, steps):
    rng = random.Random(steps)
    rows = [(i, MARCH if i % 3 else APRIL, [rng.choice([-1.0, 0.1, 0.25, 3.0]) for _ in range(3)]) for i in range(90)]
    rows += [(500, MARCH, None), (501, dt.date(2020, 1, 1), [0.5, 0.5, 0.5])]  # without a vector; alone in its month
    articles = spark.createDataFrame(rows, "id bigint, month_start date, embedding array<float>").repartition(3)
    got = {r.id: (r.month_start, r.cluster, r.distance) for r in clusters.clustered(articles, 4, steps).collect()}
    rows = [(r.id, r.month_start, r.embedding) for r in articles.collect()]
    assert got == by_force(rows, 4, steps) and 500 not in got and got[501] == (dt.date(2020, 1, 1), 0, 0.0)


def test_representatives_are_the_closest(spark):
    rows = [(1, MARCH, 0, 0.5), (2, MARCH, 0, 0.1), (3, MARCH, 0, 0.1), (4, MARCH, 1, 9.0), (5, APRIL, 0, 0.2)]
    assigned = spark.createDataFrame(rows, "id bigint, month_start date, cluster int, distance double")
    got = sorted((r.month_start, r.cluster, r.rn, r.id) for r in clusters.cluster_representatives(assigned, 2).collect())
    assert got == [(MARCH, 0, 1, 2), (MARCH, 0, 2, 3), (MARCH, 1, 1, 4), (APRIL, 0, 1, 5)]
    sizes = {(r.month_start, r.cluster): (r.news_count, r.farthest) for r in clusters.monthly_clusters(assigned).collect()}
    assert sizes == {(MARCH, 0): (3, 0.5), (MARCH, 1): (1, 9.0), (APRIL, 0): (1, 0.2)}


def test_no_step_shuffles_vectors_or_collects(spark):
    points = spark.createDataFrame([(1, MARCH, [1, 2])], "id bigint, month_start date, vector array<bigint>")
    plan = clusters.first_centres(points, 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")  # a rank with a limit before the shuffle


def test_axes_are_the_main_ones(spark):
    rng = np.random.default_rng(3)
    base, _ = np.linalg.qr(rng.normal(size=(6, 6)))
    x = rng.normal(size=(400, 6)) * [3.0, 1.5, 0.3, 0.2, 0.1, 0.1] @ base.T + 5
    news = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(999, None)], "id bigint, embedding array<double>")
    found = map2d.moments(news)
    axes = map2d.principal_axes(found)
    (first, gap1), (second, gap2) = (map2d.residual(found, a) for a in axes)
    assert found.n == 400 and gap1 < 1e-4 and gap2 < 1e-4 and first > second
    weights, vectors = np.linalg.eigh(np.cov(np.floor(x * 1024).T / 1024, bias=True))
    assert first == pytest.approx(weights[-1], rel=1e-6) and second == pytest.approx(weights[-2], rel=1e-6)
    for axis, expected in zip(axes, (vectors[:, -1], vectors[:, -2])):
        assert max(axis, key=abs) == 1 << 20 and abs(np.dot(np.array(axis, float) / np.linalg.norm(np.array(axis, float)), expected)) > 0.9999
    places = {r.id: (r.x, r.y) for r in map2d.map_2d(news).collect()}
    mean = x.mean(axis=0)
    unit = [np.array(a, float) / np.linalg.norm(np.array(a, float)) for a in axes]
    assert set(places) == set(range(400))
    assert max(abs(places[i][d] - (x[i] - mean) @ unit[d]) for i in places for d in (0, 1)) < 0.01


def test_maps_of_few_articles(spark):
    make = lambda rows: spark.createDataFrame(rows, "id bigint, embedding array<float>")
    assert map2d.map_2d(make([])).collect() == []
    assert [tuple(r) for r in map2d.map_2d(make([(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, None)])).orderBy("id").collect()] == [
        (1, 0.0, 0.0), (2, 0.0, 0.0)]
    line = {r.id: (r.x, r.y) for r in map2d.map_2d(make([(1, [1.0]), (2, [3.0])])).collect()}
    assert line == {1: (-1.0, 0.0), 2: (1.0, 0.0)}
