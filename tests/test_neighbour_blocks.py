"""Neighbours compared block by block: equal to plain loops, and no row for each pair."""

import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from pressmonth.operators import neighbours


def by_force(rows, top):
    vectors = {r.id: r.vector for r in rows}
    lengths = {r.id: float(r.length) for r in rows}
    out = set()
    for i in (i for i in vectors if i % 5 == 0):
        found = []
        for j in vectors:
            if i != j:
                below = lengths[i] ** 0.5 * lengths[j] ** 0.5
                value = None
                if below:
                    product = sum(a * b for a, b in zip(vectors[i], vectors[j]))
                    value = float(Decimal(repr(float(product) / below)).quantize(Decimal("1e-6"), ROUND_HALF_UP))
                found.append((value is None, -(value or 0), j, value))
        out |= {(i, j, value, n) for n, (_, _, j, value) in enumerate(sorted(found)[:top], 1)}
    return out


@pytest.mark.parametrize("blocks", [(4096, 16384), (3, 7)])
def test_blocks_equal_a_full_comparison(spark, monkeypatch, blocks):
    monkeypatch.setattr(neighbours, "BLOCK_ASKED", blocks[0])
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", blocks[1])
    rng = random.Random(8)
    vectors = [[rng.choice([-1.0, 0.5, 0.25, 3.0]) for _ in range(rng.choice([2, 4]))] for _ in range(60)]
    vectors += [[1.0, 2.0, 3.0, 4.0]] * 25 + [[0.0, 0.0], [1.0, 0.0, 2.0], [], None, [1e4, -1e4, 1e4, 1e4]]
    news = spark.createDataFrame(list(enumerate(vectors)), "id bigint, embedding array<double>")
    index = neighbours.hyperplane_index(news, 3, 1).cache()
    asked = index.filter(F.col("id") % 5 == 0)
    want = by_force(index.collect(), 6)
    assert {tuple(r) for r in neighbours.nearest_by_comparison(index, asked, 6).select("asked_id", "id", "similarity", "rn").collect()} == want
    # all share the only bucket of both tables, so the index must find the same
    whole = index.withColumn("buckets", F.array(F.lit(0).cast("bigint"), F.lit(0).cast("bigint")))
    found = neighbours.nearest_many(whole, whole.filter(F.col("id") % 5 == 0), 6).select("asked_id", "id", "similarity", "rn").collect()
    assert {tuple(r) for r in found} == want and len(found) == len(want)


def test_no_row_is_made_for_a_pair(spark):
    news = spark.createDataFrame([(0, [1.0, 2.0]), (5, [2.0, 1.0])], "id bigint, embedding array<double>")
    index = neighbours.hyperplane_index(news, 3, 1)
    for rows in (neighbours.nearest_many(index, index), neighbours.nearest_by_comparison(index, index)):
        text = rows._jdf.queryExecution().executedPlan().toString()
        assert "FlatMapCoGroupsInArrow" in text
        assert "zip_with" not in text.split("FlatMapCoGroupsInArrow")[0]
