"""Related keywords and neighbours of many articles against full comparisons."""

import datetime as dt
import random

import numpy as np
import pytest

from pressmonth.operators import neighbours, related

MARCH, APRIL = dt.date(2024, 3, 1), dt.date(2024, 4, 1)


def hits(seed):
    """Keywords of all sizes: rare ones, groups with the same articles, and one in every article."""
    rng = random.Random(seed)
    rows = []
    for article in range(60):
        month = MARCH if article % 4 else APRIL
        found = {"everywhere", f"only {article}", f"also {article}", f"group {article // 3}", f"half {article % 2}"}
        found |= {f"w{min(int(rng.expovariate(0.2)), 25)}" for _ in range(rng.randrange(8))}
        rows += [(month, article, k) for k in found for _ in range(rng.choice([1, 1, 2]))]
    return rows


@pytest.mark.parametrize("percent", [30, 50, 75, 100])
def test_links_equal_all_pairs(spark, percent):
    rows = hits(percent)
    present = related.presence(spark.createDataFrame(rows, "month_start date, raw_noticia_id bigint, normalized_keyword string").repartition(3))
    classes = related.keyword_classes(present)
    sets = {}
    for month, article, keyword in rows:
        sets.setdefault((month, keyword), set()).add(article)
    leader = {}
    for (month, keyword), articles in sets.items():
        key = month, frozenset(articles)
        leader[key] = min(leader.get(key, keyword), keyword)
    assert {(r.month_start, r.keyword): (r.articles, r["class"]) for r in classes.collect()} == {
        (m, k): (len(a), leader[m, frozenset(a)]) for (m, k), a in sets.items()}
    expected = set()
    for (m, one), k in leader.items():
        for (n, two), o in leader.items():
            shared = len(one & two)
            if m == n and k < o and shared and 100 * shared >= percent * len(one | two):
                expected.add((m, k, o, shared, round(shared / len(one | two), 6)))
    got = {tuple(r) for r in related.keyword_links(present, classes, percent).collect()}
    assert got == expected and (expected or percent > 50)


def test_a_prefix_is_a_part(spark):
    rows = [(MARCH, a, "hot") for a in range(100)] + [(MARCH, a, f"x{a}-{i}") for a in range(100) for i in range(a % 10)]
    present = spark.createDataFrame(rows, "month_start date, article bigint, keyword string")
    kept = related.prefixes(present, 80).filter("keyword = 'hot'").collect()
    assert len(kept) == 30 and {r.articles for r in kept} == {100} and {r.article % 10 for r in kept} == {0, 1, 2}


def test_pairs_that_meet_by_chance_are_no_candidates(spark):
    """Common keywords meet in many articles; only pairs whose prefixes share enough are counted out."""
    rng = random.Random(2)
    sets = {f"w{i:02}": set(rng.sample(range(400), 80)) for i in range(40)}
    sets["w00 again"] = {*sorted(sets["w00"])[:70], 401}
    rows = [(MARCH, a, k) for k, articles in sets.items() for a in articles]
    present = spark.createDataFrame(rows, "month_start date, article bigint, keyword string")
    pairs = [(r.keyword, r.related) for r in related.candidate_links(related.prefixes(present)).collect()]
    assert ("w00", "w00 again") in pairs and len(pairs) < 80  # of 780 that meet
    links = related.keyword_links(present, related.keyword_classes(present)).collect()
    assert [(r.keyword, r.related, r.shared) for r in links] == [("w00", "w00 again", 70)]


def test_the_index_finds_close_neighbours(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 16))
    vectors = centres[rng.integers(0, 40, 800)] + rng.normal(size=(800, 16)) * 0.15
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(900, None), (901, [0.0] * 16)]
    news = spark.createDataFrame(rows, "id bigint, embedding array<double>")
    index = neighbours.hyperplane_index(news, 24, 8).cache()
    asked = index.filter("id % 50 = 0")
    measured = neighbours.recall(index, asked, 5).first()
    assert measured.wanted == 16 * 5 and measured.recall >= 0.9
    exact = {(r.asked_id, r.id): r.similarity for r in neighbours.nearest_by_comparison(index, asked, 5).collect()}
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    for asked_id in range(0, 800, 50):
        best = [i for i in np.argsort(-(unit @ unit[asked_id])) if i != asked_id][:5]
        assert {i for a, i in exact if a == asked_id} == set(best)
    found = neighbours.nearest_many(index, asked, 5).collect()
    assert all(exact.get((r.asked_id, r.id), r.similarity) == r.similarity for r in found)
    assert len({(r.asked_id, r.id) for r in found}) == len(found)
