"""Hard negatives, vector codes and repeated passages against brute force, and their defined results for odd rows."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from pressmonth.llm import ball_codes, hard_negatives, repeats
from pressmonth.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "vec_id bigint, embedding array<float>, label int"


def finite(vector):
    return vector is not None and all(x is not None and math.isfinite(x) for x in vector)


@pytest.fixture(scope="module")
def vectors(spark):
    """Few distinct vectors (many ties), odd components, no label, negative ids, and columns with clashing names."""
    rng = random.Random(2)
    rows = []
    for i in range(700):
        vector = [rng.choice([-0.5, 0.0, 0.25, 0.01, 0.3]) for _ in range(8)]
        if rng.random() < 0.05:
            vector[2] = rng.choice([None, float("nan"), float("inf")])
        if rng.random() < 0.03:
            vector = None
        rows.append((i - 50, vector, rng.choice([None, 0, 1, 1, 1, 9])))
    frame = spark.createDataFrame(rows, SCHEMA)
    for clash in ("id", "vector", "score", "part", "group", "code", "error", "portion", "anchor"):
        frame = frame.withColumn(clash, F.lit("clash"))
    return frame.cache()


def as_rows(frame):
    return [(r["vec_id"], r["embedding"], r["label"]) for r in frame.collect()]


def negatives_by_force(rows):
    points = [(i, lab, [math.floor(256 * x) for x in v]) for i, v, lab in rows if lab is not None and i is not None and finite(v)]
    out = []
    for anchor, label, vector in (p for p in points if p[0] % 100 == 0):
        scored = [(i, lab, sum(a * b for a, b in zip(vector, v))) for i, lab, v in points if i != anchor]
        first = lambda found: sorted(found, key=lambda x: (-x[2], x[0]))[:5]
        for positive, _, score in first(x for x in scored if x[1] == label):
            found = first(x for x in scored if x[1] != label and 80 * score <= 100 * x[2] <= 100 * score)
            out += [(anchor, positive, place, x[0], score, x[2]) for place, x in enumerate(found, 1)]
    return sorted(out)


COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def mined(frame):
    found = hard_negatives.hard_negatives(frame, F.col("id") % 100 == 0)
    return sorted(tuple(r[c] for c in COLUMNS) for r in found.collect())


def test_hard_negatives_equal_brute_force(vectors, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 90)
    monkeypatch.setattr(hard_negatives, "BLOCK_ANCHORS", 3)
    assert mined(vectors) == negatives_by_force(as_rows(vectors)) != []


def test_hard_negatives_of_odd_rows(spark):
    rows = [(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (1, [1.0], 1), (2, [0.9, 0.4], 2), (3, [0.9, -0.4], 2), (3, [0.1, 0.1], 3),
            (None, [1.0, 0.0], 2), (4, [], 2), (5, [1e30, 0.0], 2), (6, [-1.0, 0.0], 1), (100, [0.0, 0.0], 7)]
    frame = spark.createDataFrame(rows, SCHEMA)
    # row 0 once; row 1 lacks a component; of the rows with id 3 the one with label 2; row 5 held at 2^21 lies above the window
    assert mined(frame) == [(0, 1, 1, 2, 65536, 256 * 230), (0, 1, 2, 3, 65536, 256 * 230)]
    assert mined(frame.limit(0)) == []


def codes_by_force(rows, entries, rounds):
    kept = [(i, lab, [math.floor(1024 * x) for x in v]) for i, v, lab in rows if finite(v)]
    values = np.array([v for _, _, v in kept])
    size = values.shape[1] // 4
    own = [values[:, p * size : (p + 1) * size] for p in range(4)]
    order = sorted(range(len(kept)), key=lambda j: kept[j][0])[:entries]
    books = np.stack([x[order] for x in own])

    def nearest():
        gaps = [((x[:, None, :] - b[None]) ** 2).sum(axis=2) for x, b in zip(own, books)]
        return np.stack([g.argmin(axis=1) for g in gaps], axis=1), sum(g.min(axis=1) for g in gaps)

    for _ in range(rounds):
        codes, _ = nearest()
        for p in range(4):
            for entry in set(codes[:, p].tolist()):
                held = own[p][codes[:, p] == entry]
                books[p, entry] = held.sum(axis=0) // len(held)
    codes, errors = nearest()
    return sorted((kept[j][0], bytes(codes[j].tolist()).hex(), int(errors[j]), kept[j][1]) for j in range(len(kept))), books


@pytest.mark.parametrize(("entries", "rounds"), [(256, 2), (7, 4)])
def test_codes_equal_brute_force(vectors, entries, rounds):
    coded, books = ball_codes.compress(vectors, entries=entries, rounds=rounds)
    expected, expected_books = codes_by_force(as_rows(vectors), entries, rounds)
    got = ball_codes.label_errors(coded.select("id", "label", "code", "error")).collect()
    assert sorted((r["id"], r["code"].hex(), r["error"], r["label"]) for r in got) == sorted(expected, key=lambda r: r[0])
    assert (books == expected_books).all()
    totals = {}
    for _, _, error, label in expected:
        totals[label] = totals.get(label, 0) + error
    assert {r["label"]: r["label_error"] for r in got} == totals


def test_balls_change_no_result():
    rng = np.random.default_rng(4)
    for spread in (3, 40, 2000):
        points, entries = rng.integers(-spread, spread, (900, 5)), rng.integers(-spread, spread, (60, 5))
        codes, gaps = ball_codes.first_codes(points, entries)
        start = rng.integers(0, 60, 900)
        for before in (start, codes):
            again, same_gaps = ball_codes.ball_codes(points, entries, before)
            assert (again == codes).all() and (same_gaps == gaps).all()


def test_codes_of_odd_rows(spark):
    rows = [(None, [1.0, 2.0], None), (1, [1.0], 5), (1, [1.0], 5), (2, [], 5), (3, None, 5), (4, [1e30], 6)]
    coded, books = ball_codes.compress(spark.createDataFrame(rows, SCHEMA))
    assert coded.count() == 5 and books.shape == (4, 5, 1)
    assert [r["error"] for r in coded.collect()] == [0] * 5
    assert books[0].ravel().tolist() == [1024, 1024, 0, 1 << 25, 1024]
    empty, _ = ball_codes.compress(spark.createDataFrame(rows, SCHEMA).limit(0))
    assert empty.count() == 0


def kept_by_force(rows, window):
    seen, out = set(), []
    for key, text in sorted(rows):
        found, gone = WORD.findall(text or ""), set()
        for start in range(len(found) - window + 1):
            content = tuple(found[start : start + window])
            if content in seen:
                gone.update(range(start, start + window))
            seen.add(content)
        out.append((key, len(found), len(gone), " ".join(w for i, w in enumerate(found) if i not in gone)))
    return out


def repetitive_rows():
    rng = random.Random(5)
    rows = []
    for i in range(250):
        text = " ".join(rng.choice("abcdé") for _ in range(rng.choice([0, 3, 19, 20, 21, 60, 300])))
        if rows and rng.random() < 0.5:
            other = rng.choice(rows)[1]
            start = rng.randrange(len(other) + 1)
            text = f"{text}\t{other[start : rng.randrange(start, len(other) + 1)]} \n{text}"
        rows.append((i, "a " * rng.randrange(60) if rng.random() < 0.1 else text))
    return [*rows, (900, rows[7][1]), (901, rows[7][1]), (902, None), (903, "\x0b \x1c\u0085 "), (904, "w" * 300_000)]


@pytest.mark.parametrize(("window", "seed", "block"), [(20, 5, 500_000), (5, 3, 100), (6, 6, 300), (4, 1, 50)])
def test_repeats_equal_brute_force(spark, monkeypatch, window, seed, block):
    monkeypatch.setattr(repeats, "BLOCK_RUNS", block)
    rows = repetitive_rows()
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    for clash in ("id", "print", "first_runs", "kept", "n_words", "removed"):
        frame = frame.withColumn(clash, F.lit("clash"))
    got = repeats.remove_repeats(frame, window, seed).collect()
    assert sorted((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got) == kept_by_force(rows, window)
    texts = dict(rows)
    for r in got:
        found = WORD.findall(texts[r["doc_id"]] or "")
        assert all(b["first"] > a["end"] for a, b in zip(r["removed"], r["removed"][1:]))
        assert all(s["end"] - s["first"] >= window for s in r["removed"])
        assert r["kept"] == " ".join(w for i, w in enumerate(found) if not any(s["first"] <= i < s["end"] for s in r["removed"]))


def test_repeats_of_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(30))
    rows = [(None, long), (1, long), (1, long), (2, f"x {long}"), (2, f"{long} y"), (3, "short text")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted((r["doc_id"] or 0, r["n_words"], r["n_removed"]) for r in repeats.remove_repeats(frame).collect())
    # the null id comes first and keeps its words; rows that repeat id and text share their result
    assert got == [(0, 30, 0), (1, 30, 30), (1, 30, 30), (2, 31, 30), (2, 31, 30), (3, 2, 0)]
    assert repeats.remove_repeats(frame.limit(0)).count() == 0


def test_queries_return_their_contracts(spark):
    directory = "/root/testdata/sf0.001"
    assert QUERIES["op11_hard_negatives"](spark, directory).columns == list(COLUMNS)
    assert QUERIES["op12_vector_codes"](spark, directory).columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    rows = QUERIES["op13_substring_dedup"](spark, directory)
    assert rows.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    assert rows.count() == spark.read.parquet(f"{directory}/documents.parquet").count()
