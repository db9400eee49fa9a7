"""The toxicity search against plain TF-IDF cosines over every term, on real documents."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from pressmonth.llm import toxicity
from pressmonth.llm.arrays import text_bytes

SF = "/root/testdata/sf0.001"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def plain_terms(text):
    """Term -> count, by one word after the other."""
    found = Counter()
    for word in WORD.findall((text or "").encode()):
        word = bytes(b + 32 if 65 <= b <= 90 else b for b in word)
        core = re.sub(rb"^[^a-z0-9\x80-\xff]+|[^a-z0-9\x80-\xff]+$", b"", word)
        if core:
            found[(0, core)] += 1
            for size in (4, 6, 8):
                if len(core) > size:
                    found[(size, core[:size])] += 1
    return found


@pytest.fixture(scope="module")
def sample(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(90_001, None), (90_002, ""), (90_003, "?! -- ..."), (90_004, "unheardofwordaltogether")], docs.schema)
    docs = docs.unionByName(odd)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    return docs, labels, toxicity.fit(docs, labels, "toxic", "doc_id", "text")


def test_neighbours_equal_plain_cosines(sample):
    docs, _, model = sample
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    counts = {i: plain_terms(t) for i, t in texts.items()}
    vocabulary = set().union(*(counts[i] for i in model.ids))
    assert len(model.vocabulary) == len(vocabulary)  # no term of an example is left out
    frequency = Counter(t for c in counts.values() for t in c if t in vocabulary)
    idf = {t: math.log((2 + len(texts)) / (1 + frequency[t])) for t in vocabulary}

    def unit(count):
        vector = {t: (1 + math.log(n)) * idf[t] for t, n in count.items() if t in vocabulary}
        norm = math.sqrt(sum(w * w for w in vector.values()))
        return {t: w / norm for t, w in vector.items()}

    vectors = {i: unit(c) for i, c in counts.items()}
    ids = sorted(texts)
    starts, at, weight = toxicity.vectors(*text_bytes(pa.array([texts[i] for i in ids], pa.string())), model.vocabulary, model.idf)
    found = list(model.index.search(starts, at, weight, toxicity.NEIGHBOURS))
    assert len(found) == len(ids)
    for doc, (near, cosine) in zip(ids, found):
        own = vectors[doc]
        exact = {i: sum(w * vectors[i].get(t, 0.0) for t, w in own.items()) for i in model.ids}
        best = sorted((s for s in exact.values() if s > 1e-12), reverse=True)[: toxicity.NEIGHBOURS]
        assert np.allclose(cosine, best, atol=1e-6)
        assert np.allclose([exact[model.ids[n]] for n in near], cosine, atol=1e-6)


def test_many_blocks_and_steps_equal_full_scan(monkeypatch):
    rng = np.random.default_rng(11)
    held = rng.random((1000, 300)) < np.linspace(0.4, 0.005, 300)  # frequent and rare terms
    dense = np.where(held, rng.random((1000, 300)), 0)
    dense[rng.random(1000) < 0.3] *= np.arange(300) < 40
    dense[500:600] = dense[400:500]  # ties
    dense /= np.maximum(np.linalg.norm(dense, axis=1, keepdims=True), 1e-9)
    rows, at = np.nonzero(dense)
    index = toxicity.BlockMaxIndex.of(np.searchsorted(rows, np.arange(1001)), at, dense[rows, at], 300)
    monkeypatch.setattr(toxicity, "POSTINGS", 500)
    for k in (1, 25, 999, 1000, 2000):
        for query, (near, cosine) in zip(dense, index.search(np.searchsorted(rows, np.arange(1001)), at, dense[rows, at], k)):
            exact = np.round(dense @ query, 9)
            order = np.lexsort((np.arange(1000), -exact))[:k]
            order = order[exact[order] > 0]
            assert np.allclose(cosine, exact[order], atol=1e-6)
            assert np.allclose(exact[near], cosine, atol=1e-6) and len(set(near.tolist())) == len(near)


def test_texts_without_known_terms_and_repeated_ids(spark, sample):
    docs, labels, _ = sample
    repeated = docs.unionByName(docs).unionByName(spark.createDataFrame([(None, "no id")], docs.schema))
    got = {}
    for row in toxicity.score_toxicity(repeated, labels).collect():
        got.setdefault(row["text"], set()).add((row["toxicity"], tuple(row["evidence"])))
    assert all(len(v) == 1 for v in got.values())
    assert got[None] == got[""] == got["?! -- ..."] == got["unheardofwordaltogether"]
    (score, evidence), = got[None]
    assert 0 < score < 1 and evidence == ()


def test_few_labelled_rows_still_tell_texts_apart(spark):
    rows = [(i, f"{'vile nasty' if i % 2 else 'calm kind'} text number{i}") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(8)], "doc_id bigint, toxic int")
    score = {r["doc_id"]: r["toxicity"] for r in toxicity.score_toxicity(docs, labels).collect()}
    assert min(score[9], score[11]) > max(score[8], score[10])
