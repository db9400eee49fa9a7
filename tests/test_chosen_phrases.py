"""The choice of phrases within the counting pass, and texts that are cleaned once for all extractors."""

import random

import pytest

from pressmonth.operators import keyphrases as kp
from pressmonth.plans import catalog
from test_hits import documents
from test_keyphrases import levenshtein

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_near_phrases_are_told_by_edit_distance():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abñ ") for _ in range(rng.randrange(0, 45)))
    for _ in range(4000):
        a = word()
        b = list(a)
        for _ in range(rng.randrange(6)):
            at = rng.randrange(len(b) + 1)
            b[at : at + rng.randrange(2)] = rng.choice(["", "a", "ñ"])
        b = "".join(b)
        for x, y in ((a, b), (b, a), (a, word())):
            assert kp._near(x, y) == (levenshtein(x, y) * 10 < max(len(x), len(y)))


@pytest.mark.parametrize("limit", [1, 5, 12, 400])
def test_phrases_are_chosen_in_the_counting_pass(spark, limit):
    rng = random.Random(limit)
    stems = ["intendencia", "ministeriales", "Ñandú", "ΣΊΣΥΦΟΣ", "Straße", "de", "2024", "presupuestario", "x_y", "coop-luz", "ﬁnanzas"]
    word = lambda: rng.choice(stems) + rng.choice(["", "", "", "s", "n", "e", "a"])
    texts = [" ".join(word() + rng.choice(["", "", "", ",", "."]) for _ in range(n)) for n in (3, 40, 0, 300, 1500, 1)]
    docs = documents(spark, *texts)
    got = {r[0]: [(p.phrase, p.phrase_score) for p in r.chosen] for r in kp.article_phrases(kp.tokens(docs), limit).collect()}
    want = {i: [] for i in range(len(texts))}
    best = kp.best_phrases(kp.keyphrase_candidates(kp.term_features(kp.tokens(docs))), limit)
    for r in best.orderBy("raw_noticia_id", "rank").collect():
        want[r.raw_noticia_id].append((r.phrase, r.phrase_score))
    assert got == want


def test_only_chosen_phrases_leave_the_pass(spark):
    text = plan(kp.keyphrase_hits(documents(spark, "")))
    assert "phrases#" not in text and "terms#" not in text and "levenshtein" not in text


def test_terms_and_candidates_pass_on_only_what_they_show(spark):
    assert "phrases#" not in plan(catalog.QUERIES["keyphrase_terms"](spark, SF))
    assert "terms#" not in plan(catalog.QUERIES["keyphrase_candidates"](spark, SF))


@pytest.mark.parametrize("name", ["all_hits", "canonicalize_hits", "merged_hits", "omit_filter", "prune_omitted", "monthly_keyword_stats"])
def test_texts_are_cleaned_once_for_all_extractors(spark, name):
    read = catalog.QUERIES[name](spark, SF).inputFiles()
    assert not any("documents.parquet" in file for file in read)
