"""What kept queries from finishing on large tables: plan shapes, and equal results of the forms that replaced them."""

import math
import random

from pressmonth.operators import keyphrases as kp
from pressmonth.operators import matching
from pressmonth.plans import catalog
from test_hits import documents
from test_keyphrases import brute_force

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_tokens_are_neither_sorted_nor_grouped(spark):
    for name in ("keyphrase_terms", "keyphrase_candidates"):
        above = plan(catalog.QUERIES[name](spark, SF)).split("MapInArrow")[0]
        assert not any(step in above for step in ("Sort", "Window", "Aggregate", "Exchange"))


def test_articles_counted_in_several_blocks(spark):
    rng = random.Random(3)
    words = ["casa", "Mar", "de", "UNSE", "17", "sol,", "río", "El", "fin."]
    texts = [" ".join(rng.choice(words) for _ in range(n)) for n in (90_000, 90_000, 0, 120_000, 7, 250_000, 5)]
    rows = kp.term_features(kp.tokens(documents(spark, *texts))).select("raw_noticia_id", "term", "term_score").collect()
    want = {(i, t): v for i, text in enumerate(texts) for t, v in brute_force(text)[0].items()}
    assert len(rows) == len(want)
    assert all(math.isclose(r.term_score, want[r.raw_noticia_id, r.term], rel_tol=1e-12) for r in rows)


def test_small_dictionaries_move_no_windows(spark):
    text = plan(catalog.QUERIES["dictionary_hits_by_join"](spark, SF))
    assert "SortMergeJoin" not in text and "hashpartitioning(gram" not in text


def test_no_function_runs_for_every_window(spark):
    joined = matching.dictionary_hits(documents(spark, ""), catalog.config(), "join")
    assert "array_join(" not in joined._jdf.queryExecution().optimizedPlan().toString()
