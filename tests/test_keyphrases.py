import math
import re
from collections import Counter, defaultdict
from statistics import mean, median, pstdev

from pyspark.sql import functions as F

from pressmonth.functions.text import fold_label
from pressmonth.operators import keyphrases as kp
from test_hits import documents

TEXTS = (
    "El Gobierno provincial anunció obras. Las obras del Gobierno provincial empiezan en mayo, dijo el ministro de Obras. "
    "El ministro de Obras confirmó 25 obras en mayo. ¡Obras! El gobierno Provincial, en mayo.",
    "Paro docente en la ciudad. El paro docente sigue; docentes en paro. UNSE y ATE en paro docente.",
    "Sola.",
    "",
)


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute_force(text, limit=12):
    """Term scores and chosen phrases of one text, by plain loops."""
    toks = []
    for s, body in enumerate(re.split(r"[.!?…]+(?:\s+|$)", text)):
        for p, w in enumerate(re.findall(r"\w+(?:['’-]\w+)*|[^\s\w]", body)):
            toks.append((s, p, w))
    words = {(s, p): w for s, p, w in toks if re.match(r"\w", w)}
    if not words:
        return {}, []
    stop = lambda t: t in kp.STOPWORDS or len(t) < 3
    number = lambda t: bool(re.fullmatch(r"[\d.,]+", t))
    uses, pairs = defaultdict(list), Counter()
    for (s, p), w in words.items():
        uses[w.lower()].append((s, p, w))
        if (s, p + 1) in words:
            pairs[w.lower(), words[s, p + 1].lower()] += 1
    tf = {t: len(u) for t, u in uses.items()}
    content = [n for t, n in tf.items() if not stop(t) and not number(t)]
    top = max([n for t, n in tf.items() if not stop(t)], default=None)
    spread = mean(content) + pstdev(content) if content else None
    sentences = max(s for s, _ in words) + 1
    score = {}
    for t, u in uses.items():
        left = [words[s, p - 1].lower() for s, p, _ in u if (s, p - 1) in words]
        right = [words[s, p + 1].lower() for s, p, _ in u if (s, p + 1) in words]
        rel = 1 + ((len(set(left)) / len(left) if left else 0) + (len(set(right)) / len(right) if right else 0)) * tf[t] / (top or tf[t])
        cased = max(sum(len(w) > 1 and w.isupper() for *_, w in u), sum(w[0].isupper() and p > 0 for _, p, w in u))
        freq, spans = tf[t] / (spread or tf[t]), len({s for s, *_ in u}) / sentences
        position = math.log(math.log(3 + median(s for s, *_ in u)))
        score[t] = rel * position / (cased / (1 + math.log(tf[t])) + freq / rel + spans / rel)
    grams = defaultdict(list)
    for s, p in sorted(words):
        run = []
        for i in range(3):
            if (s, p + i) not in words:
                break
            run.append(words[s, p + i])
            terms = [w.lower() for w in run]
            if any(map(number, terms)) or stop(terms[0]) or stop(terms[-1]):
                continue
            product, total = 1.0, 0.0
            for j, t in enumerate(terms):
                if stop(t):
                    link = 1 - pairs[terms[j - 1], t] / tf[terms[j - 1]] * pairs[t, terms[j + 1]] / tf[terms[j + 1]]
                    product, total = product * (1 + link), total - link
                else:
                    product, total = product * score[t], total + score[t]
            grams[" ".join(terms)].append((s, p, " ".join(run), product, total))
    ranked = sorted(
        (round(g[0][3] / (len(g) * (1 + g[0][4])), 6), g[0][0], g[0][1], g[0][2]) for g in grams.values()
    )
    kept = []
    for value, _, _, phrase in ranked:
        norm = fold_label(phrase)
        if len(kept) < limit and not any(
            levenshtein(norm, k[0]) * 10 < max(len(norm), len(k[0])) for k in kept
        ):
            kept.append((norm, phrase, value))
    return score, kept


def test_features_match_brute_force(spark):
    rows = kp.term_features(kp.tokens(documents(spark, *TEXTS))).select("raw_noticia_id", "term", "term_score").distinct().collect()
    got = {(r[0], r[1]): r[2] for r in rows}
    want = {(i, t): v for i, text in enumerate(TEXTS) for t, v in brute_force(text)[0].items()}
    assert got.keys() == want.keys()
    assert all(math.isclose(got[k], want[k], rel_tol=1e-12) for k in want)


def test_phrases_match_brute_force(spark):
    best = kp.best_phrases(kp.keyphrase_candidates(kp.term_features(kp.tokens(documents(spark, *TEXTS)))), 12)
    got = {}
    for r in best.orderBy("raw_noticia_id", "rank").collect():
        got.setdefault(r.raw_noticia_id, []).append((r.normalized, r.phrase, r.phrase_score))
    want = {i: brute_force(t)[1] for i, t in enumerate(TEXTS)}
    assert got == {i: k for i, k in want.items() if k}


def test_hits_count_whole_text_and_invert_score(spark):
    rows = kp.keyphrase_hits(documents(spark, *TEXTS)).filter(F.col("raw_noticia_id") == 1).collect()
    paro = next(r for r in rows if r.normalized_keyword == "paro docente")
    assert paro.occurrences == 3 and 0 < paro.score < 1 and paro.extractor_source == "yake"
    assert len(rows) <= 12 and all(len(r.normalized_keyword) >= 4 for r in rows)


def test_no_data_moves_after_the_texts_are_placed(spark):
    plan = kp.keyphrase_hits(documents(spark, *TEXTS))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2  # the texts for the tokens, and the texts to count in
