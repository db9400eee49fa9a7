"""Contextual patterns against a plain version of the graph; templates on hosts of several sizes and on broken pages."""

import hashlib
import math
import time
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from pressmonth.llm import html_templates, pii

SF = "/root/testdata/sf0.001"


def plain_patterns(texts):
    """Pattern -> kind by dictionaries, one step after the other."""
    graph, seeds = defaultdict(set), set()
    for text in texts:
        spans = pii.seed_spans(text or "", pii.base_spans(text or ""))
        for start, end, token, patterns in pii.identifiers(text or ""):
            kind = next((k for s, e, k in spans if s < end and start < e), None)
            for pattern in patterns:
                graph[pattern].add(token)
                if kind:
                    seeds.add((token, kind))
    beliefs = dict.fromkeys(seeds, 1.0)
    for _ in range(pii.ROUNDS):
        support = defaultdict(float)
        for pattern, tokens in graph.items():
            for token, kind in beliefs:
                if token in tokens:
                    support[pattern, kind] += beliefs[token, kind]
        rated = {(p, k): (s, s / (len(graph[p]) + 1)) for (p, k), s in support.items()}
        doubt = defaultdict(float)
        for (pattern, kind), (amount, confidence) in rated.items():
            if amount >= pii.MIN_SUPPORT and confidence >= 0.5:
                for token in graph[pattern]:
                    doubt[token, kind] += math.log(1 - min(confidence, 0.999))
        beliefs = dict.fromkeys(seeds, 1.0) | {k: max(1 - math.exp(v), float(k in seeds)) for k, v in doubt.items()}
    best = {}
    for (pattern, kind), (amount, confidence) in sorted(rated.items(), key=lambda r: (-r[1][0], r[0][1])):
        if amount >= pii.MIN_SUPPORT and confidence >= pii.MIN_CONFIDENCE:
            best.setdefault(pattern, kind)
    return best


def plain_spans(text, patterns):
    found = pii.seed_spans(text, pii.base_spans(text))
    seeds = list(found)
    for start, end, _, own in pii.identifiers(text):
        kind = next((patterns[p] for p in own if p in patterns), None)
        if kind and not any(s < end and start < e for s, e, _ in seeds):
            found.append((start, end, kind))
    return pii.joined(sorted(found, key=lambda x: (x[0], pii.KINDS.index(x[2]), x[1])))


@pytest.fixture(scope="module")
def marked(spark):
    real = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = [(50_000 + i, f"our member address: user{i:03d}@mail{i % 9}.example and more") for i in range(40)]
    rows += [(51_000 + i, f"call from host {i + 100}.20.30.{i + 10} over port") for i in range(30)]
    rows += [(52_000, "our member address: user777#mail7.example today"), (52_001, "call from host 300.20.30.40 again")]
    rows += [(53_000 + i, "a copy of the member address: user888#mail8.example here") for i in range(60)]
    rows += [(54_000, None), (54_001, ""), (None, "no id"), (52_000, "our member address: user777#mail7.example today")]
    return [*real, *rows]


def test_patterns_and_spans_equal_a_plain_version(spark, marked):
    frame = spark.createDataFrame(marked, "doc_id bigint, text string").withColumn("found", F.lit("clash")).withColumn("digest", F.lit(1))
    learned = plain_patterns([t for _, t in marked])
    assert {r["pattern"]: r["kind"] for r in pii.learn_patterns(frame).collect()} == learned
    got = pii.find_pii(frame).collect()
    assert len(got) == len(marked) and {r["found"] for r in got} == {"clash"}
    for row in got:
        assert row["spans"] == plain_spans(row["text"] or "", learned)
        assert row["base_sha256"] == hashlib.sha256(pii.joined(pii.base_spans(row["text"] or "")).encode()).hexdigest()


def test_unseen_identifiers_are_found(spark, marked):
    got = {r["doc_id"]: r for r in pii.find_pii(spark.createDataFrame(marked, "doc_id bigint, text string")).collect()}
    assert got[52_000]["redacted"] == "our member address: [EMAIL] today" and got[52_000]["n_email"] == 0
    assert got[52_001]["redacted"] == "call from host [IP] again"
    assert {got[53_000 + i]["redacted"] for i in range(60)} == {"a copy of the member address: [EMAIL] here"}


def test_no_pattern_is_left_out(spark):
    """More confident patterns than any limit of earlier versions."""
    rows = [(n * 10 + i, f"label{n} user{i:03d}@m{n:05d}.example") for n in range(5200) for i in range(5, 14)]
    rows += [(10**6 + n, f"label{n} user{999}#m{n:05d}.example") for n in range(5200)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    patterns = pii.learn_patterns(frame.where(f"doc_id < {10**6}"))
    spans = pii.find_pii(frame.where(f"doc_id >= {10**6}"), patterns=patterns)
    assert patterns.count() >= 5200 and spans.where("spans like 'email:%'").count() == 5200


def text_of(page):
    root = html_templates.parse(page)
    html_templates.hash_subtrees(root)
    return html_templates.main_text(root, frozenset())


def test_a_story_on_several_pages_is_no_template(spark):
    story = "<div class='entry'><p>One story that six pages of the host tell.</p><p>It has two parts.</p></div>"
    page = "<body><article><h1>Headline {0}</h1>{1}</article></body>"
    rows = [(i, "http://news.example/", page.format(i, story if i < 6 else f"<div class='entry'><p>Story number {i}</p></div>")) for i in range(100)]
    table = "<table><tr><td>a</td><td>b</td></tr></table>"
    for kind, base in (("<article><h1>Title {0}</h1><p>Own text of page number {0}</p>{1}</article>", 1000), ("<h1>Title {0}</h1><p>Own text of page number {0}</p>{1}", 3000)):
        rows += [(base + i, f"http://tables{base}.example/{i}", "<body>" + kind.format(i, table if i < 6 else "") + "</body>") for i in range(1000)]
    got = {r["page_id"]: r["text"] for r in html_templates.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    for i in range(6):
        assert got[i] == f"Headline {i}\nOne story that six pages of the host tell.\nIt has two parts."
        assert got[1000 + i] == f"Title {i}\nOwn text of page number {i}\na\nb"
        assert got[3000 + i] == f"Title {i}\nOwn text of page number {i}\na\nb"
    assert got[50] == "Headline 50\nStory number 50" and len(got) == 2100


def test_counts_change_texts_and_equal_plain_counts(spark):
    page = "<body><div class='x1'><p>Site head</p></div><div><p>Own text of page {0}, long enough</p>{1}</div><div class='x2'><i>end</i> of all pages</div></body>"
    rows = [(i, "http://plain.example/", page.format(i, "<p>rare</p>" if i < 3 else "")) for i in range(450)]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    seen = defaultdict(set)
    for _, _, text in rows:
        for subtree, inside, is_text, content in html_templates.recurring(html_templates.parse(text)):
            seen[subtree, inside, is_text].add(content)
    sizes = {inside: len(c) for (subtree, inside, _), c in seen.items() if subtree is None}
    share = {(False, True): html_templates.MIN_SHARE, (False, False): html_templates.BOX_SHARE}
    plain = {(s, i) for (s, i, t), c in seen.items() if s is not None and len(c) >= max(5, min(50, sizes[i] * share[i, t]))}
    hosted = frame.withColumn("__host", html_templates.host_of(F.col("url")))
    counted = html_templates.templates(hosted, "html", html_templates.MIN_PAGES, html_templates.MIN_SHARE)
    assert {(r["__subtree"], r["__inside"]) for r in counted.collect()} == plain and plain
    got = {r["page_id"]: r["text"] for r in html_templates.extract(frame).collect()}
    assert got[1] == "Own text of page 1, long enough\nrare" and got[400] == "Own text of page 400, long enough"


@pytest.mark.parametrize("page, text", [
    ("<b " * 330_000 + "'", None), ("<div>" * 200_000 + "deep", "deep"), ("<b>" * 300_000 + "</i>" * 30_000 + "x", "x"),
    ("<p>" * 300_000 + "x", "x"), ("<li>" * 200_000 + "x", "x"), ("<a b='" * 150_000, None), ("<i><b>" * 50_000 + "<tr>" * 50_000 + "x", "x"),
])
def test_broken_pages_take_no_quadratic_time(page, text):
    start = time.perf_counter()
    found = text_of(page)
    assert time.perf_counter() - start < 20 and (text is None or found == text)
