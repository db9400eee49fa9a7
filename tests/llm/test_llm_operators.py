"""Operators of pressmonth.llm against brute force, and their defined results for odd rows."""

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
from pressmonth.llm import bpe, fingerprints, html_templates, neardup, packing, pii, quality_pu, quality_rules, sharding, toxicity
from pressmonth.llm.arrays import mix, shingles, text_bytes, words
from pressmonth.llm.features import BUCKETS, KINDS, LinearModel, sparse_shares

SF = "/root/testdata/sf0.001"
WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = [None, "", " \n\t ", "one", "Two words", "a b c d e", "A b C d E", "x" * 5000, "é漢字 ﬁ İ ΣΑΣ 's don't <|endoftext|>\x1c\u0085z",
       "same line\nsame line\n\n" * 3, "mail a.b@c.example 4111 1111 1111 1111, 10.0.0.1 +1 (555) 555-0100 end"]
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    """Real rows, odd rows, repeated rows, a null id, and columns whose names the operators use themselves."""
    real = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    odd = spark.createDataFrame(
        [(10_000 + i, t, "en", "odd", 0) for i, t in enumerate(ODD)] + [(10_000, None, "en", "odd", 0), (None, "no id here at all", "en", "odd", 0)],
        real.schema,
    )
    frame = real.unionByName(odd)
    for clash in ("size", "shard", "slot", "ids", "quality_score", "toxicity", "evidence", "spans", "redacted", "class", "bands", "id"):
        frame = frame.withColumn(clash, F.lit("clash"))
    return frame.cache()


@pytest.fixture(scope="module")
def texts(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet").unionByName(
        spark.createDataFrame([(None, 1, 0), (3, None, None), (4, 1, 0)], "doc_id bigint, quality int, toxic int")
    )


def shingle_set(text):
    found = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if len(found) < 5:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + 5]) for i in range(len(found) - 4)}


def test_packing_covers_each_id_once(docs, texts):
    rows = packing.pack(docs, WORDS).toPandas()
    coder = Tokenizer.from_file(WORDS)
    coder.encode_special_tokens = True
    assert rows.groupby("sequence_id")["length"].sum().max() <= 2048
    ordered = rows.sort_values(["sequence_id", "offset"])
    assert ((ordered.groupby("sequence_id")["length"].cumsum() - ordered["length"]) == ordered["offset"]).all()
    expected = sorted((str(d), coder.encode(t or "", add_special_tokens=False).ids + [1]) for d, t in texts)
    got = []
    for key, own in rows.sort_values(["sequence_id", "offset"]).groupby("doc_id", dropna=False):
        name = str(None) if key != key else str(int(key))
        ids, copies = [], []
        for piece in own.itertuples():
            assert zlib.crc32(np.array(piece.ids, np.uint32).tobytes()) == piece.ids_crc32
            if piece.start == 0 and ids:
                copies.append(ids)
                ids = []
            assert piece.start == len(ids)
            ids = ids + list(piece.ids)
        got += [(name, c) for c in [*copies, ids]]
    assert sorted(got) == expected


def test_cuts_are_cheapest():
    rng = np.random.default_rng(1)
    for _ in range(20):
        places = [0, *sorted(rng.choice(np.arange(1, 120), 25, replace=False).tolist()), 120]
        costs = [0, *rng.integers(0, 9, 25).tolist(), 0]
        best = {0: 0}
        for j in range(1, len(places)):
            reach = [best[i] + 30 - places[j] + places[i] + costs[j] for i in best if places[j] - places[i] <= 30]
            if reach:
                best[j] = min(reach)
        if len(best) < len(places):
            continue
        cuts = packing.best_cuts(places, costs, 30, True)
        assert max(np.diff(cuts)) <= 30
        assert sum(30 - d for d in np.diff(cuts)) + sum(costs[places.index(c)] for c in cuts[1:]) == best[len(places) - 1]


def test_split_powers_leaves_no_token():
    assert packing.split_powers([0, 2048, 2048 + 1100], 2048) == [0, 2048, 3072, 3136, 3144, 3148]
    assert packing.split_powers([0, 2000], 2048) == [0, 2000]


def test_quality_rules_count_exactly(docs, texts, labels):
    rows = quality_rules.quality_rules(docs, labels).toPandas()
    assert len(rows) == len(texts)
    by_id = {r.doc_id: r for r in rows.itertuples() if r.doc_id == r.doc_id}
    for key, text in texts:
        if key is None:
            continue
        found = WORD.findall(text or "")
        windows = {}
        for i in range(len(found) - 7):
            windows.setdefault(tuple(found[i : i + 8]), []).append(i)
        inside = {k for at in windows.values() if len(at) > 1 for i in at for k in range(i, i + 8)}
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        row = by_id[key]
        assert (row.n_words, row.word_chars, row.n_dup_lines, row.n_repeat_words) == (
            len(found), sum(map(len, found)), len(lines) - len(set(lines)), len(inside))
        assert row.n_symbols == sum(c in "#*$%&|<>" for c in text or "")
        assert row.base_failed == (len(found) < 20 or 100 * len(inside) > 30 * len(found))
        assert not (row.base_failed and row.kept)


def test_sharding_is_a_stable_permutation(docs, texts):
    rows = sharding.shuffle_into_shards(docs, bucket_bytes=4000).select("doc_id", "text", "size", "shard", "slot", "grown_shard").toPandas()
    assert len(rows) == len(texts)
    assert sorted(rows["size"]) == sorted(len((t or "").encode()) + 8 for _, t in texts)
    for _, own in rows.groupby("shard"):
        assert sorted(own["slot"]) == list(range(len(own)))
    moved = rows[rows["shard"] != rows["grown_shard"]]
    assert (moved["grown_shard"] == 24).all()
    grown = sharding.shuffle_into_shards(docs, shards=25).select("doc_id", "shard").toPandas()
    assert dict(zip(grown["doc_id"].fillna(-1), grown["shard"])) == dict(zip(rows["doc_id"].fillna(-1), rows["grown_shard"]))
    assert sorted(sharding.fisher_yates(50, 3)) == list(range(50))


def test_templates_and_blocks(spark):
    page = ("<html><head><title>no</title></head><body><div><p>Site slogan</p></div><nav><a>menu</a></nav>{}"
            "<div class='ad'>buy</div><script>var a='<p>x</p>';</script><footer>&copy; end</footer></body>")
    body = "<p>Own  text &amp; <b>bold</b>\n{0}<p>second<br>line {0}</p>"
    rows = [(i, "http://h.example/1", page.format(body.format(i))) for i in range(8)]
    rows += [(100, "http://h.example/x", page.format("<article><p>Site slogan</p><p>art</p><section class='comments'>bad</section></article>"))]
    rows += [(101, None, None), (102, "http://other", ""), (103, "nothing", "plain < text"), (0, "http://h.example/1", rows[0][2])]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("text", F.lit(1))
    got = {r["page_id"]: r for r in html_templates.extract(pages).collect()}
    assert got[3]["text"] == "Own text & bold 3\nsecond\nline 3"
    assert got[100]["text"] == "Site slogan\nart"
    assert (got[101]["text"], got[102]["text"], got[103]["text"]) == ("", "", "plain < text")
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())
    assert html_templates.extract(pages.limit(0)).count() == 0


def test_article_parts_are_not_dropped_by_a_word_of_their_class():
    def text(page):
        root = html_templates.parse(page)
        html_templates.hash_subtrees(root)
        return html_templates.main_text(root, frozenset())

    assert text('<body class="single comments-open"><article class="post comments-open"><div class="entry-header"><h1>Head</h1></div>'
                '<section id="social-impact"><p>one</p></section><div class="side-by-side">two</div><div class="newsletter-signup">box</div>'
                '<header class="article-header">three</header><div class="ad">buy</div></article>') == "Head\none\ntwo\nthree"
    assert text('<body><div class="has-sidebar"><article><p>text</p></article></div><div class="site-footer">end</div>') == "text"
    assert text('<body class="no-comments"><div class="no-sidebar"><p>long text of a page</p></div><div class="site-footer">end</div>') == "long text of a page"


def test_template_counts_distinct_pages_at_any_host_size(spark):
    copy = "<html><body><div>{}</div><p>the only page</p><p>of this host</p><script>{}</script></body></html>"
    rows = [(i, "http://copies.example/", copy.format("same head", i)) for i in range(9)]
    page = "<html><body><section><p>latest</p></section><p>own text number {0} of the host</p></body></html>"
    rows += [(100 + i, "http://big.example/", page.format(i) if i < 6 else f"<body><p>other page {i}") for i in range(600)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_templates.extract(pages).collect()}
    assert {got[i] for i in range(9)} == {"same head\nthe only page\nof this host"}
    assert got[103] == "own text number 3 of the host"
    assert len(got) == 609


def test_boxes_inside_articles_are_template(spark):
    page = ("<body><article><h1>Title {0}</h1><p>Own text of the article number {0}.</p>{1}<div class='entry'><p>Get our letter</p></div>"
            "<p>All rights reserved</p></article></body>")
    rows = [(i, "http://h.example/", page.format(i, "<p>A shared quote.</p>" if i < 6 else "")) for i in range(20)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_templates.extract(pages).collect()}
    assert got[3] == "Title 3\nOwn text of the article number 3.\nA shared quote."
    assert got[13] == "Title 13\nOwn text of the article number 13."


def test_sketches_merge_and_estimate(spark, texts):
    rows = spark.createDataFrame([(t or "", (texts[i - 1][1] or "")) for i, (_, t) in enumerate(texts)], "a string, b string")
    a, b = fingerprints.sketch(F.col("a"), 4096), fingerprints.sketch(F.col("b"), 4096)
    got = rows.select("a", "b", fingerprints.resemblance(a, b, 4096).alias("j"), fingerprints.containment(a, b, 4096).alias("c"),
                      fingerprints.distinct_count(a, 4096).alias("n")).collect()
    case = lambda t: {tuple(s) for s in fingerprints_set(t)}
    for r in got:
        left, right = case(r["a"]), case(r["b"])
        if len(left) + len(right) > 4000:
            continue
        union = len(left | right)
        assert r["j"] == pytest.approx(len(left & right) / union if union else 1.0)
        assert r["n"] == len(left)
        assert r["c"] == pytest.approx(len(left & right) / len(left) if left else 1.0)
    parts = rows.select(F.lit(1).alias("k"), fingerprints.sketch(F.col("a"), 16).alias("sketch"))
    merged = fingerprints.merge_parts(parts, ["k"], size=16).first()["sketch"]
    assert merged == sorted({h for r in parts.collect() for h in r["sketch"]})[:16]


def fingerprints_set(text):
    found = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    if len(found) < 5:
        return [tuple(found)] if found else []
    return [tuple(found[i : i + 5]) for i in range(len(found) - 4)]


def test_following_row_wraps_around(spark):
    rows = spark.createDataFrame([(i * i, str(i)) for i in range(100)] + [(None, "null")], "doc_id bigint, text string")
    got = {r["text"]: r["next_text"] for r in fingerprints.with_following(rows, ["text"], rows_per_range=7).collect()}
    order = [str(i) for i in range(99, -1, -1)] + ["null"]
    assert got == {t: order[(i + 1) % len(order)] for i, t in enumerate(order)}
    assert fingerprints.with_following(rows.limit(0), ["text"]).count() == 0


def test_block_max_search_equals_full_scan():
    rng = np.random.default_rng(5)
    dense = np.where(rng.random((300, 40)) < 0.15, rng.random((300, 40)), 0)
    dense /= np.maximum(np.linalg.norm(dense, axis=1, keepdims=True), 1e-9)
    rows, at = np.nonzero(dense)
    index = toxicity.BlockMaxIndex.of(np.searchsorted(rows, np.arange(301)), at, dense[rows, at], 40)
    for q in dense[:60]:
        own = np.flatnonzero(q)
        _, cosine = index.nearest(own, q[own], 10)
        assert np.allclose(cosine, np.sort((dense @ q)[dense @ q > 0])[::-1][:10])


def held_out_rows(rows, labels, column):
    known = {r["doc_id"]: r[column] for r in labels.collect() if r[column] is not None}
    held = [r for r in rows if r["held_out"] and r["doc_id"] in known]
    return [r["predicted"] == known[r["doc_id"]] for r in held]


@pytest.mark.parametrize("name, column, least", [("op6_toxicity", "toxic", 0.85), ("op7_quality_classifier", "quality", 0.85)])
def test_held_out_accuracy(spark, name, column, least):
    sf = "/root/testdata/sf0.01"
    rows = entry.queries()[name](spark, sf).collect()
    right = held_out_rows(rows, spark.read.parquet(f"{sf}/labels.parquet"), column)
    assert np.mean(right) >= least and all(0 <= r["score"] <= 1 for r in rows)


def test_classifiers_without_labels(docs, labels, texts):
    none = labels.limit(0)
    assert {r[0] for r in quality_pu.score_quality(docs, none).select("quality_score").collect()} == {0.5}
    assert {r[0] for r in toxicity.score_toxicity(docs, none).select("toxicity").collect()} == {0.0}
    assert quality_rules.quality_rules(docs, none).count() == len(texts)
    assert quality_pu.score_quality(docs.limit(0), labels).count() == 0
    assert toxicity.score_toxicity(docs.limit(0), labels).count() == 0


def test_class_prior_is_near_the_truth():
    rng = np.random.default_rng(2)
    positive = rng.normal(3, 1, 2000)
    mixed = np.append(rng.normal(3, 1, 1400), rng.normal(-3, 1, 600))
    assert quality_pu.class_prior(positive, mixed) == pytest.approx(0.7, abs=0.08)


def test_unlabelled_risk_and_prior_cover_all_documents(spark):
    rng = np.random.default_rng(3)
    pools = [[f"{c}{i}" for i in range(200)] for c in "gb"]
    rows = [(i, " ".join(rng.choice(pools[int(i >= 100 and i % 4 == 0)], 30))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    weights = rng.normal(size=len(KINDS) * BUCKETS)
    known = list(range(100))
    n, loss, gradient = quality_pu.unlabelled_risk(docs, "doc_id", "text", known, weights, 0.5)
    data, offsets = text_bytes(pa.array([t for i, t in rows if i >= 100]))
    z = LinearModel(weights, 0.5).raw(data, offsets)
    by_row = sum(np.bincount(b, s * q, len(weights)) for (b, s), q in zip(sparse_shares(data, offsets), 1 / (1 + np.exp(-z))))
    assert n == 300 and loss == pytest.approx(np.logaddexp(0, z).mean(), abs=1e-5)
    assert np.allclose(gradient[:-1], by_row / 300, atol=1e-5)
    counts = quality_pu.unlabelled_counts(docs, "doc_id", "text", known, weights, 0.5, np.sort(z)[[50, 250]])
    assert counts.tolist() == [50, 200, 50]
    assert quality_pu.prior_of_counts(np.sort(z)[[50, 250]], counts) == quality_pu.class_prior(np.sort(z)[[50, 250]], z)


BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def plain_spans(text):
    found = []
    for kind, pattern in BASE.items():
        for m in pattern.finditer(text):
            digits = re.sub(r"[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            found.append((m.start(), m.end(), kind))
    return sorted(found, key=lambda s: (s[0], list(BASE).index(s[2])))


def test_base_spans_equal_the_patterns(texts):
    tricky = ["a@b@c.d.e@f.g", "@x.y", "a@b", "a@b.c.", "1.2.3.4.5.6.7.8", "999.1.1.1 1.1.1.999 01.002.3.0255", "+1", "+12 345-6789 x +(1",
              "4111-1111-1111-1111 41111111111111112222 4111  1111", "x.y@z.w" * 3, "1.2.3.4@5.6"]
    for text in [t or "" for _, t in texts] + tricky:
        assert pii.base_spans(text) == plain_spans(text)


def test_patterns_find_unseen_identifiers(spark):
    known = [(i, f"some words member address: user{i}@mail{i}.example and more") for i in range(12)]
    rows = known + [(100, "other words member address: user77 at4mail next"), (101, None), (102, ""), (103, "version 12.5.7 of it")]
    frame = spark.createDataFrame([*rows, (104, "member address: person9x now")], "doc_id bigint, text string")
    learned = pii.learn_patterns(frame)
    assert "email" in {r["kind"] for r in learned.collect()}
    got = {r["doc_id"]: r for r in pii.find_pii(frame).collect()}
    assert got[103]["spans"] == "" and got[101]["redacted"] is None and got[102]["redacted"] == ""
    assert got[3]["redacted"] == "some words member address: [EMAIL] and more"
    assert got[101]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert pii.find_pii(frame.limit(0)).count() == 0


def brute_components(texts):
    sets = {}
    for key, text in texts:
        if key is not None:
            sets.setdefault(key, []).append(shingle_set(text))
    keys, parent = sorted(sets), {k: k for k in sets}

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for n, x in enumerate(keys):
        for y in keys[n + 1 :]:
            if any(len(a & b) * 100 >= 75 * len(a | b) and a for a in sets[x] for b in sets[y]):
                a, b = sorted((find(x), find(y)))
                parent[b] = a
    return {k: find(k) for k in keys}


def test_near_duplicates_equal_brute_force(spark, docs, texts, monkeypatch):
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(120)]
    family = []
    for n in range(60):  # some linked, some just too far apart
        edited = list(base)
        for at in rng.choice(120, rng.integers(1, 9), replace=False):
            edited[at] = f"n{n}x{at}"
        family.append((20_000 + n, " ".join(edited)))
    family += [(30_000, family[0][1]), (30_001, family[0][1].upper()), (20_005, "another text of one id with six words")]
    monkeypatch.setattr(neardup, "BLOCK_ROWS", 7)
    frame = docs.unionByName(spark.createDataFrame(family, "doc_id bigint, text string"), allowMissingColumns=True)
    rows = neardup.near_duplicates(frame).collect()
    every = texts + family
    assert len(rows) == len(every)
    expected = brute_components(every)
    for r in rows:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert r["component_id"] == expected[r["doc_id"]], r
            assert r["kept"] == (r["component_id"] == r["doc_id"])
    assert neardup.near_duplicates(frame.limit(0)).count() == 0


def test_sketches_fill_and_concentrate():
    rng = np.random.default_rng(0)
    left = mix(rng.integers(0, 2**62, 400).astype(np.uint64))
    right = np.append(left[:300], mix(rng.integers(0, 2**62, 100).astype(np.uint64)))
    row = np.repeat([0, 1, 2], [400, 400, 1])
    sketch = neardup.similarity_sketches(row, np.concatenate([left, right, left[:1]]), 3, 240)
    assert (sketch != 2**64 - 1).all()
    assert (sketch[0] == sketch[1]).mean() == pytest.approx(0.6, abs=0.13)


def test_shingles_are_distinct_per_text(texts):
    data, offsets = text_bytes(pa.array([t for _, t in texts]))
    row, _ = shingles(words(data, offsets))
    plain = [fingerprints_set(t or "") for _, t in texts]
    assert np.bincount(row, minlength=len(texts)).tolist() == [len(set(p)) for p in plain]


def test_byte_bpe_equals_tiktoken(docs, texts):
    ranks = bpe.encoding(RANKS, public_tokenizers.PATTERN)
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks._mergeable_ranks, special_tokens={})
    coded = bpe.encode_texts(docs.select("doc_id", "text", "ids"), RANKS, public_tokenizers.PATTERN)
    rows = bpe.decode_ids(coded, RANKS, public_tokenizers.PATTERN).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r["ids"] == plain.encode_ordinary(r["text"] or "")
        assert bytes(r["decoded"]) == (r["text"] or "").encode()


def test_long_texts_are_cut_at_safe_places():
    coder = bpe.encoding(RANKS, public_tokenizers.PATTERN)
    rng = np.random.default_rng(4)
    for _ in range(200):
        text = "".join(rng.choice(list("ab1'!  \n\té 漢"), 300))
        cut = list(bpe.parts(text, 20))
        assert "".join(cut) == text
        assert [i for p in cut for i in coder.encode_ordinary(p)] == coder.encode_ordinary(text)


def test_pipeline_stages_keep_their_promises(spark):
    import corpus_pipeline

    source = spark.read.parquet(f"{SF}/documents.parquet")
    kept = source
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, kept, SF).cache()
        assert after.columns == source.columns
        assert after.join(kept, "doc_id", "left_anti").count() == 0
        if name == "near_duplicates":
            expected = brute_components([(r["doc_id"], r["text"]) for r in kept.collect()])
            assert {r["doc_id"] for r in after.collect()} == {k for k, v in expected.items() if k == v}
        if name == "personal_data":
            assert all(not pii.base_spans(r["text"]) for r in after.collect())
        kept = after
    pieces = corpus_pipeline.run(spark, SF)
    assert {r[0] for r in pieces.select("doc_id").distinct().collect()} == {r[0] for r in kept.select("doc_id").collect()}


def test_rows_that_share_an_id_keep_their_texts(spark):
    import corpus_pipeline

    text = ["".join(f"{w}{i} " for w in "abcdefghijkl") for i in range(4)]
    rows = [(-1, text[0]), (7, text[0]), (7, text[1]), (7, text[1]), (7, None), (8, text[2]), (9, text[2]), (None, text[3])]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()]
    assert sorted(got, key=str) == sorted([(-1, text[0]), (7, text[1]), (7, None), (8, text[2]), (None, text[3])], key=str)


def test_every_operator_is_registered_once():
    names = [q for q in entry.queries() if re.match(r"op\d+_", q)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11))
    assert "pipeline" in entry.queries()
