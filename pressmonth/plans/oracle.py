"""SQL counterparts of the registered queries, written for DuckDB over the same tables."""

from __future__ import annotations

import re

from ..functions.dates import MONTH_NAMES
from ..operators import clusters, map2d, neighbours, quality
from ..operators.keyphrases import STOPWORDS
from .catalog import ADDRESSES, ASKED_EVERY, CLUSTERS, MONTH, PAGE, REQUESTS, SOURCE_KEY, TOPIC, config

CONFIG = config()
NOW = "TIMESTAMP '2024-01-04 00:00:00'"
SPACES = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def q(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).upper()
    return str(value) if isinstance(value, (int, float)) else "'" + str(value).replace("'", "''") + "'"


def rows(*records: tuple) -> str:
    return "VALUES " + ", ".join("(" + ", ".join(map(q, r)) + ")" for r in records)


def clean(column: str) -> str:
    return f"trim(regexp_replace(coalesce({column}, ''), '{SPACES}', ' ', 'g'))"


def normalize(column: str) -> str:
    folded = f"replace(strip_accents(lower(coalesce({column}, ''))), 'ß', 'ss')"
    return rf"trim(regexp_replace(regexp_replace({folded}, '[^\p{{L}}\p{{N}}_\s-]', ' ', 'g'), '\s+', ' ', 'g'))"


def marked(column: str) -> str:
    """Text with every word in angle brackets, so that a literal search respects word boundaries."""
    return rf"regexp_replace({column}, '([\p{{L}}\p{{N}}_]+)', '<\1>', 'g')"


def counted(marked_document: str, marked_alias: str) -> str:
    """Non-overlapping occurrences of a marked alias in a marked text."""
    rest = f"length(replace({marked_document}, {marked_alias}, ''))"
    return f"((length({marked_document}) - {rest}) // length({marked_alias}))"


def average(score: str) -> str:
    """Exact average of six-digit decimals, rounded half up: in millionths, as integers."""
    total = f"sum(CAST(round({score} * 1000000) AS BIGINT))"
    return f"CAST((2 * {total} + count({score})) // (2 * count({score})) AS BIGINT) / 1000000"


ENTRIES = rows(*[
    (e["position"], e["canonical"], e["normalized"], e["keyword_type"], e["category"], e["priority"], e["enabled"])
    for e in CONFIG.entries
])
ALIASES = rows(*[
    (e["position"], i, a) for e in CONFIG.entries for i, a in enumerate(e["normalized_aliases"])
])
ALIAS_MAP = rows(*[
    (a, e["canonical"], e["normalized"], e["keyword_type"]) for a, e in CONFIG.alias_map().items()
])
RUN = r"(?:^|[^\p{L}\p{N}_])(\p{Lu}[\p{L}\p{N}]*(?: \p{Lu}[\p{L}\p{N}]*)*)"
WORDS = r"[\p{L}\p{N}_]+(?:[''’-][\p{L}\p{N}_]+)*|[^\s\p{L}\p{N}_]"

CTES: dict[str, str] = {
    "news": """
        SELECT d.doc_id AS id, md5(CAST(d.doc_id AS VARCHAR)) AS noticia_hash, d.source AS fuente,
               'https://' || d.source || '.example/' || d.doc_id AS url_original,
               split_part(d.text, chr(10), 1) AS titulo, d.text AS texto_completo,
               o.o_orderdate AS fecha_publicacion, e.ts AS fecha_extraccion, v.embedding,
               e.ts + INTERVAL 6 HOUR AS synced_at
        FROM documents d LEFT JOIN orders o ON o.o_orderkey = d.doc_id
        LEFT JOIN events e ON e.event_id = d.doc_id LEFT JOIN embeddings v ON v.vec_id = d.doc_id""",
    "dated": """
        SELECT id, fuente, fecha_publicacion, CAST(date_trunc('month', fecha_publicacion) AS DATE) AS month_start
        FROM news WHERE fecha_publicacion IS NOT NULL""",
    "cleaned": f"""
        SELECT id AS raw_noticia_id, noticia_hash, fuente AS source_media, fecha_extraccion,
               CAST(date_trunc('month', fecha_publicacion) AS DATE) AS month_start,
               trim({clean("titulo")} || '. ' || {clean("texto_completo")}) AS document
        FROM news WHERE fecha_publicacion IS NOT NULL""",
    "normal": f"SELECT *, {normalize('document')} AS normalized_document FROM cleaned",
    "docs": f"SELECT *, {marked('normalized_document')} AS marked_document FROM normal",
    "entries": f"SELECT * FROM ({ENTRIES}) t(position, canonical, normalized, keyword_type, category, priority, enabled)",
    "aliases": f"SELECT * FROM ({ALIASES}) t(position, alias_position, normalized_alias)",
    "alias_map": f"SELECT * FROM ({ALIAS_MAP}) t(alias, to_canonical, to_normalized, to_type)",
    "omitted": f"SELECT * FROM ({rows(*[(o,) for o in sorted(CONFIG.omitted)])}) t(normalized_keyword)",
    "names": f"SELECT DISTINCT normalized_alias, {marked('normalized_alias')} AS marked_alias FROM aliases",
    "name_counts": f"""
        SELECT raw_noticia_id, normalized_alias, {counted('marked_document', 'marked_alias')} AS n
        FROM docs, names""",
    "dict_counts": """
        SELECT c.raw_noticia_id, a.position, sum(c.n) AS n
        FROM name_counts c JOIN aliases a USING (normalized_alias) JOIN entries e ON e.position = a.position
        WHERE e.enabled AND c.n > 0 GROUP BY ALL""",
    "dict_hits": """
        SELECT d.raw_noticia_id, d.noticia_hash, d.month_start, d.source_media,
               e.canonical AS keyword, e.normalized AS normalized_keyword, e.canonical AS canonical_keyword,
               e.normalized AS normalized_canonical_keyword, e.keyword_type, 'dictionary' AS extractor_source,
               CAST(1 + e.priority / 100.0 AS DOUBLE) AS score, CAST(c.n AS INT) AS occurrences, e.position AS hit_order
        FROM dict_counts c JOIN entries e USING (position) JOIN docs d USING (raw_noticia_id)""",
    "found_runs": f"""
        SELECT raw_noticia_id, noticia_hash, month_start, source_media,
               unnest(regexp_extract_all(document, '{RUN}', 1)) AS mention,
               generate_subscripts(regexp_extract_all(document, '{RUN}', 1), 1) - 1 AS place
        FROM docs""",
    "runs": f"SELECT *, {normalize('mention')} AS normalized FROM found_runs",
    "entity_hits": """
        SELECT raw_noticia_id, noticia_hash, month_start, source_media, arg_min(mention, place) AS keyword,
               normalized AS normalized_keyword, CAST(NULL AS VARCHAR) AS canonical_keyword,
               CAST(NULL AS VARCHAR) AS normalized_canonical_keyword, 'misc' AS keyword_type,
               'spacy' AS extractor_source, CAST(1.0 AS DOUBLE) AS score, CAST(count(*) AS INT) AS occurrences,
               min(place) AS hit_order
        FROM runs WHERE length(normalized) >= 3
        GROUP BY raw_noticia_id, noticia_hash, month_start, source_media, normalized""",
    "all_hits": "SELECT * FROM dict_hits UNION ALL SELECT * FROM entity_hits UNION ALL SELECT * FROM phrase_hits",
    "canonical": """
        SELECT h.raw_noticia_id, h.noticia_hash, h.month_start, h.source_media,
               coalesce(m.to_canonical, h.keyword) AS keyword,
               coalesce(m.to_normalized, h.normalized_keyword) AS normalized_keyword,
               coalesce(m.to_canonical, h.canonical_keyword) AS canonical_keyword,
               coalesce(m.to_normalized, h.normalized_canonical_keyword) AS normalized_canonical_keyword,
               coalesce(m.to_type, h.keyword_type) AS keyword_type, h.extractor_source, h.score, h.occurrences, h.hit_order
        FROM {source} h LEFT JOIN alias_map m
          ON m.alias = h.normalized_keyword AND h.extractor_source <> 'dictionary'""",
    "merge": """
        SELECT raw_noticia_id, noticia_hash, month_start, source_media, normalized_keyword, extractor_source,
               arg_min(keyword, hit_order) AS keyword,
               arg_min(canonical_keyword, hit_order) FILTER (coalesce(canonical_keyword, '') <> '') AS canonical_keyword,
               arg_min(normalized_canonical_keyword, hit_order)
                 FILTER (coalesce(normalized_canonical_keyword, '') <> '') AS normalized_canonical_keyword,
               arg_min(keyword_type, hit_order) FILTER (coalesce(keyword_type, '') <> '') AS keyword_type,
               max(score) AS score, CAST(sum(occurrences) AS INT) AS occurrences
        FROM {source}
        GROUP BY raw_noticia_id, noticia_hash, month_start, source_media, normalized_keyword, extractor_source""",
    "hits": "SELECT * FROM merged WHERE normalized_keyword NOT IN (SELECT normalized_keyword FROM omitted)",
    "skeys": f"""
        SELECT month_start, source_media, coalesce(max(canonical_keyword), min(keyword)) AS keyword,
               normalized_keyword, max(canonical_keyword) AS canonical_keyword,
               max(normalized_canonical_keyword) AS normalized_canonical_keyword, max(keyword_type) AS keyword_type,
               CAST(count(DISTINCT raw_noticia_id) AS INT) AS news_count,
               CAST(sum(occurrences) AS INT) AS total_occurrences, {average('score')} AS avg_score
        FROM hits GROUP BY month_start, source_media, normalized_keyword""",
    "kmedia": """
        SELECT month_start, normalized_keyword, source_media,
               CAST(count(DISTINCT raw_noticia_id) AS INT) AS media_news_count
        FROM hits GROUP BY ALL""",
    "kstats": f"""
        SELECT b.*, CAST(m.n AS INT) AS source_media_count FROM (
          SELECT h.month_start, min(h.keyword) AS keyword, h.normalized_keyword,
                 max(h.canonical_keyword) AS canonical_keyword,
                 max(h.normalized_canonical_keyword) AS normalized_canonical_keyword,
                 max(h.keyword_type) AS keyword_type,
                 array_to_string(list_sort(list(DISTINCT h.extractor_source)), ',') AS extractors,
                 CAST(count(DISTINCT h.raw_noticia_id) AS INT) AS news_count,
                 CAST(sum(h.occurrences) AS INT) AS total_occurrences, {average('h.score')} AS avg_score,
                 CAST(coalesce(max(e.priority), 0) AS INT) AS priority
          FROM hits h LEFT JOIN entries e ON e.normalized = coalesce(h.normalized_canonical_keyword, h.normalized_keyword)
          GROUP BY h.month_start, h.normalized_keyword) b
        JOIN (SELECT month_start, normalized_keyword, count(*) AS n FROM kmedia GROUP BY ALL) m
          USING (month_start, normalized_keyword)""",
    "sstats": """
        SELECT n.month_start, n.source_media, CAST(n.news_count AS INT) AS news_count,
               CAST(coalesce(k.keyword_rows, 0) AS INT) AS keyword_rows,
               CAST(coalesce(k.distinct_keywords, 0) AS INT) AS distinct_keywords
        FROM (SELECT month_start, fuente AS source_media, count(id) AS news_count FROM dated GROUP BY ALL) n
        LEFT JOIN (SELECT month_start, source_media, sum(news_count) AS keyword_rows,
                          count(DISTINCT normalized_keyword) AS distinct_keywords FROM skeys GROUP BY ALL) k
          USING (month_start, source_media)""",
    "source_top": """
        SELECT month_start, source_media, keyword, normalized_keyword, news_count, total_occurrences, CAST(rn AS INT) AS rn
        FROM (SELECT *, row_number() OVER (PARTITION BY month_start, source_media
                ORDER BY news_count DESC, total_occurrences DESC, keyword, normalized_keyword) AS rn FROM skeys)
        WHERE rn <= 10""",
    "ktop": """
        SELECT month_start, coalesce(canonical_keyword, keyword) AS keyword, normalized_keyword, keyword_type AS type,
               news_count, total_occurrences, priority, CAST(rn AS INT) AS rn
        FROM (SELECT *, row_number() OVER (PARTITION BY month_start
                ORDER BY priority DESC, news_count DESC, total_occurrences DESC, keyword, normalized_keyword) AS rn
              FROM kstats) WHERE rn <= 20""",
    "daily": """
        SELECT month_start, CAST(fecha_publicacion AS DATE) AS activity_date, CAST(count(*) AS INT) AS news_count
        FROM dated GROUP BY ALL""",
    "named": """
        SELECT source AS source_name, 'Fuente ' || row_number() OVER (ORDER BY source) AS alias
        FROM (SELECT DISTINCT source FROM documents)""",
    "recent": f"""
        SELECT month_start, CAST(year(month_start) AS INT) AS year, CAST(month(month_start) AS INT) AS month,
               count(*) AS rows_detected
        FROM (SELECT CAST(date_trunc('month', fecha_publicacion) AS DATE) AS month_start FROM news
              WHERE fecha_publicacion IS NOT NULL AND synced_at >= {NOW} - INTERVAL 48 HOUR) GROUP BY ALL""",
    "everything": """
        SELECT month_start, CAST(year(month_start) AS INT) AS year, CAST(month(month_start) AS INT) AS month,
               count(*) AS rows_detected FROM dated GROUP BY ALL""",
    "state": f"""
        SELECT 'run-0' AS processing_run_id, year, month, month_start,
               list_extract(['pending', 'completed', 'consumed', 'processing', 'failed'], month % 5 + 1) AS status,
               'recent_sync' AS reason, rows_detected, {NOW} - INTERVAL 24 HOUR AS updated_at FROM everything""",
    "upserted": f"""
        SELECT 'run-1' AS processing_run_id, year, month, month_start, 'pending' AS status, 'recent_sync' AS reason,
               rows_detected, {NOW} AS updated_at FROM recent
        UNION ALL SELECT processing_run_id, year, month, month_start, status, reason, rows_detected, updated_at
        FROM state WHERE month_start NOT IN (SELECT month_start FROM recent)""",
    "markers": """
        SELECT doc_id AS raw_noticia_id, CASE WHEN quality = 1 THEN 'completed' ELSE 'failed' END AS status,
               0 AS keyword_rows FROM labels""",
    "topic": f"""
        SELECT h.month_start, h.raw_noticia_id, h.source_media, h.occurrences, n.fecha_publicacion
        FROM hits h JOIN news n ON n.id = h.raw_noticia_id
        WHERE h.normalized_keyword = {q(TOPIC)} OR h.normalized_canonical_keyword = {q(TOPIC)}""",
    "tsources": f"""
        SELECT s.month_start, CAST(s.rn AS INT) AS rn, s.source_media, coalesce(a.alias, s.source_media) AS alias,
               'fuente-' || coalesce(nullif(regexp_extract(coalesce(a.alias, s.source_media), '^Fuente ([0-9]+)$', 1), ''),
                                     CAST(s.rn AS VARCHAR)) AS key,
               s.news_count, s.total_occurrences
        FROM (SELECT *, row_number() OVER (PARTITION BY month_start ORDER BY news_count DESC, total_occurrences DESC,
                source_media, normalized_keyword) AS rn
              FROM skeys WHERE normalized_keyword = {q(TOPIC)} OR normalized_canonical_keyword = {q(TOPIC)}) s
        LEFT JOIN named a ON a.source_name = s.source_media WHERE rn <= 8""",
    "changes": """
        SELECT month_start, normalized_keyword, CAST(sum(n) AS INT) AS news_count, CAST(sum(p) AS INT) AS previous_count,
               CAST(sum(n) - sum(p) AS INT) AS change
        FROM (SELECT month_start, normalized_keyword, news_count AS n, 0 AS p FROM kstats
              UNION ALL SELECT CAST(month_start + INTERVAL 1 MONTH AS DATE), normalized_keyword, 0, news_count FROM kstats)
        WHERE month_start <= (SELECT max(month_start) FROM kstats) GROUP BY month_start, normalized_keyword""",
    "tdaily": """
        SELECT month_start, CAST(fecha_publicacion AS DATE) AS activity_date,
               CAST(count(DISTINCT raw_noticia_id) AS INT) AS news_count FROM topic GROUP BY ALL""",
    # --- keyphrases: the same published features, written as joins and groupings
    "bodies": r"""
        SELECT raw_noticia_id, unnest(s) AS body, generate_subscripts(s, 1) - 1 AS sentence
        FROM (SELECT raw_noticia_id, regexp_split_to_array(document, '[.!?…]+(?:\s+|$)') AS s FROM docs)""",
    "pieces": f"""
        SELECT raw_noticia_id, sentence, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS place
        FROM (SELECT raw_noticia_id, sentence, regexp_extract_all(body, '{WORDS}') AS w FROM bodies)""",
    "toks": rf"""
        SELECT raw_noticia_id, sentence, place, word, lower(word) AS term,
               lower(CASE WHEN prev_place = place - 1 AND regexp_matches(prev_word, '^[\p{{L}}\p{{N}}_]') THEN prev_word END) AS before,
               lower(CASE WHEN next_place = place + 1 AND regexp_matches(next_word, '^[\p{{L}}\p{{N}}_]') THEN next_word END) AS after,
               CAST(length(word) > 1 AND regexp_matches(word, '^\p{{Lu}}+$') AS INT) AS acronym,
               CAST(regexp_matches(word, '^\p{{Lu}}') AND place > 0 AS INT) AS proper,
               regexp_matches(word, '^[\p{{N}}.,]+$') AS number,
               (lower(word) IN ({", ".join(map(q, STOPWORDS))}) OR length(word) < 3) AS stop
        FROM (SELECT *, lag(word) OVER w AS prev_word, lag(place) OVER w AS prev_place,
                     lead(word) OVER w AS next_word, lead(place) OVER w AS next_place
              FROM pieces WINDOW w AS (PARTITION BY raw_noticia_id, sentence ORDER BY place))
        WHERE regexp_matches(word, '^[\p{{L}}\p{{N}}_]')""",
    "terms": """
        SELECT raw_noticia_id, term, count(*) AS tf, greatest(sum(acronym), sum(proper)) AS tf_cased,
               count(DISTINCT before) AS left_terms, count(before) AS left_words,
               count(DISTINCT after) AS right_terms, count(after) AS right_words,
               count(DISTINCT sentence) AS sentences, median(sentence) AS median_sentence,
               bool_or(stop) AS stop, bool_or(number) AS number
        FROM toks GROUP BY ALL""",
    "articles": """
        SELECT t.raw_noticia_id, max(tf) FILTER (NOT stop) AS max_tf, avg(tf) FILTER (NOT stop AND NOT number) AS mean_tf,
               stddev_pop(tf) FILTER (NOT stop AND NOT number) AS sd_tf, any_value(s.n) AS all_sentences
        FROM terms t JOIN (SELECT raw_noticia_id, max(sentence) + 1 AS n FROM toks GROUP BY ALL) s USING (raw_noticia_id)
        GROUP BY ALL""",
    "rates": """
        SELECT t.*, 1 + (CASE WHEN left_words > 0 THEN left_terms / left_words ELSE 0 END
                         + CASE WHEN right_words > 0 THEN right_terms / right_words ELSE 0 END)
                        * tf / coalesce(max_tf, tf) AS t_rel,
               ln(ln(3.0 + median_sentence)) AS t_pos, tf_cased / (1 + ln(tf)) AS t_case,
               tf / coalesce(mean_tf + sd_tf, tf) AS t_freq, sentences / all_sentences AS t_sent
        FROM terms t JOIN articles USING (raw_noticia_id)""",
    "scored": "SELECT *, t_rel * t_pos / (t_case + t_freq / t_rel + t_sent / t_rel) AS s FROM rates",
    # one text key per join, so that the planner sees no shortcut through the article number alone
    "pairs": """
        SELECT raw_noticia_id || ' ' || term || ' ' || after AS k, count(*) AS n
        FROM toks WHERE after IS NOT NULL GROUP BY ALL""",
    "keyed": "SELECT raw_noticia_id || ' ' || term AS k, s, tf, stop, number FROM scored",
    "follow": """
        SELECT raw_noticia_id, sentence, place, word AS w1, term AS t1,
               CASE WHEN lead(place) OVER w = place + 1 THEN lead(word) OVER w END AS w2,
               CASE WHEN lead(place) OVER w = place + 1 THEN lead(term) OVER w END AS t2,
               CASE WHEN lead(place, 2) OVER w = place + 2 THEN lead(word, 2) OVER w END AS w3,
               CASE WHEN lead(place, 2) OVER w = place + 2 THEN lead(term, 2) OVER w END AS t3
        FROM toks WINDOW w AS (PARTITION BY raw_noticia_id, sentence ORDER BY place)""",
    "grams": """
        SELECT *, raw_noticia_id || ' ' || t1 AS k1, raw_noticia_id || ' ' || t2 AS k2, raw_noticia_id || ' ' || t3 AS k3,
               raw_noticia_id || ' ' || t1 || ' ' || t2 AS p1, raw_noticia_id || ' ' || t2 || ' ' || t3 AS p2 FROM follow""",
    "phrases": """
        SELECT g.raw_noticia_id, g.sentence, g.place, w1 AS phrase, t1 AS phrase_key, x.s AS product, x.s AS total
        FROM grams g JOIN keyed x ON x.k = g.k1 WHERE NOT x.stop AND NOT x.number
        UNION ALL
        SELECT g.raw_noticia_id, g.sentence, g.place, w1 || ' ' || w2, t1 || ' ' || t2, x.s * y.s, x.s + y.s
        FROM grams g JOIN keyed x ON x.k = g.k1 JOIN keyed y ON y.k = g.k2
        WHERE NOT x.stop AND NOT x.number AND NOT y.stop AND NOT y.number
        UNION ALL
        SELECT g.raw_noticia_id, g.sentence, g.place, w1 || ' ' || w2 || ' ' || w3, t1 || ' ' || t2 || ' ' || t3,
               x.s * (CASE WHEN y.stop THEN 1 + (1 - (p.n / x.tf) * (r.n / z.tf)) ELSE y.s END) * z.s,
               x.s + (CASE WHEN y.stop THEN -(1 - (p.n / x.tf) * (r.n / z.tf)) ELSE y.s END) + z.s
        FROM grams g JOIN keyed x ON x.k = g.k1 JOIN keyed y ON y.k = g.k2 JOIN keyed z ON z.k = g.k3
        JOIN pairs p ON p.k = g.p1 JOIN pairs r ON r.k = g.p2
        WHERE NOT x.stop AND NOT x.number AND NOT y.number AND NOT z.stop AND NOT z.number""",
    "candidates": """
        SELECT raw_noticia_id, phrase_key, arg_min(phrase, sentence * 1000000 + place) AS phrase,
               round(max(product) / (count(*) * (1 + max(total))), 6) AS phrase_score,
               min(sentence * 1000000 + place) AS spot, count(*) AS tf
        FROM phrases GROUP BY raw_noticia_id, phrase_key""",
    "ordered": f"""
        SELECT raw_noticia_id, phrase, phrase_score, {normalize('phrase')} AS norm,
               row_number() OVER (PARTITION BY raw_noticia_id ORDER BY phrase_score, spot, phrase) AS k
        FROM candidates""",
    # the greedy choice, one candidate per article and round
    "picks(raw_noticia_id, k, kept, taken)": """
        SELECT raw_noticia_id, 1, [norm], true FROM ordered WHERE k = 1
        UNION ALL
        SELECT p.raw_noticia_id, o.k, CASE WHEN ok THEN list_append(p.kept, o.norm) ELSE p.kept END, ok
        FROM picks p JOIN ordered o ON o.raw_noticia_id = p.raw_noticia_id AND o.k = p.k + 1,
        LATERAL (SELECT len(list_filter(p.kept, lambda x: levenshtein(x, o.norm) * 10
                   < greatest(length(x), length(o.norm)))) = 0 AS ok) t
        WHERE len(p.kept) < 12""",
    "best": """
        SELECT o.raw_noticia_id, o.phrase, o.phrase_score, o.norm,
               row_number() OVER (PARTITION BY o.raw_noticia_id ORDER BY o.k) - 1 AS rank
        FROM picks p JOIN ordered o USING (raw_noticia_id, k) WHERE p.taken""",
    "phrase_hits": f"""
        SELECT d.raw_noticia_id, d.noticia_hash, d.month_start, d.source_media, {clean('b.phrase')} AS keyword,
               b.norm AS normalized_keyword, CAST(NULL AS VARCHAR) AS canonical_keyword,
               CAST(NULL AS VARCHAR) AS normalized_canonical_keyword, 'keyphrase' AS keyword_type,
               'yake' AS extractor_source, 1 / (1 + b.phrase_score) AS score,
               CAST(greatest(1, {counted('d.marked_document', marked('b.norm'))}) AS INT) AS occurrences, b.rank AS hit_order
        FROM (SELECT raw_noticia_id, norm, arg_min(phrase, rank) AS phrase, arg_min(phrase_score, rank) AS phrase_score,
                     min(rank) AS rank FROM best WHERE length(norm) >= 4 GROUP BY raw_noticia_id, norm) b
        JOIN docs d USING (raw_noticia_id)""",
}
CTES["canon"] = CTES.pop("canonical").format(source="all_hits")
CTES["merged"] = CTES.pop("merge").format(source="canon")
# read by several branches of a query, so kept rather than computed in each
MATERIALIZED = {"docs", "toks", "scored", "candidates", "ordered", "best", "hits", "hits_t"}
# the same hits over the titles alone: every step of the chain once more under another name
CHAIN = (
    "cleaned", "normal", "docs", "name_counts", "dict_counts", "dict_hits", "found_runs", "runs", "entity_hits", "bodies",
    "pieces", "toks", "terms", "articles", "rates", "scored", "pairs", "keyed", "follow", "grams", "phrases", "candidates",
    "ordered", "picks", "best", "phrase_hits", "all_hits", "canon", "merged", "hits",
)


def _name(cte: str) -> str:
    return cte.split("(")[0]


def _over_titles(text: str) -> str:
    return re.sub(rf"\b(FROM|JOIN)(\s+)({'|'.join(CHAIN)})\b", r"\1\2\3_t", text)


for _cte in [c for c in CTES if _name(c) in CHAIN]:
    CTES[re.sub(r"^\w+", r"\g<0>_t", _cte)] = _over_titles(CTES[_cte])
CTES["cleaned_t"] = CTES["cleaned"].replace(clean("texto_completo"), "''")


def sql(select: str) -> str:
    """The query with the definitions it needs, in dependency order."""
    ordered: list[str] = []
    by_name = {_name(c): c for c in CTES}

    def need(text: str, own: str = "") -> None:
        for name in re.findall(r"(?:FROM|JOIN|,)\s+([a-z_0-9]+)", text):
            cte = by_name.get(name)
            if cte and name != own and cte not in ordered:
                need(CTES[cte], name)
                ordered.append(cte)

    need(select)
    if not ordered:
        return select
    recursive = "RECURSIVE " if any("(" in c for c in ordered) else ""
    return f"WITH {recursive}" + ",\n".join(
        f"{c} AS {'MATERIALIZED ' if c in MATERIALIZED else ''}({CTES[c]})" for c in ordered
    ) + f"\n{select}"


HIT = (
    "raw_noticia_id, keyword, normalized_keyword, canonical_keyword, normalized_canonical_keyword, keyword_type, "
    "extractor_source, round(score, 6) AS score, occurrences"
)
IN_MONTH = f"fecha_publicacion >= DATE '{MONTH}' AND fecha_publicacion < DATE '{MONTH}' + INTERVAL 1 MONTH"
RECENT = f"fecha_extraccion >= {NOW} - INTERVAL 48 HOUR"


def _topic_news(order: str, source: str = "topic") -> str:
    return f"""
        SELECT month_start, id, fecha_publicacion, total_occurrences, CAST(rn AS INT) AS rn FROM (
          SELECT *, row_number() OVER (PARTITION BY month_start ORDER BY {order}) AS rn FROM (
            SELECT month_start, raw_noticia_id AS id, fecha_publicacion, CAST(sum(occurrences) AS INT) AS total_occurrences
            FROM {source} GROUP BY month_start, raw_noticia_id, fecha_publicacion)) WHERE rn <= 30"""


REPRESENTATIVE = "total_occurrences DESC, fecha_publicacion DESC NULLS LAST, id DESC"


def _sources(strict: bool) -> str:
    alias, extra = ("a.alias", " AND a.source_name < 'src15'") if strict else ("coalesce(a.alias, s.source_media)", "")
    return f"""
        SELECT s.month_start, CAST(s.rn AS INT) AS rn, {alias} AS alias, s.news_count, s.distinct_keywords
        FROM (SELECT *, row_number() OVER (PARTITION BY month_start ORDER BY news_count DESC, source_media) AS rn FROM sstats) s
        LEFT JOIN named a ON a.source_name = s.source_media{extra} WHERE s.rn <= 8"""


def _normalized_query(column: str) -> str:
    return rf"trim(regexp_replace(strip_accents(lower({column})), '[^\p{{L}}\p{{N}}-]+', ' ', 'g'))"


def _detected(column: str) -> str:
    return f"""
        SELECT month_start, CAST(year(month_start) AS INT) AS year, CAST(month(month_start) AS INT) AS month,
               count(*) AS rows_detected
        FROM (SELECT CAST(date_trunc('month', fecha_publicacion) AS DATE) AS month_start FROM news
              WHERE fecha_publicacion IS NOT NULL AND {column} >= {NOW} - INTERVAL 48 HOUR) GROUP BY ALL"""


_URLS = ", ".join(
    f"({i}, {v})" for i, v in enumerate((
        "url", "upper(url)", "regexp_replace(url, '^https?', 'ftp')", r"regexp_replace(url, '(?s)^(https?:).*', '\1//')",
        "regexp_replace(url, '^https?://', '')", "regexp_replace(url, '^https?://', 'javascript:')", "''",
        *[f"{q(a)} || page_id" for a in ADDRESSES],
    ))
)
# The variants that are addresses a browser opens.
OPENED = (0, 1, 8, 10, 12, 14, 16, 18, 20, 22, 24, 27, 28, 31, 35, 36)
_DOMAIN_SOURCES = {
    "affected_periods": "(SELECT status, month FROM state UNION ALL SELECT event_type, CAST(month(ts) AS INT) FROM events)",
    "processing_runs": "(SELECT lower(o_orderstatus) AS status, 'full' AS run_type FROM orders)",
    "news_keywords": "(SELECT lang AS extractor_source FROM documents)",
}
_DOMAINS = " UNION ALL ".join(
    f"SELECT {q(t)} AS table_name, {q(c)} AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS rows "
    f"FROM {_DOMAIN_SOURCES[t]} WHERE {c} NOT IN ({', '.join(map(q, allowed))}) GROUP BY {c}"
    for t, c, allowed in quality.DOMAINS if t in _DOMAIN_SOURCES
)

_SELECTS: dict[str, str] = {
    "scan_valid_news": "SELECT id, noticia_hash, fuente, url_original, titulo FROM news WHERE titulo IS NOT NULL",
    "news_page": f"""SELECT id, noticia_hash, fecha_extraccion FROM news WHERE titulo IS NOT NULL
        ORDER BY fecha_extraccion, id LIMIT {PAGE[0]} OFFSET {PAGE[1]}""",
    "news_page_after": f"""SELECT id, fecha_extraccion FROM news
        WHERE titulo IS NOT NULL AND (fecha_extraccion, id) > ({NOW} - INTERVAL 60 HOUR, 0)
        ORDER BY fecha_extraccion, id LIMIT {PAGE[0]}""",
    "incremental_news": f"""SELECT id, noticia_hash, fecha_extraccion FROM news
        WHERE titulo IS NOT NULL AND {RECENT} AND embedding IS NOT NULL""",
    "dictionary_aliases": """
        SELECT CAST(e.position AS INT) AS position, CAST(a.alias_position AS INT) AS alias_position, e.canonical,
               e.normalized, e.keyword_type, e.category, CAST(e.priority AS INT) AS priority, e.enabled,
               a.normalized_alias, (SELECT count(*) FROM name_counts c WHERE c.normalized_alias = a.normalized_alias AND c.n > 0) AS articles
        FROM entries e JOIN aliases a USING (position)""",
    "news_upsert": f"""
        SELECT id, id AS upstream_id, noticia_hash, fuente, 'Act: ' || titulo AS titulo, fecha_extraccion, {NOW} AS synced_at
        FROM news WHERE {RECENT}
        UNION ALL SELECT id, id, noticia_hash, fuente, titulo, fecha_extraccion, synced_at FROM news
        WHERE fecha_extraccion < {NOW} - INTERVAL 40 HOUR AND NOT ({RECENT})""",
    "affected_periods_upsert": "SELECT * FROM upserted",
    "keyword_hits_upsert": f"""
        SELECT {HIT} FROM hits WHERE raw_noticia_id IN (SELECT id FROM news WHERE {RECENT})
        UNION ALL SELECT {HIT} FROM hits_t o
        WHERE NOT EXISTS (SELECT 1 FROM hits n WHERE n.raw_noticia_id = o.raw_noticia_id
          AND n.normalized_keyword = o.normalized_keyword AND n.extractor_source = o.extractor_source
          AND n.raw_noticia_id IN (SELECT id FROM news WHERE {RECENT}))""",
    "processed_markers": f"""
        SELECT n.id AS raw_noticia_id, 'completed' AS status, CAST(count(h.raw_noticia_id) AS INT) AS keyword_rows
        FROM news n LEFT JOIN hits h ON h.raw_noticia_id = n.id WHERE {RECENT} GROUP BY n.id
        UNION ALL SELECT raw_noticia_id, status, keyword_rows FROM markers
        WHERE raw_noticia_id NOT IN (SELECT id FROM news WHERE {RECENT})""",
    "dictionary_sync": f"""
        SELECT s_name AS canonical_keyword, {normalize('s_name')} AS normalized_keyword, 'organization' AS keyword_type,
               CAST(NULL AS VARCHAR) AS category, CASE WHEN s_acctbal > 3000 THEN s_nationkey ELSE 0 END AS priority,
               s_acctbal > 3000 OR s_nationkey >= 12 AS enabled,
               CASE WHEN s_nationkey = 3 OR s_nationkey < 12 THEN 'config' ELSE 'manual' END AS source
        FROM supplier WHERE s_nationkey <> 3 OR s_acctbal > 3000""",
    "reset_month": f"""SELECT month_start, count(*) AS rows, CAST(sum(news_count) AS BIGINT) AS news_count FROM skeys
        WHERE month_start <> DATE '{MONTH}' GROUP BY ALL""",
    "prune_omitted": f"""
        SELECT raw_noticia_id, month_start, normalized_keyword, extractor_source, CAST(sum(occurrences) AS INT) AS occurrences
        FROM all_hits WHERE NOT (month_start = DATE '{MONTH}' AND normalized_keyword IN (SELECT normalized_keyword FROM omitted))
        GROUP BY ALL""",
    "recent_sync_periods": _detected("synced_at"),
    "recent_extraction_periods": _detected("fecha_extraccion"),
    "month_slice": f"SELECT id, fuente, fecha_publicacion FROM news WHERE {IN_MONTH}",
    "month_sample": f"SELECT id, fuente, fecha_publicacion FROM news WHERE {IN_MONTH} ORDER BY fecha_publicacion, id LIMIT 5",
    "parse_month": """
        SELECT o_orderkey, CASE WHEN regexp_full_match(trim(w), '[0-9]{4}-(0[1-9]|1[0-2])')
                                THEN CAST(trim(w) || '-01' AS DATE) END AS month_start
        FROM (SELECT o_orderkey, list_extract([k, '  ' || k || ' ', replace(k, '-', '/'), substr(k, 1, 5) || '13', '', NULL,
                k || '-01'], CAST(o_orderkey % 7 + 1 AS INT)) AS w
              FROM (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS k FROM orders))""",
    "months_to_extract": "SELECT DISTINCT month_start FROM state WHERE status IN ('pending', 'processing', 'failed')",
    "months_to_build": "SELECT DISTINCT month_start FROM state WHERE status IN ('completed', 'processing')",
    "distinct_months": "SELECT DISTINCT month_start FROM dated",
    "month_list": f"""
        SELECT month_start, strftime(month_start, '%Y-%m') AS value,
               list_extract([{", ".join(map(q, MONTH_NAMES))}], month(month_start)) || ' de ' || year(month_start) AS label,
               CAST(count(*) AS INT) AS total_news FROM dated GROUP BY month_start""",
    "select_month": """
        SELECT 'known' AS request, coalesce(max(month_start) FILTER (month_start = DATE '1998-05-01'), max(month_start)) AS month_start FROM dated
        UNION ALL SELECT 'unknown', max(month_start) FROM dated""",
    "omit_filter": f"SELECT {HIT} FROM all_hits WHERE normalized_keyword NOT IN (SELECT normalized_keyword FROM omitted)",
    "valid_urls": f"""
        SELECT page_id, CAST(variant AS INT) AS variant, CASE WHEN variant IN {OPENED} THEN value END AS url
        FROM pages, LATERAL (SELECT * FROM (VALUES {_URLS}) t(variant, value)) u""",
    "unprocessed_news": """
        SELECT id, fuente, fecha_publicacion FROM news
        WHERE id NOT IN (SELECT raw_noticia_id FROM markers WHERE status = 'completed')""",
    "sources_public": _sources(False),
    "sources_public_strict": _sources(True),
    "dictionary_hits": f"SELECT {HIT} FROM dict_hits",
    "dictionary_hits_by_join": f"SELECT {HIT} FROM dict_hits",
    "canonicalize_hits": f"SELECT {HIT} FROM canon",
    "affected_periods": "SELECT month_start, year, month, rows_detected FROM everything",
    "daily_activity": "SELECT * FROM daily",
    "source_keyword_stats": "SELECT * FROM skeys",
    "keyword_source_counts": "SELECT * FROM kmedia",
    "monthly_keyword_stats": "SELECT * FROM kstats",
    "monthly_keyword_source_map": "SELECT month_start, normalized_keyword, source_media, media_news_count AS news_count FROM kmedia",
    "source_monthly_stats": "SELECT * FROM sstats",
    "source_monthly_top": """SELECT month_start, source_media, CAST(rn - 1 AS INT) AS place, keyword, news_count,
        total_occurrences FROM source_top""",
    "monthly_overview": """
        SELECT n.month_start, CAST(n.total AS INT) AS total_news, CAST(coalesce(h.covered, 0) AS INT) AS news_with_keywords,
               CAST(n.sources AS INT) AS active_source_count, CAST(coalesce(h.keywords, 0) AS INT) AS keyword_count,
               n.first_publication_at, n.last_publication_at
        FROM (SELECT month_start, count(*) AS total, count(DISTINCT fuente) AS sources,
                     min(fecha_publicacion) AS first_publication_at, max(fecha_publicacion) AS last_publication_at
              FROM dated GROUP BY ALL) n
        LEFT JOIN (SELECT month_start, count(DISTINCT raw_noticia_id) AS covered,
                          count(DISTINCT normalized_keyword) AS keywords FROM hits GROUP BY ALL) h USING (month_start)""",
    "monthly_overview_top": """SELECT month_start, CAST(rn - 1 AS INT) AS place, keyword, type, news_count,
        total_occurrences FROM ktop""",
    "topic_overview": """
        SELECT month_start, CAST(count(DISTINCT raw_noticia_id) AS INT) AS news_count,
               CAST(coalesce(sum(occurrences), 0) AS INT) AS total_occurrences,
               min(fecha_publicacion) AS first_publication_at, max(fecha_publicacion) AS last_publication_at
        FROM topic GROUP BY month_start""",
    "topic_daily": "SELECT * FROM tdaily",
    "topic_news": _topic_news(REPRESENTATIVE),
    "topic_news_recent": _topic_news("fecha_publicacion DESC NULLS LAST, total_occurrences DESC, id DESC"),
    "topic_news_by_source": _topic_news(REPRESENTATIVE, f"""(
        SELECT t.* FROM topic t LEFT JOIN (SELECT month_start, source_media AS chosen FROM tsources WHERE key = {q(SOURCE_KEY)}) c
        USING (month_start) WHERE c.chosen IS NULL OR c.chosen = t.source_media)"""),
    "keyword_fallback": """
        SELECT month_start, CAST(rn AS INT) AS rn,
               coalesce(nullif(canonical_keyword, ''), nullif(keyword, ''), 'Tema') AS label, weight, occurrences
        FROM (SELECT *, row_number() OVER (PARTITION BY month_start ORDER BY weight DESC, occurrences DESC, keyword,
                canonical_keyword NULLS FIRST) AS rn
              FROM (SELECT month_start, coalesce(canonical_keyword, keyword) AS keyword, canonical_keyword,
                           CAST(sum(news_count) AS INT) AS weight, CAST(sum(total_occurrences) AS INT) AS occurrences
                    FROM (SELECT month_start, canonical_keyword, keyword, news_count, total_occurrences FROM skeys)
                    GROUP BY month_start, coalesce(canonical_keyword, keyword), canonical_keyword)) WHERE rn <= 24""",
    "merged_hits": f"SELECT {HIT} FROM merged",
    "peak_day": """
        SELECT month_start, arg_min(activity_date, -news_count * 100000 + (activity_date - DATE '1970-01-01')) AS peak_date,
               max(news_count) AS peak_count, count(*) FILTER (news_count > 0) AS active_days FROM daily GROUP BY month_start""",
    "run_summary": """SELECT count(*) AS periods, CAST(coalesce(sum(rows_detected), 0) AS BIGINT) AS rows_detected
        FROM recent""",
    "source_top_keywords": "SELECT * FROM source_top",
    "top_keywords_month": "SELECT * FROM ktop",
    "source_ranking": """SELECT month_start, source_media, news_count, distinct_keywords, CAST(row_number() OVER (
        PARTITION BY month_start ORDER BY news_count DESC, source_media) AS INT) AS rn FROM sstats""",
    "source_aliases": """
        SELECT source AS source_name, 'Fuente ' || row_number() OVER (ORDER BY later, source) AS alias
        FROM (SELECT source, min(CASE WHEN lang = 'fr' AND source > 'src3' THEN 0 ELSE 1 END) AS later
              FROM documents GROUP BY source)""",
    "keyword_weights": """SELECT month_start, normalized_keyword, round(greatest(0.12, least(1.0, news_count
        / CAST(greatest(1, max(news_count) OVER (PARTITION BY month_start)) AS DOUBLE))), 6) AS ratio FROM ktop""",
    "topic_sources": "SELECT * FROM tsources",
    "resolve_keyword": f"""
        SELECT month_start, coalesce(canonical_keyword, keyword) AS keyword, normalized_keyword, news_count
        FROM (SELECT *, row_number() OVER (PARTITION BY month_start ORDER BY news_count DESC, total_occurrences DESC,
                normalized_keyword) AS rn FROM kstats
              WHERE normalized_keyword = {q(TOPIC)} OR normalized_canonical_keyword = {q(TOPIC)}) WHERE rn = 1""",
    "resolve_keyword_fuzzy": f"""
        SELECT month_start, coalesce(canonical_keyword, keyword) AS keyword, normalized_keyword, news_count
        FROM (SELECT *, row_number() OVER (PARTITION BY month_start ORDER BY
                CASE WHEN position(normalized_keyword IN {q(REQUESTS[2])}) > 0 THEN 0 ELSE 1 END, news_count DESC,
                total_occurrences DESC, normalized_keyword) AS rn FROM kstats
              WHERE position(normalized_keyword IN {q(REQUESTS[2])}) > 0 OR position({q(REQUESTS[2])} IN normalized_keyword) > 0)
        WHERE rn = 1""",
    "resolve_keyword_batch": f"""
        SELECT a.month_start, a.query, coalesce(r.keyword, a.query) AS keyword,
               coalesce(r.normalized_keyword, a.query) AS normalized_keyword, r.news_count,
               list_extract(['exact', 'inside', 'around', 'raw'], coalesce(r.tier, 3) + 1) AS match
        FROM (SELECT * FROM (SELECT DISTINCT month_start FROM kstats), ({rows(*[(r,) for r in REQUESTS])}) t(query)) a
        LEFT JOIN (
          SELECT *, row_number() OVER (PARTITION BY month_start, query ORDER BY tier, news_count DESC,
              total_occurrences DESC, normalized_keyword) AS rn
          FROM (SELECT month_start, query, coalesce(canonical_keyword, keyword) AS keyword, normalized_keyword, news_count,
                       total_occurrences, CASE WHEN normalized_keyword = query OR normalized_canonical_keyword = query THEN 0
                         WHEN position(normalized_keyword IN query) > 0 THEN 1
                         WHEN position(query IN normalized_keyword) > 0 THEN 2 END AS tier
                FROM kstats, ({rows(*[(r,) for r in REQUESTS])}) t(query)) WHERE tier IS NOT NULL) r
        ON r.month_start = a.month_start AND r.query = a.query AND r.rn = 1""",
    "all_hits": f"SELECT {HIT} FROM all_hits",
    "clean_text": f"SELECT doc_id, md5({clean('text')}) AS cleaned FROM documents",
    "normalize_text": f"""SELECT doc_id, CAST(length(n) AS INT) AS chars, md5(n) AS normalized
        FROM (SELECT doc_id, {normalize('text')} AS n FROM documents)""",
    "normalize_query": f"SELECT conv_id, turn, md5({_normalized_query('text')}) AS normalized FROM conversations",
    "build_document": """SELECT raw_noticia_id, CAST(length(document) AS INT) AS chars, md5(document) AS document
        FROM docs""",
    "alias_counts": "SELECT raw_noticia_id, normalized_alias, CAST(n AS INT) AS occurrences FROM name_counts",
    "alias_keys": r"""
        SELECT s.source_media, 'fuente-' || CASE WHEN a.alias IS NOT NULL THEN replace(a.alias, 'Fuente ', '')
                 ELSE CAST(CAST(regexp_extract(s.source_media, '([0-9]+)$', 1) AS INT) + 1 AS VARCHAR) END AS key
        FROM (SELECT DISTINCT source AS source_media FROM documents) s
        LEFT JOIN named a ON a.source_name = s.source_media AND a.source_name < 'src15'""",
    "decode_keyword": r"""
        SELECT doc_id, md5(regexp_replace(split_part(text, chr(10), 1), '^[\s\x{feff}]+|[\s\x{feff}]+$', '', 'g')) AS decoded,
               '%zz+' || doc_id AS malformed FROM documents""",
    "read_top_keywords": """SELECT month_start, CAST(rn - 1 AS INT) AS place, trim(keyword) AS label,
        CAST(news_count AS DOUBLE) AS weight, CAST(nullif(total_occurrences, 0) AS DOUBLE) AS occurrences FROM ktop""",
    "month_labels": f"""SELECT DISTINCT month_start, list_extract([{", ".join(map(q, MONTH_NAMES))}], month(month_start))
        || ' de ' || year(month_start) AS label FROM dated""",
    "entity_hits": f"SELECT {HIT} FROM entity_hits",
    "keyphrase_terms": """SELECT raw_noticia_id, term, tf, CAST(tf_cased AS BIGINT) AS tf_cased, left_terms, right_terms,
        sentences, median_sentence, round(s, 6) AS term_score FROM scored""",
    "keyphrase_candidates": """SELECT raw_noticia_id, phrase_key, phrase, phrase_score, tf
        FROM candidates""",
    "keyphrase_hits": "SELECT raw_noticia_id, keyword, normalized_keyword, round(score, 6) AS score, occurrences FROM phrase_hits",
    "news_keywords": """
        SELECT raw_noticia_id, noticia_hash, month_start, keyword, normalized_keyword, canonical_keyword,
               normalized_canonical_keyword, keyword_type, extractor_source, round(score, 6) AS score, occurrences, source_media
        FROM hits""",
    "affected_month_rebuild": "SELECT * FROM daily WHERE month_start IN (SELECT month_start FROM recent)",
    "reopen_consumed": """SELECT u.* FROM upserted u JOIN state s ON s.month_start = u.month_start
        WHERE s.status = 'consumed' AND u.status = 'pending'""",
    "mark_consumed": f"""
        SELECT processing_run_id, year, month, month_start, CASE WHEN hit THEN 'consumed' ELSE status END AS status, reason,
               rows_detected, CASE WHEN hit THEN {NOW} ELSE updated_at END AS updated_at
        FROM (SELECT *, year BETWEEN 1996 AND 1998 AND status IN ('completed', 'processing') AS hit FROM state)""",
    "duplicate_keys": "SELECT fuente, md5(titulo) AS title_key, count(*) AS copies FROM news GROUP BY ALL HAVING count(*) > 1",
    "orphans": """
        SELECT 'embeddings' AS child, vec_id AS reference FROM embeddings WHERE vec_id NOT IN (SELECT doc_id FROM documents)
        UNION ALL SELECT 'orders', o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT doc_id FROM documents)""",
    "domain_violations": _DOMAINS,
    "month_over_month": "SELECT * FROM changes",
    "emerging_topics": """
        SELECT * EXCLUDE (rn), CAST(rn AS INT) AS rn FROM (
          SELECT *, row_number() OVER (PARTITION BY month_start ORDER BY change DESC, news_count DESC, normalized_keyword) AS rn
          FROM changes WHERE news_count >= 2 AND news_count + 1 >= 2 * (previous_count + 1)) WHERE rn <= 10""",
    "falling_topics": """
        SELECT * EXCLUDE (rn), CAST(rn AS INT) AS rn FROM (
          SELECT *, news_count = 0 AS disappeared,
                 row_number() OVER (PARTITION BY month_start ORDER BY change, previous_count DESC, normalized_keyword) AS rn
          FROM changes WHERE previous_count >= 2 AND change < 0) WHERE rn <= 10""",
    "source_topic_heatmap": """
        SELECT month_start, source_media,
               CAST(coalesce(sum(news_count) FILTER (normalized_keyword = 'thtion'), 0) AS INT) AS thtion,
               CAST(coalesce(sum(news_count) FILTER (normalized_keyword = 'attion'), 0) AS INT) AS attion,
               CAST(coalesce(sum(news_count) FILTER (normalized_keyword = 'the the'), 0) AS INT) AS "the the"
        FROM skeys WHERE normalized_keyword IN ('thtion', 'attion', 'the the') GROUP BY month_start, source_media""",
    "dominant_categories": """
        SELECT *, CAST(row_number() OVER (PARTITION BY month_start ORDER BY news_count DESC, total_occurrences DESC, category) AS INT) AS rn
        FROM (SELECT k.month_start, e.category, CAST(sum(k.news_count) AS INT) AS news_count,
                     CAST(sum(k.total_occurrences) AS INT) AS total_occurrences
              FROM kstats k JOIN entries e ON e.normalized = coalesce(k.normalized_canonical_keyword, k.normalized_keyword)
              WHERE e.category IS NOT NULL GROUP BY ALL)""",
    "related_keywords": f"""
        SELECT month_start, normalized_keyword, CAST(shared AS INT) AS shared_count, jaccard, CAST(rn AS INT) AS rn FROM (
          SELECT *, row_number() OVER (PARTITION BY month_start ORDER BY jaccard DESC, shared DESC, normalized_keyword) AS rn FROM (
            SELECT h.month_start, h.normalized_keyword, count(DISTINCT t.raw_noticia_id) AS shared,
                   round(count(DISTINCT t.raw_noticia_id) / (count(DISTINCT h.raw_noticia_id) + any_value(s.n)
                         - count(DISTINCT t.raw_noticia_id)), 6) AS jaccard
            FROM hits h LEFT JOIN (SELECT DISTINCT raw_noticia_id FROM topic) t USING (raw_noticia_id)
            JOIN (SELECT month_start, count(DISTINCT raw_noticia_id) AS n FROM topic GROUP BY ALL) s USING (month_start)
            WHERE h.normalized_keyword <> {q(TOPIC)} GROUP BY h.month_start, h.normalized_keyword) WHERE shared > 0) WHERE rn <= 20""",
    "keyword_daily": """
        SELECT d.month_start, d.activity_date, coalesce(t.news_count, 0) AS news_count
        FROM (SELECT month_start, CAST(unnest(generate_series(month_start, last_day(month_start), INTERVAL 1 DAY)) AS DATE) AS activity_date
              FROM (SELECT DISTINCT month_start FROM tdaily)) d LEFT JOIN tdaily t USING (month_start, activity_date)""",
    "keyword_weekly": """SELECT CAST(date_trunc('week', activity_date) AS DATE) AS week_start,
        CAST(sum(news_count) AS INT) AS news_count FROM tdaily GROUP BY ALL""",
    "related_classes": """
        SELECT month_start, normalized_keyword AS keyword, n AS articles,
          min(normalized_keyword) OVER (PARTITION BY month_start, articles) AS class
        FROM (SELECT month_start, normalized_keyword, count(DISTINCT raw_noticia_id) AS n,
                string_agg(DISTINCT raw_noticia_id, ',' ORDER BY raw_noticia_id) AS articles
              FROM hits GROUP BY month_start, normalized_keyword)""",
    "related_links": """
        SELECT a.month_start, a.keyword, b.keyword AS related, len(list_intersect(a.articles, b.articles)) AS shared,
          round(len(list_intersect(a.articles, b.articles)) / (len(a.articles) + len(b.articles) - len(list_intersect(a.articles, b.articles))), 6) AS jaccard
        FROM (SELECT month_start, min(keyword) AS keyword, articles FROM (
                SELECT month_start, normalized_keyword AS keyword, list(DISTINCT raw_noticia_id ORDER BY raw_noticia_id) AS articles
                FROM hits GROUP BY month_start, normalized_keyword) GROUP BY month_start, articles) a
        JOIN (SELECT month_start, min(keyword) AS keyword, articles FROM (
                SELECT month_start, normalized_keyword AS keyword, list(DISTINCT raw_noticia_id ORDER BY raw_noticia_id) AS articles
                FROM hits GROUP BY month_start, normalized_keyword) GROUP BY month_start, articles) b
          ON a.month_start = b.month_start AND a.keyword < b.keyword AND list_has_any(a.articles, b.articles)
        WHERE 100 * shared >= 50 * (len(a.articles) + len(b.articles) - shared)""",
    "stream_daily_activity": "SELECT * FROM daily",
    "stored_keywords": """SELECT raw_noticia_id, month_start, normalized_keyword, extractor_source, round(score, 6) AS score,
        occurrences, source_media FROM hits""",
    "month_page": f"""
        SELECT 'articles' AS section, 0 AS place, 'total' AS label, count(*) AS value FROM dated WHERE month_start = DATE '{MONTH}'
        UNION ALL SELECT 'articles', 0, 'with keywords', count(DISTINCT raw_noticia_id) FROM hits WHERE month_start = DATE '{MONTH}'
        UNION ALL SELECT 'day', 0, CAST(activity_date AS VARCHAR), news_count FROM daily WHERE month_start = DATE '{MONTH}'
        UNION ALL SELECT 'source', rn, alias, news_count FROM ({_sources(False)}) WHERE month_start = DATE '{MONTH}'
        UNION ALL SELECT 'keyword', CAST(rn AS INT), keyword, news_count FROM ktop WHERE month_start = DATE '{MONTH}'""",
    "topic_page": f"""
        SELECT 'articles' AS section, 0 AS place, {q(TOPIC)} AS label, count(DISTINCT raw_noticia_id) AS value FROM topic
        WHERE month_start = DATE '{MONTH}'
        UNION ALL SELECT 'day', 0, CAST(activity_date AS VARCHAR), news_count FROM tdaily WHERE month_start = DATE '{MONTH}'
        UNION ALL SELECT 'source', rn, alias, news_count FROM tsources WHERE month_start = DATE '{MONTH}'
        UNION ALL SELECT 'news', rn, CAST(id AS VARCHAR), total_occurrences FROM ({
            _topic_news("fecha_publicacion DESC NULLS LAST, total_occurrences DESC, id DESC")}) WHERE month_start = DATE '{MONTH}'""",
    "nearest_articles": """
        SELECT n.id, round(list_cosine_similarity(CAST(n.embedding AS DOUBLE[]), CAST(t.embedding AS DOUBLE[])), 6) AS similarity
        FROM news n, (SELECT embedding FROM news WHERE id = 7) t WHERE n.embedding IS NOT NULL AND n.id <> 7
        ORDER BY similarity DESC, n.id LIMIT 10""",
}


_GAP = "list_sum(list_transform(list_zip(p.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"


def _clusters(steps: int) -> str:
    """Common table expressions up to ``assigned``: each article's cluster after ``steps`` of Lloyd's method."""
    parts = ["""points AS MATERIALIZED (
  SELECT doc_id AS id, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start,
    list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 65536) AS BIGINT)) AS v
  FROM documents JOIN orders ON o_orderkey = doc_id JOIN embeddings ON vec_id = doc_id WHERE embedding IS NOT NULL
)""", f"""centres0 AS MATERIALIZED (
  SELECT month_start, row_number() OVER (PARTITION BY month_start ORDER BY md5(CAST(id AS VARCHAR)), id) - 1 AS cluster, v
  FROM points QUALIFY cluster < {CLUSTERS}
)"""]
    for step in range(steps + 1):
        parts.append(f"""near{step} AS MATERIALIZED (
  SELECT id, p.month_start, min(struct_pack(gap := {_GAP}, cluster := cluster)) AS best
  FROM points p JOIN centres{step} c USING (month_start) GROUP BY id, p.month_start
)""")
        if step < steps:
            parts.append(f"""centres{step + 1} AS MATERIALIZED (
  SELECT month_start, cluster, coalesce(m.v, c.v) AS v FROM centres{step} c LEFT JOIN (
    SELECT month_start, cluster, list(mean ORDER BY place) AS v FROM (
      SELECT month_start, best.cluster AS cluster, place, CAST(floor(sum(v[place]) / count(*)) AS BIGINT) AS mean
      FROM near{step} JOIN points USING (id, month_start), unnest(range(1, len(v) + 1)) AS u(place)
      GROUP BY month_start, best.cluster, place
    ) GROUP BY month_start, cluster) m USING (month_start, cluster)
)""")
    parts.append(f"""assigned AS (
  SELECT id, month_start, CAST(best.cluster AS INT) AS cluster, CAST(best.gap AS DOUBLE) / 4294967296 AS distance FROM near{steps}
)""")
    return "WITH " + ", ".join(parts)


def _dot(a: str, b: str) -> str:
    return f"list_sum(list_transform(list_zip({a}, {b}), lambda z: CAST(z[1] AS HUGEINT) * z[2]))"


def _scaled(v: str) -> str:
    return f"list_transform({v}, lambda x: x * 1048576 // greatest(1, list_max(list_transform({v}, lambda y: abs(y)))))"


def _square(v: str) -> str:
    """``v`` without its part along the first axis."""
    return f"list_transform(list_zip({v}, a.axis), lambda q: q[1] - {_dot(v, 'a.axis')} * q[2] // greatest(1, {_dot('a.axis', 'a.axis')}))"


def _power(name: str, start: int, steps: int) -> str:
    """Power iteration, one expression a step; the sign makes the largest component positive."""
    again, beside = (lambda v: v, "") if name == "first" else (_square, ", first a")
    parts = [f"""{name}0 AS MATERIALIZED (SELECT {_scaled("s.v")} AS v FROM (SELECT {again("f.v")} AS v FROM (
  SELECT list(w ORDER BY j) AS v FROM matrix WHERE i = (SELECT i FROM varied WHERE place = {start})) f{beside}) s)"""]
    for step in range(steps):
        image = f"list_transform(m.rows, lambda r: {_dot('r', 'p.v')})"
        parts.append(f"""{name}{step + 1} AS MATERIALIZED (SELECT {_scaled("s.v")} AS v FROM (SELECT {again("f.v")} AS v FROM (
  SELECT {image} AS v FROM {name}{step} p, whole m) f{beside}) s)""")
    parts.append(f"""{name} AS MATERIALIZED (
  SELECT list_transform(v, lambda x: x * CASE WHEN list_max(v) > -list_min(v) OR (list_max(v) = -list_min(v)
    AND list_position(v, list_max(v)) < list_position(v, list_min(v))) THEN 1 ELSE -1 END) AS axis FROM {name}{steps}
)""")
    return ", ".join(parts)


def _place(axis: str) -> str:
    middle = f"CAST(floor({_dot('total', f'{axis}.axis')} / n) AS HUGEINT)"
    length = f"sqrt(CAST({_dot(f'{axis}.axis', f'{axis}.axis')} AS DOUBLE))"
    return f"CAST({_dot('v', f'{axis}.axis')} - {middle} AS DOUBLE) / (1024 * {length})"


MAP_2D = f"""WITH points AS MATERIALIZED (
  SELECT doc_id AS id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1024) AS BIGINT)) AS v
  FROM documents JOIN embeddings ON vec_id = doc_id WHERE embedding IS NOT NULL
), cells AS MATERIALIZED (SELECT id, place, v[place] AS x FROM points, unnest(range(1, len(v) + 1)) AS u(place)
), sums AS MATERIALIZED (SELECT place, CAST(sum(x) AS HUGEINT) AS total, CAST(count(*) AS HUGEINT) AS n FROM cells GROUP BY place
), spread AS MATERIALIZED (
  SELECT i, j, a.n * q - a.total * b.total AS c FROM (
    SELECT l.place AS i, r.place AS j, CAST(sum(l.x * r.x) AS HUGEINT) AS q FROM cells l JOIN cells r USING (id) GROUP BY l.place, r.place
  ) JOIN sums a ON a.place = i JOIN sums b ON b.place = j
), matrix AS MATERIALIZED (SELECT i, j, c * 1073741824 // (SELECT max(abs(c)) FROM spread) AS w FROM spread
), whole AS MATERIALIZED (SELECT list(cells ORDER BY i) AS rows FROM (SELECT i, list(w ORDER BY j) AS cells FROM matrix GROUP BY i)
), varied AS MATERIALIZED (SELECT i, row_number() OVER (ORDER BY w DESC, i) AS place FROM matrix WHERE i = j
), {_power("first", 1, map2d.STEPS)}, {_power("second", 2, map2d.STEPS)}, middle AS (
  SELECT list(total ORDER BY place) AS total, any_value(n) AS n FROM sums
)
SELECT id, {_place("first")} AS x, {_place("second")} AS y FROM points, first, second, middle"""

_NEIGHBOURS = f"""WITH points AS MATERIALIZED (
  SELECT doc_id AS id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 65536) AS BIGINT)) AS v
  FROM documents JOIN embeddings ON vec_id = doc_id WHERE embedding IS NOT NULL
), cells AS (SELECT id, place, v[place + 1] AS x FROM points, unnest(range(0, len(v))) AS u(place)
), planes AS MATERIALIZED (
  SELECT t, b, i, CASE WHEN md5(t || ':' || b || ':' || i)[1] < '8' THEN 1 ELSE -1 END AS weight
  FROM unnest(range(0, {neighbours.TABLES})) AS x(t), unnest(range(0, {neighbours.BITS})) AS y(b),
    unnest(range(0, (SELECT max(len(v)) FROM points))) AS z(i)
), signs AS (SELECT id, t, b, sum(x * weight) >= 0 AS side FROM cells JOIN planes ON i = place GROUP BY id, t, b
), buckets AS MATERIALIZED (SELECT id, t, list(side ORDER BY b) AS bucket FROM signs GROUP BY id, t
), lengths AS MATERIALIZED (SELECT id, v, sqrt(CAST({_dot("v", "v")} AS DOUBLE)) AS l FROM points
), compared AS MATERIALIZED (
  SELECT a.id AS asked_id, b.id, round(CAST({_dot("a.v", "b.v")} AS DOUBLE) / (a.l * b.l), 6) AS similarity
  FROM lengths a JOIN lengths b ON a.id <> b.id AND a.id % {ASKED_EVERY} = 0
), met AS (
  SELECT DISTINCT a.id AS asked_id, b.id FROM buckets a JOIN buckets b USING (t, bucket) WHERE a.id <> b.id AND a.id % {ASKED_EVERY} = 0
), near AS (
  SELECT asked_id, id, similarity, row_number() OVER (PARTITION BY asked_id ORDER BY similarity DESC, id) AS rn
  FROM compared JOIN met USING (asked_id, id) QUALIFY rn <= 10
), wanted AS (
  SELECT asked_id, id FROM compared QUALIFY row_number() OVER (PARTITION BY asked_id ORDER BY similarity DESC, id) <= 10
)
"""

# Every rule spelt out: table, rule, and what breaks it.
_BROKEN = {
    ("raw_news", "required noticia_hash"): ("news", "noticia_hash IS NULL", "noticia_hash"),
    ("raw_news", "required titulo"): ("news", "id % 7 = 0 OR titulo IS NULL", "CAST(NULL AS VARCHAR)"),
    ("raw_news", "required url_original"): ("news", "url_original IS NULL", "url_original"),
    ("raw_news", "required fuente"): ("news", "fuente IS NULL", "fuente"),
    ("news_keyword_processing", "required raw_noticia_id"): ("marks", "raw_noticia_id IS NULL", "raw_noticia_id"),
    ("news_keyword_processing", "domain status"): ("marks", "status NOT IN ('completed', 'failed')", "status"),
    ("affected_periods", "required month_start"): ("terms", "month_start IS NULL", "month_start"),
    ("affected_periods", "required reason"): ("terms", "reason IS NULL", "reason"),
    ("affected_periods", "required status"): ("terms", "status IS NULL", "status"),
    ("affected_periods", "domain status"): (
        "terms", "status NOT IN ('pending', 'processing', 'completed', 'consumed', 'failed', 'skipped')", "status"),
    ("affected_periods", "domain month"): ("terms", "month NOT BETWEEN 1 AND 12", "month"),
    ("processing_runs", "required run_id"): ("runs", "run_id IS NULL", "run_id"),
    ("processing_runs", "required status"): ("runs", "status IS NULL", "status"),
    ("processing_runs", "domain run_type"): ("runs", "run_type NOT IN ('full', 'incremental')", "run_type"),
    ("processing_runs", "domain status"): ("runs", "status NOT IN ('running', 'completed', 'failed')", "status"),
    ("raw_news", "unique noticia_hash"): ("(SELECT noticia_hash FROM news GROUP BY ALL HAVING count(*) > 1)", "true", "noticia_hash"),
    ("news_keyword_processing", "unique raw_noticia_id"): (
        "(SELECT raw_noticia_id FROM marks GROUP BY ALL HAVING count(*) > 1)", "true", "raw_noticia_id"),
    ("affected_periods", "unique month_start, reason"): (
        "(SELECT month_start, reason FROM terms GROUP BY ALL HAVING count(*) > 1)", "true", "month_start || '|' || reason"),
    ("processing_runs", "unique run_id"): ("(SELECT run_id FROM runs GROUP BY ALL HAVING count(*) > 1)", "true", "run_id"),
    ("affected_periods", "reference processing_run_id to processing_runs.run_id"): (
        "terms", "processing_run_id NOT IN (SELECT run_id FROM runs)", "processing_run_id"),
    ("news_keyword_processing", "reference updated_from_run_id to processing_runs.run_id"): (
        "marks", "updated_from_run_id NOT IN (SELECT run_id FROM runs)", "updated_from_run_id"),
    ("news_keyword_processing", "reference raw_noticia_id to raw_news.id"): (
        "marks", "raw_noticia_id NOT IN (SELECT id FROM news)", "raw_noticia_id"),
}
_CONSTRAINTS = """WITH news AS (
  SELECT doc_id AS id, md5(CAST(doc_id AS VARCHAR)) AS noticia_hash, split_part(text, chr(10), 1) AS titulo, source AS fuente,
    'https://' || source || '.example/' || doc_id AS url_original FROM documents
), marks AS (
  SELECT vec_id * 3 AS raw_noticia_id, ['completed', 'failed', 'unknown'][label % 3 + 1] AS status, 'run-' || label AS updated_from_run_id
  FROM embeddings
), terms AS (
  SELECT 'run-' || (o_custkey % 6) AS processing_run_id, month(o_orderdate) + o_orderkey % 2 AS month, o_orderpriority AS reason,
    CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start,
    CASE o_orderstatus WHEN 'F' THEN 'failed' WHEN 'O' THEN 'open' END AS status FROM orders
), runs AS (
  SELECT 'run-' || n_regionkey AS run_id, 'running' AS status, CASE WHEN n_nationkey % 2 = 0 THEN 'full' ELSE 'weekly' END AS run_type FROM nation
)
""" + " UNION ALL ".join(
    f"SELECT {q(table)} AS table_name, {q(rule)} AS rule, count(*) AS violations, min(CAST({example} AS VARCHAR)) AS example FROM {rows} WHERE {where}"
    for (table, rule), (rows, where, example) in _BROKEN.items()
)

ORACLES: dict[str, str] = {name: sql(select) for name, select in _SELECTS.items()} | {
    "monthly_clusters": _clusters(clusters.STEPS) + """
SELECT month_start, cluster, count(*) AS news_count, max(distance) AS farthest FROM assigned GROUP BY month_start, cluster""",
    "cluster_representatives": _clusters(clusters.STEPS) + """
SELECT month_start, cluster, id, distance, CAST(row_number() OVER (PARTITION BY month_start, cluster ORDER BY distance, id) AS INT) AS rn
FROM assigned QUALIFY rn <= 3""",
    "map_2d": MAP_2D,
    "constraint_report": _CONSTRAINTS,
    "nearest_many": _NEIGHBOURS + "SELECT asked_id, id, similarity, CAST(rn AS INT) AS rn FROM near",
    "nearest_recall": _NEIGHBOURS + """SELECT count(*) AS wanted, count(near.id) AS found, round(count(near.id) / count(*), 6) AS recall
FROM wanted LEFT JOIN near USING (asked_id, id)""",
}
