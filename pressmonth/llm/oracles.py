"""SQL (DuckDB) of the queries that SQL can express."""

from __future__ import annotations

_DOT = "list_sum(list_transform(list_zip({a}, {b}), lambda z: z[1] * z[2]))"
_GAP = "list_sum(list_transform(list_zip({a}, {b}), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
_USABLE = """embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""


def _whole(scale: int) -> str:
    return f"list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT))"


HARD_NEGATIVES = f"""
WITH points AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, {_whole(256)} AS v
  FROM embeddings WHERE label IS NOT NULL AND {_USABLE}
), scores AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, p.vec_id, a.label = p.label AS same, {_DOT.format(a="a.v", b="p.v")} AS score
  FROM points a JOIN points p ON a.vec_id % 100 = 0 AND p.vec_id <> a.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), found AS (
  SELECT p.anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS place
  FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT same
    AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, CAST(positive_score AS BIGINT) AS positive_score,
  CAST(negative_score AS BIGINT) AS negative_score
FROM found WHERE place <= 5
"""


def _vector_codes(rounds: int) -> str:
    steps = []
    for turn in range(rounds + 1):
        steps.append(f"""codes{turn} AS MATERIALIZED (
  SELECT vec_id, part, min(struct_pack(gap := {_GAP.format(a="v", b="entry")}, place := place)) AS best
  FROM pieces JOIN book{turn} USING (part) GROUP BY vec_id, part
)""")
        if turn < rounds:
            steps.append(f"""means{turn} AS (
  SELECT part, best.place AS place, pos, CAST(floor(sum(v[pos]) / count(*)) AS BIGINT) AS mean
  FROM codes{turn} JOIN pieces USING (vec_id, part), unnest(range(1, len(v) + 1)) AS u(pos)
  GROUP BY part, best.place, pos
), moved{turn} AS (
  SELECT part, place, list(mean ORDER BY pos) AS entry FROM means{turn} GROUP BY part, place
), book{turn + 1} AS MATERIALIZED (
  SELECT part, place, coalesce(m.entry, b.entry) AS entry FROM book{turn} b LEFT JOIN moved{turn} m USING (part, place)
)""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, {_whole(1024)} AS v FROM embeddings WHERE {_USABLE}
), pieces AS MATERIALIZED (
  SELECT vec_id, part, v[part * len(v) // 4 + 1 : (part + 1) * len(v) // 4] AS v FROM kept, unnest(range(0, 4)) AS u(part)
), book0 AS MATERIALIZED (
  SELECT part, dense_rank() OVER (ORDER BY vec_id) - 1 AS place, v AS entry FROM pieces
  WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 256)
), {", ".join(steps)}, digest AS (
  SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, place, pos)) AS codebooks_sha256
  FROM (SELECT part, place, unnest(entry) AS x, unnest(range(0, len(entry))) AS pos FROM book{rounds})
), coded AS (
  SELECT vec_id, string_agg(printf('%02x', best.place), '' ORDER BY part) AS code, CAST(sum(best.gap) AS BIGINT) AS error
  FROM codes{rounds} GROUP BY vec_id
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN kept USING (vec_id), digest
"""


SUBSTRING_DEDUP = r"""
WITH texts AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
  SELECT doc_id, pos, md5(array_to_string(words[pos : pos + 19], ' ')) AS content
  FROM texts, unnest(range(1, len(words) - 18)) AS u(pos)
), later AS (
  SELECT doc_id, pos FROM windows
  QUALIFY row_number() OVER (PARTITION BY content ORDER BY doc_id, pos) > 1
), gone AS (
  SELECT DISTINCT doc_id, pos + step AS pos FROM later, unnest(range(0, 20)) AS u(step)
), kept AS (
  SELECT doc_id, count(*) FILTER (gone.pos IS NOT NULL) AS n_removed, string_agg(word, ' ' ORDER BY all_words.pos) FILTER (gone.pos IS NULL) AS words
  FROM (SELECT doc_id, pos, words[pos] AS word FROM texts, unnest(range(1, len(words) + 1)) AS u(pos)) all_words
  LEFT JOIN gone USING (doc_id, pos) GROUP BY doc_id
)
SELECT doc_id, CAST(len(texts.words) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept.words, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (doc_id)
"""

ORACLES = {
    "op11_hard_negatives": HARD_NEGATIVES,
    "op12_vector_codes": _vector_codes(4),
    "op13_substring_dedup": SUBSTRING_DEDUP,
}
