"""SQL counterparts of this subpackage's queries, where SQL can say them."""

from __future__ import annotations

from tillpoint.llm.common import LOWER, UPPER
from tillpoint.llm.line_dedup import SOLID

_WORD = r"[^\x20\x09-\x0D]+"

OP1 = """
  WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
  scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, cast(list_inner_product(q.e, c.e) AS BIGINT) AS score
    FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.e) = len(q.e) WHERE q.vec_id % 50 = 0),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored)
  SELECT query_id, cast(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 5"""

OP5 = f"""
  WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents),
  g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
  SELECT doc_id, keep_id, group_size, coalesce(doc_id = keep_id, keep_id IS NULL) AS kept, sha256(d.t) AS text_sha256
  FROM d JOIN g ON g.t = d.t"""

OP6 = rf"""
  WITH lists AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
  lines AS (SELECT doc_id, l, unnest(l) AS line, generate_subscripts(l, 1) AS i FROM lists),
  runs AS (
    SELECT doc_id, l, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS e FROM lines WHERE regexp_matches(line, '{SOLID}')),
  placed AS (
    SELECT doc_id, i, e, row_number() OVER (PARTITION BY array_to_string(l[i:e], chr(10)) ORDER BY doc_id, i) > 1 AS again
    FROM runs WHERE e IS NOT NULL),
  gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i, e)) AS i FROM placed WHERE again)
  SELECT lines.doc_id, coalesce(string_agg(line, chr(10) ORDER BY lines.i) FILTER (gone.i IS NULL), '') AS text,
         cast(count(gone.i) AS INTEGER) AS removed_lines
  FROM lines LEFT JOIN gone ON gone.doc_id = lines.doc_id AND gone.i = lines.i GROUP BY lines.doc_id"""

_SAID = r"'\### Assistant: </turn> ok'"
OP8 = rf"""
  WITH c AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', {_SAID} UNION ALL SELECT -7, 1, 'assistant', {_SAID}),
  g AS (
    SELECT conv_id, count(*) AS n_turns,
      string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
      coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
      sum(4 + length(regexp_replace(role, '[\\#<:]', '..', 'g')) + 2 + length(regexp_replace(text, '[\\#<]', '..', 'g')) + 8) AS chars
    FROM c GROUP BY conv_id)
  SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
         cast(chars AS BIGINT) AS formatted_chars FROM g"""

OP10 = rf"""
  WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{_WORD}') AS l FROM documents),
  s AS (
    SELECT doc_id, unnest(list_distinct(CASE WHEN len(l) = 0 THEN [] WHEN len(l) < 3 THEN [array_to_string(l, ' ')]
      ELSE list_transform(range(1, len(l) - 1), lambda i: l[i] || ' ' || l[i + 1] || ' ' || l[i + 2]) END)) AS x FROM w),
  n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
  common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2),
  links AS (SELECT a, b FROM common JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 90 * (p.n + q.n - c)),
  reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
  SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id
  JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) m ON m.a = d.doc_id"""

_TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
OP11 = rf"""
  WITH i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{_TERM}') AS l FROM benchmark),
  windows AS (
    SELECT DISTINCT item_id, least(len(l), 10) AS n, array_to_string(l[s:s + least(len(l), 10) - 1], ' ') AS w
    FROM (SELECT item_id, l, unnest(range(1, len(l) - least(len(l), 10) + 2)) AS s FROM i WHERE len(l) > 0)),
  d AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{_TERM}') AS l
    FROM documents),
  spans AS (
    SELECT r, n, s, array_to_string(l[s:s + n - 1], ' ') AS w
    FROM (SELECT r, l, n, unnest(range(1, len(l) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM windows))),
  hits AS (SELECT r, s, spans.n, item_id FROM spans JOIN windows USING (w)),
  places AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM hits) GROUP BY r),
  named AS (
    SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY r)
  SELECT doc_id, len(l) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
         coalesce(n_hit, 0) > 0 AS contaminated
  FROM d LEFT JOIN places ON places.r = d.r LEFT JOIN named ON named.r = d.r"""

def _op12(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    """Every part of every vector against every entry, round by round."""
    steps = [f"""
  WITH v AS (
    SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
  p AS (
    SELECT r, k, e[k * (len(e) // {parts}) + 1:(k + 1) * (len(e) // {parts})] AS x
    FROM (SELECT r, e, unnest(range({parts})) AS k FROM v)),
  c0 AS (
    SELECT k, n - 1 AS entry, x FROM p JOIN (SELECT r, row_number() OVER (ORDER BY vec_id) AS n FROM v) USING (r) WHERE n <= {entries})"""]
    for i in range(rounds + 1):
        steps.append(f"""
  d{i} AS (
    SELECT p.r, p.k, p.x, c.entry, list_sum(list_transform(list_zip(p.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
    FROM p JOIN c{i} c ON c.k = p.k),
  a{i} AS (SELECT r, k, any_value(x) AS x, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM d{i} GROUP BY r, k)""")
        if i < rounds:
            steps.append(f"""
  m{i} AS (
    SELECT k, entry, list(y ORDER BY j) AS x FROM (
      SELECT k, entry, j, floor(sum(x[j]) / count(*))::BIGINT AS y FROM (
        SELECT k, entry, x, unnest(range(1, len(x) + 1)) AS j FROM a{i}) GROUP BY k, entry, j) GROUP BY k, entry),
  c{i + 1} AS (SELECT c.k, c.entry, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN m{i} m ON m.k = c.k AND m.entry = c.entry)""")
    return ",".join(steps) + f""",
  coded AS (
    SELECT r, string_agg(format('{{:02x}}', entry), '' ORDER BY k) AS code, sum(d)::BIGINT AS error FROM a{rounds} GROUP BY r)
  SELECT vec_id, code, error, cast(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
         (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY k, entry)) FROM c{rounds}) AS codebooks_sha256
  FROM coded JOIN v USING (r)"""


OP12 = _op12()

OP13 = """
  WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
  scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, cast(list_inner_product(a.e, b.e) AS BIGINT) AS score
    FROM v a JOIN v b ON b.vec_id <> a.vec_id AND len(a.e) = len(b.e) WHERE a.vec_id % 100 = 0),
  positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score
    FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS r FROM scored WHERE same) WHERE r <= 5),
  ranked AS (
    SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
           row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS r
    FROM positives JOIN scored USING (anchor_id)
    WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score)
  SELECT anchor_id, positive_id, cast(r AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM ranked WHERE r <= 5"""

ORACLES: dict[str, str] = {"op1_topk": OP1, "op5_exact_dedup": OP5, "op6_line_dedup": OP6, "op6_passage_dedup": OP6,
                           "op8_chat": OP8, "op10_jaccard_join": OP10,
                           "op11_decontamination": OP11, "op12_value_codes": OP12,
                           "op13_hard_negatives": OP13}
