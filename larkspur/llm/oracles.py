"""DuckDB SQL with the rows of those queries that SQL can express."""

#: Template marks of ``chat_format``, counted in code points.
_HEADER, _HEADER_END, _END = 8, 7, 4

ORACLES = {
    "op3_chat_formatting": r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked AS (
  SELECT *, role || chr(10) || text AS body FROM rows
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN len(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(len(role) + len(text) + 8 + 7 + 4
    + (len(body) - len(replace(body, '</s>', ''))) // 4 + (len(body) - len(replace(body, '[/INST]', ''))) // 7
    + (len(body) - len(replace(body, '[INST', ''))) // 5) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id
""",
    "op5_exact_dedup": """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
""",
    "op6_url_filters": r"""
WITH parts AS (
  SELECT page_id, url,
    CASE WHEN url LIKE '%://%' THEN lower(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's')) ELSE '' END AS host,
    CASE WHEN url LIKE '%://%' THEN regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's') ELSE '' END AS path
  FROM pages
), rules(name, host, path, verdict) AS (
  VALUES ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
    ('www.example.com/en/', 'www.example.com', '/en/', 'allow'),
    ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block')
), hits AS (
  SELECT page_id, max_by(r.name, len(r.name)) AS rule, max_by(r.verdict, len(r.name)) AS verdict
  FROM parts p JOIN rules r
    ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
  GROUP BY page_id
)
SELECT p.page_id, p.host, p.path, h.rule, coalesce(h.verdict,
  CASE WHEN p.host <> '' AND regexp_matches(p.host || p.path,
    '(^|[^a-z0-9])(spam|cheap[^a-z0-9]+pills|casino|porn|xxx|free[^a-z0-9]+download|payday[^a-z0-9]+loan|(buy|cheap|discount|hot|instant|online|win)[^a-z0-9]+(betting|cialis|escorts|jackpot|loans|poker|replica|slots|steroids|viagra))([^a-z0-9]|$)', 'i')
  THEN 'block' ELSE 'allow' END) AS verdict
FROM parts p LEFT JOIN hits h USING (page_id)
""",
    "op12_collocations": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), words AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces
), starts AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words
), grams AS (
  SELECT lang, array_to_string(w[i : i + k - 1], ' ') AS phrase, k FROM starts, range(1, 6) t(k) WHERE i + k - 1 <= len(w)
), totals AS (
  SELECT lang, count(*) AS n FROM grams WHERE k = 1 GROUP BY lang
), counts AS (
  SELECT lang, phrase, any_value(k) AS k, count(*) AS a FROM grams GROUP BY lang, phrase HAVING count(*) >= 100
), cuts AS (
  SELECT lang, phrase, k, a, cut, array_to_string(string_split(phrase, ' ')[1 : cut], ' ') AS head,
    array_to_string(string_split(phrase, ' ')[cut + 1 : k], ' ') AS rest
  FROM counts, range(1, 5) t(cut) WHERE cut < k
), scores AS (
  SELECT c.lang, c.phrase, c.k, c.a, x.a AS l, y.a AS r, n, c.cut,
    (1000 * c.a::HUGEINT * n::HUGEINT) // (x.a::HUGEINT * y.a::HUGEINT) AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = c.head JOIN counts y ON y.lang = c.lang AND y.phrase = c.rest
    JOIN totals t ON t.lang = c.lang
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, c.cut) = 1
), kept AS (
  SELECT * FROM scores s WHERE NOT EXISTS (
    SELECT 1 FROM counts o WHERE o.lang = s.lang AND o.k > s.k AND o.k > 1 AND 100 * o.a >= 100 * s.a
      AND contains(' ' || o.phrase || ' ', ' ' || s.phrase || ' '))
)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
) WHERE rank <= 2000
""",
}
