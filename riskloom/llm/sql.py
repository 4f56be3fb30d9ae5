"""SQL twins of registered queries (DuckDB): plain recursive definitions, by other means than the operators."""

# CRC-32 of a short ASCII string: a table of 256 remainders, then one step per byte
CRC = """crc_table AS (
  SELECT list_transform(range(256), lambda n: list_reduce([1, 2, 3, 4, 5, 6, 7, 8], lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, n)) AS t
)"""


def crc(text: str) -> str:
    """The unsigned checksum of an SQL string expression, with ``crc_table`` in scope."""
    codes = f"list_transform(regexp_extract_all({text}, '.'), lambda ch: CAST(ascii(ch) AS BIGINT))"
    return f"xor(list_reduce({codes}, lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1]), 4294967295), 4294967295)"


REPAIR = f"""
WITH RECURSIVE {CRC},
fated AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS told, coalesce(text, ' ') AS said,
    {crc("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS fate
  FROM conversations, crc_table
),
damaged AS (
  SELECT conv_id, turn, told, CASE WHEN fate = 4 THEN 'user' ELSE told END AS role, copy,
    CASE WHEN fate = 1 THEN '' WHEN fate = 2 THEN regexp_replace(said, '[.!?]', '', 'g') ELSE said END AS text
  FROM fated, (VALUES (0), (1)) c(copy) WHERE fate <> 0 AND (copy = 0 OR fate = 3)
),
placed AS (
  SELECT *, row_number() OVER w AS i, lag(role) OVER w AS before, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS trimmed
  FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, told, text, copy)
),
judged AS (
  SELECT *, trimmed = '' AS blank,
    trimmed <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again
  FROM placed
),
coded AS (
  SELECT *, NOT blank AND NOT again AND right(trimmed, 1) NOT IN ('.', '!', '?') AS cut, left(role, 1) AS initial,
    i > 1 AND (left(before, 1) || left(role, 1)) NOT IN ('su', 'ua', 'au') AS illegal
  FROM judged
),
-- inserts between two turns: state from, state to, letters, their text
gap(f, t, letters, body) AS (
  VALUES (0, 0, '', ''), (1, 1, '', ''), (2, 2, '', ''), (3, 3, '', ''),
    (0, 2, 'I', chr(10) || 'user:'), (1, 2, 'I', chr(10) || 'user:'), (3, 2, 'I', chr(10) || 'user:'), (2, 3, 'I', chr(10) || 'assistant:'),
    (0, 3, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'), (1, 3, 'II', chr(10) || 'user:' || chr(10) || 'assistant:')
),
edits AS (
  SELECT conv_id, i, f, t, letter, price, body FROM (
    SELECT conv_id, i, s AS f, s AS t, 'D' AS letter, 2 AS price, '' AS body FROM coded, (VALUES (0), (1), (2), (3)) v(s)
    UNION ALL
    SELECT conv_id, i, f, t, 'K', CASE WHEN cut THEN 5 ELSE 0 END, chr(10) || role || ':' || text
    FROM coded JOIN (VALUES ('s', 0, 1), ('u', 0, 2), ('u', 1, 2), ('u', 3, 2), ('a', 2, 3)) k(initial, f, t) USING (initial) WHERE NOT blank AND NOT again
    UNION ALL
    SELECT conv_id, i, f, t, 'R', CASE WHEN cut THEN 6 ELSE 1 END, chr(10) || name || ':' || text
    FROM coded, (VALUES (0, 2, 'user'), (1, 2, 'user'), (3, 2, 'user'), (2, 3, 'assistant')) k(f, t, name) WHERE NOT blank AND NOT again
  )
),
walk AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, 0 AS state, 0 AS cost, '' AS audit, '' AS body FROM (SELECT DISTINCT conv_id FROM placed)
  UNION ALL
  SELECT conv_id, i, state, cost, audit, body FROM (
    SELECT w.conv_id, e.i, e.t AS state, w.cost + 5 * length(g.letters) + e.price AS cost, w.audit || g.letters || e.letter AS audit, w.body || g.body || e.body AS body,
      row_number() OVER (PARTITION BY w.conv_id, e.t ORDER BY w.cost + 5 * length(g.letters) + e.price, w.audit || g.letters || e.letter) AS place
    FROM walk w JOIN gap g ON g.f = w.state JOIN edits e ON e.conv_id IS NOT DISTINCT FROM w.conv_id AND e.i = w.i + 1 AND e.f = g.t
  ) WHERE place = 1
),
ends AS (
  SELECT w.conv_id, w.cost + 5 * length(g.letters) AS cost, w.audit || g.letters AS audit, w.body || g.body AS body
  FROM walk w JOIN gap g ON g.f = w.state AND g.t IN (0, 3)
  JOIN (SELECT conv_id, max(i) AS n FROM placed GROUP BY conv_id) m ON m.conv_id IS NOT DISTINCT FROM w.conv_id AND m.n = w.i
  QUALIFY row_number() OVER (PARTITION BY w.conv_id ORDER BY w.cost + 5 * length(g.letters), w.audit || g.letters) = 1
),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (again) AS duplicate,
    count(*) FILTER (cut) AS truncated, count(*) FILTER (illegal) AS illegal
  FROM coded GROUP BY conv_id
)
SELECT c.conv_id, CAST(coalesce(n.gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(n.blank, 0) AS BIGINT) AS blank, CAST(coalesce(n.duplicate, 0) AS BIGINT) AS duplicate,
  CAST(coalesce(n.truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(n.illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(e.cost, 0) AS BIGINT) AS cost,
  coalesce(e.audit, '') AS audit, sha256(coalesce(substr(e.body, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN counts n ON n.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM c.conv_id
"""


def _field(name: str, value: str | None = None) -> str:
    text = f"CAST({value or name} AS VARCHAR)"
    return f"CASE WHEN {name} IS NULL THEN '-' ELSE CAST(strlen({text}) AS VARCHAR) || ':' || {text} END"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join([_field("doc_id"), _field("source"), _field("lang"), _field("n_chars", n_chars), _field("text")]) + ")"


def _levels(name: str, start: str) -> str:
    """All levels of the trees that start with rows (tree, level, i, h, n)."""
    return f"""{name} AS (
  {start}
  UNION ALL
  SELECT tree, level + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (n + 1) // 2 FROM {name} WHERE n > 1 GROUP BY tree, level, i // 2, n
)"""


def _climb(name: str, start: str, nodes: str) -> str:
    """From rows (row, tree, level, i, sibs, h, old) up the levels of their trees: siblings met and the folded digest."""
    return f"""{name} AS (
  {start}
  UNION ALL
  SELECT c.row, c.tree, c.level + 1, c.i // 2, c.sibs || coalesce(s.h, ''), CASE WHEN s.h IS NULL THEN sha256(c.h) WHEN s.i < c.i THEN sha256(s.h || c.h) ELSE sha256(c.h || s.h) END
  FROM {name} c JOIN (SELECT tree, max(level) AS height FROM {nodes} GROUP BY tree) t ON t.tree = c.tree AND c.level < t.height
  LEFT JOIN {nodes} s ON s.tree = c.tree AND s.level = c.level AND s.i = xor(c.i, 1)
)"""


MANIFEST = f"""
WITH RECURSIVE {CRC},
leaves AS (
  SELECT row_number() OVER () AS row, doc_id, CASE WHEN lang IS NULL THEN '' ELSE '=' || lang END AS tree, {_leaf("n_chars")} AS leaf,
    CASE WHEN n_chars IS NOT NULL AND {crc("CAST(doc_id AS VARCHAR)")} % 7 = 0 THEN {_leaf("n_chars + 1")} END AS changed
  FROM documents, crc_table
),
placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n FROM leaves),
{_levels("nodes", "SELECT tree, 0 AS level, i, leaf AS h, n FROM placed")},
langs AS (SELECT tree, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1),
{_levels("tops", "SELECT '' AS tree, 0 AS level, i, subroot AS h, n FROM langs")},
{_climb("up", "SELECT row, tree, 0 AS level, i, '' AS sibs, coalesce(changed, leaf) AS h FROM placed", "nodes")},
{_climb("over", "SELECT u.row, '' AS tree, 0 AS level, l.i, u.sibs, u.h FROM up u JOIN langs l USING (tree) JOIN (SELECT tree, max(level) AS level FROM nodes GROUP BY tree) m USING (tree, level)", "tops")}
SELECT p.doc_id, p.leaf, l.subroot, r.h AS root, sha256(o.sibs) AS proof_sha256, o.h AS folded_root, o.h = r.h AS verified
FROM placed p JOIN langs l USING (tree) CROSS JOIN (SELECT h FROM tops WHERE n = 1) r
JOIN over o ON o.row = p.row AND o.level = (SELECT max(level) FROM tops)
"""


# The tables' pages share one layout, whose article element SQL can cut out; other layouts are in the tests.
MAIN_TEXT = r"""
WITH cut AS (SELECT row_number() OVER () AS row, page_id, url, regexp_split_to_array(regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1), '</?(?:h1|p)>') AS parts FROM pages),
blocks AS (SELECT row, page_id, url, unnest(parts) AS part, generate_subscripts(parts, 1) AS i FROM cut),
decoded AS (SELECT row, page_id, url, i, regexp_replace(replace(regexp_replace(part, '<[^>]*>', ' ', 'g'), '&quot;', '"'), '&amp;?', '&', 'g') AS part FROM blocks),
plain AS (SELECT row, page_id, url, i, trim(regexp_replace(part, '\s+', ' ', 'g')) AS part FROM decoded),
joined AS (SELECT row, page_id, url, coalesce(string_agg(part, chr(10) ORDER BY i) FILTER (part <> ''), '') AS text FROM plain GROUP BY row, page_id, url)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM joined
"""
