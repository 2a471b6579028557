"""The same questions in DuckDB SQL, where SQL can express them."""

from cohortloom.llm.line_dedup import MIN_SITES

LINE_DEDUP = f"""
WITH lines AS (
  SELECT doc_id, source, trim(u.line) AS line
  FROM documents, unnest(string_split(coalesce(text, ''), chr(10))) AS u(line)
), flagged AS (
  SELECT line, min(doc_id) AS first_doc
  FROM lines WHERE line <> ''
  GROUP BY line HAVING count(DISTINCT coalesce(source, '')) >= {MIN_SITES}
), parts AS (
  SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS nth,
         unnest(string_split(text, chr(10))) AS line
  FROM documents
), marked AS (
  SELECT p.doc_id, p.nth, p.line, f.line IS NOT NULL AS gone
  FROM parts p LEFT JOIN flagged f ON trim(p.line) = f.line AND p.doc_id <> f.first_doc
), kept AS (
  SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed,
         coalesce(string_agg(line, chr(10) ORDER BY nth) FILTER (WHERE NOT gone), '') AS text
  FROM marked GROUP BY doc_id
)"""

STREAM_DEDUP = r"""
WITH texts AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER best = 1 AS kept, text_sha256
FROM texts
WINDOW best AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id NULLS LAST)"""

def crc32_sql(text: str) -> str:
    """Unsigned crc32 of an ASCII text, bit by bit."""
    bits = "list_reduce([0, 1, 2, 3, 4, 5, 6, 7], lambda c, i: xor(c >> 1, 3988292384 * (c & 1)), xor(a, b))"
    letters = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)"
    return f"xor(list_reduce({letters}, lambda a, b: {bits}, 4294967295::BIGINT), 4294967295)"


def _leaf_sql(n_chars: str) -> str:
    values = ("doc_id", "source", "lang", n_chars, "text")
    parts = [f"coalesce(strlen(({v})::VARCHAR) || ':' || ({v})::VARCHAR, '-')" for v in values]
    return f"sha256({' || '.join(parts)})"


MERKLE = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, {_leaf_sql("n_chars")} AS leaf,
         CASE WHEN doc_id IS NOT NULL AND {crc32_sql("doc_id::VARCHAR")} % 7 = 0
              THEN {_leaf_sql("n_chars + 1")} END AS replacement
  FROM documents
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY tree) AS n
  FROM leaves
), lower AS (
  SELECT tree, 0 AS level, pos, n, leaf AS h FROM placed
  UNION ALL
  SELECT tree, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos))
  FROM lower WHERE n > 1 GROUP BY tree, level, pos // 2, n
), subroots AS (
  SELECT tree, h AS subroot, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos, count(*) OVER () AS n
  FROM lower WHERE n = 1
), upper AS (
  SELECT 0 AS level, pos, n, subroot AS h FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos))
  FROM upper WHERE n > 1 GROUP BY level, pos // 2, n
), steps AS (
  -- Of every leaf, level by level: the place of its ancestor, and the other digest of its run if there is one.
  SELECT p.tree, p.pos AS leaf_pos, l.level, (p.pos >> l.level) & 1 AS slot, o.h AS other
  FROM placed p
  JOIN (SELECT DISTINCT tree, level FROM lower WHERE n > 1) l ON p.tree = l.tree
  LEFT JOIN lower o ON o.tree = p.tree AND o.level = l.level AND o.pos = xor(p.pos >> l.level, 1)
  UNION ALL
  SELECT p.tree, p.pos, 1000 + l.level, (s.pos >> l.level) & 1, o.h
  FROM placed p
  JOIN subroots s ON p.tree = s.tree
  CROSS JOIN (SELECT DISTINCT level FROM upper WHERE n > 1) l
  LEFT JOIN upper o ON o.level = l.level AND o.pos = xor(s.pos >> l.level, 1)
), lines AS (
  SELECT tree, leaf_pos, sha256(coalesce(string_agg(other, '' ORDER BY level), '')) AS proof_sha256,
         list({{'slot': slot, 'other': coalesce(other, '')}} ORDER BY level) AS line
  FROM steps GROUP BY tree, leaf_pos
), folded AS (
  SELECT p.*, coalesce(l.proof_sha256, sha256('')) AS proof_sha256, coalesce(l.line, []) AS line, 0 AS done,
         coalesce(p.replacement, p.leaf) AS h
  FROM placed p LEFT JOIN lines l ON l.tree = p.tree AND l.leaf_pos = p.pos
  UNION ALL
  SELECT * REPLACE (done + 1 AS done,
    sha256(CASE WHEN line[done + 1].slot = 0 THEN h || line[done + 1].other ELSE line[done + 1].other || h END) AS h)
  FROM folded WHERE done < len(line)
)
SELECT f.doc_id, f.leaf, s.subroot, r.h AS root, f.proof_sha256, f.h AS folded_root, f.h = r.h AS verified
FROM folded f JOIN subroots s ON f.tree = s.tree CROSS JOIN (SELECT h FROM upper WHERE n = 1) r
WHERE f.done = len(f.line)"""

TRIE = rf"""
WITH turns AS (
  SELECT conv_id AS conv, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS place
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv, conv - conv % 20 AS base, {crc32_sql("conv::VARCHAR")} % 4 AS h FROM turns GROUP BY conv
), parts AS (
  SELECT c.conv, t.place AS nth, t.role, t.text FROM convs c JOIN turns t ON t.conv = c.base AND t.place <= c.h
  UNION ALL
  SELECT c.conv, 1000000000 + t.place, t.role, t.text FROM convs c JOIN turns t ON t.conv = c.conv AND t.place > c.h
), rebuilt AS (
  SELECT conv, row_number() OVER (PARTITION BY conv ORDER BY nth) AS depth,
         sha256(strlen(role) || ':' || role || text) AS turn,
         len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words
  FROM parts
), paths AS (
  SELECT conv, depth, words,
         sha256(string_agg(turn, '') OVER (PARTITION BY conv ORDER BY depth)) AS path
  FROM rebuilt
  UNION ALL
  SELECT conv, 0, 0, 'root' FROM convs
), lengths AS (
  SELECT conv, max(depth) AS length FROM paths GROUP BY conv
), nodes AS (
  SELECT depth, path, any_value(words) AS words, min(p.conv) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(p.conv::VARCHAR, ',' ORDER BY p.conv) FILTER (WHERE depth = length), '')) AS ends_sha256
  FROM paths p JOIN lengths l ON p.conv = l.conv GROUP BY depth, path
), edges AS (
  -- A node's ancestors are the nodes of its smallest member.
  SELECT n.depth, n.path, n.n_convs, n.words, a.depth AS above_depth, a.path AS above_path
  FROM nodes n JOIN paths a ON a.conv = n.conv_id AND a.depth <= n.depth
), children AS (
  SELECT above_depth AS depth, above_path AS path, count(*) AS n_children
  FROM edges WHERE above_depth = depth - 1 GROUP BY ALL
), totals AS (
  SELECT e.above_depth AS depth, e.above_path AS path,
         count(*) FILTER (WHERE c.path IS NULL) AS n_leaves, sum((e.n_convs - 1) * e.words)::BIGINT AS saved_tokens
  FROM edges e LEFT JOIN children c ON c.depth = e.depth AND c.path = e.path GROUP BY ALL
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children,
       t.n_leaves, t.saved_tokens, n.ends_sha256
FROM nodes n
JOIN totals t ON t.depth = n.depth AND t.path = n.path
LEFT JOIN children c ON c.depth = n.depth AND c.path = n.path
LEFT JOIN edges e ON e.depth = n.depth AND e.path = n.path AND e.above_depth = n.depth - 1
LEFT JOIN nodes p ON p.depth = e.above_depth AND p.path = e.above_path"""

SQL: dict[str, str] = {
    "op1_line_dedup": LINE_DEDUP
    + """
SELECT doc_id, n_removed, length(text) AS n_chars_left, md5(text) AS left_md5 FROM kept""",
    "op11_merkle_manifest": MERKLE,
    "op12_prefix_trie": TRIE,
    "op13_stream_dedup": STREAM_DEDUP,
}
