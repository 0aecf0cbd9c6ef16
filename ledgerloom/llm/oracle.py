"""SQL for the same rows, where SQL can express them at a bearable cost."""

from __future__ import annotations

OP7_EXACT_DEDUP = """
WITH texts AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
groups AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM texts GROUP BY body)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256
FROM texts JOIN groups USING (body)
"""

OP5_DECONTAMINATE = r"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
starts AS (
  SELECT item_id, w, least(len(w), 10) AS k, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM items WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM starts),
lengths AS (SELECT DISTINCT k FROM windows),
places AS (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM split, lengths WHERE len(w) >= k),
found AS (
  SELECT doc_id, i, p.k, item_id FROM places p JOIN windows v ON v.k = p.k AND v.phrase = array_to_string(w[i:i + p.k - 1], ' ')),
hit AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS pos FROM found) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM split LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

# crc32 of an id is taken bit by bit: list_reduce over its digits, eight steps each.
OP12_PREFIX_TRIE = r"""
WITH turns AS (
  SELECT conv_id, list({r: coalesce(role, ''), t: coalesce(text, '')}
                       ORDER BY turn NULLS FIRST, sha256(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, ''))) AS own
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
crc AS (
  SELECT conv_id, own, (4294967295 - list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), [CAST(ascii(c) AS BIGINT) FOR c IN string_split(CAST(conv_id AS VARCHAR), '')]),
    lambda s, b: list_reduce(list_prepend(xor(s, b), CAST(range(8) AS BIGINT[])),
      lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END))) % 6 AS h
  FROM turns),
rebuilt AS (
  SELECT a.conv_id, list_concat(coalesce(b.own[1:a.h], []), a.own[a.h + 1:]) AS path
  FROM crc a LEFT JOIN turns b ON b.conv_id = a.conv_id - a.conv_id % 100),
numbered AS (SELECT turn, row_number() OVER () AS id FROM (SELECT DISTINCT unnest(path) AS turn FROM rebuilt)),
steps AS (
  SELECT conv_id, len(path) AS n, unnest(path) AS turn, generate_subscripts(path, 1) AS d FROM rebuilt),
paths AS (
  SELECT r.conv_id, len(r.path) AS n, coalesce(p.ids, CAST([] AS BIGINT[])) AS ids, r.path
  FROM rebuilt r LEFT JOIN (
    SELECT conv_id, list(id ORDER BY d) AS ids FROM steps JOIN numbered USING (turn) GROUP BY conv_id) p USING (conv_id)),
members AS (SELECT conv_id, n, ids, path, unnest(range(0, n + 1)) AS d FROM paths),
nodes AS (
  SELECT ids[1:d] AS node, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * length(first(path[d].t)) END AS saved,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE n = d), '')) AS ends_sha256
  FROM members GROUP BY ids[1:d], d),
children AS (SELECT node[1:depth - 1] AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
full_ AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (node)),
below AS (SELECT node[1:e] AS node, n_children, saved FROM (SELECT *, unnest(range(0, depth + 1)) AS e FROM full_)),
sums AS (SELECT node, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(saved) AS saved_tokens FROM below GROUP BY node)
SELECT f.conv_id, f.depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children,
       CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, f.ends_sha256
FROM full_ f JOIN sums USING (node) LEFT JOIN full_ p ON f.depth > 0 AND p.node = f.node[1:f.depth - 1]
"""


def llm_oracles() -> dict[str, str]:
    return {
        "op5_decontaminate": OP5_DECONTAMINATE,
        "op7_exact_dedup": OP7_EXACT_DEDUP,
        "op12_prefix_trie": OP12_PREFIX_TRIE,
    }
