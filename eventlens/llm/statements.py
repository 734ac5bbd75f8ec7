"""DuckDB statements of the queries over benchmark items, conversations and manifests."""

from eventlens.llm import decontamination, merkle, prefix_trie

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# CRC-32 of decimal ids by its definition: the table from the reflected polynomial, then a fold.
_CRC = """
steps AS (
  SELECT b AS byte, b AS c, 0 AS k FROM range(256) t(b)
  UNION ALL
  SELECT byte, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8),
lookup AS (SELECT list(c ORDER BY byte) AS crc FROM steps WHERE k = 8)"""


def _crc(decimal: str) -> str:
    """CRC-32 of an integer's decimal text, where ``lookup`` is joined."""
    codes = f"list_transform(string_split({decimal}::VARCHAR, ''), lambda d: ascii(d)::BIGINT)"
    step = "lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295, {codes}), {step}), 4294967295)"


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), '{}', '{}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')".format(_UPPER, _LOWER)

OP11 = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS ws FROM documents),
items AS (
  SELECT coalesce(item_id::VARCHAR, 'null') AS item, ws, least(len(ws), {decontamination.WINDOW}) AS n
  FROM (SELECT item_id, {_WORDS} AS ws FROM benchmark) WHERE len(ws) > 0),
wanted AS (
  SELECT DISTINCT item, n, list_aggregate(ws[i:i+n-1], 'string_agg', ' ') AS w
  FROM (SELECT *, unnest(range(1, len(ws) - n + 2)) AS i FROM items)),
lengths AS (SELECT DISTINCT n FROM items),
places AS (
  SELECT r, i, n, list_aggregate(ws[i:i+n-1], 'string_agg', ' ') AS w
  FROM (SELECT r, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM docs, lengths WHERE len(ws) >= n)),
found AS (SELECT DISTINCT r, i, n, item FROM places JOIN wanted USING (n, w)),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM found) GROUP BY r),
listed AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN listed USING (r)
"""

_BASE_OF = f"conv_id - conv_id % {prefix_trie.BASE_EVERY}"

OP12 = f"""
WITH RECURSIVE {_CRC},
own AS (
  SELECT conv_id, list(struct_pack(role := coalesce(role, ''), said := coalesce(text, '')) ORDER BY turn NULLS FIRST) AS ts
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
cut AS (
  SELECT o.conv_id, o.ts, b.ts AS base, ({_crc('o.conv_id')} % {prefix_trie.HEAD_MODULUS})::BIGINT AS h
  FROM own o CROSS JOIN lookup LEFT JOIN own b ON b.conv_id = o.{_BASE_OF.replace('conv_id %', 'o.conv_id %')}),
rebuilt AS (SELECT conv_id, list_concat(coalesce(base[1:h], []), ts[h+1:]) AS ts FROM cut),
prefixes AS (SELECT conv_id, d, ts[1:d] AS p, len(ts) = d AS ends FROM (SELECT *, unnest(range(0, len(ts) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT d, p, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256,
         CASE WHEN d > 0 THEN (count(*) - 1) * octet_length(encode(p[d].said)) ELSE 0 END AS saved
  FROM prefixes GROUP BY d, p),
kin AS (
  SELECT n.*, u.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes k WHERE k.d = n.d + 1 AND k.p[1:n.d] = n.p) AS n_children
  FROM nodes n LEFT JOIN nodes u ON u.d = n.d - 1 AND u.p = n.p[1:n.d-1]),
sums AS (
  SELECT a.d, a.p, sum(b.saved)::BIGINT AS saved_tokens, count(*) FILTER (b.n_children = 0) AS n_leaves
  FROM kin a JOIN kin b ON b.d >= a.d AND b.p[1:a.d] = a.p GROUP BY a.d, a.p)
SELECT conv_id, kin.d AS depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
FROM kin JOIN sums ON sums.d = kin.d AND sums.p = kin.p
"""


def _field(value: str) -> str:
    return f"coalesce(octet_length(encode(({value})::VARCHAR)) || ':' || ({value})::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return "sha256(concat(" + ", ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + "))"


_N = merkle.FANOUT

# Trees are numbered t: one for each source, and 0 for the sources themselves.
OP13 = f"""
WITH RECURSIVE {_CRC},
docs AS (
  SELECT doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) AS t, {_leaf('text')} AS leaf,
         CASE WHEN {_crc('doc_id')} % {merkle.TAMPER_EVERY} = 0
              THEN {_leaf(f"translate(text, '{_UPPER}', '{_LOWER}')")} ELSE {_leaf('text')} END AS tampered
  FROM documents, lookup),
leaves AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM docs),
low AS (
  SELECT t, 0 AS level, place, leaf AS digest, count(*) OVER (PARTITION BY t) AS n FROM leaves
  UNION ALL
  SELECT t, min(level) + 1, place // {_N}, sha256(string_agg(digest, '' ORDER BY place)), ceil(min(n) / {_N})::BIGINT
  FROM low WHERE n > 1 GROUP BY t, place // {_N}),
subroots AS (SELECT t, digest FROM low WHERE n = 1),
high AS (
  SELECT 0 AS level, t - 1 AS place, digest, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT min(level) + 1, place // {_N}, sha256(string_agg(digest, '' ORDER BY place)), ceil(min(n) / {_N})::BIGINT
  FROM high WHERE n > 1 GROUP BY place // {_N}),
nodes AS (
  SELECT t, level, place, digest, n FROM low
  UNION ALL SELECT 0, level, place, digest, n FROM high),
runs AS (
  SELECT a.t, a.level, a.place, coalesce(string_agg(b.digest, '' ORDER BY b.place) FILTER (b.place < a.place), '') AS lefts,
         coalesce(string_agg(b.digest, '' ORDER BY b.place) FILTER (b.place > a.place), '') AS rights
  FROM nodes a JOIN nodes b ON a.t = b.t AND a.level = b.level AND a.place // {_N} = b.place // {_N}
  WHERE a.n > 1 GROUP BY a.t, a.level, a.place),
heights AS (SELECT t, max(level) AS height FROM nodes GROUP BY t),
walk AS (
  SELECT doc_id, leaf, l.t, l.t AS tree, l.place, 0 AS level, tampered AS node, '' AS siblings, l.place AS origin
  FROM leaves l
  UNION ALL
  SELECT doc_id, leaf, w.t, CASE WHEN w.level = height THEN 0 ELSE tree END,
         CASE WHEN w.level = height THEN w.t - 1 ELSE w.place // {_N} END,
         CASE WHEN w.level = height THEN 0 ELSE w.level + 1 END,
         CASE WHEN w.level = height THEN node ELSE sha256(concat(lefts, node, rights)) END,
         CASE WHEN w.level = height THEN siblings ELSE concat(siblings, lefts, rights) END, origin
  FROM walk w JOIN heights ON heights.t = w.tree LEFT JOIN runs r ON r.t = w.tree AND r.level = w.level AND r.place = w.place
  WHERE w.tree > 0 OR w.level < height),
top AS (SELECT digest AS root FROM high WHERE n = 1)
SELECT doc_id, leaf, s.digest AS subroot, root, sha256(siblings) AS proof_sha256, node AS folded_root, node = root AS verified
FROM walk w JOIN heights h ON h.t = 0 AND w.tree = 0 AND w.level = h.height JOIN subroots s ON s.t = w.t CROSS JOIN top
"""
