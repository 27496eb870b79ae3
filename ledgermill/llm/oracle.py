"""SQL twins of the queries that SQL can express."""

from __future__ import annotations

OP11_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
split AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM split GROUP BY lang),
starts AS (SELECT lang, w, unnest(generate_series(1, len(w))) AS i FROM split WHERE len(w) > 0),
frequent AS (
  SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, k, count(*)::BIGINT AS f
  FROM starts, (VALUES (1), (2), (3), (4)) AS lengths(k)
  WHERE i + k - 1 <= len(w)
  GROUP BY ALL HAVING count(*) >= 30),
candidates AS (
  SELECT lang, phrase, k AS size, f AS a, string_split(phrase, ' ') AS w FROM frequent WHERE k > 1),
cuts AS (
  SELECT c.lang, c.phrase, c.size, c.a, cut.k, one.f AS l, two.f AS r,
         (2000000::HUGEINT * c.a) // (one.f + two.f) AS score
  FROM candidates c
  JOIN (VALUES (1), (2), (3)) AS cut(k) ON cut.k < c.size
  JOIN frequent one ON one.lang = c.lang AND one.phrase = array_to_string(c.w[1:cut.k], ' ')
  JOIN frequent two ON two.lang = c.lang AND two.phrase = array_to_string(c.w[cut.k + 1:c.size], ' ')),
best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_phrases AS (
  SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, max(a) AS taken
  FROM candidates, (VALUES (2), (3)) AS lengths(k), (VALUES (1), (2), (3)) AS places(i)
  WHERE k < size AND i + k - 1 <= size
  GROUP BY ALL),
kept AS (
  SELECT b.* FROM best b LEFT JOIN inner_phrases p USING (lang, phrase)
  WHERE p.taken IS NULL OR 100 * p.taken < 80 * b.a),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


def _leaf(text: str) -> str:
    told = [
        f"coalesce(octet_length(encode({v}::VARCHAR))::VARCHAR || ':' || {v}::VARCHAR, '-')"
        for v in ("doc_id", "source", "lang", "n_chars", text)
    ]
    return f"sha256({' || '.join(told)})"


OP12_SQL = rf"""
WITH RECURSIVE rows AS (
  SELECT doc_id, source, {_leaf("text")} AS leaf, {_leaf("replace(text, chr(10), '')")} AS other,
    xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
        string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
      lambda acc, x: xor(xor(acc, x) >> 1, (xor(acc, x) & 1) * 3988292384))) AS crc
  FROM documents),
ranked AS (
  SELECT *, row_number() OVER () AS rid,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank
  FROM rows),
tree AS (
  SELECT source, 0 AS level, rank AS pos, leaf AS h, count(*) OVER (PARTITION BY source) AS width FROM ranked
  UNION ALL
  SELECT source, level, pos, h, count(*) OVER (PARTITION BY source) FROM (
    SELECT source, level + 1 AS level, pos // 3 AS pos, sha256(string_agg(h, '' ORDER BY pos)) AS h
    FROM tree WHERE width > 1 GROUP BY source, level, pos // 3)),
tops AS (
  SELECT source, h, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS rank FROM tree WHERE width = 1),
upper_tree AS (
  SELECT 0 AS level, rank AS pos, h, count(*) OVER () AS width FROM tops
  UNION ALL
  SELECT level, pos, h, count(*) OVER () FROM (
    SELECT level + 1 AS level, pos // 3 AS pos, sha256(string_agg(h, '' ORDER BY pos)) AS h
    FROM upper_tree WHERE width > 1 GROUP BY level, pos // 3)),
runs AS (
  SELECT d.rid, t.level, t.pos, t.h, d.rank // (3 ** t.level)::BIGINT AS own
  FROM ranked d JOIN tree t ON t.source IS NOT DISTINCT FROM d.source AND t.width > 1
    AND t.pos // 3 = d.rank // (3 ** (t.level + 1))::BIGINT
  UNION ALL
  SELECT d.rid, 1000 + t.level, t.pos, t.h, s.rank // (3 ** t.level)::BIGINT
  FROM ranked d JOIN tops s ON s.source IS NOT DISTINCT FROM d.source JOIN upper_tree t ON t.width > 1
    AND t.pos // 3 = s.rank // (3 ** (t.level + 1))::BIGINT),
steps AS (
  SELECT rid, level, coalesce(string_agg(h, '' ORDER BY pos) FILTER (pos < own), '') AS before,
         coalesce(string_agg(h, '' ORDER BY pos) FILTER (pos > own), '') AS after
  FROM runs GROUP BY rid, level),
paths AS (
  SELECT rid, list(before || ',' || after ORDER BY level) AS path,
         string_agg(before || after, '' ORDER BY level) AS siblings
  FROM steps GROUP BY rid),
folded AS (
  SELECT d.doc_id, d.leaf, s.h AS subroot, (SELECT h FROM upper_tree WHERE width = 1) AS root,
    sha256(coalesce(p.siblings, '')) AS proof_sha256,
    list_reduce(list_prepend(CASE WHEN crc % 2 = 0 THEN other ELSE leaf END, coalesce(p.path, [])),
      lambda acc, x: sha256(split_part(x, ',', 1) || acc || split_part(x, ',', 2))) AS folded_root
  FROM ranked d JOIN tops s ON s.source IS NOT DISTINCT FROM d.source LEFT JOIN paths p USING (rid))
SELECT *, folded_root = root AS verified FROM folded
"""
