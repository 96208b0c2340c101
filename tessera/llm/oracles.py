"""DuckDB SQL of the operators that SQL can express over whole tables: brute force, without the operators' methods."""

from __future__ import annotations

import string

from . import decontaminate, urlfilter

_WORD = r"[^\x20\x09-\x0D]+"
_LOWERED = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# Every pair of equal tokens votes for the offset at which it lies; offsets with enough votes are judged window by window.
_TOKENS = r"list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '')"
OP1 = f"""
WITH d AS (SELECT doc_id, {_TOKENS} AS t FROM documents), i AS (SELECT item_id, {_TOKENS} AS t FROM benchmark WHERE item_id IS NOT NULL),
  dt AS (SELECT doc_id, unnest(t) AS w, generate_subscripts(t, 1) AS p FROM d), it AS (SELECT item_id, unnest(t) AS w, generate_subscripts(t, 1) AS p FROM i),
  votes AS (SELECT doc_id, item_id, dt.p - it.p AS o, list(it.p) AS hit FROM dt JOIN it USING (w) GROUP BY ALL),
  laid AS (SELECT v.doc_id, v.item_id, v.hit, len(i.t) AS n, least(len(i.t), {decontaminate.WINDOW}) AS wide, greatest(1, 1 - o) AS low, least(len(i.t), len(d.t) - o) AS high
    FROM votes v JOIN i USING (item_id) JOIN d USING (doc_id) WHERE len(hit) * {decontaminate.SHARE[1]} >= least(len(i.t), {decontaminate.WINDOW}) * {decontaminate.SHARE[0]}),
  judged AS (SELECT doc_id, item_id, n, wide, list_max(list_transform(generate_series(low, high - wide + 1), lambda s: len(list_filter(hit, lambda p: p >= s AND p < s + wide)))) AS best FROM laid WHERE high - low + 1 >= wide)
SELECT doc_id, item_id, CAST(max(n) AS INT) AS n_item_tokens, CAST(max(best) AS INT) AS n_agreeing FROM judged WHERE best * {decontaminate.SHARE[1]} >= wide * {decontaminate.SHARE[0]} GROUP BY 1, 2
"""

_RULES = " UNION ALL ".join(f"SELECT {_quoted(r.name)} AS rule, {_quoted(r.verdict)} AS verdict, {_quoted(r.pattern)} AS pattern, {r.length} AS length, {i} AS place" for i, r in enumerate((*urlfilter.DOMAINS, *urlfilter.PATTERNS)))
OP4 = f"""
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN regexp_replace(url, '(?s)^.*?://', '') ELSE '' END AS rest FROM pages),
  h AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM u),
  p AS (SELECT page_id, translate(raw, '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS host, path FROM h),
  m AS (SELECT page_id, r.*, row_number() OVER (PARTITION BY page_id ORDER BY length > 0 DESC, length DESC, verdict = 'block' DESC, place) AS k FROM p JOIN ({_RULES}) r ON regexp_matches(p.host || p.path, '^(?:' || r.pattern || ')') AND p.host || p.path <> '')
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, CASE WHEN length > 0 THEN rule END AS rule, coalesce(verdict, 'allow') AS verdict, CASE WHEN length = 0 THEN rule END AS pattern FROM p LEFT JOIN (FROM m WHERE k = 1) USING (page_id)
"""

OP7 = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWERED}, '{_WORD}') AS w FROM documents),
  s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_transform(generate_series(1, len(w) - 2), lambda i: array_to_string(w[i:i + 2], ' ')) END) AS s FROM w),
  e AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
  links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id AND a.n * 100 >= b.n * 90 AND b.n * 100 >= a.n * 90 GROUP BY 1, 2 HAVING count(*) * 100 >= (min(a.n) + min(b.n) - count(*)) * 90),
  reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(m, s.doc_id)) AS component_id FROM s LEFT JOIN (SELECT a, min(b) AS m FROM reach GROUP BY 1) r ON r.a = s.doc_id
"""

OP9 = f"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
  g AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS h FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 34)) AS i FROM w WHERE len(w) >= 35)),
  twice AS (SELECT doc_id, i FROM g WHERE h IN (SELECT h FROM g GROUP BY 1 HAVING count(*) > 1)),
  gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 34)) AS p FROM twice),
  words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM w),
  kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (doc_id)
"""

SQL = {"op1_decontamination": OP1, "op4_url_filter": OP4, "op7_jaccard_join": OP7, "op9_substring_dedup": OP9}
