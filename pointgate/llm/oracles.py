"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

OP9_SQL = """
WITH cut AS (
  SELECT doc_id, text, coalesce(source, '') AS site, string_split(text, chr(10)) AS parts FROM documents
), lines AS (
  SELECT doc_id, site, unnest(range(len(parts))) AS place, unnest(parts) AS line FROM cut
), keyed AS (
  SELECT doc_id, site, place, line, trim(line, ' ') AS key, trim(line, ' ') <> '' AS counts FROM lines
), shared AS (
  SELECT key, min({'d': doc_id, 'p': place}) AS first
  FROM keyed WHERE counts GROUP BY key HAVING count(DISTINCT site) >= 5
), marked AS (
  SELECT k.doc_id, k.place, k.line,
         k.counts AND s.key IS NOT NULL AND NOT (s.first.d = k.doc_id AND s.first.p = k.place) AS gone
  FROM keyed k LEFT JOIN shared s ON k.key = s.key AND k.counts
), kept AS (
  SELECT doc_id, count(*) AS n_lines, sum(CASE WHEN gone THEN 1 ELSE 0 END)::BIGINT AS n_removed,
         coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '') AS text
  FROM marked GROUP BY doc_id
)
SELECT c.doc_id, coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_removed, 0) AS n_removed, md5(k.text) AS text_md5
FROM cut c LEFT JOIN kept k ON c.doc_id = k.doc_id
"""

OP13_SQL = """
WITH cut AS (
  SELECT row_number() OVER () AS row, coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), pieces AS (
  SELECT lang, unnest(string_split_regex(text, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM cut
), words AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS w FROM pieces
), runs AS (
  SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2),
         lambda i: array_to_string(list_slice(w, i, i + size - 1), ' '))) AS phrase
  FROM words, range(1, 5) AS s(size) WHERE len(w) >= size
), counted AS (
  SELECT lang, phrase, any_value(size) AS size, count(*) AS f FROM runs GROUP BY lang, phrase
), totals AS (
  SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE size = 1 GROUP BY lang
), candidates AS (
  SELECT lang, phrase, size, f AS a, string_split(phrase, ' ') AS p FROM counted WHERE size >= 2 AND f >= 30
), cuts AS (
  SELECT c.lang, c.phrase, c.size, c.a, k, array_to_string(p[1:k], ' ') AS head, array_to_string(p[k + 1:], ' ') AS tail
  FROM candidates c, range(1, 4) AS r(k) WHERE k < size
), weighed AS (
  SELECT u.lang, u.phrase, u.a, u.k, x.f AS l, y.f AS r,
         ((2000000::HUGEINT * u.a) // (x.f::HUGEINT + y.f::HUGEINT))::BIGINT AS score
  FROM cuts u JOIN counted x ON x.lang = u.lang AND x.phrase = u.head
  JOIN counted y ON y.lang = u.lang AND y.phrase = u.tail
), weakest AS (
  SELECT * FROM weighed QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), covers AS (
  SELECT c.lang, array_to_string(p[i:i + m - 1], ' ') AS phrase, max(a) AS longer
  FROM candidates c, range(2, 4) AS s(m), range(1, 4) AS t(i) WHERE m < size AND i + m - 1 <= size GROUP BY ALL
), kept AS (
  SELECT w.* FROM weakest w LEFT JOIN covers o ON o.lang = w.lang AND o.phrase = w.phrase
  WHERE o.longer IS NULL OR 100::HUGEINT * o.longer < 80::HUGEINT * w.a
)
SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score
FROM kept k JOIN totals t ON t.lang = k.lang
QUALIFY rank <= 2000
"""

OP10_SQL = """
WITH p AS (
  SELECT page_id, row_number() OVER () AS row, coalesce(url, '') AS url, strlen(coalesce(html, ''))::BIGINT AS payload_bytes,
         sha1(coalesce(html, '')) AS digest
  FROM pages
), placed AS (
  SELECT *, row_number() OVER same AS place, first_value(page_id) OVER same AS least
  FROM p WINDOW same AS (PARTITION BY digest ORDER BY page_id NULLS LAST, url, row)
)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (
         (('0x' || substr(digest, 1 + 5 * (i // 4)::INT, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31), 1)), '') AS payload_digest,
       CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN place > 1 THEN least END AS refers_to
FROM placed
"""

_KIND_PATTERNS = {  # in the order in which finds at one place are listed: pattern, group that counts, its least length
    "assign": (
        "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
        "|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)", 2, 6,
    ),
    "access": ("AKIA[A-Z0-9]+", 0, 20),
    "hex": ("[0-9a-f]{24,}", 0, 24),
    "github": ("gh[pousr]_[A-Za-z0-9]+", 0, 40),
    "slack": ("xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    "google": ("AIza[A-Za-z0-9_-]+", 0, 39),
    "stripe": ("[rs]k_live_[A-Za-z0-9]+", 0, 24),
    "jwt": ("eyJ[A-Za-z0-9_-]{8,}[.]eyJ[A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]+", 0, 0),
    "pem": ("-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0),
}

#: A find begins after the texts between finds and the finds before it.
_FINDS = """
  SELECT row, {order} AS kind_order, '{kind}' AS kind, unnest(list_transform(range(1, len(m) + 1), lambda i: {{
           'start': list_sum(list_transform(p[1:i], lambda x: length(x)))
                    + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0),
           'size': length(m[i]), 'counted': length(g[i])}})) AS found, {least} AS least
  FROM (SELECT row, string_split_regex(text, '{pattern}') AS p, regexp_extract_all(text, '{pattern}', 0) AS m,
               regexp_extract_all(text, '{pattern}', {group}) AS g FROM docs WHERE regexp_matches(text, '{pattern}'))
"""

OP11_SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents
), finds AS ({" UNION ALL ".join(
    _FINDS.format(order=k, kind=kind, pattern=pattern, group=group, least=least)
    for k, (kind, (pattern, group, least)) in enumerate(_KIND_PATTERNS.items())
)}), spans AS (
  SELECT row, kind, kind_order, found.start::BIGINT AS start,
         concat_ws(':', kind, found.start::BIGINT, (found.start + found.size)::BIGINT) AS span
  FROM finds WHERE found.counted >= least
), per_row AS (
  SELECT row, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
         count(*) FILTER (WHERE kind = 'hex') AS n_hex,
         string_agg(span, ',' ORDER BY start, kind_order) FILTER (WHERE kind_order < 3) AS base,
         string_agg(span, ',' ORDER BY start, kind_order) AS spans
  FROM spans GROUP BY row
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN per_row USING (row)
"""

_PARTS = ("doc_id", "source", "lang", "n_chars", "{text}")
_LEAF = f"sha256(concat({', '.join(f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in _PARTS)}))"

OP12_SQL = f"""
WITH RECURSIVE docs AS (
  SELECT *, CASE WHEN xor(list_reduce(
           list_concat([4294967295::UBIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT)),
           lambda a, c: list_reduce(list_concat([xor(a, c)], [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]),
                                    lambda b, z: xor(b >> 1, (b & 1) * 3988292384::UBIGINT))
         ), 4294967295::UBIGINT) % 3 = 0
         THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS text_now
  FROM documents
), leaves AS (
  SELECT doc_id, CASE WHEN lang IS NULL THEN '0' ELSE '1' || lang END AS key,
         {_LEAF.format(text="text")} AS leaf, {_LEAF.format(text="text_now")} AS leaf_now FROM docs
), placed AS (
  SELECT *, row_number() OVER () AS row,
         row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY key) AS cnt
  FROM leaves
), nodes AS (
  SELECT key, 0 AS level, idx, cnt, leaf AS hash FROM placed
  UNION ALL
  SELECT key, level + 1, idx // 8, (cnt + 7) // 8, sha256(string_agg(hash, '' ORDER BY idx))
  FROM nodes WHERE cnt > 1 GROUP BY key, level, idx // 8, cnt
), subroots AS (
  SELECT key, hash AS subroot, row_number() OVER (ORDER BY key) - 1 AS idx, count(*) OVER () AS cnt FROM nodes WHERE cnt = 1
), tops AS (
  SELECT 0 AS level, idx, cnt, subroot AS hash FROM subroots
  UNION ALL
  SELECT level + 1, idx // 8, (cnt + 7) // 8, sha256(string_agg(hash, '' ORDER BY idx))
  FROM tops WHERE cnt > 1 GROUP BY level, idx // 8, cnt
), steps AS (
  SELECT row, level AS step, coalesce(string_agg(hash, '' ORDER BY idx) FILTER (WHERE idx < own), '') AS before,
         coalesce(string_agg(hash, '' ORDER BY idx) FILTER (WHERE idx > own), '') AS after
  FROM (
    SELECT p.row, n.level, n.idx, n.hash, p.idx // pow(8, n.level)::BIGINT AS own
    FROM placed p JOIN nodes n ON n.key = p.key AND n.cnt > 1 AND n.idx // 8 = p.idx // pow(8, n.level + 1)::BIGINT
    UNION ALL
    SELECT p.row, 100 + n.level, n.idx, n.hash, s.idx // pow(8, n.level)::BIGINT
    FROM placed p JOIN subroots s ON s.key = p.key
    JOIN tops n ON n.cnt > 1 AND n.idx // 8 = s.idx // pow(8, n.level + 1)::BIGINT
  ) GROUP BY row, level, own
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY row ORDER BY step) AS k FROM steps
), folds AS (
  SELECT row, 0 AS k, leaf_now AS hash FROM placed
  UNION ALL
  SELECT f.row, f.k + 1, sha256(concat(s.before, f.hash, s.after)) FROM folds f JOIN numbered s ON s.row = f.row AND s.k = f.k + 1
), folded AS (
  SELECT row, arg_max(hash, k) AS folded_root FROM folds GROUP BY row
), proofs AS (
  SELECT row, sha256(string_agg(before || after, '' ORDER BY step)) AS proof FROM steps GROUP BY row
)
SELECT p.doc_id, p.leaf, s.subroot, t.hash AS root, coalesce(proof, sha256('')) AS proof_sha256, folded_root,
       folded_root = t.hash AS verified
FROM placed p JOIN subroots s ON s.key = p.key JOIN tops t ON t.cnt = 1
JOIN folded f ON f.row = p.row LEFT JOIN proofs o ON o.row = p.row
"""
