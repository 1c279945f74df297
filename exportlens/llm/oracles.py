"""DuckDB statements of the operators that SQL expresses; ids are unique and not null in the test tables."""

from __future__ import annotations

import string

from exportlens.llm.licenses import KNOWN, KNOWN_DIGESTS

WORD = r"[^\x20\x09-\x0D]+"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _components(nodes: str, links: str) -> str:
    """CTE comp(node, component) for the links (a, b), both ways, between the nodes (node)."""
    return f"""reach AS (SELECT node AS a, node AS b FROM {nodes}
    UNION SELECT r.a, l.b FROM reach r JOIN {links} l ON r.b = l.a),
  comp AS (SELECT a AS node, min(b) AS component FROM reach GROUP BY a)"""


NEAR_DUPLICATES = f"""WITH RECURSIVE
  words AS (SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '{WORD}') AS w FROM documents),
  sets AS (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) < 4 THEN [array_to_string(w, ' ')] ELSE
    [w[i] || ' ' || w[i+1] || ' ' || w[i+2] || ' ' || w[i+3] for i in range(1, len(w) - 2)] END)) AS s, len(w) = 0 AS bare FROM words),
  docs AS (SELECT doc_id, CASE WHEN bare THEN 0 ELSE len(s) END AS n, s,
    CASE WHEN bare THEN doc_id ELSE min(doc_id) OVER (PARTITION BY bare, s) END AS node FROM sets),
  reps AS (SELECT node, n, s FROM docs WHERE doc_id = node AND n > 0),
  items AS (SELECT node, n, unnest(s) AS item FROM reps),
  pairs AS (SELECT x.node AS a, y.node AS b FROM items x JOIN items y ON x.item = y.item AND x.node <> y.node
    GROUP BY x.node, y.node, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
  {_components("reps", "pairs")}
SELECT doc_id, n::BIGINT AS n_shingles, coalesce(component, doc_id) AS component_id, doc_id = coalesce(component, doc_id) AS kept
FROM docs LEFT JOIN comp USING (node)"""

# The rules of the licence scan, stated again: spellings, titles, and what makes a line a copyright statement.
_SPELLINGS = {
    "licence": "license", "sub license": "sublicense", "non commercial": "noncommercial", "non infringement": "noninfringement",
    "copyright owner": "copyright holder", "organisation": "organization", "favour": "favor", "https": "http", "per cent": "percent",
    "merchantibility": "merchantability", "acknowledgement": "acknowledgment",
}


def _normal(x: str) -> str:
    out = f"trim(regexp_replace(lower({x}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'), ' ')"
    for old, new in _SPELLINGS.items():
        out = f"replace({out}, '{old}', '{new}')"
    return out


_TITLES = ["license", "unlicense", "the unlicense"] + [f"{the}{name}" for the in ("", "the ") for name in (
    "mit license", "mit license mit", "isc license", "bsd license", "zlib license")] + [
    "mit license expat", "isc license isc", "new bsd license", "simplified bsd license", "bsd 2 clause license", "the 2 clause bsd license",
    "bsd 3 clause license", "the 3 clause bsd license", "bsd 3 clause new or revised license", "bsd 2 clause simplified license"]
_STATES = r"""(regexp_matches(lower(x), '^[^a-z0-9©]*(portions )?(copyright|©|\(c\))[^a-z0-9©(]*(\(c\)|©|by\b|[0-9]{4}|<|\[)')
  OR regexp_matches(lower(x), '^[^a-z0-9©]*(©|\(c\)).*\b(19|20)[0-9]{2}\b') OR regexp_matches(lower(x), '^[^a-z0-9]*all rights reserved[^a-z0-9]*$') OR regexp_matches(x, '^[^A-Za-z0-9]*(Portions )?Copyright[ \t]+[A-Z]'))"""

LICENSES = f"""WITH texts AS (SELECT row_number() OVER () AS r, * FROM (
    SELECT doc_id, NULL AS license, coalesce(text, '') AS text FROM documents
    UNION ALL SELECT NULL, * FROM (VALUES {", ".join(f"({_quoted(a)}, {_quoted(b)})" for a, b in KNOWN)}))),
  split AS (SELECT r, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) AS line FROM texts),
  lines AS (SELECT r, line, x, t FROM (SELECT *, {_normal("x")} AS t FROM split)
    WHERE t <> '' AND NOT {_STATES} AND t NOT IN ({", ".join(map(_quoted, _TITLES))})),
  units AS (SELECT r, line, t FROM lines UNION ALL
    SELECT r, 0, {_normal("string_agg(x, ' ' ORDER BY line)")} FROM lines GROUP BY r),
  known AS (SELECT digest, min(license) AS license FROM (
    SELECT sha256(t) AS digest, license FROM units JOIN texts USING (r) WHERE license IS NOT NULL AND line = 0
    UNION ALL SELECT * FROM (VALUES {", ".join(f"('{d}', {_quoted(a)})" for a, _, d in KNOWN_DIGESTS)})) GROUP BY digest)
SELECT doc_id, line::BIGINT AS line, known.license FROM units JOIN texts USING (r) JOIN known ON digest = sha256(t) WHERE texts.license IS NULL"""

EMBEDDINGS = f"""WITH RECURSIVE
  vectors AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
  good AS (SELECT vec_id AS node, label, v FROM vectors WHERE label IS NOT NULL
    AND len([x for x in v if x IS NULL OR NOT isfinite(x)]) = 0 AND len([x for x in v if x <> 0]) > 0),
  links AS (SELECT x.node AS a, y.node AS b FROM good x JOIN good y ON x.label = y.label AND x.node <> y.node
    AND len(x.v) = len(y.v) WHERE list_cosine_similarity(x.v, y.v) >= 0.98),
  {_components("good", "links")}
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(component, vec_id) AS component_id,
  vec_id = coalesce(component, vec_id) AS kept
FROM vectors LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) ON a = vec_id LEFT JOIN comp ON node = vec_id"""

ARCHIVES = f"""WITH records AS (SELECT page_id, strlen(coalesce(html, '')) AS size, sha1(coalesce(html, '')) AS h,
    min(page_id) OVER (PARTITION BY coalesce(html, '')) AS lead FROM pages)
SELECT page_id, size::BIGINT AS payload_bytes, array_to_string([substr('{BASE32}', 1 + (
    (('0x' || substr(h, (1 + (i // 4) * 5)::INT, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31), 1) for i in range(32)], '') AS payload_digest,
  CASE WHEN page_id = lead THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> lead THEN lead END AS refers_to
FROM records"""

LINES = f"""WITH docs AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL),
  split AS (SELECT doc_id, l, unnest(l) AS x, generate_subscripts(l, 1) - 1 AS i FROM docs),
  words AS (SELECT *, len(regexp_extract_all(x, '{WORD}')) >= 50 AS long_i FROM split WHERE regexp_matches(x, '{WORD}')),
  succ AS (SELECT doc_id, l, x, i, long_i, lead(i) OVER d AS j, lead(long_i) OVER d AS long_j,
    coalesce(lead(i, 1) OVER d, len(l)) AS after_i, coalesce(lead(i, 2) OVER d, len(l)) AS after_j
    FROM words WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
  windows AS (SELECT doc_id, i, x AS bytes, [{{'line': i, 'upto': after_i}}] AS ends FROM succ WHERE long_i
    UNION ALL SELECT doc_id, i, array_to_string(l[i + 1 : j + 1], chr(10)), list_concat(
      CASE WHEN NOT long_i THEN [{{'line': i, 'upto': j}}] ELSE [] END, CASE WHEN NOT long_j THEN [{{'line': j, 'upto': after_j}}] ELSE [] END)
    FROM succ WHERE j IS NOT NULL),
  judged AS (SELECT *, row_number() OVER (PARTITION BY bytes ORDER BY doc_id, i) = 1 AS stays, count(*) OVER (PARTITION BY bytes) AS n FROM windows),
  marks AS (SELECT doc_id, stays, unnest(ends) AS e FROM judged WHERE n > 1),
  gone AS (SELECT doc_id, e.line AS line, e.upto AS upto FROM marks GROUP BY ALL HAVING NOT bool_or(stays)),
  runs AS (SELECT doc_id, count(*) FILTER (upto_before IS DISTINCT FROM line) AS n_chunks, sum(upto - line) AS n_gone
    FROM (SELECT *, lag(upto) OVER (PARTITION BY doc_id ORDER BY line) AS upto_before FROM gone) GROUP BY doc_id),
  clean AS (SELECT s.doc_id, string_agg(x, chr(10) ORDER BY i) AS t FROM split s
    WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.doc_id = s.doc_id AND s.i >= g.line AND s.i < g.upto) GROUP BY s.doc_id)
SELECT d.doc_id, coalesce(len(l), 0)::BIGINT AS n_lines, coalesce(n_chunks, 0)::BIGINT AS n_removed_chunks, coalesce(n_gone, 0)::BIGINT AS n_removed_lines,
  sha256(CASE WHEN l IS NOT NULL THEN coalesce(t, '') END) AS clean_sha256
FROM documents d LEFT JOIN docs USING (doc_id) LEFT JOIN runs USING (doc_id) LEFT JOIN clean USING (doc_id)"""

ORACLES = {
    "op2_minhash_near_dedup": NEAR_DUPLICATES,
    "op4_license_scan": LICENSES,
    "op5_embedding_near_dedup": EMBEDDINGS,
    "op6_warc_archive": ARCHIVES,
    "op8_line_dedup": LINES,
}
