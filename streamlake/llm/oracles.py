"""DuckDB SQL for the queries that SQL can express.

The others (token ids, packing, sharding, certified cutoffs, trained models) are held against
brute-force versions, exact round trips or held-out accuracy in tests/llm.
"""

from __future__ import annotations

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BLANK = "' ' || chr(9) || chr(11) || chr(12) || chr(13)"

# Lines within one edit agree on one half, laid out for their own length or one less.
LINES = f"""
WITH lines AS (
  SELECT doc_id, k, l[k] AS line, trim(l[k], {_BLANK}) <> '' AS written
  FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL),
       LATERAL (SELECT unnest(range(1, len(l) + 1)) AS k)),
firsts AS (
  SELECT line, row_number() OVER (ORDER BY doc, k) AS place, doc, k, length(line) AS n
  FROM (SELECT line, min(doc_id) AS doc, arg_min(k, (doc_id, k)) AS k FROM lines WHERE written GROUP BY line)),
halves AS (
  SELECT line, place, n, m, left(line, m // 2) AS part, 'head' AS side FROM firsts, (VALUES (0), (1)) d(less), LATERAL (SELECT n - less AS m) WHERE n >= 16
  UNION ALL
  SELECT line, place, n, m, right(line, m - m // 2), 'tail' FROM firsts, (VALUES (0), (1)) d(less), LATERAL (SELECT n - less AS m) WHERE n >= 16),
pairs AS (
  SELECT DISTINCT a.place AS early, b.place AS late,
         CASE WHEN a.n <= b.n THEN a.line ELSE b.line END AS s, CASE WHEN a.n <= b.n THEN b.line ELSE a.line END AS t
  FROM halves a JOIN halves b ON a.m = b.m AND a.side = b.side AND a.part = b.part AND a.place < b.place AND abs(a.n - b.n) <= 1),
near AS (
  SELECT DISTINCT late FROM pairs
  WHERE list_bool_or([left(s, i) = left(t, i)
                      AND substr(s, CAST(i + 1 + CAST(length(s) = length(t) AS INTEGER) AS BIGINT)) = substr(t, CAST(i + 2 AS BIGINT))
                      FOR i IN range(0, length(s) + 1)])),
judged AS (
  SELECT l.doc_id, l.k, l.line, l.written,
         l.written AND (l.doc_id <> f.doc OR l.k <> f.k OR f.place IN (SELECT late FROM near)) AS gone
  FROM lines l LEFT JOIN firsts f ON l.written AND l.line = f.line),
kept AS (
  SELECT doc_id, count(*) FILTER (WHERE written) AS n_lines, count(*) FILTER (WHERE coalesce(gone, false)) AS n_removed,
         string_agg(line, chr(10) ORDER BY k) FILTER (WHERE NOT coalesce(gone, false)) AS rest
  FROM judged GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
       CASE WHEN d.text IS NULL THEN NULL WHEN n_removed = 0 THEN d.text WHEN n_removed = n_lines THEN '' ELSE rest END AS text
FROM documents d LEFT JOIN kept USING (doc_id)"""

_WORDS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
CONTAMINATION = f"""
WITH item_words AS (SELECT item_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, w[i : i + least(10, len(w)) - 1] AS phrase
  FROM item_words, LATERAL (SELECT unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i) WHERE len(w) > 0),
doc_words AS (SELECT doc_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS w FROM documents),
places AS (
  SELECT doc_id, i, n, w[i : i + n - 1] AS phrase
  FROM doc_words, (SELECT DISTINCT n FROM windows), LATERAL (SELECT unnest(range(1, len(w) - n + 2)) AS i)),
found AS (SELECT doc_id, i, p.n, item_id FROM places p JOIN windows USING (phrase)),
hits AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM found, LATERAL (SELECT unnest(range(i, i + n)) AS place) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS named
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(named, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE doc_words AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, w[i : i + 4] AS s
  FROM doc_words, LATERAL (SELECT unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i) WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM common JOIN sizes p ON x = p.doc_id JOIN sizes q ON y = q.doc_id
  WHERE 100 * c >= 75 * (p.n + q.n - c)),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
components AS (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM components LEFT JOIN sizes USING (doc_id)"""

REVISITS = """
WITH payloads AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest FROM pages),
firsts AS (SELECT payload_digest, min(page_id) AS original FROM payloads GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> original THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> original THEN original END AS refers_to
FROM payloads JOIN firsts USING (payload_digest)"""



def _merkle(levels: int = 13, source_levels: int = 9) -> str:
    """The tree level by level, up to 3**levels leaves a source and 3**source_levels sources.
    ``nodes`` are the tree's, ``docs`` each document's fold and siblings so far."""
    field = "CASE WHEN {0} IS NULL THEN '-' ELSE octet_length(encode(CAST({0} AS VARCHAR))) || ':' || CAST({0} AS VARCHAR) END"
    fields = [field.format(c) for c in ("doc_id", "source", "lang", "n_chars")]
    leaf = "sha256(" + " || ".join([*fields, field.format("{0}")]) + ")"
    # CRC-32 of the decimal doc_id bit by bit, without the last inversion; that makes its last bit 1 where 2 divides it.
    bits = "flatten([[CAST(ascii(c) AS UBIGINT), 0, 0, 0, 0, 0, 0, 0] FOR c IN string_split(CAST(doc_id AS VARCHAR), '')])"
    crc = f"list_reduce(list_prepend(CAST(4294967295 AS UBIGINT), {bits}), lambda c, b: xor(xor(c, b) >> 1, (xor(c, b) & 1) * 3988292384))"
    parts = [
        f"""base AS MATERIALIZED (
  SELECT *, {leaf.format("text")} AS leaf,
         CASE WHEN doc_id IS NOT NULL AND {crc} & 1 = 1 THEN {leaf.format("replace(text, chr(10), '')")} ELSE {leaf.format("text")} END AS changed
  FROM documents)""",
        """d0 AS MATERIALIZED (
  SELECT doc_id, leaf, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, changed AS fold, '' AS proof,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n
  FROM base)""",
        "n0 AS MATERIALIZED (SELECT tree, pos, n, leaf AS digest FROM d0)",
    ]
    top = levels + source_levels
    for k in range(top):
        parts += [
            f"r{k} AS MATERIALIZED (SELECT tree, pos // 3 AS pos, n, list(digest ORDER BY pos) AS kids FROM n{k} GROUP BY tree, pos // 3, n)",
            f"""n{k + 1}_ AS MATERIALIZED (
  SELECT tree, pos, (n + 2) // 3 AS n, CASE WHEN n = 1 THEN kids[1] ELSE sha256(array_to_string(kids, '')) END AS digest FROM r{k})""",
            f"""d{k + 1}_ AS MATERIALIZED (
  SELECT d.* EXCLUDE (fold, proof, pos, n), r.pos, (d.n + 2) // 3 AS n,
         CASE WHEN d.n = 1 THEN fold ELSE sha256(array_to_string(kids[:d.pos % 3], '') || fold || array_to_string(kids[d.pos % 3 + 2:], '')) END AS fold,
         CASE WHEN d.n = 1 THEN proof ELSE proof || array_to_string(kids[:d.pos % 3], '') || array_to_string(kids[d.pos % 3 + 2:], '') END AS proof
  FROM d{k} d JOIN r{k} r ON d.tree = r.tree AND d.pos // 3 = r.pos)""",
        ]
        if k + 1 == levels:  # the subroots are the leaves of the last tree
            parts += [
                f"n{k + 1} AS MATERIALIZED (SELECT 0 AS tree, tree AS pos, count(*) OVER () AS n, digest FROM n{k + 1}_)",
                f"""d{k + 1} AS MATERIALIZED (
  SELECT doc_id, leaf, n.digest AS subroot, fold, proof, 0 AS tree, d.tree AS pos, (SELECT count(*) FROM n{k + 1}_) AS n
  FROM d{k + 1}_ d JOIN n{k + 1}_ n ON d.tree = n.tree)""",
            ]
        else:
            parts += [f"{x}{k + 1} AS (SELECT * FROM {x}{k + 1}_)" for x in "nd"]
    return f"""WITH {", ".join(parts)}
SELECT doc_id, leaf, subroot, (SELECT digest FROM n{top}) AS root, sha256(proof) AS proof_sha256, fold AS folded_root,
       fold = (SELECT digest FROM n{top}) AS verified
FROM d{top}"""


ORACLES: dict[str, str] = {
    "op2_line_dedup": LINES,
    "op3_decontamination": CONTAMINATION,
    "op8_minhash": NEAR_DUPLICATES,
    "op10_warc": REVISITS,
    "op12_merkle": _merkle(),
}
