"""Checking SQL (DuckDB) of the corpus queries that SQL can express."""

from __future__ import annotations

# crc32 of texts: a table of 256 remainders by the rule, then a fold over the bytes.
CRC_TABLE = """
crc_bits AS (
    SELECT k, 0 AS i, k AS c FROM range(256) t(k)
    UNION ALL
    SELECT k, i + 1, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END FROM crc_bits WHERE i < 8),
crc_table AS (SELECT list(c ORDER BY k) AS remainders FROM crc_bits WHERE i = 8)"""


def crc32(text: str) -> str:
    """An expression for the unsigned crc32 of a text; needs ``crc_table`` in FROM."""
    octets = f"list_transform(range(1, strlen({text}) + 1), lambda i: ('0x' || substr(hex(encode({text})), 2 * i - 1, 2))::BIGINT)"
    return f"xor(4294967295, list_reduce({octets}, lambda c, b: xor(c // 256, remainders[xor(c, b) % 256 + 1]), 4294967295::BIGINT))"


def _leaf(n_chars: str) -> str:
    fields = ["doc_id::VARCHAR", "source", "lang", f"({n_chars})::VARCHAR", "text"]
    return "sha256(" + " || ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields) + ")"


MERKLE = f"""
WITH RECURSIVE {CRC_TABLE},
leaves AS (
    SELECT doc_id, lang, {_leaf("n_chars")} AS leaf, {_leaf("n_chars + 1")} AS other,
        {crc32("doc_id::VARCHAR")} % 7 = 0 AS tampered
    FROM documents, crc_table),
ranked AS (
    SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
        row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
    FROM leaves),
levels AS (
    SELECT tree, 0 AS level, pos, leaf AS digest FROM ranked
    UNION ALL
    SELECT tree, level + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos))
    FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS width FROM levels) WHERE width > 1 GROUP BY tree, level, pos // 2),
subroots AS (SELECT tree, max(level) AS height, arg_max(digest, level) AS subroot FROM levels GROUP BY tree),
tops AS (
    SELECT 0 AS level, tree AS pos, subroot AS digest FROM subroots
    UNION ALL
    SELECT level + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos))
    FROM (SELECT *, count(*) OVER () AS width FROM tops) WHERE width > 1 GROUP BY level, pos // 2),
root AS (SELECT max(level) AS top, arg_max(digest, level) AS root FROM tops),
steps AS (
    SELECT r.tree, r.pos, g.level AS step, (r.pos >> g.level) % 2 AS side, l.digest AS sibling
    FROM ranked r JOIN subroots s USING (tree) JOIN range(64) g(level) ON g.level < s.height
    LEFT JOIN levels l ON l.tree = r.tree AND l.level = g.level AND l.pos = xor(r.pos >> g.level, 1)
    UNION ALL
    SELECT r.tree, r.pos, s.height + g.level, (r.tree >> g.level) % 2, t.digest
    FROM ranked r JOIN subroots s USING (tree) CROSS JOIN root JOIN range(64) g(level) ON g.level < root.top
    LEFT JOIN tops t ON t.level = g.level AND t.pos = xor(r.tree >> g.level, 1)),
paths AS (
    SELECT tree, pos, string_agg(sibling, '' ORDER BY step) AS siblings,
        list({{'side': side, 'sibling': coalesce(sibling, '')}} ORDER BY step) AS steps
    FROM steps GROUP BY tree, pos),
folded AS (
    SELECT tree, pos, 1 AS step, CASE WHEN tampered THEN other ELSE leaf END AS digest FROM ranked
    UNION ALL
    SELECT f.tree, f.pos, f.step + 1,
        sha256(CASE WHEN steps[f.step].side = 1 THEN steps[f.step].sibling || digest ELSE digest || steps[f.step].sibling END)
    FROM folded f JOIN paths p USING (tree, pos) WHERE f.step <= len(p.steps)),
ends AS (SELECT tree, pos, arg_max(digest, step) AS folded_root FROM folded GROUP BY tree, pos)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(siblings, '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM ranked JOIN subroots USING (tree) CROSS JOIN root LEFT JOIN paths USING (tree, pos) JOIN ends USING (tree, pos)
"""

SPELLING = f"""
WITH RECURSIVE {CRC_TABLE},
runs AS (
    SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents) GROUP BY ALL),
hashed AS (
    SELECT run, n, {crc32("(coalesce(doc_id::VARCHAR, '') || ':' || run)")} AS h
    FROM (SELECT * FROM runs WHERE length(run) >= 7), crc_table),
words AS (
    SELECT word, sum(n)::BIGINT AS n
    FROM (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed)
    WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
shorter AS (
    SELECT word, n, i, CASE WHEN i = 0 THEN word ELSE substr(word, 1, i - 1) || substr(word, i + 1) END AS part
    FROM words, LATERAL (SELECT unnest(range(length(word) + 1)) AS i)),
near AS (
    SELECT DISTINCT a.word, a.n, b.word AS near, b.n AS near_n FROM shorter a JOIN shorter b USING (part)
    WHERE a.word <> b.word AND (a.i = b.i OR a.i = 0 OR b.i = 0)),
best AS (
    SELECT word, count(*) AS n_near, arg_min(near, (-near_n, near)) AS near, max(near_n) AS near_n FROM near GROUP BY word),
forms AS (
    SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 10 * n THEN near END AS form, CASE WHEN near_n >= 10 * n THEN near_n END AS form_n
    FROM words LEFT JOIN best USING (word)),
walk AS (
    SELECT word, word AS here, 0 AS steps FROM forms
    UNION ALL
    SELECT w.word, f.form, steps + 1 FROM walk w JOIN forms f ON f.word = w.here WHERE f.form IS NOT NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN (SELECT word, arg_max(here, steps) AS root FROM walk GROUP BY word) USING (word)
"""

ORACLES: dict[str, str] = {"op12_merkle_manifest": MERKLE, "op13_spelling_variants": SPELLING}
