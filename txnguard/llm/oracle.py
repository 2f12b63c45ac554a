"""DuckDB SQL of the text queries that SQL can express, on the same tables."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _field(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", text))) + ")"


#: crc32 of the decimal doc_id: for each byte eight shifts, with the reversed polynomial where a one falls out.
_CRC32 = """xor(list_reduce(list_prepend(4294967295::UBIGINT,
        list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::UBIGINT)),
    lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0::UBIGINT for i in range(8)]),
        lambda x, z: xor(x >> 1, (x & 1) * 3988292384::UBIGINT))), 4294967295::UBIGINT)"""


def _tree(name: str, leaves: str) -> str:
    """Levels of all trees: nodes (tree, lvl, pos, h, n), and for each node its siblings to the left and right."""
    return f"""
{name} AS (
    {leaves}
    UNION ALL
    SELECT tree, lvl + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), CAST(any_value((n + 7) // 8) AS BIGINT)
    FROM {name} WHERE n > 1 GROUP BY tree, lvl, pos // 8),
{name}_sides AS (
    SELECT u.tree, u.lvl, u.pos, coalesce(string_agg(v.h, '' ORDER BY v.pos) FILTER (v.pos < u.pos), '') AS l,
           coalesce(string_agg(v.h, '' ORDER BY v.pos) FILTER (v.pos > u.pos), '') AS r
    FROM {name} u JOIN {name} v ON u.tree = v.tree AND u.lvl = v.lvl AND u.pos // 8 = v.pos // 8
    WHERE u.n > 1 GROUP BY u.tree, u.lvl, u.pos)"""


OP11 = f"""
WITH RECURSIVE leaves AS (
    SELECT doc_id, coalesce('=' || lang, '') AS tree, {_leaf("text")} AS leaf,
           CASE WHEN {_CRC32} % 3 = 0 THEN {_leaf(f"translate(text, '{_UPPER}', '{_LOWER}')")}
                ELSE {_leaf("text")} END AS claimed
    FROM documents),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
{_tree("inner_tree", "SELECT tree, 0 AS lvl, pos, leaf AS h, count(*) OVER (PARTITION BY tree) AS n FROM placed")},
subroots AS (
    SELECT tree AS name, h, row_number() OVER (ORDER BY tree) - 1 AS pos FROM inner_tree WHERE n = 1),
{_tree("top_tree", "SELECT '' AS tree, 0 AS lvl, pos, h, count(*) OVER () AS n FROM subroots")},
way AS (
    SELECT p.tree, p.pos, s.lvl AS step, s.l, s.r FROM placed p
    JOIN inner_tree_sides s ON s.tree = p.tree AND s.pos = p.pos // CAST(8 ** s.lvl AS BIGINT)
    UNION ALL
    SELECT p.tree, p.pos, 100 + s.lvl, s.l, s.r FROM placed p JOIN subroots t ON t.name = p.tree
    JOIN top_tree_sides s ON s.pos = t.pos // CAST(8 ** s.lvl AS BIGINT)),
ways AS (
    SELECT tree, pos, sha256(string_agg(l || r, '' ORDER BY step)) AS proof, list(l || '|' || r ORDER BY step) AS steps
    FROM way GROUP BY tree, pos),
folded AS (
    SELECT p.doc_id, p.leaf, s.h AS subroot, (SELECT h FROM top_tree WHERE n = 1) AS root,
           coalesce(w.proof, sha256('')) AS proof_sha256,
           list_reduce(list_prepend(p.claimed, coalesce(w.steps, [])),
                       lambda h, x: sha256(split_part(x, '|', 1) || h || split_part(x, '|', 2))) AS folded_root
    FROM placed p JOIN subroots s ON s.name = p.tree LEFT JOIN ways w ON w.tree = p.tree AND w.pos = p.pos)
SELECT *, folded_root = root AS verified FROM folded
"""

_TERMS = (f"regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), "
          r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")

OP12 = f"""
WITH tokens AS (
    SELECT doc, doc_id, unnest({_TERMS}) AS term
    FROM (SELECT doc_id, text, row_number() OVER () AS doc FROM documents)),
sizes AS (SELECT doc, any_value(doc_id) AS doc_id, count(*) AS n FROM tokens GROUP BY doc),
totals AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM sizes),
tf AS (SELECT doc, term, count(*) AS tf FROM tokens GROUP BY doc, term),
weights AS (
    SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM tf, totals GROUP BY term),
asked AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark)),
scores AS (
    SELECT item_id, doc, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms)))) AS BIGINT) AS score
    FROM asked JOIN tf USING (term) JOIN weights USING (term) JOIN sizes USING (doc), totals
    GROUP BY item_id, doc, doc_id),
ranked AS (
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST, doc) AS INTEGER) AS rank,
           doc_id, score FROM scores WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 10
"""

OP13 = """
WITH RECURSIVE usable AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE label IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
      ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reach AS (
    SELECT a, b FROM links
    UNION
    SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(c.n, 0) AS n_links, coalesce(least(l.b, e.vec_id), e.vec_id) AS component_id,
       coalesce(least(l.b, e.vec_id), e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN counts c ON c.a = e.vec_id LEFT JOIN least l ON l.a = e.vec_id
"""
