"""The manifest of ``documents`` in SQL: trees level by level, folded from the leaves up."""

from __future__ import annotations

from .crc_sql import TABLE, crc32


def field(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR) || ':' || {value}, '-')"


def leaf(text: str) -> str:
    return "sha256(concat(" + ", ".join([*map(field, ("doc_id", "source", "lang", "n_chars")), field(text)]) + "))"


LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = f"translate(text, '{LETTERS}', '{LETTERS.lower()}')"


def levels(name: str, nodes: str) -> str:
    """Nodes of all levels, and the children's digests of each run."""
    return f"""
{name} AS (
    SELECT 0 AS level, tree, pos, digest, n FROM {nodes}
    UNION ALL
    SELECT level + 1, tree, pos // 16, sha256(string_agg(digest, '' ORDER BY pos)), any_value((n + 15) // 16)
    FROM {name} WHERE n > 1 GROUP BY level, tree, pos // 16
), {name}_runs AS (
    SELECT level, tree, pos // 16 AS run, list(digest ORDER BY pos) AS kids FROM {name} WHERE n > 1 GROUP BY level, tree, pos // 16
)"""


def climb(name: str, start: str, above: str) -> str:
    """From rows ``id, tree, pos, digest, proof`` up to the root of each tree."""
    return f"""
{name} AS (
    SELECT id, 0 AS level, tree, pos, digest, proof FROM {start}
    UNION ALL
    SELECT id, c.level + 1, c.tree, pos // 16,
        sha256(array_to_string(kids[:pos % 16] || [digest] || kids[pos % 16 + 2:], '')),
        proof || array_to_string(kids[:pos % 16] || kids[pos % 16 + 2:], '')
    FROM {name} c JOIN {above}_runs r ON r.level = c.level AND r.tree = c.tree AND r.run = c.pos // 16
)"""


ORACLE = f"""
WITH RECURSIVE {TABLE}, leaves AS (
    SELECT *, row_number() OVER (ORDER BY tree, pos) AS id FROM (
        SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n
        FROM (
            SELECT doc_id, {leaf("text")} AS digest, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
                CASE WHEN {crc32("doc_id::VARCHAR")} % 5 = 0 THEN {leaf(LOWER)} ELSE {leaf("text")} END AS shown
            FROM documents, crc_table
        )
    )
), {levels("below", "leaves")}, tops AS (
    SELECT 0 AS tree, tree AS pos, digest, count(*) OVER () AS n FROM below WHERE n = 1
), {levels("above", "tops")}, shown AS (
    SELECT id, tree, pos, shown AS digest, '' AS proof FROM leaves
), {climb("climbed", "shown", "below")}, halfway AS (
    SELECT id, 0 AS tree, tree AS pos, digest, proof FROM climbed c
    WHERE level = (SELECT max(level) FROM below b WHERE b.tree = c.tree)
), {climb("risen", "halfway", "above")}, folded AS (
    SELECT * FROM risen WHERE level = (SELECT max(level) FROM above)
)
SELECT l.doc_id, l.digest AS leaf, t.digest AS subroot, r.digest AS root, sha256(f.proof) AS proof_sha256,
    f.digest AS folded_root, f.digest = r.digest AS verified
FROM leaves l JOIN folded f ON f.id = l.id JOIN tops t ON t.pos = l.tree JOIN (SELECT digest FROM above WHERE n = 1) r ON true
"""
