"""Spelling variants in SQL: words one letter apart meet in what is left without a letter."""

from __future__ import annotations

from .crc_sql import TABLE, crc32

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

ORACLE = f"""
WITH RECURSIVE {TABLE}, runs AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, '{LETTERS}', '{LETTERS.lower()}'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents
), counted AS (
    SELECT doc_id, run, count(*) AS n FROM runs GROUP BY doc_id, run
), hashed AS (
    SELECT run, n, {crc32("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM counted, crc_table
), slipped AS (
    SELECT CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed
), words AS (
    SELECT word, sum(n)::BIGINT AS n FROM slipped WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), shorter AS (
    SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
), near AS (
    SELECT a.word, b.word AS near, b.n FROM shorter a JOIN shorter b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM shorter a JOIN words b ON a.rest = b.word
    UNION SELECT b.word, a.word, a.n FROM shorter a JOIN words b ON a.rest = b.word
), best AS (
    SELECT word, count(*) AS n_near, max(n) AS form_n, arg_min(near, (-n, near)) AS form FROM near GROUP BY word
), facts AS (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 5 * w.n THEN form END AS form,
        CASE WHEN form_n >= 5 * w.n THEN form_n END AS form_n
    FROM words w LEFT JOIN best b ON b.word = w.word
), climb AS (
    SELECT word, word AS at FROM facts
    UNION ALL SELECT c.word, f.form FROM climb c JOIN facts f ON f.word = c.at WHERE f.form IS NOT NULL
), roots AS (
    SELECT c.word, c.at AS root FROM climb c JOIN facts f ON f.word = c.at WHERE f.form IS NULL
)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n FROM facts f JOIN roots r ON r.word = f.word
"""
