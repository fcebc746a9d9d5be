"""The URL filter in DuckDB's SQL, to hold the Spark one against."""

from __future__ import annotations

from collections.abc import Sequence

from .url_templates import ALIKE, ANY, END, MANY, PRIOR, PURITY, SPREAD, Z, Rule, rule_name


def rule_case(rules: Sequence[Rule], value) -> str:
    cases = [
        f"WHEN (host = '{r[0]}' OR ends_with(host, '.{r[0]}')) AND starts_with(path, '{r[1]}') THEN {value(r)}"
        for r in sorted(rules, key=lambda r: (-len(rule_name(r)), r))
    ]
    return f"CASE {' '.join(cases)} END"


def next_level() -> str:
    """The rows of ``t`` that have a segment left, with ``done`` extended by it."""
    sums = "sum(n)::BIGINT AS n, sum(labelled)::BIGINT AS labelled, sum(blocked)::BIGINT AS blocked"
    rate = "(d.ab::DOUBLE / nullif(d.al, 0))"
    return f"""
    WITH e AS (SELECT host, done, segs[lv] AS seg, segs[lv + 1] AS nxt, {sums} FROM t
        WHERE lv <= len(segs) GROUP BY ALL),
    b AS (SELECT host, done, seg, {sums} FROM e GROUP BY ALL),
    d AS (SELECT host, done, sum(n)::BIGINT AS an, sum(labelled)::BIGINT AS al, sum(blocked)::BIGINT AS ab,
        count(*) AS children, sum(n * ln(n)) AS nlogn FROM b GROUP BY ALL),
    f AS (SELECT host, done, coalesce(nxt, '{END}') AS nxt, sum(n)::BIGINT AS pn FROM e GROUP BY ALL),
    o AS (SELECT e.host, e.done, e.seg, sum(least(e.n::DOUBLE / b.n, f.pn::DOUBLE / d.an)) AS overlap
        FROM e JOIN b USING (host, done, seg) JOIN d USING (host, done)
        JOIN f ON f.host = e.host AND f.done = e.done AND f.nxt = coalesce(e.nxt, '{END}') GROUP BY ALL),
    z AS (SELECT b.host, b.done, b.seg, d.children, o.overlap,
            ln(d.an) - d.nlogn / d.an - {SPREAD} * ln(d.children) AS spread,
            b.labelled > 0 AND d.al - b.labelled > 0 AND round(abs(b.blocked::DOUBLE / nullif(b.labelled, 0)
                - (d.ab - b.blocked)::DOUBLE / nullif(d.al - b.labelled, 0)) - {Z} * sqrt({rate} * (1 - {rate})
                * (1.0 / nullif(b.labelled, 0) + 1.0 / nullif(d.al - b.labelled, 0))), 9) > 0 AS differs
        FROM b JOIN d USING (host, done) JOIN o USING (host, done, seg))
    SELECT t.lv + 1, t.host, t.key, t.segs, t.done || '/' || CASE
            WHEN (children >= {MANY} AND round(spread, 9) >= 0)
                OR (children > 1 AND round(overlap, 9) >= {ALIKE} AND NOT coalesce(differs, false)) THEN '{ANY}'
            ELSE t.segs[lv] END, t.n, t.labelled, t.blocked
        FROM t JOIN z ON z.host = t.host AND z.done = t.done AND z.seg = t.segs[t.lv]"""


def oracle(rules: Sequence[Rule]) -> str:
    shape = """CASE WHEN regexp_full_match(s, '[0-9a-fA-F-]{12,}') AND regexp_matches(s, '[0-9]') THEN '{hex}'
        WHEN length(s) > 40 THEN '{long}' ELSE regexp_replace(s, '[0-9]+', '0', 'g') END"""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
    WITH RECURSIVE u AS (SELECT page_id,
            translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{letters}', '{letters.lower()}') AS host,
            coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
    q AS (SELECT *, {rule_case(rules, lambda r: f"'{rule_name(r)}'")} AS rule,
            {rule_case(rules, lambda r: str(r[2]).lower())} AS rule_blocks, string_split(path, '/')[2:] AS parts FROM u),
    p AS (SELECT *, list_transform(parts, lambda s: {shape}) AS segs FROM q),
    k AS (SELECT *, array_to_string(list_prepend('', segs), '/') AS key FROM p),
    t(lv, host, key, segs, done, n, labelled, blocked) AS (
        SELECT 1::BIGINT, host, key, any_value(segs), '', count(*)::BIGINT, count(rule)::BIGINT,
            (count(*) FILTER (WHERE rule_blocks))::BIGINT FROM k GROUP BY host, key
        UNION ALL ({next_level()})),
    x AS (SELECT * FROM t WHERE lv > len(segs)),
    g AS (SELECT coalesce(sum(blocked)::DOUBLE / nullif(sum(labelled), 0), 0.0) AS rate FROM x),
    h AS (SELECT host, (sum(blocked)::DOUBLE + {PRIOR} * (SELECT rate FROM g)) / (sum(labelled)::DOUBLE + {PRIOR}) AS rate
        FROM x GROUP BY host),
    r AS (SELECT host, done, (sum(blocked)::DOUBLE + {PRIOR} * any_value(h.rate)) / (sum(labelled)::DOUBLE + {PRIOR}) AS purity
        FROM x JOIN h USING (host) GROUP BY host, done)
    SELECT page_id, k.host, path, rule, t.done AS template, purity,
        CASE WHEN coalesce(rule_blocks, purity >= {PURITY}) THEN 'block' ELSE 'allow' END AS verdict
    FROM k JOIN x t ON t.host = k.host AND t.key = k.key JOIN r ON r.host = t.host AND r.done = t.done"""
