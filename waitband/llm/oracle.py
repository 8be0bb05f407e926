"""DuckDB SQL for the operators that SQL can express: line quality (3),
decontamination (6), secret scan (7) and WARC (9).  Written from the contracts,
by other means than the Spark code: exact strings instead of hashes, whole
windows instead of sliding counts."""

from __future__ import annotations

import string

from . import lines, secrets


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def line_quality() -> str:
    word = quoted(r"[^\x20\x09-\x0D]+")
    normal = (r"regexp_replace(regexp_replace(array_to_string(list_filter(string_split_regex(lower(l), '\s+'), lambda x: x <> ''), ' '), '\d', '0', 'g'), "
              r"'^[^\pL\pN]+|[^\pL\pN]+$', '', 'g')")
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS MATERIALIZED (SELECT rid, regexp_extract_all(t, {word}) AS ws FROM d),
base AS (SELECT rid, len(ws) AS n_words, coalesce(list_sum([length(x) for x in ws]), 0) AS word_chars FROM w),
win AS MATERIALIZED (SELECT rid, i, ws[i:i+2] AS g FROM w, unnest(generate_series(1, len(ws) - 2)) AS u(i)),
hot AS (SELECT rid, g FROM win GROUP BY rid, g HAVING count(*) > 1),
rep AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT win.rid, unnest([i, i + 1, i + 2]) AS p FROM win JOIN hot ON win.rid = hot.rid AND win.g = hot.g) GROUP BY rid),
l0 AS MATERIALIZED (SELECT rid, source, t, unnest(string_split(t, chr(10))) AS l FROM d),
l1 AS MATERIALIZED (SELECT *, len(regexp_extract_all(l, {word})) AS k FROM l0 WHERE regexp_matches(l, {word})),
dup AS (SELECT rid, sum(c - 1) AS n FROM (SELECT rid, l, count(*) AS c FROM l1 GROUP BY rid, l) GROUP BY rid),
norm AS MATERIALIZED (SELECT rid, source, t, {normal} AS nl, k FROM l1),
held AS (SELECT source, nl, count(DISTINCT t) AS n FROM norm GROUP BY source, nl),
host AS (SELECT source, greatest({lines.LEAST_DOCS}, floor(count(DISTINCT t) * {lines.SHARE})) AS most FROM d GROUP BY source),
gone AS (SELECT held.source, nl FROM held JOIN host ON held.source IS NOT DISTINCT FROM host.source WHERE n > most),
lost AS (SELECT rid, sum(k) AS n FROM norm JOIN gone ON norm.source IS NOT DISTINCT FROM gone.source AND norm.nl = gone.nl GROUP BY rid),
rows AS (
  SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(dup.n, 0)::BIGINT AS n_dup_lines,
    coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(lost.n, 0)::BIGINT AS n_removed
  FROM d JOIN base USING (rid) LEFT JOIN dup USING (rid) LEFT JOIN rep USING (rid) LEFT JOIN lost USING (rid))
SELECT *, (n_words < {lines.LEAST_WORDS} OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
  (NOT (n_words < {lines.LEAST_WORDS} OR 100 * n_repeat_words > 50 * n_words) AND n_words - n_removed >= n_words * {lines.LEFT}) AS kept
FROM rows
"""


def decontamination() -> str:
    words = (f"regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), "
             r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, {words} AS ws FROM documents),
b AS MATERIALIZED (SELECT item_id, ws, least(10, len(ws)) AS k FROM (SELECT item_id, {words} AS ws FROM benchmark) WHERE len(ws) > 0),
item AS MATERIALIZED (SELECT DISTINCT item_id, k, ws[i:i+k-1] AS g FROM b, unnest(generate_series(1, len(ws) - k + 1)) AS u(i)),
sizes AS (SELECT DISTINCT k FROM item),
win AS (SELECT rid, sizes.k, i, ws[i:i+sizes.k-1] AS g FROM d, sizes, unnest(generate_series(1, len(ws) - sizes.k + 1)) AS u(i)),
hit AS MATERIALIZED (SELECT rid, i, win.k, item_id FROM win JOIN item ON win.k = item.k AND win.g = item.g),
covered AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(generate_series(i, i + k - 1)) AS p FROM hit) GROUP BY rid),
items AS (SELECT rid, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hit GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (rid) LEFT JOIN items USING (rid)
"""


def secret_scan() -> str:
    found = []
    for kind, pattern, keep in (("assign", secrets.ASSIGN, f"length(regexp_extract(hit, {quoted(secrets.ASSIGN)}, 2)) >= {secrets.ASSIGN_LEAST}"),
                                ("access", secrets.ACCESS, "true"), ("hex", secrets.HEX, "true")):
        found.append(f"SELECT rid, {secrets.KINDS.index(kind)} AS kind, s, s + length(hit) AS e FROM ({places(pattern)}) WHERE {keep}")
    w = secrets.WINDOW
    table = "[" + ", ".join(map(str, secrets.weights(w))) + "]"
    anchored = [a for a in secrets.ALLOW if secrets.FROM_START.match(a)]
    inside = quoted("|".join(f"(?:{a})" for a in secrets.ALLOW if a not in anchored))
    before = lambda xs: f"coalesce(list_sum([length(x) for x in {xs}[1:k-1]]), 0)"
    for cls in secrets.CLASSES:
        asked = " AND ".join([f"regexp_matches(hit, {quoted(n)})" for n in cls.needs] + [f"NOT regexp_matches(hit, {quoted(a)})" for a in anchored])
        # what lies between the hits of the other allow-list patterns, each piece by itself
        pieces = f"""SELECT rid, (s + {before('g')} + {before('h')})::BIGINT AS s, g[k] AS hit FROM (
  SELECT rid, s, string_split_regex(hit, {inside}) AS g, regexp_extract_all(hit, {inside}, 0) AS h FROM ({places(cls.pattern)}) WHERE {asked}),
  unnest(generate_series(1, len(g))) AS v(k)"""
        found.append(f"""
SELECT rid, {secrets.KINDS.index('entropy')} AS kind, s + min(i) AS s, s + max(i) + {w} AS e FROM (
  SELECT rid, s, i, map_values(list_histogram(string_split(substr(hit, i + 1, {w}), ''))) AS n
  FROM ({pieces}), unnest(generate_series(0, length(hit) - {w})) AS u(i))
WHERE list_sum([({table})[(c + 1)::BIGINT] for c in n]) <= {secrets.most(w, cls.bits)} GROUP BY rid, s""")
    name = "(" + quoted("") + "".join(f" || CASE WHEN kind = {k} THEN '{n}' ELSE '' END" for k, n in enumerate(secrets.KINDS)) + ")"
    text = f"string_agg({name} || ':' || s || ':' || e, ',' ORDER BY s, kind, e)"
    count = lambda k: f"coalesce(count(*) FILTER (kind = {k}), 0)::BIGINT AS n_{secrets.KINDS[k]}"
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
spans AS MATERIALIZED (SELECT DISTINCT * FROM ({' UNION ALL '.join(found)})),
agg AS (SELECT rid, {count(0)}, {count(1)}, {count(2)}, {text} FILTER (kind < 3) AS base, {text} AS spans FROM spans GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN agg USING (rid)
"""


def places(pattern: str) -> str:
    """(rid, s, hit) of every match: the lengths of all that stands before it."""
    p = quoted(pattern)
    return (f"SELECT rid, h[i] AS hit, (list_sum([length(x) for x in g[1:i]]) + coalesce(list_sum([length(x) for x in h[1:i-1]]), 0))::BIGINT AS s "
            f"FROM (SELECT rid, regexp_extract_all(t, {p}, 0) AS h, string_split_regex(t, {p}) AS g FROM d), unnest(generate_series(1, len(h))) AS u(i)")


def warc() -> str:
    digits = " || ".join(
        f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(x, {5 * g + 1}, 5))::INT >> {s}) & 31) + 1)::INT, 1)" for g in range(8) for s in (15, 10, 5, 0))
    return f"""
WITH p AS MATERIALIZED (SELECT page_id, coalesce(html, '') AS body, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last FROM pages),
h AS (SELECT *, sha1(body) AS x FROM p)
SELECT page_id, strlen(body)::BIGINT AS payload_bytes, {digits} AS payload_digest,
  CASE WHEN last IS NULL OR page_id IS NOT DISTINCT FROM last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN last IS NULL OR page_id IS NOT DISTINCT FROM last THEN NULL ELSE last END AS refers_to
FROM h
"""


ORACLE = {
    "op3_line_quality": line_quality(),
    "op6_winnowing": decontamination(),
    "op7_secrets": secret_scan(),
    "op9_warc": warc(),
}
