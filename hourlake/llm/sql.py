"""The rows of some registered queries by plain SQL, written independently of the operators."""

from __future__ import annotations

#: A conversation is dropped if its turns, written out, are the first turns of a longer one, or
#: those of an equal one with a smaller id.
CHAT_SQL = """
WITH turns AS (
    SELECT conv_id,
           row_number() OVER (
               PARTITION BY conv_id
               ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST
           ) AS place,
           coalesce('r' || role, 'null') || chr(1) || coalesce('t' || text, 'null') || chr(2) AS exact,
           '<|' || coalesce(role, 'unknown') || '|>' || chr(10) || coalesce(text, '')
               || '<|end|>' || chr(10) AS line
    FROM conversations WHERE conv_id IS NOT NULL
),
whole AS (
    SELECT conv_id, count(*) AS n_turns, string_agg(exact, '' ORDER BY place) AS exact
    FROM turns GROUP BY conv_id
),
beginnings AS (
    SELECT DISTINCT t.place, string_agg(t.exact, '') OVER (
               PARTITION BY t.conv_id ORDER BY t.place
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW
           ) AS exact, w.n_turns
    FROM turns t JOIN whole w USING (conv_id)
),
chosen AS (
    SELECT min(conv_id) AS conv_id, n_turns, count(*) AS n_logged
    FROM whole w
    WHERE NOT EXISTS (
        SELECT 1 FROM beginnings b
        WHERE b.place = w.n_turns AND b.n_turns > w.n_turns AND b.exact = w.exact
    )
    GROUP BY n_turns, exact
)
SELECT conv_id, (place - 1) // 1024 AS part, n_turns, n_logged,
       string_agg(line, '' ORDER BY place) AS rendered
FROM chosen JOIN turns USING (conv_id)
GROUP BY conv_id, part, n_turns, n_logged
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Windows of item words are looked for at every place of every document.
LEAKS_SQL = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents
),
items AS (
    SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM benchmark
),
patterns AS (
    SELECT DISTINCT item_id, n, array_to_string(words[i : i + n - 1], ' ') AS p
    FROM (SELECT *, least(10, len(words)) AS n FROM items WHERE len(words) > 0) w,
         unnest(range(1, len(words) - n + 2)) places(i)
),
places AS (
    SELECT r, i, n, array_to_string(words[i : i + n - 1], ' ') AS p
    FROM docs, (SELECT DISTINCT n FROM patterns) sizes, unnest(range(1, len(words) - n + 2)) places(i)
),
hits AS (SELECT r, i, n, item_id FROM places JOIN patterns USING (n, p)),
covered AS (
    SELECT r, count(DISTINCT w) AS n_hit FROM hits, unnest(range(i, i + n)) words(w) GROUP BY r
),
named AS (
    SELECT r, count(DISTINCT item_id) AS n_items,
           sha256(string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)))
               AS items_sha256
    FROM hits GROUP BY r
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""

#: All pairs with a common shingle are compared; components are what can be reached over links.
NEAR_SQL = rf"""
WITH RECURSIVE texts AS (
    SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS words FROM documents
),
shingles AS (
    SELECT DISTINCT doc_id, unnest(
        CASE WHEN len(words) >= 5
             THEN [array_to_string(words[i : i + 4], ' ') FOR i IN range(1, len(words) - 3)]
             WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS shingle
    FROM texts
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
),
links AS (
    SELECT x, y FROM common JOIN sizes s ON s.doc_id = x JOIN sizes t ON t.doc_id = y
    WHERE 100 * c >= 85 * (s.n + t.n - c)
),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reached(v, other) AS (
    SELECT x, y FROM edges UNION SELECT r.v, e.y FROM reached r JOIN edges e ON r.other = e.x
),
least_reached AS (SELECT v AS doc_id, min(other) AS other FROM reached GROUP BY v)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(other, doc_id)) AS component_id,
       doc_id <= coalesce(other, doc_id) AS kept
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN least_reached USING (doc_id)
"""



QUALITY_RULES_SQL = rf"""
WITH texts AS (
    SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
           [x FOR x IN string_split(coalesce(text, ''), chr(10))
            IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines
    FROM documents
),
windows AS (
    SELECT r, i, count(*) OVER (PARTITION BY r, p) AS times
    FROM (
        SELECT r, i, array_to_string(words[i : i + 7], ' ') AS p
        FROM texts, unnest(range(1, len(words) - 6)) places(i)
    )
),
repeated AS (
    SELECT r, count(DISTINCT w) AS n_repeat_words
    FROM windows, unnest(range(i, i + 8)) words(w) WHERE times > 1 GROUP BY r
),
counts AS (
    SELECT r, doc_id, lang, source, CAST(len(words) AS BIGINT) AS n_words,
           CAST(coalesce(list_sum([length(w) FOR w IN words]), 0) AS BIGINT) AS word_chars,
           length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
           CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
           len(lines) AS n_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
    FROM texts LEFT JOIN repeated USING (r)
),
judged AS (
    SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
           coalesce(n_symbols / nullif(word_chars, 0), 0) AS symbol_ratio,
           coalesce(n_dup_lines / nullif(n_lines, 0), 0) AS dup_line_ratio,
           coalesce(n_repeat_words / nullif(n_words, 0), 0) AS repeat_ratio,
           coalesce(word_chars / nullif(n_words, 0), 0) AS word_length
    FROM counts
),
long AS (
    UNPIVOT judged ON symbol_ratio, dup_line_ratio, repeat_ratio, word_length
    INTO NAME ratio VALUE v
),
bucketed AS (
    SELECT r, lang, source, base_failed, ratio,
           CASE WHEN v >= 0.001 THEN CAST(floor(ln(v / 0.001::DOUBLE) / ln(1.02::DOUBLE)) AS INTEGER) END AS bucket
    FROM long
),
fine AS (
    SELECT lang, source, ratio, bucket, 1000 * count(*) AS w FROM bucketed
    WHERE NOT base_failed AND bucket IS NOT NULL GROUP BY ALL
),
places AS (SELECT DISTINCT lang, source FROM judged WHERE NOT base_failed),
overall AS (
    SELECT ratio, bucket, (200000 * sum(w)) // sum(sum(w)) OVER (PARTITION BY ratio) AS w
    FROM fine GROUP BY ratio, bucket
),
languages AS (
    SELECT lang, ratio, bucket, sum(w) AS w FROM (
        SELECT lang, ratio, bucket, w FROM fine
        UNION ALL SELECT lang, ratio, bucket, w FROM (SELECT DISTINCT lang FROM places), overall
    ) GROUP BY ALL
),
lent AS (
    SELECT lang, ratio, bucket, (200000 * w) // sum(w) OVER (PARTITION BY lang, ratio) AS w FROM languages
),
weights AS (
    SELECT lang, source, ratio, bucket, sum(w) AS w FROM (
        SELECT * FROM fine
        UNION ALL
        SELECT p.lang, p.source, ratio, bucket, w
        FROM places p JOIN lent l ON p.lang IS NOT DISTINCT FROM l.lang
    ) GROUP BY ALL
),
ends AS (
    SELECT lang, source, ratio, min(bucket) FILTER (4 * below >= total) AS low,
           min(bucket) FILTER (4 * below >= 3 * total) AS high
    FROM (
        SELECT *, sum(w) OVER (PARTITION BY lang, source, ratio ORDER BY bucket) AS below,
               sum(w) OVER (PARTITION BY lang, source, ratio) AS total
        FROM weights
    ) GROUP BY lang, source, ratio
),
verdicts AS (
    SELECT r, bool_and(coalesce(bucket <= high + 4 * (high - low + 1)
        AND (b.ratio <> 'word_length' OR bucket >= low - 4 * (high - low + 1)), TRUE)) AS inside
    FROM bucketed b
    LEFT JOIN ends e ON b.ratio = e.ratio AND b.lang IS NOT DISTINCT FROM e.lang
        AND b.source IS NOT DISTINCT FROM e.source
    GROUP BY r
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND inside AS kept
FROM judged JOIN verdicts USING (r)
"""

_WILD = """CASE WHEN {0} IS NULL THEN NULL WHEN {0} = '' THEN ''
    WHEN regexp_full_match({0}, '[0-9]+') THEN '{{n}}' WHEN contains({0}, '.') THEN '*.*' ELSE '*' END"""
_NEAR_SHARES = " AND ".join(
    f"abs({f} / rows - first({f}) OVER size / first(rows) OVER size)"
    " <= 1.3581015157406195::DOUBLE * (1 / sqrt(rows) + 1 / sqrt(first(rows) OVER size))"
    for f in ("ended", "indexed", "numbered", "dotted", "allowed", "blocked")
)


def _level(d: int) -> str:
    """One level of the url tree: urls with more than ``d`` segments get a branch, the others stay."""
    return f"""
children{d} AS (
    SELECT host, node, segments[{d + 1}] AS segment, sum(n) AS c FROM tree{d} WHERE len(segments) > {d} GROUP BY ALL
),
named{d} AS (
    SELECT t.*, CASE WHEN 10 * c >= total + 20 THEN segment ELSE {_WILD.format("segment")} END AS name
    FROM tree{d} t
    JOIN (SELECT *, sum(c) OVER (PARTITION BY host, node) AS total FROM children{d}) s
        ON t.host = s.host AND t.node = s.node AND t.segments[{d + 1}] = s.segment
),
sums{d} AS (
    SELECT host, node, name, sum(n) AS rows, sum(allowed) AS allowed, sum(blocked) AS blocked, max(purity) AS parent,
           coalesce(sum(n) FILTER (following IS NULL), 0) AS ended, coalesce(sum(n) FILTER (following = ''), 0) AS indexed,
           coalesce(sum(n) FILTER (following = '{{n}}'), 0) AS numbered,
           coalesce(sum(n) FILTER (following = '*.*'), 0) AS dotted
    FROM (SELECT *, {_WILD.format(f"segments[{d + 2}]")} AS following FROM named{d}) GROUP BY host, node, name
),
groups{d} AS (
    SELECT *, CASE WHEN {_NEAR_SHARES} THEN '' ELSE '/' || name END AS g FROM sums{d}
    WINDOW size AS (PARTITION BY host, node ORDER BY rows DESC, name ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
),
branches{d} AS (
    SELECT host, node, unnest(names) AS name,
           CASE WHEN len(names) > 1 THEN '(' || array_to_string(names, '|') || ')' ELSE names[1] END AS branch, purity
    FROM (
        SELECT host, node, list(name ORDER BY name) AS names,
               (sum(blocked) + 5 * max(parent)) / (sum(allowed) + sum(blocked) + 5) AS purity
        FROM groups{d} GROUP BY host, node, g
    )
),
tree{d + 1} AS (
    SELECT t.host, t.path, segments, n, allowed, blocked, t.node || '/' || branch AS node, b.purity AS purity
    FROM named{d} t JOIN branches{d} b ON t.host = b.host AND t.node = b.node AND t.name = b.name
    UNION ALL SELECT * FROM tree{d} WHERE len(segments) <= {d}
)"""


#: The template tree of all hosts, level by level.
URL_SQL = rf"""
WITH rules(verdict, host, path) AS (
    VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
           ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
),
parts AS (
    SELECT page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '') AS host,
           coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
    FROM (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages)
),
ruled AS (
    SELECT u.host, u.path, n, arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
           arg_max(r.verdict, length(r.host || r.path)) AS verdict
    FROM (SELECT host, path, count(*) AS n FROM parts GROUP BY ALL) u
    LEFT JOIN rules r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)
    GROUP BY ALL
),
urls AS (
    SELECT host, path, n, CASE WHEN verdict = 'allow' THEN n ELSE 0 END AS allowed,
           CASE WHEN verdict = 'block' THEN n ELSE 0 END AS blocked,
           CASE WHEN len(s) > 5 THEN s[:4] || [array_to_string(s[5:], '/')] ELSE s END AS segments
    FROM (SELECT *, string_split(path, '/')[2:] AS s FROM ruled)
),
overall AS (
    SELECT (sum(blocked) + 5 * 0.5::DOUBLE) / (sum(allowed) + sum(blocked) + 5) AS purity FROM urls
),
hosts AS (
    SELECT host, (sum(blocked) + 5 * max(o.purity)) / (sum(allowed) + sum(blocked) + 5) AS purity
    FROM urls, overall o GROUP BY host
),
tree0 AS (
    SELECT u.host, path, segments, n, allowed, blocked, '' AS node, h.purity FROM urls u JOIN hosts h ON u.host = h.host
),{",".join(map(_level, range(5)))}
SELECT page_id, p.host, p.path, rule,
       coalesce(verdict, CASE WHEN purity > 0.5 THEN 'block' ELSE 'allow' END) AS verdict, node AS template, purity
FROM parts p
JOIN ruled r ON p.host = r.host AND p.path = r.path
JOIN tree5 t ON p.host = t.host AND p.path = t.path
"""

ORACLE_SQL: dict[str, str] = {
    "op1_decontamination": LEAKS_SQL,
    "op5_chat_formatting": CHAT_SQL,
    "op7_minhash_near_dedup": NEAR_SQL,
    "op8_quality_rules": QUALITY_RULES_SQL,
    "op11_url_templates": URL_SQL,
}
