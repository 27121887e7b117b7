"""DuckDB SQL for the queries that SQL can express, written apart from the operators."""

from __future__ import annotations

import re

from .license_scan import PHRASES, step_of
from .licenses import NOTICES

_WS = r"[^\x20\x09-\x0D]+"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP1 = rf"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WS}') AS l FROM documents
), win AS (
  SELECT doc_id, i, md5(array_to_string(list_slice(l, i, i + 34), ' ')) AS h
  FROM (SELECT doc_id, l, unnest(range(1, len(l) - 33)) AS i FROM w)
), again AS (
  SELECT h FROM win GROUP BY h HAVING count(*) > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS pos FROM win SEMI JOIN again USING (h)
), word AS (
  SELECT doc_id, pos, l[pos] AS word FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS pos FROM w)
), kept AS (
  SELECT word.doc_id, count(*) AS n_words, count(g.pos) AS n_removed, string_agg(word, ' ' ORDER BY word.pos) FILTER (WHERE g.pos IS NULL) AS kept
  FROM word LEFT JOIN gone g ON word.doc_id = g.doc_id AND word.pos = g.pos GROUP BY word.doc_id
)
SELECT w.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id
"""

OP2 = rf"""
WITH parts AS (
  SELECT page_id, url,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{_UP}', '{_LOW}') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), rules(verdict, rule, rhost, rpath) AS (
  VALUES ('block', 'com/en/', 'com', '/en/'), ('allow', 'example.com/en/7', 'example.com', '/en/7'),
         ('allow', 'net/de/', 'net', '/de/'), ('block', 'example.net/de/8', 'example.net', '/de/8'),
         ('block', 'org/es/', 'org', '/es/')
), fit AS (
  SELECT page_id, url, host, path, r.rule, r.verdict,
         row_number() OVER (PARTITION BY page_id, url ORDER BY length(r.rule) DESC) AS n
  FROM parts JOIN rules r ON (host = r.rhost OR ends_with(host, '.' || r.rhost)) AND starts_with(path, r.rpath)
), pattern AS (
  SELECT page_id, url, host, path, lower(host || path) AS low, host || path AS place FROM parts
)
SELECT p.page_id, p.host, p.path, f.rule,
       CASE
         WHEN regexp_matches(p.place, '(?:^|\.)(?:ads|adserver)\.[^/]+') AND list_contains(regexp_extract_all(p.low, '[a-z0-9]+'), 'ads') THEN 'ad-server'
         WHEN regexp_matches(p.place, '(?:^|\.)adserver\.[^/]+') THEN 'ad-server-host'
         WHEN regexp_matches(p.place, '/banner/') THEN 'banner-path'
         WHEN regexp_matches(p.place, '(?:^|[./-])casino(?:[./-]|$)') THEN 'casino'
         WHEN regexp_matches(p.place, '(?:^|[./-])porn(?:[./-]|$)') THEN 'porn'
         WHEN regexp_matches(p.place, '/login(?:\.[a-z]+)?/?$') THEN 'login-page'
       END AS pattern_rule,
       coalesce(f.verdict, CASE WHEN pattern_rule IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM pattern p LEFT JOIN fit f ON f.page_id = p.page_id AND f.url = p.url AND f.n = 1
"""


OP8 = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '{_ALNUM}') AS l FROM documents
), b AS (
  SELECT item_id, l, least(8, len(l)) AS k
  FROM (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '{_ALNUM}') AS l FROM benchmark)
  WHERE len(l) > 0
), win AS (
  SELECT DISTINCT item_id, k, array_to_string(list_slice(l, i, i + k - 1), ' ') AS w
  FROM (SELECT item_id, l, k, unnest(range(1, len(l) - k + 2)) AS i FROM b)
), place AS (
  SELECT doc_id, k, i, array_to_string(list_slice(l, i, i + k - 1), ' ') AS w
  FROM (SELECT doc_id, l, k, unnest(range(1, len(l) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM win) ks WHERE len(l) >= k)
), found AS (
  SELECT p.doc_id, p.k, p.i, w.item_id FROM place p JOIN win w ON p.k = w.k AND p.w = w.w
), hit AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS pos FROM found) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.l) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_items, 0) >= 2 AS contaminated
FROM d LEFT JOIN hit ON d.doc_id = hit.doc_id LEFT JOIN items ON d.doc_id = items.doc_id
"""

def _op4(threshold: float = 0.8) -> str:
    """Blocks, notices and phrases of license_scan with its defaults."""
    low = f"translate(coalesce(text, ''), '{_UP}', '{_LOW}')"
    at = lambda phrase: " AND ".join(f"l[i + {k}] = '{w}'" if k else f"l[i] = '{w}'" for k, w in enumerate(phrase.split()))
    places = ", ".join(f"list_filter(range(1, len(l) + 1), lambda i: {at(p)}) AS p{n}" for n, (p, _) in enumerate(PHRASES))
    base = "[" + ", ".join(f"CASE WHEN len(p{n}) > 0 THEN '{label}' END" for n, (_, label) in enumerate(PHRASES)) + "]"
    every = "p0"
    for n in range(1, len(PHRASES)):
        every = f"list_concat({every}, p{n})"
    rows = []
    for text, label in NOTICES:
        words = re.findall(r"[a-z0-9]+", text.lower())
        tokens = list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))
        need = next(k for k in range(1, len(tokens) + 1) if k >= threshold * len(tokens) - 1e-9)
        rows.append(f"('{label}', {step_of(len(words))}, [{', '.join(map(repr, tokens))}], {need})")
    pairs = "list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])"
    return rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({low}, '{_ALNUM}') AS l FROM documents
), phrase AS (
  SELECT doc_id, l, {places} FROM d
), based AS (
  SELECT doc_id, len(l) AS n_words, {every} AS places, list_filter({base}, lambda x: x IS NOT NULL) AS base FROM phrase
), template(label, step, tokens, need) AS (
  VALUES {", ".join(rows)}
), block AS (
  SELECT doc_id, step, list_distinct({pairs}) AS b
  FROM (SELECT doc_id, step, list_slice(l, k + 1, k + 2 * step) AS w
        FROM (SELECT doc_id, l, step, unnest(range(0, len(l), step)) AS k FROM d, (SELECT DISTINCT step FROM template) s))
), met AS (
  SELECT doc_id, label, max(c / CAST(m AS DOUBLE)) AS containment
  FROM (SELECT doc_id, label, need, len(list_intersect(b, tokens)) AS c, len(tokens) AS m FROM block JOIN template USING (step)) WHERE c >= need GROUP BY doc_id, label
), own AS (
  SELECT doc_id, list(label) AS found, max(containment) AS score FROM met GROUP BY doc_id
)
SELECT b.doc_id, CAST(b.n_words AS BIGINT) AS n_words, CAST(len(places) AS BIGINT) AS n_base,
       CAST(list_min(places) - 1 AS BIGINT) AS first_word, CAST(list_max(places) - 1 AS BIGINT) AS last_word,
       array_to_string(list_sort(base), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(base, coalesce(found, [])))), ',') AS labels,
       CASE WHEN len(places) > 0 THEN 1.0::DOUBLE ELSE coalesce(o.score, 0.0::DOUBLE) END AS score
FROM based b LEFT JOIN own o ON o.doc_id = b.doc_id
"""


OP6 = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '{_WS}') AS l FROM documents
), sh AS (
  SELECT DISTINCT doc_id, l[i] || ' ' || l[i + 1] AS s FROM (SELECT doc_id, l, unnest(range(1, len(l))) AS i FROM d WHERE len(l) >= 2)
  UNION ALL SELECT doc_id, l[1] FROM d WHERE len(l) = 1
), n AS (
  SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id
), common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY x.doc_id, y.doc_id
), link AS (
  SELECT a, b FROM common JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 80 * (na.n + nb.n - c)
), both_ways AS (
  SELECT a, b FROM link UNION ALL SELECT b, a FROM link
), reach(doc_id, other) AS (
  SELECT a, b FROM both_ways
  UNION
  SELECT r.doc_id, e.b FROM reach r JOIN both_ways e ON r.other = e.a
), comp AS (
  SELECT doc_id, min(other) AS low FROM reach GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(c.low, d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(c.low, d.doc_id)) AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN comp c ON c.doc_id = d.doc_id
"""

_FINITE = "len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0"

#: Brute force; the search is approximate, and finds all of these at the sizes of the SQL check.
OP7 = rf"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings WHERE embedding IS NOT NULL AND {_FINITE}
), n AS (
  SELECT vec_id, e, sqrt(list_reduce(list_transform(e, lambda x: x * x), lambda a, b: a + b)) AS len FROM v
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_reduce(list_transform(list_zip(q.e, c.e), lambda x: x[1] * x[2]), lambda a, b: a + b) / (c.len * q.len) AS score
  FROM n q JOIN n c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

OP9 = rf"""
WITH lines AS (
  SELECT doc_id, pos, l[pos] AS line,
         translate(regexp_replace(regexp_replace(l[pos], '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''), '{_UP}', '{_LOW}') AS k
  FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS pos FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))
), common AS (
  SELECT k, max(doc_id) AS keeper FROM lines WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3
), judged AS (
  SELECT l.doc_id, l.pos, l.line, c.k IS NOT NULL AND l.doc_id <> c.keeper AS dropped
  FROM lines l LEFT JOIN common c ON l.k = c.k
)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN dropped THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


def _op10(rounds: int = 6) -> str:
    """Targets are settled in rounds: in each, sources over their cap get it and leave."""
    steps = [
        """r0 AS (SELECT source, n, CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0 ELSE 1.0 END AS w,
             2.0::DOUBLE * n AS cap, NULL::DOUBLE AS target FROM src)"""
    ]
    for i in range(rounds):
        steps.append(
            f"""f{i} AS (SELECT coalesce(sum(w) FILTER (WHERE target IS NULL), 1) AS each, 1.5::DOUBLE * sum(n) - coalesce(sum(cap) FILTER (WHERE target IS NOT NULL), 0) AS rest FROM r{i}),
        r{i + 1} AS (SELECT source, n, w, cap, CASE WHEN target IS NULL AND rest * w / each > cap THEN cap ELSE target END AS target FROM r{i}, f{i})"""
        )
    steps.append(
        f"""f{rounds} AS (SELECT coalesce(sum(w) FILTER (WHERE target IS NULL), 1) AS each, 1.5::DOUBLE * sum(n) - coalesce(sum(cap) FILTER (WHERE target IS NOT NULL), 0) AS rest FROM r{rounds}),
        goal AS (SELECT source, n, coalesce(target, rest * w / each) AS target FROM r{rounds}, f{rounds})"""
    )
    return rf"""
WITH docs AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{_WS}')) AS BIGINT) AS size,
         coalesce(CAST(doc_id AS VARCHAR), '') AS tie,
         (CAST(('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), text, '')), 1, 12)) AS BIGINT) + 0.5::DOUBLE) / 281474976710656.0::DOUBLE AS u
  FROM documents
), src AS (SELECT source, CAST(sum(size) AS BIGINT) AS n FROM docs GROUP BY source),
{", ".join(steps)},
plan AS (
  SELECT source, n, target, CASE WHEN n > 0 THEN CAST(floor(target / n) AS INTEGER) ELSE 0 END AS whole,
         target - CASE WHEN n > 0 THEN floor(target / n) ELSE 0 END * n AS want FROM goal
), ranked AS (
  SELECT d.*, p.n AS source_size, p.target, p.whole, p.want,
         CASE WHEN size > 0 THEN u / (1 - u) / (size / (size + 100.0::DOUBLE)) END AS q
  FROM docs d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source
), ladder AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY q NULLS LAST, tie) AS cum FROM ranked
), cut AS (
  SELECT source, min(gap) AS gap FROM (
    SELECT source, abs(cum - want) AS gap FROM ladder UNION ALL SELECT source, want FROM plan) GROUP BY source
), stop AS (
  SELECT l.source, CASE WHEN min(l.want) <= min(c.gap) THEN 0 ELSE min(cum) FILTER (WHERE abs(cum - l.want) = c.gap) END AS upto
  FROM ladder l JOIN cut c ON l.source IS NOT DISTINCT FROM c.source GROUP BY l.source
)
SELECT l.doc_id, l.size, l.source_size, l.target,
       CAST(l.whole + CASE WHEN l.q IS NOT NULL AND l.want > 0 AND l.cum <= a.upto THEN 1 ELSE 0 END AS INTEGER) AS copies,
       CAST((l.whole + CASE WHEN l.q IS NOT NULL AND l.want > 0 AND l.cum <= a.upto THEN 1 ELSE 0 END) * l.size AS BIGINT) AS taken
FROM ladder l JOIN stop a ON l.source IS NOT DISTINCT FROM a.source
"""


OP4 = _op4()
OP10 = _op10()


def oracle_sql() -> dict[str, str]:
    return {"op1_substring_dedup": OP1, "op2_url_filters": OP2, "op4_license_scan": OP4, "op6_near_dedup": OP6, "op7_vector_search": OP7, "op8_decontamination": OP8, "op9_line_dedup": OP9, "op10_mixing": OP10}
