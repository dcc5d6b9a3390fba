"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from tripyard.llm import license_index

_URL = """
SELECT page_id,
       CASE WHEN strpos(url, '://') > 0
            THEN translate(regexp_extract(substr(url, strpos(url, '://') + 3), '^([^/?#]*)', 1),
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
       CASE WHEN strpos(url, '://') > 0
            THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
FROM pages
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in r) + ")" for r in rows)


def _license_scan() -> str:
    """Every key phrase at every place, by the texts' words joined by spaces; no index."""
    known = license_index.templates()
    heads = _values([(t, k.label, int(k.base), len(k.words), len(k.keys), k.slack) for t, k in enumerate(known)])
    keys = _values([(t, j, at, phrase[0], " ".join(phrase) + " ") for t, k in enumerate(known) for j, (at, phrase) in enumerate(k.keys)])
    tokens = _values([(t, i, w) for t, k in enumerate(known) for i, w in enumerate(k.words)])
    longest = max(len(phrase) for k in known for _, phrase in k.keys)
    ahead = " || ' ' || ".join(f"coalesce(lead(w, {i}) OVER o, '')" for i in range(1, longest))
    return f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, {_LOWER} AS t FROM documents),
tok AS (
    SELECT rid, unnest(words) AS w, generate_subscripts(words, 1) - 1 AS i
    FROM (SELECT rid, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM docs)
),
ahead AS (SELECT rid, i, w, w || ' ' || {ahead} || ' ' AS run FROM tok WINDOW o AS (PARTITION BY rid ORDER BY i)),
heads(t, label, base, size, n_keys, slack) AS (VALUES {heads}),
keys(t, j, pos, head, phrase) AS (VALUES {keys}),
tokens(t, k, w) AS (VALUES {tokens}),
hits AS (
    SELECT a.rid, k.t, k.j, a.i - k.pos AS p FROM ahead a JOIN keys k ON a.w = k.head AND starts_with(a.run, k.phrase)
),
places AS (
    SELECT l.rid, l.t, l.p
    FROM hits l JOIN heads h ON h.t = l.t JOIN hits x ON x.rid = l.rid AND x.t = l.t
         AND abs(x.p - l.p) <= CASE WHEN x.j = 0 THEN 0 ELSE h.slack END
    WHERE l.j = 0
    GROUP BY l.rid, l.t, l.p, h.n_keys
    HAVING count(DISTINCT x.j) = h.n_keys
),
shares AS (
    SELECT p.rid, p.t, p.p, count(k.rid) AS standing
    FROM places p JOIN tokens s ON s.t = p.t
         LEFT JOIN tok k ON k.rid = p.rid AND k.i = p.p + s.k AND k.w = s.w
    GROUP BY p.rid, p.t, p.p
),
found AS (
    SELECT s.rid, sum(h.base) AS n_base, min(CASE WHEN h.base = 1 THEN s.p END) AS first_word,
           max(CASE WHEN h.base = 1 THEN s.p END) AS last_word,
           string_agg(DISTINCT CASE WHEN h.base = 1 THEN h.label END, ',' ORDER BY CASE WHEN h.base = 1 THEN h.label END) AS base_labels,
           string_agg(DISTINCT h.label, ',' ORDER BY h.label) AS labels,
           max(s.standing / CAST(h.size AS DOUBLE)) AS score
    FROM shares s JOIN heads h ON h.t = s.t GROUP BY s.rid
),
sizes AS (SELECT rid, count(*) AS n FROM tok GROUP BY rid)
SELECT d.doc_id, coalesce(z.n, 0) AS n_words, CAST(coalesce(f.n_base, 0) AS BIGINT) AS n_base,
       CAST(f.first_word AS BIGINT) AS first_word, CAST(f.last_word AS BIGINT) AS last_word,
       coalesce(f.base_labels, '') AS base_labels, coalesce(f.labels, '') AS labels, coalesce(f.score, 0.0) AS score
FROM docs d LEFT JOIN sizes z ON z.rid = d.rid LEFT JOIN found f ON f.rid = d.rid
"""


_FILTER_AUDIT = """
WITH docs AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents
),
good AS (
    SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
    FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
),
first AS (SELECT text, min(doc_id) AS first FROM docs GROUP BY text),
judged AS (
    SELECT d.part, coalesce(g.good, 0) AS good, coalesce(g.toxic, 0) AS toxic,
           CASE WHEN len(d.words) < 100 THEN 1 ELSE 0 END AS a,
           CASE WHEN 100 * len(list_distinct(d.words)) < 80 * len(d.words) THEN 1 ELSE 0 END AS b,
           CASE WHEN 100 * length(regexp_replace(d.text, '[^A-Z]+', '', 'g')) > 10 * length(d.text) THEN 1 ELSE 0 END AS c,
           CASE WHEN regexp_matches(d.text, '[#$%&*|]') THEN 1 ELSE 0 END AS d,
           CASE WHEN d.doc_id > f.first THEN 1 ELSE 0 END AS e
    FROM docs d JOIN first f ON f.text = d.text LEFT JOIN good g ON g.doc_id = d.doc_id
),
cells AS (
    SELECT part, [a, b, c, d, e] AS fails, a + b + c + d + e AS n_fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
    FROM judged GROUP BY part, a, b, c, d, e
),
letters(f, name) AS (VALUES (1, 'A'), (2, 'B'), (3, 'C'), (4, 'D'), (5, 'E')),
orders AS (
    SELECT [p.f, q.f, r.f, s.f, t.f] AS fs, p.name || q.name || r.name || s.name || t.name AS filter_order
    FROM letters p JOIN letters q ON q.f <> p.f JOIN letters r ON r.f NOT IN (p.f, q.f)
         JOIN letters s ON s.f NOT IN (p.f, q.f, r.f) JOIN letters t ON t.f NOT IN (p.f, q.f, r.f, s.f)
),
steps AS (SELECT fs, filter_order, unnest([1, 2, 3, 4, 5]) AS step FROM orders),
-- whether a cell fails the step's own filter, and one of those before it
met AS (
    SELECT c.part, s.filter_order, s.step, s.fs[s.step] AS f, c.n, c.good, c.toxic, c.n_fails, c.fails[s.fs[s.step]] AS own,
           CASE WHEN (s.step > 1 AND c.fails[s.fs[1]] = 1) OR (s.step > 2 AND c.fails[s.fs[2]] = 1)
                  OR (s.step > 3 AND c.fails[s.fs[3]] = 1) OR (s.step > 4 AND c.fails[s.fs[4]] = 1) THEN 1 ELSE 0 END AS gone
    FROM cells c, steps s
),
sums AS (
    SELECT part, filter_order, step, f,
           sum(CASE WHEN own = 0 AND gone = 0 THEN n ELSE 0 END) AS kept,
           sum(CASE WHEN own = 1 AND gone = 0 THEN n ELSE 0 END) AS removed,
           sum(CASE WHEN own = 1 AND gone = 1 THEN n ELSE 0 END) AS redundant,
           sum(CASE WHEN own = 1 AND n_fails = 1 THEN n ELSE 0 END) AS unique_fails,
           sum(CASE WHEN own = 1 AND gone = 0 THEN good ELSE 0 END) AS good_lost,
           sum(CASE WHEN own = 1 AND gone = 0 THEN toxic ELSE 0 END) AS toxic_lost
    FROM met GROUP BY part, filter_order, step, f
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM sums
"""

_COLLOCATIONS = f"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS rid,
           unnest(string_split_regex({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
),
lists AS (SELECT lang, row_number() OVER () AS pid, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces),
tok AS (SELECT lang, pid, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM lists),
ahead AS (
    SELECT lang, w AS w1, lead(w, 1) OVER o AS w2, lead(w, 2) OVER o AS w3, lead(w, 3) OVER o AS w4, lead(w, 4) OVER o AS w5
    FROM tok WINDOW o AS (PARTITION BY pid ORDER BY i)
),
grams AS (
    SELECT lang, [w1] AS g FROM ahead
    UNION ALL SELECT lang, [w1, w2] FROM ahead WHERE w2 IS NOT NULL
    UNION ALL SELECT lang, [w1, w2, w3] FROM ahead WHERE w3 IS NOT NULL
    UNION ALL SELECT lang, [w1, w2, w3, w4] FROM ahead WHERE w4 IS NOT NULL
    UNION ALL SELECT lang, [w1, w2, w3, w4, w5] FROM ahead WHERE w5 IS NOT NULL
),
counts AS (SELECT lang, g, count(*) AS f FROM grams GROUP BY lang, g HAVING count(*) >= 100),
totals AS (SELECT lang, count(*) AS n FROM tok GROUP BY lang),
cand AS (SELECT lang, g, f AS a, len(g) AS m FROM counts WHERE len(g) > 1),
cuts AS (SELECT lang, g, a, unnest(range(1, m)) AS k FROM cand),
scored AS (
    SELECT c.lang, c.g, c.a, c.k, l.f AS l, r.f AS r, t.n,
           (1000::HUGEINT * c.a::HUGEINT * t.n::HUGEINT) // (l.f::HUGEINT * r.f::HUGEINT) AS score
    FROM cuts c JOIN totals t ON t.lang = c.lang
         JOIN counts l ON l.lang = c.lang AND l.g = c.g[1:c.k]
         JOIN counts r ON r.lang = c.lang AND r.g = c.g[c.k + 1:]
),
least AS (SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, k) AS cut FROM scored),
starts AS (SELECT lang, g, a, m, unnest(range(1, m + 1)) AS s FROM cand),
inner_parts AS (SELECT lang, g, a, s, unnest(range(s + 1, m + 1)) AS e FROM starts),
covers AS (SELECT DISTINCT lang, g[s:e] AS g, a AS cover FROM inner_parts WHERE e - s + 1 < len(g)),
kept AS (
    SELECT * FROM least x WHERE cut = 1
    AND NOT EXISTS (SELECT 1 FROM covers y WHERE y.lang = x.lang AND y.g = x.g AND 100 * y.cover >= 100 * x.a)
),
ranked AS (
    SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM kept
),
numbered AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM ranked)
SELECT lang, rank, phrase, a, l, r, n, score FROM numbered WHERE rank <= 2000
"""

ORACLE: dict[str, str] = {
    "op11_license_scan": _license_scan(),
    "op12_filter_audit": _FILTER_AUDIT,
    "op13_collocations": _COLLOCATIONS,
    "op9_url_rules": f"""
WITH u AS ({_URL}),
rules(host, path, verdict) AS (
    VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
),
fits AS (
    SELECT u.page_id, r.host || r.path AS rule, r.verdict,
           row_number() OVER (PARTITION BY u.page_id ORDER BY length(r.host) DESC, length(r.path) DESC) AS n
    FROM u JOIN rules r
      ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)
)
SELECT u.page_id, u.host, u.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM u LEFT JOIN fits f ON f.page_id = u.page_id AND f.n = 1
""",
}
