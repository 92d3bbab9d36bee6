"""DuckDB SQL for what of the corpus queries SQL can express."""

from __future__ import annotations

from . import url_rules

#: A list of the words of a text.
WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

SUBSTRING = rf"""WITH w AS (SELECT doc_id, {WORDS} AS l FROM documents),
 p AS (SELECT doc_id, unnest(l) AS word, generate_subscripts(l, 1) AS i FROM w),
 win AS (SELECT doc_id, i, array_to_string(l[i:i + 19], ' ') AS s FROM (SELECT doc_id, l, unnest(range(1, len(l) - 18)) AS i FROM w WHERE len(l) >= 20)),
 r AS (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) > 1 AS again FROM win),
 c AS (SELECT p.doc_id, p.i, p.word, max(CASE WHEN r.again THEN 1 ELSE 0 END) OVER (PARTITION BY p.doc_id ORDER BY p.i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone FROM p LEFT JOIN r USING (doc_id, i)),
 k AS (SELECT doc_id, sum(gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (gone = 0) AS kept FROM c GROUP BY doc_id)
 SELECT w.doc_id, CAST(len(l) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN k USING (doc_id)"""

NEAR = rf"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS l FROM documents),
 g AS (SELECT DISTINCT doc_id, sh FROM (SELECT doc_id, l[i] || ' ' || l[i + 1] AS sh FROM (SELECT doc_id, l, unnest(range(1, len(l))) AS i FROM w WHERE len(l) > 1) UNION ALL SELECT doc_id, l[1] FROM w WHERE len(l) = 1)),
 n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
 s AS (SELECT doc_id, sh, n FROM g JOIN n USING (doc_id)),
 pairs AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS common, any_value(a.n) AS nu, any_value(b.n) AS nv FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id AND a.n * 100 >= b.n * 80 AND b.n * 100 >= a.n * 80 GROUP BY 1, 2),
 links AS (SELECT u, v FROM pairs WHERE 100 * common >= 80 * (nu + nv - common)),
 e AS (SELECT u, v FROM links UNION SELECT v, u FROM links),
 c(root, node) AS (SELECT doc_id, doc_id FROM documents UNION SELECT c.root, e.v FROM c JOIN e ON c.node = e.u),
 least AS (SELECT root AS doc_id, min(node) AS component_id FROM c GROUP BY root)
 SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM least LEFT JOIN n USING (doc_id)"""

BASE = rf"""WITH w AS (SELECT doc_id, coalesce(text, '') AS t, {WORDS} AS l FROM documents),
 lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM w),
 dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
 win AS (SELECT doc_id, i, array_to_string(l[i:i + 7], ' ') AS s FROM (SELECT doc_id, l, unnest(range(1, len(l) - 6)) AS i FROM w WHERE len(l) >= 8)),
 r AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) > 1 AS again FROM win),
 p AS (SELECT doc_id, unnest(range(1, len(l) + 1)) AS i FROM w),
 c AS (SELECT p.doc_id, max(CASE WHEN r.again THEN 1 ELSE 0 END) OVER (PARTITION BY p.doc_id ORDER BY p.i ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS hit FROM p LEFT JOIN r USING (doc_id, i)),
 rep AS (SELECT doc_id, sum(hit) AS n FROM c GROUP BY doc_id),
 f AS (SELECT w.doc_id, CAST(len(l) AS BIGINT) AS n_words, CAST(len(array_to_string(l, '')) AS BIGINT) AS word_chars, CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words FROM w LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id))
 SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM f"""

TARGETS = rf"""WITH t AS (SELECT source, CAST(sum(len({WORDS})) AS BIGINT) AS source_size FROM documents GROUP BY source),
 w AS (SELECT *, [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) - 1) % 3 + 1] AS w, source_size * 2.0 AS lim, 1.5 * sum(source_size) OVER () AS budget, sum(1) OVER () AS n FROM t),
 o AS (SELECT *, coalesce(sum(lim) OVER before, 0) AS spent, sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS left_w FROM w WINDOW before AS (ORDER BY lim / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
 f AS (SELECT *, (budget - spent) * w >= lim * left_w AS full_ FROM o),
 l AS (SELECT (any_value(budget) - coalesce(sum(lim) FILTER (full_), 0)) / sum(w) FILTER (NOT full_) AS level FROM f)
 SELECT source, source_size, round(CASE WHEN full_ THEN lim ELSE level * w END, 4) AS target FROM f, l"""

DIVERGENCE = r"""WITH t AS (SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS l FROM documents),
 x AS (SELECT d, lang, source, unnest(l) AS term FROM t),
 voc AS (SELECT lang, term, CAST(count(*) AS HUGEINT) AS n FROM x GROUP BY 1, 2 HAVING count(DISTINCT d) >= 3),
 lg AS (SELECT lang, CAST(count(*) AS HUGEINT) AS v, sum(n) AS total FROM voc GROUP BY 1),
 c AS (SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS n FROM x SEMI JOIN voc USING (lang, term) GROUP BY 1, 2, 3),
 g AS (SELECT DISTINCT lang, source FROM t),
 gn AS (SELECT lang, source, coalesce(sum(n), 0) AS total FROM g LEFT JOIN c USING (lang, source) GROUP BY 1, 2),
 p AS (SELECT gn.lang, gn.source, voc.term, coalesce(c.n, 0) AS n, 1 + CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 1) // (gn.total + lg.v) AS p, 1 + CAST(1000000000 AS HUGEINT) * (voc.n + 1) // (lg.total + lg.v) AS q FROM gn JOIN lg USING (lang) JOIN voc USING (lang) LEFT JOIN c ON c.lang = gn.lang AND c.source = gn.source AND c.term = voc.term),
 far AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
 pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(far.value, 0) AS BIGINT) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN far ON far.lang = a.lang AND far.source = a.source AND far.item = b.source),
 terms AS (SELECT lang, source, 'term' AS part, term AS item, CAST((p - q) * (p - q) // q AS BIGINT) AS value FROM p WHERE n > 0 AND p > q),
 r AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item COLLATE "C") AS INTEGER) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
 SELECT * FROM r WHERE part = 'pair' OR rank <= 200"""

LATTICE = rf"""WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS x, {WORDS} AS l FROM documents),
 said AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
 m AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, CASE WHEN len(l) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(l)) < 50 * len(l) THEN 'B' ELSE '' END || CASE WHEN 100 * len(regexp_extract_all(x, '[A-Z]')) > 3 * length(x) THEN 'C' ELSE '' END
  || CASE WHEN regexp_matches(x, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN t.doc_id > min(t.doc_id) OVER (PARTITION BY x) THEN 'E' ELSE '' END AS fails FROM t LEFT JOIN said USING (doc_id)),
 c AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY 1, 2),
 f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
 o AS (SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM f a, f b, f c, f d, f e WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
 s AS (SELECT filter_order, i AS step, substr(filter_order, i, 1) AS f, substr(filter_order, 1, i - 1) AS before FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS i)),
 k AS (SELECT part, filter_order, step, f, contains(fails, f) AS hit, fails = '' OR before = '' OR len(list_intersect(string_split(fails, ''), string_split(before, ''))) = 0 AS there, fails = f AS alone, n, good, toxic FROM s, c),
 r AS (SELECT part, filter_order, step, f, sum(CASE WHEN there AND NOT hit THEN n ELSE 0 END) AS kept, sum(CASE WHEN there AND hit THEN n ELSE 0 END) AS removed, sum(CASE WHEN NOT there AND hit THEN n ELSE 0 END) AS redundant, sum(CASE WHEN alone THEN n ELSE 0 END) AS unique_fails, sum(CASE WHEN there AND hit THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN there AND hit THEN toxic ELSE 0 END) AS toxic_lost FROM k GROUP BY 1, 2, 3, 4)
 SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley FROM r"""

_RULES = ", ".join(f"('{r}', '{v}', '{r.partition('/')[0]}', '/{r.partition('/')[2]}')" for r, v in url_rules.SITES)
_BLOCKED = ", ".join(f"('{w}')" for w in url_rules.WORDS)
URLS = rf"""WITH u AS (SELECT row_number() OVER () AS i, page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
 rules(rule, verdict, h, p) AS (VALUES {_RULES}), words(word) AS (VALUES {_BLOCKED}),
 s AS (SELECT i, rule, verdict, row_number() OVER (PARTITION BY i ORDER BY len(rule) DESC, rule DESC) AS n FROM u JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)),
 w AS (SELECT i, word, row_number() OVER (PARTITION BY i ORDER BY len(word) DESC, word DESC) AS n FROM (SELECT i, unnest(regexp_extract_all(host, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+')) AS token FROM u) JOIN words ON word = token)
 SELECT page_id, host, path, rule, CASE WHEN rule IS NULL THEN word END AS pattern_rule, CASE WHEN rule IS NOT NULL THEN verdict WHEN word IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict FROM u LEFT JOIN (SELECT * FROM s WHERE n = 1) USING (i) LEFT JOIN (SELECT i, word FROM w WHERE n = 1) USING (i)"""
