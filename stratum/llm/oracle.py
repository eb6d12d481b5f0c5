"""DuckDB SQL for the queries that SQL can express, written from the contracts
(not from the operators): other joins, other orders of work."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _component(vertices: str, links: str) -> str:
    """Recursive closure of symmetric links: smallest vertex reached."""
    return f"""reach(v, r) AS (SELECT id, id FROM {vertices} UNION SELECT reach.v, l.b FROM reach JOIN {links} l ON l.a = reach.r)"""


def warc() -> str:
    digits = " || ".join(f"upper(to_base(('0x' || substr(h, {10 * i + 1}, 10))::BIGINT, 32, 8))" for i in range(4))
    return f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
h AS (SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS h, max(page_id) OVER (PARTITION BY body) AS top FROM p)
SELECT page_id, payload_bytes, translate({digits}, '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
  CASE WHEN page_id < top THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id < top THEN top END AS refers_to
FROM h"""


def jaccard(k: int = 3, least: int = 90) -> str:
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
WITH RECURSIVE w AS (SELECT doc_id AS id, regexp_extract_all({lower}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT id, array_to_string(w[i:i + {k - 1}], ' ') AS g
  FROM (SELECT id, w, unnest(CASE WHEN len(w) = 0 THEN [] ELSE range(1, greatest(len(w) - {k - 1}, 1) + 1) END) AS i FROM w)),
n AS (SELECT w.id, count(s.g) AS n FROM w LEFT JOIN s ON s.id = w.id GROUP BY w.id),
-- one document of each set stands for its copies
d AS (SELECT id, md5(string_agg(g, chr(10) ORDER BY g)) AS m FROM s GROUP BY id),
rep AS (SELECT id, min(id) OVER (PARTITION BY m) AS r FROM d),
t AS (SELECT s.* FROM s JOIN rep ON rep.id = s.id AND rep.r = s.id),
c AS (SELECT a.id AS a, b.id AS b, count(*) AS c FROM t a JOIN t b ON a.g = b.g AND a.id < b.id GROUP BY 1, 2),
pair AS (SELECT a, b FROM c JOIN n x ON x.id = a JOIN n y ON y.id = b WHERE 100 * c >= {least} * (x.n + y.n - c)),
linked AS (SELECT a, b FROM pair UNION SELECT r, id FROM rep WHERE r <> id),
copies AS (SELECT r, count(*) AS k FROM rep GROUP BY r),
far AS (SELECT v, sum(k) AS k FROM (SELECT a AS v, b AS o FROM pair UNION ALL SELECT b, a FROM pair) JOIN copies ON r = o GROUP BY v),
degree AS (SELECT rep.id, coalesce(far.k, 0) + copies.k - 1 AS k FROM rep JOIN copies ON copies.r = rep.r LEFT JOIN far ON far.v = rep.r),
both_ways AS (SELECT a, b FROM linked UNION SELECT b, a FROM linked),
touched AS (SELECT DISTINCT a AS id FROM both_ways),
{_component("touched", "both_ways")}
SELECT n.id AS doc_id, n.n AS n_shingles, coalesce(m.c, n.id) AS component_id, coalesce(degree.k, 0)::BIGINT AS n_links
FROM n LEFT JOIN (SELECT v, min(r) AS c FROM reach GROUP BY v) m ON m.v = n.id LEFT JOIN degree ON degree.id = n.id"""


def mix(weights: tuple[int, ...] = (5, 2, 1), most: int = 3, seed: str = "mix") -> str:
    turn = " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(weights))
    return f"""
WITH d AS (SELECT doc_id, source, len({_WORDS}) AS size, md5('{seed}:' || doc_id::VARCHAR) AS k FROM documents),
src AS (SELECT source, sum(size)::BIGINT AS s FROM d GROUP BY source),
w AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM src),
v AS (SELECT *, CASE (rank - 1) % {len(weights)} {turn} END AS w, {most} * s AS cap FROM w),
-- the level at which the capped and the others together have all words
lv AS (SELECT a.cap / a.w AS bar, ((SELECT sum(s) FROM src) - coalesce(sum(CASE WHEN b.cap / b.w < a.cap / a.w THEN b.cap END), 0))
    / sum(CASE WHEN b.cap / b.w >= a.cap / a.w THEN b.w END) AS level FROM v a, v b GROUP BY a.rank, a.cap, a.w),
pick AS (SELECT level FROM lv WHERE level <= bar ORDER BY bar LIMIT 1),
goal AS (SELECT source, s, rank, least(cap::DOUBLE, coalesce((SELECT level FROM pick) * w, cap::DOUBLE)) AS target FROM v),
q AS (SELECT d.*, s, rank, target, sum(size) OVER (PARTITION BY rank ORDER BY k, doc_id, size) AS cum
  FROM d JOIN goal ON goal.source IS NOT DISTINCT FROM d.source),
copies AS (SELECT q.*, e, CASE WHEN target > 0 THEN (e * s + cum) / target ELSE 0 END AS f FROM q, range(0, {most}) r(e)),
run AS (SELECT *, sum(size) OVER (ORDER BY f, rank, k, doc_id, size) AS through FROM copies)
SELECT doc_id, any_value(size)::BIGINT AS size, any_value(s)::BIGINT AS source_size, any_value(target) AS target,
  CASE WHEN any_value(s) = 0 THEN 0 ELSE any_value(size) * count(*) FILTER (WHERE through <= (SELECT sum(s) FROM src)) END::BIGINT AS taken,
  CASE WHEN any_value(s) = 0 THEN 1 ELSE count(*) FILTER (WHERE through <= (SELECT sum(s) FROM src)) END::INT AS copies
FROM run GROUP BY doc_id"""


def near_vectors(least: float = 0.98) -> str:
    return f"""
WITH RECURSIVE e AS (SELECT vec_id AS id, label, list_transform(embedding, lambda x: x::DOUBLE) AS x FROM embeddings),
ok AS (SELECT * FROM e WHERE label IS NOT NULL AND x IS NOT NULL AND len(list_filter(x, lambda v: v IS NULL OR NOT isfinite(v))) = 0
  AND len(list_filter(x, lambda v: v <> 0)) > 0),
linked AS (SELECT a.id AS a, b.id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.id <> b.id AND len(a.x) = len(b.x)
  WHERE list_cosine_similarity(a.x, b.x) >= {least}),
{_component("e", "linked")},
c AS (SELECT v, min(r) AS c FROM reach GROUP BY v)
SELECT e.id AS vec_id, count(l.b) AS n_links, any_value(c.c) AS component_id, e.id = any_value(c.c) AS kept
FROM e JOIN c ON c.v = e.id LEFT JOIN linked l ON l.a = e.id GROUP BY e.id"""


def licences(templates: dict[str, str], least: float = 0.8) -> str:
    rows = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in templates.items())
    words = lambda c: rf"""string_split(trim(regexp_replace(lower({c}), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' ')"""
    pairs = "list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])"
    return rf"""
WITH t AS (SELECT l, len(g) AS m, list_distinct(g) AS g FROM (SELECT l, {pairs} AS g FROM (SELECT l, {words("x")} AS w FROM (VALUES {rows}) v(l, x))) WHERE len(g) > 0),
d AS (SELECT row_number() OVER () AS r, doc_id, {pairs} AS g FROM (SELECT doc_id, {words("coalesce(text, '')")} AS w FROM documents)),
-- every window of a template's size that holds one of its bigrams at all
p AS (SELECT r, len(g) AS n, unnest(range(0, len(g))) AS i, unnest(g) AS x FROM d),
s AS (SELECT DISTINCT r, l, unnest(range(greatest(i - m + 1, 0), least(i, greatest(n - m, 0)) + 1)) AS s FROM p JOIN (SELECT l, m, unnest(g) AS x FROM t) USING (x)),
w AS (SELECT s.r, s.l, t.g AS tg, list_distinct(d.g[s + 1:s + m]) AS wg FROM s JOIN t ON t.l = s.l JOIN d ON d.r = s.r),
top AS (SELECT r, l, max(2.0 * len(list_intersect(wg, tg)) / (len(wg) + len(tg))) AS dice FROM w GROUP BY r, l),
best AS (SELECT r, count(*) AS n, string_agg(l, ',' ORDER BY l) AS l, max(dice) AS d FROM top WHERE dice >= {least} - 1e-12 GROUP BY r)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_matches, coalesce(l, '') AS licenses, coalesce(best.d, 0)::DOUBLE AS best_dice
FROM d LEFT JOIN best ON best.r = d.r"""


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII string, bit by bit."""
    bits = "list_reduce(list_prepend(xor(c, b), range(8)), lambda y, k: xor(y >> 1, CASE WHEN y & 1 = 1 THEN 3988292384 ELSE 0 END))"
    chars = f"list_transform(range(1, length({text}) + 1), lambda i: ascii(substr({text}, i, 1))::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295, {chars}), lambda c, b: {bits}), 4294967295)"


def periodic_runs(least: int = 12) -> str:
    return rf"""
WITH h AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w, {_crc32("doc_id::VARCHAR")} AS h FROM documents),
a AS (SELECT *, len(w) AS n, h // 10 AS g, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM h),
b AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a),
d AS (SELECT r, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
  THEN list_transform(range(0, n), lambda i: CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % p + 1] END) ELSE w END AS w FROM b),
x AS (SELECT r, unnest(range(0, n)) AS i, unnest(w) AS w FROM d),
-- equal words q apart, in stretches of neighbours: m of them make a run of m + q words
e AS (SELECT s.r, t.i - s.i AS q, s.i, s.i - row_number() OVER (PARTITION BY s.r, t.i - s.i ORDER BY s.i) AS island
  FROM x s JOIN x t ON s.r = t.r AND s.w = t.w AND s.i < t.i),
m AS (SELECT r, q, min(i) AS s, count(*) + q AS n FROM e GROUP BY r, q, island HAVING count(*) >= q),
u AS (SELECT r, s, n, min(q) AS q FROM m GROUP BY r, s, n HAVING n >= greatest({least}, 2 * min(q))),
gone AS (SELECT DISTINCT r, unnest(range(s + q, s + n)) AS i FROM u),
kept AS (SELECT x.r, string_agg(w, ' ' ORDER BY x.i) AS w FROM x ANTI JOIN gone ON gone.r = x.r AND gone.i = x.i GROUP BY x.r),
best AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY r ORDER BY n DESC, s, q) = 1),
said AS (SELECT r, count(*) AS c, string_agg(s || ',' || n || ',' || q || chr(10), '' ORDER BY s, q) AS t FROM u GROUP BY r)
SELECT d.doc_id, coalesce(c, 0)::BIGINT AS n_runs, best.s::BIGINT AS start, best.n::BIGINT AS length, best.q::BIGINT AS period,
  ((1000 * best.n) // best.q)::BIGINT AS exponent_milli, sha256(coalesce(t, '')) AS runs_sha256, sha256(coalesce(kept.w, '')) AS collapsed_sha256
FROM d LEFT JOIN best ON best.r = d.r LEFT JOIN said ON said.r = d.r LEFT JOIN kept ON kept.r = d.r"""


def ranked(top: int = 10) -> str:
    terms = lambda c: rf"regexp_extract_all(translate(coalesce({c}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {terms("text")} AS w FROM documents),
c AS (SELECT count(*) AS docs_n, sum(len(w))::BIGINT AS terms_n FROM d WHERE len(w) > 0),
tf AS (SELECT r, doc_id, n, w, count(*) AS tf FROM (SELECT r, doc_id, len(w) AS n, unnest(w) AS w FROM d) GROUP BY ALL),
wt AS (SELECT w, floor(1000 * ln((2 * any_value(docs_n) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight FROM tf, c GROUP BY w),
q AS (SELECT row_number() OVER () AS item, item_id, {terms("text")} AS w FROM benchmark),
qt AS (SELECT item, item_id, w, count(*) AS times FROM (SELECT item, item_id, unnest(w) AS w FROM q) GROUP BY ALL),
s AS (SELECT item, item_id, r, doc_id, sum(times * weight * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs_n) // terms_n))))::BIGINT AS score
  FROM qt JOIN wt USING (w) JOIN tf USING (w), c GROUP BY item, item_id, r, doc_id)
SELECT item_id, rank::INT AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0) WHERE rank <= {top}"""
