"""DuckDB SQL for the queries that SQL can express over whole tables.

Written from the contracts.  The others (XXH64 fingerprints, a tokenizer
library, fitted models) are tested against plain versions in tests/llm.
"""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
GAPS = r"'[ \t\n\x0b\f\r]+'"
NO_WORD = r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+'"


def low(expr: str) -> str:
    return f"translate({expr}, '{UPPER}', '{LOWER}')"


def split(expr: str, gaps: str) -> str:
    return f"[x FOR x IN regexp_split_to_array(coalesce({expr}, ''), {gaps}) IF x <> '']"


EMBEDDINGS = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
good AS (SELECT vec_id, e FROM v WHERE e IS NOT NULL AND len(e) > 0
         AND len([x FOR x IN e IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([x FOR x IN e IF x <> 0]) > 0),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
         WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (SELECT a AS id, b AS other FROM link UNION SELECT reach.id, link.b FROM reach JOIN link ON reach.other = link.a),
least_id AS (SELECT id, min(other) AS other FROM reach GROUP BY id),
degree AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT v.vec_id, coalesce(degree.n, 0) AS n_links, least(v.vec_id, coalesce(least_id.other, v.vec_id)) AS component_id,
       v.vec_id <= coalesce(least_id.other, v.vec_id) AS kept
FROM v LEFT JOIN degree ON degree.a = v.vec_id LEFT JOIN least_id ON least_id.id = v.vec_id"""

LINES = f"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                  generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (SELECT *, {low(f"trim(line, {SPACES})")} AS key FROM l),
f AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key),
m AS (SELECT k.doc_id, k.pos, k.line, f.first IS NULL OR f.first = k.doc_id AS kept FROM k LEFT JOIN f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE NOT kept) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE kept), '')) AS kept_sha256
FROM m GROUP BY doc_id"""

LM = f"""
WITH d AS (SELECT doc_id, {split(low("text"), GAPS)} AS w FROM documents),
t AS (SELECT doc_id, len(w) AS size, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM d),
g AS (SELECT t.*, lag(x) OVER (PARTITION BY doc_id ORDER BY p) AS u FROM t),
n AS (SELECT count(*) AS total FROM t),
c1 AS (SELECT x, count(*) AS n FROM t GROUP BY x),
o1 AS (SELECT doc_id, x, count(*) AS n FROM t GROUP BY doc_id, x),
c2 AS (SELECT u, x, count(*) AS n FROM g WHERE u IS NOT NULL GROUP BY u, x),
o2 AS (SELECT doc_id, u, x, count(*) AS n FROM g WHERE u IS NOT NULL GROUP BY doc_id, u, x),
s AS (SELECT g.doc_id, g.u, c2.n - o2.n AS pair, cu.n - ou.n AS before,
             (CASE WHEN cx.n > ox.n THEN cx.n - ox.n ELSE 0.5 END) / greatest(1, n.total - g.size) AS alone
      FROM g CROSS JOIN n JOIN c1 cx ON cx.x = g.x JOIN o1 ox ON ox.doc_id = g.doc_id AND ox.x = g.x
      LEFT JOIN c1 cu ON cu.x = g.u LEFT JOIN o1 ou ON ou.doc_id = g.doc_id AND ou.x = g.u
      LEFT JOIN c2 ON c2.u = g.u AND c2.x = g.x LEFT JOIN o2 ON o2.doc_id = g.doc_id AND o2.u = g.u AND o2.x = g.x),
r AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE pair > 0) AS n_seen,
             sum(ln(CASE WHEN u IS NULL THEN alone WHEN pair > 0 THEN CAST(pair AS DOUBLE) / before ELSE 0.4 * alone END)) AS score
      FROM s GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_seen, 0) AS n_seen,
       round(coalesce(score, 0), 6) AS log_score, round(score / n_words, 6) AS mean_log_score
FROM d LEFT JOIN r ON r.doc_id = d.doc_id"""

CONTAMINATION = f"""
WITH d AS (SELECT doc_id, {split(low("text"), NO_WORD)} AS w FROM documents),
b AS (SELECT item_id, {split(low("text"), NO_WORD)} AS w FROM benchmark),
sizes AS (SELECT item_id, w, least(13, len(w)) AS n FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS gram
        FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM sizes) s),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS gram
       FROM (SELECT d.doc_id, d.w, ns.n, unnest(range(1, len(d.w) - ns.n + 2)) AS i
             FROM d JOIN (SELECT DISTINCT n FROM win) ns ON len(d.w) >= ns.n) x),
hit AS (SELECT dw.doc_id, dw.i, dw.n, win.item_id FROM dw JOIN win ON dw.n = win.n AND dw.gram = win.gram),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) h
        GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) h GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(pos.n_hit, 0) AS n_hit,
       coalesce(it.n_items, 0) AS n_items, sha256(coalesce(it.items, '')) AS items_sha256,
       coalesce(pos.n_hit, 0) > 0 AND 20 * coalesce(pos.n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN pos ON d.doc_id = pos.doc_id LEFT JOIN it ON d.doc_id = it.doc_id"""


def substrings(levels: int = 14) -> str:
    """Windows of 50 words, then of twice as many, ``levels`` times (beyond any text's length)."""
    chain, found = [], []
    for k in range(levels):
        size = 50 * 2 ** k
        if k:
            chain.append(f"l{k} AS (SELECT a.doc_id, a.i, md5(a.gram || b.gram) AS gram FROM l{k - 1} a "
                         f"JOIN l{k - 1} b ON a.doc_id = b.doc_id AND b.i = a.i + {size // 2})")
        found.append(f"SELECT DISTINCT doc_id, {size} AS size FROM l{k} WHERE gram IN "
                     f"(SELECT gram FROM l{k} GROUP BY gram HAVING min(doc_id) < max(doc_id))")
    return f"""
WITH d AS (SELECT doc_id, {split("text", GAPS)} AS w FROM documents),
c AS (SELECT *, md5(array_to_string(w, ' ')) AS whole FROM d WHERE len(w) >= 50),
lead AS (SELECT whole, min(doc_id) AS first FROM c GROUP BY whole),
win AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS gram
        FROM (SELECT *, unnest(range(1, len(w) - 48)) AS i FROM c) s),
f AS (SELECT gram, min(doc_id) AS first FROM win GROUP BY gram),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM win JOIN f ON win.gram = f.gram
         WHERE f.first < win.doc_id),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
kept AS (SELECT words.doc_id, string_agg(word, ' ' ORDER BY words.p) AS text, count(*) AS n
         FROM words LEFT JOIN gone ON words.doc_id = gone.doc_id AND words.p = gone.p
         WHERE gone.p IS NULL GROUP BY words.doc_id),
l0 AS (SELECT win.* FROM win JOIN c ON c.doc_id = win.doc_id JOIN lead ON lead.whole = c.whole AND lead.first = c.doc_id),
{", ".join(chain)},
top AS (SELECT doc_id, max(size) AS size FROM ({" UNION ALL ".join(found)}) x GROUP BY doc_id),
copy AS (SELECT c.doc_id, len(c.w) AS size FROM c JOIN lead ON lead.whole = c.whole WHERE c.doc_id > lead.first)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, len(d.w) - coalesce(kept.n, 0) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256, CAST(coalesce(copy.size, top.size) AS BIGINT) AS longest_repeat
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id LEFT JOIN copy ON d.doc_id = copy.doc_id
LEFT JOIN top ON d.doc_id = top.doc_id"""


def clusters(k: int = 40, rounds: int = 5) -> str:
    """Lloyd's rounds unrolled; integers are carried as doubles, in which every sum here is exact."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (SELECT v.n, v.vec_id, v.e, c.k, c.e AS centroid,
  list_inner_product(v.e, v.e) - 2 * list_inner_product(v.e, c.e) + list_inner_product(c.e, c.e) AS d
  FROM v CROSS JOIN c{r} c QUALIFY row_number() OVER (PARTITION BY v.n ORDER BY d, c.k) = 1)""")
        if r < rounds:
            steps.append(f"""c{r + 1} AS MATERIALIZED (SELECT c.k, coalesce(m.e, c.e) AS e FROM c{r} c LEFT JOIN
  (SELECT k, list(x ORDER BY p) AS e FROM (SELECT k, p, floor(CAST(sum(CAST(x AS BIGINT)) AS DOUBLE) / count(*)) AS x FROM
    (SELECT k, unnest(e) AS x, generate_subscripts(e, 1) AS p FROM a{r}) u GROUP BY k, p) s GROUP BY k) m ON m.k = c.k)""")
    return f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS n, vec_id, sha256('2:' || CAST(vec_id AS VARCHAR)) AS h,
  [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e FROM embeddings
  WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h NULLS LAST, e) - 1 AS k, e FROM v QUALIFY k < {k}),
{", ".join(steps)}
SELECT vec_id, CAST(k AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
  CAST(sum(CAST(d AS BIGINT)) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia,
  CAST(sum(CAST(d AS BIGINT)) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string([CAST(x AS BIGINT) FOR x IN centroid], ',')) AS centroid_sha256 FROM a{rounds}"""


SQL = {
    "op2_embedding_dedup": EMBEDDINGS,
    "op3_line_dedup": LINES,
    "op6_lm_scores": LM,
    "op8_decontamination": CONTAMINATION,
    "op10_substring_dedup": substrings(),
    "op11_centroids": clusters(),
}
