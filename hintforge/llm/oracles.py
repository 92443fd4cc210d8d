"""SQL for the training-data queries that SQL can express, in DuckDB's dialect."""

from __future__ import annotations

ASCII_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
LIMITS = {5: 15, 6: 14, 7: 13, 8: 12, 9: 11, 10: 10}

OP1 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {WORDS.format("coalesce(text, '')")} AS w FROM documents),
i AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d),
k AS (SELECT doc_id, n, i, length(w[i]) AS size, CASE WHEN i + n - 1 <= len(w) THEN array_to_string(w[i:i + n - 1], ' ') END AS gram FROM i, (SELECT unnest([3, 5, 6, 7, 8, 9, 10]) AS n)),
c AS (SELECT doc_id, n, i, size, CASE WHEN gram IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY doc_id, n, gram) END AS c FROM k),
u AS ({" UNION ALL ".join(f"SELECT doc_id, n, size, max(c) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) > 1 AS under FROM c WHERE n = {n}" for n in (3, *LIMITS))}),
g AS (SELECT doc_id, count(*) FILTER (n = 3 AND under) AS n_repeat_words, {", ".join(f"CAST(coalesce(sum(size) FILTER (n = {n} AND under), 0) AS bigint) AS dup_{n}gram_chars" for n in LIMITS)} FROM u GROUP BY doc_id),
l AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
m AS (SELECT doc_id, len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines, CAST(coalesce(list_sum(list_transform(l, lambda x: length(regexp_replace(x, '[\x20\x09-\x0D]', '', 'g')))), 0) - coalesce(list_sum(list_transform(list_distinct(l), lambda x: length(regexp_replace(x, '[\x20\x09-\x0D]', '', 'g')))), 0) AS bigint) AS line_dup_chars FROM l),
a AS (SELECT d.doc_id, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, n_lines, line_dup_chars,
  {", ".join(f"coalesce(dup_{n}gram_chars, 0) AS dup_{n}gram_chars" for n in LIMITS)} FROM d JOIN m USING (doc_id) LEFT JOIN g USING (doc_id))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_dup_lines > 3 * n_lines OR 10 * line_dup_chars > 2 * word_chars OR {" OR ".join(f"100 * dup_{n}gram_chars > {p} * word_chars" for n, p in LIMITS.items())}) AS kept FROM a
"""


def _op2() -> str:
    kind = r"""CASE WHEN regexp_matches({s}, '^[0-9]+$') THEN '{{num}}' WHEN regexp_matches({s}, '^[0-9]{{4}}-[0-9]{{2}}(-[0-9]{{2}})?$') THEN '{{date}}' WHEN regexp_matches({s}, '^[0-9a-fA-F-]{{16,}}$') THEN '{{hex}}'
      WHEN regexp_matches({s}, '[0-9]') AND length({s}) > 3 THEN '{{mixed}}' WHEN length({s}) > 40 THEN '{{long}}' ELSE {s} END"""
    rules = [("block", "example.org", "/en/1"), ("block", "example.org", "/es/"), ("allow", "com", "/fr/"), ("block", "com", "/de/"), ("allow", "org", "/")]
    fits = [(what, h + p, f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')") for what, h, p in rules]
    steps = []
    for k in range(3):
        before = f"t{k}"
        steps.append(f"""e{k} AS (SELECT host, node, l{k} AS seg, sum(n) AS n, sum(nl) AS nl, sum(nb) AS nb FROM {before} GROUP BY ALL),
a{k} AS (SELECT *, sum(nl) OVER (PARTITION BY host, node) AS al, sum(nb) OVER (PARTITION BY host, node) AS ab FROM e{k}),
o{k} AS (SELECT host, node, seg FROM a{k} WHERE n >= 20 AND nl > 0 AND al > nl AND ab > 0 AND ab < al AND abs((nb / nl - (ab - nb) / (al - nl)) / sqrt((ab / al) * (1 - ab / al) * (1 / nl + 1 / (al - nl)))) >= 2.58),
t{k + 1} AS (SELECT t.* EXCLUDE (node), t.node || '/' || CASE WHEN o.seg IS NOT NULL THEN l{k} WHEN l{k} = '' THEN '' WHEN starts_with(l{k}, '{{') THEN l{k} ELSE '*' END AS node FROM {before} t LEFT JOIN o{k} o ON o.host = t.host AND o.node = t.node AND o.seg = t.l{k})""")
    return f"""
WITH r AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN url[strpos(url, '://') + 3:] ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM r),
p AS (SELECT page_id, {ASCII_LOWER.format("raw")} AS host, regexp_extract(rest[length(raw) + 1:], '^[^?#]*') AS path FROM h),
s AS (SELECT *, string_split(regexp_replace(path, '^/', ''), '/') AS seg FROM p),
x AS (SELECT *, {", ".join(f"coalesce(seg[{k + 1}], '') AS s{k}, regexp_extract(coalesce(seg[{k + 1}], ''), '[.][A-Za-z]{{1,5}}$') AS d{k}" for k in range(3))} FROM s),
y AS (SELECT *, {", ".join(f"s{k}[:length(s{k}) - length(d{k})] AS m{k}" for k in range(3))} FROM x),
z AS (SELECT page_id, host, path, {", ".join(f"{kind.format(s=f'm{k}')} || d{k}" + (" || CASE WHEN len(seg) > 3 THEN '/**' ELSE '' END" if k == 2 else "") + f" AS l{k}" for k in range(3))} FROM y),
b AS (SELECT doc_id AS page_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels WHERE doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL) GROUP BY 1),
t0 AS (SELECT host, l0, l1, l2, '' AS node, count(*)::double AS n, count(bad)::double AS nl, coalesce(sum(bad), 0)::double AS nb FROM z LEFT JOIN b USING (page_id) GROUP BY ALL),
{", ".join(steps)},
q AS (SELECT 1 - sum(nb) / sum(nl) AS q FROM t3),
hp AS (SELECT host, (sum(nl) - sum(nb) + 10.0 * coalesce(any_value(q), 1.0)) / (sum(nl) + 10.0) AS hp FROM t3, q GROUP BY host),
np AS (SELECT host, node, (sum(nl) - sum(nb) + 10.0 * any_value(hp)) / (sum(nl) + 10.0) AS purity FROM t3 JOIN hp USING (host) GROUP BY host, node)
SELECT page_id, host, path, CASE {" ".join(f"WHEN {f} THEN '{name}'" for _, name, f in fits)} END AS rule,
  CASE {" ".join(f"WHEN {f} THEN '{what}'" for what, _, f in fits)} WHEN purity < 0.5 THEN 'block' ELSE 'allow' END AS verdict, node AS template
FROM z JOIN (SELECT host, l0, l1, l2, node FROM t3) USING (host, l0, l1, l2) JOIN np USING (host, node)
"""


OP2 = _op2()

#: Words and shingles as the operator takes them; RE2 and Java agree on letters and digits.
OP4 = r"""
WITH w AS (SELECT 'd' AS k, doc_id AS id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents
           UNION ALL
           SELECT 'b', item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') FROM benchmark),
s AS (SELECT DISTINCT k, id, array_to_string(w[i:i + 4], ' ') AS shingle FROM (SELECT k, id, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 5)),
n AS (SELECT id, count(*) AS n_shingles FROM s WHERE k = 'b' GROUP BY id),
f AS (SELECT d.id AS doc_id, b.id AS item_id, count(*) AS n_found FROM s d JOIN s b ON d.k = 'd' AND b.k = 'b' AND d.shingle = b.shingle GROUP BY ALL)
SELECT doc_id, item_id, n_shingles, n_found FROM f JOIN n ON n.id = f.item_id WHERE 10 * n_found >= 8 * n_shingles
"""

OP6 = f"""
WITH RECURSIVE d AS (SELECT doc_id, {WORDS.format(ASCII_LOWER.format("coalesce(text, '')"))} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
l AS (SELECT x, y FROM (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL) JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 90 * (p.n + q.n - c)),
r(x, y) AS (SELECT x, y FROM l UNION SELECT r.x, l.y FROM r JOIN l ON l.x = r.y)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(m.m, d.doc_id)) AS component_id FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT x AS doc_id, min(y) AS m FROM r GROUP BY x) m USING (doc_id)
"""

OP10 = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT p.page_id, p.payload_bytes, p.payload_digest, CASE WHEN f.first <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.first <> p.page_id THEN f.first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""

OP11 = rf"""
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all({ASCII_LOWER.format("coalesce(text, '')")}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w, row_number() OVER () AS doc FROM documents),
o AS (SELECT lang, source, doc, unnest(w) AS term FROM d),
k AS (SELECT lang, term, count(*) AS lang_n FROM o GROUP BY lang, term HAVING count(DISTINCT doc) >= 10),
c AS (SELECT lang, source, term, count(*) AS n, any_value(lang_n) AS lang_n FROM o JOIN k USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v, sum(lang_n)::hugeint AS lang_total FROM k GROUP BY lang),
g AS (SELECT lang, source, coalesce((SELECT sum(n) FROM c WHERE c.lang = x.lang AND c.source = x.source), 0)::hugeint AS total, coalesce(v, 0) AS v, lang_total FROM (SELECT DISTINCT lang, source FROM d) x LEFT JOIN v USING (lang)),
s AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + 1000000000::hugeint * (coalesce(c.n, 0) + 2) // (total + 2 * v) AS p, 1 + 1000000000::hugeint * (k.lang_n + 2) // (lang_total + 2 * v) AS q FROM g JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
x AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f, 0)::bigint AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN (SELECT s.lang, s.source, t.source AS item, sum((s.p - t.p) * (s.p - t.p) // (s.p + t.p)) AS f FROM s JOIN s t ON s.lang = t.lang AND s.term = t.term GROUP BY ALL) y ON y.lang = a.lang AND y.source = a.source AND y.item = b.source
      UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::bigint FROM s WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM x)
SELECT lang, source, part, item, value, rank::int AS rank FROM r WHERE part = 'pair' OR rank <= 10
"""


def _op13() -> str:
    rounds = []
    for k in range(6):
        rounds.append(f"""a{k} AS MATERIALIZED (SELECT r, arg_min(k, d * 40 + k) AS k, min(d) AS d FROM (SELECT v.r, c.k, list_sum(list_transform(list_zip(v.c, c.c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint AS d FROM v, c{k} c) GROUP BY r)""")
        if k < 5:
            rounds.append(f"""m{k} AS (SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY d) AS c FROM (SELECT k, e.d, sum(x)::bigint AS s, count(*) AS n FROM a{k} JOIN e USING (r) GROUP BY k, e.d) GROUP BY k),
c{k + 1} AS MATERIALIZED (SELECT c.k, coalesce(m.c, c.c) AS c FROM c{k} c LEFT JOIN m{k} m USING (k))""")
    return f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) AS c FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
e AS MATERIALIZED (SELECT r, unnest(range(64)) AS d, unnest(c) AS x FROM v),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h NULLS LAST) - 1 AS k, c FROM (SELECT c, sha256('2:' || vec_id) AS h FROM v ORDER BY h NULLS LAST LIMIT 40)),
{", ".join(rounds)}
SELECT vec_id, a.k::int AS cluster, a.d AS distance, (sum(a.d) OVER (PARTITION BY a.k))::bigint AS cluster_inertia, (sum(a.d) OVER ())::bigint AS inertia, sha256(array_to_string(c5.c, ',')) AS centroid_sha256
FROM v JOIN a5 a USING (r) JOIN c5 ON c5.k = a.k
"""


OP13 = _op13()
