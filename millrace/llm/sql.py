"""The same results in SQL, for the queries that SQL can express."""

from millrace.llm.licenses import NOTICES

_FOLDED = """trim(regexp_replace(translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^a-z0-9]+', ' ', 'g'))"""
_GRAMS = """CASE WHEN len(w) > 1 THEN list_distinct(list_transform(range(1, CAST(len(w) AS BIGINT)), lambda i: w[i] || ' ' || w[i + 1]))
               ELSE w END"""
_NOTICES = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in NOTICES)

OP2 = f"""
WITH notice(license, text) AS (VALUES {_NOTICES}
), template AS (
    SELECT license, {_GRAMS} AS g FROM (SELECT license, string_split({_FOLDED.format('text')}, ' ') AS w FROM notice)
), doc AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents
), unit AS (
    SELECT r, generate_subscripts(l, 1) - 1 AS place, unnest(l) AS line FROM (SELECT r, string_split(text, chr(10)) AS l FROM doc)
    UNION ALL SELECT r, -1, text FROM doc WHERE contains(text, chr(10))
), cut AS (
    SELECT r, place, {_GRAMS} AS g FROM (SELECT r, place, string_split(u, ' ') AS w FROM (SELECT r, place, {_FOLDED.format('line')} AS u FROM unit) WHERE u <> '')
), match AS (
    SELECT r, place, license, 2000000 * len(list_intersect(cut.g, template.g)) // (len(cut.g) + len(template.g)) AS dice
    FROM cut JOIN template ON 120 * len(cut.g) >= 80 * len(template.g) AND 120 * len(template.g) >= 80 * len(cut.g)
), best AS (
    SELECT r, count(DISTINCT place) AS n_units, max(dice) AS best_dice FROM match WHERE dice >= 800000 GROUP BY r
), named AS (
    SELECT r, string_agg(license, ',' ORDER BY license) AS licenses
    FROM (SELECT DISTINCT r, license FROM match WHERE dice >= 800000) GROUP BY r
)
SELECT doc_id, coalesce(n_units, 0) AS n_units, coalesce(licenses, '') AS licenses,
       CAST(coalesce(best_dice, 0) AS BIGINT) AS best_dice, n_units IS NOT NULL AS licensed
FROM doc LEFT JOIN best USING (r) LEFT JOIN named USING (r)
"""

OP6 = r"""
WITH item AS (
    SELECT row_number() OVER () AS item, coalesce(CAST(item_id AS VARCHAR), 'null') AS name,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), sized AS (SELECT *, least(10, len(w)) AS n FROM item WHERE len(w) > 0
), wanted AS (
    SELECT DISTINCT name, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g
    FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM sized)
), doc AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), placed AS (
    SELECT r, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g
    FROM (SELECT r, w, n, unnest(range(1, CAST(len(w) AS BIGINT) - n + 2)) AS i FROM doc, (SELECT DISTINCT n FROM sized))
), word AS (SELECT r, unnest(range(1, CAST(len(w) AS BIGINT) + 1)) AS p, unnest(w) AS word FROM doc
), often AS (SELECT word, count(*) AS c FROM word GROUP BY word
), part AS (
    SELECT g, n, j, q.word, coalesce(c, 0) AS c
    FROM (SELECT g, n, unnest(range(1, n + 1)) AS j, unnest(string_split(g, ' ')) AS word FROM (SELECT DISTINCT g, n FROM wanted)) q
    LEFT JOIN often USING (word)
), anchor AS (
    SELECT part.g, part.n, part.j AS a, part.word FROM part
    WHERE c > 0 QUALIFY row_number() OVER (PARTITION BY g ORDER BY c, j) = 1 AND min(c) OVER (PARTITION BY g) > 0
), candidate AS (SELECT g, n, a, r, p FROM anchor JOIN word USING (word)
), around AS (
    SELECT g, candidate.r, candidate.p FROM candidate JOIN part USING (g, n) JOIN word AS o ON o.r = candidate.r AND o.word = part.word
    WHERE o.p BETWEEN candidate.p + j - a - 2 AND candidate.p + j - a + 2
    GROUP BY g, candidate.r, candidate.p, n HAVING count(DISTINCT j) = n
), close AS (
    SELECT r, count(*) AS n_near, string_agg(name, ',' ORDER BY name) AS near_items
    FROM (SELECT DISTINCT r, name FROM around JOIN wanted USING (g)) GROUP BY r
), hit AS (SELECT r, name, n, i FROM placed JOIN wanted USING (n, g)
), covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r
), named AS (
    SELECT r, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
    FROM (SELECT DISTINCT r, name FROM hit) GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
       coalesce(n_near, 0) AS n_near, coalesce(near_items, '') AS near_items
FROM doc LEFT JOIN covered USING (r) LEFT JOIN named USING (r) LEFT JOIN close USING (r)
"""

OP7 = r"""
WITH RECURSIVE doc AS (
    SELECT doc_id, regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingle AS (
    SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 2), ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 1))) AS i FROM doc WHERE len(w) > 0)
), size AS (SELECT doc_id, count(*) AS n, md5(string_agg(s, chr(10) ORDER BY s)) AS same FROM shingle GROUP BY doc_id
), class AS (SELECT same, min(doc_id) AS head, any_value(n) AS n FROM size GROUP BY same
), kept AS (SELECT head, n, s FROM class JOIN shingle ON doc_id = head
), pair AS (
    SELECT a.head AS a, b.head AS b FROM kept a JOIN kept b ON a.s = b.s AND a.head < b.head AND 10 * a.n >= 9 * b.n AND 10 * b.n >= 9 * a.n
    GROUP BY a.head, b.head HAVING 100 * count(*) >= 90 * (any_value(a.n) + any_value(b.n) - count(*))
), link AS (SELECT a, b FROM pair UNION ALL SELECT b, a FROM pair
), reach AS (SELECT head AS node, head AS seen FROM class UNION SELECT node, b FROM reach JOIN link ON seen = a
), root AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY node
)
SELECT doc_id, coalesce(size.n, 0) AS n_shingles, coalesce(component_id, doc_id) AS component_id
FROM doc LEFT JOIN size USING (doc_id) LEFT JOIN class USING (same) LEFT JOIN root ON node = head
"""

OP10 = r"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS t FROM documents
), start AS (
    SELECT r, i, md5(hex(array_slice(t, i, i + 199))) AS h
    FROM (SELECT r, t, unnest(range(1, CAST(octet_length(t) AS BIGINT) - 198)) AS i FROM doc)
), again AS (SELECT r, i FROM start QUALIFY count(*) OVER (PARTITION BY h) > 1
), run AS (
    SELECT r, min(i) AS a, max(i) + 199 AS b
    FROM (SELECT r, i, sum(new) OVER (PARTITION BY r ORDER BY i) AS g
          FROM (SELECT r, i, CASE WHEN i - lag(i) OVER (PARTITION BY r ORDER BY i) <= 200 THEN 0 ELSE 1 END AS new FROM again))
    GROUP BY r, g
), gap AS (
    SELECT r, b + 1 AS a, coalesce(lead(a) OVER (PARTITION BY r ORDER BY a) - 1, octet_length(t)) AS b, t FROM run JOIN doc USING (r)
    UNION ALL SELECT r, 1, min(a) - 1, any_value(t) FROM run JOIN doc USING (r) GROUP BY r
), kept AS (
    SELECT r, string_agg(CASE WHEN b >= a THEN hex(array_slice(t, a, b)) ELSE '' END, '' ORDER BY a, b) AS k FROM gap GROUP BY r
), gone AS (SELECT r, sum(b - a + 1) AS n_removed, count(*) AS n_spans FROM run GROUP BY r)
SELECT doc_id, octet_length(t) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(CASE WHEN k IS NULL THEN t ELSE unhex(k) END) AS kept_sha256
FROM doc LEFT JOIN gone USING (r) LEFT JOIN kept USING (r)
"""

OP11 = r"""
WITH doc AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents
), first AS (SELECT text, min(doc_id) AS smallest FROM doc GROUP BY text
), flag AS (
    SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
    FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), cut AS (
    SELECT doc.*, smallest, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM doc JOIN first USING (text)
), failing AS (
    SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
           list_filter(['A', 'B', 'C', 'D', 'E'], lambda f: CASE f
               WHEN 'A' THEN len(w) < 200
               WHEN 'B' THEN 100 * len(list_distinct(w)) < 50 * len(w)
               WHEN 'C' THEN 100 * len(regexp_extract_all(text, '[A-Z]')) > 3 * length(text)
               WHEN 'D' THEN regexp_matches(text, '[#$%&*|]')
               ELSE coalesce(doc_id > smallest, false) END) AS fails
    FROM cut LEFT JOIN flag USING (doc_id)
), counted AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failing GROUP BY part, fails
), letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f
), place AS (
    SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, unnest([1, 2, 3, 4, 5]) AS step
    FROM letter a, letter b, letter c, letter d, letter e
    WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
), stepped AS (
    SELECT part, filter_order, step, filter_order[step] AS f,
           sum(CASE WHEN NOT list_has_any(fails, string_split(filter_order[1:step], '')) THEN n ELSE 0 END) AS kept,
           sum(CASE WHEN here AND NOT before THEN n ELSE 0 END) AS removed, sum(CASE WHEN here AND before THEN n ELSE 0 END) AS redundant,
           sum(CASE WHEN here AND len(fails) = 1 THEN n ELSE 0 END) AS unique_fails,
           sum(CASE WHEN here AND NOT before THEN good ELSE 0 END) AS good_lost,
           sum(CASE WHEN here AND NOT before THEN toxic ELSE 0 END) AS toxic_lost
    FROM (SELECT *, list_contains(fails, filter_order[step]) AS here,
                 step > 1 AND list_has_any(fails, string_split(filter_order[1:step - 1], '')) AS before FROM counted, place)
    GROUP BY part, filter_order, step
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM stepped
"""


def _op13(clusters: int = 16, rounds: int = 3) -> str:
    nearest = """near{0} AS (
    SELECT r, v, min({{'d': d, 'c': c}}) AS best
    FROM (SELECT r, v, c, CAST(list_sum(list_transform(list_zip(v, x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d
          FROM vec, centre{0}) GROUP BY r, v
)"""
    mean = """centre{1} AS (
    SELECT centre{0}.c, coalesce(y, x) AS x FROM centre{0} LEFT JOIN (
        SELECT c, list(floored ORDER BY i) AS y FROM (
            SELECT c, i, (s - ((s % n) + n) % n) // n AS floored FROM (
                SELECT best.c AS c, i, CAST(sum(v[i]) AS BIGINT) AS s, count(*) AS n
                FROM near{0}, (SELECT unnest(range(1, 65)) AS i) GROUP BY best.c, i)) GROUP BY c) AS m ON m.c = centre{0}.c
)"""
    steps = [nearest.format(0)]
    for k in range(rounds):
        steps += [mean.format(k, k + 1), nearest.format(k + 1)]
    return f"""
WITH vec AS (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), centre0 AS (
    SELECT CAST(row_number() OVER (ORDER BY h NULLS LAST, v) AS INTEGER) - 1 AS c, v AS x
    FROM (SELECT sha256('1:' || vec_id) AS h, v FROM vec) ORDER BY h NULLS LAST, v LIMIT {clusters}
), {", ".join(steps)}
SELECT vec_id, best.c AS cluster, best.d AS distance, CAST(sum(best.d) OVER (PARTITION BY best.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(best.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(x, ',')) AS centroid_sha256
FROM near{rounds} JOIN vec USING (r) JOIN centre{rounds} ON centre{rounds}.c = best.c
"""


OP13 = _op13()
