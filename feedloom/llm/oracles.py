"""SQL of the queries that SQL can express, for DuckDB over the given tables."""

MIX = r"""
WITH sized AS (
    SELECT doc_id, source,
           CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS src,
           CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
           md5(coalesce(text, '')) AS tie, row_number() OVER () AS row
    FROM documents),
classed AS (
    SELECT *, CASE WHEN size = 0 THEN 0 ELSE length(bin(size)) END AS class,
           (CAST('0x' || substr(md5('mix' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) + 0.5::DOUBLE)
               / 4503599627370496::DOUBLE AS u
    FROM sized),
sources AS (
    SELECT src, CAST(sum(size) AS BIGINT) AS source_size,
           [3, 1, 2][((row_number() OVER (ORDER BY src) - 1) % 3) + 1] AS weight
    FROM sized GROUP BY src),
capped AS (
    SELECT *, source_size * 2.0::DOUBLE AS most, (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE AS total,
           sum(weight) OVER () AS weights
    FROM sources),
levels AS (
    SELECT *, row_number() OVER o AS n,
           (total - coalesce(sum(most) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / (weights - coalesce(sum(weight) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
             AS level
    FROM capped WINDOW o AS (ORDER BY most / weight, src)),
chosen AS (SELECT arg_min(level, n) AS level FROM levels WHERE most > level * weight),
targets AS (
    SELECT src, source_size,
           least(most, coalesce((SELECT level FROM chosen) * weight, most))::DOUBLE AS target
    FROM capped),
classes AS (
    SELECT src, class, target, CAST(sum(size) AS BIGINT) AS words, CAST(sum(size) AS BIGINT) * class AS pull
    FROM classed JOIN targets USING (src) WHERE size > 0 GROUP BY src, class, target),
class_levels AS (
    SELECT *, (target - 2.0::DOUBLE * coalesce(sum(words) OVER (c ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
                / (sum(pull) OVER (PARTITION BY src)
                   - coalesce(sum(pull) OVER (c ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE AS level
    FROM classes WINDOW c AS (PARTITION BY src ORDER BY class DESC)),
first_level AS (
    SELECT src, arg_max(level, class) AS level FROM class_levels WHERE level * class < 2.0::DOUBLE GROUP BY src),
rates AS (
    SELECT k.src, k.class, k.words, k.target, coalesce(least(f.level * k.class, 2.0::DOUBLE), 2.0::DOUBLE) AS q
    FROM class_levels k LEFT JOIN first_level f USING (src)),
split AS (
    SELECT *, CAST(floor(q) AS INTEGER) AS base, q - CAST(floor(q) AS INTEGER)::DOUBLE AS p,
           target - (sum(CAST(floor(q) AS BIGINT) * words) OVER (PARTITION BY src))::DOUBLE AS aim
    FROM rates),
ranked AS (
    SELECT d.src, d.row, d.tie, d.size, s.aim, (u / (1 - u)) / (p / (1 - p)) AS r
    FROM classed d JOIN split s USING (src, class) WHERE p > 0),
summed AS (
    SELECT *, row_number() OVER o AS place,
           coalesce(sum(size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM ranked WINDOW o AS (PARTITION BY src ORDER BY r, size, tie, row)),
cuts AS (SELECT src, min(place) AS cut FROM summed WHERE (2 * before + size)::DOUBLE > 2 * aim GROUP BY src),
decided AS (
    SELECT d.doc_id, d.size, t.source_size, t.target,
           CAST(coalesce(s.base + CASE WHEN s.p > 0 AND (c.cut IS NULL OR m.place < c.cut) THEN 1 ELSE 0 END, 0)
                AS INTEGER) AS copies
    FROM classed d JOIN targets t USING (src)
    LEFT JOIN split s ON s.src = d.src AND s.class = d.class
    LEFT JOIN summed m ON m.row = d.row
    LEFT JOIN cuts c ON c.src = d.src)
SELECT doc_id, size, source_size, target, CAST(copies * size AS BIGINT) AS taken, copies FROM decided
"""

# The templates once more, as expressions over the words of a text joined by single spaces.
_LICENSE_FORMS = {
    "apache-2.0-notice": " licensed under (the terms of )?the apache (software )?license version 2 ",
    "apache-2.0-header": " you may not use this (file|work|software) except in compliance with the license you may obtain "
    "a copy of the license at ([^ ]+ ){1,12}unless required by applicable law or agreed to in writing software "
    "distributed under the license is distributed on an as is basis without warranties or conditions of any kind "
    "either express or implied ",
    "cc-by-nc-4.0-notice": " licensed under (a )?(the )?(creative commons )?(cc|attribution) (by )?(nc|noncommercial) 4 ",
    "gpl-notice": " (program|work|software|project|library|file) is (free software )?(released )?licensed under "
    "(the terms of )?the gnu general public license ",
    "isc-text": " permission to use copy modify and or distribute this software for any purpose with or without fee is "
    "hereby granted provided that the above copyright notice and this permission notice appear in all copies ",
    "mit-notice": " (released|licensed|distributed|available) under (the terms of )?the mit license ",
    "mit-text": " permission is hereby granted free of charge to any person obtaining a copy of this software and "
    "associated documentation files the software to deal in the software without restriction including without "
    "limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software "
    "and to permit persons to whom the software is furnished to do so subject to the following conditions the above "
    "copyright notice and this permission notice (including the next paragraph )?shall be included in all copies or "
    "substantial portions of the software ",
}
_ACCEPTED = ", ".join(
    f"CASE WHEN regexp_matches(norm, '{form}') THEN '{label}' END" for label, form in _LICENSE_FORMS.items()
)
LICENSES = rf"""
WITH w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents),
n AS (SELECT *, len(words) AS n, ' ' || array_to_string(words, ' ') || ' ' AS norm FROM w),
p AS (
    SELECT *, list_filter(range(n), lambda i: words[i + 1] = 'mit' AND words[i + 2] = 'license') AS mit,
           list_filter(range(n), lambda i: words[i + 1] = 'apache' AND words[i + 2] = 'license') AS apache,
           list_filter(range(n), lambda i: words[i + 1] = 'general' AND words[i + 2] = 'public'
                                      AND words[i + 3] = 'license') AS gpl
    FROM n),
l AS (
    SELECT *, list_concat(list_concat(mit, apache), gpl) AS places,
           list_filter([CASE WHEN len(apache) > 0 THEN 'apache' END, CASE WHEN len(gpl) > 0 THEN 'gpl' END,
                        CASE WHEN len(mit) > 0 THEN 'mit' END], lambda x: x IS NOT NULL) AS base,
           list_filter([{_ACCEPTED}], lambda x: x IS NOT NULL) AS more
    FROM p)
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(len(places) AS BIGINT) AS n_base,
       CAST(list_min(places) AS BIGINT) AS first_word, CAST(list_max(places) AS BIGINT) AS last_word,
       array_to_string(base, ',') AS base_labels,
       array_to_string(list_sort(list_concat(base, more)), ',') AS labels,
       CASE WHEN len(more) > 0 THEN 1.0::DOUBLE WHEN len(base) > 0 THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END AS score
FROM l
"""

TOP_K = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * x::DOUBLE) AS BIGINT)) AS vec
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.vec::DOUBLE[], c.vec::DOUBLE[]) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 20
"""

RANKED = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents),
s AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(len(terms)) AS BIGINT) AS length FROM d WHERE len(terms) > 0),
q AS (
    SELECT DISTINCT item_id,
           unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark WHERE item_id IS NOT NULL),
t AS (
    SELECT r, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT r, unnest(terms) AS term FROM d)
    WHERE term IN (SELECT term FROM q) GROUP BY r, term),
f AS (SELECT term, count(*) AS df FROM t GROUP BY term),
w AS (
    SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w
    FROM f CROSS JOIN s),
m AS (SELECT r, doc_id, 10 + (90 * CAST(len(terms) AS BIGINT) * docs) // length AS m FROM d CROSS JOIN s WHERE len(terms) > 0),
scored AS (
    SELECT item_id, r, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
    FROM q JOIN w USING (term) JOIN t USING (term) JOIN m USING (r) WHERE doc_id IS NOT NULL GROUP BY item_id, r),
ranked AS (
    SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
    FROM scored JOIN m USING (r) WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""

VECTOR_LINKS = """
WITH RECURSIVE v AS (
    SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS vec,
           vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
             AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS fine
    FROM embeddings),
l AS (
    SELECT a.r, b.r AS s FROM v a JOIN v b ON a.label = b.label AND a.r <> b.r
    WHERE a.fine AND b.fine AND list_cosine_similarity(a.vec, b.vec) >= 0.93),
reach AS (SELECT r, s FROM l UNION SELECT reach.r, l.s FROM reach JOIN l ON reach.s = l.r),
least AS (SELECT reach.r, min(v.vec_id) AS least FROM reach JOIN v ON v.r = reach.s GROUP BY reach.r),
n AS (SELECT r, count(*) AS n FROM l GROUP BY r),
o AS (
    SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, least(vec_id, coalesce(least, vec_id)) AS component_id
    FROM v LEFT JOIN n USING (r) LEFT JOIN least USING (r))
SELECT vec_id, n_links, component_id, coalesce(vec_id = component_id, true) AS kept FROM o
"""
