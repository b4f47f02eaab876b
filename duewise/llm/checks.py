"""SQL that states what the mixing, near-duplicate and decontamination queries return."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ASCII_LOWER = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"
_SPACED = r"[^\x20\x09-\x0D]+"
_LETTERED = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# A source is full if twice its size is less than its weight's share; full sources come first by that ratio.
MIXING = rf"""
    WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_SPACED}'))::BIGINT AS size FROM documents),
    s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM d GROUP BY source),
    w AS (SELECT source, source_size, [5, 2, 1][(rank - 1) % 3 + 1] AS weight FROM s),
    r AS (SELECT *, 2.0::DOUBLE * source_size / weight AS ratio, coalesce(sum(2 * source_size) OVER before, 0) AS full_words,
                 sum(weight) OVER rest AS open_weight, 1.5::DOUBLE * sum(source_size) OVER () AS wanted FROM w
          WINDOW before AS (ORDER BY 2.0::DOUBLE * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                 rest AS (ORDER BY 2.0::DOUBLE * source_size / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
    p AS (SELECT (wanted - full_words) / open_weight AS per_weight FROM r WHERE ratio >= (wanted - full_words) / open_weight
          ORDER BY ratio, source LIMIT 1),
    t AS (SELECT source, source_size, least(2.0::DOUBLE * source_size, weight * per_weight) AS target FROM w, p),
    o AS (SELECT d.*, sum(size) OVER (PARTITION BY source ORDER BY md5('mix-' || coalesce(doc_id::VARCHAR, '')), doc_id, size
                                      ROWS UNBOUNDED PRECEDING) - size AS ahead FROM d),
    j AS (SELECT o.*, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS rounds
          FROM o JOIN t ON o.source IS NOT DISTINCT FROM t.source)
    SELECT doc_id, size, source_size, target,
           (rounds * size + greatest(0, least(size, floor(target) - rounds * source_size - ahead)))::BIGINT AS taken FROM j"""

# Pairs that share a shingle, then what is reachable from each document.
NEAR_DUPLICATES = rf"""
    WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_ASCII_LOWER}, '{_SPACED}') AS words FROM documents),
    sh AS (SELECT doc_id, CASE WHEN len(words) = 0 THEN []::VARCHAR[] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
                  ELSE list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) END AS s FROM w),
    n AS (SELECT doc_id, len(s)::BIGINT AS n_shingles FROM sh),
    u AS MATERIALIZED (SELECT doc_id, hash(unnest(s)) AS h FROM sh),
    p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM u a JOIN u b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
    l AS MATERIALIZED (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
                       WHERE 100 * shared >= 85 * (x.n_shingles + y.n_shingles - shared)),
    e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
    r AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
    c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
    SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM n JOIN c USING (doc_id)"""

DECONTAMINATION = rf"""
    WITH i AS (SELECT item_id::VARCHAR AS item_id, regexp_extract_all({_ASCII_LOWER}, '{_LETTERED}') AS words FROM benchmark),
    d AS (SELECT doc_id, regexp_extract_all({_ASCII_LOWER}, '{_LETTERED}') AS words FROM documents),
    iw AS (SELECT DISTINCT item_id, k, array_to_string(words[j:j + k - 1], ' ') AS win FROM (
        SELECT item_id, words, least(13, len(words)) AS k, unnest(range(1, len(words) - least(13, len(words)) + 2)) AS j
        FROM i WHERE len(words) > 0)),
    dw AS (SELECT doc_id, k, j, array_to_string(words[j:j + k - 1], ' ') AS win FROM (
        SELECT doc_id, words, k, unnest(range(1, len(words) - k + 2)) AS j FROM d, (SELECT DISTINCT k FROM iw) WHERE len(words) >= k)),
    h AS (SELECT doc_id, item_id, j, k FROM dw JOIN iw USING (k, win)),
    hit AS (SELECT doc_id, count(DISTINCT place)::BIGINT AS n_hit FROM (SELECT doc_id, unnest(range(j, j + k)) AS place FROM h) GROUP BY doc_id),
    named AS (SELECT doc_id, count(*)::BIGINT AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS names
              FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY doc_id)
    SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
    FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)"""

# Every window of 100 bytes, the later ones of equal windows, and the stretches they cover.
REPEATS = """
    WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
    w AS (SELECT doc_id, unnest(range(octet_length(b) - 99)) AS s, b FROM d WHERE octet_length(b) >= 100),
    h AS (SELECT doc_id, s, md5(b[s + 1:s + 100]) AS h FROM w),
    again AS (SELECT doc_id, s FROM h QUALIFY row_number() OVER (PARTITION BY h ORDER BY doc_id, s) > 1),
    mark AS (SELECT *, s > coalesce(max(s) OVER (PARTITION BY doc_id ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1000) + 100 AS new FROM again),
    num AS (SELECT *, count_if(new) OVER (PARTITION BY doc_id ORDER BY s) AS k FROM mark),
    span AS (SELECT doc_id, min(s) AS s, max(s) + 100 AS e FROM num GROUP BY doc_id, k),
    gap AS (SELECT doc_id, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 0) AS f, s AS t FROM span
            UNION ALL SELECT doc_id, max(e), NULL FROM span GROUP BY doc_id),
    kept AS (SELECT doc_id, sha256(unhex(string_agg(hex(b[f + 1:coalesce(t, octet_length(b))]), '' ORDER BY f))) AS kept FROM gap JOIN d USING (doc_id) GROUP BY doc_id),
    sums AS (SELECT doc_id, sum(e - s)::BIGINT AS n_removed, count(*)::BIGINT AS n_spans FROM span GROUP BY doc_id)
    SELECT doc_id, octet_length(b)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, coalesce(kept, sha256(b)) AS kept_sha256
    FROM d LEFT JOIN sums USING (doc_id) LEFT JOIN kept USING (doc_id)"""

CHECKS = {"op4_decontamination": DECONTAMINATION, "op8_near_duplicates": NEAR_DUPLICATES, "op9_mixing": MIXING, "op11_repeats": REPEATS}
