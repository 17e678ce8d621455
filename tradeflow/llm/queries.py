"""Registered queries of the operators, over their whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tradeflow.llm import (
    interpolated,
    lattice,
    mixing,
    packed,
    periodic,
    pieces,
    quality,
    secrets,
    simhash,
    substrings,
    toxicity,
    trie,
    urls,
)
from tradeflow.llm.common import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": lambda spark, d: toxicity.toxicity(
        documents(spark, d), documents(spark, d, "labels")
    ),
    "op2_lm_scoring": lambda spark, d: interpolated.lm_scores(documents(spark, d)),
    "op3_secret_scan": lambda spark, d: secrets.secrets(documents(spark, d)),
    "op4_quality_rules": lambda spark, d: quality.quality(documents(spark, d)),
    "op5_sentencepiece": lambda spark, d: pieces.encoded(documents(spark, d)),
    "op6_substring_dedup": lambda spark, d: substrings.substring_dedup(documents(spark, d)),
    "op7_packed_ids": lambda spark, d: packed.packed(documents(spark, d)),
    "op8_mixing": lambda spark, d: mixing.mixed(documents(spark, d)),
    "op9_simhash": lambda spark, d: simhash.simhash(documents(spark, d)),
    "op10_embedding_dedup": lambda spark, d: lattice.embedding_dedup(
        documents(spark, d, "embeddings")
    ),
    "op11_periodic_runs": lambda spark, d: periodic.periodic_digest(documents(spark, d)),
    "op12_prefix_trie": lambda spark, d: trie.rebuilt_trie(documents(spark, d, "conversations")),
    "op13_url_filters": lambda spark, d: urls.url_filters(spark, documents(spark, d, "pages")),
}

# The same answers in DuckDB SQL, where SQL has the means; the other queries are held against
# brute force in tests/llm.
ORACLE_SQL: dict[str, str] = {
    "op6_substring_dedup": r"""
        WITH texts AS (
          SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
        places AS (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM texts),
        windows AS (SELECT doc_id, i, md5(array_to_string(words[i:i + 49], ' ')) AS w FROM places),
        firsts AS (SELECT w, min(doc_id) AS first FROM windows GROUP BY w),
        gone AS (
          SELECT DISTINCT doc_id, i + o AS place FROM windows JOIN firsts USING (w), range(50) AS r(o)
          WHERE first < doc_id),
        listed AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM texts),
        kept AS (
          SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS words FROM listed ANTI JOIN gone USING (doc_id, place)
          GROUP BY doc_id),
        counts AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
        SELECT t.doc_id, len(t.words)::BIGINT AS n_words, coalesce(c.n, 0)::BIGINT AS n_removed,
               sha256(coalesce(k.words, '')) AS kept_sha256
        FROM texts t LEFT JOIN kept k USING (doc_id) LEFT JOIN counts c USING (doc_id)""",
    "op8_mixing": r"""
        WITH sizes AS (
          SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                 ('0x' || substr(md5('20240501:' || coalesce(
                    doc_id::VARCHAR, 'text ' || md5(coalesce(text, '')))), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
          FROM documents),
        weighed AS (
          SELECT source, sum(size)::BIGINT AS source_size, (3 * sum(size))::BIGINT AS cap,
                 ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS weight
          FROM sizes GROUP BY source),
        running AS (
          SELECT *, cap / weight AS ratio,
                 sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0) AS rest,
                 sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST
                                   ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
          FROM weighed WINDOW before AS (ORDER BY cap / weight, source NULLS LAST
                                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        level AS (
          SELECT rest::DOUBLE / weights::DOUBLE AS level FROM running
          WHERE rest::DOUBLE / weights::DOUBLE <= ratio ORDER BY ratio, level LIMIT 1),
        targets AS (SELECT source, source_size, least(cap::DOUBLE, level * weight) AS target FROM running, level),
        rates AS (
          SELECT source, source_size, target,
                 least(CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END, 3.0::DOUBLE) AS rate,
                 ('0x' || substr(md5('20240501:source ' || coalesce(':' || source, '')), 1, 13))::BIGINT
                   / 4503599627370496.0::DOUBLE AS start
          FROM targets),
        placed AS (
          SELECT doc_id, size, u, t.source, source_size, target, start, floor(rate) AS times, rate - floor(rate) AS fraction,
                 greatest(length(bin(size)) - 6, 0) AS shift
          FROM sizes s JOIN rates t ON s.source IS NOT DISTINCT FROM t.source),
        banded AS (SELECT *, shift * 64 + (size >> shift) AS band, (size > 0)::INT AS one FROM placed),
        draws AS (SELECT source, band, u, sum(one)::BIGINT AS n FROM banded GROUP BY ALL),
        bands AS (
          SELECT source, band, sum(n)::BIGINT AS n, sum(sum(n)) OVER (PARTITION BY source ORDER BY band)::BIGINT AS upto
          FROM draws GROUP BY source, band),
        extras AS (
          SELECT b.source, band, floor(upto * (rate - floor(rate)) + start)
                 - floor((upto - n) * (rate - floor(rate)) + start) AS extra
          FROM bands b JOIN rates r ON b.source IS NOT DISTINCT FROM r.source),
        ranked AS (SELECT *, sum(n) OVER (PARTITION BY source, band ORDER BY u)::BIGINT AS rank FROM draws),
        cuts AS (
          SELECT r.source, r.band, max(u) FILTER (rank - n / 2 <= extra) AS cut
          FROM ranked r JOIN extras e ON r.source IS NOT DISTINCT FROM e.source AND r.band = e.band GROUP BY ALL)
        SELECT doc_id, size, source_size, target,
               (size * (times + CASE WHEN u <= cut THEN 1 ELSE 0 END))::BIGINT AS taken
        FROM banded b JOIN cuts c ON b.source IS NOT DISTINCT FROM c.source AND b.band = c.band""",
    "op10_embedding_dedup": """
        WITH RECURSIVE vectors AS (
          SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
          WHERE embedding IS NOT NULL AND label IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        links AS (
          SELECT a.vec_id AS x, b.vec_id AS y FROM vectors a JOIN vectors b
          ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
          WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
        reach AS (
          SELECT vec_id AS x, vec_id AS y FROM embeddings
          UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y),
        roots AS (SELECT x AS vec_id, min(y) AS component_id FROM reach GROUP BY x),
        degrees AS (SELECT x AS vec_id, count(*) AS n FROM links GROUP BY x)
        SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
        FROM roots LEFT JOIN degrees USING (vec_id)""",
    "op11_periodic_runs": r"""
        WITH texts AS (
          SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws, doc_id::VARCHAR AS t FROM documents),
        codes AS (
          SELECT doc_id, ws, len(ws)::BIGINT AS n,
                 list_transform(range(1, length(t) + 1), lambda i: ascii(substr(t, i::INT, 1))::BIGINT) AS t FROM texts),
        crcs AS (
          SELECT doc_id, ws, n, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, t),
                 lambda crc, code: list_reduce(list_prepend(xor(crc, code), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                 lambda x, y: xor(x >> 1, 3988292384 * (x & 1))))) AS h FROM codes),
        loops AS (
          SELECT doc_id, ws, n, CASE WHEN h % 10 = 0 AND n > 0 THEN (h // 10) % n ELSE n END AS a, (h // 10) % 8 AS g FROM crcs),
        words AS (
          SELECT doc_id, n, list_transform(range(n), lambda i: ws[(CASE WHEN i < a THEN i
                 ELSE a + (i - a) % (1 + (n - a) // (3 + g)) END + 1)::INT]) AS ws FROM loops),
        places AS (SELECT doc_id, n, unnest(ws) AS w, unnest(range(n)) AS i FROM words WHERE n >= 24),
        pairs AS (
          SELECT x.doc_id, x.i, y.i - x.i AS p FROM places x JOIN places y
          ON x.doc_id = y.doc_id AND x.w = y.w AND y.i > x.i AND y.i - x.i <= x.n // 3),
        islands AS (
          SELECT doc_id, i, p, i - row_number() OVER (PARTITION BY doc_id, p ORDER BY i) AS island FROM pairs),
        stretches AS (
          SELECT doc_id, p, min(i) AS start, count(*) + p AS length FROM islands GROUP BY doc_id, p, island
          HAVING count(*) + p >= greatest(24, 3 * p)),
        runs AS (
          SELECT * FROM stretches s WHERE NOT EXISTS (
            FROM stretches z WHERE z.doc_id = s.doc_id AND z.p < s.p AND s.p % z.p = 0
            AND z.start <= s.start AND z.start + z.length >= s.start + s.length)),
        gone AS (SELECT DISTINCT doc_id, unnest(range(start + p, start + length)) AS i FROM runs),
        told AS (
          SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || p || chr(10), '' ORDER BY start, p) AS listed
          FROM runs GROUP BY doc_id),
        best AS (
          SELECT * FROM runs QUALIFY row_number() OVER (
            PARTITION BY doc_id ORDER BY (length * 1000000000000) // p DESC, start, p) = 1),
        kept AS (
          SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS kept FROM places ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
        SELECT t.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start, length::BIGINT AS length,
               p::BIGINT AS period, (1000 * length // p)::BIGINT AS exponent_milli,
               sha256(coalesce(listed, '')) AS runs_sha256,
               sha256(CASE WHEN n < 24 THEN array_to_string(ws, ' ') ELSE coalesce(kept, '') END) AS collapsed_sha256
        FROM words t LEFT JOIN told USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)""",
    "op12_prefix_trie": """
        WITH convs AS (
          SELECT conv_id AS c, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS s,
                 conv_id::VARCHAR AS t FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
        codes AS (
          SELECT c, s, list_transform(range(1, length(t) + 1), lambda i: ascii(substr(t, i::INT, 1))::BIGINT) AS t FROM convs),
        heads AS (
          SELECT c, s, c - c % 5 AS base, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, t),
                 lambda crc, code: list_reduce(list_prepend(xor(crc, code), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                 lambda x, y: xor(x >> 1, 3988292384 * (x & 1))))) % 9 AS h FROM codes),
        rebuilt AS (
          SELECT a.c, list_concat(coalesce(b.s[1:a.h], []), a.s[a.h + 1:]) AS s
          FROM heads a LEFT JOIN convs b ON b.c = a.base),
        depths AS (SELECT c, s, unnest(range(len(s) + 1)) AS d FROM rebuilt),
        members AS (
          SELECT c, d, md5(s[1:d]::VARCHAR) AS p, md5(s[1:d - 1]::VARCHAR) AS q, d = len(s) AS is_last,
                 CASE WHEN d > 0 THEN strlen(s[d].text) ELSE 0 END AS size FROM depths),
        nodes AS (
          SELECT d, p, min(q) AS q, min(c) AS c, count(*) AS n, max(size) AS size,
                 sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (is_last), '')) AS ends
          FROM members GROUP BY d, p),
        families AS (SELECT d - 1 AS d, q AS p, count(*) AS k FROM nodes WHERE d > 0 GROUP BY d, q),
        sized AS (SELECT d, p, n, size, coalesce(k, 0) AS k FROM nodes LEFT JOIN families USING (d, p)),
        below AS (
          SELECT DISTINCT u.d AS d, u.p AS p, v.d AS vd, v.p AS vp FROM members u JOIN members v ON u.c = v.c AND v.d >= u.d),
        sums AS (
          SELECT below.d, below.p, count(*) FILTER (k = 0) AS leaves, sum((n - 1) * size) AS saved
          FROM below JOIN sized ON sized.d = vd AND sized.p = vp GROUP BY ALL)
        SELECT x.c AS conv_id, x.d AS depth, y.c AS parent_conv_id, x.n AS n_convs, sized.k AS n_children,
               leaves AS n_leaves, saved::BIGINT AS saved_tokens, x.ends AS ends_sha256
        FROM nodes x JOIN sized USING (d, p) JOIN sums USING (d, p) LEFT JOIN nodes y ON x.d > 0 AND y.d = x.d - 1 AND y.p = x.q""",
    "op13_url_filters": """
        WITH rests AS (
          SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
        parts AS (
          SELECT page_id, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
                 translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host FROM rests),
        rules(host, path, verdict) AS (
          VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
        best AS (
          SELECT u.host, u.path, arg_max({'rule': r.host || r.path, 'verdict': verdict}, length(r.host || r.path)) AS found
          FROM (SELECT DISTINCT host, path FROM parts) u JOIN rules r
          ON starts_with(u.path, r.path) AND (u.host = r.host OR ends_with(u.host, '.' || r.host)) GROUP BY u.host, u.path)
        SELECT page_id, host, path, found.rule AS rule, coalesce(found.verdict, 'allow') AS verdict
        FROM parts LEFT JOIN best USING (host, path)""",
}
