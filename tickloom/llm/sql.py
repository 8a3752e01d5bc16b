"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"

QUALITY_RULES = rf"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents
), windows AS (
    SELECT doc_id, i, array_to_string(w[i : i + 4], ' ') AS g
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)
), again AS (
    SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1
), covered AS (
    SELECT doc_id, count(DISTINCT i + k) AS n FROM again, range(5) t(k) GROUP BY doc_id
), lines AS (
    SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), m AS (
    SELECT d.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        coalesce(n_dup, 0)::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
        coalesce(n_lines, 0)::BIGINT AS n_lines
    FROM d LEFT JOIN covered c USING (doc_id) LEFT JOIN lines USING (doc_id)
), f AS (
    SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT (base_failed OR 100 * n_symbols > 10 * word_chars OR 100 * n_dup_lines > 30 * n_lines
         OR word_chars < 2 * n_words OR word_chars > 15 * n_words) AS kept
FROM f
"""

QUALITY_ABLATIONS = QUALITY_RULES[: QUALITY_RULES.rindex("SELECT doc_id, n_words")] + r"""
, bits AS (
    SELECT (n_words < 10)::INT AS few_words, (100 * n_repeat_words > 20 * n_words)::INT AS repeated_words,
        (100 * n_symbols > 10 * word_chars)::INT AS symbols, (100 * n_dup_lines > 30 * n_lines)::INT AS repeated_lines,
        (word_chars < 2 * n_words)::INT AS short_words, (word_chars > 15 * n_words)::INT AS long_words
    FROM f
), rules AS (
    SELECT unnest(['few_words', 'repeated_words', 'symbols', 'repeated_lines', 'short_words', 'long_words']) AS rule,
        unnest([few_words, repeated_words, symbols, repeated_lines, short_words, long_words]) AS failed,
        few_words + repeated_words + symbols + repeated_lines + short_words + long_words AS n
    FROM bits
)
SELECT rule, sum(failed)::BIGINT AS n_failed, count(*) FILTER (failed = 1 AND n = 1)::BIGINT AS n_failed_alone,
    count(*) FILTER (n > 0)::BIGINT AS n_rejected
FROM rules GROUP BY rule
"""

EXACT_DEDUP = r"""
WITH d AS (
    SELECT doc_id, length(coalesce(text, '')) AS points,
        sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
    FROM documents
)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY text_sha256)::BIGINT AS group_size,
    row_number() OVER best = 1 AS kept, text_sha256
FROM d WINDOW best AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id)
"""

SOURCE_MIX = r"""
WITH d AS (
    SELECT doc_id, coalesce('0' || source, '1') AS source, md5(doc_id::VARCHAR) AS ord,
        len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
    FROM documents
), s AS (
    SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source) - 1) % 3 AS turn FROM d GROUP BY source
), w AS (
    SELECT *, [5, 2, 1][turn + 1] AS weight, 3 * source_size AS most FROM s
), c AS (
    SELECT *, sum(source_size) OVER ()::BIGINT AS total,
        coalesce(sum(most) OVER (ORDER BY most / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS above,
        sum(weight) OVER (ORDER BY most / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT AS weights
    FROM w
), f AS (SELECT *, weight * (total - above) > most * weights AS capped FROM c
), t AS (
    SELECT source, source_size, turn, CASE WHEN capped THEN most::DOUBLE ELSE
        weight * (total - coalesce(sum(most) FILTER (capped) OVER (), 0)::BIGINT)
        / (sum(weight) FILTER (NOT capped) OVER ())::BIGINT END AS target
    FROM f
), p AS (
    SELECT doc_id, size, source_size, target, turn,
        CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole,
        coalesce(sum(size) OVER (PARTITION BY source ORDER BY ord, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS place
    FROM d JOIN t USING (source)
), k AS (
    SELECT *, CASE WHEN size > 0 THEN least(whole + (place + size / 2 <= target - whole * source_size)::INT, 3) ELSE 0 END AS copies,
        least((place + size / 2) / target, 1.0) AS done
    FROM p
)
SELECT doc_id, size, source_size, target, (size * copies)::BIGINT AS taken,
    CASE WHEN copies > 0 THEN round(CASE turn
        WHEN 0 THEN 2 * done / (1.5 + sqrt(greatest(0, 2.25 - 2 * done)))
        WHEN 1 THEN done
        ELSE CASE WHEN done * 1 <= 0.3125 THEN 2 * done / (0.5 + sqrt(greatest(0, 0.25 + done)))
             ELSE 0.5 + 2 * (done - 0.3125) / (0.75 + sqrt(greatest(0, 0.5625 + 5 * (done - 0.3125)))) END
        END, 6) END AS first_position
FROM k
"""

NGRAM_JOIN = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), s AS (
    SELECT doc_id, CASE WHEN len(w) >= 3 THEN list_distinct([array_to_string(w[i : i + 2], ' ') FOR i IN range(1, len(w) - 1)])
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS g
    FROM d
), c AS (
    SELECT doc_id, g, len(g)::BIGINT AS n, md5(array_to_string(list_sort(g), chr(10))) AS class FROM s
), classes AS (
    SELECT class, min(doc_id) AS id, any_value(g) AS g, any_value(n) AS n FROM c WHERE n > 0 GROUP BY class
), e AS (SELECT id, n, unnest(g) AS x FROM classes
), links AS (
    SELECT a.id AS i, b.id AS j FROM e a JOIN e b ON a.x = b.x AND a.id < b.id
    GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), ways AS (SELECT i, j FROM links UNION ALL SELECT j, i FROM links
), reach AS (
    SELECT id, id AS r FROM classes UNION SELECT w.j, r FROM reach JOIN ways w ON w.i = reach.id
), roots AS (SELECT id, min(r) AS root FROM reach GROUP BY id)
SELECT doc_id, c.n AS n_shingles, coalesce(root, doc_id) AS component_id
FROM c LEFT JOIN classes k ON k.class = c.class AND c.n > 0 LEFT JOIN roots ON roots.id = k.id
"""

SUBSTRING_DEDUP = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
    SELECT doc_id, i, md5(array_to_string(w[i : i + 19], ' ')) AS g
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)
), again AS (
    SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY g ORDER BY doc_id, i) > 1
), gone AS (
    SELECT DISTINCT doc_id, i + k AS p FROM again, range(20) t(k)
), removed AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id
), words AS (
    SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d
), kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(removed.n, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN removed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


#: CRC-32 of a conversation id's decimal text, by its table of 256 entries.
PREFIX_TRIE = r"""
WITH crc AS (
    SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n::BIGINT, range(8)),
        lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS tab
), t AS (
    SELECT conv_id::BIGINT AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), o AS (
    SELECT c, role, text, row_number() OVER (PARTITION BY c
        ORDER BY turn NULLS FIRST, sha256(strlen(role)::VARCHAR || ':' || role || text)) AS p FROM t
), k AS (
    SELECT c, n, c - c % 5 AS base, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
        list_transform(string_split(c::VARCHAR, ''), lambda x: ord(x)::BIGINT)), lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1]))) % 9 AS h
    FROM (SELECT c, count(*) AS n FROM t GROUP BY c), crc
), r AS (
    SELECT k.c, p AS d, role, text FROM k JOIN o ON o.c = k.base AND p <= h
    UNION ALL
    SELECT k.c, p - k.h + least(k.h, coalesce(b.n, 0)), role, text FROM k JOIN o ON o.c = k.c AND p > k.h LEFT JOIN k b ON b.c = k.base
), s AS (
    SELECT c, d, strlen(text)::BIGINT AS bytes, sha256(string_agg(strlen(role)::VARCHAR || ':' || strlen(text)::VARCHAR || ':' || role || text, ''
        ORDER BY d) OVER (PARTITION BY c ORDER BY d)) AS node, d = max(d) OVER (PARTITION BY c) AS last
    FROM r
    UNION ALL
    SELECT c, 0, 0, '', c NOT IN (SELECT c FROM r) FROM k
), v AS (
    SELECT s.*, lag(node) OVER (PARTITION BY c ORDER BY d) AS up FROM s
), n AS (
    SELECT node, d, any_value(up) AS up, min(c) AS c, count(*) AS n_convs, any_value(bytes) AS bytes,
        sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (last), '')) AS ends_sha256
    FROM v GROUP BY node, d
), w AS (
    SELECT n.*, (SELECT count(*) FROM n x WHERE x.up = n.node AND x.d = n.d + 1) AS n_children FROM n
), totals AS (
    SELECT a.node, a.d, sum((w.n_children = 0)::BIGINT)::BIGINT AS n_leaves, sum((w.n_convs - 1) * w.bytes)::BIGINT AS saved_tokens
    FROM w JOIN v a ON a.c = w.c AND a.d <= w.d GROUP BY a.node, a.d
)
SELECT w.c AS conv_id, w.d::BIGINT AS depth, x.c AS parent_conv_id, w.n_convs::BIGINT AS n_convs, w.n_children::BIGINT AS n_children,
    n_leaves, saved_tokens, w.ends_sha256
FROM w JOIN totals USING (node, d) LEFT JOIN n x ON x.node = w.up AND x.d = w.d - 1
"""


COLLOCATIONS = r"""
WITH pieces AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents)
), grams AS (
    SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i : i + k - 1])) AS g
    FROM pieces, (VALUES (1), (2), (3)) t(k) WHERE len(w) >= k
), f AS (
    SELECT lang, k, g, count(*) AS a FROM grams GROUP BY lang, k, g
), sizes AS (
    SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang
), cuts AS (
    SELECT lang, k, g, a, unnest(range(1, k)) AS cut FROM f WHERE k > 1 AND a >= 10
), scored AS (
    SELECT c.lang, c.k, c.g, c.a, l.a AS l, r.a AS r, 1000000::HUGEINT * c.a * c.a // (l.a::HUGEINT * r.a) AS score
    FROM cuts c JOIN f l ON l.lang = c.lang AND l.g = c.g[1 : cut] JOIN f r ON r.lang = c.lang AND r.g = c.g[cut + 1 :]
    QUALIFY row_number() OVER (PARTITION BY c.lang, c.g ORDER BY score, cut) = 1
), longer AS (
    SELECT lang, g[i : i + 1] AS g, max(a) AS b FROM scored, (VALUES (1), (2)) t(i) WHERE k = 3 GROUP BY ALL
), ranked AS (
    SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, array_to_string(s.g, ' ')) AS rank
    FROM scored s LEFT JOIN longer USING (lang, g) WHERE b IS NULL OR 100 * b < 50 * a
)
SELECT lang, rank::BIGINT AS rank, array_to_string(g, ' ') AS phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000
"""


#: Enumerates all combinations of the chosen tokens, where the operator mines them. The bound on
#: labelled URLs, which smaller tables do not reach, is left out.
URL_FILTER = r"""
WITH parts AS (
    SELECT DISTINCT url, regexp_extract(url, '(?s)^(.*?)://', 1) AS scheme,
        translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path, regexp_extract(url, '(?s)^.*?://[^?#]*\?([^#]*)', 1) AS query,
        regexp_extract(url, '(?s)^.*?://[^#]*#(.*)$', 1) AS fragment, string_split(host, '.') AS labels
    FROM pages WHERE contains(url, '://')
), u AS (
    SELECT url, host, path, list_distinct(list_concat(
        list_transform(list_filter([scheme], lambda x: x <> ''), lambda x: 's:' || x),
        list_transform(list_filter(list_append(list_transform(range(1, least(len(labels), 4) + 1), lambda n: array_to_string(labels[-n:], '.')), host), lambda x: x <> ''), lambda x: 'h:' || x),
        list_transform(list_filter(string_split(path, '/'), lambda x: x <> ''), lambda x: 'p:' || regexp_replace(x, '[0-9]+', '0', 'g')),
        list_transform(list_filter(string_split(query, '&'), lambda x: x <> ''), lambda x: 'q:' || regexp_replace(x, '[0-9]+', '0', 'g')),
        list_transform(list_filter([fragment], lambda x: x <> ''), lambda x: 'f:' || regexp_replace(x, '[0-9]+', '0', 'g'))
    )) AS tokens FROM parts
), judged AS (
    SELECT doc_id, max(coalesce(quality = 0 OR toxic = 1, false)::INT) AS bad FROM labels GROUP BY doc_id
), t AS (
    SELECT url, tokens, bad FROM u JOIN judged ON doc_id = TRY_CAST(regexp_extract(path, '([0-9]{1,18})[^0-9]*$', 1) AS BIGINT)
), spread AS (
    SELECT url, bad, unnest(tokens) AS token FROM t
), worth AS (
    SELECT token, count(*) AS n, sum(bad) AS n_bad FROM spread GROUP BY token HAVING sum(bad) >= 10
), chosen AS (
    SELECT url, bad, token FROM spread JOIN worth USING (token)
    QUALIFY row_number() OVER (PARTITION BY url ORDER BY n_bad / n DESC, n_bad DESC, token) <= 10
), baskets AS (
    SELECT url, bad, list(token ORDER BY token) AS items FROM chosen GROUP BY url, bad
), sets AS (
    SELECT bad, list_filter(items, lambda x, i: (pick >> (i - 1)) & 1 = 1) AS items
    FROM (SELECT *, unnest(range(1, (1 << len(items)))) AS pick FROM baskets)
), candidates AS (
    SELECT items FROM sets GROUP BY items HAVING sum(bad) >= 10 AND sum(bad) / count(*) >= 0.5
), sure AS (
    SELECT items, sum(bad) AS support, sum(bad) / count(*) AS confidence FROM candidates JOIN t ON list_has_all(tokens, items)
    GROUP BY items HAVING sum(bad) >= 10 AND sum(bad) / count(*) >= 0.5
), rules AS (
    SELECT array_to_string(items, ' ') AS mined, * FROM sure s WHERE NOT EXISTS (
        SELECT 1 FROM sure x WHERE x.items <> s.items AND list_has_all(s.items, x.items) AND x.confidence >= s.confidence)
), hits AS (
    SELECT url, mined, confidence FROM u JOIN rules ON list_has_all(tokens, items)
    QUALIFY row_number() OVER (PARTITION BY url ORDER BY confidence DESC, support DESC, mined DESC) = 1
), fixed(verdict, h, p) AS (
    VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), listed AS (
    SELECT url, h || p AS rule, verdict FROM u JOIN fixed ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
    QUALIFY row_number() OVER (PARTITION BY url ORDER BY length(h || p) DESC, length(h) DESC) = 1
)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule,
    coalesce(verdict, CASE WHEN mined IS NULL THEN 'allow' ELSE 'block' END) AS verdict, mined, confidence
FROM pages LEFT JOIN u USING (url) LEFT JOIN listed USING (url) LEFT JOIN hits USING (url)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_ngram_join": NGRAM_JOIN,
        "op4_substring_dedup": SUBSTRING_DEDUP,
        "op5_exact_dedup": EXACT_DEDUP,
        "op6_quality_rules": QUALITY_RULES,
        "quality_ablations": QUALITY_ABLATIONS,
        "op8_source_mix": SOURCE_MIX,
        "op11_prefix_trie": PREFIX_TRIE,
        "op12_url_filter": URL_FILTER,
        "op13_collocations": COLLOCATIONS,
    }
