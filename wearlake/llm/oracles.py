"""The same questions as SQL, where SQL can ask them."""

from __future__ import annotations

ORACLES: dict[str, str] = {
    "op4_quality_rules": r"""
WITH base AS (
    SELECT doc_id, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
        list_filter(string_split(coalesce(text, ''), chr(10)),
                    lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM documents
), windows AS (
    SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM base WHERE len(w) > 2)
), twice AS (
    SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1
), repeated AS (
    SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) AS places(k) GROUP BY doc_id
), counted AS (
    SELECT base.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
        len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
        length(regexp_replace(text, '[^\p{Lu}]+', '', 'g')) AS capitals, len(lines) AS n_lines,
        len(list_filter(w, lambda x: lower(x) IN (
            'a', 'an', 'and', 'are', 'as', 'at', 'be', 'by', 'for', 'from', 'in', 'is', 'it', 'of',
            'on', 'or', 'that', 'the', 'this', 'to', 'was', 'with',
            'au', 'aux', 'avec', 'dans', 'de', 'des', 'du', 'en', 'et', 'la', 'le', 'les', 'par',
            'pour', 'que', 'qui', 'sur', 'un', 'une',
            'con', 'del', 'el', 'los', 'las', 'lo', 'no', 'para', 'por', 'se', 'su', 'y',
            'auf', 'das', 'dem', 'den', 'der', 'die', 'ein', 'eine', 'ist', 'mit', 'nicht', 'sich',
            'und', 'von', 'zu'))) AS stops
    FROM base LEFT JOIN repeated ON base.doc_id IS NOT DISTINCT FROM repeated.doc_id
), judged AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND word_chars / n_words BETWEEN 2.5 AND 15 AND n_symbols / n_words <= 0.1
        AND capitals / word_chars <= 0.4 AND stops / n_words >= 0.01
        AND n_dup_lines / n_lines <= 0.5 AS kept
FROM judged
""",
    "op7_line_dedup": r"""
WITH cut AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no
    FROM documents
), bare AS (
    SELECT doc_id, line_no, regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS line FROM cut
), counted AS (
    SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words FROM bare WHERE line <> ''
), running AS (
    SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY line_no) AS done FROM counted
), placed AS (
    SELECT *, done - words AS begun FROM running
), windows AS (
    SELECT doc_id, min(line_no) OVER w AS low, max(line_no) OVER w AS high, sum(words) OVER w AS words,
        string_agg(line, chr(10)) OVER w AS content
    FROM placed WINDOW w AS (PARTITION BY doc_id ORDER BY begun RANGE BETWEEN CURRENT ROW AND 49 FOLLOWING)
    UNION
    SELECT doc_id, min(line_no) OVER w, max(line_no) OVER w, sum(words) OVER w, string_agg(line, chr(10)) OVER w
    FROM placed WINDOW w AS (PARTITION BY doc_id ORDER BY done RANGE BETWEEN 49 PRECEDING AND CURRENT ROW)
), later AS (
    SELECT doc_id, low, high FROM windows WHERE words >= 50
    QUALIFY row_number() OVER (PARTITION BY content ORDER BY doc_id, low) > 1
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(low, high + 1)) AS line_no FROM later
), remaining AS (
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone.line_no IS NOT NULL) AS n_removed,
        coalesce(string_agg(CAST(line_no AS VARCHAR), ',' ORDER BY line_no) FILTER (gone.line_no IS NOT NULL), '') AS removed,
        coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (gone.line_no IS NULL), '') AS text
    FROM cut LEFT JOIN gone USING (doc_id, line_no) GROUP BY doc_id
)
SELECT doc_id, n_lines, n_removed, removed, sha256(text) AS kept_sha256 FROM remaining
""",
    "op8_url_lists": r"""
WITH captures AS (
    SELECT page_id, url, CAST(DATE '2024-01-01' + CAST(page_id * 37 % 365 AS INTEGER) AS DATE) AS fetched,
        lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#@]*@)?([^/?#:]*)', 2)) AS host,
        string_split(lower(regexp_extract(url, '^[^:]*://[^/?#]*/([^?#]*)', 1)), '/') AS path
    FROM pages
), hosts AS (
    SELECT host, min(page_id) AS first FROM captures WHERE host <> '' GROUP BY host
), entries AS (
    SELECT host AS pattern, 'hosts' AS list, 'add' AS action, first % 300 AS day FROM hosts WHERE first % 3 = 0
    UNION ALL SELECT host, 'hosts', 'remove', first % 300 + 30 FROM hosts WHERE first % 6 = 0
    UNION ALL SELECT host, 'hosts', 'add', first % 300 + 90 FROM hosts WHERE first % 12 = 0
    UNION ALL SELECT host || '/en', 'sections', 'add', first % 200 FROM hosts WHERE first % 5 = 0
    UNION ALL SELECT host || '/en', 'sections', 'remove', first % 200 + 100 FROM hosts WHERE first % 10 = 0
    UNION ALL SELECT host[strpos(host, '.') + 1:], 'domains', 'add', first % 100 FROM hosts
        WHERE first % 7 = 0 AND len(string_split(host, '.')) > 3
), active AS (
    SELECT c.page_id, e.list || ':' || e.pattern AS hit
    FROM captures c JOIN entries e
        ON (c.host = e.pattern OR ends_with(c.host, '.' || e.pattern)
            OR (e.pattern = c.host || '/en' AND len(list_filter(c.path, lambda x: x <> '')) > 0
                AND list_filter(c.path, lambda x: x <> '')[1] = 'en'))
        AND DATE '2024-01-01' + CAST(e.day AS INTEGER) <= c.fetched
    GROUP BY c.page_id, e.list, e.pattern
    HAVING max_by(e.action, (e.day, e.action)) = 'add'
), hits AS (
    SELECT page_id, string_agg(hit, ',' ORDER BY hit) AS hits FROM active GROUP BY page_id
)
SELECT page_id, fetched, coalesce(hits, '') AS hits, hits IS NOT NULL AS blocked
FROM captures LEFT JOIN hits USING (page_id)
""",
    "op9_chat": r"""
WITH told AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL
    SELECT -1, n, CASE n WHEN 0 THEN 'user' ELSE 'assistant' END, '<|im_end|><|im_start|>assistant ok'
    FROM range(2) AS both_rows(n)
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
    sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
    CAST(sum(length('<|im_start|>' || role || chr(10)
        || regexp_replace(text, '<(\|+)', '<|\1', 'g') || '<|im_end|>' || chr(10))) AS BIGINT) AS formatted_chars
FROM told GROUP BY conv_id
""",
    "op11_prefix_trie": r"""
WITH lists AS (
    SELECT conv_id, list({'role': role, 'text': text} ORDER BY nth) AS t
    FROM (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
              row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS nth
          FROM conversations WHERE conv_id IS NOT NULL)
    GROUP BY conv_id
), hashed AS (
    SELECT conv_id, t, conv_id - conv_id % 100 AS base,
        xor(list_reduce(
            list_prepend(4294967295::BIGINT,
                list_transform(range(1, len(conv_id::VARCHAR) + 1), lambda i: ascii(substr(conv_id::VARCHAR, i, 1))::BIGINT)),
            lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, (x & 1) * 3988292384::BIGINT))
        ), 4294967295::BIGINT) % 6 AS h
    FROM lists
), rebuilt AS (
    SELECT a.conv_id, list_concat(coalesce(b.t[1:a.h], []), a.t[a.h + 1:]) AS s
    FROM hashed AS a LEFT JOIN lists AS b ON b.conv_id = a.base
), nodes AS (
    SELECT s[1:depth] AS p, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
        coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(s) = depth), '') AS ends
    FROM (SELECT conv_id, s, unnest(range(0, len(s) + 1)) AS depth FROM rebuilt)
    GROUP BY 1, 2
), kids AS (
    SELECT p[1:depth - 1] AS p, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1, 2
), valued AS (
    SELECT nodes.*, coalesce(n_children, 0) AS n_children,
        CASE WHEN nodes.depth > 0 THEN (n_convs - 1) * length(nodes.p[nodes.depth].text) ELSE 0 END AS own
    FROM nodes LEFT JOIN kids ON kids.p = nodes.p AND kids.depth = nodes.depth
), below AS (
    SELECT p[1:up] AS p, up AS depth, sum(own) AS saved, count(*) FILTER (n_children = 0) AS n_leaves
    FROM (SELECT p, own, n_children, unnest(range(0, depth + 1)) AS up FROM valued) GROUP BY 1, 2
)
SELECT v.conv_id, v.depth, parent.conv_id AS parent_conv_id, v.n_convs, v.n_children, below.n_leaves,
    CAST(below.saved AS BIGINT) AS saved_tokens, sha256(v.ends) AS ends_sha256
FROM valued AS v JOIN below ON below.p = v.p AND below.depth = v.depth
LEFT JOIN nodes AS parent ON parent.p = v.p[1:v.depth - 1] AND parent.depth = v.depth - 1
""",
    "op13_hard_negatives": """
WITH vectors AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
    FROM vectors AS a JOIN vectors AS b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
    CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INT) AS rank,
    vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 100 * score BETWEEN 30 * positive_score AND 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 10
""",
}
