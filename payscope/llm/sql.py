"""The queries in SQL, where it can express them."""

SQL = {
    "op1_chat_format": """
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL
            SELECT -1, turn, role, '<|im_end|><|im_start|>assistant ok'
            FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(turn, role)
        ), seen AS (
            SELECT *, row_number() OVER w AS n, lag(role) OVER w AS before,
                   replace(replace(text, '&', '&amp;'), '<|', '&lt;|') AS body,
                   replace(replace(replace(role, '&', '&amp;'), '<|', '&lt;|'), chr(10), '&#10;') AS head
            FROM turns
            WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
               sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
               sum(length(body) + CASE
                       WHEN before IS NULL THEN 12 + length(head) + 1 + 11
                       WHEN before = role THEN 10
                       ELSE 11 + 12 + length(head) + 1 END)::BIGINT AS formatted_chars
        FROM seen GROUP BY conv_id
    """,
    "op6_warc": """
        WITH sized AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
            FROM pages
        ), firsts AS (
            SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM sized
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
        FROM firsts
    """,
    "op9_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op10_suffix_dedup": """
        WITH docs AS (
            SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
        ), sized AS (
            SELECT doc_id, h, length(h) // 2 AS n FROM docs
        ), starts AS (
            SELECT doc_id, s, md5_number(substr(h, 2 * s + 1, 200)) AS x
            FROM (SELECT doc_id, h, unnest(range(n - 99)) AS s FROM sized WHERE n >= 100)
        ), again AS (
            SELECT doc_id, s FROM starts QUALIFY row_number() OVER (PARTITION BY x ORDER BY doc_id, s) > 1
        ), runs AS (
            SELECT doc_id, s, sum(new) OVER (PARTITION BY doc_id ORDER BY s) AS run
            FROM (SELECT doc_id, s, CASE WHEN s <= lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 100 THEN 0 ELSE 1 END AS new
                  FROM again)
        ), spans AS (
            SELECT doc_id, min(s) AS a, max(s) + 100 AS z FROM runs GROUP BY doc_id, run
        ), pieces AS (
            SELECT doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS b FROM spans
        ), cut AS (
            SELECT doc_id, count(*) AS n_spans, sum(z - a) AS n_removed, max(z) AS z,
                   string_agg(substr(h, 2 * b + 1, 2 * (a - b)), '' ORDER BY a) AS head
            FROM pieces JOIN sized USING (doc_id) GROUP BY doc_id
        )
        SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
               sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(z, 0) + 1))) AS kept_sha256
        FROM sized LEFT JOIN cut USING (doc_id)
    """,
    "op11_collocations": """
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang,
                   unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[.,;:!?\\x0A-\\x0D]')) AS piece
            FROM documents
        ), spoken AS (
            SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces
        ), sizes AS (
            SELECT lang, sum(len(w))::HUGEINT AS n FROM spoken GROUP BY lang
        ), starts AS (
            SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM spoken
        ), grams AS (
            SELECT lang, w[i : i + m - 1] AS p FROM starts, range(1, 6) AS t(m) WHERE i + m - 1 <= len(w)
        ), f AS (
            SELECT lang, p, count(*)::HUGEINT AS f FROM grams GROUP BY lang, p HAVING count(*) >= 100
        ), parted AS (
            SELECT lang, p, f AS a, unnest(range(1, len(p))) AS k FROM f WHERE len(p) > 1
        ), cut AS (
            SELECT c.lang, c.p, c.a, c.k, x.f AS l, y.f AS r, n, 1000 * c.a * n // (x.f * y.f) AS score
            FROM parted c
            JOIN f x ON x.lang = c.lang AND x.p = c.p[1 : c.k]
            JOIN f y ON y.lang = c.lang AND y.p = c.p[c.k + 1 :]
            JOIN sizes s ON s.lang = c.lang
        ), inside AS (
            SELECT DISTINCT b.lang, b.p[i : i + m - 1] AS p, b.f
            FROM f b, range(1, 5) AS s(i), range(2, 5) AS t(m) WHERE m < len(b.p) AND i + m - 1 <= len(b.p)
        ), scored AS (
            SELECT * FROM cut WHERE NOT EXISTS (FROM inside v WHERE v.lang = cut.lang AND v.p = cut.p AND v.f >= cut.a)
            QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1
        ), ranked AS (
            SELECT *, array_to_string(p, ' ') AS phrase,
                   row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(array_to_string(p, ' '))) AS rank
            FROM scored
        )
        SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
        FROM ranked WHERE rank <= 2000
    """,
}
