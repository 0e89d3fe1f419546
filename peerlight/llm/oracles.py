"""DuckDB SQL with the same rows as the contract queries that SQL can express."""

_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)

SQL: dict[str, str] = {
    "op3_warc": """
        WITH page AS (
            SELECT page_id, coalesce(html, '') AS html, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
                sha1(coalesce(html, '')) AS payload_digest
            FROM pages),
        named AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last_id FROM page)
        SELECT page_id, payload_bytes, payload_digest,
            CASE WHEN payload_bytes >= 1000 AND page_id <> last_id THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN payload_bytes >= 1000 AND page_id <> last_id THEN last_id END AS refers_to
        FROM named
    """,
    "op5_decontamination": f"""
        WITH item AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
        win AS (
            SELECT DISTINCT item, list_slice(w, i, i + least(len(w), 10) - 1) AS win
            FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM item WHERE len(w) > 0)),
        doc AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        pos AS (
            SELECT doc_id, i, n, list_slice(w, i, i + n - 1) AS win
            FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
                  FROM doc, (SELECT DISTINCT len(win) AS n FROM win) WHERE len(w) >= n)),
        found AS (SELECT doc_id, i, n, item FROM pos JOIN win USING (win)),
        hit AS (
            SELECT doc_id, count(DISTINCT p) AS n_hit
            FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
        items AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
            FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
            CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
            coalesce(n_hit, 0) > 0 AS contaminated
        FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
    """,
    "op9_line_dedup": """
        WITH line AS (
            SELECT doc_id, i, s[i] AS line,
                translate(trim(s[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
            FROM (SELECT doc_id, s, unnest(range(1, len(s) + 1)) AS i
                  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents))),
        held AS (
            SELECT k, min(doc_id) AS first_doc FROM line WHERE length(k) >= 10
            GROUP BY k HAVING count(DISTINCT doc_id) > 1),
        marked AS (SELECT line.*, coalesce(first_doc <> doc_id, false) AS gone FROM line LEFT JOIN held USING (k))
        SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
            sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM marked GROUP BY doc_id
    """,
    "op1_ngram_jaccard": f"""
        WITH RECURSIVE doc AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        gram AS (
            SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS g
            FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 5, 0) + 2)) AS i FROM doc WHERE len(w) > 0)),
        size AS (SELECT doc_id, count(*) AS n FROM gram GROUP BY doc_id),
        pair AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
            FROM gram a JOIN gram b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
        link AS (
            SELECT a, b, c = x.n AND c = y.n AS same FROM pair JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
            WHERE c >= 0.8 * (x.n + y.n - c) - 1e-9),
        reach(a, b) AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b),
        lowest AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
        own AS (SELECT a, count(*) AS n_links, min(b) FILTER (WHERE same) AS twin FROM link GROUP BY a)
        SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, least(doc_id, coalesce(twin, doc_id)) AS class_id,
            CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, least(doc_id, coalesce(b, doc_id)) AS component_id,
            doc_id <= coalesce(b, doc_id) AS kept
        FROM doc LEFT JOIN size USING (doc_id) LEFT JOIN lowest ON lowest.a = doc_id LEFT JOIN own ON own.a = doc_id
    """,
    "op4_embeddings": """
        WITH RECURSIVE v AS (
            SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS norm
            FROM (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
                  WHERE label IS NOT NULL AND embedding IS NOT NULL
                    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
            WHERE list_dot_product(e, e) > 0),
        link AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
            WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.93),
        reach(a, b) AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b),
        lowest AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
        own AS (SELECT a, count(*) AS n_links FROM link GROUP BY a)
        SELECT vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, least(vec_id, coalesce(b, vec_id)) AS component_id,
            vec_id <= coalesce(b, vec_id) AS kept
        FROM embeddings LEFT JOIN lowest ON lowest.a = vec_id LEFT JOIN own ON own.a = vec_id
    """,
    "op11_importance_resampling": f"""
        WITH crc AS (
            SELECT list(list_reduce([i] || range(0, 8),
                lambda c, step: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
            FROM (SELECT unnest(range(0, 256)) AS i)),
        doc AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        word AS (
            SELECT 's' AS side, doc_id, unnest(w) AS w FROM doc
            UNION ALL SELECT 't', NULL, unnest(w) FROM (SELECT {_WORDS} AS w FROM benchmark)),
        hashed AS (
            SELECT w, xor(list_reduce([4294967295] || b, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket
            FROM crc, (
                SELECT w, list_transform(range(0, strlen(w)), lambda i: CAST('0x' || substr(hex(w), 2 * i + 1, 2) AS BIGINT)) AS b
                FROM (SELECT DISTINCT w FROM word))),
        held AS (SELECT side, doc_id, bucket FROM word JOIN hashed USING (w)),
        size AS (SELECT count(*) FILTER (WHERE side = 's') AS sall, count(*) FILTER (WHERE side = 't') AS tall FROM held),
        gain AS (
            SELECT bucket, floor(1000 * ln(((t + 1) * (sall + 10000)::DOUBLE) / ((s + 1) * (tall + 10000)::DOUBLE))) AS g
            FROM size, (SELECT bucket, count(*) FILTER (WHERE side = 's') AS s, count(*) FILTER (WHERE side = 't') AS t FROM held GROUP BY bucket)),
        total AS (SELECT doc_id, count(*) AS n, floor(sum(g) / count(*)) AS weight FROM held JOIN gain USING (bucket) WHERE side = 's' GROUP BY doc_id),
        scored AS (
            SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
                CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
            FROM doc LEFT JOIN total USING (doc_id)),
        ranked AS (
            SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS able FROM scored WHERE n_features >= 20)
        SELECT scored.*, CASE WHEN r <= 10 * able // 100 THEN r END AS rank FROM scored LEFT JOIN ranked USING (doc_id)
    """,
    "op12_collocations": """
        WITH piece AS (
            SELECT lang, regexp_extract_all(p, '[^ \\t]+') AS w
            FROM (
                SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS p
                FROM documents)),
        total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM piece GROUP BY lang),
        gram AS (
            SELECT lang, list_slice(w, i, i + k - 1) AS g
            FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM piece, range(1, 6) AS s(k) WHERE len(w) >= k)),
        held AS (SELECT lang, g, count(*) AS f FROM gram GROUP BY ALL HAVING f >= 100),
        cand AS (SELECT lang, g, f AS a, len(g) AS size FROM held WHERE len(g) > 1),
        inner_part AS (
            SELECT lang, list_slice(g, i, i + k - 1) AS g, max(a) AS longer
            FROM (SELECT lang, g, a, size, k, unnest(range(1, size - k + 2)) AS i FROM cand, range(2, 5) AS s(k) WHERE size > k) GROUP BY ALL),
        kept AS (SELECT cand.* FROM cand LEFT JOIN inner_part USING (lang, g) WHERE longer IS NULL OR longer < a),
        cut AS (SELECT *, unnest(range(1, size)) AS k FROM kept),
        scored AS (
            SELECT cut.lang, cut.g, a, k, x.f AS l, y.f AS r, n, CAST((1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
            FROM cut JOIN held x ON x.lang = cut.lang AND x.g = list_slice(cut.g, 1, k)
            JOIN held y ON y.lang = cut.lang AND y.g = list_slice(cut.g, k + 1, size) JOIN total ON total.lang = cut.lang),
        weakest AS (
            SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
        ranked AS (
            SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank,
                array_to_string(g, ' ') AS phrase, a, l, r, n, score FROM weakest)
        SELECT * FROM ranked WHERE rank <= 2000
    """,
}
