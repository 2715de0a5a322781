"""The dealt operators in SQL for DuckDB, where SQL can express them."""

ORACLE = {
    "op6_exact_dedup": """
        WITH texts AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                     'abcdefghijklmnopqrstuvwxyz') AS norm
            FROM documents)
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(norm) AS text_sha256
        FROM texts WINDOW same AS (PARTITION BY norm)""",
    "op10_warc": """
        WITH payloads AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
                   sha256(coalesce(html, '')) AS payload_digest
            FROM pages),
        firsts AS (
            SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM payloads)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id <> first_id
                    THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
        FROM firsts""",
    "op8_mix_sources": """
        WITH RECURSIVE docs AS (
            SELECT doc_id, source,
                   len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\r]+')) AS n_tokens
            FROM documents),
        totals AS (
            SELECT source, sum(n_tokens)::BIGINT AS tokens FROM docs GROUP BY source),
        whole AS (
            SELECT sum(tokens)::BIGINT AS budget, 0.95 * ln(count(*)) AS target
            FROM totals WHERE tokens > 0),
        shares AS (
            SELECT source, tokens, tokens / budget::DOUBLE AS share
            FROM totals, whole WHERE tokens > 0),
        -- Of three searches over exponents in millionths of a binary million: the first with at most
        -- the target entropy, the first below 1 and the last above 1 that repeat no source too often.
        tried(search, low, high) AS (
            SELECT * FROM (VALUES (1, -1, 67108864), (2, -1, 1048576), (3, 1048576, 67108865))
            UNION ALL
            SELECT search, CASE WHEN holds THEN low ELSE middle END, CASE WHEN holds THEN middle ELSE high END
            FROM (
                SELECT search, low, high, middle, CASE search
                       WHEN 1 THEN ln(sum(p)) - sum(CASE WHEN p > 0 THEN p * ln(p) ELSE 0 END) / sum(p)
                                   <= any_value(target) + 1e-12
                       WHEN 2 THEN any_value(budget) * max(p / tokens) / sum(p) <= 4.0 + 1e-12
                       ELSE any_value(budget) * max(p / tokens) / sum(p) > 4.0 + 1e-12 END AS holds
                FROM (
                    SELECT search, low, high, (low + high) // 2 AS middle, tokens, budget, target,
                           pow(share, ((low + high) // 2) / 1048576.0) AS p
                    FROM tried, shares, whole WHERE high - low > 1)
                GROUP BY search, low, high, middle)),
        found AS (
            SELECT least(greatest(min(high) FILTER (search = 1), min(high) FILTER (search = 2)),
                         max(low) FILTER (search = 3)) / 1048576.0 AS exponent
            FROM tried),
        powered AS (SELECT source, tokens, pow(share, exponent) AS p FROM shares, found),
        exact AS (
            SELECT source, tokens, budget, p / (SELECT sum(p) FROM powered) * budget AS quota
            FROM powered, whole),
        floored AS (
            SELECT *, floor(quota + 1e-6 + quota * 1e-12)::BIGINT AS held FROM exact),
        ranked AS (
            SELECT *, row_number() OVER (ORDER BY quota - held DESC, source NULLS FIRST) AS place,
                   budget - sum(held) OVER () AS missing
            FROM floored),
        planned AS (
            SELECT source, tokens, held + CASE WHEN place <= missing THEN 1 ELSE 0 END AS quota
            FROM ranked),
        epochs AS (
            SELECT source, quota // tokens AS whole_epochs, quota % tokens AS rest FROM planned),
        placed AS (
            SELECT d.doc_id, d.source, whole_epochs, rest, sum(n_tokens) OVER (
                       PARTITION BY d.source
                       ORDER BY md5(concat_ws('|', 'mix-1', whole_epochs + 1, d.doc_id))) AS upto
            FROM docs d JOIN epochs e ON d.source IS NOT DISTINCT FROM e.source),
        copies AS (
            SELECT doc_id, source, unnest(range(1, whole_epochs + 1
                       + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END)) AS epoch
            FROM placed)
        SELECT doc_id, source, epoch, md5(concat_ws('|', 'mix-1', epoch, doc_id)) AS place
        FROM copies""",
    "op13_merkle": """
        WITH RECURSIVE ids AS (
            SELECT *, row_number() OVER () AS row_id, xor(4294967295, list_reduce(
                       list_concat([4294967295::BIGINT], flatten(list_transform(
                           string_split(doc_id::VARCHAR, ''),
                           lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
                       lambda crc, byte: CASE WHEN byte >= 0 THEN xor(crc, byte)
                                      ELSE xor(crc >> 1, (crc & 1) * 3988292384) END)) AS crc
            FROM documents),
        texts AS (
            SELECT *, concat(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR, '-'),
                             coalesce(strlen(source) || ':' || source, '-'),
                             coalesce(strlen(lang) || ':' || lang, '-'),
                             coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars::VARCHAR, '-')) AS head,
                   CASE WHEN crc % 5 = 0
                        THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
                        ELSE text END AS other
            FROM ids),
        leaves AS (
            SELECT row_id, doc_id, source,
                   sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                   sha256(head || coalesce(strlen(other) || ':' || other, '-')) AS claimed,
                   row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS place,
                   count(*) OVER (PARTITION BY source) AS total
            FROM texts),
        nodes(level, tree, place, total, digest) AS (
            SELECT 0, source, place, total, leaf FROM leaves
            UNION ALL
            SELECT level + 1, tree, place // 16, (any_value(total) + 15) // 16,
                   sha256(string_agg(digest, '' ORDER BY place))
            FROM nodes WHERE total > 1 GROUP BY level, tree, place // 16),
        roots AS (
            SELECT tree AS source, digest, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS place,
                   count(*) OVER () AS total
            FROM nodes WHERE total = 1),
        tops(level, place, total, digest) AS (
            SELECT 0, place, total, digest FROM roots
            UNION ALL
            SELECT level + 1, place // 16, (any_value(total) + 15) // 16,
                   sha256(string_agg(digest, '' ORDER BY place))
            FROM tops WHERE total > 1 GROUP BY level, place // 16),
        every AS (
            SELECT 0 AS part, level, tree, place, digest FROM nodes WHERE total > 1
            UNION ALL
            SELECT 1, level, NULL, place, digest FROM tops WHERE total > 1),
        steps AS (
            SELECT part, level, tree, place,
                   coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
                   coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
            FROM every WINDOW run AS (PARTITION BY part, level, tree, place // 16 ORDER BY place)),
        climbed(row_id, source, part, level, place, digest, proof) AS (
            SELECT row_id, source, 0, 0, place, claimed, '' FROM leaves
            UNION ALL
            SELECT c.row_id, c.source,
                   CASE WHEN s.level IS NULL THEN 1 ELSE c.part END,
                   CASE WHEN s.level IS NULL THEN 0 ELSE c.level + 1 END,
                   CASE WHEN s.level IS NULL THEN r.place ELSE c.place // 16 END,
                   CASE WHEN s.level IS NULL THEN c.digest ELSE sha256(s.before || c.digest || s.after) END,
                   CASE WHEN s.level IS NULL THEN c.proof ELSE c.proof || s.before || s.after END
            FROM climbed c
            JOIN roots r ON c.source IS NOT DISTINCT FROM r.source
            LEFT JOIN steps s ON c.part = s.part AND c.level = s.level AND c.place = s.place
                 AND (CASE WHEN c.part = 0 THEN c.source END) IS NOT DISTINCT FROM s.tree
            WHERE s.level IS NOT NULL OR c.part = 0),
        ends AS (
            SELECT * FROM climbed
            WHERE part = 1 AND level = (SELECT max(level) FROM tops))
        SELECT l.doc_id, l.leaf, r.digest AS subroot, t.digest AS root, sha256(e.proof) AS proof_sha256,
               e.digest AS folded_root, e.digest = t.digest AS verified
        FROM leaves l JOIN ends e USING (row_id)
        JOIN roots r ON l.source IS NOT DISTINCT FROM r.source
        JOIN tops t ON t.total = 1""",
    "op12_fill_in_middle": """
        WITH texts AS (
            SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || doc_id::VARCHAR) AS hash
            FROM documents),
        cut AS (
            SELECT *, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS units,
                   ('0x' || hash[1:8])::BIGINT AS h1, ('0x' || hash[9:16])::BIGINT AS h2,
                   ('0x' || hash[17:24])::BIGINT AS h3, ('0x' || hash[25:32])::BIGINT AS h4
            FROM texts),
        formed AS (
            SELECT *, len(units) AS n,
                   least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS first,
                   greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS last,
                   CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>')
                             OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                        WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
            FROM cut),
        parts AS (
            SELECT *, coalesce(list_aggregate(units[1:first], 'string_agg', ''), '') AS prefix,
                   coalesce(list_aggregate(units[first + 1:last], 'string_agg', ''), '') AS middle,
                   coalesce(list_aggregate(units[last + 1:], 'string_agg', ''), '') AS suffix
            FROM formed)
        SELECT doc_id, n, form,
               CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text
                                WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                                ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
               sha256(text) AS restored_sha256
        FROM parts""",
}
