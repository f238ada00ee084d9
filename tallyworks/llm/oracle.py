"""SQL counterparts, for DuckDB, of the corpus queries that SQL can express."""

OP11 = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), safe AS (
    SELECT *, regexp_replace(text, '([<\[])(\\*)(s>|/s>|SYS\]|/SYS\]|INST\]|/INST\]|ROLE\]|TEXT\]|/ROLE\])',
                             '\1\\\2\3', 'g') AS esc,
           regexp_replace(role, '([<\[])(\\*)(s>|/s>|SYS\]|/SYS\]|INST\]|/INST\]|ROLE\]|TEXT\]|/ROLE\])',
                          '\1\\\2\3', 'g') AS esc_role
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, esc)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, esc) FILTER (WHERE role = 'assistant'), ''))
           AS loss_sha256,
       (3 + sum(length(CASE role WHEN 'user' THEN '[INST] ' || esc || ' [/INST]'
                                 WHEN 'system' THEN '[SYS] ' || esc || ' [/SYS]'
                                 WHEN 'assistant' THEN ' ' || esc || '</s>'
                                 ELSE '[ROLE] ' || esc_role || ' [TEXT] ' || esc || ' [/ROLE]' END)))::BIGINT
           AS formatted_chars,
       -- the turns that the machine of roles does not allow
       any_value(faults)::BIGINT AS faults, any_value(last_role) = 'assistant' AND any_value(faults) = 0 AS valid
FROM safe JOIN (
    SELECT conv_id AS id, sum((CASE
               WHEN role = 'system' THEN before IS NOT NULL
               WHEN role = 'user' THEN coalesce(before NOT IN ('system', 'assistant'), FALSE)
               WHEN role = 'assistant' THEN before IS NULL OR before NOT IN ('user', 'tool')
               WHEN role = 'tool' THEN before IS NULL OR before <> 'assistant'
               ELSE TRUE END)::INT) AS faults, max_by(role, n) AS last_role
    FROM (SELECT conv_id, role, row_number() OVER w AS n, lag(role) OVER w AS before FROM turns
          WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role)) GROUP BY conv_id
) ON id IS NOT DISTINCT FROM conv_id
GROUP BY conv_id
"""

OP12 = r"""
WITH words AS (
    SELECT rowid_ AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT *, row_number() OVER () AS rowid_ FROM documents)
), kept AS (
    SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT doc) >= 10
), sizes AS (
    SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang
), counts AS (
    SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY lang, source, term
), groups AS (
    SELECT DISTINCT coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents
), totals AS (
    SELECT lang, source, coalesce(sum(c.n), 0) + 2 * any_value(v) AS total
    FROM groups JOIN sizes USING (lang) LEFT JOIN counts c USING (lang, source) GROUP BY lang, source
), shares AS (
    SELECT lang, source, term, coalesce(c.n, 0) AS n,
           1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 2) // total::HUGEINT AS p
    FROM totals JOIN kept USING (lang) LEFT JOIN counts c USING (lang, source, term)
), base AS (
    SELECT k.lang, term, 1 + 1000000000::HUGEINT * (k.n + 2) // (s.n + 2 * s.v)::HUGEINT AS q FROM kept k JOIN sizes s USING (lang)
), pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
    UNION ALL
    SELECT a.lang, a.source, 'pair', b.source, 0 FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    WHERE a.lang NOT IN (SELECT lang FROM sizes)
), terms AS (
    SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value
    FROM shares JOIN base USING (lang, term) WHERE n > 0 AND p > q
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY part, lang, source ORDER BY value DESC, item) AS rank
    FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""

OP13 = r"""
WITH RECURSIVE rows_ AS (
    SELECT *, coalesce(octet_length(encode(text)) || ':' || text, '-') AS text_field FROM documents
), marked AS (
    SELECT *,
           -- CRC-32 of the decimal id, bit by bit: a byte is mixed in, then shifted out in eight steps (-1)
           xor(list_reduce([4294967295] || flatten(list_transform(range(1, length(doc_id::VARCHAR) + 1),
               lambda i: [ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
               lambda acc, x: CASE WHEN x >= 0 THEN xor(acc, x)
                                   WHEN acc & 1 = 1 THEN xor(acc >> 1, 3988292384) ELSE acc >> 1 END), 4294967295) AS crc
    FROM rows_
), leaves AS (
    SELECT doc_id, lang, coalesce(octet_length(encode(lang)) || ':' || lang, '-') AS name,
           sha256(head || n_chars_field || text_field) AS leaf,
           CASE WHEN crc % 7 = 0 AND n_chars IS NOT NULL THEN sha256(head || changed_field || text_field) END AS tampered
    FROM (SELECT *, coalesce(length(doc_id::VARCHAR) || ':' || doc_id, '-')
                    || coalesce(octet_length(encode(source)) || ':' || source, '-')
                    || coalesce(octet_length(encode(lang)) || ':' || lang, '-') AS head,
                 coalesce(length(n_chars::VARCHAR) || ':' || n_chars, '-') AS n_chars_field,
                 length((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1) AS changed_field
          FROM marked)
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY name ORDER BY doc_id NULLS FIRST, leaf, tampered NULLS FIRST) - 1 AS rank,
           count(*) OVER (PARTITION BY name) AS size FROM leaves
), tree AS (
    SELECT name, 0 AS level, rank, size, leaf AS node FROM ranked
    UNION ALL
    SELECT name, level + 1, rank // 2, (max(size) + 1) // 2, sha256(string_agg(node, '' ORDER BY rank))
    FROM tree WHERE size > 1 GROUP BY name, level, rank // 2
), subroots AS (
    SELECT name, node AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS rank, count(*) OVER () AS size
    FROM tree JOIN (SELECT DISTINCT name, lang FROM leaves) USING (name) WHERE size = 1
), crown AS (
    SELECT 0 AS level, rank, size, subroot AS node FROM subroots
    UNION ALL
    SELECT level + 1, rank // 2, (max(size) + 1) // 2, sha256(string_agg(node, '' ORDER BY rank))
    FROM crown WHERE size > 1 GROUP BY level, rank // 2
), steps AS (
    SELECT own.name, own.rank, own.level,
           CASE WHEN other.node IS NULL THEN 'A' WHEN other.rank < own.rank_ THEN 'L' || other.node ELSE 'R' || other.node END AS step
    FROM (SELECT r.name, r.rank, t.level, r.rank >> t.level AS rank_ FROM ranked r
          JOIN (SELECT DISTINCT name, level FROM tree WHERE size > 1) t USING (name)) own
    LEFT JOIN tree other ON other.name = own.name AND other.level = own.level AND other.rank = xor(own.rank_, 1::BIGINT)
), last_steps AS (
    SELECT own.name, own.level,
           CASE WHEN other.node IS NULL THEN 'A' WHEN other.rank < own.rank_ THEN 'L' || other.node ELSE 'R' || other.node END AS step
    FROM (SELECT s.name, c.level, s.rank >> c.level AS rank_ FROM subroots s, (SELECT DISTINCT level FROM crown WHERE size > 1) c) own
    LEFT JOIN crown other ON other.level = own.level AND other.rank = xor(own.rank_, 1::BIGINT)
), proofs AS (
    SELECT r.doc_id, r.leaf, r.tampered, s.subroot, c.node AS root,
           coalesce((SELECT list(step ORDER BY level) FROM steps p WHERE p.name = r.name AND p.rank = r.rank), [])
           || coalesce((SELECT list(step ORDER BY level) FROM last_steps p WHERE p.name = r.name), []) AS path
    FROM ranked r JOIN subroots s USING (name) JOIN crown c ON c.size = 1
)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda x: substr(x, 2)), '')) AS proof_sha256,
       folded_root, folded_root = root AS verified
FROM (SELECT *, list_reduce([coalesce(tampered, leaf)] || path,
                            lambda acc, x: sha256(CASE WHEN x[1] = 'L' THEN substr(x, 2) || acc ELSE acc || substr(x, 2) END))
             AS folded_root FROM proofs)
"""

ORACLE: dict[str, str] = {"op11_role_machine": OP11, "op12_term_divergence": OP12, "op13_merkle_manifest": OP13}
