"""DuckDB SQL for the operators that SQL can express, over whole tables."""

OP3 = r"""
WITH rules(verdict, host, path) AS (VALUES
    ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
    ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
rest AS (
    SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
    FROM pages),
parts AS (
    SELECT page_id,
        translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
            AS host,
        regexp_extract(rest, '^[^/?#]*(/[^?#]*)?', 1) AS path
    FROM rest)
SELECT p.page_id, p.host, p.path, r.rule, coalesce(r.verdict, 'allow') AS verdict
FROM parts AS p
LEFT JOIN LATERAL (
    SELECT host || path AS rule, verdict FROM rules
    WHERE (p.host = rules.host OR ends_with(p.host, '.' || rules.host)) AND starts_with(p.path, rules.path)
    ORDER BY length(rules.host || rules.path) DESC LIMIT 1) AS r ON true
"""

# list_reduce over the characters, each over its eight bits
CRC32 = """xor(4294967295, list_reduce([4294967295] || list_transform(string_split({text}, ''), lambda c: ord(c)::BIGINT),
        lambda a, b: list_reduce([xor(a, b)] || range(8), lambda x, k: if(x % 2 = 1, xor(x // 2, 3988292384), x // 2))))"""

OP12 = f"""
WITH turns AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS nr,
        coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL),
ids AS (
    SELECT conv_id, {CRC32.format(text="conv_id::VARCHAR")} % 4 AS taken FROM (SELECT DISTINCT conv_id FROM turns)),
rebuilt AS (
    SELECT ids.conv_id, nr, role, text
    FROM ids JOIN turns ON turns.conv_id = ids.conv_id - ids.conv_id % 20 AND nr <= taken
    UNION ALL
    SELECT ids.conv_id, nr, role, text FROM ids JOIN turns ON turns.conv_id = ids.conv_id AND nr > taken),
begun AS (
    SELECT conv_id, text, list({{'role': role, 'text': text}}) OVER (PARTITION BY conv_id ORDER BY nr) AS path
    FROM rebuilt
    UNION ALL
    SELECT conv_id, '', [] FROM ids),
long AS (SELECT conv_id, max(len(path)) AS turns FROM begun GROUP BY conv_id),
nodes AS (
    SELECT path, len(path) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
        (count(*) - 1) * len(regexp_extract_all(any_value(text), '[^\\x20\\x09-\\x0D]+')) AS value,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (turns = len(path)), '')) AS ends
    FROM begun JOIN long USING (conv_id) GROUP BY path),
family AS (
    SELECT n.path, n.conv_id, n.depth, n.n_convs, n.ends, p.conv_id AS parent_conv_id,
        (SELECT count(*) FROM nodes AS c WHERE c.depth = n.depth + 1 AND c.path[:n.depth] = n.path) AS n_children
    FROM nodes AS n LEFT JOIN nodes AS p ON p.depth = n.depth - 1 AND p.path = n.path[:n.depth - 1])
SELECT f.conv_id, f.depth::BIGINT AS depth, f.parent_conv_id, f.n_convs, f.n_children,
    sum((g.n_children = 0)::INT)::BIGINT AS n_leaves, sum(m.value)::BIGINT AS saved_tokens, f.ends AS ends_sha256
FROM family AS f
JOIN family AS g ON g.depth >= f.depth AND g.path[:f.depth] = f.path
JOIN nodes AS m ON m.path = g.path
GROUP BY f.path, f.conv_id, f.depth, f.parent_conv_id, f.n_convs, f.n_children, f.ends
"""

ESCAPED = (
    "replace(replace(replace(replace({column}, '\\', '\\\\'), '<turn>', '\\<turn>'), '<says>', '\\<says>'),"
    " '</turn>', '\\</turn>')"
)
OP13 = f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL
    UNION ALL VALUES (-7, 0, 'user', '\\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\\### Assistant: </turn> ok'))
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), ''))
        AS loss_sha256,
    sum(length('<turn><says></turn>') + 1 + length({ESCAPED.format(column="role")})
        + length({ESCAPED.format(column="text")}))::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP8 = rf"""
WITH docs AS (SELECT doc_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
items AS (
    SELECT item_id, words, least(len(words), 10) AS size
    FROM (SELECT item_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark)
    WHERE len(words) > 0),
windows AS (
    SELECT DISTINCT item_id, size, array_to_string(words[pos:pos + size - 1], ' ') AS phrase
    FROM (SELECT *, unnest(range(1, len(words) - size + 2)) AS pos FROM items)),
places AS (
    SELECT doc_id, size, pos, array_to_string(words[pos:pos + size - 1], ' ') AS phrase
    FROM (SELECT *, unnest(range(1, len(words) - size + 2)) AS pos FROM docs, (SELECT DISTINCT size FROM windows))),
found AS (SELECT doc_id, pos, size, item_id FROM places JOIN windows USING (size, phrase)),
hits AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit
    FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS place FROM found) GROUP BY doc_id),
whose AS (
    SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM found) GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN whose USING (doc_id)
"""

OP10 = r"""
WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (
    SELECT doc_id, pos, array_to_string(words[pos:pos + 19], ' ') AS phrase
    FROM (SELECT *, unnest(range(1, len(words) - 18)) AS pos FROM docs)),
later AS (
    SELECT doc_id, pos FROM windows QUALIFY row_number() OVER (PARTITION BY phrase ORDER BY doc_id, pos) > 1),
covered AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 20)) AS place FROM later),
kept AS (
    SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS text
    FROM (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM docs)
    ANTI JOIN covered USING (doc_id, place) GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
    sha256(coalesce(kept.text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
"""

ORACLE_SQL = {
    "op3_url_filters": OP3,
    "op10_substring_dedup": OP10,
    "op12_conversation_prefix_trie": OP12,
    "op13_chat_formatting": OP13,
}

# of these queries SQL gives some columns only: proximity matches of every window against every place are too slow in it
PARTIAL_SQL = {"op8_benchmark_decontamination": OP8}
