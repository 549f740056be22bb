"""SQL that the queries must agree with, where SQL can express them."""

#: What a byte does to a crc32 register, as a list of 256 numbers.
STEPS = """SELECT list_transform(range(256), lambda b:
        list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)) AS s"""

#: Words of a text in lower case.
LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = rf"regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: Control strings of the chat template, with any backslashes that escape them.
CONTROLS = r"<\\*/?s>|<\\*</?SYS>>|\[\\*/?INST\]|\[\\*ROLE\]|\[\\*/?TEXT\]"

SQL = {
    "op11_importance_resampling": f"""
WITH steps AS (
    {STEPS}
), words AS (
    SELECT 'd' AS side, doc_id AS id, unnest({WORDS}) AS w FROM documents
    UNION ALL
    SELECT 't', item_id, unnest({WORDS}) FROM benchmark
), known AS (
    SELECT w, xor(list_reduce(
        list_transform(range(length(h) // 2), lambda i: ('0x' || h[2 * i + 1 : 2 * i + 2])::BIGINT),
        lambda c, b: xor(c >> 8, s[xor(c & 255, b) + 1]), 4294967295), 4294967295) % 10000 AS bucket
    FROM (SELECT w, hex(w) AS h FROM (SELECT DISTINCT w FROM words)), steps
), counts AS (
    SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 't') AS t FROM words JOIN known USING (w) GROUP BY bucket
), totals AS (SELECT sum(s)::DOUBLE AS s_all, sum(t)::DOUBLE AS t_all FROM counts),
gains AS (
    SELECT bucket, floor(1000 * ln((t + 1) * (s_all + 10000) / ((s + 1) * (t_all + 10000))))::BIGINT AS gain FROM counts, totals
), weights AS (
    SELECT id, count(*) AS n, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
    FROM words JOIN known USING (w) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY id
), scores AS (
    SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
        + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || doc_id)[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
    FROM documents LEFT JOIN weights ON id = doc_id
), places AS (
    SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM scores WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score,
    CASE WHEN rank <= (SELECT count(*) * 10 // 100 FROM places) THEN rank END AS rank
FROM scores LEFT JOIN places USING (doc_id)
""",
    "op12_chat_format": rf"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
    SELECT *, length(text) + len(regexp_extract_all(text, '{CONTROLS}')) + CASE role
        WHEN 'user' THEN length('[INST][/INST]') WHEN 'assistant' THEN length('</s>') WHEN 'system' THEN length('<<SYS>><</SYS>>')
        ELSE length('[ROLE][TEXT][/TEXT]') + length(role) + len(regexp_extract_all(role, '{CONTROLS}')) END AS n
    FROM turns
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256, sum(n)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
""",
    "op13_prefix_trie": f"""
WITH steps AS (
    {STEPS}
), turns AS (
    SELECT conv_id, strlen(coalesce(text, '')) AS n_bytes,
        md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS mark,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, mark) AS nth
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
    SELECT conv_id, xor(list_reduce(
        list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
        lambda c, b: xor(c >> 8, s[xor(c & 255, b) + 1]), 4294967295), 4294967295) % 9 AS h
    FROM (SELECT DISTINCT conv_id FROM turns), steps
), picked AS (
    SELECT c.conv_id, 0 AS own, nth, mark, n_bytes FROM convs c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 5 AND nth <= h
    UNION ALL
    SELECT conv_id, 1, nth, mark, n_bytes FROM convs JOIN turns USING (conv_id) WHERE nth > h
), members AS (
    SELECT conv_id, 0 AS depth, '' AS path, 0 AS n_bytes FROM convs
    UNION ALL
    SELECT conv_id, row_number() OVER w, string_agg(mark, '') OVER w, n_bytes
    FROM picked WINDOW w AS (PARTITION BY conv_id ORDER BY own, nth ROWS UNBOUNDED PRECEDING)
), nodes AS (
    SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(n_bytes) AS saved
    FROM members GROUP BY path, depth
), kids AS (
    SELECT path[1 : 32 * (depth - 1)] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1
), ends AS (
    SELECT path, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS sha
    FROM (SELECT conv_id, max(depth) AS depth FROM members GROUP BY conv_id) JOIN members USING (conv_id, depth) GROUP BY path
), subtrees AS (
    SELECT m.path, count(*) FILTER (n_children IS NULL) AS n_leaves, sum(saved) AS saved_tokens
    FROM nodes y LEFT JOIN kids USING (path) JOIN members m ON m.conv_id = y.conv_id AND m.depth <= y.depth GROUP BY m.path
)
SELECT n.conv_id, n.depth::BIGINT AS depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
    saved_tokens::BIGINT AS saved_tokens, coalesce(sha, sha256('')) AS ends_sha256
FROM nodes n JOIN subtrees USING (path) LEFT JOIN kids USING (path) LEFT JOIN ends USING (path)
LEFT JOIN nodes up ON n.depth > 0 AND up.path = n.path[1 : 32 * (n.depth - 1)]
""",
}
