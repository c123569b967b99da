"""DuckDB SQL of the operators' queries that SQL can express."""

from __future__ import annotations

from machinewatch.llm import chat
from machinewatch.llm.prefix_trie import BORROWED, FAMILY
from machinewatch.llm.quality_rules import MAX_LOST, MAX_REPEAT_PERCENT, MENU_SHARE, MIN_WORDS, SHORT_LINE, SYMBOL_NOISE

_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# A turn's characters in the template: control strings, and one more for each backslash and "<|".
_ESCAPED = "length({0}) + length({0}) - length(replace({0}, '\\', '')) + (length({0}) - length(replace({0}, '<|', ''))) // 2"
_TOKENS = r"len(regexp_extract_all({0}, '\p{{L}}{{1,8}}|\p{{N}}{{1,3}}|[^\s\p{{L}}\p{{N}}]'))"

CHAT = f"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
    UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
),
turns AS (
    SELECT *, {_TOKENS.format('role')} + {_TOKENS.format('text')} + {chat.TURN_TOKENS} AS tokens,
           {len(chat.START) + len(chat.SEPARATOR) + len(chat.END)} + {_ESCAPED.format('role')} + {_ESCAPED.format('text')} AS chars,
           row_number() OVER w AS i
    FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
),
placed AS (
    SELECT t.*, sum(t.tokens) OVER (PARTITION BY t.conv_id ORDER BY i) - t.tokens AS low,
           s.chars AS system_chars, greatest({chat.LEAST_CELL},
               ({chat.BUDGET - chat.HISTORY} - coalesce(s.tokens, 0)) // 2) AS size
    FROM turns t LEFT JOIN (SELECT conv_id, tokens, chars FROM turns WHERE i = 1 AND role = 'system') s
        ON s.conv_id IS NOT DISTINCT FROM t.conv_id
),
celled AS (SELECT *, low // size AS cell, tokens > size AS alone FROM placed),
spans AS (
    SELECT conv_id, cell, alone, min(low) AS start, sum(chars) AS chars, max(system_chars) AS system_chars
    FROM celled GROUP BY conv_id, cell, alone
),
past AS (
    SELECT sum(h.chars) AS chars, s.conv_id
    FROM spans s JOIN celled h ON h.conv_id IS NOT DISTINCT FROM s.conv_id AND h.low < s.start
        AND h.low + h.tokens <= s.start AND h.low >= s.start - {chat.HISTORY} AND h.cell >= s.cell - 1
        AND NOT (s.system_chars IS NOT NULL AND h.low = 0)
    GROUP BY s.conv_id
),
whole AS (
    SELECT conv_id, sum(chars + CASE WHEN start > 0 THEN coalesce(system_chars, 0) ELSE 0 END) AS chars
    FROM spans GROUP BY conv_id
),
digests AS (
    SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
           coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY i), '') AS loss
    FROM turns GROUP BY conv_id
)
SELECT d.conv_id, n_turns, turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
       cast(w.chars + coalesce(p.chars, 0) AS bigint) AS formatted_chars
FROM digests d JOIN whole w ON w.conv_id IS NOT DISTINCT FROM d.conv_id
LEFT JOIN past p ON p.conv_id IS NOT DISTINCT FROM d.conv_id"""

_DECON_WORDS = (f"regexp_extract_all(translate(coalesce(text, ''), '{_LETTERS}', '{_LETTERS.lower()}'), "
                r"'[0-9a-z\x{80}-\x{10FFFF}]+')")

DECONTAMINATION = f"""
WITH docs AS (SELECT doc_id, {_DECON_WORDS} AS w FROM documents),
items AS (SELECT item_id, {_DECON_WORDS} AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(list_slice(w, i, i + 9), ' ') AS words
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0) x
),
places AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM docs WHERE len(w) > 0),
found AS (
    SELECT p.doc_id, p.i, v.n, v.item_id
    FROM (SELECT doc_id, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS words
          FROM places CROSS JOIN (SELECT DISTINCT n FROM windows) k WHERE i + n - 1 <= len(w)) p
    JOIN windows v ON v.n = p.n AND v.words = p.words
),
hits AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (
    SELECT doc_id, unnest(range(i, i + n)) AS pos FROM found) x GROUP BY doc_id),
ids AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (
    SELECT DISTINCT doc_id, cast(item_id AS varchar) AS id FROM found WHERE item_id IS NOT NULL) x GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, h.n_hit IS NOT NULL AS contaminated
FROM docs d LEFT JOIN hits h ON h.doc_id = d.doc_id LEFT JOIN ids i ON i.doc_id = d.doc_id"""

_WORD = r"'[^\x20\x09-\x0D]+'"
_SYMBOLS = "len(regexp_extract_all({0}, '[#*$%&|<>]'))"
_BOILERPLATE = (
    r"(?i)all rights reserved|^\W*(?:this work is )?(?:licensed|released) under\b|terms (?:of|and) (?:use|service|conditions)"
    r"|privacy policy|cookie policy|uses? cookies|accept (?:all )?cookies|sign up for|subscribe to|click here"
    r"|enable javascript|^\W*(?:copyright|©|\(c\))")

QUALITY = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), {_WORD}) AS w FROM documents),
triples AS (
    SELECT doc_id, i, array_to_string(list_slice(w, i, i + 2), ' ') AS t
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM docs WHERE len(w) >= 3) x
),
repeats AS (
    SELECT doc_id, count(DISTINCT pos) AS n FROM (
        SELECT t.doc_id, unnest(range(t.i, t.i + 3)) AS pos
        FROM triples t JOIN (SELECT doc_id, t FROM triples GROUP BY doc_id, t HAVING count(*) > 1) r
            ON r.doc_id = t.doc_id AND r.t = t.t) x GROUP BY doc_id
),
lines AS (
    SELECT doc_id, i, line, w, row_number() OVER (PARTITION BY doc_id, line ORDER BY i) > 1 AS again
    FROM (SELECT doc_id, i, lines[i] AS line, regexp_extract_all(lines[i], {_WORD}) AS w
          FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i
                FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM docs) a) b) c
    WHERE len(w) > 0
),
judged AS (
    SELECT *, len(regexp_extract_all(' ' || array_to_string(w, '  ') || ' ', ' (?:[|»›•·/>-]|::) ')) AS separators, {_SYMBOLS.format('line')} AS symbols,
           length(array_to_string(w, '')) AS chars
    FROM lines
),
verdicts AS (
    SELECT doc_id, count(*) FILTER (WHERE again) AS n_dup_lines, coalesce(sum(chars) FILTER (WHERE again
        OR (separators >= 2 AND separators >= {MENU_SHARE} * len(w)) OR (symbols >= {SYMBOL_NOISE} * len(w) AND symbols >= 3)
        OR regexp_matches(line, '{_BOILERPLATE}')
        OR (len(w) < {SHORT_LINE} AND NOT regexp_matches(w[len(w)], '[.!?…"’”»)。！？:;'']$'))), 0) AS lost
    FROM judged GROUP BY doc_id
),
figures AS (
    SELECT d.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, {_SYMBOLS.format('text')} AS n_symbols,
           coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words, coalesce(lost, 0) AS lost
    FROM docs d LEFT JOIN verdicts v ON v.doc_id = d.doc_id LEFT JOIN repeats r ON r.doc_id = d.doc_id
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
       NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words) AND lost <= {MAX_LOST} * word_chars AS kept
FROM figures"""

# crc32 of a number's decimal digits, bit by bit.
_CRC32 = """xor(4294967295, list_reduce(
    [4294967295::BIGINT] || list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
    lambda a, b: list_reduce([xor(a, b)] || [0::BIGINT, 0, 0, 0, 0, 0, 0, 0],
                             lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""

TRIE = f"""
WITH turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
        PARTITION BY conv_id ORDER BY turn NULLS FIRST,
        sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
    FROM conversations WHERE conv_id IS NOT NULL
),
sizes AS (SELECT conv_id, count(*) AS size, conv_id - conv_id % {FAMILY} AS base, {_CRC32} % {BORROWED} AS h FROM turns GROUP BY conv_id),
convs AS (
    SELECT c.conv_id, c.base, c.h, least(c.h, coalesce(b.size, 0)) AS k FROM sizes c LEFT JOIN sizes b ON b.conv_id = c.base
),
rebuilt AS (
    SELECT c.conv_id, t.pos AS d, role, text FROM convs c JOIN turns t ON t.conv_id = c.base AND t.pos <= c.k
    UNION ALL
    SELECT t.conv_id, t.pos - c.h + c.k, role, text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos > c.h
),
rows AS (
    SELECT conv_id, d, sha256(array_to_string(list(sha256(length(role) || ':' || role || text)) OVER (
               PARTITION BY conv_id ORDER BY d ROWS UNBOUNDED PRECEDING), ',')) AS name,
           len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words
    FROM rebuilt
    UNION ALL SELECT conv_id, 0, '', 0 FROM convs
),
nodes AS (SELECT d, name, min(conv_id) AS rep, count(*) AS n_convs, (count(*) - 1) * max(words) AS saved FROM rows GROUP BY d, name),
own AS (SELECT r.conv_id, r.d, n.rep FROM rows r JOIN nodes n ON n.d = r.d AND n.name = r.name),
linked AS (SELECT n.*, p.rep AS parent FROM nodes n LEFT JOIN own p ON p.conv_id = n.rep AND p.d = n.d - 1),
children AS (SELECT parent AS rep, d - 1 AS d, count(*) AS n FROM linked WHERE d > 0 GROUP BY ALL),
counted AS (SELECT l.*, coalesce(c.n, 0) AS n_children FROM linked l LEFT JOIN children c ON c.rep = l.rep AND c.d = l.d),
totals AS (
    SELECT v.rep, v.d, count(*) FILTER (WHERE w.n_children = 0) AS n_leaves, sum(w.saved) AS saved
    FROM counted w JOIN own v ON v.conv_id = w.rep AND v.d <= w.d GROUP BY v.rep, v.d
),
ends AS (
    SELECT rep, d, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM own
    WHERE (conv_id, d) IN (SELECT (conv_id, max(d)) FROM rows GROUP BY conv_id) GROUP BY rep, d
)
SELECT c.rep AS conv_id, c.d AS depth, c.parent AS parent_conv_id, c.n_convs, c.n_children, t.n_leaves,
       cast(t.saved AS bigint) AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM counted c JOIN totals t ON t.rep = c.rep AND t.d = c.d LEFT JOIN ends e ON e.rep = c.rep AND e.d = c.d"""

ORACLE_SQL: dict[str, str] = {
    "op1_chat_formatting": CHAT, "op8_decontamination": DECONTAMINATION, "op9_quality_rules": QUALITY,
    "op13_conversation_prefix_trie": TRIE,
}
