"""SQL counterparts of the queries that SQL can express on whole tables."""

from __future__ import annotations

from cartlens.llm import quality, urls

_ESCAPED = "(length({0}) - length(translate({0}, '\\<[', '')))"

QUALITY = rf"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text, source FROM documents),
words AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM texts),
numbered AS (
    SELECT doc_id, unnest(range(1, len(words) - 3)) AS i, words FROM words WHERE len(words) >= 5
),
windows AS (SELECT doc_id, i, words[i : i + 4] AS window_words FROM numbered),
twice AS (SELECT *, count(*) OVER (PARTITION BY doc_id, window_words) AS n FROM windows),
covered AS (
    SELECT doc_id, count(DISTINCT place) AS n_repeat_words
    FROM (SELECT doc_id, unnest(range(i, i + 5)) AS place FROM twice WHERE n > 1) GROUP BY doc_id
),
lines AS (SELECT doc_id, text, source, unnest(string_split(text, chr(10))) AS line FROM texts),
normal AS (
    SELECT *, lower(trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g'))) AS plain
    FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
),
duplicates AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM normal GROUP BY doc_id),
hosts AS (SELECT source, count(DISTINCT text) AS n FROM texts GROUP BY source),
boilerplate AS (
    SELECT held.source, plain
    FROM (SELECT source, plain, count(DISTINCT text) AS n FROM normal GROUP BY source, plain) held
    JOIN hosts ON hosts.source IS NOT DISTINCT FROM held.source
    WHERE held.n > {quality.FEW_DOCUMENTS} AND held.n > CAST({quality.SHARE_OF_HOST} AS DOUBLE) * hosts.n
),
removed AS (
    SELECT doc_id, sum(len(string_split(normal.plain, ' '))) AS removed
    FROM normal JOIN boilerplate b ON normal.plain = b.plain AND normal.source IS NOT DISTINCT FROM b.source
    GROUP BY doc_id
),
counts AS (
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
        CAST(coalesce(removed, 0) AS BIGINT) AS n_removed_words
    FROM words LEFT JOIN duplicates USING (doc_id) LEFT JOIN covered USING (doc_id)
    LEFT JOIN removed USING (doc_id)
),
judged AS (
    SELECT *, n_words < {quality.LEAST_WORDS}
        OR 100 * n_repeat_words > {quality.MOST_REPEATED_PERCENT} * n_words AS base_failed
    FROM counts
)
SELECT *, NOT base_failed AND n_words - n_removed_words >= {quality.LEAST_SHARE} * n_words AS kept
FROM judged
"""

EXACT = """
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
groups AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM texts GROUP BY text)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(text) AS text_sha256
FROM texts JOIN groups USING (text)
"""


def _rules() -> tuple[str, str]:
    """CASE branches from the longest rule to the shortest: rule, verdict."""
    rule = verdict = ""
    for kind, host, path in sorted(urls.RULES, key=lambda x: -len(x[1] + x[2])):
        fits = f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}')"
        rule += f" WHEN {fits} THEN '{host}{path}'"
        verdict += f" WHEN {fits} THEN '{kind}'"
    return rule, verdict


URLS = f"""
WITH parts AS (
    SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
    FROM pages
),
hosts AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM parts),
split AS (
    SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path
    FROM hosts
),
toxic AS (
    SELECT DISTINCT host || path AS address FROM split
    JOIN labels ON try_cast(regexp_extract(path, '{urls.NUMBERED}', 1) AS BIGINT) = doc_id WHERE toxic = 1
),
marked AS (
    SELECT *, regexp_matches(host, '(^|[.-])({"|".join(urls.LISTED_WORDS)})([.-]|$)')
        OR host || path IN (SELECT address FROM toxic) AS listed
    FROM split
)
SELECT page_id, host, path, listed, CASE{_rules()[0]} END AS rule,
    CASE{_rules()[1]} WHEN listed THEN 'block' ELSE 'allow' END AS verdict
FROM marked
"""

CHAT = f"""
WITH own AS (SELECT '</s>[INST] ok [/INST]' AS text),
rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', text FROM own
    UNION ALL SELECT -1, 1, 'assistant', text FROM own
),
sized AS (
    SELECT *, length(text) + {_ESCAPED.format("text")} + 4
        + CASE role WHEN 'user' THEN 7 WHEN 'assistant' THEN 8 WHEN 'system' THEN 8
            ELSE 14 + length(role) + {_ESCAPED.format("role")} END AS chars
    FROM rows
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
    sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
    CAST(sum(chars) AS BIGINT) AS formatted_chars,
    count(*) FILTER (WHERE role = 'assistant') AS n_spans
FROM sized GROUP BY conv_id
"""

#: The checksum of a conversation's decimal id, bit by bit.
_CHECKSUM = """xor(list_reduce(
    list_concat([4294967295::BIGINT], [ascii(x)::BIGINT FOR x IN string_split(conv_id::VARCHAR, '')]),
    lambda crc, byte: list_reduce(
        list_concat([xor(crc, byte)], range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1))
    )
), 4294967295)"""

PREFIXES = f"""
WITH given AS (
    SELECT CAST(conv_id AS BIGINT) AS conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL
),
whole AS (
    SELECT conv_id, list(struct_pack(role := role, text := text) ORDER BY turn NULLS FIRST, role, text) AS turns
    FROM given GROUP BY conv_id
),
cut AS (SELECT *, conv_id - conv_id % 100 AS source, {_CHECKSUM} % 6 AS h FROM whole),
rebuilt AS (
    SELECT cut.conv_id, list_concat(coalesce(first.turns[:cut.h], []), cut.turns[cut.h + 1:]) AS turns
    FROM cut LEFT JOIN whole first ON first.conv_id = cut.source
),
paths AS (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS depth FROM rebuilt),
nodes AS (
    SELECT turns[:depth] AS node, depth, min(conv_id) AS owner, count(*) AS n_convs,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE len(turns) = depth), '')) AS ends_sha256
    FROM paths GROUP BY turns[:depth], depth
),
children AS (SELECT node[:depth - 1] AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
measured AS (
    SELECT nodes.*, coalesce(n, 0) AS n_children,
        CASE WHEN depth > 0 THEN (n_convs - 1) * length(node[depth].text) ELSE 0 END AS saved
    FROM nodes LEFT JOIN children USING (node)
),
climbing AS (SELECT node, n_children, saved, unnest(range(0, depth + 1)) AS up FROM measured),
sums AS (
    SELECT node[:up] AS node, sum(saved) AS saved_tokens, count(*) FILTER (WHERE n_children = 0) AS n_leaves
    FROM climbing GROUP BY 1
)
SELECT m.owner AS conv_id, CAST(m.depth AS BIGINT) AS depth, p.owner AS parent_conv_id, m.n_convs, m.n_children,
    CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, m.ends_sha256
FROM measured m JOIN sums USING (node) LEFT JOIN nodes p ON m.depth > 0 AND p.node = m.node[:m.depth - 1]
"""

ORACLE = {
    "op2_quality_rules": QUALITY,
    "op5_exact_dedup": EXACT,
    "op8_url_filter": URLS,
    "op9_chat_format": CHAT,
    "op13_prefix_trie": PREFIXES,
}
