"""The quality query as DuckDB SQL."""

FACTS = r"""
WITH d AS (
    SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents
),
w AS (
    SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
    FROM d
),
places AS (
    SELECT rid, unnest(generate_series(1, len(ws) - 2)) AS i, ws FROM w WHERE len(ws) > 2
),
windows AS (
    SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM places
),
again AS (
    SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY rid, g) > 1
),
covered AS (
    SELECT rid, count(DISTINCT i + j) AS n_repeat_words
    FROM again, (SELECT unnest([0, 1, 2]) AS j) GROUP BY rid
),
facts AS (
    SELECT w.*, CAST(len(ws) AS BIGINT) AS n_words,
        CAST(length(list_aggregate(ws, 'string_agg', '')) AS BIGINT) AS chars_or_null,
        CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
        coalesce(n_repeat_words, 0) AS n_repeat_words,
        CAST(length(text) - length(regexp_replace(text, '[^\p{L}\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS n_other,
        CAST(length(text) - length(regexp_replace(text, '\p{Lu}', '', 'g')) AS BIGINT) AS n_capitals,
        len(list_filter(ls, lambda x: regexp_matches(x, '^\s*[-*•‣]'))) AS n_bullets,
        len(list_filter(ls, lambda x: regexp_matches(x, '(\.\.\.|…)\s*$'))) AS n_cut
    FROM w LEFT JOIN covered USING (rid)
),
judged AS (
    SELECT *, coalesce(chars_or_null, 0) AS word_chars,
        n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM facts
),
verdicts AS (
    SELECT *, NOT (
        base_failed OR 10 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 15 * n_words
        OR (n_dup_lines >= 3 AND 10 * n_dup_lines > 3 * len(ls))
        OR 10 * (word_chars - n_other) < 6 * word_chars OR n_capitals > 2 * n_words
        OR 10 * n_bullets > 9 * len(ls) OR 10 * n_cut > 3 * len(ls)
    ) AS kept FROM judged
)
"""

SQL = (
    FACTS
    + "SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM verdicts"
)
