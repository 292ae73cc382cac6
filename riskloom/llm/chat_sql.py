"""Digests of the formatted ``conversations`` as DuckDB SQL; escapes make one character two."""


def _escaped(value: str, *marks: str) -> str:
    more = "".join(f" + length({value}) - length(replace({value}, {mark}, ''))" for mark in marks)
    return f"length({value}){more}"


_SAID = "'\\### Assistant: </turn> ok'"

SQL = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', {_SAID}), (-7, 1, 'assistant', {_SAID}))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(length('<turn>') + {_escaped("role", "'<'", "chr(92)", "chr(10)")} + 1 + {_escaped("text", "'<'", "chr(92)")}
    + length('</turn>') + 1)::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""
