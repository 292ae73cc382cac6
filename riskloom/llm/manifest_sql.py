"""The Merkle manifest of ``documents`` as DuckDB SQL."""

#: crc32 of ``word``: each character is followed by eight steps of one bit.
_CRC = """xor(list_reduce(list_prepend(4294967295, flatten([[ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]
    for c in string_split({word}, '')])), lambda a, x: CASE WHEN x >= 0 THEN xor(a, x)
    WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END), 4294967295)"""


def _cell(value: str, number: bool) -> str:
    size = f"length({value}::VARCHAR)" if number else f"strlen({value})"
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE {size} || ':' || {value} END"


def _leaf(n_chars: str) -> str:
    cells = [("doc_id", True), ("source", False), ("lang", False), (n_chars, True), ("text", False)]
    return f"sha256({' || '.join(_cell(*c) for c in cells)})"


#: One step up in every tree whose level has more than one node.
_UP = """SELECT {keys}level + 1, idx // 2, (any_value(n) + 1) // 2,
    sha256(string_agg(digest, '' ORDER BY idx)) FROM {tree} WHERE n > 1 GROUP BY {keys}level, idx // 2"""

#: One step down: a node's siblings, then those of its parent.
_DOWN = """SELECT {keys} c.level, c.idx, c.n,
      [{{'l': CASE WHEN c.idx % 2 = 1 THEN s.digest ELSE '' END, 'r': CASE WHEN c.idx % 2 = 0 THEN coalesce(s.digest, '') ELSE '' END}}]
        || p.proof
    FROM {proofs} p JOIN {tree} c ON {same} c.level = p.level - 1 AND c.idx // 2 = p.idx AND c.n > 1
    LEFT JOIN {tree} s ON {also} s.level = c.level AND s.idx = xor(c.idx, 1)"""

SQL = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, coalesce('=' || lang, '') AS run, {_leaf("n_chars")} AS leaf,
    CASE WHEN doc_id IS NOT NULL AND {_CRC.format(word="doc_id::VARCHAR")} % 7 = 0 THEN {_leaf("(n_chars + 1)")}
      ELSE {_leaf("n_chars")} END AS tampered
  FROM documents),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
    count(*) OVER (PARTITION BY run) AS n
  FROM leaves),
tree AS (
  SELECT run, 0 AS level, idx, n, leaf AS digest FROM placed UNION ALL {_UP.format(keys="run, ", tree="tree")}),
subroots AS (SELECT run, digest, row_number() OVER (ORDER BY run) - 1 AS idx, count(*) OVER () AS n FROM tree WHERE n = 1),
top AS (SELECT 0 AS level, idx, n, digest FROM subroots UNION ALL {_UP.format(keys="", tree="top")}),
ends AS (
  SELECT level, idx, n, []::STRUCT(l VARCHAR, r VARCHAR)[] AS proof FROM top WHERE n = 1
  UNION ALL {_DOWN.format(keys="", proofs="ends", tree="top", same="", also="")}),
proofs AS (
  SELECT t.run, t.level, t.idx, t.n, e.proof
  FROM tree t JOIN subroots s ON s.run = t.run JOIN ends e ON e.level = 0 AND e.idx = s.idx WHERE t.n = 1
  UNION ALL {_DOWN.format(keys="c.run,", proofs="proofs", tree="tree", same="c.run = p.run AND", also="s.run = c.run AND")})
SELECT d.doc_id, d.leaf, s.digest AS subroot, r.digest AS root,
  sha256(array_to_string([x.l || x.r for x in p.proof], '')) AS proof_sha256,
  list_reduce(list_prepend({{'l': d.tampered, 'r': ''}}, p.proof),
    lambda a, x: {{'l': sha256(x.l || a.l || x.r), 'r': ''}}).l AS folded_root,
  folded_root = r.digest AS verified
FROM placed d JOIN proofs p ON p.run = d.run AND p.level = 0 AND p.idx = d.idx
JOIN subroots s ON s.run = d.run CROSS JOIN (SELECT digest FROM top WHERE n = 1) r
"""
