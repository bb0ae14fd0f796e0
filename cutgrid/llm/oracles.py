"""SQL that states `op11_repair` and `op13_merkle` from their definitions, for DuckDB."""

from __future__ import annotations


def crc32_sql(text: str) -> str:
    """Unsigned crc32 of an ASCII text: one step per bit, with the character in the first step of its eight."""
    bits = f"flatten(list_transform(string_split({text}, ''), lambda c: [CAST(ascii(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))"
    return f"xor(list_reduce({bits}, lambda a, b: xor(xor(a, b) >> 1, (xor(a, b) & 1) * 3988292384), CAST(4294967295 AS BIGINT)), 4294967295)"


def _more(weight: str, cost: str, letter: str) -> str:
    """A weight (six digits of cost, then letters) with an edit behind it; text order is the order of cost and then letters."""
    return f"lpad(CAST(CAST(left({weight}, 6) AS INTEGER) + {cost} AS VARCHAR), 6, '0') || substr({weight}, 7) || '{letter}'"


def _inserted(columns: list[str]) -> list[str]:
    """The weights of the four states (nothing yet, after s, u, a) after a row was put in or not."""
    nothing, s, u, a = columns
    return [nothing, s, f"least({u}, {_more(nothing, '5', 'I')}, {_more(s, '5', 'I')}, {_more(a, '5', 'I')})", f"least({a}, {_more(u, '5', 'I')})"]


def _edited(columns: list[str]) -> list[str]:
    """The weights after a row: `ini` its initial, `gone` whether it must go, `cut` whether it is truncated."""
    nothing, s, u, a = columns

    def kept(weight: str, initial: str) -> str:
        other = f"WHEN NOT gone THEN {_more(weight, '1 + 5 * cut', 'R')}" if initial != "s" else ""
        return f"CASE WHEN NOT gone AND ini = '{initial}' THEN {_more(weight, '5 * cut', 'K')} {other} END"

    gone = [_more(weight, "2", "D") for weight in columns]
    return [
        gone[0], f"least({gone[1]}, {kept(nothing, 's')})",
        f"least({gone[2]}, {kept(nothing, 'u')}, {kept(s, 'u')}, {kept(a, 'u')})", f"least({gone[3]}, {kept(u, 'a')})",
    ]


_W = ["w0", "w1", "w2", "w3"]
_NAMED = ", ".join(f"{{}} AS {name}" for name in _W)

REPAIR = f"""
WITH RECURSIVE hurt AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {crc32_sql("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS how FROM conversations),
rows_ AS (
  SELECT conv_id, turn, CASE WHEN how = 4 THEN 'user' ELSE role END AS role,
         CASE how WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE how WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy FROM hurt),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i FROM rows_),
judged AS (
  SELECT *, left(role, 1) AS ini, rtrim(text, E' \\t\\n\\x0b\\x0c\\r') AS shown,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again FROM placed),
faults AS (
  SELECT *, shown = '' AS blank, shown <> '' AND again AS duplicate,
         shown <> '' AND NOT again AND right(shown, 1) NOT IN ('.', '!', '?') AS truncated,
         lead(ini) OVER (PARTITION BY conv_id ORDER BY i) AS next_ini FROM judged),
steps AS (SELECT conv_id, i, ini, blank OR duplicate AS gone, CAST(truncated AS INTEGER) AS cut FROM faults),
walk AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, '000000' AS w0, CAST(NULL AS VARCHAR) AS w1, CAST(NULL AS VARCHAR) AS w2,
         CAST(NULL AS VARCHAR) AS w3 FROM steps
  UNION ALL
  SELECT conv_id, i, {_NAMED.format(*_edited(_W))}
  FROM (SELECT conv_id, i, ini, gone, cut, {_NAMED.format(*_inserted(_W))}
        FROM (SELECT w.conv_id, s.i, ini, gone, cut, {_NAMED.format(*_inserted(_W))}
              FROM walk w JOIN steps s ON s.conv_id IS NOT DISTINCT FROM w.conv_id AND s.i = w.i + 1))),
last_ AS (SELECT * FROM walk w WHERE i = (SELECT max(i) FROM steps s WHERE s.conv_id IS NOT DISTINCT FROM w.conv_id)),
best AS (
  SELECT conv_id, least(w0, w3) AS w FROM (
    SELECT conv_id, {_NAMED.format(*_inserted(_W))} FROM (SELECT conv_id, {_NAMED.format(*_inserted(_W))} FROM last_))),
letters AS (
  SELECT conv_id, unnest(string_split(substr(w, 7), '')) AS letter, generate_subscripts(string_split(substr(w, 7), ''), 1) AS spot FROM best),
aligned AS (
  SELECT *, count(*) FILTER (letter <> 'I') OVER (PARTITION BY conv_id ORDER BY spot) AS i,
         count(*) FILTER (letter <> 'D') OVER (PARTITION BY conv_id ORDER BY spot) AS place FROM letters),
shown_ AS (
  SELECT l.conv_id, l.place, l.letter, CASE WHEN l.letter = 'I' THEN '' ELSE f.text END AS text, f.role, f.ini
  FROM aligned l LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM l.conv_id AND f.i = l.i AND l.letter <> 'I' WHERE l.letter <> 'D'),
led AS (SELECT conv_id, max(CASE WHEN place = 1 AND letter = 'K' AND ini = 's' THEN 1 ELSE 0 END) AS led FROM shown_ GROUP BY conv_id),
lines AS (
  SELECT s.conv_id, place, CASE WHEN letter = 'K' THEN role WHEN (place - led) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text AS line
  FROM shown_ s JOIN led l ON l.conv_id IS NOT DISTINCT FROM s.conv_id),
digests AS (SELECT conv_id, sha256(string_agg(line, E'\\n' ORDER BY place)) AS repaired_sha256 FROM lines GROUP BY conv_id),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
         count(*) FILTER (next_ini IS NOT NULL AND ini || next_ini NOT IN ('su', 'ua', 'au')) AS illegal FROM faults GROUP BY conv_id)
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(CAST(left(w, 6) AS BIGINT), 0) AS BIGINT) AS cost,
       coalesce(substr(w, 7), '') AS audit, coalesce(repaired_sha256, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN counts n ON n.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN digests d ON d.conv_id IS NOT DISTINCT FROM c.conv_id"""


def _leaf(n_chars: str) -> str:
    values = ("doc_id", "source", "lang", n_chars, "text")
    return "sha256(" + " || ".join(f"coalesce(strlen(CAST({v} AS VARCHAR)) || ':' || CAST({v} AS VARCHAR), '-')" for v in values) + ")"


def _tree(name: str, leaves: str) -> str:
    """All nodes of the trees over `leaves` (tree, i, n, h): tree, level, i, n (nodes of the level), h."""
    return f"""{name} AS (
  SELECT tree, 0 AS level, i, n, h FROM {leaves}
  UNION ALL
  SELECT tree, level + 1, i // 2, (n + 1) // 2, sha256(h || coalesce(right_, ''))
  FROM (SELECT *, lead(h) OVER (PARTITION BY tree, level ORDER BY i) AS right_ FROM {name}) WHERE n > 1 AND i % 2 = 0)"""


def _folded(name: str, start: str, tree: str) -> str:
    """The way from each row of `start` (doc, tree, i, h, proof) up to its tree's root."""
    return f"""{name} AS (
  SELECT doc, tree, 0 AS level, i, h, proof, false AS done FROM {start}
  UNION ALL
  SELECT w.doc, w.tree, w.level + 1, w.i // 2,
         CASE WHEN o.h IS NULL THEN sha256(w.h) WHEN o.i < w.i THEN sha256(o.h || w.h) ELSE sha256(w.h || o.h) END,
         w.proof || coalesce(o.h, ''), false
  FROM {name} w JOIN (SELECT DISTINCT tree, level, n FROM {tree}) s ON s.tree = w.tree AND s.level = w.level AND s.n > 1
  LEFT JOIN {tree} o ON o.tree = w.tree AND o.level = w.level AND o.i = xor(w.i, 1))"""


MERKLE = f"""
WITH RECURSIVE named AS (
  SELECT row_number() OVER () AS doc, doc_id, coalesce('=' || lang, '-') AS tree, {_leaf("n_chars")} AS h,
         CASE WHEN {crc32_sql("CAST(doc_id AS VARCHAR)")} % 7 = 0 THEN {_leaf("n_chars + 1")} ELSE {_leaf("n_chars")} END AS altered FROM documents),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n FROM named),
{_tree("nodes", "leaves")},
roots AS (SELECT tree AS lang, h FROM nodes WHERE n = 1),
tops AS (SELECT 'all' AS tree, lang, row_number() OVER (ORDER BY lang) - 1 AS i, count(*) OVER () AS n, h FROM roots),
{_tree("upper_nodes", "tops")},
begun AS (SELECT doc, tree, i, altered AS h, '' AS proof FROM leaves),
{_folded("ways", "begun", "nodes")},
reached AS (
  SELECT w.doc, 'all' AS tree, t.i, w.h, w.proof FROM ways w JOIN tops t ON t.lang = w.tree
  WHERE w.level = (SELECT max(level) FROM nodes n WHERE n.tree = w.tree)),
{_folded("upper_ways", "reached", "upper_nodes")},
ended AS (SELECT doc, h AS folded_root, proof FROM upper_ways WHERE level = (SELECT max(level) FROM upper_nodes)),
root AS (SELECT h AS root FROM upper_nodes WHERE n = 1)
SELECT doc_id, l.h AS leaf, r.h AS subroot, root, sha256(proof) AS proof_sha256, folded_root, folded_root = root AS verified
FROM leaves l JOIN roots r ON r.lang = l.tree JOIN ended e ON e.doc = l.doc, root"""
