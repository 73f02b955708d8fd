"""SQL for text operators whose answer takes more than a few lines of it."""

from __future__ import annotations

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Shingle sets as rows, links by counting shared shingles, components by following links.
NEAR_DEDUP = rf"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{LETTERS}', '{LETTERS.lower()}'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, md5(array_to_string(w[pos:pos + 4], ' ')) AS shingle
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 3, 2))) AS pos FROM docs WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
  SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
    FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY ALL
  ) JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * shared >= 75 * (p.n + q.n - shared)
), reached AS (
  SELECT doc_id AS node, doc_id AS other FROM docs
  UNION
  SELECT node, b FROM reached JOIN links ON a = other
), components AS (
  SELECT node AS doc_id, min(other) AS component_id FROM reached GROUP BY node
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM docs JOIN components USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""


def _least(*values: str) -> str:
    return f"list_sort(list_filter([{', '.join(values)}], lambda x: x IS NOT NULL))[1]"


def _after(state: int, cost: str, letter: str, line: str | None, guard: str = "TRUE") -> str:
    """The value of a state after one more edit; NULL where it cannot be made."""
    lines = f"list_append(b[{state}].t, {line})" if line else f"b[{state}].t"
    return (
        f"CASE WHEN b[{state}] IS NOT NULL AND {guard} "
        f"THEN {{'c': b[{state}].c + {cost}, 'a': b[{state}].a || '{letter}', 't': {lines}}} END"
    )


def _inserted(value: str) -> str:
    """States 1 to 4 (nothing yet, after s, u, a) after any inserts."""
    user = _least("b[3]", *(_after(state, "3", "I", "'user:'") for state in (1, 2, 4)))
    return f"""SELECT * REPLACE ([b[1], b[2], b[3], {_least("b[4]", _after(3, "3", "I", "'assistant:'"))}] AS b)
  FROM (SELECT * REPLACE ([b[1], b[2], {user}, b[4]] AS b) FROM ({value}))"""


def _step() -> str:
    """States after one more turn, with its columns at hand."""
    more, stays, own = "3 * truncated::INT", "NOT must_go", "role || ':' || text"

    def cells(states: tuple[int, ...], initial: str, name: str) -> list[str]:
        kept = [_after(s, more, "K", own, f"{stays} AND initial = '{initial}'") for s in states]
        return kept + [_after(s, f"3 + {more}", "R", f"'{name}:' || text", stays) for s in states]

    gone = [_after(s, "4", "D", None) for s in (1, 2, 3, 4)]
    system = _after(1, more, "K", own, f"{stays} AND initial = 's'")
    return f"""[{gone[0]}, {_least(gone[1], system)},
    {_least(gone[2], *cells((1, 2, 4), "u", "user"))},
    {_least(gone[3], *cells((3,), "a", "assistant"))}]"""


_BIT = "lambda y, z: CASE WHEN y % 2 = 1 THEN xor(y // 2, 3988292384) ELSE y // 2 END"
_CRC = f"""xor(list_reduce(list_concat([4294967295], list_transform(string_split(key, ''), lambda ch: ascii(ch)::BIGINT)),
    lambda c, x: list_reduce([xor(c, x), 0, 0, 0, 0, 0, 0, 0, 0], {_BIT})), 4294967295)"""

# The cheapest edits by going through the turns of all conversations at once, with the best way to each state.
CONVERSATIONS = rf"""
WITH RECURSIVE given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
  FROM conversations
), drawn AS (
  SELECT *, {_CRC} % 20 AS kind FROM given
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM drawn WHERE kind <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS pos FROM damaged
), faulty AS (
  SELECT *, left(role, 1) AS initial, regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS ink,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) AS nth,
    lag(role) OVER (PARTITION BY conv_id ORDER BY pos) AS last_role
  FROM placed
), marked AS (
  SELECT *, ink = '' AS blank, ink <> '' AND nth > 1 AS duplicate,
    ink <> '' AND nth = 1 AND ink NOT IN ('.', '!', '?') AS truncated, ink = '' OR nth > 1 AS must_go
  FROM faulty
), ways AS (
  {_inserted("SELECT DISTINCT conv_id, 0::BIGINT AS pos, [{'c': 0::BIGINT, 'a': '', 't': []::VARCHAR[]}, NULL, NULL, NULL] AS b FROM given")}
  UNION ALL
  {_inserted("SELECT w.conv_id, m.pos, " + _step() + " AS b FROM ways w JOIN marked m ON m.conv_id IS NOT DISTINCT FROM w.conv_id AND m.pos = w.pos + 1")}
), sums AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
    count(*) FILTER (last_role IS NOT NULL AND left(last_role, 1) || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM marked GROUP BY conv_id
), ends AS (
  SELECT g.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
    coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
    coalesce(illegal, 0)::BIGINT AS illegal, {_least("b[1]", "b[4]")} AS best
  FROM (SELECT DISTINCT conv_id FROM given) g LEFT JOIN sums s ON s.conv_id IS NOT DISTINCT FROM g.conv_id
  JOIN ways w ON w.conv_id IS NOT DISTINCT FROM g.conv_id AND w.pos = coalesce(n, 0)
)
SELECT conv_id, gaps, blank, duplicate, truncated, illegal, best.c AS cost, best.a AS audit,
  sha256(array_to_string(best.t, chr(10))) AS repaired_sha256
FROM ends
"""


# The patterns of the base kinds.
_KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_MATCHES = " UNION ALL ".join(
    rf"""SELECT row_id, {n} AS kind_no, '{kind}' AS kind, unnest(m) AS match, unnest(p[:len(m)]) AS piece, generate_subscripts(m, 1) AS nth
  FROM (SELECT row_id, regexp_extract_all(text, '{pattern}') AS m, regexp_split_to_array(text, '{pattern}') AS p FROM docs)"""
    for n, (kind, pattern) in enumerate(_KINDS.items())
)

# Every match of the base patterns with its place, by the lengths of what lies between; then the rule of its kind.
PII_BASE = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text FROM documents
), matches AS (
  {_MATCHES}
), placed AS (
  SELECT *, regexp_replace(match, '[^0-9]', '', 'g') AS digits,
    sum(length(piece) + length(match)) OVER (PARTITION BY row_id, kind ORDER BY nth)::BIGINT AS stop
  FROM matches
), confirmed AS (
  SELECT *, kind || ':' || (stop - length(match)) || ':' || stop AS span FROM placed
  WHERE CASE kind
    WHEN 'ip' THEN list_max(list_transform(string_split(match, '.'), lambda x: least(x::HUGEINT, 256))) <= 255
    WHEN 'card' THEN length(digits) BETWEEN 16 AND 19 AND list_sum(list_transform(string_split(reverse(digits), ''),
      lambda d, i: CASE WHEN i % 2 = 1 THEN d::INT ELSE 2 * d::INT % 10 + 2 * d::INT // 10 END)) % 10 = 0
    WHEN 'phone' THEN length(digits) BETWEEN 8 AND 15
    ELSE TRUE END
), sums AS (
  SELECT row_id, {", ".join(f"count(*) FILTER (kind = '{kind}') AS n_{kind}" for kind in _KINDS)},
    string_agg(span, ',' ORDER BY kind_no, nth) AS spans
  FROM confirmed GROUP BY row_id
)
SELECT doc_id, {", ".join(f"coalesce(n_{kind}, 0)::BIGINT AS n_{kind}" for kind in _KINDS)},
  sha256(coalesce(spans, '')) AS base_sha256
FROM docs LEFT JOIN sums USING (row_id)
"""
