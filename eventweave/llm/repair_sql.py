"""The repair of damaged conversations as SQL: a recursive query goes through all conversations from
their last rows on, carrying for each state of the pattern the least (cost, edits, repaired text)."""

from __future__ import annotations

_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(k) + 1), lambda i: ascii(substr(k, i, 1))::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, j: xor(x >> 1, (x & 1) * 3988292384))))"""
#: state that a user or assistant row leads to
_FOLLOWS = {0: 2, 1: 2, 2: 3, 3: 2}
_ROLE = {2: "user", 3: "assistant"}
#: initials that may be kept in each state, and where they lead
_KEEPS = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}


def _options(s: int) -> str:
    to = _FOLLOWS[s]
    found = [f"{{'c': 2 + s{s}.c, 'a': 'D' || s{s}.a, 't': s{s}.t}}"]
    for initial, kept in _KEEPS[s].items():
        line = f"{{'c': 5 * kind + s{kept}.c, 'a': 'K' || s{kept}.a, 't': chr(10) || role || ':' || text || s{kept}.t}}"
        found.append(f"CASE WHEN kind < 2 AND initial = '{initial}' THEN {line} END")
    line = f"{{'c': 1 + 5 * kind + s{to}.c, 'a': 'R' || s{to}.a, 't': chr(10) || '{_ROLE[to]}:' || text || s{to}.t}}"
    found.append(f"CASE WHEN kind < 2 THEN {line} END")
    return f"list_sort(list_filter([{', '.join(found)}], lambda o: o IS NOT NULL))[1] AS s{s}"


def _insert(s: int) -> str:
    to = _FOLLOWS[s]
    return f"list_sort([s{s}, {{'c': 5 + s{to}.c, 'a': 'I' || s{to}.a, 't': chr(10) || '{_ROLE[to]}:' || s{to}.t}}])[1] AS s{s}"


_INSERTS = ", ".join(_insert(s) for s in range(4))

SQL = f"""
WITH RECURSIVE g AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(cast(conv_id AS VARCHAR), ' ') || ':' || coalesce(cast(turn AS VARCHAR), ' ') AS k FROM conversations),
h AS (SELECT *, {_CRC} % 20 AS kind FROM g),
d AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
             CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
             unnest(CASE kind WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
      FROM h WHERE kind <> 0),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS rn, substr(role, 1, 1) AS initial,
             rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS shown FROM d),
f AS (SELECT *, CASE WHEN shown = '' THEN 'blank'
                     WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY rn) > 1 THEN 'duplicate'
                     WHEN right(shown, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
             lag(initial) OVER (PARTITION BY conv_id ORDER BY rn) || initial AS pair FROM n),
r AS (SELECT *, CASE WHEN fault IN ('blank', 'duplicate') THEN 2 WHEN fault = 'truncated' THEN 1 ELSE 0 END AS kind FROM f),
c AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
             count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
             count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
      FROM r GROUP BY conv_id),
b AS (
  SELECT conv_id, n AS i, {{'c': 0::BIGINT, 'a': '', 't': ''}} AS s0,
         {{'c': 10::BIGINT, 'a': 'II', 't': chr(10) || 'user:' || chr(10) || 'assistant:'}} AS s1,
         {{'c': 5::BIGINT, 'a': 'I', 't': chr(10) || 'assistant:'}} AS s2, {{'c': 0::BIGINT, 'a': '', 't': ''}} AS s3 FROM c
  UNION ALL
  SELECT conv_id, i, {_INSERTS} FROM (SELECT conv_id, i, {_INSERTS} FROM (
    SELECT b.conv_id, i - 1 AS i, {", ".join(_options(s) for s in range(4))}
    FROM b JOIN r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.rn = b.i) x) y),
o AS (SELECT DISTINCT conv_id FROM conversations)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(s0.c, 0) AS cost,
       coalesce(s0.a, '') AS audit, sha256(coalesce(substr(s0.t, 2), '')) AS repaired_sha256
FROM o LEFT JOIN c ON o.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN (SELECT * FROM b WHERE i = 0) z ON o.conv_id IS NOT DISTINCT FROM z.conv_id"""
